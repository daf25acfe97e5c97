"""Labelled web pages for the extraction model: page parts as they are common on the web, put together by rule.

Each page comes with the texts of its main blocks. Words are made from syllables, since the model reads
no words but a few that tell what a short block is.
"""

import html
import random

# Names that elements of each kind carry, and a few texts.
MENU = "nav menu navbar navigation main-menu site-nav breadcrumb breadcrumbs toolbar pagination pager skip-link tabs dropdown".split()
HEADER = "header site-header masthead topbar banner page-header top-bar branding logo".split()
FOOTER = "footer site-footer copyright legal colophon page-footer bottom footer-links disclaimer imprint".split()
SIDE = "sidebar aside widget related related-posts recommended popular trending most-read side-column secondary rail teaser archive tags".split()
NOTICE = "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal overlay privacy-notice announcement toast paywall dialog message".split()
ADVERT = "ad ads advert advertisement ad-slot sponsor sponsored promo promotion banner-ad commercial adsense".split()
FORM = "form search search-form newsletter subscribe signup login register contact-form survey poll".split()
COMMENTS = "comments comment-list comment reply replies responses discussion reader-comments respond feedback disqus".split()
SHARE = "share social social-share sharing share-buttons follow like-buttons".split()
META = "byline meta post-meta author date published reading-time".split()
MAIN = "content article post entry entry-content article-body post-body main story text body page main-content article-content post-content".split()
PLAIN = "container wrapper row col inner outer box section block grid layout wrap hfeed site".split()
SHORT = {
    "cookie": ["We use cookies.", "This site uses cookies to improve your visit. Accept", "Cookie settings", "Accept all cookies"],
    "footer": ["© 2024 Example", "Copyright 2023. All rights reserved.", "Privacy | Terms | Contact", "Imprint · Privacy · Terms"],
    "comment": ["3 comments", "Leave a reply", "Reply", "Comments"],
    "form": ["Subscribe to our newsletter", "Your e-mail address", "Search", "Login", "Submit"],
    "share": ["Share this", "Share on social media", "Tweet", "Follow us"],
    "ad": ["Advertisement", "Sponsored", "Sponsored content"],
}
SYLLABLES = "th an er on re ti es or en in de la que mento ción ré eau sch ung lich ß ü é ñ ka to mi 日本 の слово ра".split()
JUNK = ["%%%", "***", "###", "&amp;&amp;", "$$$", "&lt;", "&eacute;", "&nbsp;"]


class Writer:
    """Pieces of one page, and which of its blocks belong to the main text."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.main: list[str] = []
        self.serial = 0

    def words(self, low: int, high: int) -> str:
        """Words with an occasional piece of junk; the first is numbered, so no two texts of a page are alike."""
        rng = self.rng
        self.serial += 1
        out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        out[0] = out[0].capitalize() + str(self.serial)
        if rng.random() < 0.1:
            out = [w + rng.choice(JUNK) for w in out]
        return " ".join(out)

    def sentences(self, most: int) -> str:
        return " ".join(self.words(1, 25) + self.rng.choice(["."] * 8 + ["!", "?", ""]) for _ in range(self.rng.randint(1, most)))

    def keep(self, text: str) -> str:
        self.main.append(" ".join(html.unescape(text.replace("<br>", " ")).split()))
        return text

    def named(self, names: list[str], tags: list[str], inside: str) -> str:
        """An element of one of the tags, most often with a fitting class or id."""
        rng = self.rng
        tag = rng.choice(tags)
        name = rng.choice(names)
        if rng.random() < 0.25:
            name += " " + rng.choice(PLAIN)
        mark = rng.choice([f' class="{name}"', f" class='{name}'", f' id="{name}"', f' class="{rng.choice(PLAIN)}-{name}"'])
        if tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6:
            mark = ""
        return f"<{tag}{mark}>{inside}</{tag}>"

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.words(1, 3)}</a></li>' for k in range(self.rng.randint(low, high)))

    def text_or(self, kind: str) -> str:
        return self.rng.choice(SHORT[kind]) if self.rng.random() < 0.4 else self.sentences(3)

    def paragraphs(self, low: int, high: int) -> str:
        end = self.rng.choice(["</p>", "</p>", ""])
        return "".join(f"<p>{self.sentences(3)}{end}" for _ in range(self.rng.randint(low, high)))

    # --- parts that are not main text

    def menu(self):
        return self.named(MENU, ["nav", "div", "ul", "nav"], f"<ul>{self.links(2, 8)}</ul>" if self.rng.random() < 0.7 else self.links(2, 6))

    def header(self):
        rng = self.rng
        tag = rng.choice(["h1", "div", "p", "a"])
        inside = f"<{tag}>{self.words(1, 4)}</{tag}>"
        if rng.random() < 0.5:
            inside += f"<p>{self.sentences(1)}</p>"
        return self.named(HEADER, ["header", "div", "header"], inside + (self.menu() if rng.random() < 0.4 else ""))

    def footer(self):
        rng = self.rng
        inside = rng.choice([f"&copy; {self.words(1, 2)} &middot; {self.sentences(2)}", self.text_or("footer"), f"<p>{self.text_or('footer')}</p>"])
        if rng.random() < 0.4:
            inside += f"<ul>{self.links(2, 5)}</ul>"
        return self.named(FOOTER, ["footer", "div", "footer"], inside)

    def side(self):
        inside = f"<h3>{self.words(1, 4)}</h3>" + self.rng.choice([f"<ul>{self.links(2, 6)}</ul>", self.paragraphs(1, 3), f"<div>{self.sentences(2)}</div>"])
        return self.named(SIDE, ["aside", "div", "section", "aside"], inside)

    def notice(self):
        inside = self.rng.choice([self.text_or("cookie"), f"<p>{self.text_or('cookie')}</p><button>OK {self.words(1, 1)}</button>", self.sentences(2)])
        return self.named(NOTICE, ["div", "section", "div"], inside)

    def advert(self):
        inside = self.rng.choice([self.text_or("ad"), f"<p>{self.sentences(2)}</p>", f'<a href="/x">{self.words(2, 9)}</a>', self.sentences(1)])
        return "<!-- ad -->" * self.rng.randint(0, 1) + self.named(ADVERT, ["div", "section", "div"], inside)

    def form(self):
        tag = self.rng.choice(["label", "p", "div"])
        inside = f"<{tag}>{self.text_or('form')}</{tag}><input name=q><button>{self.words(1, 2)}</button>"
        return f'<form action="/s">{inside}</form>' if self.rng.random() < 0.5 else self.named(FORM, ["form", "div", "section"], inside)

    def comments(self):
        rng = self.rng
        tag = rng.choice(["div", "li", "article", "p"])
        name = rng.choice([' class="comment"', ' class="comment-body"', "", ' class="reply"'])
        each = "".join(
            f"<{tag}{name}>{rng.choice(['', f'<b>{self.words(1, 2)}</b> ', f'<div>{self.words(1, 2)}</div>'])}{rng.choice(['', '<p>']) if tag != 'p' else ''}{self.sentences(4)}</{tag}>"
            for _ in range(rng.randint(1, 6))
        )
        return self.named(COMMENTS, ["section", "div", "ol", "div"], f"<h3>{self.text_or('comment')}</h3>" * rng.randint(0, 1) + each)

    def share(self):
        return self.named(SHARE, ["div", "ul", "section"], self.rng.choice([self.text_or("share"), self.links(2, 5)]))

    # --- the article

    def block(self):
        rng = self.rng
        kind = rng.random()
        if kind < 0.68:
            text = self.words(1, 4) + rng.choice([".", ".", ""]) if rng.random() < 0.3 else self.sentences(rng.choice([1, 3, 8]))
            inside = rng.choice(["", "", "<b>"]) + self.keep(text)
            if rng.random() < 0.15:
                inside = f"<b>{inside}<br>"
            end = rng.choice(["</p>", "</p>", "</p>", ""])
            return f"<p>{inside}{end}"
        if kind < 0.78:
            tag = rng.choice(["h2", "h3", "h4"])
            return f"<{tag}>{self.keep(self.words(1, 8))}</{tag}>"
        if kind < 0.86:
            tag = rng.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.keep(self.words(1, 20))}" for _ in range(rng.randint(2, 6))) + f"</{tag}>"
        if kind < 0.92:
            return f"<blockquote>{self.keep(self.sentences(3))}</blockquote>"
        if kind < 0.95:
            cells = "".join("<tr>" + "".join(f"<td>{self.keep(self.words(1, 3))}</td>" for _ in range(2)) + "</tr>" for _ in range(2))
            return f"<table>{cells}</table>"
        if kind < 0.97:
            return f"<div>{self.keep(self.sentences(3))}</div>"
        if kind < 0.98:
            return f"<figure><img src=x><figcaption>{self.keep(self.words(2, 10))}</figcaption></figure>"
        return f"<pre>{self.keep(self.words(3, 30))}</pre>"

    def plain_text(self):
        """Text straight in the article, lines parted by breaks."""
        return self.keep(self.sentences(5) + "<br>" * self.rng.randint(0, 2) + self.sentences(2))

    def article(self):
        rng = self.rng
        out = []
        if rng.random() < 0.75:
            title = f"<h1>{self.keep(self.words(2, 12))}</h1>"
            out.append(f"<header>{title}</header>" if rng.random() < 0.1 else title)
        if rng.random() < 0.12:
            out.append(self.named(META, ["div", "span", "p"], self.words(1, 4)) + "<div></div>")
        straight = rng.random() < 0.18
        for _ in range(rng.choice([1, 2, 4, 8, 15])):
            out.append(self.plain_text() + "<hr>" if straight else self.block())
            if rng.random() < 0.08:
                out.append(rng.choice([self.advert, self.side, self.share, self.form])())
        for part, chance in ((self.share, 0.15), (self.side, 0.1), (self.comments, 0.15)):
            if rng.random() < chance:
                out.append(part())
        inside = "".join(out)
        kind = rng.random()
        if kind < 0.55:
            return f"<article>{inside}</article>" if rng.random() < 0.6 else f'<article class="{rng.choice(MAIN)}">{inside}</article>'
        if kind < 0.7:
            return f"<main>{inside}</main>"
        if kind < 0.93:
            return f'<div {rng.choice(["class", "id"])}="{rng.choice(MAIN)}">{inside}</div>'
        return f"<div>{inside}</div>"

    def page(self) -> str:
        rng = self.rng
        before = [self.header, self.menu, self.notice, self.advert, self.side, self.form]
        after = [self.footer, self.comments, self.side, self.advert, self.share, self.notice, self.form, self.menu]
        share = rng.choice([0, 0.15, 0.4, 0.6])
        parts = [part() for part in before if rng.random() < share]
        rng.shuffle(parts)
        body = "".join(parts) + self.article() + "".join(part() for part in after if rng.random() < share)
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(PLAIN)}">{body}</div>'
        script = '<script>var t="</p>";go()</script><style>p{margin:0}</style>'
        head = f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title>{script}</head><body>"
        return head + body + rng.choice(["</body></html>", ""])


def labelled_pages(count: int, first: int = 0) -> list[tuple[str, list[str]]]:
    """(html, texts of the main blocks in page order); page k depends on k alone."""
    out = []
    for seed in range(first, first + count):
        writer = Writer(seed)
        out.append((writer.page(), writer.main))
    return out
