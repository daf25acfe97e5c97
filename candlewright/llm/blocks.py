"""HTML cut into leaf blocks: runs of text that no block-level tag interrupts, with what encloses them."""

import html
import re
from dataclasses import dataclass

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt rtc ruby s samp small span strike "
    "strong sub sup time tt u var wbr img picture source map area audio video track canvas meter progress output".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SECTIONS = frozenset("article main section aside nav header footer form body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text or items; what they stand in is the container of a block.
HOLDERS = HEADINGS | frozenset(
    "p li dt dd ul ol dl td th tr tbody thead tfoot table caption pre blockquote figure figcaption button label option legend summary".split()
)
#: A start tag of the key closes an open element of the first set, unless one of the second lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


@dataclass
class Block:
    text: str
    traits: list[str]  # of the enclosing elements
    container: int  # number of the innermost element that holds blocks
    linked: int  # characters inside links


def traits_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The element's name, and the words of its class, id and role."""
    words = {w.lower() for m in NAMES.finditer(attributes) for w in WORD.findall(m.group(2))}
    return (f"tag {tag}", *sorted(f"name {w}" for w in words if len(w) < 30))


def events(page: str):
    """(kind, value, attributes): text, start and end in page order; comments and raw text elements are passed over.

    What the page leaves open at its end counts as closed there: a comment or a script runs to the end.
    """
    at, size = 0, len(page)
    while at < size:
        open_at = page.find("<", at)
        if open_at < 0:
            yield "text", page[at:], ""
            return
        if open_at > at:
            yield "text", page[at:open_at], ""
        if page.startswith("<!--", open_at):
            end = page.find("-->", open_at + 4)
            at = size if end < 0 else end + 3
            continue
        tag = TAG.match(page, open_at)
        if tag is None:
            special = page.startswith(("<!", "<?", "</"), open_at)
            if not special and not page[open_at + 1:open_at + 2].isalpha():
                yield "text", "<", ""
                at = open_at + 1
                continue
            end = page.find(">", open_at)
            at = size if end < 0 else end + 1
            continue
        at = tag.end()
        name = tag.group(2).lower()
        if tag.group(1):
            yield "end", name, ""
        elif name in RAW:
            close = RAW_END[name].search(page, at)
            at = size if close is None else close.start()
        else:
            yield "start", name, tag.group(3)


class _Tree:
    """The open block-level elements and what they say about text inside them."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...], int]] = []
        self.open: dict[str, int] = {}  # by name
        self.active: dict[str, int] = {}  # by trait
        self.made = 0

    def container(self) -> int:
        return next((number for name, _, number in reversed(self.stack) if name not in HOLDERS), 0)

    def traits(self) -> list[str]:
        """All traits of the enclosing elements, the innermost element, and the nearest one with names."""
        near = next((t for _, t, _ in reversed(self.stack[-16:]) if any(x.startswith("name ") for x in t)), ())
        parent = self.stack[-1][0] if self.stack else ""
        return [*self.active, f"parent {parent}", *[f"near {x}" for x in near]]

    def push(self, name: str, attributes: str):
        self.made += 1
        traits = traits_of(name, attributes)
        if name in SECTIONS:
            outer = next((n for n, _, _ in reversed(self.stack[-8:]) if n in SECTIONS), "")
            traits += (f"inside {outer} {name}",)
        self.stack.append((name, traits, self.made))
        self.open[name] = self.open.get(name, 0) + 1
        for trait in traits:
            self.active[trait] = self.active.get(trait, 0) + 1

    def pop(self):
        name, traits, _ = self.stack.pop()
        self.open[name] -= 1
        for trait in traits:
            left = self.active[trait] - 1
            if left:
                self.active[trait] = left
            else:
                del self.active[trait]

    def close(self, name: str):
        while self.open.get(name):
            last = self.stack[-1][0]
            self.pop()
            if last == name:
                return

    def start(self, name: str, attributes: str):
        if self.stack and (self.stack[-1][0] == "p" or (name in HEADINGS and self.stack[-1][0] in HEADINGS)):
            self.pop()
        if name in CLOSES:
            targets, walls = CLOSES[name]
            if any(self.open.get(t) for t in targets):
                for k in range(len(self.stack) - 1, -1, -1):
                    if self.stack[k][0] in walls:
                        break
                    if self.stack[k][0] in targets:
                        while len(self.stack) > k:
                            self.pop()
                        break
        self.push(name, attributes)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order: references decoded, white space turned into one space, trimmed."""
    tree, found = _Tree(), []
    parts: list[str] = []
    links: list[int] = []
    in_link = in_head = False

    def flush():
        nonlocal in_link
        if parts:
            text = " ".join("".join(parts).split())
            if text and not in_head:
                found.append(Block(text, tree.traits(), tree.container(), min(len(text), sum(links))))
            parts.clear()
            links.clear()
        in_link = False

    for kind, value, attributes in events(page):
        if kind == "text":
            text = html.unescape(value) if "&" in value else value
            parts.append(text)
            if in_link:
                links.append(len(text.strip()))
        elif value == "br":
            parts.append(" ")
        elif value in ("html", "head", "body"):
            flush()
            in_head = value == "head" and kind == "start"
        elif value in INLINE:
            if value == "a":
                in_link = kind == "start"
        else:
            flush()
            if kind == "end":
                tree.close(value)
            else:
                if in_head and value not in VOID and value not in ("noscript", "template"):
                    in_head = False
                if value == "hr":
                    if tree.stack and tree.stack[-1][0] == "p":
                        tree.pop()
                elif value not in VOID:
                    tree.start(value, attributes)
    flush()
    return found
