"""Extraction against brute force over all labellings, held-out pages, and the articles of the given pages."""

import html
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewright.llm import extract, queries
from candlewright.llm.blocks import Block, blocks
from candlewright.llm.labelled_pages import labelled_pages

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return extract.trained([extract.labelled(*p) for p in labelled_pages(600)])


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a<p>b <b>c</b>d<br>e&amp;f&am &eacute; \n g</p>x<hr>y") == ["a", "b cd e&f&am é g", "x", "y"]
    assert texts("<!-- <p>no</p> --><script>var a='<p>no</p>'</script><title>no</title>1 < 2 <3 <b>ok") == ["1 < 2 <3 ok"]
    assert texts("<ul><li>one<li>two<ul><li>in</ul><li>three</ul><table><tr><td>x<td>y<tr><th>z</table>") == ["one", "two", "in", "three", "x", "y", "z"]
    assert texts("<p title='a>b' class=\"c>d\">t</p><P CLASS=x>u</P><!doctype x><?pi x><![CDATA[q]]>v") == ["t", "u", "v"]
    assert texts("") == texts("<div></div><!-- open <p>x") == texts("<script>x <p>y") == []
    assert texts("<div a=\"open>x</div>y") == ["x", "y"]
    assert texts("a b&nbsp;c &#128512;&#x41;") == ["a b c 😀A"]
    deep = blocks("<div class=menu>" * 20_000 + "x" + "</div>" * 19_999 + "<p>y")
    assert [b.text for b in deep] == ["x", "y"] and "name menu" in deep[1].traits
    assert [b.linked for b in blocks("<li><a href=x>link</a> rest</li><p>no")] == [4, 0]
    assert [b.container for b in blocks("<div><p>a</p><ul><li>b</ul></div><div>c")] == [1, 1, 5]


def random_model(rng):
    pick = lambda: rng.uniform(-2, 2)
    step = [[[pick(), pick()], [pick(), pick()]] for _ in range(2)]
    return extract.Model({f"t{k}": pick() for k in range(4)} | {"any": pick()}, step, [pick(), pick()], [pick(), pick()])


def path_score(model, page, labels):
    score = model.first[labels[0]] + model.last[labels[-1]]
    for t, (block, label) in enumerate(zip(page, labels, strict=True)):
        score += label * sum(model.weight.get(x, 0.0) for x in extract.traits(block))
        if t:
            score += model.step[block.container == page[t - 1].container][labels[t - 1]][label]
    return score


def random_page(rng):
    return [Block("x", [f"t{k}" for k in range(4) if rng.random() < 0.5], rng.randint(0, 2), 0) for _ in range(rng.randint(1, 7))]


def test_viterbi_equals_all_labellings():
    rng = random.Random(3)
    for _ in range(150):
        model, page = random_model(rng), random_page(rng)
        best = max(itertools.product((0, 1), repeat=len(page)), key=lambda labels: path_score(model, page, labels))
        assert path_score(model, page, model.labels(page)) == pytest.approx(path_score(model, page, best))


def test_likelihood_and_slopes_equal_brute_force():
    rng = random.Random(5)
    for _ in range(20):
        model, page = random_model(rng), random_page(rng)
        labels = [rng.randint(0, 1) for _ in page]
        every = [path_score(model, page, x) for x in itertools.product((0, 1), repeat=len(page))]
        want = path_score(model, page, labels) - math.log(sum(map(math.exp, every)))
        pad = rng.randint(0, 3)
        emission = np.array([[sum(model.weight.get(x, 0.0) for x in extract.traits(b)) for b in page] + [9.0] * pad])
        same = np.array([[False] + [a.container == b.container for a, b in itertools.pairwise(page)] + [True] * pad])
        inside = np.array([[True] * len(page) + [False] * pad])
        args = same, np.array([labels + [0] * pad]), inside

        def value(emission, step, first, last, args=args):
            return extract.log_likelihood(emission, *args, step, first, last)

        parts = [emission, np.array(model.step), np.array(model.first), np.array(model.last)]
        got, *slopes = value(*parts)
        assert got == pytest.approx(want)
        for part, slope in zip(parts, slopes, strict=True):
            at = tuple(rng.randrange(n) for n in part.shape)
            if part is emission and at[1] >= len(page):
                continue
            part[at] += 1e-6
            assert (value(*parts)[0] - got) / 1e-6 == pytest.approx(slope[at], abs=1e-4)
            part[at] -= 1e-6


def test_held_out_pages(model):
    right = blocks_right = blocks_all = 0
    pages = labelled_pages(200, first=50_000)
    for page, main in pages:
        found = blocks(page)
        guess, truth = model.labels(found), [label for _, _, label in extract.labelled(page, main)]
        blocks_right += sum(a == b for a, b in zip(guess, truth, strict=True))
        blocks_all += len(found)
        right += model.text(page) == "\n\n".join(main)
    assert blocks_right / blocks_all > 0.985 and right / len(pages) > 0.87


def test_parts_that_are_not_main_text(model):
    article = "<article><h1>The title of it</h1><p>A first paragraph, long enough.</p><ul><li>one point</ul><p>The end.</p>{}</article>"
    want = "The title of it\n\nA first paragraph, long enough.\n\none point\n\nThe end."
    around = [
        "<header><h1>Site</h1><p>Our daily news.</p></header>", '<nav><a href="/">Home</a><a href="/b">News</a></nav>',
        '<div class="cookie-notice"><p>We use cookies to improve the site.</p><button>Accept</button></div>',
        '<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Some other story</a></ul></aside>',
        '<div class="ad">Buy this now, it is cheap.</div>', '<form action="/s"><label>Your mail</label><input><button>Go</button></form>',
        '<section id="comments"><h3>2 comments</h3><div class="comment"><p>I liked this text very much, thanks.</p></div></section>',
        "<footer>&copy; 2024 Example. All rights reserved.</footer>",
    ]
    for part in around:
        assert model.text(part + article.format("")) == want, part
        assert model.text(article.format("") + part) == want, part
    assert model.text("".join(around[:6]) + article.format(around[6]) + around[7]) == want


def test_given_pages_by_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.QUERIES["op12_html_extraction"](spark, SMALL).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.DOTALL).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r.text == "\n\n".join(p for p in parts if p)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_odd_rows(spark, model):
    rows = [(1, None, None, "t"), (None, "u", "", "t"), (2, "u", "<p>", "t"), (3, "u", "<article>" + "<p>Some text in here.</p>" * 2, "t"), (3, "u", "<article>" + "<p>Some text in here.</p>" * 2, "t")]
    rows += [(4, "u", "<article>" + "<p>A long text, again and again.</p>" * 30_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract.main_text(df, model, F.struct("*")).collect()
    assert sorted((r.row.page_id or 0, r.text[:60]) for r in got)[:3] == [(0, ""), (1, ""), (2, "")]
    assert [r.text for r in got if r.row.page_id == 3] == ["Some text in here.\n\nSome text in here."] * 2
    assert [r.text.count("\n\n") for r in got if r.row.page_id == 4] == [29_999]
    assert extract.main_text(df.limit(0), model, F.struct("page_id")).count() == 0


def test_fit_on_a_table(spark):
    known = spark.createDataFrame([*labelled_pages(25), (None, ["x"]), ("<p>none</p>", None)], "html string, main array<string>")
    found = extract.fit(known.union(known.limit(3)))
    plain = extract.trained([extract.labelled(p, m) for p, m in [*labelled_pages(25), ("<p>none</p>", [])]])
    assert found.weight.keys() == plain.weight.keys()
    assert all(found.weight[t] == pytest.approx(plain.weight[t], abs=1e-3) for t in plain.weight)
    assert extract.fit(known.limit(0)).weight == {}
