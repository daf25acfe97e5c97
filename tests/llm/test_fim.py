"""Fill-in-the-middle against a plain Python version."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from candlewright.llm import fim


def plainly(doc_id, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = parts
    if h[3] % 100 < 20:
        return n, "spm", prefix, middle, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "a", "\n", "ab\r\ncd", "<P>", "x <S> y", "<<M>", "<P<S", "< P>$1\\2", "é日本𝒳 word", "\u0000a", "a b" * 30, "a b" * 30]
    texts += ["".join(rng.choice("ab <>PSM$\\\né𝒳1") for _ in range(rng.randint(1, 80))) for _ in range(200)]
    texts += ["word, " * 400_000, "x" * 2_000_000, "é" * 600_000]
    rows = [(k, t, "r", 1) for k, t in enumerate(texts)] + [(None, "no id", "r", 1), (3, "a", "r", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n long"), rows


def test_equals_plain_version(spark):
    df, rows = rows_of(spark)
    done = fim.rearranged(df, F.struct("doc_id", "text"))
    got = done.select("row.doc_id", "n", "form", "prefix", "middle", "output", fim.restored().alias("restored"), "row.text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix, r.middle, r.output) == plainly(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_parameters_and_empty_table(spark):
    df, _ = rows_of(spark)
    empty = fim.rearranged(df.limit(0), F.struct("*"))
    assert empty.columns == ["row", "n", "form", "prefix", "middle", "suffix", "output"] and empty.count() == 0
    short = df.where("length(text) < 100")
    assert {r.form for r in fim.rearranged(short, F.struct("*"), rate=0).select("form").collect()} == {"plain"}
    every = fim.rearranged(short, F.struct("*"), rate=100, suffix_first=100, seed=7).where("row.text = 'a'").select("form").collect()
    assert {r.form for r in every} == {"spm"}
