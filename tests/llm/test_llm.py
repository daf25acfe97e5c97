"""Each operator against brute force on small inputs, with nulls, ties, repeats, long and empty texts."""

import base64
import collections
import hashlib
import itertools
import json
import pathlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from compare import canonical, oracle_rows
from pyspark.sql import functions as F

import corpus_pipeline
from candlewright.llm import bpe, chat, exact, langid, lines, packing, queries, simhash, suffixes, topk, warc
from candlewright.llm.components import components
from candlewright.session import shared_dir

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, row_key long, fp string, hash long, slot long"


def docs_frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", 1, "x", 2, 3) for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(80))
    texts = [None, "", " \t\n", "a", "A b", "a b c", "a  B c\n\na b c", "日本語 テキスト", "x" * 5000, "'s it's 12 <|endoftext|>", "\\e <s> [INST] |"]
    texts += [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(30)]
    texts += [texts[12], texts[12], texts[13] + " " + passage, passage + texts[14], passage[5:], " ".join(word() for _ in range(6000))]
    return texts


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    columns, rows = oracle_rows(queries.ORACLES[name], SMALL)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, rows)


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1080)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc_round_trip(spark):
    pages = [(1, "http://a", "same"), (3, "http://b", "same"), (3, "http://b", "same"), (2, None, None), (5, "u\r\nx", ""), (None, "n", "only"), (7, "é", "dé" * 9000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("slot", F.lit(1)).withColumn("key", F.lit("k"))
    index = warc.archive(df)
    rows = warc.read_records(index, gap=10, span=2000).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = dict((p[0], p[2] or "") for p in pages)[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), base64.b32encode(hashlib.sha1(html).digest()).decode())
        assert (r.payload == html) if r.record_type == "response" else r.payload is None
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds == sorted([(0, "response", None), (1, "revisit", 3), (3, "response", None), (3, "revisit", 3), (2, "revisit", 5), (5, "response", None), (7, "response", None)], key=lambda k: (k[0], k[1]))
    only = warc.read_records(index.where("url = 'http://a'")).collect()
    assert [r.page_id for r in only] == [1]
    assert warc.read_records(warc.archive(df.limit(0))).count() == 0
    assert warc.revisits(df, min_bytes=5).where("record_type = 'revisit'").count() == 0


def test_line_dedup_keeps_one_of_each_group(spark):
    base = "the quick brown fox jumps over a lazy dog near the old river bank today and tomorrow " * 3
    texts = [base + "\nalpha beta", "Alpha, BETA!\n" + base + "x", None, "", "\n\n", base.replace("quick", "quik") + "\nnew line here", "alpha beta"]
    df = docs_frame(spark, texts, [3, 1, 2, 4, 5, 6, None])
    got = {r.doc_id: r.text for r in lines.without_repeats(df).collect()}
    assert got[1] == texts[1] and got[3] == "" and got[None] == ""
    assert (got[2], got[4], got[5]) == (None, "", "\n\n")
    assert got[6].endswith("new line here")
    assert lines.without_repeats(df).columns == df.columns
    assert lines.without_repeats(df.limit(0)).count() == 0


def test_line_groups_equal_brute_force(spark):
    rng = random.Random(9)
    words = ["w%d" % k for k in range(30)]
    made = []
    for _ in range(25):
        line = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        made.append(" ".join(line))
        for _ in range(rng.randint(0, 5)):
            copy = list(line)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            made.append(" ".join(copy))
    df = docs_frame(spark, made)
    prints = {r.hash: r.fp for r in lines.line_prints(lines.line_table(df)).collect()}
    texts = {r.hash: r.line for r in lines.line_table(df).collect()}
    root = {h: h for h in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    for a in prints:
        for b in prints:
            if a < b and bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 3:
                if edits(texts[a], texts[b]) <= int(max(len(texts[a]), len(texts[b])) * (1 - 0.8) + 1e-9):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    table = lines.line_table(df)
    got = {r.node: r.root for r in lines.line_groups(lines.buckets(lines.line_prints(table)), table).collect()}
    assert {h: got.get(h, h) for h in prints} == {h: find(h) for h in prints}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_short_lines_meet_at_every_edit_similarity(spark):
    rng = random.Random(12)
    made = set()
    for _ in range(40):
        line = [rng.choice("abcdefgh ") for _ in range(rng.randint(1, 40))]
        for _ in range(4):
            copy = list(line)
            for _ in range(rng.randint(0, len(line) // 5)):
                k = rng.randrange(len(copy) + 1)
                copy[k:k + rng.randint(0, 1)] = rng.choice([[], ["é"], ["a", "b"][: rng.randint(1, 2)]])
            made.add("".join(copy))
    table = lines.line_table(docs_frame(spark, sorted(made)))
    texts = {r.hash: r.line for r in table.collect() if len(r.line) <= lines.SHORT}
    near = {
        (a, b) for a in texts for b in texts
        if a < b and edit_distance(texts[a], texts[b]) <= int(max(len(texts[a]), len(texts[b])) * (1 - 0.8) + 1e-9)
    }
    held = collections.defaultdict(set)
    for r in lines.segment_buckets(table).collect():
        held[r.key].add(r.hash)
    met = {(a, b) for group in held.values() for a in group for b in group if a < b}
    assert len(near) > 60 and near <= met


def test_line_dedup_finds_lines_with_a_word_replaced(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9)))
    texts = []
    for n in [6, 8, 10, 14, 20, 27, 40, 60] * 5:
        line = [word() for _ in range(n)]
        copy = list(line)
        k = rng.randrange(n)
        copy[k] = copy[k][:-1] + "xy"
        texts += [" ".join(line), " ".join(copy)]
    gone = {r.doc_id for r in lines.repeated_lines(docs_frame(spark, texts)).collect()}
    # Bands are drawn, so not every pair must meet; by fingerprints of 3 bits few do.
    assert all(k % 2 for k in gone) and len(gone) >= 0.95 * len(texts) / 2


def test_line_keys_are_shuffled_in_rounds_without_changing_groups(spark, monkeypatch):
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    texts = []
    for _ in range(30):
        line = [word() for _ in range(rng.randint(4, 30))]
        for _ in range(4):
            copy = list(line)
            copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    df = docs_frame(spark, texts)
    table = lines.line_table(df)
    prints = lines.line_prints(table)
    n = prints.count()
    rounds = [[r.key for r in keyed.select("key").collect()] for keyed in lines.key_rounds(table, prints)]
    assert all(len(keys) <= lines.KEYS * n for keys in rounds[:-1]) and sum(map(len, rounds[:-1])) == 26 * n
    assert not any(set(a) & set(b) for a, b in itertools.combinations(rounds, 2))

    def groups():
        found = collections.defaultdict(set)
        for r in lines.repeated_lines(df).collect():
            found[r.group_id].add(r.doc_id)
        return sorted(map(sorted, found.values()))

    few = groups()
    monkeypatch.setattr(lines, "KEYS", 26)
    monkeypatch.setattr(lines, "PARTS", 1)
    assert sum(map(len, few)) > 60 and groups() == few


def test_line_pairs_that_cannot_be_similar_go_no_further_than_their_bucket(spark):
    rng = random.Random(15)
    short = [" ".join(rng.choice(["the", "cat", "sat", "mat", "dog", "ran"]) for _ in range(rng.randint(2, 9))) for _ in range(120)]
    long = [" ".join([f"w{k}" for k in range(n)]) for n in (40, 41, 55, 56, 80, 81)]
    table = lines.line_table(docs_frame(spark, short + long))
    texts = {r.hash: r.line for r in table.collect()}
    within = lambda a, b: edit_distance(a, b) <= int(max(len(a), len(b)) * (1 - 0.8) + 1e-9)
    met = lines.segment_buckets(table).where("hash <> centre").select("hash", "centre", "near").distinct().collect()
    near = {(r.hash, r.centre): r.near for r in met}
    assert set(near.values()) == {True, False}
    assert all(found == within(texts[a], texts[b]) for (a, b), found in near.items())
    prints = lines.line_prints(table)
    bands = lines._shared(lines._keyed(prints, lines._band_keys(), lines.BAND)).where("hash <> centre").collect()
    apart = [r for r in bands if not min(map(len, (texts[r.hash], texts[r.centre]))) >= 0.8 * max(map(len, (texts[r.hash], texts[r.centre])))]
    assert apart and not any(r.near for r in apart)


def test_filter_by_text_stays_behind_the_even_shuffle(spark):
    rng = random.Random(18)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 8)))
    base = [[word() for _ in range(12)] for _ in range(10)]
    texts = [" ".join(w[:k] + [word()] + w[k + 1:]) for w in base for k in range(3)]
    seen = []
    kept = lines._kept

    def plan(df, purpose):
        if purpose == "line-links":
            seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, purpose)

    lines._kept = plan
    try:
        table = lines.line_table(docs_frame(spark, texts))
        roots = lines.line_groups(lines._shared(lines._keyed(lines.line_prints(table), lines._band_keys(), lines.BAND)), table).collect()
    finally:
        lines._kept = kept
    assert len({r.root for r in roots}) == 10
    assert seen and all(p.index("levenshtein") < p.index("RepartitionByExpression") and p.count("levenshtein") == p[: p.index("RepartitionByExpression")].count("levenshtein") for p in seen)


def test_comparison_by_beginnings_first_changes_no_result(spark):
    rng = random.Random(16)
    cases = []
    for n in [85, 120, 200, 330]:
        for changed in (0.1, 0.17, 0.19, 0.2, 0.21, 0.25, 0.6):
            a = "".join(rng.choice("abcdefgh  ") for _ in range(n)).strip()
            b = list(a)
            for _ in range(int(len(a) * changed)):
                k = rng.randrange(len(b))
                b[k:k + rng.randint(0, 1)] = rng.choice([[], ["x"], ["y"]])
            cases += [(a, "".join(b)), (a, "".join(b)[::-1]), (a[n // 8:] + a[:n // 8], a)]
    got = spark.createDataFrame(cases, "a string, b string").select("a", "b", lines.similar(F.col("a"), F.col("b"), 0.8)).collect()
    want = [edit_distance(a, b) <= int(max(len(a), len(b)) * (1 - 0.8) + 1e-9) for a, b, _ in got]
    assert [r[2] for r in got] == want and 5 < sum(want) < len(want) - 5


def test_line_dedup_leaves_only_the_tables_of_its_result(spark):
    base = "one two three four five six seven eight nine ten"
    df = docs_frame(spark, [base, base + " eleven", base + " eleven", "other words", "other word"])
    folder = pathlib.Path(shared_dir(spark, "probe").removeprefix("file:")).parent
    before = set(folder.iterdir())
    found = lines.without_repeats(df)
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert not left & {"lines", "line-prints", "line-buckets", "line-pairs", "line-texts", "line-mixed", "line-groups"}
    assert sorted(r.text for r in found.collect()) == ["", "", "", base, "other words"]


def test_line_dedup_keeps_a_line_in_one_of_repeated_rows(spark):
    texts = ["alpha beta\n\n--\ngamma"] * 3 + ["delta words"] * 2 + ["gamma", None, None, "", ""]
    df = docs_frame(spark, texts, [1, 1, 1, None, None, 2, 3, 3, 4, 4]).repartition(3)
    got = collections.defaultdict(list)
    for r in lines.without_repeats(df).collect():
        got[r.doc_id].append(r.text)
    assert sorted(got[1]) == ["\n--", "\n--", texts[0]]
    assert (sorted(got[None]), got[2], got[3], got[4]) == (["", "delta words"], [""], [None, None], ["", ""])


def test_top_k_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (7, [1.0, 2.0]), (8, None), (9, [1.0, None]), (10, [float("nan"), 1.0]), (11, [5.0]), (100, [0.5, -3.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", topk.scaled(F.col("embedding"))).withColumn("key", F.lit(1))
    got = topk.top_k(df, lambda i: i % 50 == 0, k=2, query_block=1, row_block=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 7, 327680), (0, 2, 50, 327680), (50, 1, 0, 327680), (50, 2, 7, 327680), (100, 1, 0, -360448), (100, 2, 7, -360448)]
    assert topk.top_k(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_pruned_top_k_equals_all_products():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(0, 60, (700, 24)))
    rows[::7] = rows[0]
    ids = rng.permutation(700)
    q, r, s = topk.best(rows[:90], ids[:90], rows, ids, 5)
    for i in range(90):
        score = rows @ rows[i]
        want = sorted((-int(score[j]), int(ids[j])) for j in range(700) if ids[j] != ids[i])[:5]
        assert [(-int(a), int(b)) for a, b in zip(s[q == i], r[q == i])] == want


def test_bpe_equals_the_library(spark, odd_texts):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    parts = ["'s", "'", "re", " ", "  ", "\n", "\t", "7", "é", "!", "\xa0", "你", "Ab", "ll", "'ve"]
    texts = odd_texts + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 15))) for _ in range(400)]
    coded = bpe.encode(docs_frame(spark, texts), path)
    for r in coded.collect():
        assert r.ids == own.encode_ordinary(texts[r.doc_id] or "")
        spots = np.cumsum([0, *(len(own.decode_single_token_bytes(i)) for i in r.ids)])[:-1]
        assert r.offsets == spots.tolist()
    for r in bpe.decode(coded, path).collect():
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_packing_loses_nothing(spark, odd_texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    texts = odd_texts * 3
    pieces = packing.pack(docs_frame(spark, texts), path, capacity=256, group_windows=20).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for k, text in enumerate(texts):
        want = own.encode(text or "", add_special_tokens=False).ids + [2]
        got = sorted(by_doc[k], key=lambda p: p.start)
        assert [p.start for p in got] == np.cumsum([0, *(p.length for p in got)])[:-1].tolist()
        assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in got]).tolist() == want
        assert {p.doc_tokens for p in got} == {len(want)}
    for held in by_sequence.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == np.cumsum([0, *(p.length for p in held)])[:-1].tolist()
        assert sum(p.length for p in held) <= 256
    assert sum(p.length for p in pieces) / (256 * len(by_sequence)) > 0.9


def test_packing_query_and_stage_encode_as_the_library_does(spark, odd_texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = odd_texts + ["a <|endoftext|> b", "a<|endoftext|>b<|startoftext|>", "x<|EndOfText|> <|endoftext|"]
    docs_frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    want = {k: own.encode(t or "", add_special_tokens=False).ids + [2] for k, t in enumerate(texts)}
    pieces = dict(corpus_pipeline.STAGES)["packing"](spark, docs_frame(spark, texts), SMALL).collect()
    got = collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert got == want
    for r in queries.QUERIES["op5_packing"](spark, str(tmp_path)).collect():
        part = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert (r.doc_tokens, r.ids_crc32) == (len(want[r.doc_id]), zlib.crc32(part))


def test_language_id_on_held_out_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(df, langid.fit(df), F.struct("doc_id", "lang", "n_chars", langid.held_out().alias("out")))
    rows = [r for r in found.collect() if r.row.out and r.row.n_chars >= 40]
    assert sum(r.lang_pred == r.row.lang for r in rows) >= 0.98 * len(rows) and len(rows) > 200
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    model = langid.fit(df)
    names, score, _, rejected = model.predict(["", "12 !?", "the of and that this with from"])
    assert names[:2] == ["und", "und"] and rejected[:2].all() and score[:2].tolist() == [0, 0] and names[2] == "en"
    nothing = langid.identify(df.limit(3), langid.fit(df.withColumn("lang", F.lit(None).cast("string"))), F.struct("doc_id"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_language_stage_keeps_texts_when_nothing_is_labelled(spark):
    texts = ["plain words", None, "", "12 !?", "日本語", "É", "x" * 3000]
    df = docs_frame(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert sorted(r.doc_id for r in stage(spark, df, SMALL).collect()) == [0, 4, 5, 6]
    rows = langid.identify(df, langid.fit(df), F.struct("doc_id")).collect()
    assert {(r.lang_pred, r.score, r.cross_entropy) for r in rows} == {("und", 0.0, None)} and len(rows) == len(texts)


def test_simhash_equals_brute_force(spark, odd_texts):
    texts = odd_texts + [odd_texts[20] + " one", odd_texts[-1] + " tail", odd_texts[-1][:-9]]

    def own(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        if not words:
            return 0
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [own(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(len(texts)):
                if bin(prints[i] ^ prints[j]).count("1") <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    rows = simhash.near_documents(docs_frame(spark, texts)).collect()
    assert {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in rows} == dict(enumerate(zip(prints, label)))
    kept = simhash.one_of_each(docs_frame(spark, texts + [texts[12]], [*range(len(texts)), 12])).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(label))
    assert simhash.near_documents(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [suffixes.CLASS_LIMIT, 300])
def test_passages_equal_brute_force(spark, odd_texts, limit):
    rng = random.Random(8)
    shared = "".join(rng.choice("abc ") for _ in range(260))
    texts = odd_texts + [f"{k} {shared} {k * 7}" for k in range(12)] + ["ab" * 300, "z" * 199, "z" * 0, "y" * 201]
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i:i + 200] for t in data for i in range(len(t) - 199))
    got = {r.row.doc_id: r for r in suffixes.without_passages(docs_frame(spark, texts), F.struct("doc_id"), class_limit=limit).collect()}
    for k, t in enumerate(data):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(t), int(gone.sum()), spans, kept), k


def test_suffix_array_equals_sorting():
    rng = random.Random(3)
    for _ in range(60):
        text = np.array([rng.randint(1, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 200))])
        assert suffixes.suffix_array(text, depth=10**9).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_chat_windows_train_each_target_once(spark):
    rng = random.Random(6)
    rows = [(1, 0, "system", "be </s> brief \\e |> <|user|>")]
    rows += [(1, k, "assistant" if k % 2 == 0 else "user", "x" * rng.randint(0, 900)) for k in range(1, 60)]
    rows += [(2, 0, None, None), (2, 0, None, None), (3, None, "assistant", "é" * 9000), (None, 5, "user", "[INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("span", F.lit(1))
    made = chat.windows(df)
    back = chat.read_back(made).collect()
    got = collections.defaultdict(list)
    for r in sorted(back, key=lambda r: r.window):
        got[r.conv_id] += [(t.role, t.text) for t in r.turns]
    want = collections.defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1])):
        want[c].append((role or "", text or ""))
    assert got == want
    targets = [t for r in sorted(back, key=lambda r: r.window) if r.conv_id == 1 for t in r.targets]
    assert targets == [t for role, t in want[1] if role == "assistant"]
    windows = {r.window: r for r in made.where("conv_id = 1").collect()}
    assert len(windows) > 3 and all("be \\l/s>" in w.text for w in windows.values())
    assert any(w.context_turns > 1 for w in windows.values())
    assert chat.windows(df.limit(0)).count() == 0


def test_exact_dedup_edges(spark, tmp_path):
    rows = [(4, "a b"), (2, "ab"), (9, "a  b"), (7, "a  b"), (7, "a  b"), (None, "a  b"), (1, None), (3, " \t"), (5, ""), (6, "q")]
    for k in range(0, len(rows), 3):
        spark.createDataFrame(rows[k:k + 3], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d.parquet")
    for digest in (exact.sha256, lambda norm: (F.char_length(norm) % 2).cast("string").cast("binary")):
        got = exact.exact_documents(spark, f"{tmp_path}/d.parquet", digest=digest, max_files=1).collect()
        groups = collections.defaultdict(list)
        for r in got:
            groups[r.text_sha256].append(r)
        assert {(g[0].keep_id, g[0].group_size, sum(r.kept for r in g)) for g in groups.values()} == {(7, 6, 1), (3, 3, 1), (6, 1, 1)}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        docs = docs.cache()
        assert docs.count() >= 150 and docs.where("n_chars <> char_length(text)").count() == 0, name
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_very_long_lines_are_compared_by_units(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 9))) for _ in range(40_000)]
    copy = ["other" + str(k) if k % 300 == 0 else w for k, w in enumerate(words)]
    moved = ["inserted"] * 2500 + words
    far = [w if k % 5 < 3 else "x" + str(k) for k, w in enumerate(words)]
    long = [" ".join(w) for w in (words, copy, moved, far)]
    assert len(long[0]) > 250_000
    table = spark.createDataFrame([(long[0], t) for t in long[1:]] + [(" ".join(words[:3000]), " ".join(copy[:3000])), (long[0][:9000], long[3][:9000])], "a string, b string")
    assert [r[0] for r in table.select(lines.similar(F.col("a"), F.col("b"), 0.8)).collect()] == [True, True, False, True, False]
    df = docs_frame(spark, [long[0], long[1], "short line", "short line too"])
    assert {r.doc_id for r in lines.repeated_lines(df).collect()} == {1}


def test_long_and_short_lines_are_held_to_the_same_edits(spark):
    # One letter of each word is another, so words tell nothing; below and above 4,096 characters a sixth and a quarter of all edited.
    rng = random.Random(22)

    def pair(words, size):
        made = ["".join(rng.choice("abcdefgh") for _ in range(size - 1)) for _ in range(words)]
        return " ".join(made), " ".join("z" + w[1:] for w in made)

    cases = [pair(words, size) for words in (300, 1500) for size in (6, 4)]
    got = spark.createDataFrame(cases, "a string, b string").select(lines.similar(F.col("a"), F.col("b"), 0.8), F.char_length("a"))
    rows = got.collect()
    assert [r[0] for r in rows] == [True, False, True, False]
    assert [r[1] > 4096 for r in rows] == [False, False, True, True]


def test_words_encoded_in_runs_equal_words_alone():
    coder = packing.WordTokenizer(queries.vocabulary("word_bpe_49k.json"), special_as_text=False)
    rng = random.Random(31)
    alphabet = "abcXYZ019|'.,-_é日𝒳́​\xa0 <>/ﬁ½"
    words = ["|", "a|b", "<|endoftext|>", "x<|startoftext|>y", "don't", "｜", "\u0085", "﻿", "'s", "i'll|"]
    words += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    words = [w.encode() for w in dict.fromkeys(words)]
    alone = [np.array(coder.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert coder.coded(words) == alone
