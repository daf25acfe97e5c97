"""The registered queries of the corpus operators and their SQL counterparts."""

from pyspark.sql import functions as F

from candlewright.llm import bpe, chat, extract, fim, langid, lines, packing, search, suffixes, topk, warc
from candlewright.llm.common import bounded_batches, table
from candlewright.llm.exact import exact_documents
from candlewright.llm.labelled_pages import labelled_pages
from candlewright.llm.simhash import near_documents

QUERIES = {}
ORACLES = {}


def query(function):
    def run(spark, sf_dir):
        bounded_batches(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def vocabulary(name):
    """A public tokenizer's file, in the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc(spark, sf_dir):
    index = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    return lines.without_repeats(docs).select(
        "doc_id", "n_lines",
        F.when(F.char_length("text") == 0, 0).otherwise(F.size(F.split("text", "\n"))).alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op3_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, lambda vec_id: vec_id % 50 == 0)


@query
def op4_byte_bpe(spark, sf_dir):
    path = vocabulary("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), special_as_text=False)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    carried = F.struct(F.col("doc_id").cast("long").alias("doc_id"), langid.held_out().alias("held_out"))
    return langid.identify(docs, langid.fit(docs), carried).select(
        "row.doc_id", "row.held_out", "lang_pred", "score", "rejected"
    )


@query
def op7_simhash_near_dedup(spark, sf_dir):
    found = near_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_suffix_array_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cut = suffixes.without_passages(docs, F.struct(F.col("doc_id").cast("long").alias("doc_id")))
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_chat_format(spark, sf_dir):
    reply = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", reply), (-7, 1, "assistant", reply)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    back = chat.read_back(chat.windows(turns)).select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("turns"),
            F.array_join("targets", "").alias("targets"),
        ).alias("part"),
        F.size("turns").alias("n"),
        F.char_length("text").alias("chars"),
    )
    whole = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars")
    )
    turns_text, loss_text = F.array_join("parts.turns", ""), F.array_join("parts.targets", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(turns_text.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss_text).cast("long").alias("loss_chars"), F.sha2(loss_text.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op10_exact_dedup(spark, sf_dir):
    return exact_documents(spark, f"{sf_dir}/documents.parquet")


@query
def op11_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    done = fim.rearranged(docs, F.struct(F.col("doc_id").cast("long").alias("doc_id")))
    return done.select(
        "row.doc_id", "n", "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored().cast("binary"), 256).alias("restored_sha256"),
    )


@query
def op12_html_extraction(spark, sf_dir):
    known = spark.createDataFrame(labelled_pages(600), "html string, main array<string>")
    pages = table(spark, sf_dir, "pages")
    found = extract.main_text(pages, extract.fit(known), F.struct(F.col("page_id").cast("long").alias("page_id"), "url"))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op13_lexical_search(spark, sf_dir):
    return search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op10_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

ORACLES["op3_exact_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""

ORACLES["op9_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
k AS (SELECT *, (length(text) + 3) // 4 + 1 AS tokens,
  length(text) + len(regexp_extract_all(text, '[\\<\[|]')) + length(role) + len(regexp_extract_all(role, '[\\<\[|]')) + 10 AS chars FROM t),
p AS (SELECT *, row_number() OVER w AS nth, sum(tokens) OVER w AS "end" FROM k
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, ("end" - tokens) // 768 AS span FROM p),
e AS (SELECT *, max("end") OVER (PARTITION BY conv_id, span) AS span_end, nth = 1 AND role = 'system' AS opening FROM s),
spans AS (SELECT DISTINCT conv_id, span FROM e),
near AS (SELECT e.conv_id, sum(e.chars) AS chars FROM e JOIN spans n ON n.conv_id = e.conv_id AND n.span = e.span_end // 768
  WHERE NOT e.opening AND e.span_end - ("end" - e.tokens) <= 256 AND e.span <> n.span GROUP BY ALL),
heads AS (SELECT e.conv_id, sum(e.chars) AS chars FROM e JOIN spans n ON n.conv_id = e.conv_id AND n.span <> e.span WHERE e.opening GROUP BY ALL),
c AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss FROM k GROUP BY conv_id)
SELECT c.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  (c.chars + coalesce(near.chars, 0) + coalesce(heads.chars, 0))::BIGINT AS formatted_chars
FROM c LEFT JOIN near USING (conv_id) LEFT JOIN heads USING (conv_id)
"""

ORACLES["op11_fill_in_middle"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT *, len(u) AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS r FROM t),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
         WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""

ORACLES["op13_lexical_search"] = r"""
WITH w AS (SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS u
  FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc, doc_id, len(u) AS n, u FROM w WHERE len(u) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM d),
i AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
it AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(u) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
part AS (SELECT doc, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len))) AS part
  FROM tf JOIN wt USING (term) JOIN d USING (doc), total),
s AS (SELECT item_id, text, doc, sum(part)::BIGINT AS score FROM it JOIN part USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN d USING (doc) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50
"""
