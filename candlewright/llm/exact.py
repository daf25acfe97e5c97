"""Exact duplicates: a stream keeps one state row per digest, hits are compared byte by byte."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm.common import BLANKS
from candlewright.session import ROCKSDB, shared_dir, stored

#: Bytes a micro-batch takes in.
BATCH_BYTES = 16 << 30
#: State on disk; a batch uploads what it changed, and files are not allotted ahead of use.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text_col: str = "text"):
    return F.translate(F.coalesce(F.col(text_col), F.lit("")), BLANKS, "")


def sha256(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _read(rows: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """doc_id, norm, digest and the order in which rows of equal text are preferred.

    The order ends with the content locator, so it never ties: code points of the original text,
    smallest doc_id (a null id comes last), then place in the files.
    """
    return rows.select(
        F.col(id_col).cast("long").alias("doc_id"),
        normalised(text_col).alias("norm"),
        F.struct(
            F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("code_points"),
            F.bitwise_not(F.col(id_col).cast("long")).alias("id_order"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("place"),
        ).alias("row"),
    ).withColumn("digest", digest(F.col("norm")))


def digest_state(
    spark: SparkSession, path: str, id_col="doc_id", text_col="text", digest=sha256, batch_bytes=BATCH_BYTES, max_files=None
) -> DataFrame:
    """(digest, keep, group_size) after streaming all files under ``path`` through keyed state.

    The state lives in RocksDB, has no watermark and so never expires. Per digest it retains the
    preferred row (stable identifier and content locator) and a count. Every micro-batch writes the
    digests it touched under its batch id; a repeated batch replaces itself. The last row written
    for a digest is its state.
    """
    out, log = shared_dir(spark, "digest-state"), shared_dir(spark, "digest-log")
    path = path.rstrip("/")
    either = f"{path[:-1]}[{path[-1]}]"  # as a pattern, a stream takes one file as well as a folder
    size = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", batch_bytes)
    source = spark.readStream.schema(spark.read.parquet(path).schema).option(*size)
    state = (
        _read(source.parquet(either), id_col, text_col, digest)
        .groupBy("digest").agg(F.max("row").alias("keep"), F.count("*").alias("group_size"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    written = spark.read.schema(state.schema.add("batch", "long")).parquet(out)
    return written.groupBy("digest").agg(F.max_by("keep", "batch").alias("keep"), F.max("group_size").alias("group_size"))


def exact_documents(
    spark: SparkSession, path: str, id_col="doc_id", text_col="text", digest=sha256, **stream
) -> DataFrame:
    """One row per document under ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are alike without the characters [\\x20\\x09-\\x0D]; a null text counts
    as empty. Of equal texts the row with the most code points stays, then the one with the smallest
    doc_id (null last); rows alike in both are told apart by their place in the files, so exactly one
    row of a group is kept. Rows that share a digest are compared with the row that stays byte by
    byte; rows that differ from it, which only a weak digest brings about, are grouped by the bytes.
    Other columns are not read. An empty table gives an empty result.
    """
    groups = stored(digest_state(spark, path, id_col, text_col, digest, **stream), "digest-groups")
    rows = _read(spark.read.parquet(path), id_col, text_col, digest)
    met = rows.join(groups, "digest").select(
        "doc_id", "row", "keep", "group_size", "digest",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.when(F.col("group_size") > 1, F.col("norm")).alias("norm"),
    )
    met = stored(met, "digest-met")
    alone, hits = met.where("group_size = 1"), met.where("group_size > 1")
    stays = hits.where(F.col("row") == F.col("keep")).select("digest", F.col("norm").alias("kept_norm"))
    compared = hits.join(stays, "digest")
    same = compared.where(F.col("norm") == F.col("kept_norm"))
    other = compared.where(F.col("norm") != F.col("kept_norm"))
    if not other.isEmpty():
        by_bytes = ["digest", "norm"]
        regrouped = hits.groupBy(*by_bytes).agg(F.max("row").alias("keep"), F.count("*").alias("group_size"))
        same = hits.drop("keep", "group_size").join(regrouped, by_bytes)
    columns = ["doc_id", "row", "keep", "group_size", "text_sha256"]
    return alone.select(columns).unionByName(same.select(columns)).select(
        "doc_id",
        F.bitwise_not(F.col("keep.id_order")).alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep")).alias("kept"),
        "text_sha256",
    )
