"""Pages as WARC archives: written with an index, read back through it in coalesced ranges."""

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.common import thinned, untouched
from candlewright.session import shared_dir, stored

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DATE = "2024-01-01T00:00:00Z"
GAP = 1 << 16  # unread bytes a range may span
RANGE = 8 << 20  # bytes of a range
GZIP_LEVEL = 6

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Four groups of ten hex digits become eight base-32 digits each."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _opened(uri: str):
    return fs.FileSystem.from_uri(uri)


def revisits(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", min_bytes: int = 0) -> DataFrame:
    """page_id, url, digest, payload_bytes, record_type, refers_to, payload (null for revisits).

    Of equal payloads of at least ``min_bytes`` bytes, one row is the response: the one of largest id
    (a null id comes last), then of largest url, then any. Payloads compare by SHA-256. Only rows
    whose payload may occur twice are shuffled with it; the rest stay in their tasks.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.unhex(F.sha2(payload, 256)).alias("key"),
    ).withColumn("slot", F.xxhash64("key"))
    repeated = stored(
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("key", "slot")
        .agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
        .where("n > 1"),
        "repeated-payloads",
    )
    found = thinned(rows, "slot", repeated).join(repeated.drop("slot", "n"), "key", "left")
    single = untouched(rows, "slot", repeated).union(
        found.where("first IS NULL").select(rows.columns)
    )
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    heads = (
        found.where(F.col("first").isNotNull() & is_first)
        .groupBy("key", "slot", "page_id", "url", "payload_bytes")
        .agg(F.first("payload").alias("payload"), F.count("*").alias("n"))
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    )
    tails = found.where(F.col("first").isNotNull() & ~is_first)
    digest = base32_sha1(F.col("payload"))

    def record(rows, kind, refers_to, payload="payload"):
        return rows.select(
            "page_id", "url", digest.alias("digest"), "payload_bytes", F.hex("key").alias("key"),
            kind.alias("record_type"), refers_to.cast("long").alias("refers_to"),
            F.when(kind == "response", F.col(payload)).alias("payload"),
        )

    nth_kind = F.when(F.col("nth") == 1, F.lit("response")).otherwise(F.lit("revisit"))
    return (
        record(single, F.lit("response"), F.lit(None))
        .union(record(heads, nth_kind, F.when(F.col("nth") > 1, F.col("page_id"))))
        .union(record(tails, F.lit("revisit"), F.col("first.page_id")))
    )


def _record(row: dict) -> bytes:
    response = row["record_type"] == "response"
    payload = row["payload"] or b""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode() + payload
    original = f"<urn:uuid:{uuid.UUID(row['key'][:32])}>"
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": original if response else f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if row["url"] is None else "".join(f"%{ord(c):02X}" if c < " " else c for c in row["url"]),
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "WARC-Profile": None if response else PROFILE,
        "WARC-Refers-To": None if response else original,
        "X-Page-ID": row["page_id"],
        "X-Refers-To-Page-ID": row["refers_to"],
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, level: int = GZIP_LEVEL) -> DataFrame:
    """One archive a task, a gzip member a record; returns the stored index, a row per record.

    A task that runs again writes a file of a new name, and only the run that succeeds is in the
    index. ``folder`` is a shared one, opened by its URI.
    """
    home, path = _opened(folder)
    home.create_dir(path, recursive=True)

    def write(batches):
        out, name, at = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None:
                    system, place = _opened(name)
                    out = system.open_output_stream(place, compression=None, buffer_size=1 << 20)
                packer = zlib.compressobj(level, wbits=31)
                member = packer.compress(_record(row)) + packer.flush()
                out.write(member)
                rows.append((name, at, len(member), row["url"], row["digest"], row["page_id"], row["record_type"]))
                at += len(member)
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["file", "offset", "length", "url", "digest", "page_id", "record_type"],
                )
        if out is not None:
            out.close()

    return stored(records.mapInArrow(write, INDEX), "warc-index")


def _parse(member: bytes) -> tuple:
    record = zlib.decompress(member, wbits=31)
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own != digest or len(payload) != size:
            raise ValueError(f"record of page {fields.get('X-Page-ID')}: payload does not match its digest")

    def number(name):
        return int(fields[name]) if name in fields else None

    return (
        number("X-Page-ID"), fields.get("WARC-Target-URI"), kind, number("X-Refers-To-Page-ID"), size, digest,
        payload if kind == "response" else None,
    )


def read_records(index: DataFrame, payloads: bool = True, gap: int = GAP, span: int = RANGE) -> DataFrame:
    """The records of the index rows given: any selection of an index by url, digest, type or place.

    Rows of one file and region go to one task in the order of the file; neighbours at most ``gap``
    bytes apart are fetched by one read of at most about ``span`` bytes. Without ``payloads`` the
    payload column is null; digest and size are still those of the bytes read.
    """

    def read(batches):
        def fetch(rows):
            system, place = _opened(rows[0]["file"])
            first = rows[0]["offset"]
            with system.open_input_file(place) as source:
                data = source.read_at(rows[-1]["offset"] + rows[-1]["length"] - first, first)
            found = [_parse(data[r["offset"] - first : r["offset"] - first + r["length"]]) for r in rows]
            if not payloads:
                found = [(*f[:-1], None) for f in found]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"],
            )

        held = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (
                    row["file"] != held[-1]["file"]
                    or row["offset"] - held[-1]["offset"] - held[-1]["length"] > gap
                    or row["offset"] + row["length"] - held[0]["offset"] > span
                ):
                    yield fetch(held)
                    held = []
                held.append(row)
        if held:
            yield fetch(held)

    region = (F.col("offset") / F.lit(span)).cast("long")
    return (
        index.select("file", "offset", "length").repartition("file", region).sortWithinPartitions("file", "offset")
        .mapInArrow(read, RECORD)
    )


def archive(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", min_bytes: int = 0) -> DataFrame:
    """Write every page as a WARC record in the shared folder; returns the index.

    A null html is an empty payload, a null url leaves its field out, control characters of a url are
    percent-encoded. Repeated rows are repeated records. An empty table writes no file and gives an
    empty index. Other columns are not read.
    """
    records = revisits(pages, id_col, url_col, html_col, min_bytes)
    return write_archives(records, shared_dir(pages.sparkSession, "warc"))
