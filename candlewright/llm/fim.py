"""Fill-in-the-middle rearrangement of texts: one counted regular expression a row cuts prefix, middle and suffix."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: A unit that gives nothing back: the counted groups below then match in one pass, without a stack.
POSSESSIVE = "(?:[A-Za-z]++|[^A-Za-z])"
#: Marks of prefix, suffix and middle.
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
MARK = "<[PSM]>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(id_col: str, seed: int, count: int) -> list[Column]:
    """Unsigned 32-bit numbers from the SHA-256 of ``seed:id``; a null id reads as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(count)]


def _order(first: str, second: str) -> Column:
    group = {"prefix": "$1", "middle": "$2", "suffix": "$3"}
    return F.lit("".join(MARKS[part] + group[part] for part in (first, second, "middle")))


def rearranged(
    docs: DataFrame, carried: Column, id_col="doc_id", text_col="text", seed: int = 1, rate: int = 90, suffix_first: int = 20
) -> DataFrame:
    """``carried`` (a struct, as column row) with n, form, prefix, middle, suffix and output of every row.

    A text has n units: words of ASCII letters and single other code points. Two draws cut it in three;
    ``rate`` of 100 texts become prefix, suffix, middle (psm) or, ``suffix_first`` of 100 of those, suffix,
    prefix, middle (spm). The others are plain, as are empty texts and those that hold a mark already:
    their output is the text, their parts are null. A null text counts as empty. Rows depend on their
    own id and text alone, so repeated rows come out alike, nothing is shuffled, and other columns are
    not read. A row needs memory for its units while they are counted.
    """
    h = [F.col(f"h{k}") for k in (1, 2, 3, 4)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(carried.alias("row"), text.alias("text"), *[d.alias(f"h{k}") for k, d in enumerate(draws(id_col, seed, 4), 1)])
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    marked = F.lit(False)
    for mark in MARKS.values():
        marked = marked | F.contains("text", F.lit(mark))
    cuts = [h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)]
    form = F.when((F.col("n") == 0) | marked | (h[2] % 100 >= rate), PLAIN).when(h[3] % 100 < suffix_first, SPM).otherwise(PSM)
    rows = rows.select("row", "text", "n", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), form.alias("form"))
    pattern = F.concat(
        F.lit(rf"(?s)\A({POSSESSIVE}{{"), F.col("a"), F.lit(rf"}}+)({POSSESSIVE}{{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*)\z")
    )
    order = F.when(F.col("form") == SPM, _order("suffix", "prefix")).otherwise(_order("prefix", "suffix"))
    output = F.when(F.col("form") == PLAIN, F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return with_parts(rows.select("row", "n", "form", output.alias("output"))).select(
        "row", "n", "form", "prefix", "middle", "suffix", "output"
    )


def with_parts(rows: DataFrame) -> DataFrame:
    """prefix, middle and suffix read back from ``output`` by ``form``; null where it is plain.

    Between marks stands text without any, so the marks found are those that were set.
    """
    parts = rows.withColumn("parts", F.when(F.col("form") != PLAIN, F.split("output", MARK)))
    spm = F.col("form") == SPM
    at = {"prefix": F.when(spm, 2).otherwise(1), "suffix": F.when(spm, 1).otherwise(2), "middle": F.lit(3)}
    return parts.select("*", *[F.get("parts", k).alias(part) for part, k in at.items()]).drop("parts")


def restored() -> Column:
    """The text before, from the columns of ``with_parts``."""
    return F.when(F.col("form") == PLAIN, F.col("output")).otherwise(F.concat("prefix", "middle", "suffix"))
