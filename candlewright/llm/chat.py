"""Conversations as windows of marked turns with a loss mask, and the way back."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.session import stored

BUDGET = 1024
HISTORY = 256
TARGET = "assistant"
SYSTEM = "system"

HEAD, HEAD_END, TAIL = "<|", "|>\n", "</s>\n"
#: A text holds no control string once these characters are written as an escape and a letter; the
#: escape itself comes first, so the way back is unambiguous.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def estimated_tokens(text: Column) -> Column:
    """One for the marks and one for every four characters begun."""
    return F.floor((F.char_length(text) + 3) / 4).cast("long") + 1


def placed_turns(turns: DataFrame, tokens=estimated_tokens) -> DataFrame:
    """conv_id, role, text, tokens, nth (from 1) and the tokens before the turn and up to its end.

    The prefix sums run over ranges of the sorted turns: each range is summed by itself, the ranges'
    totals are summed per conversation, and both are added. A conversation of any length is spread
    over many tasks.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tokens", tokens(F.col("text")))
    order = ["turn", "role", "text"]
    rows = stored(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "part").agg(F.sum("tokens").alias("sum"), F.count("*").alias("n"))
    before = totals.select(
        F.col("conv_id").alias("conv"), F.col("part").alias("range"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"),
    )
    rows = rows.withColumn("upto", F.sum("tokens").over(inside)).withColumn("nth", F.count("*").over(inside))
    return rows.join(before, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("range"))).select(
        "conv_id", "role", "text", "tokens",
        (F.col("nth") + F.col("turns_before")).alias("nth"),
        (F.col("tokens_before") + F.col("upto") - F.col("tokens")).alias("begin"),
        (F.col("tokens_before") + F.col("upto")).alias("end"),
    )


def windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, target: str = TARGET, tokens=estimated_tokens
) -> DataFrame:
    """conv_id, window, text, loss, context_turns, tokens: training windows of every conversation.

    Turns are ordered by turn (null first), then role and text; null roles and texts count as empty.
    A turn belongs to the span its first token falls in, spans being ``budget - history`` tokens
    long; turns are never cut, so a window is over the budget by its last turn and system turn at
    most. A window holds the conversation's opening system turn, the turns within the last
    ``history`` tokens of the span before, and its own turns. ``loss`` lists (start, length) in
    characters of the window's text: the texts of its own ``target`` turns, so each is trained on
    once. ``context_turns`` says how many turns at the window's start are repeated. An empty table
    gives no window.
    """
    step = budget - history
    rows = placed_turns(turns, tokens).withColumn("span", F.floor(F.col("begin") / step))
    rows = rows.withColumn("span_end", F.max("end").over(Window.partitionBy("conv_id", "span")))
    rows = stored(rows, "spans")
    opening = (F.col("nth") == 1) & (F.col("role") == SYSTEM)
    own = rows.withColumn("context", F.lit(False))
    following = F.floor(F.col("span_end") / step)
    near = rows.where(~opening & (F.col("span_end") - F.col("begin") <= history) & (following != F.col("span"))).withColumns(
        {"context": F.lit(True), "span": following}
    )
    heads = rows.where(opening).withColumn("first", F.col("span")).drop("span")
    later = rows.select(F.col("conv_id").alias("conv"), "span").distinct()
    kept = (
        heads.join(later, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("span") != F.col("first")))
        .drop("conv", "first").withColumn("context", F.lit(True))
    )
    turn = F.struct("nth", "context", "role", "text", "tokens")
    grouped = (
        own.unionByName(near).unionByName(kept).groupBy("conv_id", "span")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .where(F.exists("turns", lambda t: ~t.context))
    )
    shown = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(HEAD), escaped(t.role), F.lit(HEAD_END)).alias("head"),
        escaped(t.text).alias("body"),
        (~t.context & (t.role == target)).alias("target"),
    ))
    spans = F.aggregate(
        "shown",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("loss")),
        lambda done, t: F.struct(
            (done.at + F.char_length(t.head) + F.char_length(t.body) + len(TAIL)).cast("long").alias("at"),
            F.when(t.target, F.concat(done.loss, F.array(F.struct(
                (done.at + F.char_length(t.head)).cast("long").alias("start"), F.char_length(t.body).cast("long").alias("length")
            )))).otherwise(done.loss).alias("loss"),
        ),
    ).loss
    return grouped.withColumn("shown", shown).select(
        "conv_id",
        F.col("span").alias("window"),
        F.array_join(F.transform("shown", lambda t: F.concat(t.head, t.body, F.lit(TAIL))), "").alias("text"),
        spans.alias("loss"),
        F.size(F.filter("turns", lambda t: t.context)).alias("context_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t.tokens).alias("tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text) without the repeated ones, targets: the texts under the mask."""
    pieces = F.split("text", TAIL)
    turn = F.slice(pieces, F.col("context_turns") + 1, F.size(pieces) - 1 - F.col("context_turns"))

    def parsed(piece):
        head = F.substring_index(piece, HEAD_END, 1)
        return F.struct(
            unescaped(F.substr(head, F.lit(len(HEAD) + 1))).alias("role"),
            unescaped(F.substr(piece, F.char_length(head) + len(HEAD_END) + 1)).alias("text"),
        )

    masked = F.transform("loss", lambda s: unescaped(F.substr(F.col("text"), (s.start + 1).cast("int"), s.length.cast("int"))))
    return formatted.select("conv_id", "window", "text", F.transform(turn, parsed).alias("turns"), masked.alias("targets"))
