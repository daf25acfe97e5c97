"""Sums that do not depend on order, and number <-> text rules the alert texts follow."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Bits of a place: a double covers three places, and a place can be added up 2^36 times in a long.
PLACE = 26
BASE = 2 ** PLACE
# Place 0 holds sizes from 2^-7.5 up to 2^18.5, so that ordinary prices and quantities share it.
SHIFT = 8


def exact_sums(rows: DataFrame, keys: list[Column | str], sums: dict[str, Column],
               parts: dict[str, Column] | None = None, merged: dict[str, Column] | None = None) -> DataFrame:
    """Per group the exact sums of doubles, each rounded once, whatever order tasks deliver the rows in.

    A double is cut by its exponent into three digits to the base 2^26, whose places are multiples of
    26 bits. Rows are first added up per group and place, as longs that combine map-side in a hash
    aggregate; a group's few places are then carried into one number and rounded to the nearest double.
    No magnitude is cut off: 1e-30 and 1e20 in one group both count.

    ``parts`` are other aggregates of the rows and ``merged`` combines their columns, as a group's rows
    come in by place. Nulls are left out, a group of nulls alone gives null; NaN and infinities give the
    ordinary sum, and a sum beyond the largest double infinity.
    """
    split = rows.withColumns({f"_{n}": value.cast("double") for n, value in sums.items()})
    finite = {n: F.abs(f"_{n}") < float("inf") for n in sums}
    # Half a bit off, so that no power of two lies where the logarithm's last digit decides.
    split = split.withColumns({
        f"_{n}_at": F.when(finite[n], F.floor((F.log2(F.abs(f"_{n}")) - 0.5 + SHIFT) / PLACE).cast("int")) for n in sums
    })
    # Two halves, as the power itself may be beyond a double.
    half = {n: F.pow(F.lit(2.0), F.col(f"_{n}_at") * -(PLACE // 2) + SHIFT // 2) for n in sums}
    split = split.withColumns({f"_{n}_in": F.col(f"_{n}") * half[n] * half[n] for n in sums})
    split = split.withColumns({f"_{n}_high": F.floor(f"_{n}_in") for n in sums})
    split = split.withColumns({f"_{n}_rest": (F.col(f"_{n}_in") - F.col(f"_{n}_high")) * BASE for n in sums})
    split = split.withColumns({f"_{n}_mid": F.floor(f"_{n}_rest") for n in sums})
    split = split.withColumns({f"_{n}_low": ((F.col(f"_{n}_rest") - F.col(f"_{n}_mid")) * BASE).cast("bigint") for n in sums})

    by_place, by_group = [], []
    for n in sums:
        by_place += [F.sum(f"_{n}_{digit}").alias(f"_{n}_{digit}") for digit in ("high", "mid", "low")]
        by_place += [F.sum(F.when(~finite[n], F.col(f"_{n}"))).alias(f"_{n}_special"), F.count(f"_{n}").alias(f"_{n}_seen")]
        digits = F.struct(f"_{n}_at", f"_{n}_high", f"_{n}_mid", f"_{n}_low")
        by_group += [
            F.collect_list(F.when(F.col(f"_{n}_at").isNotNull(), digits)).alias(f"_{n}_places"),
            F.sum(f"_{n}_special").alias(f"_{n}_special"), F.sum(f"_{n}_seen").alias(f"_{n}_seen"),
        ]
    places = split.groupBy(*keys, *[f"_{n}_at" for n in sums]).agg(
        *by_place, *[part.alias(n) for n, part in (parts or {}).items()]
    )
    names = places.columns[: len(keys)]
    groups = places.groupBy(*names).agg(*by_group, *[part.alias(n) for n, part in (merged or {}).items()])

    for n in sums:
        groups = _with_digits(groups, n)
    results = {
        n: F.when(F.col(f"_{n}_seen") > 0, F.coalesce(f"_{n}_special", f"_{n}_plain", _rounded(n))) for n in sums
    }
    return groups.select(*names, *[c.alias(n) for n, c in results.items()], *(merged or {}))


def _top(n: str) -> Column:
    """A place above all carries: sums of digits reach two places up, their sign a third."""
    return F.array_max(F.col(f"_{n}_places")[f"_{n}_at"]) + 3


def _with_digits(groups: DataFrame, n: str) -> DataFrame:
    """Adds the sum where plain expressions can round it, elsewhere its carried digits and their leading one.

    Most groups have one place. Its digits, carried once, are a whole part and a rest that a double holds
    each, so their addition is the one rounding; other groups are carried by a fold. Both are exact.
    """
    one = F.get(f"_{n}_places", F.lit(0))
    carry = F.shiftright(one[f"_{n}_low"] + BASE // 2, PLACE)
    groups = groups.withColumn(f"_{n}_up", carry)
    groups = groups.withColumn(f"_{n}_middle", one[f"_{n}_mid"] + F.col(f"_{n}_up"))
    groups = groups.withColumn(f"_{n}_up2", F.shiftright(F.col(f"_{n}_middle") + BASE // 2, PLACE))
    groups = groups.withColumn(f"_{n}_whole", one[f"_{n}_high"] + F.col(f"_{n}_up2"))
    rest = (
        (F.col(f"_{n}_middle") - F.shiftleft(F.col(f"_{n}_up2"), PLACE)) * BASE
        + one[f"_{n}_low"] - F.shiftleft(F.col(f"_{n}_up"), PLACE)
    )
    half = F.pow(F.lit(2.0), one[f"_{n}_at"] * (PLACE // 2) - SHIFT // 2 - PLACE)
    added = F.col(f"_{n}_whole").cast("double") * float(BASE * BASE) + rest.cast("double")
    single = (F.size(f"_{n}_places") == 1) & (F.abs(f"_{n}_whole") < 2 ** 53)
    groups = groups.withColumn(f"_{n}_plain", F.when(single, added * half * half))
    folded = F.col(f"_{n}_plain").isNull()
    groups = groups.withColumn(f"_{n}_digits", F.when(folded, _carried(F.col(f"_{n}_places"), n)))
    lead = F.array_position(F.transform(f"_{n}_digits", lambda d: d != 0), True).cast("int")
    return groups.withColumn(f"_{n}_lead", F.when(folded, lead))


def _carried(places: Column, n: str) -> Column:
    """Digits from -2^25 up to 2^25 of the sum of all places, the highest first."""
    zero = F.lit(0).cast("bigint")

    def digit_sum(at):
        def add(total, place):
            below = place[f"_{n}_at"] - at
            return total + (
                F.when(below == 0, place[f"_{n}_high"]).when(below == 1, place[f"_{n}_mid"])
                .when(below == 2, place[f"_{n}_low"]).otherwise(zero)
            )
        return F.aggregate(places, zero, add)

    def step(done, at):
        total = done["carry"] + digit_sum(at)
        carry = F.shiftright(total + BASE // 2, PLACE)
        return F.struct(carry.alias("carry"), F.concat(F.array(total - F.shiftleft(carry, PLACE)), done["digits"]).alias("digits"))

    start = F.struct(zero.alias("carry"), F.array().cast("array<bigint>").alias("digits"))
    lowest = F.array_min(places[f"_{n}_at"]) - 2
    return F.when(F.size(places) > 0, F.aggregate(F.sequence(lowest, _top(n)), start, step, lambda done: done["digits"]))


def _rounded(n: str) -> Column:
    """The double nearest to the digits, ties to even.

    Four digits from the leading one hold more bits than a double; of all below only the sign matters,
    as the last bit of an addition of two doubles that is rounded once.
    """
    digits, lead = F.col(f"_{n}_digits"), F.col(f"_{n}_lead")
    d = [F.coalesce(F.get(digits, lead - 1 + i), F.lit(0)) for i in range(4)]
    below = F.signum(F.coalesce(F.get(F.filter(F.slice(digits, lead + 4, F.size(digits)), lambda x: x != 0), F.lit(0)), F.lit(0)))
    high = (d[0] * BASE + d[1]).cast("double") * 2.0 ** (2 * PLACE + 1)
    low = (d[2] * BASE + d[3]).cast("double") * 2.0 + below
    bits = (_top(n) - (lead - 1) - 3) * PLACE - 1 - SHIFT
    half = F.floor(bits / 2)
    scaled = (high + low) * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), bits - half)
    return F.when(lead > 0, scaled).otherwise(0.0)


# Fixed value: the texts that parse as a number (a trailing type letter such as 1.0d does not).
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?((\d(_?\d)*)?\.?(\d(_?\d)*)(e[+-]?\d(_?\d)*)?"
    r"|\d(_?\d)*\.(e[+-]?\d(_?\d)*)?|inf|infinity|nan)\s*$"
)


def to_number(text: Column) -> Column:
    """Text as a double, null where it is no number."""
    return F.when(
        text.rlike(NUMBER_TEXT), F.regexp_replace(F.trim(text), "_", "").try_cast("double")
    )


def number_text(value: Column) -> Column:
    """A double as 0.0005, 10000000.0 or 1e-05: plain digits from 1e-4 up to 1e16."""
    size = F.abs(value)
    shown = value.cast("string")
    plain = F.regexp_replace(
        F.regexp_replace(shown.try_cast("decimal(38,20)").cast("string"), r"0+$", ""), r"\.$", ".0"
    )
    mantissa = F.regexp_replace(F.substring_index(shown, "E", 1), r"\.0$", "")
    power = F.substring_index(shown, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((value == 0) | ((size >= 1e-3) & (size < 1e7)), shown)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def fixed_text(value: Column, digits: int) -> Column:
    """A double with a fixed number of decimals, rounded on its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal text instead, so 1.125 and 1.005 come out
    differently. The residual is taken in two exact halves of the double, which decides each side
    of a tie without leaving double arithmetic.
    """
    unit = float(10 ** digits)
    magnitude = F.abs(value)
    spread = magnitude * 134217729.0
    high = spread - (spread - magnitude)
    low = magnitude - high
    near = F.rint(magnitude * unit)
    above = (high * unit - (near + 0.5)) + low * unit
    below = (high * unit - (near - 0.5)) + low * unit
    odd = (near.cast("bigint") % 2) == 1
    step = (
        F.when((above > 0) | ((above == 0) & odd), 1)
        .when((below < 0) | ((below == 0) & odd), -1)
        .otherwise(0)
    )
    count = near.cast("bigint") + step
    rest = count % int(unit)
    text = F.concat(
        F.when(value < 0, F.lit("-")).otherwise(F.lit("")),
        ((count - rest) / int(unit)).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad(rest.cast("string"), digits, "0"),
    )
    return F.when(magnitude < 2.0 ** 52 / unit, text).otherwise(F.format_string(f"%.{digits}f", value))
