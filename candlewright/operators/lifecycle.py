"""Changes to the rules table, applied as a batch."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.operators import rules as R
from candlewright.session import stored

PATCHED = [
    "conditions", "logic", "action", "notification_channels",
    "email_address", "webhook_url", "cooldown_seconds", "is_active",
]
RULE_COLUMNS = [
    "rule_id", "user_id", "symbol", "timeframe", *PATCHED,
    "created_at", "updated_at", "last_triggered_at", "trigger_count",
]


def new_rules(requests: DataFrame, at: Column, rule_id: Column) -> DataFrame:
    """Full rules from create requests: defaults, normalised symbol, times, zero counters."""
    return R.with_defaults(requests).withColumns({
        "rule_id": rule_id, "created_at": at, "updated_at": at,
        "last_triggered_at": F.lit(None).cast("timestamp"), "trigger_count": F.lit(0),
    }).select(*RULE_COLUMNS)


def create(rules: DataFrame, requests: DataFrame, at: Column, rule_id: Column) -> DataFrame:
    """The rules with the valid requests added; an id already taken is refused.

    Of requests that name one id in a batch the earliest by ``at`` is taken, then the smallest by owner
    and content, so the choice does not depend on the order of rows.
    """
    valid, _ = R.validate(requests)
    made = new_rules(valid, at, rule_id)
    order = Window.partitionBy("rule_id").orderBy("created_at", "user_id", F.xxhash64(*RULE_COLUMNS))
    first = made.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")
    added = first.join(rules.select("rule_id"), "rule_id", "left_anti")
    return rules.select(*RULE_COLUMNS).unionByName(added.select(*RULE_COLUMNS))


def _sets_any(payload: str = "payload") -> Column:
    out = F.lit(False)
    for name in PATCHED:
        out = out | F.col(f"{payload}.{name}").isNotNull()
    return out


def _latest(column: Column) -> Column:
    """The value of the latest change that sets it (null if none); combines map-side."""
    return F.max_by(column, F.when(column.isNotNull(), F.col("ts")))


def patch_errors(payload: str = "payload") -> Column:
    """All reasons a patch is refused: each value it sets must be one that a rule may have."""
    return R.value_errors(lambda name: F.col(f"{payload}.{name}"), lambda value: value.isNotNull())


def validate_patches(patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patches to apply, and refused ones with their errors: a patch with one bad value changes nothing.

    Takes a change log as well, whose other operations all pass. ``patch`` and ``apply_changes`` expect
    what this lets through.
    """
    errors = patch_errors()
    if "op" in patches.columns:
        errors = F.when(F.col("op") == "patch", errors).otherwise(F.array().cast("array<string>"))
    both = patches.withColumn("errors", errors)
    return both.filter(F.size("errors") == 0).drop("errors"), both.filter(F.size("errors") > 0)


def patch(rules: DataFrame, patches: DataFrame) -> DataFrame:
    """Apply patches (rule_id, user_id, ts, payload): per column the latest value set wins.

    Only the owner's patches match, a patch that sets nothing is refused, and symbol and timeframe
    are not among the columns a patch can set.
    """
    merged = patches.filter(_sets_any()).groupBy("rule_id", "user_id").agg(
        F.max("ts").alias("_at"),
        *[_latest(F.col(f"payload.{c}")).alias(f"_{c}") for c in PATCHED],
    )
    return (
        rules.join(merged, ["rule_id", "user_id"], "left")
        .withColumns({c: F.coalesce(f"_{c}", c) for c in PATCHED})
        .withColumn("updated_at", F.coalesce("_at", "updated_at"))
        .select(*rules.columns)
    )


def _flipped(times: str) -> Column:
    """is_active after that many toggles; a missing one counts as active once it is toggled."""
    flipped = F.coalesce("is_active", F.lit(True)) != (F.col(times) % 2 == 1)
    return F.when(F.col(times).isNotNull(), flipped).otherwise(F.col("is_active"))


def delete(rules: DataFrame, deletes: DataFrame) -> DataFrame:
    return rules.join(deletes.select("rule_id", "user_id"), ["rule_id", "user_id"], "left_anti")


def toggle(rules: DataFrame, toggles: DataFrame) -> DataFrame:
    """Flip is_active once per toggle of the owner; an even number leaves it as it was."""
    counted = toggles.groupBy("rule_id", "user_id").agg(
        F.count("*").alias("_n"), F.max("ts").alias("_at")
    )
    return (
        rules.join(counted, ["rule_id", "user_id"], "left")
        .withColumn("is_active", _flipped("_n"))
        .withColumn("updated_at", F.coalesce("_at", "updated_at"))
        .select(*rules.columns)
    )


def apply_changes(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """The rules after a change log, as if its changes were applied one by one in ``ts`` order.

    Written as aggregates that combine map-side instead of a fold over each rule's sorted changes, so
    one rule with most of the log is no larger than any other after the map side:

    1. times alone are found first, in buffers of fixed width that a hash aggregate holds: per rule and user the
       last delete, the first create, the latest patch of each column;
    2. a rule's owner is whoever has it in the table, else whoever created it first; changes by
       others match nothing;
    3. nothing up to the last delete survives; the first create after it starts the rule anew
       (a stored rule that was not deleted goes on, and creates of it are refused);
    4. from that start every column takes the latest value patched (if the latest value is older
       than the start, none came after it), and toggles after the latest patch of is_active flip it
       by their parity. Values are read from the rows of those times in one pass over the log.

    ``ts`` is unique within a rule; creates and patches have passed validation.
    """
    effects = _effects(changes, _lives(rules, changes))
    both = (
        rules.select(*RULE_COLUMNS)
        .join(effects.withColumnRenamed("rule_id", "_rule"), F.col("rule_id") == F.col("_rule"), "full")
        .withColumn("rule_id", F.coalesce("rule_id", "_rule"))
        .filter(F.col("_rule").isNull() | F.col("_goes_on") | F.col("_started").isNotNull())
    )
    anew = F.col("_started").isNotNull()
    fresh = {
        "user_id": F.col("_owner"), "created_at": F.col("_started"), "updated_at": F.col("_started"),
        "last_triggered_at": F.lit(None).cast("timestamp"), "trigger_count": F.lit(0),
        **{c: F.col(f"_new.{c}") for c in ("symbol", "timeframe", *PATCHED)},
    }
    return (
        both.withColumns({c: F.when(anew, new).otherwise(F.col(c)) for c, new in fresh.items()})
        .withColumns({c: F.coalesce(f"_p_{c}", c) for c in PATCHED})
        .withColumn("is_active", _flipped("_flips"))
        .withColumn("updated_at", F.coalesce("_acted", "updated_at"))
        .select(*RULE_COLUMNS)
    )


def _lives(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """Per rule that its owner has changed, when its present life starts and each column was last patched in it.

    A time is null where nothing of the kind happened in this life.
    """
    op, ts = F.col("op"), F.col("ts")
    patched = (op == "patch") & _sets_any()
    by_user = changes.groupBy("rule_id", "user_id").agg(
        F.max(F.when(op == "delete", ts)).alias("_deleted"),
        F.min(F.when(op == "create", ts)).alias("_created"),
        F.max(F.when(patched | (op == "toggle"), ts)).alias("_acted"),
        *[F.max(F.when(patched & F.col(f"payload.{c}").isNotNull(), ts)).alias(f"_at_{c}") for c in PATCHED],
    )
    first = F.min("_created").over(Window.partitionBy("rule_id"))
    saved = rules.select("rule_id", F.col("user_id").alias("_stored"))
    owned = stored(
        by_user.join(saved, "rule_id", "left").withColumn("_first", first)
        .filter(F.coalesce(F.col("user_id") == F.col("_stored"), F.col("_created") == F.col("_first")))
        .withColumn("_goes_on", F.col("_stored").isNotNull() & F.col("_deleted").isNull())
        .drop("_stored", "_first"),
        "lives",
    )
    # Only what was deleted needs another look at the creates.
    deleted = owned.filter(F.col("_deleted").isNotNull()).select("rule_id", "user_id", "_deleted")
    again = (
        changes.filter(op == "create").select("rule_id", "user_id", "ts")
        .join(deleted, ["rule_id", "user_id"]).filter(ts > F.col("_deleted"))
        .groupBy("rule_id").agg(F.min("ts").alias("_again"))
    )
    lives = owned.join(again, "rule_id", "left").withColumn(
        "_started", F.when(~F.col("_goes_on"), F.when(F.col("_deleted").isNull(), F.col("_created")).otherwise(F.col("_again")))
    )
    times = ["_acted", *[f"_at_{c}" for c in PATCHED]]
    return lives.withColumns(
        {at: F.when(F.col("_goes_on") | (F.col(at) > F.col("_started")), F.col(at)) for at in times}
    ).drop("_deleted", "_created", "_again")


def _effects(changes: DataFrame, lives: DataFrame) -> DataFrame:
    """Per rule: where its present life starts, what was patched since and how often it was toggled.

    A life has one row for each of its times, so ``max`` only picks that row's value.
    """
    op, ts = F.col("op"), F.col("ts")
    own = changes.filter((op != "patch") | _sets_any()).join(lives, ["rule_id", "user_id"])
    # Toggles count from the start of the rule or the latest patch of is_active.
    counts = F.coalesce(ts > F.greatest("_started", "_at_is_active"), F.lit(True))
    flips = F.count_if((op == "toggle") & counts)
    raw = own.groupBy("rule_id").agg(
        F.max("user_id").alias("_owner"),
        F.bool_or("_goes_on").alias("_goes_on"),
        F.max("_started").alias("_started"),
        F.max(F.when((op == "create") & (ts == F.col("_started")), F.col("payload"))).alias("_new"),
        F.max("_acted").alias("_acted"),
        F.when(flips > 0, flips).alias("_flips"),
        *[F.max(F.when((op == "patch") & (ts == F.col(f"_at_{c}")), F.col(f"payload.{c}"))).alias(f"_p_{c}") for c in PATCHED],
    )
    created = ["symbol", "timeframe", *PATCHED]
    kept = [c for c in raw.columns if c != "_new"]
    return R.with_defaults(raw.select(*kept, "_new.*")).select(*kept, F.struct(*created).alias("_new"))
