import random

from pyspark.sql import functions as F

from candlewright.operators import cooldown as K


def sequential(times, wait):
    out, last = [], None
    for t in sorted(times):
        if last is None or t - last >= wait:
            out.append(t)
            last = t
    return out


def test_chunks_chain_to_the_sequential_result(spark, monkeypatch):
    # Chunks of eight candles: a cooldown spans several, some chunks are empty, a hot rule has most rows.
    monkeypatch.setattr(K, "CHUNK_CANDLES", 8)
    monkeypatch.setattr(K, "CHUNK_COOLDOWNS", 0)
    rng = random.Random(11)
    times = {
        ("hot", 300): list(range(0, 60 * 2000, 60)),
        ("long", 86400): sorted(rng.sample(range(0, 60 * 5000, 60), 900)),
        ("gaps", 3600): [*range(0, 6000, 60), *range(500000, 512000, 60), 900000],
        ("once", 60): [120],
        ("short", 60): list(range(60, 6000, 60)),
    }
    rows = [(rule, "1m", wait, t) for (rule, wait), ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "rule_id string, timeframe string, cooldown_seconds int, t bigint").withColumn(
        "triggered_at", F.timestamp_seconds("t")
    )
    got = K.cooldown(df).select("rule_id", "t").collect()
    for (rule, wait), ts in times.items():
        assert sorted(r.t for r in got if r.rule_id == rule) == sequential(ts, wait), rule


def test_rules_alike_in_conditions_and_cooldown_fire_once_a_set(spark, sf_dir, tmp_path, monkeypatch):
    # Customers repeated by a shift that keeps all a rule is made of, so that many rules are alike.
    from pyspark.sql.readwriter import DataFrameWriter

    from candlewright.plans import queries as Q

    shift = F.explode(F.sequence(F.lit(0), F.lit(19 * 63000), F.lit(63000)))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("_shift", shift)
    customers = customers.withColumn("c_custkey", F.col("c_custkey") + F.col("_shift")).drop("_shift")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(f"{tmp_path}/events.parquet")
    hits = Q.triggered(spark, str(tmp_path)).select("rule_id", "cooldown_seconds", F.unix_seconds("triggered_row.open_time").alias("t")).collect()
    by_rule = {}
    for r in hits:
        by_rule.setdefault((r.rule_id, r.cooldown_seconds), []).append(r.t)
    want = sorted((rule, t) for (rule, wait), times in by_rule.items() for t in sequential(times, wait))
    counted = []
    write = DataFrameWriter.parquet

    def counting(writer, path, *args, **named):
        write(writer, path, *args, **named)
        if "/triggers-" in path:
            counted.append(spark.read.parquet(path).count())

    monkeypatch.setattr(DataFrameWriter, "parquet", counting)
    for name in ("cooldown", "stream_cooldown"):
        got = Q.QUERIES[name](spark, str(tmp_path)).select("rule_id", F.unix_seconds(F.col("triggered_at").cast("timestamp"))).collect()
        assert sorted(map(tuple, got)) == want, name
    assert len(counted) == 2 and max(counted) * 10 < len(hits)
