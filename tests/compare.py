"""Compare a Spark result with the SQL counterpart run by DuckDB on the same files."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value
    if isinstance(value, (int, bool)) or value is None:
        return float(value) if isinstance(value, int) and not isinstance(value, bool) else value
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, sql: str, sf_dir: str) -> str | None:
    """None when both agree exactly, else what differs first."""
    names, left = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    columns, rows = oracle_rows(sql, sf_dir)
    others, right = canonical(columns, rows)
    if names != others:
        return f"columns {names} against {others}"
    if left == right:
        return None
    extra = [r for r in left if r not in set(right)]
    missing = [r for r in right if r not in set(left)]
    return (
        f"{names}: rows {len(left)} against {len(right)}; {len(extra)} only in Spark, {len(missing)} only in SQL; "
        f"first {extra[:1]} against {missing[:1]}"
    )
