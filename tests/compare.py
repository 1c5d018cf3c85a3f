"""Compare a registered query on Spark with its SQL on DuckDB: rows, column names, types and values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9) if math.isfinite(value) else str(value)
    return value


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    found = con.execute(sql)
    types = {d[0]: str(d[1]) for d in found.description}
    names = sorted(types)
    expected = Counter(tuple(_plain(row[list(types).index(n)]) for n in names) for row in found.fetchall())
    spark_types = dict(spark_df.dtypes)
    if sorted(spark_types) != names:
        return [f"columns {sorted(spark_types)} != {names}"]
    problems = [
        f"type of {n}: {spark_types[n]} != {types[n]}" for n in names if SAME_TYPE.get(spark_types[n]) != types[n]
    ]
    actual = Counter(tuple(_plain(v) for v in row) for row in spark_df.select(*names).collect())
    if actual != expected:
        only_spark, only_sql = actual - expected, expected - actual
        problems.append(f"{sum(actual.values())} rows, {sum(expected.values())} expected")
        problems += [f"spark: {r}" for r in list(only_spark)[:show]] + [f"sql:   {r}" for r in list(only_sql)[:show]]
    return problems
