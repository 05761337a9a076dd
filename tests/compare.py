"""Run registered queries against their SQL counterparts.

``python tests/compare.py <folder> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when both sides hold the same rows under the same names."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "BOOLEAN": "boolean"}
    expected_types = {c[0]: kinds.get(str(c[1]), str(c[1])) for c in result.description}
    if (types := dict(df.dtypes)) != expected_types:
        wrong = {n: (t, expected_types[n]) for n, t in types.items() if t != expected_types[n]}
        return f"types {wrong}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    missing, extra = list((expected - actual).elements()), list((actual - expected).elements())
    return (f"{sum(actual.values())} rows, {sum(expected.values())} expected; "
            f"{len(missing)} missing {missing[:2]}, {len(extra)} extra {extra[:2]}")


def main(folder: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    # A plain session: results must not depend on the library's own settings.
    spark = (
        SparkSession.builder.appName("compare")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, failed = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracle:
                problem = difference(df, connection, oracle[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.time() - start:6.1f}s "
              f"{problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
