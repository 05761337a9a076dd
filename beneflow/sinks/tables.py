"""Writing partitioned Parquet tables so that a re-run replaces and never duplicates."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from beneflow.sources.tables import MONTH, read_table

AUDIT_SCHEMA = (
    "operacao string, linhas bigint, nulos bigint, tabela string, run_ts string, _ano_mes string"
)


# The delivery a row came with, where a table keeps deliveries apart.
BATCH = "_lote"


@dataclass(frozen=True)
class Written:
    """What one write put into a table."""

    rows: int
    parts: list[str]


def replace_parts(
    df: DataFrame,
    path: str,
    parts: Sequence[str] | None = None,
    key: str = MONTH,
    cluster: bool = False,
) -> Written:
    """Replace partitions of a table with the rows of ``df``; other partitions are untouched.

    With stated ``parts`` exactly those are replaced: a row of any other partition fails the job
    before anything is committed, and a stated partition without new rows ends up empty. Without
    them, the partitions ``df`` has rows of are replaced.

    Dynamic overwrite stages the files and swaps them at job commit, so lost executors cost a
    task retry, not the old partition. Rows are written as they come, without a shuffle. Only when
    most tasks hold rows of many parts, ``cluster`` rebalances them by key first: a large part is
    split over many files, small ones share a task. A table has one writer at a time and is never
    replaced by a query reading it.
    """
    if parts is not None:
        outside = F.concat(F.lit(f"{key} outside {', '.join(parts)}: "), F.coalesce(key, F.lit("NULL")))
        refuse = F.raise_error(outside).cast("string")
        df = df.withColumn(key, F.when(F.col(key).isin(*parts), F.col(key)).otherwise(refuse))
    if cluster:
        df = df.hint("rebalance", key)
    written = Observation()
    # One value per partition written: the driver lists those at commit anyway.
    observed = df.observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(key).alias("parts")
    )
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    metrics = written.get
    for part in set(parts or ()) - set(metrics["parts"]):
        _empty_part(df, path, key, part)
    return Written(metrics["rows"], sorted(metrics["parts"] if parts is None else parts))


def _empty_part(df: DataFrame, path: str, key: str, part: str) -> None:
    # A second commit; a run that is lost before it is repeated as a whole.
    nothing = df.sparkSession.createDataFrame([], df.schema).drop(key)
    nothing.write.mode("overwrite").parquet(f"{path}/{key}={part}")


def replace_batch(df: DataFrame, path: str, batch: int, key: str = MONTH) -> int:
    """Write a delivery as the partition ``_lote=batch`` of a table, whole, in place of an earlier attempt; its rows."""
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(key)
        .parquet(f"{path}/{BATCH}={batch}")
    )
    return written.get["rows"]


def part_metrics(
    df: DataFrame, watched: Sequence[str] = (), key: str = MONTH
) -> DataFrame:
    """Rows, and NULLs in the watched columns, per partition; reads no other column."""
    nulls = [F.count_if(F.col(column).isNull()) for column in watched]
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("linhas"), sum(nulls, F.lit(0)).cast("bigint").alias("nulos")
    )


def record_run(
    spark: SparkSession,
    audit_path: str,
    table_path: str,
    table: str,
    written: Written,
    run_ts: str,
    watched: Sequence[str] = (),
) -> None:
    """Record one audit row per part just written; fail before that when the table does not hold those rows.

    The rows of a table, run and part are replaced, so a run that is repeated is recorded once. Counts
    come from the table as it is now: its footers and the watched columns, no other column is read.
    """
    metrics = part_metrics(read_table(spark, table_path, written.parts), watched)
    # One row per part.
    found = metrics.select("linhas", "nulos", MONTH).collect()
    if (total := sum(row.linhas for row in found)) != written.rows:
        raise RuntimeError(f"{table}: {total} rows in {', '.join(written.parts)}, {written.rows} expected")
    rows = spark.createDataFrame(found, f"linhas bigint, nulos bigint, {MONTH} string").select(
        F.lit("replace").alias("operacao"), "linhas", "nulos",
        F.lit(table).alias("tabela"), F.lit(run_ts).alias("run_ts"), MONTH,
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tabela", "run_ts", MONTH)
        .parquet(audit_path)
    )


def run_history(spark: SparkSession, audit_path: str, table: str, n: int) -> DataFrame:
    """Latest ``n`` runs of a table: version, time, operation, months, rows."""
    runs = (
        spark.read.schema(AUDIT_SCHEMA)
        .parquet(audit_path)
        .filter(F.col("tabela") == table)
        .groupBy("run_ts", "operacao")
        .agg(
            F.min(MONTH).alias("primeiro_mes"),
            F.max(MONTH).alias("ultimo_mes"),
            F.sum("linhas").alias("linhas"),
            F.sum("nulos").alias("nulos"),
        )
    )
    return runs.orderBy(F.col("run_ts").desc(), "operacao").limit(n)


def register_table(spark: SparkSession, name: str, path: str, schema: str, key: str = MONTH) -> None:
    """Give an existing partitioned folder a SQL name; its data stays where it is.

    A name that stands for another folder or other columns is given anew, and partitions that are gone
    are forgotten. A table that owns its data is never replaced.
    """
    location = path.replace("'", "\\'")
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not a table over a folder")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet PARTITIONED BY ({key}) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)


def bounded_query(
    spark: SparkSession, sql: str, order: Sequence[str], rows: int, args: Mapping[str, object] | None = None
) -> DataFrame:
    """At most ``rows`` rows of a query in a stated total order (a top-k plan).

    ``args`` are values for the query's named markers (``:name``); they never become part of its text.
    """
    return spark.sql(sql, args=dict(args or {})).orderBy(*order).limit(rows)


def page_after(df: DataFrame, order: Sequence[str], last: Mapping[str, object] | None, rows: int) -> DataFrame:
    """The next ``rows`` rows of a total order (ascending, NULL first) behind the row ``last``; the first ones for None.

    A page is found by its keys, not by counting rows before it: it costs the same wherever it is, and rows
    that come or go before it do not move it.
    """
    if last is not None:
        behind = F.lit(False)
        for i, column in enumerate(order):
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(last[c])) for c in order[:i]], F.lit(True))
            value = last[column]
            greater = F.col(column).isNotNull() if value is None else F.col(column) > F.lit(value)
            behind |= same & F.coalesce(greater, F.lit(False))
        df = df.where(behind)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(rows)


def pages(df: DataFrame, order: Sequence[str], rows: int) -> Iterator[list[Row]]:
    """All pages one after the other, each fetched by a query of its own."""
    last = None
    while page := page_after(df, order, last, rows).collect():
        yield page
        if len(page) < rows:
            return
        last = page[-1].asDict()
