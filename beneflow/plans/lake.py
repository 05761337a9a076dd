"""landing -> bronze -> silver -> gold for any set of monthly deliveries.

A column that a delivery has beyond the contract goes along up to silver: as a text column of its own, NULL where
it is missing, or within one VARIANT column, so that tables keep their columns whatever is delivered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beneflow.functions import fixed
from beneflow.operators.extras import pack_extras
from beneflow.operators.gold import gold_tables
from beneflow.operators.increments import add_batch, batch_states, gold_from_states, read_states
from beneflow.operators.layers import BRONZE_SCHEMA, to_bronze, to_silver
from beneflow.operators.quality import reconcile
from beneflow.session import shared_folder
from beneflow.sinks.tables import BATCH, record_run, replace_batch, replace_parts
from beneflow.sources.deliveries import REJECTED, REJECTED_LINE, read_delivery_files, read_monthly_deliveries
from beneflow.sources.tables import MONTH, read_table
from beneflow.streaming.arrivals import on_arrivals, on_new_files

GOLD_TABLES = ("fat_uf", "fat_especie", "fat_banco", "kpis_nacionais")
LANDING_SCHEMA = (
    ", ".join(f"`{header}` string" for header in fixed.LANDING_TO_BRONZE) + f", {MONTH} string"
)
QUARANTINE_SCHEMA = ", ".join(f"{name} string" for name in (*REJECTED, MONTH))


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def audit(self) -> str:
        return self.table("audit")


def _store(
    df: DataFrame, lake: Lake, table: str, months: Sequence[str], run_ts: str,
    watched: Sequence[str] = (), cluster: bool = False,
) -> int:
    written = replace_parts(df, lake.table(table), months, cluster=cluster)
    record_run(
        df.sparkSession, lake.audit, lake.table(table), table, written, run_ts, watched
    )
    return written.rows


def _require_same(table: str, rows: int, source: str, source_rows: int) -> int:
    if rows != source_rows:
        raise RuntimeError(f"{table} has {rows} rows, {source} has {source_rows}")
    return rows


def run_landing(
    spark: SparkSession, deliveries: str, months: Sequence[str], lake: Lake, run_ts: str
) -> int:
    """Delimited text -> Parquet text columns, one folder per month; all months in one job. Rows for bronze.

    Landing has a row for every line. A broken one has only its text, the reason and its file there, and is
    in ``quarantine`` too, which is made from landing, so deliveries are read once.
    """
    landed = read_monthly_deliveries(spark, deliveries, months, list(fixed.LANDING_TO_BRONZE), rejected=True)
    lines = _store(landed, lake, "landing", months, run_ts)
    rejected = read_table(spark, lake.table("landing"), months, schema=QUARANTINE_SCHEMA)
    return lines - _store(rejected.where(F.col(REJECTED_LINE).isNotNull()), lake, "quarantine", months, run_ts)


def _read_months(
    spark: SparkSession, path: str, months: Sequence[str], schema: str
) -> tuple[DataFrame, list[str]]:
    """Months of a layer under its schema and whatever text columns their files have besides, and those."""
    folders = [f"{path}/{MONTH}={month}" for month in months]
    found = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*folders)
    known = set(spark.createDataFrame([], schema).columns)
    extra = [name for name in found.columns if name not in known and name not in REJECTED]
    kinds = {f.name: "variant" if isinstance(f.dataType, T.VariantType) else "string" for f in found.schema.fields}
    named = ", ".join([*[f"`{name.replace('`', '``')}` {kinds[name]}" for name in extra], schema])
    return read_table(spark, path, months, schema=named), extra


def run_bronze(
    spark: SparkSession, months: Sequence[str], lake: Lake, run_ts: str, variant: bool = False
) -> int:
    """Typed rows; with ``variant`` whatever is beyond the contract is one column, ``_extras``."""
    landing, extra = _read_months(spark, lake.table("landing"), months, f"{LANDING_SCHEMA}, {REJECTED_LINE} string")
    landing = landing.where(F.col(REJECTED_LINE).isNull()).drop(REJECTED_LINE)
    source = F.concat(F.lit("landing/"), F.col(MONTH))
    bronze = to_bronze(landing, F.col(MONTH), source, run_ts, extra)
    if variant:
        bronze = pack_extras(bronze, extra)
    return _store(bronze, lake, "bronze", months, run_ts, ["vl_liquido", "dt_inicio_validade"])


def run_silver(spark: SparkSession, months: Sequence[str], lake: Lake, run_ts: str) -> int:
    bronze, _ = _read_months(spark, lake.table("bronze"), months, BRONZE_SCHEMA)
    return _store(to_silver(bronze, run_ts), lake, "silver", months, run_ts, ["sexo"])


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder of this run through the file system it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run_gold(
    spark: SparkSession, months: Sequence[str], lake: Lake, run_ts: str, accuracy: int | None = None
) -> None:
    """Check the four tables against each other for every month, then publish them.

    They are made in a folder of their own first, so months that do not agree leave the published tables
    as they were; what failed is kept in ``gold_failures``. Percentiles are exact unless an ``accuracy`` is given.
    """
    silver = read_table(spark, lake.table("silver"), months, schema=_silver_schema(spark, run_ts))
    _publish(spark, gold_tables(silver, run_ts, accuracy), months, lake, run_ts)


def _silver_schema(spark: SparkSession, run_ts: str) -> T.StructType:
    return to_silver(spark.createDataFrame([], BRONZE_SCHEMA), run_ts).schema


def _publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], months: Sequence[str], lake: Lake, run_ts: str
) -> None:
    staged, staging = {}, shared_folder(spark, "gold")
    for name, df in tables.items():
        df.write.parquet(f"{staging}/{name}")
        staged[name] = spark.read.schema(df.schema).parquet(f"{staging}/{name}")
    failures = reconcile(staged).where(~F.col("ok")).withColumn("run_ts", F.lit(run_ts))
    failures.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(
        lake.table("gold_failures")
    )
    failed = spark.read.schema(failures.schema).parquet(lake.table("gold_failures"))
    if broken := failed.where(F.col("run_ts") == run_ts).count():
        raise RuntimeError(f"gold tables disagree in {broken} checks; see {lake.table('gold_failures')}")
    for name, df in staged.items():
        _store(df, lake, name, months, run_ts, cluster=True)
    drop_folder(spark, staging)


def run_layers(
    spark: SparkSession, deliveries: str, months: Sequence[str], lake: Lake, run_ts: str, variant: bool = False
) -> None:
    """All layers for the given months of a deliveries folder; safe to run again."""
    landed = run_landing(spark, deliveries, months, lake, run_ts)
    bronze = _require_same("bronze", run_bronze(spark, months, lake, run_ts, variant), "landing", landed)
    _require_same("silver", run_silver(spark, months, lake, run_ts), "bronze", bronze)
    run_gold(spark, months, lake, run_ts)


def follow_deliveries(
    spark: SparkSession, deliveries: str, lake: Lake, checkpoint: str, run_ts: str
) -> None:
    """All layers for every month that got a delivery file since the last call."""
    on_arrivals(
        spark,
        deliveries,
        checkpoint,
        lambda months: run_layers(spark, deliveries, months, lake, run_ts),
    )


def add_files(
    spark: SparkSession, deliveries: str, files: Sequence[str], lake: Lake, batch: int, run_ts: str
) -> list[str]:
    """Some delivery files through all layers as one batch; gold of the months they touch. Those months.

    Earlier batches are read as states only. A batch has rows of its own in ``landing``, ``silver`` and the
    states, which a repeated run replaces, broken lines with their reason in ``landing``. The layers are kept by
    batch, so a lake is filled either this way or by whole months.
    """
    landed = read_delivery_files(spark, deliveries, files, list(fixed.LANDING_TO_BRONZE), rejected=True)
    landing = f"{lake.table('landing')}/{BATCH}={batch}"
    replace_batch(landed, lake.table("landing"), batch)
    good = spark.read.schema(landed.schema).parquet(landing).where(F.col(REJECTED_LINE).isNull())
    extra = [c for c in landed.columns if c not in (*fixed.LANDING_TO_BRONZE, *REJECTED, MONTH)]
    bronze = to_bronze(good, F.col(MONTH), F.lit(f"landing/{BATCH}={batch}"), run_ts, extra)
    rows = replace_batch(to_silver(bronze, run_ts), lake.table("silver"), batch)
    _require_same("silver", rows, "landing", good.count())
    schema = _silver_schema(spark, run_ts)
    silver = spark.read.schema(schema).parquet(f"{lake.table('silver')}/{BATCH}={batch}")
    months = add_batch(silver, lake.table("states"), batch)
    if months:
        _publish(spark, gold_from_states(lake_states(spark, lake, months), run_ts), months, lake, run_ts)
    return months


def lake_states(spark: SparkSession, lake: Lake, months: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The states of all batches of a lake, or of some of its months."""
    nothing = batch_states(spark.createDataFrame([], _silver_schema(spark, "")))
    schemas = {name: state.schema for name, state in nothing.items()}
    return read_states(spark, lake.table("states"), schemas, months)


def follow_files(
    spark: SparkSession, deliveries: str, lake: Lake, checkpoint: str, run_ts: str, files_at_a_time: int = 1000
) -> None:
    """All layers for the delivery files that arrived since the last call; a late file adds its own rows only."""
    on_new_files(
        spark,
        deliveries,
        checkpoint,
        lambda files, batch: add_files(spark, deliveries, files, lake, batch, run_ts),
        files_at_a_time=files_at_a_time,
    )
