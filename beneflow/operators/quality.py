"""Quality metrics and checks as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.functions import measures as M
from beneflow.sources.tables import MONTH


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(M.rows().alias("qtd"))


def total_of_groups(groups: DataFrame, counter: str = "qtd") -> DataFrame:
    """Total row count from the group counts, without another pass over the rows."""
    return groups.agg(F.sum(counter).alias("total"))


def bronze_quality(bronze: DataFrame, source: DataFrame) -> DataFrame:
    """Per month: rows, rows in the source, NULL values and dates, and whether the counts agree."""
    written = bronze.groupBy(MONTH).agg(
        M.rows().alias("total"),
        F.count_if(F.col("vl_liquido").isNull()).alias("nulos_vl"),
        F.count_if(F.col("dt_inicio_validade").isNull()).alias("nulos_dt"),
        M.percent_where(F.col("vl_liquido").isNull()).alias("pct_nulos_vl"),
        M.percent_where(F.col("dt_inicio_validade").isNull()).alias("pct_nulos_dt"),
    )
    arrived = source.groupBy(MONTH).agg(M.rows().alias("total_origem"))
    return written.join(arrived, MONTH, "full").withColumn(
        "confere", F.col("total").eqNullSafe(F.col("total_origem"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every business column, from one pass."""
    columns = [c for c in df.columns if not c.startswith("_")]
    counts = df.agg(
        M.rows().alias("_linhas"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot(["_linhas"], columns, "coluna", "nulos").select(
        "coluna", "nulos", M.percent(F.col("nulos"), F.col("_linhas")).alias("pct")
    )


def same_town_counts(silver: DataFrame) -> DataFrame:
    """Payments made elsewhere and in the town of residence; unknown towns are in neither."""
    same = F.col("fl_mesmo_municipio")
    return silver.agg(
        F.count_if(~same).alias("pagto_diferente"), F.count_if(same).alias("pagto_mesmo")
    )


# Column of each table that has to add up to 100 within a month.
SHARES = {"fat_uf": "pct_nacional_qtd", "fat_especie": None, "fat_banco": "market_share_pct"}


def reconcile(gold: dict[str, DataFrame]) -> DataFrame:
    """Per month: shares add up to 100 (within rounding), and all tables count the same rows.

    Every table is read once.
    """
    monthly = []
    for table, share in SHARES.items():
        total_share = F.lit(None).cast("double") if share is None else F.round(F.sum(share), 2)
        monthly.append(
            gold[table]
            .groupBy(MONTH)
            .agg(F.sum("qtd_beneficios").cast("double").alias("linhas"), total_share.alias("fatia"))
            .withColumn("tabela", F.lit(table))
        )
    tables = reduce(DataFrame.unionByName, monthly)
    names = F.array(*[F.lit(table) for table in SHARES])
    expected = gold["kpis_nacionais"].select(
        MONTH, F.col("total_beneficios").cast("double").alias("total"),
        F.explode(names).alias("tabela"),
    )

    def check(name: str, lhs: Column, rhs: Column, ok: Column) -> Column:
        return F.struct(
            F.concat("tabela", F.lit(name)).alias("verificacao"), lhs.alias("lhs"),
            rhs.alias("rhs"), ok.alias("ok"),
        )

    rows, total, share = F.col("linhas"), F.col("total"), F.col("fatia")
    checks = F.array(
        check("_total", rows, total, rows.eqNullSafe(total)),
        check("_soma_pct", share, F.lit(100.0), F.abs(share - 100.0) < 1.0),
    )
    return (
        tables.join(expected, [MONTH, "tabela"], "full")
        .select(MONTH, F.inline(checks))
        .filter(~F.col("verificacao").endswith("_soma_pct") | F.col("lhs").isNotNull())
        .select("verificacao", MONTH, "lhs", "rhs", "ok")
    )
