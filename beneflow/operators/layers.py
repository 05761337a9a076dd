"""Bronze and silver: one narrow projection each, one output row per input row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.functions import fixed, parsing

BRONZE_SCHEMA = (
    ", ".join(
        f"{column} "
        + {"vl_liquido": "decimal(12,2)", "dt_inicio_validade": "date"}.get(column, "string")
        for column in fixed.LANDING_TO_BRONZE.values()
    )
    + ", _source_path string, _ingestion_ts string, _ano_mes string"
)


def _literal(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def to_bronze(
    landing: DataFrame, month: str | Column, source: str | Column, run_ts: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Rename, type money and date, stamp lineage: 14 -> 17 columns, nothing dropped.

    Columns beyond the contract that are named in ``extra`` follow as the text they are.
    """
    parsers = {"vl_liquido": parsing.money, "dt_inicio_validade": parsing.day}
    business = []
    for header, column in fixed.LANDING_TO_BRONZE.items():
        parse = parsers.get(column, lambda text: text)
        business.append(parse(parsing.named(header)).alias(column))
    return landing.select(
        *business,
        _literal(month).alias("_ano_mes"),
        _literal(source).alias("_source_path"),
        F.lit(run_ts).alias("_ingestion_ts"),
        *[parsing.named(name).alias(name) for name in extra],
    )


def clean(df: DataFrame) -> DataFrame:
    """Trim every business text column and null the "no information" markers."""
    return df.select([parsing.clean_text(field) for field in df.schema.fields])


def replace_column(df: DataFrame, column: str, parts: Mapping[str, Column]) -> DataFrame:
    """Put several derived columns in the place of one."""
    return df.withColumns(dict(parts)).drop(column)


def parse_bank(df: DataFrame) -> DataFrame:
    return replace_column(df, "banco", parsing.bank(F.col("banco")))


def parse_municipality(df: DataFrame, column: str) -> DataFrame:
    return replace_column(df, column, parsing.municipality(F.col(column), column))


def parse_payment(df: DataFrame) -> DataFrame:
    return replace_column(df, "meio_pagamento", parsing.payment_means(F.col("meio_pagamento")))


def add_state_code(df: DataFrame) -> DataFrame:
    return df.withColumn("sg_uf", parsing.state_code(F.col("uf")))


def add_state_code_by_join(df: DataFrame) -> DataFrame:
    """Same as ``add_state_code`` through a dimension join.

    The dimension is the fixed list of 27 states, so the broadcast does not grow with data.
    """
    states = df.sparkSession.createDataFrame(
        list(fixed.STATE_CODES.items()), "uf string, sg_uf string"
    )
    return df.join(F.broadcast(states), "uf", "left")


def add_time(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ano_inicio": F.year("dt_inicio_validade"),
            "mes_inicio": F.month("dt_inicio_validade"),
        }
    )


def add_flags(df: DataFrame) -> DataFrame:
    """``fl_vl_zero`` is never NULL; ``fl_mesmo_municipio`` is NULL when a code is missing."""
    return df.withColumns(
        {
            "fl_vl_zero": F.coalesce(F.col("vl_liquido") <= 0, F.lit(False)),
            "fl_mesmo_municipio": F.col("mun_pagto_codigo") == F.col("mun_resid_codigo"),
        }
    )


def to_silver(bronze: DataFrame, run_ts: str) -> DataFrame:
    """Clean, parse and flag: 17 -> 29 columns, one row out per row in."""
    df = parse_bank(clean(bronze))
    for town in ("mun_pagto", "mun_resid"):
        df = parse_municipality(df, town)
    df = add_state_code(df).withColumn("especie_codigo", F.col("especie_codigo").try_cast("int"))
    return add_flags(add_time(parse_payment(df))).withColumn("_silver_ts", F.lit(run_ts))


def add_species_group(df: DataFrame, name: str = "grupo_especie") -> DataFrame:
    return df.withColumn(name, parsing.species_group("especie_codigo"))
