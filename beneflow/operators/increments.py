"""Gold from states that add up, so a late delivery costs its own rows.

Every delivery (a batch) leaves four small states: sums by the cells all gold tables roll up from, the towns of
its groups as bitmaps, and how often each value occurs. Gold of a month is finished from the states of all its
batches; silver is not read again. A batch that is run twice replaces its own states, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beneflow.functions import measures as M
from beneflow.operators import gold
from beneflow.operators.layers import add_species_group
from beneflow.operators.percentiles import join_on_keys, percentiles_of_counts, value_counts
from beneflow.operators.states import distinct_rollup, distinct_state
from beneflow.sinks.tables import BATCH, replace_batch
from beneflow.sources.tables import MONTH

# Codes of the contract: a month has some ten thousand cells, however many payments it has.
VALUE_KEYS = ("_ano_mes", "uf", "sg_uf", "especie_codigo", "especie_descricao", "grupo_especie")
CELL_KEYS = (*VALUE_KEYS, "banco_codigo", "banco_nome")


def _counted() -> dict[str, Column]:
    return {
        "n_feminino": F.col("sexo") == "Feminino",
        "n_masculino": F.col("sexo") == "Masculino",
        "n_sexo_nulo": F.col("sexo").isNull(),
        "n_ramo_rural": F.col("ramo_atividade") == "Rural",
        "n_urbano": F.col("clientela") == "Urbano",
        "n_mesmo_municipio": F.col("fl_mesmo_municipio"),
        "n_vl_zero": F.col("fl_vl_zero"),
        "n_conta_corrente": F.col("meio_pag_codigo") == "CCF",
        "n_cartao": F.col("meio_pag_codigo") == "CMG",
    }


def batch_states(silver: DataFrame) -> dict[str, DataFrame]:
    """The states of some rows; those of several batches together are the states of all their rows."""
    rows = add_species_group(silver)
    return {
        "celulas": rows.groupBy(*CELL_KEYS).agg(
            M.rows().alias("n"), F.count("vl_liquido").alias("n_valor"), F.sum("vl_liquido").alias("soma"),
            F.min("vl_liquido").alias("minimo"), F.max("vl_liquido").alias("maximo"),
            *[F.count_if(holds).alias(name) for name, holds in _counted().items()],
        ),
        "municipios_resid": distinct_state(rows, gold.UF_KEYS, ["mun_resid_codigo"]),
        "municipios_pagto": distinct_state(rows, gold.BANK_KEYS, ["mun_pagto_codigo"]),
        "valores": value_counts(rows.where(F.col("vl_liquido").isNotNull()), VALUE_KEYS, "vl_liquido"),
    }


def add_batch(silver: DataFrame, root: str, batch: int) -> list[str]:
    """Store the states of a batch in place of an earlier attempt's; the months it has rows of."""
    states = batch_states(silver)
    for name, state in states.items():
        replace_batch(state, f"{root}/{name}", batch)
    own = read_states(silver.sparkSession, root, {name: state.schema for name, state in states.items()})
    touched = own["celulas"].where(F.col(BATCH) == batch).select(MONTH).distinct()
    return sorted(row[0] for row in touched.collect())


def read_states(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType], months: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The states of all batches, or of some months of them. ``schemas`` are those ``batch_states`` gives."""
    found = {}
    for name, schema in schemas.items():
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        df = spark.read.schema(whole).parquet(f"{root}/{name}")
        found[name] = df if months is None else df.where(F.col(MONTH).isin(*months))
    return found


def _total() -> Column:
    return F.sum("soma").cast("decimal(22,2)")


def _mean() -> Column:
    return M.exact_mean(F.sum("soma"), F.sum("n_valor"))


def _share(counter: str) -> Column:
    return M.percent(F.sum(counter), F.sum("n"))


def _with_towns(facts: DataFrame, state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    towns = distinct_rollup(state, keys).select(*keys, F.col("distintos").alias(name))
    return join_on_keys(facts, towns, keys, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def gold_from_states(states: Mapping[str, DataFrame], run_ts: str) -> dict[str, DataFrame]:
    """The four gold tables, the same as ``gold.gold_tables`` makes of all rows with exact percentiles."""
    cells, values = states["celulas"], states["valores"]

    def quantiles(keys: Sequence[str], wanted: Mapping[str, float]) -> DataFrame:
        return percentiles_of_counts(values, keys, "vl_liquido", wanted)

    by_uf = cells.groupBy(*gold.UF_KEYS).agg(
        F.sum("n").alias("qtd_beneficios"), _total().alias("vl_total"), _mean().alias("vl_medio"),
        F.min("minimo").alias("vl_minimo"), F.max("maximo").alias("vl_maximo"),
        _share("n_feminino").alias("pct_feminino"), _share("n_masculino").alias("pct_masculino"),
        _share("n_ramo_rural").alias("pct_rural"), _share("n_mesmo_municipio").alias("pct_pagto_mesmo_municipio"),
        M.distinct_count(F.col("banco_codigo")).alias("qtd_bancos_utilizados"),
    )
    by_uf = _with_towns(by_uf, states["municipios_resid"], gold.UF_KEYS, "qtd_municipios_atendidos")

    counters = ("n", "n_valor", "soma", "n_feminino", "n_ramo_rural", "n_urbano", "n_mesmo_municipio", "n_vl_zero")
    by_species = cells.groupBy(*gold.SPECIES_STATE_KEYS).agg(
        *[F.sum(c).alias(c) for c in counters], F.max("maximo").alias("maximo"), F.collect_set("uf").alias("ufs")
    )

    by_bank = cells.groupBy(*gold.BANK_KEYS).agg(
        F.sum("n").alias("qtd_beneficios"), _total().alias("vl_total"), _mean().alias("vl_medio"),
        M.distinct_count(F.col("uf")).alias("qtd_ufs_atendidas"),
        _share("n_conta_corrente").alias("pct_conta_corrente"), _share("n_cartao").alias("pct_cartao"),
    )
    by_bank = _with_towns(by_bank, states["municipios_pagto"], gold.BANK_KEYS, "qtd_municipios_pagadores")

    by_month = cells.groupBy(*gold.MONTH_KEYS).agg(
        F.sum("n").alias("total_beneficios"),
        *[M.distinct_count(F.col(c)).alias(name) for name, c in {
            "total_ufs_atendidas": "uf", "total_especies_ativas": "especie_codigo", "total_bancos_pagadores": "banco_codigo",
        }.items()],
        _total().alias("vl_total_brasil"), _mean().alias("vl_medio_nacional"), F.max("maximo").alias("vl_maximo_nacional"),
        _share("n_feminino").alias("pct_feminino"), _share("n_ramo_rural").alias("pct_rural"),
        _share("n_mesmo_municipio").alias("pct_pagto_mesmo_municipio"),
        F.sum("n_vl_zero").alias("qtd_vl_zero"), F.sum("n_sexo_nulo").alias("qtd_sexo_nulo"),
    )
    by_month = _with_towns(by_month, states["municipios_resid"], gold.MONTH_KEYS, "total_municipios_atendidos")

    return {
        "fat_uf": gold.finish_uf(by_uf, quantiles(gold.UF_KEYS, gold.MEDIAN), run_ts),
        "fat_especie": gold.finish_species(by_species, quantiles(gold.SPECIES_KEYS, gold.MEDIAN), run_ts),
        "fat_banco": gold.finish_bank(by_bank, run_ts),
        "kpis_nacionais": gold.finish_month(by_month, quantiles(gold.MONTH_KEYS, gold.NATIONAL_PERCENTILES), run_ts),
    }
