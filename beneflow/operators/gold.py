"""The four gold tables, each one aggregation of silver by its own keys.

Sums and counts are combined on the map side, and distinct counts collapse to (keys, value) sets one
column at a time, so no grain ever holds two columns that are counted distinctly. A group with a third of
all rows reaches the shuffle as one partial row per task and distinct value. Percentiles count bands of values
first and shuffle only values of the bands that hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beneflow.functions import measures as M
from beneflow.operators.layers import add_species_group
from beneflow.operators.percentiles import join_on_keys, percentiles

UF_KEYS = ("_ano_mes", "uf", "sg_uf", "grupo_especie")
SPECIES_KEYS = ("_ano_mes", "especie_codigo", "especie_descricao", "grupo_especie")
BANK_KEYS = ("_ano_mes", "banco_codigo", "banco_nome")
MONTH_KEYS = ("_ano_mes",)

SPECIES_STATE_KEYS = (*SPECIES_KEYS, "sg_uf")
MEDIAN = {"vl_mediano": 0.5}
# Groups are months times codes of the contract: 27 states and abroad, 5 groups, about 100 species. So many are a
# century of months.
MOST_GROUPS = 500_000
NATIONAL_PERCENTILES = {"vl_mediano_nacional": 0.5, "vl_p90_nacional": 0.9}


def _total() -> Column:
    return F.sum("vl_liquido").cast("decimal(22,2)")


def _mean() -> Column:
    return M.exact_mean(F.sum("vl_liquido"), F.count("vl_liquido"))


def _uf_facts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*UF_KEYS).agg(
        M.rows().alias("qtd_beneficios"),
        _total().alias("vl_total"),
        _mean().alias("vl_medio"),
        F.min("vl_liquido").alias("vl_minimo"),
        F.max("vl_liquido").alias("vl_maximo"),
        M.percent_where(F.col("sexo") == "Feminino").alias("pct_feminino"),
        M.percent_where(F.col("sexo") == "Masculino").alias("pct_masculino"),
        M.percent_where(F.col("ramo_atividade") == "Rural").alias("pct_rural"),
        M.percent_where(F.col("fl_mesmo_municipio")).alias("pct_pagto_mesmo_municipio"),
        M.distinct_count(F.col("mun_resid_codigo")).alias("qtd_municipios_atendidos"),
        M.distinct_count(F.col("banco_codigo")).alias("qtd_bancos_utilizados"),
    )


def finish_uf(facts: DataFrame, medians: DataFrame, run_ts: str) -> DataFrame:
    """Ranks and shares of the month, on a row for a state and group."""
    count, total = F.col("qtd_beneficios"), F.col("vl_total")
    # grupo_especie_top is the group a row belongs to; the contract calls it so.
    return join_on_keys(facts, medians, UF_KEYS, "left").select(
        "uf", "sg_uf", "_ano_mes", "qtd_beneficios", "vl_total", "vl_medio", "vl_mediano",
        "vl_minimo", "vl_maximo", "pct_feminino", "pct_masculino", "pct_rural",
        "pct_pagto_mesmo_municipio", "qtd_municipios_atendidos", "qtd_bancos_utilizados",
        F.col("grupo_especie").alias("grupo_especie_top"),
        F.lit(run_ts).alias("_gold_ts"),
        M.rank_descending(count, "_ano_mes").alias("rank_qtd"),
        M.rank_descending(total, "_ano_mes").alias("rank_vl_total"),
        M.percent_of_partition(count, "_ano_mes").alias("pct_nacional_qtd"),
        M.percent_of_partition(total, "_ano_mes").alias("pct_nacional_valor"),
    )


def _species_by_state(rows: DataFrame) -> DataFrame:
    """The first of two levels: sums per species and state, then per species. States are few, so are the rows between."""
    return rows.groupBy(*SPECIES_STATE_KEYS).agg(
        M.rows().alias("n"),
        F.count("vl_liquido").alias("n_valor"),
        F.sum("vl_liquido").alias("soma"),
        F.max("vl_liquido").alias("maximo"),
        F.collect_set("uf").alias("ufs"),
        *[F.count_if(flag).alias(name) for name, flag in {
            "n_feminino": F.col("sexo") == "Feminino",
            "n_ramo_rural": F.col("ramo_atividade") == "Rural",
            "n_urbano": F.col("clientela") == "Urbano",
            "n_mesmo_municipio": F.col("fl_mesmo_municipio"),
            "n_vl_zero": F.col("fl_vl_zero"),
        }.items()],
    )


def finish_species(by_state: DataFrame, medians: DataFrame, run_ts: str) -> DataFrame:
    """The second level, with the top state, and ranks within the group."""
    percent = lambda counter: M.percent(F.sum(counter), F.sum("n"))
    facts = _with_top_state(by_state).groupBy(*SPECIES_KEYS, "uf_com_mais_beneficios").agg(
        F.sum("n").alias("qtd_beneficios"),
        F.sum("soma").cast("decimal(22,2)").alias("vl_total"),
        M.exact_mean(F.sum("soma"), F.sum("n_valor")).alias("vl_medio"),
        F.max("maximo").alias("vl_maximo"),
        percent("n_feminino").alias("pct_feminino"),
        percent("n_ramo_rural").alias("pct_rural"),
        percent("n_urbano").alias("pct_urbano"),
        percent("n_mesmo_municipio").alias("pct_mesmo_municipio"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ufs")))).cast("bigint").alias("qtd_ufs_atendidas"),
        F.sum("n_vl_zero").alias("qtd_vl_zero"),
    )
    facts = join_on_keys(facts, medians, SPECIES_KEYS, "left")
    return facts.select(
        "especie_codigo", "especie_descricao", "grupo_especie", "_ano_mes", "qtd_beneficios",
        "vl_total", "vl_medio", "vl_mediano", "vl_maximo", "pct_feminino", "pct_rural",
        "pct_urbano", "pct_mesmo_municipio", "qtd_ufs_atendidas", "uf_com_mais_beneficios",
        "qtd_vl_zero",
        F.lit(run_ts).alias("_gold_ts"),
        M.rank_descending(F.col("qtd_beneficios"), "_ano_mes", "grupo_especie")
        .alias("rank_no_grupo"),
    )


def _with_top_state(by_state: DataFrame) -> DataFrame:
    """Mark each row with the state that has most payments of its month and species.

    Ties go to the first code, NULL last; a missing species code has no top state. Works on rows
    already summed per species and state, at most a few dozen per window partition.
    """
    species = ["_ano_mes", "especie_codigo"]
    in_state = F.sum("n").over(Window.partitionBy(*species, "sg_uf"))
    best_first = [F.col("n_estado").desc(), F.col("sg_uf").asc_nulls_last()]
    best = F.first("sg_uf").over(Window.partitionBy(*species).orderBy(*best_first))
    return by_state.withColumn("n_estado", in_state).withColumn(
        "uf_com_mais_beneficios", F.when(F.col("especie_codigo").isNotNull(), best)
    )


def _bank_facts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*BANK_KEYS).agg(
        M.rows().alias("qtd_beneficios"),
        _total().alias("vl_total"),
        _mean().alias("vl_medio"),
        M.distinct_count(F.col("uf")).alias("qtd_ufs_atendidas"),
        M.distinct_count(F.col("mun_pagto_codigo")).alias("qtd_municipios_pagadores"),
        M.percent_where(F.col("meio_pag_codigo") == "CCF").alias("pct_conta_corrente"),
        M.percent_where(F.col("meio_pag_codigo") == "CMG").alias("pct_cartao"),
    )


def finish_bank(facts: DataFrame, run_ts: str) -> DataFrame:
    """Ranks and market shares of the month, on a row for a bank."""
    count, total = F.col("qtd_beneficios"), F.col("vl_total")
    return facts.select(
        "banco_codigo", "banco_nome", "_ano_mes", "qtd_beneficios", "vl_total", "vl_medio",
        "qtd_ufs_atendidas", "qtd_municipios_pagadores", "pct_conta_corrente", "pct_cartao",
        F.lit(run_ts).alias("_gold_ts"),
        M.rank_descending(count, "_ano_mes").alias("rank_qtd"),
        M.percent_of_partition(count, "_ano_mes").alias("market_share_pct"),
        M.percent_of_partition(total, "_ano_mes").alias("market_share_valor_pct"),
    )


def _month_facts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MONTH_KEYS).agg(
        M.rows().alias("total_beneficios"),
        M.distinct_count(F.col("uf")).alias("total_ufs_atendidas"),
        M.distinct_count(F.col("mun_resid_codigo")).alias("total_municipios_atendidos"),
        _total().alias("vl_total_brasil"),
        _mean().alias("vl_medio_nacional"),
        F.max("vl_liquido").alias("vl_maximo_nacional"),
        M.percent_where(F.col("sexo") == "Feminino").alias("pct_feminino"),
        M.percent_where(F.col("ramo_atividade") == "Rural").alias("pct_rural"),
        M.percent_where(F.col("fl_mesmo_municipio")).alias("pct_pagto_mesmo_municipio"),
        M.distinct_count(F.col("especie_codigo")).alias("total_especies_ativas"),
        M.distinct_count(F.col("banco_codigo")).alias("total_bancos_pagadores"),
        F.count_if("fl_vl_zero").alias("qtd_vl_zero"),
        F.count_if(F.col("sexo").isNull()).alias("qtd_sexo_nulo"),
    )


def finish_month(facts: DataFrame, national: DataFrame, run_ts: str) -> DataFrame:
    return join_on_keys(facts, national, MONTH_KEYS, "left").withColumn("_gold_ts", F.lit(run_ts))


def fat_uf(silver: DataFrame, run_ts: str, accuracy: int | None = None) -> DataFrame:
    """State x species group x month, ranked and shared within the month."""
    rows = add_species_group(silver)
    medians = percentiles(rows, UF_KEYS, "vl_liquido", MEDIAN, accuracy, MOST_GROUPS)
    return finish_uf(_uf_facts(rows), medians, run_ts)


def fat_especie(silver: DataFrame, run_ts: str, accuracy: int | None = None) -> DataFrame:
    """Species x month with its top state, ranked within the species group."""
    rows = add_species_group(silver)
    medians = percentiles(rows, SPECIES_KEYS, "vl_liquido", MEDIAN, accuracy, MOST_GROUPS)
    return finish_species(_species_by_state(rows), medians, run_ts)


def fat_banco(silver: DataFrame, run_ts: str) -> DataFrame:
    """Bank x month with market shares."""
    return finish_bank(_bank_facts(silver), run_ts)


def kpis_nacionais(silver: DataFrame, run_ts: str, accuracy: int | None = None) -> DataFrame:
    """One row per month."""
    national = percentiles(silver, MONTH_KEYS, "vl_liquido", NATIONAL_PERCENTILES, accuracy, MOST_GROUPS)
    return finish_month(_month_facts(silver), national, run_ts)


def gold_tables(silver: DataFrame, run_ts: str, accuracy: int | None = None) -> dict[str, DataFrame]:
    """All four tables of a stored silver table; percentiles exact, or sketches of the given accuracy."""
    return {
        "fat_uf": fat_uf(silver, run_ts, accuracy),
        "fat_especie": fat_especie(silver, run_ts, accuracy),
        "fat_banco": fat_banco(silver, run_ts),
        "kpis_nacionais": kpis_nacionais(silver, run_ts, accuracy),
    }
