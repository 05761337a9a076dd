import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from beneflow.operators import gold
from beneflow.operators.percentiles import percentiles, percentiles_of_counts, value_counts
from beneflow.operators.ranking import species_with_top_state, top_state_per_species
from beneflow.plans import lake as layer_chain
from beneflow.operators.quality import reconcile
from beneflow.session import shared_folder
from beneflow.sinks.tables import replace_parts
from beneflow.sources.tables import read_table
from test_plan_shapes import shuffled

TS = "2026-02-01T00:00:00Z"
COLUMNS = {
    "fat_uf": "uf sg_uf _ano_mes qtd_beneficios vl_total vl_medio vl_mediano vl_minimo vl_maximo "
    "pct_feminino pct_masculino pct_rural pct_pagto_mesmo_municipio qtd_municipios_atendidos "
    "qtd_bancos_utilizados grupo_especie_top _gold_ts rank_qtd rank_vl_total pct_nacional_qtd "
    "pct_nacional_valor",
    "fat_especie": "especie_codigo especie_descricao grupo_especie _ano_mes qtd_beneficios vl_total "
    "vl_medio vl_mediano vl_maximo pct_feminino pct_rural pct_urbano pct_mesmo_municipio "
    "qtd_ufs_atendidas uf_com_mais_beneficios qtd_vl_zero _gold_ts rank_no_grupo",
    "fat_banco": "banco_codigo banco_nome _ano_mes qtd_beneficios vl_total vl_medio "
    "qtd_ufs_atendidas qtd_municipios_pagadores pct_conta_corrente pct_cartao _gold_ts rank_qtd "
    "market_share_pct market_share_valor_pct",
    "kpis_nacionais": "_ano_mes total_beneficios total_ufs_atendidas total_municipios_atendidos "
    "vl_total_brasil vl_medio_nacional vl_maximo_nacional pct_feminino pct_rural "
    "pct_pagto_mesmo_municipio total_especies_ativas total_bancos_pagadores qtd_vl_zero "
    "qtd_sexo_nulo vl_mediano_nacional vl_p90_nacional _gold_ts",
}


@pytest.fixture(scope="module")
def tables(silver):
    """Each table on its own, straight from silver."""
    return {
        "fat_uf": gold.fat_uf(silver, TS),
        "fat_especie": gold.fat_especie(silver, TS),
        "fat_banco": gold.fat_banco(silver, TS),
        "kpis_nacionais": gold.kpis_nacionais(silver, TS),
    }


@pytest.fixture(scope="module")
def shared(silver):
    """All tables as the layer chain makes them."""
    return gold.gold_tables(silver, TS)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(tables, name):
    assert tables[name].columns == COLUMNS[name].split()
    if "vl_medio" in tables[name].columns:
        types = dict(tables[name].dtypes)
        assert (types["vl_total"], types["vl_medio"]) == ("decimal(22,2)", "decimal(16,6)")


@pytest.mark.parametrize("name", COLUMNS)
def test_shared_inputs_give_the_same_tables(tables, shared, name):
    alone, together = tables[name].collect(), shared[name].collect()
    assert sorted(map(str, alone)) == sorted(map(str, together))
    assert alone


def test_accuracy_reaches_every_percentile(silver):
    exact, sketched = (gold.gold_tables(silver, TS, accuracy) for accuracy in (None, 5))
    plans = {name: df._jdf.queryExecution().toString() for name, df in sketched.items()}
    assert [name for name, plan in plans.items() if "percentile_approx" in plan] == ["fat_uf", "fat_especie", "kpis_nacionais"]
    assert all("percentile_approx" not in df._jdf.queryExecution().toString() for df in exact.values())


def test_no_table_keeps_two_distinct_columns_in_one_grain(silver):
    """Sums read silver once, percentiles twice; of values, hardly any are shuffled."""
    for df in gold.gold_tables(silver, TS).values():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") <= 3
    more = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")
    wide = silver.select("*", more).withColumn("vl_liquido", (F.col("vl_liquido") + F.col("i")).cast("decimal(12,2)"))
    df = gold.kpis_nacionais(wide.drop("i"), TS)
    df.collect()
    values = [n for by, n in shuffled(df) if "units" in by]
    assert values and sum(values) < 0.1 * wide.count()


def test_disagreeing_months_are_not_published(spark, silver, monkeypatch):
    lake = layer_chain.Lake(shared_folder(spark, "unpublished"))
    replace_parts(silver, lake.table("silver"), cluster=True)
    months = ["199803", "199804"]
    layer_chain.run_gold(spark, months, lake, "run1")

    def rows_of(name):
        return sorted(map(str, read_table(spark, lake.table(name)).collect()))

    before = {name: rows_of(name) for name in layer_chain.GOLD_TABLES}
    make = layer_chain.gold_tables

    def short(rows, *args):
        return make(rows, *args) | {"fat_banco": gold.fat_banco(rows.filter("banco_codigo != 100"), TS)}

    monkeypatch.setattr(layer_chain, "gold_tables", short)
    with pytest.raises(RuntimeError, match="disagree in 2 checks"):
        layer_chain.run_gold(spark, months, lake, "run2")
    assert {name: rows_of(name) for name in layer_chain.GOLD_TABLES} == before
    failures = spark.read.parquet(lake.table("gold_failures")).collect()
    assert {(r["run_ts"], r["verificacao"], r["_ano_mes"]) for r in failures} == {
        ("run2", "fat_banco_total", month) for month in months
    }


def test_tables_agree(shared):
    checks = reconcile(shared).collect()
    assert len(checks) == 5 * 80
    assert all(row["ok"] for row in checks)


def test_a_lost_row_is_noticed(silver, shared):
    short = dict(shared, fat_banco=gold.fat_banco(silver.filter("banco_codigo != 100"), TS))
    broken = reconcile(short).filter("not ok").select("verificacao").distinct().collect()
    assert [row[0] for row in broken] == ["fat_banco_total"]


def brute_percentile(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(Decimal(str(p)) * len(ordered))) - 1]


def test_exact_percentiles_against_brute_force(spark):
    """Hot group, NULL group, negative values, values far apart, groups without any value."""
    rng = random.Random(7)
    rows = [("hot", Decimal(rng.choice([162100, 162100, rng.randrange(10**9)])) / 100)
            for _ in range(4000)]
    rows += [(None, Decimal(rng.randrange(-(10**5), 10**11)) / 100) for _ in range(500)]
    rows += [(f"g{i % 40}", Decimal(rng.randrange(10**7)) / 100) for i in range(1500)]
    rows += [("one", Decimal("-0.01")), ("empty", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v decimal(12,2)").repartition(7)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}

    groups = defaultdict(list)
    for key, value in rows:
        if value is not None:
            groups[key].append(value)
    expected = {
        key: tuple(brute_percentile(values, p) for p in wanted.values())
        for key, values in groups.items()
    }
    direct = percentiles(df, ["k"], "v", wanted)
    counted = percentiles_of_counts(value_counts(df, ["k"], "v"), ["k"], "v", wanted)
    for result in (direct, counted):
        assert {r["k"]: tuple(r[n] for n in wanted) for r in result.collect()} == expected
        assert dict(result.dtypes)["p50"] == "decimal(12,2)"


def test_counts_at_a_finer_grain_give_the_same_percentiles(silver):
    counts = value_counts(silver, ["_ano_mes", "uf"], "vl_liquido")
    coarse = percentiles_of_counts(counts, ["_ano_mes"], "vl_liquido", {"m": 0.5})
    direct = percentiles(silver, ["_ano_mes"], "vl_liquido", {"m": 0.5})
    assert sorted(map(str, coarse.collect())) == sorted(map(str, direct.collect()))


def test_percentile_needs_a_small_decimal(spark):
    with pytest.raises(TypeError):
        percentiles(spark.createDataFrame([(1.0,)], "v double"), [], "v", {"m": 0.5})


def test_sketch_is_close(silver):
    exact = gold.kpis_nacionais(silver, TS).select("_ano_mes", "vl_mediano_nacional")
    sketch = gold.kpis_nacionais(silver, TS, accuracy=100).select(
        "_ano_mes", F.col("vl_mediano_nacional").alias("aprox")
    )
    both = exact.join(sketch, "_ano_mes").collect()
    assert len(both) == 80
    assert all(abs(r["aprox"] - r["vl_mediano_nacional"]) < 15000 for r in both)


def test_top_state_ties_and_missing_codes(spark):
    rows = [("1", 41, "SP", 2), ("1", 41, "AC", 2), ("1", 41, None, 2), ("1", 42, None, 3),
            ("1", 42, "SP", 1), ("1", None, "SP", 9), ("2", 41, "SP", 1)]
    counts = spark.createDataFrame(
        rows, "_ano_mes string, especie_codigo int, sg_uf string, n long"
    )
    top = {(r[0], r[1]): r[2] for r in top_state_per_species(counts).collect()}
    assert top == {("1", 41): "AC", ("1", 42): None, ("1", None): "SP", ("2", 41): "SP"}
    joined = {(r[0], r[1]): (r[2], r[3]) for r in species_with_top_state(counts).collect()}
    assert joined == {("1", 41): (6, "AC"), ("1", 42): (4, None), ("1", None): (9, None),
                      ("2", 41): (1, "SP")}


def test_species_with_several_descriptions_share_their_top_state(silver):
    relabelled = silver.withColumn(
        "especie_descricao", F.concat("especie_descricao", F.lit(" "), F.col("sexo"))
    )
    rows = gold.fat_especie(relabelled, TS).filter("especie_codigo is not null")
    tops = rows.groupBy("_ano_mes", "especie_codigo").agg(
        F.count_distinct(F.coalesce("uf_com_mais_beneficios", F.lit("-"))).alias("n")
    )
    assert tops.filter("n > 1").count() == 0


def test_one_month_with_only_zero_values(spark, silver):
    zero = silver.withColumn("vl_liquido", F.lit(0).cast("decimal(12,2)")).limit(5)
    rows = gold.fat_banco(zero, TS).collect()
    assert rows and all(r["market_share_valor_pct"] is None for r in rows)


def test_a_month_missing_from_a_table_is_noticed(shared):
    short = dict(shared, fat_uf=shared["fat_uf"].filter("_ano_mes != '199803'"))
    broken = reconcile(short).filter("not ok").collect()
    assert [(r["verificacao"], r["_ano_mes"], r["lhs"]) for r in broken] == [
        ("fat_uf_total", "199803", None)
    ]
