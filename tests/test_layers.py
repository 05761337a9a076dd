from decimal import Decimal

from pyspark.sql import functions as F

from beneflow.functions import fixed
from beneflow.operators import layers
from beneflow.plans import queries


def test_bronze_columns_in_order(spark, folder):
    df = queries.bronze(spark, folder)
    assert df.columns == [
        *fixed.LANDING_TO_BRONZE.values(), "_ano_mes", "_source_path", "_ingestion_ts"
    ]
    assert len(df.columns) == 17
    types = dict(df.dtypes)
    assert types.pop("vl_liquido") == "decimal(12,2)"
    assert types.pop("dt_inicio_validade") == "date"
    assert set(types.values()) == {"string"}


def test_silver_columns(silver):
    assert set(silver.columns) == {
        "despacho", "sexo", "clientela", "tipo_beneficio", "uf", "vl_liquido", "ramo_atividade",
        "dt_inicio_validade", "especie_codigo", "especie_descricao", "_ano_mes", "_source_path",
        "_ingestion_ts", "banco_codigo", "banco_nome", "mun_pagto_codigo", "mun_pagto_sg_uf",
        "mun_pagto_nome", "mun_resid_codigo", "mun_resid_sg_uf", "mun_resid_nome", "sg_uf",
        "meio_pag_codigo", "meio_pag_descricao", "ano_inicio", "mes_inicio", "fl_vl_zero",
        "fl_mesmo_municipio", "_silver_ts",
    }
    types = dict(silver.dtypes)
    assert types["banco_codigo"] == types["especie_codigo"] == types["ano_inicio"] == "int"
    assert types["mun_pagto_codigo"] == "string"
    assert types["fl_vl_zero"] == types["fl_mesmo_municipio"] == "boolean"


def test_silver_facts(silver):
    def nulls(column):
        return F.count_if(F.col(column).isNull())

    facts = silver.agg(
        F.count("*"), nulls("sexo"), nulls("clientela"), nulls("despacho"),
        nulls("ramo_atividade"), nulls("vl_liquido"), nulls("dt_inicio_validade"),
        nulls("banco_codigo"), nulls("especie_codigo"), F.count_if("fl_vl_zero"),
        F.count_if("fl_mesmo_municipio"), nulls("sg_uf"), nulls("mun_pagto_sg_uf"),
        F.countDistinct("uf"), F.countDistinct("mun_resid_codigo"),
        F.countDistinct("especie_codigo"), F.countDistinct("banco_codigo"),
        F.countDistinct("_ano_mes"), F.sum("vl_liquido"),
    ).first()
    assert tuple(facts) == (
        6000, 2070, 918, 2072, 908, 7, 8, 0, 51, 43, 101, 222, 0, 25, 50, 49, 10, 80,
        Decimal("314748430.24"),
    )


def test_species_group_totals(silver):
    groups = layers.add_species_group(silver).groupBy("grupo_especie").count().collect()
    assert {r["grupo_especie"]: r["count"] for r in groups} == {
        "Amparo_BPC": 448, "Aposentadoria": 2193, "Auxilio": 926, "Outros": 1146, "Pensao": 1287,
    }
