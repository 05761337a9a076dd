import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from beneflow.functions import fixed, parsing
from beneflow.operators import layers


def value_of(spark, text, expression):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(expression(F.col("x")).alias("y")).first()[0]


def values_of(spark, text, expressions):
    df = spark.createDataFrame([(text,)], "x string")
    return tuple(df.select(*[c.alias(n) for n, c in expressions(F.col("x")).items()]).first())


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1.621,00", Decimal("1621.00")),
        ("0,00", Decimal("0.00")),
        ("-12,5", Decimal("-12.50")),
        ("9.999.999.999,99", Decimal("9999999999.99")),
        ("99.999.999.999,00", None),
        ("n/d", None),
        ("", None),
        (None, None),
    ],
)
def test_money(spark, text, expected):
    assert value_of(spark, text, parsing.money) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("30/01/2026", datetime.date(2026, 1, 30)),
        ("31/02/2000", None),
        ("2026-01-30", None),
        ("", None),
        (None, None),
    ],
)
def test_day(spark, text, expected):
    assert value_of(spark, text, parsing.day) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("104-Caixa Economica", (104, "Caixa Economica")),
        ("1-Banco-X", (1, "Banco-X")),
        ("104", (104, "104")),
        ("SemCodigo", (None, "SemCodigo")),
        (None, (None, None)),
    ],
)
def test_bank(spark, text, expected):
    assert values_of(spark, text, parsing.bank) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("28043-To-Miracema-X", ("28043", "TO", "Miracema-X")),
        ("28043-To", ("28043", "TO", "28043-To")),
        ("Ignorado", ("Ignorado", None, "Ignorado")),
        (None, (None, None, None)),
    ],
)
def test_municipality(spark, text, expected):
    assert values_of(spark, text, lambda c: parsing.municipality(c, "mun")) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Ccf - Conta", ("CCF", "Conta-Corrente Fisica")),
        ("Ccl  -  Loterica", ("CCL", "Conta-Corrente Loterica")),
        ("Cmg", ("CMG", "Cartao Magnetico")),
        ("Cmg-Cartao", (None, None)),
        ("Xyz - Outro", (None, None)),
        (None, (None, None)),
    ],
)
def test_payment_means(spark, text, expected):
    assert values_of(spark, text, parsing.payment_means) == expected


def test_every_state_has_its_code_in_both_variants(spark):
    names = [*fixed.STATE_CODES, "Exterior", None]
    df = spark.createDataFrame([(name,) for name in names], "uf string")
    expected = {name: fixed.STATE_CODES.get(name) for name in names}
    assert len(fixed.STATE_CODES) == 27
    for variant in (layers.add_state_code, layers.add_state_code_by_join):
        rows = variant(df).collect()
        assert {row["uf"]: row["sg_uf"] for row in rows} == expected


@pytest.mark.parametrize(
    ("code", "expected"),
    [(41, "Aposentadoria"), (21, "Pensao"), (31, "Auxilio"), (88, "Amparo_BPC"), (99, "Outros"),
     (None, "Outros")],
)
def test_species_group(spark, code, expected):
    df = spark.createDataFrame([(code,)], "especie_codigo int")
    assert layers.add_species_group(df).first()["grupo_especie"] == expected


def test_species_groups_do_not_overlap():
    codes = [code for group in fixed.SPECIES_GROUPS.values() for code in group]
    assert len(codes) == len(set(codes)) == 52


def test_markers_become_null_only_in_categorical_columns(spark):
    df = spark.createDataFrame(
        [(" {ñ class}", " {ñ class}", " x "), ("Nao Informado ", "a", "y"), ("  ", " ", "z"),
         (" Feminino ", "b", "w"), (None, None, None)],
        "sexo string, uf string, _tag string",
    )
    assert [tuple(row) for row in layers.clean(df).collect()] == [
        (None, "{ñ class}", " x "), (None, "a", "y"), (None, "", "z"), ("Feminino", "b", "w"),
        (None, None, None),
    ]


def test_trim_removes_spaces_only(spark):
    df = spark.createDataFrame([(" \ta\u00a0 ",)], "uf string")
    assert layers.clean(df).first()[0] == "\ta\u00a0"


def test_flags(spark):
    df = spark.createDataFrame(
        [(None, "1", "1"), (Decimal("-1"), "1", "2"), (Decimal("0"), None, "2"),
         (Decimal("3"), "1", None)],
        "vl_liquido decimal(12,2), mun_pagto_codigo string, mun_resid_codigo string",
    )
    flags = [(r["fl_vl_zero"], r["fl_mesmo_municipio"]) for r in layers.add_flags(df).collect()]
    assert flags == [(False, True), (True, False), (True, None), (False, None)]


def test_column_name_with_a_back_tick(spark):
    df = spark.createDataFrame([("v",)], ["a`b.c"])
    assert df.select(parsing.named("a`b.c")).first()[0] == "v"
