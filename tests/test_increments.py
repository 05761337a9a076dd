"""Gold from the states of batches against gold of all rows; what a late file reads; columns beyond the contract."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from beneflow.operators import extras, gold, increments
from beneflow.plans import lake as layer_chain
from beneflow.plans import queries
from beneflow.session import shared_folder
from beneflow.sinks.tables import replace_batch
from beneflow.sources import benefits, deliveries
from beneflow.sources.tables import read_table

TS = "run1"
MONTHS = ["199712", "199803", "199804"]


@pytest.fixture(scope="module")
def payments(silver):
    """Three months, with rows whose amounts, towns, banks or states are NULL."""
    some = silver.where(F.col("_ano_mes").isin(*MONTHS))
    return some.union(
        some.where("_ano_mes = '199803'").limit(20).withColumns({
            "vl_liquido": F.lit(None).cast("decimal(12,2)"), "mun_resid_codigo": F.lit(None).cast("string"),
            "banco_codigo": F.lit(None).cast("int"), "sg_uf": F.lit(None).cast("string"),
        })
    ).persist()


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def check(spark, lake, payments):
    made = increments.gold_from_states(layer_chain.lake_states(spark, lake), TS)
    for name, want in gold.gold_tables(payments, TS).items():
        assert dict(made[name].dtypes) == dict(want.dtypes)
        assert rows_of(made[name]) == rows_of(want), name
    return made


def test_states_of_batches_give_the_same_gold(spark, payments):
    lake = layer_chain.Lake(shared_folder(spark, "states"))
    late = (F.col("_ano_mes") != MONTHS[0]) & (F.pmod(F.hash("vl_liquido", "uf"), F.lit(3)) == 0)
    assert increments.add_batch(payments.where(~late), lake.table("states"), 0) == MONTHS
    # An attempt that had more rows is replaced as a whole, months that are gone with it included.
    increments.add_batch(payments, lake.table("states"), 1)
    for _ in range(2):
        assert increments.add_batch(payments.where(late), lake.table("states"), 1) == MONTHS[1:]
        made = check(spark, lake, payments)
    assert all("/states/" in file for df in made.values() for file in df.inputFiles())


def test_batches_without_rows_or_amounts(spark, payments):
    lake = layer_chain.Lake(shared_folder(spark, "states"))
    bare = payments.withColumns({"vl_liquido": F.lit(None).cast("decimal(12,2)"), "mun_pagto_codigo": F.lit(None).cast("string")})
    assert increments.add_batch(bare.limit(0), lake.table("states"), 0) == []
    assert all(df.count() == 0 for df in increments.gold_from_states(layer_chain.lake_states(spark, lake), TS).values())
    increments.add_batch(bare, lake.table("states"), 7)
    check(spark, lake, bare)


def test_a_batch_is_replaced_whole(spark):
    path = shared_folder(spark, "batches")
    df = spark.range(10).selectExpr("id", "CAST(id % 3 AS string) AS _ano_mes")
    assert replace_batch(df, path, 4) == 10
    assert replace_batch(df.where("_ano_mes = '1'"), path, 4) == 3
    assert replace_batch(df.limit(0), path, 5) == 0
    assert spark.read.schema("id bigint, _ano_mes string, _lote bigint").parquet(path).groupBy("_lote").count().collect() == [(4, 3)]


def test_a_late_file_adds_its_own_rows(spark, folder):
    base = shared_folder(spark, "lake")
    feed = benefits.landing_feed(spark, folder).where(F.col("_ano_mes").isin(*MONTHS[1:]))
    lake = layer_chain.Lake(f"{base}/lake")

    def deliver(month, rows):
        deliveries.write_delivery(rows.drop("_ano_mes").coalesce(1), f"{base}/in/_ano_mes={month}", queries.DELIVERY_HEADER, mode="append")

    def follow():
        layer_chain.follow_files(spark, f"{base}/in", lake, f"{base}/checkpoint", TS, files_at_a_time=1)
        lots = read_table(spark, lake.table("silver")).groupBy("_lote").count().collect()
        return {int(r["_lote"]): r["count"] for r in lots}

    whole = {month: feed.where(F.col("_ano_mes") == month) for month in MONTHS[1:]}
    for month, rows in whole.items():
        deliver(month, rows)
    first = follow()
    assert sorted(first) == [0, 1] and sum(first.values()) == feed.count()
    bank = rows_of(read_table(spark, lake.table("fat_banco"), [MONTHS[1]]))
    late = whole[MONTHS[2]].limit(3)
    deliver(MONTHS[2], late)
    assert follow() == first | {2: 3}
    assert follow() == first | {2: 3}
    kpis = {r["_ano_mes"]: r["total_beneficios"] for r in read_table(spark, lake.table("kpis_nacionais")).collect()}
    assert kpis == {MONTHS[1]: whole[MONTHS[1]].count(), MONTHS[2]: whole[MONTHS[2]].count() + 3}
    assert rows_of(read_table(spark, lake.table("fat_banco"), [MONTHS[1]])) == bank


def test_extras_of_odd_names_and_texts(spark):
    rows = [
        ("a", " 1.621,00 ", "07/02/2001", "x 'y'"), ("b", "n/d", "31/02/2001", ""), ("c", None, None, None), ("d", "-3", "2001-02-07", "7"),
    ]
    df = spark.createDataFrame(rows, "id string, `Nota.` string, `Dt \"x\"` string, `d'água` string")
    packed = extras.pack_extras(df, df.columns[1:])
    assert dict(packed.dtypes) == {"id": "string", "_extras": "variant"}
    path = shared_folder(spark, "variant")
    packed.write.parquet(path)
    back = spark.read.parquet(path).select(
        "id", extras.extra("Nota.", extras.MONEY).alias("n"), extras.extra('Dt "x"', extras.DAY).alias("d"),
        extras.extra("d'água").alias("s"), extras.extra("d'água", "int").alias("i"), extras.extra("nowhere").alias("no"),
        F.expr("size(json_object_keys(to_json(_extras)))").alias("held"),
    )
    assert sorted(map(tuple, back.collect())) == [
        ("a", Decimal("1621.00"), datetime.date(2001, 2, 7), "x 'y'", None, None, 3), ("b", None, None, "", None, None, 3),
        ("c", None, None, None, None, None, 0), ("d", Decimal("-3.00"), None, "7", 7, None, 3),
    ]
    assert "Python" not in back._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="quotes"):
        extras.extra("'\"")
    assert extras.pack_extras(df.select("id"), []).where("to_json(_extras) = '{}'").count() == 4
