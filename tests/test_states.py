"""Merged states against plain counts, SQL functions against their DataFrame twins, pages against the whole order."""

import random

import pytest
from pyspark.sql import functions as F

from beneflow.functions import catalog, parsing
from beneflow.operators import states
from beneflow.sinks.tables import bounded_query, page_after, pages

CODES = ["7", "007", "-3", "0", "32767", "32768", "2147483647", "2147483648", "x", "Ignorado", " 7", "7.0", None, ""]


def test_distinct_values_of_any_text(spark):
    rng = random.Random(1)
    rows = [(f"m{rng.randrange(4)}", rng.choice(["SP", "RJ", None]), rng.choice(CODES), rng.choice([1, 2, 40_000, None])) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "mes string, uf string, cod string, num int").repartition(5)
    state = states.distinct_state(df, ["mes", "uf"], ["cod", "num"])
    # A month that is merged twice counts once.
    state = state.union(state.where("mes = 'm1'"))
    found = {(r.nivel, r.mes, r.uf, r.coluna): r.distintos for r in states.distinct_rollup(state, ["mes"], ["uf"], []).collect()}
    want = {}
    for i, column in ((2, "cod"), (3, "num")):
        for mes, uf, *_ in rows:
            for level, key in ((0, (mes, None)), (1, (None, uf)), (2, (None, None))):
                own = {r[i] for r in rows if r[i] is not None and (level != 0 or r[0] == mes) and (level != 1 or r[1] == uf)}
                want[(level, *key, column)] = len(own)
    assert found == want


def test_distinct_state_of_nothing(spark):
    df = spark.createDataFrame([("m", None)], "mes string, cod string")
    assert states.distinct_rollup(states.distinct_state(df, ["mes"], ["cod"]), ["mes"]).collect() == []


def test_bitmaps_sort_distinct_values_not_rows(spark):
    """The bitmap aggregate is sort-based: a task's rows are made distinct by hashing before anything is sorted."""
    import contextlib
    import io
    import re

    df = spark.range(10_000).selectExpr("CAST(id % 3 AS string) AS mes", "CAST(id % 7 AS string) AS cod")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        states.distinct_state(df, ["mes"], ["cod"]).explain()
    plan = out.getvalue().split("== Physical Plan ==")[-1].splitlines()
    operators = [m.group(1) for line in plan if (m := re.match(r"[\s+\-:*]*(\w+)", line))]
    # The plan is printed from the top down: the operator nearest the scan comes last.
    below_sorts = operators[max(i for i, op in enumerate(operators) if op == "Sort") :]
    assert any(op.startswith("HashAggregate") for op in below_sorts)
    found = {(r.mes, r.coluna): r.distintos for r in states.distinct_rollup(states.distinct_state(df, ["mes"], ["cod"]), ["mes"]).collect()}
    assert found == {(str(m), "cod"): 7 for m in range(3)}


def test_merged_sketches_stay_within_their_error(spark):
    n = 200_000
    df = spark.range(n).selectExpr("id % 24 AS mes", "id % 3 AS k", "CAST((id * 7919 % 1000003) / 100 AS decimal(12,2)) AS v")
    df = df.union(df.limit(50).selectExpr("mes", "k", "CAST(NULL AS decimal(12,2))"))
    out = states.quantile_rollup(states.quantile_state(df, ["mes", "k"], "v"), ["k"], {"p50": 0.5, "p99": 0.99}).collect()
    for r in out:
        own = sorted(i * 7919 % 1000003 for i in range(r.k, n, 3))
        assert r.n == len(own)
        for p, value in ((0.5, r.p50), (0.99, r.p99)):
            rank = sum(x <= int(value * 100) for x in own) / len(own)
            assert abs(rank - p) < 0.02


def test_functions_are_the_same_for_sql_and_dataframes(spark):
    names = catalog.register_functions(spark)
    assert catalog.register_functions(spark) == names
    rows = [(41, "1.621,00", "São Paulo", "104-Caixa"), (88, "n/d", "Exterior", "SemCodigo"), (None, None, None, None), (21, "0,00", "Acre", "-")]
    df = spark.createDataFrame(rows, "cod int, valor string, uf string, banco string")
    df.createOrReplaceTempView("pagamentos_teste")
    by_sql = spark.sql("SELECT grupo_especie(cod) g, valor_monetario(valor) v, sigla_uf(uf) s, parte_codigo(banco) b FROM pagamentos_teste")
    by_name = df.select(*[F.call_function(f, F.col(c)) for f, c in zip(names, df.columns, strict=True)])
    own = df.select(parsing.species_group("cod"), parsing.money(F.col("valor")), parsing.state_code(F.col("uf")), parsing.leading_code(F.col("banco")))
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in by_name.collect()] == [tuple(r) for r in own.collect()]
    assert "Python" not in by_sql._jdf.queryExecution().toString()
    spark.catalog.dropTempView("pagamentos_teste")


@pytest.mark.parametrize("rows", [1, 4, 7, 100])
def test_pages_are_the_whole_order(spark, rows):
    values = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in ("x", None, "y", "") for b in (2, None, 1))]
    df = spark.createDataFrame(values, "a string, b int, i int").repartition(3)
    order = ["a", "b", "i"]
    whole = [tuple(r) for r in df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).collect()]
    found = list(pages(df, order, rows))
    assert [tuple(r) for page in found for r in page] == whole
    assert all(len(page) == rows for page in found[:-1])


def test_rows_that_come_before_a_page_do_not_move_it(spark):
    df = spark.range(20).selectExpr("id AS a")
    first = page_after(df, ["a"], None, 5).collect()
    more = df.union(spark.range(-5, 0).selectExpr("id AS a"))
    assert [r.a for r in page_after(more, ["a"], first[-1].asDict(), 5).collect()] == [5, 6, 7, 8, 9]


def test_markers_are_values_and_never_text(spark):
    spark.range(10).createOrReplaceTempView("dez")
    found = bounded_query(spark, "SELECT id FROM dez WHERE id >= :de AND CAST(id AS string) <> :texto", ["id"], 3, {"de": 4, "texto": "5' OR '1'='1"})
    assert [r.id for r in found.collect()] == [4, 5, 6]
    spark.catalog.dropTempView("dez")
