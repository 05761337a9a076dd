import pytest
from pyspark.sql import functions as F

from beneflow.functions import fixed
from beneflow.plans import lake as layer_chain, queries
from beneflow.session import shared_folder
from beneflow.sinks.tables import run_history
from beneflow.sources import benefits, deliveries
from beneflow.sources.tables import read_table


@pytest.mark.parametrize(
    ("header", "expected"),
    [
        ("a;b;c;d", ";"),
        ("a,b,c,d", ","),
        ("a\tb\tc\td", "\t"),
        ("a|b|c|d", "|"),
        ("a;b;c", ";"),
        ("a,b,c", ";"),
        ("a,x;b,y;c,z;d", ";"),
        ("", ";"),
    ],
)
def test_sniff_separator(header, expected):
    assert deliveries.sniff_separator(header) == expected


def test_repeated_headers_get_their_position():
    assert deliveries.distinct_names(["a", "Espécie", "Espécie"]) == ["a", "Espécie1", "Espécie2"]
    assert deliveries.distinct_names(["a", "A", "b"]) == ["a0", "A1", "b"]
    assert deliveries.distinct_names(queries.DELIVERY_HEADER) == list(fixed.LANDING_TO_BRONZE)


@pytest.mark.parametrize("separator", fixed.SEPARATORS)
def test_round_trip(spark, separator):
    path = shared_folder(spark, "delivery")
    rows = [("São Paulo", " 88", "x"), ("Ceará ", "{ñ class}", None), ("  a", "1.621.00", "z")]
    df = spark.createDataFrame(rows, "a string, b string, c string").select("*", F.col("a").alias("d"))
    deliveries.write_delivery(df.repartition(3), path, ["UF", "Espécie", "Espécie", "d"], separator)
    back = deliveries.read_delivery(spark, path)
    assert back.columns == ["UF", "Espécie1", "Espécie2", "d"]
    expected = [(a, b, c, a) for a, b, c in rows]
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, expected))


def test_header_names_equal_those_spark_infers(spark):
    path = shared_folder(spark, "delivery")
    df = spark.createDataFrame([("1", "2", "3", "4")], "a string, b string, c string, d string")
    deliveries.write_delivery(df, path, ["x", "Espécie", "Espécie", "y"])
    inferred = spark.read.csv(path, header=True, sep=";", encoding="ISO-8859-1")
    assert deliveries.read_delivery(spark, path).columns == inferred.columns


def test_months_with_different_headers(spark):
    base = shared_folder(spark, "monthly")
    frames = {"202601": "a string, b string, c string, d string",
              "202602": "a string, b string, c string, d string, e string"}
    for month, schema in frames.items():
        width = schema.count(" string")
        df = spark.createDataFrame([tuple(f"{month}{i}" for i in range(width))], schema)
        deliveries.write_delivery(df, f"{base}/_ano_mes={month}", df.columns)
    back = deliveries.read_monthly_deliveries(spark, base, list(frames)).sort("_ano_mes").collect()
    assert [(r["_ano_mes"], r["a"], r["e"]) for r in back] == [
        ("202601", "2026010", None), ("202602", "2026020", "2026024")
    ]


def _files(spark, *texts):
    """A folder with a file for each text."""
    path = shared_folder(spark, "files")
    for text in texts:
        lines = [(line,) for line in text.split("\n")]
        spark.createDataFrame(lines, "line string").coalesce(1).write.mode("append").text(path)
    return path


def test_files_of_one_folder_with_other_separators_and_column_orders(spark):
    path = _files(spark, "A;B;C;D\n1;2;3;4", "D;C;B;A\n4;3;2;1", "A,B,C,D\n1,2,3,4", "B|A|D|C|E\n2|1|4|3|5", "")
    rows = deliveries.read_delivery(spark, path, ["A", "B", "C", "D"]).select(*"ABCDE").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "2", "3", "4", "5")] + [("1", "2", "3", "4", None)] * 3


def test_separators_inside_quoted_names(spark):
    df = deliveries.read_delivery(spark, _files(spark, '"A;x";B;C;D\n1;2;3;4'))
    assert df.columns == ["A;x", "B", "C", "D"]
    assert [tuple(r) for r in df.collect()] == [("1", "2", "3", "4")]


def test_a_file_without_a_known_column_is_refused(spark):
    path = _files(spark, "A;B;C;D\n1;2;3;4", "A;B;X;D\n1;2;3;4")
    with pytest.raises(ValueError, match="no column C"):
        deliveries.read_delivery(spark, path, ["A", "B", "C", "D"])


def test_repeated_names_in_another_order():
    known = list(fixed.LANDING_TO_BRONZE)
    turned = queries.DELIVERY_HEADER[-2:] + queries.DELIVERY_HEADER[:-2]
    assert deliveries.distinct_names(turned, known) == known[-2:] + known[:-2]


def test_every_written_file_has_its_header(spark):
    path = shared_folder(spark, "delivery")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        df = spark.range(50).selectExpr("cast(id AS string) AS a", "'x' AS b", "'y' AS c", "'z' AS d")
        deliveries.write_delivery(df.coalesce(2), path, df.columns)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert deliveries.read_delivery(spark, path).count() == 50


def test_an_empty_delivery_is_an_error(spark):
    path = shared_folder(spark, "empty")
    spark.createDataFrame([], "x string").write.csv(path)
    with pytest.raises(ValueError, match="no header"):
        deliveries.read_delivery(spark, path)


def test_a_new_column_reaches_silver(spark, folder):
    base = shared_folder(spark, "lake")
    months = ["199503", "199803"]
    feed = benefits.landing_feed(spark, folder)
    for month in months:
        one = feed.filter(F.col("_ano_mes") == month).drop("_ano_mes")
        header = list(queries.DELIVERY_HEADER)
        if month == "199803":
            one, header = one.withColumn("nota", F.lit(" nova ")), [*header, "Observação"]
        deliveries.write_delivery(one, f"{base}/in/_ano_mes={month}", header)
    lake = layer_chain.Lake(f"{base}/lake")
    layer_chain.run_layers(spark, f"{base}/in", months, lake, "run1")
    rows = read_table(spark, lake.table("silver"), merge_schema=True).select("_ano_mes", "Observação").distinct()
    assert sorted(map(tuple, rows.collect())) == [("199503", None), ("199803", "nova")]
    assert "Observação" in read_table(spark, lake.table("bronze"), merge_schema=True).columns


def test_two_months_end_to_end_and_a_late_file(spark, folder):
    base = shared_folder(spark, "lake")
    months = ["199503", "199803"]
    feed = benefits.landing_feed(spark, folder).filter(F.col("_ano_mes").isin(*months)).cache()
    for month in months:
        one = feed.filter(F.col("_ano_mes") == month).drop("_ano_mes")
        deliveries.write_delivery(one, f"{base}/in/_ano_mes={month}", queries.DELIVERY_HEADER)
    lake = layer_chain.Lake(f"{base}/lake")
    layer_chain.follow_deliveries(spark, f"{base}/in", lake, f"{base}/checkpoint", "run1")
    # A second file for one month arrives; only that month runs again, with both files.
    late = feed.filter(F.col("_ano_mes") == months[1]).drop("_ano_mes").limit(3)
    deliveries.write_delivery(
        late, f"{base}/in/_ano_mes={months[1]}", queries.DELIVERY_HEADER, mode="append"
    )
    layer_chain.follow_deliveries(spark, f"{base}/in", lake, f"{base}/checkpoint", "run2")
    layer_chain.follow_deliveries(spark, f"{base}/in", lake, f"{base}/checkpoint", "run3")

    expected = {r[0]: r[1] for r in feed.groupBy("_ano_mes").count().collect()}
    expected[months[1]] += 3
    silver = read_table(spark, lake.table("silver"))
    assert {r[0]: r[1] for r in silver.groupBy("_ano_mes").count().collect()} == expected
    assert len(silver.columns) == 29
    kpis = read_table(spark, lake.table("kpis_nacionais")).collect()
    assert {r["_ano_mes"]: (r["total_beneficios"], r["_gold_ts"]) for r in kpis} == {
        "199503": (expected["199503"], "run1"), "199803": (expected["199803"], "run2")
    }
    history = run_history(spark, lake.audit, "silver", 5).collect()
    assert [r["run_ts"] for r in history] == ["run2", "run1"]
    assert history[1]["linhas"] == sum(expected.values()) - 3


def bytes_read(spark):
    """By all tasks of this local session so far."""
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_headers_cost_the_beginning_of_each_file(spark):
    path = shared_folder(spark, "large")
    rows = spark.range(0, 600_000, 1, 3).selectExpr(*[f"repeat(CAST(id AS string), 3) AS c{i}" for i in range(4)])
    deliveries.write_delivery(rows, path, ["A", "B", "C", "D"])
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(path)).getLength()
    before = bytes_read(spark)
    assert deliveries.file_headers(spark, [path]) == {"A;B;C;D": [path]}
    assert size > 40e6 and bytes_read(spark) - before < 0.05 * size
    before = bytes_read(spark)
    assert deliveries.read_delivery(spark, path).count() == 600_000
    assert bytes_read(spark) - before < 1.05 * size


BROKEN = "A;B;C;D\n1;2;3;4\n1;2;3;4;5;6\n1;2\n\"x;y\";2;3;4\n\"x;y\";2;3\n;;;\n  lone"


def test_broken_lines_are_kept_whole(spark):
    rows = deliveries.read_delivery(spark, _files(spark, BROKEN), list("ABCD"), rejected=True).collect()
    assert len(rows) == 7
    good = sorted([tuple(r[c] for c in "ABCD") for r in rows if r[deliveries.REJECTED_LINE] is None], key=str)
    assert good == [("1", "2", "3", "4"), ("x;y", "2", "3", "4"), (None, None, None, None)]
    broken = {r[deliveries.REJECTED_LINE]: r for r in rows if r[deliveries.REJECTED_LINE] is not None}
    assert {line: r[deliveries.REJECTED_WHY] for line, r in broken.items()} == {
        "1;2;3;4;5;6": "campos_a_mais", "1;2": "campos_a_menos", '"x;y";2;3': "campos_a_menos", "  lone": "campos_a_menos"
    }
    for r in broken.values():
        assert r["A"] is None and r["D"] is None and r[deliveries.REJECTED_FILE].endswith(".txt")


def test_broken_lines_fail_a_read_that_does_not_keep_them(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        deliveries.read_delivery(spark, _files(spark, BROKEN)).select("A").collect()


def test_good_and_rejected_rows_are_the_lines_read(spark, folder):
    df = queries.delivery_rescued(spark, folder)
    rows = df.collect()
    lines = benefits.raw_feed(spark, folder).count()
    counted = {kind: sum(r.qtd for r in rows if r.situacao == kind) for kind in ("boa", "campos_a_menos", "campos_a_mais")}
    assert sum(counted.values()) == lines and all(counted.values())
    audited = {r.chave: 0 for r in rows if r.situacao == "auditoria"}
    for r in rows:
        if r.situacao == "auditoria":
            audited[r.chave] += r.qtd
    assert audited == {"landing": lines, "quarantine": lines - counted["boa"]}
