from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import aggregates as A
from tallyframe.operators import classify as K
from tallyframe.operators import columns as C
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import predicates as P
from tallyframe.operators import quality as Q
from tallyframe.operators import unions as U

KEYS = [(1, 5, "a"), (1, 5, "b"), (2, None, "c"), (2, 1, "d"), (None, 3, "e")]


def keyed(spark):
    return spark.createDataFrame(KEYS, "k int, v int, t string")


def test_aging_edges(spark):
    days = [-1, 0, 1, 30, 31, 60, 61, 90, 91, 120, 121, 180, 181, 360, 361, None]
    df = spark.createDataFrame([(d, 10.0) for d in days], "d int, b double")
    got = {r["d"]: r.asDict() for r in K.aging_buckets(df, "d", "b").collect()}
    single = [n for n, _, _ in K.AGING_BANDS[:8]]
    for d in days:
        hits = [n for n in single if got[d][n]]
        assert len(hits) == (0 if d is None or d < 0 else 1), d
    assert [n for n in single if got[30][n]] == ["mora_1_a_30"] and [n for n in single if got[31][n]] == ["mora_31_a_60"]
    assert got[1]["morageneral"] and not got[0]["morageneral"] and got[31]["mora_30"] and not got[30]["mora_30"]


def test_latest_first_and_ties(spark, rows):
    df = keyed(spark)
    assert rows(L.latest_per_key(df, "k", ["v", "t"])) == rows(spark.createDataFrame([(1, 5, "b"), (2, 1, "d"), (None, 3, "e")], df.schema))
    assert rows(L.first_per_key(df, "k", ["v", "t"])) == rows(spark.createDataFrame([(1, 5, "a"), (2, 1, "d"), (None, 3, "e")], df.schema))
    assert L.keep_max_group(df, "k", "v").filter("k = 1").count() == 2
    assert L.latest_per_key(df.limit(0), "k", ["v"]).count() == 0


def test_group_extremes_may_keep_none(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (2, 5, 0)], "k int, hi int, lo int")
    assert [tuple(r) for r in L.keep_group_extremes(df, "k", ["hi"], ["lo"]).collect()] == [(2, 5, 0)]


def test_flagged_groups(spark, rows):
    df = keyed(spark)
    assert rows(L.keep_flagged_groups(df, "k", F.col("t") == "a").select("t")) == [("a",), ("b",)]
    assert rows(L.keep_flagged_groups(df, "k", F.col("t") == "a", drop_flag_rows=True).select("t")) == [("b",)]
    assert rows(L.group_flag(df, "k", F.col("t") == "d", "f").select("t", "f")) == [("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", 0)]


def test_salted_lookup_equals_plain(spark, rows):
    left = spark.range(2000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    left = left.withColumn("k", F.when(F.col("k") == 1, 0).otherwise(F.col("id").cast("int")))
    right = spark.range(1500).select(F.col("id").cast("int").alias("rk"), (F.col("id") * 2).alias("w"))
    for how in ("left", "inner"):
        for heavy in (1, 100, 100_000):
            assert rows(J.salted_lookup(left, right, {"k": "rk"}, how=how, heavy_rows=heavy)) == rows(J.lookup(left, right, {"k": "rk"}, how=how))


def test_lookup_never_grows_on_unique_keys(spark):
    left = keyed(spark)
    right = spark.createDataFrame([(1, "x"), (2, "y")], "rk int, w string")
    got = J.lookup(left, right, {"k": "rk"})
    assert got.count() == left.count() and got.columns == ["k", "v", "t", "w"]
    assert J.lookup(left, right, {"k": "rk"}, right_filter=F.col("w") == "x").filter("w = 'y'").count() == 0
    assert J.anti_join(left, right, {"k": "rk"}).count() + J.semi_join(left, right, {"k": "rk"}).count() == left.count()


def test_latest_values_equals_apply_top1(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, 1, "F", "a"), (1, 2, "O", "b"), (1, 3, "F", "c"), (2, 1, "O", "d")], "k int, n int, s string, v string")
    one = J.latest_values(right, "k", ["n"], {"f": (F.col("v"), F.col("s") == "F"), "o": (F.col("v"), F.col("s") == "O")})
    got = J.lookup(left, one, "k")
    want = J.apply_top1(left, right, "k", ["n"], {"v": "f"}, F.col("s") == "F")
    want = J.apply_top1(want, right, "k", ["n"], {"v": "o"}, F.col("s") == "O")
    assert rows(got) == rows(want)


def test_parameters_must_be_one_row(spark):
    df = spark.range(3).toDF("i")
    one = spark.createDataFrame([(7, "x")], "a int, b string")
    assert [tuple(r) for r in J.with_parameters(df, one).collect()] == [(i, 7, "x") for i in range(3)]
    with pytest.raises(Exception):
        J.with_parameters(df, one.union(one)).collect()


def test_event_pairs_hold_every_row_once(spark):
    rows = [(1, "o", i) for i in range(50)] + [(1, "n", i) for i in range(40)] + [(2, "o", 99), (3, "n", 5), (None, "o", 7), (1, "x", 0)]
    df = spark.createDataFrame(rows, "k int, t string, i int")
    got = J.event_pairs(df, "k", F.col("t") == "o", F.col("t") == "n", {"many": F.count("*"), "total": F.sum("i")}).collect()
    assert len(got) == 50 + 40 + 1 + 1
    assert {(r.side, r.i) for r in got if r.k == 1} == {("original", i) for i in range(50)} | {("replacement", i) for i in range(40)}
    assert {(r.k, r.many, r.total) for r in got} == {(1, 40, 780), (2, None, None), (None, None, None)}


def test_first_due_sums_ties(spark, rows):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (1, 2, 9.0), (2, 5, 1.0)], "k int, d int, a double")
    assert rows(J.first_due(df, "k", "d", {"s": F.sum("a")})) == [(1, 1, 5.0), (2, 5, 1.0)]
    assert rows(J.last_paid(df, "k", "d", {"s": F.sum("a")})) == [(1, 2, 9.0), (2, 5, 1.0)]


def test_first_values(spark, rows):
    df = spark.createDataFrame([(1, 1, None, "x"), (1, 2, "a", "y"), (2, 1, None, None)], "k int, n int, p string, q string")
    assert rows(A.first_values(df, ["k"], ["n"], ["p", "q"])) == [(1, "a", "x"), (2, None, None)]
    assert rows(A.first_values(df, ["k"], ["n"], ["p", "q"], skip_nulls=False)) == [(1, None, "x"), (2, None, None)]


def test_lists_and_nulls(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    for n in (0, 198, 200, 5000):
        for extra in ([], [None]):
            codes = ["a", *(f"x{i}" for i in range(n)), *extra]
            assert rows(P.filter_in_list(df, "c", codes)) == [("a",)]
            assert rows(P.filter_not_in_list(df, "c", codes)) == [("b",)]
    assert rows(P.filter_in_list(df, "c", [None])) == [] and rows(P.filter_not_in_list(df, "c", [None])) == [("a",), ("b",)]


def test_only_named_columns_are_cut(spark, rows):
    df = spark.createDataFrame([("x" * 300, "y" * 300, 5)], "a string, b string, n int")
    assert rows(C.truncate_strings(df, {"a": 3, "n": 1})) == [("xxx", "y" * 300, 5)]


def test_day_filters_are_half_open(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-14 23:59:59.999999'), (TIMESTAMP_NTZ '2024-01-15 00:00:00'), (TIMESTAMP_NTZ '2024-01-15 23:59:59.999999'), (TIMESTAMP_NTZ '2024-01-16 00:00:00') AS t(ts)")
    assert P.filter_yesterday(df, "ts", "2024-01-16").count() == 2
    assert P.filter_recent_days(df, "ts", "2024-01-16", 1).count() == 3
    assert df.filter(P.between_days("ts", "2024-01-14", "2024-01-15")).count() == 3


def test_lifecycle_order(spark):
    data = [("2020-01-05", "2020-01-05"), ("2020-01-05", "2020-01-30"), ("2020-01-05", None), ("2020-01-05", "2030-01-01"), ("2020-01-05", "2020-03-01")]
    df = spark.createDataFrame([(date.fromisoformat(a), date.fromisoformat(b) if b else None) for a, b in data], "o date, c date")
    got = [r[0] for r in df.select(K.lifecycle_label(F.col("o"), F.col("c"), "2024-01-01", K.ACTIVITY_LABELS)).collect()]
    assert got == ["No Activo", "No Activo", "Activo", "Activo", None]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` Código  Oficina ` int, `Región:` int, Fecha int")
    assert C.normalize_column_names(df).columns == ["CODIGO_OFICINA", "REGION:", "FECHA"]
    assert C.normalize_column_names(df, upper=False, drop=":").columns == ["codigo_oficina", "region", "fecha"]
    assert C.rename_by_pattern(df, {("codigo", "oficina"): "id"}).columns[0] == "id"
    with pytest.raises(ValueError):
        C.normalize_column_names(spark.createDataFrame([(1, 2)], "`Año` int, ano int"))


def test_select_available(spark):
    df = spark.createDataFrame([(("n", "s"), 1)], "Peticion struct<Nombre:string,Otro:string>, `Raíz` int")
    got = C.select_available(df, ["DI_Nombre", "raiz", "otro", "Falta"], root="Peticion", prefixes=("DI_",))
    assert got.first().asDict() == {"DI_Nombre": "n", "raiz": 1, "otro": "s", "Falta": None}


def test_conform(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("d", T.DecimalType(10, 3)), T.StructField("x", T.DateType())])
    df = spark.createDataFrame([("1", "2.5", "z"), ("bad", "1.2345", "z")], "A string, d string, other string")
    got = C.conform_to_schema(df, schema)
    assert got.schema.simpleString() == "struct<a:int,d:decimal(10,3),x:date>"
    assert [(r["a"], str(r["d"]), r["x"]) for r in got.collect()] == [(1, "2.500", None), (None, "1.235", None)]
    assert C.empty_like(spark, schema).isEmpty()


def test_unions(spark, rows):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    assert rows(U.union_constant_row(df, {"i": 0})) == [(0, None), (1, "a")]
    wide = spark.createDataFrame([(1, "m", None), (2, None, "f")], "k int, m string, l string")
    assert rows(U.unpivot_columns(wide, ["k"], {"m": "movil", "l": "fijo"}, "kind", "tel")) == [(1, "movil", "m"), (2, "fijo", "f")]


def test_quality(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        Q.require_unique(df, ["k"])
    with pytest.raises(ValueError):
        Q.require_non_empty(df.limit(0))
    with pytest.raises(ValueError):
        Q.require_columns(df, ["k", "z"])
    assert Q.skip_if_empty(df.limit(0), lambda d: 1) is None
    counted, seen = Q.with_row_count(df, "test_quality")
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") * 0.1).alias("a"))
    results = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        got = A.group_sum(df.repartition(n), ["k"], {"s": F.round("a", 2)})
        results.append(sorted(tuple(r) for r in got.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
