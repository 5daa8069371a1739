from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import merges as M
from tallyframe.session import new_table_path, shared_folder
from tallyframe.sinks import loads as K
from tallyframe.sources.calendar import business_flag, calendar_between
from tallyframe.sources.tables import SplitColumn, jdbc_options
from tallyframe.streaming import increments as I
from tests.conftest import plan_of


def table(spark, rows, ddl="k int, c string, n int"):
    return spark.createDataFrame(rows, ddl)


OLD = [(1, "a", 1), (2, "b", 2), (3, "gone", 3)]
NEW = [(1, "a", 1), (2, "changed", 20), (4, "new", 4)]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_table_path(spark, "x") != new_table_path(spark, "x")


def test_upserts_and_repeats(spark, rows):
    old, new = table(spark, OLD), table(spark, NEW)
    once = M.upsert_replace(old, new, ["k"])
    assert rows(once) == [(1, "a", 1), (2, "changed", 20), (3, "gone", 3), (4, "new", 4)]
    assert rows(M.upsert_replace(once, new, ["k"])) == rows(once)
    part = M.upsert_update_insert(old, new.union(table(spark, [(None, "x", 0)])), ["k"], ["n"])
    assert rows(part) == [(1, "a", 1), (2, "b", 20), (3, "gone", 3), (4, "new", 4)]
    assert rows(M.upsert_update_insert(part, new, ["k"], ["n"])) == rows(part)


def test_update_to_null_is_an_update(spark, rows):
    got = M.upsert_update_insert(table(spark, [(1, "a", 1)]), table(spark, [(1, "z", None)]), ["k"], ["n"])
    assert rows(got) == [(1, "a", None)]


def test_hash_validity(spark):
    content = ["k", "c"]
    day = lambda d: f"2024-01-{d:02d}"
    t1 = M.stage_validity(table(spark, OLD), content, day(10))
    t2 = M.hash_validity_merge(t1, M.stage_validity(table(spark, NEW + NEW), content, day(11)), content)
    t3 = M.hash_validity_merge(t2, M.stage_validity(table(spark, NEW), content, day(11)), content)
    got = {(r["k"], r["c"]): (r["valid_from"].day, r["valid_to"].day) for r in t3.collect()}
    assert got == {(1, "a"): (9, 10), (2, "b"): (9, 9), (3, "gone"): (9, 9), (2, "changed"): (10, 10), (4, "new"): (10, 10)}
    assert t3.count() == t2.count() == t3.select("hash").distinct().count()


def test_null_and_empty_are_one_content(spark):
    day = lambda rows, d: M.stage_validity(table(spark, rows), ["k", "c"], f"2024-01-{d}")
    got = M.hash_validity_merge(day([(1, None, 0), (2, "b", 0)], 10), day([(1, "", 0)], 11), ["k", "c"]).collect()
    assert {(r.k, r.c, r.valid_from.day, r.valid_to.day) for r in got} == {(1, "", 9, 10), (2, "b", 9, 9)}


def test_version_merge_reads_one_and_writes_another(spark, rows):
    path = new_table_path(spark, "versions")
    K.write_version(table(spark, OLD), path, "2024-01-01")
    merge = lambda a, b: M.upsert_replace(a, b, ["k"])
    for _ in range(2):
        got = K.merge_version(table(spark, NEW), path, "2024-01-01", "2024-01-02", merge)
    assert got.count() == 4
    assert rows(K.read_version(spark, path, "2024-01-01")) == rows(table(spark, OLD))
    with pytest.raises(ValueError):
        K.merge_version(table(spark, NEW), path, "2024-01-02", "2024-01-02", merge)


def test_partition_merge_leaves_other_partitions_alone(spark, rows):
    path = new_table_path(spark, "parts")
    base = table(spark, [(1, "a", 2020), (2, "b", 2021), (3, "c", 2021)], "k int, c string, y int")
    K.append_partitions(base, path, "y")
    files = lambda y: {r[0] for r in spark.read.parquet(path).filter(f"y = {y}").select(F.input_file_name()).collect()}
    before = files(2020)
    got = K.merge_partitions(table(spark, [(2, "B", 2021), (9, "n", 2022)], "k int, c string, y int"), path, ["k"], "y")
    assert rows(got) == [(1, "a", 2020), (2, "B", 2021), (3, "c", 2021), (9, "n", 2022)]
    assert files(2020) == before


def test_merge_reads_only_touched_partitions(spark):
    path = new_table_path(spark, "parts")
    base = table(spark, [(i, "a", i % 10) for i in range(100)])
    K.append_partitions(base, path, "n")
    seen = []

    def merge(old, new):
        seen.append((plan_of(old), {r.n for r in old.select("n").collect()}))
        return M.upsert_replace(old, new, ["k"])

    K.merge_touched(table(spark, [(3, "z", 3), (13, "z", 3)]), path, "n", merge)
    assert "PartitionFilters: [isnotnull(n" in seen[0][0] and seen[0][1] == {3}
    got = spark.read.parquet(path)
    assert got.count() == 100 and got.filter("c = 'z'").count() == 2
    K.merge_touched(table(spark, [(200, "n", None)]), path, "n", lambda old, new: M.upsert_replace(old, new, ["k"]))
    assert spark.read.parquet(path).filter("n is null").count() == 1


def test_empty_reloads_empty_their_day(spark):
    rows = table(spark, OLD)
    path = new_table_path(spark, "days")
    for day in ("2024-01-14", "2024-01-15"):
        assert K.append_snapshot(rows, path, day).filter(f"as_of = '{day}'").count() == 3
    assert K.append_snapshot(rows.limit(0), path, "2024-01-15").select("as_of").distinct().collect() == [(date(2024, 1, 14),)]
    roll = new_table_path(spark, "roll")
    assert K.rollforward_snapshot(spark, roll, "2024-01-15", "S", lambda: rows).count() == 3
    assert K.rollforward_snapshot(spark, roll, "2024-01-15", "S", lambda: rows.limit(0)).count() == 0
    month = new_table_path(spark, "month")
    at = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)
    assert K.month_gated_copy(rows, month, at, "UTC").count() == 3
    assert K.month_gated_copy(rows.limit(0), month, at, "UTC").count() == 0


def test_staged_duplicates_do_not_multiply(spark, rows):
    old = table(spark, [(1, "a", 1)])
    staged = table(spark, [(1, "x", 5), (1, "y", 4), (2, "p", 1), (2, "q", 2), (None, "z", 9)])
    assert rows(M.upsert_update_insert(old, staged, ["k"], ["c"], ["n"])) == [(1, "x", 1), (2, "q", 2)]
    assert rows(M.upsert_update_insert(old, staged, ["k"], ["c"])) == [(1, "y", 1), (2, "q", 2)]


def test_stream_of_several_batches(spark, rows):
    source, path, log = (new_table_path(spark, n) for n in ("in", "out", "log"))
    for k in range(4):
        table(spark, [(k % 2, "c", k), (9, "d", k)]).coalesce(1).write.mode("append").parquet(source)
    numbers = []

    def load(batch, number):
        numbers.append(number)
        for _ in range(2):  # every batch twice
            staged = batch.withColumn("b", K.bucket_of(["k"], 4))
            if number == 0:
                K.append_partitions(staged, path, "b")
            else:
                K.merge_touched(staged, path, "b", lambda old, new: M.upsert_replace(old, new, ["k"]))

    I.load_increments(I.read_increments(spark, source, table(spark, OLD).schema, files_per_batch=1), log, load)
    assert numbers == [0, 1, 2, 3]
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [0, 1, 9]


def test_rollforward(spark, rows):
    path = new_table_path(spark, "roll")
    load = lambda: table(spark, [(1, "a", 1)])
    K.rollforward_snapshot(spark, path, "2024-01-14", "S", load)
    for _ in range(2):
        got = K.rollforward_snapshot(spark, path, "2024-01-15", "N", lambda: pytest.fail("must not load"))
    assert rows(got.select("k", "cut_date")) == [(1, date(2024, 1, 13)), (1, date(2024, 1, 14))]


def test_calendar(spark):
    days = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-12 05:00:00'), (TIMESTAMP_NTZ '2024-01-15 01:00:00') AS t(ts)")
    calendar = calendar_between(days, "ts")
    assert calendar.count() == 4
    assert business_flag(calendar, "2024-01-15") == "N"
    assert business_flag(calendar, "2024-01-16") == "S"
    assert business_flag(calendar, "2030-01-01") is None


def test_month_gate():
    at = datetime(2024, 2, 1, 3, tzinfo=timezone.utc)
    assert K.is_month_start(at, "UTC") and not K.is_month_start(at, "America/Bogota")


def test_fill_blank_date(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "2020-01-01")], "i int, d string")
    assert rows(M.fill_blank_date(df, "d", "2024-01-16")) == [(1, "2024-01-15"), (2, "2024-01-15"), (3, "2020-01-01")]


def test_export_and_view(spark):
    path = new_table_path(spark, "csv")
    target = K.export_dated_csv(table(spark, OLD), path, "2024-01-16", single_file=True)
    assert target.endswith("cut_date=20240116")
    assert spark.read.option("header", True).csv(target).count() == 3
    history = table(spark, OLD).withColumn("d", F.lit(date(2024, 1, 1)))
    assert K.current_view(history, "tallyframe_test_view", "d", "2024-01-02").count() == 0
    assert K.current_view(history, "tallyframe_test_view").count() == 3


def test_recreate_checks_the_key(spark):
    path = new_table_path(spark, "recreate")
    with pytest.raises(ValueError):
        K.recreate_load(table(spark, OLD + OLD), path, key=["k"])


def test_stream_reads_each_file_once(spark):
    source, target, log = (new_table_path(spark, n) for n in ("in", "out", "log"))
    schema = table(spark, OLD).schema
    table(spark, OLD).write.parquet(source)
    for _ in range(2):
        assert I.append_increments(I.read_increments(spark, source, schema), target, log).count() == 3
    table(spark, NEW).write.mode("append").parquet(source)
    assert I.append_increments(I.read_increments(spark, source, schema), target, log).count() == 6


def test_jdbc_options():
    assert jdbc_options(table="dim.t") == {"fetchsize": "10000", "dbtable": "dim.t"}
    assert jdbc_options(query="SELECT 1")["query"] == "SELECT 1"
    split = jdbc_options(query="SELECT 1 AS x", split=SplitColumn("x", "0", "10", 4))
    assert split["dbtable"] == "(SELECT 1 AS x) AS subquery" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        jdbc_options()
