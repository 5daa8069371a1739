"""Tables laid out for their readers, against plain versions and by their plans."""

import os
import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import joins as J
from tallyframe.operators import merges as M
from tallyframe.operators import sides as S
from tallyframe.plans import all_queries
from tallyframe.session import new_table_path
from tallyframe.sinks import evolving as V
from tallyframe.sinks import loads as K
from tallyframe.sources.files import scan_csv_checked
from tallyframe.streaming import increments as I
from tests.conftest import plan_of


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_bucketed_tables_join_without_a_shuffle(spark, folder, no_broadcast):
    plan = plan_of(all_queries()["load_bucketed_join"](spark, folder))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_buckets_grow_with_the_tables(spark, folder, monkeypatch):
    """A bucket is one task's work: no bucket holds more than its share, and the join still needs no shuffle."""
    assert [K.buckets_for(n, 8) for n in (0, 8_000_000, 8_000_001, 216_000_000)] == [8, 8, 16, 256]
    monkeypatch.setattr(K.buckets_for, "__defaults__", (100,))
    made = all_queries()["load_bucketed_join"](spark, folder)
    assert int(re.search(r"SelectedBucketsCount: \d+ out of (\d+)", plan_of(made)).group(1)) > 8
    assert made.count() == spark.read.parquet(f"{folder}/orders.parquet").count()


def test_bucketed_load_replaces_and_checks(spark, rows):
    name, path = "tallyframe_test_buckets", new_table_path(spark, "buckets")
    K.bucketed_load(spark.range(10), name, ["id"], 4, path)
    table = K.bucketed_load(spark.range(3), name, ["id"], 4, path, unique=True)
    assert rows(table) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        K.bucketed_load(spark.createDataFrame([(1,), (1,)], "id long"), name, ["id"], 4, path, unique=True)


def test_latest_view_opens_no_other_day(spark, rows):
    path = new_table_path(spark, "history")
    for day, n in (("2024-01-02", 1), ("2024-01-10", 2), ("2023-12-31", 3)):
        K.append_snapshot(spark.createDataFrame([(n,)], "n int"), path, day)
    for day in ("2024-01-02", "2023-12-31"):
        for f in os.listdir(f"{path}/as_of={day}"):
            if f.endswith(".parquet"):
                with open(f"{path}/as_of={day}/{f}", "wb") as out:
                    out.write(b"no parquet")
    assert K.last_day(spark, path) == date(2024, 1, 10)
    assert rows(K.latest_view(spark, path, "tallyframe_test_newest")) == [(2, date(2024, 1, 10))]
    assert spark.table("tallyframe_test_newest").count() == 1
    with pytest.raises(ValueError):
        K.last_day(spark, path, "other")


def test_joins_prune_days_at_run_time(spark):
    path = new_table_path(spark, "many_days")
    spark.range(4000).select("id", F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("as_of")).write.partitionBy("as_of").parquet(path)
    days = spark.createDataFrame([(date(2024, 1, 5), "x"), (date(2024, 1, 6), "y")], "d date, mark string").filter("mark = 'x'")
    joined = spark.read.parquet(path).join(days, F.col("as_of") == F.col("d"))
    assert "dynamicpruning" in plan_of(joined) and joined.count() == 100


def test_three_days_of_different_schemas(spark, rows):
    path = new_table_path(spark, "evolving")
    first = spark.createDataFrame([(1, 1.5, date(2024, 1, 1))], "a int, f float, d date")
    second = spark.createDataFrame([(2**40, "x", datetime(2024, 1, 2, 3))], "A long, s string, d timestamp_ntz")
    third = spark.createDataFrame([(7, 2.25, (3, [1, 2]))], "a smallint, f double, n struct<p:int,q:array<int>>")
    V.append_evolving(first, path, "2024-01-01")
    V.append_evolving(second, path, "2024-01-02")
    table = V.append_evolving(third, path, "2024-01-03")
    assert [(f.name, f.dataType.simpleString()) for f in table.schema.fields] == [
        ("a", "bigint"), ("f", "double"), ("d", "timestamp_ntz"), ("s", "string"), ("n", "struct<p:int,q:array<int>>"), ("as_of", "date"),
    ]
    assert sorted(tuple(r)[:4] for r in table.collect()) == sorted([
        (1, 1.5, datetime(2024, 1, 1), None), (2**40, None, datetime(2024, 1, 2, 3), "x"), (7, 2.25, None, None),
    ])
    again = V.append_evolving(spark.createDataFrame([(8,)], "a int"), path, "2024-01-03")
    assert sorted(r["a"] for r in again.collect()) == [1, 8, 2**40]
    assert "PartitionFilters: [isnotnull(as_of" in plan_of(V.read_evolving(spark, path).filter("as_of = DATE '2024-01-02'"))


def test_a_change_that_loses_values_is_refused(spark):
    path = new_table_path(spark, "refused")
    V.append_evolving(spark.createDataFrame([(1, "x")], "a long, s string"), path, "2024-01-01")
    for ddl, row in (("a double", (1.0,)), ("s int", (1,)), ("a string", ("1",))):
        with pytest.raises(V.SchemaChange):
            V.append_evolving(spark.createDataFrame([row], ddl), path, "2024-01-02")
    assert K.last_day(spark, path) == date(2024, 1, 1)
    assert V.merged_schema(T._parse_datatype_string("x decimal(10,2)"), T._parse_datatype_string("x decimal(12,5)")).simpleString() == "struct<x:decimal(13,5)>"
    with pytest.raises(ValueError, match="no table"):
        V.read_evolving(spark, new_table_path(spark, "nothing"))


def test_a_failed_first_load_leaves_no_table(spark):
    assert V.stored_schema(spark, new_table_path(spark, "none")) is None


def test_each_event_once_in_five_batches(spark, folder):
    """The stream's rows are the table's, though deliveries repeat each other; without the step they are not."""
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id long, x string")
    assert sorted(r["id"] or 0 for r in I.once_each(batch, ["id"], "x", "1 day").collect()) == [0, 1, 2]
    counts = all_queries()["stream_once_each"](spark, folder).agg(F.sum("n")).first()[0]
    assert counts == spark.read.parquet(f"{folder}/events.parquet").count()


def test_a_delivery_of_many_files_is_one_batch(spark, folder, monkeypatch):
    """Batches follow from deliveries, not from the number of files that a larger table has."""
    logs, append = [], I.append_increments
    monkeypatch.setattr(I, "append_increments", lambda stream, path, log: (logs.append(log), append(stream, path, log))[1])
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        path = new_table_path(spark, "many_files")
        spark.read.parquet(f"{folder}/events.parquet").repartition(6).write.parquet(f"{path}/events.parquet")
        rows = all_queries()["stream_once_each"](spark, path)
        assert rows.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{folder}/events.parquet").count()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
    files = os.listdir(f"{logs[0]}/sources/0")
    assert len(set(logs)) == 1 and len([f for f in files if f.isdigit()]) == 5


def plain_ranges(points, ranges, how):
    out = []
    for p in points:
        hits = [
            (*p, r[3]) for r in ranges
            if p[0] is not None and p[0] == r[0] and p[1] is not None and (r[1] is None or p[1] >= r[1]) and (r[2] is None or p[1] <= r[2])
        ]
        out += hits or ([(*p, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_binned_ranges_against_all_pairs(spark, how):
    rnd = random.Random(4)
    keys = ["a"] * 8 + ["b", None]
    points = [(rnd.choice(keys), rnd.choice([None, 0, 10, 10, 20, -5, rnd.randrange(-100, 5000)]), i % 7) for i in range(400)]
    ranges = [(rnd.choice(keys), lo, lo + rnd.choice([0, 1, 9, 10, 11, 100, 3000])) for lo in (rnd.choice([0, 10, 20, rnd.randrange(-300, 5000)]) for _ in range(80))]
    ranges += [("a", None, 15), ("a", 4000, None), ("b", None, None), ("a", 30, 20), ("a", 10**9, None), ("a", None, -(10**9))]
    ranges = [(*r, i) for i, r in enumerate(ranges)]
    left = spark.createDataFrame(points, "k string, p long, n int")
    right = spark.createDataFrame(ranges, "k string, lo long, hi long, r int")
    got = J.range_lookup(left, right, "k", "p", "lo", "hi", ["r"], width=10, how=how)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_ranges(points, ranges, how)
    none = J.range_lookup(left, right.limit(0), "k", "p", "lo", "hi", ["r"], width=10, how=how)
    assert none.count() == (len(points) if how == "left" else 0)
    assert J.range_lookup(left.limit(0), right, "k", "p", "lo", "hi", ["r"], width=10, how=how).count() == 0


def test_a_hot_key_of_ranges_is_split_by_bins(spark, folder, no_broadcast):
    plan = plan_of(all_queries()["range_bins_join"](spark, folder))
    assert not re.search(r"hashpartitioning\(l_linestatus#\d+, \d+\)", plan)
    assert re.search(r"hashpartitioning\([^)]*__b#", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pairs_of_points_and_ranges_are_listed_once(spark):
    """Rows without a match are found by distinct points and semi join; long ranges lie in many narrow bins."""
    left = spark.createDataFrame([("a", d % 900) for d in range(4000)], "k string, p long")
    right = spark.createDataFrame([("a", d, None, d) for d in range(40)] + [("a", 2000, 2001, 99)], "k string, lo long, hi long, r int")
    found = J.range_lookup(left, right, "k", "p", "lo", "hi", ["r"], width=1)
    assert found.count() == sum(min(d % 900, 39) + 1 for d in range(4000))
    logical = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Inner", logical)) == 1 and "Join LeftSemi" in logical
    assert J.BINS_PER_RANGE >= 64


def test_the_pairs_of_one_bin_are_shared_by_tasks(spark, no_broadcast, monkeypatch):
    """A bin of many pairs is cut into cells by its ranges and by its points; the rows are those of all pairs."""
    monkeypatch.setattr(J, "CELL_SIDE", 20, raising=False)
    monkeypatch.setattr(J, "RANGES_PER_ARRAY", 8, raising=False)
    points = [("a", 5, i) for i in range(600)] + [("b", 70, 1), ("b", 70, 1), ("c", 5, 2), (None, 5, 3), ("a", None, 4)]
    ranges = [("a", 0, 9, i) for i in range(90)] + [("a", 0, 9, 0), ("b", 60, None, -1), ("a", 6, 9, -2), (None, 0, 9, -3)]
    left, right = spark.createDataFrame(points, "k string, p long, n int"), spark.createDataFrame(ranges, "k string, lo long, hi long, r int")
    found = J.range_lookup(left, right, "k", "p", "lo", "hi", ["r"], width=10)
    tasks = found.filter("k = 'a' AND r IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 600 * 91 and max(r["count"] for r in tasks) < 600 * 91 / 4
    assert sorted(map(tuple, found.collect()), key=repr) == plain_ranges(points, ranges, "left")


def test_ranges_of_keys_of_another_type(spark, monkeypatch):
    """A key that equals several keys of the other side has no cells that both sides know."""
    monkeypatch.setattr(J, "CELL_SIDE", 2, raising=False)
    left = spark.createDataFrame([(1, 5, i) for i in range(20)] + [(2, 5, 0)], "k int, p long, n int")
    right = spark.createDataFrame([("1", 0, 9, 1), ("01", 0, 9, 2), ("1", 4, None, 3), ("3", 0, 9, 4)], "k string, lo long, hi long, r int")
    found = J.range_lookup(left, right, "k", "p", "lo", "hi", ["r"], width=10).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 5, i, r) for i in range(20) for r in (1, 2, 3)] + [(2, 5, 0, None)], key=repr)
    wide = right.filter("k <> '01'").withColumn("k", F.col("k").cast("long"))
    found = J.range_lookup(left, wide, "k", "p", "lo", "hi", ["r"], width=10).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 5, i, r) for i in range(20) for r in (1, 3)] + [(2, 5, 0, None)], key=repr)


def test_rejected_lines(spark, rows, tmp_path):
    lines = ["1;2.5;2024-01-01", "", "2;x;2024-01-01", "3;1.0", "4;1.0;2024-13-01", '5;"1.5";2024-01-02', "6;1;2024-01-01;z", "q;1;2024-01-01", ";;", "7;;2024-01-03"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id;price;day\n" + "\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("day", T.DateType())])
    good, bad = scan_csv_checked(spark, str(tmp_path / "in"), schema, new_table_path(spark, "checked"), sep=";")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, 2.5, date(2024, 1, 1)), (5, 1.5, date(2024, 1, 2)), (None, None, None), (7, None, date(2024, 1, 3))], key=repr)
    assert {(r.line, r.reason) for r in bad.collect()} == {
        ("2;x;2024-01-01", "price"), ("3;1.0", "columns"), ("4;1.0;2024-13-01", "day"), ("6;1;2024-01-01;z", "columns"), ("q;1;2024-01-01", "id"),
    }
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    assert good.count() + bad.count() == sum(map(bool, lines))


def test_sides_against_plain_values(spark, rows):
    lines = [(k, n, v, d) for k in (1, 2, None) for n, v, d in ((1, 5.0, 3), (1, 7.0, 9), (2, None, 4), (3, 1.25, None), (1, 8.0, 9))]
    notes = [(1, "b"), (1, "a"), (1, "a"), (4, "z"), (None, "n")]
    tables = {
        "lines": spark.createDataFrame(lines, "k long, n int, v double, d int"), "notes": spark.createDataFrame(notes, "nk long, t string"),
        "names": spark.createDataFrame([("a, b", "both")], "label string, name string"),
    }
    d, n, v = F.col("d"), F.col("n"), F.col("v")
    line, note = {"id": "k"}, {"id": "nk"}
    sides = [
        S.Side("lines", line, S.Pick({"newest": v, "newest_n": n}, [d, v])), S.Side("lines", line, S.Pick({"oldest": v}, [d, v], oldest=True)),
        S.Side("lines", line, S.Pick({"second": n}, [d]), n == 2), S.Side("lines", line, S.Value("total", "sum", v)),
        S.Side("lines", line, S.Value("ones", "count"), n == 1), S.Side("lines", line, S.Value("big", "exists"), v > 7.5), S.Side("lines", line, S.Value("least", "min", v)),
        S.Side("notes", note, S.Listing("labels", F.col("t"))), S.Side("names", {"labels": "label"}, S.Value("name", "max", F.col("name"))),
    ]
    fact = spark.createDataFrame([(1, "f"), (2, "g"), (3, "h"), (None, "i")], "id long, x string")
    got = S.gather(fact, tables, sides)
    one = (8.0, 1, 5.0, 2, 21.25, 3, True, 1.25)
    empty = (None, None, None, None, None, 0, False, None)
    assert rows(got) == sorted([(1, "f", *one, "a, b", "both"), (2, "g", *one, None, None), (3, "h", *empty, None, None), (None, "i", *empty, None, None)], key=repr)


def test_sides_of_a_key_are_one_shuffle(spark, folder, no_broadcast):
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("orders", "lineitem", "customer", "events")}
    sides = [S.Side("orders", {"c_custkey": "o_custkey"}, S.Value(f"most{i}", "max", F.col("o_totalprice") * i)) for i in range(12)]
    sides += [S.Side("events", {"c_custkey": "user_id"}, S.Value("events", "count"))]
    plan = plan_of(S.gather(tables["customer"], tables, sides))
    assert len(re.findall(r"Location: .*/orders\.parquet", plan)) == 1 and len(re.findall(r"Location: .*/events\.parquet", plan)) == 1
    assert len(re.findall(r"\) SortMergeJoin", plan)) == 1 and len(re.findall(r"Arguments: hashpartitioning", plan)) == 2


def test_history_by_deliveries(spark, rows):
    """A delivery adds its rows alone; merging deliveries, whole or half done, and loading one again change nothing."""
    path, content = new_table_path(spark, "validity"), ["c"]
    days = {"2024-01-02": ["a", "b"], "2024-01-03": ["b", None], "2024-01-04": ["a", "", "d"]}
    for day, values in days.items():
        staged = M.stage_validity(spark.createDataFrame([(v,) for v in values], "c string"), content, day)
        K.append_validity(staged, path, day)
        K.append_validity(staged, path, day)

    def found():
        return sorted((r.c or "", str(r.valid_from), str(r.valid_to)) for r in K.read_validity(spark, path, content).collect())

    want = [("", "2024-01-02", "2024-01-03"), ("a", "2024-01-01", "2024-01-03"), ("b", "2024-01-01", "2024-01-02"), ("d", "2024-01-03", "2024-01-03")]
    assert found() == want
    before = K.read_validity(spark, path, content).collect()
    K.append_snapshot(spark.createDataFrame(before).select("hash", "c", "valid_from", "valid_to"), path, "2024-01-03", "delivered")  # as if stopped half way
    assert found() == want
    K.compact_validity(spark, path, content, "2024-01-03")
    assert found() == want and spark.read.parquet(path).filter("delivered < DATE '2024-01-03'").count() == 0
