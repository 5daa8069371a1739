"""Loads: each query writes its tables under the shared folder and returns the table read
back. Inputs are date ranges of the whole tables, as a run would receive them."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tallyframe.functions import numbers as N
from tallyframe.operators import merges as M
from tallyframe.operators import predicates as P
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sinks import loads as K
from tallyframe.sources.calendar import business_flag, calendar_between
from tallyframe.streaming import increments as I


def _customer_state(rows):
    """One row per customer: number of orders, total, first and last day."""
    return rows.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), N.sum_money(F.col("o_totalprice")).alias("total"),
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"),
    )


_STATE_SQL = """SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
 CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders WHERE {} GROUP BY o_custkey"""
_OLD_SQL = _STATE_SQL.format(f"o_orderdate < TIMESTAMP '{ORDERS_AS_OF}'")
_NEW_SQL = _STATE_SQL.format(f"o_orderdate >= TIMESTAMP '{ORDERS_AS_OF}'")


#: Buckets of the upserted tables; a table of a billion keys would have thousands.
BUCKETS = 8


def _bucketed(rows, keys):
    return rows.withColumn("bucket", K.bucket_of(keys, BUCKETS))


def _old_and_new(t):
    old = t.orders.filter(P.before_day("o_orderdate", ORDERS_AS_OF))
    new = t.orders.filter(P.since_day("o_orderdate", ORDERS_AS_OF))
    return old, new


@query("""
SELECT event_type, count(*) AS n, DATE '2024-01-16' AS as_of FROM events WHERE ts < TIMESTAMP '2024-01-17' GROUP BY 1
""")
def load_append_snapshot(t):
    """Three days. The last is loaded twice and leaves no duplicates; the others are loaded again without rows and are empty."""
    path = new_table_path(t.spark, "event_counts")
    counts = lambda first, last: t.events.filter(P.between_days("ts", first, last)).groupBy("event_type").agg(F.count("*").alias("n"))
    for as_of in ("2024-01-14", "2024-01-15", "2024-01-16", "2024-01-16"):
        loaded = K.append_snapshot(counts("2024-01-01", as_of), path, as_of)
    for as_of in ("2024-01-14", "2024-01-15"):
        loaded = K.append_snapshot(counts("2030-01-01", "2030-01-02"), path, as_of)
    return loaded


@query(_NEW_SQL)
def load_truncate(t):
    path = new_table_path(t.spark, "customer_state")
    old, new = _old_and_new(t)
    K.truncate_load(_customer_state(old), path)
    return K.truncate_load(_customer_state(new), path)


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
""")
def load_recreate(t):
    """New schema over an old table, with a checked key and sorted files."""
    path = new_table_path(t.spark, "customers")
    K.truncate_load(t.customer.select("c_custkey"), path)
    df = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return K.recreate_load(df, path, key=["c_custkey"], sort=["c_custkey"], spread=["c_custkey"])


@query(f"""
WITH o AS ({_OLD_SQL}), n AS ({_NEW_SQL})
SELECT * FROM n UNION ALL SELECT * FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM n)
""")
def load_upsert_replace(t):
    """Only buckets of staged customers are rewritten."""
    path = new_table_path(t.spark, "customer_state")
    old, new = (_bucketed(_customer_state(rows), ["o_custkey"]) for rows in _old_and_new(t))
    K.append_partitions(old, path, "bucket")
    return K.merge_partitions(new, path, ["o_custkey"], "bucket").drop("bucket")


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus = 'O' THEN 'CLOSED' ELSE o_orderstatus END AS state, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
""")
def load_upsert_partitions(t):
    """Rows of recent years change their state; only the partitions of those years are rewritten."""
    path = new_table_path(t.spark, "order_state")
    base = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("state"), F.year("o_orderdate").alias("y"))
    K.append_partitions(base, path, "y")
    staged = base.filter("y >= 1999 AND state = 'O'").withColumn("state", F.lit("CLOSED"))
    return K.merge_partitions(staged, path, ["o_orderkey"], "y")


@query(f"""
WITH o AS ({_OLD_SQL}), n AS ({_NEW_SQL})
SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(o.orders, n.orders) AS orders,
  CASE WHEN o.o_custkey IS NULL THEN n.total ELSE o.total END AS total, coalesce(o.first_day, n.first_day) AS first_day,
  CASE WHEN n.o_custkey IS NULL THEN o.last_day ELSE n.last_day END AS last_day
FROM o FULL JOIN n ON o.o_custkey = n.o_custkey
""")
def load_upsert_update_insert(t):
    """Known customers only move their last day; unknown ones are added whole."""
    path = new_table_path(t.spark, "channel_users")
    old, new = (_bucketed(_customer_state(rows), ["o_custkey"]) for rows in _old_and_new(t))
    K.append_partitions(old, path, "bucket")
    merge = lambda target, staged: M.upsert_update_insert(target, staged, ["o_custkey"], ["last_day"], ["last_day"])
    return K.merge_touched(new, path, "bucket", merge).drop("bucket")


# Run dates that cut the events of the month into four deliveries.
VALIDITY_RUNS = ("2024-01-08", "2024-01-15", "2024-01-22", "2024-01-31")


@query("""
SELECT md5(CAST(user_id AS VARCHAR) || chr(1) || event_type || chr(1) || large) AS hash, user_id, event_type, large, min(run) - 1 AS valid_from, max(run) - 1 AS valid_to
FROM (SELECT user_id, event_type, CASE WHEN value > 20 THEN 'S' ELSE 'N' END AS large,
  CASE WHEN ts < TIMESTAMP '2024-01-08' THEN DATE '2024-01-08' WHEN ts < TIMESTAMP '2024-01-15' THEN DATE '2024-01-15'
       WHEN ts < TIMESTAMP '2024-01-22' THEN DATE '2024-01-22' ELSE DATE '2024-01-31' END AS run FROM events WHERE ts < TIMESTAMP '2024-01-31')
GROUP BY user_id, event_type, large
""")
def load_hash_validity(t):
    """Four weekly deliveries of the products each user has used; each writes its own rows, and the first two are merged on the way."""
    path = new_table_path(t.spark, "user_products")
    content = ["user_id", "event_type", "large"]
    start = "2024-01-01"
    for run in VALIDITY_RUNS:
        rows = t.events.filter(P.since_day("ts", start) & P.before_day("ts", run))
        rows = rows.select("user_id", "event_type", F.when(F.col("value") > 20, "S").otherwise("N").alias("large"))
        K.append_validity(M.stage_validity(rows.distinct(), content, run), path, run)
        start = run
    K.compact_validity(t.spark, path, content, VALIDITY_RUNS[1])
    return K.read_validity(t.spark, path, content)


@query("""
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS balance, d AS cut_date FROM events,
 (SELECT unnest([DATE '2024-01-13', DATE '2024-01-14']) AS d) WHERE ts < TIMESTAMP '2024-01-14' GROUP BY user_id, d
""")
def load_rollforward(t):
    """Saturday is loaded; Sunday is no business day, so Saturday's snapshot is repeated."""
    path = new_table_path(t.spark, "savings")
    calendar = calendar_between(t.events, "ts")
    for as_of in ("2024-01-14", "2024-01-15"):

        def load(as_of=as_of):
            upto = t.events.filter(P.before_day("ts", as_of))
            return upto.groupBy("user_id").agg(N.sum_money(F.col("value")).alias("balance"))

        out = K.rollforward_snapshot(t.spark, path, as_of, business_flag(calendar, as_of), load)
    return out


@query("""
SELECT CAST(d AS DATE) AS cal_date, CASE WHEN dayofweek(d) = 0 THEN 'N' ELSE 'S' END AS business_day FROM (
  SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)
""")
def calendar_lookup(t):
    return calendar_between(t.events, "ts")


@query(f"""
SELECT o_orderkey, o_totalprice, DATE '{ORDERS_AS_OF}' AS as_of FROM orders WHERE o_orderstatus = 'P'
""")
def load_snapshot_from_table(t):
    path = new_table_path(t.spark, "insurance_history")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    stamped = M.snapshot_projection(rows, F.col("o_orderstatus") == "P", ORDERS_AS_OF).drop("o_orderstatus")
    return K.append_snapshot(stamped, path, ORDERS_AS_OF)


@query("""
SELECT s_suppkey, s_name, DATE '2024-02-01' AS as_of FROM supplier
""")
def load_month_gated_copy(t):
    """Only day 1 in local time copies: 02:00 UTC on 1 February is still January in Bogota."""
    path = new_table_path(t.spark, "offices_month")
    offices = t.supplier.select("s_suppkey", "s_name")
    early = datetime(2024, 2, 1, 2, tzinfo=timezone.utc)
    if K.month_gated_copy(offices, path, early, "America/Bogota") is not None:
        raise AssertionError("copied before local midnight")
    return K.month_gated_copy(offices, path, early.replace(hour=12), "America/Bogota")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2000-06-29' END AS fecha_carge FROM orders
""")
def load_post_fill(t):
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderstatus") == "P", "  ")
    rows = t.orders.select("o_orderkey", raw.alias("fecha_carge"))
    path = new_table_path(t.spark, "filled")
    return K.truncate_load(M.fill_blank_date(rows, "fecha_carge", ORDERS_AS_OF), path)


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, 20000630 AS cut_date FROM orders
""")
def load_export_dated_csv(t):
    path = new_table_path(t.spark, "export")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    K.export_dated_csv(rows, path, ORDERS_AS_OF)
    reader = t.spark.read.schema("o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, cut_date INT")
    return reader.option("header", True).csv(path)


@query("""
SELECT event_type, count(*) AS n, DATE '2024-01-16' AS as_of FROM events WHERE ts < TIMESTAMP '2024-01-17' GROUP BY event_type
""")
def load_current_view(t):
    """A view of the last day of a snapshot table; the date filter prunes partitions."""
    history = load_append_snapshot(t)
    return K.current_view(history, "tallyframe_event_counts", "as_of", date(2024, 1, 16))


@query("""
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events WHERE event_type <> 'error'
""")
def stream_append_increment(t):
    """New event files as a stream, through the same transform as a batch."""
    stream = I.read_increments(t.spark, t.folder, t.events.schema, "events.parquet")

    def transform(df):
        parsed = df.filter("event_type <> 'error'").withColumn("k", F.from_json("props", "k INT")["k"])
        return parsed.select("event_id", "user_id", "event_type", "k", "value")

    return I.append_increments(
        stream, new_table_path(t.spark, "increments"), new_table_path(t.spark, "increments_log"), transform
    )


@query("""
SELECT user_id, event_type, CAST(min(ts) AS DATE) AS valid_from, CAST(max(ts) AS DATE) AS valid_to FROM events GROUP BY user_id, event_type
""")
def stream_validity_increment(t):
    """Events come as five files and as many micro-batches; each merges into the buckets it touches.

    A repeated batch only widens what is there already, so it leaves the same table.
    """
    source, path = new_table_path(t.spark, "stream_in"), new_table_path(t.spark, "stream_validity")
    t.events.select("user_id", "event_type", "ts").repartition(5).write.parquet(source)
    stream = I.read_increments(t.spark, source, t.spark.read.parquet(source).schema, files_per_batch=1)
    content = ["user_id", "event_type"]
    merge = lambda target, new: _bucketed(M.hash_validity_merge(target, new, content), ["hash"])

    def load(batch, number):
        days = batch.groupBy(*content).agg(
            F.to_date(F.min("ts")).alias("valid_from"), F.to_date(F.max("ts")).alias("valid_to")
        )
        staged = _bucketed(M.with_content_hash(days, content), ["hash"])
        if number == 0:
            K.append_partitions(staged, path, "bucket")
        else:
            K.merge_touched(staged, path, "bucket", merge)

    I.load_increments(stream, new_table_path(t.spark, "stream_validity_log"), load)
    return t.spark.read.parquet(path).drop("bucket", "hash")
