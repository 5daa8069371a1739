"""Aggregates, one-row-per-key selection, unions and sorts on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import numbers as N
from tallyframe.operators import aggregates as A
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import predicates as P
from tallyframe.operators import unions as U
from tallyframe.plans.registry import ORDERS_AS_OF, query


@query("""
SELECT n_name, year(o_orderdate) AS order_year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(-o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS flipped
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, year(o_orderdate)
""")
def group_sum(t):
    """Summed per customer and year first; the joins then meet few rows."""
    per_customer = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("order_year")).agg(
        F.sum(N.money(F.col("o_totalprice"))).alias("total")
    )
    named = J.lookup(per_customer, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], how="inner")
    named = J.lookup(named, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], how="inner")
    return named.groupBy("n_name", "order_year").agg(
        F.sum("total").cast("double").alias("revenue"), F.sum(-F.col("total")).cast("double").alias("flipped")
    )


@query("""
SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY o_custkey
""")
def group_min_max(t):
    return A.group_min_max(t.orders, ["o_custkey"], F.to_date("o_orderdate"), "first_day", "last_day")


@query("""
SELECT l_suppkey, CAST(sum(CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS capital,
  CAST(sum(CAST(CASE WHEN l_returnflag IN ('N', 'R') AND l_linestatus = 'O' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS interest,
  CAST(sum(CAST(CASE WHEN l_tax = 0 THEN -l_extendedprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS waived,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY l_suppkey
""")
def conditional_sum(t):
    price = F.col("price")
    lines = t.lineitem.select(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_tax", N.money(F.col("l_extendedprice")).alias("price")
    )
    return lines.groupBy("l_suppkey").agg(
        *A.conditional_sums(
            price,
            {
                "capital": F.col("l_returnflag") == "A",
                "interest": F.col("l_returnflag").isin("N", "R") & (F.col("l_linestatus") == "O"),
            },
        ),
        *A.conditional_sums(-price, {"waived": F.col("l_tax") == 0}),
        N.sum_money(price).alias("total"),
    )


@query("""
SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS line_1,
 max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS line_2, max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS line_3
FROM lineitem GROUP BY l_orderkey
""")
def conditional_max_pivot(t):
    return A.conditional_max_pivot(
        t.lineitem, ["l_orderkey"], "l_linenumber", F.col("l_extendedprice"), {1: "line_1", 2: "line_2", 3: "line_3"}
    )


@query("""
SELECT l_orderkey, CAST(sum(DISTINCT CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS distinct_qty,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY l_orderkey
""")
def sum_distinct(t):
    return A.sum_distinct(
        t.lineitem, ["l_orderkey"], {"distinct_qty": F.col("l_quantity")}, {"qty": F.col("l_quantity")}
    )


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
 coalesce(CASE WHEN l_returnflag = 'A' THEN l_quantity END, 0) + coalesce(CASE WHEN l_linestatus = 'O' THEN l_quantity END, 0)
 + coalesce(CASE WHEN l_linenumber > 3 THEN l_quantity END, 0) AS total FROM lineitem
""")
def null_safe_sum_of_columns(t):
    q = F.col("l_quantity")
    parts = [
        F.when(F.col("l_returnflag") == "A", q),
        F.when(F.col("l_linestatus") == "O", q),
        F.when(F.col("l_linenumber") > 3, q),
    ]
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", N.null_safe_sum(parts).alias("total")
    )


@query("""
SELECT o_custkey, string_agg(kind || '-' || n, ', ' ORDER BY kind) AS contacts FROM (
  SELECT o_custkey, o_orderpriority AS kind, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_custkey
""")
def string_agg_labelled(t):
    """Counted per kind first, so a list holds at most one entry per kind."""
    return A.labelled_list(t.orders, ["o_custkey"], "o_orderpriority", F.count("*"), "contacts")


@query("""
SELECT user_id, arg_min(value, ts) FILTER (WHERE event_type = 'purchase') AS first_purchase_value,
  arg_min(event_id, ts) FILTER (WHERE event_type = 'error') AS first_error,
  arg_min(event_type, ts) AS first_type FROM events GROUP BY user_id
""")
def first_per_group(t):
    """First known value of each column per user, by time."""
    df = t.events.select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("first_purchase_value"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("first_error"),
        F.col("event_type").alias("first_type"),
    )
    return A.first_values(
        df, ["user_id"], ["ts", "event_id"], ["first_purchase_value", "first_error", "first_type"]
    )


@query("""
SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem GROUP BY 1, 2, 3
""")
def group_as_distinct(t):
    return A.group_as_distinct(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("""
SELECT last_day(o_orderdate) AS month_end, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size, count(*) AS orders
FROM orders GROUP BY 1, 2
""")
def group_by_expression(t):
    size = F.when(F.col("o_totalprice") >= 250000, "large").otherwise("small")
    return t.orders.groupBy(F.last_day("o_orderdate").alias("month_end"), size.alias("size")).agg(
        F.count("*").alias("orders")
    )


@query("""
SELECT o_orderkey, o_totalprice, (SELECT max(o_totalprice) FROM orders) AS top_price FROM orders
WHERE o_totalprice >= (SELECT max(o_totalprice) FROM orders) * 0.5
""")
def scalar_subquery(t):
    top = t.orders.agg(F.max("o_totalprice").alias("top_price"))
    df = J.with_parameters(t.orders.select("o_orderkey", "o_totalprice"), top)
    return df.filter(F.col("o_totalprice") >= F.col("top_price") * 0.5)


_LATEST = """
SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1
"""


@query(_LATEST.format(cols="o_custkey, o_orderkey, o_totalprice", key="o_custkey", order="o_orderdate DESC, o_orderkey DESC", table="orders"))
def latest_per_key(t):
    return L.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(_LATEST.format(
    cols="o_custkey, o_orderkey, CAST(closed AS DATE) AS closed", key="o_custkey", order="(closed IS NULL), closed DESC, o_orderkey DESC",
    table="(SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed FROM orders)"))
def latest_per_key_nulls_last(t):
    df = t.orders.withColumn("closed", F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")))
    return L.latest_per_key(df, "o_custkey", ["closed", "o_orderkey"]).select("o_custkey", "o_orderkey", "closed")


@query(_LATEST.format(cols="user_id, event_id, event_type", key="user_id", order="ts, event_id", table="events"))
def first_per_key(t):
    return L.first_per_key(t.events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(_LATEST.format(cols="c_mktsegment, c_custkey, c_name", key="c_mktsegment", order="c_custkey", table="customer"))
def any_per_key(t):
    return L.any_per_key(t.customer, "c_mktsegment", ["c_custkey"]).select("c_mktsegment", "c_custkey", "c_name")


@query(_LATEST.format(
    cols="conv_id, turn, role, md5(text) AS text_md5", key="conv_id, role", order="turn DESC", table="conversations"))
def dedupe_by_key(t):
    return L.dedupe_by_key(t.conversations, ["conv_id", "role"], ["turn"]).select(
        "conv_id", "turn", "role", F.md5("text").alias("text_md5")
    )


@query("""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, max(CASE WHEN event_type = 'error' AND value > 40 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS flag FROM events)
WHERE flag = 1 AND NOT (event_type = 'error' AND value > 40)
""")
def group_flag_over(t):
    flag = (F.col("event_type") == "error") & (F.col("value") > 40)
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    return L.keep_flagged_groups(rows, "user_id", flag, drop_flag_rows=True)


@query("""
SELECT o_orderkey, o_custkey, max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS has_large FROM orders
""")
def group_flag_column(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return L.group_flag(rows, "o_custkey", F.col("o_totalprice") > 450000, "has_large").drop("o_totalprice")


@query("""
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
""")
def distinct_rows(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("""
SELECT o_orderkey, 'open' AS branch FROM orders WHERE o_orderstatus = 'O' UNION ALL
SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def union_all(t):
    def branch(cond, name):
        return t.orders.filter(cond).select("o_orderkey", F.lit(name).alias("branch"))

    return U.union_all(branch("o_orderstatus = 'O'", "open"), branch("o_orderpriority = '1-URGENT'", "urgent"))


@query("""
SELECT s_suppkey, s_name, s_nationkey FROM supplier UNION ALL SELECT -1, 'SIN DATO', NULL
""")
def union_constant_row(t):
    return U.union_constant_row(
        t.supplier.select("s_suppkey", "s_name", "s_nationkey"), {"s_suppkey": -1, "s_name": "SIN DATO"}
    )


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM (
  SELECT DISTINCT * FROM orders WHERE o_orderstatus <> 'F' UNION ALL
  SELECT DISTINCT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000 UNION ALL
  SELECT DISTINCT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice <= 300000 AND o_orderpriority < '3' UNION ALL
  SELECT DISTINCT * FROM orders WHERE o_orderpriority = '1-URGENT')) WHERE rn = 1
""")
def overlapping_branch_union(t):
    closed = F.col("o_orderstatus") == "F"
    large = F.col("o_totalprice") > 300000
    branches = [
        ~closed, closed & large, closed & ~large & (F.col("o_orderpriority") < "3"), F.col("o_orderpriority") == "1-URGENT"
    ]
    rows = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return U.overlapping_branches(rows, branches, ["o_custkey", "d"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey
""")
def global_sort(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").orderBy("o_custkey", "o_orderkey")
