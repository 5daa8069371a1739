"""Join shapes on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import predicates as P
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query
from tallyframe.sinks.loads import measured


def branch_hierarchy(t):
    """Region, zone and branch in one table; the jobs share it."""
    zones = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
    joined = t.supplier.join(zones, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    return joined.select(
        F.col("s_suppkey").alias("branch_id"), F.col("s_name").alias("branch"),
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone"),
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"),
    )


@query("""
SELECT s_suppkey AS branch_id, s_name AS branch, n_nationkey AS zone_id, n_name AS zone, r_regionkey AS region_id, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def inner_equi_join_hierarchy(t):
    return branch_hierarchy(t)


@query("""
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def left_equi_join(t):
    return J.lookup(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer, {"o_custkey": "c_custkey"},
        ["c_name", "c_mktsegment"],
    ).drop("o_custkey")


@query("""
SELECT o_orderkey, o_totalprice, c_name AS building_customer FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND c_acctbal > 0
""")
def left_join_filtered_on(t):
    return J.lookup(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer, {"o_custkey": "c_custkey"},
        {"c_name": "building_customer"},
        right_filter=(F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0),
    ).drop("o_custkey")


@query("""
SELECT event_id, user_id, value, c_name FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def left_equi_join_salted(t):
    """Users may be hot: the events of heavy ones spread over salts, and only the customers of these repeat, once per salt."""
    events = t.events.select("event_id", "user_id", "value")
    return J.salted_lookup(events, t.customer.select("c_custkey", "c_name"), {"user_id": "c_custkey"})


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, o_orderstatus, c_name, cn.n_name AS customer_nation,
  cr.r_name AS customer_region, p_brand, s_name, sn.n_name AS supplier_nation, sr.r_name AS supplier_region
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey
""")
def star_denormalize(t):
    """Side tables are widened first while they are small, so the lines meet only four joins."""
    place = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    customer = J.lookup(
        t.customer, place, {"c_nationkey": "n_nationkey"}, {"n_name": "customer_nation", "r_name": "customer_region"}
    )
    supplier = J.lookup(
        t.supplier, place, {"s_nationkey": "n_nationkey"}, {"n_name": "supplier_nation", "r_name": "supplier_region"}
    )
    orders = J.lookup(
        t.orders, customer, {"o_custkey": "c_custkey"}, ["c_name", "customer_nation", "customer_region"]
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return J.star_denormalize(
        lines,
        [
            J.Dimension(t.part, {"l_partkey": "p_partkey"}, ["p_brand"]),
            J.Dimension(supplier, {"l_suppkey": "s_suppkey"}, ["s_name", "supplier_nation", "supplier_region"]),
            J.Dimension(
                orders, {"l_orderkey": "o_orderkey"},
                ["o_orderstatus", "c_name", "customer_nation", "customer_region"],
            ),
        ],
    )


@query("""
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, open_total, closed_total
FROM (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS open_total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) a
FULL JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS closed_total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b
ON a.o_custkey = b.o_custkey
""")
def full_outer_join(t):
    def total(status, name):
        rows = t.orders.filter(F.col("o_orderstatus") == status)
        return rows.groupBy("o_custkey").agg(N.sum_money(F.col("o_totalprice")).alias(name))

    return J.full_outer(total("O", "open_total"), total("F", "closed_total"), ["o_custkey"])


@query("""
SELECT o_orderkey, bank_day, close_day, date_diff('day', CAST(o_orderdate AS DATE), bank_day) AS age
FROM orders CROSS JOIN (SELECT CAST(max(o_orderdate) AS DATE) AS bank_day, CAST(last_day(max(o_orderdate)) AS DATE) AS close_day FROM orders)
""")
def one_row_parameters(t):
    params = t.orders.agg(
        F.to_date(F.max("o_orderdate")).alias("bank_day"), F.last_day(F.max("o_orderdate")).alias("close_day")
    )
    df = J.with_parameters(t.orders.select("o_orderkey", "o_orderdate"), params)
    age = D.days_between(F.col("o_orderdate"), F.col("bank_day"))
    return df.select("o_orderkey", "bank_day", "close_day", age.alias("age"))


@query("""
WITH band AS (SELECT p_brand AS brand, min(p_size) + 10 AS lo, max(p_size) - 10 AS hi FROM part GROUP BY p_brand)
SELECT p_partkey, p_brand, p_size, lo, hi FROM part LEFT JOIN band ON p_brand = brand AND p_size BETWEEN lo AND hi
""")
def theta_range_on(t):
    """An equal key plus a range on the right side."""
    band = t.part.groupBy(F.col("p_brand").alias("brand")).agg(
        (F.min("p_size") + 10).alias("lo"), (F.max("p_size") - 10).alias("hi")
    )
    return J.lookup(
        t.part.select("p_partkey", "p_brand", "p_size"), measured(band), {"p_brand": "brand"}, ["lo", "hi"],
        condition=F.col("p_size").between(F.col("lo"), F.col("hi")),
    )


@query("""
SELECT c_custkey, n_name AS next_nation FROM customer LEFT JOIN nation ON c_nationkey + 1 = n_nationkey
""")
def computed_key_join(t):
    keyed = t.customer.select("c_custkey", (F.col("c_nationkey") + 1).alias("k"))
    return J.lookup(keyed, t.nation, {"k": "n_nationkey"}, {"n_name": "next_nation"}).drop("k")


@query("""
WITH rate AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS y, max(l_tax) AS rate, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT o_orderkey, y AS rate_day, rate, lines FROM orders LEFT JOIN rate ON CAST(date_trunc('year', o_orderdate) AS DATE) = y
""")
def date_key_join(t):
    rate = t.lineitem.groupBy(D.year_start(F.col("l_shipdate")).alias("rate_day")).agg(
        F.max("l_tax").alias("rate"), F.count("*").alias("lines")
    )
    keyed = t.orders.select("o_orderkey", D.year_start(F.col("o_orderdate")).alias("y"))
    return J.lookup(keyed, measured(rate.withColumn("k", F.col("rate_day"))), {"y": "k"}, ["rate_day", "rate", "lines"]).drop("y")


@query("""
SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL
""")
def anti_join_isnull(t):
    return J.anti_join(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"})


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1999-01-01')
""")
def anti_join_not_exists(t):
    recent = t.orders.filter((F.col("o_orderstatus") == "F") & P.since_day("o_orderdate", "1999-01-01"))
    return J.anti_join(t.customer.select("c_custkey", "c_name"), recent, {"c_custkey": "o_custkey"})


@query("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def semi_join_in_subquery(t):
    machinery = t.customer.filter("c_mktsegment = 'MACHINERY'")
    return J.semi_join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), machinery, {"o_custkey": "c_custkey"}
    ).drop("o_custkey")


@query("""
SELECT c_custkey, c_name, last_order, last_price FROM customer LEFT JOIN LATERAL (
  SELECT o_orderkey AS last_order, o_totalprice AS last_price FROM orders
  WHERE o_custkey = c_custkey AND o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) ON true
""")
def apply_top1(t):
    return J.apply_top1(
        t.customer.select("c_custkey", "c_name"), t.orders, {"c_custkey": "o_custkey"}, ["o_orderdate", "o_orderkey"],
        {"o_orderkey": "last_order", "o_totalprice": "last_price"}, F.col("o_orderstatus") == "F",
    )


@query("""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)
  THEN 1 ELSE 0 END AS has_large_urgent FROM customer
""")
def apply_any(t):
    return J.apply_any(
        t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"}, "has_large_urgent",
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000),
    )


@query("""
SELECT c_custkey, n, top_price, max_low, max_high FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top_price,
    max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE 0 END) AS max_low,
    max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice ELSE 0 END) AS max_high
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def apply_aggregate(t):
    def top(priority):
        return F.max(F.when(F.col("o_orderpriority") == priority, F.col("o_totalprice")).otherwise(0.0))

    return J.apply_aggregate(
        t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"},
        {"n": F.count("*"), "top_price": F.max("o_totalprice"), "max_low": top("5-LOW"), "max_high": top("2-HIGH")},
        F.col("o_orderstatus") != "P",
    )


@query("""
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
""")
def apply_rows(t):
    return J.lookup(
        t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"}, ["o_orderkey"],
        right_filter=F.col("o_orderstatus") == "P",
    )


@query("""
SELECT user_id, event_id AS last_purchase, value AS last_value FROM events e
JOIN (SELECT user_id AS u, max(ts) AS m FROM events WHERE event_type = 'purchase' GROUP BY user_id) ON u = user_id AND m = ts
WHERE event_type = 'purchase'
""")
def join_latest_event(t):
    latest = J.latest_event(
        t.events.select("user_id", "event_id", "event_type", "value", "ts"), "user_id",
        F.col("event_type") == "purchase", ["ts", "event_id"],
    )
    return latest.select("user_id", F.col("event_id").alias("last_purchase"), F.col("value").alias("last_value"))


@query("""
SELECT user_id, arg_min(event_type, ts) AS first_event_type, arg_min(value, ts) AS first_value,
  arg_max(event_type, ts) AS last_event_type, arg_max(value, ts) AS last_value FROM events GROUP BY user_id
""")
def join_first_last_state(t):
    return J.first_last_state(t.events, "user_id", ["ts", "event_id"], ["event_type", "value"])


@query("""
WITH first AS (SELECT l_orderkey AS k, min(l_shipdate) AS due FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CAST(due AS DATE) AS first_due, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS instalment, count(*) AS lines
FROM lineitem JOIN first ON k = l_orderkey AND due = l_shipdate GROUP BY l_orderkey, due
""")
def self_join_min_due(t):
    first = J.first_due(
        t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice"), "l_orderkey", "l_shipdate",
        {"instalment": N.sum_money(F.col("l_extendedprice")), "lines": F.count("*")},
    )
    return first.select("l_orderkey", F.to_date("l_shipdate").alias("first_due"), "instalment", "lines")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
JOIN (SELECT l_orderkey AS k, max(l_shipdate) AS m FROM lineitem GROUP BY l_orderkey) ON k = l_orderkey AND m = l_shipdate
""")
def join_back_max_group(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return L.keep_max_group(lines, "l_orderkey", "l_shipdate").drop("l_shipdate")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
JOIN (SELECT o_custkey AS k, max(CAST(o_orderdate AS DATE)) AS m, min(o_orderstatus) AS s FROM orders GROUP BY 1)
ON k = o_custkey AND CAST(o_orderdate AS DATE) = m AND o_orderstatus = s
""")
def join_back_two_extremes(t):
    """Newest date and lowest status of the customer at once; some customers keep none."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"))
    return L.keep_group_extremes(rows, "o_custkey", maxima=["d"], minima=["o_orderstatus"]).drop("d")


@query("""
WITH recent AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-14'),
new AS (SELECT user_id AS u, count(*) AS replacements FROM recent WHERE event_type = 'signup' GROUP BY user_id)
SELECT event_id, user_id, value, 'original' AS side, coalesce(replacements, 0) AS replacements
FROM recent LEFT JOIN new ON u = user_id WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, user_id, value, 'replacement', replacements FROM recent JOIN new ON u = user_id
WHERE event_type = 'signup' AND user_id IN (SELECT user_id FROM recent WHERE event_type = 'purchase')
""")
def same_table_event_pair(t):
    recent = P.filter_recent_days(t.events, "ts", EVENTS_AS_OF, 2).select("event_id", "user_id", "event_type", "value")
    pairs = J.event_pairs(recent, "user_id", F.col("event_type") == "purchase", F.col("event_type") == "signup", {"replacements": F.count("*")})
    many = N.null_default(F.col("replacements"), 0).alias("replacements")
    return pairs.select("event_id", "user_id", "value", "side", many)


@query("""
SELECT o_orderkey, priority, amount FROM (
  SELECT o_orderkey, upper(substring(o_orderpriority, 3)) AS priority, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS amount
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-30'
  UNION ALL
  SELECT o_orderkey, upper(substring(o_orderpriority, 3)), CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-30')
""")
def history_plus_online(t):
    def movements(df):
        signed = N.sign_by(F.col("o_totalprice"), F.col("o_orderstatus") == "F")
        return df.select("o_orderkey", F.upper(F.expr("substring(o_orderpriority, 3)")).alias("priority"), signed.alias("amount"))

    history = t.orders.filter(P.before_day("o_orderdate", ORDERS_AS_OF))
    online = t.orders.filter(P.since_day("o_orderdate", ORDERS_AS_OF))
    return J.history_plus_online(history, online, movements)
