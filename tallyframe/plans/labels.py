"""Classifiers on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.operators import classify as K
from tallyframe.operators import joins as J
from tallyframe.operators import predicates as P
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query
from tallyframe.sinks.loads import measured


def _aging_sql(amount: str, days: str) -> str:
    """Expected bucket sums, one CASE per band."""
    out = []
    for name, low, high in K.AGING_BANDS:
        cond = f"{days} >= {low}" if high is None else f"{days} BETWEEN {low} AND {high}"
        out.append(
            f"CAST(sum(CAST(CASE WHEN {cond} THEN {amount} ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS {name}"
        )
    return ",\n".join(out)


@query(f"""
SELECT n_name, c_mktsegment, count(*) AS orders, {_aging_sql('o_totalprice', 'dpd')}
FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') AS dpd FROM orders WHERE o_orderstatus = 'O')
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, c_mktsegment
""")
def open_order_aging(t):
    """Open balances by days past due, per nation and segment.

    Aging columns are summed per customer before the customer is looked up, so only one
    row per customer meets the join and a customer with many orders is no hot key.
    """
    open_orders = t.orders.filter("o_orderstatus = 'O'").select(
        "o_custkey", N.money(F.col("o_totalprice")).alias("o_totalprice"),
        D.days_between(F.col("o_orderdate"), D.run_date(ORDERS_AS_OF)).alias("dpd"),
    )
    aged = K.aging_buckets(open_orders, "dpd", "o_totalprice")
    bands = [name for name, _, _ in K.AGING_BANDS]
    per_customer = aged.groupBy("o_custkey").agg(
        F.count("*").alias("n"), *[F.sum(b).alias(b) for b in bands]
    )
    named = J.lookup(per_customer, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey", "c_mktsegment"])
    named = J.lookup(named, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    return named.groupBy("n_name", "c_mktsegment").agg(
        F.sum("n").alias("orders"), *[F.sum(b).cast("double").alias(b) for b in bands]
    )


@query(f"""
SELECT o_orderkey, {', '.join(
    f"CASE WHEN dpd {'>= ' + str(lo) if hi is None else f'BETWEEN {lo} AND {hi}'} THEN o_totalprice ELSE 0 END AS {name}"
    for name, lo, hi in K.AGING_BANDS)}
FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') AS dpd FROM orders)
""")
def aging_buckets(t):
    df = t.orders.select(
        "o_orderkey", "o_totalprice",
        D.days_between(F.col("o_orderdate"), D.run_date(ORDERS_AS_OF)).alias("dpd"),
    )
    return K.aging_buckets(df, "dpd", "o_totalprice").drop("o_totalprice", "dpd")


@query(f"""
SELECT o_orderkey, CASE WHEN opened = closed THEN 'Desembolsado y Cancelado el Mismo Dia'
  WHEN last_day(opened) = last_day(closed) THEN 'Desembolsado y Cancelado el Mismo Mes'
  WHEN closed IS NULL THEN 'Desembolso No Cancelado' WHEN closed > DATE '{ORDERS_AS_OF}' THEN 'Desembolso Cancelado Posterior a la Fecha de Consulta' END AS label
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS opened, last_ship AS closed FROM orders
      LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY l_orderkey)
      ON l_orderkey = o_orderkey)
""")
def lifecycle_label(t):
    last = t.lineitem.groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("closed"))
    df = J.lookup(t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("opened")), last, {"o_orderkey": "l_orderkey"})
    return df.select("o_orderkey", K.lifecycle_label(F.col("opened"), F.col("closed"), ORDERS_AS_OF).alias("label"))


@query(f"""
SELECT c_custkey, CAST(latest AS DATE) AS updated,
  CASE WHEN date_diff('day', CAST(latest AS DATE), DATE '{ORDERS_AS_OF}') > 365 THEN 'Desactualizado' ELSE 'Actualizado' END AS label
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS latest FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{ORDERS_AS_OF}' GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def freshness_label(t):
    past = t.orders.filter((F.col("o_orderstatus") == "F") & P.before_day("o_orderdate", ORDERS_AS_OF))
    latest = past.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("updated"))
    df = J.lookup(t.customer.select("c_custkey"), latest, {"c_custkey": "o_custkey"})
    return df.select("*", K.freshness_label(F.col("updated"), ORDERS_AS_OF).alias("label"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
  CASE l_returnflag WHEN 'A' THEN 'ACTIVO' WHEN 'N' THEN 'NUEVO' ELSE 'OTRO' END AS estado,
  CASE l_linestatus WHEN 'O' THEN 'RURAL' WHEN 'F' THEN 'URBANO' END AS zona
FROM lineitem
""")
def code_to_label(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        K.code_to_label(F.col("l_returnflag"), {"A": "ACTIVO", "N": "NUEVO"}, "OTRO").alias("estado"),
        K.code_to_label(F.col("l_linestatus"), {"O": "RURAL", "F": "URBANO"}).alias("zona"),
    )


@query("""
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O'
  AND o_orderdate >= TIMESTAMP '2001-06-01') THEN 'SI' ELSE 'NO' END AS con_pendientes FROM customer
""")
def flag_exists(t):
    recent = (F.col("o_orderstatus") == "O") & P.since_day("o_orderdate", "2001-06-01")
    hit = J.apply_any(t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"}, "hit", recent)
    return hit.select("c_custkey", K.yes_no(F.col("hit") == 1).alias("con_pendientes"))


@query("""
WITH wage AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS y, CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) + 100000 AS w FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice >= w * 0 AND o_totalprice <= w * 1 THEN 1 ELSE 0 END AS seg_small,
  CASE WHEN o_orderstatus = 'O' AND o_totalprice > w * 1 AND o_totalprice <= w * 2.5 THEN 1 ELSE 0 END AS seg_medium,
  CASE WHEN o_totalprice > w * 2.5 AND o_totalprice <= w * 100 THEN 1 ELSE 0 END AS seg_large
FROM orders LEFT JOIN wage ON y = CAST(date_trunc('year', o_orderdate) AS DATE)
""")
def threshold_segment_by_year(t):
    """The yearly wage is joined on 1 January of the row's date."""
    keyed = t.orders.withColumn("y", D.year_start(F.col("o_orderdate")))
    wage = keyed.groupBy("y").agg((F.min(N.money(F.col("o_totalprice"))).cast("double") + 100000).alias("w"))
    df = J.lookup(keyed, measured(wage), "y")
    is_open = F.col("o_orderstatus") == "O"
    segments = [
        K.Segment("seg_small", F.lit(0), F.lit(1), when=is_open),
        K.Segment("seg_medium", F.lit(1), F.lit(2.5), low_open=True, when=is_open),
        K.Segment("seg_large", F.lit(2.5), F.lit(100), low_open=True),
    ]
    return df.select("o_orderkey", *K.threshold_segments(F.col("o_totalprice"), F.col("w"), segments))


@query("""
SELECT l_orderkey, l_partkey, l_extendedprice,
  CASE WHEN l_discount IS NULL OR l_discount = 0 THEN l_tax ELSE l_discount END AS tasa_actual
FROM lineitem
""")
def fallback_if_zero(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_extendedprice",
        N.fallback_if_zero(F.col("l_discount"), F.col("l_tax")).alias("tasa_actual"),
    )


@query("""
SELECT event_id, CASE WHEN month(ts) = 1 AND event_type IN ('click', 'view') THEN coalesce(p.first_id, 0)
   WHEN month(ts) = 1 AND event_type = 'error' THEN coalesce(s.first_id, 0) ELSE event_id END AS routed
FROM events e
LEFT JOIN (SELECT user_id, min(event_id) AS first_id FROM events WHERE event_type = 'purchase' GROUP BY user_id) p ON p.user_id = e.user_id
LEFT JOIN (SELECT user_id, min(event_id) AS first_id FROM events WHERE event_type = 'signup' GROUP BY user_id) s ON s.user_id = e.user_id
""")
def transaction_router(t):
    """Two alternatives are looked up; the code pair decides which one counts."""
    firsts = t.events.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("bought"),
        F.min(F.when(F.col("event_type") == "signup", F.col("event_id"))).alias("signed"),
    )
    df = J.lookup(t.events.select("event_id", "user_id", "event_type", F.month("ts").alias("module")), firsts, "user_id")
    routes = [
        K.Route(1, ("click", "view"), F.coalesce("bought", F.lit(0))),
        K.Route(1, ("error",), F.coalesce("signed", F.lit(0))),
    ]
    routed = K.transaction_router(F.col("module"), F.col("event_type"), routes, F.col("event_id"))
    return df.select("event_id", routed.alias("routed"))


@query("""
SELECT c_custkey, CASE WHEN agente IS NULL OR TRY_CAST(agente AS DOUBLE) IS NOT NULL THEN n_name ELSE agente END AS nombre
FROM (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS VARCHAR)
  WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_name END AS agente FROM customer)
LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def name_fallback_if_numeric(t):
    agent = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string"))
        .when(F.col("c_mktsegment") != "FURNITURE", F.col("c_name"))
    )
    df = J.lookup(t.customer.withColumn("agente", agent), t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    return df.select("c_custkey", K.name_fallback_if_numeric(F.col("agente"), F.col("n_name")).alias("nombre"))
