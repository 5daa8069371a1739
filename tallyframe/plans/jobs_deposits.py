"""Deposit, savings and insurance jobs on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.operators import classify as K
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import predicates as P
from tallyframe.operators import sides as G
from tallyframe.plans.jobs_credit import customer_places
from tallyframe.plans.joining import branch_hierarchy
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query


@query("""
WITH flagged AS (SELECT *, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS flag
  FROM events WHERE ts >= TIMESTAMP '2024-01-14' AND event_type IN ('purchase', 'error')),
renewed AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-14' AND event_type = 'signup'),
new AS (SELECT user_id AS u, count(*) AS nuevas, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS capital_total FROM renewed GROUP BY user_id)
SELECT user_id AS cuenta, 'original' AS lado, event_id AS operacion, value AS capital, CAST(ts AS DATE) AS fecha, coalesce(nuevas, 0) AS nuevas, capital_total
FROM flagged LEFT JOIN new ON u = user_id WHERE flag = 1 AND event_type <> 'error'
UNION ALL
SELECT user_id, 'replacement', event_id, value, CAST(ts AS DATE), nuevas, capital_total FROM renewed JOIN new ON u = user_id
WHERE user_id IN (SELECT user_id FROM flagged WHERE flag = 1 AND event_type <> 'error')
""")
def job_deposit_renewals(t):
    """Original deposits of flagged accounts of the last two days, and every renewal of those accounts."""
    recent = P.filter_recent_days(t.events, "ts", EVENTS_AS_OF, 2).select("user_id", "event_id", "event_type", "value", "ts")
    ledger = recent.filter(F.col("event_type").isin("purchase", "error"))
    originals = L.keep_flagged_groups(ledger, "user_id", F.col("event_type") == "error", drop_flag_rows=True)
    both = originals.unionByName(recent.filter("event_type = 'signup'"))
    pairs = J.event_pairs(
        both, "user_id", F.col("event_type") == "purchase", F.col("event_type") == "signup",
        {"nuevas": F.count("*"), "capital_total": N.sum_money(F.col("value"))},
    )
    return pairs.select(
        F.col("user_id").alias("cuenta"), F.col("side").alias("lado"), F.col("event_id").alias("operacion"), F.col("value").alias("capital"),
        F.to_date("ts").alias("fecha"), N.null_default(F.col("nuevas"), 0).alias("nuevas"), "capital_total",
    )


# Payment modes of a deposit by its period in days.
DEPOSIT_MODES = {
    0: "Cuota única", 30: "Mensual", 60: "Bimensual", 90: "Trimestral", 180: "Semestral", 360: "Anual",
}
DEPOSIT_MODE_UNKNOWN = "Desconocido"


@query("""
SELECT l_orderkey, l_partkey, l_extendedprice AS valor, CASE WHEN s_name IS NULL OR TRY_CAST(s_name AS DOUBLE) IS NOT NULL THEN zone ELSE s_name END AS nombre_suc,
  CASE WHEN l_suppkey = 7 THEN 'Cartagena' ELSE zone END AS sucursal, CASE WHEN l_suppkey = 7 THEN 103 ELSE l_suppkey END AS codigo_sucursal,
  coalesce(s_acct, l_suppkey) AS asesor, p_type AS producto,
  CASE (l_linenumber - 1) * 30 WHEN 0 THEN 'Cuota única' WHEN 30 THEN 'Mensual' WHEN 60 THEN 'Bimensual' WHEN 90 THEN 'Trimestral' WHEN 180 THEN 'Semestral' ELSE 'Desconocido' END AS modalidad,
  adviser_region, p_brand AS marca, o_orderstatus AS estado, c_name AS titular, c_mktsegment AS segmento, titular_zone, titular_region, first_day AS apertura, last_day AS vencimiento, titles AS titulos, coalesce(renewed, false) AS renovado, last_contact, contacts
FROM lineitem LEFT JOIN (SELECT l_orderkey AS dk, CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day, count(*) AS titles, bool_or(l_returnflag = 'R') AS renewed FROM lineitem GROUP BY 1) ON dk = l_orderkey
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN (SELECT c_custkey, c_name, c_mktsegment, n_name AS titular_zone, r_name AS titular_region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey) ON c_custkey = o_custkey
LEFT JOIN (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_contact, count(*) AS contacts FROM events GROUP BY 1) ON user_id = o_custkey
LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN CAST(s_suppkey AS VARCHAR) WHEN s_acctbal > 1000 THEN s_name END AS s_name,
   CASE WHEN s_acctbal > 1000 THEN s_suppkey + 1000 END AS s_acct, n_name AS zone, r_name AS adviser_region FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey) ON l_suppkey = s_suppkey
LEFT JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'N') AND l_linestatus <> 'F' AND l_discount <> l_tax
""")
def job_deposits_by_day(t):
    """Open deposits with adviser, office, payment mode, holder and history; one office is booked elsewhere.

    The holder's row is put together from the contract, the customer, its place and its contacts before the deposits meet it, and what all
    titles of a contract say is one side.
    """
    balance = F.col("s_acctbal")
    advisers = t.supplier.select(
        "s_suppkey", "s_nationkey",
        F.when(balance > 5000, F.col("s_suppkey").cast("string")).when(balance > 1000, F.col("s_name")).alias("agent"),
        F.when(balance > 1000, F.col("s_suppkey") + 1000).alias("agent_id"),
    )
    places = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    advisers = J.lookup(advisers, places, {"s_nationkey": "n_nationkey"}, {"n_name": "zone", "r_name": "adviser_region"})
    holders = J.lookup(t.customer, places, {"c_nationkey": "n_nationkey"}, {"n_name": "titular_zone", "r_name": "titular_region"})
    event, order = {"c_custkey": "user_id"}, [F.col("ts"), F.col("event_id")]
    holders = G.gather(holders, {"events": t.events}, [G.Side("events", event, G.Pick({"last_contact": F.col("event_type")}, order)), G.Side("events", event, G.Value("contacts", "count"))])
    contracts = J.lookup(
        t.orders, holders, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "titular_zone", "titular_region", "last_contact", "contacts"],
    )
    contract, day = {"o_orderkey": "l_orderkey"}, F.to_date("l_shipdate")
    sides = [
        G.Side("titles", contract, G.Value("first_day", "min", day)), G.Side("titles", contract, G.Value("last_day", "max", day)),
        G.Side("titles", contract, G.Value("titles", "count")), G.Side("titles", contract, G.Value("renewed", "exists"), F.col("l_returnflag") == "R"),
    ]
    contracts = G.gather(contracts, {"titles": t.lineitem}, sides)
    rows = t.lineitem.filter(
        F.col("l_returnflag").isin("A", "N") & (F.col("l_linestatus") != "F") & (F.col("l_discount") != F.col("l_tax"))
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    df = J.star_denormalize(
        rows,
        [
            J.Dimension(advisers, {"l_suppkey": "s_suppkey"}, ["agent", "agent_id", "zone", "adviser_region"]),
            J.Dimension(t.part, {"l_partkey": "p_partkey"}, ["p_type", "p_brand"]),
            J.Dimension(
                contracts, {"l_orderkey": "o_orderkey"},
                ["o_orderstatus", "c_name", "c_mktsegment", "titular_zone", "titular_region", "first_day", "last_day", "titles", "renewed", "last_contact", "contacts"],
            ),
        ],
    )
    moved = F.col("l_suppkey") == 7
    period = (F.col("l_linenumber") - 1) * 30
    return df.select(
        "l_orderkey", "l_partkey", F.col("l_extendedprice").alias("valor"),
        K.name_fallback_if_numeric(F.col("agent"), F.col("zone")).alias("nombre_suc"),
        F.when(moved, "Cartagena").otherwise(F.col("zone")).alias("sucursal"),
        F.when(moved, F.lit(103).cast("long")).otherwise(F.col("l_suppkey")).alias("codigo_sucursal"),
        F.coalesce("agent_id", "l_suppkey").alias("asesor"), F.col("p_type").alias("producto"),
        K.code_to_label(period, DEPOSIT_MODES, DEPOSIT_MODE_UNKNOWN).alias("modalidad"), "adviser_region", F.col("p_brand").alias("marca"),
        F.col("o_orderstatus").alias("estado"), F.col("c_name").alias("titular"), F.col("c_mktsegment").alias("segmento"), "titular_zone", "titular_region",
        F.col("first_day").alias("apertura"), F.col("last_day").alias("vencimiento"), F.col("titles").alias("titulos"), F.coalesce("renewed", F.lit(False)).alias("renovado"),
        "last_contact", F.when(F.col("contacts") > 0, F.col("contacts")).alias("contacts"),
    )


@query(f"""
SELECT c_custkey AS documento, l_orderkey AS numeroproducto, DATE '2000-06-29' AS fecha_corte FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey WHERE l_linenumber IN (1, 2, 3) AND c_mktsegment <> 'FURNITURE' AND o_orderstatus <> 'F' AND l_shipdate <> o_orderdate
""")
def job_deposit_clients(t):
    rows = t.lineitem.filter(F.col("l_linenumber").isin(1, 2, 3)).select("l_orderkey", "l_shipdate")
    known = J.lookup(
        t.orders.filter("o_orderstatus <> 'F'"), t.customer.filter("c_mktsegment <> 'FURNITURE'"),
        {"o_custkey": "c_custkey"}, {"c_mktsegment": "segment"}, how="inner",
    )
    df = J.lookup(rows, known, {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderdate"], how="inner")
    return df.filter(F.col("l_shipdate") != F.col("o_orderdate")).select(
        F.col("o_custkey").alias("documento"), F.col("l_orderkey").alias("numeroproducto"),
        F.lit(D.yesterday(ORDERS_AS_OF)).alias("fecha_corte"),
    )


@query(f"""
WITH pol AS (SELECT *, CAST(o_orderdate AS DATE) AS s, CAST(CAST(o_orderdate AS DATE) + to_months(CAST(12 + o_custkey % 36 AS INTEGER)) AS DATE) AS e,
  DATE '1960-01-01' + CAST(o_custkey % 14000 AS INTEGER) AS birth FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW')),
calc AS (SELECT *, date_diff('month', s, e) AS term, CASE WHEN DATE '{ORDERS_AS_OF}' >= e THEN 0 ELSE
  (2 * date_diff('day', DATE '{ORDERS_AS_OF}', e) * date_diff('month', s, e) + date_diff('day', s, e)) // (2 * date_diff('day', s, e)) END AS rest FROM pol)
SELECT o_orderkey AS poliza, c_name AS asegurado, n_name AS zona, r_name AS region, s AS fecha_inicio, e AS fecha_fin,
  CASE WHEN date_diff('day', birth, s) / 365.25 < 10 OR date_diff('day', birth, s) / 365.25 > 100 THEN 18.0 ELSE date_diff('day', birth, s) / 365.25 END AS edad_inicio,
  term AS plazo_inicial_m, rest AS plazo_restante, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * rest AS DOUBLE) AS valor_reintegrar
FROM calc LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def job_insurance_refunds(t):
    """Remaining term and refund of each policy at the run date."""
    start = F.to_date("o_orderdate")
    policies = P.filter_in_list(t.orders, "o_orderpriority", ["1-URGENT", "3-MEDIUM", "5-LOW"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", start.alias("s"),
        F.add_months(start, (12 + F.col("o_custkey") % 36).cast("int")).alias("e"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("o_custkey") % 14000).cast("int")).alias("birth"),
    )
    df = J.lookup(policies, customer_places(t), {"o_custkey": "c_custkey"}, ["c_name", "zone", "region"])
    rest = D.prorated_remaining(F.col("s"), F.col("e"), ORDERS_AS_OF)
    return df.select(
        F.col("o_orderkey").alias("poliza"), F.col("c_name").alias("asegurado"), F.col("zone").alias("zona"), "region",
        F.col("s").alias("fecha_inicio"), F.col("e").alias("fecha_fin"),
        D.age_years_decimal(F.col("birth"), F.col("s")).alias("edad_inicio"),
        D.month_boundaries(F.col("s"), F.col("e")).alias("plazo_inicial_m"), rest.alias("plazo_restante"),
        (N.money(F.col("o_totalprice")) * rest).cast("double").alias("valor_reintegrar"),
    )


@query("""
WITH agent AS (SELECT user_id, event_id AS agent_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'view') WHERE rn = 1)
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_custkey AS VARCHAR) || '0' ELSE CAST(o_orderkey AS VARCHAR) END AS numero_producto,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha_adjudicado, coalesce(agent_id, o_custkey) AS asesor,
  coalesce(trim(n_name), '') AS departamento, c_name AS nombre_cliente, o_totalprice AS valor
FROM orders LEFT JOIN agent ON user_id = o_custkey LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0 LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderpriority <> '5-LOW'
""")
def job_savings_balances(t):
    """The business-day branch of the savings snapshot: one row per open account."""
    agents = L.latest_per_key(
        t.events.filter("event_type <> 'view'").select("user_id", "event_id"), "user_id", ["event_id"]
    )
    holders = J.lookup(t.customer.filter("c_acctbal >= 0"), t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    df = J.star_denormalize(
        t.orders.filter("o_orderpriority <> '5-LOW'"),
        [
            J.Dimension(agents, {"o_custkey": "user_id"}, {"event_id": "agent_id"}),
            J.Dimension(holders, {"o_custkey": "c_custkey"}, ["c_name", "n_name"]),
        ],
    )
    granted = F.when(F.col("o_orderstatus") == "O", F.lit("1753-01-01").cast("date")).otherwise(F.to_date("o_orderdate"))
    number = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.col("o_custkey"), F.lit("0"))).otherwise(F.col("o_orderkey").cast("string"))
    return df.select(
        "o_orderkey", number.alias("numero_producto"), D.sentinel_to_null(granted).alias("fecha_adjudicado"),
        F.coalesce("agent_id", "o_custkey").alias("asesor"), N.null_default(F.trim("n_name"), "").alias("departamento"),
        F.col("c_name").alias("nombre_cliente"), F.col("o_totalprice").alias("valor"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_extendedprice, branch, zone, region, coalesce(p_name, p_brand) AS product FROM lineitem
LEFT JOIN (SELECT s_suppkey, s_name AS branch, n_name AS zone, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON s_suppkey = l_suppkey
LEFT JOIN (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS p_name, p_brand FROM part) ON p_partkey = l_partkey
WHERE l_linestatus = 'O' AND l_returnflag = 'N'
""")
def job_deposit_history(t):
    """Snapshot of the open deposits with the branch hierarchy."""
    rows = t.lineitem.filter("l_linestatus = 'O' AND l_returnflag = 'N'").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    parts = t.part.select("p_partkey", F.coalesce(F.when(F.col("p_size") > 10, F.col("p_name")), "p_brand").alias("product"))
    df = J.star_denormalize(
        rows,
        [
            J.Dimension(branch_hierarchy(t), {"l_suppkey": "branch_id"}, ["branch", "zone", "region"]),
            J.Dimension(parts, {"l_partkey": "p_partkey"}, ["product"]),
        ],
    )
    return df.drop("l_suppkey")
