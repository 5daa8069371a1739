"""Credit jobs: orders stand for credit operations, lines for movements and instalments,
events for the adviser and event history of an account."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.operators import aggregates as A
from tallyframe.operators import classify as K
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import predicates as P
from tallyframe.operators import sides as S
from tallyframe.operators import unions as U
from tallyframe.plans.registry import ORDERS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sinks.loads import measured, publish

MONEY_SUM = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def customer_places(t):
    """Customers with their zone and region."""
    zones = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, {"r_name": "region"})
    return J.lookup(t.customer, zones, {"c_nationkey": "n_nationkey"}, {"n_name": "zone", "region": "region"})


_PLACES_SQL = """places AS (SELECT c.*, n_name AS zone, r_name AS region FROM customer c
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


@query(f"""
WITH {_PLACES_SQL},
ops AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders
   WHERE o_orderstatus <> 'F' OR o_totalprice > 50000 OR o_orderpriority < '3') WHERE rn = 1),
moves AS (SELECT l_orderkey AS k, CAST(min(l_shipdate) AS DATE) AS first_move, CAST(max(l_shipdate) AS DATE) AS last_move FROM lineitem
   WHERE l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 2 AND 49 GROUP BY l_orderkey),
due AS (SELECT l_orderkey AS k, min(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey),
quota AS (SELECT l_orderkey AS k, {MONEY_SUM.format('l_extendedprice')} AS quota_capital,
   CAST(sum(DISTINCT CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS quota_tax,
   CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS quota_insurance
   FROM lineitem JOIN due ON due.k = l_orderkey AND d = l_shipdate GROUP BY l_orderkey),
warranty AS (SELECT l_orderkey AS k, max(p_type) AS warranty FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size BETWEEN 11 AND 24 GROUP BY l_orderkey),
advisers AS (SELECT user_id, arg_min(event_type, ts) AS first_adviser, arg_max(event_type, ts) AS last_adviser FROM events GROUP BY user_id),
base AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS opened, o_totalprice, c_name, c_mktsegment, zone, region, first_move,
   CASE WHEN o_orderstatus = 'F' THEN last_move END AS closed, last_move, quota_capital, quota_tax, quota_insurance, warranty, first_adviser, last_adviser
   FROM ops LEFT JOIN moves ON moves.k = o_orderkey LEFT JOIN quota ON quota.k = o_orderkey LEFT JOIN warranty ON warranty.k = o_orderkey
   LEFT JOIN places ON o_custkey = c_custkey LEFT JOIN advisers ON user_id = o_custkey)
SELECT o_orderkey, o_custkey, opened, o_totalprice AS initial_debt, c_name, zone, region, first_move, closed,
  date_diff('day', opened, last_move) AS term_days, CASE WHEN last_move IS NOT NULL THEN CAST(trunc(date_diff('day', opened, last_move) / 30) AS BIGINT) END AS term_months,
  last_day(first_move) AS ledger_month, quota_capital, quota_tax, quota_insurance, coalesce(warranty, '**SIN GARANTIA**') AS warranty,
  coalesce(first_adviser, c_mktsegment) AS first_adviser, coalesce(last_adviser, c_mktsegment) AS last_adviser,
  CASE WHEN opened = closed THEN 'Desembolsado y Cancelado el Mismo Dia' WHEN last_day(opened) = last_day(closed) THEN 'Desembolsado y Cancelado el Mismo Mes'
   WHEN closed IS NULL THEN 'Desembolso No Cancelado' WHEN closed > DATE '{ORDERS_AS_OF}' THEN 'Desembolso Cancelado Posterior a la Fecha de Consulta' END AS mark,
  CASE WHEN opened = closed OR last_day(opened) = last_day(closed) THEN 'No Activo' WHEN closed IS NULL OR closed > DATE '{ORDERS_AS_OF}' THEN 'Activo' END AS active
FROM base
""")
def job_loan_originations(t):
    """Loads ``loan_originations`` as a day's snapshot and a dated CSV, and returns the day read back."""
    return publish(loan_originations(t), new_table_path(t.spark, "loan_originations"), ORDERS_AS_OF)


def loan_originations(t):
    """Each side is reduced to one row per operation before it meets the operations."""
    closed_status = F.col("o_orderstatus") == "F"
    ops = U.overlapping_branches(
        t.orders,
        [~closed_status, closed_status & (F.col("o_totalprice") > 50000), closed_status & (F.col("o_orderpriority") < "3"),
         F.col("o_orderpriority") < "3"],
        ["o_custkey", "o_orderdate"], ["o_orderkey"],
    )
    lines = t.lineitem
    moved = F.when(F.col("l_returnflag").isin("A", "N") & F.col("l_quantity").between(2, 49), F.col("l_shipdate"))
    quota = J.first_due(
        lines.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_tax", "l_returnflag", "l_quantity"),
        "l_orderkey", "l_shipdate",
        {
            "quota_capital": N.sum_money(F.col("l_extendedprice")),
            "quota_tax": F.sum_distinct(N.money(F.col("l_tax"))).cast("double"),
            "quota_insurance": N.sum_money(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)),
        },
        {"first_move": (F.to_date(F.min(moved)), F.min), "last_move": (F.to_date(F.max(moved)), F.max)},
    ).drop("l_shipdate")
    listed = t.part.filter(F.col("p_size").between(11, 24)).select("p_partkey", "p_type")
    warranty = J.lookup(
        lines.select("l_orderkey", "l_partkey"), listed, {"l_partkey": "p_partkey"}, ["p_type"], how="inner"
    ).groupBy("l_orderkey").agg(F.max("p_type").alias("warranty"))
    advisers = J.first_last_state(t.events, "user_id", ["ts", "event_id"], ["event_type"])
    df = J.star_denormalize(
        ops,
        [
            J.Dimension(quota, {"o_orderkey": "l_orderkey"}, ["first_move", "last_move", "quota_capital", "quota_tax", "quota_insurance"]),
            J.Dimension(warranty, {"o_orderkey": "l_orderkey"}, ["warranty"]),
            J.Dimension(customer_places(t), {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "zone", "region"]),
            J.Dimension(
                advisers, {"o_custkey": "user_id"},
                {"first_event_type": "first_adviser", "last_event_type": "last_adviser"},
            ),
        ],
    )
    df = df.withColumns({"opened": F.to_date("o_orderdate"), "closed": F.when(closed_status, F.col("last_move"))})
    opened, closed = F.col("opened"), F.col("closed")
    term = D.days_between(opened, F.col("last_move"))
    return df.select(
        "o_orderkey", "o_custkey", "opened", F.col("o_totalprice").alias("initial_debt"), "c_name", "zone", "region",
        "first_move", "closed", term.alias("term_days"), N.integer_division(term, 30).alias("term_months"),
        D.month_end(F.col("first_move")).alias("ledger_month"), "quota_capital", "quota_tax", "quota_insurance",
        N.null_default(F.col("warranty"), "**SIN GARANTIA**").alias("warranty"),
        F.coalesce("first_adviser", "c_mktsegment").alias("first_adviser"),
        F.coalesce("last_adviser", "c_mktsegment").alias("last_adviser"),
        K.lifecycle_label(opened, closed, ORDERS_AS_OF).alias("mark"),
        K.lifecycle_label(opened, closed, ORDERS_AS_OF, K.ACTIVITY_LABELS).alias("active"),
    )


# Movement kinds of the stand-in ledger, by line number.
COLLECTION_KINDS = {"capital": (1, 2), "interest": (3,), "insurance": (4,), "fee": (5,), "vat": (6,), "other": (7,)}

_KIND_SQL = ",\n".join(
    MONEY_SUM.format(f"CASE WHEN l_linenumber IN ({', '.join(map(str, lines))}) THEN amount ELSE 0 END") + f" AS {name}"
    for name, lines in COLLECTION_KINDS.items()
)


@query(f"""
WITH {_PLACES_SQL},
moves AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '2000-06-01' AND l_shipdate < TIMESTAMP '2000-06-30' AND l_suppkey <> 99)
SELECT DATE '2000-06-29' AS cut_date, o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'MICROCREDITO' WHEN 'F' THEN 'COMERCIAL' ELSE '' END AS portfolio,
  c_name, zone, region, CAST(l_shipdate AS DATE) AS paid_on, upper(trim(o_orderpriority)) AS kind_of_payment, {_KIND_SQL},
  {MONEY_SUM.format('amount')} AS total,
  {MONEY_SUM.format("CASE WHEN l_linenumber = 7 AND l_tax > 0.04 THEN -amount ELSE 0 END")} AS waived
FROM moves JOIN orders ON l_orderkey = o_orderkey LEFT JOIN places ON o_custkey = c_custkey
GROUP BY o_orderkey, o_orderstatus, c_name, zone, region, l_shipdate, o_orderpriority
""")
def job_collections_mtd(t):
    """Loads ``collections_mtd`` as a day's snapshot and a dated CSV, and returns the day read back."""
    return publish(collections_mtd(t), new_table_path(t.spark, "collections_mtd"), ORDERS_AS_OF)


def collections_mtd(t):
    """Month-to-date collections from the history and today's ledger, per credit and day.

    The movements are summed per credit and day before the credit's data is looked up.
    """

    def movements(ledger):
        rows = P.filter_month_to_date(ledger, "l_shipdate", ORDERS_AS_OF).filter("l_suppkey <> 99")
        amount = N.sign_by(N.money(F.col("l_extendedprice")), F.col("l_returnflag") == "R")
        return rows.select("l_orderkey", "l_shipdate", "l_linenumber", "l_tax", amount.alias("amount"))

    both = J.history_plus_online(
        t.lineitem.filter("l_linestatus = 'F'"), t.lineitem.filter("l_linestatus = 'O'"), movements
    )
    amount, line = F.col("amount"), F.col("l_linenumber")
    summed = both.groupBy("l_orderkey", "l_shipdate").agg(
        *A.conditional_sums(amount, {name: line.isin(*lines) for name, lines in COLLECTION_KINDS.items()}),
        N.sum_money(amount).alias("total"),
        *A.conditional_sums(-amount, {"waived": (line == 7) & (F.col("l_tax") > 0.04)}),
    )
    df = J.lookup(
        summed, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderstatus", "o_orderpriority"], how="inner"
    )
    df = J.lookup(df, customer_places(t), {"o_custkey": "c_custkey"}, ["c_name", "zone", "region"])
    return df.select(
        F.lit(D.month_to_date_bounds(ORDERS_AS_OF)[1]).alias("cut_date"), F.col("l_orderkey").alias("o_orderkey"),
        K.code_to_label(F.col("o_orderstatus"), {"O": "MICROCREDITO", "F": "COMERCIAL"}, "").alias("portfolio"),
        "c_name", "zone", "region", F.to_date("l_shipdate").alias("paid_on"),
        F.upper(F.trim("o_orderpriority")).alias("kind_of_payment"), *COLLECTION_KINDS, "total", "waived",
    )


_LINE_ORDER = "(l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_tax)"
_AGING_SQL = {
    # Per credit, from its lines: balances by kind, rates, days, instalments and the guarantee.
    "credit": f"""SELECT l_orderkey AS k, arg_max(l_discount, (l_shipdate, l_partkey, l_suppkey, l_extendedprice)) FILTER (l_returnflag = 'N') AS event_rate,
  arg_max(l_tax, {_LINE_ORDER}) FILTER (l_returnflag = 'R') AS arrears_rate,
  {', '.join(f"arg_max(l_extendedprice, {_LINE_ORDER}) FILTER (l_linenumber = {n}{more}) AS {name}" for name, n, more in (('interest', 1, ''), ('arrears', 2, ''), ('commission', 3, ''), ('insurance', 4, ' AND l_quantity >= 10')))},
  CAST(max(l_shipdate) FILTER (l_shipdate <= TIMESTAMP '{ORDERS_AS_OF}') AS DATE) AS last_payment, CAST(min(l_shipdate) FILTER (l_shipdate > TIMESTAMP '{ORDERS_AS_OF}') AS DATE) AS next_due,
  count(*) AS instalments, arg_max(l_partkey, (l_shipdate, l_partkey)) FILTER (l_linenumber >= 5) AS guarantee, coalesce(bool_or(l_quantity >= 40), false) AS guaranteed
  FROM lineitem GROUP BY l_orderkey""",
    # Per customer, from all its credits: three addresses, scores, the first credit, how many there are.
    "client": """SELECT o_custkey AS k, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'F') AS home,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'P') AS business, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'O') AS work,
  max(o_totalprice) AS score, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS score_urgent, CAST(min(o_orderdate) AS DATE) AS first_credit, count(*) AS credits
  FROM orders GROUP BY o_custkey""",
    "kinds": "SELECT user_id, event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1, 2",
    "talks": """SELECT user_id, string_agg(event_type || '-' || n, ', ' ORDER BY event_type) AS contacts, arg_min(event_type, (first_ts, event_type)) AS first_adviser,
  arg_max(event_type, (last_ts, event_type)) AS last_adviser FROM kinds GROUP BY user_id""",
    "people": "SELECT c_custkey, c_name, zone, region, client.* EXCLUDE (k), talks.* EXCLUDE (user_id) FROM places LEFT JOIN client ON client.k = c_custkey LEFT JOIN talks ON user_id = c_custkey",
}
#: Segments by the wage of the credit's year: name, from and up to so many wages, condition in SQL.
AGING_SEGMENTS = (("popular", 0, 2, "O"), ("productive", 2, 9, None), ("expanded", 9, 16, None), ("small_business", 16, 25, None), ("large", 25, 10**9, None))


def _segment_sql(name, low, high, status):
    own = f"o_orderstatus = '{status}' AND o_totalprice >= w * {low}" if status else f"o_totalprice > w * {low}"
    return f"CASE WHEN {own} AND o_totalprice <= w * {high} THEN 1 ELSE 0 END AS {name}"


@query(f"""
WITH {_PLACES_SQL}, {', '.join(f'{name} AS ({sql})' for name, sql in _AGING_SQL.items())},
params AS (SELECT CAST(max(o_orderdate) AS DATE) AS bank_day FROM orders),
wage AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS y, min(o_totalprice) + 9000 AS w FROM orders GROUP BY 1),
base AS (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') AS dpd FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate <= TIMESTAMP '{ORDERS_AS_OF}')
SELECT o_orderkey, p.c_name, p.zone, p.region, date_diff('day', CAST(o_orderdate AS DATE), bank_day) AS seniority,
 {', '.join(f"CASE WHEN dpd {'>= ' + str(lo) if hi is None else f'BETWEEN {lo} AND {hi}'} THEN o_totalprice ELSE 0 END AS {name}" for name, lo, hi in K.AGING_BANDS)},
 CASE WHEN event_rate IS NULL OR event_rate = 0 THEN 0.5 ELSE event_rate END AS rate, arrears_rate, interest, arrears, commission, insurance, last_payment, next_due,
 coalesce(instalments, 0) AS instalments, guarantee, coalesce(guaranteed, false) AS guaranteed,
 coalesce(p.home, p.business, p.work) AS address, coalesce(p.business, p.work) AS business_address, coalesce(p.contacts, '**SIN TELEFONO**') AS contacts, p.score, p.score_urgent,
 p.first_credit, coalesce(p.credits, 0) AS credits, p.first_adviser, p.last_adviser, q.c_name AS codebtor, q.zone AS codebtor_zone, coalesce(q.business, q.home) AS codebtor_address,
 {', '.join(_segment_sql(*s) for s in AGING_SEGMENTS)}
FROM base CROSS JOIN params LEFT JOIN wage ON y = CAST(date_trunc('year', o_orderdate) AS DATE) LEFT JOIN credit ON credit.k = o_orderkey
LEFT JOIN people p ON p.c_custkey = o_custkey LEFT JOIN people q ON q.c_custkey = o_custkey + 1
""")
def job_portfolio_aging(t):
    """The daily collections table: one row per open credit with all that is known about it.

    What is known per credit and per customer is declared as sides, so each table is read once per key. Everything known
    per customer is put on one customer row first and written, since a credit meets two customers: its debtor and its co-debtor.
    """
    as_of = F.lit(ORDERS_AS_OF).cast("timestamp_ntz")
    credits = t.orders.filter((F.col("o_orderstatus") != "F") & (F.col("o_orderdate") <= as_of))
    years = t.orders.groupBy(D.year_start(F.col("o_orderdate")).alias("y")).agg(
        (F.min("o_totalprice") + 9000).alias("w"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )
    wage = measured(years)
    params = wage.agg(F.max("last_day").alias("bank_day"))
    person = measured(_aging_people(t))
    df = J.with_parameters(credits, params).withColumn("y", D.year_start(F.col("o_orderdate")))
    df = J.lookup(S.gather(df, {"lines": t.lineitem}, _credit_sides(as_of)), wage, "y", ["w"])
    codebtor = {"c_name": "codebtor", "zone": "codebtor_zone", "codebtor_address": "codebtor_address"}
    second = person.withColumn("codebtor_address", F.coalesce("business", "home")).withColumn("c_custkey", F.col("c_custkey") - 1)
    df = J.star_denormalize(
        df,
        [
            J.Dimension(
                person, {"o_custkey": "c_custkey"},
                ["c_name", "zone", "region", "home", "business", "work", "score", "score_urgent", "first_credit", "credits", "contacts", "first_adviser", "last_adviser"],
            ),
            J.Dimension(second, {"o_custkey": "c_custkey"}, codebtor),
        ],
    )
    amount = F.col("o_totalprice")
    dpd = D.days_between(F.col("o_orderdate"), D.run_date(ORDERS_AS_OF))
    segments = [
        K.Segment(name, F.lit(low), F.lit(high), low_open=status is None, when=None if status is None else F.col("o_orderstatus") == status)
        for name, low, high, status in AGING_SEGMENTS
    ]
    return df.select(
        "o_orderkey", "c_name", "zone", "region",
        D.days_between(F.col("o_orderdate"), F.col("bank_day")).alias("seniority"), *K.aging_columns(dpd, amount),
        N.fallback_if_zero(F.col("event_rate"), F.lit(0.5)).alias("rate"), "arrears_rate", "interest", "arrears", "commission", "insurance",
        F.to_date("last_payment").alias("last_payment"), F.to_date("next_due").alias("next_due"), "instalments", "guarantee", "guaranteed",
        F.coalesce("home", "business", "work").alias("address"), F.coalesce("business", "work").alias("business_address"),
        N.null_default(F.col("contacts"), "**SIN TELEFONO**").alias("contacts"), "score", "score_urgent", "first_credit",
        F.coalesce("credits", F.lit(0).cast("long")).alias("credits"), "first_adviser", "last_adviser", "codebtor", "codebtor_zone", "codebtor_address",
        *K.threshold_segments(amount, F.col("w"), segments),
    )


def _credit_sides(as_of, key: str = "o_orderkey") -> list[S.Side]:
    """What the lines of a credit say about it; ``key`` is the credit's column in the fact."""
    on, line = {key: "l_orderkey"}, F.col("l_linenumber")
    newest = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    day, flag, quantity = F.col("l_shipdate"), F.col("l_returnflag"), F.col("l_quantity")

    def balance(name: str, where) -> S.Side:
        return S.Side("lines", on, S.Pick({name: F.col("l_extendedprice")}, [*newest, F.col("l_tax")]), where)

    return [
        balance("interest", line == 1), balance("arrears", line == 2), balance("commission", line == 3), balance("insurance", (line == 4) & (quantity >= 10)),
        S.Side("lines", on, S.Pick({"event_rate": F.col("l_discount")}, newest), flag == "N"),
        S.Side("lines", on, S.Pick({"arrears_rate": F.col("l_tax")}, [*newest, F.col("l_tax")]), flag == "R"),
        S.Side("lines", on, S.Value("last_payment", "max", day), day <= as_of), S.Side("lines", on, S.Value("next_due", "min", day), day > as_of),
        S.Side("lines", on, S.Value("instalments", "count")), S.Side("lines", on, S.Value("guaranteed", "exists"), quantity >= 40),
        S.Side("lines", on, S.Pick({"guarantee": F.col("l_partkey")}, [day, F.col("l_partkey")]), line >= 5),
    ]


def _aging_people(t):
    """One row per customer: its place, and what its credits and events say about it."""
    credit, event = {"c_custkey": "o_custkey"}, {"c_custkey": "user_id"}
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")

    def address(name: str, of: str) -> S.Side:
        return S.Side("credits", credit, S.Pick({name: F.col("o_orderpriority")}, [F.col("o_orderdate"), F.col("o_orderkey")]), status == of)

    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", price).otherwise(0.0)
    kinds = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    kind = F.col("event_type")
    sides = [
        address("home", "F"), address("business", "P"), address("work", "O"),
        S.Side("credits", credit, S.Value("score", "max", price)), S.Side("credits", credit, S.Value("score_urgent", "max", urgent)),
        S.Side("credits", credit, S.Value("first_credit", "min", F.to_date("o_orderdate"))), S.Side("credits", credit, S.Value("credits", "count")),
        S.Side("kinds", event, S.Listing("contacts", F.concat(kind, F.lit("-"), F.col("n").cast("string")))),
        S.Side("kinds", event, S.Pick({"first_adviser": kind}, [F.col("first_ts"), kind], oldest=True)),
        S.Side("kinds", event, S.Pick({"last_adviser": kind}, [F.col("last_ts"), kind])),
    ]
    places = customer_places(t).select("c_custkey", "c_name", "zone", "region")
    return S.gather(places, {"credits": t.orders, "kinds": kinds}, sides)


@query(f"""
WITH {_PLACES_SQL}, {', '.join(f'{name} AS ({sql})' for name, sql in _AGING_SQL.items())},
before AS (SELECT l_orderkey, l_suppkey, {MONEY_SUM.format('l_extendedprice')} AS balance_before, count(*) AS rows_before FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-06-01' GROUP BY 1, 2),
now AS (SELECT l_orderkey, l_suppkey, {MONEY_SUM.format('l_extendedprice')} AS balance_now, count(*) AS rows_now FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01' GROUP BY 1, 2),
texts AS (SELECT l_orderkey AS k, max(CASE WHEN l_linenumber = 1 THEN l_tax END) AS rate_1, max(CASE WHEN l_linenumber = 2 THEN l_tax END) AS rate_2, max(CASE WHEN l_linenumber = 3 THEN l_tax END) AS rate_3,
  max(CASE WHEN l_linenumber = 7 THEN l_tax END) AS rate_alco, CAST(max(l_shipdate) AS DATE) AS text_day FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey),
more AS (SELECT l_orderkey AS k, arg_max(l_discount, (l_shipdate, l_linenumber, l_discount)) FILTER (l_linenumber IN (2, 3) AND l_discount > 0) AS small_business_rate,
  coalesce(bool_or(l_quantity < 5), false) AS other_guarantee, 'FNG-' || min(l_partkey) FILTER (l_quantity >= 40) AS guarantee_code FROM lineitem GROUP BY l_orderkey),
instance AS (SELECT o_orderkey AS k, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS rn FROM orders) WHERE rn = 1),
lists AS (SELECT o_custkey AS lk, string_agg(o_orderpriority || '-' || n, ', ' ORDER BY o_orderpriority || '-' || n) AS credit_kinds FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1),
wage AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS y, min(o_totalprice) + 9000 AS w FROM orders GROUP BY 1),
base AS (SELECT *, coalesce(before.l_orderkey, now.l_orderkey) AS credit_key, coalesce(before.l_suppkey, now.l_suppkey) AS office FROM before FULL JOIN now ON before.l_orderkey = now.l_orderkey AND before.l_suppkey = now.l_suppkey)
SELECT credit_key AS l_orderkey, office AS l_suppkey, balance_before, balance_now, coalesce(rows_before, 0) + coalesce(rows_now, 0) AS movements, CASE WHEN rows_now IS NULL THEN 'S' ELSE 'N' END AS settled,
  rate_1, rate_2, rate_3, rate_alco, text_day, small_business_rate, event_rate, arrears_rate, interest, arrears, commission, insurance, last_payment, next_due, credit.instalments, guaranteed, other_guarantee, guarantee, guarantee_code,
  o_orderpriority, o_orderstatus, p.c_name, p.zone, p.region, p.home, p.business, p.work, p.contacts, credit_kinds, p.score, p.first_adviser, p.last_adviser,
  q.c_name AS codebtor, q.contacts AS codebtor_contacts, date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') AS days_since,
  {', '.join(_segment_sql(*x) for x in AGING_SEGMENTS)}
FROM base LEFT JOIN texts ON texts.k = credit_key LEFT JOIN credit ON credit.k = credit_key LEFT JOIN more ON more.k = credit_key LEFT JOIN instance ON instance.k = credit_key
LEFT JOIN wage ON y = CAST(date_trunc('year', o_orderdate) AS DATE) LEFT JOIN people p ON p.c_custkey = o_custkey LEFT JOIN people q ON q.c_custkey = o_custkey + 1 LEFT JOIN lists ON lk = o_custkey
""")
def job_portfolio_history(t):
    """Closing and current balances side by side on a many-part key, with all that is known about the credit and its people.

    The lines are read twice in all: by credit and office, and by credit. Both times narrow rows are shuffled, by credit, so that neither their
    aggregates nor their join move them again. What is known about people is joined to credits, and the lines meet it once, by credit.
    """

    early = P.before_day("l_shipdate", "2000-06-01")
    price, line, quantity = F.col("l_extendedprice"), F.col("l_linenumber"), F.col("l_quantity")
    both = t.lineitem.repartition("l_orderkey").groupBy("l_orderkey", "l_suppkey").agg(
        N.sum_money(F.when(early, price)).alias("balance_before"), F.sum(F.when(early, 1)).alias("rows_before"),
        N.sum_money(F.when(~early, price)).alias("balance_now"), F.sum(F.when(~early, 1)).alias("rows_now"),
    )
    on = {"l_orderkey": "l_orderkey"}
    text = F.col("l_linestatus") == "O"
    rates = {"rate_1": 1, "rate_2": 2, "rate_3": 3, "rate_alco": 7}
    instance = {c: F.col(c) for c in ("o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate")}
    newest = [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_discount")]
    sides = [
        *_credit_sides(F.lit(ORDERS_AS_OF).cast("timestamp_ntz"), "l_orderkey"),
        *[S.Side("lines", on, S.Value(name, "max", F.col("l_tax")), text & (line == n)) for name, n in rates.items()],
        S.Side("lines", on, S.Value("text_day", "max", F.to_date("l_shipdate")), text),
        S.Side("lines", on, S.Pick({"small_business_rate": F.col("l_discount")}, newest), line.isin(2, 3) & (F.col("l_discount") > 0)),
        S.Side("lines", on, S.Value("other_guarantee", "exists"), quantity < 5),
        S.Side("lines", on, S.Value("guarantee_part", "min", F.col("l_partkey")), quantity >= 40),
    ]
    newest_credit = S.Side("credits", {"credit": "o_orderkey"}, S.Pick(instance, [F.col("o_orderdate")]))
    credit = S.gathered({"credits": t.orders}, [newest_credit]).select(F.col("__k0").alias("credit"), *newest_credit.make.out(F.col("__v0")))
    person = measured(_aging_people(t))
    kinds = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    listed = S.Side("kinds", {"o_custkey": "o_custkey"}, S.Listing("credit_kinds", F.concat("o_orderpriority", F.lit("-"), F.col("n").cast("string"))))
    years = measured(t.orders.groupBy(D.year_start(F.col("o_orderdate")).alias("y")).agg((F.min("o_totalprice") + 9000).alias("w")))
    second = person.withColumn("c_custkey", F.col("c_custkey") - 1)
    credit = S.gather(credit.withColumn("y", D.year_start(F.col("o_orderdate"))), {"kinds": kinds}, [listed])
    credit = J.star_denormalize(
        credit,
        [
            J.Dimension(years, "y", ["w"]),
            J.Dimension(person, {"o_custkey": "c_custkey"}, ["c_name", "zone", "region", "home", "business", "work", "contacts", "score", "first_adviser", "last_adviser"]),
            J.Dimension(second, {"o_custkey": "c_custkey"}, {"c_name": "codebtor", "contacts": "codebtor_contacts"}),
        ],
    )
    df = J.lookup(S.gather(both, {"lines": t.lineitem}, sides), credit, {"l_orderkey": "credit"})
    segments = [
        K.Segment(name, F.lit(low), F.lit(high), low_open=status is None, when=None if status is None else F.col("o_orderstatus") == status)
        for name, low, high, status in AGING_SEGMENTS
    ]
    return df.select(
        "l_orderkey", "l_suppkey", "balance_before", "balance_now",
        N.null_safe_sum([F.col("rows_before"), F.col("rows_now")]).alias("movements"), K.yes_no(F.col("rows_now").isNull(), "S", "N").alias("settled"),
        *rates, "text_day", "small_business_rate", "event_rate", "arrears_rate", "interest", "arrears", "commission", "insurance",
        F.to_date("last_payment").alias("last_payment"), F.to_date("next_due").alias("next_due"), "instalments", "guaranteed", "other_guarantee", "guarantee",
        F.concat(F.lit("FNG-"), F.col("guarantee_part").cast("string")).alias("guarantee_code"), "o_orderpriority", "o_orderstatus",
        "c_name", "zone", "region", "home", "business", "work", "contacts", "credit_kinds", "score", "first_adviser", "last_adviser", "codebtor", "codebtor_contacts",
        D.days_between(F.col("o_orderdate"), D.run_date(ORDERS_AS_OF)).alias("days_since"), *K.threshold_segments(F.col("o_totalprice"), F.col("w"), segments),
    )


@query(f"""
WITH {_PLACES_SQL},
kept AS (SELECT l.* FROM orders l JOIN (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS m, min(o_orderstatus) AS s FROM orders GROUP BY 1, 2) ON k = o_custkey AND d = CAST(o_orderdate AS DATE) AND m = o_orderkey AND s = o_orderstatus),
last_pay AS (SELECT l_orderkey AS k, {MONEY_SUM.format('l_extendedprice')} AS last_payment, CAST(l_shipdate AS DATE) AS paid_on FROM lineitem
  JOIN (SELECT l_orderkey AS j, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON j = l_orderkey AND m = l_shipdate GROUP BY l_orderkey, l_shipdate)
SELECT o_orderkey, c_name, zone, region, o_totalprice AS initial_debt, last_payment, date_diff('day', CAST(o_orderdate AS DATE), paid_on) AS days_prepaid, DATE '2000-06-30' AS cut_month
FROM kept LEFT JOIN last_pay ON last_pay.k = o_orderkey LEFT JOIN places ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' AND trim(o_orderpriority) <> '' AND o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)
""")
def job_cancelled_loans(t):
    """Loads ``cancelled_loans`` as a day's snapshot and a dated CSV, and returns the day read back."""
    return publish(cancelled_loans(t), new_table_path(t.spark, "cancelled_loans"), ORDERS_AS_OF)


def cancelled_loans(t):
    """Closed credits that are not refinanced, with the total of their last payment day."""
    rows = t.orders.withColumn("d", F.to_date("o_orderdate"))
    kept = L.keep_group_extremes(rows, ["o_custkey", "d"], maxima=["o_orderkey"], minima=["o_orderstatus"])
    closed = kept.filter((F.col("o_orderstatus") == "F") & (F.trim("o_orderpriority") != ""))
    last_pay = J.last_paid(
        t.lineitem, "l_orderkey", "l_shipdate", {"last_payment": N.sum_money(F.col("l_extendedprice"))}
    ).withColumn("paid_on", F.to_date("l_shipdate"))
    refinanced = t.events.filter((F.col("event_type") == "error") & (F.col("value") > 100))
    df = J.anti_join(closed, refinanced, {"o_custkey": "user_id"})
    df = J.lookup(df, last_pay, {"o_orderkey": "l_orderkey"}, ["last_payment", "paid_on"])
    df = J.lookup(df, customer_places(t), {"o_custkey": "c_custkey"}, ["c_name", "zone", "region"])
    return df.select(
        "o_orderkey", "c_name", "zone", "region", F.col("o_totalprice").alias("initial_debt"), "last_payment",
        D.days_between(F.col("d"), F.col("paid_on")).alias("days_prepaid"),
        F.last_day(F.lit(D.yesterday(ORDERS_AS_OF))).alias("cut_month"),
    )


@query("""
SELECT l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS start_day, CAST(l_shipdate AS DATE) + 30 AS end_day, l_quantity FROM lineitem
JOIN (SELECT l_orderkey AS k, max(l_linenumber) AS m FROM lineitem GROUP BY 1) ON k = l_orderkey AND m = l_linenumber WHERE l_linestatus = 'O'
""")
def job_credit_dates(t):
    """Dates of the newest sub-operation of each credit."""
    newest = L.keep_max_group(
        t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber", "l_linestatus"),
        "l_orderkey", "l_linenumber",
    ).filter("l_linestatus = 'O'")
    start = F.to_date("l_shipdate")
    return newest.select(
        "l_orderkey", "l_suppkey", start.alias("start_day"), F.date_add(start, 30).alias("end_day"), "l_quantity"
    )


@query(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, o_totalprice, date_diff('day', CAST(l_shipdate AS DATE), DATE '{ORDERS_AS_OF}') AS days_late
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'O'
WHERE l_shipdate < TIMESTAMP '{ORDERS_AS_OF}' AND l_returnflag LIKE 'N%'
""")
def job_online_arrears(t):
    """Loads ``online_arrears`` as a day's snapshot and a dated CSV, and returns the day read back."""
    return publish(online_arrears(t), new_table_path(t.spark, "online_arrears"), ORDERS_AS_OF)


def online_arrears(t):
    rows = t.lineitem.filter(P.before_day("l_shipdate", ORDERS_AS_OF) & F.col("l_returnflag").startswith("N"))
    df = J.lookup(
        rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"), t.orders,
        {"l_orderkey": "o_orderkey"}, ["o_totalprice"], right_filter=F.col("o_orderstatus") == "O",
    )
    late = D.days_between(F.col("l_shipdate"), D.run_date(ORDERS_AS_OF))
    return df.withColumn("days_late", late).drop("l_shipdate")
