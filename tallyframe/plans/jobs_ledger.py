"""Ledger jobs: lines stand for ledger movements, parts for the chart of accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.operators import aggregates as A
from tallyframe.operators import joins as J
from tallyframe.operators import predicates as P
from tallyframe.operators import unions as U
from tallyframe.plans.registry import ORDERS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sinks.loads import publish
from tallyframe.plans.scans_filters import _CODES_SQL, _code_list

MONEY_SUM = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


@query(f"""
SELECT CAST(l_shipdate AS DATE) AS fecha_contable, p_brand AS rubro, p_name AS descripcion, l_orderkey AS cuenta, c_name AS nombre, l_extendedprice AS importe, l_suppkey AS sucursal
FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size > 5 LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'O' LEFT JOIN customer ON c_custkey = o_custkey
WHERE p_brand LIKE 'Brand#2%' AND l_shipdate < TIMESTAMP '{ORDERS_AS_OF}'
""")
def job_expense_ledger(t):
    """Expense movements up to the run date, with account text and holder."""
    rows = t.lineitem.filter(P.before_day("l_shipdate", ORDERS_AS_OF)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    chart = t.part.filter((F.col("p_size") > 5) & F.col("p_brand").startswith("Brand#2"))
    holders = J.lookup(t.orders.filter("o_orderstatus = 'O'"), t.customer, {"o_custkey": "c_custkey"}, ["c_name"])
    df = J.lookup(rows, chart, {"l_partkey": "p_partkey"}, {"p_brand": "rubro", "p_name": "descripcion"}, how="inner")
    df = J.lookup(df, holders, {"l_orderkey": "o_orderkey"}, {"c_name": "nombre"})
    return df.select(
        F.to_date("l_shipdate").alias("fecha_contable"), "rubro", "descripcion", F.col("l_orderkey").alias("cuenta"),
        "nombre", F.col("l_extendedprice").alias("importe"), F.col("l_suppkey").alias("sucursal"),
    )


@query("""
SELECT l_orderkey, l_suppkey, l_partkey, p_brand AS rubro, l_extendedprice AS saldo, CAST(l_shipdate AS DATE) AS fecha FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
WHERE p_brand LIKE 'Brand#1%' OR (p_brand = 'Brand#25' AND CAST(l_shipdate AS DATE) = last_day(l_shipdate))
""")
def job_accrued_interest(t):
    """One code family every day, one further code on month ends only."""
    coded = J.lookup(
        t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate"), t.part,
        {"l_partkey": "p_partkey"}, {"p_brand": "rubro"},
    )
    day = F.to_date("l_shipdate")
    kept = coded.filter(
        P.any_of(F.col("rubro").startswith("Brand#1"), (F.col("rubro") == "Brand#25") & (day == F.last_day(day)))
    )
    return kept.select(
        "l_orderkey", "l_suppkey", "l_partkey", "rubro", F.col("l_extendedprice").alias("saldo"), day.alias("fecha")
    )


@query(f"""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS fecha, p_brand || '/' || p_size AS rubro, l_suppkey AS sucursal, l_linestatus AS modulo, l_extendedprice AS saldo
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_brand || '/' || p_size IN ({_CODES_SQL}) AND l_shipdate >= TIMESTAMP '{ORDERS_AS_OF}' AND l_shipdate < TIMESTAMP '{ORDERS_AS_OF}' + INTERVAL 1 DAY
""")
def job_ledger_codes(t):
    """Distinct balances of one day for a long list of ledger codes.

    The list is applied to the chart of accounts before it meets the day's movements.
    """
    chart = t.part.select("p_partkey", F.concat_ws("/", "p_brand", "p_size").alias("rubro"))
    listed = P.filter_in_list(chart, "rubro", _code_list())
    rows = t.lineitem.filter(P.on_day("l_shipdate", ORDERS_AS_OF)).select("l_partkey", "l_suppkey", "l_linestatus", "l_shipdate", "l_extendedprice")
    df = J.lookup(rows, listed, {"l_partkey": "p_partkey"}, ["rubro"], how="inner")
    return A.group_as_distinct(
        df.select(
            F.to_date("l_shipdate").alias("fecha"), "rubro", F.col("l_suppkey").alias("sucursal"), F.col("l_linestatus").alias("modulo"),
            F.col("l_extendedprice").alias("saldo"),
        )
    )


@query(f"""
SELECT CAST(l_shipdate AS DATE) AS fecha, l_suppkey AS sucursal, l_linenumber AS rubro, {MONEY_SUM.format('-l_extendedprice')} AS saldo, 'cierre' AS origen
FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_shipdate < TIMESTAMP '{ORDERS_AS_OF}' GROUP BY l_shipdate, l_suppkey, l_linenumber
UNION ALL
SELECT CAST(l_shipdate AS DATE), l_suppkey, l_linenumber, {MONEY_SUM.format('-l_extendedprice')}, 'en linea'
FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_shipdate >= TIMESTAMP '{ORDERS_AS_OF}' GROUP BY l_shipdate, l_suppkey, l_linenumber
""")
def job_cash_monitor(t):
    """Sign-flipped balances per day, office and code: closed days and the online ledger."""

    def monitor(rows, origin):
        kept = P.filter_in_list(rows, "l_returnflag", ["A", "N"])
        summed = A.group_sum(
            kept, [F.to_date("l_shipdate").alias("fecha"), F.col("l_suppkey").alias("sucursal"), F.col("l_linenumber").alias("rubro")],
            {"saldo": -F.col("l_extendedprice")},
        )
        return summed.withColumn("origen", F.lit(origin))

    closed = t.lineitem.filter(P.before_day("l_shipdate", ORDERS_AS_OF))
    online = t.lineitem.filter(P.since_day("l_shipdate", ORDERS_AS_OF))
    return U.union_all(monitor(closed, "cierre"), monitor(online, "en linea"))


@query(f"""
SELECT DISTINCT s_nationkey AS sucursal, s_suppkey AS centro, -s_acctbal AS saldo, DATE '{ORDERS_AS_OF}' AS fecha_hora FROM supplier WHERE s_acctbal <> 0
UNION ALL SELECT DISTINCT c_nationkey, c_custkey, -c_acctbal, DATE '{ORDERS_AS_OF}' FROM customer WHERE c_acctbal <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def job_balance_monitor(t):
    """Loads ``balance_monitor`` as a day's snapshot and a dated CSV, and returns the day read back."""
    return publish(balance_monitor(t), new_table_path(t.spark, "balance_monitor"), ORDERS_AS_OF)


def balance_monitor(t):
    """Distinct current balances with flipped sign and the load date."""

    def balances(rows, office, centre, amount):
        kept = rows.filter(F.col(amount) != 0)
        return kept.select(
            F.col(office).alias("sucursal"), F.col(centre).alias("centro"), (-F.col(amount)).alias("saldo"),
            D.run_date(ORDERS_AS_OF).alias("fecha_hora"),
        ).distinct()

    clients = P.filter_in_list(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"])
    return U.union_all(
        balances(t.supplier, "s_nationkey", "s_suppkey", "s_acctbal"),
        balances(clients, "c_nationkey", "c_custkey", "c_acctbal"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS fecha FROM lineitem
WHERE l_linenumber = 2 AND l_returnflag <> 'R' AND l_shipdate >= TIMESTAMP '2000-01-01' AND l_extendedprice > 0
""")
def job_module_transactions(t):
    kept = t.lineitem.filter(
        P.all_of(
            F.col("l_linenumber") == 2, F.col("l_returnflag") != "R", P.since_day("l_shipdate", "2000-01-01"),
            F.col("l_extendedprice") > 0,
        )
    )
    return kept.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("fecha")
    )
