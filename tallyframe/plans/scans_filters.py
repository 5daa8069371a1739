"""Sources, filters and predicates on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.numbers import sum_money
from tallyframe.operators import columns as C
from tallyframe.operators import predicates as P
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sources.files import scan_csv
from tallyframe.sources.tables import scan_parquet, scan_query, scan_subquery


@query("""
SELECT n_name, r_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_name, r_name
""")
def scan_tables_with_sql(t):
    return scan_query(
        t.spark,
        """
        SELECT n_name, r_name, count(*) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey
        GROUP BY n_name, r_name
        """,
        customer=t.customer, nation=t.nation, region=t.region,
    )


@query("""
SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'
GROUP BY o_orderpriority
""")
def scan_subquery_then_filter(t):
    sub = scan_subquery(
        t.spark, "SELECT o_orderpriority, o_orderstatus, o_totalprice FROM {orders} WHERE o_totalprice > 300000",
        orders=t.orders,
    )
    return sub.filter("o_orderstatus = 'O'").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query("""
SELECT c_custkey AS codigo_cliente, c_name AS "nombre", c_mktsegment || ' ñandú' AS region_linea, c_acctbal AS saldo
FROM customer
""")
def scan_csv_with_declared_schema(t):
    path = new_table_path(t.spark, "customer_csv")
    source = t.customer.select(
        F.col("c_custkey").alias(" Código Cliente "),
        F.col("c_name").alias("Nombre"),
        F.concat("c_mktsegment", F.lit(" ñandú")).alias("Región línea"),
        F.col("c_acctbal").alias("Saldo"),
    )
    source.write.options(sep=";", encoding="ISO-8859-1", header=True).csv(path)
    schema = T.StructType(
        [
            T.StructField(" Código Cliente ", T.LongType()),
            T.StructField("Nombre", T.StringType()),
            T.StructField("Región línea", T.StringType()),
            T.StructField("Saldo", T.DoubleType()),
        ]
    )
    df = scan_csv(t.spark, path, schema, sep=";", encoding="ISO-8859-1", normalize=True)
    return df.toDF(*[c.lower() for c in df.columns])


@query("""
SELECT * FROM part
""")
def scan_parquet_directory(t):
    upper = t.part.toDF(*[c.upper() for c in t.part.columns])
    path = new_table_path(t.spark, "part_upper")
    upper.write.parquet(path)
    return scan_parquet(t.spark, path)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice > 250000
""")
def filter_conjunction(t):
    return t.orders.filter(
        P.all_of(
            F.col("o_orderstatus") == "O",
            F.col("o_orderpriority") != "5-LOW",
            P.since_day("o_orderdate", "1998-01-01"),
            F.col("o_totalprice") > 250000,
        )
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def filter_in_short_list(t):
    return P.filter_in_list(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "o_orderpriority"
    )


def _code_list() -> list[str]:
    """516 ledger-like codes by rule: 12 brands with 43 sizes each."""
    return [f"Brand#{b}/{s}" for b in range(1, 13) for s in range(1, 44)]


_CODES_SQL = """
SELECT 'Brand#' || b.b || '/' || s.s FROM (SELECT unnest(generate_series(1, 12)) AS b) b,
(SELECT unnest(generate_series(1, 43)) AS s) s
"""


@query(f"""
SELECT p_partkey, p_brand || '/' || p_size AS code FROM part
WHERE p_brand || '/' || p_size IN ({_CODES_SQL})
""")
def filter_in_long_list(t):
    coded = t.part.select("p_partkey", F.concat_ws("/", "p_brand", "p_size").alias("code"))
    return P.filter_in_list(coded, "code", _code_list()).select("p_partkey", "code")


@query(f"""
SELECT p_partkey, code FROM (SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL ELSE p_brand || '/' || p_size END AS code FROM part)
WHERE code IS NOT NULL AND code NOT IN ({_CODES_SQL})
""")
def filter_not_in_long_list(t):
    coded = t.part.select(
        "p_partkey", F.when(F.col("p_size") != 50, F.concat_ws("/", "p_brand", "p_size")).alias("code")
    )
    return P.filter_not_in_list(coded, "code", _code_list()).select("p_partkey", "code")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag BETWEEN 'A' AND 'N'
AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
""")
def filter_between(t):
    return t.lineitem.filter(
        F.col("l_quantity").between(10, 20)
        & F.col("l_returnflag").between("A", "N")
        & P.between_days("l_shipdate", "1997-01-01", "1997-12-31")
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("""
SELECT p_partkey, p_type, p_name FROM part WHERE p_type LIKE 'S%' OR p_name LIKE 'blue%'
""")
def filter_like_prefix(t):
    return t.part.filter(F.col("p_type").startswith("S") | F.col("p_name").startswith("blue")).select(
        "p_partkey", "p_type", "p_name"
    )


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem
WHERE l_returnflag = 'R' OR (l_linestatus = 'O' AND CAST(l_shipdate AS DATE) = last_day(l_shipdate))
GROUP BY l_returnflag, l_linestatus
""")
def filter_month_end_branch(t):
    month_end = F.to_date("l_shipdate") == F.last_day("l_shipdate")
    kept = t.lineitem.filter(
        P.any_of(F.col("l_returnflag") == "R", (F.col("l_linestatus") == "O") & month_end)
    )
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), sum_money(F.col("l_extendedprice")).alias("amount")
    )


@query("""
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day, 'in month' AS run FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-06-01' AND o_orderdate < TIMESTAMP '2000-06-30'
UNION ALL
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE), 'on day 1' FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-05-01' AND o_orderdate < TIMESTAMP '2000-06-01'
""")
def filter_month_to_date(t):
    def run(as_of, label):
        rows = P.filter_month_to_date(t.orders, "o_orderdate", as_of)
        return rows.select(
            "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day"), F.lit(label).alias("run")
        )

    return run(ORDERS_AS_OF, "in month").unionByName(run("2000-06-01", "on day 1"))


@query("""
SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-09'
""")
def filter_recent_days(t):
    return P.filter_recent_days(t.events, "ts", EVENTS_AS_OF, 7).select("event_id", "user_id", "event_type", "value")


@query("""
SELECT event_id, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""")
def filter_yesterday(t):
    return P.filter_yesterday(t.events, "ts", EVENTS_AS_OF).select("event_id", "user_id", "event_type", "value")


@query("""
SELECT o_orderkey, a, b FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS a,
         CASE WHEN o_orderpriority < '3' THEN NULL ELSE o_orderpriority END AS b,
         CASE WHEN o_totalprice < 1000 THEN NULL ELSE o_custkey END AS k FROM orders)
WHERE (a IS NOT NULL OR b IS NOT NULL) AND k IS NOT NULL
""")
def drop_null_rows_and_keys(t):
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("a"),
        F.when(F.col("o_orderpriority") >= "3", F.col("o_orderpriority")).alias("b"),
        F.when(F.col("o_totalprice") >= 1000, F.col("o_custkey")).alias("k"),
    )
    return P.drop_null_key(C.clean_null_rows(df, ["a", "b"]), "k").select("o_orderkey", "a", "b")
