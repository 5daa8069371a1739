"""Person, phone and code-table jobs on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.functions import text as X
from tallyframe.operators import classify as K
from tallyframe.operators import columns as C
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import merges as M
from tallyframe.operators import predicates as P
from tallyframe.operators import sides as G
from tallyframe.operators import unions as U
from tallyframe.plans.joining import branch_hierarchy
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sinks import loads as S

_PHONES_SQL = """
work AS (SELECT s_suppkey, CASE WHEN s_acctbal < 2000 THEN NULL WHEN s_acctbal < 5000 THEN '(2) 723-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') ELSE '300.' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') END AS tel FROM supplier),
raw AS (SELECT c_custkey, tel AS t1,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'abc' WHEN 'FURNITURE' THEN '' WHEN 'MACHINERY' THEN '31 ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '4-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS t2,
  CASE WHEN c_acctbal > 8000 THEN '(320)' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN c_acctbal > 0 THEN '60' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS t3,
  CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS kind
  FROM customer LEFT JOIN work ON s_suppkey = c_nationkey),
digits AS (SELECT c_custkey, kind, trim(regexp_replace(t1, '[-(). ]', '', 'g')) AS d1, trim(regexp_replace(t2, '[-(). ]', '', 'g')) AS d2, trim(regexp_replace(t3, '[-(). ]', '', 'g')) AS d3 FROM raw),
phones AS (SELECT c_custkey,
  CASE WHEN d1 LIKE '3%' AND regexp_matches(d1, '^[0-9]+$') THEN d1 WHEN d2 LIKE '3%' AND regexp_matches(d2, '^[0-9]+$') THEN d2
       WHEN kind = 2 AND d3 LIKE '3%' AND regexp_matches(d3, '^[0-9]+$') THEN d3 END AS celular,
  CASE WHEN d1 NOT LIKE '3%' AND length(d1) >= 7 AND regexp_matches(d1, '^[0-9]+$') THEN d1 WHEN d2 NOT LIKE '3%' AND length(d2) >= 7 AND regexp_matches(d2, '^[0-9]+$') THEN d2
       WHEN kind = 1 AND d3 NOT LIKE '3%' AND length(d3) >= 7 AND regexp_matches(d3, '^[0-9]+$') THEN d3 END AS fijo
  FROM digits)
"""


def _phone_sources(t):
    """Three texts per customer that may hold a phone, and the kind of the third."""
    key = F.col("c_custkey").cast("string")
    segment = F.col("c_mktsegment")
    work = t.supplier.select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 2000, None)
        .when(F.col("s_acctbal") < 5000, F.concat(F.lit("(2) 723-"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0")))
        .otherwise(F.concat(F.lit("300."), F.lpad(F.col("s_suppkey").cast("string"), 7, "0"))).alias("tel"),
    )
    own = (
        F.when(segment == "BUILDING", "abc").when(segment == "FURNITURE", "")
        .when(segment == "MACHINERY", F.concat(F.lit("31 "), F.lpad(key, 8, "0")))
        .otherwise(F.concat(F.lit("4-"), F.lpad(key, 6, "0")))
    )
    contact = F.when(F.col("c_acctbal") > 8000, F.concat(F.lit("(320)"), F.lpad(key, 7, "0"))).when(
        F.col("c_acctbal") > 0, F.concat(F.lit("60"), F.lpad(key, 6, "0"))
    )
    customers = t.customer.select(
        "c_custkey", "c_nationkey", own.alias("t2"), contact.alias("t3"),
        F.when(F.col("c_custkey") % 3 == 0, 1).otherwise(2).alias("kind"),
    )
    return J.lookup(customers, work, {"c_nationkey": "s_suppkey"}, {"tel": "t1"})


@query(f"""
WITH {_PHONES_SQL}
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS pendoc, celular AS numero_tel, 'celular' AS tipo_tel FROM phones WHERE celular IS NOT NULL
UNION ALL SELECT DISTINCT CAST(c_custkey AS VARCHAR), fijo, 'fijo' FROM phones WHERE fijo IS NOT NULL AND (celular IS NULL OR fijo <> celular)
""")
def job_phone_directory(t):
    """Mobile and landline of each person: the first source that holds one wins."""
    src = _phone_sources(t)
    kind = F.col("kind")
    mobile = F.coalesce(
        X.mobile_number(F.col("t1")), X.mobile_number(F.col("t2")), F.when(kind == 2, X.mobile_number(F.col("t3")))
    )
    landline = F.coalesce(
        X.landline_number(F.col("t1")), X.landline_number(F.col("t2")), F.when(kind == 1, X.landline_number(F.col("t3")))
    )
    both = src.select(F.col("c_custkey").cast("string").alias("pendoc"), mobile.alias("m"), landline.alias("l"))
    both = both.withColumn("l", F.when(F.col("m").isNull() | (F.col("l") != F.col("m")), F.col("l")))
    return U.unpivot_columns(both, ["pendoc"], {"m": "celular", "l": "fijo"}, "tipo_tel", "numero_tel").distinct()


#: Kinds of addresses of a person, and the status of the credits that stand for them.
ADDRESSES = {"home": "F", "work": "O", "biz": "P"}
_ADDRESS_SQL = ", ".join(
    f"arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = '{status}') AS {name}, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = '{status}') AS {name}_street"
    for name, status in ADDRESSES.items()
)


@query(f"""
WITH person AS (SELECT *, DATE '1950-02-28' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS birth FROM customer),
account AS (SELECT o_custkey AS k, {_ADDRESS_SQL}, CAST(min(o_orderdate) AS DATE) AS opened, count(*) AS accounts, coalesce(bool_or(o_totalprice > 400000 AND o_orderstatus = 'F'), false) AS moved,
  max(o_totalprice) FILTER (o_orderpriority = '1-URGENT') AS assets, min(o_totalprice) FILTER (o_orderpriority = '5-LOW') AS debts FROM orders GROUP BY 1),
life AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS education, arg_min(event_type, (ts, event_id)) FILTER (value > 20) AS job, CAST(arg_min(ts, (ts, event_id)) FILTER (value > 20) AS DATE) AS job_since,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS income, CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click') AS DOUBLE) AS outgo,
  coalesce(bool_or(event_type = 'error' AND value > 50), false) AS exposed, count(*) FILTER (event_type = 'signup') AS children FROM events GROUP BY 1),
places AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT CAST(c_custkey AS VARCHAR) AS cuenta, trim(c_name) AS nombre, b.n_name AS pais, b.r_name AS continente, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Titular' ELSE 'No titular' END AS titularidad,
  date_diff('year', birth, DATE '{EVENTS_AS_OF}') - CASE WHEN birth + to_years(CAST(date_diff('year', birth, DATE '{EVENTS_AS_OF}') AS INTEGER)) > DATE '{EVENTS_AS_OF}' THEN 1 ELSE 0 END AS edad,
  home, coalesce(work, 0) AS work, biz, CASE WHEN home IS NULL THEN 'No' WHEN home % 2 = 1 THEN 'SI' ELSE 'Otro' END AS pep,
  home_street, work_street, biz_street, h.n_name AS home_place, h.r_name AS home_region, w.n_name AS work_place, w.r_name AS work_region, coalesce(z.n_name, '0') AS biz_place, z.r_name AS biz_region, center.r_name AS center,
  opened, date_diff('day', opened, DATE '{EVENTS_AS_OF}') AS seniority, coalesce(accounts, 0) AS accounts, CASE WHEN moved THEN 'Migrado ESAL' ELSE 'No Migrado ESAL' END AS moved, assets, debts,
  coalesce(education, '0') AS education, coalesce(job, '9999') AS job, job_since, income, outgo, coalesce(exposed, false) AS exposed, coalesce(children, 0) AS children,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Constructor' WHEN 'MACHINERY' THEN 'Industrial' ELSE 'Otro' END AS clase
FROM person LEFT JOIN places b ON c_nationkey = b.n_nationkey LEFT JOIN account ON account.k = c_custkey LEFT JOIN life ON user_id = c_custkey
LEFT JOIN places h ON h.n_nationkey = home % 30 LEFT JOIN places w ON w.n_nationkey = work % 30 LEFT JOIN places z ON z.n_nationkey = biz % 30 LEFT JOIN region center ON center.r_regionkey = biz % 7
""")
def job_person_master(t):
    """One clean row per person with the newest address of each kind and its place, account, work and income, loaded as an upsert.

    What credits and events say about a person is declared as sides of one key: each table is read once, and the person meets
    all of it in one join. Places come in under four names.
    """
    birth = F.date_add(F.lit("1950-02-28").cast("date"), ((F.col("c_custkey") * 37) % 20000).cast("int"))
    people = L.any_per_key(t.customer, "c_custkey", ["c_name"]).withColumn("birth", birth)
    places = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    people = G.gather(people, {"credits": t.orders, "events": t.events}, _person_sides())
    for name in ADDRESSES:
        people = people.withColumn(f"{name}_code", F.col(name) % 30)
    people = J.star_denormalize(
        people.withColumn("center_code", F.col("biz") % 7),
        [
            J.Dimension(places, {"c_nationkey": "n_nationkey"}, {"n_name": "pais", "r_name": "continente"}),
            *[J.Dimension(places, {f"{name}_code": "n_nationkey"}, {"n_name": f"{name}_place", "r_name": f"{name}_region"}) for name in ADDRESSES],
            J.Dimension(t.region, {"center_code": "r_regionkey"}, {"r_name": "center"}),
        ],
    )
    home, run = F.col("home"), D.run_date(EVENTS_AS_OF)
    rows = people.select(
        F.trim(F.col("c_custkey").cast("string")).alias("cuenta"), F.col("c_name").alias("nombre"), "pais", "continente",
        F.when(F.col("c_mktsegment") == "BUILDING", "Titular").otherwise("No titular").alias("titularidad"),
        N.null_default(D.age_years(F.col("birth"), run), 0).alias("edad"),
        "home", N.null_default(F.col("work"), 0).alias("work"), "biz",
        F.when(home.isNull(), "No").when(home % 2 == 1, "SI").otherwise("Otro").alias("pep"),
        *[f"{name}_street" for name in ADDRESSES], "home_place", "home_region", "work_place", "work_region",
        N.null_default(F.col("biz_place"), "0").alias("biz_place"), "biz_region", "center", "opened", D.days_between(F.col("opened"), run).alias("seniority"), "accounts",
        F.when(F.col("moved"), "Migrado ESAL").otherwise("No Migrado ESAL").alias("moved"), "assets", "debts",
        N.null_default(F.col("education"), "0").alias("education"), N.null_default(F.col("job"), "9999").alias("job"), F.to_date("job_since").alias("job_since"),
        "income", "outgo", "exposed", "children", K.code_to_label(F.col("c_mktsegment"), {"BUILDING": "Constructor", "MACHINERY": "Industrial"}, "Otro").alias("clase"),
    )
    clean = C.map_text_columns(rows, lambda c: F.trim(X.clean_control_chars(c)))
    path = new_table_path(t.spark, "persons")
    stale = clean.filter("titularidad = 'Titular'").withColumn("nombre", F.lit("old"))
    S.write_version(stale, path, "2024-01-15")
    return S.merge_version(clean, path, "2024-01-15", EVENTS_AS_OF, lambda old, new: M.upsert_replace(old, new, ["cuenta"]))


def _person_sides() -> list[G.Side]:
    credit, event = {"c_custkey": "o_custkey"}, {"c_custkey": "user_id"}
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    kind, value, order = F.col("event_type"), F.col("value"), [F.col("ts"), F.col("event_id")]
    newest = [F.col("o_orderdate"), F.col("o_orderkey")]
    return [
        *[G.Side("credits", credit, G.Pick({name: F.col("o_orderkey"), f"{name}_street": priority}, newest), status == of) for name, of in ADDRESSES.items()],
        G.Side("credits", credit, G.Value("opened", "min", F.to_date("o_orderdate"))), G.Side("credits", credit, G.Value("accounts", "count")),
        G.Side("credits", credit, G.Value("moved", "exists"), (price > 400000) & (status == "F")),
        G.Side("credits", credit, G.Value("assets", "max", price), priority == "1-URGENT"), G.Side("credits", credit, G.Value("debts", "min", price), priority == "5-LOW"),
        G.Side("events", event, G.Pick({"education": kind}, order)), G.Side("events", event, G.Pick({"job": kind, "job_since": F.col("ts")}, order, oldest=True), value > 20),
        G.Side("events", event, G.Value("income", "sum", value), kind == "purchase"), G.Side("events", event, G.Value("outgo", "sum", value), kind == "click"),
        G.Side("events", event, G.Value("exposed", "exists"), (kind == "error") & (value > 50)), G.Side("events", event, G.Value("children", "count"), kind == "signup"),
    ]


@query(f"""
SELECT documento, fecha_financiera, date_diff('day', fecha_financiera, DATE '{ORDERS_AS_OF}') AS dias_a_hoy,
 CASE WHEN date_diff('day', fecha_financiera, DATE '{ORDERS_AS_OF}') > 365 THEN 'Desactualizado' ELSE 'Actualizado' END AS estado_financiera
FROM (SELECT o_custkey AS documento, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS fecha_financiera,
  row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus <> 'F'), o_orderdate DESC) AS rn FROM orders) WHERE rn = 1
""")
def job_financial_update(t):
    dated = t.orders.select(
        F.col("o_custkey").alias("documento"),
        F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("fecha_financiera"),
    )
    last = dated.groupBy("documento").agg(F.max("fecha_financiera").alias("fecha_financiera"))
    at = F.col("fecha_financiera")
    return last.select(
        "documento", at, D.days_between(at, D.run_date(ORDERS_AS_OF)).alias("dias_a_hoy"),
        K.freshness_label(at, ORDERS_AS_OF).alias("estado_financiera"),
    )


@query("""
SELECT DISTINCT r_regionkey AS region_id, r_name AS region, n_nationkey AS zone_id, n_name AS zone, s_suppkey AS branch_id, s_name AS branch FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 0
UNION ALL SELECT 9, 'DIRECCION GENERAL', 900, 'DIRECCION GENERAL', 9000, 'DIRECCION GENERAL'
""")
def job_region_zone_branch(t):
    rows = branch_hierarchy(t).filter("region_id <> 0").select("region_id", "region", "zone_id", "zone", "branch_id", "branch")
    head = "DIRECCION GENERAL"
    return U.union_constant_row(
        rows.distinct(),
        {"region_id": 9, "region": head, "zone_id": 900, "zone": head, "branch_id": 9000, "branch": head},
    )


@query("""
SELECT p_brand AS codigo, p_type AS descripcion, CASE p_type WHEN 'SMALL' THEN 'RURAL' WHEN 'LARGE' THEN 'URBANO' ELSE 'OTRO' END AS zona,
 1 AS empresa, min(p_size) AS menor FROM part GROUP BY p_brand, p_type UNION ALL SELECT 'N', 'No aplica', 'OTRO', 1, 0
""")
def job_code_tables(t):
    """Code dimensions: distinct codes, labels, constants and the extra member."""
    codes = t.part.groupBy(F.col("p_brand").alias("codigo"), F.col("p_type").alias("descripcion")).agg(F.min("p_size").alias("menor"))
    labelled = codes.select(
        "codigo", "descripcion",
        K.code_to_label(F.col("descripcion"), {"SMALL": "RURAL", "LARGE": "URBANO"}, "OTRO").alias("zona"),
        F.lit(1).alias("empresa"), "menor",
    )
    return U.union_constant_row(
        labelled, {"codigo": "N", "descripcion": "No aplica", "zona": "OTRO", "empresa": 1, "menor": 0}
    )


@query("""
SELECT DISTINCT s_suppkey AS cod_asesor, s_name AS asesor, n_name AS sucursal, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' WHERE s_acctbal > 0
""")
def job_advisers(t):
    offices = J.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, {"r_name": "region"}, right_filter=F.col("r_name") != "ASIA")
    df = J.lookup(t.supplier.filter("s_acctbal > 0"), offices, {"s_nationkey": "n_nationkey"}, {"n_name": "sucursal", "region": "region"}, how="inner")
    return df.select(F.col("s_suppkey").alias("cod_asesor"), F.col("s_name").alias("asesor"), "sucursal", "region").distinct()


@query("""
SELECT s_suppkey AS cuenta, s_name AS nombre, CASE WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_tax = 0.08) THEN 'SI' ELSE 'NO' END AS tiene_saldo,
 (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS ultimo_movimiento FROM supplier
""")
def job_vendors(t):
    """Suppliers with an existence flag and the day of their last movement."""
    lines = t.lineitem.groupBy("l_suppkey").agg(
        F.max(F.when((F.col("l_quantity") > 49) & (F.col("l_tax") == 0.08), 1)).alias("hit"),
        F.to_date(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))).alias("ultimo_movimiento"),
    )
    df = J.lookup(t.supplier.select("s_suppkey", "s_name"), lines, {"s_suppkey": "l_suppkey"}, ["hit", "ultimo_movimiento"])
    return df.select(
        F.col("s_suppkey").alias("cuenta"), F.col("s_name").alias("nombre"),
        K.yes_no(F.col("hit") == 1).alias("tiene_saldo"), "ultimo_movimiento",
    )


@query(f"""
SELECT c_custkey, c_name, c_mktsegment, CAST(max(o_orderdate) AS DATE) AS last_day FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderdate >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY GROUP BY ALL
""")
def job_recent_clients(t):
    """Projection of the rows touched in the last 30 days."""
    recent = P.filter_recent_days(t.orders, "o_orderdate", ORDERS_AS_OF, 30)
    last = recent.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("last_day"))
    return J.lookup(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), last, {"c_custkey": "o_custkey"}, ["last_day"], how="inner"
    )
