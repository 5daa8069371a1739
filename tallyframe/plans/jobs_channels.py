"""Channel and teller jobs: events stand for channel traffic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.functions import text as X
from tallyframe.operators import classify as K
from tallyframe.operators import joins as J
from tallyframe.operators import latest as L
from tallyframe.operators import merges as M
from tallyframe.operators import predicates as P
from tallyframe.plans.documents import _SESSION_STEPS, session_token
from tallyframe.plans.registry import EVENTS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sinks import loads as S
from tallyframe.sources import payloads

_USER_SQL = """SELECT user_id, lpad(CAST(user_id % 5 AS VARCHAR), 3, '0') || lpad(CAST(user_id % 11 AS VARCHAR), 4, '0') || lpad(CAST(user_id AS VARCHAR), 25, '0') AS persona,
  CAST(min(ts) AS DATE) AS fecha_alta, CASE WHEN arg_max(event_type, ts) = 'error' THEN CAST(max(ts) AS DATE) END AS fecha_baja FROM events WHERE {} GROUP BY user_id"""


@query(f"""
WITH o AS ({_USER_SQL.format("ts < TIMESTAMP '2024-01-16'")}), n AS ({_USER_SQL.format("ts >= TIMESTAMP '2024-01-02'")})
SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.persona, n.persona) AS persona, CASE WHEN o.user_id IS NULL THEN n.fecha_alta ELSE o.fecha_alta END AS fecha_alta,
  CASE WHEN n.user_id IS NULL THEN o.fecha_baja ELSE n.fecha_baja END AS fecha_baja FROM o FULL JOIN n ON o.user_id = n.user_id
""")
def job_channel_users(t):
    """Users with a fixed-width identity; a later delivery only moves the closing date."""

    def users(rows):
        ends = J.first_last_state(
            rows.select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"], ["event_type", "ts"]
        )
        identity = X.fixed_width_key([(F.col("user_id") % 5, 3), (F.col("user_id") % 11, 4), (F.col("user_id"), 25)])
        closed = F.when(F.col("last_event_type") == "error", F.to_date("last_ts"))
        return ends.select(
            "user_id", identity.alias("persona"), F.to_date("first_ts").alias("fecha_alta"), closed.alias("fecha_baja")
        )

    path = new_table_path(t.spark, "channel_users")
    S.write_version(users(t.events.filter(P.before_day("ts", "2024-01-16"))), path, "2024-01-15")
    staged = users(t.events.filter(P.since_day("ts", "2024-01-02")))
    return S.merge_version(
        staged, path, "2024-01-15", EVENTS_AS_OF, lambda old, new: M.upsert_update_insert(old, new, ["user_id"], ["fecha_baja"])
    )


@query("""
WITH src AS (SELECT user_id, event_type || lpad(CAST(user_id AS VARCHAR), 30, '0') AS producto, CASE WHEN value > 30 THEN 'S' END AS habilitado,
  CASE WHEN ts < TIMESTAMP '2024-01-16' THEN DATE '2024-01-15' ELSE DATE '2024-01-16' END AS d FROM events WHERE event_type <> 'view')
SELECT md5(CAST(user_id AS VARCHAR) || chr(1) || producto || chr(1) || coalesce(habilitado, '') || chr(1) || CASE WHEN length(producto) >= 32 THEN substring(producto, 23, 10) ELSE '' END) AS hash,
  user_id AS usuario_canal, producto AS codigo_producto, coalesce(habilitado, '') AS producto_habilitado,
  CASE WHEN length(producto) >= 32 THEN substring(producto, 23, 10) ELSE '' END AS cuenta_cliente, min(d) AS fecha_desde, max(d) AS fecha_hasta
FROM src GROUP BY user_id, producto, habilitado
""")
def job_channel_products(t):
    """Products of each user kept as a history by content hash."""
    content = ["usuario_canal", "codigo_producto", "producto_habilitado", "cuenta_cliente"]

    def products(rows):
        code = F.concat(F.col("event_type"), F.lpad(F.col("user_id").cast("string"), 30, "0"))
        kept = rows.filter("event_type <> 'view'").select(
            F.col("user_id").alias("usuario_canal"), code.alias("codigo_producto"),
            F.when(F.col("value") > 30, "S").alias("producto_habilitado"),
            X.guarded_substring(code, 32, 23, 10).alias("cuenta_cliente"),
        )
        return kept.fillna("", ["codigo_producto", "producto_habilitado", "cuenta_cliente"]).distinct()

    def stage(rows, as_of):
        return M.stage_validity(products(rows), content, as_of).withColumnsRenamed(
            {"valid_from": "fecha_desde", "valid_to": "fecha_hasta"}
        )

    path = new_table_path(t.spark, "channel_products")
    S.write_version(stage(t.events.filter(P.before_day("ts", EVENTS_AS_OF)), EVENTS_AS_OF), path, EVENTS_AS_OF)
    staged = stage(t.events.filter(P.since_day("ts", EVENTS_AS_OF)), "2024-01-17")
    return S.merge_version(
        staged, path, EVENTS_AS_OF, "2024-01-17",
        lambda old, new: M.hash_validity_merge(old, new, content, "hash", "fecha_desde", "fecha_hasta"),
    )


@query("""
SELECT event_id, user_id AS usuario_canal, strftime(ts, '%Y-%m-%d') || CASE WHEN event_type = 'click' THEN ' 00:00:00' ELSE strftime(ts, ' %H:%M:%S') END AS fecha_hora,
  CASE WHEN event_type = 'error' THEN 'T' ELSE 'F' END AS bloqueo,
  lpad(coalesce(CASE WHEN value > 10 THEN CAST(user_id % 5 AS VARCHAR) END, '0'), 3, '0') || lpad(CAST(user_id % 11 AS VARCHAR), 4, '0') || lpad(CAST(user_id AS VARCHAR), 25, '0') AS administrador,
  CAST(ts AS DATE) AS fecha_informacion FROM events WHERE event_type <> 'signup'
""")
def job_channel_audit(t):
    """Audit events with a timestamp made of date and clock text; impossible clocks drop out."""
    kind = F.col("event_type")
    clock = F.when(kind == "signup", "997700").when(kind == "click", "0x1").otherwise(F.date_format("ts", "HH:mm:ss"))
    stamp = D.assemble_timestamp(F.to_date("ts"), clock)
    admin = X.fixed_width_key(
        [(F.when(F.col("value") > 10, F.col("user_id") % 5), 3), (F.col("user_id") % 11, 4), (F.col("user_id"), 25)],
        null_as="0",
    )
    rows = t.events.select(
        "event_id", F.col("user_id").alias("usuario_canal"), stamp.alias("stamp"),
        F.when(kind == "error", "T").otherwise("F").alias("bloqueo"), admin.alias("administrador"),
        F.to_date("ts").alias("fecha_informacion"),
    )
    valid = P.drop_null_key(rows, "stamp")
    return valid.select(
        "event_id", "usuario_canal", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"), "bloqueo",
        "administrador", "fecha_informacion",
    )


@query("""
SELECT event_id, user_id AS usuario_canal, upper(trim(event_type)) AS dispositivo, event_type || ' ' || user_id AS browser, 'CO' AS pais_conexion, props AS ip,
  CAST(ts AS DATE) AS fecha_informacion, c_mktsegment AS tipo_usuario FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type <> 'error'
""")
def job_channel_sessions(t):
    """Sessions whose token is JSON in JSON, with the user's type from another source."""
    rows = t.events.filter("event_type <> 'error'").withColumn("raw", session_token())
    opened = payloads.json_chain(rows, "raw", _SESSION_STEPS)
    flat = opened.select(
        "event_id", F.col("user_id").alias("usuario_canal"),
        X.trim_upper(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))).alias("dispositivo"),
        F.concat_ws(" ", "browser.name", "browser.version").alias("browser"),
        F.col("finger.country").alias("pais_conexion"), F.col("token.Ip").alias("ip"),
        F.to_date("ts").alias("fecha_informacion"),
    )
    return J.lookup(flat, t.customer, {"usuario_canal": "c_custkey"}, {"c_mktsegment": "tipo_usuario"})


@query("""
SELECT event_id, event_type AS etiqueta, CAST(user_id AS VARCHAR) AS monto, value AS capital, value / 4 AS tasa,
  CASE WHEN event_type IN ('view', 'click') THEN CAST(ts AS DATE) END AS fecha_final, CAST(NULL AS VARCHAR) AS moneda FROM events
""")
def job_channel_transactions(t):
    """Simulations held as JSON with a declared nested shape; only slashed dates are dates."""
    due = F.when(F.col("event_type").isin("view", "click"), F.date_format("ts", "yyyy/MM/dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    simulation = F.struct(due.alias("fechaVencimiento"), (F.col("value") / 4).alias("tasa"), F.col("value").alias("capital"))
    raw = t.events.select(
        "event_id",
        F.to_json(
            F.struct(simulation.alias("Simulacion"), F.col("event_type").alias("EtiquetaProducto"), F.col("user_id").cast("string").alias("Monto"))
        ).alias("raw"),
    )
    shape = (
        "Simulacion STRUCT<plazo: STRING, fechaVencimiento: STRING, intereses: DOUBLE, tasa: DOUBLE, capital: DOUBLE, "
        "moneda: STRING>, EtiquetaProducto STRING, Monto STRING, Plazo STRING"
    )
    doc = payloads.json_parse_schema(raw, "raw", shape)
    final = D.guarded_parse_date(F.col("doc.Simulacion.fechaVencimiento"), "^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd")
    return doc.select(
        "event_id", F.col("doc.EtiquetaProducto").alias("etiqueta"), F.col("doc.Monto").alias("monto"),
        F.col("doc.Simulacion.capital").alias("capital"), F.col("doc.Simulacion.tasa").alias("tasa"),
        final.alias("fecha_final"), F.col("doc.Simulacion.moneda").alias("moneda"),
    )


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS usuario, CASE WHEN value > 5 THEN value ELSE 0 END AS importe,
 CAST(CAST(user_id AS VARCHAR) || CAST(event_id % 100 AS VARCHAR) AS BIGINT) AS codigo_tipo_operacion, CAST(ts AS DATE) AS fecha_informacion FROM events
""")
def job_channel_operations(t):
    rows = t.events.select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("usuario"),
        F.when(F.col("value") > 5, F.col("value")).alias("importe"),
        N.concat_numeric_code(F.col("user_id"), F.col("event_id") % 100).alias("codigo_tipo_operacion"),
        F.to_date("ts").alias("fecha_informacion"),
    )
    return rows.fillna({"usuario": "", "importe": 0.0})


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, o_orderpriority, CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE -l_extendedprice END AS importe
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
WHERE l_linenumber IN (1, 3, 5) AND l_returnflag NOT IN ('R') AND l_shipdate >= TIMESTAMP '1998-01-01'
""")
def job_channel_transfers(t):
    rows = t.lineitem.filter(
        F.col("l_linenumber").isin(1, 3, 5) & ~F.col("l_returnflag").isin("R") & P.since_day("l_shipdate", "1998-01-01")
    ).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        N.sign_by(F.col("l_extendedprice"), F.col("l_linestatus") != "O").alias("importe"),
    )
    listed = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return J.lookup(rows, t.orders, {"l_orderkey": "o_orderkey"}, ["o_orderpriority"], right_filter=listed)


@query("""
WITH cash AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_extendedprice, l_linestatus FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate >= TIMESTAMP '1999-01-01'),
specific AS (SELECT l_orderkey AS k, l_partkey AS hcta, TRY_CAST(split_part(ref, ' ', 1) AS INTEGER) AS oper FROM (
   SELECT *, CASE WHEN l_linestatus = 'O' THEN l_suppkey || ' deposito' ELSE 'REF ' || l_suppkey END AS ref,
   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem WHERE l_returnflag <> 'R') WHERE rn = 1)
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice AS importe,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'O' THEN coalesce(o_custkey, 0) WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN coalesce(s_nationkey, 0) ELSE hcta END AS cuenta,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN coalesce(oper, 0) ELSE l_orderkey END AS operacion,
  CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN trim(coalesce(s_name, '')) || ' ' || coalesce(CAST(s_nationkey AS VARCHAR), '') ELSE c_name END AS nombre,
  CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END AS anulado
FROM cash JOIN specific ON k = l_orderkey LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = oper
""")
def job_teller_transactions(t):
    """Cash movements with the client found through the first specific line of the operation."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_linestatus", "l_returnflag", "l_shipdate"
    )
    cash = lines.filter((F.col("l_returnflag") == "A") & P.since_day("l_shipdate", "1999-01-01"))
    ref = F.when(F.col("l_linestatus") == "O", F.concat("l_suppkey", F.lit(" deposito"))).otherwise(F.concat(F.lit("REF "), "l_suppkey"))
    specific = L.first_per_key(
        lines.filter("l_returnflag <> 'R'"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    ).select("l_orderkey", F.col("l_partkey").alias("hcta"), X.first_token_int(ref).alias("oper"))
    client = J.lookup(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_name"])
    per_order = J.lookup(specific, client, {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderstatus", "c_name"])
    per_order = J.lookup(per_order, t.supplier, {"oper": "s_suppkey"}, ["s_name", "s_nationkey"])
    df = J.lookup(cash, per_order, "l_orderkey", how="inner")
    module, kind = F.col("l_linenumber"), F.col("l_linestatus")
    account = K.transaction_router(
        module, kind,
        [K.Route(1, ("O",), N.null_default(F.col("o_custkey"), 0)), K.Route(1, ("F",), N.null_default(F.col("s_nationkey"), 0).cast("long"))],
        F.col("hcta"),
    )
    operation = K.transaction_router(module, kind, [K.Route(1, ("F",), N.null_default(F.col("oper"), 0).cast("long"))], F.col("l_orderkey"))
    name = K.transaction_router(
        module, kind, [K.Route(1, ("F",), X.concat_blank(F.trim("s_name"), F.lit(" "), F.col("s_nationkey")))], F.col("c_name")
    )
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("importe"), account.alias("cuenta"),
        operation.alias("operacion"), name.alias("nombre"), K.yes_no(F.col("o_orderstatus") == "F", "S", "N").alias("anulado"),
    )
