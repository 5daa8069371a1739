"""JSON operators. The provided tables hold little JSON, so documents are built from whole
rows and texts first; the expected SQL reads the rows directly."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import jsonvals as V
from tallyframe.functions import variants as W
from tallyframe.plans.registry import query
from tallyframe.session import new_table_path
from tallyframe.sources import payloads as S


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events
""")
def json_parse_schema(t):
    parsed = S.json_parse_schema(t.events, "props", "k INT, missing STRING")
    return parsed.select("event_id", "doc.k", "doc.missing")


@query("""
SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total FROM events GROUP BY event_type
""")
def json_column_infer(t):
    parsed = S.json_column_infer(t.events.select("event_type", "props"), "props")
    return parsed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("doc.k").alias("total"))


_SESSION_STEPS = [
    ("token", "raw", "App STRING, User STRING, Ip STRING, FingerPrint STRING"),
    ("finger", "token.FingerPrint", "country STRING, region STRING, Info STRING"),
    ("info", "finger.Info", "ua STRING, browser STRING, os STRING"),
    ("browser", "info.browser", "name STRING, version STRING"),
    ("os", "info.os", "name STRING, version STRING"),
]


def session_token():
    """A channel token: JSON text inside JSON text, four levels deep."""
    browser = F.to_json(F.struct(F.col("event_type").alias("name"), F.col("user_id").cast("string").alias("version")))
    os = F.to_json(F.struct(F.lit("os").alias("name"), F.when(F.col("value") > 10, "2.1").alias("version")))
    info = F.to_json(F.struct(F.lit("agent \"x\"").alias("ua"), browser.alias("browser"), os.alias("os")))
    finger = F.to_json(F.struct(F.lit("CO").alias("country"), F.col("event_type").alias("region"), info.alias("Info")))
    return F.to_json(
        F.struct(F.lit("web").alias("App"), F.col("user_id").cast("string").alias("User"), F.col("props").alias("Ip"), finger.alias("FingerPrint"))
    )


@query("""
SELECT event_id, props AS ip, 'CO' AS country, event_type AS region, 'agent "x"' AS ua, event_type || ' ' || user_id AS browser,
  CASE WHEN value > 10 THEN 'os 2.1' ELSE 'os' END AS app FROM events
""")
def json_nested_string_chain(t):
    raw = t.events.select("event_id", session_token().alias("raw"))
    opened = S.json_chain(raw, "raw", _SESSION_STEPS)
    return opened.select(
        "event_id", F.col("token.Ip").alias("ip"), "finger.country", "finger.region", "info.ua",
        F.concat_ws(" ", "browser.name", "browser.version").alias("browser"),
        F.concat_ws(" ", "os.name", "os.version").alias("app"),
    )


@query("""
SELECT conv_id, turn, CAST(n AS VARCHAR) AS id, role AS estado, md5(line) AS asunto_md5, CASE WHEN role <> 'system' THEN lower(role) END AS cf_canal, CAST(NULL AS VARCHAR) AS cf_falta
FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM conversations)
""")
def json_envelope_records(t):
    """One envelope per message, one record per line of its text."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            (i + 1).alias("id"), F.col("role").alias("idestado"), line.alias("asunto"),
            F.struct(F.when(F.col("role") != "system", F.lower("role")).alias("canal_resp")).alias("cf"),
        ),
    )
    payload = F.to_json(F.struct(F.struct(lines.alias("Table")).alias("detalle")))
    rows = S.json_envelope_records(
        t.conversations.select("conv_id", "turn", payload.alias("raw")), "raw", ["detalle", "Table"],
        {"id": "id", "estado": "idestado", "asunto": "asunto", "cf_canal": "cf.canal_resp", "cf_falta": "cf.departamento_cod"},
        keep=["conv_id", "turn"],
    )
    return rows.withColumn("asunto_md5", F.md5("asunto")).drop("asunto")


def application_document():
    """A credit application: root object, nested objects, references as a list, accents."""
    return F.to_json(
        F.struct(
            F.lit("1").alias("version"),
            F.struct(
                F.concat(F.lit("G"), F.col("conv_id")).alias("GuidEngine"),
                F.struct(
                    F.col("turn").alias("Secuencial"),
                    F.struct(F.col("text").alias("Descripción"), F.col("role").alias("TipoCanal")).alias("detalle"),
                ).alias("orden"),
                F.array(
                    F.struct(F.lit(None).cast("string").alias("NombreReferencia"), F.lit(1).alias("n")),
                    F.struct(F.col("role").alias("NombreReferencia"), F.lit(2).alias("n")),
                    F.struct(F.lit("last").alias("NombreReferencia"), F.lit(3).alias("n")),
                ).alias("referencias"),
            ).alias("Peticion"),
        )
    )


DEEP_FIND_SQL = """
SELECT conv_id, turn, 'G' || conv_id AS guid, md5(text) AS text_md5, role AS canal, role AS referencia, CAST(turn AS VARCHAR) AS secuencial,
  '1' AS n, CAST(NULL AS VARCHAR) AS nada, role AS segundo FROM conversations
"""


@query(DEEP_FIND_SQL)
def json_deep_find(t):
    """Keys anywhere in whole documents, by exact, folded and ending match."""
    docs = t.conversations.select("conv_id", "turn", application_document().alias("doc"))
    return _found(V.with_json_nodes(docs, "doc"))


def _found(opened):
    nodes = F.col("nodes")
    return opened.select(
        "conv_id", "turn",
        V.deep_find(nodes, ["GuidEngine"]).alias("guid"),
        F.md5(V.deep_find(nodes, ["DESCRIPCION"], "folded")).alias("text_md5"),
        V.deep_find(nodes, ["canal"], "suffix").alias("canal"),
        V.deep_find(nodes, ["NombreReferencia"]).alias("referencia"),
        V.deep_find(nodes, ["Secuencial"]).alias("secuencial"),
        V.deep_find(nodes, ["n"]).alias("n"),
        V.deep_find(nodes, ["nada"]).alias("nada"),
        V.deep_find(nodes, ["ausente", "tipocanal"], "folded").alias("segundo"),
    )


@query(DEEP_FIND_SQL)
def json_documents_stored(t):
    """The same search over documents that were parsed once and stored as variants: no text is parsed again."""
    docs = t.conversations.select("conv_id", "turn", application_document().alias("doc"))
    path = new_table_path(docs.sparkSession, "documents")
    W.with_document(docs, "doc").drop("doc").write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    return _found(W.with_nodes(stored, "document"))


@query("""
SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS doc FROM customer
""")
def json_serialize(t):
    return t.customer.select("c_custkey", F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment")).alias("doc"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS first_value,
  CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN p_name ELSE p_name || ', ' || p_brand END AS joined,
  CASE WHEN p_size % 3 = 0 THEN '0' WHEN p_size % 3 = 1 THEN '["' || p_name || '"]' ELSE '["' || p_name || '","' || p_brand || '"]' END AS otros
FROM part
""")
def json_array_values(t):
    kind = F.col("p_size") % 3
    values = (
        F.when(kind == 0, F.array().cast("array<string>"))
        .when(kind == 1, F.array("p_name"))
        .otherwise(F.array("p_name", "p_brand"))
    )
    return t.part.select(
        "p_partkey", V.array_first_or_join(values, first_only=True).alias("first_value"),
        V.array_first_or_join(values).alias("joined"), V.array_empty_default(values).alias("otros"),
    )
