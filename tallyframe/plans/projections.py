"""Projection, naming and conforming."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import columns as C
from tallyframe.operators import quality as Q
from tallyframe.plans.registry import query
from tallyframe.sinks.loads import truncate_load
from tallyframe.session import new_table_path


@query("""
SELECT c_custkey AS cuenta, c_name AS nombre, c_mktsegment AS segmento, 1 AS empresa, 'CLIENTE' AS rol,
       c_acctbal * 2 AS doble
FROM customer
""")
def project_rename_and_constants(t):
    base = t.customer.withColumn("doble", F.col("c_acctbal") * 2)
    named = C.project_rename(
        base, {"c_custkey": "cuenta", "c_name": "nombre", "c_mktsegment": "segmento", "doble": "doble"}
    )
    return C.constant_columns(named, {"empresa": 1, "rol": "CLIENTE"})


@query("""
SELECT *, CAST(o_orderdate AS DATE) AS fecha, o_totalprice / 2 AS mitad FROM (SELECT * EXCLUDE (o_orderdate), o_orderdate FROM orders)
""".replace("*, CAST", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST"))
def select_star_plus(t):
    return t.orders.select(
        "*", F.to_date("o_orderdate").alias("fecha"), (F.col("o_totalprice") / 2).alias("mitad")
    ).drop("o_orderdate")


@query("""
SELECT p_partkey AS "CODIGO_OFICINA", p_brand AS "REGION", p_size AS "NUMERO_DE_EMPLEADOS", p_name AS usuario_engine
FROM part
""")
def normalize_and_rename_columns(t):
    df = t.part.select(
        F.col("p_partkey").alias(" Código Oficina "),
        F.col("p_brand").alias("Región"),
        F.col("p_size").alias("Número de  empleados"),
        F.col("p_name").alias("Usuario (Engine) asignado"),
    )
    df = C.rename_by_pattern(df, {("usuario", "engine"): "usuario_engine"})
    upper = C.normalize_column_names(df.drop("usuario_engine"))
    return C.normalize_column_names(df).select(*upper.columns, F.col("USUARIO_ENGINE").alias("usuario_engine"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "IdExterno", c_name AS "DI_Nombre", c_mktsegment AS "Region", '' AS "CVD_Faltante",
       CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS "REF_Segmento", 'n/a' AS "OFC_Fallback"
FROM customer
""")
def select_available_columns(t):
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    df = t.customer.select(
        F.col("c_custkey").alias("idexterno"),
        F.struct(F.col("c_name").alias("Nombre"), segment.alias("Segmento")).alias("Peticion"),
        F.struct(F.struct(F.col("c_mktsegment").alias("Región")).alias("inner")).alias("outer"),
    )
    wanted = ["IdExterno", "DI_Nombre", "Region", "CVD_Faltante", "REF_Segmento", "OFC_Fallback"]
    picked = C.select_available(
        df, wanted, root="Peticion", prefixes=("DI_", "CVD_", "REF_", "AC_", "OFC_"),
        fallback={"OFC_Fallback": F.lit("n/a")},
    )
    return C.null_to_blank_all(C.ensure_columns(picked, wanted))


@query("""
SELECT c_custkey, c_name, '' AS extra, c_acctbal FROM customer
""")
def ensure_columns_in_order(t):
    return C.ensure_columns(t.customer, ["c_custkey", "c_name", "extra", "c_acctbal"])


@query("""
SELECT CAST(c_custkey AS INTEGER) AS custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS acctbal,
       TRY_CAST(c_mktsegment AS INTEGER) AS segment_no, CAST(NULL AS VARCHAR) AS missing, c_name AS name
FROM customer
""")
def conform_to_schema(t):
    named = t.customer.toDF("CustKey", "name", "nation", "AcctBal", "segment_no")
    target = T.StructType(
        [
            T.StructField("custkey", T.IntegerType()),
            T.StructField("acctbal", T.DecimalType(18, 2)),
            T.StructField("segment_no", T.IntegerType()),
            T.StructField("missing", T.StringType()),
            T.StructField("name", T.StringType()),
        ]
    )
    return C.conform_to_schema(named, target).withColumn("acctbal", F.col("acctbal").cast("double"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, substring(c_name, 1, 12) AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, substring(c_mktsegment, 1, 4) AS c_mktsegment
FROM customer
""")
def cast_all_string_and_truncate(t):
    text = C.cast_all_string(t.customer.drop("c_acctbal"))
    return C.truncate_strings(text, {"c_name": 12, "c_mktsegment": 4})


@query("""
SELECT doc_id, substring(text, 1, 256) AS text, lang FROM documents
""")
def truncate_text_default(t):
    return C.truncate_strings(t.documents.select("doc_id", "text", "lang"), {"text": 256, "lang": 256})


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_line_keys(t):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderkey, count(*) AS copies FROM orders GROUP BY o_orderkey HAVING count(*) > 1
""")
def duplicate_order_keys(t):
    return Q.duplicate_keys(t.orders, ["o_orderkey"])


@query("""
SELECT s_suppkey, s_name FROM supplier
""")
def checked_load(t):
    df = Q.require_unique(
        Q.require_non_empty(Q.require_columns(t.supplier, ["s_suppkey", "s_name"]), "supplier"), ["s_suppkey"]
    ).select("s_suppkey", "s_name")
    counted, seen = Q.with_row_count(df)
    path = new_table_path(t.spark, "supplier")
    loaded = Q.skip_if_empty(counted, lambda d: truncate_load(d, path))
    seen.get["rows"]
    return loaded
