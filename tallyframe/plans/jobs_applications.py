"""Jobs over application documents and API payloads, built from whole conversations."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import dates as D
from tallyframe.functions import jsonvals as V
from tallyframe.functions import numbers as N
from tallyframe.functions import text as X
from tallyframe.functions import variants as W
from tallyframe.operators import aggregates as A
from tallyframe.operators import columns as C
from tallyframe.operators import latest as L
from tallyframe.operators import merges as M
from tallyframe.operators import predicates as P
from tallyframe.plans.registry import EVENTS_AS_OF, query
from tallyframe.session import new_table_path
from tallyframe.sources import payloads as S
from tallyframe.sources.files import scan_csv

# Prefixes of the wanted application columns.
APPLICATION_PREFIXES = ("DI_", "CVD_", "REF_", "AC_", "OFC_")


class SectionField(NamedTuple):
    """A form field of the wide table: its number, column, section of the document, and key there."""

    number: int
    column: str
    section: str
    key: str


def section_fields() -> list[SectionField]:
    """The numbered fields of an application's forms, by rule: data of two persons, three loans, references, a business and obligations.

    Keys differ from columns as they do in documents: without the prefix, in capitals, with an accent, under the whole name, or
    (obligations) with something before them.
    """
    names = [("DI_", f"Dato{n}{person}", person.lower()) for person in ("Titular", "Conyuge") for n in range(1, 46)]
    names += [("CVD_", f"Cuota{n}Credito{k}", f"vigente{k}") for k in (1, 2, 3) for n in range(1, 9)]
    names += [("REF_", f"Contacto{n}", "contactos") for n in range(1, 9)]
    names += [("AC_", f"Negocio{n}Conyuge", "negocio") for n in range(1, 45)]
    names += [("OFC_", f"Plazo{n}Obligacion", "obligaciones") for n in range(1, 24)]
    out = []
    for i, (prefix, bare, section) in enumerate(names):
        keys = (bare, bare.upper(), bare.replace("o", "\u00f3", 1), prefix + bare)
        out.append(SectionField(i, prefix + bare, section, f"Linea_{bare}" if prefix == "OFC_" else keys[i % 4]))
    return out


SECTION_FIELDS = section_fields()


def _section_value(field: SectionField):
    """One of five messages has a field."""
    text = F.concat(F.col("role"), F.lit(f"-{field.number}-"), (F.col("conv_id") % 7).cast("string"))
    return F.when((F.col("turn") + field.number) % 5 == 0, text)


def _section_sql() -> str:
    return ", ".join(
        f"""coalesce(arg_min(role, turn) FILTER ((turn + {f.number}) % 5 = 0) || '-{f.number}-' || (conv_id % 7), '') AS "{f.column}\"""" for f in SECTION_FIELDS
    )


def _application(t):
    """One nested document per message; the first message of some talks has gaps."""
    known = F.col("role") != "system"
    turn = F.col("turn")
    guid = F.when(F.col("conv_id") % 10 != 9, F.concat(F.lit("G"), F.col("conv_id")))
    applicant = F.struct(
        F.col("role").alias("NombreTitular"),
        F.when(turn % 2 == 0, "0001-01-01T00:00:00").otherwise("1980-05-17T00:00:00").alias("FechaNacimientoTitular"),
        F.struct(
            F.when(turn == 0, F.lit("NaN")).otherwise(F.concat(turn, F.lit(".0"))).alias("SalarioPensión"),
            F.when(known, (turn * 100).cast("string")).alias("OtrosIngresos"),
        ).alias("ingresos"),
    )
    references = F.array(
        F.struct(F.concat(F.lit("ref "), F.col("role")).alias("NombreReferencia")),
        F.struct(F.lit("otra").alias("NombreReferencia")),
    )
    sections = F.struct(
        *[F.struct(*[_section_value(f).alias(f.key) for f in SECTION_FIELDS if f.section == name]).alias(name) for name in dict.fromkeys(f.section for f in SECTION_FIELDS)]
    )
    goods = F.when(turn % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("role", F.lit("casa")))
    doc = F.struct(
        F.struct(
            guid.alias("GuidEngine"), F.concat(F.lit("F"), F.col("conv_id")).alias("IdExterno"),
            F.when(known, F.concat(F.lit(" "), F.col("role"), F.lit(" "))).alias("Usuario"),
            F.when(turn > 1, F.concat(F.col("role"), F.lit("@x.co"))).alias("EmailUsuario"),
            F.when(turn > 0, F.lit("2024-01-10T10:00:00")).alias("FechaCarge"),
            applicant.alias("titular"), references.alias("referencias"), goods.alias("BienesTitular"),
            F.col("text").alias("ObservacionAnalista"), sections.alias("formulario"),
        ).alias("Peticion")
    )
    return t.conversations.select("conv_id", "turn", F.to_json(doc).alias("doc"))


# The wanted columns of the wide table, with other names their values have in documents.
APPLICATION_COLUMNS = (
    "Usuario", "EmailUsuario", "DI_NombreTitular", "DI_FechaNacimientoTitular", "CVD_SalarioPension", "CVD_OtrosIngresos",
    "REF_NombreReferencia", "DI_BienesTitular", "DI_Referencias", "DI_Ingresos", "DI_FechaCarge", "DI_Correo", "OFC_Externo",
)
APPLICATION_ALIASES = {"DI_Correo": "EmailUsuario"}
WIDE_COLUMNS = (*APPLICATION_COLUMNS, *(f.column for f in SECTION_FIELDS))


def application_fields() -> list[V.Field]:
    """A column is looked for under its alias, under its whole name, without its prefix, and last by the ending of a name."""
    out = []
    for column in WIDE_COLUMNS:
        bare = C.strip_prefix(column, APPLICATION_PREFIXES)
        alias = [APPLICATION_ALIASES[column]] if column in APPLICATION_ALIASES else []
        out.append(V.Field(column, (*alias, column, bare) if bare != column else (*alias, bare), by_ending=column.startswith("OFC_")))
    return out


_APP_GROUP_SQL = """
d AS (SELECT *, CASE WHEN conv_id % 10 <> 9 THEN 'G' || conv_id END AS guid FROM conversations),
f AS (SELECT guid, conv_id, arg_min(role, turn) AS role0, min(turn) AS turn0, min(turn) FILTER (WHERE role <> 'system') AS turn_known,
  arg_min(role, turn) FILTER (WHERE role <> 'system') AS role_known, min(turn) FILTER (WHERE turn > 1) AS turn_mail, arg_min(role, turn) FILTER (WHERE turn > 1) AS role_mail,
  arg_min(text, turn) AS text0, max(turn) AS last_turn, min(turn) FILTER (WHERE turn % 2 = 1) AS turn_odd, min(turn) FILTER (WHERE turn % 3 <> 0) AS turn_goods,
  arg_min(role, turn) FILTER (WHERE turn % 3 <> 0) AS role_goods, min(turn) FILTER (WHERE turn > 0) AS turn_pos
  FROM d WHERE guid IS NOT NULL GROUP BY guid, conv_id)
"""


@query(f"""
WITH {_APP_GROUP_SQL}
SELECT guid AS "GuidEngine", 'F' || conv_id AS "IdExterno", coalesce(role_known, '') AS "Usuario", coalesce(upper(role_mail || '@x.co'), '') AS "EmailUsuario",
  role0 AS "DI_NombreTitular", CASE WHEN turn_odd IS NULL THEN '' ELSE '1980-05-17' END AS "DI_FechaNacimientoTitular", coalesce(CASE WHEN turn0 = 0 THEN 'NaN' ELSE CAST(turn0 AS VARCHAR) END, '') AS "CVD_SalarioPension",
  'ref ' || role0 AS "REF_NombreReferencia", 'ref ' || role0 || ', otra' AS "DI_Referencias", coalesce(CASE WHEN turn0 = 0 THEN 'NaN' ELSE CAST(turn0 AS VARCHAR) END, '') AS "DI_Ingresos", CASE WHEN turn_goods IS NULL THEN '' ELSE role_goods || ', casa' END AS "DI_BienesTitular",
  CASE WHEN turn_pos IS NULL THEN '2024-01-15' ELSE '2024-01-10' END AS "DI_FechaCarge",
  coalesce(CAST(turn_known * 100 AS VARCHAR), '') AS "CVD_OtrosIngresos", coalesce(role_mail || '@x.co', '') AS "DI_Correo", 'F' || conv_id AS "OFC_Externo", g.* EXCLUDE (gid)
FROM f JOIN (SELECT conv_id AS gid, {_section_sql()} FROM d WHERE guid IS NOT NULL GROUP BY conv_id) g ON f.conv_id = g.gid
WHERE role_known IS NOT NULL OR role_mail IS NOT NULL
""")
def job_application_wide(t):
    """The wide application table from documents of unknown shape.

    A document is parsed once. Only wanted values leave it, as rows that meet the catalogue of fields; each is put in order
    by itself, the first of each application and column is taken by an aggregate of narrow rows, and the columns are put side by
    side last.
    """
    opened = W.with_document(_application(t), "doc")
    keys = ["GuidEngine", "IdExterno"]
    wanted = [*[V.Field(k, (k,)) for k in keys], *application_fields()]
    names = W.with_nodes(opened, "document", "nodes", W.wants(wanted))
    keyed = names.select("turn", "nodes", F.col("document.opens").alias("opens"), *[V.deep_find(F.col("nodes"), [k], "folded").alias(k) for k in keys])
    found = V.found_fields(P.drop_null_key(keyed, "GuidEngine"), "nodes", [*keys, "turn", "opens"], application_fields())
    # Through a generator, so that the filter on values does not work them out a second time.
    found = found.withColumn("value", F.explode(F.array(_application_value(F.col("item"), F.col("value"), F.col("opens"), F.col("column")))))
    first = found.filter("value is not null").groupBy(*keys, "column").agg(F.min_by("value", F.struct("turn", "rank", "position")).alias("value"))
    # At most one entry per wanted column.
    side = first.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("by_column"))
    wide = side.select(*keys, *[F.try_element_at("by_column", F.lit(c)).alias(c) for c in WIDE_COLUMNS])
    kept = C.clean_null_rows(wide, ["Usuario", "EmailUsuario"])
    return M.fill_blank_date(C.null_to_blank_all(kept), "DI_FechaCarge", EVENTS_AS_OF)


def _application_value(item, text, opens, column):
    """A found value as the wide table wants it: lists as one text, the first entry alone for references, dates cut and checked.

    Each step is worked out once, whatever the next one does with it.
    """
    one = W.once(
        W.listed(item, opens),
        lambda items: F.when(items.isNotNull(), X.list_items_normalize(items, column.startswith("REF_"))).otherwise(_plain_application_value(item, text, opens)),
    )
    whole = W.once(one, X.strip_trailing_zero_decimal)
    born = lambda v: D.parse_date(F.substring(D.sentinel_to_null(v), 1, 10)).cast("string")
    return W.once(
        whole,
        lambda v: F.when(column == "Usuario", F.trim(v)).when(column == "EmailUsuario", F.upper(v))
        .when(column == "DI_FechaNacimientoTitular", born(v)).when(column == "DI_FechaCarge", F.substring(v, 1, 10)).otherwise(v),
    )


def _plain_application_value(item, text, opens):
    nested = F.startswith(F.ltrim(text), F.lit("{"))
    return W.once(F.when(nested, W.first_plain(item, opens)).otherwise(text), lambda v: X.tidy(F.trim(v)))


# The declared type of application documents.
APPLICATION_TYPE = """
Peticion STRUCT<GuidEngine: STRING, IdExterno: STRING, Usuario: STRING, EmailUsuario: STRING, FechaCarge: STRING,
  titular: STRUCT<NombreTitular: STRING, FechaNacimientoTitular: STRING, ingresos: STRUCT<`SalarioPensión`: STRING, OtrosIngresos: STRING>>,
  referencias: ARRAY<STRUCT<NombreReferencia: STRING>>, BienesTitular: ARRAY<STRING>, ObservacionAnalista: STRING>
"""


@query(f"""
WITH {_APP_GROUP_SQL}
SELECT guid AS "GuidEngine", 'F' || conv_id AS "IdExterno", CAST(turn_pos AS DOUBLE) AS "Salario", CAST(turn_known * 100 AS DOUBLE) AS "Otros Ingresos",
  CASE WHEN turn0 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-01-10' END AS "Fecha Carge" FROM f
""")
def job_application_income(t):
    """Income columns by declared schema: numbers, default dates, first known value."""
    docs = S.json_parse_schema(_application(t), "doc", APPLICATION_TYPE, "parsed")
    flat = docs.select("turn", "parsed.Peticion.*").select(
        "turn", "GuidEngine", "IdExterno", N.nan_to_null(F.col("titular.ingresos.`SalarioPensión`")).alias("Salario"),
        N.nan_to_null(F.col("titular.ingresos.OtrosIngresos")).alias("Otros Ingresos"),
        D.default_date(D.parse_date(F.substring("FechaCarge", 1, 10)), EVENTS_AS_OF).alias("Fecha Carge"),
    )
    flat = P.drop_null_key(flat, "GuidEngine")
    return A.first_values(flat, ["GuidEngine", "IdExterno"], ["turn"], ["Salario", "Otros Ingresos", "Fecha Carge"])


@query(f"""
WITH {_APP_GROUP_SQL}
SELECT guid AS "GuidEngine", 'F' || conv_id AS "IdExterno", role_known AS "Usuario", upper(role_mail || '@x.co') AS "EmailUsuario", DATE '2024-01-10' AS "FechaCarge", CAST(NULL AS VARCHAR) AS "LineaFNG"
FROM f WHERE turn_pos IS NOT NULL AND (role_known IS NOT NULL OR role_mail IS NOT NULL)
""")
def job_application_base(t):
    """Columns resolved against the declared schema; what is missing is null."""
    docs = S.json_parse_schema(_application(t), "doc", APPLICATION_TYPE, "parsed").select("turn", "parsed.*")
    flat = C.select_available(
        docs, ["GuidEngine", "IdExterno", "Usuario", "EmailUsuario", "FechaCarge", "LineaFNG"], keep=["turn"], root="Peticion"
    )
    flat = P.drop_null_key(flat, "GuidEngine").withColumns(
        {
            "Usuario": F.trim("Usuario"), "EmailUsuario": X.trim_upper(F.col("EmailUsuario")),
            "FechaCarge": D.parse_date(F.substring(D.sentinel_to_null(F.col("FechaCarge")), 1, 10)),
        }
    )
    first = A.first_values(flat, ["GuidEngine", "IdExterno"], ["turn"], ["Usuario", "EmailUsuario", "FechaCarge", "LineaFNG"])
    return C.clean_null_rows(first, ["Usuario", "EmailUsuario"]).filter(F.col("FechaCarge").isNotNull())


@query(f"""
WITH {_APP_GROUP_SQL}
SELECT guid AS "GuidEngine", 'F' || conv_id AS "IdExterno", role0 AS "Nombre", CASE WHEN turn0 > 0 THEN CAST(turn0 AS DOUBLE) END AS "Valor",
  CASE WHEN turn0 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-01-10' END AS "Fecha Carge", md5(text0) AS "Observacion" FROM f
""")
def job_application_request(t):
    """Exact keys anywhere in the document; the first row per application, nulls kept."""
    opened = V.with_json_nodes(_application(t), "doc")
    nodes = F.col("nodes")
    flat = opened.select(
        "turn", V.deep_find(nodes, ["GuidEngine"]).alias("GuidEngine"), V.deep_find(nodes, ["IdExterno"]).alias("IdExterno"),
        V.deep_find(nodes, ["NombreTitular"]).alias("Nombre"),
        N.nan_to_null(V.deep_find(nodes, ["SalarioPensión"])).alias("Valor"),
        D.default_date(D.parse_date(F.substring(V.deep_find(nodes, ["FechaCarge"]), 1, 10)), EVENTS_AS_OF).alias("Fecha Carge"),
        F.md5(V.deep_find(nodes, ["ObservacionAnalista"])).alias("Observacion"),
    )
    flat = P.drop_null_key(flat, "GuidEngine")
    first = A.first_values(
        flat, ["GuidEngine", "IdExterno"], ["turn"], ["Nombre", "Valor", "Fecha Carge", "Observacion"], skip_nulls=False
    )
    return C.clean_null_rows(first, ["Nombre", "Valor"])


def _work_order_payload(t):
    """One payload per message with two records: an old and a new state of one order."""
    def record(state, hour):
        return F.struct(
            F.concat(F.lit("W"), F.col("conv_id")).alias("IdWorkOrder"), F.col("role").alias("UsuarioAsignado"),
            F.lit(state).alias("Estado"), F.concat(F.lit("2024-01-"), F.lpad((F.col("turn") + 1).cast("string"), 2, "0"), F.lit(hour)).alias("FechaInicioOrden"),
        )

    records = F.array(record("abierta", " 08:00:00"), record("cerrada", " 17:30:00"))
    return t.conversations.select(F.to_json(F.struct(F.struct(records.alias("record")).alias("records"))).alias("raw"))


@query("""
SELECT 'W' || conv_id AS "IdWorkOrder", arg_max(role, turn) AS "UsuarioAsignado", 'cerrada' AS "Estado",
  '2024-01-' || lpad(CAST(max(turn) + 1 AS VARCHAR), 2, '0') || ' 17:30:00' AS "FechaInicioOrden", CAST(NULL AS VARCHAR) AS "FechaFinOrden", DATE '2024-01-16' AS cargado
FROM conversations GROUP BY conv_id
""")
def job_work_orders(t):
    """Work orders of an API payload, newest state per order."""
    fields = ["IdWorkOrder", "UsuarioAsignado", "Estado", "FechaInicioOrden", "FechaFinOrden"]
    rows = S.json_envelope_records(_work_order_payload(t), "raw", ["records", "record"], {f: f for f in fields})
    rows = rows.withColumn("cargado", D.run_date(EVENTS_AS_OF))
    return L.dedupe_by_key(rows, "IdWorkOrder", ["FechaInicioOrden", "UsuarioAsignado"])


@query("""
SELECT 'T' || conv_id || '-' || turn AS id, role AS idestadodesc, md5(text) AS asunto_md5, CASE WHEN role = 'user' THEN 'web' END AS cf_canal_resp, CAST(NULL AS VARCHAR) AS cf_municipio_cod,
  DATE '2024-01-01' + CAST(turn AS INTEGER) AS fecha FROM conversations
""")
def job_tickets(t):
    """Ticket records with nested custom fields; absent fields are null, not the text None."""
    cf = F.struct(F.when(F.col("role") == "user", "web").alias("canal_resp"))
    created = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")), "yyyy-MM-dd 10:15:00")
    ticket = F.struct(
        F.concat(F.lit("T"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("id"), F.col("role").alias("idestadodesc"),
        F.col("text").alias("asunto"), created.alias("fechacreacion"), cf.alias("cf"),
    )
    raw = t.conversations.select(F.to_json(F.struct(F.array(ticket).alias("data"))).alias("raw"))
    rows = S.json_envelope_records(
        raw, "raw", ["data"],
        {"id": "id", "idestadodesc": "idestadodesc", "asunto": "asunto", "fechacreacion": "fechacreacion",
         "cf_canal_resp": "cf.canal_resp", "cf_municipio_cod": "cf.municipio_cod"},
    )
    return rows.select(
        "id", "idestadodesc", F.md5("asunto").alias("asunto_md5"), "cf_canal_resp", "cf_municipio_cod",
        F.to_date(D.parse_timestamp(F.col("fechacreacion"))).alias("fecha"),
    )


@query("""
SELECT CAST(conv_id AS VARCHAR) AS "DocumentoIdentidad", role AS "TipodeAcuerdo", DATE '2024-01-01' + CAST(turn AS INTEGER) AS "Fecha" FROM conversations
""")
def job_agreements(t):
    """Payload keys with colons and blanks; the identity column is found by its words."""
    signed = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")), "dd/MM/yyyy")
    record = F.struct(
        F.col("conv_id").cast("string").alias(" Documento de Identidad: "), F.col("role").alias("Tipo de Acuerdo:"),
        signed.alias("Fecha "),
    )
    raw = t.conversations.select(F.to_json(record).alias("raw"))
    docs = S.json_parse_schema(raw, "raw", "` Documento de Identidad: ` STRING, `Tipo de Acuerdo:` STRING, `Fecha ` STRING").select("doc.*")
    named = C.rename_by_pattern(docs, {("documento", "identidad"): "DocumentoIdentidad"})
    named = named.toDF(*[c.replace(":", "").replace(" ", "") for c in named.columns])
    return named.withColumn("Fecha", D.parse_date(F.col("Fecha"), "dd/MM/yyyy"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS "IDENTIFICACION", s_name AS "NOMBRE", DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS ingreso, CAST(NULL AS DATE) AS retiro FROM supplier
""")
def job_employees(t):
    """Employee records with text timestamps."""
    hired = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int")), "yyyy-MM-dd'T'00:00:00")
    record = F.struct(F.col("s_suppkey").alias("IDENTIFICACION"), F.col("s_name").alias("NOMBRE"), hired.alias("FECHAINGRESO"), F.lit("").alias("FECHARETIRO"))
    raw = t.supplier.select(F.to_json(F.struct(F.struct(F.array(record).alias("Table")).alias("detalle"))).alias("raw"))
    fields = ["IDENTIFICACION", "NOMBRE", "FECHAINGRESO", "FECHARETIRO"]
    rows = S.json_envelope_records(raw, "raw", ["detalle", "Table"], {f: f for f in fields})
    return rows.select(
        "IDENTIFICACION", "NOMBRE", F.col("FECHAINGRESO").try_cast("timestamp_ntz").cast("date").alias("ingreso"),
        F.col("FECHARETIRO").try_cast("timestamp_ntz").cast("date").alias("retiro"),
    )


@query("""
SELECT o_orderkey AS "CREDITO", CAST(o_orderdate AS DATE) AS "FECHA_APERTURA", CASE WHEN o_orderstatus = 'F' THEN CAST(NULL AS DOUBLE) ELSE o_totalprice END AS "SALDO_INICIAL" FROM orders
""")
def job_initial_balances(t):
    """A semicolon file with accented headers, dates as day/month/year and gaps."""
    path = new_table_path(t.spark, "balances_csv")
    t.orders.select(
        F.col("o_orderkey").alias("Crédito"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha Apertura"),
        F.when(F.col("o_orderstatus") == "F", "s/d").otherwise(F.col("o_totalprice").cast("string")).alias(" Saldo Inicial"),
    ).write.options(sep=";", encoding="ISO-8859-1", header=True).csv(path)
    names = ["Crédito", "Fecha Apertura", " Saldo Inicial"]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = scan_csv(t.spark, path, text, sep=";", encoding="ISO-8859-1", normalize=True)
    return df.select(
        F.col("CREDITO").try_cast("long").alias("CREDITO"), D.parse_date(F.col("FECHA_APERTURA"), "dd/MM/yyyy").alias("FECHA_APERTURA"),
        N.nan_to_null(F.col("SALDO_INICIAL")).alias("SALDO_INICIAL"),
    )
