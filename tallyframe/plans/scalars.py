"""Text, date and number functions on whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import dates as D
from tallyframe.functions import numbers as N
from tallyframe.functions import text as X
from tallyframe.operators import columns as C
from tallyframe.operators import joins as J
from tallyframe.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, query


@query("""
SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS nombre,
  substring(replace(trim(replace(replace(replace('  calle;' || c_custkey || '  |no' || chr(10) || ' ' || c_mktsegment || ' ', ';', ''), '|', ''), '  ', ' ')), chr(10), ''), 1, 500) AS direccion
FROM customer
""")
def text_trim_and_replace_chain(t):
    address = F.concat(F.lit("  calle;"), F.col("c_custkey"), F.lit("  |no\n "), F.col("c_mktsegment"), F.lit(" "))
    return t.customer.select(
        "c_custkey",
        X.trim_upper(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("nombre"),
        X.clean_address(address, 500).alias("direccion"),
    )


@query("""
SELECT doc_id, md5(regexp_replace(text, '[\\n\\r\\t]', ' ', 'g')) AS text_md5, length(text) AS n, lang, source FROM documents
""")
def text_clean_control_chars(t):
    """Every text column of whole documents."""
    cleaned = C.map_text_columns(t.documents.select("doc_id", "text", "lang", "source"), X.clean_control_chars)
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"), "lang", "source")


@query("""
SELECT doc_id, md5(lower(strip_accents(text))) AS folded_md5 FROM documents
""")
def text_fold_accents(t):
    return t.documents.select("doc_id", F.md5(F.lower(X.fold_accents(F.col("text")))).alias("folded_md5"))


@query("""
SELECT page_id, md5(regexp_replace(html, '[^0-9]', '', 'g')) AS digits_md5, length(html) AS n,
  CASE WHEN length(url) >= 32 THEN substring(url, 9, 10) END AS cuenta,
  CASE WHEN regexp_matches(url, '^https?://[a-z.]+/[a-z]+/[0-9]+$') THEN 1 ELSE 0 END AS plain_url
FROM pages
""")
def text_digits_slices_and_patterns(t):
    url = F.col("url")
    return t.pages.select(
        "page_id", F.md5(X.strip_non_digits(F.col("html"))).alias("digits_md5"), F.length("html").alias("n"),
        X.guarded_substring(url, 32, 9, 10).alias("cuenta"),
        F.when(url.rlike("^https?://[a-z.]+/[a-z]+/[0-9]+$"), 1).otherwise(0).alias("plain_url"),
    )


@query("""
SELECT p_partkey, TRY_CAST(replace(trim(split_part(ref, ' ', 1)), chr(9), '') AS INTEGER) AS oper,
  CASE WHEN p_size > 25 THEN NULL ELSE p_name || '/' || p_brand END AS strict,
  coalesce(CASE WHEN p_size <= 25 THEN p_name END, '') || p_brand AS blank,
  concat_ws(' ', CASE WHEN p_size <= 25 THEN p_name END, p_brand) AS skipping
FROM (SELECT *, CASE WHEN p_size > 40 THEN p_name ELSE chr(9) || p_partkey END || ' ' || p_name AS ref FROM part)
""")
def text_tokens_and_concat(t):
    ref = F.concat(
        F.when(F.col("p_size") > 40, F.col("p_name")).otherwise(F.concat(F.lit("\t"), F.col("p_partkey"))),
        F.lit(" "), F.col("p_name"),
    )
    maybe = F.when(F.col("p_size") <= 25, F.col("p_name"))
    return t.part.select(
        "p_partkey", X.first_token_int(ref).alias("oper"),
        X.concat_strict(maybe, F.lit("/"), F.col("p_brand")).alias("strict"),
        X.concat_blank(maybe, F.col("p_brand")).alias("blank"),
        F.concat_ws(" ", maybe, "p_brand").alias("skipping"),
    )


@query("""
SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || lpad(CAST(c_custkey % 7 AS VARCHAR), 4, '0') || lpad(CAST(c_custkey AS VARCHAR), 25, '0') AS persona,
  lpad(coalesce(CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END, '0'), 3, '0') AS persona_cero,
  md5(c_name || chr(1) || '' || chr(1) || c_mktsegment || chr(1) || coalesce(CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END, '')) AS hash
FROM customer
""")
def text_fixed_width_key_and_hash(t):
    maybe = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey"))
    return t.customer.select(
        "c_custkey",
        X.fixed_width_key([(F.col("c_nationkey"), 3), (F.col("c_custkey") % 7, 4), (F.col("c_custkey"), 25)]).alias("persona"),
        X.fixed_width_key([(maybe, 3)], null_as="0").alias("persona_cero"),
        X.content_hash(F.col("c_name"), F.lit(""), F.col("c_mktsegment"), maybe).alias("hash"),
    )


@query("""
SELECT p_partkey,
  CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN p_name || ', ' || p_brand WHEN 2 THEN p_name || ', 7' WHEN 3 THEN p_name ELSE p_type || ', ' || p_name END AS lista,
  CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN p_name WHEN 2 THEN p_name WHEN 3 THEN p_name ELSE p_type END AS primero,
  CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN '["' || p_name || '","' || p_brand || '"]' WHEN 2 THEN '[ "' || p_name || '" , 7, null]' WHEN 3 THEN p_name ELSE '[' || p_type || ',  ''' || p_name || ''']' END AS sin_vacias,
  CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_size || '.50' END AS entero
FROM part
""")
def text_lists_and_decimals(t):
    """Empty list, JSON list, list with numbers and nulls, plain text, list that is no JSON."""
    kind = F.col("p_size") % 5
    text = (
        F.when(kind == 0, "[ ]")
        .when(kind == 1, F.format_string('["%s","%s"]', "p_name", "p_brand"))
        .when(kind == 2, F.format_string('[ "%s" , 7, null]', "p_name"))
        .when(kind == 3, F.col("p_name"))
        .otherwise(F.format_string("[%s,  '%s']", "p_type", "p_name"))
    )
    number = F.concat(F.col("p_size"), F.when(F.col("p_size") % 2 == 0, ".00").otherwise(".50"))
    return t.part.select(
        "p_partkey",
        X.list_text_normalize(text).alias("lista"),
        X.list_text_normalize(text, first_only=True).alias("primero"),
        X.blank_empty_list(text).alias("sin_vacias"),
        X.strip_trailing_zero_decimal(number).alias("entero"),
    )


@query(f"""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), shipped) AS days, date_diff('month', CAST(o_orderdate AS DATE), shipped) AS months,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') AS seniority, DATE '2000-06-29' AS yesterday,
  last_day(o_orderdate) AS month_end, CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start, strftime(o_orderdate, '%Y%m%d') AS stamp,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') // 30 AS whole_months
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE o_orderdate <= TIMESTAMP '{ORDERS_AS_OF}'
""")
def date_differences(t):
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("shipped"))
    rows = t.orders.filter(F.col("o_orderdate") <= F.lit(ORDERS_AS_OF).cast("timestamp_ntz"))
    rows = rows.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    df = J.lookup(rows, shipped, {"o_orderkey": "l_orderkey"})
    d = F.col("d")
    seniority = D.days_between(d, D.run_date(ORDERS_AS_OF))
    return df.select(
        "o_orderkey", D.days_between(d, F.col("shipped")).alias("days"),
        D.month_boundaries(d, F.col("shipped")).alias("months"), seniority.alias("seniority"),
        F.lit(D.yesterday(ORDERS_AS_OF)).alias("yesterday"), D.month_end(d).alias("month_end"),
        D.year_start(d).alias("year_start"), D.format_date(d).alias("stamp"),
        N.integer_division(seniority, 30).alias("whole_months"),
    )


@query(f"""
SELECT o_orderkey, date_diff('year', b, ref_day) - CASE WHEN b + to_years(CAST(date_diff('year', b, ref_day) AS INTEGER)) > ref_day THEN 1 ELSE 0 END AS years,
  CASE WHEN date_diff('day', b, ref_day) / 365.25 < 23 OR date_diff('day', b, ref_day) / 365.25 > 28 THEN 18.0 ELSE date_diff('day', b, ref_day) / 365.25 END AS years_decimal
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, DATE '{EVENTS_AS_OF}' AS ref_day FROM orders)
""")
def date_ages(t):
    birth, at = F.to_date("o_orderdate"), D.run_date(EVENTS_AS_OF)
    return t.orders.select(
        "o_orderkey", D.age_years(birth, at).alias("years"),
        D.age_years_decimal(birth, at, low=23, high=28).alias("years_decimal"),
    )


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'P') THEN NULL ELSE CAST(o_orderdate AS DATE) END AS closed,
  CASE WHEN o_orderstatus IN ('O', 'P') THEN DATE '2000-06-29' ELSE CAST(o_orderdate AS DATE) END AS filled,
  CASE WHEN o_orderpriority < '3' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed,
  DATE '{ORDERS_AS_OF}' AS loaded
FROM orders
""")
def date_sentinels_and_parsing(t):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "O", "1753-01-01").when(
        F.col("o_orderstatus") == "P", "0001-01-01T00:00:00").otherwise(iso)
    closed = D.parse_date(F.substring(D.sentinel_to_null(raw), 1, 10))
    text = F.when(F.col("o_orderpriority") < "2", "no date").when(
        F.col("o_orderpriority") < "3", F.date_format("o_orderdate", "MM-yyyy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select(
        "o_orderkey", closed.alias("closed"), D.default_date(closed, ORDERS_AS_OF).alias("filled"),
        D.guarded_parse_date(text, "^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy").alias("parsed"),
        D.run_date(ORDERS_AS_OF).alias("loaded"),
    )


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00' WHEN event_type = 'signup' THEN NULL
  WHEN event_type = 'click' THEN '1900-01-01 ' || strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
  CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%d.%m.%Y') END AS back
FROM events
""")
def timestamp_assembly(t):
    kind = F.col("event_type")
    clock = (
        F.when(kind == "view", F.date_format("ts", "HH:mm"))
        .when(kind == "signup", "259999")
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    stamp = D.assemble_timestamp(F.when(kind != "click", F.to_date("ts")), clock)
    text = F.when(kind == "error", "??").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select(
        "event_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.date_format(D.parse_timestamp(text), "dd.MM.yyyy").alias("back"),
    )


@query(f"""
SELECT o_orderkey, term_months, CASE WHEN ref_day >= e THEN 0 ELSE rest END AS remaining, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN ref_day >= e THEN 0 ELSE rest END AS DOUBLE) AS refund
FROM (SELECT *, date_diff('month', s, e) AS term_months, DATE '{ORDERS_AS_OF}' AS ref_day,
        (2 * date_diff('day', DATE '{ORDERS_AS_OF}', e) * date_diff('month', s, e) + date_diff('day', s, e)) // (2 * date_diff('day', s, e)) AS rest
      FROM (SELECT *, CAST(o_orderdate AS DATE) AS s, CAST(CAST(o_orderdate AS DATE) + to_months(CAST(6 + o_custkey % 48 AS INTEGER)) AS DATE) AS e FROM orders))
""")
def prorated_remaining_term(t):
    start = F.to_date("o_orderdate")
    df = t.orders.select(
        "o_orderkey", "o_totalprice", start.alias("s"), F.add_months(start, (6 + F.col("o_custkey") % 48).cast("int")).alias("e")
    )
    rest = D.prorated_remaining(F.col("s"), F.col("e"), ORDERS_AS_OF)
    return df.select(
        "o_orderkey", D.month_boundaries(F.col("s"), F.col("e")).alias("term_months"), rest.alias("remaining"),
        (N.money(F.col("o_totalprice")) * rest).cast("double").alias("refund"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, coalesce(CASE WHEN l_returnflag <> 'R' THEN l_quantity END, -1) AS qty,
  CASE WHEN l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END AS signed, abs(CASE WHEN l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END) AS unsigned,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE ((CAST(l_quantity AS BIGINT) * 12345 + 50) // 100) / 100.0 END AS tasa,
  CASE WHEN l_returnflag = 'A' THEN l_tax END AS cleaned, CAST(CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS BIGINT) AS code,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INTEGER) END AS whole
FROM lineitem
""")
def number_conversions(t):
    flag, price = F.col("l_returnflag"), F.col("l_extendedprice")
    scaled = F.when(flag == "N", "sin tasa").otherwise((F.col("l_quantity").cast("long") * 12345).cast("string"))
    raw = F.when(flag == "A", F.col("l_tax").cast("string")).when(flag == "N", "NaN").otherwise("n/a")
    signed = N.sign_by(price, F.col("l_linestatus") == "F")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        N.null_default(F.when(flag != "R", F.col("l_quantity")), -1.0).alias("qty"),
        signed.alias("signed"), F.abs(signed).alias("unsigned"),
        N.scaled_decimal(scaled).cast("double").alias("tasa"), N.nan_to_null(raw).alias("cleaned"),
        N.concat_numeric_code(F.col("l_orderkey"), F.col("l_linenumber")).alias("code"),
        F.when(flag == "A", F.col("l_quantity").cast("int").cast("string")).otherwise("x").try_cast("int").alias("whole"),
    )
