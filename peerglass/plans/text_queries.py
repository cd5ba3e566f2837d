"""Queries of text keys, numbers, dates and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerglass.functions import dates as D
from peerglass.functions import numbers as N
from peerglass.functions import payload as P
from peerglass.functions import text as X
from peerglass.operators import pages
from peerglass.operators import records as R
from peerglass.operators import reporting as rep
from peerglass.plans import views as vw
from peerglass.plans.registry import query
from peerglass.sources.delimited import resolve_columns
from peerglass.sources.documents import parse_json_keep_raw, valid_documents

# White space of any kind, spelled out for an engine without Unicode classes.
SQL_SPACE = (r"[\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_clean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{SQL_SPACE}+', ' ', 'g'))"


def sql_unescape(c: str) -> str:
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        c = f"replace({c}, '{entity}', '{text}')"
    return c


def sql_strip_tags(c: str) -> str:
    out = f"regexp_replace({c}, '<[^>]*>', ' ', 'g')"
    return sql_clean(sql_unescape(out))


def digest(column):
    """Long results are compared by their hash."""
    return F.md5(column)


# --- text ---------------------------------------------------------------------

@query("text_key", f"""
SELECT doc_id, md5(k) AS key_hash, length(k) AS key_chars FROM (
  SELECT doc_id, regexp_replace(regexp_replace(replace(coalesce(text, ''), '차체나', '차체및'),
    '[,，·ㆍ;:(){{}}\\[\\]<>"''“”‘’]', '', 'g'), '{SQL_SPACE}+', '', 'g') AS k FROM documents)""")
def text_key(t):
    key = X.text_key("text")
    return t.documents.select("doc_id", digest(key).alias("key_hash"), F.length(key).cast("bigint").alias("key_chars"))


@query("name_key", """
SELECT page_id, regexp_replace(replace(replace(replace(lower(url), '주식회사', ''), '(주)', ''), '㈜', ''),
  '[^0-9a-z가-힣.\\-:/]', '', 'g') AS key FROM pages""")
def name_key(t):
    return t.pages.select("page_id", X.name_key("url").alias("key"))


@query("name_clean", f"""
SELECT p_partkey, {sql_strip("replace(replace(regexp_replace(name, '\\(.*?\\)', '', 'g'), '주식회사', ''), '(주)', '')")} AS clean
FROM (SELECT p_partkey, '주식회사 ' || p_name || ' (' || p_type || ')㈜ ' AS name FROM part)""")
def name_clean(t):
    name = F.concat(F.lit("주식회사 "), F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")㈜ "))
    return t.part.select("p_partkey", X.name_clean(name).alias("clean"))


@query("clean_text", f"""
SELECT doc_id, md5({sql_clean('text')}) AS text_hash, length({sql_clean('text')}) AS n_clean FROM documents""")
def clean_text(t):
    clean = X.clean_text("text")
    return t.documents.select("doc_id", digest(clean).alias("text_hash"),
                              F.length(clean).cast("bigint").alias("n_clean"))


@query("clean_cells", f"""
SELECT doc_id, md5({sql_strip("replace(coalesce(text, ''), chr(10), ' ')")}) AS cell_hash,
       CASE WHEN {sql_strip("coalesce(CASE WHEN lang <> 'fr' THEN lang END, '')")} = '' THEN 'Column_0' ELSE lang END || '|'
         || CASE WHEN source = 'src1' THEN 'Column_1' ELSE source END AS header
FROM documents""")
def clean_cells(t):
    header = F.array(F.when(F.col("lang") != "fr", F.col("lang")),
                     F.when(F.col("source") == "src1", F.lit(" \n")).otherwise(F.col("source")))
    return t.documents.select("doc_id", digest(X.clean_cell("text")).alias("cell_hash"),
                              F.array_join(X.clean_header(header), "|").alias("header"))


@query("header_clean", """
SELECT p_partkey, replace(p_name, ' ', '') || '2024.12E' AS header,
       p_size || '원' || chr(10) || '2.' || p_name || '3.' AS steps
FROM part""")
def header_clean(t):
    header = F.concat(F.col("p_name"), F.lit(" '2024.12(E)\n"))
    steps = F.concat(F.col("p_size").cast("string"), F.lit("원2."), F.col("p_name"), F.lit("3."))
    return t.part.select("p_partkey", X.period_header(header).alias("header"),
                         X.break_numbered_steps(steps).alias("steps"))


@query("bracket_title", f"""
SELECT p_partkey, CASE WHEN {sql_strip('x')} <> '' AND NOT starts_with({sql_strip('x')}, '[')
                  THEN '[' || {sql_strip('x')} || ']' ELSE {sql_strip('x')} END AS title
FROM (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN '[' || p_name || '] ' WHEN 'SMALL' THEN '  ' ELSE ' ' || p_name END AS x
      FROM part)""")
def bracket_title(t):
    kind = F.col("p_type")
    title = F.when(kind == "PROMO", F.concat(F.lit("["), F.col("p_name"), F.lit("] "))).when(
        kind == "SMALL", F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("p_name")))
    return t.part.select("p_partkey", X.bracket_title(title).alias("title"))


@query("flag_keywords", """
SELECT doc_id, regexp_matches(text, 'license|password|example\\.com|copyright|therisk') AS flagged FROM (
  SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM documents)""")
def flag_keywords(t):
    terms = ["license", "password", "example.com", "copyright", "therisk"]
    return t.documents.select("doc_id", X.flag_keywords("text", terms).alias("flagged"))


@query("first_present", f"""
SELECT page_id, coalesce(nullif(h, ''), nullif(x, '')) AS title FROM (
  SELECT page_id, {sql_strip_tags("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")} AS h,
         {sql_strip_tags("regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1)")} AS x FROM pages)""")
def first_present(t):
    return t.pages.select("page_id", pages.page_title("html").alias("title"))


@query("entity_from_name", """
SELECT s_suppkey, f, trim(CASE WHEN contains(f, ' IR') THEN split_part(f, ' IR', 1)
  WHEN contains(f, '_') THEN split_part(f, '_', 1) ELSE split_part(f, ' ', 1) END) AS entity
FROM (SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN s_name || ' IR 2024' WHEN s_nationkey < 16 THEN s_name || '_v2.1'
             ELSE s_name || ' report' END AS f FROM supplier)""")
def entity_from_name(t):
    name, n = F.col("s_name"), F.col("s_nationkey")
    stem = F.when(n < 8, F.concat(name, F.lit(" IR 2024"))).when(n < 16, F.concat(name, F.lit("_v2.1"))).otherwise(
        F.concat(name, F.lit(" report")))
    return t.supplier.select("s_suppkey", stem.alias("f"),
                             X.entity_from_filename(F.concat(stem, F.lit(".pdf"))).alias("entity"))


@query("filename_date", """
SELECT o_orderkey, f, CASE WHEN m BETWEEN '01' AND '12' THEN y || '.' || m END AS ym FROM (
  SELECT *, regexp_extract(f, '(20[1-3]\\d)[-._]?([0-1]\\d)', 1) AS y,
            regexp_extract(f, '(20[1-3]\\d)[-._]?([0-1]\\d)', 2) AS m FROM (
    SELECT o_orderkey, 'deck_' || (year(o_orderdate) + 15) || CASE o_orderstatus WHEN 'F' THEN '-' WHEN 'O' THEN '_' ELSE '' END
      || lpad(CAST(month(o_orderdate) + CASE WHEN o_orderpriority = '5-LOW' THEN 5 ELSE 0 END AS VARCHAR), 2, '0') || '.pdf' AS f
    FROM orders))""")
def filename_date(t):
    status = F.col("o_orderstatus")
    month = F.month("o_orderdate") + F.when(F.col("o_orderpriority") == "5-LOW", 5).otherwise(0)
    mark = F.when(status == "F", F.lit("-")).when(status == "O", F.lit("_")).otherwise(F.lit(""))
    name = F.concat(F.lit("deck_"), (F.year("o_orderdate") + 15).cast("string"), mark,
                    F.lpad(month.cast("string"), 2, "0"), F.lit(".pdf"))
    return t.orders.select("o_orderkey", name.alias("f"), X.filename_date(name).alias("ym"))


@query("path_keys", """
SELECT page_id, split_part(p, '\\', 1) AS root, split_part(p, '\\', 2) AS corp, split_part(p, '\\', 3) AS receipt,
       split_part(p, '\\', 4) AS file, 'https://viewer.example.org/?no=' || split_part(p, '\\', 3) AS viewer
FROM (SELECT page_id, 'raw\\' || split_part(split_part(url, '://', 2), '/', 1) || '\\' || page_id || '\\' || page_id || '.zip' AS p
      FROM pages)""")
def path_keys(t):
    host = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    no = F.col("page_id").cast("string")
    path = F.concat(F.lit("raw\\"), host, F.lit("\\"), no, F.lit("\\"), no, F.lit(".zip"))
    root, corp, receipt, file = X.split_path(path)
    return t.pages.select("page_id", root.alias("root"), corp.alias("corp"), receipt.alias("receipt"),
                          file.alias("file"), X.viewer_url("https://viewer.example.org/?no=", receipt).alias("viewer"))


@query("resolve_columns", """
SELECT p_brand AS code, p_name AS name, p_type AS kind FROM part""")
def resolve_cols(t):
    raw = t.part.select(F.col("p_type").alias("산업 구분 "), F.col("p_name").alias(" 산업내용"),
                        F.col("p_size").alias("산업코드"), F.col("p_brand").alias("산업분류코드 (신)"))
    return resolve_columns(raw, {"code": ["산업분류코드", "산업코드"], "name": ["산업내용"], "kind": ["구분"]})


# --- numbers --------------------------------------------------------------------

@query("pad_code", """
SELECT c_custkey, CASE WHEN length(k) < 6 THEN lpad(k, 6, '0') ELSE k END AS code,
       CASE WHEN length(v) < 3 THEN lpad(v, 3, '0') ELSE v END AS short
FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k, CAST(c_custkey AS VARCHAR) AS v FROM customer)""")
def pad_code(t):
    return t.customer.select("c_custkey", N.pad_code("c_custkey").alias("code"), N.pad_code("c_custkey", 3).alias(
        "short"))


@query("first_number", """
SELECT doc_id, TRY_CAST(nullif(regexp_extract(replace(text, ',', ''), '([-+]?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS number
FROM documents""")
def first_number(t):
    return t.documents.select("doc_id", N.first_number("text").alias("number"))


@query("market_cap_eok", """
SELECT o_orderkey, txt, jo * 10000.0::DOUBLE + eok AS eok FROM (
  SELECT *, coalesce(TRY_CAST(replace(nullif(regexp_extract(s, '(?:(\\d+(?:,\\d+)*)조)?(?:(\\d+(?:,\\d+)*))?$', 1), ''), ',', '') AS DOUBLE), 0) AS jo,
            coalesce(TRY_CAST(replace(nullif(regexp_extract(s, '(?:(\\d+(?:,\\d+)*)조)?(?:(\\d+(?:,\\d+)*))?$', 2), ''), ',', '') AS DOUBLE), 0) AS eok
  FROM (SELECT o_orderkey, txt, replace(regexp_replace(txt, '\\s+', '', 'g'), '억원', '') AS s FROM (
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey || '조 ' || format('{:,}', o_orderkey) || '억원'
             WHEN 'O' THEN format('{:,}', o_orderkey) ELSE o_custkey || '조' END AS txt FROM orders)))""")
def market_cap_eok(t):
    key, status = F.format_number("o_orderkey", 0), F.col("o_orderstatus")
    txt = (
        F.when(status == "F", F.concat(F.col("o_custkey").cast("string"), F.lit("조 "), key, F.lit("억원")))
        .when(status == "O", key).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("조")))
    )
    return t.orders.select("o_orderkey", txt.alias("txt"), N.market_cap_eok(txt).alias("eok"))


@query("format_statement", """
WITH s AS (SELECT c_custkey, c_acctbal,
  CASE c_mktsegment WHEN 'MACHINERY' THEN '△' || abs(c_acctbal) WHEN 'BUILDING' THEN '(' || abs(trunc(c_acctbal)::BIGINT) || ')'
       WHEN 'AUTOMOBILE' THEN ' ' || c_acctbal::VARCHAR || ' ' WHEN 'HOUSEHOLD' THEN 'N/A' ELSE c_name END AS txt FROM customer),
n AS (SELECT *, CASE WHEN contains(CAST(abs(c_acctbal) AS VARCHAR), '.') THEN
    format('{:,}', CAST(trunc(abs(c_acctbal)) AS BIGINT)) ||
    CASE WHEN regexp_replace(split_part(CAST(abs(c_acctbal) AS VARCHAR), '.', 2), '0+$', '') = '' THEN ''
         ELSE '.' || regexp_replace(split_part(CAST(abs(c_acctbal) AS VARCHAR), '.', 2), '0+$', '') END END AS num FROM s)
SELECT c_custkey, txt, CASE WHEN starts_with(txt, '△') THEN '-' || num
  WHEN starts_with(txt, '(') THEN '(' || format('{:,}', CAST(trunc(abs(c_acctbal)) AS BIGINT)) || ')'
  WHEN starts_with(txt, ' ') THEN CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || num ELSE txt END AS shown FROM n""")
def format_statement(t):
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    txt = (
        F.when(seg == "MACHINERY", F.concat(F.lit("△"), F.abs(bal).cast("string")))
        .when(seg == "BUILDING", F.concat(F.lit("("), F.abs(bal.cast("bigint")).cast("string"), F.lit(")")))
        .when(seg == "AUTOMOBILE", F.concat(F.lit(" "), bal.cast("string"), F.lit(" ")))
        .when(seg == "HOUSEHOLD", F.lit("N/A")).otherwise(F.col("c_name"))
    )
    return t.customer.select("c_custkey", txt.alias("txt"), N.format_statement(txt).alias("shown"))


@query("harmonise_units", """
SELECT o_orderkey, CASE WHEN unit = '억원' AND contains(txt, '백만') THEN n / 100 WHEN unit = '백만원' AND contains(txt, '억') THEN n * 100
       ELSE n END AS value
FROM (SELECT *, CASE WHEN regexp_replace(txt, '[^\\d.\\-]', '', 'g') = '' THEN 0
                ELSE TRY_CAST(regexp_replace(txt, '[^\\d.\\-]', '', 'g') AS DOUBLE) END AS n FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '백만원' ELSE '억원' END AS unit,
    CASE o_orderpriority WHEN '1-URGENT' THEN format('{:,}', o_custkey) || '백만원' WHEN '2-HIGH' THEN '-' || o_custkey || '.5억'
         WHEN '3-MEDIUM' THEN '미정' ELSE '약 ' || o_custkey END AS txt FROM orders))""")
def harmonise_units(t):
    pri, key = F.col("o_orderpriority"), F.col("o_custkey").cast("string")
    txt = (
        F.when(pri == "1-URGENT", F.concat(F.format_number("o_custkey", 0), F.lit("백만원")))
        .when(pri == "2-HIGH", F.concat(F.lit("-"), key, F.lit(".5억")))
        .when(pri == "3-MEDIUM", F.lit("미정")).otherwise(F.concat(F.lit("약 "), key))
    )
    unit = F.when(F.col("o_orderstatus") == "F", F.lit("백만원")).otherwise(F.lit("억원"))
    return t.orders.select("o_orderkey", N.harmonise_unit(txt, unit).alias("value"))


AMOUNT_SQL = """amounts AS (
  SELECT event_id, txt, CASE WHEN contains(txt, '백만') THEN 0.01::DOUBLE WHEN contains(txt, '조') THEN 10000.0::DOUBLE
           WHEN contains(txt, 'M') OR contains(txt, '달러') THEN 13.0::DOUBLE ELSE 1.0::DOUBLE END AS mult,
         regexp_extract_all(txt, '(\\d+\\.?\\d*)', 1) AS nums
  FROM (SELECT event_id, CASE WHEN k < 20 THEN '미공개' WHEN k < 40 THEN floor(value)::BIGINT || '~900억'
                 WHEN k < 60 THEN '$' || floor(value)::BIGINT || 'M' WHEN k < 80 THEN floor(value)::BIGINT || '백만원'
                 ELSE floor(value)::BIGINT || '조' END AS txt
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))), money AS (
  SELECT event_id, txt, CASE len(nums) WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN nums[1]::DOUBLE * mult
              ELSE (nums[1]::DOUBLE * mult + nums[2]::DOUBLE * mult) / 2 END AS amount,
         CASE len(nums) WHEN 0 THEN '비공개' WHEN 1 THEN format('{:g}', nums[1]::DOUBLE * mult) || '억'
              ELSE format('{:g}', nums[1]::DOUBLE * mult) || '~' || format('{:g}', nums[2]::DOUBLE * mult) || '억' END AS label
  FROM amounts)"""


@query("amount_range", f"WITH {AMOUNT_SQL} SELECT event_id, txt, amount, label FROM money")
def amount_range(t):
    rounds = vw.funding_rounds(t)
    money = N.amount_range("amount")
    return rounds.select(F.col("seq").alias("event_id"), F.col("amount").alias("txt"), money["amount"].alias("amount"),
                         money["label"].alias("label"))


def _approx(c: str) -> str:
    return f"""CASE WHEN {c} >= 1e12 THEN '(약 ' || CAST({c} // 1000000000000 AS BIGINT) || '조' || CASE
      WHEN ({c} % 1000000000000) // 100000000 > 0 THEN ' ' || format('{{:,}}', ({c} % 1000000000000) // 100000000) || '억'
      ELSE '' END || ')' WHEN {c} >= 1e8 THEN '(약 ' || format('{{:,}}', {c} // 100000000) || '억)'
      ELSE '(약 ' || format('{{:,}}', {c} // 10000) || '만)' END"""


@query("money_approx", f"""
SELECT o_orderkey, {_approx('v')} AS approx FROM (
  SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) * CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 5000 ELSE 20000000 END AS v
  FROM orders)""")
def money_approx(t):
    status = F.col("o_orderstatus")
    scale = F.when(status == "F", 1).when(status == "O", 5000).otherwise(20000000)
    return t.orders.select("o_orderkey", N.money_approx(F.col("o_totalprice").cast("bigint") * scale).alias("approx"))


@query("money_format", """
SELECT o_orderkey, format('{:,.0f}', o_totalprice) || '원' AS won, format('{:,}', o_orderkey) || '주' AS shares,
       printf('%.2f', o_totalprice / 10000::DOUBLE) || '배' AS multiple,
       CASE WHEN c >= 10000 AND CAST(trunc(c - floor(c / 10000) * 10000) AS BIGINT) > 0
            THEN '시총 ' || CAST(floor(c / 10000) AS BIGINT) || '조 '
                 || format('{:,}', CAST(trunc(c - floor(c / 10000) * 10000) AS BIGINT)) || '억'
            WHEN c >= 10000 THEN '시총 ' || CAST(floor(c / 10000) AS BIGINT) || '조'
            WHEN c > 0 THEN '시총 ' || format('{:,}', CAST(trunc(c) AS BIGINT)) || '억' ELSE '시총 N/A' END AS cap
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice / 10 END AS c FROM orders)""")
def money_format(t):
    cap = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 10)
    return t.orders.select(
        "o_orderkey", N.won_text("o_totalprice").alias("won"), N.shares_text("o_orderkey").alias("shares"),
        N.multiple_text(F.col("o_totalprice") / 10000).alias("multiple"), N.market_cap_text(cap).alias("cap"))


@query("shares_fallback", """
SELECT c_custkey, coalesce(CASE WHEN c_nationkey <> 0 AND c_nationkey < 9 THEN c_nationkey END,
                           CASE WHEN c_acctbal > 0 THEN CAST(trunc(trunc(c_acctbal) / 500) AS BIGINT) END,
                           CASE WHEN c_nationkey < 9 THEN c_nationkey END) AS shares
FROM customer""")
def shares_fallback(t):
    known = F.when(F.col("c_nationkey") < 9, F.col("c_nationkey"))
    return t.customer.select("c_custkey", N.shares_or_capital(known, F.col("c_acctbal").cast("bigint")).alias("shares"))


# --- dates ------------------------------------------------------------------------

DATE_TEXT_SQL = """SELECT o_orderkey, d, CASE o_orderstatus WHEN 'F' THEN strftime(d, '%Y-%m-%d') WHEN 'O' THEN strftime(d, '%m-%d-%y')
  ELSE '상장 ' || year(d) END AS txt
  FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate - INTERVAL 26 YEAR
                                          ELSE o_orderdate END AS d FROM orders)"""


def _date_texts(t):
    day = F.when(F.col("o_orderpriority") == "5-LOW", F.expr("o_orderdate - INTERVAL 26 YEAR")).otherwise(
        F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    txt = (
        F.when(status == "F", F.date_format(day, "yyyy-MM-dd")).when(status == "O", F.date_format(day, "MM-dd-yy"))
        .otherwise(F.concat(F.lit("상장 "), F.year(day).cast("string")))
    )
    return t.orders.select("o_orderkey", txt.alias("txt"))


@query("parse_dates", f"""
SELECT o_orderkey, txt, strftime(CASE WHEN contains(txt, '상장') THEN NULL
  WHEN regexp_matches(txt, '^\\d{{4}}-') THEN try_strptime(txt, '%Y-%m-%d')
  ELSE CASE WHEN CAST(right(txt, 2) AS INTEGER) >= 69 THEN try_strptime('19' || right(txt, 2) || '-' || left(txt, 5), '%Y-%m-%d')
            ELSE try_strptime('20' || right(txt, 2) || '-' || left(txt, 5), '%Y-%m-%d') END END, '%Y%m%d') AS ymd
FROM ({DATE_TEXT_SQL})""")
def parse_dates(t):
    return _date_texts(t).withColumn("ymd", F.date_format(D.parse_listing_date("txt"), "yyyyMMdd"))


@query("listing_age", """
SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30') AS days,
       CAST(trunc(datediff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30') / 365) AS INTEGER) AS years FROM orders""")
def listing_age(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", D.listed_days(day, "2000-06-30").cast("bigint").alias("days"),
                           D.listed_years(day, "2000-06-30").alias("years"))


@query("year_label", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '구분'
  WHEN o_orderstatus = 'F' OR year(o_orderdate) >= 1999 THEN year(o_orderdate) || '(E)'
  ELSE CAST(year(o_orderdate) AS VARCHAR) END AS label FROM orders""")
def year_label(t):
    year, status = F.year("o_orderdate").cast("string"), F.col("o_orderstatus")
    txt = F.when(status == "P", F.lit("구분")).when(status == "F", F.concat(year, F.lit("년(e)"))).otherwise(
        F.concat(year, F.lit(".12")))
    return t.orders.select("o_orderkey", D.year_label(txt, 1999).alias("label"))


@query("statement_periods", """
SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN '' ELSE array_to_string(list_concat(['구분'], list_transform(range(o_custkey % 4 - 1),
         lambda i: CASE WHEN i = 1 THEN '2020(E)' WHEN 2022 + i >= 2024 THEN (2022 + i) || '(E)' ELSE (2022 + i)::VARCHAR END)), '|') END AS labels,
       CAST(CASE WHEN o_custkey % 4 > 1 THEN o_custkey % 4 - 1 ELSE 5 END AS INTEGER) AS n_periods FROM orders""")
def statement_periods(t):
    n = (F.col("o_custkey") % 4).cast("int")
    cells = F.slice(F.array(F.lit("구분"), F.lit("2022.12"), F.lit("2020년(e)"), F.lit("2024/12")), F.lit(1), n)
    return t.orders.select("o_orderkey", D.statement_periods(cells, 2024).alias("p")).select(
        "o_orderkey", F.array_join("p.labels", "|").alias("labels"), "p.n_periods")


@query("chart_dataset", """
WITH r AS (SELECT o_orderkey, i, o_orderpriority = '5-LOW' AS counted, CASE WHEN 2022 + i >= 2024 THEN (2022 + i) || '(E)' ELSE (2022 + i)::VARCHAR END AS label,
                  CASE (o_custkey + i) % 4 WHEN 0 THEN 0.01 WHEN 1 THEN 1.0 END AS scale,
                  CASE (o_custkey + i) % 4 WHEN 0 THEN '백만원' WHEN 1 THEN '억원' END AS named,
                  CASE (o_custkey + i) % 4 WHEN 0 THEN o_custkey + i WHEN 1 THEN i + 1.5 WHEN 2 THEN 0 ELSE o_custkey END::DOUBLE AS n
           FROM orders, LATERAL (SELECT unnest(range(o_custkey % 5)) AS i)),
c AS (SELECT o_orderkey, named, count(*) AS k, min(i) AS f FROM r WHERE named IS NOT NULL GROUP BY 1, 2),
u AS (SELECT o_orderkey, first(named ORDER BY k DESC, f) AS named FROM c GROUP BY 1),
d AS (SELECT r.*, CASE WHEN counted THEN '건' ELSE coalesce(u.named, '백만원') END AS unit FROM r LEFT JOIN u USING (o_orderkey)),
v AS (SELECT *, CASE WHEN unit = '억원' AND named = '백만원' THEN n / 100 WHEN unit = '백만원' AND named = '억원' THEN n * 100 ELSE n END AS value FROM d),
g AS (SELECT o_orderkey, min(unit) AS unit, string_agg(label || '=' || value::VARCHAR, ',' ORDER BY i) AS points, sum(value) AS total
      FROM v GROUP BY 1)
SELECT o_orderkey, unit, points FROM orders LEFT JOIN (SELECT * FROM g WHERE total <> 0) g USING (o_orderkey)""")
def chart_dataset(t):
    key = F.col("o_custkey")
    rows = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(
        F.concat((2022 + i).cast("string"), F.lit("년")),
        F.when((key + i) % 4 == 0, F.concat((key + i).cast("string"), F.lit("백만원")))
        .when((key + i) % 4 == 1, F.concat((i + 1).cast("string"), F.lit(".5 억")))
        .when((key + i) % 4 == 2, F.lit("N/A")).otherwise(F.concat(F.lit("약 "), key.cast("string")))))
    pairs = F.concat(F.array(F.array(F.lit("연도"), F.lit("금액"))), F.slice(rows, F.lit(1), (key % 5).cast("int")))
    title = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("계약 건수")).otherwise(F.lit("수출 추이"))
    return t.orders.select("o_orderkey", rep.chart_dataset(pairs, title, 2024).alias("c")).select(
        "o_orderkey", "c.unit", F.array_join(F.transform("c.points", lambda p: F.concat(
            p["label"], F.lit("="), p["value"].cast("string"))), ",").alias("points"))


# --- JSON ---------------------------------------------------------------------------

@query("valid_documents", """
SELECT event_id, doc FROM (
  SELECT event_id, CASE event_type WHEN 'error' THEN '{"error": 500, "p": ' || props || '}' WHEN 'view' THEN '[' || props || ']'
                   WHEN 'click' THEN '{"p": ' ELSE props END AS doc FROM events)
WHERE json_valid(doc) AND json_type(doc) = 'OBJECT' AND NOT list_contains(json_keys(doc), 'error')""")
def valid_docs(t):
    kind = F.col("event_type")
    doc = (
        F.when(kind == "error", F.concat(F.lit('{"error": 500, "p": '), "props", F.lit("}")))
        .when(kind == "view", F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == "click", F.lit('{"p": ')).otherwise(F.col("props"))
    )
    return valid_documents(t.events.select("event_id", doc.alias("doc")), "doc")


@query("json_keep_raw", """
SELECT event_id, CASE WHEN event_type <> 'click' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_type = 'click' THEN '{"k": ' END AS raw_text, event_type = 'click' AS parse_error FROM events""")
def json_keep_raw(t):
    doc = F.when(F.col("event_type") == "click", F.lit('{"k": ')).otherwise(F.col("props"))
    return parse_json_keep_raw(t.events.select("event_id", doc.alias("doc")), "doc", "k bigint")


@query("salvage_json", """
SELECT event_id, CASE WHEN event_type = 'error' THEN '{}' ELSE props END AS json FROM events""")
def salvage_json(t):
    kind = F.col("event_type")
    answer = (
        F.when(kind == "error", F.concat(F.lit("no answer {"), "props"))
        .when(kind == "view", F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(kind == "click", F.concat(F.lit("Here it is: "), "props", F.lit(" done.\n"))).otherwise(F.col("props"))
    )
    return t.events.select("event_id", P.salvage_json(answer).alias("json"))


@query("kv_lookup", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS VARCHAR) END AS per,
       event_type AS market_value FROM events""")
def kv_lookup(t):
    k = F.get_json_object("props", "$.k")
    code = F.when(F.col("event_type") == "error", F.lit("pbr")).otherwise(F.lit("per"))
    doc = F.concat(F.lit('{"totalInfos": [{"code": "'), code, F.lit('", "value": "'), k, F.lit(
        '"}, {"code": "marketValue", "value": "'), "event_type", F.lit('"}]}'))
    parsed = F.from_json(doc, "totalInfos array<struct<code:string,value:string>>")["totalInfos"]
    return t.events.select("event_id", P.kv_lookup(parsed, "per").alias("per"),
                           P.kv_lookup(parsed, "marketValue").alias("market_value"))


@query("coalesce_alias", """
SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL WHEN event_type IN ('click', 'view') THEN event_type ELSE 'legacy' END
  AS peers FROM events""")
def coalesce_alias(t):
    kind = F.col("event_type")
    doc = (
        F.when(kind == "signup", F.lit('{"new": [], "old": []}'))
        .when(kind.isin("click", "view"), F.concat(F.lit('{"new": ["'), kind, F.lit('"], "old": ["x"]}')))
        .when(kind == "error", F.lit('{"new": [], "old": ["legacy"]}')).otherwise(F.lit('{"old": ["legacy"]}'))
    )
    parsed = F.from_json(doc, "new array<string>, old array<string>")
    return t.events.select("event_id", F.array_join(R.coalesce_alias(parsed["new"], parsed["old"]), ",").alias("peers"))


@query("clean_series", """
SELECT event_id, string_agg(y || '=' || v, ';' ORDER BY y) AS series FROM (
  SELECT event_id, '2022' AS y, CAST(CAST(json_extract(props, '$.k') AS BIGINT) * 1000 AS VARCHAR) AS v FROM events WHERE event_type <> 'view'
  UNION ALL SELECT event_id, '2023', '0' FROM events WHERE event_type <> 'view') GROUP BY 1
UNION ALL SELECT event_id, '' FROM events WHERE event_type = 'view'""")
def clean_series(t):
    k = F.get_json_object("props", "$.k").cast("bigint") * 1000
    header = F.array(F.lit("Year"), F.lit("Revenue"))
    body = [F.array(F.lit("2022년"), F.concat(F.format_number(k, 0), F.lit("억원"))),
            F.array(F.lit("2023 "), F.lit("N/A")), F.array(F.lit("2024"), F.lit("unknown")), F.array(F.lit("2025"))]
    pairs = F.when(F.col("event_type") == "view", F.array(header)).when(
        F.col("event_type") == "click", F.array(*body)).otherwise(F.array(header, *body))
    items = F.transform(rep.clean_series(pairs), lambda s: F.concat_ws("=", s["year"], s["value"].cast(
        "bigint").cast("string")))
    return t.events.select("event_id", F.array_join(items, ";").alias("series"))
