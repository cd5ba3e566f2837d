"""Queries of reference data, documents, evidence, records and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerglass.operators import documents as docs
from peerglass.operators import evidence as ev
from peerglass.operators import pages
from peerglass.operators import records as R
from peerglass.operators import refdata as ref
from peerglass.operators import reporting as rep
from peerglass.operators import similarity as sim
from peerglass.operators.distributed import dealt
from peerglass.plans import views as vw
from peerglass.plans.registry import query
from peerglass.plans.screening_queries import PAIRS_SQL, label_pairs
from peerglass.plans.text_queries import AMOUNT_SQL, sql_strip, sql_strip_tags, sql_unescape

# --- reference data -------------------------------------------------------------


def _industry_rows(t):
    """Code list of every supplier: letter rows open a section, number rows follow."""
    lines = t.lineitem.groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").alias("q"), F.min(F.ascii("l_returnflag")).alias("flag"), F.min("l_partkey").alias("part"))
    letter = F.col("q") >= 40
    return lines.select(
        F.col("l_suppkey").alias("file"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_no"),
        F.when(letter, F.lower(F.char("flag"))).otherwise(F.concat(F.lit(" "), F.col("part").cast("string"))).alias("raw_code"),
        F.concat(F.lit("Part, ("), F.col("part").cast("string"), F.lit(")")).alias("industry_name"),
    )


INDUSTRY_SQL = """lines AS (
  SELECT l_suppkey AS file, l_orderkey * 8 + l_linenumber AS row_no, max(l_quantity) AS q, min(l_returnflag) AS flag,
         min(l_partkey) AS part FROM lineitem GROUP BY 1, 2), ind AS (
  SELECT file, row_no, part, CASE WHEN q >= 40 THEN flag END AS letter,
         CASE WHEN q < 40 THEN CASE WHEN length(part::VARCHAR) < 5 THEN lpad(part::VARCHAR, 5, '0') ELSE part::VARCHAR END
         END AS num FROM lines), coded AS (
  SELECT file, row_no, part, last_value(letter IGNORE NULLS) OVER (PARTITION BY file ORDER BY row_no
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) || num AS class_code FROM ind)"""


@query("section_ffill", f"WITH {INDUSTRY_SQL} SELECT file, row_no, class_code FROM coded")
def section_ffill(t):
    rows = ref.industry_class_code(_industry_rows(t), "file", "row_no", "raw_code")
    return rows.select("file", "row_no", "class_code")


@query("industry_codes", f"""WITH {INDUSTRY_SQL}
SELECT file, row_no, class_code FROM coded WHERE class_code IS NOT NULL""")
def industry_codes(t):
    rows = ref.industry_class_code(_industry_rows(t), "file", "row_no", "raw_code")
    return ref.require_code(rows).select("file", "row_no", "class_code")


ATTACH_SQL = """lookup AS (SELECT p_type || p_size AS key, p_brand AS class_code FROM part),
attached AS (SELECT c_custkey, c_mktsegment, key0, class_code FROM (
    SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey < 20 THEN 'PROMO' ELSE 'NONE' END || c_nationkey AS key0 FROM customer) c
  LEFT JOIN lookup ON key = key0)"""


def _attached(t, cut=None, many=False):
    codes = t.part.select(F.concat(F.col("p_type"), F.lit("  ("), F.col("p_size").cast("string"), F.lit(")")).alias(
        "industry_name"), F.col("p_brand").alias("class_code"))
    kind = F.when(F.col("c_nationkey") < 20, F.lit("PROMO,\n")).otherwise(F.lit("NONE "))
    companies = t.customer.select("c_custkey", "c_mktsegment", F.concat(
        kind, F.col("c_nationkey").cast("string")).alias("industry"))
    return ref.attach_industry_code(companies, cut(codes, "industry_name") if cut else codes, "industry", "industry_name",
                                    many=many)


@query("attach_code", f"WITH {ATTACH_SQL} SELECT c_custkey, class_code FROM attached")
def attach_code(t):
    return _attached(t, many=True).select("c_custkey", "class_code")


@query("unmatched_codes", f"""WITH {ATTACH_SQL}
SELECT c_custkey, c_mktsegment, class_code FROM attached WHERE class_code IS NULL""")
def unmatched_codes(t):
    # a company with codes is told by one of them, so the rows of all are not made
    return ref.unmatched(_attached(t, ref.code_presence), ["c_custkey", "c_mktsegment"])


@query("null_audit", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_o_orderkey,
       count(*) FILTER (WHERE c_name IS NULL) AS null_c_name
FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE year(o_orderdate) = 2000) ON o_custkey = c_custkey""")
def null_audit(t):
    year = t.orders.filter(F.year("o_orderdate") == 2000).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return ref.null_audit(t.customer.join(year, "c_custkey", "left"), ["o_orderkey", "c_name"])


@query("reference_prep", f"""WITH {INDUSTRY_SQL}, firsts AS (
  SELECT o_custkey, min(strftime(o_orderdate, '%Y-%m-%d')) AS listed FROM orders GROUP BY 1)
SELECT c_custkey, c_name, class_code, listed AS listed_text, strftime(CAST(listed AS DATE), '%Y%m%d') AS listing_ymd,
       datediff('day', CAST(listed AS DATE), DATE '2002-01-01') AS listed_days,
       CAST(trunc(datediff('day', CAST(listed AS DATE), DATE '2002-01-01') / 365) AS INTEGER) AS listed_years
FROM customer LEFT JOIN firsts ON o_custkey = c_custkey
LEFT JOIN coded ON part = c_custkey AND class_code IS NOT NULL""")
def reference_prep(t):
    firsts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("d"))
    companies = t.customer.join(firsts, "c_custkey", "left").select(
        "c_custkey", "c_name", F.concat(F.lit("Part "), F.col("c_custkey").cast("string")).alias("industry"),
        F.date_format("d", "yyyy-MM-dd").alias("listed_text"))
    rows = ref.reference_prep(_industry_rows(t), companies, as_of="2002-01-01")
    return rows.select("c_custkey", "c_name", "class_code", "listed_text", "listing_ymd",
                       F.col("listed_days").cast("bigint").alias("listed_days"), "listed_years")


# --- documents ------------------------------------------------------------------

INVENTORY_SQL = """paths AS (
  SELECT doc_id, n_chars, CASE WHEN n_chars < 500 THEN source || ' IR 2024.' || doc_id || '.pdf'
    WHEN n_chars < 800 THEN source || '_intro ' || doc_id || '.docx' WHEN n_chars < 1000 THEN source || ' notes ' || doc_id || '.pdf'
    ELSE CASE source WHEN 'src3' THEN 'metadata' ELSE source END || '/' ||
         CASE lang WHEN 'en' THEN 'IR_Deck ' || doc_id || '.PDF' WHEN 'fr' THEN '재무제표_' || doc_id || '.xlsx'
                   WHEN 'de' THEN '홍보 브로셔 ' || doc_id || '.pptx' ELSE 'memo.' || doc_id || '.txt' END END AS path
  FROM documents), files AS (
  SELECT doc_id, path, split_part(path, '/', -1) AS file_name, lower(regexp_extract(path, '(\\.[^.]*)$', 1)) AS ext,
         NOT contains(path, '/') AS in_root,
         CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE
           CASE WHEN contains(path, ' IR') THEN split_part(path, ' IR', 1) WHEN contains(path, '_') THEN split_part(path, '_', 1)
                ELSE split_part(path, ' ', 1) END END AS company
  FROM paths), inventory AS (
  SELECT *, CASE WHEN contains(lower(file_name), 'ir') THEN 'IR' WHEN contains(file_name, '재무') THEN '재무'
                 WHEN contains(file_name, '홍보') THEN '홍보' WHEN in_root AND ends_with(file_name, '.pdf') THEN 'IR' ELSE '기타' END
            AS doc_type
  FROM files WHERE ext IN ('.pdf', '.pptx', '.docx', '.xlsx', '.xls', '.csv', '.md') AND company <> 'metadata')"""


@query("file_inventory", f"WITH {INVENTORY_SQL} SELECT doc_id, company, doc_type, file_name, ext FROM inventory")
def file_inventory(t):
    return docs.file_inventory(vw.inventory_listing(t)).select("doc_id", "company", "doc_type", "file_name", "ext")


@query("first_main_doc", f"""WITH {INVENTORY_SQL}
SELECT company, count(*) AS n_files, count(*) FILTER (WHERE doc_type = 'IR') AS n_ir,
       count(*) FILTER (WHERE doc_type = '기타') AS n_other, min(path) FILTER (WHERE doc_type = 'IR' AND ext = '.pdf') AS main_doc
FROM inventory GROUP BY 1""")
def first_main_doc(t):
    bundled = docs.first_main_doc(docs.file_inventory(vw.inventory_listing(t)))
    return bundled.select("company", "n_files", F.col("n_type_0").alias("n_ir"), F.col("n_type_3").alias("n_other"),
                          "main_doc")


@query("classify_docs", """
SELECT p_partkey, CASE WHEN contains(f, 'ir') THEN 'IR' WHEN contains(f, '재무') THEN '재무' WHEN contains(f, '홍보') THEN '홍보'
  ELSE '기타' END AS doc_type
FROM (SELECT p_partkey, lower(CASE WHEN p_type = 'PROMO' THEN '재무_' WHEN p_type = 'SMALL' THEN '홍보 ' WHEN p_size > 40 THEN 'Ir-'
        ELSE '' END || p_name || '.docx') AS f FROM part)""")
def classify_docs(t):
    kind = F.col("p_type")
    prefix = F.when(kind == "PROMO", F.lit("재무_")).when(kind == "SMALL", F.lit("홍보 ")).when(
        F.col("p_size") > 40, F.lit("Ir-")).otherwise(F.lit(""))
    return t.part.select("p_partkey", docs.doc_type(F.concat(prefix, "p_name", F.lit(".docx"))).alias("doc_type"))


@query("manifest_top_files", """
SELECT archive, file_count, rank, name, size FROM (
  SELECT source AS archive, doc_id AS name, n_chars AS size, count(*) OVER (PARTITION BY source) AS file_count,
         row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 10""")
def manifest_top_files(t):
    files = t.documents.select(F.col("source").alias("archive"), F.col("doc_id").alias("name"),
                               F.col("n_chars").alias("size"))
    return docs.manifest_candidates(files)


@query("pending_docs", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def pending_docs(t):
    return docs.pending(t.documents.select("doc_id", "source"), t.labels, ["doc_id"])


@query("guard_pages", """
SELECT page_id, CASE WHEN status <> 200 THEN 'HTTP ' || status WHEN n < 1000 THEN 'too short: ' || n END AS reject_reason
FROM (SELECT page_id, length(html) AS n, CASE WHEN contains(url, '#') THEN 404 ELSE 200 END AS status FROM pages)""")
def guard_pages(t):
    status = F.when(F.contains("url", F.lit("#")), 404).otherwise(200)
    return docs.guard_pages(t.pages.withColumn("status", status), status="status").select("page_id", "reject_reason")


@query("document_bundle", """
SELECT conv_id AS doc_id, turn // 4 AS part_no, count(*) AS n_items,
       md5(string_agg(chr(10) || chr(10) || '==== [보충 문서: ' || role || '] ====' || chr(10) || text, '' ORDER BY turn)) AS bundle_hash
FROM conversations WHERE role <> 'system' AND text <> '' GROUP BY 1, 2""")
def document_bundle(t):
    sections = t.conversations.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("section_no"),
                                      F.col("role").alias("name"), "text")
    bundle = docs.document_bundle(sections, main=F.col("name") == "system", per_part=4)
    return bundle.select("doc_id", "part_no", "n_items", F.md5("bundle").alias("bundle_hash"))


@query("table_text", """
SELECT c_nationkey AS page_no, c_custkey // 512 AS part_no, count(*) AS n_items,
       md5('NATION_' || c_nationkey || ' | segment | Column_2' || chr(10) || '--- | --- | ---' || chr(10) ||
         string_agg(c_name || ' | ' || c_mktsegment || ' | ' || coalesce(CASE WHEN c_acctbal > 0 THEN trunc(c_acctbal)::BIGINT::VARCHAR END, ''),
                    chr(10) ORDER BY c_custkey)) AS table_hash
FROM customer GROUP BY 1, 2""")
def table_text(t):
    rows = t.customer.select(
        F.col("c_nationkey").alias("page_no"), F.lit(1).alias("table_no"), F.col("c_custkey").alias("row_no"),
        F.array(F.concat(F.col("c_name"), F.lit("\n")), F.col("c_mktsegment"), F.when(
            F.col("c_acctbal") > 0, F.col("c_acctbal").cast("bigint").cast("string"))).alias("cells"))
    headers = t.nation.select(F.col("n_nationkey").alias("page_no"), F.lit(1).alias("table_no"),
                              F.array(F.col("n_name"), F.lit("segment"), F.lit(None)).alias("cells"))
    text = docs.table_text(rows, headers, per_part=512)
    return text.select("page_no", "part_no", "n_items", F.md5("table_text").alias("table_hash"))


LINK = r"""(?is)<li><a href="/([^"]*)">(.*?)</a></li>"""


@query("page_elements", f"""
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS n, unnest(regexp_extract_all(html, '{LINK}', 2)) AS v,
                      generate_subscripts(regexp_extract_all(html, '{LINK}', 1), 1) AS i FROM pages),
items AS (SELECT page_id, i, {sql_strip_tags('n')} AS n, {sql_strip_tags('v')} AS v FROM links)
SELECT page_id, coalesce(string_agg(n || ' (' || v || '%)', ', ' ORDER BY i) FILTER (WHERE n <> '' AND v <> ''), '') AS products
FROM pages LEFT JOIN items USING (page_id) GROUP BY 1""")
def page_elements(t):
    return t.pages.select("page_id", pages.listed_pairs(pages.element_pairs("html", LINK)).alias("products"))


@query("product_table", f"""
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS n, unnest(regexp_extract_all(html, '{LINK}', 2)) AS v,
                      generate_subscripts(regexp_extract_all(html, '{LINK}', 1), 1) AS i FROM pages)
SELECT page_id, coalesce(string_agg({sql_strip_tags('n')} || ' (' || {sql_strip_tags('v')} || '%)', ', ' ORDER BY i)
                         FILTER (WHERE {sql_strip_tags('n')} <> '' AND {sql_strip_tags('v')} <> ''), '') AS products
FROM pages LEFT JOIN links USING (page_id) GROUP BY 1""")
def product_table(t):
    return vw.product_pages(t).select("page_id", pages.product_list("html").alias("products"))


@query("listing_metrics", vw.LISTING_PAGES_SQL)
def listing_metrics(t):
    return vw.listing_pages(t).select("company_id", pages.listing_metrics("html", "fundamentals").alias("m")).select(
        "company_id", "m.*")


# The same stack row by row: pages are split at opening brackets, each part is a tag and the text after it.
@query("main_text", f"""
WITH RECURSIVE parts AS (
  SELECT page_id, unnest(p) AS part, generate_subscripts(p, 1) AS i
  FROM (SELECT page_id, string_split(regexp_replace(html, '(?is)<(script|style).*?</(script|style)>', '', 'g'), '<') AS p FROM pages)),
tags AS (SELECT page_id, i, CASE WHEN i > 1 THEN lower(regexp_extract(part, '^/?([a-zA-Z][^\\s/>]*)', 1)) ELSE '' END AS name,
                i > 1 AND starts_with(part, '/') AS closes,
                {sql_strip(sql_unescape("CASE WHEN i > 1 THEN substr(part, instr(part, '>') + 1) ELSE part END"))} AS said FROM parts),
walk AS (
  SELECT page_id, 1::BIGINT AS i, []::VARCHAR[] AS stack, 0::BIGINT AS since, 0 AS block FROM pages
  UNION ALL
  SELECT page_id, i, CASE WHEN opens THEN list_append(stack, name) WHEN place > 0 THEN stack[1:place - 1] ELSE stack END,
         CASE WHEN begins THEN len(stack) + 1 WHEN place > 0 AND place <= since THEN 0 ELSE since END,
         block + CASE WHEN begins THEN 1 ELSE 0 END
  FROM (SELECT *, opens AND since = 0 AND name IN ('div', 'p', 'td') AS begins FROM (
    SELECT w.page_id, g.i, w.stack, w.since, w.block, g.name,
           name <> '' AND NOT closes AND name NOT IN ('meta', 'br', 'img', 'hr', 'link', 'input') AS opens,
           CASE WHEN closes AND list_contains(stack, name)
                THEN len(stack) + 1 - list_position(list_reverse(stack), name) ELSE 0 END AS place
    FROM walk w JOIN tags g ON g.page_id = w.page_id AND g.i = w.i + 1))),
blocks AS (SELECT page_id, block, string_agg(said, ' ' ORDER BY i) AS x FROM walk JOIN tags USING (page_id, i)
           WHERE since > 0 AND said <> '' GROUP BY 1, 2),
best AS (SELECT page_id, x, row_number() OVER (PARTITION BY page_id ORDER BY length(x) DESC, block) AS place FROM blocks WHERE length(x) >= 200)
SELECT page_id, coalesce(left(x, 700), '') AS main_text FROM pages LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (page_id)""")
def main_text(t):
    return t.pages.select("page_id", pages.main_text("html").alias("main_text"))


# --- evidence -------------------------------------------------------------------

EVIDENCE_SQL = """sig AS (
  SELECT item_id AS t, CASE WHEN length(regexp_extract(text, '^(\\w+)', 1)) > 2 THEN regexp_extract(text, '^(\\w+)', 1) ELSE '' END
           AS company_name, ['example.com', 'example.net', 'www.example.org'][length(text) % 3 + 1] AS company_domain,
         '1-' || item_id AS biz_reg_no FROM benchmark), evi AS (
  SELECT CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT) AS t, length(source) * 10 + ascii(lang) % 5 AS claim_no, d.doc_id,
         CASE lang WHEN 'en' THEN '언론' WHEN 'fr' THEN '공시' WHEN 'de' THEN '홈페이지' ELSE '기타' END AS source_type,
         regexp_replace(lower(text || ' ' || source || ' ' || coalesce(url, '')), '[^0-9a-z가-힣.\\-:/]', '', 'g') AS blob
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id), scored AS (
  SELECT e.*, s.company_name, CASE WHEN lower(company_name) <> '' AND contains(blob, lower(company_name)) THEN 3 ELSE 0 END
    + CASE WHEN contains(blob, company_domain) THEN 3 ELSE 0 END
    + CASE WHEN contains(regexp_replace(blob, '[^0-9]', '', 'g'), replace(biz_reg_no, '-', '')) THEN 4 ELSE 0 END AS match_score
  FROM evi e JOIN sig s USING (t)), strength AS (
  SELECT t, claim_no, max(match_score) AS max_match,
         count(*) FILTER (WHERE source_type IN ('공시', '등기', '홈페이지') AND match_score > 0) AS n_official, count(*) AS n_evidence
  FROM scored GROUP BY 1, 2)"""


@query("evidence_score", f"""WITH {EVIDENCE_SQL} SELECT t, claim_no, doc_id, source_type, match_score FROM scored""")
def evidence_score(t):
    scored = ev.evidence_match_score(vw.evidence(t), vw.signatures(t))
    return scored.select("t", "claim_no", "doc_id", "source_type", "match_score")


@query("best_claim", f"""WITH {EVIDENCE_SQL}
SELECT t, claim_no, max_match, n_official, n_evidence FROM (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY max_match DESC, n_official DESC, n_evidence DESC, claim_no) AS place
  FROM strength) WHERE place = 1""")
def best_claim(t):
    return ev.best_claim(ev.evidence_match_score(vw.evidence(t), vw.signatures(t)))


@query("validate_claims", f"""WITH {EVIDENCE_SQL}, people AS (
  SELECT item_id AS t, 'CEO ' || length(text) % 4 AS person FROM benchmark), claims AS (
  SELECT DISTINCT t, claim_no, 'CEO ' || (claim_no + t) % 3 AS name FROM evi), totals AS (
  SELECT p.t, count(c.claim_no) AS n_claims, count(*) FILTER (WHERE name = person) AS n_hits
  FROM people p LEFT JOIN claims c ON c.t = p.t GROUP BY 1), best AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.t ORDER BY max_match DESC, n_official DESC, n_evidence DESC, s.claim_no) AS place
  FROM strength s JOIN claims c ON c.t = s.t AND c.claim_no = s.claim_no JOIN people p ON p.t = s.t AND p.person = c.name), v AS (
  SELECT p.t, person, claim_no, max_match, n_official, n_evidence, CASE WHEN company_name = '' THEN '회사명 미확인'
    WHEN n_claims = 0 THEN 'CEO 주장 근거 없음' WHEN n_hits = 0 THEN '동명이인/타인 정보 가능성' WHEN n_evidence IS NULL THEN '근거가 없음'
    WHEN max_match < 3 THEN '회사 동일성 검증 실패' WHEN n_official < 1 THEN '공식/준공식 근거 부재' ELSE '' END AS reason
  FROM people p JOIN sig USING (t) JOIN totals USING (t) LEFT JOIN best b ON b.t = p.t AND place = 1)
SELECT t, person, reason = '' AS valid, reason, CASE WHEN reason = '' AND n_evidence < 2 THEN '근거 1개로 제한됨' ELSE '' END AS warning,
       claim_no, max_match, n_official, n_evidence FROM v""")
def validate_claims(t):
    people = t.benchmark.select(F.col("item_id").alias("t"),
                                F.concat(F.lit("CEO "), (F.length("text") % 4).cast("string")).alias("person"))
    evidence = vw.evidence(t)
    claims = evidence.select("t", "claim_no").distinct().withColumn(
        "name", F.concat(F.lit("CEO "), ((F.col("claim_no") + F.col("t")) % 3).cast("string")))
    return ev.validate_claims(people, claims, evidence, vw.signatures(t))


# --- records ----------------------------------------------------------------------

@query("default_row", """
SELECT d.doc_id, coalesce(CASE WHEN toxic = 1 THEN 'toxic:' || quality END, 'IPO (예상):-') AS rows
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def default_row(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    pair = F.struct(F.lit("toxic").alias("round"), F.col("quality").cast("string").alias("value"))
    items = F.when(F.col("toxic") == 1, F.array(pair)).when(F.col("toxic") == 0, F.array().cast(
        "array<struct<round:string,value:string>>"))
    filled = R.default_when_empty(items, F.struct(F.lit("IPO (예상)").alias("round"), F.lit("-").alias("value")))
    text = F.transform(filled, lambda r: F.concat_ws(":", r["round"], r["value"]))
    return rows.select("doc_id", F.array_join(text, ",").alias("rows"))


@query("split_categories", """
WITH c AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'm&a 또는 IPO' WHEN 'fr' THEN 'IPO' ELSE lang END AS category FROM documents)
SELECT doc_id, category FROM c WHERE category <> 'm&a 또는 IPO'
UNION ALL SELECT doc_id, unnest(['M&A', 'IPO']) FROM c WHERE category = 'm&a 또는 IPO'""")
def split_categories(t):
    lang = F.col("lang")
    cat = F.when(lang == "en", F.lit("m&a 또는 IPO")).when(lang == "fr", F.lit("IPO")).otherwise(lang)
    return R.split_categories(t.documents.select("doc_id", cat.alias("category")))


@query("detail_structs", f"""
WITH {PAIRS_SQL}, r AS (
  SELECT t, company_id, row_number() OVER (PARTITION BY t ORDER BY score DESC, company_id) AS no FROM scored)
SELECT t, string_agg(no || ':' || company_id, ',' ORDER BY no) AS details FROM r WHERE no <= 5 GROUP BY 1""")
def detail_structs(t):
    scores = sim.similarity_scores(*label_pairs(t)).select(
        "t", F.col("company_id").alias("company"), "score", F.col("similarity_reason").alias("reason"),
        F.lit("-").alias("main_products"))
    line = F.transform("similarity", lambda r: F.concat_ws(":", r["no"].cast("string"), r["company"].cast("string")))
    return R.similarity_details(scores).select("t", F.array_join(line, ",").alias("details"))


@query("mix_wide", """
SELECT o_orderpriority AS priority, round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4)::DOUBLE AS "F",
       round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'O') / count(*), 4)::DOUBLE AS "O",
       CASE WHEN o_orderpriority <> '5-LOW' THEN round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'P') / count(*), 4)::DOUBLE END AS "P"
FROM orders GROUP BY 1""")
def mix_wide(t):
    by_status = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("o_orderstatus") == s).alias(s) for s in ("F", "O", "P")])
    share = {s: F.round(F.col(s) * 100 / F.col("n"), 4) for s in ("F", "O", "P")}
    full = F.create_map(*[x for s, c in share.items() for x in (F.lit(s), c)])
    mix = F.when(F.col("priority") == "5-LOW", F.map_filter(full, lambda k, _: k != "P")).otherwise(full)
    return R.mix_wide(R.mix_long(by_status.select("priority", mix.alias("business_mix"))), ["priority"], ["F", "O", "P"])


@query("mix_numbered", """
WITH names AS (SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS no FROM (
       SELECT DISTINCT p_type || ' ' || p_brand AS segment FROM part)),
mix AS (SELECT l_suppkey, no, round(sum(l_quantity), 2) AS ratio FROM lineitem JOIN part ON p_partkey = l_partkey
        JOIN names ON segment = p_type || ' ' || p_brand GROUP BY 1, 2)
SELECT l_suppkey, count(*) AS n, string_agg(no || '=' || CAST(ratio AS BIGINT), ',' ORDER BY no) AS mix FROM mix GROUP BY 1""")
def mix_numbered(t):
    """Business mix of suppliers over segments that only the data name."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_type", "p_brand").alias("segment"))
    long = t.lineitem.join(part, "l_partkey").groupBy("l_suppkey", "segment").agg(F.round(F.sum("l_quantity"), 2).alias("ratio"))
    mix = R.mix_numbered(long, ["l_suppkey"], R.segment_numbers(long))
    shown = F.transform(F.map_entries("mix"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("bigint").cast("string")))
    return mix.select("l_suppkey", F.size("mix").cast("bigint").alias("n"), F.array_join(shown, ",").alias("mix"))


@query("matrix_cells", """
WITH y AS (SELECT o_custkey AS company_id, year(o_orderdate) AS label, count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
                  count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY label) - 1 AS row_no FROM y)
SELECT company_id, row_no::INTEGER AS row_no, label::VARCHAR AS label, col_no, period,
       CASE col_no WHEN 1 THEN f::VARCHAR WHEN 2 THEN o::VARCHAR END AS value
FROM n CROSS JOIN (VALUES (1, 'F'), (2, 'O'), (3, 'P')) c(col_no, period)""")
def matrix_cells(t):
    status, text = F.col("o_orderstatus"), "string"
    years = t.orders.groupBy(F.col("o_custkey").alias("company_id"), F.year("o_orderdate").cast(text).alias("label")).agg(
        F.count_if(status == "F").cast(text).alias("f"), F.count_if(status == "O").cast(text).alias("o"))
    # rows lack their last cell
    matrices = years.groupBy("company_id").agg(F.array_sort(F.collect_list(F.array("label", "f", "o"))).alias("Rows"))
    heads = F.array(*[F.lit(h) for h in ("year", "F", "O", "P")]).alias("Columns")
    return R.matrix_cells(matrices.select("company_id", F.struct(heads, "Rows").alias("matrix")))


MERGE_SQL = """base AS (SELECT c_custkey AS t, c_name, c_mktsegment FROM customer),
ord AS (SELECT o_custkey AS t, count(*) AS n, min(o_orderpriority) AS p FROM orders GROUP BY 1),
parts AS (SELECT p_partkey AS t, p_brand FROM part)"""


@query("merge_sections", f"""WITH {MERGE_SQL}
SELECT coalesce(b.t, o.t, p.t) AS t, coalesce(b.c_name, '') AS name, coalesce(p.p_brand, o.p, b.c_mktsegment) AS rating,
       CAST(o.n AS VARCHAR) AS orders, coalesce(p.p_brand, o.p, b.c_mktsegment) AS header_rating
FROM base b FULL JOIN ord o ON o.t = b.t FULL JOIN parts p ON p.t = coalesce(b.t, o.t)""")
def merge_sections(t):
    rating = F.lit("Investment_Rating")
    base = t.customer.select(F.col("c_custkey").alias("t"), F.create_map(
        F.lit("name"), "c_name", rating, "c_mktsegment").alias("record"))
    orders = t.orders.groupBy(F.col("o_custkey").alias("t")).agg(
        F.count(F.lit(1)).cast("string").alias("n"), F.min("o_orderpriority").alias("p")).select(
        "t", F.create_map(F.lit("orders"), "n", rating, "p").alias("record"))
    parts = t.part.select(F.col("p_partkey").alias("t"), F.create_map(rating, "p_brand").alias("record"))
    merged = R.merge_sections([base, orders, parts])
    record = F.col("record")
    header = R.move_rating(record, F.create_map(F.lit("title"), F.lit("x")))
    return merged.select("t", F.coalesce(record["name"], F.lit("")).alias("name"),
                         record["Investment_Rating"].alias("rating"), record["orders"].alias("orders"),
                         header["Investment_Rating"].alias("header_rating"))


@query("patch_merge", """
WITH p AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
b AS (SELECT o_orderkey AS t, o_custkey % 3 AS h, o_custkey % 2 AS r, o_custkey % 4 AS s, o_orderstatus AS st FROM orders)
SELECT t, CASE WHEN k IS NOT NULL AND k % 5 > h THEN 'p' || k % 5 ELSE 'b' || h END AS history,
       CASE WHEN k IS NOT NULL AND k % 3 > 0 AND r = 0 THEN 'p' || k % 3 ELSE 'b' || r END AS trends,
       CASE WHEN k IS NOT NULL AND k % 4 > 1 AND s <= 1 THEN 'p' || k % 4 ELSE 'b' || s END AS series,
       coalesce(event_type, st) AS person, coalesce(k::VARCHAR, st) AS logic
FROM b LEFT JOIN p ON event_id = t""")
def patch_merge(t):
    k = F.get_json_object("props", "$.k").cast("int")
    p, b = F.lit("p"), F.lit("b")
    patch = t.events.select(
        F.col("event_id").alias("t"), F.array_repeat(p, k % 5).alias("history"), F.array_repeat(p, k % 3).alias(
            "trends"), F.array_repeat(p, k % 4).alias("series"),
        F.create_map(F.lit("name"), "event_type").alias("person"), k.cast("string").alias("logic"))
    key = F.col("o_custkey").cast("int")
    base = t.orders.select(
        F.col("o_orderkey").alias("t"), F.array_repeat(b, key % 3).alias("history"), F.array_repeat(b, key % 2).alias(
            "trends"), F.array_repeat(b, key % 4).alias("series"),
        F.create_map(F.lit("name"), "o_orderstatus", F.lit("old"), F.lit("x")).alias("person"),
        F.col("o_orderstatus").alias("logic"))
    merged = R.patch_merge(base, patch, {"history": R.LONGER, "trends": R.IF_EMPTY, "series": R.SERIES,
                                         "person": R.OVERLAY, "logic": R.REPLACE})

    def short(name):
        c = F.col(name)
        return F.concat(F.coalesce(F.try_element_at(c, F.lit(1)), b), F.size(c).cast("string")).alias(name)

    return merged.select("t", short("history"), short("trends"), short("series"),
                         F.col("person")["name"].alias("person"), "logic")


@query("patch_documents", """
WITH p AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
b AS (SELECT o_orderkey AS t, o_custkey % 3 AS h, o_custkey % 2 AS r, o_custkey % 4 AS s, o_orderstatus AS st FROM orders),
j AS (SELECT *, k IS NOT NULL AS there, coalesce(k, 0) % 5 AS ph, coalesce(k, 0) % 3 AS pr, coalesce(k, 0) % 4 AS ps FROM b LEFT JOIN p ON event_id = t)
SELECT t, CASE WHEN ph > h THEN ph ELSE h END AS n_history, CASE WHEN pr > 0 AND r = 0 THEN 'new' WHEN r > 0 THEN 'old' END AS trend,
       CASE WHEN ps > 1 AND s <= 1 THEN 'Year=Revenue' || repeat(',2024=7.5', ps::BIGINT)
            ELSE 'Year=Revenue' || CASE WHEN s > 1 THEN repeat(',2020=1200.0', s::BIGINT) ELSE '' END END AS sales,
       'Year=Count' AS contracts, CASE WHEN there THEN event_type ELSE st END AS ceo, 'kept' AS philosophy,
       CASE WHEN there AND k % 2 = 1 THEN 'k' || k ELSE 'none' END AS logic, 'same' AS other
FROM j""")
def patch_documents(t):
    """Nested report documents completed from patch documents."""
    text = lambda c: F.to_json(c)
    items = lambda n, item: F.array_repeat(F.lit(item), n.cast("int"))
    series = lambda n, year, value: F.array_repeat(F.array(F.lit(year), F.lit(value)), n.cast("int"))
    key, k = F.col("o_custkey"), F.get_json_object("props", "$.k").cast("int")
    base = t.orders.select(F.col("o_orderkey").alias("t"), F.parse_json(text(F.struct(
        F.struct(items(key % 3, "b").alias("Investment_History")).alias("Financial_Status"),
        F.struct(items(key % 2, "old").alias("Target_Market_Trends"),
                 F.struct(series(key % 4, "2020년", "1,200억원").alias("Sales_Graph_Data")).alias("Export_and_Contract_Stats"),
                 F.lit("same").alias("Other")).alias("Growth_Potential"),
        F.struct(F.struct(F.col("o_orderstatus").alias("Name"), F.lit("kept").alias("Management_Philosophy")).alias(
            "CEO_Reference")).alias("Key_Personnel"),
        F.struct(F.lit("none").alias("Valuation_Logic_Detail")).alias("Valuation_and_Judgment")))).alias("doc"))
    patch = t.events.select(F.col("event_id").alias("t"), F.parse_json(text(F.struct(
        F.struct(items(k % 5, "p").alias("Investment_History")).alias("Financial_Status"),
        F.struct(items(k % 3, "new").alias("Target_Market_Trends"),
                 F.struct(series(k % 4, "2024", "7.5").alias("Sales_Graph_Data")).alias("Export_and_Contract_Stats"),
                 F.lit("not in the tree").alias("Other")).alias("Growth_Potential"),
        F.struct(F.struct(F.col("event_type").alias("Name")).alias("CEO_Reference")).alias("Key_Personnel"),
        F.struct(F.when(k % 2 == 1, F.concat(F.lit("k"), k.cast("string"))).alias("Valuation_Logic_Detail")).alias(
            "Valuation_and_Judgment")))).alias("doc"))
    done = R.patch_documents(base, patch)
    pairs = "array<array<string>>"
    read = F.try_variant_get("doc", "$", f"""struct<
        Financial_Status: struct<Investment_History: array<string>>,
        Growth_Potential: struct<Target_Market_Trends: array<string>, Other: string,
            Export_and_Contract_Stats: struct<Sales_Graph_Data: {pairs}, Contract_Count_Graph_Data: {pairs}>>,
        Key_Personnel: struct<CEO_Reference: struct<Name: string, Management_Philosophy: string>>,
        Valuation_and_Judgment: struct<Valuation_Logic_Detail: string>>""")
    growth, ceo = F.col("_read.Growth_Potential"), F.col("_read.Key_Personnel.CEO_Reference")

    def rows(name):
        return F.array_join(F.transform(growth["Export_and_Contract_Stats"][name], lambda r: F.array_join(r, "=")), ",")

    return done.select("t", read.alias("_read")).select(
        "t", F.size("_read.Financial_Status.Investment_History").cast("bigint").alias("n_history"),
        F.get(growth["Target_Market_Trends"], F.lit(0)).alias("trend"), rows("Sales_Graph_Data").alias("sales"),
        rows("Contract_Count_Graph_Data").alias("contracts"), ceo["Name"].alias("ceo"), ceo["Management_Philosophy"].alias("philosophy"),
        F.col("_read.Valuation_and_Judgment.Valuation_Logic_Detail").alias("logic"), growth["Other"].alias("other"))


SECTIONS = {"finance": R.FINANCE_FIELDS, "market": R.MARKET_FIELDS, "tech": R.TECH_FIELDS, "personnel": R.PERSONNEL_FIELDS,
            "valuation": R.VALUATION_FIELDS}


def _expected_fault(spec) -> str:
    """SQL of the one rule that a document breaks: rule and damage follow from the event's number."""
    rules = ", ".join(f"{{'p': '{f.path}', 'n': {str(f.nullable).lower()}}}" for f in spec)
    rule = f"([{rules}])[CAST(event_id % {len(spec)} AS INTEGER) + 1]"
    damage = f"event_id // {len(spec)} % 4"
    return (f"CASE WHEN {damage} = 0 THEN '' WHEN {damage} = 3 THEN 'type:' || {rule}.p WHEN {rule}.n THEN '' "
            f"WHEN {damage} = 1 THEN 'missing:' || {rule}.p ELSE 'null:' || {rule}.p END")


@query("section_schemas", "SELECT event_id, " + ", ".join(f"{_expected_fault(spec)} AS {name}" for name, spec in SECTIONS.items())
       + " FROM events")
def section_schemas(t):
    """The five section schemas, each over a document of every event with at most one fault."""
    docs = {name: F.parse_json(vw.section_document(spec, F.col("event_id"))) for name, spec in SECTIONS.items()}
    parsed = dealt(t.events.select("event_id")).select("event_id", *[doc.alias(f"{name}_doc") for name, doc in docs.items()])
    found = [F.array_join(R.violations(F.col(f"{name}_doc"), spec), ",").alias(name) for name, spec in SECTIONS.items()]
    return parsed.select("event_id", *found)


@query("schema_violations", """
WITH k AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k = 50 THEN 'unreadable' ELSE array_to_string(list_filter([
    CASE WHEN k >= 90 THEN 'missing:Title' WHEN k < 10 THEN 'null:Title' WHEN k < 20 THEN 'type:Title' END,
    CASE WHEN k % 5 <> 3 THEN 'length:Investment_Highlights' END,
    CASE WHEN k % 5 > 0 THEN 'missing:Investment_Highlights[].Source' END], lambda x: x IS NOT NULL), ',') END AS violations
FROM k""")
def schema_violations(t):
    spec = [R.Field("Title"), R.Field("Unit", nullable=True), R.Field("Investment_Highlights", "ARRAY", exact_len=3),
            R.Field("Investment_Highlights[].Highlight_Title"), R.Field("Investment_Highlights[].Highlight_Logic"),
            R.Field("Investment_Highlights[].Source")]
    checked = R.schema_violations(vw.json_sections(t), "section", spec)
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


# --- reports ----------------------------------------------------------------------

@query("infer_unit", """
WITH v AS (SELECT p_type AS kind, p_partkey, CASE split_part(p_name, ' ', 2) WHEN 'bolt' THEN '백만원' WHEN 'gear' THEN '억원'
    WHEN 'ring' THEN '조원' WHEN 'rod' THEN '천원' WHEN 'widget' THEN '만원' WHEN 'plate' THEN '%' WHEN 'anvil' THEN '달러' END AS u
  FROM part), c AS (SELECT kind, u, count(*) AS n, min(p_partkey) AS f FROM v WHERE u IS NOT NULL GROUP BY 1, 2)
SELECT kind, coalesce(u, '백만원') AS unit FROM (SELECT DISTINCT kind FROM v)
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, f) AS place FROM c) USING (kind)
WHERE place = 1 OR place IS NULL""")
def infer_unit(t):
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    units = {"bolt": "백만원", "gear": "억", "ring": "조원", "rod": "천", "widget": "만", "plate": "%", "anvil": "$"}
    mark = F.coalesce(*[F.when(word == w, F.lit(u)) for w, u in units.items()], F.lit(""))
    values = t.part.select(F.col("p_type").alias("kind"), "p_partkey",
                           F.concat(F.col("p_size").cast("string"), F.lit(" "), mark).alias("value"))
    return rep.infer_unit(values, "kind", "value", "p_partkey")


@query("nonzero_series", """
WITH s AS (SELECT user_id || '-' || event_type AS series, event_id, CASE WHEN value > 200 THEN value ELSE 0 END AS value FROM events)
SELECT series, event_id, value FROM s WHERE series IN (SELECT series FROM s GROUP BY 1 HAVING sum(value) <> 0)""")
def nonzero_series(t):
    rows = t.events.select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("series"), "event_id",
                           F.when(F.col("value") > 200, F.col("value")).otherwise(0.0).alias("value"))
    return rep.nonzero_series(rows, "series", "value")


@query("funding_timeline", f"""WITH {AMOUNT_SQL}, raw AS (
  SELECT user_id AS t, event_id AS seq, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'signup' THEN 'Seed' WHEN 'view' THEN 'Pre-A' WHEN 'click' THEN 'Series A' WHEN 'purchase' THEN 'Pre-IPO'
              ELSE '비공개' END AS lab FROM events), keyed AS (
  SELECT t, seq, CASE WHEN k < 20 THEN lab ELSE (2015 + k % 9) || '.' || lpad((k % 12 + 1)::VARCHAR, 2, '0') END AS date,
         CASE WHEN lab = '비공개' THEN 'N/A' ELSE lab END AS round, CASE WHEN k < 20 THEN 9999 ELSE 2015 + k % 9 END AS sort_year,
         CASE lab WHEN 'Seed' THEN 2 WHEN 'Pre-A' THEN 3 WHEN 'Series A' THEN 4 WHEN 'Pre-IPO' THEN 9 ELSE 99 END AS sort_round,
         CASE lab WHEN 'Seed' THEN 'seed' WHEN 'Pre-A' THEN 'pre' WHEN 'Series A' THEN 'series a' WHEN 'Pre-IPO' THEN 'pre'
              ELSE 'other' END AS round_class FROM raw)
SELECT t, seq, date, round, CASE WHEN sort_year = 9999 THEN round ELSE sort_year::VARCHAR END AS axis_label, amount,
       label AS amount_label, round_class, sort_year, sort_round,
       row_number() OVER (PARTITION BY t ORDER BY sort_year, sort_round, seq) - 1 AS x
FROM keyed JOIN money ON event_id = seq""")
def funding_timeline(t):
    return rep.funding_timeline(vw.funding_rounds(t))


@query("list_preview", """
WITH r AS (SELECT c_nationkey AS t, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS no,
                  count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT t, any_value(n) AS n, format('{:,}', any_value(n)) || '개사 (' || string_agg(c_name, ', ' ORDER BY no) FILTER (WHERE no <= 20)
       || CASE WHEN any_value(n) > 20 THEN ', ...)' ELSE ')' END AS preview FROM r GROUP BY 1""")
def list_preview(t):
    rows = t.customer.select(F.col("c_nationkey").alias("t"), "c_name", "c_custkey")
    return rep.list_preview(rows, "t", "c_name", "c_custkey")


@query("mark_members", """
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN '통과' ELSE '미통과' END AS status
FROM documents""")
def mark_members(t):
    return rep.mark_members(t.documents.select("doc_id"), t.labels.filter("quality = 1"), ["doc_id"])


