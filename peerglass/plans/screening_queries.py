"""Queries of industry matching, screening and valuation."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerglass.functions.numbers import round_discount, sentinel_number
from peerglass.operators import matching as M
from peerglass.operators import screening as S
from peerglass.operators import similarity as sim
from peerglass.operators import valuation as val
from peerglass.operators.distributed import join_split
from peerglass.plans import views as vw
from peerglass.plans.registry import query


def _industries(t):
    return t.part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("code"),
                         F.col("p_partkey").alias("row_no"))


def _part_companies(t):
    return t.part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("company_code"))


# --- industries and codes ---------------------------------------------------

@query("industry_map", """
SELECT p_type AS name, count(DISTINCT p_brand) AS n_codes, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS codes
FROM part GROUP BY 1""")
def industry_map(t):
    return M.industry_map(t.part, "p_type", "p_brand").select(
        F.col("p_type").alias("name"), F.size("codes").cast("bigint").alias("n_codes"),
        F.array_join("codes", ",").alias("codes"),
    )


@query("industry_vocab", """
SELECT p_name AS name, min(p_partkey) AS row_no FROM part GROUP BY 1 ORDER BY 2, 1 LIMIT 1500""")
def industry_vocab(t):
    return M.industry_vocab(_industries(t), "name", "row_no")


@query("keyword_industry", """
WITH kw AS (SELECT DISTINCT p_size AS t, split_part(p_name, ' ', 2) AS keyword FROM part)
SELECT DISTINCT kw.t, p.p_brand AS code FROM kw JOIN part p ON contains(p.p_name, kw.keyword)""")
def keyword_industry(t):
    keywords = t.part.select(
        F.col("p_size").alias("t"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("keyword")
    )
    return M.keyword_industry_codes(keywords, _industries(t))


@query("companies_by_code", """
WITH tg AS (SELECT n_nationkey AS t, 'Brand#' || (n_nationkey + 1) AS code FROM nation)
SELECT DISTINCT t, p_name AS name FROM tg JOIN part
  ON p_brand = code OR (length(code) >= 3 AND contains(p_brand, code))""")
def companies_by_code(t):
    return M.companies_by_code(vw.target_codes(t), _part_companies(t))


@query("parent_code_retry", """
WITH tg AS (SELECT n_nationkey AS t, 'Brand#' || (n_nationkey + 10) AS code FROM nation),
hit AS (SELECT t, code, p_name FROM tg LEFT JOIN part ON contains(p_brand, code)),
parent AS (SELECT DISTINCT t, left(code, length(code) - 1) AS code FROM hit WHERE p_name IS NULL)
SELECT DISTINCT t, p_name AS name FROM hit WHERE p_name IS NOT NULL
UNION SELECT DISTINCT t, p_name FROM parent JOIN part ON contains(p_brand, code)""")
def parent_code_retry(t):
    targets = t.nation.select(F.col("n_nationkey").alias("t"),
                              F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 10).cast("string")).alias("code"))
    return M.companies_by_code(targets, _part_companies(t), parent_retry=True)


@query("semi_members", """
WITH peers AS (SELECT o_custkey FROM orders)
SELECT c_nationkey AS t, c_custkey AS company_id, c_name AS name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM peers)""")
def semi_members(t):
    peers = t.orders.select(F.col("o_custkey").alias("company_id"))
    rows = t.customer.select(F.col("c_nationkey").alias("t"), F.col("c_custkey").alias("company_id"),
                             F.col("c_name").alias("name"))
    return M.restrict_to(rows, peers, ["company_id"]).select("t", "company_id", "name")


@query("lookup_code", """
WITH asked AS (SELECT DISTINCT name FROM (
  SELECT p_name AS name FROM part UNION ALL SELECT upper(split_part(p_name, ' ', 2)) FROM part
  UNION ALL SELECT s_name FROM supplier)),
exact AS (SELECT name, min(p_partkey) AS k FROM asked JOIN part ON p_name = name GROUP BY 1),
partial AS (SELECT name, min(p_partkey) AS k FROM asked JOIN part ON contains(lower(p_name), lower(name))
            WHERE name NOT IN (SELECT name FROM exact) GROUP BY 1)
SELECT a.name, lpad(CAST(coalesce(e.k, p.k) AS VARCHAR), CAST(greatest(6, length(CAST(coalesce(e.k, p.k) AS VARCHAR))) AS INTEGER), '0')
         AS code,
       CASE WHEN e.k IS NOT NULL THEN 'exact' WHEN p.k IS NOT NULL THEN 'contains' ELSE 'none' END AS match
FROM asked a LEFT JOIN exact e USING (name) LEFT JOIN partial p USING (name)""")
def lookup_code(t):
    word = F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))
    names = (
        t.part.select(F.col("p_name").alias("name")).unionByName(t.part.select(word.alias("name")))
        .unionByName(t.supplier.select(F.col("s_name").alias("name")))
    )
    companies = t.part.select(F.col("p_name").alias("company"), F.col("p_partkey").cast("string").alias("code"),
                              F.col("p_partkey").alias("row_no"))
    return M.lookup_code(names, companies)


@query("distinct_peers", """
SELECT DISTINCT l_suppkey AS t, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey""")
def distinct_peers(t):
    # Distinct keys before the join: the fact table shrinks first.
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    named = pairs.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return M.distinct_peers(named.select(F.col("l_suppkey").alias("t"), F.col("p_name").alias("name")))


@query("dedupe_first", """
SELECT o_custkey AS t, CAST(CASE WHEN length(c) < 6 THEN lpad(c, 6, '0') ELSE c END AS VARCHAR) AS code,
       min(o_orderkey) AS row_no, arg_min(o_orderpriority, o_orderkey) AS priority
FROM (SELECT *, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS VARCHAR) AS c FROM orders) GROUP BY 1, 2""")
def dedupe_first(t):
    rows = t.orders.select(
        F.col("o_custkey").alias("t"), F.col("o_orderkey").alias("row_no"), F.col("o_orderpriority").alias("priority"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("string").alias("code"),
    )
    return M.dedupe_by_code(rows)


@query("expand_pool", """
WITH wide AS (SELECT DISTINCT l_suppkey * 100 + l_quantity::BIGINT AS t, p_name AS name, l_returnflag AS flag
              FROM lineitem JOIN part ON p_partkey = l_partkey),
base AS (SELECT DISTINCT t, name FROM wide WHERE flag = 'R'),
small AS (SELECT t FROM wide WHERE t NOT IN (SELECT t FROM base GROUP BY 1 HAVING count(*) > 10))
SELECT t, name FROM base UNION SELECT t, name FROM wide WHERE t IN (SELECT t FROM small)""")
def expand_pool(t):
    # Both matches come from one scan: each pair carries whether it is wider.
    wide = F.col("l_returnflag") != "R"
    target = F.col("l_suppkey") * 100 + F.col("l_quantity").cast("bigint")
    rows = t.lineitem.select(target.alias("t"), "l_partkey", wide.alias("wide")).distinct()
    named = rows.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    tagged = named.select("t", F.col("p_name").alias("name"), "wide")
    return M.widen_small(tagged, "wide")


# --- stage 2 ------------------------------------------------------------------

@query("december_filter", """
SELECT o_orderkey, month(o_orderdate) || '월' AS month, CAST(o_custkey AS VARCHAR) AS code FROM orders
WHERE contains(month(o_orderdate) || '월', '12')""")
def december_filter(t):
    rows = t.orders.select("o_orderkey", F.concat(F.month("o_orderdate").cast("string"), F.lit("월")).alias("month"),
                           F.col("o_custkey").cast("string").alias("code"))
    return S.december_filter(rows)


@query("profit_filter", f"""WITH {vw.CELLS_SQL}
SELECT company_id, label, period, TRY_CAST(replace(value, ',', '') AS DOUBLE) AS amount FROM cells
WHERE coalesce(TRY_CAST(replace(nullif(value, '-'), ',', '') AS DOUBLE), -999999) > 0""")
def profit_filter(t):
    return S.profit_filter(vw.cells(t), "value").select(
        "company_id", "label", "period", sentinel_number("value").alias("amount"))


@query("income_verdict", f"""WITH {vw.INCOME_SQL}
SELECT company_id, net_income, profit_passed, income_reason FROM verdicts""")
def income_verdict(t):
    companies = t.customer.select(F.col("c_custkey").alias("company_id"))
    return S.income_verdict(companies, vw.cells(t), income_period=vw.INCOME_PERIOD)


STAGE2_SQL = f"""{vw.LISTED_SQL}, {vw.INCOME_SQL}, pool AS (
  SELECT c_nationkey AS t, c_custkey AS company_id FROM customer), s2 AS (
  SELECT t, company_id, l.code, l.row_no, v.net_income, v.income_reason, v.profit_passed AS profit,
         contains(coalesce(l.month, ''), '12') AND l.code <> '' AS is_dec
  FROM pool JOIN listed l USING (company_id) JOIN verdicts v USING (company_id)), s2b AS (
  SELECT *, is_dec AND row_number() OVER (PARTITION BY t, code, is_dec ORDER BY row_no) = 1 AS dec_passed FROM s2)"""


@query("stage2_financial", f"""WITH {STAGE2_SQL}
SELECT t, company_id, CASE WHEN length(code) < 6 THEN lpad(code, 6, '0') ELSE code END AS code, dec_passed,
       dec_passed AND profit AS profit_passed, net_income, income_reason FROM s2b""")
def stage2_financial(t):
    pool = t.customer.select(F.col("c_nationkey").alias("t"), F.col("c_custkey").alias("company_id"))
    return S.stage2_financial(pool, vw.listed(t), vw.cells(t), income_period=vw.INCOME_PERIOD).select(
        "t", "company_id", "code", "dec_passed", "profit_passed", "net_income", "income_reason")


# --- stage 3 ------------------------------------------------------------------

def label_pairs(t):
    """Target of a label: its first vector.  Candidates: the other vectors of the label."""
    firsts = t.embeddings.groupBy(F.col("label").alias("t")).agg(
        F.min("vec_id").alias("first"), F.min_by("embedding", "vec_id").alias("embedding"))
    pairs = join_split(t.embeddings.select(F.col("label").alias("t"), F.col("vec_id").alias("company_id")),
                       firsts.select("t", "first"), "t").filter("company_id <> first").select("t", "company_id")
    return pairs, firsts.select("t", "embedding"), vw.vectors(t)


PAIRS_SQL = """tv AS (SELECT label AS t, min(vec_id) AS first, arg_min(embedding, vec_id) AS te FROM embeddings GROUP BY 1),
scored AS (SELECT t, vec_id AS company_id,
  round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    list_cosine_similarity(te::DOUBLE[], embedding::DOUBLE[]))), 6) AS score
  FROM embeddings JOIN tv ON label = t AND vec_id <> first)"""


@query("similarity_pairs", f"""WITH {PAIRS_SQL}
SELECT t, company_id, score, score >= 0.3 AS similar FROM scored""")
def similarity_pairs(t):
    return sim.similarity_scores(*label_pairs(t)).select("t", "company_id", "score", "similar")


@query("top_similar", f"""WITH {PAIRS_SQL}
SELECT t, company_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY score DESC, company_id) AS rank FROM scored) WHERE rank <= 15""")
def top_similar(t):
    scores = sim.similarity_scores(*label_pairs(t)).select("t", "company_id", "score")
    return sim.top_similar(scores)


@query("stage3_similarity", f"""WITH {PAIRS_SQL}
SELECT t, company_id, score, score >= 0.3 AS similar,
       coalesce(CASE WHEN p_size > 25 THEN p_name END, '정보 없음') AS main_products
FROM scored LEFT JOIN part ON p_partkey = company_id""")
def stage3_similarity(t):
    info = t.part.select(F.col("p_partkey").alias("company_id"),
                         F.when(F.col("p_size") > 25, F.col("p_name")).alias("main_products"))
    return sim.stage3_similarity(*label_pairs(t), info).select("t", "company_id", "score", "similar", "main_products")


@query("attach_default", """
SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN 'quality ' || quality END, '정보 없음') AS main_products
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def attach_default(t):
    info = t.labels.select("doc_id", F.when(F.col("quality") == 1, F.concat(F.lit("quality "), F.col(
        "quality").cast("string"))).alias("main_products"))
    return sim.attach_products(t.documents.select("doc_id"), info, "doc_id")


# --- stage 4 ------------------------------------------------------------------

def _metrics(t):
    """Metrics of every company; the requirement stage reads them three times."""
    return vw.company_metrics(t)


@query("general_requirements", f"""WITH {vw.METRICS_SQL}
SELECT t, company_id, r = '' AS passed, CASE WHEN r = '' THEN 'OK' ELSE r END AS reason
FROM (SELECT *, {vw.reasons_sql(True)} AS r FROM metrics)""")
def general_requirements(t):
    return S.general_requirements(vw.company_metrics(t)).select("t", "company_id", "passed", "reason")


@query("screen_fallback", f"""WITH {vw.METRICS_SQL}, thin AS (SELECT * REPLACE (per / 3 AS per) FROM metrics), {vw.stage4_sql('thin')}
SELECT t, company_id, relaxed, ok AS passed, CASE WHEN base_r = '' THEN 'OK' ELSE base_r END AS reason FROM s4""")
def screen_fallback(t):
    thin = vw.company_metrics(t).withColumn("per", F.col("per") / 3)
    return S.screen_with_fallback(thin).select("t", "company_id", "relaxed", "passed", "reason")


@query("trim_extremes", f"""WITH {vw.METRICS_SQL}, {vw.stage4_sql('metrics')}
SELECT t, company_id, passed, is_outlier, reason FROM s4 WHERE NOT relaxed
UNION ALL SELECT t, company_id, false, false, strict_r FROM s4 WHERE relaxed""")
def trim_extremes(t):
    return S.trim_extremes(S.general_requirements(_metrics(t))).select(
        "t", "company_id", "passed", "is_outlier", "reason")


@query("stage4_requirements", f"""WITH {vw.METRICS_SQL}, {vw.stage4_sql('metrics')}
SELECT t, company_id, relaxed, passed, is_outlier, reason, per, pbr, market_cap, ev_ebitda FROM s4""")
def stage4_requirements(t):
    return S.stage4_requirements(_metrics(t)).select(
        "t", "company_id", "relaxed", "passed", "is_outlier", "reason", "per", "pbr", "market_cap", "ev_ebitda")


@query("peer_details", f"""WITH {vw.METRICS_SQL}, {vw.stage4_sql('metrics')}, r AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY CASE WHEN passed THEN 2 WHEN is_outlier THEN 1 ELSE 0 END,
                               company_id) AS no FROM s4)
SELECT t, count(*) AS n, string_agg(no || ':' || company_id || ':' || passed || ':' || reason, '|' ORDER BY no) AS details
FROM r WHERE no <= 30 GROUP BY 1""")
def peer_details(t):
    details = S.peer_details(S.stage4_requirements(_metrics(t)))
    line = F.transform("requirements", lambda r: F.concat_ws(
        ":", r["no"].cast("string"), r["company"].cast("string"), r["passed"].cast("string"), r["reason"]))
    return details.select("t", F.size("requirements").cast("bigint").alias("n"),
                          F.array_join(line, "|").alias("details"))


@query("reason_counts", f"""WITH {vw.METRICS_SQL}, {vw.stage4_sql('metrics')}
SELECT t, count(*) FILTER (WHERE is_outlier) AS n_outliers,
       CASE WHEN count(*) FILTER (WHERE is_outlier) = 0 THEN 'no trim'
            WHEN bool_or(starts_with(reason, 'MAX/MIN')) FILTER (WHERE is_outlier) THEN 'per only' ELSE 'full trim' END AS note
FROM s4 GROUP BY 1""")
def reason_counts(t):
    return S.outlier_note(S.stage4_requirements(_metrics(t)))


# --- the funnel ---------------------------------------------------------------

def _pool(t):
    """Stage 1: companies by code; small pools get those of the region's code as well."""
    companies = vw.listed(t).select("company_id", "company_code")
    own, wide = F.col("n_nationkey"), F.col("n_regionkey")
    tries = F.array(*[F.struct(F.lit(w).alias("wide"), F.concat(F.lit("Brand#"), (n + 1).cast("string")).alias("code"))
                      for w, n in ((False, own), (True, wide))])
    codes = t.nation.select(own.alias("t"), F.explode(tries).alias("c")).select("t", "c.*")
    matched = M.match_companies(codes, companies, target=["t", "wide"], company="company_id", parent_retry=True)
    pool = M.widen_small(matched, "wide", company="company_id")
    return pool.select("t", F.col("company_id").cast("bigint").alias("company_id"))


def _funnel(t):
    master = vw.companies(t).drop("t", "name", "company_code")
    return S.peer_funnel(_pool(t), master, vw.cells(t), vw.target_vectors(t), vw.vectors(t), threshold=vw.VECTOR_THRESHOLD,
                         income_period=vw.INCOME_PERIOD)


FUNNEL_SQL = f"""{vw.LISTED_SQL}, {vw.INCOME_SQL}, {vw.METRICS_SQL}, tg AS (
  SELECT n_nationkey AS t, 'Brand#' || (n_nationkey + 1) AS code, 'Brand#' || (n_regionkey + 1) AS wide FROM nation),
p1 AS (SELECT t, company_id FROM tg JOIN listed ON contains(company_code, tg.code)), p2 AS (
  SELECT t, company_id FROM p1 UNION
  SELECT t, company_id FROM tg JOIN listed ON contains(company_code, wide)
  WHERE t NOT IN (SELECT t FROM p1 GROUP BY 1 HAVING count(*) > 10)), f1 AS (
  SELECT p.t, company_id, l.code, l.row_no, v.income_reason, v.profit_passed AS profit,
         contains(coalesce(l.month, ''), '12') AND l.code <> '' AS is_dec,
         m.is_warning, m.market_cap, m.per, m.pbr, m.ev_ebitda,
         CASE WHEN e.embedding IS NULL THEN 0.0 ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           list_cosine_similarity(te.embedding::DOUBLE[], e.embedding::DOUBLE[]))), 6) END AS raw_score,
         e.embedding IS NULL AS no_info
  FROM p2 p JOIN listed l USING (company_id) JOIN verdicts v USING (company_id)
  JOIN metrics m USING (company_id) JOIN embeddings te ON te.vec_id = p.t
  LEFT JOIN embeddings e ON e.vec_id = company_id), f2 AS (
  SELECT *, is_dec AND row_number() OVER (PARTITION BY t, code, is_dec ORDER BY row_no) = 1 AS dec_passed FROM f1), f3 AS (
  SELECT *, dec_passed AND profit AS profit_passed, CASE WHEN dec_passed AND profit THEN raw_score END AS score,
         dec_passed AND profit AND raw_score >= {vw.VECTOR_THRESHOLD} AS is_similar FROM f2),
{vw.stage4_sql('f3', 'is_similar')}, f5 AS (
  SELECT t, company_id, CASE WHEN passed THEN 4 WHEN is_similar THEN 3 WHEN profit_passed THEN 2 ELSE 1 END AS stage_reached,
         dec_passed, passed, is_outlier, score, per,
         CASE WHEN is_similar THEN reason WHEN profit_passed THEN CASE WHEN no_info THEN '사업 정보 없음' ELSE 'scored' END
              WHEN dec_passed THEN income_reason ELSE '결산월' END AS reason,
         CASE WHEN passed THEN row_number() OVER (PARTITION BY t, passed ORDER BY score DESC, company_id) END AS place
  FROM s4), funnel AS (SELECT * EXCLUDE (place), CASE WHEN place <= 10 THEN place END AS peer_rank FROM f5)"""


@query("peer_funnel", f"""WITH {FUNNEL_SQL}
SELECT t, company_id, stage_reached, dec_passed, passed, reason, is_outlier, score, per, peer_rank FROM funnel""")
def peer_funnel(t):
    return _funnel(t)


@query("funnel_counts", f"""WITH {FUNNEL_SQL}
SELECT t, count(*) AS stage1_pool, count(*) FILTER (WHERE dec_passed) AS stage2_december,
       count(*) FILTER (WHERE stage_reached >= 2) AS stage2_profit,
       count(*) FILTER (WHERE stage_reached >= 3) AS stage3_similar,
       count(*) FILTER (WHERE stage_reached >= 4) AS stage4_passed, count(peer_rank) AS final_peers
FROM funnel GROUP BY 1""")
def funnel_counts(t):
    return S.funnel_counts(_funnel(t))


# --- valuation ------------------------------------------------------------------

def _final_peers(t):
    """Final peers by the requirement stage alone, best multiples first."""
    judged = S.stage4_requirements(_metrics(t)).withColumn("score", F.col("pbr"))
    return S.cap_peers(judged)


PEERS_SQL = f"""{vw.METRICS_SQL}, {vw.stage4_sql('metrics')}, peers AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY pbr DESC NULLS LAST, company_id) AS place
                 FROM s4 WHERE passed) WHERE place <= 10), multiples AS (
  SELECT n_nationkey AS t, coalesce(avg(per), 0.0) AS avg_per FROM nation LEFT JOIN peers ON t = n_nationkey GROUP BY 1)"""


@query("peer_multiple", f"""WITH {PEERS_SQL} SELECT t, round(avg_per, 6) AS avg_per FROM multiples""")
def peer_multiple(t):
    targets = t.nation.select(F.col("n_nationkey").alias("t"))
    peers = targets.join(_final_peers(t).select("t", "per", "passed"), "t", "left")
    return val.peer_multiple(peers).select("t", F.round("avg_per", 6).alias("avg_per"))


@query("scenario_grid", """
SELECT c_custkey AS t, scenario_no, scenario, CAST(ratio AS DOUBLE) AS ratio FROM customer
CROSS JOIN (VALUES (0, '낙관적', 1.0), (1, '중립적', 0.7), (2, '보수적', 0.5)) s(scenario_no, scenario, ratio)""")
def scenario_grid(t):
    return val.expand_scenarios(t.customer.select(F.col("c_custkey").alias("t")))


SCENARIO_SQL = f"""{PEERS_SQL}, inputs AS (
  SELECT n_nationkey AS t, CAST(floor(income) AS BIGINT) AS income,
         CASE WHEN n_nationkey < 10 THEN CAST(floor(capital) AS BIGINT) END AS shares0,
         ['Seed', 'Pre-A', 'Series A', 'Pre-B', 'Pre-IPO'][n_regionkey + 1] AS round,
         CASE WHEN n_nationkey < 20 THEN CAST(floor(capital) * 5000 AS BIGINT) END AS capital
  FROM nation LEFT JOIN (
    SELECT c_nationkey, sum(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END) AS income
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1) i ON i.c_nationkey = n_nationkey
  LEFT JOIN (SELECT c_nationkey, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS capital FROM customer GROUP BY 1) k
    ON k.c_nationkey = n_nationkey), base AS (
  SELECT i.t, income, avg_per, scenario_no, scenario, CAST(ratio AS DOUBLE) AS ratio,
         coalesce(nullif(shares0, 0), CASE WHEN capital > 0 THEN CAST(trunc(capital / 500) AS BIGINT) END, shares0) AS shares,
         CAST(CASE round WHEN 'Seed' THEN 0.8 WHEN 'Pre-A' THEN 0.6 WHEN 'Series A' THEN 0.5 WHEN 'Pre-B' THEN 0.4
              WHEN 'Pre-IPO' THEN 0.2 END AS DOUBLE) AS discount
  FROM inputs i JOIN multiples USING (t)
  CROSS JOIN (VALUES (0, '낙관적', 1.0), (1, '중립적', 0.7), (2, '보수적', 0.5)) s(scenario_no, scenario, ratio)), v1 AS (
  SELECT *, avg_per > 0 AND coalesce(income, 0) <> 0 AS can,
         CASE WHEN avg_per > 0 AND coalesce(income, 0) <> 0
              THEN CAST(floor(income * ratio / (1 + discount) / 1000000) AS BIGINT) * 1000000 END AS pv FROM base), v2 AS (
  SELECT *, pv * avg_per AS ev, CASE WHEN coalesce(shares, 0) <> 0 THEN pv * avg_per / shares END AS price FROM v1), v AS (
  SELECT *, CAST(floor(price * CAST(0.6 AS DOUBLE) / 100) AS BIGINT) * 100 AS final_price FROM v2)"""


def _approx_sql(c: str) -> str:
    return f"""CASE
    WHEN {c} >= 1e12 THEN '(약 ' || CAST(floor({c} / 1e12) AS BIGINT) || '조' || CASE
      WHEN floor(({c} - floor({c} / 1e12) * 1e12) / 1e8) > 0
      THEN ' ' || format('{{:,}}', CAST(floor(({c} - floor({c} / 1e12) * 1e12) / 1e8) AS BIGINT)) || '억' ELSE '' END || ')'
    WHEN {c} >= 1e8 THEN '(약 ' || format('{{:,}}', CAST(floor({c} / 1e8) AS BIGINT)) || '억)'
    ELSE '(약 ' || format('{{:,}}', CAST(floor({c} / 1e4) AS BIGINT)) || '만)' END"""


@query("scenario_valuation", f"""WITH {SCENARIO_SQL}
SELECT t, scenario_no, scenario, ratio, round(avg_per, 6) AS avg_per, discount, shares, pv, round(ev, 4) AS ev,
       round(price, 4) AS price, final_price, 'IR 추정치 ' || CAST(trunc(ratio * 100) AS BIGINT) || '% 달성' AS ratio_text,
       format('{{:,}}', pv) || '원' || chr(10) || {_approx_sql('CAST(pv AS DOUBLE)')} AS pv_text,
       format('{{:,.0f}}', ev) || '원' || chr(10) || {_approx_sql('ev')} AS ev_text,
       CASE WHEN can THEN coalesce(format('{{:,.0f}}', price) || '원', '-') END AS price_text,
       CASE WHEN can THEN coalesce(format('{{:,}}', final_price) || '원', '-') END AS final_price_text,
       CASE WHEN can THEN '' ELSE array_to_string(list_filter([
         CASE WHEN avg_per <= 0 THEN '유효한 Peer PER 데이터 부재' END,
         CASE WHEN coalesce(income, 0) = 0 THEN '추정 당기순이익 정보 부재' END], lambda x: x IS NOT NULL), '; ')
       END AS not_computable,
       CASE WHEN NOT can THEN '-' WHEN coalesce(shares, 0) = 0 THEN '산출 불가 (주식수 부재)'
            WHEN scenario_no = 0 THEN format('{{:,}}', final_price) || '원' END AS headline_price
FROM v""")
def scenario_valuation(t):
    multiples = val.peer_multiple(_final_peers(t).select("t", "per", "passed"))
    rows = val.scenario_valuation(vw.valuation_inputs(t), multiples)
    return rows.withColumns({c: F.round(c, p) for c, p in (("avg_per", 6), ("ev", 4), ("price", 4))})


@query("valuation_summary", f"""WITH {SCENARIO_SQL}, s AS (
  SELECT v.*, shares0, round, CASE WHEN avg_per > 0 THEN printf('%.2f배', avg_per) ELSE '산출 불가' END AS multiple,
         CASE WHEN NOT can THEN '-' WHEN coalesce(shares, 0) = 0 THEN '산출 불가 (주식수 부재)'
              ELSE format('{{:,}}', final_price) || '원' END AS headline
  FROM v JOIN inputs USING (t) WHERE scenario_no = 0)
SELECT t, headline AS headline_price, CASE WHEN can
    THEN '1단계 (Peer 평균 PER): ' || multiple || ' 적용' || chr(10) || '2단계 (할인율 적용): 타겟 투자 라운드 [' || round
      || '] 리스크를 반영하여 현가 할인율 ' || CAST(round(discount * 100) AS BIGINT) || '% 적용' || chr(10)
      || '3~4단계 (가치 산출): 하단의 시나리오별 밸류에이션 표 참조' || chr(10) || CASE
        WHEN coalesce(shares, 0) = 0 THEN '  * 참고: 자본금 및 발행주식수 정보 부재로 주당 단가 산출 생략'
        WHEN coalesce(shares0, 0) <> 0 THEN '  * 참고: 기준 주식수 ' || format('{{:,}}', shares)
          || '주 (명시된 주식수가 없을 경우, 자본금을 바탕으로 액면가 500원을 가정하여 역산된 주식수일 수 있습니다.)'
        ELSE '  * 참고: 기준 주식수 ' || format('{{:,}}', shares) || '주 (문서 내 정보 부재로 외부 검색 (자본금) 바탕으로 액면가 500원 가정 역산)' END
    ELSE '※ 산출 불가 사유:' || chr(10) || CASE WHEN avg_per <= 0 THEN '- 유효한 Peer PER 데이터 부재' || chr(10) ELSE '' END
      || CASE WHEN coalesce(income, 0) = 0 THEN '- 2002년 추정 당기순이익 정보 부재' || chr(10) ELSE '' END END AS rationale,
  CASE WHEN coalesce(income, 0) <> 0 THEN format('{{:,}}', income) || '원' ELSE '정보 부재' END AS net_income_text,
  CASE WHEN coalesce(shares, 0) <> 0 THEN format('{{:,}}', shares) || '주' ELSE '정보 부재' END AS shares_text, multiple AS multiple_text,
  CAST(trunc(discount * 100) AS BIGINT) || '%' AS discount_text, '40%' AS offer_discount_text, '예상 공모가: ' || headline AS comment
FROM s""")
def valuation_summary(t):
    multiples = val.peer_multiple(_final_peers(t).select("t", "per", "passed"))
    return val.valuation_summary(vw.valuation_inputs(t), multiples, target_year=2002, source=F.lit(" (자본금)"))


@query("statement_ratios", """
SELECT o_custkey AS company_id, year(o_orderdate) AS year,
       round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 4)
         AS current_ratio,
       round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P') / sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4)
         AS debt_ratio
FROM orders GROUP BY 1, 2""")
def statement_ratios(t):
    cells = t.orders.select(F.col("o_custkey").alias("company_id"), F.year("o_orderdate").alias("year"),
                            F.col("o_orderstatus").alias("account"), F.col("o_totalprice").alias("value"))
    accounts = {"current_assets": "F", "current_liabilities": "O", "total_liabilities": "P", "total_equity": "F"}
    ratios = val.statement_ratios(cells, ["company_id", "year"], accounts=accounts)
    return ratios.withColumns({c: F.round(c, 4) for c in ("current_ratio", "debt_ratio")})


@query("ratio_valuation", """
WITH fin AS (SELECT o_custkey, sum(o_totalprice) AS sales,
                    sum(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END) AS income
             FROM orders GROUP BY 1),
peers AS (SELECT c_nationkey AS t, abs(c_acctbal) * 1000 AS cap, income, sales FROM customer JOIN fin ON o_custkey = c_custkey),
mult AS (SELECT t, avg(cap / income) FILTER (WHERE income > 0) AS avg_per, avg(cap / sales) FILTER (WHERE sales > 0) AS avg_psr
         FROM peers GROUP BY 1)
SELECT n_nationkey AS t, round(avg_per, 6) AS avg_per, round(avg_psr, 6) AS avg_psr,
       round(s_acctbal * avg_per, 4) AS value_by_per,
       round(CASE WHEN n_regionkey > 0 THEN s_acctbal * 3 * avg_psr ELSE s_acctbal * 10 END, 4) AS value_by_sales
FROM nation JOIN (SELECT s_nationkey, max(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey
LEFT JOIN mult ON t = n_nationkey""")
def ratio_valuation(t):
    fin = t.orders.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("sales"),
        F.sum(F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))).alias(
            "income"))
    peers = t.customer.join(fin, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_nationkey").alias("t"), (F.abs("c_acctbal") * 1000).alias("cap"), "income", "sales")
    funding = t.supplier.groupBy("s_nationkey").agg(F.max("s_acctbal").alias("a"))
    targets = t.nation.join(funding, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_nationkey").alias("t"), F.col("a").alias("income"),
        F.when(F.col("n_regionkey") > 0, F.col("a") * 3).alias("sales"), F.col("a").alias("last_funding"))
    places = {"avg_per": 6, "avg_psr": 6, "value_by_per": 4, "value_by_sales": 4}
    rows = val.ratio_valuation(targets, peers)
    return rows.withColumns({c: F.round(c, p) for c, p in places.items()})


@query("round_discount", """
WITH r AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'Seed + Angel' WHEN 'view' THEN 'Pre-A'
             WHEN 'click' THEN 'Series A' WHEN 'purchase' THEN 'Pre-IPO' ELSE NULL END AS label FROM events)
SELECT event_id, label, CAST(CASE label WHEN 'Seed + Angel' THEN 0.8 WHEN 'Pre-A' THEN 0.6 WHEN 'Series A' THEN 0.5
  WHEN 'Pre-IPO' THEN 0.2 ELSE 0.5 END AS DOUBLE) AS discount FROM r""")
def discount(t):
    kind = F.col("event_type")
    label = (
        F.when(kind == "signup", F.lit("Seed + Angel")).when(kind == "view", F.lit("Pre-A"))
        .when(kind == "click", F.lit("Series A")).when(kind == "purchase", F.lit("Pre-IPO"))
    )
    return t.events.select("event_id", label.alias("label"), round_discount(label).alias("discount"))


FLAGSHIP = "peer_funnel"
