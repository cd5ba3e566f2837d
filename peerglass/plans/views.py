"""The given tables read as the tables of the screening work.

Customers stand for listed companies, nations for the target companies they
are screened for, orders for their statements and multiples, parts for the
industry list, embeddings for business descriptions.  Each Spark view has an
SQL twin of the same columns for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass.operators.distributed import dealt
from peerglass.plans.registry import Tables

INCOME_PERIOD = "2000.12"
# The given vectors are random: half of the usual scores would be 0.
VECTOR_THRESHOLD = 0.05


def companies(t: Tables) -> DataFrame:
    """Listed companies with code, settlement month, class code and metrics."""
    price = F.col("o_totalprice")
    facts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.month("o_orderdate")).alias("m"),
        # Whole cents, so that the mean does not depend on the order of the sum.
        (F.floor(F.sum(F.round(price * 100).cast("bigint")) * 10 / F.count(price)) / 1e7).alias("per"),
        F.round(F.max(price) / F.avg(price), 6).alias("pbr"),
        F.round(F.stddev_samp(price) / 1e4, 6).alias("ev_ebitda"),
    )
    return t.customer.join(facts, "c_custkey", "left").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"),
        F.abs(F.col("c_acctbal").cast("bigint")).cast("string").alias("code"),
        F.concat(F.col("m").cast("string"), F.lit("월")).alias("month"),
        F.concat(F.lit("Brand#"), (F.col("c_nationkey") + 1).cast("string")).alias("company_code"),
        F.col("c_custkey").alias("row_no"), F.col("c_nationkey").alias("t"),
        (F.col("c_acctbal") < -800).alias("is_warning"),
        F.round(F.abs("c_acctbal") / 5, 2).alias("market_cap"),
        "per", "pbr", "ev_ebitda",
    )


def listed(t: Tables) -> DataFrame:
    return companies(t).select("company_id", "name", "code", "month", "company_code", "row_no")


def company_metrics(t: Tables) -> DataFrame:
    """Metrics with the target each company is screened for."""
    return companies(t).select("company_id", "t", "is_warning", "market_cap", "per", "pbr", "ev_ebitda")


def cells(t: Tables) -> DataFrame:
    """Statement cells: account label, period and amount text of every company."""
    status, late = F.col("o_orderstatus"), F.month("o_orderdate") >= 10
    year = F.when(F.year("o_orderdate") >= 1999, 2000).otherwise(1998)
    sign = F.when(F.col("o_orderpriority") <= "3-MEDIUM", 1).otherwise(-1)
    keyed = t.orders.select(
        F.col("o_custkey").alias("company_id"),
        F.when(status == "F", "당기순이익(지배)").when(status == "O", "당기순이익").otherwise("매출액").alias("label"),
        F.when(status == "F", 3).when(status == "O", 2).otherwise(1).alias("row_no"),
        F.concat(year.cast("string"), F.lit(".12"), F.when(late, F.lit("(E)")).otherwise(F.lit(""))).alias("period"),
        (year * 10 + F.when(late, 1).otherwise(0)).alias("col_no"),
        (F.col("o_totalprice") * sign).alias("amount"),
    )
    thousands = (F.sum("amount") / 1000).cast("bigint")
    return keyed.groupBy("company_id", "label", "row_no", "period", "col_no").agg(
        F.when(thousands == 0, F.lit("-")).otherwise(F.format_number(thousands, 0)).alias("value")
    )


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("company_id"), "embedding")


def target_vectors(t: Tables) -> DataFrame:
    targets = t.nation.select(F.col("n_nationkey").cast("bigint").alias("vec_id"), F.col("n_nationkey").alias("t"))
    return t.embeddings.join(targets, "vec_id").select("t", "embedding")


def target_codes(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("t"),
        F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 1).cast("string")).alias("code"),
    )


def valuation_inputs(t: Tables) -> DataFrame:
    """One row per nation: income, shares, funding round and capital."""
    of = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    sign = F.when(F.col("o_orderstatus") == "P", -1).otherwise(1)
    income = (
        t.orders.join(of, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)") * sign).alias("income"))
    )
    capital = of.groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("capital"))
    rounds = F.array(*[F.lit(r) for r in ("Seed", "Pre-A", "Series A", "Pre-B", "Pre-IPO")])
    return (
        t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
        .join(income, "c_nationkey", "left").join(capital, "c_nationkey", "left")
        .select(
            F.col("c_nationkey").alias("t"),
            F.floor("income").cast("bigint").alias("target_net_income"),
            F.when(F.col("c_nationkey") < 10, F.floor("capital").cast("bigint")).alias("total_shares"),
            F.try_element_at(rounds, F.col("n_regionkey") + 1).alias("target_round"),
            F.when(F.col("c_nationkey") < 20, (F.floor("capital") * 5000).cast("bigint")).alias("capital"),
        )
    )


def inventory_listing(t: Tables) -> DataFrame:
    """Paths of a company data folder, one per document."""
    no = F.col("doc_id").cast("string")
    name = (
        F.when(F.col("lang") == "en", F.concat(F.lit("IR_Deck "), no, F.lit(".PDF")))
        .when(F.col("lang") == "fr", F.concat(F.lit("재무제표_"), no, F.lit(".xlsx")))
        .when(F.col("lang") == "de", F.concat(F.lit("홍보 브로셔 "), no, F.lit(".pptx")))
        .otherwise(F.concat(F.lit("memo."), no, F.lit(".txt")))
    )
    folder = F.when(F.col("source") == "src3", F.lit("metadata")).otherwise(F.col("source"))
    path = (
        F.when(F.col("n_chars") < 500, F.concat(F.col("source"), F.lit(" IR 2024."), no, F.lit(".pdf")))
        .when(F.col("n_chars") < 800, F.concat(F.col("source"), F.lit("_intro "), no, F.lit(".docx")))
        .when(F.col("n_chars") < 1000, F.concat(F.col("source"), F.lit(" notes "), no, F.lit(".pdf")))
        .otherwise(F.concat(folder, F.lit("/"), name))
    )
    return t.documents.select(path.alias("path"), F.col("n_chars").alias("length"), "doc_id")


def signatures(t: Tables) -> DataFrame:
    """Company identities: a name, a domain and a registration number."""
    word = F.regexp_extract("text", r"^(\w+)", 1)
    domains = F.array(F.lit("example.com"), F.lit("example.net"), F.lit("www.example.org"))
    return t.benchmark.select(
        F.col("item_id").alias("t"),
        F.when(F.length(word) > 2, word).otherwise(F.lit("")).alias("company_name"),
        F.element_at(domains, F.length("text") % 3 + 1).alias("company_domain"),
        F.concat(F.lit("1-"), F.col("item_id").cast("string")).alias("biz_reg_no"),
    )


def evidence(t: Tables) -> DataFrame:
    """Evidence rows: documents as snippets, the page of the same number as source."""
    kind = (
        F.when(F.col("lang") == "en", F.lit("언론")).when(F.col("lang") == "fr", F.lit("공시"))
        .when(F.col("lang") == "de", F.lit("홈페이지")).otherwise(F.lit("기타"))
    )
    urls = t.pages.select(F.col("page_id").alias("doc_id"), "url")
    return t.documents.join(urls, "doc_id", "left").select(
        F.regexp_extract("source", r"(\d+)", 1).cast("bigint").alias("t"),
        (F.length("source") * 10 + F.ascii("lang") % 5).cast("bigint").alias("claim_no"),
        "doc_id", kind.alias("source_type"), F.col("source").alias("source_name"),
        F.col("text").alias("snippet"), "url",
    )


def json_sections(t: Tables) -> DataFrame:
    """Section documents as JSON text, some of them broken in different ways."""
    k = F.get_json_object("props", "$.k").cast("int")
    title = (
        F.when(k < 10, F.lit("null")).when(k < 20, F.lit("7"))
        .otherwise(F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
    )
    items = F.array_join(F.array_repeat(F.lit('{"Highlight_Title": "a", "Highlight_Logic": "b"}'), k % 5), ", ")
    unit = F.when(k % 2 == 0, F.lit('"Unit": null, ')).otherwise(F.lit(""))
    body = F.concat(
        F.lit("{"), F.when(k < 90, F.concat(F.lit('"Title": '), title, F.lit(", "))).otherwise(F.lit("")),
        unit, F.lit('"Investment_Highlights": ['), items, F.lit("]"),
        F.when(k == 50, F.lit("")).otherwise(F.lit("}")),
    )
    return t.events.select("event_id", body.alias("section"))


def section_document(spec, number: Column) -> Column:
    """JSON text of a section in which at most one rule is broken: rule and damage follow from the number.

    The texts are as many as rules and damages, so they are made with the plan and picked in the row.
    """
    picked, damage = F.pmod(number, F.lit(len(spec))), F.pmod(F.floor(number / len(spec)), F.lit(4))

    def tree(paths):
        heads: dict[str, list] = {}
        for path, place, field in paths:
            head, _, rest = path.partition(".")
            heads.setdefault(head.removesuffix("[]"), []).append((("[]." if head.endswith("[]") else "") + rest, place, field))
        return heads

    def text(hit: int | None, harm: int) -> str:
        """Text with one rule broken; without a number no rule holds, and nothing stands where one would."""
        def members(paths) -> str:
            """'"name": value' texts of an object, joined."""
            found = [member(name, below) for name, below in tree(paths).items()]
            return ", ".join(m for m in found if m is not None)

        def member(name: str, below) -> str | None:
            own = next(((place, field) for rest, place, field in below if rest == ""), None)
            items = [(rest.removeprefix("[]."), place, field) for rest, place, field in below if rest.startswith("[].")]
            inner = [b for b in below if b[0] and not b[0].startswith("[].")]
            if inner:
                return f'"{name}": {{{members(inner)}}}'
            if hit is None:
                return None
            listed = own[1].kind == "ARRAY"
            value = f"[{', '.join([f'{{{members(items)}}}'] * 3)}]" if items else '["a", "b", "c"]' if listed else '"text"'
            broken = hit == own[0]
            if broken and harm == 1:
                return None
            return f'"{name}": ' + ({2: "null", 3: '"x"' if listed else "5"}.get(harm, value) if broken else value)

        return f"{{{members([(f.path, place, f) for place, f in enumerate(spec)])}}}"

    texts = [text(hit, harm) for harm in range(4) for hit in range(len(spec))] + [text(None, 0)]
    at = F.coalesce(damage * len(spec) + picked, F.lit(len(texts) - 1)).cast("int")
    return F.element_at(F.array(*[F.lit(t) for t in texts]), at + 1)


def funding_rounds(t: Tables) -> DataFrame:
    """Funding rounds of every user: date text, label and amount text."""
    k = F.get_json_object("props", "$.k").cast("int")
    whole = F.floor("value").cast("string")
    year = (F.lit(2015) + k % 9).cast("string")
    date = (
        F.when(k < 8, F.lit("")).when(k < 16, F.lit("2000.00")).when(k < 20, F.lit("N/A"))
        .otherwise(F.concat(year, F.lit("."), F.lpad((k % 12 + 1).cast("string"), 2, "0")))
    )
    label = (
        F.when(F.col("event_type") == "signup", F.lit("Seed")).when(F.col("event_type") == "view", F.lit("Pre-A"))
        .when(F.col("event_type") == "click", F.lit("Series A")).when(F.col("event_type") == "purchase",
                                                                      F.lit("Pre-IPO"))
        .otherwise(F.lit("비공개"))
    )
    amount = (
        F.when(k < 20, F.lit("미공개")).when(k < 40, F.concat(whole, F.lit("~"), F.lit("900억")))
        .when(k < 60, F.concat(F.lit("$"), whole, F.lit("M"))).when(k < 80, F.concat(whole, F.lit("백만원")))
        .otherwise(F.concat(whole, F.lit("조")))
    )
    return t.events.select(
        F.col("user_id").alias("t"), F.col("event_id").alias("seq"), date.alias("date"), label.alias("round"),
        amount.alias("amount"),
    )


def product_pages(t: Tables) -> DataFrame:
    """Pages whose link list is a product table between two other tables, with a head row and cells that do not count."""
    row = '<tr><th>&nbsp;<span class="cut">$1</span> etc</th><td>0</td><td class="num c2">$2</td><td>1</td></tr>'
    html = F.regexp_replace("html", r"""(?is)<li><a href="/([^"]*)">(.*?)</a></li>""", row)
    other = "<table class='t'><tbody><tr><th>other</th><td>3</td></tr></tbody></table>"
    html = F.replace(html, F.lit("<ul>"), F.lit(
        other + '<TABLE class="t" id="cTB203"><thead><tr><th>name</th><td>ratio</td></tr></thead><tbody><tr><th> </th><td>5</td></tr>'))
    return t.pages.select("page_id", F.replace(html, F.lit("</ul>"), F.lit(
        f"</tbody><tfoot><tr><th>sum</th><td>100</td></tr></tfoot></TABLE>{other}")).alias("html"))


def listing_pages(t: Tables) -> DataFrame:
    """A listing page and a page of fundamentals of every customer; values stand now here, now there, or are missing."""
    n = F.col("c_custkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    cents = F.lpad((n % 100).cast("string"), 2, "0")
    cap = n * 37 % 90000
    cap_text = F.when(cap >= 10000, text(F.floor(cap / 10000).cast("string"), "조", F.format_number(cap % 10000, 0))).otherwise(
        F.format_number(cap, 0))
    per, pbr = text((n % 97).cast("string"), ".", cents), text((n % 7).cast("string"), ".", cents)
    ev = text((n % 31).cast("string"), ".", (n % 10).cast("string"))

    def caption(value) -> Column:
        return text("<table><caption>투자 정보</caption><tbody><tr><th>시가총액</th><td>1</td></tr></tbody></table>"
                    "<table><caption> 시가총액 정보</caption><tbody><tr><th>상장주식수</th><td>7</td></tr><tr><th><b>시가총액</b>(억)</th><td>",
                    value, "</td><td>9</td></tr></tbody></table>")

    in_first = (
        F.when(n % 5 == 0, text('<em id="_market_sum">\n\t', cap_text, "\n</em>억원"))
        .when(n % 5 == 1, caption(text("<em>", cap_text, "</em>억원"))).when(n % 5 == 2, caption(text(cap_text, "억원")))
        .when(n % 5 == 3, F.lit('<em id="_market_sum">N/A</em>')).otherwise(F.lit("<em id='_market'>5</em>"))
    )
    later = F.when(n % 5 == 4, text("<em id='_market_sum'>", cap_text, "</em>")).when(n % 5 % 3 == 0, F.lit('<em id="_market_sum">3</em>')) \
        .otherwise(F.lit(""))
    in_table = (
        F.when(n % 4 == 0, text('<tr><th>PER</th><td><em id="_per">', per, "</em>배</td></tr><tr><th>PBR</th><td><em id=\"_pbr\">", pbr,
                                "</em>배</td></tr>"))
        .when(n % 4 == 1, text("<tr><th>추정PER(배)</th><td> ", per, " 배</td><td>8</td></tr><tr><th>PBR</th><td>N/A</td></tr>"))
        .when(n % 4 == 2, text('<tr><th>PER</th><td>', per, '</td></tr><tr><td><em id="_per">N/A</em></td></tr>'
                               '<tr><th>PBR</th><td>-</td></tr>'))
        .otherwise(F.lit("<tr><th>배당</th><td>2</td></tr>"))
    )
    warned = F.when(n % 11 == 0, F.lit("<div><p>관리종목</p></div>")).otherwise(F.lit("<div>일반</div>"))
    filler = F.when(n % 13 == 0, F.lit("")).otherwise(F.repeat(F.lit("<div>x 거래정지</div>"), 70))
    after = F.when(n % 4 == 3, text("<em id=_pbr>", pbr, "</em>")).otherwise(F.lit(""))
    html = text('<div class="wrap_company"><h2>', F.col("c_name"), "</h2>", warned, '</div><div class="aside first"><div>a</div>', in_first,
                "</div>", later, '<table class="per_table">', in_table, "</table>", after, filler)
    fund = text('<table class="gHead03"><tbody><tr><th>EV/EBITDA</th><td>77</td></tr></tbody></table><div class="fl_le fund"><div></div>'
                '<table class="x gHead03"><tbody><tr><th>매출</th><td>5</td></tr>',
                F.when(n % 3 == 0, text("<tr><th>ev / ebitda</th><td>1</td></tr><tr><th>Ev/Ebitda<br></th><td> ", ev, "</td><td>6</td></tr>"))
                .when(n % 3 == 1, F.lit("<tr><th>EV/EBITDA</th><td>N/A</td></tr>")).otherwise(F.lit("")), "</tbody></table></div>")
    rows = dealt(t.customer.select("c_custkey", "c_name"))
    return rows.select(n.alias("company_id"), html.alias("html"), fund.alias("fundamentals"))


# --- SQL twins --------------------------------------------------------------

LISTING_PAGES_SQL = """
SELECT n AS company_id, good AND n % 11 = 0 AS is_warning, CASE WHEN good AND n % 5 <> 3 THEN n * 37 % 90000 ELSE 0 END::DOUBLE AS market_cap,
       CASE WHEN good AND n % 4 <> 3 THEN CAST((n % 97) || '.' || lpad((n % 100)::VARCHAR, 2, '0') AS DOUBLE) END AS per,
       CASE WHEN good AND n % 4 IN (0, 3) THEN CAST((n % 7) || '.' || lpad((n % 100)::VARCHAR, 2, '0') AS DOUBLE) END AS pbr,
       CASE WHEN good AND n % 3 = 0 THEN CAST((n % 31) || '.' || (n % 10) AS DOUBLE) END AS ev_ebitda
FROM (SELECT c_custkey AS n, c_custkey % 13 <> 0 AS good FROM customer)"""

LISTED_SQL = """listed AS (
  SELECT c_custkey AS company_id, c_name AS name, CAST(CAST(abs(trunc(c_acctbal)) AS BIGINT) AS VARCHAR) AS code,
         CAST(m AS VARCHAR) || '월' AS month, 'Brand#' || (c_nationkey + 1) AS company_code, c_custkey AS row_no
  FROM customer LEFT JOIN (SELECT o_custkey, max(month(o_orderdate)) AS m FROM orders GROUP BY 1) o
    ON o_custkey = c_custkey)"""

METRICS_SQL = """metrics AS (
  SELECT c_custkey AS company_id, c_nationkey AS t, c_acctbal < -800 AS is_warning,
         round(abs(c_acctbal) / 5, 2) AS market_cap, per, pbr, ev_ebitda
  FROM customer LEFT JOIN (
    SELECT o_custkey, (sum(CAST(round(o_totalprice * 100) AS BIGINT)) * 10 // count(*))::DOUBLE / 1e7::DOUBLE AS per, round(max(o_totalprice) / avg(o_totalprice), 6) AS pbr,
           round(stddev_samp(o_totalprice) / 1e4, 6) AS ev_ebitda
    FROM orders GROUP BY 1) o ON o_custkey = c_custkey)"""

CELLS_SQL = """cells AS (
  SELECT company_id, label, row_no, period, col_no,
         CASE WHEN trunc(sum(amount) / 1000) = 0 THEN '-'
              ELSE format('{:,}', CAST(trunc(sum(amount) / 1000) AS BIGINT)) END AS value
  FROM (SELECT o_custkey AS company_id,
               CASE o_orderstatus WHEN 'F' THEN '당기순이익(지배)' WHEN 'O' THEN '당기순이익' ELSE '매출액' END AS label,
               CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END AS row_no,
               CASE WHEN year(o_orderdate) >= 1999 THEN '2000' ELSE '1998' END || '.12'
                 || CASE WHEN month(o_orderdate) >= 10 THEN '(E)' ELSE '' END AS period,
               CASE WHEN year(o_orderdate) >= 1999 THEN 20000 ELSE 19980 END
                 + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS col_no,
               o_totalprice * CASE WHEN o_orderpriority <= '3-MEDIUM' THEN 1 ELSE -1 END AS amount
        FROM orders) GROUP BY ALL)"""

INCOME_SQL = f"""{CELLS_SQL}, picked AS (
  SELECT company_id,
         arg_min(col_no, (CASE WHEN contains(period, 'E') THEN 1 ELSE 0 END) * 100000 + col_no)
           FILTER (WHERE contains(period, '{INCOME_PERIOD}')) AS col_no,
         arg_min(row_no, CASE WHEN contains(label, '당기순이익(지배)') THEN 0 ELSE 10 END + row_no)
           FILTER (WHERE contains(label, '당기순이익(지배)') OR label = '당기순이익') AS row_no
  FROM cells GROUP BY 1), income AS (
  SELECT c_custkey AS company_id, p.company_id AS has_table, p.col_no, p.row_no,
         coalesce(TRY_CAST(replace(nullif(value, '-'), ',', '') AS DOUBLE), -999999.0) AS amount
  FROM customer LEFT JOIN picked p ON p.company_id = c_custkey
  LEFT JOIN cells c ON c.company_id = p.company_id AND c.col_no = p.col_no AND c.row_no = p.row_no), verdicts AS (
  SELECT company_id,
         CASE WHEN col_no IS NOT NULL AND row_no IS NOT NULL THEN amount END AS net_income,
         coalesce(col_no IS NOT NULL AND row_no IS NOT NULL AND amount > 0, false) AS profit_passed,
         CASE WHEN has_table IS NULL THEN '재무 테이블 없음' WHEN col_no IS NULL THEN '기간 컬럼 없음'
              WHEN row_no IS NULL THEN '당기순이익 행 없음'
              WHEN amount > 0 THEN '흑자 (' || CAST(amount AS VARCHAR) || ')'
              ELSE '적자 (' || CAST(amount AS VARCHAR) || ')' END AS income_reason
  FROM income)"""


def reasons_sql(strict: bool) -> str:
    floor = "WHEN per < 10 THEN printf('PER %.1f (10 미만)', per)" if strict else ""
    return f"""array_to_string(list_filter([
      CASE WHEN is_warning THEN '관리/투자 위험 종목' END,
      CASE WHEN market_cap >= 1000 THEN '시가총액 ' || CAST(trunc(market_cap) AS BIGINT) || '억 (1천억 이상)' END,
      CASE WHEN per IS NULL OR per <= 0 THEN 'PER N/A (데이터 없음 또는 적자)' {floor}
           WHEN per > 100 THEN printf('PER %.1f (100 초과)', per) END], lambda x: x IS NOT NULL), ', ')"""


def stage4_sql(rows: str, eligible: str = "true") -> str:
    """Window form of the requirement stage over a relation with metrics."""
    metric = ["per", "pbr", "market_cap", "ev_ebitda"]
    stats = ", ".join(
        f"max(CASE WHEN ok THEN {m} END) OVER w AS mx_{m}, min(CASE WHEN ok THEN {m} END) OVER w AS mn_{m}, "
        f"count(CASE WHEN ok THEN {m} END) OVER w AS n_{m}" for m in metric
    )
    note = "coalesce(" + ", ".join(
        f"CASE WHEN big AND n_{m} > 2 AND {m} = mx_{m} THEN 'MAX {m.upper()} (' || CAST({m} AS VARCHAR) || ')' "
        f"WHEN big AND n_{m} > 2 AND {m} = mn_{m} THEN 'MIN {m.upper()} (' || CAST({m} AS VARCHAR) || ')' END"
        for m in reversed(metric)
    ) + ")"
    per_note = ("CASE WHEN big AND n_per > 2 AND (per = mx_per OR per = mn_per) "
                "THEN 'MAX/MIN PER (' || CAST(per AS VARCHAR) || ')' END")
    return f"""s4a AS (
  SELECT *, {eligible} AS eligible, {reasons_sql(True)} AS strict_r, {reasons_sql(False)} AS loose_r FROM {rows}), s4b AS (
  SELECT *, count(*) FILTER (WHERE eligible AND strict_r = '') OVER (PARTITION BY t) = 0 AS relaxed FROM s4a), s4c AS (
  SELECT *, CASE WHEN relaxed THEN loose_r ELSE strict_r END AS base_r,
         eligible AND CASE WHEN relaxed THEN loose_r ELSE strict_r END = '' AS ok FROM s4b), s4d AS (
  SELECT *, count(*) FILTER (WHERE ok) OVER w AS n_ok, ok AND count(*) FILTER (WHERE ok) OVER w > 4 AS big, {stats}
  FROM s4c WINDOW w AS (PARTITION BY t)), s4e AS (
  SELECT *, {note} AS full_note, {per_note} AS per_note FROM s4d), s4f AS (
  SELECT *, CASE WHEN n_ok - count(full_note) OVER (PARTITION BY t) >= 3 THEN full_note
                 WHEN n_ok - count(per_note) OVER (PARTITION BY t) >= 3 THEN per_note END AS note FROM s4e), s4 AS (
  SELECT *, ok AND note IS NULL AS passed, note IS NOT NULL AS is_outlier,
         CASE WHEN eligible THEN coalesce(note, CASE WHEN base_r = '' THEN 'OK' ELSE base_r END) END AS reason
  FROM s4f)"""
