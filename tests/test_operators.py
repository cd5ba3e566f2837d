"""Matching, documents, records and reports on small hand-made tables."""

import json
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerglass.operators import distributed as dist
from peerglass.operators import documents as docs
from peerglass.operators import evidence as ev
from peerglass.operators import matching as M
from peerglass.operators import records as R
from peerglass.operators import refdata as ref
from peerglass.operators import reporting as rep
from peerglass.operators import screening as S

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
words = st.text("abc가", min_size=0, max_size=6)


def column(spark, name, items, kind="string"):
    return spark.createDataFrame([(i,) for i in items], f"{name} {kind}")


@FEW
@given(st.lists(words, max_size=25), st.lists(words, max_size=25))
def test_contains_pairs_equals_all_pairs(spark, needles, texts):
    got = {tuple(r) for r in dist.contains_pairs(column(spark, "n", needles), column(spark, "x", texts), "n", "x").collect()}
    assert got == {(n, x) for n in needles if n for x in texts if x and n in x}


@FEW
@given(st.lists(words, max_size=20), st.lists(words, max_size=20), st.booleans())
def test_code_match_equals_all_pairs(spark, codes, held, retry):
    def hits(code):
        return {h for h in held if h and (h == code or (len(code) >= 3 and code in h))}

    want = set()
    for code in filter(None, codes):
        found = hits(code)
        if retry and not found and len(code) > 3:
            found = hits(code[:-1])
        want |= {(code, h) for h in found}
    got = M.code_pairs(column(spark, "c", codes), column(spark, "h", held), "c", "h", retry)
    assert {(r.c, r.h) for r in got.collect()} == want


def test_lookup_prefers_equal_names_and_takes_brackets_literally(spark):
    companies = spark.createDataFrame([("가나다", "5930", 3), ("가나", "1", 5), ("ABC(주)", "77", 1), ("xABC(주)", "78", 0),
                                       ("가나", "2", 4)], "company string, code string, row_no int")
    got = {r.name: (r.code, r.match) for r in M.lookup_code(column(
        spark, "name", ["가나", "나다", "abc(주)", "none", " 가나다 "]), companies).collect()}
    assert got == {"가나": ("000002", "exact"), "나다": ("005930", "contains"), "abc(주)": ("000078", "contains"),
                   "none": (None, "none"), "가나다": ("005930", "exact")}


def test_small_pools_are_widened(spark):
    pool = spark.createDataFrame([(1, f"a{i}") for i in range(10)] + [(2, f"a{i}") for i in range(11)], "t int, name string")
    wide = spark.createDataFrame([(1, "a0"), (1, "w"), (2, "w"), (3, "w")], "t int, name string")
    got = {(r.t, r.name) for r in M.expand_pool(pool, wide).collect()}
    assert (1, "w") in got and (2, "w") not in got and (3, "w") in got and len(got) == 10 + 1 + 11 + 1


def test_empty_keyword_matches_nothing(spark):
    kw = spark.createDataFrame([(1, " "), (1, "ring")], "t int, keyword string")
    ind = spark.createDataFrame([("ring maker", "C1"), ("ring", "C1"), ("bolt", "C2"), ("x ring", "")], "name string, code string")
    assert [tuple(r) for r in M.keyword_industry_codes(kw, ind).collect()] == [(1, "C1")]


def test_industry_codes(spark):
    rows = spark.createDataFrame([("f", i, c) for i, c in enumerate(["01", "a", "011", "0111", "B ", "123456", "x1", "7"])],
                                 "file string, row_no int, raw string")
    got = [r.class_code for r in ref.industry_class_code(rows, "file", "row_no", "raw").orderBy("row_no").collect()]
    assert got == [None, None, "A00011", "A00111", None, "B123456", None, "B00007"]
    assert ref.require_code(ref.industry_class_code(rows, "file", "row_no", "raw")).count() == 4


@settings(FEW, max_examples=4)
@given(st.integers(0, 10**6), st.integers(1, 9))
def test_forward_fill_over_ranges(spark, seed, parts):
    rng = random.Random(seed)
    places = [rng.randrange(10**12) for _ in range(25)] if seed % 2 else list(range(25))  # sparse or dense
    rows = [(k, i, rng.choice([None, None, None, "a", "b"])) for k in ("hot", "cold", None, "x") for i in sorted(set(places))]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, pos bigint, v string")
    got = {(r.k, r.pos): r.f for r in dist.forward_fill(df, ["k"], "pos", "v", "f", parts=parts).collect()}
    last = {}
    for k, pos, v in rows:
        last[k] = v or last.get(k)
        assert got[(k, pos)] == last[k]


@settings(FEW, max_examples=4)
@given(st.integers(0, 10**6), st.integers(1, 9))
def test_ranks_over_ranges(spark, seed, parts):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([0, 1, 2, None]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, b int, i int")
    got = {r.i: r.x for r in dist.rank_in_ranges(df, ["k"], ["b", "i"], "x", parts=parts).collect()}
    for key in ("a", "b", None):
        mine = sorted((b is not None, b or 0, i) for k, b, i in rows if k == key)
        assert [got[row[-1]] for row in mine] == list(range(len(mine)))


def test_ranges_are_the_same_whatever_is_read_of_them(spark):
    """Later filters and narrow selections do not reach below the exchange that the branches share."""
    i = F.col("id")
    df = spark.range(0, 60_000, 1, 6).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 40).cast("string"))).alias("k"),
        F.xxhash64("id").alias("pos"), F.when(i % 500 == 0, i).alias("v"), F.sha2(i.cast("string"), 256).alias("wide"))
    pdf = df.toPandas().sort_values(["k", "pos"])
    pdf["f"] = pdf.groupby("k").v.ffill()
    pdf["x"] = pdf.groupby("k").cumcount()
    filled = dist.forward_fill(df, ["k"], "pos", "v", "f", parts=16)
    ranked = dist.rank_in_ranges(df, ["k"], ["pos"], "x", parts=16)
    hot = pdf[pdf.k == "hot"]
    assert filled.filter("k = 'hot'").agg(F.count("f"), F.sum("f")).first() == (hot.f.count(), int(hot.f.sum()))
    assert filled.select("f").agg(F.count("f"), F.sum("f")).first() == (pdf.f.count(), int(pdf.f.sum()))
    want = dict(zip(hot.pos, hot.x))
    assert {r.pos: r.x for r in ranked.filter("k = 'hot' and pos > 0").select("pos", "x").collect()} == {
        p: x for p, x in want.items() if p > 0}
    rows = ranked.groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("top"), F.countDistinct("x").alias("d")).collect()
    assert all(r.n == r.top + 1 == r.d for r in rows)


def test_ranges_follow_rows_and_are_made_once(spark):
    """A hot key with half of all rows and sparse positions lies in many even ranges; the plan deals the rows once."""
    i = F.col("id")
    df = spark.range(0, 80_000, 1, 8).select(F.when(i % 2 == 0, 0).otherwise(i).alias("k"), (i * i * i).alias("pos"),
                                             F.when(i % 100 == 0, i).alias("v"))
    sizes = [r["count"] for r in dist.in_ranges(df, ["k"], ["pos"], 16).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
    out = dist.forward_fill(df, ["k"], "pos", "v", "f", parts=16)
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    made = [line for line in final.splitlines() if "Exchange rangepartitioning" in line and "ReusedExchange" not in line]
    assert len(made) == 1 and "ReusedExchange" in final
    assert "SinglePartition" not in final


def test_text_parts_are_whole(spark):
    df = spark.createDataFrame([("d", i, f"<{i}>") for i in range(10)], "k string, pos int, s string")
    parts = dist.text_parts(df, ["k"], "pos", "s", "out", per_part=3).orderBy("part_no").collect()
    assert "".join(p.out for p in parts) == "".join(f"<{i}>" for i in range(10))
    assert max(p.n_items for p in parts) == 3


def test_attach_code_keeps_duplicates(spark):
    companies = spark.createDataFrame([("a", "차체나, 부품"), ("b", "없음")], "name string, industry string")
    codes = spark.createDataFrame([("차체 및 부품", "C1"), ("차체및부품", "C2")], "industry_name string, class_code string")
    rows = ref.attach_industry_code(companies, codes, "industry", "industry_name")
    assert sorted((r.name, r.class_code or "") for r in rows.collect()) == [("a", "C1"), ("a", "C2"), ("b", "")]
    assert [r.name for r in ref.unmatched(rows, ["name", "industry"]).collect()] == ["b"]


def test_file_inventory(spark):
    paths = ["Acme/IR deck.PDF", "Acme/재무.xlsx", "Acme/x.txt", "metadata/a.csv", "Acme/deep/a.pdf", "Beta IR 2024.pdf",
             "Gamma_intro.docx", "Delta notes.pdf", "Acme/notes.pdf"]
    got = {r.path: (r.company, r.doc_type) for r in docs.file_inventory(column(spark, "path", paths)).collect()}
    assert got == {"Acme/IR deck.PDF": ("Acme", "IR"), "Acme/재무.xlsx": ("Acme", "재무"), "Acme/notes.pdf": ("Acme", "기타"),
                   "Beta IR 2024.pdf": ("Beta", "IR"), "Gamma_intro.docx": ("Gamma", "기타"), "Delta notes.pdf": ("Delta", "IR")}


def test_evidence_validation_reasons(spark):
    people = spark.createDataFrame([(i, "김") for i in range(1, 8)], "t int, person string")
    sig = spark.createDataFrame([(i, "" if i == 1 else "가나", "gana.com", "1-2") for i in range(1, 8)],
                                "t int, company_name string, company_domain string, biz_reg_no string")
    claims = spark.createDataFrame([(1, 1, "김"), (3, 1, "박"), (4, 1, "김"), (5, 1, "김"), (6, 1, "김"), (7, 1, " 김 "), (7, 2, "김")],
                                   "t int, claim_no int, name string")
    evidence = spark.createDataFrame([
        (5, 1, "공시", "기타 회사", "", ""), (6, 1, "언론", "가나 대표", "", ""), (7, 1, "공시", "(주)가나", "", ""),
        (7, 2, "공시", "㈜ 가 나", "gana.com", ""), (3, 1, "공시", "가나", "", "")],
        "t int, claim_no int, source_type string, snippet string, source_name string, url string")
    got = {r.t: (r.reason, r.warning, r.claim_no) for r in ev.validate_claims(people, claims, evidence, sig).collect()}
    assert [got[i][0] for i in range(1, 8)] == [
        "회사명 미확인", "CEO 주장 근거 없음", "동명이인/타인 정보 가능성", "근거가 없음", "회사 동일성 검증 실패", "공식/준공식 근거 부재", ""]
    assert got[7][1:] == ("근거 1개로 제한됨", 2)


def test_merge_takes_the_later_section(spark):
    def section(rows):
        return spark.createDataFrame(rows, "t int, record map<string,string>")

    merged = R.merge_sections([section([(1, {"a": "1", "b": "1"}), (2, {"a": "2"})]), section([(1, {"b": "9"}), (3, None)])])
    assert {r.t: r.record for r in merged.collect()} == {1: {"a": "1", "b": "9"}, 2: {"a": "2"}, 3: None}


def test_matrix_cells_of_short_and_missing_rows(spark):
    kind = "company_id int, matrix struct<Columns: array<string>, Rows: array<array<string>>>"
    rows = [(1, (["item", "2023", "2024"], [["a", "1", "2"], ["b", "3"]])), (2, (["item"], [["a"]])), (3, None), (4, (["x", "y"], []))]
    got = [tuple(r) for r in R.matrix_cells(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(got, key=str) == [(1, 0, "a", 1, "2023", "1"), (1, 0, "a", 2, "2024", "2"), (1, 1, "b", 1, "2023", "3"),
                                    (1, 1, "b", 2, "2024", None)]


def test_a_segment_called_null_is_kept(spark):
    long = spark.createDataFrame([("k", "null", 1.0), ("k", "a`b", 2.0), ("m", None, None)], "c string, segment string, ratio double")
    wide = R.mix_wide(long, ["c"], ["null", "a`b"])
    assert wide.columns == ["c", "a`b", "null"]
    assert {tuple(r) for r in wide.collect()} == {("k", 2.0, 1.0), ("m", None, None)}
    numbers = R.segment_numbers(long)
    assert {r.segment: r.segment_no for r in numbers.collect()} == {"a`b": 0, "null": 1}
    assert {r.c: r.mix for r in R.mix_numbered(long, ["c"], numbers).collect()} == {"k": {0: 2.0, 1: 1.0}, "m": {}}


def test_table_without_a_header_is_kept(spark):
    rows = spark.createDataFrame([(1, 1, 1, ["x", "y"]), (1, 2, 1, ["z"])], "page_no int, table_no int, row_no int, cells array<string>")
    heads = spark.createDataFrame([(1, 1, ["a", None])], "page_no int, table_no int, cells array<string>")
    got = {r.table_no: r.table_text for r in docs.table_text(rows, heads).collect()}
    assert got == {1: "a | Column_1\n--- | ---\nx | y", 2: "z"}


def test_trim_is_named_by_its_kind(spark):
    rows = spark.createDataFrame([(1, True, "full"), (1, False, None), (2, True, "per"), (2, True, "per"), (3, False, None)],
                                 "t int, is_outlier boolean, trim_kind string")
    got = {r.t: (r.n_outliers, r.note) for r in S.outlier_note(rows).collect()}
    assert got == {1: (1, "full trim"), 2: (2, "per only"), 3: (0, "no trim")}


def test_schema_rules_of_a_section(spark):
    good = '{"Investment_Risks": [{"Risk_Title": "a", "Risk_Detail": "b", "Mitigation_and_Outlook": "c"}]}'
    spec = [f for f in R.VALUATION_FIELDS if f.path.startswith("Investment_Risks")]
    df = column(spark, "j", [good, '{"Investment_Risks": [{"Risk_Title": "a", "Risk_Detail": null}]}', "{", "{}"])
    checked = R.schema_violations(df, "j", spec)
    got = {r.j: r.violations for r in checked.collect()}
    assert got[good] == [] and got["{"] == ["unreadable"] and got["{}"] == ["missing:Investment_Risks"]
    assert len([v for v in got.values() if "null:Investment_Risks[].Risk_Detail" in v]) == 1
    clean, bad = R.split_quarantine(checked)
    assert (clean.count(), bad.count()) == (1, 3)


def test_every_section_schema_reads(spark):
    df = column(spark, "j", ["{}"])
    for spec in (R.FINANCE_FIELDS, R.MARKET_FIELDS, R.TECH_FIELDS, R.PERSONNEL_FIELDS, R.VALUATION_FIELDS):
        found = R.schema_violations(df, "j", spec).first().violations
        assert found and all(v.startswith("missing:") for v in found)


def test_mark_and_preview(spark):
    rows = spark.createDataFrame([("g", f"n{i:02d}", i) for i in range(22)] + [("h", "only", 1)], "g string, n string, o int")
    got = {r.g: r.preview for r in rep.list_preview(rows, "g", "n", "o").collect()}
    assert got["h"] == "1개사 (only)"
    assert got["g"] == "22개사 (" + ", ".join(f"n{i:02d}" for i in range(20)) + ", ...)"


def test_unit_ties_go_to_the_first_seen(spark):
    rows = spark.createDataFrame([("a", "3억", 1), ("a", "5백만", 0), ("b", "3", 2)], "g string, v string, n int")
    assert {r.g: r.unit for r in rep.infer_unit(rows, "g", "v", "n", "억원").collect()} == {"a": "백만원", "b": "억원"}


def test_timeline_places_across_ranges(spark):
    rows = spark.createDataFrame([(1, i, "2024.01", "Seed", "5억") for i in range(20)] + [(1, 20, "", "IPO", "")],
                                 "t int, seq int, date string, round string, amount string")
    got = rep.funding_timeline(rows, parts=5).orderBy("x").collect()
    assert [r.seq for r in got] == list(range(21)) and [r.x for r in got] == list(range(21))
    assert got[-1].date == "IPO" and got[-1].axis_label == "IPO" and got[-1].amount_label == "비공개"


@pytest.mark.parametrize("html, status, reason", [("x" * 1000, 200, None), ("x" * 999, 200, "too short: 999"),
                                                  (None, 200, "too short: 0"), ("x" * 2000, 503, "HTTP 503")])
def test_page_guard(spark, html, status, reason):
    df = spark.createDataFrame([(html, status)], "html string, status int")
    assert docs.guard_pages(df, status="status").first().reject_reason == reason


def test_pending_is_what_has_no_output(spark):
    left = docs.pending(column(spark, "k", [1, 2, 3], "int"), column(spark, "k", [2], "int"), ["k"])
    assert sorted(r.k for r in left.collect()) == [1, 3]


def test_split_categories(spark):
    got = R.split_categories(spark.createDataFrame([(1, "M&A/IPO"), (2, "ipo")], "i int, category string"))
    assert sorted((r.i, r.category) for r in got.collect()) == [(1, "IPO"), (1, "M&A"), (2, "ipo")]


def test_dedupe_takes_the_first_row(spark):
    rows = spark.createDataFrame([(1, "7", 2, "b"), (1, "000007", 1, "a"), (2, "7", 3, "c")], "t int, code string, row_no int, n string")
    assert {(r.t, r.n) for r in M.dedupe_by_code(rows).collect()} == {(1, "a"), (2, "c")}


def test_patch_of_nested_documents(spark):
    base = [
        (1, '{"Financial_Status": {"Investment_History": ["a"], "Unit": "x"}, "Growth_Potential": {"Target_Market_Trends": [], '
            '"Export_and_Contract_Stats": {"Sales_Graph_Data": [["Year", "v"]], "Export_Graph_Data": [["2020년", "1,000억"], ["2021", "N/A"], ["x", "y"]]}}, '
            '"Key_Personnel": {"CEO_Reference": {"Name": "old", "Age": 5}}, "Valuation_and_Judgment": {"Valuation_Logic_Detail": {"a": 1}}, "Other": 1}'),
        (2, '{"Other": 2}'), (3, '{"Financial_Status": null}')]
    patch = [
        (1, '{"Financial_Status": {"Investment_History": ["b", "c"], "Unit": "y"}, "Growth_Potential": {"Target_Market_Trends": ["t"], '
            '"Export_and_Contract_Stats": {"Sales_Graph_Data": [["2022", "3"], ["2023", "4.5"]], "Export_Graph_Data": [["2030", "1"], ["2031", "2"]]}}, '
            '"Key_Personnel": {"CEO_Reference": {"Name": "new"}}, "Valuation_and_Judgment": {"Valuation_Logic_Detail": {"b": 2}}, "Other": 9}'),
        (2, '{"Financial_Status": {"Investment_History": ["only"]}, "Key_Personnel": {"Team_Capability": {"n": 1}}}')]
    made = [spark.createDataFrame(rows, "t int, j string").select("t", F.parse_json("j").alias("doc")) for rows in (base, patch)]
    done = {r.t: json.loads(r.j) for r in R.patch_documents(*made).select("t", F.to_json("doc").alias("j")).collect()}
    one, stats = done[1], done[1]["Growth_Potential"]["Export_and_Contract_Stats"]
    assert one["Financial_Status"] == {"Investment_History": ["b", "c"], "Unit": "x"} and one["Other"] == 1
    assert one["Growth_Potential"]["Target_Market_Trends"] == ["t"]
    assert stats == {"Sales_Graph_Data": [["Year", "Revenue"], ["2022", 3], ["2023", 4.5]],
                     "Export_Graph_Data": [["Year", "Export_Value"], ["2020", 1000], ["2021", 0]], "Contract_Count_Graph_Data": [["Year", "Count"]]}
    assert one["Key_Personnel"]["CEO_Reference"] == {"Name": "new", "Age": 5}
    assert one["Valuation_and_Judgment"]["Valuation_Logic_Detail"] == {"b": 2}
    assert done[2]["Other"] == 2 and done[2]["Financial_Status"] == {"Investment_History": ["only"]}
    assert done[2]["Key_Personnel"] == {"Team_Capability": {"n": 1}}
    assert "Financial_Status" not in done[3] or not done[3]["Financial_Status"]



def test_patch_documents_reads_no_value_twice(spark):
    docs = spark.createDataFrame([(1, '{"a": {"x": 1, "y": 2}}')], "t int, j string").select("t", F.parse_json("j").alias("doc"))
    plan = lambda policies: R.patch_documents(docs, docs, policies)._jdf.queryExecution().optimizedPlan().toString()
    reads = lambda made, kind: made.count(kind)
    assert reads(plan({"a": R.OVERLAY}), "MapType(StringType,VariantType,true), false") == 5  # both documents, the patch's size, both sides
    assert reads(plan({"a": R.SERIES}), "ArrayType(ArrayType(StringType,true),true), false") == 1
    assert "ArrayType(VariantType,true)" not in plan({"a": R.REPLACE})


def test_patch_documents_keeps_odd_values(spark):
    fields = {"longer": R.LONGER, "empty": R.IF_EMPTY, "series": R.SERIES, "over": R.OVERLAY, "put": R.REPLACE}
    cases = [  # base, patch, what it becomes; a series is always given with its header
        ({"longer": "text", "empty": {"a": 1}, "put": None}, {"longer": ["p"], "empty": [1], "put": 2},
         {"longer": ["p"], "empty": [1], "put": 2}),
        ({"longer": ["b"], "empty": [0], "over": {"a": None, "b": 1}}, {"longer": "text", "empty": [1], "over": {"a": 2, "c": None}},
         {"longer": ["b"], "empty": [0], "over": {"a": 2, "b": 1, "c": None}}),
        ({"over": [1], "series": ["x", "y"]}, {"over": {}, "series": [["2020", "1"]]}, {"over": [1]}),
        ({"over": [1], "rest": None}, {"over": {"a": 1}, "rest": 1}, {"over": {"a": 1}, "rest": None}),
        ({"longer": [], "put": [1]}, None, {"longer": [], "put": [1]}),
    ]
    rows = [(i, json.dumps({"in": b}), None if p is None else json.dumps({"in": p})) for i, (b, p, _) in enumerate(cases)]
    made = spark.createDataFrame(rows, "t int, b string, p string")
    base, patch = made.select("t", F.parse_json("b").alias("doc")), made.select("t", F.parse_json("p").alias("doc"))
    done = {r.t: json.loads(r.j)["in"] for r in R.patch_documents(base, patch, {"in": fields}).select("t", F.to_json("doc").alias("j")).collect()}
    for i, (_, _, want) in enumerate(cases):
        assert done[i].pop("series") == [["Year", "series"]]
        assert done[i] == want
