"""Column functions on hand-made values: the traps and the branches."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerglass.functions import dates as D
from peerglass.functions import numbers as N
from peerglass.functions import payload as P
from peerglass.functions import text as X
from peerglass.operators import reporting as rep

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(spark, fn, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("v").alias("r")).collect()]


CASES = [
    (X.text_key, [" 차체나 특장차,\n제조(업)·“A” ", None, "a b"], ["차체및특장차제조업A", "", "ab"]),
    (X.name_key, ["주식회사 ABC(주) ㈜Tech-1.co/K:9!", None], ["abctech-1.co/k:9", ""]),
    (X.name_clean, ["주식회사 가나(Gana)", " (주)다라 "], ["가나", "다라"]),
    (X.clean_text, ["a  \n b ", None], ["a b", ""]),
    (X.clean_cell, [None, " a\nb\n"], ["", "a b"]),
    (X.period_header, ["'2024.12 (E)\n"], ["2024.12E"]),
    (X.break_numbered_steps, ["10원2.다음 3배4.끝 5개6."], ["10원\n2.다음 3배\n4.끝 5개6."]),
    (X.bracket_title, ["해자", "[해자]", "", None], ["[해자]", "[해자]", "", ""]),
    (X.digits_only, ["123-45-67890", None], ["1234567890", ""]),
    (X.filename_date, ["IR_202510_v5", "x2025-13", "2031.7", "deck 1999.05", "20250.12"],
     ["2025.10", None, None, None, None]),
    (X.entity_from_filename, ["Acme IR Deck.pdf", "Acme_v2.pdf", "Acme plan.pdf", "Acme.pdf"], ["Acme"] * 4),
    (X.file_ext, ["a.tar.GZ", "noext", ".hidden"], [".gz", "", ""]),
    (X.flag_keywords, ["이 종목은 투자 경고", "거래정지 안내", "정상"], [False, True, False]),
    (X.strip_tags, ["<b>a</b><br>b &amp;&lt;c&nbsp;"], ["a b &<c"]),
    (N.pad_code, ["5930", "0123456", "064400"], ["005930", "0123456", "064400"]),
    (N.first_number, ["약 -1,234.5배", "없음", None, "+3"], [-1234.5, None, None, 3.0]),
    (N.sentinel_number, ["1,234", "-", "nan", "", None, "N/A", "abc", "-5"],
     [1234.0, -999999.0, -999999.0, -999999.0, -999999.0, -999999.0, -999999.0, -5.0]),
    (N.market_cap_eok, ["40조1,935", "1조 6,222억원", "6,222", "", None, "12조", "12조원"],
     [401935.0, 16222.0, 6222.0, 0.0, 0.0, 120000.0, 0.0]),
    (N.format_statement, ["1234567", "1234.50", "(1234)", "△1234.5", "▽7", "1,234", "-", "N/A", "", "abc", "-0.5", "1e3"],
     ["1,234,567", "1,234.5", "(1,234)", "-1,234.5", "-7", "1,234", "-", "N/A", "", "abc", "-0.5", "1,000"]),
    (lambda c: N.amount_range(c)["amount"], ["60~100억", "50억", "미공개", "500백만", "2조", "$3M", "10달러"],
     [80.0, 50.0, 5.0, 5.0, 20000.0, 39.0, 130.0]),
    (lambda c: N.amount_range(c)["label"], ["60~100억", "50.50억", "미공개", "300조", "1백만"],
     ["60~100억", "50.5억", "비공개", "3e+06억", "0.01억"]),
    (N.unit_token, ["3백만원", "2억", "1조", "5천", "7만", "3%", "$5", "5"],
     ["백만원", "억원", "조원", "천원", "만원", "%", "달러", None]),
    (N.round_discount, ["Seed + Angel", "Pre-A", "Series A", "Pre-B", "Series C", "Pre-IPO", "프리 A", "unknown", None],
     [0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.6, 0.5, 0.5]),
    (N.round_rank, ["angel", "Seed", "Pre-A", "Series A", "Pre-IPO", "IPO", "시리즈B", "Bridge"],
     [1, 2, 3, 4, 9, 10, 6, 99]),
    (lambda c: D.parse_listing_date(c).cast("string"),
     ["2024-01-31", "2024-3-5", "01-31-69", "01-31-68", "31-01-24", "", "2024-02-30", None],
     ["2024-01-31", "2024-03-05", "1969-01-31", "2068-01-31", None, None, None, None]),
    (lambda c: D.year_label(c, 2025), ["2024년", "2025", "2023(e)", "구분"], ["2024", "2025(E)", "2023(E)", "구분"]),
    (P.salvage_json, ['```json\n{"a": 1}\n```', 'x {"a": {"b": 2}} y', "{broken", None, "[1, 2]"],
     ['{"a": 1}', '{"a": {"b": 2}}', "{}", "{}", "[1, 2]"]),
    (P.is_valid_document, ['{"a": 1}', '{"error": 5}', "[1]", "{", None], [True, False, False, False, False]),
    (lambda c: rep.repaired_date(c, F.lit("Seed")), ["2024.01", "2000.00", "none", None, "24.01"],
     ["2024.01", "Seed", "Seed", "Seed", "Seed"]),
]


CASES += [
    (lambda c: D.statement_periods(F.split(c, ","), 2025)["n_periods"], ["구분,2023,2024", "구분", ""], [2, 5, 5]),
    (lambda c: F.array_join(D.statement_periods(F.split(c, ","), 2025)["labels"], ","), ["2020,2023.12,2025,2024e,합계"], ["2020,2023,2025(E),2024(E),합계"]),
    (X.text_key, ["차체나, 부품·\n(특수)", " a\u00a0b\u3000c\x1c\u2028", None, "[x]:{y}"], ["차체및부품특수", "abc", "", "xy"]),
]


@pytest.mark.parametrize("fn, given_values, expected", CASES)
def test_cases(spark, fn, given_values, expected):
    assert values(spark, fn, given_values) == expected


def test_doc_type_defaults(spark):
    names = ["ACME ir.PDF", "재무제표.xlsx", "소개.pdf"]
    assert values(spark, X.doc_type, names) == ["IR", "재무", "기타"]
    assert values(spark, lambda c: X.doc_type(c, in_root=F.lit(True)), names) == ["IR", "재무", "IR"]


def test_harmonise_unit(spark):
    got = values(spark, lambda c: N.harmonise_unit(c, F.lit("억원")), ["500백만원", "3억", "1,000", "", "1-2"])
    assert got == [5.0, 3.0, 1000.0, 0.0, None]
    assert values(spark, lambda c: N.harmonise_unit(c, F.lit("백만원")), ["3억"]) == [300.0]


def test_money_texts(spark):
    nums = [1.5e12, 2.0e12, 3.45e8, 25000.0, -5.0e6]
    assert values(spark, N.money_approx, nums, "double") == [
        "(약 1조 5,000억)", "(약 2조)", "(약 3억)", "(약 2만)", "(약 -500만)"]
    assert values(spark, N.won_text, [2.5, 3.5, 1234.4], "double") == ["2원", "4원", "1,234원"]
    assert values(spark, N.percent_text, [0.7, 0.29, 0.5], "double") == ["70%", f"{int(0.29 * 100)}%", "50%"]
    assert values(spark, N.market_cap_text, [25000.0, 20000.0, 999.9, 0.0, None], "double") == [
        "시총 2조 5,000억", "시총 2조", "시총 999억", "시총 N/A", "시총 N/A"]


def test_shares(spark):
    df = spark.createDataFrame([(10, 5000), (0, 1999), (None, 500), (0, None), (None, -5)], "s long, c long")
    assert [r[0] for r in df.select(N.shares_or_capital("s", "c")).collect()] == [10, 3, 1, 0, None]


def test_listed_years_cut_towards_zero(spark):
    df = spark.sql("select date'2020-01-01' d union all select date'2024-01-01' union all select null")
    rows = df.select(D.listed_days("d", "2023-01-01"), D.listed_years("d", "2023-01-01")).collect()
    assert [tuple(r) for r in rows] == [(1096, 3), (-365, -1), (None, None)]


def test_clean_series(spark):
    df = spark.createDataFrame([
        (1, [["Year", "Value"], ["2023년", "1,000억원"], ["2024", "N/A"], ["2025", "x"], ["2026"]]),
        (2, [["2023", "5"], ["2024", "-"]]), (3, [["2023", "5"]]), (4, []),
    ], "i int, v array<array<string>>")
    got = {r.i: [(x.year, x.value) for x in r.s] for r in df.select("i", rep.clean_series("v").alias("s")).collect()}
    assert got == {1: [("2023", 1000.0), ("2024", 0.0)], 2: [("2023", 5.0), ("2024", 0.0)], 3: [], 4: []}


def test_headers_named_by_position(spark):
    df = spark.createDataFrame([(["구분", None, " \n"],)], "v array<string>")
    assert df.select(X.clean_header("v")).first()[0] == ["구분", "Column_1", "Column_2"]


def test_kv_lookup(spark):
    df = spark.sql("""select from_json('{"x":[{"code":"per","value":"9"},{"code":"per","value":"8"}]}',
                      'x array<struct<code:string,value:string>>').x as v""")
    assert df.select(P.kv_lookup("v", "per"), P.kv_lookup("v", "pbr")).first()[:] == ("9", None)


@FEW
@given(st.lists(st.text("0123456789", min_size=1, max_size=9), min_size=1, max_size=20))
def test_pad_never_cuts(spark, codes):
    assert values(spark, N.pad_code, codes) == [c.zfill(6) for c in codes]


@FEW
@given(st.lists(st.floats(-1e15, 1e15), min_size=1, max_size=20))
def test_number_texts_are_total(spark, numbers):
    approx = values(spark, N.money_approx, numbers, "double")
    plain = values(spark, N.plain_number, numbers, "double")
    assert all(a.startswith("(약 ") for a in approx)
    assert all(math.isclose(float(p), n, rel_tol=1e-9, abs_tol=1e-9) for p, n in zip(plain, numbers))


@FEW
@given(st.lists(st.floats(0.01, 1e8), min_size=1, max_size=20))
def test_general_text_has_six_digits(spark, numbers):
    got = values(spark, lambda c: N.general_text(F.col(c)), numbers, "double")
    assert all(math.isclose(float(g), float(f"{n:g}"), rel_tol=2e-5) for g, n in zip(got, numbers))


def test_only_decimal_texts_are_numbers(spark):
    from peerglass.functions.numbers import sentinel_number, to_double

    texts = ["12", "-1.5", ".5", "1e3", "NaN", "12d", "1,200f", "0x1p3", "Infinity", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in rows.select(to_double("t")).collect()] == [12.0, -1.5, 0.5, 1000.0, *[None] * 7]
    missing = rows.select(sentinel_number("t")).collect()
    assert len({r[0] for r in missing[4:]}) == 1


def test_name_key_drops_the_same_by_class_and_by_ranges(spark):
    """On all characters but surrogates."""
    from peerglass import fixed_values as V
    codes = spark.range(0x110000).filter("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    plain, ranges = (F.regexp_replace("c", p.replace(r"\x{", r"\x{"), "") for p in (V.NAME_KEY_DROP_PLAIN, V.NAME_KEY_DROP))
    assert codes.filter(plain != ranges).count() == 0
    assert codes.filter(ranges != "").count() == 10 + 26 + (0xD7A3 - 0xAC00 + 1) + 4


def chart(spark, rows, title="수출 추이", fallback="백만원"):
    df = spark.createDataFrame([(rows, title)], "p array<array<string>>, t string")
    c = df.select(rep.chart_dataset("p", "t", 2024, fallback).alias("c")).first().c
    return c and (c.unit, [(p.label, p.value) for p in c.points])


def test_chart_dataset(spark):
    head = ["Year", "Value"]
    assert chart(spark, [head, ["2022년", "1,000백만원"], ["2023", "2억"], ["2024", "N/A"]]) == (
        "백만원", [("2022", 1000.0), ("2023", 200.0), ("2024(E)", 0.0)])
    assert chart(spark, [["2022", "5억"], ["2023", "1백만"], ["2021(e)", "3억"]]) == ("억원", [("2022", 5.0), ("2023", 0.01), ("2021(E)", 3.0)])
    assert chart(spark, [head, ["2022", "3건"], ["2023", "4"]], "계약 건수") == ("건", [("2022", 3.0), ("2023", 4.0)])
    assert chart(spark, [head, ["2022", "7"]], fallback="억원") == ("억원", [("2022", 7.0)])
    for nothing in ([], [head], [head, ["2022", "0"], ["2023", "-"]], [head, ["2022", "1.2.3"]], None):
        assert chart(spark, nothing) is None


def test_count_unit_by_title(spark):
    df = spark.createDataFrame([("a", "3억", 1, "계약 건수"), ("b", "3억", 2, "매출")], "g string, v string, n int, title string")
    assert {r.g: r.unit for r in rep.infer_unit(df, "g", "v", "n", title="title").collect()} == {"a": "건", "b": "억원"}
