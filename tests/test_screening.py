"""Screening and valuation on small hand-made pools."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerglass.operators import screening as S
from peerglass.operators import similarity as sim
from peerglass.operators import valuation as val

FEW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
METRICS = "t int, company_id int, is_warning boolean, market_cap double, per double, pbr double, ev_ebitda double"


def pool(spark, rows):
    return spark.createDataFrame(rows, METRICS)


def company(i, per, pbr=1.0, cap=100.0, ev=None, warning=False, t=1):
    return (t, i, warning, cap, per, pbr, ev)


def verdicts(df):
    return {r.company_id: (r.passed, r.reason) for r in df.collect()}


def test_reasons_of_general_requirements(spark):
    rows = [company(1, 15.0), company(2, None), company(3, -1.0), company(4, 9.0), company(5, 101.0),
            company(6, 15.0, cap=1000.0), company(7, 15.0, cap=0.0), company(8, 9.96, warning=True, cap=2500.9)]
    got = verdicts(S.general_requirements(pool(spark, rows)))
    assert got[1] == (True, "OK") and got[7] == (True, "OK")
    assert got[2] == got[3] == (False, "PER N/A (데이터 없음 또는 적자)")
    assert got[4] == (False, "PER 9.0 (10 미만)") and got[5] == (False, "PER 101.0 (100 초과)")
    assert got[6] == (False, "시가총액 1000억 (1천억 이상)")
    assert got[8] == (False, "관리/투자 위험 종목, 시가총액 2500억 (1천억 이상), PER 10.0 (10 미만)")
    assert verdicts(S.general_requirements(pool(spark, rows), strict=False))[4] == (True, "OK")


def test_small_group_is_not_trimmed(spark):
    rows = [company(i, 10.0 + i) for i in range(4)]
    assert all(p for p, _ in verdicts(S.stage4_requirements(pool(spark, rows))).values())


def test_full_trim_later_metric_names_the_reason(spark):
    rows = [company(i, 10.0 + i, pbr=2.0 + (i == 0) - (i == 7), cap=float(100 + i)) for i in range(8)]
    got = verdicts(S.stage4_requirements(pool(spark, rows)))
    assert got[7] == (False, "MAX MARKET_CAP (107.0)") and got[0] == (False, "MIN MARKET_CAP (100.0)")
    assert sum(p for p, _ in got.values()) == 6


def test_equal_values_count_as_max(spark):
    # All pbr and caps are equal: everybody would go, so only the PER extremes do.
    rows = [company(i, 10.0 + i) for i in range(6)]
    got = verdicts(S.stage4_requirements(pool(spark, rows)))
    assert got[0] == (False, "MAX/MIN PER (10.0)") and got[5] == (False, "MAX/MIN PER (15.0)")
    assert sum(p for p, _ in got.values()) == 4


def test_trim_is_cancelled_when_too_few_are_left(spark):
    rows = [company(i, 10.0 if i < 3 else 20.0) for i in range(5)]
    assert all(p for p, _ in verdicts(S.stage4_requirements(pool(spark, rows))).values())


def test_nulls_need_three_values(spark):
    rows = [company(i, 10.0 + i, pbr=None, cap=100.0 + i, ev=5.0 if i in (2, 3) else None) for i in range(7)]
    got = verdicts(S.stage4_requirements(pool(spark, rows)))
    assert got[2][0] and got[3][0]


def test_floor_falls_only_where_nobody_passes(spark):
    rows = [company(1, 5.0), company(2, 6.0), company(1, 5.0, t=2), company(2, 12.0, t=2)]
    got = {(r.t, r.company_id): (r.passed, r.relaxed) for r in S.stage4_requirements(pool(spark, rows)).collect()}
    assert got == {(1, 1): (True, True), (1, 2): (True, True), (2, 1): (False, False), (2, 2): (True, False)}


def reference_trim(rows):
    """Plain restatement of the requirement stage for one target."""
    def run(strict):
        ok = [r for r in rows if not r[2] and r[3] < 1000 and r[4] is not None and r[4] > 0
              and not (strict and r[4] < 10) and r[4] <= 100]
        if len(ok) <= 4:
            return {r[1] for r in ok}
        index = {"per": 4, "pbr": 5, "market_cap": 3, "ev_ebitda": 6}

        def extremes(names):
            drop = set()
            for name in names:
                have = [r for r in ok if r[index[name]] is not None]
                if len(have) > 2:
                    ends = {max(r[index[name]] for r in have), min(r[index[name]] for r in have)}
                    drop |= {r[1] for r in have if r[index[name]] in ends}
            return drop

        everybody = {r[1] for r in ok}
        for names in (list(index), ["per"]):
            left = everybody - extremes(names)
            if len(left) >= 3:
                return left
        return everybody

    return run(True) or run(False)


@FEW
@given(st.integers(0, 10**6))
def test_stage4_equals_plain_restatement(spark, seed):
    rng = random.Random(seed)
    rows = [
        (t, i, rng.random() < 0.1, float(rng.choice([0, 50, 500, 900, 1200])), rng.choice([None, 4.0, 8.0, 12.0, 20.0, 55.0]),
         rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 5.0, 6.0, 7.0]))
        for t in range(6) for i in range(rng.randrange(1, 16))
    ]
    got = {(r.t, r.company_id) for r in S.stage4_requirements(pool(spark, rows)).filter("passed").collect()}
    want = {(t, c) for t in range(6) for c in reference_trim([r for r in rows if r[0] == t])}
    assert got == want


CELLS = "company_id int, label string, row_no int, period string, col_no int, value string"


@pytest.mark.parametrize("cells, expected", [
    ([("당기순이익", 2, "2024.12", 1, "100"), ("당기순이익(지배)", 3, "2024.12", 1, "-5")], (-5.0, False, "적자 (-5.0)")),
    ([("당기순이익", 2, "2024.12(E)", 2, "7"), ("당기순이익", 2, "2024.12", 3, "1,234")], (1234.0, True, "흑자 (1234.0)")),
    ([("당기순이익", 2, "2024.12(E)", 2, "7")], (7.0, True, "흑자 (7.0)")),
    ([("당기 순이익", 2, "'24.12", 1, "9")], (None, False, "기간 컬럼 없음")),
    ([("매출액", 1, "2024.12", 1, "9")], (None, False, "당기순이익 행 없음")),
    # The chosen line has no cell in the chosen period.
    ([("매출액", 1, "2024.12", 1, "9"), ("당기순이익", 2, "2024.12(E)", 2, "9")], (-999999.0, False, "적자 (-999999.0)")),
    ([("당기순이익", 2, "2024.12", 1, "9"), ("당기순이익(지배)", 3, "2023.12", 0, "9")],
     (-999999.0, False, "적자 (-999999.0)")),
    ([("당기순이익", 2, "2024.12", 1, "-")], (-999999.0, False, "적자 (-999999.0)")),
    ([], (None, False, "재무 테이블 없음")),
])
def test_income_verdict(spark, cells, expected):
    companies = spark.createDataFrame([(1,)], "company_id int")
    row = S.income_verdict(companies, spark.createDataFrame([(1, *c) for c in cells], CELLS)).first()
    assert (row.net_income, row.profit_passed, row.income_reason) == expected


def test_first_of_a_code_per_target(spark):
    listed = spark.createDataFrame([(1, "5930", "12월", 1), (2, "005930", "12월", 2), (3, "5930", "3월", 0),
                                    (4, "", "12월", 4), (5, None, "12월", 5)],
                                   "company_id int, code string, month string, row_no int")
    rows = spark.createDataFrame([(t, c) for t in (1, 2) for c in range(1, 6) if (t, c) != (2, 1)],
                                 "t int, company_id int")
    got = S.stage2_financial(rows, listed, spark.createDataFrame([], CELLS)).filter("dec_passed").collect()
    assert {(r.t, r.company_id) for r in got} == {(1, 1), (2, 2)}


def test_similarity_contract(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10)], "t int, company_id int")
    targets = spark.createDataFrame([(1, [1.0, 0.0])], "t int, embedding array<float>")
    vectors = spark.createDataFrame([(10, [1.0, 0.0]), (11, [-1.0, 0.0])], "company_id int, embedding array<float>")
    rows = sim.similarity_scores(pairs, targets, vectors).collect()
    got = {(r.t, r.company_id): (r.score, r.similar, r.similarity_reason) for r in rows}
    assert got[(1, 10)] == (1.0, True, "scored") and got[(1, 11)] == (0.0, False, "scored")
    assert got[(1, 12)] == (0.0, False, "사업 정보 없음") and got[(2, 10)] == (None, True, "skipped")


def test_funnel_stages(spark):
    n = 8
    rows = spark.createDataFrame([(1, i) for i in range(n)], "t int, company_id int")
    companies = spark.createDataFrame(
        [(i, str(i), "12월" if i != 0 else "3월", i, False, 100.0, 10.0 + i, 1.0, None) for i in range(n)],
        "company_id int, code string, month string, row_no int, is_warning boolean, market_cap double, per double, "
        "pbr double, ev_ebitda double")
    cells = spark.createDataFrame(
        [(i, "당기순이익", 1, "2024.12", 1, "-3" if i == 1 else "3") for i in range(n)], CELLS)
    vectors = spark.createDataFrame([(i, [1.0, 0.0] if i != 2 else [0.0, 1.0]) for i in range(n)],
                                    "company_id int, embedding array<float>")
    target = spark.createDataFrame([(1, [1.0, 0.0])], "t int, embedding array<float>")
    funnel = S.peer_funnel(rows, companies, cells, target, vectors)
    got = {r.company_id: (r.stage_reached, r.peer_rank) for r in funnel.collect()}
    assert [got[i][0] for i in range(n)] == [1, 1, 2, 3, 4, 4, 4, 3]
    assert [got[i][1] for i in (4, 5, 6)] == [1, 2, 3]
    counts = S.funnel_counts(funnel).first().asDict()
    assert counts == {"t": 1, "stage1_pool": 8, "stage2_december": 7, "stage2_profit": 6, "stage3_similar": 5,
                      "stage4_passed": 3, "final_peers": 3}


INPUTS = "t int, target_net_income long, total_shares long, target_round string, capital long"


def test_scenarios(spark):
    inputs = spark.createDataFrame([
        (1, 10_000_000_000, 1_000_000, "Series B", None), (2, -1_500_000, None, None, 5_000_000),
        (3, 0, 10, "Seed", None), (4, 10, 10, "Seed", None), (5, 10_000_000_000, None, "Seed", None)], INPUTS)
    multiples = spark.createDataFrame([(1, 12.5), (2, 10.0), (3, 10.0), (5, 10.0)], "t int, avg_per double")
    rows = {(r.t, r.scenario_no): r for r in val.scenario_valuation(inputs, multiples).collect()}
    first = rows[(1, 0)]
    pv = int(10_000_000_000 / 1.4 // 1_000_000 * 1_000_000)
    assert (first.pv, first.discount) == (pv, 0.4)
    assert first.final_price == int(pv * 12.5 / 1_000_000 * 0.6 // 100 * 100)
    assert rows[(2, 0)].pv == -1_000_000 and rows[(2, 0)].shares == 10_000
    assert rows[(3, 0)].not_computable == "추정 당기순이익 정보 부재" and rows[(3, 0)].pv is None
    assert rows[(4, 0)].not_computable == "유효한 Peer PER 데이터 부재"
    assert rows[(5, 0)].price_text == "-"
    told = {r.t: r for r in val.valuation_summary(inputs, multiples, target_year=2025).collect()}
    assert len(told) == 5 and told[1].headline_price == first.final_price_text and told[1].comment == f"예상 공모가: {first.final_price_text}"
    assert told[1].rationale.splitlines()[0] == "1단계 (Peer 평균 PER): 12.50배 적용" and "[Series B]" in told[1].rationale
    assert "현가 할인율 40% 적용" in told[1].rationale and "기준 주식수 1,000,000주 (명시된" in told[1].rationale
    assert "[미상 (기본값 적용)]" in told[2].rationale and "10,000주 (문서 내 정보 부재" in told[2].rationale
    assert told[2].net_income_text == "-1,500,000원" and told[2].discount_text == "50%"
    assert (told[3].headline_price, told[3].rationale) == ("-", "※ 산출 불가 사유:\n- 2025년 추정 당기순이익 정보 부재\n")
    assert told[4].rationale == "※ 산출 불가 사유:\n- 유효한 Peer PER 데이터 부재\n" and told[4].multiple_text == "산출 불가"
    assert told[5].headline_price == "산출 불가 (주식수 부재)" and told[5].rationale.endswith("주당 단가 산출 생략")


def test_scenario_rows_say_the_headline_price(spark):
    inputs = spark.createDataFrame([
        (1, 10_000_000_000, 1_000_000, "Series B", None), (2, 0, 10, "Seed", None), (3, 10_000_000_000, None, "Seed", None)], INPUTS)
    multiples = spark.createDataFrame([(1, 12.5), (2, 10.0), (3, 10.0)], "t int, avg_per double")
    rows = {(r.t, r.scenario_no): r for r in val.scenario_valuation(inputs, multiples).collect()}
    assert [rows[(1, no)].headline_price for no in range(3)] == [rows[(1, 0)].final_price_text, None, None]
    assert [rows[(2, no)].headline_price for no in range(3)] == ["-"] * 3
    assert [rows[(3, no)].headline_price for no in range(3)] == ["산출 불가 (주식수 부재)"] * 3


def test_statement_ratios_of_the_sample_statement(spark):
    cells = spark.createDataFrame([(2024, "유동자산", 1800.0), (2024, "유동부채", 1100.0), (2024, "부채총계", 1800.0),
                                   (2024, "자본총계", 2700.0), (2024, "매출액", 6200.0)],
                                  "year int, account string, value double")
    row = val.statement_ratios(cells, ["year"]).first()
    assert (row.current_ratio, row.debt_ratio) == (1800 / 1100, 1800 / 2700)


def test_details_keep_thirty(spark):
    rows = [company(i, 5.0 if i < 25 else 10.0 + i) for i in range(40)]
    details = S.peer_details(S.stage4_requirements(pool(spark, rows))).first().requirements
    assert len(details) == 30 and not details[0].passed


def test_peer_cap_and_ties(spark):
    rows = [company(i, 20.0) for i in range(30)]
    judged = S.general_requirements(pool(spark, rows)).withColumn("score", F.lit(0.5))
    assert [r.company_id for r in S.cap_peers(judged).orderBy("rank").collect()] == list(range(10))
