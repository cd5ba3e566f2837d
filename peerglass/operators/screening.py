"""Financial filter, general requirements, outlier trim and the peer funnel.

Group facts (extremes, counts, chosen rule set) come from partial aggregates of
one row per target that are joined back, never from a window over a whole
target, so a target with a third of all candidates is not one task's work.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.numbers import fixed, pad_code, plain_number, sentinel_number
from peerglass.functions.text import as_col, strip
from peerglass.operators.distributed import join_split, split_hot_keys, top_k_per_key
from peerglass.operators.similarity import similarity_scores
from peerglass.session import cut_lineage

METRIC_COLUMNS = ("is_warning", "market_cap", "per", "pbr", "ev_ebitda")


# --- stage 2: settlement month and income ----------------------------------

def december(month: Column | str, code: Column | str) -> Column:
    c = F.coalesce(strip(month), F.lit(""))
    return F.contains(c, F.lit(V.SETTLEMENT_MONTH)) & (F.coalesce(strip(code), F.lit("")) != "")


def december_filter(rows: DataFrame, month: str = "month", code: str = "code") -> DataFrame:
    """Companies that settle in December and carry a code."""
    return rows.filter(december(month, code))


def profit_filter(rows: DataFrame, amount: str) -> DataFrame:
    """Rows with a positive amount; unreadable amounts fail."""
    return rows.filter(sentinel_number(amount) > 0)


def income_verdict(companies: DataFrame, cells: DataFrame, *, company: str = "company_id", label: str = "label",
                   row_no: str = "row_no", period: str = "period", col_no: str = "col_no", value: str = "value",
                   income_period: str = V.INCOME_PERIOD) -> DataFrame:
    """Net income of each company from its statement cells, with verdict and reason.

    Period: the first column of the wanted period that is no estimate, else the
    first that is.  Account: the controlling-interest line, else the plain one.
    """
    head = F.translate(as_col(period), " '()\n", "")
    name = F.replace(as_col(label), F.lit(" "), F.lit(""))
    wanted = F.contains(head, F.lit(income_period))
    period_rank = F.when(wanted, F.contains(head, F.lit(V.ESTIMATE_MARK)).cast("int"))
    account_rank = F.when(F.contains(name, F.lit(V.INCOME_ACCOUNT_CONTROLLING)), 0).when(
        strip(name) == V.INCOME_ACCOUNT, 1
    )
    marked = cells.select(
        company, F.col(row_no).alias("_row"), F.col(col_no).alias("_col"), F.col(value).alias("_raw"),
        period_rank.alias("_p"), account_rank.alias("_a"),
    )
    in_period, in_account = F.col("_p").isNotNull(), F.col("_a").isNotNull()
    # The first income cell by period, then account, is the wanted one unless
    # the chosen period or account has no such cell: one aggregate finds all.
    chosen = marked.groupBy(company).agg(
        F.min(F.when(in_period, F.struct("_p", "_col")))["_col"].alias("_col"),
        F.min(F.when(in_account, F.struct("_a", "_row")))["_row"].alias("_row"),
        F.min(F.when(in_period & in_account, F.struct("_p", "_col", "_a", "_row", "_raw"))).alias("_cell"),
        F.lit(True).alias("_has_table"),
    )
    judged = companies.join(chosen, company, "left")
    at_cell = (F.col("_cell._col") == F.col("_col")) & (F.col("_cell._row") == F.col("_row"))
    income = sentinel_number(F.when(at_cell, F.col("_cell._raw")))
    complete = F.col("_col").isNotNull() & F.col("_row").isNotNull()
    reason = (
        F.when(F.col("_has_table").isNull(), F.lit(V.FAIL_NO_TABLE))
        .when(F.col("_col").isNull(), F.lit(V.FAIL_NO_PERIOD))
        .when(F.col("_row").isNull(), F.lit(V.FAIL_NO_INCOME_ROW))
        .when(income > 0, F.concat(F.lit(V.PROFIT_TEXT), plain_number(income), F.lit(")")))
        .otherwise(F.concat(F.lit(V.LOSS_TEXT), plain_number(income), F.lit(")")))
    )
    return judged.select(
        *companies.columns,
        F.when(complete, income).alias("net_income"),
        F.coalesce(complete & (income > 0), F.lit(False)).alias("profit_passed"),
        reason.alias("income_reason"),
    )


def mark_december_firsts(rows: DataFrame, settles: str, *, target: str = "t", code: str = "code",
                         row_no: str = "row_no") -> DataFrame:
    """``dec_passed``: settles in December and is the first of its code in the target.

    Repeated codes are found by an aggregate; the rows themselves only meet the
    short list of repeats, those of a hot (target, code) in several tasks.
    """
    codes = (
        rows.groupBy(target, code)
        .agg(F.min(F.when(F.col(settles), F.col(row_no))).alias("_first"), F.count_if(settles).alias("_n"),
             F.count(F.lit(1)).alias("_rows"))
    )
    first = F.col("_first").isNull() | (F.col(row_no) == F.col("_first"))
    repeats = codes.filter("_n > 1").select(target, code, "_first")
    joined = join_split(rows, repeats, [target, code], "left", by=[target, row_no], sizes=codes)
    return joined.withColumn("dec_passed", F.col(settles) & first).drop(settles, "_first")


def stage2_financial(pool: DataFrame, listed: DataFrame, cells: DataFrame, *, target: str = "t",
                     company: str = "company_id", income_period: str = V.INCOME_PERIOD) -> DataFrame:
    """Pool rows with ``dec_passed`` and ``profit_passed``."""
    verdicts = income_verdict(listed, cells, company=company, income_period=income_period)
    joined = pool.join(verdicts, company, "left").withColumn("_settles", december("month", "code"))
    marked = mark_december_firsts(joined.withColumn("code", pad_code(strip("code"))), "_settles", target=target)
    return marked.withColumn(
        "profit_passed", F.col("dec_passed") & F.coalesce("profit_passed", F.lit(False))
    )


# --- stage 4: general requirements and trim --------------------------------

def requirement_reasons(strict: bool, cap_ceiling: float = V.MARKET_CAP_CEILING, per_floor: float = V.PER_FLOOR,
                        per_ceiling: float = V.PER_CEILING) -> Column:
    """Array of the requirements a company fails."""
    cap = F.coalesce(F.col("market_cap"), F.lit(0.0))
    per = F.col("per")
    per_text = F.concat(F.lit("PER "), fixed(per, 1))
    per_rule = F.when(per.isNull() | (per <= 0), F.lit(V.REASON_PER_MISSING))
    if strict:
        per_rule = per_rule.when(per < per_floor, F.concat(per_text, F.lit(f" ({per_floor} 미만)")))
    per_rule = per_rule.when(per > per_ceiling, F.concat(per_text, F.lit(f" ({per_ceiling} 초과)")))
    cap_text = F.concat(F.lit("시가총액 "), cap.cast("bigint").cast("string"), F.lit("억 (1천억 이상)"))
    return F.array_compact(F.array(
        F.when(F.coalesce("is_warning", F.lit(False)), F.lit(V.REASON_WARNING)),
        F.when(cap >= cap_ceiling, cap_text),
        per_rule,
    ))


def _reason_text(reasons: Column | str) -> Column:
    return F.when(F.size(reasons) == 0, F.lit(V.REASON_OK)).otherwise(F.array_join(reasons, ", "))


def general_requirements(rows: DataFrame, strict: bool = True) -> DataFrame:
    """``passed`` and ``reason`` of the general requirements."""
    return (
        rows.withColumn("_reasons", requirement_reasons(strict))
        .withColumn("passed", F.size("_reasons") == 0)
        .withColumn("reason", _reason_text("_reasons"))
        .drop("_reasons")
    )


def _value(metric: str) -> Column:
    return F.coalesce(F.col(metric), F.lit(0.0)) if metric == "market_cap" else F.col(metric)


def _group_facts(passed: Column, metrics: Sequence[str]) -> list[Column]:
    facts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(passed).alias("n_passed")]
    for m in metrics:
        kept = F.when(passed, _value(m))
        facts += [F.max(kept).alias(f"max_{m}"), F.min(kept).alias(f"min_{m}"), F.count(kept).alias(f"n_{m}")]
    return facts


def _trim(at: DataFrame, expand: Callable[[DataFrame], DataFrame], columns: Sequence[str], target: str,
          metrics: Sequence[str], min_group: int, min_left: int) -> DataFrame:
    """Mark outliers among passed rows, the facts of their target at hand."""
    grouped = F.col("passed") & (F.col("n_passed") >= min_group)
    enough = {m: F.col(f"n_{m}") >= V.TRIM_MIN_VALUES for m in metrics}
    at_max = {m: grouped & enough[m] & (_value(m) == F.col(f"max_{m}")) for m in metrics}
    at_min = {m: grouped & enough[m] & (_value(m) == F.col(f"min_{m}")) for m in metrics}
    # The last metric that hits names the reason; MAX comes before MIN.
    notes = []
    for m in reversed(list(metrics)):
        shown = F.concat(F.lit(f" {m.upper()} ("), plain_number(_value(m)), F.lit(")"))
        notes.append(F.when(at_max[m], F.concat(F.lit("MAX"), shown)).when(at_min[m], F.concat(F.lit("MIN"), shown)))
    per_note = F.when(
        at_max["per"] | at_min["per"], F.concat(F.lit("MAX/MIN PER ("), plain_number("per"), F.lit(")"))
    )
    noted = at.withColumn("_full", F.coalesce(*notes)).withColumn("_per", per_note)
    drops = noted.groupBy(target).agg(
        F.count("_full").alias("_n_full"), F.count("_per").alias("_n_per")
    )
    left_full = F.col("n_passed") - F.col("_n_full") >= min_left
    left_per = F.col("n_passed") - F.col("_n_per") >= min_left
    note = F.when(left_full, F.col("_full")).when(left_per, F.col("_per"))
    kind = F.when(left_full, F.lit("full")).otherwise(F.lit("per"))
    return (
        noted.join(expand(drops), [target, "_salt"], "left")
        .withColumn("is_outlier", F.col("passed") & note.isNotNull())
        .withColumn("trim_kind", F.when(F.col("is_outlier"), kind))
        .withColumn("reason", F.when(F.col("is_outlier"), note).otherwise(F.col("reason")))
        .withColumn("passed", F.col("passed") & ~F.col("is_outlier"))
        .select(*columns, "is_outlier", "trim_kind")
    )


def trim_extremes(rows: DataFrame, *, target: str = "t", metrics: Sequence[str] = tuple(V.TRIM_METRICS),
                  min_group: int = V.TRIM_MIN_GROUP, min_left: int = V.TRIM_MIN_LEFT) -> DataFrame:
    """Drop the holders of each metric's extremes from large enough groups.

    Needs ``passed`` and ``reason``.  Where fewer than ``min_left`` would be
    left only the PER extremes go, and where that is still too few nobody does.
    """
    facts = rows.groupBy(target).agg(*_group_facts(F.col("passed"), metrics))
    salted, expand = split_hot_keys(rows, facts, target, "n_rows")
    at = salted.join(expand(facts), [target, "_salt"], "left")
    return _trim(at, expand, rows.columns, target, metrics, min_group, min_left)


def screen_with_fallback(rows: DataFrame, *, target: str = "t") -> DataFrame:
    """Strict requirements; the PER floor falls for targets nobody passes.

    Adds ``passed``, ``reason`` and ``relaxed``.
    """
    both = _with_both_verdicts(rows)
    chosen = both.groupBy(target).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count_if(F.size("_strict") == 0) == 0).alias("relaxed")
    )
    salted, expand = split_hot_keys(both, chosen, target, "n_rows")
    return _choose(salted.join(expand(chosen), [target, "_salt"], "left"), rows.columns, [])


def _with_both_verdicts(rows: DataFrame, eligible: Column | None = None) -> DataFrame:
    strict, relaxed = requirement_reasons(True), requirement_reasons(False)
    if eligible is not None:
        strict, relaxed = F.when(eligible, strict), F.when(eligible, relaxed)
    return rows.withColumn("_strict", strict).withColumn("_relaxed", relaxed)


def _choose(rows: DataFrame, columns: Sequence[str], extra: Sequence[str]) -> DataFrame:
    reasons = F.when(F.col("relaxed"), F.col("_relaxed")).otherwise(F.col("_strict"))
    return rows.select(
        *columns, *extra, "relaxed",
        (F.coalesce(F.size(reasons) == 0, F.lit(False))).alias("passed"),
        F.when(reasons.isNotNull(), _reason_text(reasons)).alias("reason"),
    )


def stage4_requirements(rows: DataFrame, *, target: str = "t", eligible: Column | None = None) -> DataFrame:
    """General requirements with fallback, then the outlier trim.

    ``eligible`` limits the stage to the survivors before it; other rows keep a
    null reason.  The facts of both rule sets come from one aggregate, and the
    strict set is kept unless nobody passes it: the trim never empties a group,
    so that is when the strict run ends with no survivor.
    """
    both = _with_both_verdicts(rows, eligible)
    ok = {name: F.coalesce(F.size(f"_{name}") == 0, F.lit(False)) for name in ("strict", "relaxed")}
    metrics = V.TRIM_METRICS
    sides = both.groupBy(target).agg(
        F.struct(*_group_facts(ok["strict"], metrics)).alias("strict"),
        F.struct(*_group_facts(ok["relaxed"], metrics)).alias("loose"),
    )
    relaxed = F.col("strict.n_passed") == 0
    facts = sides.select(
        target, relaxed.alias("relaxed"), F.when(relaxed, F.col("loose")).otherwise(F.col("strict")).alias("_facts")
    ).select(target, "relaxed", "_facts.*")
    salted, expand = split_hot_keys(both, facts, target, "n_rows")
    at = salted.join(expand(facts), [target, "_salt"], "left")
    chosen = _choose(at, rows.columns, ["_salt", *[c for c in facts.columns if c not in (target, "relaxed")]])
    kept = [*rows.columns, "relaxed", "passed", "reason"]
    return _trim(chosen, expand, kept, target, metrics, V.TRIM_MIN_GROUP, V.TRIM_MIN_LEFT)


def cap_peers(rows: DataFrame, k: int = V.PEER_CAP, *, target: str = "t", company: str = "company_id") -> DataFrame:
    """Final peers: the best k passed rows per target, ties by company."""
    return top_k_per_key(rows.filter("passed"), [target], [F.desc_nulls_last("score"), F.asc(company)], k)


def peer_details(rows: DataFrame, k: int = V.REQUIREMENT_ROWS, *, target: str = "t",
                 company: str = "company_id") -> DataFrame:
    """The first k requirement verdicts of each target as a list of structs.

    Failed rows come first, then the trimmed, then the passed ones.
    """
    place = F.when(F.col("passed"), 2).when(F.col("is_outlier"), 1).otherwise(0)
    kept = top_k_per_key(rows.withColumn("_place", place), [target], [F.asc("_place"), F.asc(company)], k, "no")
    info = F.struct(*[c for c in METRIC_COLUMNS if c in rows.columns])
    item = F.struct("no", F.col(company).alias("company"), "passed", "reason", info.alias("info"))
    return kept.groupBy(target).agg(F.array_sort(F.collect_list(item)).alias("requirements"))


def outlier_note(rows: DataFrame, *, target: str = "t") -> DataFrame:
    """Trimmed rows per target and what the report says about them."""
    counted = rows.groupBy(target).agg(F.count_if("is_outlier").alias("n_outliers"), F.max("trim_kind").alias("_kind"))
    note = F.when(F.col("_kind") == "full", F.lit("full trim")).when(F.col("_kind") == "per", F.lit("per only"))
    return counted.select(target, "n_outliers", note.otherwise(F.lit("no trim")).alias("note"))


# --- the funnel -------------------------------------------------------------

def peer_funnel(pool: DataFrame, companies: DataFrame, cells: DataFrame, target_vectors: DataFrame,
                vectors: DataFrame, *, target: str = "t", company: str = "company_id",
                vector: str = "embedding", threshold: float = V.SIMILARITY_THRESHOLD,
                income_period: str = V.INCOME_PERIOD) -> DataFrame:
    """Every pool company with the stage it reaches, why it leaves, and its final place.

    ``companies`` holds code, month, row_no and the listing metrics.  The cheap
    filters come first: vectors are joined to those only that pass them, and
    the scores are put back by (target, company).  The rows are written after each of these steps, and the next one
    reads the few columns it needs from there: every step joins its rows with aggregates of themselves, so in one plan the
    whole history would stand some hundred times, more than the planner gets through.
    """
    verdicts = income_verdict(companies, cells, company=company, income_period=income_period)
    settles = december("month", "code")
    facts = cut_lineage(pool.join(verdicts, company, "left").select(
        target, company, pad_code(strip("code")).alias("code"), "row_no", *METRIC_COLUMNS, "income_reason",
        settles.alias("_settles"), F.coalesce("profit_passed", F.lit(False)).alias("_profit"),
    ))
    candidates = facts.filter(F.col("_settles") & F.col("_profit")).select(target, company).distinct()
    scores = similarity_scores(candidates, target_vectors, vectors, target=target, company=company, vector=vector,
                               threshold=threshold)
    scored = cut_lineage(facts.join(
        scores.select(target, company, F.struct("score", "similar", "similarity_reason").alias("_s")), [target, company], "left"))
    marked = mark_december_firsts(scored, "_settles", target=target)
    survives = F.col("dec_passed") & F.col("_profit")
    staged = cut_lineage(marked.select(
        target, company, *METRIC_COLUMNS, "dec_passed", survives.alias("profit_passed"), "income_reason",
        F.when(survives, F.col("_s.score")).alias("score"),
        F.coalesce(survives & F.col("_s.similar"), F.lit(False)).alias("similar"),
        F.col("_s.similarity_reason").alias("similarity_reason"),
    ))
    judged = stage4_requirements(staged, target=target, eligible=F.col("similar"))
    stage = (
        F.when(F.col("passed"), 4).when(F.col("similar"), 3).when(F.col("profit_passed"), 2).otherwise(1)
    )
    why_not = (
        F.when(F.col("similar"), F.col("reason"))
        .when(F.col("profit_passed"), F.col("similarity_reason"))
        .when(F.col("dec_passed"), F.col("income_reason"))
        .otherwise(F.lit(V.FAIL_SETTLEMENT))
    )
    result = judged.select(
        target, company, stage.alias("stage_reached"), "dec_passed", "passed", why_not.alias("reason"),
        "is_outlier", "score", "per",
    )
    best = cap_peers(result, target=target, company=company).select(
        target, company, F.col("rank").alias("peer_rank")
    )
    return result.join(best, [target, company], "left")


def funnel_counts(funnel: DataFrame, *, target: str = "t") -> DataFrame:
    """Companies left after each stage, per target."""
    reached = F.col("stage_reached")
    return funnel.groupBy(target).agg(
        F.count(F.lit(1)).alias("stage1_pool"),
        F.count_if("dec_passed").alias("stage2_december"),
        F.count_if(reached >= 2).alias("stage2_profit"),
        F.count_if(reached >= 3).alias("stage3_similar"),
        F.count_if(reached >= 4).alias("stage4_passed"),
        F.count("peer_rank").alias("final_peers"),
    )


__all__ = [
    "cap_peers", "december_filter", "funnel_counts", "general_requirements", "income_verdict",
    "mark_december_firsts", "outlier_note", "peer_details", "peer_funnel", "profit_filter", "screen_with_fallback",
    "stage2_financial", "stage4_requirements", "trim_extremes",
]
