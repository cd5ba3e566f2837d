"""Peer multiples and scenario valuation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.numbers import (
    fixed, grouped, money_approx, multiple_text, percent_text, round_discount, shares_or_capital, shares_text, won_text,
)


def peer_multiple(peers: DataFrame, *, target: str = "t", per: str = "per", passed: str = "passed") -> DataFrame:
    """Mean PER of the passed final peers; 0.0 where there is none."""
    return peers.groupBy(target).agg(
        F.coalesce(F.avg(F.when(F.col(passed), F.col(per))), F.lit(0.0)).alias("avg_per")
    )


def expand_scenarios(rows: DataFrame) -> DataFrame:
    """Each row once per scenario.  A row-local explode: nothing is joined."""
    scenarios = F.array(*[
        F.struct(F.lit(i).alias("scenario_no"), F.lit(name).alias("scenario"), F.lit(ratio).alias("ratio"))
        for i, (name, ratio) in enumerate(V.SCENARIOS)
    ])
    return rows.select("*", F.explode(scenarios).alias("_s")).select(*rows.columns, "_s.*")


def floor_to(value: Column, step: int) -> Column:
    return F.floor(value / step) * step


def valuation_base(inputs: DataFrame, multiples: DataFrame, *, target: str = "t") -> DataFrame:
    """One row per target: what the scenarios start from, and whether they can be computed.

    Inputs: target, target_net_income, total_shares, target_round, capital.
    """
    income = F.coalesce(F.col("target_net_income"), F.lit(0))
    ready = (
        inputs.join(multiples.select(target, "avg_per"), target, "left")
        .withColumn("avg_per", F.coalesce("avg_per", F.lit(0.0)))
        .withColumn("shares", shares_or_capital("total_shares", "capital"))
        .withColumn("discount", round_discount("target_round"))
    )
    return ready.select(
        "*", income.alias("_income"), ((F.col("avg_per") > 0) & (income != 0)).alias("_can_value"),
        (F.coalesce(F.col("shares"), F.lit(0)) != 0).alias("_has_shares"))


def present_value(ratio: Column) -> Column:
    value = floor_to(F.col("_income") * ratio / (1 + F.col("discount")), V.PV_STEP)
    return F.when(F.col("_can_value"), value)


def offer_price(price: Column) -> Column:
    return floor_to(price * (1 - V.OFFER_DISCOUNT), V.PRICE_STEP)


def filled(template: str, **parts: Column) -> Column:
    """A text with columns in the places of its braces."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[parts[piece] if place % 2 else F.lit(piece) for place, piece in enumerate(pieces)])


def scenario_valuation(inputs: DataFrame, multiples: DataFrame, *, target: str = "t") -> DataFrame:
    """Three scenario rows per target, or the reason why none can be computed.

    The row of the first scenario says the headline price; a reason why there is none stands on every row.
    """
    can_value = F.col("_can_value")
    blockers = F.array_compact(F.array(
        F.when(F.col("avg_per") <= 0, F.lit(V.NO_PEER_PER)), F.when(F.col("_income") == 0, F.lit(V.NO_INCOME))))
    rows = (
        expand_scenarios(valuation_base(inputs, multiples, target=target))
        .withColumn("pv", present_value(F.col("ratio")))
        .withColumn("ev", F.col("pv") * F.col("avg_per"))
        .withColumn("price", F.when(F.col("_has_shares"), F.col("ev") / F.col("shares")))
        .withColumn("final_price", offer_price(F.col("price")))
    )
    headline = F.when(~can_value, F.lit("-")).when(~F.col("_has_shares"), F.lit(V.NO_SHARE_PRICE))
    return rows.select(
        target, "scenario_no", "scenario", "ratio", "avg_per", "discount", "shares", "pv", "ev", "price", "final_price",
        filled(V.SCENARIO_NOTE, share=percent_text("ratio")).alias("ratio_text"),
        F.concat(won_text("pv"), F.lit("\n"), money_approx("pv")).alias("pv_text"),
        F.concat(won_text("ev"), F.lit("\n"), money_approx("ev")).alias("ev_text"),
        F.when(can_value, F.coalesce(won_text("price"), F.lit("-"))).alias("price_text"),
        F.when(can_value, F.coalesce(won_text("final_price"), F.lit("-"))).alias("final_price_text"),
        F.when(~can_value, F.array_join(blockers, "; ")).otherwise(F.lit("")).alias("not_computable"),
        F.coalesce(headline, F.when(F.col("scenario_no") == 0, won_text("final_price"))).alias("headline_price"),
    )


def valuation_summary(inputs: DataFrame, multiples: DataFrame, *, target_year: int, target: str = "t",
                      source: Column | None = None) -> DataFrame:
    """One row per target: headline price, how it came about, and the figures as the report shows them.

    The headline is the offer price of the first scenario.  ``source`` says where a capital that stands in for missing shares
    was found.
    """
    base = valuation_base(inputs, multiples, target=target)
    can_value, has_shares = F.col("_can_value"), F.col("_has_shares")
    given = F.coalesce(F.col("total_shares"), F.lit(0)) != 0
    price = won_text(offer_price(present_value(F.lit(V.SCENARIOS[0][1])) * F.col("avg_per") / F.col("shares")))
    headline = F.when(~can_value, F.lit("-")).when(~has_shares, F.lit(V.NO_SHARE_PRICE)).otherwise(price)
    multiple = F.when(F.col("avg_per") > 0, multiple_text("avg_per")).otherwise(F.lit(V.NO_MULTIPLE))
    round_name = F.coalesce(F.nullif(F.col("target_round"), F.lit("")), F.lit(V.UNKNOWN_ROUND))
    steps = filled(V.RATIONALE_STEPS, multiple=multiple, round=round_name,
                   discount=F.concat(fixed(F.col("discount") * 100, 0), F.lit("%")))
    note = (
        F.when(has_shares & given, filled(V.RATIONALE_SHARES, shares=shares_text("shares")))
        .when(has_shares, filled(V.RATIONALE_SHARES_FROM_CAPITAL, shares=shares_text("shares"), source=F.coalesce(
            source if source is not None else F.lit(""), F.lit(""))))
        .otherwise(F.lit(V.RATIONALE_NO_SHARES))
    )
    blocked = F.concat(
        F.lit(V.RATIONALE_BLOCKED), F.when(F.col("avg_per") <= 0, F.lit(V.RATIONALE_NO_PEER_PER)).otherwise(F.lit("")),
        F.when(F.col("_income") == 0, F.lit(V.RATIONALE_NO_INCOME.format(year=target_year))).otherwise(F.lit("")))
    missing = F.lit(V.NO_INFORMATION)
    return base.withColumn("headline_price", headline).select(
        target, "headline_price", F.when(can_value, F.concat(steps, note)).otherwise(blocked).alias("rationale"),
        F.when(F.col("_income") != 0, F.concat(grouped("_income"), F.lit("원"))).otherwise(missing).alias("net_income_text"),
        F.when(has_shares, shares_text("shares")).otherwise(missing).alias("shares_text"), multiple.alias("multiple_text"),
        percent_text("discount").alias("discount_text"), percent_text(F.lit(V.OFFER_DISCOUNT)).alias("offer_discount_text"),
        filled(V.OFFER_COMMENT, price=F.col("headline_price")).alias("comment"))


def statement_ratios(cells: DataFrame, keys: list[str], account: str = "account", value: str = "value",
                     accounts: dict[str, str] | None = None) -> DataFrame:
    """Current ratio and debt ratio from account lines in long form."""
    names = accounts or V.STATEMENT_ACCOUNTS
    wide = cells.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(account) == label, F.col(value))).alias(column) for column, label in names.items()
    ])
    return wide.select(
        *keys,
        F.try_divide("current_assets", "current_liabilities").alias("current_ratio"),
        F.try_divide("total_liabilities", "total_equity").alias("debt_ratio"),
    )


def ratio_valuation(targets: DataFrame, peers: DataFrame, *, target: str = "t") -> DataFrame:
    """Own metric times the peers' mean multiple; without sales ten times the last funding.

    Targets: target, income, sales, last_funding.  Peers: target, cap, income, sales.
    """
    multiples = peers.groupBy(target).agg(
        F.avg(F.when(F.col("income") > 0, F.col("cap") / F.col("income"))).alias("avg_per"),
        F.avg(F.when(F.col("sales") > 0, F.col("cap") / F.col("sales"))).alias("avg_psr"),
    )
    joined = targets.join(multiples, target, "left")
    by_sales = F.col("sales") * F.col("avg_psr")
    by_funding = F.col("last_funding") * V.FUNDING_MULTIPLE
    return joined.select(
        target, "avg_per", "avg_psr",
        (F.col("income") * F.col("avg_per")).alias("value_by_per"),
        F.when(F.coalesce("sales", F.lit(0.0)) > 0, by_sales).otherwise(by_funding).alias("value_by_sales"),
    )
