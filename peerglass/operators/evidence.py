"""Checking of person claims against a company's identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.text import digits_only, name_key, strip


def evidence_match_score(evidence: DataFrame, signatures: DataFrame, *, target: str = "t") -> DataFrame:
    """Points for name, domain and registration number found in each evidence text.

    Evidence: target, snippet, source_name, url.  Signatures: target,
    company_name, company_domain, biz_reg_no.  Keys of both sides are made
    once, in steps of their own, before they are looked for in each other.
    """
    blob = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("snippet", "source_name", "url")])
    texts = evidence.withColumn("_text", name_key(blob)).withColumn("_digits", digits_only("_text"))
    needles = signatures.select(
        target, name_key("company_name").alias("_name"), name_key("company_domain").alias("_domain"),
        digits_only("biz_reg_no").alias("_number"),
    )

    def found(needle: str, text: str, points: int) -> Column:
        hit = (F.col(needle) != "") & F.contains(F.col(text), F.col(needle))
        return F.when(hit, points).otherwise(0)

    score = (
        found("_name", "_text", V.NAME_POINTS) + found("_domain", "_text", V.DOMAIN_POINTS)
        + found("_number", "_digits", V.REGISTRATION_POINTS)
    )
    return texts.join(needles, target, "left").select(*evidence.columns, score.alias("match_score"))


def claim_strength(scored: DataFrame, *, target: str = "t", claim: str = "claim_no") -> DataFrame:
    """Per claim: best score, official evidence with a score, evidence count."""
    official = F.col("source_type").isin(*V.OFFICIAL_SOURCES) & (F.col("match_score") > 0)
    return scored.groupBy(target, claim).agg(
        F.max("match_score").alias("max_match"),
        F.count_if(official).alias("n_official"),
        F.count(F.lit(1)).alias("n_evidence"),
    )


def best_claim(scored: DataFrame, *, target: str = "t", claim: str = "claim_no") -> DataFrame:
    """Strongest claim per target: score, then official evidence, then evidence; first claim wins ties.

    Two partial aggregates; a target with many claims never meets in one task.
    """
    strength = claim_strength(scored, target=target, claim=claim)
    order = F.struct("max_match", "n_official", "n_evidence", (-F.col(claim)).alias("_first"))
    row = F.struct(claim, "max_match", "n_official", "n_evidence")
    return strength.groupBy(target).agg(F.max_by(row, order).alias("_b")).select(target, "_b.*")


def validate_claims(people: DataFrame, claims: DataFrame, evidence: DataFrame, signatures: DataFrame, *,
                    target: str = "t", claim: str = "claim_no") -> DataFrame:
    """Verdict per person: ordered failure reason, or a warning for a single evidence.

    People: target, person.  Claims: target, claim_no, name.
    """
    asked = people.select(target, strip("person").alias("person"))
    named = claims.join(asked, target).withColumn("_hit", strip("name") == F.col("person"))
    totals = named.groupBy(target).agg(F.count(F.lit(1)).alias("n_claims"), F.count_if("_hit").alias("n_hits"))
    hits = named.filter("_hit").select(target, claim)
    scored = evidence_match_score(evidence.join(hits, [target, claim], "left_semi"), signatures, target=target)
    best = best_claim(scored, target=target, claim=claim)
    company = signatures.select(target, strip(F.coalesce("company_name", F.lit(""))).alias("_company"))
    joined = asked.join(company, target, "left").join(totals, target, "left").join(best, target, "left")
    reason = (
        F.when(F.coalesce("_company", F.lit("")) == "", F.lit(V.FAIL_NO_COMPANY))
        .when(F.coalesce("n_claims", F.lit(0)) == 0, F.lit(V.FAIL_NO_CLAIMS))
        .when(F.coalesce("n_hits", F.lit(0)) == 0, F.lit(V.FAIL_NO_NAME))
        .when(F.col("n_evidence").isNull(), F.lit(V.FAIL_NO_EVIDENCE))
        .when(F.col("max_match") < V.MIN_MATCH_POINTS, F.lit(V.FAIL_IDENTITY))
        .when(F.col("n_official") < 1, F.lit(V.FAIL_OFFICIAL))
    )
    warning = F.when(reason.isNull() & (F.col("n_evidence") < 2), F.lit(V.WARN_ONE_EVIDENCE)).otherwise(F.lit(""))
    return joined.select(
        target, "person", reason.isNull().alias("valid"), F.coalesce(reason, F.lit("")).alias("reason"),
        warning.alias("warning"), claim, "max_match", "n_official", "n_evidence",
    )
