"""Business similarity of candidates to their target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.operators.distributed import join_split, top_k_per_key


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def with_unit_length(rows: DataFrame, vector: str, size: str) -> DataFrame:
    """Vector length as a column, computed once per vector and not once per pair."""
    return rows.withColumn(size, norm(F.col(vector)))


def similarity_scores(pairs: DataFrame, targets: DataFrame, candidates: DataFrame, *, target: str = "t",
                      company: str = "company_id", vector: str = "embedding",
                      threshold: float = V.SIMILARITY_THRESHOLD) -> DataFrame:
    """Score in [0, 1], verdict and reason for every given (target, candidate) pair.

    Only the pairs handed in are scored.  A target with most of the pairs, or a candidate of most targets, is split and its
    vector repeated for every part.  A candidate without a description
    fails with score 0; a target without one lets all its candidates pass.
    """
    wanted = with_unit_length(targets.select(target, F.col(vector).alias("_tv")), "_tv", "_tn")
    held = with_unit_length(candidates.select(company, F.col(vector).alias("_cv")), "_cv", "_cn")
    joined = join_split(pairs, held, company, "left", by=pairs.columns)
    joined = join_split(joined, wanted, target, "left", by=pairs.columns,
                        sizes=pairs.groupBy(target).agg(F.count(F.lit(1)).alias("_rows")))
    return joined.select(
        *pairs.columns,
        *score_columns(F.col("_tv"), F.col("_tn"), F.col("_cv"), F.col("_cn"), threshold),
    )


def score_columns(tv: Column, tn: Column, cv: Column, cn: Column, threshold: float) -> list[Column]:
    cosine = F.coalesce(F.try_divide(dot(tv, cv), tn * cn), F.lit(0.0))
    exact = F.when(cv.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))
    score = F.when(tv.isNotNull(), F.round(exact, 6))  # rounded for output, after the comparison
    passed = tv.isNull() | (exact >= threshold)
    reason = F.when(tv.isNull(), F.lit("skipped")).when(cv.isNull(), F.lit(V.NO_BUSINESS_INFO)).otherwise(
        F.lit("scored")
    )
    return [score.alias("score"), passed.alias("similar"), reason.alias("similarity_reason")]


def attach_products(scores: DataFrame, info: DataFrame, key: str = "company_id",
                    products: str = "main_products") -> DataFrame:
    """Product text of each scored company, a fixed text where unknown."""
    return scores.join(info.select(key, products), key, "left").withColumn(
        products, F.coalesce(products, F.lit(V.NO_PRODUCT_INFO))
    )


def top_similar(scores: DataFrame, k: int = V.SIMILAR_SHOWN, *, target: str = "t",
                company: str = "company_id") -> DataFrame:
    """The k most similar candidates of each target."""
    return top_k_per_key(scores, [target], [F.desc("score"), F.asc(company)], k)


def stage3_similarity(pairs: DataFrame, targets: DataFrame, candidates: DataFrame, info: DataFrame, *,
                      target: str = "t", company: str = "company_id",
                      threshold: float = V.SIMILARITY_THRESHOLD) -> DataFrame:
    """Scores, verdicts and products of the stage-2 survivors."""
    scores = similarity_scores(pairs, targets, candidates, target=target, company=company, threshold=threshold)
    return attach_products(scores, info, company)
