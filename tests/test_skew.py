"""A hot target: its rows are split over tasks, and the results stay right."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from peerglass.operators import refdata as ref
from peerglass.operators import screening as S
from peerglass.operators import similarity as sim
from peerglass.operators.distributed import join_split, split_hot_keys

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_pool(spark, n=200_000):
    """Every third row belongs to target 0, the others to 400 targets."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 3 == 0, 0).otherwise(1 + i % 400).cast("int").alias("t"), i.alias("company_id"),
        (i % 50 == 0).alias("is_warning"), (i % 1500).cast("double").alias("market_cap"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 8000.0).alias("per"), (F.lit(1.0) + i % 997).alias("pbr"),
        (F.lit(2.0) + i % 499).alias("ev_ebitda"),
    )


def test_hot_target_is_split(small_partitions):
    """Rows of the hot target spread evenly over the salts its facts are given."""
    rows = hot_pool(small_partitions)
    sizes = rows.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    salted, expand = split_hot_keys(rows, sizes, "t", "n", rows_per_task=2500)
    parts = salted.groupBy("t", "_salt").count().filter("t = 0").toPandas()
    assert len(parts) == 27 and parts["count"].max() < 2 * parts["count"].mean()
    facts = expand(sizes).groupBy("t").count().toPandas().set_index("t")["count"]
    assert facts[0] == 27 and (facts == 1).sum() == len(facts) - 1
    joined = salted.join(expand(sizes), ["t", "_salt"])
    assert joined.count() == rows.count()


def test_every_hot_key_is_split(small_partitions):
    """A hundred keys beyond a task's rows: all of them spread, by their row counts."""
    rows = small_partitions.range(100_000).select((F.col("id") % 100).alias("t"), "id")
    salted, _ = split_hot_keys(rows, rows.groupBy("t").agg(F.count("*").alias("n")), "t", "n", rows_per_task=300)
    parts = salted.groupBy("t", "_salt").count()
    assert parts.count() == 400 and parts.agg(F.max("count")).first()[0] < 360


def test_requirement_stage_joins_on_the_salt(small_partitions):
    result = S.stage4_requirements(hot_pool(small_partitions))
    text = result._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"SortMergeJoin \[([^\]]*)\]", text)
    assert keys and all("_salt" in k for k in keys)


def test_hot_target_is_right(small_partitions):
    rows = hot_pool(small_partitions)
    judged = S.stage4_requirements(rows).filter("t = 0")
    got = {r.company_id for r in judged.filter("passed").select("company_id").toLocalIterator()}
    pdf = rows.filter("t = 0").toPandas()
    ok = pdf[~pdf.is_warning & (pdf.market_cap < 1000) & (pdf.per >= 10) & (pdf.per <= 100)]
    metrics = ["per", "pbr", "market_cap", "ev_ebitda"]
    out = sum(((ok[m] == ok[m].max()) | (ok[m] == ok[m].min())) for m in metrics) > 0
    assert got == set(ok[~out].company_id) and len(got) > 1000


def test_two_sided_join_splits_a_hot_key_and_keeps_all_pairs(small_partitions):
    """Half of the rows under one key; its facts, three to a key, meet every one of them."""
    rows = small_partitions.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 300).alias("k"), F.lit("same").alias("text"), "id")
    facts = rows.select("k").distinct().crossJoin(small_partitions.range(3).select(F.col("id").alias("f")))
    joined = join_split(rows.drop("id"), facts, "k", rows_per_task=1000)
    assert joined.count() == 120_000
    assert joined.groupBy("k", "f").count().filter("k = -1").agg(F.min("count"), F.max("count")).first()[:] == (20_000, 20_000)
    left = join_split(rows, facts.filter("k <> -1"), "k", "left", by=["id"], rows_per_task=1000)
    assert left.filter("k = -1 and f is null").count() == 20_000


def test_equal_rows_of_a_hot_key_do_not_stay_together(small_partitions):
    rows = small_partitions.range(0, 40_000, 1, 16).select(F.lit(1).alias("t"), F.lit("x").alias("a"))
    salted, _ = split_hot_keys(rows, rows.groupBy("t").agg(F.count("*").alias("n")), "t", "n", rows_per_task=5000)
    parts = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(parts) > 3 and max(parts) < 20_000


def test_similarity_of_a_hot_label(small_partitions, monkeypatch):
    """One target with half of all pairs: scores as computed one by one, no join on the label alone."""
    monkeypatch.setattr(join_split, "__kwdefaults__", {"by": None, "sizes": None, "rows_per_task": 500})
    n = 6000
    i = F.col("id")
    vectors = small_partitions.range(n).select(i.alias("company_id"), F.array(F.sin(i), F.cos(i * 3), (i % 7).cast("double")).alias("embedding"))
    targets = small_partitions.range(40).select(i.alias("t"), F.array(F.cos(i), F.lit(1.0), F.lit(0.5)).alias("embedding"))
    pairs = small_partitions.range(n).select(F.when(i % 2 == 0, 0).otherwise(i % 40).alias("t"), i.alias("company_id"))
    scored = sim.similarity_scores(pairs, targets, vectors)
    plain = pairs.join(vectors.withColumnRenamed("embedding", "cv"), "company_id").join(targets.withColumnRenamed("embedding", "tv"), "t")
    dots = F.aggregate(F.zip_with("tv", "cv", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    want = plain.select("t", "company_id", F.greatest(F.lit(0.0), dots / (size("tv") * size("cv"))).alias("w"))
    assert scored.join(want, ["t", "company_id"]).filter(F.abs(F.col("score") - F.col("w")) < 1e-5).count() == n
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert all("_salt" in keys for keys in re.findall(r"SortMergeJoin \[([^\]]*)\]", text))


def test_first_of_a_hot_code(small_partitions):
    """Half of a target's rows share one code: one of them is the first, found on salted keys."""
    i = F.col("id")
    rows = small_partitions.range(0, 20_000, 1, 8).select(
        (i % 3).alias("t"), F.when(i % 2 == 0, "A00001").otherwise(F.lpad(i.cast("string"), 6, "0")).alias("code"), i.alias("row_no"),
        (i % 5 > 0).alias("_settles"))
    marked = S.mark_december_firsts(rows, "_settles")
    text = marked._jdf.queryExecution().executedPlan().toString()
    assert all("_salt" in keys for keys in re.findall(r"SortMergeJoin \[([^\]]*)\]", text))
    firsts = {(r.t, r.row_no) for r in marked.filter("dec_passed and code = 'A00001'").collect()}
    want = {t: min(x for x in range(20_000) if x % 3 == t and x % 2 == 0 and x % 5 > 0) for t in range(3)}
    assert firsts == set(want.items())
    assert marked.filter("dec_passed and code <> 'A00001'").count() == sum(1 for x in range(20_000) if x % 2 and x % 5)


def test_industry_with_many_codes_is_spread_by_the_rows_it_makes(spark, monkeypatch):
    monkeypatch.setattr(ref, "JOINED_ROWS", 1000)
    companies = spark.range(200).select(F.col("id").alias("c"), F.when(F.col("id") < 190, F.lit("hot, one")).alias("industry"))
    codes = spark.range(50).select(F.lit("hot one").alias("industry_name"), F.col("id").cast("string").alias("class_code"))
    rows = ref.attach_industry_code(companies, codes, "industry", "industry_name", many=True).withColumn("task", F.spark_partition_id())
    kept = rows.collect()
    assert len(kept) == 190 * 50 + 10 and len({(r.c, r.class_code) for r in kept}) == 9510
    made = Counter(r.task for r in kept)
    assert len(made) == 4 and max(made.values()) < 0.6 * len(kept)


def test_companies_without_code_are_told_without_the_rows_of_all_codes(spark):
    companies = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, None), (1, "a")], "c int, industry string")
    listed = [("a", str(i)) for i in range(40)] + [("b", None), ("b,", None), ("b", "7"), ("차체,나", "1"), (None, "9")]
    codes = spark.createDataFrame(listed, "industry_name string, class_code string")
    cut = ref.code_presence(codes, "industry_name")
    assert cut.count() == 6
    plain = ref.unmatched(ref.attach_industry_code(companies, codes, "industry", "industry_name"), ["c"])
    short = ref.unmatched(ref.attach_industry_code(companies, cut, "industry", "industry_name"), ["c"])
    assert sorted(r.c for r in short.collect()) == sorted(r.c for r in plain.collect()) == [2, 2, 3]
