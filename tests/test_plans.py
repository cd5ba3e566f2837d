"""Plans: no all-pairs joins, no one-task stages, pushed filters, narrow scans."""

import re

import pytest
from pyspark.sql import functions as F

from peerglass.operators import records as R
from peerglass.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Reports whose one row or one ordered list is the result itself.
ONE_TASK = {"industry_vocab", "null_audit"}


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_all_pairs_and_no_single_partition(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    if name not in ONE_TASK:
        assert "SinglePartition" not in text


@pytest.mark.parametrize("name", ["top_similar", "manifest_top_files", "list_preview"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_filters_and_columns_reach_the_scan(spark):
    assert re.search(r"ReadSchema: struct<o_custkey:bigint>", plan(spark, "semi_members"))
    text = plan(spark, "mark_members")
    assert "EqualTo(quality,1)" in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,quality:\w+>", text)


def test_only_bounded_lists_are_broadcast(spark):
    """With size-based broadcasts off, what is left are the lists of keys beyond the rows of a task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "stage4_requirements")
        assert "SortMergeJoin" in text
        assert "BroadcastExchange" in text
        assert len(re.findall("> 1000000", text)) >= 1
        assert QUERIES["peer_funnel"](spark, FOLDER).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")



@pytest.mark.parametrize("name", ["listing_metrics", "section_schemas"])
def test_rows_of_small_files_are_dealt_before_costly_steps(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan


def test_faults_of_documents_taken_apart(spark):
    values = ['"x"', "5", "null", "[]", "{}", "[5, null]", '[{"a": "x"}, {"a": null}]', '[{"a": "x"}, {"b": 1}]', '[{"a": "x", "b": "y"}]',
              '[{"a": 1, "b": null}, {"b": "z"}]']
    texts = [f'{{"o": {{"l": {v}, "s": {w}}}, "t": {w}}}' for v in values for w in values] + ["{}", "[]", "null", '{"o": 5}', '{"o": null}']
    spec = [R.Field("o.s"), R.Field("o.l", "ARRAY", exact_len=2), R.Field("o.l[].a"), R.Field("o.l[].b", nullable=True), R.Field("t", "ARRAY")]
    docs = spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("d"))
    both = docs.select(R.violations(F.col("d"), spec).alias("a"), F.array_compact(R._walk(F.col("d"), R.rule_tree(spec))).alias("b")).collect()
    assert len(both) == 105 and all(r.a == r.b for r in both)
