"""Spans of the methods that reach beyond a base span."""

import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from peerglass.llm import decontaminate, jaccard, licenses, mixing, pii, secrets  # noqa: E402
from peerglass.llm import scratch as scratch_module  # noqa: E402
from peerglass.llm.scratch import Scratch  # noqa: E402


def test_a_random_token_that_holds_hex_digits_is_redacted_whole(spark):
    token = "kJ8sPq2LmZxG" + "0123456789abcdef" + "RtV4bNc7WyH3"
    docs = spark.createDataFrame([(0, f"key {token} end"), (1, "sum 0123456789abcdef end")], "doc_id bigint, text string")
    found = secrets.find_secrets(docs)
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secret_spans"]] for r in found.collect()}
    assert spans == {0: [("random", 4, 44), ("hex", 16, 32)], 1: [("hex", 4, 20)]}
    shown = found.select("doc_id", secrets.redact(F.col("text"), F.col("secret_spans")).alias("t")).orderBy("doc_id").collect()
    assert [r["t"] for r in shown] == ["key [random] end", "sum [hex] end"]


def test_an_address_that_reaches_beyond_a_strict_one(spark):
    texts = ["mail me: jane.roe@web.uni [dot] de now", "mail me: jane.roe@web.uni. Then we", "server 10.20.30.40 80 is up"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: [(s["kind"], r["text"][s["start"]:s["end"]], s["base"]) for s in r["pii_spans"]] for r in pii.find_pii(docs).collect()}
    strict = ("email", "jane.roe@web.uni", True)
    assert sorted(found[0]) == sorted([strict, ("email", "jane.roe@web.uni [dot] de", False)])
    assert found[1] == [strict] and found[2] == [("ip", "10.20.30.40", True)]


@pytest.mark.parametrize("many", [20_000, 40_000])
def test_license_scan_of_many_phrases_takes_time_in_proportion(many):
    """Twice the phrases, about twice the time: a hit is placed from the one before it."""
    text = "all rights reserved cc by the " * many
    scanner = licenses.Scanner(licenses.TEMPLATES)
    start = time.perf_counter()
    words, hits, first, last, *_ = scanner.scan(text)
    assert (words, hits, first, last) == (6 * many, 2 * many, 0, 6 * many - 3)
    assert time.perf_counter() - start < many / 4000


def test_settings_of_the_session_are_as_before(spark):
    docs = spark.createDataFrame([(0, "a b c d e f g"), (1, "a b c d e f g")], "doc_id bigint, text string")
    before = dict(spark.conf.getAll)
    groups = jaccard.similarity_groups(docs)
    assert [tuple(r) for r in groups.orderBy("doc_id").collect()] == [(0, 3, 0), (1, 3, 0)]
    after = dict(spark.conf.getAll)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    assert after.pop(name, "10000") == before.pop(name, "10000") and after == before


def test_one_hot_source_moves_no_text(spark, monkeypatch):
    """Nearly all rows of one source: no exchange of documents with few sources, and the same rows with many."""
    i = F.col("id")
    docs = spark.range(0, 3000, 1, 4).select(
        i.alias("doc_id"), F.when(i % 20 > 0, "hot").otherwise(F.concat(F.lit("s"), (i % 7).cast("string"))).alias("source"),
        F.repeat(F.lit("word "), (i % 90).cast("int")).alias("text"))
    few = mixing.mix(docs, keep=["doc_id"])
    assert few.columns == ["doc_id", "size", "source_size", "target", "rate", "copies", "taken"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3  # the third makes what is known of the sources
    rows = sorted(map(tuple, few.collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(docs, keep=["doc_id"]).collect())) == rows


def test_sets_of_a_common_passage_meet_once_and_not_in_every_branch(spark, monkeypatch):
    """A passage in all texts: what is shipped to the walks stays a few rows for each text, and no link is lost."""
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    passage = " ".join(f"p{n}" for n in range(60))
    own = [(40 + 3 * i, i // 2 if i % 10 < 2 else i) for i in range(80)]  # some pairs with nearly the same own words
    rows = [(i, f"{passage} " + " ".join(f"w{name}-{n}" for n in range(length))) for i, (length, name) in enumerate(own)]
    shipped, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda placed, *rest: shipped.append(placed.count()) or linked(placed, *rest))
    groups = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in groups.collect()) == Counter(brute.groups(rows))
    assert max(shipped) <= 10 * len(rows)


def test_the_plan_of_decontamination_holds_the_words_few_times(spark):
    """A condition on windows, pushed below the steps that make them, held the words more than a thousand times."""
    words = [f"w{n}" for n in range(40)]
    docs = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(words[:12])), (2, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([("a", " ".join(words[5:18])), ("b", " ".join(words[:12])), ("c", None), ("d", "")],
                                  "item_id string, text string")
    found = decontaminate.find_contamination(docs, bench)
    rows = {r["_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.collect()}
    assert rows == {0: (40, 18, ["a", "b"]), 1: (12, 12, ["b"]), 2: (0, 0, [])}
    for frame in (found, decontaminate.drop_contaminated(docs, bench)):
        plan = frame._jdf.queryExecution().optimizedPlan()
        filters = [node.expressions().toString() for node in _nodes(plan) if node.nodeName() == "Filter"]
        assert filters and max(text.count("zip_with") for text in filters) <= 8 and max(text.count("regexp_extract_all") for text in filters) <= 8


def _nodes(plan):
    below = plan.children()
    return [plan, *[node for i in range(below.size()) for node in _nodes(below.apply(i))]]


def test_groups_that_are_stars_already_are_not_walked_again(spark, monkeypatch):
    """Rounds of joins end as soon as all groups are stars, and the families' walks give stars themselves."""
    scratch = Scratch(spark, "t")
    stars = [(n, n % 3) for n in range(3, 40)] + [(n, 100) for n in range(101, 120)]
    found = jaccard.connected(spark.createDataFrame(stars, "a bigint, b bigint"), scratch, "s")
    assert {tuple(r) for r in found.collect()} == {*stars, (0, 0), (1, 1), (2, 2), (100, 100)}
    assert scratch.count == 2
    keys, connected = [], jaccard.connected
    monkeypatch.setattr(jaccard, "connected", lambda links, scratch, key: keys.append(key) or connected(links, scratch, key))
    rows = [(i, " ".join(f"w{i // 4}-{n}" for n in range(40 + i % 4))) for i in range(60)]
    groups = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in groups.collect()) == Counter(brute.groups(rows))
    assert keys == ["family"]


def _spied(monkeypatch, seen):
    linked = jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda placed, sets, share: seen.append((placed.count(), sets.count())) or linked(placed, sets, share))


def test_sets_with_common_runs_of_words_only_are_not_shipped(spark, monkeypatch):
    """Every set shares most of its shingles with some others, but few with any one of them: no walk needs it."""
    rng = np.random.default_rng(6)
    phrases = [" ".join(f"p{n}-{k}" for k in range(10)) for n in range(2000)]
    texts = [" ".join(phrases[n] for n in rng.integers(0, 2000, 30)) for _ in range(200)]
    rows = list(enumerate([*texts, *[f"{text} one more" for text in texts[:10]]]))
    shipped = []
    _spied(monkeypatch, shipped)
    groups = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in groups.collect()) == Counter(brute.groups(rows))
    assert shipped and all(20 <= sets <= 100 for _, sets in shipped[:1])


def test_walks_go_in_turns(spark, monkeypatch):
    """What is shipped at once follows the sets, and many turns give the groups of one."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "SHARED", 2)
    monkeypatch.setattr(jaccard, "SHIPPED", 0.5)
    rng = np.random.default_rng(3)
    base = [f"w{n}" for n in range(120)]
    rows = [(i, " ".join(base[:60 + int(rng.integers(0, 60))] + [f"x{i}-{n}" for n in range(rng.integers(0, 40))])) for i in range(80)]
    shipped = []
    _spied(monkeypatch, shipped)
    groups = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in groups.collect()) == Counter(brute.groups(rows))
    assert len(shipped) >= 6 and max(n for n, _ in shipped) <= 1.5 * len(rows)


def _local_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(files.mkString("\n").split("\n"))


def test_shuffle_files_of_a_written_table_go_with_the_write(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = _local_files(spark), spark.conf.get(name)
    made = Scratch(spark, "t").cut(spark.range(5000).selectExpr("id % 700 as k", "id").groupBy("k").agg(F.collect_list("id").alias("ids")))
    left = lambda: {f for f in _local_files(spark) - before if "shuffle_" in f}
    until = time.monotonic() + 20
    while left() and time.monotonic() < until:
        time.sleep(0.2)
    assert not left() and spark.conf.get(name) == setting
    assert made.count() == 700


def test_groups_leave_one_table(spark, monkeypatch, tmp_path):
    """What a later step reads is the ids and groups; sets and branches are no longer on disk."""
    monkeypatch.setattr(scratch_module, "shared_folder", lambda spark: f"file://{tmp_path}")
    rows = [(i, " ".join(f"w{i // 4}-{n}" for n in range(40 + i % 4))) for i in range(60)]
    groups = jaccard.similarity_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(list(tmp_path.glob("jaccard-*/*"))) == 1
    assert Counter(tuple(r) for r in groups.collect()) == Counter(brute.groups(rows))


def test_kept_documents_are_shuffled_once(spark):
    """Null ids and rows that repeat id and text: one row each, and one exchange holds the texts."""
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words of the same id"), (2, "a b c d e f"), (None, "g h i j k l"), (None, "g h i j k l"),
            (None, None), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumn("more", F.lit("m"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        kept = jaccard.keep_first(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    finally:
        spark.conf.set(threshold, before)
    assert kept.columns == docs.columns
    assert got == Counter([(1, "a b c d e f"), (1, "other words of the same id"), (None, "g h i j k l"), (None, None), (3, None), (4, "")])
    assert "Exchange" not in plan[plan.index("Window"):plan.index("SortMergeJoin")]
