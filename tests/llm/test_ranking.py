"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerglass.llm import ranking
from peerglass.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(UP) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def expected(docs, items, top=10):
    held = [(doc, Counter(terms(text))) for doc, text in docs]
    held = [(doc, found, sum(found.values())) for doc, found in held if found]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(term for _, found, _ in held for term in found)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc, found, size in held:
            m = 100 - 90 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * found[t] // (1000 * found[t] + 8 * m))
                        for t in own if t in found)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, place, row[3], -row[0]) for place, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_query_agrees_with_plain_python(spark):
    read = lambda name, key: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(key, "text").collect()]
    assert got(QUERIES["op13_ranked_search"](spark, FOLDER)) == expected(read("documents", "doc_id"), read("benchmark", "item_id"))


def made(seed, docs=400, vocab=60):
    rng = random.Random(seed)
    words = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(vocab)]
    weights = [1 / (i + 1) for i in range(vocab)]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    rows = [(i, text(rng.choice([1, 5, 40, 200]))) for i in range(docs)]
    rows += [(i, rows[0][1]) for i in range(docs, docs + 40)]  # equal scores
    return rows, [(i, text(rng.choice([1, 4, 50]))) for i in range(12)]


@pytest.mark.parametrize("asked, block", [(200_000, 4096), (30, 64)])
def test_made_documents(spark, monkeypatch, asked, block):
    """Items in one turn and in many, documents in large and small blocks."""
    monkeypatch.setattr(ranking, "BLOCK", block)
    docs, items = made(4)
    random.Random(1).shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(ranking.rank(frame, wanted, asked=asked)) == expected(docs, items)


def test_awkward_rows(spark):
    long = "rare " + "common " * 200_000
    texts = [None, "", "!!! ###", "Common rare", "common RARE x", long, "é", " nbsp", "a_b a-b a.b", "common"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "Common rare"), (3, "Common rare"), (None, "common rare"), (None, "rare")]
    items = [(1, "Rare common"), (1, "é"), (2, None), (3, ""), (None, "a b nbsp"), (4, "nothing here"), (5, "a a a b"), (5, "a a a b")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    for name in ("n", "terms", "counts", "score", "rank", "bucket", "item", "term"):
        frame, wanted = frame.withColumn(name, F.lit("clash")), wanted.withColumn(name, F.lit("clash"))
    assert got(ranking.rank(frame, wanted)) == expected(docs, items)


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([] if empty != "items" else [(1, "a")], "doc_id bigint, text string")
    items = spark.createDataFrame([] if empty != "docs" else [(1, "a")], "item_id bigint, text string")
    assert got(ranking.rank(docs, items)) == []


def test_masks_are_bounds_and_few_are_scored():
    rng = np.random.default_rng(3)
    rows = [(doc, term, int(rng.integers(1, 50)) * (200 if term > 90 else 1)) for doc in range(3000)
            for term in np.flatnonzero(rng.random(100) < np.linspace(0.9, 0.01, 100))]
    owner, term, part = (np.array(c) for c in zip(*rows))
    block = ranking.Block(np.bincount(owner, minlength=3000), owner, term.astype(np.int32), part.astype(np.int64))
    asked = np.array([1, 5, 40, 60, 80, 92, 95, 99])
    wanted = np.isin(np.arange(100), asked)
    bound, code = block.masks(asked)
    scores = block.scores(np.arange(3000), wanted)
    assert (scores <= bound[code]).all()
    held = {doc: frozenset(t for d, t, _ in rows if d == doc and wanted[t]) for doc in range(200)}
    assert all((held[a] == held[b]) == (code[a] == code[b]) for a in range(0, 200, 7) for b in range(200))
    looked = []
    plain = block.scores
    block.scores = lambda docs, w: looked.append(len(docs)) or plain(docs, w)
    best = ranking.best_of(block, list(range(3000)), asked, wanted, [])
    assert [(-s, d) for s, _, d in best] == sorted(((int(s), d) for d, s in enumerate(scores)), key=lambda r: (-r[0], r[1]))[:10]
    assert sum(looked) < 1500
