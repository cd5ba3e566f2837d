"""Fingerprints and groups against plain Python."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from peerglass.llm import simhash
from peerglass.llm.queries import QUERIES
from peerglass.llm.scratch import Scratch

FOLDER = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    """{fingerprint: smallest id} by comparing all with all."""
    group = {fp: fp for fp, _ in rows}
    for a in list(group):
        for b in list(group):
            if group[a] != group[b] and (a ^ b).bit_count() <= radius:
                old, new = group[a], group[b]
                group = {fp: new if g == old else g for fp, g in group.items()}
    least = {}
    for fp, doc in rows:
        if doc is not None:
            least[group[fp]] = min(doc, least.get(group[fp], doc))
    return {fp: least.get(g) for fp, g in group.items()}


def expected(docs):
    rows = [(plain_fingerprint(text), doc) for doc, text in docs]
    of = plain_groups(rows)
    return sorted(((doc, f"{fp:016x}", of[fp]) for fp, doc in rows), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query_agrees_with_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_simhash"](spark, FOLDER)) == expected(docs)


def test_awkward_rows(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé😀") for _ in range(4)) for _ in range(50)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [None, "", " \n\t", "One", "one", "one two", "ONE two three", "one two three", "one two  three four", long, long + " x", "a " * 50]
    docs = [(10 * i + 3, t) for i, t in enumerate(texts)] + [(3, "one"), (3, "one"), (None, "one two"), (None, "nothing like it")]
    made = spark.createDataFrame(docs, "doc_id bigint, text string")
    for name in ("fp", "first_id", "grp", "component_id", "mask", "fingerprint", "cls"):
        made = made.withColumn(name, F.lit("clash"))
    assert got(simhash.near_duplicates(made)) == expected(docs)


def test_empty_table(spark):
    assert got(simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string"))) == []


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_of_a_text_make_the_same_fingerprint(piece):
    rng = random.Random(piece)
    text = "".join(rng.choice("ab C\n\té ") for _ in range(400))
    assert simhash.fingerprint(text.encode(), piece) == plain_fingerprint(text)


@pytest.mark.parametrize("tree", [2, 40, 5000])
def test_hot_shards_are_cut_again_and_lose_no_link(spark, tree):
    """Hundreds of fingerprints around a few centres, so that most share their first 32 bits."""
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(3)]
    values = {c ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 4))) for c in centres for _ in range(250)}
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    scratch = Scratch(spark, "test")
    placed = simhash.shards(nodes, scratch, tree).cache()
    if tree > 2:
        assert placed.groupBy("mask", "bits").count().agg(F.max("count")).first()[0] <= max(tree, 256)
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(placed).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    group = {v: v for v in values}
    for a, b in found:
        if group[a] != group[b]:
            old, new = group[a], group[b]
            group = {v: new if g == old else g for v, g in group.items()}
    want = plain_groups([(v, v) for v in values])
    least = {}
    for v, g in group.items():
        least[g] = min(v, least.get(g, v))
    assert {v: least[g] for v, g in group.items()} == want


def test_tree_follows_few_edges():
    rng = random.Random(1)
    tree, looked = simhash.BKTree(), 0

    class Counted(list):
        def __getitem__(self, place):
            nonlocal looked
            looked += 1
            return super().__getitem__(place)

    values = [rng.getrandbits(64) for _ in range(2000)]
    for value in values:
        tree.add(value)
    tree.values = Counted(tree.values)
    assert tree.near(values[700] ^ 3, 2) == [700]
    assert looked < len(values)
