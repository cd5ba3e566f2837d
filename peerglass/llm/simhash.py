"""Near duplicates by SimHash fingerprints and BK-trees.

A fingerprint has a bit for each of 64 places: 1 where more than half of the hashes of a text's three-word runs have it.
Equal fingerprints are one node.  Nodes that differ in at most two bits link; a group is what links reach.

Nodes meet in shards.  The 64 bits are four blocks; two nodes within two bits agree on two whole blocks at least, so a
node goes to the six shards named by a pair of its blocks and no link is lost.  Each shard's nodes stand in a BK-tree:
a child hangs at the edge numbered by its distance to the parent, and a search follows only the edges that the triangle
inequality leaves open.  A shard of more than ``TREE`` nodes is cut again by the same rule over the bits that are still
free: 32, then 16, then 8, and 8 free bits make 256 nodes at most.  So a tree is of bounded size however many texts are
alike, and is shipped to one task together with its searches; trees are not broadcast, as there are more of them in more data.

Fingerprints are made in one Arrow pass that holds a piece of a text at a time.

Defined cases: null text and text without words have fingerprint zero, linked like any other; texts of one or two words have
one run; repeated rows are kept, each with the same result; a null id is kept as a row and is a group's smallest id only where
the group has no other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerglass.llm.jaccard import connected
from peerglass.llm.scratch import Scratch

SHINGLE, RADIUS, SEED, TREE = 3, 2, 42, 1024
PIECE = 1 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _shingles(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Word runs of a text, a piece of the text at a time; the last words of a piece lead the next."""
    carry: list[bytes] = []
    at, short = 0, True
    while at < len(text):
        blank = _BLANK.search(text, at + piece)
        past = blank.start() if blank else len(text)
        words = carry + text[at:past].translate(_LOWER).split()
        if len(words) >= SHINGLE:
            short = False
            yield [b" ".join(run) for run in zip(*(words[n:] for n in range(SHINGLE)))]
        carry, at = words[-(SHINGLE - 1):], past
    if short and carry:
        yield [b" ".join(carry)]


def fingerprint(text: bytes, piece: int = PIECE) -> int:
    ones, total = np.zeros(64, np.int64), 0
    for runs in _shingles(text, piece):
        hashes = np.fromiter((xxhash.xxh64_intdigest(run, SEED) for run in runs), "<u8", len(runs))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(runs)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str, column: str) -> DataFrame:
    """(doc_id, fp) of every row; the fingerprint's 64 bits as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(column).alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


class BKTree:
    """Numbers in a tree whose edges are Hamming distances."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the numbers within the radius."""
        found, ahead = [], [0] if self.values else []
        while ahead:
            place = ahead.pop()
            distance = (self.values[place] ^ value).bit_count()
            if distance <= radius:
                found.append(place)
            edges = self.edges[place]
            ahead += [edges[d] for d in range(max(distance - radius, 0), distance + radius + 1) if d in edges]
        return found

    def add(self, value: int) -> None:
        """A number that the tree does not hold yet."""
        self.values.append(value)
        self.edges.append({})
        place, new = 0, len(self.values) - 1
        while new:
            edges = self.edges[place]
            distance = (self.values[place] ^ value).bit_count()
            if distance not in edges:
                edges[distance] = new
                return
            place = edges[distance]


def tree_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links between different numbers, as many as hold together what all links within the radius do."""
    tree, links, group = BKTree(), [], []

    def top(place: int) -> int:
        while group[place] != place:
            group[place] = group[group[place]]
            place = group[place]
        return place

    for new, value in enumerate(values):
        group.append(new)
        for place in tree.near(value, radius):
            if (other := top(place)) != top(new):
                group[top(new)] = other
                links.append((value, tree.values[place]))
        tree.add(value)
    return links


def _masks(bits: list[int]) -> list[int]:
    """Two of four equal blocks of some bits, in all six ways."""
    size = len(bits) // 4
    blocks = [bits[n * size:(n + 1) * size] for n in range(4)]
    return [sum(1 << bit for block in pair for bit in block) for pair in combinations(blocks, 2)]


def _free(mask: int) -> list[int]:
    return [bit for bit in range(64) if not mask >> bit & 1]


def _signed(number: int) -> Column:
    return F.lit(number - (1 << 64) if number >> 63 else number).cast("long")


def _levels() -> list[dict[int, list[int]]]:
    """For each cut the masks that a shard's mask is refined to; the first one starts from no mask."""
    levels, masks = [], [0]
    for _ in range(3):
        levels.append({mask: [mask | more for more in _masks(_free(mask))] for mask in masks})
        masks = sorted({child for children in levels[-1].values() for child in children})
    return levels


def _dealt(nodes: DataFrame, level: dict[int, list[int]]) -> DataFrame:
    """(fp, mask, bits) of all shards a node goes to."""
    ways = {mask: F.array(*map(_signed, children)) for mask, children in level.items()}
    if "mask" not in nodes.columns:
        choices = ways[0]
    else:
        choices = F.element_at(F.create_map(*[part for mask, way in ways.items() for part in (_signed(mask), way)]), F.col("mask"))
    dealt = nodes.select("fp", F.explode(choices).alias("mask")).distinct() if "mask" in nodes.columns \
        else nodes.select("fp", F.explode(choices).alias("mask"))
    return dealt.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))


def shards(nodes: DataFrame, scratch: Scratch, tree: int = TREE) -> DataFrame:
    """(fp, mask, bits): nodes in shards of two to ``tree`` nodes, those within the radius together in one at least."""
    placed, levels = None, _levels()
    for step, level in enumerate(levels):
        dealt = _dealt(nodes, level)
        sizes = scratch.cut(dealt.groupBy("mask", "bits").agg(F.count("*").alias("many")).where("many > 1"))
        # both sides are plain rows, so that the engine can split a hot shard
        dealt = scratch.cut(dealt.join(sizes, ["mask", "bits"]).select("fp", "mask", "bits", "many"))
        last = step == len(levels) - 1
        fits = dealt if last else dealt.where(F.col("many") <= tree)
        placed = fits if placed is None else placed.union(fits)
        nodes = dealt.where(F.col("many") > tree).select("fp", "mask")
        if last or nodes.isEmpty():
            return placed.drop("many")


def links(placed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links of all shards, found in the shard's tree."""
    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            found = []
            values = np.asarray(batch.column("fp")).view(np.uint64).tolist()
            for key, value in zip(zip(batch.column("mask").to_pylist(), batch.column("bits").to_pylist()), values):
                if key != shard:
                    found += tree_links(held, radius)
                    shard, held = key, []
                held.append(value)
            yield pairs(found)
        yield pairs(tree_links(held, radius))

    return placed.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp") \
        .mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", column: str = "text", tree: int = TREE) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, fingerprint, component_id)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.cut(with_fingerprints(docs, doc_id, column))
    nodes = scratch.cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = scratch.cut(links(shards(nodes.select("fp"), scratch, tree)))
    groups = scratch.cut(connected(found, scratch, "groups"))
    nodes = scratch.cut(nodes.join(groups.withColumnRenamed("cls", "fp"), "fp", "left")
                        .select("fp", "first_id", F.coalesce("grp", "fp").alias("grp")))
    least = scratch.cut(nodes.groupBy("grp").agg(F.min("first_id").alias("component_id")))
    of = scratch.cut(nodes.join(least, "grp").select("fp", "component_id"))
    return marked.join(of, "fp").select(F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")
