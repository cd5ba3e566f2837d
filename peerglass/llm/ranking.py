"""Ranked lexical search by presence masks.

One pass over the documents counts the terms of all texts and keeps, for each document, the terms that some item asks
for.  From that written table come the weights, and then the search itself, again in one pass: in a block of documents every
term has a bitmap of the documents that hold it.  Turned round, an item's bitmaps give each document a mask of the item's
terms that it holds, and documents of one mask are one group.  The most that a mask can score is the sum of the largest parts
its terms reach in the block.  Groups are scored in the order of that bound and the search ends when the bound falls
below the tenth score so far, which a task carries on from block to block.  Nothing that could be among the ten is skipped.

A task returns ten documents for an item at most; the ten best of those are found in two steps, so that no task gathers an item's
rows from all others.  Items are taken in turns of about ``ASKED`` terms: only their terms travel to the tasks, however many
items there are.

Defined cases: null text has no terms, in documents and items; rows of one item id are one item with the terms of all, null being an
id too; repeated documents are ranked each; of equal scores the smaller id comes first, a null id last; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerglass.llm import text as tx
from peerglass.llm.scratch import Scratch

TOP, ASKED, BLOCK, BUCKETS = 10, 200_000, 4096, 64
_WORDS = pa.binary()


def _fold() -> bytes:
    """Capitals lowered, and every ASCII character that is no letter or digit a space."""
    return bytes(c + 0x20 if chr(c) in tx.UPPER else c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))


def with_terms(docs: DataFrame, doc_id: str, column: str, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts): all terms of a text counted, and those of the vocabulary by their place in it."""
    fold = _fold()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, _WORDS)
        for batch in batches:
            sizes, owner, place, many = [], [], [], []
            for row, value in enumerate(batch.column(1).cast(pa.large_binary())):
                words = (value.as_py() or b"").translate(fold).split()
                sizes.append(len(words))
                found = np.asarray(pc.index_in(pa.array(words, _WORDS), value_set=known).drop_null())
                terms, counts = np.unique(found, return_counts=True)
                owner.append(len(terms))
                place.append(terms)
                many.append(counts)
            bounds = np.concatenate([[0], np.cumsum(owner)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([*part, np.zeros(0, np.int32)]).astype(np.int32)))
                     for part in (place, many)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(column).alias("text"))
    made = T.StructType.fromDDL("n bigint, terms array<int>, counts array<int>")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *made.fields]))


class Block:
    """The postings of some documents: by document, and as one bitmap for each term."""

    def __init__(self, sizes: np.ndarray, owner: np.ndarray, term: np.ndarray, part: np.ndarray) -> None:
        """``sizes``: postings of each document; owner, term and part of the score by posting, in order of documents."""
        self.count, self.term, self.part = len(sizes), term, part
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        order = np.argsort(term, kind="stable")
        self.held, firsts = np.unique(term[order], return_index=True)
        self.most = np.maximum.reduceat(part[order], firsts) if len(order) else np.zeros(0, np.int64)
        width = -(-self.count // 8)
        spot = np.repeat(np.arange(len(self.held)), np.diff(np.append(firsts, len(order)))) * width + owner[order] // 8
        bit = (128 >> (owner[order] % 8)).astype(np.uint8)
        self.bitmaps = np.zeros(len(self.held) * width, np.uint8)
        if len(order):
            spots, begins = np.unique(spot, return_index=True)
            self.bitmaps[spots] = np.bitwise_or.reduceat(bit, begins)
        self.bitmaps = self.bitmaps.reshape(-1, width)

    def masks(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bound of each mask, mask of each document) for the terms of an item."""
        rows = np.flatnonzero(np.isin(self.held, asked, assume_unique=True))
        bits = np.unpackbits(self.bitmaps[rows], axis=1, count=self.count)
        code = np.zeros(self.count, np.int64)
        for first in range(0, len(rows), 32):
            some = bits[first:first + 32]
            packed = np.zeros((self.count, 4), np.uint8)
            packed[:, :-(-len(some) // 8)] = np.packbits(some, axis=0).T
            _, number = np.unique(packed.view(np.uint32)[:, 0], return_inverse=True)
            _, code = np.unique(code * (int(number.max()) + 1) + number, return_inverse=True)
        _, example = np.unique(code, return_index=True)
        return self.most[rows] @ bits[:, example].astype(np.int64), code

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of some documents; ``wanted`` marks the terms of the item."""
        sizes = self.stops[docs] - self.starts[docs]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[docs] - (ends - sizes), sizes)
        running = np.concatenate([[0], np.cumsum(np.where(wanted[self.term[at]], self.part[at], 0))])
        return running[ends] - running[ends - sizes]


def _key(doc: object) -> tuple:
    return doc is None, doc if doc is not None else 0


def best_of(block: Block, ids: list, asked: np.ndarray, wanted: np.ndarray, kept: list[tuple], top: int = TOP) -> list[tuple]:
    """The best (-score, key of id, id) of the documents of a block and those kept from blocks before."""
    bound, code = block.masks(asked)
    by_bound = np.argsort(-bound, kind="stable")
    place = np.empty_like(by_bound)
    place[by_bound] = np.arange(len(by_bound))
    docs = np.argsort(place[code], kind="stable")
    bounds = bound[code[docs]]
    at, step = 0, 4 * top
    while at < len(docs):
        least = -kept[-1][0] if len(kept) == top else 1
        open_ = int(np.searchsorted(-bounds, -least, side="right"))  # equal scores may have smaller ids
        if at >= open_:
            break
        some = docs[at:min(at + step, open_)]
        found = block.scores(some, wanted)
        good = np.flatnonzero(found >= least)
        if len(good) > top:  # those below the tenth of this step can't be among the ten
            good = good[found[good] >= -np.partition(-found[good], top - 1)[top - 1]]
        kept = heapq.nsmallest(top, kept + [(-int(found[i]), _key(ids[some[i]]), ids[some[i]]) for i in good], key=lambda r: r[:2])
        at, step = at + len(some), 4 * step
    return kept


def _search(table: DataFrame, items: list[tuple], weights: np.ndarray, documents: int, words: int, id_field: T.StructField) -> DataFrame:
    """(item_id, doc_id, score): for every task and item the best documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple]] = [[] for _ in items]
        asked = [np.array(terms) for _, terms in items]
        wanted = np.zeros(len(weights), bool)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                terms, counts = part.column("terms"), part.column("counts")
                sizes = np.asarray(pc.list_value_length(terms)).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                m = 100 - 90 + 90 * np.asarray(part.column("n")) * documents // max(words, 1)
                term, tf = np.asarray(terms.flatten()), np.asarray(counts.flatten()).astype(np.int64)
                block = Block(sizes, owner, term, weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner])))
                ids = part.column("doc_id").to_pylist()
                for n, own in enumerate(asked):
                    wanted[own] = True
                    kept[n] = best_of(block, ids, own, wanted, kept[n])
                    wanted[own] = False
        rows = [(n, r) for n, own in enumerate(kept) for r in own]
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array([n for n, _ in rows], pa.int32()), pa.array([r[2] for _, r in rows], kind),
                pa.array([-r[0] for _, r in rows], pa.int64())], names=["item", "doc_id", "score"])

    found = table.mapInArrow(run, T.StructType([T.StructField("item", T.IntegerType()), table.schema["doc_id"],
                                                T.StructField("score", T.LongType())]))
    names = table.sparkSession.createDataFrame([(n, item) for n, (item, _) in enumerate(items)],
                                               T.StructType([T.StructField("item", T.IntegerType()), id_field]))
    return found.join(names, "item").drop("item")


def _first(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


def rank(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", column: str = "text",
         asked: int = ASKED) -> DataFrame:
    """(item_id, rank, doc_id, score): the ten best documents of each item."""
    scratch = Scratch(docs.sparkSession, "ranking")
    terms = scratch.cut(items.select(F.col(item_id).alias("item_id"), F.explode(F.array_distinct(tx.tokens(F.col(column)))).alias("term"))
                        .distinct())
    turns = max(1, math.ceil(terms.count() / asked))
    results = []
    for turn in range(turns):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(turns)) == turn).collect()  # about ``asked`` rows
        vocabulary = sorted({r.term.encode() for r in own})
        place = {word: n for n, word in enumerate(vocabulary)}
        wants: dict = {}
        for r in own:
            wants.setdefault(r.item_id, []).append(place[r.term.encode()])
        table = scratch.cut(with_terms(docs, doc_id, column, vocabulary))
        total = table.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        held = np.zeros(len(vocabulary), np.int64)
        for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row for a term of the turn
            held[r.term] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total.documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
        field = T.StructField("item_id", terms.schema["item_id"].dataType)
        found = _search(table, sorted(wants.items(), key=lambda w: _key(w[0])), weights, total.documents, total.words, field)
        found = _first(found.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))), ["item_id", "bucket"], TOP)
        results.append(_first(found.drop("rank", "bucket"), ["item_id"], TOP))
    return reduce(DataFrame.unionByName, results).select(
        F.col("item_id").alias(item_id), F.col("rank").cast("int"), F.col("doc_id").alias(doc_id), "score")
