"""Similarity join of shingle sets over prefix trees, and the groups that its links make.

A document's set holds the hashes of its five-word runs.  Equal sets are one class, so copies are never compared.  The
sets are put in a global order and stored in trees; a set's first shingle, and its first one in a second order, name its branch
of the tree, and only sets of one branch meet.  Two sets of similarity J have the same first shingles with probability J * J under
random orders, so the join repeats over ``ORDERS`` trees of two independent orders each.  Sets that link meet in one branch at least,
but for a probability of 3e-12 at the threshold of 0.75 (no hit of 32), so a set alone in all its branches is left out.  By one
shingle alone, sets that have just common runs of words would meet, the more of them the larger the table; by two they seldom do.

Inside a branch, a tree is walked once for all sets together: the overlaps with the path so far are shared by
everything below, and a set leaves a subtree as soon as what remains of either cannot reach the threshold.  Sets that
are linked already are not compared again, so a branch of near copies costs about as much as one walk of one of them.

Spark deals the work out.  Sets that hang together by branches are a family; one of at most ``BLOCK`` sets is one tree, and each set is
shipped once.  What is shipped more often goes in turns, each of about ``SHIPPED`` times the shingles of all sets, so the disk that it
takes follows the sets and not the number of meetings.  The branches of larger families are walked one by one, those with sets of different groups only.  A branch
beyond ``BLOCK`` sets is dealt out in blocks at first, which all share some sets.  Later the sets that hang together by such branches
are a pool: two of them meet once in it and not in every branch they share.  A pool is dealt into blocks by size, of ``BLOCK`` sets or
less where they are long, and only blocks meet whose sizes allow a link.  That is exact, and a walk's memory is bounded; the number
of meetings still grows with the square of the sets of like size in a pool.  Groups are connected components, found by joins on
(class, class) rows.

Defined cases: texts without words or null have an empty set and no link; with fewer than five words all words are the one
shingle; repeated rows are equal sets; a null id is kept as a row, and is not a group's smallest id unless alone; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerglass.llm import wordhash
from peerglass.llm.scratch import Scratch

SHINGLE, ORDERS, BLOCK, SHARED = 5, 32, 1500, 24
#: How many times the shingles of all sets travel in one turn.
SHIPPED = 2
#: A set of so many shingles counts as one more set of its block.
LONG = 1000
#: Sets of long texts are large, so few of them travel in one Arrow batch.
ROWS_A_BATCH = "1000"


def _sets(batch_text: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For pieces of a batch: its first row, and the sorted set of each row."""
    for first, _, data, bounds in wordhash.chunks(batch_text):
        texts = wordhash.Texts(data, bounds, lower=True)
        place, gram = texts.grams(SHINGLE)
        doc = texts.doc[place]
        # texts of one to four words: all of them as one shingle
        begins = np.cumsum(texts.words) - texts.words
        for count in range(1, SHINGLE):
            rows = np.flatnonzero(texts.words == count)
            with np.errstate(over="ignore"):
                whole = np.full(len(rows), count, np.uint64)
                for n, factor in enumerate(wordhash.scramble(np.arange(2000, 2000 + count)) | np.uint64(1)):
                    whole += texts.hash[begins[rows] + n] * factor
            doc, gram = np.concatenate([doc, rows]), np.concatenate([gram, wordhash.scramble(whole)])
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        doc, gram = doc[fresh], gram[fresh]
        cuts = np.searchsorted(doc, np.arange(texts.count + 1))
        yield first, [gram[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _reordered(gram: np.ndarray, order: int) -> np.ndarray:
    """The place of shingles in one of the global orders."""
    with np.errstate(over="ignore"):
        x = (gram ^ _SEEDS[order]) * np.uint64(0x9FB21C651E98DF25)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


_SEEDS = wordhash.scramble(np.arange(5000, 5000 + 64))


def with_sets(docs: DataFrame, ids: list[str], column: str = "text", full: bool = False) -> DataFrame:
    """(ids, n, cls, roots) of each row: the set's size, its digest, and the name of its branch in every tree.

    With ``full`` it is (ids, n, cls, grams) instead, the set as sorted 64-bit numbers.
    """
    long, fields = T.LongType(), docs.select(*ids).schema.fields
    made = {"n": long, "cls": long, **({"grams": T.BinaryType()} if full else {"roots": T.ArrayType(long)})}
    schema = T.StructType([*fields, *[T.StructField(name, kind) for name, kind in made.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column("_read")):
                kept = [batch.column(c).slice(first, len(sets)) for c in ids]
                sizes = np.array([len(s) for s in sets], np.int64)
                filled = np.flatnonzero(sizes)
                digest = np.zeros(len(sets), np.uint64)
                roots = np.zeros((len(sets), ORDERS), np.uint64)
                if len(filled):
                    flat = np.concatenate([sets[i] for i in filled])
                    cuts = np.cumsum(sizes[filled]) - sizes[filled]
                    with np.errstate(over="ignore"):
                        digest[filled] = wordhash.scramble(np.add.reduceat(wordhash.scramble(flat ^ np.uint64(77)), cuts)
                                                           + sizes[filled].astype(np.uint64))
                    for tree in range(0 if full else ORDERS):
                        first_of = [np.minimum.reduceat(_reordered(flat, order), cuts) for order in (tree, ORDERS + tree)]
                        with np.errstate(over="ignore"):
                            roots[filled, tree] = wordhash.scramble(wordhash.scramble(first_of[0]) + first_of[1])
                digest = pa.array(digest.view(np.int64))
                if full:
                    columns = [pa.array(sizes), digest, pa.array([s.tobytes() for s in sets], pa.binary())]
                else:
                    lists = pa.ListArray.from_arrays(np.arange(0, ORDERS * (len(sets) + 1), ORDERS, dtype=np.int32),
                                                     pa.array(roots.view(np.int64).ravel()))
                    columns = [pa.array(sizes), digest, lists]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*ids, *made])

    return docs.select(*ids, F.col(column).alias("_read")).mapInArrow(run, schema)


class _Groups:
    """Disjoint sets over small numbers."""

    def __init__(self, start: np.ndarray) -> None:
        self.of = start.copy()

    def join(self, a: int, b: int) -> None:
        low, high = sorted((self.of[a], self.of[b]))
        self.of[self.of == high] = low


def tree_links(sets: list[np.ndarray], groups: np.ndarray, share: float = 0.75, step: int = 32,
               sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that join sets of different groups; together with the groups they connect all similar sets.

    With ``sides`` only sets of different sides are compared.

    ``sets`` are arrays in one global order.  The tree is the sorted list of sets: neighbours share a path as far as
    their arrays agree, and the overlaps counted along it are kept on a stack, at every ``step``-th shingle.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(count), sizes)[order]
    names, begins = np.unique(flat[order], return_index=True)
    stops = np.append(begins[1:], len(flat))
    coded = np.searchsorted(names, flat)
    cuts = np.append(0, np.cumsum(sizes))
    rows = [coded[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    walk = sorted(range(count), key=lambda i: rows[i].tolist())
    merged = _Groups(groups)
    links: list[tuple[int, int]] = []
    stack: list[np.ndarray] = [np.zeros(count, np.int64)]  # overlaps with the first 0, step, 2 step ... shingles of the path
    last = np.zeros(0, np.int64)
    ahead = np.ones(count, bool)
    for i in walk:
        ahead[i] = False  # pairs with sets walked before are settled
        path = rows[i]
        short = min(len(path), len(last))
        differs = np.flatnonzero(path[:short] != last[:short])
        common = int(differs[0]) if len(differs) else short
        del stack[common // step + 1:]
        overlap, at, size = stack[-1].copy(), (len(stack) - 1) * step, len(path)
        # J >= share  <=>  overlap >= share / (1 + share) * (sizes together)
        need = np.ceil(share / (1 + share) * (sizes + size) - 1e-9)
        alive = ahead & (merged.of != merged.of[i])
        if sides is not None:
            alive &= sides != sides[i]
        alive &= (overlap + (size - at) >= need) & (np.minimum(sizes, size) >= need)
        while at < size and alive.any():
            part = path[at:at + step]
            runs = stops[part] - begins[part]
            spots = np.arange(int(runs.sum())) + np.repeat(begins[part] - (np.cumsum(runs) - runs), runs)
            overlap += np.bincount(owner[spots], minlength=count)
            at += len(part)
            if len(part) == step:
                stack.append(overlap.copy())
            alive &= overlap + (size - at) >= need
        last = path[:at]
        if at == size:
            for j in np.flatnonzero(alive & (overlap >= need)):
                if merged.of[i] != merged.of[j] and (1 + share) * overlap[j] >= share * (size + sizes[j]):
                    links.append((i, int(j)))
                    merged.join(i, int(j))
    return links


def _branch_links(share: float):
    """Links inside the branches of a partition, whose rows come sorted by branch: groups that a branch joins, to the smallest of them."""
    def links(branch: tuple, rows: list[dict]) -> list[tuple[int, int]]:
        order = branch[0]
        rows = list({row["cls"]: row for row in rows}.values())
        sets = [np.sort(_reordered(np.frombuffer(row["grams"], np.uint64), order)) for row in rows]
        names, groups = np.unique([row["grp"] for row in rows], return_inverse=True)
        if len(sets) < 2 or not groups.any():
            return []
        sides = np.array([row["side"] for row in rows])
        merged = _Groups(groups)
        for i, j in tree_links(sets, groups, share, sides=sides if sides.any() else None):
            merged.join(i, j)
        moved = np.unique(np.stack([groups, merged.of])[:, groups != merged.of], axis=1)
        return list(zip(*names[moved].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch, held = None, []
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if (row["tree"], row["root"], row["block"]) != branch:
                    if held:
                        found += links(branch, held)
                    branch, held = (row["tree"], row["root"], row["block"]), []
                held.append(row)
            yield _pairs(found)
        if held:
            yield _pairs(links(branch, held))

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[n] for p in found], pa.int64()) for n in (0, 1)], names=["a", "b"])


def connected(links: DataFrame, scratch: Scratch, key: str) -> DataFrame:
    """(cls, grp) of all ends of links (a, b): grp is the smallest class that links reach.

    Large and small stars in turn: neighbours above a node are pointed at its smallest neighbour, then those below it,
    until every node has one neighbour below it or some above it.  Rows stay as many as there are links.  The smallest neighbours
    are a written table, as the engine splits the rows of a hot node only where the other side of the join is no aggregate of the same
    step.  It also tells whether all are stars, and is then the result.
    """
    edges = scratch.cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        f"{key}-first")
    turn = 0
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        below = F.count_if(F.col("v") < F.col("u"))
        low = scratch.cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                                ((below > 1) | ((below > 0) & (below < F.count("*")))).alias("open")), f"{key}-low")
        if not low.agg(F.max("open")).first()[0]:
            break
        large = scratch.cut(both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")), f"{key}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", "m")).distinct()
        edges = scratch.cut(small, f"{key}-{turn % 2}")
        turn += 1
    scratch.drop(f"{key}-first", f"{key}-large", f"{key}-0", f"{key}-1")
    return low.select(F.col("u").alias("cls"), F.col("m").alias("grp"))


def similarity_groups(docs: DataFrame, doc_id: str = "doc_id", column: str = "text", share: float = 0.75) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_shingles, component_id).

    All Arrow stages run before this returns, and the session's size of batches is then what it was.
    """
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, ROWS_A_BATCH)
    try:
        return _similarity_groups(docs, doc_id, column, share)
    finally:
        conf.set(name, before)


def _similarity_groups(docs: DataFrame, doc_id: str, column: str, share: float) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(column).alias("_text"))
    marked = scratch.cut(with_sets(rows, ["_id"], "_text"), "marked")
    classes = marked.where("n > 0").groupBy("cls").agg(F.first("roots").alias("roots"))
    members = classes.select("cls", F.posexplode("roots").alias("tree", "root"))
    crowded = members.groupBy("tree", "root").agg(F.count("*").alias("many")).where("many > 1").drop("many")
    members = scratch.cut(members.join(crowded, ["tree", "root"]), "members")
    wanted = scratch.cut(members.select("cls").distinct(), "wanted")

    # The sets of classes that may link, read again from one text of each class.
    one = marked.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("_id").alias("_pick")) \
        .withColumnRenamed("cls", "_want")
    texts = rows.join(one, F.col("_id").eqNullSafe(F.col("_pick"))).select("_want", "_text")
    sets = with_sets(texts, ["_want"], "_text", full=True).where("cls = _want").drop("_want")
    sets = scratch.cut(sets, "sets")  # an id that repeats may give a set twice; that changes no link

    groups = None
    # Families first: whatever hangs together by branches and is small is joined at once.  What is larger is joined by some trees,
    # and what they leave by all trees.
    for step, trees in enumerate((None, (0, 3), (0, ORDERS))):
        # what is settled now stays so
        members = scratch.cut(_unsettled(members, groups), "members")
        if members.isEmpty():
            break
        if trees is None:
            # one walk for each family
            families = scratch.cut(_families(members, scratch), "families")
            placed = members.select("cls", "grp").distinct().join(families.where("many <= " + str(BLOCK)), "cls") \
                .select("cls", "grp", F.lit(0).alias("tree"), F.col("family").alias("root"), F.lit(0).alias("block"), F.lit(0).alias("side"))
            members = members.join(families.where("many > " + str(BLOCK)).select("cls"), "cls", "left_semi")
            found = scratch.cut(_linked(placed, sets, share), "found")
            # a family is one walk, so what it found are stars already
            groups = found.toDF("cls", "grp").union(found.select("b", "b").distinct())
        else:
            part = members.where((F.col("tree") >= trees[0]) & (F.col("tree") < trees[1]))
            placed = scratch.cut(_opening(part) if step == 1 else _placed(part, sets, scratch, share), "placed")
            found = _linked_in_turns(placed, sets, scratch, share)
            groups = connected(groups.where("cls <> grp").toDF("a", "b").union(found), scratch, f"groups-{step}")
        members = members.drop("grp")

    if groups is None:
        groups = wanted.select("cls", F.col("cls").alias("grp"))
    ids = marked.join(groups.withColumnRenamed("cls", "g_cls"), (F.col("cls") == F.col("g_cls")) & (F.col("n") > 0), "left") \
        .select("_id", "n", F.when(F.col("n") > 0, F.coalesce("grp", "cls")).alias("grp"))
    ids = scratch.cut(ids, "ids")
    # the result reads the ids alone, for as long as it is used
    scratch.drop(*[key for key in scratch.written if key != "ids"])
    least = ids.where("grp is not null").groupBy("grp").agg(F.min("_id").alias("component_id")).withColumnRenamed("grp", "c_grp")
    return ids.join(least, F.col("grp") == F.col("c_grp"), "left").select(
        F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"))


def _unsettled(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Members with their groups, of branches with more than one group."""
    if groups is None:
        members = members.withColumn("grp", F.col("cls"))
    else:
        members = members.join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    mixed = members.groupBy("tree", "root").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low <> high")
    return members.join(mixed.select("tree", "root"), ["tree", "root"])


def _families(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, family, many): what hangs together by sharing branches, each set once, with the family's size."""
    first = members.groupBy("tree", "root").agg(F.min("cls").alias("b"))
    families = connected(members.join(first, ["tree", "root"]).select(F.col("cls").alias("a"), "b"), scratch, "family") \
        .withColumnRenamed("grp", "family")
    return families.join(families.groupBy("family").agg(F.count("*").alias("many")), "family").select("cls", "family", "many")


def _with_totals(members: DataFrame) -> DataFrame:
    """Members of branches with more than one group, with the branch's number of sets."""
    totals = members.groupBy("tree", "root").agg(F.count("*").alias("total"), F.min("grp").alias("low"), F.max("grp").alias("high"))
    return members.join(totals.where("low <> high").select("tree", "root", "total"), ["tree", "root"])


def _opening(members: DataFrame) -> DataFrame:
    """Members with the blocks of their branches that they visit; some sets are shared by all blocks."""
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls", F.lit("block")), blocks).cast("int")
    visits = F.when(F.pmod(F.xxhash64("cls"), F.col("total")) < SHARED, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    return _with_totals(members).select("cls", "tree", "root", "grp", F.explode(visits).alias("block"), F.lit(0).alias("side"))


def _placed(members: DataFrame, sets: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """Members with the branches, or the meetings of their pool, in which they are compared with all that may link with them."""
    members = _with_totals(members)
    placed = members.where(F.col("total") <= BLOCK).select("cls", "tree", "root", "grp", F.lit(0).alias("block"), F.lit(0).alias("side"))
    crowd = scratch.cut(members.where(F.col("total") > BLOCK), "crowd")
    return placed if crowd.isEmpty() else placed.unionByName(_pools(crowd, sets, scratch, share))


def _pools(crowd: DataFrame, sets: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """Members of crowded branches with the meetings of their pool's blocks; in a meeting of two blocks each is a side."""
    pooled = _families(crowd, scratch).join(crowd.select("cls", "grp").distinct(), "cls") \
        .join(sets.select("cls", "n").distinct(), "cls") \
        .select("cls", "grp", "family", "n")
    # blocks in order of size, without sorting sets: a set's place follows from how many are of which size
    sizes = pooled.groupBy("family", "n").agg(F.count("*").alias("many")).withColumn("weight", 1 + F.col("n") / LONG)
    before = F.sum(F.col("many") * F.col("weight")).over(Window.partitionBy("family").orderBy("n")) - F.col("many") * F.col("weight")
    place = F.col("before") + F.pmod(F.xxhash64("cls", F.lit("block")), F.col("many")) * F.col("weight")
    dealt = scratch.cut(pooled.join(sizes.withColumn("before", before), ["family", "n"])
                        .select("cls", "grp", "family", "n", F.floor(place / BLOCK).cast("int").alias("own")), "pooled")
    blocks = dealt.groupBy("family", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    small = blocks.toDF("family", "a", "a_low", "a_high")
    large = blocks.toDF("l_family", "b", "b_low", "b_high")
    meet = (F.col("family") == F.col("l_family")) & (F.col("a") <= F.col("b")) & (F.col("a_high") >= share * F.col("b_low"))
    pairs = small.join(large, meet).select("family", "a", "b", F.xxhash64("a", "b").alias("block"))
    visits = pairs.select("family", F.col("a").alias("own"), "block", F.when(F.col("a") < F.col("b"), 1).otherwise(0).alias("side")) \
        .union(pairs.where("a < b").select("family", "b", "block", F.lit(2)))
    return dealt.join(visits, ["family", "own"]).select("cls", F.lit(0).alias("tree"), F.col("family").alias("root"), "grp", "block", "side")


def _linked(placed: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """Links (a, b) between different groups, found by one walk for each branch and block."""
    keys = ["tree", "root", "block"]
    return placed.join(sets.drop("n"), "cls").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(_branch_links(share), "a bigint, b bigint")


def _linked_in_turns(placed: DataFrame, sets: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """Links of all branches and blocks, walked in as many turns as keep what one of them ships near ``SHIPPED`` times the sets."""
    total = sets.agg(F.sum("n")).first()[0] or 1
    shipped = placed.join(sets.select("cls", "n"), "cls").agg(F.sum("n")).first()[0] or 0
    turns = max(1, math.ceil(shipped / (SHIPPED * total)))
    turn = F.pmod(F.xxhash64("tree", "root", "block", F.lit("turn")), F.lit(turns))
    found = [scratch.cut(_linked(placed.where(turn == n), sets, share), f"found-{n}") for n in range(turns)]
    return functools.reduce(DataFrame.union, found)


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, and all documents without words.

    Rows that repeat id and text are one document.
    """
    kept = similarity_groups(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    # in a struct a null equals a null, and rows dealt by it for the join lie together for the window: texts are shuffled once
    left = docs.withColumn("_at", F.struct("doc_id")).join(kept.select(F.struct("_kept").alias("_kept_at")), F.col("_at") == F.col("_kept_at"), "left_semi")
    left = left.withColumn("_text_key", F.xxhash64("text"))
    same = Window.partitionBy("_at", "_text_key").orderBy("_at")
    return left.withColumn("_place", F.row_number().over(same)).where("_place = 1").select(*docs.columns)
