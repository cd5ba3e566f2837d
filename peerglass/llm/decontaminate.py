"""Benchmark decontamination by winnowing.

Both sides keep, for every run of ``window`` words, the smallest hash of its ``gram``-word pieces.  Equal runs keep equal
hashes, so a document that shares a run with a benchmark item shares a fingerprint with it: nothing that long is missed.
Documents that share a fingerprint are extended: their runs are compared with the item's runs as a whole.  Items
shorter than ``window`` words have no full run; they are one run of their own length, looked up by its hash.

Everything is built-in functions.  Only fingerprints (two numbers) of all documents are joined; texts are read
again for the documents with a hit.  Fingerprints of common passages do not multiply: the item side holds each once.

Runs are compared by 64-bit hashes of their words: a chance hit has a probability of about 1e-19 for a pair of runs.

Defined cases: null text has no words, and no hit; items without words never occur; equal documents each get their own row;
rows are told apart by id and text, a null id is a value; repeated items count once by id; an empty table gives
no hits; other columns are kept by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass.llm import text as tx

WINDOW, GRAM = 13, 8


def _hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _low(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _pair(values: Column, shift: int, join) -> Column:
    """``join`` of each element with the one ``shift`` places on; the last ``shift`` have no partner and go."""
    size = F.greatest(F.size(values) - shift, F.lit(0))
    return F.zip_with(F.slice(values, 1, size), F.slice(values, shift + 1, size), join)


def with_windows(frame: DataFrame, column: str) -> DataFrame:
    """Adds ``_run`` (hash of every run of 13 words) and ``_low`` (the smallest 8-word hash in it), by start.

    Hashes of longer pieces come from those of shorter ones: 1, 2, 4, 8 words, then two overlapping eights.
    """
    out = frame.withColumn("_h1", F.transform(tx.tokens(F.col(column)), lambda word: F.xxhash64(word)))
    out = out.withColumn("_h2", _pair(F.col("_h1"), 1, _hash))
    out = out.withColumn("_h4", _pair(F.col("_h2"), 2, _hash))
    out = out.withColumn("_h8", _pair(F.col("_h4"), 4, _hash))
    rest = WINDOW - GRAM
    out = out.withColumn("_run", _pair(F.col("_h8"), rest, _hash))
    out = out.withColumn("_m2", _pair(F.col("_h8"), 1, _low)).withColumn("_m4", _pair(F.col("_m2"), 2, _low))
    size = F.size("_run")
    return out.withColumn("_low", F.zip_with(F.slice("_m4", F.lit(1), size), F.slice("_m2", F.lit(5), size), _low)) \
        .drop("_h1", "_h2", "_h4", "_h8", "_m2", "_m4")


def _pieces(words: Column, length: int) -> Column:
    """Hash of every run of ``length`` words, by start."""
    starts = F.sequence(F.lit(1), F.size(words) - (length - 1))
    return F.when(F.size(words) >= length, F.transform(starts, lambda i: F.xxhash64(F.lit(length), F.slice(words, i, length)))) \
        .otherwise(F.expr("cast(array() as array<bigint>)"))


def _row_key(column: str) -> Column:
    return F.xxhash64(F.col("_id"), tx.whole(F.col(column)))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", column: str = "text",
                       item_id: str = "item_id", item_text: str = "text", least_share: float = 0.05) -> DataFrame:
    """One row for each document row: ``_id``, ``_key``, n_words, n_hit, items, contaminated.

    ``_key`` is a hash of id and text, by which the rows of ``docs`` can be joined.  ``items`` are the sorted ids, as strings, of items
    with an occurring run.
    """
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(column).alias("_text")).withColumn("_key", _row_key("_text"))
    items = benchmark.select(F.col(item_id).cast("string").alias("_item"), F.col(item_text).alias("_text")) \
        .where(F.col("_text").isNotNull())

    # A condition on _run or _low, also one that Spark infers from a plain explode, would be pushed below the steps that make them and
    # hold the words some thousand times.  So it stands on the words, and what is exploded is no plain column.
    long_items = with_windows(items.where(F.size(tx.tokens(F.col("_text"))) >= WINDOW), "_text")
    lows = long_items.select(F.explode(F.array_distinct("_low")).alias("low")).distinct()
    runs = long_items.select(F.explode(F.array_distinct("_run")).alias("run"), F.lit(WINDOW).alias("length"), "_item")

    fingerprints = with_windows(docs, "_text").select("_id", "_key", F.explode(F.array_distinct("_low")).alias("low"))
    hit = fingerprints.join(lows, "low", "left_semi").select("_id", "_key").distinct()
    again = docs.join(hit, docs["_key"].eqNullSafe(hit["_key"]) & docs["_id"].eqNullSafe(hit["_id"]), "left_semi") \
        .dropDuplicates(["_id", "_key"])
    placed = F.transform("_run", lambda run, at: F.struct(at.alias("at"), run.alias("run")))
    places = with_windows(again, "_text").select("_id", "_key", F.explode(placed).alias("place")) \
        .select("_id", "_key", "place.at", "place.run").withColumn("length", F.lit(WINDOW))

    # Which lengths below a full run occur: at most twelve numbers.
    words = tx.tokens(F.col("_text"))
    short_items = items.withColumn("_words", words).withColumn("length", F.size("_words")).where(F.col("length").between(1, WINDOW - 1))
    for (length,) in sorted(short_items.select("length").distinct().collect()):
        whole = short_items.where(F.col("length") == length) \
            .select(F.xxhash64(F.lit(length), "_words").alias("run"), "length", "_item")
        runs = runs.unionByName(whole)
        seen = docs.withColumn("_words", words).select("_id", "_key", F.posexplode(_pieces(F.col("_words"), length)).alias("at", "run"))
        places = places.unionByName(seen.join(whole.select("run").distinct(), "run", "left_semi")
                                    .distinct().withColumn("length", F.lit(length)))

    occurring = runs.distinct().groupBy("run", "length").agg(F.array_sort(F.collect_set("_item")).alias("held_by"))
    found = places.join(occurring, ["run", "length"]).groupBy("_id", "_key").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("held_by")))).alias("items"))
    covered = F.aggregate(
        F.col("places"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words")),
        lambda state, place: F.struct(
            F.greatest(state["end"], place["at"] + place["length"]).alias("end"),
            (state["words"] + F.greatest(place["at"] + place["length"] - F.greatest(place["at"], state["end"]), F.lit(0)))
            .alias("words")))["words"]
    found = found.select(F.col("_id").alias("f_id"), F.col("_key").alias("f_key"), covered.alias("n_hit"), "items")

    counted = docs.select("_id", "_key", F.regexp_count(tx.whole(F.col("_text")), F.lit(tx.TOKEN)).cast("long").alias("n_words"))
    out = counted.join(found, counted["_key"].eqNullSafe(found["f_key"]) & counted["_id"].eqNullSafe(found["f_id"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "_id", "_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        ((n_hit > 0) & (n_hit >= F.col("n_words") * least_share)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that are contaminated; repeated rows share one verdict."""
    bad = find_contamination(docs, benchmark).where("contaminated").select(F.col("_id").alias("b_id"), F.col("_key").alias("b_key")).distinct()
    key = F.xxhash64(F.col("doc_id"), tx.whole(F.col("text")))
    return docs.join(bad, key.eqNullSafe(bad["b_key"]) & docs["doc_id"].eqNullSafe(bad["b_id"]), "left_anti")
