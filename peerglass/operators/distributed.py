"""Building blocks that stay whole and parallel when one key holds most rows.

None of them sends a whole group to one task: groups are reduced by partial
aggregation before the shuffle, scanned range by range, or cut into parts
of a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in the given order.

    An aggregate rather than a window, so each task sends at most one row per
    key to the shuffle.  Descending order: pass negated columns.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_row"))
    return picked.select(*keys, "_row.*")


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  rank: str = "rank") -> DataFrame:
    """First k rows of each key with their place.

    Catalyst turns the bounded row number into a group limit that runs before
    the shuffle as well, so each task sends at most k rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def split_hot_keys(rows: DataFrame, sizes: DataFrame, key: str | Sequence[str], size: str, *, by: Sequence[str] | None = None,
                   rows_per_task: int = 1_000_000) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Prepare a join of rows with tables of facts by key, hot keys split.

    A key with more than ``rows_per_task`` rows spreads them over as many salts
    as it holds such portions, however many keys do.  Returns the rows with a
    ``_salt`` column and a function that gives a table of facts the same
    salts; both are then joined on (key, _salt).  Joining on the key alone would
    leave a hot key in one task: AQE does not split a join whose other side is
    an aggregate on the same key.  The broadcast list holds at most one key for
    every ``rows_per_task`` rows of the input: a million for a million million.

    Rows are spread by the columns ``by`` (all that are no arrays or structs, unless given) and by the partition they
    come from, so rows that are equal throughout do not stay together either.
    """
    keys = [key] if isinstance(key, str) else list(key)
    plain = [c for c, kind in rows.dtypes if not kind.startswith(("array", "struct", "map", "variant"))]
    hot = sizes.filter(F.col(size) > rows_per_task).select(
        *[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)], F.ceil(F.col(size) / rows_per_task).cast("int").alias("_salts"))
    same = [F.col(k).eqNullSafe(F.col(f"_hot{i}")) for i, k in enumerate(keys)]

    def marked(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(hot), same, "left").drop(*[f"_hot{i}" for i in range(len(keys))])
        return joined.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    salt = F.pmod(F.xxhash64(*(by or plain), F.col("_from")), F.col("_salts")).cast("int")
    salted = marked(rows.withColumn("_from", F.spark_partition_id())).withColumn("_salt", salt).drop("_salts", "_from")

    def expand(facts: DataFrame) -> DataFrame:
        return marked(facts).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")

    return salted, expand


def join_split(rows: DataFrame, facts: DataFrame, key: str | Sequence[str], how: str = "inner", *, by: Sequence[str] | None = None,
               sizes: DataFrame | None = None, rows_per_task: int = 1_000_000) -> DataFrame:
    """Join of rows with facts by key, where a key may hold most of the rows.

    Two-sided: rows of a hot key are salted, its facts are repeated for every salt.  ``sizes`` has the key and ``_rows`` where
    an aggregate at hand counts them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if sizes is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    salted, expand = split_hot_keys(rows, sizes, keys, "_rows", by=by, rows_per_task=rows_per_task)
    return salted.join(expand(facts), [*keys, "_salt"], how).drop("_salt")


def dealt(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt evenly, ahead of steps that cost far more than the row is long: a small file is read by one task or a few."""
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shared(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows dealt by key, or evenly where none is given, in one exchange that all branches of a plan read.

    A row passes the exchange as one packed value, and it is unpacked by an expression that filters do not pass: whatever the
    branches need of it, the plan below is the same for all, so the engine runs it once and reuses its output.
    """
    packed = df.select(F.array(F.struct(*df.columns)).alias("_packed"))
    row = F.element_at("_packed", 1)
    spread = packed.repartition(*[row[k] for k in keys]) if keys else dealt(packed)
    return spread.select(F.when(F.spark_partition_id() >= 0, row).alias("_row")).select("_row.*")


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows dealt by range of (keys, order), with the number of their range as ``_part``.

    The ranges follow the rows: Spark takes their bounds from a sample of the sort columns, so a hot key lies in as many
    ranges as it has rows for, however its positions are spread.  Rows equal in all sort columns stay together.

    Several branches of a plan read the ranges, and they must see the same ones.  A row therefore passes the exchange as one
    packed value that no later step can narrow, ``_part`` keeps filters above it, and the number of ranges is
    fixed, so that no branch merges them.  The branches have one exchange in common.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.element_at("_packed", 1)
    packed = df.select(F.array(F.struct(*df.columns)).alias("_packed"))
    dealt = packed.repartitionByRange(parts, *[row[c] for c in [*keys, *order]])
    return dealt.select(F.spark_partition_id().alias("_part"), row.alias("_row")).select("_part", "_row.*")


def carried(ranged: DataFrame, keys: Sequence[str], tail: Column, merge: Callable[[Column], Column]) -> DataFrame:
    """(_part, keys, _carried): what the ranges before it hand on to the first key of a range.

    Only the last key of a range can go on in the next one, so a range says two things: which key it begins with, and the
    ``tail`` aggregate of the key it ends with.  ``merge`` aggregates tails of one key in order of the ranges.  The result
    has one row for a range at most, however many rows there are.
    """
    key = F.struct(*keys)
    tails = ranged.groupBy("_part", *keys).agg(tail.alias("_tail"))
    edges = tails.groupBy("_part").agg(F.min(key).alias("first"), F.max_by(F.struct(key.alias("key"), "_tail"), key).alias("last"))
    marks = edges.select("_part", F.explode(F.array(
        F.struct(F.lit(True).alias("begins"), F.col("first").alias("key"), F.lit(None).alias("_tail")),
        F.struct(F.lit(False).alias("begins"), F.col("last.key").alias("key"), F.col("last._tail").alias("_tail")),
    )).alias("_mark")).select("_part", "_mark.*")
    before = Window.partitionBy("key").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    handed = marks.withColumn("_carried", merge(F.col("_tail")).over(before)).filter("begins")
    return handed.select("_part", "key.*", "_carried")


def with_carried(ranged: DataFrame, keys: Sequence[str], handed: DataFrame) -> DataFrame:
    """Rows with ``_carried`` of their range and key, null for keys that begin inside the range."""
    names = {c: f"_key{i}" for i, c in enumerate(["_part", *keys])}
    # a row for each range at most: as many as the plan names, so it may be broadcast
    small = F.broadcast(handed.select(*[F.col(c).alias(n) for c, n in names.items()], "_carried"))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return ranged.join(small, same, "left").drop(*names.values())


def rank_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, start: int = 0,
                   parts: int | None = None) -> DataFrame:
    """Place of every row within its key, found range by range.

    A prefix scan: rows are numbered inside (range, key), and the rows of the key in earlier ranges are added.
    """
    ranged = in_ranges(df, keys, order, parts)
    handed = carried(ranged, keys, F.count(F.lit(1)), F.sum)
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    numbered = ranged.withColumn("_place", F.row_number().over(inside))
    return with_carried(numbered, keys, handed).withColumn(
        out, F.coalesce("_carried", F.lit(0)) + F.col("_place") - 1 + start).drop("_part", "_place", "_carried")


def forward_fill(df: DataFrame, keys: Sequence[str], position: str, value: str, out: str,
                 parts: int | None = None) -> DataFrame:
    """Last non-null value at or before each row, in order of a position.

    A prefix scan: rows are filled inside (range, key); a range that begins inside a key starts with the last value of the
    key in earlier ranges.
    """
    ranged = in_ranges(df, keys, [position], parts)
    tail = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(position)))
    handed = carried(ranged, keys, tail, lambda t: F.last(t, ignorenulls=True))
    inside = Window.partitionBy("_part", *keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    return with_carried(filled, keys, handed).withColumn(out, F.coalesce(out, "_carried")).drop("_part", "_carried")


def substrings(text: Column, low: int, high: Column | int) -> Column:
    """Distinct substrings of a text with lengths from low to high."""
    high = F.lit(high) if isinstance(high, int) else high

    def of_length(size: Column) -> Column:
        last = F.length(text) - size + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, size))

    lengths = F.when(high >= low, F.sequence(F.lit(low), high)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def placed_substrings(text: Column, sizes: Column) -> Column:
    """array<struct<gram, at>> of all substrings of the given sizes with their places from 0."""
    def of_size(size: Column) -> Column:
        last = F.length(text) - size
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.substring(text, i + 1, size).alias("gram"), i.alias("at")))

    return F.flatten(F.transform(sizes, of_size))


def contains_pairs(needles: DataFrame, texts: DataFrame, needle: str, text: str, gram: int = 3) -> DataFrame:
    """Distinct (needle, text) pairs where the text contains the needle.

    A positional index in place of a comparison of all pairs.  The index holds (gram, text id, place) for all pieces of up
    to ``gram`` letters and no text.  Every needle is looked up under its rarest piece; a hit says where in the text the
    needle would have to stand, and only that place is compared, with the text fetched by id.  Texts are stored once, and each
    table is read once: what later steps share lies in one exchange.  Empty needles match nothing.
    """
    wanted = shared(needles.select(needle).filter(F.length(needle) > 0).distinct(), [needle])
    held = shared(texts.select(F.xxhash64(text).alias("_id"), text).filter(F.length(text) > 0).distinct(), ["_id"])

    def pieces(df: DataFrame, column: str, keep: str, sizes: Column) -> DataFrame:
        found = df.select(keep, F.explode(placed_substrings(F.col(column), sizes)).alias("_p"))
        return found.select(keep, F.col("_p.gram").alias("_gram"), F.col("_p.at").alias("_at"))

    index = pieces(held, text, "_id", F.sequence(F.lit(1), F.lit(gram)))
    counts = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    probes = pieces(wanted, needle, needle, F.array(F.least(F.length(needle), F.lit(gram))))
    rarest = (
        probes.join(counts, "_gram", "left")
        .groupBy(needle)
        .agg(F.min_by(F.struct("_gram", "_at"), F.struct(F.coalesce("_n", F.lit(0)), "_gram", "_at")).alias("_best"))
        .select(needle, F.col("_best._gram").alias("_gram"), F.col("_best._at").alias("_lead"))
    )
    places = rarest.join(index, "_gram").select(needle, "_id", (F.col("_at") - F.col("_lead")).alias("_start"))
    found = places.filter("_start >= 0").join(held, "_id")
    stands = F.substring(F.col(text), F.col("_start") + 1, F.length(needle)) == F.col(needle)
    return found.filter(stands).select(needle, text).distinct()


def text_parts(df: DataFrame, keys: Sequence[str], position: str, text: str, out: str,
               per_part: int = 256, separator: str = "") -> DataFrame:
    """Texts of each key joined in order, cut into numbered parts.

    A part joins the texts of ``per_part`` consecutive positions, so no row
    grows with the group; read in order of ``part_no`` the parts are the whole.
    """
    part = F.floor(F.col(position) / per_part).alias("part_no")
    grouped = df.groupBy(*keys, part).agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("s")))).alias("_items")
    )
    joined = F.array_join(F.transform("_items", lambda item: item["s"]), separator)
    return grouped.select(*keys, "part_no", F.size("_items").cast("bigint").alias("n_items"), joined.alias(out))
