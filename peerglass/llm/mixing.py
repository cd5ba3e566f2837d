"""Mix sources to target weights by entropy balancing.

Every document gets a rate: how often the mix takes it.  The rates that meet each source's token target and are closest
to one copy each, in relative entropy, are exponential in the document's size, with one multiplier for each source.
The multipliers solve the convex dual by Newton steps over all sources at once; what a step needs of the documents is
one count for each source and size, so a source of any length is summed up before it is shuffled.  Rates stop at
``most`` copies.  They are then rounded to whole copies: the fraction decides by a fixed hash, in order of
hash over fraction, up to the words that the source still needs, so its total is off by half a document at most.

Everything is built-in functions.  Multipliers, targets and bucket sums are tables of one row for each source
or bucket.  The order inside a source is needed in one narrow bucket only.

Defined cases: null or blank text has size 0 and is never taken; a null source is a source of its own, last in order; equal
rows each get a row, those with equal id and text share their hash and are taken in any order, alike in all columns; an
empty table gives an empty result; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerglass.llm import text as tx
from peerglass.llm.scratch import Scratch

WEIGHTS = [5, 2, 1]
STEPS = 25
#: So many sources at most are broadcast: one row of numbers for each.
FEW_SOURCES = 10_000


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, total, target) from rows of (source, size, n), a table of one row for each source.

    Weights repeat over the sources in code-point order, null last.  Sources at their limit leave the rest to
    the others by weight; the common level is the one at which the targets add up.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weighted = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), place))
    # Ascending limit for each unit of weight: those before the level are full.
    ratio = F.col("total") * most / F.col("weight")
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    levels = weighted.withColumn("ratio", ratio) \
        .withColumn("full", F.sum(F.col("total") * most).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("budget", F.sum("total").over(Window.partitionBy()) * share) \
        .withColumn("turn", F.row_number().over(by_ratio))
    level = (F.col("budget") - F.coalesce("full", F.lit(0.0))) / F.col("left")
    # The level holds at the first source that it does not fill.
    holds = F.when(level <= F.col("ratio"), F.struct("turn", level.alias("level")))
    return levels.withColumn("level", F.min(holds).over(Window.partitionBy())["level"]).select(
        "source", "total", F.least(F.col("total") * most, F.col("level") * F.col("weight")).alias("target"))


def _rate(size: Column, mean: Column, tilt: Column, most: float) -> Column:
    return F.least(F.exp(F.least(tilt * size / mean, F.lit(50.0))), F.lit(most))


def balance(sizes: DataFrame, targets: DataFrame, scratch: Scratch, most: float = 2.0, near: float = 1e-6) -> DataFrame:
    """(source, total, target, mean, tilt): the multiplier of each source, by damped Newton steps on the dual.

    A step sums rates and their derivative over the counts of (source, size).  Where a step leaves the
    interval that must hold the solution, the middle of the interval is taken.  It ends when all sources meet their
    target to ``near``, or after ``STEPS`` steps.
    """
    size = F.col("size").cast("double")
    used = sizes.where("size > 0")
    means = used.groupBy(F.col("source").alias("m_source")).agg(
        (F.sum(size * F.col("n")) / F.sum("n")).alias("mean"), F.min(size).alias("least"))
    state = targets.where("total > 0").join(means, F.col("source").eqNullSafe(F.col("m_source"))).drop("m_source")
    # At the upper end the smallest document is at its limit as well.
    state = state.withColumn("low", F.lit(-60.0) * F.col("mean") / F.col("least")) \
        .withColumn("high", F.log(F.lit(most)) * F.col("mean") / F.col("least")) \
        .withColumn("off", F.lit(0.0)) \
        .withColumn("tilt", F.greatest("low", F.least("high", F.log(F.col("target") / F.col("total")))))
    state = scratch.cut(state, "balance")
    for _ in range(STEPS):
        known = state.withColumnRenamed("source", "s_source")
        rows = used.join(known, F.col("source").eqNullSafe(F.col("s_source")))
        rate = _rate(size, F.col("mean"), F.col("tilt"), most)
        words = size * F.col("n") * rate
        slope = F.when(rate < most, words * size / F.col("mean")).otherwise(0.0)
        sums = rows.select("s_source", words.alias("words"), slope.alias("slope")).groupBy("s_source") \
            .agg(F.sum("words").alias("words"), F.sum("slope").alias("slope"))
        step = state.join(sums, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
        excess = F.col("words") - F.col("target")
        step = step.withColumn("off", F.abs(excess) / F.col("target")) \
            .withColumn("low", F.when(excess < 0, F.col("tilt")).otherwise(F.col("low"))) \
            .withColumn("high", F.when(excess > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - F.when(F.col("slope") > 0, excess / F.col("slope"))
        middle = (F.col("low") + F.col("high")) / 2
        moved = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(middle)
        step = step.withColumn("tilt", F.when(F.col("off") <= near, F.col("tilt")).otherwise(moved))
        state = scratch.cut(step.select(*state.columns), "balance")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= near:
            break
    return state.select("source", "total", "target", "mean", "tilt")


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, keep: list[str] | None = None) -> DataFrame:
    """Adds size, source_size, target, rate, copies and taken (copies times size) to all documents.

    ``keep``: the columns to return with them, all unless given.  Where there are at most ``FEW_SOURCES`` sources, what is known of
    them is broadcast and documents are not shuffled; otherwise they are joined by source.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    keep = docs.columns if keep is None else keep
    sized = docs.select(F.struct(*keep).alias("_row"), "doc_id", "text", "source") \
        .withColumn("size", F.regexp_count(tx.whole(F.col("text")), F.lit(tx.WORD)).cast("long")) \
        .withColumn("_key", F.xxhash64(F.col("doc_id"), tx.whole(F.col("text"))))
    narrow = scratch.cut(sized.select("source", "size", "_key"))
    sizes = scratch.cut(narrow.groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = scratch.cut(source_targets(sizes, share, most))
    few = targets.count() <= FEW_SOURCES
    small = F.broadcast if few else (lambda frame: frame)
    tilts = balance(sizes, targets, scratch, most).select(F.col("source").alias("t_source"), "mean", "tilt")
    known = targets.join(tilts, F.col("source").eqNullSafe(F.col("t_source")), "left") \
        .select(F.col("source").alias("k_source"), F.col("total").alias("source_size"), F.col("target").alias("target"), "mean", "tilt")

    def rated(frame: DataFrame) -> DataFrame:
        rate = F.when(F.col("size") > 0, _rate(F.col("size").cast("double"), F.col("mean"), F.col("tilt"), most)).otherwise(0.0)
        out = frame.join(small(known), frame["source"].eqNullSafe(known["k_source"])).drop("k_source") \
            .withColumn("rate", F.least(F.coalesce(rate, F.lit(0.0)), F.lit(most)))
        out = out.withColumn("_whole", F.floor("rate")).withColumn("_part", F.col("rate") - F.col("_whole"))
        uniform = F.greatest(tx.chance(F.col("_key"), "copy"), F.lit(1e-12))
        # Order of taking: small hash over large fraction first.  The bucket is its logarithm.
        return out.withColumn("_order", F.when(F.col("_part") > 0, uniform / F.col("_part"))) \
            .withColumn("_bucket", F.floor(F.log2("_order") * 64))

    open_rows = rated(narrow).where("size > 0")
    buckets = open_rows.groupBy("source", "_bucket").agg(
        F.sum(F.when(F.col("_bucket").isNotNull(), F.col("size")).otherwise(0)).alias("words"),
        F.sum(F.col("_whole") * F.col("size")).alias("sure"), F.first("target").alias("target"))
    each = Window.partitionBy("source")
    upto = each.orderBy(F.col("_bucket").asc_nulls_first())
    buckets = buckets.withColumn("need", F.col("target") - F.sum("sure").over(each)) \
        .withColumn("before", F.sum("words").over(upto) - F.col("words")).where(F.col("_bucket").isNotNull())
    edge = buckets.where((F.col("before") < F.col("need")) & (F.col("before") + F.col("words") >= F.col("need"))) \
        .select(F.col("source").alias("e_source"), F.col("_bucket").alias("e_bucket"), F.col("need") - F.col("before"))
    edge = scratch.cut(edge.toDF("e_source", "e_bucket", "e_need"))
    inside = open_rows.join(edge, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("_bucket") == F.col("e_bucket")))
    in_order = Window.partitionBy("source", "_bucket").orderBy("_order", "_key")
    # the last document taken is the one whose middle lies before the need; equal keys are taken together
    last = inside.withColumn("_run", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))) \
        .where(F.col("_run") - F.col("size") / 2 <= F.col("e_need"))
    last = last.groupBy("source", "_bucket").agg(F.max(F.struct("_order", "_key")).alias("last"))
    # a source is cut at (order, key); without an edge all or nothing of its fractions is needed
    cuts = buckets.groupBy("source").agg(F.first("need").alias("need"), F.sum("words").alias("words")).join(
        edge, F.col("source").eqNullSafe(F.col("e_source")), "left").drop("e_source", "e_need").join(
        last.withColumnRenamed("source", "l_source").drop("_bucket"), F.col("source").eqNullSafe(F.col("l_source")), "left")
    cuts = scratch.cut(cuts.select(
        F.col("source").alias("c_source"), "e_bucket", F.col("last._order").alias("last_order"), F.col("last._key").alias("last_key"),
        ((F.col("need") > 0) & (F.col("words") < F.col("need"))).alias("c_all")))

    out = rated(sized)
    out = out.join(small(cuts), out["source"].eqNullSafe(cuts["c_source"]), "left")
    early = (F.col("_bucket") < F.col("e_bucket")) | ((F.col("_bucket") == F.col("e_bucket")) & (
        (F.col("_order") < F.col("last_order")) | ((F.col("_order") == F.col("last_order")) & (F.col("_key") <= F.col("last_key")))))
    more = F.col("_part").isNotNull() & (F.col("_part") > 0) & F.coalesce(F.col("c_all") | early, F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("_whole") + more.cast("long")).otherwise(0).cast("long")
    made = ["size", "source_size", "target", "rate", "copies", "taken"]
    kept = [F.col("_row")[name].alias(name) for name in keep if name not in made]
    return out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(*kept, *made)


def repeat(docs: DataFrame) -> DataFrame:
    """The mixed documents: each as often as the mix takes it, with the columns it had."""
    mixed = mix(docs.select("doc_id", "text", "source", F.struct("*").alias("_given")))
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").select("_given", times).select("_given.*")
