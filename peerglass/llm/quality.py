"""Quality rules with limits that follow the data.

Each document's measures come from one pass over its text.  Their spread is kept as mergeable quantile sketches, one for
each language, source and measure: counts of values in logarithmic buckets, exact to 2 % of the value.  Sketches of
a language, and of all rows, are sums of the finer ones.  A document is rejected where a measure lies far outside
its group's middle half; quantiles of a group lean on those of the next wider one, the less the more rows it has.  Shares are 0 in most texts, which leaves no
middle half to go by, so a share is too much only beyond its group's tail as well: the hundredth of the group's rows that
have most of it, and the tenth of those that have any, whichever are fewer.  No limit is a fixed value of a measure.
The limits are joined back by group.

Sketches are grouped counts, summed in each task before they are shuffled; their size depends on the range
of values only.  Measures are written once, so texts are read once.

Defined cases: null text has no words and fails the base rule; null languages and sources are groups of their own; equal rows get
equal verdicts; an empty table gives an empty result; columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerglass.llm import wordhash
from peerglass.llm.scratch import Scratch

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
RUN = 8
#: Buckets grow by this factor.
GROWTH = 1.04
#: (measure, whether it is a share that most texts have nothing of, whether too little is a fault as well).
MEASURES = [("symbol_share", True, False), ("line_share", True, False), ("repeat_share", True, False), ("word_length", False, True)]
#: Parts of all rows, and of the rows that have any of it, that no share is too much for.
TAIL, TAIL_OF_SOME = 0.99, 0.9
#: The bucket of zero, below all others.
ZERO = -100000
#: Rows beyond a quantile with which a group's own value counts as much as that of the wider group.
EQUAL_ROWS = 10
#: How many middle halves beyond it a value may lie.
REACH = 3.0


def _counts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    texts = wordhash.Texts(data, bounds, lower=False)
    chars = texts.per_text(texts.solid & ((data & 0xC0) != 0x80))
    symbols = texts.per_text(_SYMBOL[data])

    # lines: cut at line ends and text ends, those with a word
    cuts = np.unique(np.concatenate([bounds, np.flatnonzero(data == 0x0A) + 1])).astype(np.int64)
    starts, ends = cuts[:-1], cuts[1:].copy()
    ends -= (data[ends - 1] == 0x0A) if len(ends) else 0
    solid = np.concatenate([[0], np.cumsum(texts.solid, dtype=np.int64)])
    full = solid[ends] > solid[starts]
    starts, ends = starts[full], ends[full]
    doc = np.searchsorted(bounds, starts, side="right") - 1
    key = wordhash.pieces_hash(data, starts, ends)
    order = np.lexsort((key, doc))
    same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    lines = np.bincount(doc[order][1:][same], minlength=texts.count)

    # words in runs that stand in their text twice or more
    place, gram = texts.grams(RUN)
    order = np.lexsort((gram, texts.doc[place]))
    doc_of = texts.doc[place][order]
    twin = (gram[order][1:] == gram[order][:-1]) & (doc_of[1:] == doc_of[:-1])
    marked = np.zeros(len(texts.hash) + 1, np.int64)
    marked[place[order[1:][twin]]] = 1
    marked[place[order[:-1][twin]]] = 1
    running = np.concatenate([np.zeros(RUN, np.int64), np.cumsum(marked[:-1])])
    covered = running[RUN:] > running[:-RUN]
    repeats = np.bincount(texts.doc[covered], minlength=texts.count)
    return [texts.words, chars, symbols, lines, repeats]


def with_counts(docs: DataFrame, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and the counts of each text, in one pass without a shuffle."""
    keep = [c for c in keep or docs.columns if c not in COUNTS]
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(name, T.LongType()) for name in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_counts(data, bounds) for _, _, data, bounds in wordhash.chunks(batch.column("_read"))]
            if parts:
                made = [pa.array(np.concatenate([p[n] for p in parts]).astype(np.int64)) for n in range(len(COUNTS))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, *COUNTS])

    return docs.select(*keep, F.col(column).alias("_read")).mapInArrow(run, schema)


def measures(row: DataFrame) -> DataFrame:
    """The measures that the limits apply to: shares of the text, and the mean length of words."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return row.withColumns({
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "line_share": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    })


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def _bucket(value: Column) -> Column:
    return F.when(value > 0, F.floor(F.log(value) / float(np.log(GROWTH)))).otherwise(ZERO)


def _middle(bucket: Column) -> Column:
    return F.when(bucket > ZERO, F.pow(F.lit(GROWTH), bucket + 0.5)).otherwise(0.0)


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the finest sketches."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), _bucket(F.col(name)).cast("long").alias("bucket"))
                                for name, _, _ in MEASURES])).alias("p")
    return rows.select("lang", "source", pairs).groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, measure, rows, some, q1, q2, q3, tail, some_tail) of sketches merged over all other columns."""
    merged = sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    each = Window.partitionBy(*groups, "measure")
    running = merged.withColumn("upto", F.sum("n").over(each.orderBy("bucket"))).withColumn("rows", F.sum("n").over(each)) \
        .withColumn("zeros", F.sum(F.when(F.col("bucket") == ZERO, F.col("n")).otherwise(0)).over(each))
    at = lambda share: _middle(F.min(F.when(F.col("upto") >= F.col("rows") * share, F.col("bucket"))))
    in_some = (F.col("bucket") > ZERO) & (F.col("upto") - F.col("zeros") >= (F.col("rows") - F.col("zeros")) * TAIL_OF_SOME)
    return running.groupBy(*groups, "measure").agg(
        F.max("rows").alias("rows"), F.max(F.col("rows") - F.col("zeros")).alias("some"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), at(TAIL).alias("tail"),
        _middle(F.min(F.when(in_some, F.col("bucket")))).alias("some_tail"))


def limits(sketches: DataFrame) -> DataFrame:
    """(lang, source, measure, least, most): limits of every group.

    A quantile weighs n / (n + k) against that of the language, which weighs as much against that of all rows: n rows
    of the group, k of them have ``EQUAL_ROWS`` beyond the quantile.
    """
    fine, lang, every = (quantiles(sketches, groups) for groups in (["lang", "source"], ["lang"], []))
    found = {"q1": ("rows", 0.25), "q2": ("rows", 0.25), "q3": ("rows", 0.25), "tail": ("rows", 1 - TAIL), "some_tail": ("some", 1 - TAIL_OF_SOME)}
    lang = lang.toDF("l_lang", "l_measure", "l_rows", "l_some", *[f"l_{q}" for q in found])
    every = every.toDF("e_measure", "e_rows", "e_some", *[f"e_{q}" for q in found])
    both = fine.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure"))) \
        .join(every, F.col("measure") == F.col("e_measure"))

    def blend(q: str) -> Column:
        n, beyond = found[q]
        own, wider = (F.col(f"{p}{n}") / (F.col(f"{p}{n}") + EQUAL_ROWS / beyond) for p in ("", "l_"))
        value = lambda p: F.coalesce(F.col(f"{p}{q}"), F.lit(0.0))
        return own * value("") + (1 - own) * (wider * value("l_") + (1 - wider) * value("e_"))

    both = both.select("lang", "source", "measure", *[blend(q).alias(q) for q in found])
    share = F.create_map(*[F.lit(x) for name, is_share, _ in MEASURES for x in (name, is_share)])
    low = F.create_map(*[F.lit(x) for name, _, two in MEASURES for x in (name, two)])
    spread = (F.col("q3") - F.col("q1")) * REACH
    # quantiles are the middles of their buckets: half a bucket more, and all values of the bucket are within
    edge = GROWTH ** 0.51
    return both.select(
        "lang", "source", "measure",
        F.when(low[F.col("measure")], F.least(F.col("q1") - spread, F.col("q2") / 2)).otherwise(F.lit(-1.0)).alias("least"),
        (F.when(share[F.col("measure")], F.greatest(F.col("q3") + spread, F.col("tail"), F.col("some_tail")))
         .otherwise(F.col("q3") + spread) * edge).alias("most"))


def judge(docs: DataFrame, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with counts, ``base_failed``, and ``kept``: the base rule and the limits of the row's group."""
    keep = [c for c in keep or docs.columns if c not in (*COUNTS, "base_failed", "kept")]
    scratch = Scratch(docs.sparkSession, "quality")
    packed = docs.select(F.struct(*keep).alias("_row"), "lang", "source", F.col(column).alias("_text"))
    rows = measures(scratch.cut(with_counts(packed, "_text", ["_row", "lang", "source"])))
    return _verdict(rows, _bounds(rows, scratch))


def _bounds(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(b_lang, b_source, least and most of each measure): one row for each group."""
    bounds = limits(sketch(rows.where(~base_failed()))).groupBy("lang", "source").pivot("measure", [m for m, _, _ in MEASURES]) \
        .agg(F.first("least").alias("least"), F.first("most").alias("most"))
    return scratch.cut(bounds.withColumnsRenamed({"lang": "b_lang", "source": "b_source"}))


def _verdict(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    joined = rows.join(bounds, rows["lang"].eqNullSafe(bounds["b_lang"]) & rows["source"].eqNullSafe(bounds["b_source"]), "left")
    good = F.lit(True)
    for name, _, _ in MEASURES:
        good = good & F.coalesce(F.col(name).between(F.col(f"{name}_least"), F.col(f"{name}_most")), F.lit(True))
    return joined.select("_row.*", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & good).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    Limits come from a written table of counts alone.  Texts are counted again for the verdict: a second pass costs less than a copy
    of all texts on disk, which would lie there as long as the result is read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    given = docs.select(F.struct(F.struct("*").alias("_given")).alias("_row"), "lang", "source", F.col("text").alias("_text"))
    narrow = scratch.cut(with_counts(given, "_text", ["lang", "source"]))
    rows = measures(with_counts(given, "_text", ["_row", "lang", "source"]))
    return _verdict(rows, _bounds(measures(narrow), scratch)).where("kept").select("_given.*")
