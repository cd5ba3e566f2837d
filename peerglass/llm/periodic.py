"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q that holds at least ``LEAST`` words and ``TIMES`` periods and
that no neighbouring word extends.

Periods up to ``SHORT`` are found by direct scans: words are compared with those q places on.  A longer period q belongs to
the scale w, the power of two with w / 2 < q <= w.  Words that a run repeats, its w-word pieces repeat too, q places on, and no
closer: two equal pieces at a shorter distance would give the run a shorter period.  Of every w / 2 consecutive pieces the one
with the smallest hash is kept (a minimizer); windows q places apart keep pieces q places apart, and a run of four periods
holds such windows, so its period is the distance of some two neighbouring minimizers of equal hash.  Each such pair
is a seed that is extended word by word in both directions.  A false seed does not survive; a run is missed only where hashes of
64 bits of two different pieces agree.

All texts of a piece of a batch are scanned as one row of word numbers, with a number of its own between two texts.  One Arrow
pass, no shuffle; the hashes of a scale are made from those of the scale before it.

Defined cases: null text and text without words have no runs and an empty collapsed text; repeated rows are kept, each with the
same result; a null id is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerglass.llm.wordhash import scramble

LEAST, TIMES, SHORT = 6, 4, 8
#: Bytes of text that are scanned together; a longer text is scanned alone.
PIECE = 1 << 19
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _direct(words: np.ndarray, period: int) -> np.ndarray:
    """(start, length, period) of all stretches that repeat at a distance."""
    same = np.concatenate([[False], words[period:] == words[:-period], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, stops = edges[::2], edges[1::2]
    return np.stack([starts, stops - starts + period, np.full(len(starts), period)], axis=1)


def _slide(values: np.ndarray, width: int, choose: np.ufunc) -> np.ndarray:
    """The chosen one of every ``width`` consecutive values; width is a power of two."""
    step = 1
    while step < width:
        values = choose(values[:-step], values[step:])
        step *= 2
    return values


def minimizers(pieces: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest hash in any ``width`` consecutive ones, ties included."""
    if len(pieces) < width:
        return np.zeros(0, np.int64)
    none = np.zeros(width - 1, np.uint64)
    lows = np.concatenate([none, _slide(pieces, width, np.minimum), none])
    # a place is smallest in some window where the largest low of its windows is its own
    return np.flatnonzero(pieces == _slide(lows, width, np.maximum))


def _seeds(pieces: np.ndarray, scale: int) -> list[tuple[int, int]]:
    """(period, place) of neighbouring equal minimizers at a distance of the scale, in order."""
    places = minimizers(pieces, scale // 2)
    hashes = pieces[places]
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    away = places[1:] - places[:-1]
    good = np.flatnonzero((hashes[1:] == hashes[:-1]) & (away > scale // 2) & (away <= scale))
    found = np.stack([away[good], places[good]], axis=1)
    return [tuple(row) for row in found[np.lexsort((found[:, 1], found[:, 0]))].tolist()]


def _reach(words: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The stretch [first, past) around a place in which words equal those a period on."""
    past, step, end = place, 64, len(words) - period
    while past < end:
        stop = min(past + step, end)
        differs = np.flatnonzero(words[past:stop] != words[past + period:stop + period])
        if len(differs):
            past += int(differs[0])
            break
        past, step = stop, 2 * step
    first, step = place, 64
    while first > 0:
        start = max(first - step, 0)
        differs = np.flatnonzero(words[start:first] != words[start + period:first + period])
        if len(differs):
            first = start + int(differs[-1]) + 1
            break
        first, step = start, 2 * step
    return first, past


def find(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) of all runs, by start and period.  ``longest``: most words of a text."""
    rows = [_direct(words, period) for period in range(1, min(SHORT, len(words) - 1) + 1)]
    pieces, scale = scramble(words), 1
    while scale // 2 < longest // TIMES and len(pieces):
        if scale > SHORT:
            stretch, before, grown = (0, 0), 0, []
            for period, place in _seeds(pieces, scale):
                if period != before or not stretch[0] <= place < stretch[1]:
                    stretch, before = _reach(words, place, period), period
                    grown.append((stretch[0], stretch[1] - stretch[0] + period, period))
            rows.append(np.array(grown, np.int64).reshape(-1, 3))
        with np.errstate(over="ignore"):
            pieces = scramble(pieces[:max(len(pieces) - scale, 0)] * np.uint64(0x9FB21C651E98DF25) + pieces[scale:])
        scale *= 2
    runs = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
    runs = runs[(runs[:, 1] >= LEAST) & (runs[:, 1] >= TIMES * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # a stretch with a shorter period has its multiples too
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _scanned(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text."""
    split = pc.ascii_split_whitespace(texts)
    sizes = np.asarray(pc.list_value_length(split)).astype(np.int64)
    words, doc = split.flatten(), np.repeat(np.arange(len(texts)), sizes)
    solid = np.asarray(pc.greater(pc.binary_length(words), 0))
    words, doc = words.filter(pa.array(solid)), doc[solid]
    counts = np.bincount(doc, minlength=len(texts))
    begins = np.cumsum(counts) - counts + np.arange(len(texts))  # with one number between two texts
    numbers = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    row = np.full(len(words) + len(texts), -1, np.int64)
    places = np.arange(len(words)) + doc
    row[places] = numbers
    gaps = np.flatnonzero(row < 0)
    row[gaps] = -1 - np.arange(len(gaps))
    runs = find(row, int(counts.max(initial=0)))
    marks = np.zeros(len(row) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(marks)[places] == 0
    left = words.filter(pa.array(kept))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=len(texts)))])
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), left), pa.scalar(" ", left.type))
    of = np.searchsorted(begins, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    rows = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                                      names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), rows), collapsed.cast(pa.string())


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of parts of about ``PIECE`` bytes."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64))
    first = 0
    while first < len(texts):
        done = int(ends[first - 1]) if first else 0
        past = max(int(np.searchsorted(ends, done + PIECE, side="right")), first + 1)
        yield first, past - first
        first = past


def find_runs(docs: DataFrame, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) of every row.

    ``runs`` hold start, length and period in words, by start, then period.  ``collapsed`` is the text without the words that a
    run contains after its first period, joined by one space.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for first, rows in _portions(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), *_scanned(texts.slice(first, rows))],
                                                 names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(column).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])
    return rows.mapInArrow(run, schema)


def most_repeated(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equal ones."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
