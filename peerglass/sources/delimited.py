"""Delimited files in old and new character sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerglass import fixed_values as V

# How each reading encoding is named to the csv source.  A byte order mark is
# dropped from the first header either way.
CHARSETS = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp949": "MS949", "euc-kr": "EUC-KR"}


def match_columns(columns: Sequence[str], wanted: Mapping[str, Sequence[str]]) -> dict[str, str] | None:
    """For each wanted name the first column that contains one of its tokens.

    Tokens are tried in order of preference.  None where a name stays open.
    """
    found = {}
    for name, tokens in wanted.items():
        hits = [c for token in tokens for c in columns if token in c.strip().lstrip("﻿")]
        if not hits:
            return None
        found[name] = hits[0]
    return found


def resolve_columns(df: DataFrame, wanted: Mapping[str, Sequence[str]], keep_others: bool = False) -> DataFrame:
    """Columns found by header tokens, renamed; raises where one is missing."""
    found = match_columns(df.columns, wanted)
    if found is None:
        raise ValueError(f"no column for one of {list(wanted)} in {df.columns}")
    chosen = [F.col(f"`{column}`").alias(name) for name, column in found.items()]
    others = [F.col(f"`{c}`") for c in df.columns if c not in found.values()] if keep_others else []
    return df.select(*chosen, *others)


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _line, _raw) of all lines: undecoded text with its place, any number of splits to a file."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), F.col("value").alias("_raw"))


def records(lines: DataFrame) -> DataFrame:
    """(_file, _first, _raw) of all records: lines joined where a quoted field goes on over the end of a line.

    A line begins inside a field where an odd number of quotes stands before it in the file; doubled quotes do not change
    that.  Quotes are summed for each split, and a prefix sum over the splits of a file (one row for a split) tells each how
    it begins; inside a split its lines are summed in order.  So a file needs no single task.  ``_first`` is true for the
    record at the top of a file.
    """
    quotes = F.length("_raw") - F.length(F.replace(F.col("_raw"), F.lit('"'), F.lit("")))
    split = ["_file", "_block"]
    counted = lines.withColumn("_quotes", quotes)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    totals = counted.groupBy(*split).agg(F.sum("_quotes").alias("_n"))
    begun = totals.select(*split, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begun"))
    before = Window.partitionBy(*split).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*split).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    known = counted.join(begun, split).withColumn("_begins", (F.col("_begun") + F.coalesce(F.sum("_quotes").over(before), F.lit(0))) % 2 == 0)
    start = F.when(F.col("_begins"), F.struct("_block", "_line"))
    placed = known.withColumn("_start", F.last(start, ignorenulls=True).over(upto))

    # Lines at the head of a split may go on a record of an earlier split.
    tails = known.groupBy(*split).agg(F.max(start).alias("_tail"))
    open_ = tails.select(*split, F.last("_tail", ignorenulls=True).over(earlier).alias("_open"))
    keyed = placed.join(open_, split).withColumn("_start", F.coalesce("_start", "_open"))

    top = (F.col("_start._block") == 0) & (F.col("_start._line") == F.min("_line").over(Window.partitionBy(*split)))
    keyed = keyed.withColumn("_first", F.when(F.col("_begins"), top))
    whole = F.col("_begins") & (F.col("_quotes") % 2 == 0)
    single = keyed.filter(whole).select("_file", "_first", "_raw")
    parts = keyed.filter(~whole).groupBy("_file", "_start").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_line", "_raw"))).alias("_parts"), F.max("_first").alias("_first"))
    joined = parts.select("_file", "_first", F.array_join(F.transform("_parts", lambda p: p["_raw"]), "\n").alias("_raw"))
    return single.unionByName(joined)


def decodes(lines: DataFrame, encoding: str) -> bool:
    """Whether all lines are text in an encoding."""
    if CHARSETS.get(encoding) == "UTF-8":
        return lines.filter(~F.is_valid_utf8("_raw")).isEmpty()
    try:
        lines.agg(F.max(F.length(_text(encoding)))).collect()
    except PySparkException as error:
        if "MALFORMED_CHARACTER_CODING" in str(error):
            return False
        raise
    return True


def _text(encoding: str) -> Column:
    return F.decode(F.col("_raw").cast("binary"), CHARSETS.get(encoding, encoding))


def read_delimited(spark: SparkSession, path: str, wanted: Mapping[str, Sequence[str]],
                   encodings: Sequence[str] = tuple(V.READ_ENCODINGS)) -> DataFrame:
    """All-string rows in the first encoding that decodes and has the wanted columns and a row.

    Fields may be quoted, with line breaks and doubled quotes inside.  Whether the text decodes is found by reading it once
    for each encoding that is tried; the rows themselves stay lazy.
    """
    lines = split_lines(spark, path)
    if lines.limit(2).count() == 2:
        for encoding in encodings:
            if not decodes(lines, encoding):
                continue
            options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "nullValue": "", "escape": '"'}
            names = spark.read.options(header=True, encoding=CHARSETS.get(encoding, encoding), **options).csv(path).columns
            if match_columns(names, wanted) is None:
                continue
            body = records(lines).filter(~F.col("_first")).select(F.rtrim(_text(encoding), F.lit("\r")).alias("_text"))
            schema = ", ".join(f"_c{i} string" for i in range(len(names)))
            rows = body.filter(F.trim("_text") != "").select(F.from_csv("_text", schema, options).alias("_row"))
            return resolve_columns(rows.select(*[F.col(f"_row._c{i}").alias(name) for i, name in enumerate(names)]), wanted)
    raise ValueError(f"{path}: none of {list(encodings)} gives rows with {list(wanted)}")


def write_delimited(df: DataFrame, path: str, encoding: str = "cp949") -> None:
    """Rows as delimited text; quotes in a field are doubled, as readers of such files expect."""
    df.write.option("header", True).option("escape", '"').option("encoding", CHARSETS.get(encoding, encoding)).mode("overwrite").csv(path)
