"""Reference tables: industry codes and listed companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.dates import listed_days, listed_years, parse_listing_date
from peerglass.functions.numbers import pad_code
from peerglass.functions.text import strip, text_key
from peerglass.operators.distributed import forward_fill, shared, split_hot_keys

#: Joined rows of one industry that one task makes.
JOINED_ROWS = 10_000_000


def industry_class_code(rows: DataFrame, file: str, row_no: str, code: str, out: str = "class_code") -> DataFrame:
    """Section letter of the rows above plus the five-digit number; null on letter rows."""
    raw = strip(code)
    lettered = rows.withColumn("_letter", F.when(raw.rlike("^[A-Za-z]$"), F.upper(raw))).withColumn(
        "_number", F.when(raw.rlike(r"^\d+$"), pad_code(raw, V.CODE_DIGITS))
    )
    filled = forward_fill(lettered, [file], row_no, "_letter", "_section")
    return filled.withColumn(out, F.concat("_section", "_number")).drop("_letter", "_number", "_section")


def require_code(rows: DataFrame, code: str = "class_code") -> DataFrame:
    return rows.na.drop(subset=[code])


def attach_industry_code(companies: DataFrame, codes: DataFrame, industry: str, code_name: str,
                         code: str = "class_code", many: bool = False) -> DataFrame:
    """Codes of a company's industry by text key; several codes give several rows.

    The code list is left to the optimizer to broadcast: it is small where it
    is a code list, and a hash join serves where it is not.

    ``many``: for industries with many codes.  The rows that come out are the companies of an industry times its codes; they,
    and not the rows that go in, tell over how many tasks an industry is spread.  Each side is made once and read by the
    counts and the join.
    """
    lookup = codes.select(text_key(code_name).alias("_key"), code)
    keyed = companies.withColumn("_key", text_key(industry))
    if not many:
        return keyed.join(lookup, "_key", "left").drop("_key")
    lookup, keyed = shared(lookup), shared(keyed)
    held = lookup.groupBy("_key").agg(F.count(F.lit(1)).alias("_codes"))
    made = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_companies")).join(held, "_key").select(
        "_key", (F.col("_companies") * F.col("_codes")).alias("_rows"))
    salted, repeat = split_hot_keys(keyed, made, "_key", "_rows", rows_per_task=JOINED_ROWS)
    # repeated codes are more than the optimizer takes them for, so they are not left to it to broadcast, and the tasks are as
    # many as asked for, though what they read is little
    salted = salted.repartition(int(salted.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_key", "_salt")
    return salted.join(repeat(lookup).hint("merge"), ["_key", "_salt"], "left").drop("_key", "_salt")


def code_presence(codes: DataFrame, code_name: str, code: str = "class_code") -> DataFrame:
    """The code list cut to what tells the companies without a code: every entry without one, and one entry with a code for
    each text key that has any.  Attached to it, a company has a row for each null it would have, and one more at most."""
    named = codes.filter(F.col(code).isNotNull()).groupBy(text_key(code_name).alias("_key")).agg(
        F.min_by(code_name, code).alias(code_name), F.min(code).alias(code))
    return codes.filter(F.col(code).isNull()).select(code_name, code).unionByName(named.drop("_key"))


def unmatched(companies: DataFrame, columns: Sequence[str], code: str = "class_code") -> DataFrame:
    return companies.filter(F.col(code).isNull()).select(*columns, code)


def null_audit(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count and null count of each column."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def listing_columns(companies: DataFrame, listed_text: str, as_of: str) -> DataFrame:
    """Listing date, its yyyyMMdd text, and the days and whole years since."""
    dated = companies.withColumn("listing_date", parse_listing_date(listed_text))
    return dated.select(
        "*",
        F.date_format("listing_date", "yyyyMMdd").alias("listing_ymd"),
        listed_days("listing_date", as_of).alias("listed_days"),
        listed_years("listing_date", as_of).alias("listed_years"),
    )


def reference_prep(industry_rows: DataFrame, companies: DataFrame, *, as_of: str, file: str = "file",
                   row_no: str = "row_no", raw_code: str = "raw_code", industry_name: str = "industry_name",
                   industry: str = "industry", listed_text: str = "listed_text") -> DataFrame:
    """Listed companies with class codes and listing age, ready for screening."""
    codes = require_code(industry_class_code(industry_rows, file, row_no, raw_code))
    coded = attach_industry_code(companies, codes, industry, industry_name)
    return listing_columns(coded, listed_text, as_of)
