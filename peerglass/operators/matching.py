"""From industry names to codes to companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.numbers import pad_code
from peerglass.functions.text import strip
from peerglass.operators.distributed import contains_pairs, first_per_key, join_split, shared, substrings


def industry_codes_long(rows: DataFrame, name: str, code: str) -> DataFrame:
    """Distinct non-empty (name, code) pairs."""
    return (
        rows.select(strip(name).alias(name), strip(code).alias(code))
        .filter((F.col(name) != "") & (F.col(code) != ""))
        .distinct()
    )


def industry_map(rows: DataFrame, name: str, code: str) -> DataFrame:
    """Codes of each industry name, sorted.

    Pairs are made distinct first, so an array never outgrows the code list.
    """
    pairs = industry_codes_long(rows, name, code)
    return pairs.groupBy(name).agg(F.array_sort(F.collect_list(code)).alias("codes"))


def industry_vocab(rows: DataFrame, name: str, row_no: str, cap: int = V.VOCABULARY_CAP) -> DataFrame:
    """First distinct industry names in order of appearance: the vocabulary report."""
    return rows.groupBy(name).agg(F.min(row_no).alias(row_no)).orderBy(row_no, name).limit(cap)


def keyword_industry_codes(keywords: DataFrame, industries: DataFrame, *, target: str = "t",
                           keyword: str = "keyword", name: str = "name", code: str = "code") -> DataFrame:
    """Distinct codes per target of the industries whose name contains a keyword."""
    asked = keywords.select(target, strip(keyword).alias(keyword)).distinct()
    pairs = contains_pairs(asked, industries, keyword, name)
    codes = industry_codes_long(industries, name, code)
    keyword_codes = pairs.join(codes, name).select(keyword, code).distinct()
    return asked.join(keyword_codes, keyword).select(target, code).distinct()


def code_pairs(targets: DataFrame, held: DataFrame, code: str, company_code: str, parent_retry: bool = False,
               min_partial: int = V.MIN_PARTIAL_CODE) -> DataFrame:
    """Distinct (target code, company code) pairs that match.

    A target code matches an equal code, and from three letters on any code
    that contains it.  Every company code lists its substrings of that length
    and itself, so the match is a hash join on equality.  With ``parent_retry``
    a longer code is looked up without its last letter as well, and those hits
    count where the code itself has none.
    """
    own = strip(code)
    asked = targets.select(own.alias(code)).filter(F.col(code) != "").distinct()
    parent = F.when(F.length(code) > min_partial, F.expr(f"left(`{code}`, length(`{code}`) - 1)"))
    tries = F.array_compact(F.array(F.col(code), parent)) if parent_retry else F.array(F.col(code))
    probes = asked.select(code, F.posexplode(tries).alias("_try", "_key"))
    codes = held.select(strip(company_code).alias(company_code)).filter(F.col(company_code) != "").distinct()
    keys = F.array_distinct(
        F.array_append(substrings(F.col(company_code), min_partial, F.length(company_code)), F.col(company_code))
    )
    hits = codes.select(company_code, F.explode(keys).alias("_key")).join(probes, "_key")
    if not parent_retry:
        return hits.select(code, company_code)
    first = hits.groupBy(code).agg(F.min("_try").alias("_try"))
    return hits.join(first, [code, "_try"]).select(code, company_code)


def companies_by_code(targets: DataFrame, companies: DataFrame, *, company: str = "name", **options) -> DataFrame:
    """Distinct companies per target whose code matches one of the target's codes.

    With ``parent_retry`` a code longer than three letters that matches nothing
    is tried again without its last letter.
    """
    return match_companies(targets, companies, company=company, **options).distinct()


def match_companies(targets: DataFrame, companies: DataFrame, *, target: str | Sequence[str] = "t",
                    code: str = "code", company: str = "name", company_code: str = "company_code",
                    parent_retry: bool = False) -> DataFrame:
    """``companies_by_code`` with a row for every company row, for callers that aggregate anyway."""
    by = [target] if isinstance(target, str) else list(target)
    pairs = code_pairs(targets, companies, code, company_code, parent_retry)
    matched = targets.select(*by, strip(code).alias(code)).join(pairs, code)
    wanted = matched.select(*by, company_code).distinct()
    listed = companies.select(strip(company_code).alias(company_code), strip(company).alias(company))
    return wanted.join(listed, company_code).select(*by, company)


def expand_pool(pool: DataFrame, expanded: DataFrame, *, target: str = "t", company: str = "name",
                small: int = V.SMALL_POOL) -> DataFrame:
    """Distinct pools; those of at most ``small`` companies get the wider match as well."""
    own = pool.select(target, company).withColumn("_wide", F.lit(False))
    wider = expanded.select(target, company).withColumn("_wide", F.lit(True))
    return widen_small(own.unionByName(wider), "_wide", target=target, company=company, small=small)


def widen_small(tagged: DataFrame, wide: str, *, target: str = "t", company: str = "name",
                small: int = V.SMALL_POOL) -> DataFrame:
    """Pool from the rows of both matches, ``wide`` telling the wider ones.

    One aggregate makes the rows distinct and remembers which are the pool's
    own; pool sizes are then one row per target.
    """
    rows = tagged.groupBy(target, company).agg(F.bool_or(~F.col(wide)).alias("_own"))
    sizes = rows.groupBy(target).agg(F.count_if("_own").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    kept = join_split(rows, sizes, target, sizes=sizes).filter(F.col("_own") | (F.col("_n") <= small))
    return kept.select(target, company)


def restrict_to(rows: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in a list; also used for the survivors of a stage."""
    return rows.join(names.select(*keys).distinct(), keys, "left_semi")


def distinct_peers(rows: DataFrame, target: str = "t", name: str = "name") -> DataFrame:
    return rows.select(target, name).distinct()


def dedupe_by_code(rows: DataFrame, *, target: str = "t", code: str = "code", row_no: str = "row_no") -> DataFrame:
    """First company of every padded code per target."""
    return first_per_key(rows.withColumn(code, pad_code(strip(code))), [target, code], [row_no])


def lookup_code(names: DataFrame, companies: DataFrame, *, name: str = "name", company: str = "company",
                code: str = "code", row_no: str = "row_no") -> DataFrame:
    """Stock code of a company name: equal name first, else a name that contains it.

    The contains match ignores case and runs for the misses only.  Names with
    no match keep a null code.  The company list is reduced to the first row of every name at once; equal names, the index
    of the misses and their codes all read that.
    """
    first = F.min_by(F.struct(F.col(code).alias("code"), F.col(row_no).alias("row_no")), row_no)
    listed = shared(companies.groupBy(F.col(company).alias("company")).agg(first.alias("first")), ["company"])
    asked = shared(names.select(strip(name).alias(name)).distinct(), [name])
    exact = asked.join(listed.select(F.col("company").alias(name), F.col("first.code").alias("_exact"), F.lit(True).alias("_hit")),
                       name, "left")
    misses = exact.filter(F.col("_hit").isNull()).select(name, F.lower(name).alias("_low"))
    # One row per lower-cased company text, and of those the first in file order.
    folded = listed.groupBy(F.lower("company").alias("_text")).agg(F.min_by("first", "first.row_no").alias("first"))
    pairs = contains_pairs(misses, folded, "_low", "_text")
    best = pairs.join(folded, "_text").groupBy("_low").agg(F.min_by("first", "first.row_no").alias("first"))
    partial = misses.join(best, "_low").select(name, F.col("first.code").alias("_partial"), F.lit(True).alias("_part"))
    match = F.when(F.col("_hit"), F.lit("exact")).when(F.col("_part"), F.lit("contains")).otherwise(F.lit("none"))
    return exact.join(partial, name, "left").select(
        name, pad_code(strip(F.coalesce("_exact", "_partial"))).alias(code), match.alias("match")
    )
