"""Report datasets: series, timelines, units and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.dates import year_label
from peerglass.functions.numbers import amount_range, grouped, harmonise_unit, round_class, round_rank, to_double, unit_token
from peerglass.functions.text import as_col, contains_any, let, strip
from peerglass.operators.distributed import join_split, rank_in_ranges, top_k_per_key


def infer_unit(values: DataFrame, group: str, value: str, row_no: str, fallback: str = V.DEFAULT_UNIT,
               title: str | None = None) -> DataFrame:
    """Most common unit named in each group; first seen wins ties; fallback where none is.

    Groups whose ``title`` speaks of a count have the count unit, whatever their values say.
    """
    units = (
        values.withColumn("unit", unit_token(value)).filter(F.col("unit").isNotNull())
        .groupBy(group, "unit").agg(F.count(F.lit(1)).alias("_n"), F.min(row_no).alias("_first"))
        .groupBy(group).agg(F.max_by("unit", F.struct(F.col("_n"), (-F.col("_first")).alias("f"))).alias("unit"))
    )
    counts = contains_any(F.col(title), V.COUNT_TITLES) if title is not None else F.lit(False)
    groups = values.groupBy(group).agg(F.max(counts).alias("_counts"))
    unit = F.when(F.col("_counts"), F.lit(V.COUNT_UNIT)).otherwise(F.coalesce("unit", F.lit(fallback)))
    return groups.join(units, group, "left").select(group, unit.alias("unit"))


def chart_dataset(pairs: Column | str, title: Column | str, as_of_year: int, fallback: Column | str = V.DEFAULT_UNIT) -> Column:
    """struct<unit, unit_label, points> of a series of [year, value] texts; null where there is nothing to draw.

    A first row whose year is no number is the header.  The unit is the count unit where the title speaks of a count, else the
    one most values name, first seen of equals, else the fallback; values are moved to it.  A series without rows,
    with values that add up to nothing or with a malformed number has no chart.
    """
    text = lambda row, i: F.coalesce(F.try_element_at(row, F.lit(i)), F.lit(""))
    year = lambda row: strip(F.replace(text(row, 1), F.lit("년"), F.lit("")))
    rows = as_col(pairs)
    body = F.filter(rows, lambda row, i: ((i > 0) | year(row).rlike("^[0-9]")) & (F.size(row) >= 2))
    fallback = F.lit(fallback) if isinstance(fallback, str) and fallback in V.MONEY_UNITS else as_col(fallback)

    def common(units: Column) -> Column:
        counted = F.transform(F.array_distinct(units), lambda u, i: F.struct(
            F.size(F.filter(units, lambda x: x == u)).alias("n"), (-i).alias("first"), u.alias("unit")))
        return F.coalesce(F.array_max(counted)["unit"], fallback)

    def drawn(body: Column) -> Column:
        named = F.array_compact(F.transform(body, lambda row: unit_token(text(row, 2))))
        unit = F.when(contains_any(as_col(title), V.COUNT_TITLES), F.lit(V.COUNT_UNIT)).otherwise(let(named, common))

        def chart(unit: Column) -> Column:
            points = F.transform(body, lambda row: F.struct(
                year_label(year(row), as_of_year).alias("label"), harmonise_unit(text(row, 2), unit).alias("value")))
            return let(points, lambda p: F.when(
                F.aggregate(p, F.lit(0.0), lambda total, point: total + point["value"]) != 0,
                F.struct(unit.alias("unit"), F.concat(F.lit("(단위: "), unit, F.lit(")")).alias("unit_label"), p.alias("points"))))

        return let(unit, chart)

    return F.when(F.size(rows) >= 2, let(body, drawn))


def nonzero_series(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of the series whose values do not sum to zero."""
    sums = rows.groupBy(key).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    alive = sums.filter(F.col("_sum") != 0).select(key)
    return join_split(rows, alive, key, "left_semi", sizes=sums).select(*rows.columns)


def clean_series(pairs: Column | str) -> Column:
    """Series of [year, value] text pairs as array<struct<year, value>>, unreadable rows dropped.

    A first row whose year is no number is taken for the header and left out.
    A series of fewer than two rows gives an empty array.
    """
    rows = as_col(pairs)
    text = lambda row, i: F.coalesce(F.try_element_at(row, F.lit(i)), F.lit(""))

    def year(row: Column) -> Column:
        return strip(F.replace(text(row, 1), F.lit("년"), F.lit("")))

    def number(row: Column) -> Column:
        c = strip(F.translate(text(row, 2), ",억원", ""))
        given = F.try_element_at(row, F.lit(2)).isNotNull()  # a missing value drops the row, a mark for none is 0
        return F.when(given, F.when(c.isin(*V.SERIES_NA_MARKS), F.lit(0.0)).otherwise(to_double(c)))

    body = F.filter(rows, lambda row, i: (i > 0) | year(row).rlike("^[0-9]"))
    read = F.transform(body, lambda row: F.struct(year(row).alias("year"), number(row).alias("value"),
                                                  F.size(row).alias("n")))
    good = F.filter(read, lambda s: (s["n"] >= 2) & s["value"].isNotNull())
    shaped = F.transform(good, lambda s: F.struct(s["year"].alias("year"), s["value"].alias("value")))
    return F.when(F.size(rows) >= 2, shaped).otherwise(F.slice(shaped, 1, 0))


def repaired_date(date: Column | str, label: Column | str) -> Column:
    """Funding date text; a date that cannot be right is replaced by the round label."""
    d, r = (strip(F.coalesce(as_col(c), F.lit(""))) for c in (date, label))
    bad = ~d.rlike(r"\d{4}") | F.contains(d, F.lit("2000")) | F.contains(d, F.lit("0000")) | F.lower(d).isin(
        *V.DATE_NA_MARKS
    )
    return F.when(bad, F.when(r != "", r).otherwise(F.lit("-"))).otherwise(d)


def funding_timeline(rounds: DataFrame, *, target: str = "t", date: str = "date", label: str = "round",
                     amount: str = "amount", seq: str = "seq", parts: int | None = None) -> DataFrame:
    """Funding rounds with their place on the timeline and what the chart shows.

    Sorted by year, then by the usual order of rounds, then as given.  Rows are dealt by range of what they are sorted by, and
    only then are amounts read: the texts travel as they are.
    """
    raw_label = strip(F.coalesce(F.col(label), F.lit("")))
    no_label = (raw_label == "") | F.lower(raw_label).isin(*V.ROUND_NA_MARKS)
    # In steps, so that no text is read twice.
    read = rounds.select(
        target, seq, repaired_date(date, label).alias("date"), F.col(amount).alias("_amount"),
        F.when(no_label, F.lit("N/A")).otherwise(raw_label).alias("round"), round_rank(label).alias("sort_round"),
    ).withColumn(
        "sort_year", F.coalesce(F.regexp_extract("date", r"\d{4}", 0).try_cast("int"), F.lit(V.LAST_YEAR))
    )
    placed = rank_in_ranges(read, [target], ["sort_year", "sort_round", seq], "x", parts=parts)
    return placed.withColumn("_money", amount_range("_amount")).select(
        target, seq, "date", "round",
        F.when(F.col("sort_year") == V.LAST_YEAR, F.col("round")).otherwise(F.col("sort_year").cast("string")).alias(
            "axis_label"),
        F.col("_money.amount").alias("amount"), F.col("_money.label").alias("amount_label"),
        round_class("round").alias("round_class"), "sort_year", "sort_round", "x",
    )


def list_preview(rows: DataFrame, group: str, item: str, order: str, limit: int = V.PREVIEW_ITEMS) -> DataFrame:
    """'N개사 (a, b, ...)' per group: the count of all items and the first few of them."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    first = top_k_per_key(rows.select(group, item, order), [group], [F.asc(order)], limit, "_no")
    listed = first.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_no", item))).alias("_items"))
    names = F.array_join(F.transform("_items", lambda i: i[item].cast("string")), ", ")
    more = F.when(F.col("n") > limit, F.lit(", ...)")).otherwise(F.lit(")"))
    text = F.concat(grouped("n"), F.lit("개사 ("), names, more)
    return counts.join(listed, group).select(group, "n", text.alias("preview"))


def empty_preview(text: Column | str) -> Column:
    """A preview, or the fixed text for an empty list."""
    return F.coalesce(as_col(text), F.lit(V.EMPTY_LIST_TEXT))


def mark_members(rows: DataFrame, passed: DataFrame, keys: Sequence[str], yes: str = "통과",
                 no: str = "미통과") -> DataFrame:
    """``status`` by presence in a list of keys."""
    listed = passed.select(*keys).distinct().withColumn("_in", F.lit(True))
    return rows.join(listed, list(keys), "left").withColumn(
        "status", F.when(F.col("_in"), F.lit(yes)).otherwise(F.lit(no))
    ).drop("_in")
