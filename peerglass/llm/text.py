"""Column helpers shared by the native text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of letters, digits and anything outside ASCII; capitals are lowered after the match.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A word between white space.
WORD = r"[^\x20\x09-\x0D]+"

SPAN = "array<struct<start:int,end:int,hit:string,before:string>>"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lowered and nothing else.  Plain ASCII takes the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def tokens(text: Column) -> Column:
    """Lowered words of letters, digits and non-ASCII characters."""
    return F.transform(F.regexp_extract_all(whole(text), F.lit(TOKEN), F.lit(0)), lower_ascii)


def no_spans() -> Column:
    return F.expr(f"cast(array() as {SPAN})")


def spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None,
          where: Column | None = None) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The pieces between matches and the matches themselves are read by two built-in functions; running lengths give
    the places.  ``before`` holds up to 24 characters in front of the match.  ``keep`` filters by the match, ``where``
    is a cheap test that a text must pass before it is searched at all.
    """
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + F.char_length(piece["gap"])
        end = start + F.coalesce(F.char_length(piece["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), piece["hit"].alias("hit"),
                        F.right(piece["gap"], F.lit(24)).alias("before"))
        good = piece["hit"].isNotNull() if keep is None else piece["hit"].isNotNull() & keep(piece["hit"])
        return F.struct(end.alias("at"), F.when(good, F.array_append(state["out"], span)).otherwise(state["out"]).alias("out"))

    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), add)["out"]
    return found if where is None else F.when(where, found).otherwise(no_spans())


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.split(F.reverse(number), "")
    values = F.transform(backwards, lambda c, place: c.cast("int") * (place % 2 + 1))
    return F.aggregate(values, F.lit(0), lambda total, v: total + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def span_text(all_spans: Column) -> Column:
    """``kind:start:end`` of spans that are sorted already, joined by commas."""
    return F.array_join(F.transform(all_spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))), ",")


def labelled(found: Column, order: int, kind: str, base: bool) -> Column:
    """Spans with the place of their kind, its name, and whether they are base spans; they sort by start, then kind."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        F.lit(base).alias("base")))


def chance(*parts: Column | str | int) -> Column:
    """A repeatable number in [0, 1) from the given values."""
    return F.pmod(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), F.lit(1 << 40)) / float(1 << 40)
