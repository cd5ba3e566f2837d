"""Codes, amounts and their texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.text import as_col, first_token_value, let, strip

EXACT = "decimal(38,10)"


def pad_code(value: Column | str, width: int = V.STOCK_CODE_DIGITS) -> Column:
    """Left-pad with zeros; longer codes stay whole."""
    c = as_col(value).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def to_double(value: Column | str) -> Column:
    """Number of a plain decimal text; null for anything else, such as NaN, 12d or 0x1p3."""
    c = as_col(value)
    return F.when(c.cast("string").rlike(V.DECIMAL_TEXT), c.try_cast("double"))


def plain_number(value: Column | str) -> Column:
    """Decimal text of a double without exponent: 12.0, 0.5, 12345678.25."""
    c = as_col(value).cast("double")
    size = F.abs(c)
    exact = F.regexp_replace(c.try_cast("decimal(38,12)").cast("string"), r"(\.\d*?[1-9])0+$|(\.0)0*$", "$1$2")
    return F.when((size >= 1e-3) & (size < 1e7), c.cast("string")).otherwise(exact)


def fixed(value: Column | str, places: int) -> Column:
    """Fixed places, half-even, no thousands separators."""
    return F.replace(F.format_number(as_col(value), places), F.lit(","), F.lit(""))


def group_digits(digits: Column) -> Column:
    """Thousands separators in a text of digits."""
    return F.regexp_replace(digits, r"(?<=\d)(?=(\d{3})+$)", ",")


def grouped(value: Column | str) -> Column:
    """Whole number with thousands separators, decimals cut off."""
    return F.format_number(as_col(value).cast("bigint"), 0)


def first_number(value: Column | str) -> Column:
    """First signed decimal of a text, thousands separators ignored; null where there is none."""
    return to_double(F.regexp_extract(F.replace(as_col(value), F.lit(","), F.lit("")), r"([-+]?\d+(?:\.\d+)?)", 1))


def sentinel_number(value: Column | str) -> Column:
    """Number of a statement cell; anything unreadable becomes the missing amount."""
    c = strip(F.coalesce(as_col(value), F.lit("")))
    parsed = F.when(~c.isin(*V.AMOUNT_NA_MARKS), to_double(F.replace(c, F.lit(","), F.lit(""))))
    return F.coalesce(parsed, F.lit(float(V.MISSING_AMOUNT)))


def market_cap_eok(value: Column | str) -> Column:
    """Market cap text such as '40조1,935' in units of 억; 0.0 where unreadable."""
    s = F.replace(F.regexp_replace(F.coalesce(as_col(value), F.lit("")), r"(?U)\s+", ""), F.lit("억원"), F.lit(""))

    def part(group: int) -> Column:
        text = F.replace(F.regexp_extract(s, V.MARKET_CAP_TEXT, group), F.lit(","), F.lit(""))
        return F.coalesce(to_double(text), F.lit(0.0))

    return part(1) * float(V.JO_IN_EOK) + part(2)


def format_statement(value: Column | str) -> Column:
    """Statement cell for display: thousands separators, brackets and △ kept as signs."""
    s = strip(value)
    dense = F.replace(s, F.lit(" "), F.lit(""))
    bracket = F.startswith(dense, F.lit("(")) & F.endswith(dense, F.lit(")")) & (F.length(dense) > 1)
    core = (
        F.when(bracket, F.regexp_replace(dense, r"^\(|\)$", ""))
        .when(F.startswith(dense, F.lit("△")) | F.startswith(dense, F.lit("▽")),
              F.concat(F.lit("-"), F.regexp_replace(dense, "^[△▽]", "")))
        .otherwise(dense)
    )
    number = core.try_cast(EXACT)
    digits = F.abs(number).cast("string")
    whole = group_digits(F.split_part(digits, F.lit("."), F.lit(1)))
    fraction = F.regexp_replace(F.split_part(digits, F.lit("."), F.lit(2)), "0+$", "")
    body = F.concat(
        F.when(F.startswith(core, F.lit("-")), F.lit("-")).otherwise(F.lit("")),
        whole,
        F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )
    shown = F.when(bracket, F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    keep = (s == "") | s.isin("-", "N/A") | F.contains(s, F.lit(",")) | number.isNull()
    return F.when(keep, s).otherwise(shown)


def _trim_zeros(value: Column) -> Column:
    return F.regexp_replace(value.cast("decimal(30,10)").cast("string"), r"\.?0+$", "")


def _exponent_text(value: Column) -> Column:
    power = F.floor(F.log10(F.abs(value)))
    mantissa = _trim_zeros(F.rint(value / F.pow(F.lit(10.0), power.cast("double")) * 1e5) / 1e5)
    return F.concat(mantissa, F.lit("e+"), F.lpad(power.cast("string"), 2, "0"))


def general_text(value: Column) -> Column:
    """Six significant digits, no trailing zeros; an exponent from a million up."""

    def rounded(v: Column) -> Column:
        step = F.pow(F.lit(10.0), F.lit(5.0) - F.floor(F.log10(F.abs(v))))
        return F.when(v == 0, F.lit(0.0)).otherwise(F.rint(v * step) / step)

    def shown(v: Column) -> Column:
        return (
            F.when(v == 0, F.lit("0")).when(F.abs(v) < 1e6, _trim_zeros(v)).when(v.isNotNull(), _exponent_text(v))
        )

    return let(let(value, rounded), shown)


def amount_range(value: Column | str) -> Column:
    """Funding amount text as struct<amount, label> in 억; ranges give their mean."""
    text = F.coalesce(as_col(value), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(r"(\d+\.?\d*)"), F.lit(1))
    ends = F.struct(
        F.try_element_at(found, F.lit(1)).cast("double").alias("low"),
        F.try_element_at(found, F.lit(2)).cast("double").alias("high"),
        first_token_value(text, V.AMOUNT_MULTIPLIERS, 1.0).alias("scale"),
    )

    def read(e: Column) -> Column:
        low, high = e["low"] * e["scale"], e["high"] * e["scale"]
        amount = F.coalesce((low + high) / 2.0, low, F.lit(V.UNKNOWN_AMOUNT))
        label = F.coalesce(
            F.concat(general_text(low), F.lit("~"), general_text(high), F.lit("억")),
            F.concat(general_text(low), F.lit("억")),
            F.lit(V.UNKNOWN_AMOUNT_TEXT),
        )
        return F.struct(amount.alias("amount"), label.alias("label"))

    return let(ends, read)


def unit_token(value: Column | str) -> Column:
    """Unit named in an amount text; null where none is."""
    return first_token_value(as_col(value), V.UNIT_TOKENS, None)


def harmonise_unit(value: Column | str, unit: Column | str) -> Column:
    """Chart value of an amount text, moved between 백만원 and 억원 to fit the unit.

    An empty text counts as 0; a malformed number gives null.
    """
    raw = strip(F.coalesce(as_col(value), F.lit("")))
    text = F.regexp_replace(raw, r"[^\d.\-]", "")
    number = F.when(text == "", F.lit(0.0)).otherwise(to_double(text))
    return (
        F.when((as_col(unit) == "억원") & F.contains(raw, F.lit("백만")), number / 100)
        .when((as_col(unit) == "백만원") & F.contains(raw, F.lit("억")), number * 100)
        .otherwise(number)
    )


# --- texts of money --------------------------------------------------------

def money_approx(value: Column | str) -> Column:
    """Rounded Korean money text: (약 1조 2,345억), (약 12억), (약 3만)."""
    c = as_col(value).cast("double")
    jo = F.floor(c / 1e12)
    eok = F.floor((c - jo * F.lit(1e12)) / 1e8)
    big = F.concat(F.lit("(약 "), jo.cast("string"), F.lit("조"),
                   F.when(eok > 0, F.concat(F.lit(" "), grouped(eok), F.lit("억"))).otherwise(F.lit("")), F.lit(")"))
    return (
        F.when(c >= 1e12, big)
        .when(c >= 1e8, F.concat(F.lit("(약 "), grouped(F.floor(c / 1e8)), F.lit("억)")))
        .otherwise(F.concat(F.lit("(약 "), grouped(F.floor(c / 1e4)), F.lit("만)")))
    )


def won_text(value: Column | str) -> Column:
    return F.concat(F.format_number(as_col(value).cast("double"), 0), F.lit("원"))


def shares_text(value: Column | str) -> Column:
    return F.concat(grouped(value), F.lit("주"))


def multiple_text(value: Column | str) -> Column:
    return F.concat(fixed(value, 2), F.lit("배"))


def percent_text(rate: Column | str) -> Column:
    return F.concat((as_col(rate) * 100).cast("bigint").cast("string"), F.lit("%"))


def market_cap_text(value: Column | str) -> Column:
    c = F.coalesce(as_col(value).cast("double"), F.lit(0.0))
    jo = F.floor(c / V.JO_IN_EOK).cast("bigint")
    rest = (c - jo * F.lit(float(V.JO_IN_EOK))).cast("bigint")
    return (
        F.when((c >= V.JO_IN_EOK) & (rest > 0),
               F.concat(F.lit("시총 "), jo.cast("string"), F.lit("조 "), grouped(rest), F.lit("억")))
        .when(c >= V.JO_IN_EOK, F.concat(F.lit("시총 "), jo.cast("string"), F.lit("조")))
        .when(c > 0, F.concat(F.lit("시총 "), grouped(c), F.lit("억")))
        .otherwise(F.lit("시총 N/A"))
    )


# --- rounds and shares -----------------------------------------------------

def round_key(label: Column | str) -> Column:
    c = F.lower(F.coalesce(as_col(label), F.lit("")))
    return F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit("-"), F.lit(""))


def round_discount(label: Column | str) -> Column:
    """Discount rate of a funding round."""
    return first_token_value(round_key(label), V.ROUND_DISCOUNTS, V.DEFAULT_DISCOUNT)


def round_rank(label: Column | str) -> Column:
    """Place of a funding round in the usual order; unknown labels come last."""
    return first_token_value(round_key(label), V.ROUND_ORDER, V.LAST_ROUND)


def round_class(label: Column | str) -> Column:
    return first_token_value(round_key(label), V.ROUND_CLASSES, "other")


def shares_or_capital(shares: Column | str, capital: Column | str) -> Column:
    """Share count; missing or zero counts are derived from capital and face value."""
    known, money = as_col(shares), as_col(capital)
    derived = F.when(money > 0, (money / V.FACE_VALUE).cast("bigint"))
    return F.coalesce(F.when(known != 0, known.cast("bigint")), derived, known.cast("bigint"))

