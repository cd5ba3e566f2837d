"""JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerglass.functions.text import as_col, strip


def salvage_json(value: Column | str) -> Column:
    """JSON text inside a free answer: fences dropped, first '{' to last '}'; else '{}'."""
    c = strip(F.coalesce(as_col(value), F.lit("")))
    c = F.regexp_replace(c, r"^```[a-zA-Z]*\s*", "")
    c = F.regexp_replace(c, r"\s*```\z", "")
    body = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    text = F.when(body != "", body).otherwise(c)
    return F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.lit("{}"))


def is_valid_document(value: Column | str) -> Column:
    """True for a JSON object without an ``error`` key at its top."""
    keys = F.json_object_keys(as_col(value))
    return F.coalesce(~F.array_contains(keys, "error"), F.lit(False))


def kv_lookup(items: Column | str, code: str, key: str = "code", value: str = "value") -> Column:
    """Value of the first item of an array of structs that carries a code."""
    hits = F.filter(as_col(items), lambda item: item[key] == code)
    return F.try_element_at(hits, F.lit(1))[value]
