"""Text keys, clean-ups and classifications."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerglass import fixed_values as V

# White space as a text tool sees it: with no-break space and separators.
SPACE = r"(?U)[\s\x1C-\x1F]"
#: The same characters one by one.
WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(value: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(as_col(value), rf"{SPACE}+\z|\A{SPACE}+", "")


def text_key(value: Column | str) -> Column:
    """Matching key of an industry name: no punctuation, no white space; null gives ''."""
    c = F.coalesce(as_col(value), F.lit(""))
    c = F.replace(c, F.lit(V.KEY_REPLACEMENT[0]), F.lit(V.KEY_REPLACEMENT[1]))
    return F.translate(c, V.KEY_PUNCTUATION + WHITE, "")


def name_key(value: Column | str) -> Column:
    """Matching key of a company name, address or page text."""
    c = F.lower(F.coalesce(as_col(value), F.lit("")))
    for mark in V.COMPANY_MARKS:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return F.regexp_replace(c, V.NAME_KEY_DROP, "")


def name_clean(value: Column | str) -> Column:
    """Company name for display: bracketed parts and company marks removed."""
    c = F.regexp_replace(as_col(value), r"\(.*?\)", "")
    for mark in V.COMPANY_MARKS[:2]:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return strip(c)


def clean_text(value: Column | str) -> Column:
    """White-space runs to one blank, ends trimmed; null gives ''."""
    c = F.regexp_replace(F.coalesce(as_col(value), F.lit("")), rf"{SPACE}+", " ")
    return F.trim(c)


def clean_cell(value: Column | str) -> Column:
    """Table cell: null gives '', line breaks become blanks, ends trimmed."""
    return strip(F.replace(F.coalesce(as_col(value), F.lit("")), F.lit("\n"), F.lit(" ")))


def clean_header(cells: Column | str) -> Column:
    """Header cells of a table; a blank one is named after its position."""
    return F.transform(
        as_col(cells),
        lambda cell, i: F.when(clean_cell(cell) == "", F.concat(F.lit("Column_"), i.cast("string")))
        .otherwise(clean_cell(cell)),
    )


def period_header(value: Column | str) -> Column:
    """Period header without blanks, quotes, brackets and line breaks."""
    return F.translate(as_col(value), " '()\n", "")


def break_numbered_steps(value: Column | str) -> Column:
    """Start a new line before a numbered step that follows a unit."""
    return F.regexp_replace(as_col(value), V.NUMBERED_STEP, "$1\n$2")


def bracket_title(value: Column | str) -> Column:
    c = strip(F.coalesce(as_col(value), F.lit("")))
    return F.when((c != "") & ~F.startswith(c, F.lit("[")), F.concat(F.lit("["), c, F.lit("]"))).otherwise(c)


def digits_only(value: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(as_col(value), F.lit("")), "[^0-9]+", "")


def contains_any(value: Column | str, terms: Sequence[str]) -> Column:
    """True where the text contains one of the terms."""
    c = as_col(value)
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(c, F.lit(term))
    return hit


def flag_keywords(value: Column | str, terms: Sequence[str] = tuple(V.WARNING_TERMS)) -> Column:
    """Risk flag: one of the terms occurs in the text, white space made even first."""
    return contains_any(clean_text(value), terms)


def first_token_value(value: Column, table, default) -> Column:
    """Value of the first table row one of whose tokens the text contains."""

    def pick(text: Column) -> Column:
        chain = None
        for tokens, result in table:
            cond = contains_any(text, [tokens] if isinstance(tokens, str) else tokens)
            chain = F.when(cond, F.lit(result)) if chain is None else chain.when(cond, F.lit(result))
        return chain.otherwise(F.lit(default))

    return let(value, pick)


def first_present(*values: Column | str, marks: Sequence[str] = tuple(V.PAGE_NA_MARKS)) -> Column:
    """First value that is neither null, blank nor one of the no-value marks."""
    return F.coalesce(*[let(clean_text(value), lambda c: F.when((c != "") & ~c.isin(*marks), c)) for value in values])


def file_stem(value: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(as_col(value), r"(?<=.)\.[^.]*$", "")


def file_ext(value: Column | str) -> Column:
    """Lower-cased last extension with its dot, '' where there is none."""
    return F.lower(F.regexp_extract(as_col(value), r"(?s)^.+(\.[^.]*)$", 1))


def doc_type(file_name: Column | str, rules: Sequence[str] = tuple(V.DOC_TYPES),
             in_root: Column | None = None) -> Column:
    """First rule word found in the file name; root-level PDFs count as the main type."""
    name = F.lower(as_col(file_name))
    rest = F.lit(V.OTHER_DOC_TYPE)
    if in_root is not None:
        rest = F.when(in_root & F.endswith(name, F.lit(".pdf")), F.lit(V.ROOT_PDF_DOC_TYPE)).otherwise(rest)
    chain = None
    for rule in rules:
        cond = F.contains(name, F.lit(rule.lower()))
        chain = F.when(cond, F.lit(rule)) if chain is None else chain.when(cond, F.lit(rule))
    return chain.otherwise(rest)


def entity_from_filename(file_name: Column | str) -> Column:
    """Company named by a file: text before ' IR', else before '_', else before a blank."""
    stem = file_stem(file_name)
    cut = (
        F.when(F.contains(stem, F.lit(" IR")), F.split_part(stem, F.lit(" IR"), F.lit(1)))
        .when(F.contains(stem, F.lit("_")), F.split_part(stem, F.lit("_"), F.lit(1)))
        .otherwise(F.split_part(stem, F.lit(" "), F.lit(1)))
    )
    return strip(cut)


def filename_date(file_name: Column | str) -> Column:
    """'YYYY.MM' from a file name; null where there is none or the month is not valid."""
    c = as_col(file_name)
    year, month = (F.regexp_extract(c, V.FILENAME_DATE, i) for i in (1, 2))
    return F.when((year != "") & month.between("01", "12"), F.concat_ws(".", year, month))


def split_path(path: Column | str) -> list[Column]:
    """(root, company key, receipt key, file) of a back-slash separated storage path."""
    parts = F.split(as_col(path), r"\\")
    return [F.try_element_at(parts, F.lit(i)) for i in range(1, 5)]


def viewer_url(prefix: str, receipt: Column | str) -> Column:
    """Address of the viewer page of one receipt key."""
    return F.concat(F.lit(prefix), as_col(receipt))


# --- pages -----------------------------------------------------------------

def strip_tags(html: Column | str) -> Column:
    """Text of a page fragment: tags become blanks, common entities are resolved."""
    c = F.regexp_replace(as_col(html), r"<[^>]*>", " ")
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(text))
    return clean_text(c)


def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first element of a kind, '' where there is none."""
    return strip_tags(F.regexp_extract(as_col(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))
