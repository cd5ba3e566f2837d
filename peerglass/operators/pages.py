"""Facts of landed web pages, read inside the row: no shuffle and no page tree.

A page is cut into pieces once: tags, comments, scripts and the text between them.  What stands inside what is found by one
fold over the pieces that keeps the stack of open tags, so text behind an inner closing tag stays with its block.
The work grows with the pieces of a page times the depth of its nesting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.numbers import first_number, market_cap_eok
from peerglass.functions.text import WHITE, as_col, clean_text, contains_any, first_present, let, strip, tag_text

#: A comment, a script or style with its content, a tag, a text, or a bracket that opens nothing.
PIECE = r"""(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|</?[a-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|<[a-z/!?][^>]*>|[^<]+|<"""
NAME_LENGTH = 24
#: Elements that never hold anything.
EMPTY_ELEMENTS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
                  "script", "style"]
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape(text: Column) -> Column:
    resolved = text
    for entity, char in ENTITIES:
        resolved = F.replace(resolved, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")), resolved).otherwise(text)


def pieces(html: Column | str) -> Column:
    """array<struct<name, closes, text>> of a page in order: tags that open or close something, and stripped texts.

    ``name`` is '' for a text, and a tag has none.  Names and texts are read without patterns: there is one for every few letters.
    """
    found = F.regexp_extract_all(F.coalesce(as_col(html), F.lit("")), F.lit(PIECE), F.lit(0))

    def read(piece: Column) -> Column:
        closes = F.startswith(piece, F.lit("</"))
        head = F.translate(F.substring(piece, F.when(closes, 3).otherwise(2), F.lit(NAME_LENGTH)), "/>\t\n\r\f", " " * 6)
        name = F.lower(F.substring_index(head, " ", 1))
        plain = ~F.startswith(piece, F.lit("<")) | (F.length(piece) == 1)
        none = F.lit("")
        return F.when(plain, F.struct(none.alias("name"), F.lit(False).alias("closes"), F.trim(unescape(piece), F.lit(WHITE)).alias("text"))) \
            .when(~F.startswith(piece, F.lit("<!")) & ~F.startswith(piece, F.lit("<?")) & ~F.endswith(piece, F.lit("/>"))
                  & ~name.isin(*EMPTY_ELEMENTS), F.struct(name.alias("name"), closes.alias("closes"), none.alias("text")))

    return F.filter(F.transform(found, read), lambda p: (p["name"] != "") | (p["text"] != ""))


def _joined(read: Column, sep: str) -> Column:
    texts = F.filter(F.transform(read, lambda p: p["text"]), lambda t: t != "")
    return F.array_join(texts, sep)


def text_of(html: Column | str, sep: str = " ") -> Column:
    """Text of a page fragment: its stripped texts joined, white space made even."""
    return clean_text(_joined(pieces(html), sep))


def longest_block(read: Column, names: Sequence[str], min_chars: int) -> Column:
    """struct<size, first, past> of the longest outermost block, first and past counting pieces from 1; size 0 where none is.

    A closing tag closes the last open tag of its name and all tags opened since; one that has no partner is
    passed over; what is open at the end is closed there.  A block within a block is never longer than that, so only
    the outermost count.
    """
    block = lambda size, first, past: F.struct(size.alias("size"), first.alias("first"), past.alias("past"))
    zero = F.lit(0)
    start = F.struct(F.array().cast("array<string>").alias("stack"), zero.alias("at"), zero.alias("since"), zero.alias("first"),
                     zero.alias("size"), block(zero, zero, zero).alias("best"))

    def better(state: Column) -> Column:
        found = (state["since"] > 0) & (state["size"] >= min_chars) & (state["size"] > state["best"]["size"])
        return F.when(found, block(state["size"], state["first"], state["at"])).otherwise(state["best"])

    def step(state: Column, piece: Column) -> Column:
        stack, since = state["stack"], state["since"]
        opens = (piece["name"] != "") & ~piece["closes"]
        # place of the last open tag of this name, 0 where none is open
        back = F.when(piece["closes"], F.array_position(F.reverse(stack), piece["name"])).otherwise(F.lit(0))

        def after(back: Column) -> Column:
            place = F.when(back > 0, F.size(stack) - back + 1).otherwise(F.lit(0)).cast("int")
            begins = opens & (since == 0) & piece["name"].isin(*names)
            ends = (place > 0) & (place <= since)
            said = F.length(piece["text"])
            more = F.when((since > 0) & (said > 0), said + F.when(state["size"] > 0, 1).otherwise(0)).otherwise(0)
            return F.struct(
                F.when(opens, F.array_append(stack, piece["name"])).when(place > 0, F.slice(stack, F.lit(1), place - 1))
                .otherwise(stack).alias("stack"),
                (state["at"] + 1).alias("at"),
                F.when(begins, F.size(stack) + 1).when(ends, 0).otherwise(since).alias("since"),
                F.when(begins, state["at"] + 2).otherwise(state["first"]).alias("first"),
                F.when(begins, 0).otherwise(state["size"] + more).alias("size"),
                F.when(ends, better(state)).otherwise(state["best"]).alias("best"))

        return let(back, after)

    return F.aggregate(read, start, step, better)


def main_text(html: Column | str, min_chars: int = V.MAIN_TEXT_MIN_CHARS, max_chars: int = V.MAIN_TEXT_MAX_CHARS) -> Column:
    """Longest text block of a page with all that stands in it, shortened for the report; '' where none is long enough."""
    def cut(read: Column) -> Column:
        return let(longest_block(read, V.TEXT_BLOCKS, min_chars), lambda best: F.when(best["size"] > 0, F.left(
            _joined(F.slice(read, best["first"], best["past"] - best["first"] + 1), " "), F.lit(max_chars))).otherwise(F.lit("")))

    return let(pieces(html), cut)


# --- elements ----------------------------------------------------------------


def with_id(value: str) -> str:
    return rf"""\bid\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s/>]))"""


def with_class(value: str) -> str:
    return rf"""\bclass\s*=\s*(?:"(?:[^"]*\s)?{value}(?:\s[^"]*)?"|'(?:[^']*\s)?{value}(?:\s[^']*)?'|{value}(?=[\s/>]))"""


def opening(tag: str, *marks: str) -> str:
    """Pattern of an opening tag with all of the marks."""
    return rf"(?is)<{tag}\b" + "".join(rf"(?=[^>]*{m})" for m in marks) + "[^>]*>"


def element(html: Column | str, tag: str, *marks: str) -> Column:
    """Content of the first element of a kind, with elements of the same kind in it; null where there is none.

    The rest of the page is split at the closing tags; the element ends at the first one before which as many were closed as
    opened.
    """
    def content(parts: Column) -> Column:
        state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("open"), F.lit(0).alias("end"))

        def step(s: Column, part: Column) -> Column:
            def after(opened: Column) -> Column:
                return F.struct((s["at"] + 1).alias("at"), opened.alias("open"),
                                F.when(opened == s["at"], s["at"] + 1).otherwise(0).alias("end"))

            # behind the end nothing is looked at
            return F.when(s["end"] > 0, s).otherwise(let(s["open"] + F.regexp_count(part, F.lit(rf"(?i)<{tag}\b")), after))

        def cut(end: Column) -> Column:
            return F.array_join(F.slice(parts, F.lit(1), F.when(end > 0, end).otherwise(F.size(parts))), f"</{tag}>")

        return let(F.aggregate(parts, state, step)["end"], cut)

    rest = F.try_element_at(F.split(as_col(html), opening(tag, *marks), 2), F.lit(2))
    return let(F.split(rest, rf"(?i)</{tag}\s*>", -1), content)


def table_rows(table: Column, body_only: bool = False) -> Column:
    """Contents of the rows of a table, those of its bodies only if so asked."""
    row = F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\s*>|</table\s*>|\z)")
    if not body_only:
        return F.regexp_extract_all(table, row, F.lit(1))
    bodies = F.regexp_extract_all(table, F.lit(r"(?is)<tbody\b[^>]*>(.*?)(?:</tbody\s*>|\z)"), F.lit(1))
    return F.flatten(F.transform(bodies, lambda body: F.regexp_extract_all(body, row, F.lit(1))))


def cell(row: Column, tag: str, *marks: str) -> Column:
    """Content of the first cell of a kind in a row; null where there is none."""
    return F.try_element_at(F.regexp_extract_all(
        row, F.lit(opening(tag, *marks) + rf"(.*?)(?=</{tag}\s*>|<t[hdr]\b|\z)"), F.lit(1)), F.lit(1))


def product_list(html: Column | str, table_id: str = V.PRODUCT_TABLE_ID) -> Column:
    """'name (ratio%)' items of the product table, comma separated; '' where the page has no such table.

    Only rows in the bodies of the table with this id count; a row ends where the next one begins.  A name is the marked part of the heading cell or all of it, a ratio
    the marked number cell or the first one; rows without either are left out.
    """
    def item(row: Column) -> Column:
        heading = cell(row, "th")
        marked = F.try_element_at(F.regexp_extract_all(
            row, F.lit(r"(?is)<th\b(?:(?!</th|<td\b).)*?" + opening("span", with_class("cut")).removeprefix("(?is)") + r"(.*?)</span"), F.lit(1)), F.lit(1))
        plain = lambda c: strip(F.replace(text_of(c), F.lit(" "), F.lit("")))
        return F.struct(
            plain(F.coalesce(marked, heading)).alias("name"),
            plain(F.coalesce(cell(row, "td", with_class("c2"), with_class("num")), cell(row, "td"))).alias("ratio"),
            (heading.isNotNull() & cell(row, "td").isNotNull()).alias("whole"))

    rows = table_rows(F.coalesce(element(html, "table", with_id(table_id)), F.lit("")), body_only=True)
    return listed_pairs(F.filter(F.transform(rows, item), lambda p: p["whole"] & (p["name"] != "") & (p["ratio"] != "")))


def element_pairs(html: Column | str, pattern: str) -> Column:
    """array<struct<name, ratio>> of a repeated page element, blanks left out.

    ``pattern`` has two groups.
    """
    c = as_col(html)
    names = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda part: text_of(part))
    values = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(2)), lambda part: text_of(part))
    pairs = F.zip_with(names, values, lambda n, v: F.struct(n.alias("name"), v.alias("ratio")))
    return F.filter(pairs, lambda p: (p["name"] != "") & (p["ratio"] != ""))


def listed_pairs(pairs: Column) -> Column:
    """'name (ratio%)' items, comma separated."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit(" ("), p["ratio"], F.lit("%)"))), ", ")


def page_title(html: Column | str) -> Column:
    """Title of a page: heading first, then the title element."""
    return first_present(tag_text(html, "h1"), tag_text(html, "title"))


# --- listing metrics -----------------------------------------------------------


def _row_value(rows: Column, term: str, upper: bool = False, inner: str | None = None) -> Column:
    """Text of the first value cell of the first row whose heading names the term."""
    def named(row: Column) -> Column:
        heading = text_of(cell(row, "th"))
        return cell(row, "td").isNotNull() & F.contains(F.upper(heading) if upper else heading, F.lit(term))

    def value(found: Column) -> Column:
        held = found if inner is None else F.coalesce(element(found, inner), found)
        return F.when(found.isNotNull(), text_of(held))

    return let(cell(F.try_element_at(F.filter(rows, named), F.lit(1)), "td"), value)


def _node_text(html: Column, scope: Column, node_id: str) -> Column:
    """Text of a marked value, looked for in its own part of the page first."""
    return text_of(F.coalesce(element(scope, "em", with_id(node_id)), element(html, "em", with_id(node_id))), "")


def _ratio(html: Column, table: Column, rows: Column, node_id: str, term: str) -> Column:
    """A multiple: the marked value, else the row of that name in the multiples table; null where it says there is none."""
    def raw(marked: Column) -> Column:
        missing = marked.isin("", *V.PAGE_NA_MARKS)
        return F.when(missing, F.coalesce(_row_value(rows, term), marked)).otherwise(marked)

    def number(text: Column) -> Column:
        return F.when(~F.contains(text, F.lit("N/A")) & ~text.isin("", *V.PAGE_NA_MARKS), first_number(text))

    return let(let(_node_text(html, table, node_id), raw), number)


def _market_cap(page: Column, first: Column) -> Column:
    def captioned(tables: Column) -> Column:
        named = F.filter(tables, lambda t: F.contains(text_of(element(t, "caption")), F.lit(V.MARKET_CAP_TERM)))
        rows = table_rows(F.coalesce(F.try_element_at(named, F.lit(1)), F.lit("")), body_only=True)
        return _row_value(rows, V.MARKET_CAP_TERM, inner="em")

    tables = F.regexp_extract_all(F.coalesce(first, F.lit("")), F.lit(opening("table") + r"(.*?)</table"), F.lit(1))
    text = let(_node_text(page, first, "_market_sum"), lambda marked: F.when(marked != "", marked).otherwise(captioned(tables)))
    return let(text, lambda c: F.when(c.isNotNull() & ~c.isin("", *V.PAGE_NA_MARKS), market_cap_eok(c)).otherwise(F.lit(0.0)))


def listing_metrics(html: Column | str, fundamentals: Column | str, min_chars: int = V.MIN_PAGE_CHARS) -> Column:
    """struct<is_warning, market_cap, per, pbr, ev_ebitda> of a listing page and the company's page of fundamentals.

    Every value has a place where it is looked for first and others after it.  A page that is too short gives no facts: no
    warning, a market cap of 0 and no multiples.
    """
    def read(page: Column) -> Column:
        table = element(page, "table", with_class("per_table"))
        ratios = let(table, lambda t: let(table_rows(t), lambda rows: F.struct(
            _ratio(page, t, rows, "_per", "PER").alias("per"), _ratio(page, t, rows, "_pbr", "PBR").alias("pbr"))))
        warned = contains_any(text_of(element(page, "div", with_class("wrap_company"))), V.WARNING_TERMS)
        cap = let(element(page, "div", with_class("first")), lambda first: _market_cap(page, first))
        return F.struct(warned.alias("is_warning"), cap.alias("market_cap"), ratios.alias("ratios"))

    def fund(page: Column) -> Column:
        table = element(element(page, "div", with_class("fund"), with_class("fl_le")), "table", with_class("gHead03"))
        return first_present(_row_value(table_rows(F.coalesce(table, F.lit("")), body_only=True), "EV/EBITDA", upper=True))

    whole = F.length(as_col(html)) >= min_chars
    return let(let(F.when(whole, as_col(html)), read), lambda f: F.struct(
        F.coalesce(f["is_warning"], F.lit(False)).alias("is_warning"), F.coalesce(f["market_cap"], F.lit(0.0)).alias("market_cap"),
        f["ratios"]["per"].alias("per"), f["ratios"]["pbr"].alias("pbr"),
        F.when(whole, first_number(fund(as_col(fundamentals)))).alias("ev_ebitda")))
