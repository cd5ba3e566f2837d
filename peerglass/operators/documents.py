"""File inventories, text bundles and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.text import as_col, clean_cell, clean_header, doc_type, entity_from_filename, file_ext
from peerglass.operators.distributed import text_parts, top_k_per_key


def file_inventory(listing: DataFrame, path: str = "path", *, exts: Sequence[str] = tuple(V.SUPPORTED_EXTS),
                   ignore: Sequence[str] = tuple(V.IGNORE_FOLDERS)) -> DataFrame:
    """One row per supported file: company, document type, file name, extension.

    Paths are relative to the data folder: 'company/file' or a file in the
    root, whose company is read from its name.  Deeper files and ignored
    folders are left out.
    """
    parts = F.split(path, "/")
    depth = F.size(parts)
    name = F.element_at(parts, -1)
    in_root = depth == 1
    rows = listing.filter(depth <= 2).withColumn("file_name", name).withColumn("ext", file_ext(name))
    kept = rows.filter(F.col("ext").isin(*exts) & ~F.element_at(parts, 1).isin(*ignore))
    company = F.when(in_root, entity_from_filename("file_name")).otherwise(F.element_at(parts, 1))
    return kept.withColumn("company", company).withColumn("doc_type", doc_type("file_name", in_root=in_root))


def first_main_doc(files: DataFrame, *, company: str = "company", order: str = "path") -> DataFrame:
    """Per company: file count, files per type, and the first PDF of the main type."""
    main = (F.col("doc_type") == V.ROOT_PDF_DOC_TYPE) & (F.col("ext") == ".pdf")
    kinds = [*V.DOC_TYPES, V.OTHER_DOC_TYPE]
    return files.groupBy(company).agg(
        F.count(F.lit(1)).alias("n_files"),
        *[F.count_if(F.col("doc_type") == kind).alias(f"n_type_{i}") for i, kind in enumerate(kinds)],
        F.min(F.when(main, F.col(order))).alias("main_doc"),
    )


def pending(inputs: DataFrame, outputs: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs that have no output yet."""
    return inputs.join(outputs.select(*keys), keys, "left_anti")


def guard_pages(pages: DataFrame, html: str = "html", status: str | None = None,
                min_chars: int = V.MIN_PAGE_CHARS) -> DataFrame:
    """``reject_reason`` of pages that are too short or did not answer with 200."""
    size = F.coalesce(F.length(html), F.lit(0))
    reason = F.lit(None).cast("string")
    if status is not None:
        reason = F.when(F.col(status) != 200, F.concat(F.lit("HTTP "), F.col(status).cast("string")))
    short = F.when(size < min_chars, F.concat(F.lit("too short: "), size.cast("string")))
    return pages.withColumn("reject_reason", F.coalesce(reason, short))


def manifest_files(manifest: DataFrame) -> DataFrame:
    """File rows of an archive manifest: nested items and files flattened."""
    items = manifest.select(F.explode("items").alias("i")).select("i.*")
    return items.select("zip_path", "corp_code", "rcept_no", F.explode("files").alias("f")).select(
        "zip_path", "corp_code", "rcept_no", "f.*"
    )


def manifest_candidates(files: DataFrame, archive: str = "archive", name: str = "name", size: str = "size",
                        k: int = V.MANIFEST_TOP_FILES) -> DataFrame:
    """The k largest files of each archive, with the archive's file count."""
    counts = files.groupBy(archive).agg(F.count(F.lit(1)).alias("file_count"))
    top = top_k_per_key(files.select(archive, name, size), [archive], [F.desc(size), F.asc(name)], k)
    return top.join(counts, archive)


def document_bundle(sections: DataFrame, *, doc: str = "doc_id", position: str = "section_no", name: str = "name",
                    text: str = "text", main: Column | None = None, per_part: int = 256) -> DataFrame:
    """Sections of each document in order under their markers, in numbered parts.

    The main document (``main`` true) and empty sections are left out.
    """
    kept = sections if main is None else sections.filter(~main)
    kept = kept.filter(F.coalesce(F.col(text), F.lit("")) != "")
    head, tail = V.SUPPLEMENT_MARKER.split("{name}")
    marked = F.concat(F.lit("\n\n" + head), F.col(name), F.lit(tail + "\n"), F.col(text))
    rows = kept.select(doc, position, marked.alias("_marked"))
    return text_parts(rows, [doc], position, "_marked", "bundle", per_part)


def table_row_text(cells: Column | str) -> Column:
    """Cells of a table row as pipe-separated text, nulls blank."""
    return F.array_join(F.transform(as_col(cells), clean_cell), " | ")


def table_text(rows: DataFrame, headers: DataFrame, *, table: Sequence[str] = ("page_no", "table_no"),
               row_no: str = "row_no", cells: str = "cells", per_part: int = 1024) -> DataFrame:
    """Tables as pipe-separated text in numbered parts.

    ``headers`` holds one row per table; header and separator line come with
    every part, so each part is a readable table.  Blank header cells are named
    after their position; a table without a header row is given as plain lines.
    """
    lines = rows.select(*table, row_no, table_row_text(cells).alias("_line"))
    parts = text_parts(lines, list(table), row_no, "_line", "_body", per_part, separator="\n")
    head = headers.select(*table, clean_header(cells).alias("_head"))
    rule = F.array_join(F.transform("_head", lambda _: F.lit("---")), " | ")
    return parts.join(head, list(table), "left").select(
        *table, "part_no", "n_items",
        F.concat_ws("\n", table_row_text("_head"), rule, F.col("_body")).alias("table_text"),
    )
