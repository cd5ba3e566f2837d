"""Company records: merge, patch, schema checks and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StructField, StructType, VariantType

from peerglass import fixed_values as V
from peerglass.functions.text import as_col, let
from peerglass.operators.distributed import join_split, rank_in_ranges, top_k_per_key
from peerglass.operators.reporting import clean_series


# --- small reshapes --------------------------------------------------------

def coalesce_alias(*lists: Column | str) -> Column:
    """First non-empty list among the names a field had over time."""
    return F.coalesce(*[F.when(F.size(as_col(c)) > 0, as_col(c)) for c in lists])


def default_when_empty(items: Column | str, row: Column) -> Column:
    """A list, or a list of one default row where it is empty or missing."""
    c = as_col(items)
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, c).otherwise(F.array(row))


def split_categories(rows: DataFrame, category: str = "category") -> DataFrame:
    """A row that names both exit routes becomes one row for each."""
    upper = F.upper(category)
    both = F.contains(upper, F.lit("M&A")) & F.contains(upper, F.lit("IPO"))
    cats = F.when(both, F.array(F.lit("M&A"), F.lit("IPO"))).otherwise(F.array(F.col(category)))
    rest = [c for c in rows.columns if c != category]
    return rows.select(*rest, F.explode(cats).alias(category))


def similarity_details(scores: DataFrame, k: int = V.SIMILAR_STORED, *, target: str = "t",
                       company: str = "company") -> DataFrame:
    """The k best similarity rows of each target as an ordered list of structs."""
    kept = top_k_per_key(scores, [target], [F.desc("score"), F.asc(company)], k, "no")
    item = F.struct("no", company, "score", "reason", "main_products")
    return kept.groupBy(target).agg(F.array_sort(F.collect_list(item)).alias("similarity"))


def mix_long(rows: DataFrame, mix: str = "business_mix") -> DataFrame:
    """One row per segment of a business mix; companies without any keep a null row."""
    rest = [c for c in rows.columns if c != mix]
    return rows.select(*rest, F.explode_outer(mix).alias("segment", "ratio"))


def segment_numbers(long: DataFrame, segment: str = "segment") -> DataFrame:
    """(segment, segment_no): the distinct segment names numbered in order from 0."""
    names = long.select(segment).filter(F.col(segment).isNotNull()).distinct()
    numbered = rank_in_ranges(names.withColumn("_all", F.lit(0)), ["_all"], [segment], "segment_no")
    return numbered.drop("_all")


def mix_numbered(long: DataFrame, keys: Sequence[str], numbers: DataFrame) -> DataFrame:
    """(keys, mix): ratios of each company as a map keyed by segment number; null ratios and missing segments have no entry.

    The wide form of a mix whose segments are too many for columns, or not known when the plan is made.
    """
    # segment names repeat over the companies, so their table is joined in parts where one is hot
    numbered = join_split(long, numbers, "segment", "left")
    entry = F.when(F.col("ratio").isNotNull(), F.struct("segment_no", "ratio"))
    picked = numbered.groupBy(*keys, "segment_no").agg(F.min(entry).alias("_entry")).groupBy(*keys)
    return picked.agg(F.map_from_entries(F.array_sort(F.collect_list("_entry"))).alias("mix"))


def mix_wide(long: DataFrame, keys: Sequence[str], segments: Sequence[str]) -> DataFrame:
    """One column for each of the given segments in sorted order, null where absent.

    One aggregate over conditions: no list of names passes through the driver.
    """
    named = {s: F.max(F.when(F.col("segment") == s, F.col("ratio"))).alias(s) for s in sorted(set(segments))}
    return long.groupBy(*keys).agg(*named.values())


def matrix_cells(rows: DataFrame, matrix: str = "matrix", *, key: str = "company_id") -> DataFrame:
    """Statement cells of a matrix struct<Columns, Rows>: (key, row_no, label, col_no, period, value).

    The first column holds the labels.  Cells that a short row lacks are null; a
    matrix without rows gives no cell.  Everything stays inside the row.
    """
    lines = rows.select(key, F.col(f"{matrix}.Columns").alias("_heads"),
                        F.posexplode(f"{matrix}.Rows").alias("row_no", "_line"))
    heads = F.slice("_heads", 2, F.greatest(F.size("_heads") - 1, F.lit(0)))
    cells = lines.select(key, "row_no", F.try_element_at("_line", F.lit(1)).alias("label"), "_line",
                         F.posexplode(heads).alias("_at", "period"))
    return cells.select(key, "row_no", "label", (F.col("_at") + 1).alias("col_no"), "period",
                        F.try_element_at("_line", F.col("_at") + 2).alias("value"))


# --- merge and patch -------------------------------------------------------

def overlay_maps(base: Column, later: Column) -> Column:
    """Union of two maps; the later one wins on equal keys."""
    names = F.map_keys(later)
    kept = F.map_filter(base, lambda k, _: ~F.exists(names, lambda name: name == k))
    return F.when(base.isNull(), later).when(later.isNull(), base).otherwise(F.map_concat(kept, later))


def merge_sections(sections: Sequence[DataFrame], key: str = "t", record: str = "record") -> DataFrame:
    """One record per company from section maps; later sections win.

    Sections are stacked and meet in one shuffle; a company's list holds one
    map of each section, so it does not grow with the data.
    """
    stacked = reduce(DataFrame.unionByName, [
        s.select(key, F.struct(F.lit(i).alias("no"), F.col(record).alias("map")).alias("_part"))
        for i, s in enumerate(sections)])
    parts = stacked.groupBy(key).agg(F.collect_list("_part").alias("_parts"))
    none = F.lit(None).cast(stacked.schema["_part"].dataType["map"].dataType)

    def of(no: int) -> Column:
        return F.filter("_parts", lambda p: p["no"] == no)

    in_order = F.flatten(F.array(*[of(no) for no in range(len(sections))]))  # maps have no order, so no sort
    return parts.select(key, F.aggregate(in_order, none, lambda done, p: overlay_maps(done, p["map"])).alias(record))


def move_rating(record: Column | str, header: Column | str, name: str = "Investment_Rating") -> Column:
    """Header map with the rating of the record copied into it, where there is one."""
    rec = as_col(record)
    head = F.coalesce(as_col(header), F.create_map().cast("map<string,string>"))
    moved = F.create_map(F.lit(name), rec[name])
    return F.when(F.map_contains_key(rec, name), overlay_maps(head, moved)).otherwise(head)


LONGER, IF_EMPTY, SERIES, OVERLAY, REPLACE = "longer", "if_empty", "series", "overlay", "replace"


def _size(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def _chosen(policy: str, base: Column, patch: Column, b: Column, p: Column, overlaid: Column) -> Column:
    """What a policy makes of two values; ``b`` and ``p`` are their sizes."""
    if policy == LONGER:
        return F.when(p > b, patch).otherwise(base)
    if policy == IF_EMPTY:
        return F.when((p > 0) & (b == 0), patch).otherwise(base)
    if policy == SERIES:
        return F.when((p > 1) & (b <= 1), patch).otherwise(base)
    if policy == OVERLAY:
        return F.when(p > 0, overlaid).otherwise(base)
    return F.coalesce(patch, base)


def patch_merge(base: DataFrame, patch: DataFrame, policies: dict[str, str], key: str = "t") -> DataFrame:
    """Fields of a record completed from a patch, each by its policy.

    longer: the longer list wins; if_empty: fills an empty list; series: fills
    a list of at most one row from one of more; overlay: maps merged, patch
    wins; replace: patch wins where present.
    """
    other = patch.select(key, *[F.col(c).alias(f"_p_{c}") for c in policies])
    joined = base.join(other, key, "left")

    def merged(name: str, policy: str) -> Column:
        b, p = F.col(name), F.col(f"_p_{name}")
        sized = policy != REPLACE
        return _chosen(policy, b, p, _size(b) if sized else None, _size(p) if sized else None,
                       overlay_maps(b, p) if policy == OVERLAY else None)

    rest = [c for c in base.columns if c not in policies]
    return joined.select(*rest, *[merged(c, how).alias(c) for c, how in policies.items()])


#: Policies of a report document by path.
REPORT_POLICIES = {
    "Financial_Status": {"Investment_History": LONGER},
    "Growth_Potential": {
        "Target_Market_Trends": IF_EMPTY,
        "Export_and_Contract_Stats": {name: SERIES for name in V.CHART_SERIES},
    },
    "Key_Personnel": {"CEO_Reference": OVERLAY, "Team_Capability": OVERLAY},
    "Valuation_and_Judgment": {"Valuation_Logic_Detail": REPLACE},
}


def _entries(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))


def _known(value: Column) -> Column:
    """A value, with the null of a document as no value."""
    return F.when(~F.is_variant_null(value), value)


def normalised_series(value: Column, header: str) -> Column:
    """A chart series with its header row and readable [year, value] rows behind it, as a document value."""
    head = F.array(F.lit(V.CHART_YEAR).cast("variant"), F.lit(header).cast("variant"))

    def rows(series: Column) -> Column:
        pairs = F.transform(series, lambda r: F.array(r["year"].cast("variant"), r["value"].cast("variant")))
        return F.to_variant_object(F.concat(F.array(head), pairs))

    # fewer than two rows are none to clean_series
    return let(F.try_variant_get(value, "$", "array<array<string>>"),
               lambda given: F.when(F.size(given) >= 2, let(clean_series(given), rows)).otherwise(F.to_variant_object(F.array(head))))


def _patched(base: Column, patch: Column, policy: str | dict, name: str = "") -> Column:
    if isinstance(policy, dict):
        def merged(old: Column, new: Column) -> Column:
            made = F.map_from_entries(F.filter(F.array(*[
                F.struct(F.lit(field).alias("key"), _patched(
                    _known(F.try_element_at(old, F.lit(field))), _known(F.try_element_at(new, F.lit(field))), below, field).alias("value"))
                for field, below in policy.items()]), lambda e: e["value"].isNotNull()))
            # plain comparisons: in profiles isin, and map_contains_key after it, was the costliest step of the merge
            rest = F.map_filter(old, lambda k, _: reduce(Column.__and__, [k != field for field in policy]))
            return F.to_variant_object(F.map_concat(rest, made))

        both = let(F.struct(_entries(base).alias("b"), _entries(patch).alias("p")), lambda e: merged(e["b"], e["p"]))
        return F.when(base.isNotNull() | patch.isNotNull(), both)

    if policy == REPLACE:
        return _chosen(policy, base, patch, None, None, None)
    kind = "map<string,variant>" if policy == OVERLAY else "array<variant>"
    sized = lambda v: F.greatest(F.size(F.try_variant_get(v, "$", kind)), F.lit(0))

    def chosen(e: Column) -> Column:
        overlaid = let(F.struct(_entries(e["b"]).alias("b"), _entries(e["p"]).alias("p")),
                       lambda m: F.to_variant_object(overlay_maps(m["b"], m["p"]))) if policy == OVERLAY else None
        # sizes are counted only where they decide
        value = F.when(e["p"].isNull(), e["b"]).otherwise(_chosen(policy, e["b"], e["p"], sized(e["b"]), sized(e["p"]), overlaid))
        return normalised_series(value, V.CHART_SERIES.get(name, name)) if policy == SERIES else value

    return let(F.struct(base.alias("b"), patch.alias("p")), chosen)


def patch_documents(base: DataFrame, patch: DataFrame, policies: dict | None = None, *, key: str = "t", doc: str = "doc") -> DataFrame:
    """Documents (variant) completed from patch documents by a tree of policies.

    Objects named in the tree are walked on both sides at once; what the tree does not name stays as it is.  A field that
    only the patch has is filled by its policy.  Chart series come out normalised whether patched or not, and one that is
    missing is a header alone.
    """
    joined = base.join(patch.select(key, F.col(doc).alias("_patch")), key, "left")
    merged = _patched(_known(F.col(doc)), _known(F.col("_patch")), policies or REPORT_POLICIES)
    return joined.withColumn(doc, merged).drop("_patch")


# --- section schemas -------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """A field a section must have; ``path`` uses dots, '[]' marks list items."""

    path: str
    kind: str = "STRING"
    nullable: bool = False
    exact_len: int | None = None


def listed_fields(listed: Sequence[tuple[str, str]]) -> list[Field]:
    return [Field(path, kind, path in V.NULLABLE_FIELDS, V.FIELD_LENGTHS.get(path)) for path, kind in listed]


FINANCE_FIELDS = listed_fields(V.FINANCE_FIELDS)
MARKET_FIELDS = listed_fields(V.MARKET_FIELDS)
TECH_FIELDS = listed_fields(V.TECH_FIELDS)
PERSONNEL_FIELDS = listed_fields(V.PERSONNEL_FIELDS)
VALUATION_FIELDS = listed_fields(V.VALUATION_FIELDS)


class _Node:
    """Rules by path: what holds for a value, for its fields, and for the items of its list."""

    def __init__(self) -> None:
        self.rule: Field | None = None
        self.fields: dict[str, _Node] = {}
        self.items: _Node | None = None

    def size(self) -> int:
        below = [*self.fields.values(), *([self.items] if self.items else [])]
        return (self.rule is not None) + sum(node.size() for node in below)


def rule_tree(spec: Sequence[Field]) -> _Node:
    root = _Node()
    for field in spec:
        node = root
        for step in field.path.split("."):
            node = node.fields.setdefault(step.removesuffix("[]"), _Node())
            if step.endswith("[]"):
                node.items = node.items or _Node()
                node = node.items
        node.rule = field
    return root


def _fault(value: Column, field: Field) -> Column:
    """'fault:path' of one value, null where it is right.  What is right, as most values are, is told by one look."""
    text = lambda fault: F.lit(None if fault is None else f"{fault}:{field.path}").cast("string")
    if field.kind == "ARRAY":  # cheaper than to spell out the type of a whole list
        size = F.size(F.try_variant_get(value, "$", "array<variant>"))  # null or below 0 where it is none
        fault = F.when(size == field.exact_len if field.exact_len is not None else size >= 0, text(None))
        fault = fault.when(size >= 0, text("length"))
    else:
        fault = F.when(F.schema_of_variant(value) == field.kind, text(None))
    fault = fault.when(value.isNull(), text(None if field.nullable else "missing"))
    return fault.when(F.is_variant_null(value), text(None if field.nullable else "null")).otherwise(text("type"))


def _walk(value: Column, node: _Node, in_list: bool = False) -> Column:
    """Faults below a value: one place for each rule of the node, null where it holds.

    Every field is looked up once, in the value it stands in; the items of a list are read in one go.  Outside lists the
    engine itself computes a shared look-up once; inside, values are bound by name.
    """
    def field(name: str, below: _Node) -> Column:
        found = F.try_variant_get(value, f"$.{name}", "variant")
        leaf = not below.fields and below.items is None
        return _walk(found, below, in_list) if leaf or not in_list else let(found, lambda v: _walk(v, below, True))

    def items(below: _Node) -> Column:
        none = F.array(*[F.lit(None).cast("string")] * below.size())
        first = F.aggregate(
            F.try_variant_get(value, "$", "array<variant>"), none,
            lambda found, item: F.zip_with(found, _walk(item, below, True), lambda old, new: F.coalesce(old, new)))
        return F.coalesce(first, none)

    parts = [F.array(_fault(value, node.rule))] if node.rule else []
    parts += [field(name, below) for name, below in node.fields.items()]
    parts += [items(node.items)] if node.items else []
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _shape(node: _Node) -> DataType:
    """Type that takes a value apart along the rules below it, down to values that are read by themselves."""
    if node.fields and not node.items and not node.rule:
        return StructType([StructField(name, _shape(below)) for name, below in node.fields.items()])
    if node.items and not node.fields:
        return ArrayType(_shape(node.items))
    return VariantType() if not node.fields and not node.items else NullType()


def _can_shape(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_can_shape(field.dataType) for field in kind)
    # a list within a list would hide which of its items is none
    return isinstance(kind.elementType, StructType) and all(
        isinstance(f.dataType, VariantType) for f in kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, VariantType)


def _shaped_faults(value: Column, node: _Node, doc: Column, path: str = "$") -> Column:
    """``_walk`` over a value that was taken apart: the same faults in the same places."""
    if node.items:
        none = F.array(*[F.lit(None).cast("string")] * node.items.size())
        right = lambda item: reduce(Column.__and__, [
            F.coalesce(F.schema_of_variant(item[name]) == below.rule.kind, F.lit(False)) for name, below in node.items.fields.items()])
        faults = lambda item: F.array(*[_fault(item[name], below.rule) for name, below in node.items.fields.items()])
        # items are looked through one by one only where one is not plainly right
        first = F.when(F.exists(value, lambda item: ~right(item)), F.aggregate(
            value, none, lambda found, item: F.zip_with(found, faults(item), lambda old, new: F.coalesce(old, new))))
        parts = [F.coalesce(first, none)]
        if node.rule:  # what is no list here may be a missing one, a null or another value
            length = node.rule.exact_len
            good = value.isNotNull() if length is None else F.size(value) == length
            whole = _fault(F.try_variant_get(doc, path, "variant"), node.rule)
            parts.insert(0, F.array(F.when(~F.coalesce(good, F.lit(False)), whole)))
    elif node.fields:
        parts = [_shaped_faults(value[name], below, doc, f"{path}.{name}") for name, below in node.fields.items()]
    else:
        parts = [F.array(_fault(value, node.rule))]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def violations(doc: Column, spec: Sequence[Field]) -> Column:
    """Broken rules of a document (variant column), in order of their paths' first mention; of a list its first faulty item counts.

    Where the rules ask for objects, lists of flat objects and single values, a document is taken apart in one pass; other rules
    are walked value by value.
    """
    tree = rule_tree(spec)
    shape = _shape(tree)
    if not tree.fields or not _can_shape(shape):
        return F.array_compact(_walk(doc, tree))
    return F.array_compact(let(F.struct(doc.alias("doc"), F.try_variant_get(doc, "$", shape.simpleString()).alias("read")),
                               lambda s: _shaped_faults(s["read"], tree, s["doc"])))


def schema_violations(docs: DataFrame, json: str, spec: Sequence[Field]) -> DataFrame:
    """``violations``: every broken rule of a section; 'unreadable' for malformed JSON.

    The text is parsed once per row, and the parsed value is walked once along the tree of rules.
    """
    parsed = docs.withColumn("_doc", F.try_parse_json(json))
    unreadable = F.array(F.lit("unreadable"))
    found = F.when(F.col("_doc").isNull(), unreadable).otherwise(violations(F.col("_doc"), spec))
    return parsed.withColumn("violations", found).drop("_doc")


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without violations, rows with some)."""
    clean = F.size("violations") == 0
    return checked.filter(clean), checked.filter(~clean)
