"""Personal data: wide candidate patterns, boosted trees over format and context, calibrated thresholds.

Generators propose overlapping spans.  Spans of the four strict patterns are kept as they are; the others are scored by
gradient-boosted trees whose splits are written out as one expression, so scoring happens inside the row with built-in
functions and nothing is shuffled.  The trees are trained here on a labelled sample, their thresholds on its held-out part.

Defined cases: null text is empty; a text without a hit has empty strings and zero counts; repeated rows each get
their own result; long texts are read whole; other columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerglass.llm import text as tx

KINDS = ["email", "ip", "card", "phone"]

_LOCAL = r"[A-Za-z0-9._%+-]"
#: The strict patterns.  A search that fails at the start of a run of its own characters is not tried again inside it.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: The generators beyond them.
_AT, _DOT = r"(?:[(\[{]at[)\]}]|\x20at\x20|@)", r"(?:[(\[{]dot[)\]}]|\x20dot\x20|\.)"
SPELT_EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++\x20?{_AT}\x20?[A-Za-z0-9-]++(?:\x20?{_DOT}\x20?[A-Za-z0-9-]++){{1,4}}+"
#: A part of every match of it.
SPELT_PART = rf"{_AT}\x20?[A-Za-z0-9-]++\x20?{_DOT}"
COLON_IP = r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+::?){2,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])"
NUMBERS = r"(?<![0-9A-Za-z+.])\(?[0-9][0-9\x20()./_-]{7,30}[0-9](?![0-9A-Za-z])"

FEATURES = ["is_email", "is_ip", "is_card", "is_phone", "chars", "digits", "groups", "longest", "luhn", "zero_start",
            "paren", "dots", "slashes", "hexes", "spelt", "ctx_email", "ctx_ip", "ctx_card", "ctx_phone", "ctx_other",
            "at_sign", "gap_after_dot", "ending", "marked_local", "holds_email", "holds_ip"]


def features(candidate: Column) -> Column:
    """Format and context of a candidate (kind, hit, before) as an array, in the order of ``FEATURES``."""
    kind, hit, before = candidate["rank"], candidate["hit"], F.lower(candidate["before"])
    number = tx.digits(hit)
    groups = F.regexp_extract_all(hit, F.lit("[0-9A-Za-z]+"), F.lit(0))
    values = [
        *[kind == n for n in range(4)],
        F.char_length(hit), F.char_length(number), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.char_length(g))), F.lit(0)),
        F.char_length(number).between(12, 19) & tx.luhn(number), number.startswith("0"), F.contains(hit, F.lit("(")),
        F.char_length(hit) - F.char_length(F.replace(hit, F.lit("."), F.lit(""))), F.contains(hit, F.lit("/")),
        F.regexp_count(hit, F.lit("[A-Fa-f]")), hit.rlike(r"[(\[{](?:at|dot)[)\]}]"),
        before.rlike(r"mail|contact|write|reach"), before.rlike(r"\bip|host|addr|server"),
        before.rlike(r"card|visa|credit|master|amex|paid"), before.rlike(r"phone|tel|call|mobile|cell|fax|dial"),
        before.rlike(r"isbn|order|invoice|version|date|time|page|model|serial|section|\bid\b|since|from [0-9]*$"),
        F.contains(hit, F.lit("@")), hit.rlike(r"\.\x20"), hit.rlike(r"(?:\.|dot[)\]}]?\x20?)[a-z]{2,}$"), hit.rlike(r"^[A-Za-z-]*[._%+0-9]"),
        hit.rlike(EMAIL), hit.rlike(IP),
    ]
    return F.array(*[v.cast("double") for v in values])


def labelled_sample(spark: SparkSession, rows: int = 4400) -> DataFrame:
    """The labelled sample (label, held, kind, hit, before), made from row numbers by hashing.

    It holds ``rows`` candidates, the same in every run: personal data in the formats the strict patterns miss, and
    look-alikes such as dates, times, order numbers and numbers that fail their check.
    """
    row = F.col("id")

    def pick(seed: str, *values: str) -> Column:
        choice = F.floor(tx.chance(row, seed) * len(values)).cast("int")
        return F.get(F.array(*[F.lit(v) for v in values]), choice)

    def number(seed: str, width: int, hexes: bool = False) -> Column:
        code = F.sha2(F.concat(F.lit(seed), row.cast("string")), 256)
        return F.substring(code if hexes else F.translate(code, "abcdef", "013579"), 1, width)

    def grouped(value: Column, *widths: int, by: Column | str = " ") -> Column:
        parts, at = [], 1
        for width in widths:
            parts.append(F.substring(value, at, width))
            at += width
        by = F.lit(by) if isinstance(by, str) else by
        return reduce(lambda a, b: F.concat(a, by, b), parts)

    body = F.concat(F.lit("4"), number("card", 14))
    check = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.when(
        tx.luhn(F.concat(body, d.cast("string"))), d).otherwise(-1)))
    card = F.concat(body, check.cast("string"))
    wrong = F.concat(body, ((check + 1 + F.floor(tx.chance(row, "w") * 9)) % 10).cast("int").cast("string"))
    name, host = pick("n", "jane.roe", "max", "info", "a.b", "sales99"), pick("h", "mail", "example", "web-host", "uni")
    end = pick("e", "com", "org", "net", "de")
    some = pick("some", "", "and then ", "the list of ", "nicht ", "que les ")
    call = pick("call", "call ", "phone: ", "Tel. ", "mobile ", "fax ", "", "it was ")
    sort = pick("sort", ".", " ", "-", "/")
    kinds: list[tuple[int, int, Column, Column]] = [
        (1, 0, F.concat(name, pick("a", " [at] ", "(at)", " {at} "), host, pick("d", " [dot] ", "(dot)", "."), end),
         pick("c0", "mail me: ", "contact ", "", "write to ")),
        (1, 0, F.concat(name, F.lit(" at "), host, F.lit(" dot "), end), pick("c1", "mail me: ", "contact ", "reach me ")),
        (0, 0, F.concat(pick("x", "look", "was", "aim"), F.lit(" at "), pick("y", "noon", "them", "it"), F.lit(". "),
                        pick("z", "The", "So", "Then")), some),
        (0, 0, F.concat(pick("x", "look", "was", "aim"), F.lit(" at "), pick("y", "noon", "3", "it"), F.lit("."), number("v", 1)),
         some),
        (1, 0, F.concat(name, pick("a2", " @ ", " @", "@ "), host, F.lit("."), end), pick("c15", "mail me: ", "", "contact ", "and then ")),
        (1, 0, F.concat(name, F.lit("@"), host, pick("d2", " [dot] ", "(dot)", " dot "), end), pick("c16", "mail me: ", "", "contact ", "and then ")),
        (1, 0, F.concat(pick("n2", "jane.roe", "a.b", "sales99", "max_1"), F.lit(" at "), host, F.lit("."), end),
         pick("c17", "mail me: ", "", "contact ", "and then ")),
        (1, 0, F.concat(pick("n3", "max", "info", "office", "jane"), F.lit(" at "), host, F.lit("."), end),
         pick("c18", "mail me: ", "contact ", "write to ", "reach me: ")),
        (1, 0, F.concat(name, pick("a3", " [at] ", "(at)", " @ "), host, F.lit("."), end, F.lit(". "), pick("z", "The", "So", "Then")),
         pick("c19", "mail me: ", "contact ", "", "write to ")),
        (1, 0, F.concat(name, F.lit("@"), host, F.lit("."), pick("h2", "mail", "web", "uni"), pick("d3", " [dot] ", "(dot)", " dot "), end),
         pick("c20", "mail me: ", "", "contact ", "and then ")),
        (0, 0, F.concat(name, F.lit("@"), host, F.lit("."), end, F.lit(". "), pick("z", "The", "So", "Then")),
         pick("c21", "mail me: ", "contact ", "", "write to ")),
        (0, 3, F.concat(grouped(number("ip4", 8), 2, 2, 2, 2, by="."), F.lit(" "), number("port", 2)), pick("c22", "server ", "", "host ", "ip ")),
        (0, 0, F.concat(pick("x2", "look", "shop", "based", "sold"), F.lit(" at "), host, F.lit("."), end), some),
        (0, 0, F.concat(pick("x3", "look", "meet", "two"), pick("a4", " at ", " @ "), pick("y", "noon", "them", "it"),
                        pick("g", ".", ". "), pick("z", "The", "So", "Then")), some),
        (0, 0, F.concat(pick("x4", "sold", "priced", "12"), F.lit(" @ "), number("v2", 2), F.lit("."), number("v", 2)), some),
        (1, 1, grouped(number("v6", 32, True), 4, 4, 4, 4, 4, 4, 4, 4, by=":"), pick("c2", "host ", "ip: ", "", "address ")),
        (1, 1, F.concat(grouped(number("v6", 12, True), 4, 4, 4, by=":"), F.lit("::"), number("l", 2, True)),
         pick("c3", "server ", "ip ", "address ")),
        (0, 1, grouped(number("t", 6), 2, 2, 2, by=":"), pick("c4", "at time ", "since ", "", "from ")),
        (0, 1, grouped(number("mac", 12, True), 2, 2, 2, 2, 2, 2, by=":"), some),
        (1, 2, grouped(card, 4, 4, 4, 4, by=pick("s", ".", "/", "_", "  ", " - ")), pick("c5", "card ", "visa ", "", "paid by ")),
        (0, 2, grouped(wrong, 4, 4, 4, 4, by=pick("s", ".", "/", " ", "-", " - ")), pick("c6", "card ", "order ", "", "serial ")),
        (0, 2, F.concat(F.lit("978-3-"), grouped(number("isbn", 9), 2, 6, 1, by="-")), pick("c7", "isbn ", "", "book ")),
        (0, 2, grouped(number("cc", 13), 4, 4, 5, by=sort), some),
        (1, 3, F.concat(F.lit("("), number("p", 3), F.lit(") "), grouped(number("q", 7), 3, 4, by="-")), call),
        (1, 3, grouped(number("p", 10), 3, 3, 4, by=pick("ps", "-", ".", " ")), pick("c8", "call ", "phone: ", "Tel. ", "mobile ", "fax ")),
        (1, 3, F.concat(F.lit("0049 "), grouped(number("p", 9), 2, 3, 4, by=" ")), call),
        (1, 3, F.concat(F.lit("0"), grouped(number("p", 9), 2, 7, by=pick("ps2", "/", " ", "-"))), pick("c9", "call ", "phone ", "Tel. ")),
        (0, 3, F.concat(grouped(number("d", 8), 4, 2, 2, by="-"), F.lit(" "), number("hh", 2)), pick("c10", "date ", "", "since ")),
        (0, 3, grouped(number("o", 10), 3, 3, 4, by="-"), pick("c11", "order ", "invoice ", "serial ", "model ", "id ")),
        (0, 3, grouped(number("o", 9), 3, 3, 3, by=pick("os", " ", ".")), some),
        (0, 3, F.concat(number("y", 4), F.lit("-"), number("y2", 4), F.lit(" "), number("y3", 2)), pick("c12", "from ", "page ", "")),
        (0, 3, F.concat(F.lit("978-3-"), grouped(number("isbn", 9), 2, 6, 1, by="-")), pick("c13", "isbn ", "", "book ")),
        (0, 3, grouped(wrong, 4, 4, 4, 4, by=" "), pick("c14", "card ", "", "serial ")),
    ]
    choice = row % len(kinds)

    def by_template(part: int) -> Column:
        out = None
        for n, template in enumerate(kinds):
            value = F.lit(template[part]) if isinstance(template[part], int) else template[part]
            out = F.when(choice == n, value) if out is None else out.when(choice == n, value)
        return out

    return spark.range(0, rows, 1, 2).select(
        by_template(0).cast("double").alias("label"), (tx.chance(row, "fold") < 0.3).alias("held"),
        by_template(1).alias("rank"), by_template(2).alias("hit"), by_template(3).alias("before"))


def _tree(node, values: str) -> str:
    """A decision tree as nested conditions on an array."""
    if node.subtreeDepth() == 0:
        return f"{float(node.prediction())}D"
    split = node.split()
    return (f"IF(get({values}, {split.featureIndex()}) <= {float(split.threshold())}D, "
            f"{_tree(node.leftChild(), values)}, {_tree(node.rightChild(), values)})")


def _score(model: GBTClassificationModel, values: str) -> str:
    """Weighted sum of all trees as SQL: one text to read instead of thousands of calls."""
    return " + ".join(f"{float(weight)}D * {_tree(tree._java_obj.rootNode(), values)}"
                      for tree, weight in zip(model.trees, model.treeWeights))


class PiiModel:
    """Boosted trees with one threshold for each kind."""

    def __init__(self, trees: GBTClassificationModel, thresholds: list[float]) -> None:
        self.score, self.thresholds = _score(trees, "c.values"), thresholds

    def accepted(self, candidates: str) -> Column:
        """Those of an array column of candidates, with their features as ``values``, that are personal data."""
        limits = ", ".join("double('Infinity')" if t == float("inf") else f"{t}D" for t in self.thresholds)
        return F.expr(f"filter({candidates}, c -> {self.score} >= get(array({limits}), c.rank))")


def train(sample: DataFrame, precision: float = 0.98, trees: int = 12, depth: int = 4) -> PiiModel:
    """Fit the trees and calibrate them.

    A kind's threshold is the lowest score from which on at least ``precision`` of the held-out candidates are personal
    data.  Scores are counted in bins by Spark; the driver sees the bins only.
    """
    table = sample.select("label", "held", "rank", features(F.struct("rank", "hit", "before")).alias("values"))
    table = table.withColumn("features", array_to_vector("values"))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32).fit(table.where(~F.col("held")))
    scored = table.where("held").withColumn("score", F.expr(_score(fitted, "values")))
    bins = scored.groupBy("rank", F.floor(F.col("score") * 10).alias("bin")).agg(
        F.sum("label").alias("good"), F.count("*").alias("all")).collect()
    thresholds = []
    for kind in range(len(KINDS)):
        good = total = 0
        best = float("inf")
        for row in sorted((r for r in bins if r["rank"] == kind), key=lambda r: -r["bin"]):
            good, total = good + row["good"], total + row["all"]
            if good < precision * total:
                break
            best = row["bin"] / 10
        thresholds.append(max(best, 0.0))
    return PiiModel(fitted, thresholds)


_MODELS: dict[str, PiiModel] = {}


def model(spark: SparkSession) -> PiiModel:
    """The trained model, once for each session: it depends on a fixed sample only."""
    key = spark.sparkContext.applicationId
    if key not in _MODELS:
        _MODELS[key] = train(labelled_sample(spark))
    return _MODELS[key]


def _small(part: Column) -> Column:
    """Whether a string of digits is at most 255, however long it is."""
    short = F.regexp_replace(part, "^0+", "")
    return (F.char_length(short) <= 3) & (F.coalesce(F.when(F.char_length(short) <= 3, short).try_cast("int"), F.lit(0)) <= 255)


def find_pii(docs: DataFrame, fitted: PiiModel | None = None, column: str = "text") -> DataFrame:
    """Adds ``pii_spans``: all spans of a document by start, then kind, with whether they are base spans."""
    fitted = fitted or model(docs.sparkSession)
    text = tx.whole(F.col(column))
    size = lambda hit: F.char_length(tx.digits(hit))
    base = [
        tx.spans(text, EMAIL, where=F.contains(text, F.lit("@"))),
        tx.spans(text, IP, lambda hit: F.forall(F.split(hit, "[.]"), _small), text.rlike(r"[0-9]\.[0-9]")),
        tx.spans(text, CARD, lambda hit: size(hit).between(12, 19) & tx.luhn(tx.digits(hit)),
                 text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        tx.spans(text, PHONE, lambda hit: size(hit).between(9, 15), text.rlike(r"\+[0-9]")),
    ]
    numbers = tx.spans(text, NUMBERS, lambda hit: size(hit).between(9, 19), text.rlike(r"[0-9][0-9\x20()./_-]{7}"))
    wide = [
        tx.spans(text, SPELT_EMAIL, where=text.rlike(SPELT_PART)),
        tx.spans(text, COLON_IP, where=text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f:]")),
    ]
    base_spans = reduce(F.concat, [tx.labelled(f, n, KINDS[n], True) for n, f in enumerate(base)])
    staged = docs.withColumns({"_base": base_spans, "_numbers": numbers, **{f"_wide{n}": f for n, f in enumerate(wide)}})

    def candidates(found: str, kind: int) -> Column:
        return F.transform(found, lambda s: F.struct(F.lit(kind).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
                                                     s["hit"].alias("hit"), s["before"].alias("before")))

    # Numbers are proposed as cards and as phones, by their digits.
    cards = F.filter(candidates("_numbers", 2), lambda c: size(c["hit"]) >= 12)
    phones = F.filter(candidates("_numbers", 3), lambda c: size(c["hit"]) <= 15)
    proposed = F.concat(candidates("_wide0", 0), candidates("_wide1", 1), cards, phones)
    # Within a base span a proposal says nothing new; one that reaches beyond it is judged like any other.
    proposed = F.filter(proposed, lambda c: ~F.exists("_base", lambda b: (b["start"] <= c["start"]) & (c["end"] <= b["end"])))
    with_values = F.transform(proposed, lambda c: F.struct(c["rank"].alias("rank"), c["start"].alias("start"), c["end"].alias("end"),
                                                           features(c).alias("values")))
    staged = staged.withColumn("_proposed", with_values)
    names = F.array(*[F.lit(k) for k in KINDS])
    extra = F.transform(fitted.accepted("_proposed"), lambda c: F.struct(
        c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), F.get(names, c["rank"]).alias("kind"),
        F.lit(False).alias("base")))
    return staged.withColumn("pii_spans", F.array_sort(F.concat(F.col("_base"), extra))) \
        .drop("_base", "_numbers", "_wide0", "_wide1", "_proposed")
