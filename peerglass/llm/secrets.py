"""Secret scan: fixed patterns plus two character Markov models.

A token is a secret where the model of random strings explains its character pairs better than the model of ordinary
identifiers by more than a calibrated log-likelihood ratio.  Both models are pair counts over labelled samples, counted
by Spark.  All work on texts is built-in functions inside the row: no shuffle.

Defined cases: null text is empty; a text without a hit has empty strings and zero counts; repeated rows each get
their own result; long texts are read whole; other columns are kept.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerglass.llm import text as tx

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Generic tokens that stand alone; any of them may be a secret.
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}+(?![\p{L}\p{N}])"
KINDS = ["assign", "access", "hex", "random"]

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Parts of ordinary identifiers and words, the labelled negatives are put together from them.
PARTS = (
    "get set user name file path read write list index count value data table column row key config server client "
    "request response message error handler manager service factory builder parser string number array object node "
    "tree graph edge weight model train test batch size layer input output buffer stream socket thread process queue "
    "task event time date start end first last next previous page view form button label image color width height "
    "account order invoice payment customer product price total tax shipping address city country street phone mail "
    "the and of to in for with that this from have were been which their there would about these other into could "
    "ung keit schaft lich heit sprach arbeit gesell verein einander entwick ueber unter zwischen ment tion eau elle "
    "ción dad mente ando iendo ado ida ero ista able ness ship ward less ful ing ed er est ly"
).split()


def labelled_tokens(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """The labelled sample (label, fold, token): ``rows`` random strings and as many ordinary identifiers.

    Made from row numbers by hashing, so it is the same in every run; its size is the parameter.
    """
    def pick(n: int) -> Column:
        return F.element_at(parts, (F.floor(tx.chance(F.col("id"), n) * len(PARTS)) + 1).cast("int"))

    parts = F.split(F.lit(" ".join(PARTS)), " ")
    ids = spark.range(rows)
    seed = F.concat(F.lit("sample"), F.col("id").cast("string"))
    raw = F.unhex(F.substring(F.sha2(seed, 256), 1, 2 * 24))
    strings = F.when(F.col("id") % 4 == 0, F.regexp_replace(F.base64(raw), "[\r\n]", "")) \
        .when(F.col("id") % 4 == 1, F.regexp_replace(F.base64(raw), "[^A-Za-z0-9]", "")) \
        .when(F.col("id") % 4 == 2, F.translate(F.base64(raw), "+/=\r\n", "-_")) \
        .otherwise(F.lower(F.regexp_replace(F.base64(raw), "[^A-Za-z0-9]", "")))
    words = [pick(n) for n in range(6)]
    names = F.when(F.col("id") % 6 == 0, F.concat_ws("_", *words[:4])) \
        .when(F.col("id") % 6 == 1, F.concat(words[0], *[F.initcap(w) for w in words[1:4]])) \
        .when(F.col("id") % 6 == 2, F.concat_ws("-", *words[:3], F.floor(tx.chance(F.col("id"), 9) * 3000).cast("string"))) \
        .when(F.col("id") % 6 == 3, F.concat_ws("/", *words[:5])) \
        .when(F.col("id") % 6 == 4, F.upper(F.concat_ws("_", *words[:4]))) \
        .otherwise(F.concat(*words))
    fold = tx.chance(F.col("id"), "fold") < 0.25
    return ids.select(F.lit(1).alias("label"), fold.alias("held"), strings.alias("token")).unionByName(
        ids.select(F.lit(0).alias("label"), fold.alias("held"), names.alias("token")))


def _pairs(token: Column) -> Column:
    """Places in the flat table of character pairs, one for each pair of neighbours."""
    size = len(ALPHABET) + 1
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.zip_with(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, 2, F.size(codes)),
                      lambda a, b: a * size + b)


def _ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a token: random against ordinary."""
    return F.aggregate(_pairs(token), F.lit(0.0), lambda total, at: total + F.get(table, at))


def train(sample: DataFrame, rate: float = 0.005) -> tuple[list[float], float]:
    """The table of log ratios of all character pairs and the threshold.

    Only counts of character pairs and two quantiles reach the driver; all are bounded by the alphabet.  The threshold lies
    midway between the value that all but ``rate`` of the held-out ordinary tokens stay below and the one that as
    many of the random strings exceed.
    """
    size = len(ALPHABET) + 1
    counts = sample.where(~F.col("held")).select("label", F.explode(_pairs(F.col("token"))).alias("pair")) \
        .groupBy("label", "pair").count().collect()
    seen = {(row["label"], row["pair"]): row["count"] for row in counts}

    def log_share(label: int, first: int, second: int) -> float:
        total = sum(seen.get((label, first * size + c), 0) for c in range(size))
        return math.log((seen.get((label, first * size + second), 0) + 0.5) / (total + 0.5 * size))

    table = [log_share(1, a, b) - log_share(0, a, b) for a in range(size) for b in range(size)]
    score = _ratio(F.col("token"), literal(table))
    held = sample.where("held").withColumn("score", score)
    ordinary, strings = held.agg(
        F.percentile(F.when(F.col("label") == 0, F.col("score")), F.lit(1 - rate)),
        F.percentile(F.when(F.col("label") == 1, F.col("score")), F.lit(rate))).first()
    return table, (ordinary + strings) / 2


def literal(values: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{v:.6f}" for v in values)), ",").cast("array<double>")


_MODELS: dict[tuple, tuple[list[float], float]] = {}


def model(spark: SparkSession) -> tuple[list[float], float]:
    """The trained models, once for each session: they depend on fixed samples only."""
    key = (spark.sparkContext.applicationId,)
    if key not in _MODELS:
        _MODELS[key] = train(labelled_tokens(spark))
    return _MODELS[key]


def find_secrets(docs: DataFrame, models: tuple[list[float], float] | None = None, column: str = "text") -> DataFrame:
    """Adds ``secret_spans``: all spans of a document by start, then kind, with whether they are base spans."""
    table, threshold = models or model(docs.sparkSession)
    text = tx.whole(F.col(column))
    assign = tx.spans(text, ASSIGN, lambda hit: F.char_length(F.regexp_extract(hit, ASSIGN, 1)) >= 12,
                      text.rlike("[:=]"))
    access = tx.spans(text, ACCESS, where=F.contains(text, F.lit("AKIA")))
    hexes = tx.spans(text, HEX, where=text.rlike(HEX))
    wide = tx.spans(text, CANDIDATE, lambda hit: _ratio(hit, literal(table)) > threshold, text.rlike(CANDIDATE))
    base = reduce(F.concat, [tx.labelled(found, n, KINDS[n], True) for n, found in enumerate([assign, access, hexes])])
    staged = docs.withColumn("_base", base).withColumn("_wide", wide)
    # a token within a base span says nothing new; one that reaches beyond it does, and redact() merges the two
    extra = F.filter(tx.labelled(F.col("_wide"), 3, KINDS[3], False), lambda x: ~F.exists(
        F.col("_base"), lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    return staged.withColumn("secret_spans", F.array_sort(F.concat(F.col("_base"), extra))).drop("_base", "_wide")


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge into the first."""
    state = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def add(s: Column, x: Column) -> Column:
        start = F.greatest(s["at"], x["start"])
        piece = F.concat(F.substring(tx.whole(text), s["at"] + 1, F.greatest(start - s["at"], F.lit(0))),
                         F.when(x["start"] >= s["at"], F.concat(F.lit("["), x["kind"], F.lit("]"))).otherwise(F.lit("")))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.array_append(s["out"], piece).alias("out"))

    done = F.aggregate(found, state, add)
    return F.concat(F.array_join(done["out"], ""), F.substring(tx.whole(text), done["at"] + 1, F.char_length(tx.whole(text))))
