"""URL filter: pattern rules found by their rarest token.

A rule is a regular expression over ``host/path``, with the literal words that every match must hold as whole words.  Each rule is filed
under the one that is rarest in the URLs.  A URL's words fetch the rules filed under them, and only those run
their expression.  Rules without such a word are tried on every URL.

The rules are a parameter and come as a table; the joins leave it to Spark whether they are small enough to be sent to all
tasks.  Word counts are summed before they are shuffled, and only words of rules are counted.

Defined cases: a null URL, or one without ``://``, has an empty host and path, and the verdict for no rule; equal rows each get
a row; an empty table gives an empty result; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerglass.llm import text as tx

#: Fixed values: (verdict, host, path) of the rules whose longest match decides.
SITE_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

#: Words that mark a page as spam in its host or as a folder of its path; the verdict where no site rule fits.
BAD_WORDS = ("ads adserver banner casino cheap click doubleclick farm gambling lottery malware phishing pills poker popup porn "
             "spam tracker tracking viagra warez xxx").split()


def word_rules(words: list[str]) -> list[tuple[str, str]]:
    """(pattern, words) of rules that match a whole word of the host, or a whole folder of the path."""
    return [(rf"^[^/]*(?<![0-9a-z]){w}(?![0-9a-z])|/{w}(?=/|$)", w) for w in words]


def rule_table(spark: SparkSession, site: list[tuple[str, str, str]] | None = None, words: list[str] | None = None) -> DataFrame:
    """(rule, verdict, pattern, words): site rules have a name, the others none."""
    rows = []
    for verdict, host, path in site if site is not None else SITE_RULES:
        # the path may go on behind the rule's, so its last word need not be whole
        whole = re.findall(r"[0-9a-z]+", host) + re.findall(r"[0-9a-z]+(?=[^0-9a-z])", path.lower())
        rows.append((host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", " ".join(whole)))
    rows += [(None, "block", pattern, literal) for pattern, literal in word_rules(BAD_WORDS if words is None else words)]
    fields = [F.struct(F.lit(n).alias("id"), F.lit(r).cast("string").alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("pattern"),
                       F.lit(w).alias("words")) for n, (r, v, p, w) in enumerate(rows)]
    return spark.range(1).select(F.explode(F.array(*fields)).alias("r")).select("r.*")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lowered, and path of a URL."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))
    host = tx.lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _words(text: Column) -> Column:
    """Words of rules and URLs, lowered."""
    return F.array_distinct(F.regexp_extract_all(tx.lower_ascii(text), F.lit("[0-9a-z]+"), F.lit(0)))


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, column: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict: that of the longest site rule, else block where any other rule matches, else allow."""
    rules = rules if rules is not None else rule_table(pages.sparkSession)
    host, path = host_and_path(F.col(column))
    made = ["host", "path", "rule", "verdict"]
    urls = pages.select(F.col(column)).withColumns({"host": host, "path": path}) \
        .select("host", "path", F.concat("host", "path").alias("site")).where("site <> ''").groupBy("host", "path", "site").agg(
            F.count("*").alias("many"))
    # The empty word stands for rules without any, and every URL has it.
    words = urls.select("site", "many", F.explode(F.array_append(_words(F.col("site")), F.lit(""))).alias("word"))

    # Each rule under its rarest word.
    literal = rules.select("id", F.explode_outer(_words(F.col("words"))).alias("word")).fillna("", ["word"])
    seen = words.join(literal.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.sum("many").alias("seen"))
    filed = literal.join(seen, "word", "left").groupBy("id").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "word"))["word"].alias("word"))
    fetched = words.select("site", "word").join(rules.join(filed, "id"), "word")
    shown = F.when(F.col("rule").isNull(), tx.lower_ascii(F.col("site"))).otherwise(F.col("site"))
    matched = fetched.where(F.regexp_like(shown, F.col("pattern")))
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.char_length("rule").alias("size"), "rule", "verdict")))
    verdicts = matched.groupBy("site").agg(best.alias("best"), F.max(F.when(F.col("rule").isNull(), F.col("verdict"))).alias("other")) \
        .withColumnRenamed("site", "v_site")

    out = pages.select(F.struct("*").alias("_row"), F.col(column).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    out = out.withColumns({"host": host, "path": path})
    out = out.join(verdicts, F.concat("host", "path") == F.col("v_site"), "left")
    kept = [F.col("_row")[c].alias(c) for c in pages.columns if c not in made]
    return out.select(*kept, "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", "other", F.lit("allow")).alias("verdict"))
