"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/") + "/"
    relative = F.regexp_replace("path", rf"^.*?{_quote(base)}", "")
    return files.select(relative.alias("path"), "length", F.col("modificationTime").alias("modified"))


def _quote(text: str) -> str:
    return r"\Q" + text + r"\E"
