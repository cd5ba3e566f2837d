"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder; a cluster must name one.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _temporary()


_OWN: list[str] = []


def _temporary() -> str:
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="peerglass-"))
    return _OWN[0]


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session with a setting that is afterwards what it was."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Scratch:
    """Tables of one run.  ``cut`` writes and rereads a table, ``drop`` deletes those that nothing needs any more.

    What a returned result still reads goes when the program ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path, self.count = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.written: dict[str, str] = {}
        atexit.register(self._end)

    def cut(self, frame: DataFrame, key: str | None = None) -> DataFrame:
        """Write the table and read it back; an older table of the same key is deleted afterwards.

        Shuffle files of the write go as soon as it ends, and not when the driver happens to collect its garbage: by then a large
        table's steps would have left several of them.
        """
        self.count += 1
        path = f"{self.path}/{self.count}"
        with _setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            frame.write.parquet(path)
        if key is not None:
            self.drop(key)
            self.written[key] = path
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *keys: str) -> None:
        for key in keys:
            if key in self.written:
                _remove(self.spark, self.written.pop(key))

    def _end(self) -> None:
        with contextlib.suppress(Exception):  # the session may have ended already
            _remove(self.spark, self.path)
