"""Company documents as JSON files and JSON lines."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from peerglass import fixed_values as V
from peerglass.functions.payload import is_valid_document

BUSINESS_MIX_SCHEMA = (
    "generated_at string, corp_code string, rcept_no string, report_nm string, rcept_dt string, "
    "dart_viewer_url string, zip_path string, source_file string, table_index bigint, score bigint, "
    "confidence string, business_mix map<string,double>, "
    "debug struct<status:string,reason:string,segment_col:string,ratio_col:string,ratio_kind:string>"
)
MANIFEST_SCHEMA = (
    "generated_at string, raw_root string, items array<struct<zip_path:string,file_count:bigint,"
    "files:array<struct<name:string,ext:string,size:bigint,compress_size:bigint>>,"
    "candidates_top10:array<struct<name:string,ext:string,size:bigint,compress_size:bigint>>,"
    "corp_code:string,rcept_no:string>>"
)

RESERVED = frozenset('/\\%:*?"<>|{}[]#')


def file_name(name: str, suffix: str = "") -> str:
    """A file name for any company name: what a path or a reader would take for its own is percent-encoded."""
    if not name:
        raise ValueError("a document needs a company name")
    encoded = "".join(quote(c, safe="") if c in RESERVED or ord(c) < 0x20 else c for c in name)
    if encoded[0] in "._~":  # hidden files are not read
        encoded = f"%{ord(encoded[0]):02X}{encoded[1:]}"
    full = encoded + suffix
    if len(full.encode()) > 255:
        raise ValueError(f"the name of a company is too long for a file: {name[:40]}...")
    return full


@dataclass
class WrittenDocuments(WriterCommitMessage):
    """What a task has written: file names, and the folder they wait in."""

    folder: str
    files: list[str]


class DocumentWriter(DataSourceWriter):
    """Two phases: tasks write into folders of their own, and only when all have ended the files move to their place.

    A task that is run twice, or a job that fails, leaves nothing that a reader would find.
    """

    def __init__(self, path: str, suffix: str, overwrite: bool) -> None:
        self.path, self.suffix, self.overwrite = path, suffix, overwrite
        self.waiting = f"_temporary-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.path)
        return store, root.rstrip("/")

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        store, root = self._store()
        folder = f"{root}/{self.waiting}/{TaskContext.get().taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        files: set[str] = set()
        for name, text in iterator:
            file = file_name(name, self.suffix)
            if file in files:
                raise ValueError(f"two documents of one company: {name}")
            files.add(file)
            with store.open_output_stream(f"{folder}/{file}") as out:
                out.write((text or "").encode())
        return WrittenDocuments(folder, sorted(files))

    def commit(self, messages: list) -> None:
        store, root = self._store()
        found = [(m.folder, file) for m in messages if m is not None for file in m.files]
        names = {file for _, file in found}
        if len(names) < len(found):
            raise ValueError(f"{len(found) - len(names)} companies have two documents")
        with ThreadPoolExecutor(16) as pool:  # renames wait for the store, not for this machine
            list(pool.map(lambda f: store.move(f"{f[0]}/{f[1]}", f"{root}/{f[1]}"), found))
            if self.overwrite:
                there = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
                gone = [f.path for f in there if f.is_file and f.path.endswith(self.suffix) and f.base_name not in names]
                list(pool.map(store.delete_file, gone))
        self.abort(messages)

    def abort(self, messages: list) -> None:
        store, root = self._store()
        with contextlib.suppress(OSError):
            store.delete_dir(f"{root}/{self.waiting}")


class CompanyDocuments(DataSource):
    """Sink of (name, text) rows: one named file for each."""

    @classmethod
    def name(cls) -> str:
        return "company_documents"

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], self.options.get("suffix", V.DOCUMENT_SUFFIX), overwrite)


def write_documents(df: DataFrame, path: str, name: str = "company", suffix: str = V.DOCUMENT_SUFFIX, mode: str = "overwrite") -> None:
    """One JSON document per company, in one file named after it.

    The path is one that Arrow's file systems know (a local folder, hdfs, s3, gs).  Two documents of one company are an error.
    """
    df.sparkSession.dataSource.register(CompanyDocuments)
    body = F.to_json(F.struct(*[c for c in df.columns if c != name]), {"ignoreNullFields": "false"})
    df.select(F.col(name).cast("string").alias("name"), body.alias("text")).write.format("company_documents").mode(mode) \
        .option("suffix", suffix).save(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*" + V.DOCUMENT_SUFFIX, suffix: str = V.DOCUMENT_SUFFIX,
                   encoded: bool = False) -> DataFrame:
    """(file, name, text) of the JSON files a pattern finds; the name is the file name without its suffix.

    ``encoded``: names were made by ``write_documents``, so their percent signs are decoded.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)

    def decoded(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))  # only a plus stands for itself

    file = decoded(F.col("_metadata.file_name"))  # given in URL form
    name = F.when(F.endswith(file, F.lit(suffix)), F.left(file, F.length(file) - len(suffix))).otherwise(file)
    return files.select(file.alias("file"), (decoded(name) if encoded else name).alias("name"), F.col("value").alias("text"))


def valid_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are JSON objects and carry no error."""
    return df.filter(is_valid_document(text))


def parse_json_keep_raw(df: DataFrame, text: str, schema: str | T.StructType) -> DataFrame:
    """Parsed payload; malformed text is kept in ``raw_text`` with ``parse_error`` set."""
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*wanted.fields, T.StructField("_raw", T.StringType())])
    parsed = F.from_json(F.col(text), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"})
    rest = [c for c in df.columns if c != text]
    return df.withColumn("_j", parsed).select(
        *rest, *[F.col(f"_j.{f.name}") for f in wanted.fields],
        F.col("_j._raw").alias("raw_text"), F.col("_j._raw").isNotNull().alias("parse_error"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: str = BUSINESS_MIX_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
