"""Readers for fetched pages."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylake import schemas
from vacancylake.session import local_folder, materialize


#: Column that takes the text of a row which could not be read.
_CORRUPT = "_corrupt"

#: Names of files that Hadoop's readers decompress.
_COMPRESSED = r"(?i)\.(bz2|deflate|gz|lz4|lzo|snappy|zst)$"

#: Most files and bytes that a task reads, and bytes or rows that leave it at once.
_TASK_FILES, _TASK_BYTES = 4096, 32 << 20
_BATCH_FILES, _BATCH_BYTES = 1024, 4 << 20


def _read_pages(spark: SparkSession, path: str, layout: str, **options) -> DataFrame:
    if layout not in ("parquet", "json", "orc"):
        raise ValueError(f"unsupported page layout: {layout}")
    return spark.read.schema(schemas.PAGES).format(layout).options(**options).load(path)


def read_api_pages(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    """Fetched JSON pages, the body kept as text."""
    return _read_pages(spark, path, layout)


class CheckedPages(NamedTuple):
    pages: DataFrame  # rows that could be read, as :data:`schemas.PAGES`
    rejects: DataFrame  # file, reason, record: rows and files that could not
    files: DataFrame  # file, bytes, modified, rows, rejected: all that lay there


def read_checked_pages(spark: SparkSession, path: str, layout: str = "parquet") -> CheckedPages:
    """Fetched pages with what could not be read named instead of lost or fatal.

    JSON lines that do not parse, or hold a value of the wrong type, are rejected
    with their text. Of Parquet and ORC files the rows that can be decoded are kept;
    a file that gave fewer rows than its footer states is rejected as a file, and so
    is one that gave none, be its footer unreadable or empty. ORC itself turns a value
    of the wrong type into null. A compressed JSON file cut short fails the read: how
    many lines it lacks cannot be known. Files of no bytes are passed over. The rows
    are written once to the checkpoint folder, so that the three results agree.
    """
    file = F.col("_metadata.file_path").alias("_file")
    names = [field.name for field in schemas.PAGES]
    if layout == "json":
        wide = T.StructType([*schemas.PAGES.fields, T.StructField(_CORRUPT, T.StringType())])
        reader = spark.read.schema(wide).option("columnNameOfCorruptRecord", _CORRUPT)
        rows = reader.json(path, mode="PERMISSIVE").select("*", file)
        stated = None
    else:
        found = _read_pages(spark, path, layout, ignoreCorruptFiles=True)
        rows = found.select("*", F.lit(None).cast("string").alias(_CORRUPT), file)
        # without any column a scan reads the footers alone
        stated = found.groupBy(file).agg(F.count("*").alias("_stated"))
    rows = materialize(rows)
    bad = F.col(_CORRUPT).isNotNull()
    per_file = rows.groupBy("_file").agg(F.count("*").alias("rows"), F.count_if(bad).alias("rejected"))
    listed = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("_file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    same_name = F.regexp_replace("_file", "^file:/+", "file:///")  # the two readers write local names differently
    files = listed.withColumn("_file", same_name).join(per_file.withColumn("_file", same_name), "_file", "left")
    rejects = rows.filter(bad).select(
        same_name.alias("file"), F.lit("Row could not be read").alias("reason"), F.col(_CORRUPT).alias("record")
    )
    if stated is not None:
        files = files.join(stated.withColumn("_file", same_name), "_file", "left")
        whole = F.coalesce(F.col("rows") == F.col("_stated"), F.lit(False))
        short = F.concat(F.lit("Only "), F.coalesce("rows", F.lit(0)), F.lit(" of "), "_stated", F.lit(" rows could be read"))
        reason = F.coalesce(short, F.lit("No row could be read"))
        named = files.filter(~whole).select(F.col("_file").alias("file"), reason.alias("reason"))
        rejects = rejects.unionByName(named.withColumn("record", F.lit(None).cast("string")))
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("rows", "rejected")]
    return CheckedPages(
        rows.filter(~bad).select(*names), rejects, files.select(F.col("_file").alias("file"), "bytes", "modified", *counts)
    )


def read_page_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """One page per file; ``pattern`` captures the source and page number from its path."""
    files = _local_files(spark, path)
    if files is None:
        found = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        files = found.select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_modified"),
            F.col("value").alias("_body"),
        )
    name = F.col("_file")
    return files.select(
        F.regexp_extract(name, pattern, 1).alias("source"),
        F.regexp_extract(name, pattern, 2).try_cast("int").alias("page_no"),
        name.alias("url"),
        F.lit(200).alias("status_code"),
        F.when(F.lower(name).endswith(".json"), "application/json")
        .otherwise("text/html")
        .alias("content_type"),
        F.col("_body").alias("body"),
        F.col("_modified").alias("fetched_at"),
    )


def _local_files(spark: SparkSession, path: str) -> DataFrame | None:
    """All files below a folder on a local or mounted disk, as Spark's text reader gives them.

    Spark's reader keeps an entry per file on the driver, lists in a task per folder and
    counts every file as 4 MB when it deals them out. Here the driver lists only the
    folder's own names; tasks walk what lies below these, and the files found are dealt
    out by their number and bytes. None where Spark's reader is needed: in another
    store, for a pattern, a single file or compressed files.
    """
    root = local_folder(spark, path)
    if root is None or not os.path.isdir(root):
        return None
    names = pa.table({"name": pa.array([name for name in os.listdir(root) if _is_data(name)], pa.string())})
    cores = spark.sparkContext.defaultParallelism

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                for entry in _files_at(f"{root.rstrip('/')}/{name}"):
                    found.append(entry)
                    if len(found) == 10_000:
                        yield _listed(found)
                        found = []
            yield _listed(found)

    entries = spark.createDataFrame(names, "name string").repartition(cores)
    listed = materialize(entries.mapInArrow(walk, "path string, bytes bigint, modified bigint"))
    total = listed.agg(F.count("*"), F.sum("bytes"), F.bool_or(F.col("path").rlike(_COMPRESSED))).first()
    n_files, n_bytes, compressed = total[0], total[1] or 0, total[2]
    if compressed:
        return None
    tasks = max(cores, -(-n_files // _TASK_FILES), -(-n_bytes // _TASK_BYTES))
    read = listed.select("path", "modified").repartition(tasks, "path").mapInArrow(
        _read_files, "_file string, _modified bigint, _body binary"
    )
    return read.select("_file", F.timestamp_millis("_modified").alias("_modified"), F.col("_body").cast("string").alias("_body"))


def _is_data(name: str) -> bool:
    """Whether Spark's readers look at a file or folder of this name."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _files_at(path: str) -> Iterator[tuple[str, int, int]]:
    """Path, bytes and modification time in milliseconds of each file at or below a path; empty files are passed over."""
    try:
        if not os.path.isdir(path):
            state = os.stat(path)
            if state.st_size > 0:
                yield path, state.st_size, state.st_mtime_ns // 1_000_000
            return
        names = os.listdir(path)
    except FileNotFoundError:  # removed meanwhile, or a link that leads nowhere
        return
    for name in names:
        if _is_data(name):
            yield from _files_at(f"{path}/{name}")


def _listed(found: list[tuple[str, int, int]]) -> pa.RecordBatch:
    paths, sizes, times = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_pydict(
        {"path": pa.array(paths, pa.string()), "bytes": pa.array(sizes, pa.int64()), "modified": pa.array(times, pa.int64())}
    )


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files' names as Spark gives them, and what they hold."""

    def batch_of(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
        names, times, bodies = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict(
            {"_file": pa.array(names, pa.string()), "_modified": pa.array(times, pa.int64()), "_body": pa.array(bodies, pa.binary())}
        )

    rows, held = [], 0
    for batch in batches:
        for path, modified in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with open(path, "rb") as file:
                body = file.read()
            rows.append((_file_uri(path), modified, body))
            held += len(body)
            if held >= _BATCH_BYTES or len(rows) >= _BATCH_FILES:
                yield batch_of(rows)
                rows, held = [], 0
    if rows:
        yield batch_of(rows)


def _file_uri(path: str) -> str:
    """A local path as Java writes it in a URI: letters beyond ASCII stay, spaces and signs do not."""
    safe = "/;:@&=+$,-_.!~*'()"
    if path.isascii():
        return "file:" + quote(path, safe=safe)
    plain = (c if not c.isascii() and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc") else quote(c, safe=safe) for c in path)
    return "file:" + "".join(plain)


def read_html_pages(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    """Fetched HTML pages up to each source's first page of another kind."""
    return html_pages(_read_pages(spark, path, layout))


def html_pages(pages: DataFrame) -> DataFrame:
    """Pages before the first non-HTML page of their source, body as ``html``."""
    from vacancylake.operators.spread import attach

    is_html = F.coalesce(F.lower("content_type").contains("text/html"), F.lit(False))
    stops = non_html_warnings(pages).select("source", F.col("page_no").alias("_stop"))
    return (
        attach(pages.filter(is_html), stops, ["source"], "left")
        .filter(F.col("_stop").isNull() | (F.col("page_no") < F.col("_stop")))
        .drop("_stop")
        .withColumnRenamed("body", "html")
    )


def non_html_warnings(pages: DataFrame) -> DataFrame:
    """The page at which each source ended because it was not HTML."""
    is_html = F.coalesce(F.lower("content_type").contains("text/html"), F.lit(False))
    first = F.min_by(F.struct("page_no", "content_type"), "page_no").alias("_p")
    return (
        pages.filter(~is_html)
        .groupBy("source")
        .agg(first)
        .select(
            "source",
            "_p.page_no",
            F.concat(
                F.lit("Page "), F.col("_p.page_no").cast("string"),
                F.lit(" returned non-HTML content: "), F.coalesce("_p.content_type", F.lit("")),
            ).alias("warning"),
        )
    )
