"""Pages written as a text file each."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.session import local_folder

#: Characters that Spark's writers spell as %XX in a folder's name, and its name for no value.
_ESCAPED = {ord(sign): f"%{ord(sign):02X}" for sign in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\{[]^\x7f"]}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_page_files(pages: DataFrame, path: str, by: list[str], text: str) -> None:
    """Write every text to a file of its own, its path naming the columns ``by``.

    A line end follows each text, and texts of equal keys that share a task are one
    file. On local and mounted disks the tasks make the files themselves, each task in
    one folder and under names like ``source=a,page=1.txt``: a folder per file would
    take more of the disk than most files. A file has a hidden name until it is whole,
    so that a task run again replaces its own files. In other stores Spark's writer
    makes a folder per key, ``source=a/page=1/``.
    """
    folder = local_folder(pages.sparkSession, path)
    if folder is None:
        # every task moves its own files; by default the driver moves them all, one after another
        writer = pages.select(*by, text).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.partitionBy(*by).text(path)
        return
    os.makedirs(folder)  # as Spark's writers do, this one refuses a folder that is there
    # a line end within the binary text, so that the tasks only write
    rows = pages.select(
        *[F.col(name).cast("string").alias(name) for name in by],
        F.concat(F.coalesce(F.col(text).cast("binary"), F.lit(b"")), F.lit(b"\n")).alias("_text"),
    ).sortWithinPartitions(*by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into, made = f"{folder}/{TaskContext.get().partitionId():05d}", 0
        for key, texts in groupby(_rows(batches), key=lambda row: row[:-1]):
            names = (_NO_VALUE if not value else value.translate(_ESCAPED) for value in key)
            file = ",".join(f"{name}={value}" for name, value in zip(by, names, strict=True)) + ".txt"
            if not made:
                os.makedirs(into, exist_ok=True)
            with open(hidden := f"{into}/.part", "wb") as out:
                out.writelines(row[-1] for row in texts)
            os.replace(hidden, f"{into}/{file}")
            made += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([made], pa.int64())})

    rows.mapInArrow(write, "files bigint").agg(F.sum("files")).first()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)
