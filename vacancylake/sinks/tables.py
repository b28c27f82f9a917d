"""Snapshot, append and reject writers."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Published versions, a small file each, named by their number.
_VERSIONS = "_versions"


class Version(NamedTuple):
    number: int
    folder: str
    tag: str


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's FileContext, Path and rename option for a location."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    fs_package = jvm.org.apache.hadoop.fs
    location = fs_package.Path(path)
    context = fs_package.FileContext.getFileContext(
        location.getFileSystem(conf).getUri(), conf
    )
    return context, fs_package, conf


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    context, package, _ = _hadoop(spark, path)
    folder = package.Path(path)
    if not context.util().exists(folder):
        return []
    return sorted(status.getPath().getName() for status in context.util().listStatus(folder))


def _version(spark: SparkSession, path: str, name: str) -> Version:
    context, package, _ = _hadoop(spark, path)
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(context.open(package.Path(f"{path}/{_VERSIONS}/{name}")), "UTF-8"))
    try:
        folder, tag = reader.readLine(), reader.readLine()
    finally:
        reader.close()
    return Version(int(name), f"{path}/{folder}", tag or "")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions published so far, oldest first; their folders may have been removed."""
    return [_version(spark, path, name) for name in folder_names(spark, f"{path}/{_VERSIONS}") if name.isdigit()]


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The newest published version."""
    names = [name for name in folder_names(spark, f"{path}/{_VERSIONS}") if name.isdigit()]
    return _version(spark, path, names[-1]) if names else None


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """Folder of the table's current snapshot, or None if none was published."""
    version = current_version(spark, path)
    return version.folder if version else None


def current_tag(spark: SparkSession, path: str) -> str | None:
    """The tag the current snapshot was published with."""
    version = current_version(spark, path)
    return version.tag if version else None


def publish(spark: SparkSession, path: str, base: Version | None, folder: str, tag: str) -> Version:
    """Let a folder of the table follow the version ``base`` (None: be the first).

    The version's file is moved to its number without overwriting, so of several
    writers that start from one base only one succeeds; TableChanged tells the others.
    """
    number = (base.number if base else 0) + 1
    context, package, conf = _hadoop(spark, path)
    target = package.Path(f"{path}/{_VERSIONS}/{number:012d}")
    staged = package.Path(f"{path}/{_VERSIONS}/.{uuid.uuid4().hex}")
    stream = staged.getFileSystem(conf).create(staged, True)
    stream.write(bytearray(f"{folder}\n{tag}\n".encode()))
    stream.close()
    try:
        context.rename(staged, target, spark.sparkContext._gateway.new_array(package.Options.Rename, 0))
    except Py4JJavaError as error:
        context.delete(staged, False)
        if not context.util().exists(target):
            raise
        raise TableChanged(path) from error
    return Version(number, f"{path}/{folder}", tag)


class TableChanged(RuntimeError):
    """Another writer published in between; the rows must be made anew."""


def write_snapshot(
    df: DataFrame,
    path: str,
    tag: str = "",
    partition_by: list[str] | None = None,
    base: str | None = None,
    keep: int | None = None,
) -> str:
    """Replace a table as a whole: readers see the old rows or the new ones.

    The rows go to a folder of their own, which is then published as the next
    version. The frame may read the table it replaces, because the old snapshot
    stays untouched. Returns the new snapshot's folder.

    ``base`` is the snapshot that the rows were made from, empty if there was none
    yet; without it the one that is current now. If the table shows another by the
    time of publishing, TableChanged is raised and the table left alone. ``keep``
    removes all but the newest so many snapshots.
    """
    spark = df.sparkSession
    version = current_version(spark, path)
    if base is not None and base != (version.folder if version else ""):
        raise TableChanged(path)
    name = f"snapshot-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{name}")
    publish(spark, path, version, name, tag)
    if keep is not None:
        remove_old_snapshots(spark, path, keep)
    return f"{path}/{name}"


def remove_old_snapshots(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove snapshots older than the current one but for the newest ``keep - 1`` of them.

    Keep as many as readers may still be reading. Newer folders are left, since a
    writer may be about to publish them.
    """
    current = current_snapshot(spark, path)
    context, package, _ = _hadoop(spark, path)
    found = {
        status.getPath().getName(): (status.getModificationTime(), status.getPath())
        for status in context.util().listStatus(package.Path(path))
        if status.isDirectory() and status.getPath().getName().startswith("snapshot-")
    }
    at, _ = found.pop((current or "").rsplit("/", 1)[-1], (0, None))
    older = sorted((made, name) for name, (made, _) in found.items() if made <= at)
    for _, name in older[: max(0, len(older) - (keep - 1))]:
        context.delete(found[name][1], True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    context, package, _ = _hadoop(spark, path)
    if context.util().exists(package.Path(path)):
        context.delete(package.Path(path), True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Let a finished folder take the place of ``path``; the old one goes last."""
    context, package, _ = _hadoop(spark, path)
    old = package.Path(f"{path}.{uuid.uuid4().hex}")
    plain = spark.sparkContext._gateway.new_array(package.Options.Rename, 0)
    replaced = context.util().exists(package.Path(path))
    if replaced:
        context.rename(package.Path(path), old, plain)
    context.rename(package.Path(new), package.Path(path), plain)
    if replaced:
        context.delete(old, True)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Add run or attempt rows to a table."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_rejects(df: DataFrame, path: str, stage: str, run_id: int) -> None:
    """Keep rejected, skipped or duplicate rows with their reasons, by run and stage.

    A run written again replaces its own rows; those of other runs stay.
    """
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}/stage={stage}")
