"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on; cluster sizing stays with whoever submits it.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the default, 96 bits, takes half as long again to write listings and keeps no least and greatest value
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_SETTINGS` to a session made elsewhere."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vacancylake-"), "vacancylake.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def local_session(name: str = "vacancylake", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors could not read it back after losing the node that wrote it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vacancylake-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder as Parquet and read it back.

    Cuts the lineage like a checkpoint, computes the frame only once, and leaves
    a columnar table later readers can prune and whose size the planner knows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder behind a path on a local or mounted disk; None in another store, or where a pattern is given.

    There tasks may work with the system's own calls. Hadoop's local file system
    starts a process for every file and folder it makes, unless its native library
    is there.
    """
    if any(sign in path for sign in "*?[]{}\\"):
        return None
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    if location.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return None
    return location.toUri().getPath()


def literal_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table written down in code, as a local relation whose size Catalyst knows."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
    columns = {name: pa.array([row.get(name) for row in rows], kinds[kind]) for name, kind in fields}
    return spark.createDataFrame(pa.table(columns), schema)
