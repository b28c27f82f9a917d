"""Helpers of the corpus operators: session set-up, shared files, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylake.session import ensure_checkpoint_dir, materialize, ship_package

#: Rows that reach a Python worker at a time; long texts make wide batches.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Ship the package and keep the batches of texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_path(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def map_batches(df: DataFrame, run: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Apply ``run`` to every Arrow batch of ``df``, as the task reads it."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from run(batch)

    return df.mapInArrow(over, schema)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``edges(u, v)``: (node, root).

    Alternates star rounds (Kiveris et al. 2014): every node points its larger
    neighbours, then its smaller ones, to the least it knows. Both steps are a
    grouped minimum and a join, so a node with very many neighbours is never
    gathered. Self links and nulls are ignored; nodes without links are not listed.
    """
    rising = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = materialize(rising.distinct())
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = materialize(small.union(least.select("u", "m")).distinct())
        before, mark, current = mark, _mark(following), following
        if before == mark:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
