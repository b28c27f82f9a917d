"""The listings table in buckets of its key, merged by touching only what a batch touches."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vacancylake import schemas
from vacancylake.operators.identity import KEY, dedupe
from vacancylake.operators.merge import upsert_jobs
from vacancylake.operators.rollups import status_moves, sum_counts
from vacancylake.operators.spread import planned_bytes
from vacancylake.sinks.tables import TableChanged, Version, _hadoop, current_version, publish, remove_folder, versions

#: Buckets of a new table; a table keeps the number it was made with.
BUCKETS = 64
_ROWS = "rows"
#: Stored bytes of listings that a task puts in place.
TASK_BYTES = 16 << 20
#: Moves that are added up for a reader before a merge stores the sum instead.
FOLDED = 32
_COUNTS = "company_id bigint, status string, n bigint"
_WITH_BUCKET = StructType([*schemas.JOBS.fields, StructField("bucket", IntegerType())])


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """Listings of the given buckets, or of all; only their folders are read."""
    if current_version(spark, path) is None:
        return spark.createDataFrame([], schemas.JOBS)
    rows = spark.read.schema(_WITH_BUCKET).parquet(f"{path}/{_ROWS}")
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(buckets))
    return rows.select(*schemas.JOBS.names)


def stored_counts(spark: SparkSession, path: str, upto: Version | None = None) -> DataFrame:
    """(company_id, status, n) of the listings, kept up to date by every merge.

    Adds the moves of the newest merges to the last stored sum; the listings
    themselves are not read.
    """
    kept = [v for v in versions(spark, path) if upto is None or v.number <= upto.number]
    folders, state = [], None
    for version in reversed(kept):
        state = json.loads(version.tag)
        folders.append(f"{path}/{state['counts']}")
        if state["folded"]:
            break
    if not folders:
        return spark.createDataFrame([], _COUNTS)
    return sum_counts(spark.read.schema(_COUNTS).parquet(*folders))


def _marker(path: str, version: Version) -> str:
    return f"{path}/_versions/.{version.number:012d}.applied"


def unfinished(spark: SparkSession, path: str) -> Version | None:
    """The newest version, if its rows have not all been put in place."""
    version = current_version(spark, path)
    if version is None:
        return None
    context, package, _ = _hadoop(spark, path)
    return None if context.util().exists(package.Path(_marker(path, version))) else version


def _dealt(rows: DataFrame, touched: list[int]) -> DataFrame:
    """Each bucket's rows in tasks of their own, of about :data:`TASK_BYTES` each."""
    parts = max(1, -(-planned_bytes(rows) // (TASK_BYTES * len(touched))))
    cell = (F.array_position(F.lit(touched), F.col("bucket")) - 1) * parts + F.pmod(F.xxhash64(F.lit("part"), *KEY), F.lit(parts))
    return rows.repartitionById(parts * len(touched), cell.cast("int"))


def finish_merge(spark: SparkSession, path: str) -> None:
    """Put the staged rows of an unfinished merge in place; again, if need be.

    Spark replaces exactly the partitions that occur among the rows. Doing it
    twice gives the same table, so a merge that was cut off is finished by its
    writer's next call, or by this one if the writer is gone for good.
    """
    version = unfinished(spark, path)
    if version is None:
        return
    state = json.loads(version.tag)
    staged = spark.read.schema(_WITH_BUCKET).parquet(f"{path}/{state['staged']}")
    writer = _dealt(staged, state["touched"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(f"{path}/{_ROWS}")
    _, package, conf = _hadoop(spark, path)
    marker = package.Path(_marker(path, version))
    marker.getFileSystem(conf).create(marker, True).close()
    remove_folder(spark, f"{path}/{state['staged']}")


def merge_listings(
    records: DataFrame, path: str, now: Column, writer: str, number: int, buckets: int = BUCKETS
) -> list[int]:
    """Merge one batch of records into the table at ``path``; returns the buckets rewritten.

    ``now`` may aggregate over the batch, as ``max("seen_at")`` does. Only buckets in
    which the batch has keys are read and written; from their rows before and after
    follow the moves of :func:`stored_counts`. The merged rows
    are staged, the next version is published with the batch's place (of several
    writers that read the same version one succeeds, the others get TableChanged),
    and then Spark overwrites the buckets. A batch whose ``writer`` has already
    merged ``number`` or a later one changes nothing. While a merge of another
    writer is unfinished, TableChanged is raised.
    """
    spark = records.sparkSession
    open_version = unfinished(spark, path)
    if open_version is not None:
        if json.loads(open_version.tag)["writer"] != writer:
            raise TableChanged(f"{path}: unfinished merge of {json.loads(open_version.tag)['writer']}")
        finish_merge(spark, path)
    version = current_version(spark, path)
    state = json.loads(version.tag) if version else {"buckets": buckets, "done": {}}
    if state["done"].get(writer, -1) >= number:
        return []
    bucket = bucket_of(state["buckets"])
    facts = records.agg(F.collect_set(bucket).alias("touched"), F.unix_micros(now.cast("timestamp")).alias("now")).first()
    touched = sorted(facts.touched)  # one number a bucket
    if not touched:
        return []
    current = read_buckets(spark, path, touched)
    merged = upsert_jobs(current, dedupe(records), F.timestamp_micros(F.lit(facts.now))).drop("op")
    name = uuid.uuid4().hex
    staged, counts = f"_staged/{name}", f"counts/{name}"
    shaped = merged.select(*[F.col(f.name).cast(f.dataType) for f in schemas.JOBS])
    tag = {
        "buckets": state["buckets"], "writer": writer, "staged": staged, "touched": touched,
        "counts": counts, "folded": version is None or (version.number + 1) % FOLDED == 0,
        "done": {**state["done"], writer: number},
    }
    try:
        shaped.withColumn("bucket", bucket).write.parquet(f"{path}/{staged}")
        after = spark.read.schema(_WITH_BUCKET).parquet(f"{path}/{staged}")
        moves = status_moves(current, after)
        if tag["folded"] and version is not None:
            moves = sum_counts(moves.unionByName(stored_counts(spark, path, version)))
        moves.write.parquet(f"{path}/{counts}")  # a row a company and status
        publish(spark, path, version, _ROWS, json.dumps(tag))
    except Exception as error:
        for folder in (staged, counts):
            remove_folder(spark, f"{path}/{folder}")
        if current_version(spark, path) != version:  # files read here may be gone
            raise TableChanged(path) from error
        raise
    finish_merge(spark, path)
    return touched
