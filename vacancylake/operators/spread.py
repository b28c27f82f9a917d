"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest planned size, in bytes, of a side that is sent to every executor.
BROADCAST_LIMIT = 16 * 1024 * 1024

#: Most hot keys that are treated apart, and keys the sketch that finds them tracks.
HOT_KEYS = 1000
TRACKED_KEYS = 1 << 14

#: Ways a hot key is divided when a dimension is too large to send around.
SALTS = 32


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; reads metadata only."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether a frame is small enough to send to every executor.

    The planner's estimate settles most cases. It cannot see how far a grouping
    or a filter shrinks its input, so above the limit the bytes are measured.
    Frames with nested columns are not measured and never fit above the estimate.
    """
    if planned_bytes(df) <= limit:
        return True
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema.fields):
        return False
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null keys meet; keeps the left side's key columns."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    same = F.lit(True)
    for name in on:
        same = same & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed, same).drop(*[f"_right_{name}" for name in on])


def row_salt(df: DataFrame, salts: int = SALTS, by: list[str] | None = None) -> Column:
    """A repeatable bucket for each row, drawn from the row's own values."""
    names = by or [
        field.name
        for field in df.schema.fields
        if not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    bucket = F.pmod(F.xxhash64(*[F.col(name) for name in names]), F.lit(salts))
    # never null, which the planner cannot tell from a remainder alone
    return F.coalesce(bucket, F.lit(0)).cast("int")


def attach(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    how: str = "left",
    limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join many fact rows to a dimension holding at most one row per key.

    A dimension below ``limit`` is broadcast. For a larger one, a sketch of the
    facts finds the keys that would overfill a task; only the rows of these are
    divided by a salt, and only their dimension rows repeated once per salt. All
    other rows on both sides move once.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(dimension, limit):
        return facts.join(F.broadcast(dimension), on, how)
    hot = F.xxhash64(*on).isin(hot_keys(facts, on))
    # a row's partition tells equal rows apart, and stays the same when a task is run again
    salt = F.pmod(F.xxhash64(row_salt(facts, 1 << 30), F.spark_partition_id()), F.lit(salts)).cast("int")
    salted = facts.withColumn("_salt", F.when(hot, salt).otherwise(F.lit(0)))
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = dimension.withColumn("_salt", F.explode(every))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, on: list[str], partitions: int | None = None) -> list[int]:
    """Hashes of the keys with more than twice the rows of an average shuffle partition.

    They are taken from a mergeable frequent-items sketch, one pass over the key
    columns; it never misses a key of more than about a 4,000th of all rows. At
    most :data:`HOT_KEYS` are returned.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = F.expr(f"approx_top_k(_key, {HOT_KEYS}, {TRACKED_KEYS})")
    found = df.select(F.xxhash64(*on).alias("_key")).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [row["item"] for row in found.top if row["count"] * partitions > 2 * found.n]


def first_rows(
    df: DataFrame, keys: list[str], order: list[Column], carry: list[str] | None = None
) -> DataFrame:
    """The first row of each key by ``order``, one row per key.

    A grouped minimum is combined on the map side, so a key with a third of all
    rows reaches its reducer as one row per input partition; a ranking window
    would send every copy to one task.
    """
    columns = carry or [name for name in df.columns if name not in keys]
    best = F.min_by(F.struct(*columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(
        *[name for name in df.columns if name in keys or name in columns]
    )


def fill_cores(df: DataFrame, keys: list[str]) -> DataFrame:
    """Spread a small input over all cores before costly per-row work.

    A scan larger than the cluster's cores times one file split already has
    enough tasks and is left alone: moving it would cost more than it gains.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if planned_bytes(df) >= cores * split:
        return df
    return df.repartition(cores, *keys)
