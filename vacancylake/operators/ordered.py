"""Ordered per-key computations that survive a key too large for one task.

Each entry point first measures the largest key. Below the limit a plain window
is the right plan. Above it the rows are range-partitioned on (key, order), which
cuts a hot key into consecutive chunks, and each chunk gets from the chunks
before it only what the computation needs: a few trailing rows or one subtotal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vacancylake.operators.spread import null_safe_join
from vacancylake.session import materialize

#: Rows of one key that a single task is trusted to sort and scan.
MAX_GROUP_ROWS = 5_000_000

#: ``compute(rows, window)`` adds columns using frames over the given window.
Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the biggest key and rows in all (a map-side combined count)."""
    row = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return row[0] or 0, row[1] or 0


def ordered_chunks(df: DataFrame, keys: list[str], order: list[str], chunks: int) -> DataFrame:
    """Rows with the number of the range partition they fall in, as ``_chunk``.

    Materialized, because range bounds come from sampling:
    every later reader must see the same chunks.
    """
    bounds = [F.col(name).asc_nulls_first() for name in [*keys, *order]]
    ranged = df.repartitionByRange(chunks, *bounds)
    return materialize(ranged.withColumn("_chunk", F.spark_partition_id()))


def _chunk_count(total: int, max_group_rows: int) -> int:
    """Chunks that hold about half the rows one task is trusted with."""
    return max(2, -(-2 * total // max_group_rows))


def lookback(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    depth: int,
    compute: Compute,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Run ``compute`` where each row needs at most ``depth`` rows before it."""
    largest, total = group_sizes(df, keys)
    if largest <= max_group_rows:
        return compute(df, Window.partitionBy(*keys).orderBy(*order))

    chunked = ordered_chunks(df, keys, order, _chunk_count(total, max_group_rows))
    chunk_keys = [*keys, "_chunk"]
    newest_first = Window.partitionBy(*chunk_keys).orderBy(*[F.desc(name) for name in order])
    # At most ``depth`` rows per (key, chunk) leave each task: the ranking filter
    # is applied before the exchange.
    tails = (
        chunked.withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= depth)
        .groupBy(*chunk_keys)
        .agg(F.collect_list(F.struct(*df.columns)).alias("_tail"))
    )
    # A chunk that holds rows adds at least one to its tail, so the rows needed
    # are always within the ``depth`` chunks before.
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-depth, -1)
    carried = (
        tails.withColumn("_carry", F.flatten(F.collect_list("_tail").over(before)))
        .select("_chunk", F.explode("_carry").alias("_row"))
        .select("_row.*", "_chunk")
    )
    rows = chunked.withColumn("_home", F.lit(True)).unionByName(
        carried.withColumn("_home", F.lit(False))
    )
    window = Window.partitionBy(*chunk_keys).orderBy(*order)
    return compute(rows, window).filter("_home").drop("_home", "_chunk")


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Cumulative sum per key; rows with equal ``order`` all see each other."""
    return running_sums(df, keys, order, {name: value}, max_group_rows)


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Several cumulative sums per key in one sweep; rows with equal ``order`` all see each other."""
    rows = df.withColumns({f"_value_{name}": value for name, value in values.items()})
    own = [f"_value_{name}" for name in values]
    largest, total = group_sizes(rows, keys)
    if largest <= max_group_rows:
        window = Window.partitionBy(*keys).orderBy(order)
        return rows.withColumns({name: F.sum(f"_value_{name}").over(window) for name in values}).drop(*own)

    # Equal order values share a range partition, so no tie crosses a chunk.
    chunked = ordered_chunks(rows, keys, [order], _chunk_count(total, max_group_rows))
    chunk_keys = [*keys, "_chunk"]
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    subtotals = (
        chunked.groupBy(*chunk_keys)
        .agg(*[F.sum(f"_value_{name}").alias(f"_subtotal_{name}") for name in values])
        .withColumns({f"_before_{name}": F.coalesce(F.sum(f"_subtotal_{name}").over(earlier), F.lit(0)) for name in values})
        .drop(*[f"_subtotal_{name}" for name in values])
    )
    window = Window.partitionBy(*chunk_keys).orderBy(order)
    local = chunked.withColumns({f"_local_{name}": F.sum(f"_value_{name}").over(window) for name in values})
    # Chunk numbers rise with the order, so subtotals join on (key, chunk): at
    # most one row per key plus one per partition.
    return (
        null_safe_join(local, subtotals, chunk_keys)
        .withColumns({name: F.col(f"_local_{name}") + F.col(f"_before_{name}") for name in values})
        .drop(*own, *[f"_{part}_{name}" for name in values for part in ("local", "before")], "_chunk")
    )
