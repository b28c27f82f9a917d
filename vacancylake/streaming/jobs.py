"""Structured Streaming versions of the incremental jobs.

De-duplication and timeout windows take and return a streaming DataFrame. The
others start a query that applies the batch operators to every micro-batch, with
what earlier batches left in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancylake.operators.detectors import anomalous_counts
from vacancylake.operators.drift import drift_events
from vacancylake.operators.identity import KEY
from vacancylake.sinks.listings import BUCKETS, merge_listings
from vacancylake.sinks.tables import folder_names, remove_folder

#: Buckets of the tails that a detecting stream keeps.
TAIL_BUCKETS = 32


def stream_dedupe(records: DataFrame, event_time: str, watermark: str) -> DataFrame:
    """One record per key within the watermark. Which copy stays is arrival order."""
    return records.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(KEY)


def stream_first(
    records: DataFrame, event_time: str, watermark: str, gap: str, order: tuple[str, ...] = ("page_no", "pos")
) -> DataFrame:
    """The first record of each key by ``order``, however the input is cut into batches.

    Records of one key belong together while each follows the one before in event
    time by less than ``gap``; a gap as long as a run makes a run's copies one group.
    A group's row is emitted once the watermark has passed its end, ``gap`` after
    its last record, and state holds one row per open group. Copies that arrive
    later than the watermark allows, and records without a time, are left out.
    Equal positions are settled by the row's hash, as :func:`identity.dedupe` does.
    """
    columns = [F.col(name) for name in records.columns]
    position = F.struct(*[F.col(name) for name in order], F.xxhash64(*columns))
    return (
        records.withWatermark(event_time, watermark)
        .groupBy(*KEY, F.session_window(event_time, gap))
        .agg(F.min_by(F.struct(*columns), position).alias("_row"))
        .select("_row.*")
    )


def upsert_batches(
    path: str, seen_at: str, stream: str, buckets: int = BUCKETS
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function merging each batch into the bucketed table at ``path``.

    Only buckets with keys of the batch are read and rewritten. The table notes the
    last batch of every stream; a batch replayed after a failure is recognised and
    skipped or finished, while other streams may use the same numbers. ``stream``
    names a stream for all its restarts. Times come from the batch's own ``seen_at``
    column. If another writer publishes meanwhile, the batch fails with TableChanged
    and is merged anew at its restart.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_listings(batch, path, F.max(seen_at), stream, batch_id, buckets)

    return merge


def stream_upsert(
    records: DataFrame, path: str, checkpoint: str, seen_at: str = "seen_at", buckets: int = BUCKETS
):
    """Start merging a stream of records into a listings table; its checkpoint names the stream."""
    merge = upsert_batches(path, seen_at, checkpoint, buckets)
    return _start(records, merge, checkpoint)


def _start(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str):
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def detect_batches(
    path: str, key: str, depth: int, detect: Callable[[DataFrame], DataFrame], buckets: int = TAIL_BUCKETS
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function running a batch detector over a stream.

    Each batch is judged together with the last ``depth`` rows its keys had before;
    findings go to ``path/found/batch=N``. These tails lie in folders by a hash of
    the key, ``path/tails/N/tail_bucket=B``, and a batch reads and writes only the
    buckets in which it has keys, so a key that rests costs nothing. What a later
    batch has replaced is removed, but for the tails a replay of the last batch
    reads; a replay overwrites its own output. ``detect`` must carry the column
    ``_new`` along. A late row is judged among the rows still kept, and changes no
    earlier finding. ``path`` belongs to one checkpoint and one number of buckets.
    """
    newest = Window.partitionBy("tail_bucket", key).orderBy(F.desc("ts"), F.desc("id"))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = batch.withColumn("_new", F.lit(True)).persist()
        touched = {row[0] for row in rows.select(bucket).distinct().collect()}  # at most ``buckets``
        current, replaced = bucket_versions(spark, f"{path}/tails", touched, batch_id)
        if current:
            kept = spark.read.schema(batch.schema).parquet(*current)
            rows = rows.unionByName(kept.withColumn("_new", F.lit(False)))
        found = detect(rows).filter("_new").drop("_new")
        found.write.mode("overwrite").parquet(f"{path}/found/batch={batch_id}")
        # the rank filter runs below the exchange: a hot key sends ``depth`` rows a task
        dealt = rows.withColumn("tail_bucket", bucket).withColumn("_back", F.row_number().over(newest))
        tails = dealt.filter(F.col("_back") <= depth).select(*columns, "tail_bucket")
        tails.write.mode("overwrite").partitionBy("tail_bucket").parquet(f"{path}/tails/{batch_id}")
        rows.unpersist()
        for folder in replaced:
            remove_folder(spark, folder)

    return step


def bucket_versions(
    spark: SparkSession, path: str, buckets: set[int], before: int
) -> tuple[list[str], list[str]]:
    """Folders of the newest tails of ``buckets`` older than a batch, and folders no batch reads again."""
    parts: dict[int, list[int]] = {}
    removable = []
    for number in sorted(int(name) for name in folder_names(spark, path) if name.isdigit() and int(name) < before):
        names = [name for name in folder_names(spark, f"{path}/{number}") if name.startswith("tail_bucket=")]
        for name in names:
            parts.setdefault(int(name.partition("=")[2]), []).append(number)
        if not names:
            removable.append(f"{path}/{number}")
    where = lambda number, bucket: f"{path}/{number}/tail_bucket={bucket}"
    removable += [where(n, bucket) for bucket, numbers in parts.items() for n in numbers[:-1]]
    return [where(parts[b][-1], b) for b in sorted(buckets & parts.keys())], removable


def findings(spark: SparkSession, path: str) -> DataFrame:
    """What the finished batches of a detecting stream found, with the batch."""
    return spark.read.parquet(f"{path}/found")


def stream_zero_jobs(
    counts: DataFrame, path: str, checkpoint: str, window: int = 10, min_expected: int = 1
):
    """Start finding count anomalies in a stream (source, ts, id, job_count)."""

    def detect(rows: DataFrame) -> DataFrame:
        return anomalous_counts(rows, window, min_expected).select(
            "source", "ts", "id", F.col("job_count").alias("current_count"), "type", "average_count", "_new"
        )

    return _start(counts, detect_batches(path, "source", window - 1, detect), checkpoint)


def stream_selector_drift(
    snapshots: DataFrame, path: str, checkpoint: str, history: int = 10, **options
):
    """Start finding drift in a stream (selector, ts, id, match_count).

    Further options are those of :func:`drift_events`.
    """

    def detect(rows: DataFrame) -> DataFrame:
        return drift_events(rows, history, **options).select(
            "selector", "ts", "id", "actual_count", "kind", "severity", "_new"
        )

    return _start(snapshots, detect_batches(path, "selector", history - 1, detect), checkpoint)


def stream_timeout_counts(
    timeouts: DataFrame,
    watermark: str = "10 minutes",
    window_s: int = 300,
    slide_s: int = 60,
    max_timeouts: int = 3,
) -> DataFrame:
    """Sliding windows holding enough timeouts, with the sources concerned.

    Counts are per window, not per event as in the batch detector.
    """
    return (
        timeouts.withWatermark("ts", watermark)
        .groupBy(F.window("ts", f"{window_s} seconds", f"{slide_s} seconds"))
        .agg(
            F.count("*").alias("timeout_count"),
            F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("source"),
        )
        .filter(F.col("timeout_count") >= max_timeouts)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "timeout_count",
            "source",
        )
    )
