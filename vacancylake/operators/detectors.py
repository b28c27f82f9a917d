"""Anomalies in listing counts and timeouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vacancylake.operators.ordered import MAX_GROUP_ROWS, lookback, running_sum, running_sums
from vacancylake.operators.spread import attach
from vacancylake.session import materialize

_ORDER = ["ts", "id"]


def count_history(
    counts: DataFrame,
    window: int = 10,
    latest_only: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Counts (source, ts, id, job_count) with their trailing statistics.

    Adds ``history`` (the last ``window`` counts, current one included),
    ``n_history``, ``average_count`` and ``trend``.
    """

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-(window - 1), 0)
        return rows.withColumn("history", F.collect_list("job_count").over(frame))

    if latest_only:
        newest = Window.partitionBy("source").orderBy(*[F.desc(c) for c in _ORDER])
        counts = counts.withColumn("_back", F.row_number().over(newest)).filter(
            F.col("_back") <= window
        )
    rows = lookback(counts, ["source"], _ORDER, window - 1, compute, max_group_rows)
    if latest_only:
        rows = rows.filter(F.col("_back") == 1).drop("_back")

    n = F.size("history")
    total = F.aggregate("history", F.lit(0).cast("bigint"), lambda a, x: a + x)
    last, middle, first = (F.try_element_at("history", F.lit(-i)) for i in (1, 2, 3))
    return (
        rows.withColumn("n_history", n)
        .withColumn("average_count", total / F.nullif(n, F.lit(0)))
        .withColumn(
            "trend",
            F.when(n < 3, "stable")
            .when((last > middle) & (middle > first), "increasing")
            .when((last < middle) & (middle < first), "decreasing")
            .otherwise("stable"),
        )
    )


def anomalous_counts(
    counts: DataFrame,
    window: int = 10,
    min_expected: int = 1,
    latest_only: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The rows of :func:`count_history` that show an anomaly, with its ``type``."""
    rows = count_history(counts, window, latest_only, max_group_rows)
    count, average = F.col("job_count"), F.col("average_count")
    zero = (count == 0) & (average > min_expected)
    drop = (F.col("trend") == "decreasing") & (count < average * 0.5)
    kind = F.when(zero, "zero_jobs").when(drop, "suspicious_count")
    return rows.withColumn("type", kind).filter(F.col("type").isNotNull())


def detect_count_anomalies(counts: DataFrame, **options) -> DataFrame:
    """Zero-listing and sudden-drop anomalies, at most one per observation.

    Options are those of :func:`anomalous_counts`.
    """
    rows = anomalous_counts(counts, **options)
    count, average = F.col("job_count"), F.col("average_count")
    shown = F.format_string("%.1f", average)
    return (
        rows.select(
            "type",
            "source",
            F.when(F.col("type") == "zero_jobs", "error").otherwise("warning").alias("severity"),
            F.when(
                F.col("type") == "zero_jobs", F.concat(F.lit("Zero jobs from "), F.col("source"))
            )
            .otherwise(F.concat(F.lit("Suspicious job count drop for "), F.col("source")))
            .alias("title"),
            F.when(
                F.col("type") == "zero_jobs",
                F.concat(
                    F.lit("Source "), F.col("source"), F.lit(" returned 0 jobs. Average over last "),
                    F.col("n_history").cast("string"), F.lit(" runs: "), shown,
                    F.lit(". Possible selector drift or anti-bot blocking."),
                ),
            )
            .otherwise(
                F.concat(
                    F.lit("Job count dropped significantly for "), F.col("source"),
                    F.lit(". Current: "), count.cast("string"), F.lit(", Average: "), shown,
                )
            )
            .alias("message"),
            F.col("ts").alias("detected_at"),
            count.alias("current_count"),
            "average_count",
            "trend",
            F.when(F.col("type") == "zero_jobs", F.col("history")).alias("history"),
        )
    )


def detect_zero_jobs(counts: DataFrame, **options) -> DataFrame:
    return detect_count_anomalies(counts, **options).filter(F.col("type") == "zero_jobs")


def detect_suspicious_drop(counts: DataFrame, **options) -> DataFrame:
    return detect_count_anomalies(counts, **options).filter(F.col("type") == "suspicious_count")


def sliding_count(
    events: DataFrame,
    keys: list[str],
    window_s: float,
    name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Events of the same key in (ts - window, ts], counted for each event.

    Every event adds one when it happens and takes it away when it leaves the
    window, so the count is a running sum and costs one sort, however many
    events a window holds.
    """
    span = int(window_s * 1_000_000)
    at = F.unix_micros("ts")
    columns = events.columns
    arrive = events.withColumn("_at", at).withColumn("_step", F.lit(1))
    leave = events.select(*keys, (at + span).alias("_at"), F.lit(-1).alias("_step"))
    steps = arrive.unionByName(leave, allowMissingColumns=True)
    counted = running_sum(steps, keys, "_at", F.col("_step"), name, max_group_rows)
    return counted.filter(F.col("_step") == 1).select(*columns, F.col(name).cast("bigint").alias(name))


def detect_timeout_pattern(
    timeouts: DataFrame,
    window_s: int = 300,
    max_timeouts: int = 3,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Timeouts (ts, id, source) at which the trailing window reaches the limit.

    A window touches two time buckets of its own length. Within the event's
    bucket a source is in the window if its first timeout is not later; within
    the bucket before, if its last one is late enough. So the list of sources
    needs only each source's first and last time per bucket, and the count is a
    running sum per bucket that starts from what the bucket before left.
    """
    span = window_s * 1_000_000
    at = F.unix_micros("ts")
    home = timeouts.withColumn("_at", at).withColumn("_bucket", F.floor(at / span))
    moved = home.select((F.col("_bucket") + 1).alias("_bucket"), F.col("_at"))
    opening = moved.groupBy("_bucket").agg(F.count("*").alias("_step")).select(
        "_bucket", (F.col("_bucket") * span).alias("_at"), "_step"
    )
    leaving = moved.select("_bucket", (F.col("_at") + span).alias("_at"), F.lit(-1).cast("bigint").alias("_step"))
    steps = (
        home.withColumns({"_step": F.lit(1).cast("bigint"), "_event": F.lit(True)})
        .unionByName(opening, allowMissingColumns=True)
        .unionByName(leaving, allowMissingColumns=True)
    )
    flagged = running_sum(
        steps, ["_bucket"], "_at", F.col("_step"), "timeout_count", max_group_rows
    ).filter(F.col("_event") & (F.col("timeout_count") >= max_timeouts))

    # a timeout without a source counts, but names none
    per_source = home.filter("source is not null").groupBy("_bucket", "source").agg(
        F.min("_at").alias("first_at"), F.max("_at").alias("last_at")
    )
    roster = (
        per_source.withColumn("here", F.lit(True))
        .unionByName(
            per_source.withColumn("_bucket", F.col("_bucket") + 1).withColumn("here", F.lit(False))
        )
        .groupBy("_bucket")
        .agg(F.collect_list(F.struct("source", "first_at", "last_at", "here")).alias("_roster"))
    )
    present = F.filter(
        "_roster",
        lambda s: F.when(s["here"], s["first_at"] <= F.col("_at")).otherwise(
            s["last_at"] > F.col("_at") - span
        ),
    )
    names = F.array_sort(F.array_distinct(F.transform(present, lambda s: s["source"])))
    found = attach(flagged, roster, ["_bucket"], "left").withColumn("sources", F.coalesce(names, F.array().cast("array<string>")))
    listed = F.array_join("sources", ", ")
    return found.select(
        F.lit("timeout_pattern").alias("type"),
        listed.alias("source"),
        F.lit("warning").alias("severity"),
        F.lit("Multiple timeouts detected").alias("title"),
        F.concat(
            F.col("timeout_count").cast("string"), F.lit(f" timeouts in the last {window_s}s from "),
            F.size("sources").cast("string"), F.lit(" source(s): "), listed,
        ).alias("message"),
        F.col("ts").alias("detected_at"),
        F.col("id").alias("event_id"),
        F.col("timeout_count").cast("bigint").alias("timeout_count"),
        F.size("sources").alias("n_sources"),
    )


def timeout_sweep(
    timeouts: DataFrame, window_s: int = 300, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Every instant (ts) with timeouts: what its trailing window holds, without listing it.

    Adds to (ts, event_id: the least id): ``arrivals`` at the instant itself, and
    of the window ``timeout_count``, ``n_sources`` (distinct, nulls are none) and
    ``n_instants``, besides ``bucket``, the number ``place`` of the instant in its
    bucket of the window's length and ``places_before``, those of the bucket before.

    A source's timeouts of one bucket put it into every window from its first one
    to the bucket's end, and on into the next bucket until its last one is too old.
    So a source is two spans a bucket at most, whatever its number of timeouts, and
    all counts are sums of steps that an ordered sweep of each bucket adds up.
    """
    span = window_s * 1_000_000
    at = F.unix_micros("ts")
    home = timeouts.filter("ts is not null").select("id", "source", at.alias("at"), F.floor(at / span).alias("bucket"))
    instants = home.groupBy("bucket", "at").agg(F.count(F.lit(1)).alias("arrivals"), F.min("id").alias("event_id"))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def steps(rows: DataFrame, bucket: Column, when: Column, **given: Column) -> DataFrame:
        names = ("arrivals", "counted", "sources", "instants", "places", "places_before")
        return rows.select(
            bucket.alias("bucket"), when.cast("bigint").alias("at"),
            *[given.get(name, zero).cast("bigint").alias(name) for name in names],
            given.get("event_id", F.lit(None)).cast("bigint").alias("event_id"),
        )

    n, bucket, here = F.col("arrivals"), F.col("bucket"), F.col("at")
    following = bucket + 1
    arriving = steps(instants, bucket, here, arrivals=n, counted=n, instants=one, places=one, event_id=F.col("event_id"))
    leaving = steps(instants, following, here + span, counted=-n, instants=-one)
    per_bucket = instants.groupBy("bucket").agg(F.sum("arrivals").alias("arrivals"), F.count(F.lit(1)).alias("n"))
    opening = steps(per_bucket, following, following * span, counted=n, instants=F.col("n"), places_before=F.col("n"))

    spans = home.filter("source is not null").groupBy("bucket", "source").agg(
        F.min("at").alias("first"), F.max("at").alias("last")
    )
    both = (
        spans.select("bucket", "source", "first", F.lit(None).cast("bigint").alias("gone"))
        .union(spans.select(following, "source", F.lit(None).cast("bigint"), F.col("last") + span))
        .groupBy("bucket", "source").agg(F.max("first").alias("first"), F.max("gone").alias("gone"))
    )
    first, gone = F.col("first"), F.col("gone")
    step = lambda when, value: F.struct(when.alias("when"), F.lit(value).cast("bigint").alias("value"))
    apart = gone.isNotNull() & (first.isNull() | (first > gone))
    edges = F.array_compact(F.array(
        F.when(gone.isNotNull(), step(bucket * span, 1)),
        F.when(apart, step(gone, -1)),
        F.when(first.isNotNull() & (gone.isNull() | apart), step(first, 1)),
    ))
    present = both.select("bucket", F.explode(edges).alias("edge"))
    moving = steps(present, bucket, F.col("edge.when"), sources=F.col("edge.value"))

    summed = ("arrivals", "counted", "sources", "instants", "places", "places_before")
    swept = arriving.unionByName(leaving).unionByName(opening).unionByName(moving).groupBy("bucket", "at").agg(
        *[F.sum(name).alias(name) for name in summed], F.min("event_id").alias("event_id")
    )
    totals = {
        "timeout_count": F.col("counted"), "n_sources": F.col("sources"), "n_instants": F.col("instants"),
        "place": F.col("places"), "before": F.col("places_before"),
    }
    counted = running_sums(swept, ["bucket"], "at", totals, max_group_rows).filter("arrivals > 0")
    return counted.select(
        F.timestamp_micros("at").alias("ts"), "event_id", "arrivals", *list(totals)[:3], "bucket", "place",
        F.col("before").alias("places_before"),
    )


def _starts(swept: DataFrame, max_timeouts: int) -> DataFrame:
    before = F.col("timeout_count") - F.col("arrivals")
    return swept.filter((F.col("timeout_count") >= max_timeouts) & (before < max_timeouts))


def timeout_stretches(
    timeouts: DataFrame, window_s: int = 300, max_timeouts: int = 3, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """One row for each stretch of time over the limit: what its first instant shows.

    (detected_at, event_id, timeout_count, n_sources). A stretch begins when the
    trailing window comes to hold ``max_timeouts`` timeouts (ts, id, source) and
    ends when it holds fewer, be it only between two timeouts. Timeouts without a
    time count nowhere, those without a source name none.
    """
    starts = _starts(timeout_sweep(timeouts, window_s, max_group_rows), max_timeouts)
    return starts.select(F.col("ts").alias("detected_at"), "event_id", "timeout_count", "n_sources")


def stretch_sources(
    timeouts: DataFrame, window_s: int = 300, max_timeouts: int = 3, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The sources in the first window of each stretch, one row each: (detected_at, event_id, source).

    A stretch's first window holds fewer than ``max_timeouts`` timeouts besides those
    of its first instant, so there are no more rows than timeouts times the limit. They are found by
    place: a window is so many instants back from its own, each an equality join.
    """
    span = window_s * 1_000_000
    swept = materialize(timeout_sweep(timeouts, window_s, max_group_rows))
    starts = _starts(swept, max_timeouts)
    back = starts.select(
        F.col("ts").alias("detected_at"), "event_id", "bucket", "places_before",
        F.explode(F.sequence(F.col("place") - F.col("n_instants") + 1, F.col("place"))).alias("place"),
    )
    earlier = F.col("place") < 1
    wanted = back.select(
        "detected_at", "event_id",
        F.when(earlier, F.col("bucket") - 1).otherwise(F.col("bucket")).alias("bucket"),
        F.when(earlier, F.col("place") + F.col("places_before")).otherwise(F.col("place")).alias("place"),
    )
    at = F.unix_micros("ts")
    named = timeouts.filter("ts is not null and source is not null").select(
        "ts", F.floor(at / span).alias("bucket"), "source"
    ).distinct()
    instants = swept.select("bucket", "place", "ts")
    return (
        wanted.join(instants, ["bucket", "place"])
        .select("detected_at", "event_id", "bucket", "ts")
        .join(named, ["bucket", "ts"])
        .select("detected_at", "event_id", "source")
        .distinct()
    )


def run_alert_rules(
    runs: DataFrame,
    attempts: DataFrame,
    max_failed_share: float = 0.5,
    max_duration_s: float = 3600.0,
) -> DataFrame:
    """Runs with too many failed attempts or running for too long."""
    shares = attempts.groupBy("run_id").agg(
        F.count_if(F.col("status") == "failed").alias("failed"), F.count("*").alias("n")
    )
    length = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000
    joined = (
        runs.join(shares, runs["id"] == shares["run_id"], "left")
        .withColumn("failed_share", F.coalesce(F.col("failed") / F.col("n"), F.lit(0.0)))
        .withColumn("duration_seconds", length)
    )
    fired: Column = F.array_compact(
        F.array(
            F.when(F.col("failed_share") > max_failed_share, F.lit("high_error_rate")),
            F.when(F.col("duration_seconds") > max_duration_s, F.lit("slow_run")),
        )
    )
    return joined.select(
        F.col("id").alias("run_id"),
        F.explode(fired).alias("rule"),
        "failed_share",
        "duration_seconds",
    )
