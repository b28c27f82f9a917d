"""From stored attempts to anomalies, alerts and sources to switch off."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.operators import alerts, detectors, drift, ranking

_SHARED = ["type", "source", "severity", "title", "message", "detected_at"]


class Monitoring(NamedTuple):
    anomalies: DataFrame
    run_rules: DataFrame
    alerts: DataFrame
    to_disable: DataFrame


def monitor(
    attempts: DataFrame, runs: DataFrame, failures: int = 3, snapshots: DataFrame | None = None, **rules: float
) -> Monitoring:
    """Judge the attempts table; a source is the text of its company's id.

    Counts are those of attempts that did not fail, since a failed one says nothing
    about the number of listings. ``alerts`` tells zero results and failures, with
    ``disable`` where the source's last ``failures`` attempts all failed. Selector
    match counts ``snapshots`` (source, selector, ts, id, match_count) add drift
    alerts; equal selectors of two sources have their own histories. ``rules`` are
    the limits of :func:`detectors.run_alert_rules`.
    """
    timed = attempts.withColumns({"source": F.col("company_id").cast("string"), "ts": F.col("started_at")})
    counts = timed.filter("status <> 'failed'").select("source", "ts", "id", F.col("jobs_found").alias("job_count"))
    timeouts = timed.filter(F.lower("error_type").contains("timeout")).select("source", "ts", "id")
    counted = detectors.detect_count_anomalies(counts)
    zeros = counted.filter("type = 'zero_jobs'").withColumnRenamed("detected_at", "ts")
    failed = timed.filter("status in ('failed', 'partial')").select(
        "source", "ts", "error_message", (F.col("status") == "partial").alias("is_partial")
    )
    to_disable = ranking.sources_to_disable(attempts, failures)
    switched = to_disable.select(F.col("company_id").cast("string").alias("source"), F.lit(True).alias("disable"))
    parts = [alerts.zero_job_alerts(zeros), alerts.failure_alerts(failed)]
    if snapshots is not None:
        parts.append(alerts.drift_alerts(drift.drift_events(snapshots, keys=("source", "selector"))))
    told = alerts.to_alerts(*parts)
    return Monitoring(
        counted.select(*_SHARED).unionByName(detectors.detect_timeout_pattern(timeouts).select(*_SHARED)),
        detectors.run_alert_rules(runs, attempts, **rules),
        told.join(switched, "source", "left").withColumn("disable", F.coalesce("disable", F.lit(False))),
        to_disable,
    )
