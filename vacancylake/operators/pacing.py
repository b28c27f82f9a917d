"""Audit of request spacing and daily quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from vacancylake.operators.detectors import sliding_count
from vacancylake.operators.ordered import MAX_GROUP_ROWS, lookback

# Least seconds between two requests to one origin, per family.
MIN_GAP_SECONDS = {"api": 0.5, "html": 2.0, "browser": 3.0}

# The stricter policy for browser sources.
BROWSER_POLICY_GAP_SECONDS = 5.0
BROWSER_POLICY_PER_DAY = 100


def pacing_audit(requests: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Requests (origin, family, ts, id) with gap, quota use and violations."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("_previous", F.lag("ts").over(w))

    spaced = lookback(requests, ["origin"], ["ts", "id"], 1, compute, max_group_rows)
    counted = sliding_count(spaced, ["origin"], 86_400, "requests_24h", max_group_rows)
    floor = F.lit(None).cast("double")
    for family, seconds in MIN_GAP_SECONDS.items():
        floor = F.when(F.col("family") == family, F.lit(seconds)).otherwise(floor)
    browser = F.col("family") == "browser"
    gap = (F.unix_micros("ts") - F.unix_micros("_previous")) / 1_000_000
    return (
        counted.withColumn("gap_seconds", gap)
        .withColumn("min_gap_seconds", floor)
        .withColumn(
            "too_fast", F.coalesce(F.col("gap_seconds") < F.col("min_gap_seconds"), F.lit(False))
        )
        .withColumn(
            "breaks_browser_gap",
            browser & F.coalesce(F.col("gap_seconds") < BROWSER_POLICY_GAP_SECONDS, F.lit(False)),
        )
        .withColumn("over_quota", browser & (F.col("requests_24h") > BROWSER_POLICY_PER_DAY))
        .drop("_previous")
    )
