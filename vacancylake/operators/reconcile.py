"""Closing and reopening listings from what a snapshot did and did not show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.operators.identity import KEY
from vacancylake.operators.spread import attach

# Run outcomes that never count as a miss.
NON_COUNTING_STATUSES = ["partial", "failed", "cancelled", "interrupted", "skipped", "running"]


def close_missing(jobs: DataFrame, seen: DataFrame, scraped: DataFrame | None = None) -> DataFrame:
    """Open listings absent from the snapshot, as they look once closed.

    ``scraped`` (column company_id) limits closing to companies whose
    extraction produced a snapshot at all.
    """
    open_jobs = jobs.filter(F.col("status") == "open")
    if scraped is not None:
        open_jobs = attach(open_jobs, scraped.select("company_id").distinct(), ["company_id"], "left_semi")
    return open_jobs.join(seen.select(*KEY), KEY, "left_anti").select(
        *[F.lit("closed").alias("status") if c == "status" else F.col(c) for c in jobs.columns]
    )


def reopen_seen(jobs: DataFrame, seen: DataFrame) -> DataFrame:
    """Closed listings present in the snapshot, as they look once reopened."""
    return (
        jobs.filter(F.col("status") == "closed")
        .join(seen.select(*KEY), KEY, "left_semi")
        .select(
            *[F.lit("open").alias("status") if c == "status" else F.col(c) for c in jobs.columns]
        )
    )


def trusted_companies(attempts: DataFrame) -> DataFrame:
    """Companies whose attempt may count misses, with the run's start time.

    Complete, authoritative and not degraded; one row per company.
    """
    counted = attempts.filter(
        F.col("complete")
        & F.col("authoritative_snapshot")
        & ~F.col("status").isin(NON_COUNTING_STATUSES)
    )
    return counted.groupBy("company_id").agg(F.max("started_at").alias("run_started_at"))


def reconcile(
    jobs: DataFrame,
    seen: DataFrame,
    attempts: DataFrame,
    now: Column,
    threshold: int = 2,
    mode: str = "threshold",
) -> DataFrame:
    """Listings after one run, each with the ``change`` made to it.

    ``attempts`` holds the run's attempts, at most one per company. Trusted
    companies only: an unseen open listing gains a miss and closes at
    ``threshold``; a seen one starts again at zero and reopens if closed. In
    ``mode="immediate"`` the first miss closes and any attempt that did not
    fail is trusted. ``change`` is closed, reopened, missed, reset or null.
    """
    if mode == "immediate":
        trusted = (
            attempts.filter(F.col("status") != "failed")
            .groupBy("company_id")
            .agg(F.max("started_at").alias("run_started_at"))
        )
        needed = 1
    elif mode == "threshold":
        trusted, needed = trusted_companies(attempts), threshold
    else:
        raise ValueError(f"unknown mode: {mode}")

    flagged = (
        attach(jobs, trusted, ["company_id"], "left")
        .join(seen.select(*KEY).withColumn("_seen", F.lit(True)), KEY, "left")
        .withColumn("_seen", F.coalesce(F.col("_seen"), F.lit(False)))
    )
    counts = F.col("run_started_at").isNotNull()
    misses = F.coalesce(F.col("missing_count"), F.lit(0))
    # A listing stored after the run began cannot have been missed by it.
    unseen = (
        counts
        & ~F.col("_seen")
        & (F.col("status") == "open")
        & F.coalesce(F.col("last_seen_at") < F.col("run_started_at"), F.lit(True))
    )
    back = counts & F.col("_seen")
    change = (
        F.when(unseen & (misses + 1 >= needed), "closed")
        .when(unseen, "missed")
        .when(back & (F.col("status") == "closed"), "reopened")
        .when(back & (misses > 0), "reset")
    )
    result = flagged.withColumn("change", change)
    status = (
        F.when(F.col("change") == "closed", "closed")
        .when(F.col("change") == "reopened", "open")
        .otherwise(F.col("status"))
    )
    missing = (
        F.when(F.col("change").isin("closed", "missed"), misses + 1)
        .when(back, F.lit(0))
        .otherwise(misses)
    )
    updates = {
        "status": status,
        "missing_count": missing.cast("int"),
        "last_seen_at": F.when(back, now).otherwise(F.col("last_seen_at")),
        "updated_at": F.when(F.col("change").isin("closed", "reopened"), now).otherwise(
            F.col("updated_at")
        ),
    }
    return result.select(
        *[updates[c].alias(c) if c in updates else F.col(c) for c in jobs.columns], "change"
    )


def reconcile_counts(reconciled: DataFrame) -> DataFrame:
    """Per company: closed, reopened and updated (misses counted or cleared)."""

    def n(*kinds: str) -> Column:
        return F.count_if(F.col("change").isin(*kinds))

    return reconciled.groupBy("company_id").agg(
        n("closed").alias("closed"),
        n("reopened").alias("reopened"),
        n("closed", "missed", "reset").alias("updated"),
    )


def stale_candidates(jobs: DataFrame, threshold: int = 2) -> DataFrame:
    """Open listings per company that the next complete run would close."""
    stale = (F.col("status") == "open") & (F.coalesce(F.col("missing_count"), F.lit(0)) >= threshold)
    return jobs.filter(stale).groupBy("company_id").agg(F.count("*").alias("stale_jobs"))
