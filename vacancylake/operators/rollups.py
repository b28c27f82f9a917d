"""Counters and summaries over listings, runs and attempts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.dates import duration_ms, duration_seconds
from vacancylake.operators.lookup import attempts_with_company
from vacancylake.operators.ranking import recent_attempts
from vacancylake.operators.spread import attach


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(F.col(name).cast("bigint")), F.lit(0)).alias(name)


def dashboard_stats(
    jobs: DataFrame, companies: DataFrame, runs: DataFrame, attempts: DataFrame
) -> DataFrame:
    """One row of headline numbers, each a scalar subquery over one table."""
    spark = jobs.sparkSession
    job_counts = jobs.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col("status") == "open").alias("m"))
    ).scalar()
    company_counts = companies.agg(
        F.struct(F.count("*").alias("n"), F.count_if("is_active").alias("m"))
    ).scalar()
    newest = F.max_by(F.struct("id", "started_at", "status"), F.struct("started_at", "id"))
    last = runs.agg(newest).scalar()
    last_id = runs.agg(F.max_by("id", F.struct("started_at", "id"))).scalar()
    found = (
        attempts.filter(F.col("run_id") == last_id)
        .agg(F.coalesce(F.sum(F.col("jobs_found").cast("bigint")), F.lit(0)))
        .scalar()
    )
    row = spark.range(1).select(
        job_counts.alias("j"),
        company_counts.alias("c"),
        runs.agg(F.count("*")).scalar().alias("total_runs"),
        last.alias("r"),
        found.alias("f"),
    )
    return row.select(
        F.col("j.n").alias("total_jobs"),
        F.col("j.m").alias("open_jobs"),
        F.col("c.n").alias("total_companies"),
        F.col("c.m").alias("active_companies"),
        "total_runs",
        F.col("r.id").alias("last_run_id"),
        F.col("r.started_at").alias("last_run_started_at"),
        F.col("r.status").alias("last_run_status"),
        F.when(F.col("r.id").isNotNull(), F.col("f")).alias("last_run_jobs_found"),
    )


def run_totals(runs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Runs with the totals of their attempts; zero where there are none."""
    totals = attempts.groupBy("run_id").agg(
        _sum("jobs_found"),
        _sum("new_jobs"),
        _sum("closed_jobs"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    measures = ["jobs_found", "new_jobs", "closed_jobs", "failed"]
    return runs.join(totals, runs["id"] == totals["run_id"], "left").select(
        *[runs[c] for c in runs.columns],
        duration_seconds(runs["started_at"], runs["finished_at"]).alias("duration_seconds"),
        *[F.coalesce(totals[m], F.lit(0)).alias(m) for m in measures],
    )


def run_success_pct(totals: DataFrame) -> DataFrame:
    """Adds ``success_pct``: share of found listings left after failed attempts."""
    found, failed = F.col("jobs_found"), F.col("failed")
    return totals.withColumn(
        "success_pct", F.when(found > 0, F.round((found - failed) / found * 100).cast("bigint"))
    )


def status_counts(jobs: DataFrame) -> DataFrame:
    """(company_id, status, n): listings per company and status."""
    return jobs.groupBy("company_id", "status").agg(F.count("*").alias("n"))


def status_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """What leads from the counts of ``before`` to those of ``after``; only rows that differ."""
    lost = status_counts(before).withColumn("n", -F.col("n"))
    return sum_counts(lost.unionByName(status_counts(after)))


def sum_counts(counts: DataFrame) -> DataFrame:
    """Counts and moves added up; what cancels out is left out."""
    return counts.groupBy("company_id", "status").agg(F.sum("n").alias("n")).filter("n <> 0")


def company_stats(companies: DataFrame, jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Companies with listing counts and the time of their last attempt."""
    return company_stats_of(companies, status_counts(jobs), attempts)


def company_stats_of(companies: DataFrame, counted: DataFrame, attempts: DataFrame) -> DataFrame:
    """:func:`company_stats` from counts per company and status, stored or fresh."""

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counts = counted.groupBy("company_id").agg(
        F.sum("n").alias("total_jobs"),
        n(F.col("status") == "open").alias("open_jobs"),
        n(F.col("status") == "closed").alias("closed_jobs"),
    )
    last = attempts.groupBy("company_id").agg(F.max("started_at").alias("last_run_at"))
    measures = ["total_jobs", "open_jobs", "closed_jobs"]
    return (
        companies.withColumn("company_id", F.col("id"))
        .join(counts, "company_id", "left")
        .join(last, "company_id", "left")
        .select(
            *companies.columns,
            *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures],
            "last_run_at",
        )
    )


def aggregate_sources(metrics: DataFrame) -> DataFrame:
    """Totals over per-source metrics (status, counters, warnings, times)."""

    def having(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return metrics.agg(
        F.count("*").alias("total_adapters"),
        having("success").alias("successful"),
        having("partial").alias("partial"),
        having("failed").alias("failed"),
        having("skipped").alias("skipped"),
        _sum("jobs_found").alias("total_jobs_found"),
        _sum("pages_fetched").alias("total_pages_fetched"),
        _sum("requests_made").alias("total_requests_made"),
        F.coalesce(F.sum(F.coalesce(F.size("warnings"), F.lit(0))), F.lit(0)).alias(
            "total_warnings"
        ),
        F.coalesce(F.sum(duration_ms(F.col("started_at"), F.col("finished_at"))), F.lit(0)).alias(
            "total_duration_ms"
        ),
    )


def pipeline_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        _sum("jobs_found").alias("total_found"),
        _sum("new_jobs").alias("total_new"),
        _sum("closed_jobs").alias("total_closed"),
        F.count("error_type").alias("errors"),
    )


def overall_status(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Run outcome from per-source outcomes: exit code and run status."""
    counts = results.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("status") == "partial").alias("n_partial"),
    )
    code = (
        F.when(F.col("n") == 0, 0)
        .when(F.col("n_failed") == F.col("n"), 2)
        .when((F.col("n_failed") > 0) | (F.col("n_partial") > 0), 1)
        .otherwise(0)
    )
    names = F.array(F.lit("success"), F.lit("partial"), F.lit("failed"))
    return (
        counts.withColumn("exit_code", code)
        .withColumn("run_status", F.element_at(names, F.col("exit_code") + 1))
        .select(*(by or []), "exit_code", "run_status")
    )


def success_rate(succeeded: Column, total: Column) -> Column:
    return F.when(total > 0, succeeded / total * 100).otherwise(F.lit(0.0))


def metrics_summary(runs: DataFrame) -> DataFrame:
    """Averages over runs (jobs_found, duration_ms, succeeded, total)."""
    rate = success_rate(F.col("succeeded"), F.col("total"))
    n = F.count("*")
    whole = F.floor(F.sum("duration_ms") / F.count("*")).cast("bigint")
    return runs.agg(
        n.alias("total_runs"),
        _sum("jobs_found").alias("total_jobs_found"),
        F.coalesce(whole, F.lit(0)).alias("avg_duration_ms"),
        F.coalesce(F.avg(rate), F.lit(0.0)).alias("avg_success_rate"),
    )


def attempt_rows(
    records: DataFrame,
    rejects: DataFrame,
    dropped: DataFrame,
    merged: DataFrame,
    reconciled: DataFrame,
) -> DataFrame:
    """Per-company counters and warnings of one run.

    Every input is reduced to one row per company before anything is joined.
    """

    def count(df: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
        n = F.count("*") if condition is None else F.count_if(condition)
        return df.groupBy("company_id").agg(n.alias(name))

    closed = reconciled.groupBy("company_id").agg(
        F.count_if(F.col("change") == "closed").alias("closed_jobs"),
        F.count_if(F.col("change") == "reopened").alias("reopened_jobs"),
    )
    parts = [
        count(records, "jobs_found"),
        count(rejects, "records_rejected"),
        count(dropped, "_dropped"),
        count(merged, "new_jobs", F.col("op") == "created"),
        closed,
    ]
    # Union and one more grouping instead of a chain of outer joins.
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c != "company_id"]
    totals = stacked.groupBy("company_id").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )
    warnings = F.concat_ws(
        "; ",
        F.when(
            F.col("records_rejected") > 0,
            F.concat(F.col("records_rejected").cast("string"), F.lit(" records failed transformation")),
        ),
        F.when(
            F.col("_dropped") > 0,
            F.concat(F.col("_dropped").cast("string"), F.lit(" duplicates removed")),
        ),
    )
    return totals.withColumn("warnings", F.nullif(warnings, F.lit(""))).select(
        "company_id",
        "jobs_found",
        "records_rejected",
        "new_jobs",
        "closed_jobs",
        "reopened_jobs",
        "warnings",
    )


def expected_range_check(attempts: DataFrame, expectations: DataFrame) -> DataFrame:
    """Attempts whose listing count leaves the range expected of the company.

    ``expectations``: company_id, expected_min, expected_max.
    """
    found = F.col("jobs_found")
    verdict = F.when(found < F.col("expected_min"), "below").when(
        found > F.col("expected_max"), "above"
    )
    return (
        attach(attempts, expectations, ["company_id"], "inner")
        .withColumn("verdict", verdict)
        .filter(F.col("verdict").isNotNull())
    )


class RunDetail(NamedTuple):
    run: DataFrame
    attempts: DataFrame


class CompanyDetail(NamedTuple):
    company: DataFrame
    attempts: DataFrame


def run_detail(runs: DataFrame, attempts: DataFrame, companies: DataFrame, run_id: int) -> RunDetail:
    own = attempts.filter(F.col("run_id") == run_id)
    return RunDetail(
        run_totals(runs.filter(F.col("id") == run_id), own),
        attempts_with_company(own, companies),
    )


def company_detail(
    companies: DataFrame, jobs: DataFrame, attempts: DataFrame, slug: str, k: int = 10
) -> CompanyDetail:
    company = companies.filter(F.col("slug") == slug)
    own = company.select(F.col("id").alias("company_id"))
    own_attempts = attach(attempts, own, ["company_id"], "left_semi")
    own_jobs = attach(jobs, own, ["company_id"], "left_semi")
    return CompanyDetail(
        company_stats(company, own_jobs, own_attempts), recent_attempts(own_attempts, k)
    )
