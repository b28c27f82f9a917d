"""Row validation, normalisation and the list/export filters."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.dates import parse_posted_at
from vacancylake.functions.text import blank_to_null, default_location, strip
from vacancylake.functions.urls import canonicalize_clean_url, clean_url, is_absolute
from vacancylake.operators.spread import attach

# Source states that may be loaded.
ADMITTED_COMPLIANCE = ["approved", "needs-review"]

# Severities from mildest to gravest.
SEVERITIES = ["info", "warning", "error", "critical"]


def _reasons(*checks: tuple[str, Column]) -> Column:
    named = F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for reason, failed in checks]))
    # a row without faults, as most are, needs no list to be filtered
    return F.when(reduce(or_, [failed for _, failed in checks]), named).otherwise(F.array().cast("array<string>"))


def split_by(df: DataFrame, reasons: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and with entries in a reasons column."""
    good = df.filter(F.size(reasons) == 0).drop(reasons)
    return good, df.filter(F.size(reasons) > 0)


def validate_raw(rows: DataFrame) -> DataFrame:
    """Trim raw listing rows and note why a row must be skipped."""
    trimmed = rows
    for name in ("source", "title", "url", "location", "source_job_id"):
        if name in rows.columns:
            trimmed = trimmed.withColumn(name, strip(F.col(name)))
    return trimmed.withColumn(
        "skip_reasons",
        _reasons(
            ("missing source", F.coalesce(F.col("source") == "", F.lit(True))),
            ("empty title", F.coalesce(F.col("title") == "", F.lit(True))),
            ("bad url", ~is_absolute(F.col("url"))),
        ),
    )


def to_records(rows: DataFrame) -> DataFrame:
    """Normalise raw rows of known companies and note why one is rejected.

    Expects ``company_id`` next to the raw columns.
    """
    def optional(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    cleaned = rows.withColumn("url", clean_url(F.col("url")))
    read = cleaned.select(
        "company_id",
        strip(F.col("title")).alias("title"),
        optional("title_vi").alias("title_vi"),
        default_location(F.col("location")).alias("location"),
        "url",
        canonicalize_clean_url(F.col("url")).alias("_canonical"),
        blank_to_null(F.col("date_posted")).isNotNull().alias("_dated"),
        parse_posted_at(F.col("date_posted")).alias("date_posted"),
        "source_job_id",
        optional("salary_raw").alias("salary_raw"),
        "raw_data",
        "page_no",
        "pos",
    )
    return read.select(
        "company_id",
        "title",
        "title_vi",
        "location",
        "url",
        F.coalesce("_canonical", "url").alias("canonical_url"),
        "date_posted",
        F.lit("open").alias("status"),
        "source_job_id",
        "salary_raw",
        "raw_data",
        "page_no",
        "pos",
        _reasons(
            ("bad company", F.coalesce(F.col("company_id") <= 0, F.lit(True))),
            ("empty title", F.coalesce(F.col("title") == "", F.lit(True))),
            ("bad url", F.col("_canonical").isNull() & ~is_absolute(F.col("url"))),
            ("unparseable date", F.col("_dated") & F.col("date_posted").isNull()),
        ).alias("reject_reasons"),
    )


def _midnight(day: date | datetime | str) -> Column:
    return F.lit(str(day)[:10]).cast("date").cast("timestamp")


def filter_jobs(
    jobs: DataFrame,
    companies: DataFrame,
    company: str | None = None,
    status: str | None = None,
    date_from: date | str | None = None,
    date_to: date | str | None = None,
    strict: bool = False,
) -> DataFrame:
    """List filter. Unknown slugs and statuses filter nothing unless strict.

    A date bound drops undated listings, and ``date_to`` means the start of
    that day.
    """
    rows = jobs
    if company:
        # Looked up first, so that the id is a literal the scan can prune by.
        match = companies.filter(F.col("slug") == company).select("id").head()
        if match is not None:
            rows = rows.filter(F.col("company_id") == match["id"])
        elif strict:
            rows = rows.filter(F.lit(False))
    if status and (strict or status in ("open", "closed", "unknown")):
        rows = rows.filter(F.col("status") == status)
    if date_from:
        rows = rows.filter(F.col("date_posted") >= _midnight(date_from))
    if date_to:
        rows = rows.filter(F.col("date_posted") <= _midnight(date_to))
    return rows


def export_filter(
    jobs: DataFrame,
    include_closed: bool = False,
    company_names: list[str] | None = None,
    date_from: Column | None = None,
    date_to: Column | None = None,
) -> DataFrame:
    """Export filter: drops closed listings; date bounds spare undated ones."""
    rows = jobs
    if company_names:
        rows = rows.filter(F.col("company_name").isin(company_names))
    if not include_closed:
        rows = rows.filter(F.coalesce(F.col("status"), F.lit("open")) != "closed")
    posted = F.col("date_posted")
    if date_from is not None:
        rows = rows.filter(posted.isNull() | (posted >= date_from))
    if date_to is not None:
        rows = rows.filter(posted.isNull() | (posted <= date_to))
    return rows


def active_companies(companies: DataFrame) -> DataFrame:
    return companies.filter("is_active").orderBy("name", "id")


def select_sources(
    companies: DataFrame,
    adapter_type: str | None = None,
    slugs: list[str] | None = None,
    exclude: list[str] | None = None,
) -> DataFrame:
    rows = companies
    if adapter_type is not None:
        rows = rows.filter(F.col("adapter_type") == adapter_type)
    if slugs is not None:
        rows = rows.filter(F.col("slug").isin(slugs))
    if exclude:
        rows = rows.filter(~F.col("slug").isin(exclude))
    return rows


def compliance_gate(seed: DataFrame) -> DataFrame:
    """Seed rows with ``admitted`` and, for the others, the skip reason."""
    state = F.coalesce(F.col("compliance_status"), F.lit("unknown"))
    admitted = state.isin(ADMITTED_COMPLIANCE)
    return seed.withColumn("admitted", admitted).withColumn(
        "skip_reason",
        F.when(~admitted, F.concat(F.lit("compliance: "), state)),
    )


def mark_orphans(runs: DataFrame, now: Column, timeout_s: int = 3600) -> DataFrame:
    """Runs left running for too long become interrupted; ``swept`` flags them."""
    cutoff = F.date_trunc("second", now) - F.make_dt_interval(secs=F.lit(timeout_s))
    swept = (F.col("status") == "running") & (F.col("started_at") < cutoff)
    return (
        runs.withColumn("swept", swept)
        .withColumn("status", F.when(F.col("swept"), "interrupted").otherwise(F.col("status")))
        .withColumn("finished_at", F.when(F.col("swept"), now).otherwise(F.col("finished_at")))
    )


def mark_orphan_attempts(attempts: DataFrame, swept_runs: DataFrame, now: Column) -> DataFrame:
    """Open attempts of swept runs become interrupted too."""
    gone = swept_runs.filter("swept").select(F.col("id").alias("run_id")).withColumn("_gone", F.lit(True))
    hit = F.coalesce(F.col("_gone"), F.lit(False)) & (F.col("status") == "running")
    return (
        attach(attempts, gone, ["run_id"], "left")
        .withColumn("swept", hit)
        .withColumn("status", F.when(F.col("swept"), "interrupted").otherwise(F.col("status")))
        .withColumn("finished_at", F.when(F.col("swept"), now).otherwise(F.col("finished_at")))
        .drop("_gone")
        .select(*attempts.columns, "swept")
    )


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)


def active_alerts(
    alerts: DataFrame,
    alert_type: str | None = None,
    source: str | None = None,
    min_severity: str | None = None,
) -> DataFrame:
    rows = alerts.filter(~F.col("acknowledged"))
    if alert_type:
        rows = rows.filter(F.col("alert_type") == alert_type)
    if source:
        rows = rows.filter(F.col("source") == source)
    if min_severity:
        floor = SEVERITIES.index(min_severity) + 1
        rows = rows.filter(severity_rank(F.col("severity")) >= floor)
    return rows


def clear_acknowledged(alerts: DataFrame) -> DataFrame:
    return alerts.filter(~F.col("acknowledged"))
