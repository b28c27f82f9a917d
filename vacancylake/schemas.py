"""Explicit table schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_LONG, _INT, _TEXT, _FLAG, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampType(),
)

COMPANIES = _table(
    ("id", _LONG, False),
    ("name", _TEXT, False),
    ("slug", _TEXT, False),
    ("adapter_type", _TEXT, False),
    ("base_url", _TEXT, False),
    ("config", _TEXT, True),
    ("is_active", _FLAG, True),
    ("authoritative", _FLAG, True),
    ("created_at", _TIME, True),
    ("updated_at", _TIME, True),
)

JOBS = _table(
    ("id", _LONG, False),
    ("company_id", _LONG, False),
    ("title", _TEXT, False),
    ("title_vi", _TEXT, True),
    ("location", _TEXT, False),
    ("url", _TEXT, False),
    ("canonical_url", _TEXT, False),
    ("date_posted", _TIME, True),
    ("status", _TEXT, False),
    ("source_job_id", _TEXT, True),
    ("salary_raw", _TEXT, True),
    ("raw_data", _TEXT, True),
    ("missing_count", _INT, True),
    ("first_seen_at", _TIME, True),
    ("last_seen_at", _TIME, True),
    ("created_at", _TIME, True),
    ("updated_at", _TIME, True),
)

RUNS = _table(
    ("id", _LONG, False),
    ("started_at", _TIME, False),
    ("finished_at", _TIME, True),
    ("status", _TEXT, False),
    ("triggered_by", _TEXT, True),
    ("notes", _TEXT, True),
)

ATTEMPTS = _table(
    ("id", _LONG, False),
    ("run_id", _LONG, False),
    ("company_id", _LONG, False),
    ("started_at", _TIME, False),
    ("finished_at", _TIME, True),
    ("status", _TEXT, False),
    ("jobs_found", _INT, True),
    ("records_rejected", _INT, True),
    ("new_jobs", _INT, True),
    ("closed_jobs", _INT, True),
    ("missing_count", _INT, True),
    ("pages_fetched", _INT, True),
    ("requests_made", _INT, True),
    ("complete", _FLAG, True),
    ("authoritative_snapshot", _FLAG, True),
    ("error_type", _TEXT, True),
    ("error_message", _TEXT, True),
    ("warnings", _TEXT, True),
)

#: Listing rows as a source emits them, before normalisation.
RAW_LISTINGS = _table(
    ("source", _TEXT, True),
    ("page_no", _INT, True),
    ("pos", _INT, True),
    ("source_job_id", _TEXT, True),
    ("title", _TEXT, True),
    ("location", _TEXT, True),
    ("url", _TEXT, True),
    ("date_posted", _TEXT, True),
    ("salary_raw", _TEXT, True),
    ("raw_data", _TEXT, True),
)

#: One fetched page, JSON or HTML.
PAGES = _table(
    ("source", _TEXT, False),
    ("page_no", _INT, False),
    ("url", _TEXT, True),
    ("status_code", _INT, True),
    ("content_type", _TEXT, True),
    ("body", _TEXT, True),
    ("fetched_at", _TIME, True),
)

#: One request outcome.
FETCH_LOG = _table(
    ("source", _TEXT, False),
    ("family", _TEXT, False),
    ("page_no", _INT, False),
    ("attempt", _INT, True),
    ("started_at", _TIME, True),
    ("finished_at", _TIME, True),
    ("status_code", _INT, True),
    ("content_type", _TEXT, True),
    ("error_type", _TEXT, True),
    ("n_jobs", _INT, True),
)

TABLES = {
    "companies": COMPANIES,
    "jobs": JOBS,
    "runs": RUNS,
    "attempts": ATTEMPTS,
}
