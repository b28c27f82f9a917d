"""Fetch-failure rules: what to retry, when, and what kind of fault it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Answers and faults worth another try.
RETRYABLE_STATUS_CODES = [408, 429, 500, 502, 503, 504]
RETRYABLE_ERROR_TYPES = ["timeout", "TimeoutError", "ConnectionError", "TimeoutException"]


def is_retryable(status_code: Column, error_type: Column) -> Column:
    return F.coalesce(status_code.isin(RETRYABLE_STATUS_CODES), F.lit(False)) | F.coalesce(
        error_type.isin(RETRYABLE_ERROR_TYPES), F.lit(False)
    )


def is_failure(status_code: Column, error_type: Column) -> Column:
    return error_type.isNotNull() | F.coalesce(status_code >= 400, F.lit(False))


def retry_plan(
    fetch_log: DataFrame,
    max_retries: int = 3,
    base: float = 1.0,
    cap: float = 30.0,
    factor: float = 2.0,
    jitter_seed: int | None = None,
) -> DataFrame:
    """Failed fetches with the time of their next try, or marked final.

    ``attempt`` counts tries made so far. With ``jitter_seed`` the delay is
    uniform between zero and the computed one.
    """
    attempt = F.col("attempt")
    delay = F.least(F.lit(base) * F.pow(F.lit(factor), attempt - 1), F.lit(cap))
    if jitter_seed is not None:
        delay = delay * F.rand(jitter_seed)
    again = is_retryable(F.col("status_code"), F.col("error_type")) & (attempt < max_retries)
    micros = F.unix_micros("finished_at") + F.floor(delay * 1_000_000)
    return (
        fetch_log.filter(is_failure(F.col("status_code"), F.col("error_type")))
        .withColumn("is_final", ~again)
        .withColumn("delay_seconds", F.when(again, delay))
        .withColumn("next_attempt_at", F.when(again, F.timestamp_micros(micros.cast("bigint"))))
    )


def recovery_class(status_code: Column, error_type: Column, jobs_found: Column) -> Column:
    """Fault family: auth, anti_bot, transient, parse or data_quality; else null."""
    kind = F.lower(F.coalesce(error_type, F.lit("")))
    return (
        F.when(kind.contains("challenge") | kind.contains("anti_bot"), "anti_bot")
        .when(status_code.isin(401, 403), "auth")
        .when(is_retryable(status_code, error_type) | kind.contains("timeout"), "transient")
        .when(kind.contains("parse") | kind.contains("selector"), "parse")
        .when(error_type.isNull() & (jobs_found == 0), "data_quality")
    )
