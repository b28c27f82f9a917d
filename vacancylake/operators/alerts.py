"""Alerts as rows: any sink can deliver them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COLUMNS = ["alert_type", "severity", "source", "message", "details", "ts", "acknowledged"]


def _details(**values: Column) -> Column:
    items = [part for name, value in values.items() for part in (F.lit(name), value.cast("string"))]
    return F.create_map(*items) if items else F.create_map().cast("map<string,string>")


def _alert(df: DataFrame, kind: Column, severity: Column, message: Column, details: Column) -> DataFrame:
    return df.select(
        kind.alias("alert_type"),
        severity.alias("severity"),
        "source",
        message.alias("message"),
        details.cast("map<string,string>").alias("details"),
        "ts",
        F.lit(False).alias("acknowledged"),
    )


def drift_alerts(drifts: DataFrame) -> DataFrame:
    """From drift events (source, ts, selector, expected_min, actual_count, severity, message)."""
    known = F.col("severity").isin("warning", "error", "critical")
    return _alert(
        drifts,
        F.lit("selector_drift"),
        F.when(known, F.col("severity")).otherwise("warning"),
        F.concat(F.lit("Selector drift detected: "), F.col("message")),
        _details(
            selector=F.col("selector"),
            expected_min=F.col("expected_min"),
            actual_count=F.col("actual_count"),
            drift_severity=F.col("severity"),
        ),
    )


def failure_alerts(failures: DataFrame) -> DataFrame:
    """From failed or partial sources (source, ts, error_message, is_partial)."""
    return _alert(
        failures,
        F.lit("scrape_failure"),
        F.when(F.col("is_partial"), "warning").otherwise("error"),
        F.concat(
            F.lit("Scraping failed"),
            F.when(F.col("is_partial"), " (partial)").otherwise(""),
            F.lit(": "),
            F.coalesce("error_message", F.lit("")),
        ),
        _details(),
    )


def zero_job_alerts(anomalies: DataFrame) -> DataFrame:
    """From zero-listing anomalies (source, ts, current_count)."""
    return _alert(
        anomalies,
        F.lit("zero_jobs"),
        F.lit("critical"),
        F.concat(F.lit("Zero jobs returned from "), F.col("source"), F.lit("!")),
        _details(job_count=F.col("current_count")),
    )


def fault_alerts(faults: DataFrame) -> DataFrame:
    """From classified faults (source, ts, fault); other families yield no row.

    Faults: rate_limit, anti_bot, parse, auth and transient. The last two mean
    the source could not be read.
    """
    fault = F.col("fault")
    kind = (
        F.when(fault == "rate_limit", "rate_limit")
        .when(fault == "anti_bot", "anti_bot")
        .when(fault == "parse", "parse_error")
        .when(fault.isin("auth", "transient"), "source_unavailable")
    )
    severity = (
        F.when(fault == "anti_bot", "critical").when(fault == "auth", "error").otherwise("warning")
    )
    message = (
        F.when(fault == "rate_limit", F.concat(F.lit("Rate limit hit for "), F.col("source")))
        .when(
            fault == "anti_bot",
            F.concat(F.lit("Anti-bot protection detected for "), F.col("source")),
        )
        .when(fault == "parse", F.concat(F.lit("Parse error for "), F.col("source")))
        .otherwise(F.concat(F.lit("Source unavailable: "), F.col("source")))
    )
    return _alert(
        faults.filter(fault.isin("rate_limit", "anti_bot", "parse", "auth", "transient")),
        kind,
        severity,
        message,
        _details(),
    )


def to_alerts(*parts: DataFrame) -> DataFrame:
    """One alert table from any of the projections above."""
    alerts = parts[0].select(*_COLUMNS)
    for part in parts[1:]:
        alerts = alerts.unionByName(part.select(*_COLUMNS))
    return alerts


def drift_text(drifts: DataFrame) -> DataFrame:
    """Drift events with the multi-line text shown to people as ``text``."""
    return drifts.withColumn(
        "text",
        F.concat(
            F.lit("["), F.upper("severity"), F.lit("] Selector Drift: "), F.col("message"),
            F.lit("\n  Selector: "), F.col("selector"),
            F.lit("\n  Expected: >= "), F.col("expected_min").cast("string"), F.lit(" matches"),
            F.lit("\n  Actual: "), F.col("actual_count").cast("string"), F.lit(" matches"),
            F.lit("\n  Time: "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
        ),
    )
