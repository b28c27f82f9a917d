"""Per-source extraction outcomes from the log of fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.operators.spread import attach

# Answers that end a source with an error instead of a warning.
AUTH_STATUS_CODES = [401, 403]


def page_outcomes(fetch_log: DataFrame, keys: list[str]) -> DataFrame:
    """One row per page: its last attempt, all its attempts counted."""
    has_warnings = "n_warnings" in fetch_log.columns
    last = F.max_by(
        F.struct(
            "status_code",
            F.lower("content_type").alias("content_type"),
            "error_type",
            "n_jobs",
            (F.col("n_warnings") if has_warnings else F.lit(0)).alias("n_warnings"),
        ),
        F.coalesce("attempt", F.lit(1)),
    )
    pages = fetch_log.groupBy(*keys, "family", "page_no").agg(
        last.alias("_last"), F.count("*").alias("requests")
    )
    return pages.select(*keys, "family", "page_no", "requests", "_last.*")


def judged_pages(fetch_log: DataFrame, keys: list[str]) -> DataFrame:
    """Page outcomes with ``failed``."""
    pages = page_outcomes(fetch_log, keys)
    non_html = (F.col("family") == "html") & ~F.coalesce(F.col("content_type").contains("text/html"), F.lit(False))
    return pages.withColumn(
        "failed",
        F.col("error_type").isNotNull() | F.coalesce(F.col("status_code") >= 400, F.lit(False)) | non_html,
    )


def readable_pages(pages: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """The pages (source, page_no, ...) before their source's first failing page."""
    failed = judged_pages(fetch_log, ["source"]).filter("failed")
    stops = failed.groupBy("source").agg(F.min("page_no").alias("_stop_page"))
    return (
        attach(pages, stops, ["source"], "left")
        .filter(F.col("_stop_page").isNull() | (F.col("page_no") < F.col("_stop_page")))
        .drop("_stop_page")
    )


def stated_totals(pages: DataFrame) -> DataFrame:
    """(source, stated_total): the number of listings a JSON source says it has."""
    total = F.coalesce(*[F.get_json_object("body", path) for path in ("$.meta.total", "$.total")])
    return pages.groupBy("source").agg(F.max(total.cast("bigint")).alias("stated_total"))


def classify_extraction(fetch_log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Status, counters and warning of each source.

    Pages after a source's first failing page are ignored. Families differ in
    what an empty result means: see the status rule at the end.
    """
    keys = keys or ["source"]
    pages = judged_pages(fetch_log, keys)
    code, fault = F.col("status_code"), F.col("error_type")
    on_page = F.concat(F.lit(" on page "), F.col("page_no").cast("string"))
    slow = F.lower(F.coalesce(fault, F.lit(""))).contains("timeout")
    challenge = F.coalesce(fault.startswith("challenge"), F.lit(False))
    warning = (
        F.when(code.isin(AUTH_STATUS_CODES), F.lit(None).cast("string"))
        .when(code == 429, F.concat(F.lit("Rate limited"), on_page, F.lit(", continuing with partial data")))
        .when(code >= 400, F.concat(F.lit("HTTP error"), on_page, F.lit(": "), code.cast("string")))
        .when(challenge, F.concat(F.lit("Anti-bot challenge"), on_page, F.lit(": "), F.substring_index(fault, ":", -1)))
        .when(slow, F.concat(F.lit("Timeout"), on_page))
        .when(fault.isNotNull(), F.concat(F.lit("Error"), on_page, F.lit(": "), fault))
        .otherwise(
            F.concat(
                F.lit("Page "), F.col("page_no").cast("string"),
                F.lit(" returned non-HTML content: "), F.coalesce("content_type", F.lit("")),
            )
        )
    )
    denied = F.when(
        code.isin(AUTH_STATUS_CODES),
        F.concat(
            F.when(F.col("family") == "api", "Authentication failed: ").otherwise("Access denied: "),
            code.cast("string"),
        ),
    )
    first_failure = (
        pages.filter("failed")
        .groupBy(*keys)
        .agg(F.min_by(F.struct("page_no", warning.alias("w"), denied.alias("e")), "page_no").alias("_stop"))
    )
    read = attach(pages, first_failure, keys, "left").filter(
        F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop.page_no"))
    )
    ok = ~F.col("failed")
    totals = read.groupBy(*keys, "family").agg(
        F.coalesce(F.sum(F.when(ok, F.col("n_jobs"))), F.lit(0)).cast("bigint").alias("jobs_found"),
        F.count_if(ok).alias("pages_fetched"),
        F.sum("requests").alias("requests_made"),
        F.coalesce(F.sum(F.when(ok, F.col("n_warnings"))), F.lit(0)).alias("_parse_warnings"),
        F.first("_stop").alias("_stop"),
        F.min("page_no").alias("_low"),
        F.max("page_no").alias("_high"),
        F.count("*").alias("_n"),
    )
    return _with_status(totals).select(
        *keys,
        "family",
        "status",
        "error",
        "warning",
        "n_warnings",
        "jobs_found",
        "pages_fetched",
        "requests_made",
        "complete",
    )


def _with_status(totals: DataFrame) -> DataFrame:
    empty = F.col("jobs_found") == 0
    warned = F.col("n_warnings") > 0
    hostile = F.coalesce(F.lower("warning").rlike("challenge|blocked"), F.lit(False))
    browser: Column = (
        F.when(empty & warned, F.when(hostile, "failed").otherwise("partial"))
        .when(warned, "partial")
        .otherwise("success")
    )
    html = F.when(empty & warned, "failed").when(empty, "partial").otherwise("success")
    api = F.when(empty & warned, "failed").otherwise("success")
    return (
        totals.withColumn("warning", F.col("_stop.w"))
        .withColumn("error", F.col("_stop.e"))
        .withColumn(
            "n_warnings",
            F.col("_parse_warnings") + F.when(F.col("warning").isNotNull(), 1).otherwise(0),
        )
        .withColumn(
            "status",
            F.when(F.col("error").isNotNull(), "failed")
            .when(F.col("family") == "browser", browser)
            .when(F.col("family") == "html", html)
            .otherwise(api),
        )
        .withColumn(
            "complete",
            F.col("_stop").isNull()
            & (F.col("_low") == 1)
            & (F.col("_high") == F.col("_n")),
        )
    )


def snapshot_complete(pages: DataFrame, page_size: int = 100) -> DataFrame:
    """Whether each source's pages form a whole snapshot.

    ``pages``: source, style (offset or page), page_no, current_count, total,
    page_offset, failed. Offset sources end when offset + count reaches the
    total, page sources when the last page is not full.
    """
    per_source = pages.groupBy("source").agg(
        F.max_by(F.struct("style", "current_count", "total", "page_offset"), "page_no").alias("_last"),
        F.bool_or("failed").alias("_failed"),
        F.min("page_no").alias("_low"),
        F.max("page_no").alias("_high"),
        F.count("*").alias("pages"),
    )
    last = {name: F.col(f"_last.{name}") for name in ("style", "current_count", "total", "page_offset")}
    ended = F.when(
        last["style"] == "offset",
        last["page_offset"] + last["current_count"] >= last["total"],
    ).otherwise(last["current_count"] != page_size)
    whole = ~F.col("_failed") & (F.col("_low") == 1) & (F.col("_high") == F.col("pages"))
    return per_source.select(
        "source",
        last["current_count"].alias("current_count"),
        last["total"].alias("total"),
        "pages",
        (~ended).alias("has_next"),
        (ended & whole).alias("complete"),
    )


def classify_zero_result(extractions: DataFrame) -> DataFrame:
    """Why a source yielded nothing; null when it yielded something.

    Uses jobs_found, status, complete, n_warnings and, where known,
    challenge_detected and container_matches.
    """

    def known(name: str) -> Column:
        return F.col(name) if name in extractions.columns else F.lit(None)

    hostile = F.coalesce(known("challenge_detected").cast("boolean"), F.lit(False)) | F.coalesce(
        F.lower("warning").rlike("challenge|blocked"), F.lit(False)
    )
    matches = known("container_matches").cast("bigint")
    clean = (F.col("n_warnings") == 0) & F.col("error").isNull()
    return extractions.withColumn(
        "zero_class",
        F.when(F.col("jobs_found") > 0, F.lit(None).cast("string"))
        .when(hostile, "anti_bot")
        .when((F.col("pages_fetched") > 0) & (F.coalesce(matches == 0, F.lit(False)) | ~clean), "parse_error")
        .when(F.col("complete") & clean, "true_empty")
        .otherwise("unverified_empty"),
    )


def dry_run_counts(extractions: DataFrame) -> DataFrame:
    """What a run would have found, per source; any error means partial."""
    return extractions.select(
        "source",
        "jobs_found",
        "n_warnings",
        F.when(F.col("error").isNotNull(), "partial").otherwise("success").alias("status"),
    )
