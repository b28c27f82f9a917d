"""Joins between listings, companies, attempts, translations and source specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.dates import duration_seconds
from vacancylake.functions.text import blank_to_null, title_fingerprint
from vacancylake.operators.spread import attach
from vacancylake.session import literal_frame


def _company_names(companies: DataFrame) -> DataFrame:
    return companies.select(
        F.col("id").alias("company_id"),
        F.col("name").alias("company_name"),
        F.col("slug").alias("company_slug"),
    )


def jobs_with_company(jobs: DataFrame, companies: DataFrame, outer: bool = False) -> DataFrame:
    """Listings with company name and slug; outer keeps orphans as Unknown."""
    joined = attach(jobs, _company_names(companies), ["company_id"], "left" if outer else "inner")
    if not outer:
        return joined
    return joined.withColumn(
        "company_name", F.coalesce("company_name", F.lit("Unknown"))
    ).withColumn("company_slug", F.coalesce("company_slug", F.lit("")))


def attempts_with_company(
    attempts: DataFrame, companies: DataFrame, run_id: int | None = None
) -> DataFrame:
    """Attempts, oldest first, with company names and durations."""
    rows = attempts if run_id is None else attempts.filter(F.col("run_id") == run_id)
    joined = attach(rows, _company_names(companies), ["company_id"], "left")
    return (
        joined.withColumn("company_name", F.coalesce("company_name", F.lit("Unknown")))
        .withColumn("company_slug", F.coalesce("company_slug", F.lit("")))
        .withColumn("duration_seconds", duration_seconds(F.col("started_at"), F.col("finished_at")))
        .orderBy("started_at", "id")
    )


def pending_translations(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    """One row per title fingerprint that has no translation yet."""
    return (
        jobs.filter(blank_to_null(F.col("title")).isNotNull())
        .select(title_fingerprint(F.col("title")).alias("fingerprint"), F.trim("title").alias("title"))
        .groupBy("fingerprint")
        .agg(F.min("title").alias("title"))
        .join(cache.select("fingerprint"), "fingerprint", "left_anti")
    )


def apply_translations(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    """Set title_vi from the cache (fingerprint, translation); null when absent."""
    table = cache.select("fingerprint", F.col("translation").alias("_translation"))
    keyed = jobs.withColumn("fingerprint", title_fingerprint(F.col("title")))
    return attach(keyed, table, ["fingerprint"], "left").select(
        *[F.col("_translation").alias(c) if c == "title_vi" else F.col(c) for c in jobs.columns]
    )


def translation_counts(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    """Calls a translator would make, and titles served without one."""
    titled = jobs.filter(blank_to_null(F.col("title")).isNotNull())
    per_title = titled.groupBy(title_fingerprint(F.col("title")).alias("fingerprint")).agg(
        F.count("*").alias("n")
    )
    known = cache.select("fingerprint").withColumn("_known", F.lit(True))
    missing = F.col("_known").isNull()
    return per_title.join(known, "fingerprint", "left").agg(
        F.count_if(missing).alias("calls"),
        F.coalesce(F.sum(F.when(missing, F.col("n") - 1).otherwise(F.col("n"))), F.lit(0)).alias(
            "hits"
        ),
    )


def unmatched_sources(companies: DataFrame, specs: DataFrame) -> DataFrame:
    """Companies no source spec covers, as failed outcomes."""
    return companies.join(specs.select("slug"), "slug", "left_anti").select(
        F.col("id").alias("company_id"),
        "slug",
        F.lit("failed").alias("status"),
        F.lit("NoAdapter").alias("error_type"),
        F.concat(F.lit("No adapter registered for "), F.col("slug")).alias("error_message"),
    )


def companies_by_slugs(companies: DataFrame, slugs: list[str]) -> tuple[DataFrame, DataFrame]:
    """Requested companies in request order, and the slugs not found."""
    asked = [{"request_pos": pos, "slug": slug} for pos, slug in enumerate(slugs)]
    wanted = literal_frame(companies.sparkSession, asked, "request_pos int, slug string")
    found = companies.join(F.broadcast(wanted), "slug").orderBy("request_pos")
    missing = wanted.join(companies.select("slug").filter(F.col("slug").isin(slugs)), "slug", "left_anti")
    return found, missing


def with_fallback(
    primary_rows: DataFrame,
    primary_metrics: DataFrame,
    fallback_rows: DataFrame,
    fallback_metrics: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Fallback rows count only when every primary source failed.

    Metrics of the fallback are added under the same condition, next to those of
    the primary sources.
    """
    all_failed: Column = primary_metrics.agg(
        F.coalesce(F.every(F.col("status") == "failed"), F.lit(False)).alias("f")
    ).scalar()
    rows = primary_rows.unionByName(fallback_rows.filter(all_failed), allowMissingColumns=True)
    metrics = primary_metrics.unionByName(
        fallback_metrics.filter(all_failed), allowMissingColumns=True
    )
    return rows, metrics


def union_sources(frames: dict[str, DataFrame], required: tuple[str, ...] = ("title", "url")):
    """All sources' rows in one frame, each stamped with its source slug.

    A frame without the required columns cannot hold listings: it is left out
    and its slug returned in the second value.
    """
    skipped = [slug for slug, df in frames.items() if not set(required) <= set(df.columns)]
    union: DataFrame | None = None
    for slug, df in frames.items():
        if slug in skipped:
            continue
        stamped = df.withColumn("source", F.lit(slug))
        union = stamped if union is None else union.unionByName(stamped, allowMissingColumns=True)
    return union, skipped
