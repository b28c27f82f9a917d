"""One scrape snapshot, from fetched pages to merged listings."""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylake import schemas
from vacancylake.operators.extraction import classify_extraction, readable_pages, stated_totals
from vacancylake.operators.identity import KEY, dedupe, duplicates
from vacancylake.operators.lookup import unmatched_sources
from vacancylake.operators.merge import upsert_jobs
from vacancylake.operators.quality import split_by, to_records, validate_raw
from vacancylake.operators.reconcile import reconcile
from vacancylake.operators.rollups import attempt_rows, overall_status
from vacancylake.operators.spread import attach
from vacancylake.session import materialize
from vacancylake.sinks import tables as sinks
from vacancylake.sources.html import extract_pages, listings
from vacancylake.sources.pages import html_pages
from vacancylake.sources.specs import SourceCatalog


class SnapshotResult(NamedTuple):
    jobs: DataFrame
    attempts: DataFrame
    run_status: DataFrame
    skipped: DataFrame
    rejected: DataFrame
    dropped: DataFrame
    #: Snapshot of the listings table the run started from; empty: none yet, None: not told.
    base: str | None = None


def raw_listings(pages: DataFrame, catalog: SourceCatalog) -> DataFrame:
    """Raw rows of every source: one plan per parser, one for all page rules."""
    slugs_of = defaultdict(list)
    for spec in catalog.enabled():
        if spec.parse is not None:
            slugs_of[spec.parse].append(spec.slug)
    parts = [parse(pages.filter(F.col("source").isin(slugs))) for parse, slugs in slugs_of.items()]
    ruled = [spec.slug for spec in catalog.enabled() if spec.rule is not None]
    if ruled:
        fetched = pages.filter(
            F.col("source").isin(ruled) & F.coalesce(F.col("status_code") < 400, F.lit(True))
        )
        rules = catalog.rules(pages.sparkSession)
        parts.append(listings(extract_pages(html_pages(fetched), rules)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union


def run_snapshot(
    pages: DataFrame,
    fetch_log: DataFrame,
    jobs: DataFrame,
    companies: DataFrame,
    catalog: SourceCatalog,
    run_id: int,
    started_at: Column,
    now: Column,
    threshold: int = 2,
    mode: str = "threshold",
    base: str | None = None,
) -> SnapshotResult:
    """Merge one run's pages into the listings table.

    All companies go through one plan. A source that failed is known by its row
    in the extraction outcomes and leaves its listings untouched. The checked raw
    rows, the records, the outcomes and the merged listings are materialized, because
    several results are drawn from each; the counters come from the merged rows' ``op``
    and ``change``.

    Listings come from the pages before a source's first failing page. A crawl is
    complete only if it also ended by itself: where the source states its number
    of listings, so many were found; else a page source stopped before the
    catalog's page limit. An incomplete crawl closes nothing.

    ``base`` names the snapshot that ``jobs`` were read at (``tables.read_based``);
    the run is stored only over that one.
    """
    spark = pages.sparkSession
    readable = readable_pages(pages, fetch_log)
    # stored, for a filter over parsed columns would parse each listing again for every use of one
    valid, skipped = split_by(materialize(validate_raw(raw_listings(readable, catalog))), "skip_reasons")
    ids = companies.filter("is_active").select(
        F.col("slug").alias("source"), F.col("id").alias("company_id")
    )
    owned = attach(valid, ids, ["source"], "left")
    stray = F.array(F.lit("source is no active company"))
    skipped = skipped.unionByName(
        owned.filter("company_id is null").drop("company_id").withColumn("skip_reasons", stray)
    )
    records = materialize(to_records(owned.filter("company_id is not null")))
    good, rejected = split_by(records, "reject_reasons")
    unique, dropped = dedupe(good), duplicates(good)

    limits = catalog.frame(spark).select(F.col("slug").alias("source"), "max_pages")
    ended = F.coalesce(
        F.col("jobs_found") >= F.col("stated_total"),
        (F.col("family") == "api") | (F.col("pages_fetched") < F.col("max_pages")),
        F.lit(True),
    )
    extracted = attach(classify_extraction(fetch_log), stated_totals(pages), ["source"], "left")
    extracted = attach(extracted, limits, ["source"], "left").withColumn("complete", F.col("complete") & ended)
    # a row a company, but drawn from every page's text, and read by each result
    outcomes = materialize(
        attach(
            extracted.drop("stated_total", "max_pages"),
            companies.select(
                F.col("slug").alias("source"), F.col("id").alias("company_id"), "authoritative"
            ),
            ["source"],
            "inner",
        )
    )
    judged = outcomes.select(
        "company_id",
        "status",
        "complete",
        F.col("authoritative").alias("authoritative_snapshot"),
        started_at.alias("started_at"),
    )
    reconciled = reconcile(jobs.drop("op", "change"), unique.select(*KEY), judged, now, threshold, mode)
    merged = materialize(upsert_jobs(reconciled, unique, now))

    counters = attempt_rows(good, rejected, dropped, merged, merged)
    missing = unmatched_sources(companies.filter("is_active"), catalog.frame(spark))
    attempts = (
        outcomes.drop("jobs_found", "warning", "n_warnings", "family")
        .join(counters, "company_id", "left")
        .unionByName(missing.withColumnRenamed("slug", "source"), allowMissingColumns=True)
        .select(
            F.xxhash64(F.lit(run_id), "company_id").alias("id"),
            F.lit(run_id).cast("bigint").alias("run_id"),
            "company_id",
            started_at.alias("started_at"),
            now.alias("finished_at"),
            "status",
            *[
                F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
                for c in ("jobs_found", "records_rejected", "new_jobs", "closed_jobs", "reopened_jobs")
            ],
            *[
                F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
                for c in ("pages_fetched", "requests_made")
            ],
            F.coalesce("complete", F.lit(False)).alias("complete"),
            F.coalesce("authoritative", F.lit(False)).alias("authoritative_snapshot"),
            F.when(F.col("error").isNotNull(), "ExtractionError")
            .otherwise(F.col("error_type"))
            .alias("error_type"),
            F.coalesce("error", "error_message").alias("error_message"),
            "warnings",
        )
    )
    return SnapshotResult(merged, attempts, overall_status(attempts), skipped, rejected, dropped, base)


def store_run(
    result: SnapshotResult, root: str, run_id: int, started_at: Column, now: Column, triggered_by: str = "cli"
) -> None:
    """Keep a run: its rejects, attempts and run row, and last the merged listings.

    Everything but the listings lies in a folder of the run, so storing a run again
    replaces its rows. The published listings carry the run's id; a run that has
    published, be it the newest or not, is not published again. A run whose base is
    no longer current raises TableChanged before anything is written, and if another
    writer publishes meanwhile, before the listings are.
    """
    spark = result.jobs.sparkSession
    published = {v.tag for v in sinks.versions(spark, f"{root}/jobs")}
    current = sinks.current_snapshot(spark, f"{root}/jobs") or ""
    if str(run_id) not in published and result.base not in (None, current):
        raise sinks.TableChanged(f"{root}/jobs")
    reasons = {"validate": (result.skipped, "skip_reasons"), "transform": (result.rejected, "reject_reasons")}
    rejects = {stage: rows.withColumnRenamed(column, "reasons") for stage, (rows, column) in reasons.items()}
    rejects["dedupe"] = result.dropped.withColumn("reasons", F.array(F.lit("duplicate")))
    for stage, rows in rejects.items():
        dated = rows.withColumn("date_posted", F.col("date_posted").cast("string"))  # text before it is parsed
        sinks.write_rejects(dated, f"{root}/rejects", stage, run_id)

    def shaped(df: DataFrame, schema: StructType, key: str) -> DataFrame:
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema if f.name != key
        ])

    attempts = shaped(result.attempts, schemas.ATTEMPTS, "run_id")
    attempts.write.mode("overwrite").parquet(f"{root}/attempts/run_id={run_id}")
    run = result.run_status.select(
        started_at.alias("started_at"), now.alias("finished_at"), F.col("run_status").alias("status"),
        F.lit(triggered_by).alias("triggered_by"),
    )
    shaped(run, schemas.RUNS, "id").write.mode("overwrite").parquet(f"{root}/runs/id={run_id}")
    if str(run_id) not in published:
        base = current if result.base is None else result.base
        sinks.write_snapshot(shaped(result.jobs, schemas.JOBS, ""), f"{root}/jobs", tag=str(run_id), base=base)
