"""Upserts as set-based joins on the table's natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.operators.identity import KEY
from vacancylake.operators.spread import attach


def upsert_jobs(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Merge de-duplicated records into the listings table.

    Both sides hold one row per key, so the full outer join has no hot key.
    ``op`` is created, updated or kept. The id and creation time of a known
    listing never change; title_vi and salary_raw keep their value when the
    incoming one is null. A ``change`` that reconciling noted stays beside ``op``.
    """
    old, new = current.alias("old"), incoming.alias("new")
    known, seen = F.col("old.id").isNotNull(), F.col("new.status").isNotNull()

    def pick(name: str) -> Column:
        return F.when(seen, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    def keep(name: str) -> Column:
        return F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).alias(name)

    key = [F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}")).alias(k) for k in KEY]
    merged = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in KEY], "full_outer")
    return merged.select(
        F.coalesce(
            F.col("old.id"),
            F.xxhash64(F.col("new.company_id"), F.col("new.canonical_url")),
        ).alias("id"),
        key[0],
        pick("title"),
        keep("title_vi"),
        pick("location"),
        pick("url"),
        key[1],
        pick("date_posted"),
        pick("status"),
        pick("source_job_id"),
        keep("salary_raw"),
        pick("raw_data"),
        F.coalesce(F.col("old.missing_count"), F.lit(0)).alias("missing_count"),
        F.coalesce(F.col("old.first_seen_at"), now).alias("first_seen_at"),
        F.when(seen, now).otherwise(F.col("old.last_seen_at")).alias("last_seen_at"),
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        F.when(seen, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
        F.when(~known, "created").when(seen, "updated").otherwise("kept").alias("op"),
        *[F.col(f"old.{name}") for name in ("change",) if name in current.columns],
    )


def upsert_companies(current: DataFrame, seed: DataFrame, now: Column) -> DataFrame:
    """Merge seed rows into companies by slug, with the same ``op`` values."""
    old, new = current.alias("old"), seed.alias("new")
    seen = F.col("new.slug").isNotNull()
    written = ["name", "adapter_type", "base_url", "config", "is_active", "authoritative"]
    return old.join(new, F.col("old.slug") == F.col("new.slug"), "full_outer").select(
        F.coalesce(F.col("old.id"), F.xxhash64(F.col("new.slug"))).alias("id"),
        F.coalesce(F.col("old.slug"), F.col("new.slug")).alias("slug"),
        *[
            F.when(seen, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)
            for name in written
        ],
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        F.when(seen, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
        F.when(F.col("old.id").isNull(), "created")
        .when(seen, "updated")
        .otherwise("kept")
        .alias("op"),
    )


def deactivate_company(companies: DataFrame, company_id: int, now: Column) -> DataFrame:
    hit = F.col("id") == company_id
    return companies.withColumn(
        "is_active", F.when(hit, F.lit(False)).otherwise(F.col("is_active"))
    ).withColumn("updated_at", F.when(hit, now).otherwise(F.col("updated_at")))


def apply_row_updates(table: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite non-null fields by id; ``matched`` flags the rows touched."""
    fields = [name for name in updates.columns if name != "id"]
    renamed = updates.select(
        "id", *[F.col(name).alias(f"_new_{name}") for name in fields]
    ).withColumn("_hit", F.lit(True))
    joined = attach(table, renamed, ["id"], "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{name}"), F.col(name)).alias(name)
            if name in fields
            else F.col(name)
            for name in table.columns
        ],
        F.coalesce(F.col("_hit"), F.lit(False)).alias("matched"),
    )
