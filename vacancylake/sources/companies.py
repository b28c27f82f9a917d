"""The seed list of companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.operators.merge import upsert_companies
from vacancylake.operators.quality import compliance_gate
from vacancylake.session import literal_frame

SEED_SCHEMA = (
    "name string, slug string, adapter_type string, base_url string, config string, "
    "is_active boolean, authoritative boolean, compliance_status string"
)

# Name, slug, family, careers page, config and compliance state.
SEED = [
    ("OPSWAT", "opswat", "api", "https://www.opswat.com/careers", "{}", "needs-review"),
    ("Vancity", "vancity", "api", "https://jobs.vancity.com", "{}", "needs-review"),
    (
        "Farm Credit Canada", "farm-credit-canada", "api",
        "https://fccfac.wd3.myworkdayjobs.com/en-US/careers-carrieres",
        '{"workday_tenant": "fccfac"}', "needs-review",
    ),
    (
        "CalOptima", "caloptima", "html",
        "https://careers.pageuppeople.com/1150/cw/en-us/listing", "{}", "needs-review",
    ),
    ("iQmetrix", "iqmetrix", "html", "https://iqmetrix.applytojob.com/apply", "{}", "needs-review"),
    (
        "First West Credit Union", "first-west", "html", "https://careers.firstwestcu.ca", "{}",
        "needs-review",
    ),
    (
        "Electric Power Engineers", "electric-power-engineers", "html",
        "https://join.epeconsulting.com/EPE-Engineering-Jobs/jobs", "{}", "needs-review",
    ),
    (
        "Absolute Security", "absolute-security", "html",
        "https://jobs.jobvite.com/absolute/jobs", "{}", "needs-review",
    ),
    (
        "TikTok", "tiktok", "browser", "https://careers.tiktok.com", "{}", "needs-review",
    ),
    (
        "Northrop Grumman", "northrop", "browser", "https://www.northropgrumman.com/careers", "{}",
        "needs-review",
    ),
]


def seed_frame(spark: SparkSession) -> DataFrame:
    names = ["name", "slug", "adapter_type", "base_url", "config", "compliance_status"]
    rows = [dict(zip(names, row), is_active=True, authoritative=True) for row in SEED]
    return literal_frame(spark, rows, SEED_SCHEMA)


def load_companies(
    current: DataFrame, seed: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Companies after seeding, and the seed rows compliance holds back."""
    gated = compliance_gate(seed)
    admitted = gated.filter("admitted").drop("admitted", "skip_reason", "compliance_status")
    held_back = gated.filter(~F.col("admitted")).drop("admitted")
    return upsert_companies(current, admitted, now), held_back
