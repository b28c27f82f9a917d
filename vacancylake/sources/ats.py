"""Listing rows from applicant-tracking-system JSON pages.

Objects inside a page are first read as raw JSON text and then field by field,
so one malformed listing costs that listing and not its page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.text import blank_to_null

_GREENHOUSE_ITEM = (
    "id string, title string, location string, updated_at string, absolute_url string, "
    "department string, employment_type string, internal_job_id string"
)
_WORKDAY_ITEM = (
    "jobPostingId string, title string, locations string, subcategory string, "
    "postedOn string, absoluteUrl string, workdayUrl string"
)
_JSON = {"ignoreNullFields": "false"}


def _items(pages: DataFrame, field: str, item_schema: str) -> DataFrame:
    parsed = F.from_json("body", f"{field} array<string>")
    return (
        pages.filter(F.coalesce(F.col("status_code") < 400, F.lit(True)))
        .select("source", "page_no", F.posexplode(parsed[field]).alias("pos", "_item"))
        .select("source", "page_no", "pos", F.from_json("_item", item_schema).alias("j"))
    )


def _whole_number(text: Column) -> Column:
    return text.try_cast("bigint")


def flatten_greenhouse(pages: DataFrame) -> DataFrame:
    """``jobs[]`` of Greenhouse pages as raw listing rows."""
    # named in a step of its own, for trimming looks at it several times and each look would parse it again
    items = _items(pages, "jobs", _GREENHOUSE_ITEM).withColumn("_place", F.get_json_object("j.location", "$.name"))
    department = F.col("j.department")
    return items.select(
        "source",
        "page_no",
        "pos",
        F.coalesce("j.id", F.lit("")).alias("source_job_id"),
        F.coalesce("j.title", F.lit("")).alias("title"),
        F.coalesce(blank_to_null(F.col("_place")), F.lit("Remote")).alias("location"),
        F.coalesce("j.absolute_url", F.lit("")).alias("url"),
        F.col("j.updated_at").alias("date_posted"),
        F.to_json(
            F.struct(
                F.when(department.startswith("{"), F.get_json_object(department, "$.name")).alias(
                    "department"
                ),
                F.col("j.employment_type").alias("employment_type"),
                _whole_number(F.col("j.internal_job_id")).alias("internal_job_id"),
            ),
            _JSON,
        ).alias("raw_data"),
    )


def flatten_workday(
    pages: DataFrame,
    default_location: str | Column = "Vancouver, BC",
    with_primary_location: bool = True,
) -> DataFrame:
    """``data[]`` of Workday pages as raw listing rows; rows without a URL are dropped."""
    fallback = default_location if isinstance(default_location, Column) else F.lit(default_location)
    items = _items(pages, "data", _WORKDAY_ITEM)
    locations = F.coalesce(F.from_json("j.locations", "array<string>"), F.array().cast("array<string>"))
    location = F.coalesce(F.try_element_at(locations, F.lit(1)), fallback)
    url = F.coalesce(F.nullif("j.absoluteUrl", F.lit("")), F.nullif("j.workdayUrl", F.lit("")))
    fields = [
        F.coalesce("j.jobPostingId", F.lit("")).alias("job_posting_id"),
        locations.alias("locations"),
        F.from_json("j.subcategory", "struct<id:string,name:string>").alias("subcategory"),
    ]
    if with_primary_location:
        fields.append(location.alias("primary_location"))
    fields.append(F.col("j.postedOn").alias("posted_on"))
    return items.filter(url.isNotNull()).select(
        "source",
        "page_no",
        "pos",
        F.coalesce("j.jobPostingId", F.lit("")).alias("source_job_id"),
        F.coalesce("j.title", F.lit("")).alias("title"),
        location.alias("location"),
        url.alias("url"),
        F.col("j.postedOn").alias("date_posted"),
        F.to_json(F.struct(*fields), _JSON).alias("raw_data"),
    )


def page_meta(pages: DataFrame, style: str, field: str) -> DataFrame:
    """Paging facts of each page, as the completeness check reads them.

    ``style`` is offset (Workday) or page (Greenhouse); ``field`` names the
    listing array.
    """
    body = F.from_json(
        "body",
        f"{field} array<string>, total bigint, offset bigint, meta struct<total:bigint>",
    )
    parsed = pages.withColumn("_b", body)
    failed = (
        F.coalesce(F.col("status_code") >= 400, F.lit(False))
        | F.col("_b").isNull()
        | F.col(f"_b.{field}").isNull()
    )
    return parsed.select(
        "source",
        F.lit(style).alias("style"),
        "page_no",
        F.coalesce(F.size(f"_b.{field}"), F.lit(0)).cast("bigint").alias("current_count"),
        F.coalesce("_b.total", "_b.meta.total", F.lit(0)).alias("total"),
        F.coalesce("_b.offset", F.lit(0)).alias("page_offset"),
        failed.alias("failed"),
    )
