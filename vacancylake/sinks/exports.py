"""Reproducible CSV exports."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.functions.dates import iso_text
from vacancylake.functions.text import easy_apply, salary_bucket, salary_text
from vacancylake.operators.ranking import export_order
from vacancylake.sinks.tables import replace_folder

# Columns of the listing export, in order, and its short form.
EXPORT_COLUMNS = [
    "company_name",
    "job_title",
    "location",
    "job_url",
    "canonical_url",
    "date_posted",
    "status",
    "first_seen_at",
    "last_seen_at",
]
SHORT_EXPORT_COLUMNS = [
    "company_name",
    "job_title",
    "location",
    "job_url",
    "date_posted",
    "status",
    "canonical_url",
]

# Columns of the application sheet, in order, and its first state.
SHEET_COLUMNS = [
    "Company name",
    "Title job",
    "Link job",
    "Salary",
    "Location",
    "Loại job",
    "Status",
    "Date",
    "Người Apply",
    "Kiểm tra",
    "Ghi chú",
    "Title job vietsub",
    "TN-visa",
    "Job Refer",
    "Foundation",
    "Easy Apply",
    "Salary bucket",
]
SHEET_STATUS = "Chưa apply"


def export_rows(jobs: DataFrame, short: bool = False) -> DataFrame:
    """Listings with company names as export text, in export order."""

    def shown(name: str) -> Column:
        if dict(jobs.dtypes)[name].startswith("timestamp"):
            return F.coalesce(iso_text(F.col(name)), F.lit(""))
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    named = {"job_title": "title", "job_url": "url"}
    columns = SHORT_EXPORT_COLUMNS if short else EXPORT_COLUMNS
    return export_order(jobs).select(*[shown(named.get(c, c)).alias(c) for c in columns])


def application_sheet(jobs: DataFrame, today: date | str, default_status: str = SHEET_STATUS) -> DataFrame:
    """The application-tracking projection of listings with company names."""
    blank = F.lit("")

    def first(*names: str) -> Column:
        present = [F.nullif(F.col(n), blank) for n in names if n in jobs.columns]
        return F.coalesce(*present, blank)

    salary = F.col("_salary")
    values = [
        first("company_name", "company_slug"),
        first("title"),
        first("url"),
        salary,
        F.coalesce(F.nullif("location", blank), F.lit("Remote")),
        blank,
        F.lit(default_status),
        F.lit(str(today)).cast("date"),
        blank,
        blank,
        blank,
        first("title_vi"),
        blank,
        blank,
        blank,
        easy_apply(F.col("raw_data")),
        salary_bucket(salary),
    ]
    priced = jobs.withColumn("_salary", salary_text(F.col("salary_raw"), F.col("raw_data")))
    return priced.select(*[v.alias(n) for n, v in zip(SHEET_COLUMNS, values)])


def export_csv(rows: DataFrame, path: str, single_file: bool = False, bom: bool = False) -> None:
    """Write ordered rows as RFC 4180 CSV: a part with the header, then parts without.

    ``rows`` must already be in a total order; the parts, put together by name, are
    the ordered export, whatever its size, and no task sees it all. With
    ``single_file`` one task writes one file of the same bytes. The files are
    written aside and then take the old export's place.
    """
    names = rows.columns
    shown = ["\ufeff" + names[0] if bom else names[0], *names[1:]]
    header = rows.sparkSession.createDataFrame([tuple(shown)], ", ".join(f"`{n}` string" for n in names))
    texts = rows.select(*[F.col(f"`{n}`").cast("string") for n in names])
    if single_file:  # merging partitions may take them in any order, so their rows are numbered
        numbered = texts.withColumn("_at", F.monotonically_increasing_id())
        numbered = header.withColumn("_at", F.lit(-1).cast("bigint")).union(numbered)
        out = numbered.repartition(1).sortWithinPartitions("_at").drop("_at")
    else:
        out = header.coalesce(1).union(texts)
    aside = f"{path}.{uuid.uuid4().hex}"
    (
        out.write.option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(aside)
    )
    replace_folder(rows.sparkSession, aside, path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An export of several parts as text columns, without its header."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    parts = spark.read.schema(schema).option("escape", '"').option("multiLine", True).csv(path)
    return parts.filter(~F.col("_metadata.file_name").startswith("part-00000-")).fillna("")
