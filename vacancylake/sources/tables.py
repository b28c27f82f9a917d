"""Table scans and point lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.sinks.tables import current_snapshot


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan jobs, companies, runs or attempts under ``root``.

    Published tables are read at their current snapshot; plain Parquet folders
    are read as they are. Filters and column choices reach the scan.
    """
    return read_based(spark, root, name)[0]


def read_based(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, str]:
    """The table, and the snapshot it was read at: empty if none was published."""
    if name not in schemas.TABLES:
        raise KeyError(f"unknown table: {name}")
    path = f"{root.rstrip('/')}/{name}"
    base = current_snapshot(spark, path) or ""
    schema = schemas.TABLES[name]
    return spark.read.schema(schema).parquet(base or path).select(*schema.names), base


def find_by(df: DataFrame, **values: object) -> DataFrame:
    """Rows equal on every given column; an unknown value gives an empty frame."""
    condition: Column = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.filter(condition)
