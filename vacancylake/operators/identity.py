"""De-duplication on (company_id, canonical_url)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.operators.spread import BROADCAST_LIMIT, SALTS, attach, first_rows
from vacancylake.session import materialize

KEY = ["company_id", "canonical_url"]
#: The key without nulls, and a row's position with its digest, while copies are told apart.
_PLAIN = ["_company", "_no_company", "_url", "_no_url"]
_POSITION = ["_page", "_pos", "_digest", "_digest2"]


def _input_order(records: DataFrame) -> list[Column]:
    """Input position, with the row's own hash to settle equal positions."""
    return [
        F.col("page_no"),
        F.col("pos"),
        F.xxhash64(*[F.col(name) for name in records.columns]),
    ]


def dedupe(records: DataFrame) -> DataFrame:
    """The first record of each key in input order (page_no, pos)."""
    return first_rows(records, KEY, _input_order(records))


def duplicates(records: DataFrame, salts: int = SALTS, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The records :func:`dedupe` drops, with the title that was kept.

    What is grouped is the key, the position, the title and a 128-bit digest of each
    row, combined on the map side, so that the exchange does not grow with the
    payload and a hot key reaches its reducer as its distinct rows. The payload is
    read once more and met with the keys that have copies, :func:`attach` sending
    these around or splitting the hot ones by ``salts``. Exact copies of a kept row
    leave as one row a key, which is then repeated. Null keys are equal to each
    other, as they are to :func:`dedupe`.
    """
    columns = [F.col(name) for name in records.columns]
    second = F.xxhash64(F.lit("second half"), *columns)
    position = dict(zip(_POSITION, [*_input_order(records), second], strict=True))
    plain = dict(zip(_PLAIN, [F.coalesce("company_id", F.lit(0)), F.col("company_id").isNull(),
                              F.coalesce("canonical_url", F.lit("")), F.col("canonical_url").isNull()], strict=True))
    rows = records.withColumns({**plain, **position})
    counted = rows.groupBy(*_PLAIN, *_POSITION, F.col("title").alias("_title")).agg(F.count("*").alias("_same"))
    kept = F.min(F.struct(*_POSITION, "_title", "_same")).alias("_kept")
    first = [F.col(f"_kept.{name}").alias(f"_first{name}") for name in _POSITION]
    copied = materialize(
        counted.groupBy(*_PLAIN)
        .agg(kept, F.sum("_same").alias("_copies"))
        .filter("_copies > 1")
        .select(*_PLAIN, *first, "_kept._title", "_kept._same")
    )
    met = attach(rows, copied, _PLAIN, "inner", limit, salts)
    is_later = F.struct(*_POSITION) > F.struct(*[f"_first{name}" for name in _POSITION])
    reason = F.concat(F.lit("Duplicate of "), F.col("_title")).alias("reason")
    later = met.filter(is_later).select(*columns, reason)
    # of the rows equal to the kept one, all but one are dropped
    row = F.struct(*columns, reason)
    same = met.filter(~is_later & (F.col("_same") > 1)).groupBy(*_PLAIN, "_same").agg(F.first(row).alias("_row"))
    times = F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("_same")))
    return later.unionByName(same.select("_row", times).select("_row.*"))


def seen_urls(records: DataFrame) -> DataFrame:
    return records.select(*KEY).distinct()
