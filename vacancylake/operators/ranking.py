"""Latest-per-key, orderings and pages of results."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows per page of each list.
PAGE_SIZES = {"jobs": 25, "companies": 20, "runs": 20}

#: Rows a top-k may bring to the driver's merge of per-task results.
TOP_K_LIMIT = 100_000

#: Accuracy of the quantile sketch: ranks are off by at most this part of the rows.
SKETCH_ACCURACY = 10_000

#: Bytes of a string that one step of a selection compares. With the three bits of
#: their number they stay below the 53 bits that the sketch, which counts in doubles, keeps.
STEP_BYTES = 6


def latest_run(runs: DataFrame) -> DataFrame:
    best = F.max_by(F.struct(*runs.columns), F.struct("started_at", "id"))
    return runs.agg(best.alias("_run")).filter("_run is not null").select("_run.*")


def last_attempt_per_company(attempts: DataFrame) -> DataFrame:
    best = F.max_by(F.struct(*attempts.columns), F.struct("started_at", "id"))
    return attempts.groupBy("company_id").agg(best.alias("_last")).select("_last.*")


def recent_attempts(attempts: DataFrame, k: int = 10) -> DataFrame:
    """The k newest attempts per company.

    The rank filter reaches below the exchange, so each task forwards at most k
    rows per company.
    """
    newest = Window.partitionBy("company_id").orderBy(F.desc("started_at"), F.desc("id"))
    return (
        attempts.withColumn("recency", F.row_number().over(newest))
        .filter(F.col("recency") <= k)
    )


def sources_to_disable(attempts: DataFrame, n: int = 3) -> DataFrame:
    """Companies whose last n attempts all failed."""
    return (
        recent_attempts(attempts, n)
        .groupBy("company_id")
        .agg(
            F.every(F.col("status") == "failed").alias("_all"),
            F.count("*").alias("failures"),
            F.max("started_at").alias("last_failed_at"),
        )
        .filter(F.col("_all") & (F.col("failures") == n))
        .drop("_all")
    )


def newest_jobs_first(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy(F.desc_nulls_last("date_posted"), "id")


def recent_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(k)


def active_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "running").orderBy(F.desc("started_at"), F.desc("id"))


def jobs_by_company(jobs: DataFrame, company_id: int, status: str | None = None) -> DataFrame:
    rows = jobs.filter(F.col("company_id") == company_id)
    if status is not None:
        rows = rows.filter(F.col("status") == status)
    return rows.orderBy(F.desc("created_at"), F.desc("id"))


def attempts_by_run(attempts: DataFrame, run_id: int) -> DataFrame:
    return attempts.filter(F.col("run_id") == run_id).orderBy("started_at", "id")


def attempts_by_company(attempts: DataFrame, company_id: int) -> DataFrame:
    return attempts.filter(F.col("company_id") == company_id).orderBy(
        F.desc("started_at"), F.desc("id")
    )


def export_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("company_name", "title", "canonical_url")


class By(NamedTuple):
    """One key of an order: a column, its direction and where its nulls stand."""

    name: str
    descending: bool = False
    nulls_last: bool = False

    def column(self) -> Column:
        place = "last" if self.nulls_last else "first"
        return getattr(F, f"{'desc' if self.descending else 'asc'}_nulls_{place}")(self.name)

    def steps(self, kind: T.DataType) -> list[Column] | None:
        """Numbers that rise with the key, the first ones deciding; None if the type has none.

        For strings they are the first of a series without end (:meth:`piece`).
        """
        value = F.col(self.name)
        null = F.isnull(value).cast("bigint")
        if isinstance(kind, T.IntegralType):
            number = value.cast("bigint")
        elif isinstance(kind, T.BooleanType):
            number = value.cast("int").cast("bigint")
        elif isinstance(kind, T.DateType):
            number = F.unix_date(value).cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number = F.unix_micros(value.cast("timestamp"))
        elif kind == T.StringType():
            number = None
        else:
            return None
        halves = [] if number is None else [F.shiftright(number, 32), number.bitwiseAND(0xFFFFFFFF)]
        return [null if self.nulls_last else -null, *map(self._turned, halves)]

    def piece(self, k: int) -> Column:
        """A number for the k-th six bytes of a string, which orders them as the string does."""
        part = F.substring(F.encode(self.name, "utf-8"), STEP_BYTES * k + 1, STEP_BYTES)
        code = F.conv(F.rpad(F.hex(part), 2 * STEP_BYTES, "0"), 16, 10).cast("bigint")
        return self._turned(code * 8 + F.octet_length(part))  # the length tells padding from zero bytes

    def _turned(self, number: Column) -> Column:
        # the complement turns the order round and cannot overflow
        return F.coalesce(F.bitwise_not(number) if self.descending else number, F.lit(0))


class _Piece(NamedTuple):
    """Rows of which a part of the page is taken, by position among them."""

    rows: DataFrame
    count: int
    start: int
    limit: int


def paginate(
    df: DataFrame,
    page: int,
    limit: int,
    order: list[By],
    top_k_limit: int = TOP_K_LIMIT,
) -> DataFrame:
    """One page in a total order, with page, limit, total_count and total_pages.

    ``order`` must end in a unique key. The page is clamped to the last one. Early
    pages are a distributed top-k. For a page deeper than ``top_k_limit`` the rows
    around it are selected first (:func:`select_range`), so that neither the table
    is sorted nor written. Keys are integers, booleans, dates, timestamps or
    strings; a deep page over another type sorts the rows equal in the keys before it.
    """
    total = df.count()
    pages = max(1, -(-total // limit))
    page = min(max(page, 1), pages)
    start = (page - 1) * limit
    pieces = select_range(_Piece(df, total, start, min(limit, total - start)), order, top_k_limit)
    columns = [key.column() for key in order]
    taken = [piece.rows.orderBy(*columns).offset(piece.start).limit(piece.limit) for piece in pieces]
    rows = reduce(DataFrame.union, taken).orderBy(*columns) if len(taken) > 1 else taken[0]
    return rows.select(
        "*",
        F.lit(page).alias("page"),
        F.lit(limit).alias("page_limit"),
        F.lit(total).alias("total_count"),
        F.lit(pages).alias("total_pages"),
    )


def select_range(wanted: _Piece, order: list[By], top_k_limit: int) -> list[_Piece]:
    """Narrow row ranges that together hold the wanted positions, in order.

    A quantile sketch of the deciding number, one pass over its column, tells
    between which values the page lies; a recount makes sure of it, and only rows
    between them go on. Where they cannot be narrowed, the rows split at the page's
    first value into those before, equal and behind, of which the equal ones go on
    to the next number. What remains are ranges whose wanted part is among their
    first ``top_k_limit`` rows, or rows equal in every number.
    """
    kinds = {field.name: field.dataType for field in wanted.rows.schema.fields}
    found: list[_Piece] = []
    # what is still to be narrowed, last first: rows, key, and the number of the step within it
    open_: list[tuple[_Piece, int, int]] = [(wanted, 0, 0)]
    while open_:
        piece, key, step = open_.pop()
        rows, count, start, limit = piece
        if start + limit <= top_k_limit or key == len(order):
            found.append(piece)
            continue
        by = order[key]
        steps = by.steps(kinds[by.name])
        text = kinds[by.name] == T.StringType()
        if steps is None:
            found.append(piece)
            continue
        if step >= len(steps) and not text:
            open_.append((piece, key + 1, 0))
            continue
        number = steps[step] if step < len(steps) else by.piece(step - len(steps))
        length = F.max(F.octet_length(by.name)) if text else F.lit(0)
        margin = 2 / SKETCH_ACCURACY
        ranks = [max(0.0, start / count - margin), start / count, min(1.0, (start + limit) / count + margin)]
        least, most, (low, pivot, high), longest = rows.agg(
            F.min(number), F.max(number), F.percentile_approx(number, ranks, SKETCH_ACCURACY), length
        ).first()
        if least == most:
            ended = text and step >= len(steps) and (longest or 0) <= STEP_BYTES * (step - len(steps) + 1)
            open_.append((piece, key + 1, 0) if ended else (piece, key, step + 1))
            continue
        before, inside, less, equal = rows.agg(
            F.count_if(number < low), F.count_if(number.between(low, high)),
            F.count_if(number < pivot), F.count_if(number == pivot),
        ).first()
        if inside < count and before <= start and start + limit <= before + inside:
            open_.append((_Piece(rows.filter(number.between(low, high)), inside, start - before, limit), key, step))
            continue
        ranges = [(number < pivot, 0, less, step), (number == pivot, less, equal, step + 1), (number > pivot, less + equal, count - less - equal, step)]
        for keep, begin, size, following in reversed(ranges):
            first, last = max(start, begin), min(start + limit, begin + size)
            if first < last:
                open_.append((_Piece(rows.filter(keep), size, first - begin, last - first), key, following))
    return found or [wanted]
