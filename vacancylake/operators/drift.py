"""Selector drift and health from match-count snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vacancylake.operators.ordered import MAX_GROUP_ROWS, lookback
from vacancylake.operators.spread import attach

_ORDER = ["ts", "id"]


def _since_reset(snapshots: DataFrame, resets: DataFrame | None) -> DataFrame:
    """Drop snapshots taken before a selector's history was reset."""
    if resets is None:
        return snapshots
    table = resets.select("selector", F.col("reset_at").alias("_reset_at"))
    return (
        attach(snapshots, table, ["selector"], "left")
        .filter(F.col("_reset_at").isNull() | (F.col("ts") > F.col("_reset_at")))
        .drop("_reset_at")
    )


def _newest(snapshots: DataFrame, n: int, keys: tuple[str, ...] = ("selector",)) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in _ORDER])
    return snapshots.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n)


def drift_events(
    snapshots: DataFrame,
    history: int = 10,
    min_expected: int = 1,
    drift_threshold: float = 0.5,
    zero_threshold: int = 2,
    latest_only: bool = False,
    resets: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    keys: tuple[str, ...] = ("selector",),
) -> DataFrame:
    """All drift events of snapshots (selector, ts, id, match_count).

    Three independent checks over the last ``history`` snapshots, the current
    one included: ``zero_matches``, ``average`` and ``sudden_drop``. A history is
    that of one value of ``keys``.
    """
    rows = _since_reset(snapshots, resets)
    if latest_only:
        rows = _newest(rows, history, keys)

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-(history - 1), 0)
        return df.withColumn("_h", F.collect_list("match_count").over(frame))

    rows = lookback(rows, list(keys), _ORDER, history - 1, compute, max_group_rows)
    if latest_only:
        rows = rows.filter(F.col("_back") == 1)

    n, latest = F.size("_h"), F.col("match_count")
    older = F.slice("_h", 1, n - 1)
    backwards = F.transform(F.reverse("_h"), lambda x: x != 0)
    first_hit = F.array_position(backwards, True)
    zeros = F.when(first_hit == 0, n.cast("bigint")).otherwise(first_hit - 1)
    rows = (
        rows.filter(n >= 2)
        .withColumn("_zeros", zeros)
        .withColumn(
            "_avg", F.aggregate(older, F.lit(0).cast("bigint"), lambda a, x: a + x) / (n - 1)
        )
        .withColumn("_previous", F.element_at("_h", -2))
        .withColumn("_drift", F.abs(latest - F.col("_avg")) / F.greatest(F.col("_avg"), F.lit(1.0)))
    )
    name = F.concat(F.lit("Selector '"), F.col("selector"), F.lit("' "))
    drop = (F.col("_previous") - latest) / F.greatest(F.col("_previous"), F.lit(1))
    below = latest < min_expected

    def event(kind: str, fired: Column, severity: Column, *message: Column) -> Column:
        return F.when(
            fired,
            F.struct(
                F.lit(kind).alias("kind"), severity.alias("severity"), F.concat(*message).alias("message")
            ),
        )

    zero = event(
        "zero_matches",
        latest == 0,
        F.when(F.col("_zeros") >= zero_threshold, "critical")
        .when(F.col("_zeros") >= 2, "error")
        .otherwise("warning"),
        name, F.lit("returned 0 matches ("), F.col("_zeros").cast("string"),
        F.lit(f" consecutive). Expected at least {min_expected}."),
    )
    average = event(
        "average",
        (F.size("_h") >= 3) & (F.col("_avg") != 0) & (F.col("_drift") >= drift_threshold) & below,
        F.when(F.col("_drift") < 1.0, "warning").otherwise("error"),
        name, F.lit("matched "), latest.cast("string"),
        F.lit(f" elements, expected {min_expected}+ (historical avg: "),
        F.format_string("%.1f", F.col("_avg")), F.lit("). Drift: "),
        F.format_string("%.1f%%", F.col("_drift") * 100), F.lit(" from average."),
    )
    sudden = event(
        "sudden_drop",
        (drop > 0.8) & below & (F.col("_previous") >= min_expected),
        F.lit("error"),
        name, F.lit("dropped from "), F.col("_previous").cast("string"), F.lit(" to "),
        latest.cast("string"), F.lit(f" matches (80%+ drop). Expected at least {min_expected}."),
    )
    keep = [c for c in snapshots.columns if c not in ("selector", "match_count")]
    return (
        rows.withColumn("_event", F.explode(F.array_compact(F.array(zero, average, sudden))))
        .select(
            "selector",
            *keep,
            F.lit(min_expected).alias("expected_min"),
            latest.alias("actual_count"),
            "_event.kind",
            "_event.severity",
            "_event.message",
        )
    )


def drift_zero_matches(snapshots: DataFrame, **options) -> DataFrame:
    return drift_events(snapshots, **options).filter(F.col("kind") == "zero_matches")


def drift_average(snapshots: DataFrame, **options) -> DataFrame:
    return drift_events(snapshots, **options).filter(F.col("kind") == "average")


def drift_sudden_drop(snapshots: DataFrame, **options) -> DataFrame:
    return drift_events(snapshots, **options).filter(F.col("kind") == "sudden_drop")


def selector_health(
    snapshots: DataFrame,
    history: int = 10,
    min_expected: int = 1,
    resets: DataFrame | None = None,
) -> DataFrame:
    """Statistics of each selector's last snapshots and a volatility score."""
    recent = _newest(_since_reset(snapshots, resets), history)
    stats = recent.groupBy("selector").agg(
        F.count("*").alias("total_snapshots"),
        F.avg("match_count").alias("avg_match_count"),
        F.min("match_count").alias("min_match_count"),
        F.max("match_count").alias("max_match_count"),
        F.stddev_pop("match_count").alias("_sd"),
    )
    average = F.col("avg_match_count")
    score = F.least(F.lit(1.0), F.col("_sd") / F.greatest(average, F.lit(1.0)))
    return stats.select(
        "selector",
        "total_snapshots",
        "avg_match_count",
        "min_match_count",
        "max_match_count",
        F.when(average > 0, score).otherwise(F.lit(0.0)).alias("drift_score"),
        (F.col("min_match_count") >= min_expected).alias("is_healthy"),
    )
