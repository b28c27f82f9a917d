import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vacancylake.operators import alerts, detectors, drift, ordered, pacing, quality, ranking

START = datetime(2026, 7, 1)


def counts_of(spark, **series):
    rows = [
        (s, START + timedelta(hours=i), i, c) for s, values in series.items() for i, c in enumerate(values)
    ]
    return spark.createDataFrame(rows, "source string, ts timestamp, id bigint, job_count bigint")


def test_count_sequences(spark):
    df = counts_of(spark, zero=[10, 10, 0], alone=[0], drop=[100, 50, 25, 5], fine=[10, 12])
    got = {(r.source, r.type, r.severity) for r in detectors.detect_count_anomalies(df).collect()}
    assert got == {("zero", "zero_jobs", "error"), ("drop", "suspicious_count", "warning")}
    row = detectors.detect_zero_jobs(df).first()
    assert row.message == (
        "Source zero returned 0 jobs. Average over last 3 runs: 6.7. "
        "Possible selector drift or anti-bot blocking."
    )
    assert row.history == [10, 10, 0]


def snapshots_of(spark, **series):
    df = counts_of(spark, **series)
    return df.withColumnRenamed("source", "selector").withColumnRenamed("job_count", "match_count")


def kinds(rows):
    return sorted((r.selector, r.kind, r.severity) for r in rows.collect())


def test_selector_sequences(spark):
    options = dict(history=5, latest_only=True)
    df = snapshots_of(spark, a=[5, 5, 0], b=[5, 0, 0], c=[0], d=[5, 6, 5, 4, 5])
    got = kinds(drift.drift_events(df, **options))
    assert got == [
        ("a", "average", "error"), ("a", "sudden_drop", "error"), ("a", "zero_matches", "warning"),
        ("b", "average", "error"), ("b", "zero_matches", "critical"),
    ]
    # with a higher threshold two zeros in a row are an error
    assert ("b", "zero_matches", "error") in kinds(drift.drift_events(df, zero_threshold=3, **options))


def test_selector_health(spark):
    df = snapshots_of(spark, steady=[4] * 10, broken=[4] * 10 + [0], dead=[0, 0])
    got = {r.selector: r for r in drift.selector_health(df).collect()}
    assert (got["steady"].drift_score, got["steady"].is_healthy) == (0.0, True)
    assert got["broken"].drift_score > 0 and got["broken"].total_snapshots == 10
    assert (got["dead"].is_healthy, got["dead"].drift_score) == (False, 0.0)


def test_reset_forgets_older_snapshots(spark):
    df = snapshots_of(spark, a=[5, 5, 0])
    resets = spark.createDataFrame([("a", START + timedelta(hours=1))], "selector string, reset_at timestamp")
    assert drift.drift_events(df, resets=resets).count() == 0


def timeouts_of(spark, rows):
    data = [(s, START + timedelta(seconds=at), i) for i, (s, at) in enumerate(rows)]
    return spark.createDataFrame(data, "source string, ts timestamp, id bigint")


def test_timeout_pattern(spark):
    assert detectors.detect_timeout_pattern(timeouts_of(spark, [("a", 0), ("a", 10)])).count() == 0
    row = detectors.detect_timeout_pattern(timeouts_of(spark, [("a", 0), ("b", 200), ("c", 299)])).first()
    assert (row.source, row.severity, row.timeout_count) == ("a, b, c", "warning", 3)
    # an event exactly one window old has left it
    assert detectors.detect_timeout_pattern(timeouts_of(spark, [("a", 0), ("b", 200), ("c", 300)])).count() == 0


def brute_timeouts(rows, window, limit):
    found = {}
    for i, (_, at) in enumerate(rows):
        inside = [s for s, other in rows if at - window < other <= at]
        if len(inside) >= limit:
            found[i] = (len(inside), ", ".join(sorted(set(inside))))
    return found


@pytest.mark.parametrize("max_group_rows", [ordered.MAX_GROUP_ROWS, 20])
def test_timeout_pattern_against_brute_force(spark, max_group_rows):
    """A third of all timeouts fall into one bucket; ties included."""
    rng = random.Random(3)
    rows = [(f"s{rng.randrange(5)}", rng.randrange(300)) for _ in range(60)]
    rows += [(f"s{rng.randrange(9)}", rng.randrange(20_000)) for _ in range(120)]
    got = {
        r.event_id: (r.timeout_count, r.source)
        for r in detectors.detect_timeout_pattern(
            timeouts_of(spark, rows), max_group_rows=max_group_rows
        ).collect()
    }
    assert got == brute_timeouts(rows, 300, 3)


def brute_stretches(rows, window, limit):
    found = {}
    for at in {at for _, at in rows}:
        inside = [(s, other) for s, other in rows if at - window < other <= at]
        arrivals = sum(other == at for _, other in inside)
        if len(inside) >= limit > len(inside) - arrivals:
            first = min(i for i, (_, other) in enumerate(rows) if other == at)
            found[first] = (len(inside), {s for s, _ in inside if s is not None})
    return found


@pytest.mark.parametrize("max_group_rows", [ordered.MAX_GROUP_ROWS, 20])
@pytest.mark.parametrize("limit", [1, 3, 6])
def test_timeout_stretches_against_brute_force(spark, max_group_rows, limit):
    """A hot bucket, ties, windows over the borders of buckets, null sources and times."""
    rng = random.Random(limit)
    rows = [(f"s{rng.randrange(5)}", rng.randrange(300)) for _ in range(60)]
    rows += [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(60) * 100) for _ in range(60)]
    rows += [(f"s{rng.randrange(9)}", rng.randrange(20_000)) for _ in range(120)]
    events = timeouts_of(spark, rows).union(spark.createDataFrame([("x", None, -1)], "source string, ts timestamp, id bigint"))
    expected = brute_stretches(rows, 300, limit)
    got = detectors.timeout_stretches(events, 300, limit, max_group_rows).collect()
    assert {r.event_id: (r.timeout_count, r.n_sources) for r in got} == {i: (n, len(s)) for i, (n, s) in expected.items()}
    assert len(got) == len(expected) > 0
    named = detectors.stretch_sources(events, 300, limit, max_group_rows).collect()
    assert sorted((r.event_id, r.source) for r in named) == sorted((i, s) for i, (_, names) in expected.items() for s in names)
    assert detectors.stretch_sources(events.limit(0), 300, limit).collect() == []


def test_hundred_thousand_sources_in_one_window(spark):
    """Rows out stay linear in the events, and no list of sources is made."""
    n = 100_000
    events = spark.range(n).select(
        F.concat(F.lit("s"), F.col("id")).alias("source"),
        F.timestamp_micros(F.col("id") * 1000 + 1_700_000_000_000_000).alias("ts"), "id",
    )
    assert [tuple(r)[1:] for r in detectors.timeout_stretches(events).collect()] == [(2, 3, 3)]
    assert {r.source for r in detectors.stretch_sources(events).collect()} == {"s0", "s1", "s2"}
    last = detectors.timeout_sweep(events).orderBy(F.desc("ts")).first()
    assert (last.timeout_count, last.n_sources, last.n_instants) == (n, n, n)


def hot_counts(spark, n=600):
    """One source owns two thirds of the rows."""
    rng = random.Random(5)
    rows = [
        ("hot" if i % 3 else f"s{i % 7}", START + timedelta(minutes=rng.randrange(n)), i, rng.choice([0, 0, 1, 2, 5, 9]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "source string, ts timestamp, id bigint, job_count bigint")


def test_lookback_over_chunks_equals_plain_window(spark):
    df = hot_counts(spark)
    plain = detectors.count_history(df)
    split = detectors.count_history(df, max_group_rows=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_hot_source_is_split_over_chunks(spark):
    chunks = ordered.ordered_chunks(hot_counts(spark), ["source"], ["ts", "id"], 12)
    held = chunks.filter("source = 'hot'").groupBy("_chunk").count().collect()
    assert len(held) > 4 and max(r["count"] for r in held) < 120


def test_drift_over_chunks_equals_plain_window(spark):
    df = hot_counts(spark).withColumnRenamed("source", "selector").withColumnRenamed("job_count", "match_count")
    plain, split = drift.drift_events(df), drift.drift_events(df, max_group_rows=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


@pytest.mark.parametrize("max_group_rows", [ordered.MAX_GROUP_ROWS, 30])
def test_pacing_against_brute_force(spark, max_group_rows):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        origin = "hot" if i % 2 else f"o{i % 5}"
        family = {"hot": "browser", "o0": "api"}.get(origin, "html")
        rows.append((origin, family, START + timedelta(seconds=rng.randrange(100_000)), i))
    df = spark.createDataFrame(rows, "origin string, family string, ts timestamp, id bigint")
    got = {r.id: r for r in pacing.pacing_audit(df, max_group_rows).collect()}
    assert len(got) == 300
    day = timedelta(days=1)
    for origin, family, ts, i in rows:
        same = sorted((t, j) for o, _, t, j in rows if o == origin)
        before = [t for t, j in same if (t, j) < (ts, i)]
        gap = (ts - before[-1]).total_seconds() if before else None
        inside = sum(ts - day < t <= ts for t, _ in same)
        assert got[i].requests_24h == inside
        assert got[i].gap_seconds == gap
        assert got[i].over_quota == (family == "browser" and inside > 100)
        floor = {"api": 0.5, "html": 2.0, "browser": 3.0}[family]
        assert got[i].too_fast == (gap is not None and gap < floor)


@pytest.mark.parametrize("top_k_limit", [ranking.TOP_K_LIMIT, 3])
@pytest.mark.parametrize("page,expected", [(1, 1), (4, 4), (10, 10), (99, 10), (0, 1)])
def test_pages(spark, top_k_limit, page, expected):
    df = spark.createDataFrame([(i, None if i % 9 == 0 else i // 4) for i in range(95)], "id int, rank int")
    order = [ranking.By("rank", descending=True, nulls_last=True), ranking.By("id")]
    whole = [r.id for r in df.orderBy(F.desc_nulls_last("rank"), F.asc("id")).collect()]
    rows = ranking.paginate(df, page, 10, order, top_k_limit).collect()
    assert [r.id for r in rows] == whole[(expected - 1) * 10 : expected * 10]
    assert {(r.page, r.total_count, r.total_pages) for r in rows} == {(expected, 95, 10)}


KEYS = ["", "a", "a\0", "a" * 7, "a" * 8, "a" * 30 + "x", "a" * 30 + "y", "a" * 30, "\u00e9", "\U0001f600", "\uffff", "Z", None]


@pytest.mark.parametrize(
    "key,descending,nulls_last", [("t", False, False), ("t", True, True), ("d", True, False), ("n", True, True), ("b", False, True), ("f", False, False)]
)
def test_deep_pages_over_every_kind_of_key(spark, key, descending, nulls_last):
    """Ties of a third of all rows, pages across borders of nulls and of tied values."""
    rng = random.Random(9)
    rows = [
        (i, "hot" if i % 3 == 0 else rng.choice(KEYS), rng.choice([None, START, START + timedelta(microseconds=1)]),
         rng.choice([None, -(2**63), 2**63 - 1, 0, 0, 5]), rng.choice([True, False, None]), rng.choice([None, 0.5, -1.5, float("nan")]))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "id bigint, t string, d timestamp, n bigint, b boolean, f double").coalesce(1).cache()
    order = [ranking.By(key, descending, nulls_last), ranking.By("id", descending=True)]
    whole = [r.id for r in df.orderBy(*[by.column() for by in order]).collect()]
    for page in (5, 11):
        got = [r.id for r in ranking.paginate(df, page, 10, order, top_k_limit=20).collect()]
        assert got == whole[(page - 1) * 10 : page * 10], page
    df.unpersist()


def test_a_deep_page_sorts_a_narrow_range_only(spark):
    n, limit = 200_000, 20
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"))
    order = [ranking.By("k"), ranking.By("id", descending=True)]
    pieces = ranking.select_range(ranking._Piece(df, n, 150_000, limit), order, 1000)
    assert sum(p.limit for p in pieces) == limit and all(p.rows.count() <= 2000 for p in pieces)
    whole = [tuple(r) for r in df.orderBy("k", F.desc("id")).offset(150_000).limit(limit).collect()]
    assert [tuple(r)[:2] for r in ranking.paginate(df, 7501, limit, order, 1000).collect()] == whole
    assert ranking.paginate(df.limit(0), 3, 10, order, 1).collect() == []


def test_alert_severity_is_ranked_by_order(spark):
    rows = [(s, False, "zero_jobs", "a") for s in quality.SEVERITIES] + [("critical", True, "zero_jobs", "a")]
    df = spark.createDataFrame(rows, "severity string, acknowledged boolean, alert_type string, source string")
    got = sorted(r.severity for r in quality.active_alerts(df, min_severity="error").collect())
    assert got == ["critical", "error"]
    assert quality.clear_acknowledged(df).count() == 4


def test_alert_projection(spark):
    zeros = detectors.detect_zero_jobs(counts_of(spark, a=[10, 10, 0])).withColumnRenamed("detected_at", "ts")
    row = alerts.to_alerts(alerts.zero_job_alerts(zeros)).first()
    assert (row.severity, row.message, row.details) == (
        "critical", "Zero jobs returned from a!", {"job_count": "0"}
    )


def test_disable_after_n_failures(spark):
    rows = [(1, i, "failed") for i in range(3)] + [(2, 0, "success"), (2, 1, "failed"), (2, 2, "failed"), (3, 0, "failed")]
    df = spark.createDataFrame(
        [(c, START + timedelta(hours=i), i, s) for c, i, s in rows],
        "company_id bigint, started_at timestamp, id bigint, status string",
    )
    assert [r.company_id for r in ranking.sources_to_disable(df).collect()] == [1]


def test_orphans(spark):
    rows = [(1, START, "running"), (2, START + timedelta(hours=5), "running"), (3, START, "success")]
    runs = spark.createDataFrame(rows, "id bigint, started_at timestamp, status string").withColumn(
        "finished_at", F.lit(None).cast("timestamp")
    )
    now = F.lit(START + timedelta(hours=5, minutes=30)).cast("timestamp")
    got = {r.id: (r.status, r.finished_at is not None) for r in quality.mark_orphans(runs, now).collect()}
    assert got == {1: ("interrupted", True), 2: ("running", False), 3: ("success", False)}


def test_timeout_without_source_counts_but_names_none(spark):
    rows = [(i, START + timedelta(seconds=10 * i), "a" if i < 3 else None) for i in range(4)]
    events = spark.createDataFrame(rows, "id bigint, ts timestamp, source string")
    got = {r.event_id: r for r in detectors.detect_timeout_pattern(events).collect()}
    assert {i: (r.timeout_count, r.n_sources, r.source) for i, r in got.items()} == {2: (3, 1, "a"), 3: (4, 1, "a")}


@pytest.mark.parametrize("limit", [5_000_000, 2])
def test_running_sum_keeps_null_keys_and_ties(spark, limit):
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 3, 4), (None, 1, 8), (None, None, 16), (None, 2, 32)]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    got = ordered.running_sum(df, ["k"], "at", F.col("v"), "total", limit).collect()
    assert sorted((r.v, r.total) for r in got) == [(1, 3), (2, 3), (4, 7), (8, 24), (16, 16), (32, 56)]
