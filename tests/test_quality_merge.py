from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.operators import identity, lookup, merge, quality, reconcile, rollups, spread

def now():
    return F.lit("2026-07-20 00:00:00").cast("timestamp")

RAW = (
    "source string, source_job_id string, title string, location string, url string, "
    "date_posted string, raw_data string, company_id bigint, page_no int, pos int"
)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


FIRST = [
    ("testcorp", "job-1", "Software Engineer", "Remote", "https://testcorp.com/jobs/1", "2026-07-20T10:00:00Z", None, 1, 1, 0),
    ("testcorp", "job-2", "Product Manager", "New York", "https://testcorp.com/jobs/2", "2026-07-21T10:00:00Z", None, 1, 1, 1),
    ("testcorp", "job-3", "Data Scientist", None, "https://testcorp.com/jobs/3", "", None, 1, 1, 2),
]


def empty_jobs(spark):
    return spark.createDataFrame([], schemas.JOBS)


def load(spark, rows):
    good, bad = quality.split_by(quality.to_records(raw(spark, rows)), "reject_reasons")
    return good, bad


def test_validation_keeps_reasons(spark):
    rows = FIRST + [
        ("", "x", " ", None, "nope", None, None, 1, 1, 3),
    ]
    good, bad = quality.split_by(quality.validate_raw(raw(spark, rows)), "skip_reasons")
    assert good.count() == 3
    assert bad.first().skip_reasons == ["missing source", "empty title", "bad url"]


def test_one_bad_row_does_not_lose_the_rest(spark):
    rows = FIRST + [("testcorp", "j", "T", None, "https://testcorp.com/jobs/9", "whenever", None, 1, 1, 3)]
    good, bad = load(spark, rows)
    assert good.count() == 3
    assert bad.first().reject_reasons == ["unparseable date"]
    places = {r.title: r.location for r in good.collect()}
    assert places["Data Scientist"] == "Remote"


def test_duplicate_snapshot(spark):
    rows = [
        FIRST[0],
        ("testcorp", "job-1", "Engineer again", "Remote", "https://testcorp.com/jobs/1?utm_source=linkedin", None, None, 1, 1, 1),
        ("testcorp", "job-2", "Product Manager", "New York", "https://testcorp.com/jobs/2", None, None, 1, 1, 2),
    ]
    good, _ = load(spark, rows)
    assert good.count() == 3
    kept = identity.dedupe(good)
    assert sorted(r.title for r in kept.collect()) == ["Product Manager", "Software Engineer"]
    dropped = identity.duplicates(good).collect()
    assert [r.reason for r in dropped] == ["Duplicate of Software Engineer"]
    merged = merge.upsert_jobs(empty_jobs(spark), kept, now())
    assert merged.filter("op = 'created'").count() == 2


def test_hot_key_with_exact_copies_keeps_every_row(spark):
    """One key owns a third of the rows, most of them exact copies."""
    rows = [(1, "hot", 1, 0, "u", "t") for _ in range(100)]
    rows += [(1, "hot", 2, i % 5, f"u{i}", f"t{i}") for i in range(50)]
    rows += [(i % 7, f"k{i % 90}", 1, i, f"u{i}", f"t{i}") for i in range(300)]
    df = spark.createDataFrame(
        rows, "company_id bigint, canonical_url string, page_no int, pos int, url string, title string"
    )
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[:2]].append(r)
    kept = {(r.company_id, r.canonical_url): (r.page_no, r.pos) for r in identity.dedupe(df).collect()}
    assert kept == {k: min(v, key=lambda r: r[2:4])[2:4] for k, v in by_key.items()}
    dropped = identity.duplicates(df, salts=4).collect()
    got = Counter((r.company_id, r.canonical_url) for r in dropped)
    assert got == Counter({k: len(v) - 1 for k, v in by_key.items() if len(v) > 1})
    union = Counter(tuple(r)[:6] for r in dropped) + Counter(
        tuple(r) for r in identity.dedupe(df).select(*df.columns).collect()
    )
    assert union == Counter(rows)


@pytest.mark.parametrize("limit", [1 << 24, -1])
def test_duplicates_move_no_wide_payload(spark, limit):
    """Null keys are one key; equal positions and exact copies with nested payloads count each."""
    rows = [(None, None, 1, 0, "t", {"a": "x"}, ["p" * 500])] * 3
    rows += [(None, None, 1, i % 2, f"t{i}", {"a": str(i)}, None) for i in range(4)]
    rows += [(1, None, None, None, "n", None, []), (1, "", None, None, "m", None, []), (1, "", 2, 0, None, None, [])]
    rows += [(2, f"u{i}", 1, i, f"t{i}", {"a": None}, ["p" * 500]) for i in range(50)]
    df = spark.createDataFrame(
        rows, "company_id bigint, canonical_url string, page_no int, pos int, title string, tags struct<a:string>, body array<string>"
    ).repartition(5)
    plain = lambda d: d.withColumns({"tags": F.to_json("tags"), "body": F.to_json("body")})
    dropped = identity.duplicates(df, limit=limit)
    assert Counter(r.reason for r in dropped.collect())["Duplicate of m"] == 1
    kept = [tuple(r) for r in plain(identity.dedupe(df).select(*df.columns)).collect()]
    lost = [tuple(r) for r in plain(dropped.drop("reason")).collect()]
    assert Counter(kept + lost) == Counter(tuple(r) for r in plain(df).collect())
    assert len(lost) == 7
    if limit > 0:  # only the kept rows' exact copies are grouped
        plan = dropped._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert identity.duplicates(df.filter("false")).count() == 0


def test_hot_keys_are_found_and_only_they_are_repeated(spark):
    facts = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") + 100).alias("k"),
        F.lit("same").alias("v"),
    ).repartition(6)
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hashes = dict(facts.select(F.xxhash64("k"), "k").distinct().collect())
    assert sorted((hashes[h] for h in spread.hot_keys(facts, ["k"], 8)), key=str) == [7, None]
    got = spread.attach(facts, dim, ["k"], "left", limit=-1, salts=5)
    same = lambda df: sorted(map(str, df.collect()))
    assert same(got) == same(facts.join(F.broadcast(dim), "k", "left"))
    # equal rows of a hot key, null ones too, are divided; a cold key's dimension row appears once
    hot = F.xxhash64("k").isin(spread.hot_keys(facts, ["k"], 8))
    salt = F.pmod(F.xxhash64(spread.row_salt(facts, 1 << 30), F.spark_partition_id()), F.lit(5))
    salts = facts.filter(hot).withColumn("s", salt).groupBy("k").agg(F.count_distinct("s").alias("n")).collect()
    assert len(salts) == 2 and all(r.n > 1 for r in salts)
    assert spread.hot_keys(facts.filter("false"), ["k"]) == []


@pytest.mark.parametrize("limit", [spread.BROADCAST_LIMIT, -1])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach_gives_plain_join_results(spark, how, limit):
    facts = spark.createDataFrame([(0 if i % 3 == 0 else i % 11, i) for i in range(300)], "k int, v int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 11, 2)], "k int, name string")
    got = spread.attach(facts, dim, ["k"], how, limit=limit, salts=5)
    expected = facts.join(dim, ["k"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    if limit < 0:
        assert "Broadcast" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_rerun_changes_nothing(spark):
    good, _ = load(spark, FIRST)
    first = merge.upsert_jobs(empty_jobs(spark), identity.dedupe(good), now())
    second = merge.upsert_jobs(first.drop("op"), identity.dedupe(good), now())
    assert first.filter("op = 'created'").count() == 3
    assert {r.op for r in second.collect()} == {"updated"}
    assert sorted(map(str, second.drop("op").collect())) == sorted(map(str, first.drop("op").collect()))


def test_update_keeps_translation_salary_id_and_creation_time(spark):
    good, _ = load(spark, FIRST)
    stored = merge.upsert_jobs(empty_jobs(spark), good, now()).drop("op")
    stored = stored.withColumn("title_vi", F.lit("vi")).withColumn("salary_raw", F.lit("$1"))
    later = F.lit("2026-08-01 00:00:00").cast("timestamp")
    after = merge.upsert_jobs(stored, good, later).collect()
    before = {r.canonical_url: r for r in stored.collect()}
    for r in after:
        b = before[r.canonical_url]
        assert (r.id, r.created_at, r.title_vi, r.salary_raw) == (b.id, b.created_at, "vi", "$1")
        assert r.updated_at > b.updated_at


def jobs_of(spark, rows):
    base = spark.createDataFrame(
        rows, "id bigint, company_id bigint, canonical_url string, status string, missing_count int"
    )
    return base.select(
        "id", "company_id", F.lit("t").alias("title"), F.lit(None).cast("string").alias("title_vi"),
        F.lit("Remote").alias("location"), F.col("canonical_url").alias("url"), "canonical_url",
        F.lit(None).cast("timestamp").alias("date_posted"), "status",
        *[F.lit(None).cast("string").alias(c) for c in ("source_job_id", "salary_raw", "raw_data")],
        "missing_count",
        *[F.lit("2026-07-01").cast("timestamp").alias(c) for c in ("first_seen_at", "last_seen_at", "created_at", "updated_at")],
    )


def attempts_of(spark, rows):
    df = spark.createDataFrame(
        rows, "company_id bigint, status string, complete boolean, authoritative_snapshot boolean"
    )
    return df.withColumn("started_at", F.lit("2026-07-10").cast("timestamp"))


JOBS = [
    (1, 1, "a", "open", 0), (2, 1, "b", "open", 1), (3, 1, "c", "closed", 2), (4, 1, "d", "open", 1),
    (5, 2, "e", "open", 5), (6, 3, "f", "open", 5), (7, 4, "g", "open", 5), (8, 5, "h", "open", 5),
]
SEEN = [(1, "c"), (1, "d")]
ATTEMPTS = [
    (1, "success", True, True),
    (2, "success", False, True),
    (3, "success", True, False),
    (4, "failed", True, True),
]


def test_reconcile_only_trusts_complete_authoritative_runs(spark):
    seen = spark.createDataFrame(SEEN, "company_id bigint, canonical_url string")
    rows = reconcile.reconcile(jobs_of(spark, JOBS), seen, attempts_of(spark, ATTEMPTS), now())
    got = {r.id: (r.status, r.missing_count, r.change) for r in rows.collect()}
    assert got == {
        1: ("open", 1, "missed"),
        2: ("closed", 2, "closed"),
        3: ("open", 0, "reopened"),
        4: ("open", 0, "reset"),
        5: ("open", 5, None), 6: ("open", 5, None), 7: ("open", 5, None), 8: ("open", 5, None),
    }
    counts = {r.company_id: (r.closed, r.reopened, r.updated) for r in reconcile.reconcile_counts(rows).collect()}
    assert counts[1] == (1, 1, 3)
    assert counts[2] == (0, 0, 0)


def test_reconcile_immediate_spares_failed_and_absent_sources(spark):
    seen = spark.createDataFrame(SEEN, "company_id bigint, canonical_url string")
    rows = reconcile.reconcile(
        jobs_of(spark, JOBS), seen, attempts_of(spark, ATTEMPTS), now(), mode="immediate"
    )
    closed = sorted(r.id for r in rows.filter("status = 'closed'").collect())
    assert closed == [1, 2, 5, 6]


def test_listing_stored_after_run_start_is_not_missed(spark):
    seen = spark.createDataFrame([], "company_id bigint, canonical_url string")
    jobs = jobs_of(spark, JOBS[:2]).withColumn("last_seen_at", F.lit("2026-07-15").cast("timestamp"))
    rows = reconcile.reconcile(jobs, seen, attempts_of(spark, ATTEMPTS), now())
    assert rows.filter("change is not null").count() == 0


def test_close_and_reopen_sets(spark):
    seen = spark.createDataFrame(SEEN, "company_id bigint, canonical_url string")
    jobs = jobs_of(spark, JOBS)
    assert sorted(r.id for r in reconcile.close_missing(jobs, seen).collect()) == [1, 2, 5, 6, 7, 8]
    scraped = spark.createDataFrame([(1,)], "company_id bigint")
    assert sorted(r.id for r in reconcile.close_missing(jobs, seen, scraped).collect()) == [1, 2]
    assert [r.id for r in reconcile.reopen_seen(jobs, seen).collect()] == [3]
    assert reconcile.reopen_seen(jobs, seen.limit(0)).count() == 0


def test_stale_candidates(spark):
    jobs = jobs_of(spark, [(1, 1, "a", "open", 2), (2, 1, "b", "open", 1), (3, 1, "c", "open", 0)])
    assert [r.stale_jobs for r in reconcile.stale_candidates(jobs).collect()] == [1]


@pytest.mark.parametrize(
    "statuses,code,run_status",
    [
        (["failed", "failed"], 2, "failed"),
        (["success", "failed"], 1, "partial"),
        (["success", "partial"], 1, "partial"),
        (["success"], 0, "success"),
        ([], 0, "success"),
    ],
)
def test_exit_codes(spark, statuses, code, run_status):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    row = rollups.overall_status(df).first()
    assert (row.exit_code, row.run_status) == (code, run_status)


def test_filters_reproduce_lenient_lookups(spark):
    jobs = jobs_of(spark, JOBS).withColumn("date_posted", F.expr("timestamp'2026-07-01 00:00:00' + make_dt_interval(id, 12)"))
    companies = spark.createDataFrame([(1, "one"), (2, "two")], "id bigint, slug string")

    def ids(**options):
        return sorted(r.id for r in quality.filter_jobs(jobs, companies, **options).collect())

    assert ids(company="one") == [1, 2, 3, 4]
    assert ids(company="nobody") == [1, 2, 3, 4, 5, 6, 7, 8]
    assert ids(company="nobody", strict=True) == []
    assert ids(status="closed") == [3]
    assert ids(status="banana") == [1, 2, 3, 4, 5, 6, 7, 8]
    # the bound is the start of that day
    assert ids(date_to="2026-07-03") == [1]
    assert ids(date_from="2026-07-08") == [7, 8]


def test_translations(spark):
    jobs = jobs_of(spark, JOBS[:4]).withColumn("title", F.element_at(F.array(*map(F.lit, ["Dev", " dev ", "Ops", " "])), F.col("id").cast("int")))
    cache = spark.createDataFrame([("Dev", "Lập trình")], "title string, translation string").select(
        F.sha2(F.lower("title"), 256).alias("fingerprint"), "translation"
    )
    assert [r.title for r in lookup.pending_translations(jobs, cache).collect()] == ["Ops"]
    done = {r.id: r.title_vi for r in lookup.apply_translations(jobs, cache).collect()}
    assert done == {1: "Lập trình", 2: "Lập trình", 3: None, 4: None}
    row = lookup.translation_counts(jobs, cache).first()
    assert (row.calls, row.hits) == (1, 2)


def test_fallback_only_when_all_failed(spark):
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2,)], "id int")
    failed = spark.createDataFrame([("failed",)], "status string")
    mixed = spark.createDataFrame([("failed",), ("success",)], "status string")
    rows, metrics = lookup.with_fallback(a.limit(0), failed, b, mixed)
    assert [r.id for r in rows.collect()] == [2] and metrics.count() == 3
    rows, metrics = lookup.with_fallback(a, mixed, b, mixed)
    assert [r.id for r in rows.collect()] == [1] and metrics.count() == 2


def test_slug_requests_keep_order_and_report_missing(spark):
    companies = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, slug string")
    found, missing = lookup.companies_by_slugs(companies, ["b", "x", "a"])
    assert [r.slug for r in found.collect()] == ["b", "a"]
    assert [r.slug for r in missing.collect()] == ["x"]


def test_dashboard_on_empty_tables(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in schemas.TABLES.items()}
    row = rollups.dashboard_stats(frames["jobs"], frames["companies"], frames["runs"], frames["attempts"]).first()
    assert (row.total_jobs, row.total_runs, row.last_run_id, row.last_run_jobs_found) == (0, 0, None, None)
    summary = rollups.metrics_summary(
        spark.createDataFrame([], "jobs_found int, duration_ms bigint, succeeded int, total int")
    ).first()
    assert tuple(summary) == (0, 0, 0, 0.0)
