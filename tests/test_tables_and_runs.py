import json
import re

import pytest
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.operators import lookup, quality, rollups
from vacancylake.plans.monitoring import monitor
from vacancylake.plans.snapshot import run_snapshot, store_run
from vacancylake.sinks import exports, listings, tables as sinks
from vacancylake.sources import specs, tables

JOB_FIELDS = [f.name for f in schemas.JOBS]


def ts(text):
    return F.lit(text).cast("timestamp")


def listing_page(*ids):
    cards = "".join(
        f'<div class="job-card"><h3 class="job-title">Role {i}</h3><a class="job-link" href="/careers/{i}">x</a></div>'
        for i in ids
    )
    return f"<html><body>{cards}</body></html>"


def workday(*ids):
    rows = [{"jobPostingId": str(i), "title": f"W {i}", "locations": ["X"], "absoluteUrl": f"https://w.example/{i}"} for i in ids]
    return json.dumps({"data": rows, "total": len(rows), "offset": 0, "limit": 100})


COMPANIES = [(1, "TechCorp", "techcorp"), (2, "Vancity", "vancity"), (3, "Nobody", "nobody")]


def company_frame(spark):
    base = spark.createDataFrame(COMPANIES, "id bigint, name string, slug string")
    return base.select(
        "id", "name", "slug", F.lit("html").alias("adapter_type"), F.lit("u").alias("base_url"),
        F.lit(None).cast("string").alias("config"), F.lit(True).alias("is_active"),
        F.lit(True).alias("authoritative"), ts("2026-01-01").alias("created_at"),
        ts("2026-01-01").alias("updated_at"),
    )


def snapshot(spark, jobs, run_id, day, html_ids, api_ids, html_status=200, **options):
    pages = spark.createDataFrame(
        [
            ("techcorp", 1, "u", html_status, "text/html", listing_page(*html_ids), None),
            ("vancity", 1, "u", 200, "application/json", workday(*api_ids), None),
        ],
        schemas.PAGES,
    )
    log = spark.createDataFrame(
        [
            ("techcorp", "html", 1, 1, html_status, "text/html", None, len(html_ids)),
            ("vancity", "api", 1, 1, 200, "application/json", None, len(api_ids)),
        ],
        "source string, family string, page_no int, attempt int, status_code int, content_type string, error_type string, n_jobs int",
    )
    return run_snapshot(
        pages, log, jobs, company_frame(spark), specs.default_catalog(), run_id,
        ts(f"2026-07-{day:02d} 10:00:00"), ts(f"2026-07-{day:02d} 11:00:00"), **options,
    )


def statuses(jobs):
    return {r.canonical_url.rsplit("/", 1)[1]: r.status for r in jobs.collect()}


def test_runs_merge_close_and_reopen(spark, tmp_path):
    path = str(tmp_path / "jobs")
    jobs = spark.createDataFrame([], schemas.JOBS)

    first = snapshot(spark, jobs, 1, 1, [1, 2, 2, 3], [10, 11])
    assert {r.op for r in first.jobs.collect()} == {"created"} and first.jobs.count() == 5
    attempts = {r.company_id: r for r in first.attempts.collect()}
    assert (attempts[1].jobs_found, attempts[1].new_jobs, attempts[1].warnings) == (4, 3, "1 duplicates removed")
    assert (attempts[3].status, attempts[3].error_type) == ("failed", "NoAdapter")
    assert first.run_status.first().run_status == "partial"
    assert first.dropped.count() == 1
    sinks.write_snapshot(first.jobs.drop("op"), path)

    def stored():
        return tables.read_table(spark, str(tmp_path), "jobs")

    # the same snapshot again: nothing new
    again = snapshot(spark, stored(), 2, 2, [1, 2, 3], [10, 11])
    assert again.jobs.filter("op = 'created'").count() == 0 and again.jobs.count() == 5
    sinks.write_snapshot(again.jobs.drop("op"), path)

    # one listing missing twice closes; a failed source in between counts for nothing
    for run, day, status in ((3, 3, 200), (4, 4, 500), (5, 5, 200)):
        result = snapshot(spark, stored(), run, day, [1, 2], [10, 11], status)
        sinks.write_snapshot(result.jobs.drop("op"), path)
        expected = "closed" if run == 5 else "open"
        assert statuses(stored())["3"] == expected
    assert {r.company_id: r.closed_jobs for r in result.attempts.collect()}[1] == 1

    back = snapshot(spark, stored(), 6, 6, [1, 2, 3], [10, 11])
    assert {r.company_id: r.reopened_jobs for r in back.attempts.collect()}[1] == 1
    assert statuses(back.jobs)["3"] == "open"


def test_snapshot_replaces_whole_table_and_keeps_the_old_one_readable(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert sinks.current_snapshot(spark, path) is None
    old = sinks.write_snapshot(spark.range(3), path, tag="7")
    assert sinks.current_tag(spark, path) == "7"
    new = sinks.write_snapshot(spark.read.parquet(old).filter("id > 0"), path)
    assert sinks.current_snapshot(spark, path).endswith(new.rsplit("/", 1)[1])
    assert spark.read.parquet(new).count() == 2 and spark.read.parquet(old).count() == 3


def test_writers_notice_each_other_and_old_snapshots_go(spark, tmp_path):
    path = str(tmp_path / "t")
    first = sinks.write_snapshot(spark.range(1), path)
    second = sinks.write_snapshot(spark.range(2), path, base=first)
    with pytest.raises(sinks.TableChanged):
        sinks.write_snapshot(spark.range(3), path, base=first)
    assert sinks.current_snapshot(spark, path) == second
    last = sinks.write_snapshot(spark.range(4), path, base=second)
    sinks.remove_old_snapshots(spark, path, 1)
    assert [p.name for p in tmp_path.glob("t/snapshot-*")] == [last.rsplit("/", 1)[1]]
    assert spark.read.parquet(last).count() == 4


def test_of_several_first_publishers_one_succeeds(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(1), path, base="")
    with pytest.raises(sinks.TableChanged):
        sinks.write_snapshot(spark.range(2), path, base="")
    version = sinks.current_version(spark, path)
    for writer in (1, 2):  # both start from the same version, at the same time
        if writer == 1:
            sinks.publish(spark, path, version, "snapshot-a", "a")
        else:
            with pytest.raises(sinks.TableChanged):
                sinks.publish(spark, path, version, "snapshot-b", "b")
    assert [(v.number, v.tag) for v in sinks.versions(spark, path)] == [(1, ""), (2, "a")]


def test_a_stored_run_is_not_stored_over_a_newer_one(spark, tmp_path):
    root, day = str(tmp_path), ts("2026-07-01 10:00:00")
    none, base = spark.createDataFrame([], schemas.JOBS), ""
    runs = {}
    for run, numbers in ((7, [1, 2]), (8, [1, 2, 3])):
        jobs = tables.read_table(spark, root, "jobs") if run == 8 else none
        runs[run] = snapshot(spark, jobs, run, run, numbers, [10], base=base)
        store_run(runs[run], root, run, day, day)
        base = sinks.current_snapshot(spark, f"{root}/jobs")
    before = sorted(map(str, tables.read_table(spark, root, "jobs").collect()))
    store_run(runs[7], root, 7, day, day)
    assert sorted(map(str, tables.read_table(spark, root, "jobs").collect())) == before
    assert [v.tag for v in sinks.versions(spark, f"{root}/jobs")] == ["7", "8"]
    late = snapshot(spark, none, 9, 9, [1], [10], base="")  # made from the table as it was at first
    with pytest.raises(sinks.TableChanged):
        store_run(late, root, 9, day, day)
    assert not (tmp_path / "attempts" / "run_id=9").exists()
    assert sorted(map(str, tables.read_table(spark, root, "jobs").collect())) == before


def records(spark, rows):
    """(company_id, canonical_url, title) as clean records."""
    full = [(c, u, t, None, "Remote", u, None, "open", "1", None, None, 1, k) for k, (c, u, t) in enumerate(rows)]
    return spark.createDataFrame(full, (
        "company_id bigint, canonical_url string, title string, title_vi string, location string, url string, date_posted timestamp, "
        "status string, source_job_id string, salary_raw string, raw_data string, page_no bigint, pos bigint"))


def files_of(path):
    return {p.relative_to(path): (p.stat().st_mtime_ns, p.stat().st_size) for p in path.glob("rows/bucket=*/*.parquet")}


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path, day = str(tmp_path / "jobs"), ts("2026-07-01 10:00:00")
    first = records(spark, [(1, f"https://x/{k}", "a") for k in range(60)] + [(1, "https://x/3", "a copy")])
    assert listings.merge_listings(first, path, day, "w", 0, buckets=8) == list(range(8))
    before = files_of(tmp_path / "jobs")
    touched = listings.merge_listings(records(spark, [(1, "https://x/3", "b")]), path, ts("2026-07-02 10:00:00"), "w", 1)
    after = files_of(tmp_path / "jobs")
    changed = {p.parts[1] for p in before.keys() ^ after.keys() | {p for p in before if p in after and before[p] != after[p]}}
    assert len(touched) == 1 and changed == {f"bucket={touched[0]}"}
    rows = tables.read_table(spark, str(tmp_path), "jobs")
    assert rows.columns == schemas.JOBS.names
    got = {r.canonical_url: r for r in rows.collect()}
    assert len(got) == rows.count() == 60 and {u for u, r in got.items() if r.title == "b"} == {"https://x/3"}
    assert got["https://x/3"].first_seen_at.day == 1 and got["https://x/3"].last_seen_at.day == 2
    # whole plan: only the touched bucket's folder is scanned
    plan = listings.read_buckets(spark, path, touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan)
    # delivered again, and nothing at all
    assert listings.merge_listings(records(spark, [(1, "https://x/3", "c")]), path, day, "w", 1) == []
    assert listings.merge_listings(records(spark, []), path, day, "w", 2) == []
    assert files_of(tmp_path / "jobs") == after and listings.read_buckets(spark, path, []).count() == 0


def test_counts_follow_the_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listings, "FOLDED", 3)
    path, day = str(tmp_path / "jobs"), ts("2026-07-01 10:00:00")
    assert listings.stored_counts(spark, path).collect() == []
    for number in range(5):
        batch = records(spark, [(k % 3, f"https://x/{k}", "t") for k in range(number, 4 * number + 2)] + [(None, f"n{number}", "t")])
        status = F.when(F.col("pos") % (number + 2) == 0, "closed").otherwise("open")
        listings.merge_listings(batch.withColumn("status", status), path, day, "w", number, buckets=4)
        recount = rollups.status_counts(tables.read_table(spark, str(tmp_path), "jobs"))
        assert sorted(map(str, listings.stored_counts(spark, path).collect())) == sorted(map(str, recount.collect()))
    assert [json.loads(v.tag)["folded"] for v in sinks.versions(spark, path)] == [True, False, True, False, False]


def test_a_bucket_is_put_in_place_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listings, "TASK_BYTES", 500)
    path, day = str(tmp_path / "jobs"), ts("2026-07-01 10:00:00")
    keys = [(k % 3, f"https://x/{k}", "t") for k in range(400)] + [(None, "n", "t")]
    listings.merge_listings(records(spark, keys), path, day, "w", 0, buckets=2)
    assert all(len(list(folder.glob("*.parquet"))) > 1 for folder in tmp_path.glob("jobs/rows/bucket=*"))
    found = tables.read_table(spark, str(tmp_path), "jobs").select("company_id", "canonical_url", "title").collect()
    assert sorted(map(str, found)) == sorted(str(r) for r in records(spark, keys).select("company_id", "canonical_url", "title").collect())


def test_pages_are_parsed_once_a_run(spark):
    result = snapshot(spark, spark.createDataFrame([], schemas.JOBS), 1, 1, [1, 2], [10])
    for rows in (result.skipped, result.rejected, result.dropped):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "MapInArrow" not in plan


def test_outcomes_are_drawn_from_the_pages_once_a_run(spark):
    """What several results and every storing read must not look into the pages' texts again."""
    result = snapshot(spark, spark.createDataFrame([], schemas.JOBS), 1, 1, [1, 2], [10])
    for rows in (result.attempts, result.run_status):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "get_json_object" not in plan and "LocalRelation [source" not in plan and "LogicalRDD [source" not in plan
    assert {(r.company_id, r.jobs_found, r.complete) for r in result.attempts.collect()} == {(1, 2, True), (2, 1, True), (3, 0, False)}


def test_fetched_pages_are_made_once_for_runs_in_turn(spark, tmp_path, monkeypatch):
    """Two runs over the same pages: the second reads them and their log where the first did."""
    from vacancylake.plans import driver_tables, queries

    made = []
    pages = driver_tables.Tables.ats_pages
    monkeypatch.setattr(driver_tables.Tables, "ats_pages", lambda t, style: made.append(style) or pages(t, style))
    orders = spark.range(230).selectExpr(
        "id AS o_orderkey", "id % 9 AS o_custkey", "substring('OFP', cast(id % 3 + 1 AS int), 1) AS o_orderstatus",
        "1.0D AS o_totalprice", "timestamp'2024-01-05 00:00:00' AS o_orderdate", "'5-LOW' AS o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(3).selectExpr("id AS s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    rows = queries.stored_runs_in_turn(driver_tables.Tables(spark, str(tmp_path))).collect()
    assert made == ["greenhouse"]
    expected = {(f"https://jobs.example.com/{i}", "open", 0) for i in range(230)}
    expected |= {(f"https://jobs.example.com/old-{i}", "closed", max(i % 3 + 1, 2)) for i in range(1, 230, 2)}
    assert {tuple(row) for row in rows} == expected and len(rows) == len(expected)


def test_a_merge_cut_off_is_finished_by_its_writer(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "jobs"), ts("2026-07-01 10:00:00")
    listings.merge_listings(records(spark, [(1, "a", "old"), (None, "n", "old")]), path, day, "w", 0, buckets=4)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(listings, "finish_merge", fail)
        with pytest.raises(OSError):
            listings.merge_listings(records(spark, [(1, "a", "new"), (1, "b", "new")]), path, day, "w", 1)
    with pytest.raises(sinks.TableChanged):
        listings.merge_listings(records(spark, [(1, "c", "x")]), path, day, "other", 0)
    # the same batch again: its staged rows are put in place, not merged a second time
    assert listings.merge_listings(records(spark, [(1, "a", "twice")]), path, day, "w", 1) == []
    titles = {r.canonical_url: r.title for r in tables.read_table(spark, str(tmp_path), "jobs").collect()}
    assert titles == {"a": "new", "b": "new", "n": "old"}
    listings.merge_listings(records(spark, [(1, "c", "x")]), path, day, "other", 0)
    assert listings.unfinished(spark, path) is None and not list(tmp_path.glob("jobs/_staged/*"))


def test_of_two_merges_from_one_version_one_is_refused(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "jobs"), ts("2026-07-01 10:00:00")
    listings.merge_listings(records(spark, [(1, "a", "old")]), path, day, "w", 0, buckets=4)
    upsert = listings.upsert_jobs

    def meanwhile(*args):  # another writer merges while this one works its rows out
        monkeypatch.setattr(listings, "upsert_jobs", upsert)
        listings.merge_listings(records(spark, [(1, "a", "theirs")]), path, day, "other", 0)
        return upsert(*args)

    monkeypatch.setattr(listings, "upsert_jobs", meanwhile)
    with pytest.raises(sinks.TableChanged):
        listings.merge_listings(records(spark, [(1, "a", "ours")]), path, day, "w", 1)
    assert tables.read_table(spark, str(tmp_path), "jobs").first().title == "theirs"
    listings.merge_listings(records(spark, [(1, "a", "ours")]), path, day, "w", 1)
    assert tables.read_table(spark, str(tmp_path), "jobs").first().title == "ours"


def test_failed_write_leaves_the_current_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(3), path)
    before = sinks.current_snapshot(spark, path)
    with pytest.raises(Exception):
        sinks.write_snapshot(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), path)
    assert sinks.current_snapshot(spark, path) == before


def test_append_and_rejects(spark, tmp_path):
    for day in (1, 2):
        sinks.append_rows(spark.range(2).withColumn("day", F.lit(day)), str(tmp_path / "a"), ["day"])
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    rejects = spark.createDataFrame([("t", ["bad url"])], "title string, reasons array<string>")
    for run in (7, 8, 8):
        sinks.write_rejects(rejects, str(tmp_path / "r"), "validate", run)
    kept = spark.read.parquet(str(tmp_path / "r")).collect()
    assert sorted((r.run_id, r.stage, r.title) for r in kept) == [(7, "validate", "t"), (8, "validate", "t")]


def export_jobs(spark):
    rows = [
        ("B Co", 'Dev, "senior"', "b1", "open"), ("A Co", "Ops\nlead", "a2", "open"),
        ("A Co", "Ops\nlead", "a1", "unknown"), ("C Co", "Old", "c1", "closed"),
    ]
    df = spark.createDataFrame(rows, "company_name string, title string, canonical_url string, status string")
    return df.select(
        "*", F.col("canonical_url").alias("url"), F.lit("Remote").alias("location"),
        F.when(F.col("company_name") == "A Co", ts("2026-07-15 10:30:00")).alias("date_posted"),
        ts("2026-07-01").alias("first_seen_at"), ts("2026-07-02").alias("last_seen_at"),
        F.lit("$180K/yr - $240K/yr").alias("salary_raw"), F.lit('{"easy_apply": "yes"}').alias("raw_data"),
        F.lit(None).cast("string").alias("title_vi"),
    )


def csv_bytes(folder):
    return b"".join(p.read_bytes() for p in sorted(folder.glob("part-*.csv")))


def test_csv_is_ordered_quoted_and_reproducible(spark, tmp_path):
    import csv
    import io

    rows = exports.export_rows(quality.export_filter(export_jobs(spark)))
    for name in ("x", "y"):
        exports.export_csv(rows, str(tmp_path / name))
    first = csv_bytes(tmp_path / "x")
    assert first == csv_bytes(tmp_path / "y")
    table = list(csv.reader(io.StringIO(first.decode())))
    assert table[0] == exports.EXPORT_COLUMNS
    assert [(r[0], r[1], r[4]) for r in table[1:]] == [
        ("A Co", "Ops\nlead", "a1"), ("A Co", "Ops\nlead", "a2"), ("B Co", 'Dev, "senior"', "b1"),
    ]
    assert table[1][5] == "2026-07-15T10:30:00+00:00" and table[3][5] == ""
    for single in (False, True):  # the second replaces the first
        exports.export_csv(rows.repartitionByRange(3, "canonical_url"), str(tmp_path / "z"), single_file=single, bom=True)
        assert csv_bytes(tmp_path / "z").startswith(b"\xef\xbb\xbf") and csv_bytes(tmp_path / "z").count(b"\xef\xbb\xbf") == 1
        assert csv_bytes(tmp_path / "z").count(b"company_name") == 1
        assert len(list((tmp_path / "z").glob("part-*.csv"))) == (1 if single else 4)
    assert not list(tmp_path.glob("z.*"))
    back = exports.read_csv(spark, str(tmp_path / "x"), exports.EXPORT_COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert exports.export_rows(export_jobs(spark), short=True).columns == exports.SHORT_EXPORT_COLUMNS


def test_export_filters(spark):
    jobs = export_jobs(spark)

    def urls(**options):
        return sorted(r.canonical_url for r in quality.export_filter(jobs, **options).collect())

    assert urls() == ["a1", "a2", "b1"]
    assert urls(include_closed=True) == ["a1", "a2", "b1", "c1"]
    assert urls(company_names=["A Co"]) == ["a1", "a2"]
    # undated listings pass every date bound
    assert urls(date_from=ts("2026-08-01")) == ["b1"]
    assert urls(date_to=ts("2026-08-01")) == ["a1", "a2", "b1"]


def test_application_sheet(spark):
    row = exports.application_sheet(export_jobs(spark), "2026-07-20").first()
    assert list(row.asDict()) == exports.SHEET_COLUMNS and len(exports.SHEET_COLUMNS) == 17
    assert (row["Status"], row["Salary bucket"], row["Easy Apply"], str(row["Date"])) == (
        "Chưa apply", "150+", "Yes", "2026-07-20"
    )


def test_unknown_company_in_outer_join(spark):
    jobs = spark.createDataFrame([(1, 9)], "id bigint, company_id bigint")
    row = lookup.jobs_with_company(jobs, company_frame(spark), outer=True).first()
    assert (row.company_name, row.company_slug) == ("Unknown", "")
    assert lookup.jobs_with_company(jobs, company_frame(spark)).count() == 0


def test_point_lookup(spark):
    assert tables.find_by(company_frame(spark), slug="vancity").first().id == 2
    assert tables.find_by(company_frame(spark), id=99).count() == 0
    with pytest.raises(KeyError):
        tables.read_table(spark, "/nowhere", "no_such_table")


def test_truncated_and_failed_crawls_close_nothing(spark):
    """A crawl short of the stated total is incomplete; pages from the first failure on are not read."""
    stored = snapshot(spark, spark.createDataFrame([], schemas.JOBS), 1, 1, [1, 2], [10, 11, 12]).jobs.drop("op")
    short = json.dumps({"data": json.loads(workday(10))["data"], "total": 3, "offset": 0, "limit": 1})
    pages = [
        ("vancity", 1, "u", 200, "application/json", short, None),
        ("techcorp", 1, "u", 200, "text/html", listing_page(1), None),
        ("techcorp", 2, "u", 429, "text/html", "", None),
        ("techcorp", 3, "u", 200, "text/html", listing_page(9), None),
    ]
    log = [
        (s, "api" if s == "vancity" else "html", n, 1, code, kind, None, 1)
        for s, n, _, code, kind, _, _ in pages
    ]
    schema = "source string, family string, page_no int, attempt int, status_code int, content_type string, error_type string, n_jobs int"
    result = run_snapshot(
        spark.createDataFrame(pages, schemas.PAGES), spark.createDataFrame(log, schema), stored, company_frame(spark),
        specs.default_catalog(), 2, ts("2026-07-02 10:00:00"), ts("2026-07-02 11:00:00"), threshold=1,
    )
    assert statuses(result.jobs) == {k: "open" for k in ("1", "2", "10", "11", "12")}
    attempts = {r.company_id: r for r in result.attempts.collect()}
    assert not attempts[1].complete and not attempts[2].complete and attempts[2].closed_jobs == 0


def test_a_stored_run_is_stored_once(spark, tmp_path):
    root = str(tmp_path)
    empty = spark.createDataFrame([], schemas.JOBS)
    for run, ids in ((1, [1, 2, 2]), (2, [2, 3]), (2, [2, 3])):
        known = empty if run == 1 else tables.read_table(spark, root, "jobs")
        result = snapshot(spark, known, run, run, ids, [10])
        store_run(result, root, run, ts("2026-07-01 10:00:00"), ts("2026-07-01 11:00:00"))
    jobs = {r.canonical_url.rsplit("/", 1)[1]: r.missing_count for r in tables.read_table(spark, root, "jobs").collect()}
    assert jobs == {"1": 1, "2": 0, "3": 0, "10": 0}
    attempts = tables.read_table(spark, root, "attempts").groupBy("run_id").count().collect()
    assert {(r.run_id, r["count"]) for r in attempts} == {(1, 3), (2, 3)}
    assert {(r.id, r.status) for r in tables.read_table(spark, root, "runs").collect()} == {(1, "partial"), (2, "partial")}
    kept = spark.read.option("mergeSchema", True).parquet(f"{root}/rejects")
    assert {(r.run_id, r.stage, r.reasons[0]) for r in kept.collect()} == {(1, "dedupe", "duplicate")}


def test_rows_of_unknown_sources_are_kept_as_skipped(spark):
    pages = spark.createDataFrame(
        [("vancity", 1, "u", 200, "application/json", workday(1), None)], schemas.PAGES
    )
    log = spark.createDataFrame(
        [("vancity", "api", 1, 1, 200, "application/json", None, 1)],
        "source string, family string, page_no int, attempt int, status_code int, content_type string, error_type string, n_jobs int",
    )
    others = company_frame(spark).filter("slug <> 'vancity'")
    now = ts("2026-07-02 10:00:00")
    result = run_snapshot(pages, log, spark.createDataFrame([], schemas.JOBS), others, specs.default_catalog(), 1, now, now)
    assert [r.skip_reasons for r in result.skipped.collect()] == [["source is no active company"]]
    assert result.jobs.count() == 0


def test_monitoring(spark):
    rows = [(i, 1, 1, i, "success", n, None) for i, n in enumerate((9, 9, 9, 0))]
    rows += [(10 + i, 1, 2, i, "failed", 0, "timeout") for i in range(3)] + [(20, 1, None, 0, "partial", None, None)]
    attempts = spark.createDataFrame(
        rows, "id bigint, run_id bigint, company_id bigint, m int, status string, jobs_found bigint, error_type string"
    ).withColumns({"started_at": F.timestamp_seconds(F.col("m") * 60), "error_message": F.lit(None).cast("string")})
    runs = spark.createDataFrame([(1, 0, 10)], "id bigint, a int, b int").select(
        "id", F.timestamp_seconds("a").alias("started_at"), F.timestamp_seconds("b").alias("finished_at")
    )
    seen = monitor(attempts, runs, 3, max_failed_share=0.3)
    assert sorted((r.type, r.source) for r in seen.anomalies.collect()) == [("timeout_pattern", "2"), ("zero_jobs", "1")]
    told = {(r.alert_type, r.source, r.severity, r.disable) for r in seen.alerts.collect()}
    assert told == {
        ("zero_jobs", "1", "critical", False), ("scrape_failure", "2", "error", True),
        ("scrape_failure", None, "warning", False),
    }
    assert [r.company_id for r in seen.to_disable.collect()] == [2]
    assert [r.rule for r in seen.run_rules.collect()] == ["high_error_rate"]
