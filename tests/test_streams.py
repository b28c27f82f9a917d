"""Streams over several micro-batches give what the batch operators give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vacancylake.operators import detectors, drift, identity
from vacancylake.plans import queries
from vacancylake.session import ensure_checkpoint_dir
from vacancylake.sources import tables
from vacancylake.streaming import jobs as streams

START = datetime(2026, 7, 1)


@pytest.fixture
def feed(spark, tmp_path):
    """Rows written as three files in time order, and a stream reading one per batch."""

    def make(rows, schema):
        for part in range(3):
            third = rows[part * len(rows) // 3 : (part + 1) * len(rows) // 3]
            spark.createDataFrame(third, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        batch = spark.read.schema(schema).parquet(str(tmp_path / "in"))
        stream = (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        )
        return batch, stream

    return make


@pytest.fixture
def drain(spark, tmp_path):
    def run(stream):
        query = (
            stream.writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))

    return run


@pytest.fixture
def detected(spark, tmp_path):
    def run(start, stream, **options):
        start(stream, str(tmp_path / "out"), str(tmp_path / "progress"), **options).awaitTermination()
        found = streams.findings(spark, str(tmp_path / "out"))
        assert found.select("batch").distinct().count() == 3
        return found.drop("batch")

    return run


def series(n=240, keys=4, seed=1):
    rng = random.Random(seed)
    return [
        (f"k{rng.randrange(keys)}", START + timedelta(seconds=40 * i), i, rng.choice([0, 0, 1, 3, 9]))
        for i in range(n)
    ]


def same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.select(*left.columns).collect()))


def test_count_anomalies(feed, detected):
    batch, stream = feed(series(), "source string, ts timestamp, id bigint, job_count bigint")
    twin = detectors.detect_count_anomalies(batch).withColumnRenamed("detected_at", "ts")
    same(twin.select("source", "ts", "type", "current_count"), detected(streams.stream_zero_jobs, stream))


def test_selector_drift(feed, detected):
    batch, stream = feed(series(seed=2), "selector string, ts timestamp, id bigint, match_count bigint")
    twin = drift.drift_events(batch, history=5)
    same(
        twin.select("selector", "ts", "id", "kind", "severity"),
        detected(streams.stream_selector_drift, stream, history=5),
    )


def test_dedupe_keeps_one_row_per_key(feed, drain):
    rows = [(1, k, ts) for k, ts, _, _ in series(seed=4)]
    batch, stream = feed(rows, "company_id bigint, canonical_url string, ts timestamp")
    kept = drain(streams.stream_dedupe(stream, "ts", "1 day"))
    same(identity.seen_urls(batch), kept)


def test_timeout_windows(feed, drain):
    batch, stream = feed(
        [(k, ts, i) for k, ts, i, _ in series(seed=5)], "source string, ts timestamp, id bigint"
    )
    got = drain(streams.stream_timeout_counts(stream, watermark="1 minute", slide_s=300, max_timeouts=7))
    twin = (
        batch.groupBy(F.window("ts", "300 seconds"))
        .agg(F.count("*").alias("timeout_count"), F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("source"))
        .filter("timeout_count >= 7")
        .select(F.col("window.start").alias("window_start"), "timeout_count", "source")
    )
    closed = got.agg(F.max("window_end")).first()[0]
    assert got.count() > 3
    same(twin.filter(F.col("window_start") < closed), got)


def test_upsert_is_idempotent_per_batch(spark, feed, tmp_path):
    rows = [
        (1, f"https://x/{k}", f"t{i}", "Remote", f"https://x/{k}", ts, "open", str(i), i, 0)
        for k, ts, i, _ in series(seed=6)
    ]
    schema = (
        "company_id bigint, canonical_url string, title string, location string, url string, "
        "seen_at timestamp, status string, source_job_id string, page_no bigint, pos int"
    )
    batch, stream = feed(rows, schema)

    def full(df):
        empty = {c: F.lit(None).cast("string") for c in ("title_vi", "salary_raw", "raw_data")}
        return df.withColumns(empty).withColumn("date_posted", F.col("seen_at"))

    path = str(tmp_path / "jobs")
    streams.stream_upsert(full(stream), path, str(tmp_path / "p")).awaitTermination()
    table = tables.read_table(spark, str(tmp_path), "jobs")
    assert table.count() == identity.seen_urls(batch).count()
    before = sorted(map(str, table.collect()))
    # the last batch delivered once more is recognised and skipped
    streams.upsert_batches(path, "seen_at", str(tmp_path / "p"))(full(batch), 2)
    again = tables.read_table(spark, str(tmp_path), "jobs")
    assert sorted(map(str, again.collect())) == before
    # another stream may use the same batch numbers
    other = full(batch).withColumn("canonical_url", F.lit("https://x/other"))
    streams.upsert_batches(path, "seen_at", "other")(other, 0)
    streams.upsert_batches(path, "seen_at", str(tmp_path / "p"))(full(batch), 2)
    assert tables.read_table(spark, str(tmp_path), "jobs").count() == len(before) + 1


def test_a_replayed_batch_finds_the_same(spark, feed, tmp_path):
    rows = series(60, seed=8) + [(None, START, 99, 5), (None, START + timedelta(days=1), 100, 0)]
    batch, _ = feed(sorted(rows, key=lambda r: r[1:3]), "source string, ts timestamp, id bigint, job_count bigint")
    path = str(tmp_path / "out")
    detect = lambda df: detectors.anomalous_counts(df).select("source", "id", "type", "_new")
    step = streams.detect_batches(path, "source", 9, detect)
    cut = START + timedelta(seconds=1200)
    for part, number in ((F.col("ts") < cut, 0), (F.col("ts") >= cut, 1), (F.col("ts") >= cut, 1)):
        step(batch.filter(part), number)
    same(detectors.anomalous_counts(batch).select("source", "id", "type"), streams.findings(spark, path).drop("batch"))


def test_tails_touch_only_the_buckets_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "out")
    detect = lambda df: detectors.anomalous_counts(df).select("source", "id", "type", "_new")
    step = streams.detect_batches(path, "source", 9, detect, buckets=16)
    schema = "source string, ts timestamp, id bigint, job_count bigint"
    everything = []

    def feed(number, keys):
        rows = [(k, START + timedelta(minutes=number), number * 100 + i, (number * 7 + i) % 3) for i, k in enumerate(keys)]
        everything.extend(rows)
        step(spark.createDataFrame(rows, schema), number)

    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/tails/*/tail_bucket=*/*.parquet")}
    keys = [f"k{i}" for i in range(40)]
    feed(0, keys)
    first = files()
    feed(1, ["k3"])
    second = files()
    assert {p: at for p, at in second.items() if p in first} == first  # what rests is left alone
    assert len({p.parent.name for p in second if p not in first}) == 1
    sizes = []
    for number in range(2, 14):
        feed(number, keys[number : number + 3])
        sizes.append(len({p.parent for p in files()}))
    assert max(sizes) <= 16 + 6  # the newest of each bucket, and those before of the last batch
    tails = spark.read.schema(schema).parquet(*streams.bucket_versions(spark, f"{path}/tails", set(range(16)), 99)[0])
    assert tails.count() == sum(min(9, sum(r[0] == k for r in everything)) for k in keys)
    batch = spark.createDataFrame(everything, schema)
    same(detectors.anomalous_counts(batch).select("source", "id", "type"), streams.findings(spark, path).drop("batch"))


@pytest.mark.parametrize("cuts", [(0, 80, 160), (0, 1, 239)])
def test_first_copies_do_not_depend_on_the_batches(spark, tmp_path, cuts):
    """A run's copies are one group; the closing record moves the watermark past them."""
    rng = random.Random(9)
    schema = "company_id bigint, canonical_url string, ts timestamp, page_no int, pos int, title string"
    rows = [(rng.choice([1, None]), rng.choice(["a", "b", "c", None]), START + timedelta(seconds=40 * i),
             rng.randrange(6), rng.randrange(3), f"t{i}") for i in range(240)]
    end = [(9, "end", START + timedelta(days=9), 0, 0, "end")]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for lo, hi in zip(cuts, [*cuts[1:], 240], strict=True):
        late = end if hi == 240 else []
        part = rows[lo:hi]
        rng.shuffle(part)
        spark.createDataFrame(part + late, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = streams.stream_first(stream, "ts", "1 day", "1 day").writeStream.format("parquet")
        query.option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(schema).parquet(out)
    same(identity.dedupe(spark.createDataFrame(rows, schema)), got)


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or configured in folder


def test_timeout_counts_is_a_registered_query_with_its_sql():
    assert "stream_timeout_counts" in queries.QUERIES and "stream_timeout_counts" in queries.SQL
