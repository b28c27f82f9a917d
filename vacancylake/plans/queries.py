"""Registered queries: each operator over the driver's whole tables.

A query is a function of :class:`Tables`; next to it stands SQL giving the same
rows on another engine, where SQL can say it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.functions import dates, faults, text, urls
from vacancylake.operators import (
    alerts,
    detectors,
    drift,
    extraction,
    identity,
    lookup,
    merge,
    pacing,
    quality,
    ranking,
    reconcile,
    rollups,
    spread,
)
from vacancylake.plans.driver_tables import DERIVED, Tables, cte, listing_pages, tidy
from vacancylake.plans.monitoring import monitor
from vacancylake.plans.snapshot import SnapshotResult, run_snapshot, store_run
from vacancylake.session import ensure_checkpoint_dir, materialize
from vacancylake.sinks import exports
from vacancylake.sinks import tables as sinks
from vacancylake.sinks.listings import merge_listings, stored_counts
from vacancylake.sinks.page_files import write_page_files
from vacancylake.sources import ats, companies, html, pages, specs, tables
from vacancylake.streaming import jobs as streams

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

NOW = "2024-06-01 12:00:00"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def runnable(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: tidy(fn(Tables(spark, folder)))


def now():
    return F.lit(NOW).cast("timestamp")


def stamp(column: str) -> str:
    """SQL text of a timestamp in ISO form."""
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


# --------------------------------------------------------------------------
# URLs and other scalar rules
# --------------------------------------------------------------------------

_TRACKING = ", ".join(f"'{p}'" for p in urls.TRACKING_PARAMETERS)
_PAGE_CANONICAL = f"""
    regexp_replace(
        lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1))
        || CASE WHEN kept = '' THEN regexp_replace(path, '/+$', '') ELSE path || '?' || kept END,
        '/+$', '')"""
_PAGE_PARTS = f"""
    SELECT *, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
           coalesce(array_to_string(list_sort(list_filter(
               string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'),
               lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ({_TRACKING}))), '&'), '') AS kept
    FROM pages"""


@register(f"""
    SELECT lower(regexp_extract(canonical_url, '://([^/?#]*)', 1)) AS host,
           count(*) AS listings, count(DISTINCT canonical_url) AS distinct_urls
    FROM (SELECT min(page_id) AS page_id, canonical_url
          FROM (SELECT page_id, {_PAGE_CANONICAL} AS canonical_url FROM ({_PAGE_PARTS}))
          GROUP BY canonical_url)
    GROUP BY 1""")
def listings_per_host(t: Tables) -> DataFrame:
    records = t.pages.select(
        F.lit(1).cast("bigint").alias("company_id"),
        urls.canonicalize_url(F.col("url")).alias("canonical_url"),
        F.col("page_id").alias("page_no"),
        F.lit(0).alias("pos"),
    )
    return (
        identity.dedupe(records)
        .groupBy(urls.url_host(F.col("canonical_url")).alias("host"))
        .agg(
            F.count("*").alias("listings"),
            F.count_distinct("canonical_url").alias("distinct_urls"),
        )
    )


@register(f"SELECT page_id, {_PAGE_CANONICAL} AS canonical_url FROM ({_PAGE_PARTS})")
def canonicalize_page_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.canonicalize_url(F.col("url")).alias("canonical_url"))


_MESSY = """
    SELECT o_orderkey, CAST(o_orderkey AS STRING) AS k, o_orderstatus AS s,
           CAST(o_custkey % 7 AS STRING) AS z FROM {orders}"""


@register("""
    SELECT o_orderkey, CASE o_orderkey % 10
        WHEN 0 THEN 'https://jobs.example.com/Job/' || k || '/?a=' || s || '&z=' || z
        WHEN 1 THEN 'http://jobs.example.com/job/' || k
        WHEN 2 THEN 'https://jobs.example.com/job/' || k || '?a=1&a=0&b='
        WHEN 3 THEN 'https://jobs.example.com/job/' || k || '?q=x+y+z%2A~'
        WHEN 5 THEN 'https://jobs.example.com:8443/job/' || k
        WHEN 7 THEN 'https://jobs.example.com'
        WHEN 8 THEN 'https://jobs.example.com/' || k || '?p=100%25zz'
        WHEN 9 THEN 'https://user@jobs.example.com/x/' || k END AS canonical_url
    FROM (SELECT o_orderkey, CAST(o_orderkey AS STRING) AS k, o_orderstatus AS s,
                 CAST(o_custkey % 7 AS STRING) AS z FROM orders)""")
def canonicalize_url(t: Tables) -> DataFrame:
    k, s, z = F.col("k"), F.col("s"), F.col("z")
    shapes = [
        F.concat(F.lit("HTTPS://Jobs.Example.COM:443/Job/"), k, F.lit("/?z="), z,
                 F.lit("&utm_source=feed&a="), s, F.lit("&Ref=x#frag")),
        F.concat(F.lit("http://jobs.example.com:80/job/"), k, F.lit("/")),
        F.concat(F.lit("https://jobs.example.com/a/../job/./"), k, F.lit(";v=1?b=&a=1&a=0")),
        F.concat(F.lit("  https://jobs.example.com/job/"), k, F.lit("?q=x+y%20z*~ ")),
        F.concat(F.lit("job/"), k),
        F.concat(F.lit("https://jobs.example.com:8443/job/"), k, F.lit("#about")),
        F.lit(""),
        F.lit("https://jobs.example.com/?fbclid=1&GCLID=2"),
        F.concat(F.lit("https://jobs.example.com/"), k, F.lit("?p=100%zz")),
        F.concat(F.lit("https://User@JOBS.example.com/x/y/../"), k, F.lit("?")),
    ]
    raw = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 10 + 1).cast("int"))
    messy = t.sql(_MESSY).select("o_orderkey", raw.alias("raw"))
    return messy.select("o_orderkey", urls.canonicalize_url(F.col("raw")).alias("canonical_url"))


@register("""
    SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'open' WHEN 1 THEN 'closed'
           WHEN 2 THEN 'unknown' WHEN 3 THEN 'open' WHEN 4 THEN 'closed' END AS status
    FROM orders""")
def normalize_status(t: Tables) -> DataFrame:
    spelling = F.element_at(
        F.array(*[F.lit(v) for v in (" ACTIVE", "Filled", "n/a", "live ", "inactive", "banana")]),
        (F.col("o_orderkey") % 6 + 1).cast("int"),
    )
    return t.orders.select("o_orderkey", text.normalize_status(spelling).alias("status"))


_DAY = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)"


@register(f"""
    SELECT o_orderkey,
           CASE o_orderkey % 9
               WHEN 0 THEN {_DAY} + INTERVAL '3' HOUR + INTERVAL '30' MINUTE
               WHEN 1 THEN {_DAY} + INTERVAL '10' HOUR + INTERVAL '30' MINUTE
               WHEN 2 THEN {_DAY} WHEN 3 THEN {_DAY} + INTERVAL '10' HOUR
               WHEN 4 THEN {_DAY} + INTERVAL '10' HOUR + INTERVAL '30' MINUTE WHEN 5 THEN {_DAY}
               END AS posted_at,
           o_orderkey % 9 IN (6, 8) AS rejected
    FROM orders""")
def parse_posted_at(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    shapes = [
        F.concat(day, F.lit("T10:30:00+07:00")),
        F.concat(day, F.lit("T10:30:00Z")),
        day,
        F.concat(day, F.lit(" 10:00:00")),
        F.concat(compact, F.lit("T103000Z")),
        compact,
        F.concat(day, F.lit(" at noon")),
        F.lit("  "),
        F.lit("2026-13-45"),
    ]
    raw = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return t.orders.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey",
        dates.parse_posted_at(F.col("raw")).alias("posted_at"),
        dates.posted_at_rejected(F.col("raw")).alias("rejected"),
    )


_LOOSE_SQL = f"""
    SELECT o_orderkey, CASE o_orderkey % 11
        WHEN 0 THEN TIMESTAMP '{NOW}' WHEN 1 THEN TIMESTAMP '{NOW}' - INTERVAL '1' DAY
        WHEN 2 THEN TIMESTAMP '{NOW}' - n * INTERVAL '1' DAY
        WHEN 3 THEN TIMESTAMP '{NOW}' - n * INTERVAL '1' HOUR
        WHEN 4 THEN TIMESTAMP '{NOW}' - n * INTERVAL '7' DAY
        WHEN 5 THEN TIMESTAMP '{NOW}' - n * INTERVAL '30' DAY
        WHEN 6 THEN day WHEN 7 THEN day WHEN 8 THEN day WHEN 9 THEN day END AS posted
    FROM (SELECT *, o_orderkey % 20 + 1 AS n, {_DAY} AS day FROM orders)"""


def _loose_text():
    n = (F.col("o_orderkey") % 20 + 1).cast("string")
    shapes = [
        F.lit("Posted Today"),
        F.lit("yesterday"),
        F.concat(n, F.lit(" days ago")),
        F.concat(n, F.lit(" Hours ago")),
        F.concat(F.lit("about "), n, F.lit(" weeks")),
        F.concat(n, F.lit("  months ago")),
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.date_format("o_orderdate", "MMMM d, yyyy"),
        F.date_format("o_orderdate", "MMM dd, yyyy"),
        F.date_format("o_orderdate", "yyyy/M/d"),
        F.lit("soon"),
    ]
    return F.element_at(F.array(*shapes), (F.col("o_orderkey") % 11 + 1).cast("int"))


@register(_LOOSE_SQL)
def parse_loose_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.parse_loose_date(_loose_text(), now()).alias("posted"))


@register(f"""
    SELECT o_orderkey, coalesce({stamp('posted')} || '+00:00', 'soon') AS shown FROM ({_LOOSE_SQL})""")
def iso_or_original(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.iso_or_original(_loose_text(), now()).alias("shown"))


@register("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Remote'
           ELSE o_orderpriority END AS location FROM orders""")
def default_location(t: Tables) -> DataFrame:
    raw = (
        F.when(F.col("o_orderkey") % 4 == 1, F.lit("  "))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit(" "), "o_orderpriority"))
        .when(F.col("o_orderkey") % 4 == 3, F.col("o_orderpriority"))
    )
    return t.orders.select("o_orderkey", text.default_location(raw).alias("location"))


@register("""
    SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'a-' || k WHEN 1 THEN 'q' || k
           WHEN 2 THEN 'A_' || k WHEN 3 THEN k WHEN 4 THEN k WHEN 5 THEN k END AS source_job_id
    FROM (SELECT *, CAST(o_orderkey AS STRING) AS k FROM orders)""")
def source_job_id(t: Tables) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    choices = [
        ("caloptima", F.concat(F.lit("https://x.example/job/a-"), k, F.lit("?p=1"))),
        ("iqmetrix", F.concat(F.lit("https://x.example/apply/q"), k, F.lit("/dev"))),
        ("absolute-security", F.concat(F.lit("https://x.example/acme/job/A_"), k, F.lit(".html"))),
        ("techcorp", F.concat(F.lit("https://x.example/Careers/"), k)),
        ("techcorp", F.concat(F.lit("https://x.example/show?JOB_ID="), k)),
        ("startupxyz", F.concat(F.lit("https://x.example/jobs/"), k)),
        ("vancity", F.concat(F.lit("https://x.example/job/"), k)),
    ]
    at = (F.col("o_orderkey") % 7 + 1).cast("int")
    source = F.element_at(F.array(*[F.lit(s) for s, _ in choices]), at)
    url = F.element_at(F.array(*[u for _, u in choices]), at)
    return t.orders.select("o_orderkey", text.source_job_id(url, source).alias("source_job_id"))


@register("""
    SELECT p_partkey, CASE WHEN v >= 250 THEN '250+' WHEN v >= 200 THEN '200+'
           WHEN v >= 150 THEN '150+' ELSE '' END AS bucket
    FROM (SELECT p_partkey, CAST(substr(CAST(CAST(floor(p_retailprice * 100) AS BIGINT) AS STRING), 1, 3)
                 AS INT) AS v FROM part)""")
def salary_bucket(t: Tables) -> DataFrame:
    whole = F.floor(F.col("p_retailprice") * 100).cast("bigint")
    shown = F.concat(F.lit("$"), F.format_number(whole, 0), F.lit("/yr"))
    return t.part.select("p_partkey", text.salary_bucket(shown).alias("bucket"))


@register(cte("jobs") + """
    SELECT id, CASE WHEN raw_data LIKE '%true%' OR raw_data LIKE '%Yes%' THEN 'Yes' ELSE '' END
           AS easy_apply FROM jobs""")
def easy_apply(t: Tables) -> DataFrame:
    return t.jobs.select("id", text.easy_apply(F.col("raw_data")).alias("easy_apply"))


_SALARY_SQL = "coalesce(nullif(salary_raw, ''), nullif(raw_data ->> '$.salary', ''), '')"


@register(cte("jobs") + f" SELECT id, {_SALARY_SQL} AS salary FROM jobs")
def salary_text(t: Tables) -> DataFrame:
    return t.jobs.select("id", text.salary_text(F.col("salary_raw"), F.col("raw_data")).alias("salary"))


@register(cte("jobs") + " SELECT id, sha256(lower(trim(title))) AS fingerprint FROM jobs")
def title_fingerprint(t: Tables) -> DataFrame:
    return t.jobs.select("id", text.title_fingerprint(F.col("title")).alias("fingerprint"))


@register(r"""
    SELECT page_id, regexp_replace(u,
        '([?&](api[_-]?key|token|secret|password|auth|key|id)=)[^&]+', '\1<REDACTED>', 'gi') AS url
    FROM (SELECT page_id, url || CASE WHEN strpos(url, '?') > 0 THEN '&' ELSE '?' END
          || 'Api_Key=k' || CAST(page_id AS STRING) || '&monkey=1&ID=7' AS u FROM pages)""")
def redact_url(t: Tables) -> DataFrame:
    joint = F.when(F.instr("url", "?") > 0, "&").otherwise("?")
    with_secret = F.concat(
        "url", joint, F.lit("Api_Key=k"), F.col("page_id").cast("string"), F.lit("&monkey=1&ID=7")
    )
    return t.pages.select("page_id", text.redact_url(with_secret).alias("url"))


@register("""
    SELECT event_id, '<REDACTED>' AS api_key, event_type AS event_type, '<REDACTED>' AS secret,
           '<REDACTED>' AS header, props AS props FROM events""")
def redact_map(t: Tables) -> DataFrame:
    entries = F.create_map(
        F.lit(" Api-Key "), F.col("user_id").cast("string"),
        F.lit("event type"), F.col("event_type"),
        F.lit("my_secret_name"), F.lit("s"),
        F.lit("X-Auth-Token"), F.lit("t"),
        F.lit("props"), F.col("props"),
    )
    return t.events.withColumn("m", text.redact_map(entries)).select(
        "event_id",
        F.col("m")[" Api-Key "].alias("api_key"),
        F.col("m")["event type"].alias("event_type"),
        F.col("m")["my_secret_name"].alias("secret"),
        F.col("m")["X-Auth-Token"].alias("header"),
        F.col("m")["props"].alias("props"),
    )


@register(cte("attempts") + """
    SELECT id, round(CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) / 1000000, 6) AS seconds,
           (epoch_us(finished_at) - epoch_us(started_at)) // 1000 AS millis FROM attempts""")
def durations(t: Tables) -> DataFrame:
    span = (F.col("started_at"), F.col("finished_at"))
    return t.attempts.select(
        "id",
        dates.duration_seconds(*span).alias("seconds"),
        dates.duration_ms(*span).alias("millis"),
    )


_RETRYABLE_SQL = "(status_code IN (408, 429, 500, 502, 503, 504) OR coalesce(error_type, '') = 'timeout')"


@register(cte("fetch_log") + f"""
    SELECT source, page_no, attempt, NOT again AS is_final, CASE WHEN again THEN delay END AS delay_seconds,
           CASE WHEN again THEN finished_at + delay * INTERVAL '1' SECOND END AS next_attempt_at
    FROM (SELECT source, page_no, attempt % 4 + 1 AS attempt, finished_at,
                 {_RETRYABLE_SQL} AND attempt % 4 + 1 < 3 AS again,
                 least(pow(2, attempt % 4), 30) AS delay
          FROM fetch_log WHERE error_type IS NOT NULL OR status_code >= 400)""")
def retry_plan(t: Tables) -> DataFrame:
    log = t.fetch_log.withColumn("attempt", F.col("attempt") % 4 + 1)
    return faults.retry_plan(log).select(
        "source", "page_no", "attempt", "is_final", "delay_seconds", "next_attempt_at"
    )


@register(cte("fetch_log") + f"""
    SELECT status_code, error_type, {_RETRYABLE_SQL} AS retryable, count(*) AS n
    FROM fetch_log GROUP BY 1, 2, 3""")
def is_retryable(t: Tables) -> DataFrame:
    rule = faults.is_retryable(F.col("status_code"), F.col("error_type"))
    return t.fetch_log.groupBy("status_code", "error_type", rule.alias("retryable")).agg(
        F.count("*").alias("n")
    )


_RECOVERY_SQL = f"""CASE WHEN error_type LIKE '%challenge%' THEN 'anti_bot'
    WHEN status_code IN (401, 403) THEN 'auth' WHEN {_RETRYABLE_SQL} THEN 'transient'
    WHEN error_type IS NULL AND n_jobs = 0 THEN 'data_quality' END"""


@register(cte("fetch_log") + f"""
    SELECT source, page_no, attempt, {_RECOVERY_SQL} AS recovery FROM fetch_log""")
def recovery_class(t: Tables) -> DataFrame:
    rule = faults.recovery_class(F.col("status_code"), F.col("error_type"), F.col("n_jobs"))
    return t.fetch_log.select("source", "page_no", "attempt", rule.alias("recovery"))


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------

_PAGED = """SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus,
    CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS page_no,
    row_number() OVER (PARTITION BY floor(o_orderkey / 100) ORDER BY o_orderkey) - 1 AS pos,
    CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS posted
    FROM orders"""


@register(f"""
    SELECT 'greenhouse' AS source, page_no, pos, CAST(o_orderkey AS STRING) AS source_job_id,
           o_orderpriority AS title,
           CASE WHEN o_orderkey % 3 <> 0 THEN 'City ' || CAST(o_custkey % 20 AS STRING)
                ELSE 'Remote' END AS location,
           'https://jobs.example.com/' || CAST(o_orderkey AS STRING) AS url, posted AS date_posted,
           '{{"department":' || CASE WHEN o_orderkey % 2 = 0 THEN '"' || o_orderstatus || '"' ELSE 'null' END
           || ',"employment_type":"full","internal_job_id":' || CAST(o_orderkey + 5 AS STRING) || '}}'
               AS raw_data
    FROM ({_PAGED})""")
def flatten_greenhouse(t: Tables) -> DataFrame:
    return ats.flatten_greenhouse(t.ats_pages("greenhouse"))


@register(f"""
    SELECT 'workday' AS source, page_no, pos, 'JOB-' || k AS source_job_id, o_orderpriority AS title,
           location, CASE WHEN o_orderkey % 4 <> 0 THEN 'https://a.example.com/' || k
                ELSE 'https://w.example.com/' || k END AS url, posted AS date_posted,
           '{{"job_posting_id":"JOB-' || k || '","locations":'
           || CASE WHEN o_orderkey % 3 <> 0 THEN '["' || o_orderstatus || '","x"]' ELSE '[]' END
           || ',"subcategory":{{"id":"c1","name":"' || o_orderstatus || '"}},"primary_location":"'
           || location || '","posted_on":' || coalesce('"' || posted || '"', 'null') || '}}' AS raw_data
    FROM (SELECT *, CAST(o_orderkey AS STRING) AS k,
                 CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE 'Vancouver, BC' END AS location
          FROM ({_PAGED}))
    WHERE o_orderkey % 8 <> 0""")
def flatten_workday(t: Tables) -> DataFrame:
    return ats.flatten_workday(t.ats_pages("workday"))


@register("""
    WITH p AS (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS page, count(*) AS n FROM orders GROUP BY 1),
         last AS (SELECT *, (SELECT count(*) FROM orders) AS total, (SELECT count(*) FROM p) AS pages,
                  page * 100 + n AS reached FROM p ORDER BY page DESC LIMIT 1)
    SELECT 'workday' AS source, n AS current_count, total, pages, reached < total AS has_next,
           reached >= total AND page + 1 = pages AS complete FROM last
    UNION ALL
    SELECT 'greenhouse', n, total, pages, n = 100, n <> 100 AND page + 1 = pages FROM last""")
def snapshot_complete(t: Tables) -> DataFrame:
    meta = ats.page_meta(t.ats_pages("workday"), "offset", "data").unionByName(
        ats.page_meta(t.ats_pages("greenhouse"), "page", "jobs")
    )
    return extraction.snapshot_complete(meta)


@register(cte("html_source") + """
    SELECT h.source, h.page_no, h.page_id FROM html_source h
    LEFT JOIN (SELECT source, min(page_no) AS stop FROM html_source
               WHERE content_type NOT LIKE '%text/html%' GROUP BY source) s ON s.source = h.source
    WHERE h.page_no < coalesce(s.stop, 1000000000)""")
def html_pages(t: Tables) -> DataFrame:
    return pages.html_pages(t.html_source).select("source", "page_no", "page_id")


@register("""
    SELECT source, title, url, location FROM (
        SELECT 'orders-feed' AS source, o_orderpriority AS title, 'o' || CAST(o_orderkey AS STRING) AS url,
               CAST(NULL AS STRING) AS location FROM orders
        UNION ALL
        SELECT 'parts-feed', p_name, 'p' || CAST(p_partkey AS STRING), p_type FROM part)""")
def union_sources(t: Tables) -> DataFrame:
    union, _ = lookup.union_sources(
        {
            "orders-feed": t.orders.select(
                F.col("o_orderpriority").alias("title"),
                F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("url"),
            ),
            "parts-feed": t.part.select(
                F.col("p_name").alias("title"),
                F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("url"),
                F.col("p_type").alias("location"),
            ),
            "broken-feed": t.customer.select("c_name"),
        }
    )
    return union.select("source", "title", "url", "location")


@register("""
    SELECT source, page_no, CASE style WHEN 0 THEN base || joint || 'offset=' || CAST((page_no - 1) * 100 AS STRING)
                || '&limit=100'
            WHEN 1 THEN CASE WHEN page_no = 1 THEN base ELSE base || joint || 'page=' || CAST(page_no AS STRING) END
            ELSE base || joint || 'page=' || CAST(page_no AS STRING) || '&per_page=100' END AS url
    FROM (SELECT lower(replace(s_name, '#', '-')) AS source, s_suppkey % 3 AS style,
                 unnest(range(1, CAST(s_suppkey % 5 + 2 AS BIGINT))) AS page_no,
                 'https://x.example.com/jobs' || CASE WHEN s_suppkey % 2 = 0 THEN '?q=1' ELSE '' END AS base,
                 CASE WHEN s_suppkey % 2 = 0 THEN '&' ELSE '?' END AS joint
          FROM supplier)""")
def expand_listing_urls(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    sources = t.supplier.select(
        F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("slug"),
        F.concat(
            F.lit("https://x.example.com/jobs"), F.when(key % 2 == 0, "?q=1").otherwise("")
        ).alias("listing_url"),
        F.when(key % 3 == 0, "offset").when(key % 3 == 1, "page").otherwise("page_per_page").alias("paging"),
        (key % 3 == 1).alias("first_page_bare"),
        (key % 5 + 1).cast("int").alias("max_pages"),
        F.lit(100).alias("per_page"),
    )
    return specs.expand_listing_urls(sources)


_ADMITTED = "compliance_status IN ('approved', 'needs-review')"


@register(cte("companies", "seed") + f"""
    SELECT coalesce(c.slug, s.slug) AS slug, coalesce(s.name, c.name) AS name,
           coalesce(s.adapter_type, c.adapter_type) AS adapter_type,
           coalesce(s.authoritative, c.authoritative) AS authoritative,
           CASE WHEN c.id IS NULL THEN 'created' WHEN s.slug IS NULL THEN 'kept' ELSE 'updated' END AS op
    FROM companies c FULL OUTER JOIN (SELECT * FROM seed WHERE {_ADMITTED}) s ON s.slug = c.slug""")
def load_companies(t: Tables) -> DataFrame:
    loaded, _ = companies.load_companies(t.companies, t.seed, now())
    return loaded.select("slug", "name", "adapter_type", "authoritative", "op")


@register(cte("companies") + " SELECT * FROM companies WHERE slug = 'supplier-000000007'")
def find_company(t: Tables) -> DataFrame:
    return tables.find_by(t.companies, slug="supplier-000000007")


# --------------------------------------------------------------------------
# HTML pages
# --------------------------------------------------------------------------

_NAV_ITEMS = r"""
    SELECT page_id, unnest(range(0, len(hrefs))) AS pos, unnest(hrefs) AS href, unnest(titles) AS title
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS titles FROM pages)"""


def _site_pages(t: Tables, source: str = "site") -> DataFrame:
    return t.pages.select(
        F.lit(source).alias("source"), F.col("page_id").cast("int").alias("page_no"), "url", "html"
    )


def _one_rule(t: Tables, source: str, family: str, **rule) -> DataFrame:
    catalog = specs.SourceCatalog(
        [specs.SourceSpec(source, family, "https://site.example.com", rule=specs.PageRule(**rule))]
    )
    return catalog.rules(t.spark)


@register(r"""
    SELECT page_id AS page_no, selector, n AS match_count, n > 0 AS matched FROM (
        SELECT page_id, unnest(['nav li', 'article > h1', 'p', 'div.ad', 'a[href]', 'a[href*="/th"]', '>bad',
                                'li > a[href^="/"]', 'article > h1:first-child']) AS selector,
               unnest([len(regexp_extract_all(html, '<li>')), len(regexp_extract_all(html, '<h1>')),
                       len(regexp_extract_all(html, '<p>')), len(regexp_extract_all(html, '<div class="ad">')),
                       len(regexp_extract_all(html, '<a href=')),
                       len(regexp_extract_all(html, '<a href="[^"]*/th')), 0,
                       len(regexp_extract_all(html, '<li><a href="/')),
                       len(regexp_extract_all(html, '<article><h1>'))]) AS n
        FROM pages)""")
def count_selector_matches(t: Tables) -> DataFrame:
    selectors = [
        "nav li", "article > h1", "p", "div.ad", "a[href]", 'a[href*="/th"]', ">bad", 'li > a[href^="/"]',
        "article > h1:first-child",
    ]
    return html.count_selector_matches(_site_pages(t), selectors, ["page_no"])


@register(f"""
    SELECT 'site' AS source, page_id AS page_no, pos, title, 'Remote' AS location,
           'https://site.example.com' || href AS url FROM ({_NAV_ITEMS}) WHERE title <> ''""")
def extract_listings(t: Tables) -> DataFrame:
    rules = _one_rule(
        t, "site", "html", container="nav li", title="a", link="a", base_url="https://site.example.com"
    )
    return html.extract_listings(_site_pages(t), rules).select(
        "source", "page_no", "pos", "title", "location", "url"
    )


@register(f"""
    SELECT 'site' AS source, page_id AS page_no, pos, title, 'Falls Church, VA' AS location,
           'https://www.example.com' || href AS url FROM ({_NAV_ITEMS}) WHERE title <> ''""")
def extract_rendered_listings(t: Tables) -> DataFrame:
    rules = _one_rule(
        t, "site", "browser", container="[data-automation-id='job'], nav li", title="a, h3",
        base_url="https://www.example.com", default_location="Falls Church, VA",
    )
    return html.extract_listings(_site_pages(t), rules).select(
        "source", "page_no", "pos", "title", "location", "url"
    )


@register(r"""
    SELECT page_id AS page_no, trim(regexp_replace(
        replace(replace(replace(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1),
            '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS title
    FROM pages WHERE regexp_matches(html, '<article><h1>\s*[^<\s]')""")
def extract_cards(t: Tables) -> DataFrame:
    rule = specs.PageRule(container="article", title="h1")
    cards = html.extract_cards(_site_pages(t), rule)
    return cards.filter("kind = 'job'").select("page_no", "title")


@register(r"""
    SELECT page_id, pos, 'https://x.example.com/careers/' || substr(href, 2) AS url FROM (
        SELECT page_id, unnest(range(0, len(h))) AS pos, unnest(h) AS href
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))""")
def extract_links(t: Tables) -> DataFrame:
    careers = t.pages.withColumn("html", F.replace("html", F.lit('href="/'), F.lit('href="&#47;careers&#x2F;')))
    return html.extract_links(careers, F.lit("https://x.example.com/list/all"), ["page_id"])


@register(r"""
    SELECT page_id AS page_no, nullif(regexp_extract(html, '<li><a href="([^"]*)"', 1), '') AS next_page
    FROM pages""")
def next_page_url(t: Tables) -> DataFrame:
    return html.next_page_url(_site_pages(t), "a.next, nav li a").select("page_no", "next_page")


@register(cte("fetch_log") + """
    SELECT source, page_no, attempt, page_no < 10 AND n_jobs > 0 AS go_on FROM fetch_log""")
def should_continue(t: Tables) -> DataFrame:
    rule = specs.should_continue(F.col("page_no"), F.col("n_jobs"))
    return t.fetch_log.select("source", "page_no", "attempt", rule.alias("go_on"))


_WORDED = {
    0: "<p>one <b>Job</b> and a career</p>",
    1: "<article>x</article>",
    2: "<!-- job career position --><script>job career</script>",
    3: "<p>opportunity</p>",
}


@register("""
    SELECT page_id, CAST(CASE page_id % 4 WHEN 0 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS BIGINT) AS word_matches,
           least(len(regexp_extract_all(html, '<article>')) + CASE WHEN page_id % 4 = 1 THEN 1 ELSE 0 END, 5)
               AS element_matches,
           page_id % 4 = 0 OR len(regexp_extract_all(html, '<article>'))
               + CASE WHEN page_id % 4 = 1 THEN 1 ELSE 0 END >= 2 AS is_listing
    FROM pages""")
def is_listing_page(t: Tables) -> DataFrame:
    extra = F.element_at(F.array(*[F.lit(v) for v in _WORDED.values()]), (F.col("page_id") % 4 + 1).cast("int"))
    return html.is_listing_page(t.pages.withColumn("html", F.concat("html", extra)), ["page_id"])


def _contains_any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


@register(f"""
    SELECT page_id, kind AS challenge_type, kind IS NOT NULL AS challenge_detected FROM (
        SELECT page_id, CASE
            WHEN {_contains_any("regexp_extract(h, '<title[^>]*>(.*?)</title>', 1)", html.CHALLENGE_TITLES)} THEN 'title'
            WHEN {_contains_any("h", html.BLOCKED_KEYWORDS)} THEN 'blocked'
            WHEN {_contains_any("h", html.CHALLENGE_KEYWORDS)} THEN 'challenge' END AS kind
        FROM (SELECT page_id, lower(CASE page_id % 5
                WHEN 0 THEN replace(html, '<title>', '<title>Just a Moment... ')
                WHEN 1 THEN html || '<p>Access Denied</p>' WHEN 2 THEN html || '<i>Ray ID: 9</i>'
                WHEN 3 THEN html || '<p>job 1403</p>' ELSE html END) AS h FROM pages))""")
def classify_challenge(t: Tables) -> DataFrame:
    kind = F.col("page_id") % 5
    shown = (
        F.when(kind == 0, F.replace("html", F.lit("<title>"), F.lit("<title>Just a Moment... ")))
        .when(kind == 1, F.concat("html", F.lit("<p>Access Denied</p>")))
        .when(kind == 2, F.concat("html", F.lit("<i>Ray ID: 9</i>")))
        .when(kind == 3, F.concat("html", F.lit("<p>job 1403</p>")))
        .otherwise(F.col("html"))
    )
    return html.classify_challenge(t.pages.withColumn("html", shown)).select(
        "page_id", "challenge_type", "challenge_detected"
    )


# --------------------------------------------------------------------------
# Validation and filters
# --------------------------------------------------------------------------

_GOOD_URL = "regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')"


@register(cte("raw_rows") + f"""
    SELECT page_no, trim(source) AS source, trim(title) AS title, trim(url) AS url,
           concat_ws('; ', CASE WHEN trim(source) = '' THEN 'missing source' END,
               CASE WHEN trim(title) = '' THEN 'empty title' END,
               CASE WHEN NOT {_GOOD_URL} THEN 'bad url' END) AS reasons
    FROM raw_rows""")
def validate_raw(t: Tables) -> DataFrame:
    return quality.validate_raw(t.raw_rows).select(
        "page_no", "source", "title", "url", F.array_join("skip_reasons", "; ").alias("reasons")
    )


@register(cte("raw_rows") + f"""
    SELECT page_no, company_id, trim(title) AS title, trim(url) AS url,
           coalesce(nullif(trim(location), ''), 'Remote') AS location,
           CASE page_no % 6 WHEN 0 THEN '/job/' || CAST(page_no AS STRING)
               WHEN 1 THEN 'https://jobs.example.com/Job/' || CAST(page_no AS STRING)
               ELSE 'https://jobs.example.com/job/' || CAST(page_no AS STRING) END AS canonical_url,
           CASE page_no % 5 WHEN 0 THEN TIMESTAMP '2026-07-15 03:30:00'
               WHEN 4 THEN TIMESTAMP '2026-07-15 00:00:00' END AS date_posted,
           concat_ws('; ', CASE WHEN company_id <= 0 THEN 'bad company' END,
               CASE WHEN trim(title) = '' THEN 'empty title' END,
               CASE WHEN NOT {_GOOD_URL} THEN 'bad url' END,
               CASE WHEN date_posted = 'soon' THEN 'unparseable date' END) AS reasons
    FROM raw_rows""")
def to_records(t: Tables) -> DataFrame:
    return quality.to_records(t.raw_rows).select(
        "page_no", "company_id", "title", "url", "location", "canonical_url", "date_posted",
        F.array_join("reject_reasons", "; ").alias("reasons"),
    )


@register(cte("jobs", "companies") + """
    SELECT id, company_id, status, date_posted FROM jobs
    WHERE company_id = (SELECT id FROM companies WHERE slug = 'supplier-000000003') AND status = 'open'
      AND date_posted >= DATE '1996-01-01' AND date_posted <= DATE '1999-12-31'""")
def filter_jobs(t: Tables) -> DataFrame:
    rows = quality.filter_jobs(
        t.jobs, t.companies, "supplier-000000003", "open", "1996-01-01", "1999-12-31"
    )
    return rows.select("id", "company_id", "status", "date_posted")


@register(cte("jobs") + " SELECT id, status FROM jobs WHERE date_posted >= DATE '1998-06-01'")
def filter_jobs_unknown_values(t: Tables) -> DataFrame:
    rows = quality.filter_jobs(t.jobs, t.companies, "no-such-company", "banana", "1998-06-01")
    return rows.select("id", "status")


@register(cte("jobs", "companies") + """
    SELECT j.id, c.name AS company_name, j.status, j.date_posted
    FROM jobs j JOIN companies c ON c.id = j.company_id
    WHERE j.status <> 'closed' AND c.name IN ('Supplier#000000001', 'Supplier#000000002')
      AND (j.date_posted IS NULL OR j.date_posted BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01')""")
def export_filter(t: Tables) -> DataFrame:
    named = lookup.jobs_with_company(t.jobs, t.companies)
    rows = quality.export_filter(
        named,
        company_names=["Supplier#000000001", "Supplier#000000002"],
        date_from=F.lit("1996-01-01").cast("timestamp"),
        date_to=F.lit("1999-01-01").cast("timestamp"),
    )
    return rows.select("id", "company_name", "status", "date_posted")


@register(cte("companies") + " SELECT id, name, slug FROM companies WHERE is_active ORDER BY name")
def active_companies(t: Tables) -> DataFrame:
    return quality.active_companies(t.companies).select("id", "name", "slug")


@register(cte("companies") + """
    SELECT id, slug, adapter_type FROM companies
    WHERE adapter_type = 'html' AND slug NOT IN ('supplier-000000001', 'supplier-000000004')""")
def select_sources(t: Tables) -> DataFrame:
    rows = quality.select_sources(
        t.companies, adapter_type="html", exclude=["supplier-000000001", "supplier-000000004"]
    )
    return rows.select("id", "slug", "adapter_type")


@register(cte("seed") + f"""
    SELECT slug, coalesce({_ADMITTED}, false) AS admitted,
           CASE WHEN NOT coalesce({_ADMITTED}, false)
                THEN 'compliance: ' || coalesce(compliance_status, 'unknown') END AS skip_reason FROM seed""")
def compliance_gate(t: Tables) -> DataFrame:
    return quality.compliance_gate(t.seed).select("slug", "admitted", "skip_reason")


_SWEEP_NOW = "2024-01-20 00:00:00.5"
_SWEPT = f"(status = 'running' AND started_at < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '3600' SECOND)"


@register(cte("runs") + f"""
    SELECT id, CASE WHEN {_SWEPT} THEN 'interrupted' ELSE status END AS status,
           CASE WHEN {_SWEPT} THEN TIMESTAMP '{_SWEEP_NOW}' ELSE finished_at END AS finished_at,
           {_SWEPT} AS swept FROM runs""")
def mark_orphans(t: Tables) -> DataFrame:
    swept = quality.mark_orphans(t.runs, F.lit(_SWEEP_NOW).cast("timestamp"))
    return swept.select("id", "status", "finished_at", "swept")


@register(cte("runs", "attempts") + f"""
    SELECT a.id, a.run_id, CASE WHEN hit THEN 'interrupted' ELSE a.status END AS status, hit AS swept
    FROM (SELECT id, run_id, CASE WHEN finished_at IS NULL THEN 'running' ELSE status END AS status,
                 finished_at IS NULL AND run_id IN (SELECT id FROM runs WHERE {_SWEPT}) AS hit
          FROM attempts) a""")
def mark_orphan_attempts(t: Tables) -> DataFrame:
    at = F.lit(_SWEEP_NOW).cast("timestamp")
    unfinished = F.when(F.col("finished_at").isNull(), "running").otherwise(F.col("status"))
    rows = t.attempts.withColumn("status", unfinished)
    swept = quality.mark_orphan_attempts(rows, quality.mark_orphans(t.runs, at), at)
    return swept.select("id", "run_id", "status", "swept")


def _fault_alerts(t: Tables) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("rate_limit", "anti_bot", "parse", "auth", "transient", "none")])
    source = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return alerts.fault_alerts(
        t.events.select(
            source.alias("source"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.element_at(kinds, (F.col("event_id") % 6 + 1).cast("int")).alias("fault"),
        )
    ).withColumn("acknowledged", F.second("ts") % 2 == 0)


_FAULT_ALERTS = """
    SELECT CASE event_id % 6 WHEN 0 THEN 'rate_limit' WHEN 1 THEN 'anti_bot' WHEN 2 THEN 'parse_error'
                ELSE 'source_unavailable' END AS alert_type,
           CASE event_id % 6 WHEN 1 THEN 'critical' WHEN 3 THEN 'error' ELSE 'warning' END AS severity,
           'u' || CAST(user_id AS STRING) AS source, ts, CAST(second(ts) AS BIGINT) % 2 = 0 AS acknowledged
    FROM events WHERE event_id % 6 <> 5"""


@register(f"""
    SELECT alert_type, severity, source, ts FROM ({_FAULT_ALERTS})
    WHERE NOT acknowledged AND severity IN ('error', 'critical')""")
def active_alerts(t: Tables) -> DataFrame:
    rows = quality.active_alerts(_fault_alerts(t), min_severity="error")
    return rows.select("alert_type", "severity", "source", "ts")


@register(f"SELECT alert_type, count(*) AS n FROM ({_FAULT_ALERTS}) WHERE NOT acknowledged GROUP BY 1")
def clear_acknowledged(t: Tables) -> DataFrame:
    left = quality.clear_acknowledged(_fault_alerts(t))
    return left.groupBy("alert_type").agg(F.count("*").alias("n"))


# --------------------------------------------------------------------------
# De-duplication, merging and joins
# --------------------------------------------------------------------------

_RANKED = cte("records") + """, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY company_id, canonical_url ORDER BY page_no, pos) AS rn,
           first_value(title) OVER (PARTITION BY company_id, canonical_url ORDER BY page_no, pos) AS kept
    FROM records)"""


@register(_RANKED + " SELECT company_id, canonical_url, page_no, pos, title, url FROM ranked WHERE rn = 1")
def dedupe(t: Tables) -> DataFrame:
    return identity.dedupe(t.records.drop("price")).select(
        "company_id", "canonical_url", "page_no", "pos", "title", "url"
    )


@register(_RANKED + """
    SELECT company_id, canonical_url, page_no, pos, title, 'Duplicate of ' || kept AS reason
    FROM ranked WHERE rn > 1""")
def duplicates(t: Tables) -> DataFrame:
    return identity.duplicates(t.records.drop("price")).select(
        "company_id", "canonical_url", "page_no", "pos", "title", "reason"
    )


@register(cte("records") + " SELECT DISTINCT company_id, canonical_url FROM records")
def seen_urls(t: Tables) -> DataFrame:
    return identity.seen_urls(t.records)


_MERGED = """
    SELECT c.id, coalesce(c.company_id, n.company_id) AS company_id,
           coalesce(c.canonical_url, n.canonical_url) AS canonical_url,
           coalesce(n.title, c.title) AS title, coalesce(n.title_vi, c.title_vi) AS title_vi,
           coalesce(n.location, c.location) AS location, coalesce(n.status, c.status) AS status,
           coalesce(n.salary_raw, c.salary_raw) AS salary_raw,
           CASE WHEN n.status IS NULL THEN c.raw_data END AS raw_data,
           CASE WHEN c.id IS NULL THEN 'created' WHEN n.status IS NULL THEN 'kept' ELSE 'updated' END AS op
    FROM jobs c FULL OUTER JOIN incoming n
      ON n.company_id = c.company_id AND n.canonical_url = c.canonical_url"""


@register(cte("jobs", "incoming") + _MERGED)
def upsert_jobs(t: Tables) -> DataFrame:
    merged = merge.upsert_jobs(t.jobs, identity.dedupe(t.incoming), now())
    return merged.select(
        F.when(F.col("op") != "created", F.col("id")).alias("id"),
        "company_id", "canonical_url", "title", "title_vi", "location", "status", "salary_raw",
        "raw_data", "op",
    )


@register(cte("companies", "seed") + f"""
    SELECT coalesce(c.slug, s.slug) AS slug, coalesce(s.name, c.name) AS name,
           coalesce(s.base_url, c.base_url) AS base_url, coalesce(s.is_active, c.is_active) AS is_active,
           CASE WHEN s.slug IS NULL THEN c.updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at,
           CASE WHEN c.id IS NULL THEN 'created' WHEN s.slug IS NULL THEN 'kept' ELSE 'updated' END AS op
    FROM companies c FULL OUTER JOIN seed s ON s.slug = c.slug""")
def upsert_companies(t: Tables) -> DataFrame:
    merged = merge.upsert_companies(t.companies, t.seed, now())
    return merged.select("slug", "name", "base_url", "is_active", "updated_at", "op")


@register(cte("companies") + f"""
    SELECT id, is_active AND id <> 4 AS is_active,
           CASE WHEN id = 4 THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at FROM companies""")
def deactivate_company(t: Tables) -> DataFrame:
    return merge.deactivate_company(t.companies, 4, now()).select("id", "is_active", "updated_at")


_SEEN = "SELECT DISTINCT company_id, canonical_url FROM incoming"


@register(cte("jobs", "incoming") + f"""
    SELECT id, company_id, 'closed' AS status FROM jobs j WHERE status = 'open' AND NOT EXISTS (
        SELECT 1 FROM ({_SEEN}) s WHERE s.company_id = j.company_id AND s.canonical_url = j.canonical_url)""")
def close_missing(t: Tables) -> DataFrame:
    return reconcile.close_missing(t.jobs, identity.seen_urls(t.incoming)).select(
        "id", "company_id", "status"
    )


@register(cte("jobs", "incoming") + f"""
    SELECT id, company_id, 'open' AS status FROM jobs j WHERE status = 'closed' AND EXISTS (
        SELECT 1 FROM ({_SEEN}) s WHERE s.company_id = j.company_id AND s.canonical_url = j.canonical_url)""")
def reopen_seen(t: Tables) -> DataFrame:
    return reconcile.reopen_seen(t.jobs, identity.seen_urls(t.incoming)).select(
        "id", "company_id", "status"
    )


def _last_attempts(t: Tables) -> DataFrame:
    return ranking.last_attempt_per_company(t.attempts)


_LAST = """last AS (SELECT * FROM attempts QUALIFY
    row_number() OVER (PARTITION BY company_id ORDER BY started_at DESC, id DESC) = 1)"""


def _reconciled_sql(trusted: str, needed: int) -> str:
    return cte("jobs", "incoming", "attempts") + f""", {_LAST},
    flagged AS (
        SELECT j.*, l.company_id IS NOT NULL AS counts, s.company_id IS NOT NULL AS seen
        FROM jobs j LEFT JOIN (SELECT * FROM last WHERE {trusted}) l ON l.company_id = j.company_id
        LEFT JOIN ({_SEEN}) s ON s.company_id = j.company_id AND s.canonical_url = j.canonical_url),
    changed AS (
        SELECT *, CASE WHEN counts AND NOT seen AND status = 'open' THEN
                       CASE WHEN missing_count + 1 >= {needed} THEN 'closed' ELSE 'missed' END
                       WHEN counts AND seen AND status = 'closed' THEN 'reopened'
                       WHEN counts AND seen AND missing_count > 0 THEN 'reset' END AS change
        FROM flagged)"""


_RECONCILED = """
    SELECT id, company_id, CASE change WHEN 'closed' THEN 'closed' WHEN 'reopened' THEN 'open'
                ELSE status END AS status,
           CASE WHEN change IN ('closed', 'missed') THEN missing_count + 1
                WHEN counts AND seen THEN 0 ELSE missing_count END AS missing_count, change
    FROM changed"""
_TRUSTED = "complete AND authoritative_snapshot AND status NOT IN ('partial', 'failed')"


@register(_reconciled_sql(_TRUSTED, 2) + _RECONCILED)
def reconcile_threshold(t: Tables) -> DataFrame:
    rows = reconcile.reconcile(t.jobs, identity.seen_urls(t.incoming), _last_attempts(t), now())
    return rows.select("id", "company_id", "status", "missing_count", "change")


@register(_reconciled_sql("status <> 'failed'", 1) + _RECONCILED)
def reconcile_immediate(t: Tables) -> DataFrame:
    rows = reconcile.reconcile(
        t.jobs, identity.seen_urls(t.incoming), _last_attempts(t), now(), mode="immediate"
    )
    return rows.select("id", "company_id", "status", "missing_count", "change")


@register(_reconciled_sql(_TRUSTED, 2) + """
    SELECT company_id, count(*) FILTER (change = 'closed') AS closed,
           count(*) FILTER (change = 'reopened') AS reopened,
           count(*) FILTER (change IN ('closed', 'missed', 'reset')) AS updated
    FROM changed GROUP BY company_id""")
def reconcile_counts(t: Tables) -> DataFrame:
    rows = reconcile.reconcile(t.jobs, identity.seen_urls(t.incoming), _last_attempts(t), now())
    return reconcile.reconcile_counts(rows)


@register(cte("jobs") + """
    SELECT company_id, count(*) AS stale_jobs FROM jobs
    WHERE status = 'open' AND missing_count >= 2 GROUP BY company_id""")
def stale_candidates(t: Tables) -> DataFrame:
    return reconcile.stale_candidates(t.jobs)


#: Added to a key so that its partners are missing from the other table.
_APART = 1_000_000_000
_FEW = f"few AS (SELECT * REPLACE (id + CASE id % 3 WHEN 0 THEN {_APART} ELSE 0 END AS id) FROM companies)"


def _parted(df: DataFrame, key: str, every: int) -> DataFrame:
    """All rows; those whose key is a multiple of ``every`` meet nobody."""
    moved = F.when(F.col(key) % every == 0, F.col(key) + _APART).otherwise(F.col(key))
    return df.withColumn(key, moved)


@register(cte("jobs", "companies") + f""", {_FEW}
    SELECT j.id, c.name AS company_name, c.slug AS company_slug FROM jobs j JOIN few c ON c.id = j.company_id""")
def jobs_with_company(t: Tables) -> DataFrame:
    few = _parted(t.companies, "id", 3)
    return lookup.jobs_with_company(t.jobs, few).select("id", "company_name", "company_slug")


@register(cte("jobs", "companies") + f""", {_FEW}
    SELECT j.id, coalesce(c.name, 'Unknown') AS company_name, coalesce(c.slug, '') AS company_slug
    FROM jobs j LEFT JOIN few c ON c.id = j.company_id""")
def jobs_with_company_outer(t: Tables) -> DataFrame:
    few = _parted(t.companies, "id", 3)
    return lookup.jobs_with_company(t.jobs, few, outer=True).select(
        "id", "company_name", "company_slug"
    )


_ATTEMPT_NAMES = """
    SELECT a.id, a.started_at, coalesce(c.name, 'Unknown') AS company_name, a.status,
           round((epoch_us(a.finished_at) - epoch_us(a.started_at)) / 1000000.0, 6) AS duration_seconds
    FROM attempts a LEFT JOIN companies c ON c.id = a.company_id"""


@register(cte("attempts", "companies") + _ATTEMPT_NAMES + " WHERE a.run_id = 7")
def attempts_with_company(t: Tables) -> DataFrame:
    return lookup.attempts_with_company(t.attempts, t.companies, 7).select(
        "id", "started_at", "company_name", "status", "duration_seconds"
    )


_CACHE = """cache AS (SELECT DISTINCT sha256(lower(trim(t))) AS fingerprint, 'vi: ' || lower(trim(t)) AS translation
    FROM (SELECT title || CASE WHEN id % 50 < 20 THEN '' ELSE ' (old)' END AS t FROM jobs))"""


def _cache(t: Tables) -> DataFrame:
    title = F.concat("title", F.when(F.col("id") % 50 < 20, "").otherwise(" (old)"))
    return t.jobs.select(
        text.title_fingerprint(title).alias("fingerprint"),
        F.concat(F.lit("vi: "), F.lower(F.trim(title))).alias("translation"),
    ).distinct()


@register(cte("jobs") + f""", {_CACHE}
    SELECT sha256(lower(trim(title))) AS fingerprint, min(trim(title)) AS title FROM jobs
    WHERE sha256(lower(trim(title))) NOT IN (SELECT fingerprint FROM cache) GROUP BY 1""")
def pending_translations(t: Tables) -> DataFrame:
    return lookup.pending_translations(t.jobs, _cache(t))


@register(cte("jobs") + f""", {_CACHE}
    SELECT id, title, translation AS title_vi FROM jobs
    LEFT JOIN cache ON fingerprint = sha256(lower(trim(title)))""")
def apply_translations(t: Tables) -> DataFrame:
    return lookup.apply_translations(t.jobs, _cache(t)).select("id", "title", "title_vi")


@register(cte("jobs") + f""", {_CACHE}, per AS (
        SELECT sha256(lower(trim(title))) AS f, count(*) AS n FROM jobs GROUP BY 1)
    SELECT count(*) FILTER (f NOT IN (SELECT fingerprint FROM cache)) AS calls,
           CAST(sum(CASE WHEN f IN (SELECT fingerprint FROM cache) THEN n ELSE n - 1 END) AS BIGINT) AS hits
    FROM per""")
def translation_counts(t: Tables) -> DataFrame:
    return lookup.translation_counts(t.jobs, _cache(t))


@register(cte("companies") + """
    SELECT id AS company_id, slug, 'failed' AS status, 'NoAdapter' AS error_type,
           'No adapter registered for ' || slug AS error_message FROM companies WHERE id % 4 <> 0""")
def unmatched_sources(t: Tables) -> DataFrame:
    return lookup.unmatched_sources(t.companies, t.companies.filter("id % 4 = 0"))


@register(cte("companies") + """
    SELECT CAST(pos AS BIGINT) AS request_pos, id, c.slug FROM companies c JOIN (VALUES (0, 'supplier-000000005'),
        (1, 'nobody'), (2, 'supplier-000000002')) r(pos, slug) ON r.slug = c.slug""")
def companies_by_slugs(t: Tables) -> DataFrame:
    found, _ = lookup.companies_by_slugs(
        t.companies, ["supplier-000000005", "nobody", "supplier-000000002"]
    )
    return found.select("request_pos", "id", "slug")


@register("""
    SELECT o_orderkey AS id, 'primary' AS origin FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'fallback' FROM orders WHERE o_orderstatus <> 'F'""")
def with_fallback(t: Tables) -> DataFrame:
    def part(rows: str, origin: str) -> DataFrame:
        return t.orders.filter(rows).select(
            F.col("o_orderkey").alias("id"), F.lit(origin).alias("origin")
        )

    failed = t.orders.groupBy("o_orderpriority").agg(F.lit("failed").alias("status"))
    fine = t.orders.groupBy("o_orderpriority").agg(F.lit("success").alias("status"))
    rows, _ = lookup.with_fallback(part("o_orderstatus = 'F'", "primary"), failed, part("o_orderstatus <> 'F'", "fallback"), fine)
    return rows


@register(cte("runs", "attempts") + """
    SELECT id, CASE WHEN id % 3 = 0 THEN 'failed' ELSE status END AS status,
           CASE WHEN id % 3 = 0 THEN 'note ' || CAST(id AS STRING) ELSE notes END AS notes,
           id % 3 = 0 AS matched FROM runs""")
def apply_row_updates(t: Tables) -> DataFrame:
    updates = t.runs.filter("id % 3 = 0").select(
        "id",
        F.lit("failed").alias("status"),
        F.concat(F.lit("note "), F.col("id").cast("string")).alias("notes"),
    )
    return merge.apply_row_updates(t.runs, updates).select("id", "status", "notes", "matched")


# --------------------------------------------------------------------------
# Roll-ups
# --------------------------------------------------------------------------


@register(cte("jobs", "companies", "runs", "attempts") + """
    SELECT (SELECT count(*) FROM jobs) AS total_jobs,
           (SELECT count(*) FROM jobs WHERE status = 'open') AS open_jobs,
           (SELECT count(*) FROM companies) AS total_companies,
           (SELECT count(*) FROM companies WHERE is_active) AS active_companies,
           (SELECT count(*) FROM runs) AS total_runs, r.id AS last_run_id,
           r.started_at AS last_run_started_at, r.status AS last_run_status,
           (SELECT CAST(sum(jobs_found) AS BIGINT) FROM attempts WHERE run_id = r.id) AS last_run_jobs_found
    FROM (SELECT * FROM runs ORDER BY started_at DESC LIMIT 1) r""")
def dashboard_stats(t: Tables) -> DataFrame:
    return rollups.dashboard_stats(t.jobs, t.companies, t.runs, t.attempts)


_SHORT_ATTEMPTS = (
    f"few AS (SELECT * REPLACE (run_id + CASE run_id % 5 WHEN 0 THEN {_APART} ELSE 0 END AS run_id) FROM attempts)"
)
_TOTALS = """
    SELECT r.id, r.status,
           round((epoch_us(r.finished_at) - epoch_us(r.started_at)) / 1000000.0, 6) AS duration_seconds,
           coalesce(CAST(sum(a.jobs_found) AS BIGINT), 0) AS jobs_found,
           coalesce(CAST(sum(a.new_jobs) AS BIGINT), 0) AS new_jobs,
           coalesce(CAST(sum(a.closed_jobs) AS BIGINT), 0) AS closed_jobs,
           count(*) FILTER (a.status = 'failed') AS failed
    FROM runs r LEFT JOIN few a ON a.run_id = r.id GROUP BY r.id, r.status, r.finished_at, r.started_at"""


def _totals(t: Tables) -> DataFrame:
    return rollups.run_totals(t.runs, _parted(t.attempts, "run_id", 5)).select(
        "id", "status", "duration_seconds", "jobs_found", "new_jobs", "closed_jobs", "failed"
    )


@register(cte("runs", "attempts") + f", {_SHORT_ATTEMPTS} {_TOTALS}")
def run_totals(t: Tables) -> DataFrame:
    return _totals(t)


@register(cte("runs", "attempts") + f""", {_SHORT_ATTEMPTS}
    SELECT id, CASE WHEN jobs_found > 0 THEN
        CAST(round((jobs_found - failed) / jobs_found * 100) AS BIGINT) END AS success_pct FROM ({_TOTALS})""")
def run_success_pct(t: Tables) -> DataFrame:
    return rollups.run_success_pct(_totals(t)).select("id", "success_pct")


_COMPANY_STATS = """
    SELECT c.id, c.name, coalesce(j.n, 0) AS total_jobs, coalesce(j.o, 0) AS open_jobs,
           coalesce(j.x, 0) AS closed_jobs, a.last_run_at
    FROM companies c
    LEFT JOIN (SELECT company_id, count(*) AS n, count(*) FILTER (status = 'open') AS o,
                      count(*) FILTER (status = 'closed') AS x FROM few GROUP BY 1) j ON j.company_id = c.id
    LEFT JOIN (SELECT company_id, max(started_at) AS last_run_at FROM attempts GROUP BY 1) a
           ON a.company_id = c.id"""


@register(cte("companies", "jobs", "attempts")
          + f", few AS (SELECT * REPLACE (company_id + CASE company_id % 7 WHEN 0 THEN {_APART} ELSE 0 END AS company_id)"
          " FROM jobs)" + _COMPANY_STATS)
def company_stats(t: Tables) -> DataFrame:
    stats = rollups.company_stats(t.companies, _parted(t.jobs, "company_id", 7), t.attempts)
    return stats.select("id", "name", "total_jobs", "open_jobs", "closed_jobs", "last_run_at")


@register(cte("attempts") + """
    SELECT count(*) AS total_adapters, count(*) FILTER (status = 'success') AS successful,
           count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed,
           CAST(0 AS BIGINT) AS skipped, CAST(sum(jobs_found) AS BIGINT) AS total_jobs_found,
           CAST(sum(pages_fetched) AS BIGINT) AS total_pages_fetched,
           CAST(sum(requests_made) AS BIGINT) AS total_requests_made,
           CAST(sum(CASE WHEN warnings IS NULL THEN 0 ELSE 2 END) AS BIGINT) AS total_warnings,
           CAST(sum((epoch_us(finished_at) - epoch_us(started_at)) // 1000) AS BIGINT) AS total_duration_ms
    FROM attempts""")
def aggregate_sources(t: Tables) -> DataFrame:
    return rollups.aggregate_sources(t.attempts.withColumn("warnings", F.split("warnings", "; ")))


@register(cte("attempts") + """
    SELECT CAST(sum(jobs_found) AS BIGINT) AS total_found, CAST(sum(new_jobs) AS BIGINT) AS total_new,
           CAST(sum(closed_jobs) AS BIGINT) AS total_closed, count(error_type) AS errors FROM attempts""")
def pipeline_totals(t: Tables) -> DataFrame:
    return rollups.pipeline_totals(t.attempts)


@register(cte("attempts") + """
    SELECT company_id, CAST(code AS BIGINT) AS exit_code,
           CASE code WHEN 2 THEN 'failed' WHEN 1 THEN 'partial' ELSE 'success' END AS run_status
    FROM (SELECT company_id, CASE WHEN count(*) FILTER (status = 'failed') = count(*) THEN 2
                 WHEN count(*) FILTER (status IN ('failed', 'partial')) > 0 THEN 1 ELSE 0 END AS code
          FROM attempts GROUP BY company_id)""")
def overall_status(t: Tables) -> DataFrame:
    return rollups.overall_status(t.attempts, ["company_id"])


@register(cte("attempts") + """
    SELECT count(*) AS total_runs, CAST(sum(f) AS BIGINT) AS total_jobs_found,
           CAST(floor(sum(d) / count(*)) AS BIGINT) AS avg_duration_ms,
           round(avg(s / n * 100), 6) AS avg_success_rate
    FROM (SELECT run_id, sum(jobs_found) AS f, count(*) AS n, count(*) FILTER (status = 'success') AS s,
                 sum((epoch_us(finished_at) - epoch_us(started_at)) // 1000) AS d
          FROM attempts GROUP BY run_id)""")
def metrics_summary(t: Tables) -> DataFrame:
    per_run = t.attempts.groupBy("run_id").agg(
        F.sum("jobs_found").alias("jobs_found"),
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.sum(dates.duration_ms(F.col("started_at"), F.col("finished_at"))).alias("duration_ms"),
    )
    return rollups.metrics_summary(per_run)


@register(cte("snapshots") + """
    SELECT selector, count(*) AS total_snapshots, round(avg(match_count), 6) AS avg_match_count,
           min(match_count) AS min_match_count, max(match_count) AS max_match_count,
           round(CASE WHEN avg(match_count) > 0
                THEN least(1.0, stddev_pop(match_count) / greatest(avg(match_count), 1.0)) ELSE 0.0 END, 6)
                AS drift_score,
           min(match_count) >= 1 AS is_healthy
    FROM (SELECT * FROM snapshots QUALIFY
          row_number() OVER (PARTITION BY selector ORDER BY ts DESC, id DESC) <= 10)
    GROUP BY selector""")
def selector_health(t: Tables) -> DataFrame:
    return drift.selector_health(t.snapshots)


_ATTEMPT_ROWS = """, good AS (SELECT * FROM raw_rows WHERE company_id > 0),
    parts AS (
        SELECT company_id, 1 AS f, 0 AS r, 0 AS d, 0 AS n, 0 AS x, 0 AS o FROM records
        UNION ALL SELECT company_id, 0, 1, 0, 0, 0, 0 FROM raw_rows WHERE date_posted = 'soon'
        UNION ALL SELECT company_id, 0, 0, 1, 0, 0, 0 FROM ranked WHERE rn > 1
        UNION ALL SELECT company_id, 0, 0, 0, CASE op WHEN 'created' THEN 1 ELSE 0 END, 0, 0
                  FROM (""" + _MERGED + """)
        UNION ALL SELECT company_id, 0, 0, 0, 0, CASE WHEN change = 'closed' THEN 1 ELSE 0 END,
                  CASE WHEN change = 'reopened' THEN 1 ELSE 0 END FROM changed),
    sums AS (SELECT company_id, CAST(sum(f) AS BIGINT) AS jobs_found, CAST(sum(r) AS BIGINT) AS records_rejected,
                    CAST(sum(d) AS BIGINT) AS d, CAST(sum(n) AS BIGINT) AS new_jobs,
                    CAST(sum(x) AS BIGINT) AS closed_jobs, CAST(sum(o) AS BIGINT) AS reopened_jobs
             FROM parts GROUP BY company_id)
    SELECT company_id, jobs_found, records_rejected, new_jobs, closed_jobs, reopened_jobs,
           nullif(concat_ws('; ', CASE WHEN records_rejected > 0
                    THEN CAST(records_rejected AS STRING) || ' records failed transformation' END,
                CASE WHEN d > 0 THEN CAST(d AS STRING) || ' duplicates removed' END), '') AS warnings
    FROM sums"""


@register(_reconciled_sql(_TRUSTED, 2) + ", " + cte("records", "raw_rows")[5:]
          + _RANKED[len(cte("records")):] + _ATTEMPT_ROWS)
def attempt_rows(t: Tables) -> DataFrame:
    records = t.records.drop("price")
    seen = identity.seen_urls(t.incoming)
    return rollups.attempt_rows(
        records,
        t.raw_rows.filter("date_posted = 'soon'"),
        identity.duplicates(records),
        merge.upsert_jobs(t.jobs, identity.dedupe(t.incoming), now()),
        reconcile.reconcile(t.jobs, seen, _last_attempts(t), now()),
    )


_EXTRACTED = cte("fetch_log") + """,
    pages_read AS (SELECT source, family, page_no, count(*) AS requests,
                     arg_max(struct_pack(c := status_code, k := content_type, e := error_type, n := n_jobs), attempt) AS v
              FROM fetch_log GROUP BY source, family, page_no),
    judged AS (SELECT *, v.e IS NOT NULL OR v.c >= 400
                      OR (family = 'html' AND v.k NOT LIKE '%text/html%') AS bad FROM pages_read),
    stops AS (SELECT source, arg_min(struct_pack(p := page_no, v := v), page_no) AS s FROM judged WHERE bad
              GROUP BY source),
    sums AS (SELECT j.source, j.family, any_value(s.s) AS s,
                    coalesce(CAST(sum(CASE WHEN NOT bad THEN j.v.n END) AS BIGINT), 0) AS jobs_found,
                    count(*) FILTER (NOT bad) AS pages_fetched, CAST(sum(requests) AS BIGINT) AS requests_made,
                    min(page_no) AS low, max(page_no) AS high, count(*) AS n
             FROM judged j LEFT JOIN stops s ON s.source = j.source
             WHERE s.source IS NULL OR j.page_no <= s.s.p GROUP BY j.source, j.family),
    told AS (SELECT *, CAST(s.p AS STRING) AS p,
                    CASE WHEN s.v.c IN (401, 403) THEN CASE family WHEN 'api' THEN 'Authentication failed: '
                              ELSE 'Access denied: ' END || CAST(s.v.c AS STRING) END AS error
             FROM sums),
    warned AS (SELECT *, CASE WHEN s IS NULL OR error IS NOT NULL THEN NULL
                    WHEN s.v.c = 429 THEN 'Rate limited on page ' || p || ', continuing with partial data'
                    WHEN s.v.c >= 400 THEN 'HTTP error on page ' || p || ': ' || CAST(s.v.c AS STRING)
                    WHEN s.v.e LIKE 'challenge%' THEN 'Anti-bot challenge on page ' || p || ': title'
                    WHEN s.v.e LIKE '%timeout%' THEN 'Timeout on page ' || p
                    ELSE 'Page ' || p || ' returned non-HTML content: ' || s.v.k END AS warning FROM told),
    outcomes_per_source AS (
    SELECT source, family, CASE WHEN error IS NOT NULL THEN 'failed'
               WHEN family = 'browser' THEN CASE WHEN warning IS NULL THEN 'success' WHEN jobs_found > 0 THEN 'partial'
                    WHEN lower(warning) LIKE '%challenge%' THEN 'failed' ELSE 'partial' END
               WHEN jobs_found = 0 AND warning IS NOT NULL THEN 'failed'
               WHEN jobs_found = 0 AND family = 'html' THEN 'partial' ELSE 'success' END AS status,
           error, warning, jobs_found, pages_fetched, requests_made,
           s IS NULL AND low = 1 AND high = n AS complete
    FROM warned)"""


@register(_EXTRACTED + " SELECT * FROM outcomes_per_source")
def classify_extraction(t: Tables) -> DataFrame:
    return extraction.classify_extraction(t.fetch_log).drop("n_warnings")


@register(_EXTRACTED + """
    SELECT source, jobs_found, CASE WHEN jobs_found > 0 THEN NULL
        WHEN coalesce(lower(warning) LIKE '%challenge%', false) THEN 'anti_bot'
        WHEN pages_fetched > 0 AND (warning IS NOT NULL OR error IS NOT NULL) THEN 'parse_error'
        WHEN complete AND warning IS NULL AND error IS NULL THEN 'true_empty'
        ELSE 'unverified_empty' END AS zero_class FROM outcomes_per_source""")
def classify_zero_result(t: Tables) -> DataFrame:
    outcomes = extraction.classify_extraction(t.fetch_log)
    return extraction.classify_zero_result(outcomes).select("source", "jobs_found", "zero_class")


@register(_EXTRACTED + """
    SELECT source, jobs_found, CASE WHEN warning IS NULL THEN CAST(0 AS BIGINT) ELSE 1 END AS n_warnings,
           CASE WHEN error IS NOT NULL THEN 'partial' ELSE 'success' END AS status FROM outcomes_per_source""")
def dry_run_counts(t: Tables) -> DataFrame:
    return extraction.dry_run_counts(extraction.classify_extraction(t.fetch_log))


@register(cte("attempts", "companies") + """
    SELECT a.id, a.company_id, a.jobs_found, CASE WHEN a.jobs_found < 2 + c.id % 10 THEN 'below' ELSE 'above' END
        AS verdict
    FROM attempts a JOIN companies c ON c.id = a.company_id
    WHERE a.jobs_found < 2 + c.id % 10 OR a.jobs_found > 100 + c.id % 50""")
def expected_range_check(t: Tables) -> DataFrame:
    expected = t.companies.select(
        F.col("id").alias("company_id"),
        (F.col("id") % 10 + 2).alias("expected_min"),
        (F.col("id") % 50 + 100).alias("expected_max"),
    )
    return rollups.expected_range_check(t.attempts, expected).select(
        "id", "company_id", "jobs_found", "verdict"
    )


@register(cte("runs", "attempts", "companies") + f""", few AS (SELECT * FROM attempts),
    totals AS ({_TOTALS})
    SELECT t.id AS run_id, t.jobs_found AS run_jobs_found, a.id AS attempt_id, a.company_name,
           a.duration_seconds
    FROM totals t, ({_ATTEMPT_NAMES} WHERE a.run_id = 9) a WHERE t.id = 9""")
def run_detail(t: Tables) -> DataFrame:
    detail = rollups.run_detail(t.runs, t.attempts, t.companies, 9)
    run = detail.run.select(F.col("id").alias("run_id"), F.col("jobs_found").alias("run_jobs_found"))
    attempts = detail.attempts.select(
        "run_id", F.col("id").alias("attempt_id"), "company_name", "duration_seconds"
    )
    return attempts.join(run, "run_id")


@register(cte("companies", "jobs", "attempts") + f""", few AS (SELECT * FROM jobs)
    SELECT s.id, s.total_jobs, s.open_jobs, s.closed_jobs, s.last_run_at, a.id AS attempt_id
    FROM ({_COMPANY_STATS}) s, (SELECT id FROM attempts WHERE company_id = 4
                                ORDER BY started_at DESC, id DESC LIMIT 10) a WHERE s.id = 4""")
def company_detail(t: Tables) -> DataFrame:
    detail = rollups.company_detail(t.companies, t.jobs, t.attempts, "supplier-000000003")
    company = detail.company.select("id", "total_jobs", "open_jobs", "closed_jobs", "last_run_at")
    attempts = detail.attempts.select(F.col("company_id").alias("id"), F.col("id").alias("attempt_id"))
    return company.join(attempts, "id")


# --------------------------------------------------------------------------
# Detectors and windows
# --------------------------------------------------------------------------

_COUNT_HISTORY = cte("counts") + """, w AS (
    SELECT *, avg(job_count) OVER last10 AS average, count(*) OVER last10 AS n,
           lag(job_count, 1) OVER o AS b, lag(job_count, 2) OVER o AS a
    FROM counts WINDOW o AS (PARTITION BY source ORDER BY ts, id),
        last10 AS (PARTITION BY source ORDER BY ts, id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""
_FALLING = "(a > b AND b > job_count AND job_count < average * 0.5)"


@register(_COUNT_HISTORY + f"""
    SELECT source, ts AS detected_at, job_count AS current_count, round(average, 6) AS average_count,
           CASE WHEN a > b AND b > job_count THEN 'decreasing' WHEN a < b AND b < job_count THEN 'increasing'
                ELSE 'stable' END AS trend
    FROM w WHERE job_count = 0 AND average > 1""")
def detect_zero_jobs(t: Tables) -> DataFrame:
    return detectors.detect_zero_jobs(t.counts).select(
        "source", "detected_at", "current_count", "average_count", "trend"
    )


@register(_COUNT_HISTORY + f"""
    SELECT source, ts AS detected_at, job_count AS current_count, round(average, 6) AS average_count
    FROM w WHERE NOT (job_count = 0 AND average > 1) AND {_FALLING}""")
def detect_suspicious_drop(t: Tables) -> DataFrame:
    return detectors.detect_suspicious_drop(t.counts).select(
        "source", "detected_at", "current_count", "average_count"
    )


@register(_COUNT_HISTORY + f"""
    SELECT source, CASE WHEN job_count = 0 AND average > 1 THEN 'zero_jobs' ELSE 'suspicious_count' END AS type,
           job_count AS current_count
    FROM (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY source ORDER BY ts DESC, id DESC) = 1)
    WHERE (job_count = 0 AND average > 1) OR {_FALLING}""")
def latest_count_anomalies(t: Tables) -> DataFrame:
    found = detectors.detect_count_anomalies(t.counts, latest_only=True)
    return found.select("source", "type", "current_count")


@register(cte("timeouts") + """
    SELECT t.id AS event_id, t.ts AS detected_at, count(*) AS timeout_count,
           array_to_string(list_sort(list(DISTINCT e.source)), ', ') AS source
    FROM timeouts t JOIN timeouts e
      ON e.ts > t.ts - INTERVAL '7200' SECOND AND e.ts <= t.ts
    GROUP BY t.id, t.ts HAVING count(*) >= 3""")
def detect_timeout_pattern(t: Tables) -> DataFrame:
    found = detectors.detect_timeout_pattern(t.timeouts, window_s=7200)
    return found.select("event_id", "detected_at", "timeout_count", "source")


_STRETCHES = cte("timeouts") + """, seen AS (
    SELECT t.ts, min(t.id) AS event_id, count(*) AS arrivals FROM timeouts t GROUP BY t.ts),
    stretches AS (
    SELECT s.ts, s.event_id, count(*) AS timeout_count, count(DISTINCT e.source) AS n_sources
    FROM seen s JOIN timeouts e ON e.ts > s.ts - INTERVAL '7200' SECOND AND e.ts <= s.ts
    GROUP BY s.ts, s.event_id, s.arrivals HAVING count(*) >= 3 AND count(*) - s.arrivals < 3)"""


@register(_STRETCHES + " SELECT ts AS detected_at, event_id, timeout_count, n_sources FROM stretches")
def timeout_stretches(t: Tables) -> DataFrame:
    return detectors.timeout_stretches(t.timeouts, window_s=7200)


@register(_STRETCHES + """
    SELECT DISTINCT s.ts AS detected_at, s.event_id, e.source
    FROM stretches s JOIN timeouts e ON e.ts > s.ts - INTERVAL '7200' SECOND AND e.ts <= s.ts
    WHERE e.source IS NOT NULL""")
def timeout_stretch_sources(t: Tables) -> DataFrame:
    return detectors.stretch_sources(t.timeouts, window_s=7200)


_DRIFT = cte("snapshots") + """, w AS (
    SELECT *, list(match_count) OVER (PARTITION BY selector ORDER BY ts, id
                                      ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h,
           avg(match_count) OVER (PARTITION BY selector ORDER BY ts, id
                                  ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS average,
           lag(match_count) OVER (PARTITION BY selector ORDER BY ts, id) AS previous
    FROM snapshots),
    v AS (SELECT *, abs(match_count - average) / greatest(average, 1.0) AS d,
                 coalesce(list_position(list_transform(list_reverse(h), lambda x: x <> 0), true) - 1, len(h)) AS z
          FROM w WHERE len(h) >= 2)"""


@register(_DRIFT + """
    SELECT selector, ts, match_count AS actual_count,
           CASE WHEN z >= 2 THEN 'critical' ELSE 'warning' END AS severity,
           'Selector ''' || selector || ''' returned 0 matches (' || CAST(z AS STRING)
               || ' consecutive). Expected at least 1.' AS message
    FROM v WHERE match_count = 0""")
def drift_zero_matches(t: Tables) -> DataFrame:
    return drift.drift_zero_matches(t.snapshots).select(
        "selector", "ts", "actual_count", "severity", "message"
    )


@register(_DRIFT + """
    SELECT selector, ts, match_count AS actual_count, CASE WHEN d < 1 THEN 'warning' ELSE 'error' END AS severity
    FROM v WHERE len(h) >= 3 AND average <> 0 AND d >= 0.5 AND match_count < 1""")
def drift_average(t: Tables) -> DataFrame:
    return drift.drift_average(t.snapshots).select("selector", "ts", "actual_count", "severity")


@register(_DRIFT + """
    SELECT selector, ts, match_count AS actual_count, 'error' AS severity FROM v
    WHERE (previous - match_count) / greatest(previous, 1) > 0.8 AND match_count < 1 AND previous >= 1""")
def drift_sudden_drop(t: Tables) -> DataFrame:
    return drift.drift_sudden_drop(t.snapshots).select("selector", "ts", "actual_count", "severity")


# One step per outcome: the breaker's state is carried along each source.
@register(cte("requests") + """, w AS (
        SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY origin ORDER BY ts, id)) / 1000000.0 AS gap,
               count(*) OVER (PARTITION BY origin ORDER BY epoch_us(ts)
                              RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS n24,
               CASE family WHEN 'api' THEN 0.5 WHEN 'html' THEN 2.0 ELSE 3.0 END AS floor_s
        FROM requests)
    SELECT origin, id, n24 AS requests_24h, round(CAST(gap AS DOUBLE), 6) AS gap_seconds,
           coalesce(gap < floor_s, false) AS too_fast,
           family = 'browser' AND coalesce(gap < 5, false) AS breaks_browser_gap,
           family = 'browser' AND n24 > 100 AS over_quota FROM w""")
def pacing_audit(t: Tables) -> DataFrame:
    return pacing.pacing_audit(t.requests).select(
        "origin", "id", "requests_24h", "gap_seconds", "too_fast", "breaks_browser_gap", "over_quota"
    )


@register(f"""
    SELECT 'selector_drift' AS alert_type, severity, selector AS source, detail, ts FROM (
        SELECT selector, ts, CAST(match_count AS STRING) AS detail,
               CASE WHEN z >= 2 THEN 'critical' ELSE 'warning' END AS severity
        FROM ({_DRIFT} SELECT * FROM v WHERE match_count = 0))
    UNION ALL
    SELECT 'zero_jobs', 'critical', source, CAST(job_count AS STRING), ts
    FROM ({_COUNT_HISTORY} SELECT * FROM w WHERE job_count = 0 AND average > 1)
    UNION ALL
    SELECT 'scrape_failure', CASE status WHEN 'partial' THEN 'warning' ELSE 'error' END,
           CAST(company_id AS STRING),
           'Scraping failed' || CASE status WHEN 'partial' THEN ' (partial)' ELSE '' END || ': '
               || coalesce(error_message, ''), started_at
    FROM ({cte("attempts")} SELECT * FROM attempts WHERE status IN ('partial', 'failed'))
    UNION ALL SELECT alert_type, severity, source, NULL, ts FROM ({_FAULT_ALERTS})""")
def to_alerts(t: Tables) -> DataFrame:
    drifts = drift.drift_zero_matches(t.snapshots).withColumn("source", F.col("selector"))
    zeros = detectors.detect_zero_jobs(t.counts).withColumnRenamed("detected_at", "ts")
    failures = t.attempts.filter("status in ('partial', 'failed')").select(
        F.col("company_id").cast("string").alias("source"),
        F.col("started_at").alias("ts"),
        "error_message",
        (F.col("status") == "partial").alias("is_partial"),
    )
    table = alerts.to_alerts(
        alerts.drift_alerts(drifts),
        alerts.zero_job_alerts(zeros),
        alerts.failure_alerts(failures),
        _fault_alerts(t),
    )
    detail = F.coalesce(
        F.col("details")["actual_count"],
        F.col("details")["job_count"],
        F.when(F.col("alert_type") == "scrape_failure", F.col("message")),
    )
    return table.select("alert_type", "severity", "source", detail.alias("detail"), "ts")


@register(_DRIFT + """
    SELECT '[' || CASE WHEN z >= 2 THEN 'CRITICAL' ELSE 'WARNING' END || '] Selector Drift: Selector '''
           || selector || ''' returned 0 matches (' || CAST(z AS STRING) || ' consecutive). Expected at least 1.'
           || chr(10) || '  Selector: ' || selector || chr(10) || '  Expected: >= 1 matches' || chr(10)
           || '  Actual: 0 matches' || chr(10) || '  Time: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS text
    FROM v WHERE match_count = 0""")
def drift_text(t: Tables) -> DataFrame:
    return alerts.drift_text(drift.drift_zero_matches(t.snapshots)).select("text")


@register(cte("runs", "attempts") + """, j AS (
        SELECT r.id, coalesce(a.share, 0) AS share,
               (epoch_us(r.finished_at) - epoch_us(r.started_at)) / 1000000.0 AS secs
        FROM runs r LEFT JOIN (SELECT run_id, count(*) FILTER (status = 'failed') / count(*) AS share
                               FROM attempts GROUP BY 1) a ON a.run_id = r.id)
    SELECT id AS run_id, 'high_error_rate' AS rule, round(share, 6) AS failed_share FROM j WHERE share > 0.2
    UNION ALL SELECT id, 'slow_run', round(share, 6) FROM j WHERE secs > 86000""")
def run_alert_rules(t: Tables) -> DataFrame:
    fired = detectors.run_alert_rules(t.runs, t.attempts, max_failed_share=0.2, max_duration_s=86_000)
    return fired.select("run_id", "rule", "failed_share")


@register(cte("runs") + " SELECT id, started_at, status FROM runs ORDER BY started_at DESC LIMIT 1")
def latest_run(t: Tables) -> DataFrame:
    return ranking.latest_run(t.runs).select("id", "started_at", "status")


@register(cte("attempts") + f", {_LAST} SELECT id, company_id, started_at, status FROM last")
def last_attempt_per_company(t: Tables) -> DataFrame:
    return ranking.last_attempt_per_company(t.attempts).select("id", "company_id", "started_at", "status")


@register(cte("attempts") + """
    SELECT id, company_id, row_number() OVER (PARTITION BY company_id ORDER BY started_at DESC, id DESC) AS recency
    FROM attempts QUALIFY recency <= 10""")
def recent_attempts(t: Tables) -> DataFrame:
    return ranking.recent_attempts(t.attempts).select("id", "company_id", "recency")


@register(cte("attempts") + """
    SELECT company_id, count(*) AS failures, max(started_at) AS last_failed_at
    FROM (SELECT * FROM attempts QUALIFY
          row_number() OVER (PARTITION BY company_id ORDER BY started_at DESC, id DESC) <= 2)
    GROUP BY company_id HAVING bool_and(status = 'failed') AND count(*) = 2""")
def sources_to_disable(t: Tables) -> DataFrame:
    return ranking.sources_to_disable(t.attempts, 2)


# --------------------------------------------------------------------------
# Orderings, pages and exports
# --------------------------------------------------------------------------


def _page_sql(page: int, limit: int) -> str:
    return cte("jobs") + f"""
    SELECT id, date_posted, CAST({page} AS BIGINT) AS page, CAST({limit} AS BIGINT) AS page_limit,
           (SELECT count(*) FROM jobs) AS total_count,
           CAST(ceil((SELECT count(*) FROM jobs) / {limit}) AS BIGINT) AS total_pages
    FROM jobs ORDER BY date_posted DESC NULLS LAST, id LIMIT {limit} OFFSET {(page - 1) * limit}"""


#: Newest listings first, those without a date last.
_NEWEST = [ranking.By("date_posted", descending=True, nulls_last=True), ranking.By("id")]


@register(_page_sql(3, 25))
def paginate(t: Tables) -> DataFrame:
    rows = ranking.paginate(t.jobs, 3, 25, _NEWEST)
    return rows.select("id", "date_posted", "page", "page_limit", "total_count", "total_pages")


@register(_page_sql(40, 25))
def paginate_deep(t: Tables) -> DataFrame:
    rows = ranking.paginate(t.jobs, 40, 25, _NEWEST, top_k_limit=100)
    return rows.select("id", "date_posted", "page", "page_limit", "total_count", "total_pages")


@register(cte("jobs") + """
    SELECT id, title, CAST(7 AS BIGINT) AS page, (SELECT count(*) FROM jobs) AS total_count
    FROM jobs ORDER BY title DESC NULLS LAST, id LIMIT 40 OFFSET 240""")
def paginate_by_title(t: Tables) -> DataFrame:
    by_title = [ranking.By("title", descending=True, nulls_last=True), ranking.By("id")]
    return ranking.paginate(t.jobs, 7, 40, by_title, top_k_limit=100).select("id", "title", "page", "total_count")


@register(cte("jobs") + " SELECT id, date_posted FROM jobs ORDER BY date_posted DESC NULLS LAST, id")
def newest_jobs_first(t: Tables) -> DataFrame:
    return ranking.newest_jobs_first(t.jobs).select("id", "date_posted")


@register(cte("runs") + " SELECT id, started_at FROM runs ORDER BY started_at DESC, id DESC LIMIT 10")
def recent_runs(t: Tables) -> DataFrame:
    return ranking.recent_runs(t.runs).select("id", "started_at")


@register(cte("runs") + " SELECT id, started_at FROM runs WHERE status = 'running'")
def active_runs(t: Tables) -> DataFrame:
    return ranking.active_runs(t.runs).select("id", "started_at")


@register(cte("jobs") + " SELECT id, created_at FROM jobs WHERE company_id = 3 AND status = 'open'")
def jobs_by_company(t: Tables) -> DataFrame:
    return ranking.jobs_by_company(t.jobs, 3, "open").select("id", "created_at")


@register(cte("attempts") + " SELECT id, started_at FROM attempts WHERE run_id = 4")
def attempts_by_run(t: Tables) -> DataFrame:
    return ranking.attempts_by_run(t.attempts, 4).select("id", "started_at")


@register(cte("attempts") + " SELECT id, started_at FROM attempts WHERE company_id = 4")
def attempts_by_company(t: Tables) -> DataFrame:
    return ranking.attempts_by_company(t.attempts, 4).select("id", "started_at")


@register(cte("jobs", "companies") + f"""
    SELECT c.name AS company_name, j.title AS job_title, j.location, j.url AS job_url, j.canonical_url,
           coalesce({stamp("date_posted")} || '+00:00', '') AS date_posted, j.status,
           {stamp("first_seen_at")} || '+00:00' AS first_seen_at, {stamp("last_seen_at")} || '+00:00' AS last_seen_at
    FROM jobs j JOIN companies c ON c.id = j.company_id WHERE j.status <> 'closed'""")
def export_rows(t: Tables) -> DataFrame:
    return exports.export_rows(quality.export_filter(lookup.jobs_with_company(t.jobs, t.companies)))


@register(cte("jobs", "companies") + f"""
    SELECT c.name AS "Company name", j.title AS "Title job", j.url AS "Link job", {_SALARY_SQL} AS "Salary",
           j.location AS "Location", '' AS "Loại job", 'Chưa apply' AS "Status", DATE '2024-06-01' AS "Date",
           '' AS "Người Apply", '' AS "Kiểm tra", '' AS "Ghi chú", coalesce(title_vi, '') AS "Title job vietsub",
           '' AS "TN-visa", '' AS "Job Refer", '' AS "Foundation",
           CASE WHEN raw_data LIKE '%true%' OR raw_data LIKE '%Yes%' THEN 'Yes' ELSE '' END AS "Easy Apply",
           CASE WHEN v >= 250 THEN '250+' WHEN v >= 200 THEN '200+' WHEN v >= 150 THEN '150+' ELSE '' END
               AS "Salary bucket"
    FROM (SELECT *, TRY_CAST(regexp_extract(replace({_SALARY_SQL}, ',', ''), '[0-9]{{2,3}}') AS INT) AS v FROM jobs) j
    JOIN companies c ON c.id = j.company_id""")
def application_sheet(t: Tables) -> DataFrame:
    return exports.application_sheet(lookup.jobs_with_company(t.jobs, t.companies), "2024-06-01")


# --------------------------------------------------------------------------
# Streams, each run to the end of its input
# --------------------------------------------------------------------------


def _event_stream(t: Tables, derived: str) -> DataFrame:
    """A derived frame of the events table, read as a stream."""
    schema = t.events.schema
    source = t.spark.readStream.schema(schema).parquet(f"{t._folder}/events*.parquet")
    timed = source.withColumn("ts", F.col("ts").cast("timestamp"))
    # already cast, so that the stream keeps the column it puts a watermark on
    return t.spark.sql(DERIVED[derived].replace("CAST(ts AS TIMESTAMP)", "ts"), events=timed)


def _fed(t: Tables, derived: str, start) -> str:
    """Run a stream over all events, which arrive in three parts in time order, a batch each."""
    work = _work(t)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = t.events.agg(F.min(at), F.max(at)).first()
    cuts = [low + (high - low) * k // 3 for k in (1, 2)] if low is not None else [0, 0]
    for part in (at <= cuts[0], (at > cuts[0]) & (at <= cuts[1]), (at > cuts[1]) | at.isNull()):
        t.events.filter(part).write.mode("append").parquet(f"{work}/events")
        source = t.spark.readStream.schema(t.events.schema).parquet(f"{work}/events")
        timed = source.withColumn("ts", F.col("ts").cast("timestamp"))
        start(t.spark.sql(DERIVED[derived], events=timed), f"{work}/out", f"{work}/progress").awaitTermination()
    return f"{work}/out"


def _detected(t: Tables, derived: str, start) -> DataFrame:
    """Findings of a detecting stream that reads all events in three batches."""
    return streams.findings(t.spark, _fed(t, derived, start))


def _drain(t: Tables, stream: DataFrame) -> DataFrame:
    """Run a stream over all that is there and read back what it wrote."""
    work = f"{ensure_checkpoint_dir(t.spark)}/{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{work}/rows")
        .option("checkpointLocation", f"{work}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{work}/rows")


@register(cte("timeouts") + " SELECT DISTINCT source FROM timeouts")
def stream_dedupe(t: Tables) -> DataFrame:
    keyed = _event_stream(t, "timeouts").select(
        F.lit(1).alias("company_id"), F.col("source").alias("canonical_url"), "ts"
    )
    return _drain(t, streams.stream_dedupe(keyed, "ts", "60 days")).select(
        F.col("canonical_url").alias("source")
    )


# a source's timeouts less than an hour apart are one group; of each that the watermark has passed, the last event
@register(cte("timeouts") + """, marked AS (
        SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY source ORDER BY ts, id) >= 3600000000, true) AS fresh
        FROM timeouts WHERE ts IS NOT NULL),
    grouped AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY source ORDER BY ts, id) AS part FROM marked)
    SELECT source, max(id) AS last_event FROM grouped GROUP BY source, part
    HAVING max(epoch_us(ts)) + 3600000000 <= (SELECT max(epoch_us(ts)) FROM timeouts) - 3600000000""")
def stream_first(t: Tables) -> DataFrame:
    """Events in three batches; a group's row is not the one that arrives first."""

    def start(timeouts: DataFrame, path: str, checkpoint: str):
        keyed = timeouts.select(
            F.lit(1).alias("company_id"), F.col("source").alias("canonical_url"), "ts", "id",
            F.lit(1).alias("page_no"), (-F.col("id")).alias("pos"),
        )
        out = streams.stream_first(keyed, "ts", "1 hour", "1 hour").writeStream.format("parquet")
        out = out.option("path", f"{path}/rows").option("checkpointLocation", checkpoint)
        return out.trigger(availableNow=True).start()

    rows = t.spark.read.schema("canonical_url string, id bigint").parquet(f"{_fed(t, 'timeouts', start)}/rows")
    return rows.select(F.col("canonical_url").alias("source"), F.col("id").alias("last_event"))


# each batch merges as of its newest record; the last one to show a source decides its row
@register(cte("timeouts") + """, span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) - min(epoch_us(ts)) AS width FROM events),
    dealt AS (SELECT t.*, coalesce((epoch_us(t.ts) > lo + width // 3)::INT + (epoch_us(t.ts) > lo + width * 2 // 3)::INT, 2) AS batch
              FROM timeouts t, span),
    batches AS (SELECT batch, max(ts) AS newest FROM dealt GROUP BY batch),
    firsts AS (SELECT source, batch, arg_min(id, (ts, id)) AS id FROM dealt GROUP BY source, batch)
    SELECT source AS canonical_url, arg_max(id, batch) AS first_event, min(newest) AS first_seen_at, max(newest) AS last_seen_at
    FROM firsts JOIN batches USING (batch) GROUP BY source""")
def stream_upsert(t: Tables) -> DataFrame:
    text_null = F.lit(None).cast("string")

    def start(timeouts: DataFrame, path: str, checkpoint: str):
        records = timeouts.select(
            F.lit(1).cast("bigint").alias("company_id"),
            F.concat(F.lit("seen by "), "source").alias("title"),
            text_null.alias("title_vi"),
            F.lit("Remote").alias("location"),
            F.col("source").alias("url"),
            F.col("source").alias("canonical_url"),
            F.col("ts").alias("date_posted"),
            F.lit("open").alias("status"),
            F.col("id").cast("string").alias("source_job_id"),
            text_null.alias("salary_raw"),
            text_null.alias("raw_data"),
            F.unix_micros("ts").alias("page_no"),
            F.col("id").alias("pos"),
            F.col("ts").alias("seen_at"),
        )
        return streams.stream_upsert(records, f"{path}/jobs", checkpoint, buckets=8)

    return tables.read_table(t.spark, _fed(t, "timeouts", start), "jobs").select(
        "canonical_url", F.col("source_job_id").cast("bigint").alias("first_event"), "first_seen_at", "last_seen_at"
    )


@register(_COUNT_HISTORY + f"""
    SELECT source, id, job_count AS current_count, round(average, 6) AS average_count,
           CASE WHEN job_count = 0 AND average > 1 THEN 'zero_jobs' ELSE 'suspicious_count' END AS type
    FROM w WHERE (job_count = 0 AND average > 1) OR {_FALLING}""")
def stream_zero_jobs(t: Tables) -> DataFrame:
    found = _detected(t, "counts", streams.stream_zero_jobs)
    return found.select("source", "id", "current_count", "average_count", "type")


@register(_DRIFT + """
    SELECT selector, id, 'zero_matches' AS kind, CASE WHEN z >= 2 THEN 'critical' ELSE 'warning' END AS severity
    FROM v WHERE match_count = 0
    UNION ALL SELECT selector, id, 'average', CASE WHEN d < 1 THEN 'warning' ELSE 'error' END FROM v
    WHERE len(h) >= 3 AND average <> 0 AND d >= 0.5 AND match_count < 1
    UNION ALL SELECT selector, id, 'sudden_drop', 'error' FROM v
    WHERE (previous - match_count) / greatest(previous, 1) > 0.8 AND match_count < 1 AND previous >= 1""")
def stream_selector_drift(t: Tables) -> DataFrame:
    found = _detected(t, "snapshots", streams.stream_selector_drift)
    return found.select("selector", "id", "kind", "severity")


# windows are emitted once the watermark, an hour behind the last event, has passed them
@register(cte("timeouts") + """, w AS (
        SELECT source, (epoch_us(ts) // 3600000000 - k) * 3600 AS s FROM timeouts, (VALUES (0), (1)) v(k))
    SELECT make_timestamp(s * 1000000) AS window_start, make_timestamp((s + 7200) * 1000000) AS window_end,
           count(*) AS timeout_count, array_to_string(list_sort(list(DISTINCT source)), ', ') AS source
    FROM w GROUP BY s
    HAVING count(*) >= 3 AND (s + 7200) * 1000000 <= (SELECT max(epoch_us(ts)) FROM timeouts) - 3600000000""")
def stream_timeout_counts(t: Tables) -> DataFrame:
    return _drain(
        t,
        streams.stream_timeout_counts(
            _event_stream(t, "timeouts"), window_s=7200, slide_s=3600, watermark="1 hour"
        ),
    )


# --------------------------------------------------------------------------
# Known sources, whole runs and tables written and read back
# --------------------------------------------------------------------------


@register("""
    SELECT source, page_no, row_number() OVER (PARTITION BY page_no ORDER BY o_orderkey) - 1 AS pos, title,
           CASE WHEN o_orderkey % 3 <> 0 THEN 'City ' || CAST(o_custkey % 20 AS STRING)
                WHEN source = 'caloptima' THEN 'Orange County, CA'
                WHEN source = 'tiktok' THEN '' ELSE 'Remote' END AS location,
           CASE source WHEN 'techcorp' THEN 'https://www.techcorp.example/careers/' || k
                WHEN 'startupxyz' THEN 'https://startupxyz.example.com/jobs/' || k
                WHEN 'caloptima' THEN 'https://careers.pageuppeople.com/1150/job/x' || k || '?p=1'
                ELSE 'https://careers.tiktok.com/position/' || k END AS url,
           CASE source WHEN 'caloptima' THEN 'x' || k ELSE k END AS source_job_id
    FROM (SELECT *, CAST(o_orderkey AS STRING) AS k, o_orderpriority || ' & ' || o_orderstatus AS title,
                 CAST(floor(o_orderkey / 100) AS BIGINT) + 1 AS page_no,
                 CASE CAST(floor(o_orderkey / 100) AS BIGINT) % 4 WHEN 0 THEN 'techcorp' WHEN 1 THEN 'startupxyz'
                      WHEN 2 THEN 'caloptima' ELSE 'tiktok' END AS source
          FROM orders)""")
def extract_known_sources(t: Tables) -> DataFrame:
    rules = specs.default_catalog().rules(t.spark)
    rows = html.extract_listings(listing_pages(t.orders), rules)
    return rows.select("source", "page_no", "pos", "title", "location", "url", "source_job_id")


def _middle_page(t: Tables):
    return t.orders.agg(F.floor(F.max(F.floor(F.col("o_orderkey") / 100)) / 2) + 1).scalar()


def _fetched(t: Tables, truncated: bool = False, failing: bool = False) -> DataFrame:
    """Pages of one source that hold every order, with their number of listings, as fetched and kept.

    ``truncated``: the source states more listings than its pages hold;
    ``failing``: its middle page was refused.
    """
    pages_read = t.ats_pages("greenhouse").withColumn("source", F.lit("opswat"))
    if truncated:
        pages_read = pages_read.withColumn("body", F.regexp_replace("body", r'"total":(\d)', r'"total":1$1'))
    if failing:
        refused = F.col("page_no") == _middle_page(t)
        pages_read = pages_read.withColumn("status_code", F.when(refused, 429).otherwise(F.col("status_code")))
    return materialize(
        pages_read.withColumns(
            {
                "url": F.lit("u"),
                "content_type": F.lit("application/json"),
                "n_jobs": F.json_array_length(F.get_json_object("body", "$.jobs")),
            }
        )
    )


def _snapshot_run(t: Tables, fetched: DataFrame, over: str | None = None, run_id: int = 5) -> SnapshotResult:
    """A run over the fetched pages.

    ``over``: start from the listings stored there, instead of made-up older ones.
    """
    pages_read = fetched.drop("n_jobs")
    log = fetched.select(
        "source",
        F.lit("api").alias("family"),
        "page_no",
        F.lit(1).alias("attempt"),
        "status_code",
        "content_type",
        F.lit(None).cast("string").alias("error_type"),
        "n_jobs",
    )
    seed = companies.seed_frame(t.spark).filter("slug in ('opswat', 'vancity')")
    known = seed.withColumn("id", F.when(F.col("slug") == "opswat", F.lit(1)).otherwise(2).cast("bigint"))
    even = F.col("id") % 2 == 1
    key = (F.col("id") - 1).cast("string")
    stored = t.jobs.withColumns(
        {
            "company_id": F.lit(1).cast("bigint"),
            "canonical_url": F.concat(
                F.lit("https://jobs.example.com/"), F.when(even, "").otherwise("old-"), key
            ),
            "status": F.when(even, F.col("status")).otherwise("open"),
        }
    )
    base = None
    if over is not None:
        stored, base = tables.read_based(t.spark, over, "jobs")
    started, at = (F.lit(f"2024-06-{run_id - 4:02d} {hour}:00:00").cast("timestamp") for hour in (10, 12))
    at = now() if over is None else at
    return run_snapshot(pages_read, log, stored, known, specs.default_catalog(), run_id, started, at, base=base)


@register("""
    SELECT 'https://jobs.example.com/' || CAST(o_orderkey AS STRING) AS canonical_url, 'open' AS status,
           CAST(0 AS BIGINT) AS missing_count, CASE WHEN o_orderkey % 2 = 0 THEN 'updated' ELSE 'created' END AS op,
           o_orderpriority AS title
    FROM orders
    UNION ALL
    SELECT 'https://jobs.example.com/old-' || CAST(o_orderkey AS STRING),
           CASE WHEN o_orderkey % 3 + 1 >= 2 THEN 'closed' ELSE 'open' END, o_orderkey % 3 + 1, 'kept',
           o_orderpriority || ' role ' || CAST(o_orderkey % 50 AS STRING)
    FROM orders WHERE o_orderkey % 2 = 1""")
def snapshot_listings(t: Tables) -> DataFrame:
    return _snapshot_run(t, _fetched(t)).jobs.select("canonical_url", "status", "missing_count", "op", "title")


@register("""
    SELECT CAST(1 AS BIGINT) AS company_id, 'success' AS status, true AS complete, count(*) AS jobs_found,
           count(*) FILTER (o_orderkey % 2 = 1) AS new_jobs,
           count(*) FILTER (o_orderkey % 2 = 1 AND o_orderkey % 3 >= 1) AS closed_jobs,
           count(*) FILTER (o_orderkey % 2 = 0 AND o_orderstatus = 'F') AS reopened_jobs,
           CAST(count(DISTINCT floor(o_orderkey / 100)) AS BIGINT) AS pages_fetched
    FROM orders""")
def snapshot_attempts(t: Tables) -> DataFrame:
    return _snapshot_run(t, _fetched(t)).attempts.select(
        "company_id", "status", "complete", "jobs_found", "new_jobs", "closed_jobs", "reopened_jobs",
        "pages_fetched",
    )


_KEY = "'https://jobs.example.com/' || CAST(o_orderkey AS STRING)"
_STORED_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'unknown' END"


@register(f"""
    SELECT {_KEY} AS canonical_url, 'open' AS status, o_orderkey % 3 AS missing_count,
           'updated' AS op, false AS complete
    FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT {_KEY}, 'open', 0, 'created', false FROM orders WHERE o_orderkey % 2 = 1
    UNION ALL
    SELECT 'https://jobs.example.com/old-' || CAST(o_orderkey AS STRING), 'open', o_orderkey % 3, 'kept', false
    FROM orders WHERE o_orderkey % 2 = 1""")
def snapshot_truncated(t: Tables) -> DataFrame:
    """A crawl short of the stated total updates listings and closes none."""
    run = _snapshot_run(t, _fetched(t, truncated=True))
    complete = run.attempts.filter("company_id = 1").select("company_id", "complete")
    rows = run.jobs.join(F.broadcast(complete), "company_id")  # one row
    return rows.select("canonical_url", "status", "missing_count", "op", "complete")


@register(f"""
    WITH o AS (SELECT *, floor(o_orderkey / 100) < (SELECT floor(max(floor(o_orderkey / 100)) / 2) FROM orders) AS read
               FROM orders)
    SELECT {_KEY} AS canonical_url, CASE WHEN read THEN 'open' ELSE {_STORED_STATUS} END AS status,
           CASE WHEN read THEN 'updated' ELSE 'kept' END AS op
    FROM o WHERE o_orderkey % 2 = 0
    UNION ALL SELECT {_KEY}, 'open', 'created' FROM o WHERE o_orderkey % 2 = 1 AND read
    UNION ALL SELECT 'https://jobs.example.com/old-' || CAST(o_orderkey AS STRING), 'open', 'kept'
    FROM o WHERE o_orderkey % 2 = 1""")
def snapshot_failed_page(t: Tables) -> DataFrame:
    """Listings from the refused page on are neither read nor closed."""
    return _snapshot_run(t, _fetched(t, failing=True)).jobs.select("canonical_url", "status", "op")


def _stored_run(t: Tables) -> str:
    root = _work(t)
    started = F.lit("2024-06-01 10:00:00").cast("timestamp")
    store_run(_snapshot_run(t, _fetched(t)), root, 5, started, now())
    return root


@register("""
    SELECT 'https://jobs.example.com/' || CAST(o_orderkey AS STRING) AS canonical_url, 'open' AS status,
           CAST(0 AS BIGINT) AS missing_count
    FROM orders
    UNION ALL
    SELECT 'https://jobs.example.com/old-' || CAST(o_orderkey AS STRING),
           CASE WHEN o_orderkey % 3 + 1 >= 2 THEN 'closed' ELSE 'open' END, o_orderkey % 3 + 1
    FROM orders WHERE o_orderkey % 2 = 1""")
def stored_run_jobs(t: Tables) -> DataFrame:
    return tables.read_table(t.spark, _stored_run(t), "jobs").select("canonical_url", "status", "missing_count")


@register("""
    SELECT 'https://jobs.example.com/' || CAST(o_orderkey AS STRING) AS canonical_url, 'open' AS status,
           CAST(0 AS BIGINT) AS missing_count
    FROM orders
    UNION ALL
    SELECT 'https://jobs.example.com/old-' || CAST(o_orderkey AS STRING), 'closed', greatest(o_orderkey % 3 + 1, 2)
    FROM orders WHERE o_orderkey % 2 = 1""")
def stored_runs_in_turn(t: Tables) -> DataFrame:
    """Two runs, the second over what the first stored; storing the first again changes nothing."""
    root, started = _work(t), F.lit("2024-06-01 10:00:00").cast("timestamp")
    fetched = _fetched(t)
    first = _snapshot_run(t, fetched)
    store_run(first, root, 5, started, now())
    store_run(_snapshot_run(t, fetched, over=root, run_id=6), root, 6, started, now())
    store_run(first, root, 5, started, now())
    return tables.read_table(t.spark, root, "jobs").select("canonical_url", "status", "missing_count")


@register("""
    SELECT CAST(5 AS BIGINT) AS run_id, CAST(1 AS BIGINT) AS company_id, 'success' AS status, 'success' AS run_status,
           count(*) AS jobs_found, count(*) FILTER (o_orderkey % 2 = 1) AS new_jobs,
           count(*) FILTER (o_orderkey % 2 = 1 AND o_orderkey % 3 >= 1) AS closed_jobs
    FROM orders""")
def stored_run_attempts(t: Tables) -> DataFrame:
    root = _stored_run(t)
    runs = tables.read_table(t.spark, root, "runs").select(F.col("id").alias("run_id"), F.col("status").alias("run_status"))
    rows = tables.read_table(t.spark, root, "attempts").join(runs, "run_id")
    return rows.select("run_id", "company_id", "status", "run_status", "jobs_found", "new_jobs", "closed_jobs")


@register(cte("attempts") + f""", counted AS (
        SELECT company_id, started_at, jobs_found,
               avg(jobs_found) OVER (PARTITION BY company_id ORDER BY started_at, id
                                     ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS average
        FROM attempts WHERE status <> 'failed'),
    off AS (SELECT company_id FROM (SELECT * FROM attempts QUALIFY
                row_number() OVER (PARTITION BY company_id ORDER BY started_at DESC, id DESC) <= 2)
            GROUP BY company_id HAVING bool_and(status = 'failed') AND count(*) = 2)
    SELECT alert_type, severity, CAST(company_id AS STRING) AS source, ts, company_id IN (FROM off) AS disable FROM (
        SELECT 'zero_jobs' AS alert_type, 'critical' AS severity, company_id, started_at AS ts
        FROM counted WHERE jobs_found = 0 AND average > 1
        UNION ALL SELECT 'scrape_failure', CASE status WHEN 'partial' THEN 'warning' ELSE 'error' END, company_id,
                         started_at FROM attempts WHERE status IN ('partial', 'failed'))""")
def monitoring_alerts(t: Tables) -> DataFrame:
    return monitor(t.attempts, t.runs, 2).alerts.select("alert_type", "severity", "source", "ts", "disable")


@register(cte("snapshots") + """, w AS (
        SELECT selector, 'src-' || CAST(id % 3 AS STRING) AS source, id, ts, match_count FROM snapshots),
    h AS (SELECT *, list(match_count) OVER (PARTITION BY source, selector ORDER BY ts, id
                                            ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h,
                 avg(match_count) OVER (PARTITION BY source, selector ORDER BY ts, id
                                        ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS average,
                 lag(match_count) OVER (PARTITION BY source, selector ORDER BY ts, id) AS previous FROM w),
    v AS (SELECT *, abs(match_count - average) / greatest(average, 1.0) AS d,
                 coalesce(list_position(list_transform(list_reverse(h), lambda x: x <> 0), true) - 1, len(h)) AS z
          FROM h WHERE len(h) >= 2)
    SELECT source, selector, ts, CASE WHEN z >= 2 THEN 'critical' ELSE 'warning' END AS severity FROM v WHERE match_count = 0
    UNION ALL SELECT source, selector, ts, CASE WHEN d < 1 THEN 'warning' ELSE 'error' END FROM v
    WHERE len(h) >= 3 AND average <> 0 AND d >= 0.5 AND match_count < 1
    UNION ALL SELECT source, selector, ts, 'error' FROM v
    WHERE (previous - match_count) / greatest(previous, 1) > 0.8 AND match_count < 1 AND previous >= 1""")
def monitoring_drift_alerts(t: Tables) -> DataFrame:
    """Drift alerts of the monitoring plan; each selector has a history in every source."""
    snapshots = t.snapshots.withColumn("source", F.concat(F.lit("src-"), (F.col("id") % 3).cast("string")))
    told = monitor(t.attempts, t.runs, 2, snapshots).alerts.filter("alert_type = 'selector_drift'")
    return told.select("source", F.col("details")["selector"].alias("selector"), "ts", "severity")


_BODY_PAGES = """
    SELECT 'site-' || CAST(page_id % 10 AS STRING) AS source, CAST(floor(page_id / 10) AS INT) + 1 AS page_no, url,
           200 AS status_code, 'text/html' AS content_type, html AS body, CAST(NULL AS TIMESTAMP) AS fetched_at
    FROM {pages}"""


@register("""
    SELECT layout, 'site-' || CAST(page_id % 10 AS STRING) AS source, CAST(floor(page_id / 10) AS BIGINT) + 1 AS page_no,
           CAST(length(html) AS BIGINT) AS n_chars
    FROM pages, (VALUES ('parquet'), ('json'), ('orc')) AS l(layout)""")
def read_pages(t: Tables) -> DataFrame:
    """All pages, written in each layout and read by the page readers."""
    out = None
    for layout, read in (("parquet", pages.read_html_pages), ("json", pages.read_api_pages), ("orc", pages.read_html_pages)):
        root = _work(t)
        t.sql(_BODY_PAGES).write.format(layout).save(root)
        rows = read(t.spark, root, layout)
        text_of = "body" if "body" in rows.columns else "html"
        rows = rows.select(F.lit(layout).alias("layout"), "source", "page_no", F.length(text_of).alias("n_chars"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("""
    SELECT 'site-' || CAST(page_id % 10 AS STRING) AS source, CAST(floor(page_id / 10) AS BIGINT) + 1 AS page_no,
           CAST(length(html) AS BIGINT) AS n_chars, CAST(NULL AS STRING) AS reason
    FROM pages WHERE page_id % 9 NOT IN (4, 7)
    UNION ALL SELECT NULL, NULL, NULL, 'Row could not be read' FROM pages WHERE page_id % 9 IN (4, 7)""")
def read_checked_pages(t: Tables) -> DataFrame:
    """All pages as JSON lines, some cut in half and some with a word for a number: good rows and named rejects."""
    root = _work(t)
    rows = t.sql(_BODY_PAGES)
    number = F.regexp_extract("source", r"(\d+)", 1).cast("bigint") + (F.col("page_no") - 1) * 10
    line = F.to_json(F.struct(*rows.columns))
    line = F.when(number % 9 == 4, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))).when(
        number % 9 == 7, F.regexp_replace(line, '"status_code":200', '"status_code":"soon"')
    ).otherwise(line)
    rows.select(line.alias("value")).write.text(root)
    read = pages.read_checked_pages(t.spark, root, "json")
    good = read.pages.select("source", "page_no", F.length("body").alias("n_chars"), F.lit(None).cast("string").alias("reason"))
    blank = [F.lit(None).cast(field.dataType).alias(field.name) for field in good.schema.fields[:3]]
    return good.unionByName(read.rejects.select(*blank, "reason"))


@register("""
    SELECT 'p' || CAST(page_id AS STRING) AS source, CAST(page_id % 7 AS BIGINT) AS page_no,
           CAST(length(html) AS BIGINT) + 1 AS n_chars  -- the writer ends each file with a line end
    FROM pages WHERE length(html) > 0""")
def read_page_files(t: Tables) -> DataFrame:
    """All pages, one text file each, read by path."""
    root = _work(t)
    named = t.pages.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("s"), (F.col("page_id") % 7).alias("n"), "html"
    )
    named = spread.fill_cores(named.filter("length(html) > 0"), ["s"])
    write_page_files(named, root, ["s", "n"], "html")
    read = pages.read_page_files(t.spark, root, r"/s=([^/]+)[/,]n=(\d+)[/.]")
    return read.select("source", "page_no", F.length("body").alias("n_chars"))


def _work(t: Tables) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/{uuid.uuid4().hex}"


@register(cte("jobs") + """
    SELECT id, company_id, status, date_posted FROM jobs WHERE status = 'open' AND company_id < 20""")
def published_table(t: Tables) -> DataFrame:
    root = _work(t)
    sinks.write_snapshot(t.jobs.filter("false"), f"{root}/jobs")
    sinks.write_snapshot(t.jobs, f"{root}/jobs")
    rows = tables.read_table(t.spark, root, "jobs")
    return rows.filter("status = 'open' and company_id < 20").select("id", "company_id", "status", "date_posted")


_MERGED = cte("jobs", "companies", "attempts") + """, merged AS (
        SELECT company_id, CASE WHEN id % 2 = 0 THEN 'closed' ELSE status END AS status
        FROM jobs WHERE id % 3 <> 0 OR id % 2 = 0)"""


def _merged_jobs(t: Tables) -> str:
    """Listings merged in three batches, of which the second closes what the first brought or not."""
    work = f"{_work(t)}/jobs"
    records = t.jobs.withColumns({"page_no": F.lit(1), "pos": F.col("id")})
    batches = (records.filter("id % 3 <> 0"), records.filter("id % 2 = 0").withColumn("status", F.lit("closed")),
               records.filter("id % 3 = 1 and id % 2 = 1"))
    for number, batch in enumerate(batches):
        merge_listings(batch, work, now(), "batches", number, buckets=8)
    return work


@register(_MERGED + """
    SELECT c.id, c.slug, coalesce(total_jobs, 0) AS total_jobs, coalesce(open_jobs, 0) AS open_jobs,
           coalesce(closed_jobs, 0) AS closed_jobs
    FROM companies c LEFT JOIN (
        SELECT company_id, count(*) AS total_jobs, count(*) FILTER (status = 'open') AS open_jobs,
               count(*) FILTER (status = 'closed') AS closed_jobs FROM merged GROUP BY company_id) m ON m.company_id = c.id""")
def company_stats_from_merges(t: Tables) -> DataFrame:
    """Listing counts moved along by three merges, equal to a full recount."""
    counts = stored_counts(t.spark, _merged_jobs(t))
    stats = rollups.company_stats_of(t.companies, counts, t.attempts)
    return stats.select("id", "slug", "total_jobs", "open_jobs", "closed_jobs")


@register(cte("attempts") + " SELECT id, run_id, status FROM attempts")
def appended_rows(t: Tables) -> DataFrame:
    root = _work(t)
    for part in (0, 1):
        sinks.append_rows(t.attempts.filter(f"id % 2 = {part}"), f"{root}/attempts")
    return tables.read_table(t.spark, root, "attempts").select("id", "run_id", "status")


@register(cte("raw_rows") + """
    SELECT r AS run_id, page_no, stage FROM (VALUES (1), (2)) AS v(r), (
        SELECT page_no, 'validate' AS stage FROM raw_rows
        WHERE trim(source) = '' OR trim(title) = '' OR NOT regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')
        UNION ALL SELECT page_no, 'transform' FROM raw_rows
        WHERE company_id <= 0 OR trim(title) = '' OR date_posted = 'soon'
           OR NOT regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]'))""")
def rejects_table(t: Tables) -> DataFrame:
    root = _work(t)
    _, skipped = quality.split_by(quality.validate_raw(t.raw_rows), "skip_reasons")
    _, rejected = quality.split_by(quality.to_records(t.raw_rows), "reject_reasons")
    for run in (1, 2):
        sinks.write_rejects(skipped.select("page_no", F.col("skip_reasons").alias("reasons")), root, "validate", run)
        sinks.write_rejects(rejected.select("page_no", F.col("reject_reasons").alias("reasons")), root, "transform", run)
    read = t.spark.read.schema("page_no bigint, reasons array<string>, run_id int, stage string").parquet(root)
    return read.select("run_id", "page_no", "stage")


@register(SQL["export_rows"])
def csv_export(t: Tables) -> DataFrame:
    root = _work(t)
    rows = exports.export_rows(quality.export_filter(lookup.jobs_with_company(t.jobs, t.companies)))
    exports.export_csv(rows, f"{root}/export")
    return exports.read_csv(t.spark, f"{root}/export", exports.EXPORT_COLUMNS)
