"""The listing domain derived from the driver's tables.

Each derivation is one SQL text that Spark and the checking engine both run.
``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.session import configure

DERIVED = {
    "companies": """
        SELECT s_suppkey + 1 AS id, s_name AS name, lower(replace(s_name, '#', '-')) AS slug,
               CASE s_suppkey % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'html' ELSE 'browser' END
                   AS adapter_type,
               'https://' || lower(replace(s_name, '#', '-')) || '.example.com/careers' AS base_url,
               '[]' AS config, s_acctbal > 0 AS is_active, s_suppkey % 5 <> 0 AS authoritative,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS created_at,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
        FROM {supplier}""",
    "seed": """
        SELECT s_name || ' Careers' AS name,
               CASE WHEN s_suppkey % 4 = 0 THEN 'new-' ELSE '' END
                   || lower(replace(s_name, '#', '-')) AS slug,
               'html' AS adapter_type, 'https://careers.example.com' AS base_url, '[1]' AS config,
               true AS is_active, s_suppkey % 2 = 0 AS authoritative,
               CASE s_suppkey % 6 WHEN 0 THEN 'approved' WHEN 1 THEN 'needs-review'
                    WHEN 2 THEN 'blocked' WHEN 3 THEN 'needs-review' WHEN 4 THEN NULL
                    ELSE 'blocked-by-policy' END AS compliance_status
        FROM {supplier}""",
    "jobs": """
        SELECT o_orderkey + 1 AS id,
               o_custkey % (SELECT count(*) FROM {supplier}) + 1 AS company_id,
               o_orderpriority || ' role ' || CAST(o_orderkey % 50 AS STRING) AS title,
               CASE WHEN o_orderkey % 6 = 0 THEN 'vi ' || o_orderpriority END AS title_vi,
               CASE WHEN o_orderkey % 7 = 0 THEN 'Remote'
                    ELSE 'City ' || CAST(o_custkey % 20 AS STRING) END AS location,
               'https://jobs.example.com/job/' || CAST(o_orderkey AS STRING) || '?utm_source=feed'
                   AS url,
               'https://jobs.example.com/job/' || CAST(o_orderkey AS STRING) AS canonical_url,
               CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS date_posted,
               CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'unknown' END
                   AS status,
               CAST(o_orderkey AS STRING) AS source_job_id,
               CASE WHEN o_orderkey % 3 <> 0 THEN '$' || CAST(o_orderkey % 400 AS STRING) || ',000'
                    END AS salary_raw,
               CASE o_orderkey % 5
                    WHEN 0 THEN '[]'
                    WHEN 1 THEN '{{"easy_apply": true, "salary": "$180K"}}'
                    WHEN 2 THEN '{{"easy_apply": "Yes"}}'
                    WHEN 3 THEN '{{"easy_apply": 1, "salary": "$260,000"}}'
                    ELSE '{{"easy_apply": false}}' END AS raw_data,
               CAST(o_orderkey % 3 AS BIGINT) AS missing_count,
               CAST(o_orderdate AS TIMESTAMP) AS first_seen_at,
               CAST(o_orderdate AS TIMESTAMP) AS last_seen_at,
               CAST(o_orderdate AS TIMESTAMP) AS created_at,
               CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM {orders}""",
    "incoming": """
        SELECT o_custkey % (SELECT count(*) FROM {supplier}) + 1 AS company_id,
               o_orderpriority || ' role updated' AS title, CAST(NULL AS STRING) AS title_vi,
               'Onsite' AS location,
               'https://jobs.example.com/job/' || CASE WHEN o_orderkey % 4 = 0 THEN 'moved-'
                        WHEN o_orderkey % 5 = 0 THEN 'new-' ELSE '' END
                   || CAST(o_orderkey AS STRING) AS url,
               'https://jobs.example.com/job/' || CASE WHEN o_orderkey % 4 = 0 THEN 'moved-'
                        WHEN o_orderkey % 5 = 0 THEN 'new-' ELSE '' END
                   || CAST(o_orderkey AS STRING) AS canonical_url,
               CAST(o_orderdate AS TIMESTAMP) AS date_posted, 'open' AS status,
               CAST(o_orderkey AS STRING) AS source_job_id,
               CASE WHEN o_orderkey % 2 = 0 THEN '$200K' END AS salary_raw,
               CAST(NULL AS STRING) AS raw_data,
               CAST(o_orderkey AS BIGINT) AS page_no, CAST(0 AS BIGINT) AS pos
        FROM {orders}""",
    "attempts": """
        SELECT event_id + 1 AS id, CAST(day(CAST(ts AS TIMESTAMP)) AS BIGINT) AS run_id,
               user_id % (SELECT count(*) FROM {supplier}) + 1 AS company_id,
               CAST(ts AS TIMESTAMP) AS started_at,
               CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS TIMESTAMP) + INTERVAL '90' SECOND END
                   AS finished_at,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial'
                    ELSE 'success' END AS status,
               CAST(floor(value) AS BIGINT) AS jobs_found,
               CAST(floor(value) AS BIGINT) % 5 AS records_rejected,
               CAST(floor(value) AS BIGINT) % 7 AS new_jobs,
               CAST(event_id % 3 AS BIGINT) AS closed_jobs, CAST(event_id % 2 AS BIGINT) AS missing_count,
               CAST(event_id % 4 AS BIGINT) + 1 AS pages_fetched,
               CAST(event_id % 4 AS BIGINT) + 2 AS requests_made,
               event_type <> 'view' AS complete, user_id % 5 <> 0 AS authoritative_snapshot,
               CASE WHEN event_type = 'error' THEN
                    CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'http' END END AS error_type,
               CASE WHEN event_type = 'error' THEN 'fetch failed' END AS error_message,
               CASE WHEN event_id % 5 = 0 THEN 'slow; late' END AS warnings
        FROM {events}""",
    "runs": """
        SELECT CAST(day(CAST(ts AS TIMESTAMP)) AS BIGINT) AS id, min(CAST(ts AS TIMESTAMP)) AS started_at,
               CASE WHEN day(CAST(ts AS TIMESTAMP)) % 6 <> 0 THEN max(CAST(ts AS TIMESTAMP)) END
                   AS finished_at,
               CASE WHEN day(CAST(ts AS TIMESTAMP)) % 6 = 0 THEN 'running' ELSE 'success' END AS status,
               'cli' AS triggered_by, CAST(NULL AS STRING) AS notes
        FROM {events} GROUP BY day(CAST(ts AS TIMESTAMP))""",
    # five sources, each with a fifth of all rows
    "counts": """
        SELECT event_type AS source, CAST(ts AS TIMESTAMP) AS ts, event_id AS id,
               CAST(floor(value) AS BIGINT) % 7 * (1 + event_id % 3) AS job_count
        FROM {events}""",
    "snapshots": """
        SELECT 'sel-' || CAST(user_id % 40 AS STRING) AS selector, CAST(ts AS TIMESTAMP) AS ts,
               event_id AS id, CAST(floor(value) AS BIGINT) % 4 AS match_count
        FROM {events}""",
    "timeouts": """
        SELECT 'user-' || CAST(user_id % 12 AS STRING) AS source, CAST(ts AS TIMESTAMP) AS ts,
               event_id AS id
        FROM {events} WHERE event_type = 'error'""",
    "outcomes": """
        SELECT 'src-' || CAST(user_id % 8 AS STRING) AS source, CAST(ts AS TIMESTAMP) AS ts,
               event_id AS id,
               NOT (event_type = 'error' OR (event_type = 'view' AND day(CAST(ts AS TIMESTAMP)) % 2 = 0))
                   AS ok
        FROM {events}""",
    "requests": """
        SELECT 'org-' || CAST(user_id % 6 AS STRING) AS origin,
               CASE user_id % 6 % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'html' ELSE 'browser' END AS family,
               CAST(ts AS TIMESTAMP) AS ts, event_id AS id
        FROM {events}""",
    "fetch_log": """
        SELECT 'src-' || CAST(user_id AS STRING) || '-' || CAST(day(CAST(ts AS TIMESTAMP)) % 4 AS STRING)
                   AS source,
               CASE user_id % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'html' ELSE 'browser' END AS family,
               CAST(day(CAST(ts AS TIMESTAMP)) AS BIGINT) AS page_no, CAST(event_id AS BIGINT) AS attempt,
               CAST(ts AS TIMESTAMP) AS started_at,
               CAST(ts AS TIMESTAMP) + INTERVAL '2' SECOND AS finished_at,
               CASE WHEN event_id % 23 = 0 THEN CAST(429 AS BIGINT) WHEN event_id % 29 = 0 THEN 403
                    WHEN event_id % 31 = 0 THEN 500 ELSE 200 END AS status_code,
               CASE WHEN event_id % 19 = 0 THEN 'application/json' ELSE 'text/html; charset=utf-8' END
                   AS content_type,
               CASE WHEN event_id % 37 = 0 THEN 'timeout'
                    WHEN event_id % 41 = 0 THEN 'challenge:title' END AS error_type,
               CAST(floor(value / 20) AS BIGINT) AS n_jobs
        FROM {events}""",
    "records": """
        SELECT l_suppkey % 20 + 1 AS company_id,
               'Part ' || CAST(l_partkey AS STRING) || ' v' || CAST(l_linenumber AS STRING) AS title,
               'https://jobs.example.com/part/' || CAST(l_partkey AS STRING) || '?utm_source='
                   || CAST(l_orderkey AS STRING) AS url,
               'https://jobs.example.com/part/'
                   || CAST(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS STRING)
                   AS canonical_url,
               CAST(l_orderkey AS BIGINT) AS page_no,
               CAST(l_linenumber * 1000000 + l_partkey AS BIGINT) AS pos,
               l_extendedprice AS price
        FROM {lineitem}""",
    "raw_rows": """
        SELECT CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'src-' || CAST(o_custkey % 9 AS STRING) END
                   AS source,
               CASE WHEN o_orderkey % 17 = 0 THEN '   ' ELSE '  ' || o_orderpriority || ' ' END AS title,
               CASE o_orderkey % 6 WHEN 0 THEN '/job/' || CAST(o_orderkey AS STRING)
                    WHEN 1 THEN ' HTTPS://Jobs.Example.com/Job/' || CAST(o_orderkey AS STRING) || '/#x '
                    ELSE 'https://jobs.example.com/job/' || CAST(o_orderkey AS STRING) || '?ref=a'
                    END AS url,
               CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE ' Da Nang ' END AS location,
               CASE o_orderkey % 5 WHEN 0 THEN '2026-07-15T10:30:00+07:00' WHEN 1 THEN 'soon'
                    WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '2026-07-15' END AS date_posted,
               CAST(o_orderkey AS STRING) AS source_job_id, CAST(NULL AS STRING) AS raw_data,
               o_custkey % 11 AS company_id, CAST(o_orderkey AS BIGINT) AS page_no,
               CAST(0 AS BIGINT) AS pos
        FROM {orders}""",
    "html_source": """
        SELECT 'site-' || CAST(page_id % 10 AS STRING) AS source,
               CAST(floor(page_id / 10) AS BIGINT) + 1 AS page_no, page_id, url,
               CASE WHEN page_id % 97 = 96 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END
                   AS content_type,
               html AS body
        FROM {pages}""",
}

_BASE = ["supplier", "orders", "events", "lineitem", "pages", "part", "customer"]


class Tables:
    """Driver tables and derived frames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self._folder = folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a portable SQL text over the driver tables it names."""
        used = {name: self.base(name) for name in _BASE if "{" + name + "}" in text}
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.sql(DERIVED[name]) if name in DERIVED else self.base(name)

    def ats_pages(self, style: str) -> DataFrame:
        """Orders as pages of 100 listings in a Greenhouse or Workday body."""
        text = F.col("o_orderkey").cast("string")
        undated = F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        if style == "greenhouse":
            item = F.struct(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderpriority").alias("title"),
                F.when(
                    F.col("o_orderkey") % 3 != 0,
                    F.struct(F.concat(F.lit("City "), (F.col("o_custkey") % 20).cast("string")).alias("name")),
                ).alias("location"),
                undated.alias("updated_at"),
                F.concat(F.lit("https://jobs.example.com/"), text).alias("absolute_url"),
                F.when(F.col("o_orderkey") % 2 == 0, F.struct(F.col("o_orderstatus").alias("name"))).alias(
                    "department"
                ),
                F.lit("full").alias("employment_type"),
                (F.col("o_orderkey") + 5).alias("internal_job_id"),
            )
        else:
            item = F.struct(
                F.concat(F.lit("JOB-"), text).alias("jobPostingId"),
                F.col("o_orderpriority").alias("title"),
                F.when(F.col("o_orderkey") % 3 != 0, F.array(F.col("o_orderstatus"), F.lit("x")))
                .otherwise(F.array().cast("array<string>"))
                .alias("locations"),
                F.struct(F.lit("c1").alias("id"), F.col("o_orderstatus").alias("name")).alias("subcategory"),
                undated.alias("postedOn"),
                F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("https://a.example.com/"), text)).alias(
                    "absoluteUrl"
                ),
                F.when(F.col("o_orderkey") % 8 != 0, F.concat(F.lit("https://w.example.com/"), text)).alias(
                    "workdayUrl"
                ),
            )
        orders = self.base("orders")
        page = F.floor(F.col("o_orderkey") / 100).cast("int")
        bodies = (
            orders.withColumn("_page", page)
            .groupBy("_page")
            .agg(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("item")))),
                    lambda x: x["item"],
                ).alias("items")
            )
        )
        total = orders.agg(F.count("*")).scalar()
        body = (
            F.struct(F.col("items").alias("jobs"), F.struct(total.alias("total")).alias("meta"))
            if style == "greenhouse"
            else F.struct(
                F.col("items").alias("data"),
                total.alias("total"),
                (F.col("_page") * 100).alias("offset"),
                F.lit(100).alias("limit"),
            )
        )
        return bodies.select(
            F.lit(style).alias("source"),
            (F.col("_page") + 1).alias("page_no"),
            F.lit(200).alias("status_code"),
            F.to_json(body).alias("body"),
        )


_CARD = {
    "techcorp": (
        '<div class="job-card"><h3 class="job-title">%s &amp; %s</h3><div class="job-meta">'
        '<span class="location">%s</span></div><a class="job-link" href="/careers/%s">Go</a></div>'
    ),
    "startupxyz": (
        '<tr class="job-row"><td class="job-title-cell"><a href="/jobs/%4$s">%1$s &amp; %2$s</a>'
        '<td class="job-location-cell">%3$s<td class="job-date-cell">July'
    ),
    "caloptima": (
        '<tr><td><a href="/1150/job/x%4$s?p=1">%1$s <b>&amp;</b> %2$s</a></td><td>%3$s</td></tr>'
    ),
    "tiktok": (
        '<div data-job-id="%4$s"><a href="/position/%4$s">%1$s &amp; %2$s</a>'
        '<span class="location">%3$s</span></div>'
    ),
}


def listing_pages(orders: DataFrame) -> DataFrame:
    """Orders as HTML listing pages of 100 in the layouts of four known sources."""
    slugs = list(_CARD)
    page = F.floor(F.col("o_orderkey") / 100).cast("int")
    key = F.col("o_orderkey").cast("string")
    city = F.when(
        F.col("o_orderkey") % 3 != 0, F.concat(F.lit("City "), (F.col("o_custkey") % 20).cast("string"))
    ).otherwise("")
    values = (F.col("o_orderpriority"), F.col("o_orderstatus"), city, key)
    card = F.lit(None).cast("string")
    for at, slug in enumerate(slugs):
        card = F.when(page % len(slugs) == at, F.format_string(_CARD[slug], *values)).otherwise(card)
    body = F.array_join(F.transform(F.array_sort("cards"), lambda c: c["card"]), "\n")
    return (
        orders.groupBy(page.alias("_page"))
        .agg(F.collect_list(F.struct("o_orderkey", card.alias("card"))).alias("cards"))
        .select(
            F.element_at(F.array(*[F.lit(s) for s in slugs]), F.col("_page") % len(slugs) + 1).alias("source"),
            (F.col("_page") + 1).alias("page_no"),
            F.concat(F.lit("<html><body><table><tbody>"), body, F.lit("</tbody></table>")).alias("html"),
        )
    )


def cte(*names: str) -> str:
    """``WITH`` clause defining derived frames for the checking engine."""
    plain = {name: name for name in _BASE}
    return "WITH " + ",\n".join(f"{n} AS ({DERIVED[n].format(**plain)})" for n in names)


def tidy(df: DataFrame) -> DataFrame:
    """Column types both engines agree on: long integers, zoneless times, 6 decimals."""
    columns = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        elif kind == "timestamp":
            col = col.cast("timestamp_ntz")
        elif kind == "double":
            col = F.round(col, 6)
        columns.append(col.alias(name))
    return df.select(*columns)
