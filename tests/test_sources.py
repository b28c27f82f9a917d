import gzip
import json

import pytest
from pyspark.sql import functions as F

from vacancylake import schemas
from vacancylake.operators import extraction, lookup
from vacancylake.sinks import page_files
from vacancylake.sinks import tables as sinks
from vacancylake.sinks.page_files import write_page_files
from vacancylake.sources import ats, companies, html, markup, pages, specs

CARDS = """<html><body><main>
<div class="job-card wide"><h2 class="title">Baker <i>(night</i>   shift)</h2><a class="job-link" href="/open/b-17">More</a>
  <span class="location">Oslo</span><span class="date">2025-02-03</span></div>
<div class="job-card"><a class="job-link" href="/open/nameless">More</a></div>
<div class="job-card"><h2 class="title">Glazier &amp; Fitter</h2><span class="date">yesterday</span></div>
<div class="job-card"><h2 class="title">Tram Driver</h2><span class="date">2025-01-30</span>
  <a class="job-link" href="https://tram.example/job/9">More</a></div>
<script>document.write('<div class="job-card"></div>')</script>
<a class="next" href="/open?from=20">Older</a></main>
</body></html>"""

TABLE = """<div class="pagination"><a href="/open?p=2">2</a></div><table class="jobs-table"><tbody>
<tr class="job-row"><td><a href="/jobs/88">Cook</a></td><td class="job-location-cell"></td></tr>
<tr class="job-row" data-job-id="41"><td class="job-title-cell"><a href="/jobs/41">Harbour Pilot</a>
<td class="job-location-cell">Bergen<td class="job-date-cell">May
</tbody></table>"""


def page_frame(spark, *rows):
    return spark.createDataFrame(rows, "source string, page_no int, html string")


def rule_frame(spark, source, family="html", **rule):
    spec = specs.SourceSpec(source, family, "https://x.example", rule=specs.PageRule(**rule))
    return specs.SourceCatalog([spec]).rules(spark)


CARD_RULE = dict(
    container=".job-card", title="h2.title", link="a.job-link", location=".location", date=".date",
    base_url="https://x.example/list", next_page="a.next",
)


def test_cards(spark):
    found = html.extract_pages(page_frame(spark, ("s", 1, CARDS)), rule_frame(spark, "s", **CARD_RULE))
    rows = [tuple(r) for r in html.listings(found).select("pos", "title", "url", "location", "date_posted").orderBy("pos").collect()]
    assert rows == [
        (0, "Baker (night shift)", "https://x.example/open/b-17", "Oslo", "2025-02-03"),
        (3, "Tram Driver", "https://tram.example/job/9", "Remote", "2025-01-30"),
    ]
    # a title without a link is dropped silently, a card without title is not
    assert [r.warning for r in html.extraction_warnings(found).collect()] == ["Skipping job without title"]
    summary = html.page_summary(found).first()
    assert (summary.jobs_found, summary.next_page) == (2, "/open?from=20")


def test_table_with_unclosed_cells_and_id_from_url(spark):
    catalog = specs.default_catalog()
    rows = html.extract_listings(page_frame(spark, ("startupxyz", 1, TABLE)), catalog.rules(spark)).orderBy("pos").collect()
    assert [(r.title, r.url, r.location, r.source_job_id) for r in rows] == [
        ("Cook", "https://startupxyz.example.com/jobs/88", "Remote", "88"),
        ("Harbour Pilot", "https://startupxyz.example.com/jobs/41", "Bergen", "41"),
    ]


def test_empty_page_warns_about_its_container(spark):
    found = html.extract_pages(page_frame(spark, ("s", 1, "<p>nothing")), rule_frame(spark, "s", **CARD_RULE))
    assert [r.warning for r in html.extraction_warnings(found).collect()] == [
        "Container selector '.job-card' matched no elements"
    ]


def test_rendered_pages(spark):
    body = """<div data-job-id="7"><a href="/position/7"> Dev <b>Ops</b></a></div>
    <div class="jobCard"><h3>No link</h3></div>
    <article class="job"><a href="http://o.example/8">QA</a><span class="location">Hanoi</span></article>"""
    rows = html.extract_listings(page_frame(spark, ("tiktok", 1, body)), specs.default_catalog().rules(spark)).orderBy("pos").collect()
    assert [(r.title, r.url, r.location, r.source_job_id) for r in rows] == [
        ("DevOps", "https://careers.tiktok.com/position/7", "Singapore", "7"),
        ("QA", "http://o.example/8", "Hanoi", None),
    ]


def test_default_cards_use_the_link_selector(spark):
    rows = html.extract_cards(page_frame(spark, ("s", 1, CARDS))).filter("kind <> 'page'").orderBy("pos").collect()
    assert [(r.kind, r.title, r.url) for r in rows] == [
        ("job", "Baker (night shift)", "/open/b-17"),
        ("warning", None, None),
        ("job", "Glazier & Fitter", ""),
        ("job", "Tram Driver", "https://tram.example/job/9"),
    ]
    assert rows[1].warning == "Skipping card without title"


@pytest.mark.parametrize(
    "selector,n",
    [
        (".job-card", 4), ("div.job-card", 4), ("span.job-card", 0), ("a[href]", 4), ("[href*='open']", 3),
        ("a[class='next']", 1), ('a[class="next"]', 1), (".job-card a, h2", 6), ("body .job-card .date", 3),
        ("div span:nth-child(2)", 2), ("div > a", 3), ("main > a", 1), ("main>div>a, h2", 6), ("body > a", 0),
        ("html div > .date", 3), ("a[href^='/open']", 3), ("a[href$='9']", 1), ("[class~='wide']", 1),
        ("[class~='job']", 0), ("a:first-child", 1), ("div :last-child", 5), ("", 0), ("> a", 0), ("a >", 0), ("[x", 0),
        ("a[href*='']", 0),
    ],
)
def test_selectors(selector, n):
    assert markup.count(markup.parse(CARDS), selector) == n


def test_selector_counts(spark):
    got = html.count_selector_matches(page_frame(spark, ("s", 1, CARDS)), ["h2", "nope>"], ["source"])
    assert {(r.selector, r.match_count, r.matched) for r in got.collect()} == {("h2", 3, True), ("nope>", 0, False)}


def test_unknown_selectors_are_named(spark):
    for selector in ("a:hover", "a + b", "h2 ~ a", ":not(p)"):
        with pytest.raises(markup.UnsupportedSelector):
            html.count_selector_matches(page_frame(spark, ("s", 1, CARDS)), [selector], ["source"])
    good = specs.SourceSpec("good", "html", "u", rule=specs.PageRule(**CARD_RULE))
    bad = specs.SourceSpec("bad", "html", "u", rule=specs.PageRule(**CARD_RULE | {"title": "h2:hover"}))
    rules = specs.SourceCatalog([good, bad]).rules(spark)
    found = html.extract_pages(page_frame(spark, ("good", 1, CARDS), ("bad", 1, CARDS)), rules)
    assert {r.source for r in html.listings(found).collect()} == {"good"}
    assert [r.warning for r in html.extraction_warnings(found).filter("source = 'bad'").collect()] == [
        "title: unsupported selector: 'h2:hover'"
    ]


def test_numeric_references(one):
    texts = ["&#x2F;a&#47;", "&#38;lt;", "&#x110000;&#xD800;&#0;", "&#8364;&apos;", "none", None]
    assert one(texts, lambda v: html.unescape(F.col(v))) == ["/a/", "&lt;", "\ufffd\ufffd\ufffd", "€'", "none", None]


def test_links_and_next_page(spark):
    df = page_frame(spark, ("s", 1, CARDS + "<!-- <a href='/jobs/hidden'> --><a href=\"/careers/x?a=1&#38;b=2&#x26;amp;lt;&#xE9;\">c</a><a href='/About'>n</a><a href='&#x2F;jobs&#47;7'>j</a>"))
    links = html.extract_links(df, F.lit("https://x.example/a/b"), ["source"]).orderBy("pos").collect()
    assert [r.url for r in links] == [
        "https://tram.example/job/9", "https://x.example/careers/x?a=1&b=2&amp;lt;é", "https://x.example/jobs/7",
    ]
    assert html.next_page_url(df).first().next_page == "/open?from=20"
    assert html.next_page_url(page_frame(spark, ("s", 1, "<p>"))).first().next_page is None


def test_listing_page_rule(spark):
    rows = [
        ("words", 1, "<p>A Job and your <b>career</b>"),
        ("cards", 1, "<article></article><div class='job'></div>"),
        ("none", 1, "<p>job</p><script>career position</script>"),
    ]
    got = {r.source: r.is_listing for r in html.is_listing_page(page_frame(spark, *rows), ["source"]).collect()}
    assert got == {"words": True, "cards": True, "none": False}


CHALLENGES = [
    ("<title>Just a moment...</title>", "title", "title"),
    ("<title>Jobs</title><p>Access denied</p>", "blocked", "blocked"),
    ("<p>Your RAY ID is 1</p>", "challenge", "challenge"),
    ("<p>job 1403</p>", "blocked", None),
    ("<p>HTTP 403</p>", "blocked", "blocked"),
    ("<h1>Open roles</h1>", None, None),
]


@pytest.mark.parametrize("mode,column", [("substring", 1), ("word", 2)])
def test_challenges(spark, mode, column):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CHALLENGES)], "i int, html string")
    got = [r.challenge_type for r in html.classify_challenge(df, mode).orderBy("i").collect()]
    assert got == [c[column] for c in CHALLENGES]


WORKDAY = {
    "total": 3, "offset": 0, "limit": 100,
    "data": [
        {"jobPostingId": "R7", "title": "No link", "locations": []},
        "garbage",
        {"title": "Night Nurse", "postedOn": "2025-03-01T06:30:00Z", "jobPostingId": "R9", "locations": ["Tromsø", "Bodø"],
         "workdayUrl": "https://w.example/9", "absoluteUrl": "https://care.example/posts/R9",
         "subcategory": {"id": "c4", "name": "Care"}},
        {"jobPostingId": "R8", "title": "Second link", "locations": [], "absoluteUrl": "", "workdayUrl": "https://w.example/8"},
    ],
}


def json_pages(spark, *rows):
    return spark.createDataFrame(rows, "source string, page_no int, status_code int, body string")


def test_workday(spark):
    rows = ats.flatten_workday(json_pages(spark, ("vancity", 1, 200, json.dumps(WORKDAY)))).orderBy("pos").collect()
    assert [(r.source_job_id, r.location, r.url) for r in rows] == [
        ("R9", "Tromsø", "https://care.example/posts/R9"),
        ("R8", "Vancouver, BC", "https://w.example/8"),
    ]
    assert json.loads(rows[0].raw_data) == {
        "job_posting_id": "R9", "locations": ["Tromsø", "Bodø"], "subcategory": {"id": "c4", "name": "Care"},
        "primary_location": "Tromsø", "posted_on": "2025-03-01T06:30:00Z",
    }
    canada = ats.flatten_workday(json_pages(spark, ("f", 1, 200, json.dumps(WORKDAY))), "Canada", False)
    row = canada.filter("source_job_id = 'R8'").first()
    assert row.location == "Canada" and "primary_location" not in row.raw_data


def test_greenhouse_survives_odd_rows(spark):
    body = {
        "jobs": [
            {"id": 12345, "title": "Engineer", "location": {"name": "HCMC"}, "updated_at": "2026-07-15T10:30:00Z",
             "absolute_url": "https://j.example/1", "department": {"name": "R&D"}, "employment_type": "full", "internal_job_id": 9},
            {"id": 2, "title": "B", "location": None, "absolute_url": "https://j.example/2", "department": "text"},
            {"title": "C", "location": "text", "absolute_url": "https://j.example/3"},
        ],
        "meta": {"total": 3},
    }
    rows = ats.flatten_greenhouse(json_pages(spark, ("opswat", 1, 200, json.dumps(body)), ("opswat", 2, 200, "{oops"))).orderBy("pos").collect()
    assert [(r.source_job_id, r.location, r.date_posted) for r in rows] == [
        ("12345", "HCMC", "2026-07-15T10:30:00Z"), ("2", "Remote", None), ("", "Remote", None),
    ]
    assert json.loads(rows[0].raw_data) == {"department": "R&D", "employment_type": "full", "internal_job_id": 9}
    assert json.loads(rows[1].raw_data)["department"] is None


def test_greenhouse_texts_are_parsed_once(spark):
    """The place is looked up once for all that trimming does with it."""
    rows = ats.flatten_greenhouse(json_pages(spark, ("opswat", 1, 200, "{}")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(j#") == 2  # place and department


def meta_rows(spark, *rows):
    return spark.createDataFrame(
        rows, "source string, style string, page_no int, current_count bigint, total bigint, page_offset bigint, failed boolean"
    )


def test_snapshot_completeness(spark):
    rows = [
        ("next", "offset", 1, 1, 200, 100, False),
        ("done", "offset", 1, 100, 100, 0, False),
        ("full", "page", 1, 100, 0, 0, False),
        ("short", "page", 1, 100, 0, 0, False), ("short", "page", 2, 7, 0, 0, False),
        ("gap", "page", 1, 100, 0, 0, False), ("gap", "page", 3, 7, 0, 0, False),
        ("broken", "offset", 1, 50, 50, 0, True),
    ]
    got = {r.source: (r.has_next, r.complete) for r in extraction.snapshot_complete(meta_rows(spark, *rows)).collect()}
    assert got == {
        "next": (True, False), "done": (False, True), "full": (True, False), "short": (False, True),
        "gap": (False, False), "broken": (False, False),
    }


def test_frontier(spark):
    urls = {
        (r.source, r.page_no): r.url
        for r in specs.expand_listing_urls(specs.default_catalog().frame(spark), 3).collect()
    }
    assert urls["opswat", 2].endswith("/jobs?page=2&per_page=100")
    assert urls["vancity", 3].endswith("/jobPostings?offset=200&limit=100")
    assert urls["caloptima", 1] == "https://careers.pageuppeople.com/1150/cw/en-us/listing/"
    assert urls["caloptima", 2].endswith("/listing/?page=2")
    assert urls["iqmetrix", 1].endswith("/apply?page=1")
    assert len(urls) == 36


def test_catalog_refuses_duplicates():
    with pytest.raises(ValueError):
        specs.SourceCatalog([specs.SPECS[0], specs.SPECS[0]])


def test_seed(spark):
    from vacancylake import schemas

    now = F.lit("2026-01-01").cast("timestamp")
    seed = companies.seed_frame(spark)
    blocked = seed.limit(1).withColumn("slug", F.lit("x")).withColumn("compliance_status", F.lit("blocked"))
    empty = spark.createDataFrame([], schemas.COMPANIES)
    loaded, held = companies.load_companies(empty, seed.unionByName(blocked), now)
    assert loaded.filter("op = 'created'").count() == 10
    assert [r.skip_reason for r in held.collect()] == ["compliance: blocked"]
    again, _ = companies.load_companies(loaded.drop("op"), seed, now)
    assert {r.op for r in again.collect()} == {"updated"}


def test_page_readers(spark, tmp_path):
    from vacancylake import schemas

    rows = [("s", n, f"u{n}", 200, kind, f"<p>{n}", None) for n, kind in ((1, "text/html"), (2, "application/pdf"), (3, "text/html"))]
    df = spark.createDataFrame(rows, schemas.PAGES)
    for layout in ("parquet", "json", "orc"):
        df.write.format(layout).save(str(tmp_path / layout))
        got = pages.read_html_pages(spark, str(tmp_path / layout), layout)
        assert [(r.page_no, r.html) for r in got.collect()] == [(1, "<p>1")]
        assert pages.read_api_pages(spark, str(tmp_path / layout), layout).count() == 3
    assert pages.non_html_warnings(df).first().warning == "Page 2 returned non-HTML content: application/pdf"
    (tmp_path / "files" / "acme").mkdir(parents=True)
    (tmp_path / "files" / "acme" / "4.html").write_text("<p>\nx")
    got = pages.read_page_files(spark, str(tmp_path / "files"), r"/([^/]+)/(\d+)\.html$").first()
    assert (got.source, got.page_no, got.body, got.content_type) == ("acme", 4, "<p>\nx", "text/html")


def test_page_files_match_sparks_reader(spark, tmp_path, monkeypatch):
    """Names with signs, hidden files, empty files, bytes that are no UTF-8 and, at the end, a compressed file."""
    files = {"a b/1%2 #\u00e9.html": b"x\ny", "s=p1/n=2/part-0.txt": b"q", ".x/1.html": b"h", "_h/1.html": b"h", "_y=1/_k.txt": b"h",
             "_y=1/_k=2.txt": b"z", "empty.html": b"", "\u00fc/bad.html": b"\xff\xfe", "a b/w+&=@.json": b"{}", "top.html": b"t"}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body)

    def read():
        found = pages.read_page_files(spark, str(tmp_path), r"/([^/]+)/([^/]+)\.[a-z]+$")
        rows = found.withColumn("body", F.hex(F.col("body").cast("binary"))).collect()
        return sorted(rows, key=lambda row: row.url)

    got = read()
    assert {row.url.rsplit("/", 1)[-1] for row in got} == {
        "1%252%20%23\u00e9.html", "part-0.txt", "_k=2.txt", "bad.html", "w+&=@.json", "top.html"}
    with monkeypatch.context() as patch:
        patch.setattr(pages, "_local_files", lambda *_: None)
        assert read() == got
    (tmp_path / "z.html.gz").write_bytes(gzip.compress(b"plain"))
    assert [bytes.fromhex(row.body) for row in read() if row.url.endswith(".gz")] == [b"plain"]


def test_page_files_take_few_tasks(spark, tmp_path):
    """Writing and reading 300 files, some of them in a folder each; a task per folder or for every few files does not scale."""
    texts = spark.range(300).selectExpr("concat('p', id) AS s", "id % 7 AS n", "concat('text ', id) AS html")
    unnamed = spark.createDataFrame([(None, None, "a"), (None, None, "b:c")], "s string, n bigint, html string")
    doubled = texts.union(texts.filter("n = 3")).union(unnamed)
    context = spark.sparkContext
    context.setJobGroup("page files", "written and read")
    try:
        write_page_files(doubled.repartition(3, "s"), str(tmp_path / "files"), ["s", "n"], "html")
        for i in range(300):
            (tmp_path / "files" / f"folder-{i}").mkdir()
            (tmp_path / "files" / f"folder-{i}" / f"s=f{i},n=1.txt").write_text("own")
        read = pages.read_page_files(spark, str(tmp_path / "files"), r"/s=([^/]+)[/,]n=(\d+)[/.]").collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    told = context.statusTracker()
    stages = {stage for job in told.getJobIdsForGroup("page files") for stage in told.getJobInfo(job).stageIds}
    assert sum(told.getStageInfo(stage).numTasks for stage in stages if told.getStageInfo(stage)) < 100
    assert sorted((row.source, row.page_no, row.body) for row in read if row.source.startswith("p")) == sorted(
        (f"p{i}", i % 7, f"text {i}\n" * (2 if i % 7 == 3 else 1)) for i in range(300))
    assert {(row.source, row.page_no, row.body) for row in read if row.source.startswith("f")} == {(f"f{i}", 1, "own") for i in range(300)}
    assert [(row.page_no, sorted(row.body.splitlines())) for row in read if not row.source] == [(None, ["a", "b:c"])]


def test_page_files_are_named_as_by_sparks_writer(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [("a/b=%", 1, "x"), ("", 2, "y"), (None, None, None), ("\u00fc 1", -3, "z\nz")], "s string, n int, html string").coalesce(1)
    write_page_files(rows, str(tmp_path / "own"), ["s", "n"], "html")
    own = {p.stem: p.read_bytes() for p in (tmp_path / "own").rglob("*.txt")}
    assert all(p.is_dir() or not p.name.startswith(".") for p in (tmp_path / "own").rglob("*"))
    with pytest.raises(FileExistsError):
        write_page_files(rows, str(tmp_path / "own"), ["s", "n"], "html")
    with monkeypatch.context() as patch:  # what other stores get
        patch.setattr(page_files, "local_folder", lambda *_: None)
        write_page_files(rows, str(tmp_path / "spark"), ["s", "n"], "html")
    sparks = {",".join(p.parent.relative_to(tmp_path / "spark").parts): p.read_bytes() for p in (tmp_path / "spark").rglob("part-*.txt")}
    assert own == sparks and len(own) == 4


def fetch(spark, rows):
    return spark.createDataFrame(
        rows, "source string, family string, page_no int, attempt int, status_code int, content_type string, error_type string, n_jobs int"
    )


HTML = "text/html"


def test_extraction_outcomes(spark):
    rows = [
        ("ok", "api", 1, 1, 200, None, None, 5),
        ("limited", "api", 1, 1, 200, None, None, 5), ("limited", "api", 2, 1, 429, None, None, None),
        ("limited", "api", 3, 1, 200, None, None, 50),
        ("down", "api", 1, 1, 500, None, None, None),
        ("denied", "api", 1, 1, 200, None, None, 5), ("denied", "api", 2, 1, 403, None, None, None),
        ("retried", "api", 1, 1, 500, None, None, None), ("retried", "api", 1, 2, 200, None, None, 3),
        ("empty", "html", 1, 1, 200, HTML, None, 0),
        ("pdf", "html", 1, 1, 200, "application/pdf", None, 0),
        ("slow", "html", 1, 1, 200, HTML, None, 2), ("slow", "html", 2, 1, None, None, "timeout", None),
        ("wall", "browser", 1, 1, 200, HTML, "challenge:title", None),
        ("nav", "browser", 1, 1, None, None, "NavigationError", None),
        ("half", "browser", 1, 1, 200, HTML, None, 4), ("half", "browser", 2, 1, 200, HTML, "challenge:blocked", None),
        ("quiet", "api", 1, 1, 200, None, None, 0),
    ]
    out = extraction.classify_extraction(fetch(spark, rows))
    got = {r.source: (r.status, r.jobs_found, r.pages_fetched, r.requests_made, r.complete) for r in out.collect()}
    assert got == {
        "ok": ("success", 5, 1, 1, True),
        "limited": ("success", 5, 1, 2, False),
        "down": ("failed", 0, 0, 1, False),
        "denied": ("failed", 5, 1, 2, False),
        "retried": ("success", 3, 1, 2, True),
        "empty": ("partial", 0, 1, 1, True),
        "pdf": ("failed", 0, 0, 1, False),
        "slow": ("success", 2, 1, 2, False),
        "wall": ("failed", 0, 0, 1, False),
        "nav": ("partial", 0, 0, 1, False),
        "half": ("partial", 4, 1, 2, False),
        "quiet": ("success", 0, 1, 1, True),
    }
    notes = {r.source: r.warning or r.error for r in out.collect()}
    assert notes["denied"] == "Authentication failed: 403"
    assert notes["limited"] == "Rate limited on page 2, continuing with partial data"
    assert notes["slow"] == "Timeout on page 2"
    zero = {r.source: r.zero_class for r in extraction.classify_zero_result(out).collect()}
    assert (zero["ok"], zero["wall"], zero["quiet"], zero["down"]) == (None, "anti_bot", "true_empty", "unverified_empty")
    dry = {r.source: r.status for r in extraction.dry_run_counts(out).collect()}
    assert (dry["denied"], dry["down"]) == ("partial", "success")


def test_union_skips_frames_of_the_wrong_shape(spark):
    good = spark.createDataFrame([("t", "u")], "title string, url string")
    bad = spark.createDataFrame([(1,)], "x int")
    union, skipped = lookup.union_sources({"a": good, "b": bad})
    assert skipped == ["b"] and union.first().source == "a"


def _page_rows(spark, n, start=0):
    rows = [(f"s{i % 2}", i, f"https://x/{i}", 200, "text/html", "b" * i, None) for i in range(start, start + n)]
    return spark.createDataFrame(rows, schemas.PAGES)


@pytest.mark.parametrize("layout", ["parquet", "orc"])
def test_unreadable_files_are_named(spark, tmp_path, layout):
    root = tmp_path / layout
    for number, (n, start) in enumerate([(5, 0), (7, 5), (0, 0)]):
        _page_rows(spark, n, start).coalesce(1).write.format(layout).save(str(tmp_path / f"w{number}"))
    root.mkdir()
    parts = [next((tmp_path / f"w{number}").glob(f"part*.{layout}")) for number in (0, 1, 2)]
    (root / f"good.{layout}").write_bytes(parts[0].read_bytes())
    (root / f"cut.{layout}").write_bytes(parts[1].read_bytes()[:-40])
    (root / f"nothing.{layout}").write_bytes(parts[2].read_bytes())
    wrong = _page_rows(spark, 3).withColumn("status_code", F.lit("soon"))
    wrong.coalesce(1).write.format(layout).save(str(tmp_path / "w3"))
    (root / f"wrong.{layout}").write_bytes(next((tmp_path / "w3").glob(f"part*.{layout}")).read_bytes())
    read = pages.read_checked_pages(spark, str(root), layout)
    assert sorted(r.page_no for r in read.pages.filter("status_code = 200").collect()) == [0, 1, 2, 3, 4]
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in read.rejects.collect()}
    assert reasons[f"cut.{layout}"] == reasons[f"nothing.{layout}"] == "No row could be read"
    if layout == "parquet":  # the other layout's reader turns the word into null
        assert reasons.pop("wrong.parquet") == "Only 0 of 3 rows could be read"
    assert len(reasons) == 2
    assert {r.file.rsplit("/", 1)[1] for r in read.files.collect()} == {f"{n}.{layout}" for n in ("good", "cut", "nothing", "wrong")}


def test_unreadable_lines_are_named_and_kept_as_rejects(spark, tmp_path):
    lines = ['{"source": "s", "page_no": 1, "body": "x", "status_code": 200}', '{"source": "s", "page_no": 2, "bo',
             '{"source": "s", "page_no": 3, "status_code": "soon"}', '{"source": null, "page_no": 4}', ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    (tmp_path / "in" / "b.json").write_text(lines[0])
    (tmp_path / "in" / "empty.json").write_text("")  # passed over
    read = pages.read_checked_pages(spark, str(tmp_path / "in"), "json")
    assert sorted((r.page_no, r.body) for r in read.pages.collect()) == [(1, "x"), (1, "x"), (4, None)]
    assert sorted(r.record for r in read.rejects.collect()) == sorted(lines[1:3])
    ledger = {r.file.rsplit("/", 1)[1]: (r["rows"], r.rejected) for r in read.files.collect()}
    assert ledger == {"a.json": (4, 2), "b.json": (1, 0)}
    sinks.write_rejects(read.rejects, str(tmp_path / "rejects"), "read", 4)
    kept = spark.read.parquet(str(tmp_path / "rejects"))
    assert {(r.run_id, r.stage, r.reason) for r in kept.collect()} == {(4, "read", "Row could not be read")}
