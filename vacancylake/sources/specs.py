"""Source specs: where a source's pages are and how they become listings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.session import literal_frame

RULE_SCHEMA = (
    "source string, family string, container string, title string, link string, "
    "location string, date string, url_attribute string, base_url string, "
    "default_location string, id_attribute string, next_page string, max_pages int"
)


@dataclass(frozen=True)
class PageRule:
    """Selectors and defaults of one HTML source."""

    container: str
    title: str = "h2.title, h3.title, .job-title"
    link: str = "a[href]"
    location: str | None = None
    date: str | None = None
    url_attribute: str = "href"
    base_url: str = ""
    default_location: str = "Remote"
    id_attribute: str | None = None
    next_page: str = "a.next, a[rel='next']"
    max_pages: int = 20


@dataclass(frozen=True)
class SourceSpec:
    """One source. ``parse`` turns its pages into raw rows when no rule does."""

    slug: str
    family: str
    listing_url: str
    paging: str = "page"
    first_page_bare: bool = True
    rule: PageRule | None = None
    parse: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)
    enabled: bool = True
    max_pages: int = 20
    per_page: int = 100


class SourceCatalog:
    """Known specs by slug."""

    def __init__(self, specs: list[SourceSpec] | None = None) -> None:
        self._specs: dict[str, SourceSpec] = {}
        for spec in specs or []:
            self.add(spec)

    def add(self, spec: SourceSpec) -> None:
        if spec.slug in self._specs:
            raise ValueError(f"duplicate source: {spec.slug}")
        self._specs[spec.slug] = spec

    def get(self, slug: str) -> SourceSpec | None:
        return self._specs.get(slug)

    def enabled(self) -> list[SourceSpec]:
        return [spec for spec in self._specs.values() if spec.enabled]

    def frame(self, spark: SparkSession) -> DataFrame:
        """Specs as rows: slug, family, listing_url, paging and limits."""
        schema = (
            "slug string, family string, listing_url string, paging string, "
            "first_page_bare boolean, max_pages int, per_page int"
        )
        return literal_frame(spark, [vars(s) for s in self.enabled()], schema)

    def rules(self, spark: SparkSession) -> DataFrame:
        """Rules of the HTML sources as rows."""
        names = [f.name for f in fields(PageRule)]
        rows = [
            {"source": s.slug, "family": s.family, **{n: getattr(s.rule, n) for n in names}}
            for s in self.enabled()
            if s.rule is not None
        ]
        return literal_frame(spark, rows, RULE_SCHEMA)


# Listing pages, selectors and default locations of each source.
SPECS = [
    SourceSpec(
        "opswat", "api", "https://boards-api.greenhouse.io/v1/boards/opswat/jobs",
        paging="page_per_page", first_page_bare=False,
    ),
    SourceSpec(
        "vancity", "api", "https://vancity.wd1.myworkday.com/ccx/api/v1/vancity/jobPostings",
        paging="offset", first_page_bare=False,
    ),
    SourceSpec(
        "farm-credit-canada", "api",
        "https://fccfac.wd3.myworkdayjobs.com/ccx/api/v1/fccfac/jobPostings",
        paging="offset", first_page_bare=False,
    ),
    SourceSpec(
        "caloptima", "html", "https://careers.pageuppeople.com/1150/cw/en-us/listing/",
        rule=PageRule(
            container="table tbody tr",
            title="a[href*='/job/']",
            link="a[href*='/job/']",
            location="td:nth-child(2)",
            base_url="https://careers.pageuppeople.com/1150/cw/en-us/listing",
            default_location="Orange County, CA",
        ),
    ),
    SourceSpec(
        "iqmetrix", "html", "https://iqmetrix.applytojob.com/apply", first_page_bare=False,
        rule=PageRule(
            container="h3, .job-listing",
            title="a",
            link="a",
            location=".location, .job-location",
            base_url="https://iqmetrix.applytojob.com/apply",
        ),
    ),
    SourceSpec(
        "first-west", "html", "https://careers.firstwestcu.ca/",
        rule=PageRule(
            container=".job-item, article.job",
            title="a",
            link="a",
            location=".job-location, .location",
            base_url="https://careers.firstwestcu.ca",
            default_location="British Columbia, CA",
        ),
    ),
    SourceSpec(
        "electric-power-engineers", "html",
        "https://join.epeconsulting.com/EPE-Engineering-Jobs/jobs",
        rule=PageRule(
            container=".job-listing, article.job",
            title="a",
            link="a",
            location=".job-location, .location",
            base_url="https://join.epeconsulting.com",
            default_location="Austin, TX",
        ),
    ),
    SourceSpec(
        "absolute-security", "html", "https://jobs.jobvite.com/absolute/jobs",
        rule=PageRule(
            container="table tbody tr.job, .job-list tr",
            title="a.job-title, td.title a",
            link="a.job-title, td.title a",
            location="td.location, td:nth-child(2)",
            base_url="https://jobs.jobvite.com",
        ),
    ),
    SourceSpec(
        "techcorp", "html", "https://www.techcorp.example/careers", max_pages=10,
        rule=PageRule(
            container=".job-card",
            title=".job-title",
            link=".job-link",
            location=".job-meta .location",
            base_url="https://www.techcorp.example",
            next_page="a.next",
            max_pages=10,
        ),
    ),
    SourceSpec(
        "startupxyz", "html", "https://startupxyz.example.com/jobs",
        rule=PageRule(
            container=".job-row",
            title="a",
            link="a",
            location=".job-location-cell",
            base_url="https://startupxyz.example.com",
            next_page="a.next",
        ),
    ),
    SourceSpec(
        "tiktok", "browser", "https://careers.tiktok.com/search", first_page_bare=False,
        rule=PageRule(
            container="[data-job-id], .jobCard, article.job",
            title="a, h3, .job-title",
            location=".location, .job-location",
            base_url="https://careers.tiktok.com",
            default_location="Singapore",
            id_attribute="data-job-id",
        ),
    ),
    SourceSpec(
        "northrop", "browser", "https://www.northropgrumman.com/careers", first_page_bare=False,
        rule=PageRule(
            container='[data-automation-id="jobListItem"], [data-automation-id="job"], li.job',
            title='[data-automation-id="jobTitle"], a, h3',
            location='[data-automation-id="jobLocation"], .location',
            base_url="https://www.northropgrumman.com",
            default_location="Falls Church, VA",
        ),
    ),
]

# Selectors tried on a page no spec describes.
DEFAULT_CARD_RULE = PageRule(
    container="article.job, div.job-listing, .job-card",
    title="h2.title, h3.title, .job-title",
    link="a[href], .job-link",
    location=".location, .job-location, [data-location]",
    date=".date, .posted-date, time",
    next_page="a.next, .pagination-next, a[rel='next']",
    max_pages=10,
)


def default_catalog() -> SourceCatalog:
    from vacancylake.sources.ats import flatten_greenhouse, flatten_workday

    parsers = {
        "opswat": flatten_greenhouse,
        "vancity": flatten_workday,
        "farm-credit-canada": lambda pages: flatten_workday(pages, "Canada", False),
    }
    return SourceCatalog(
        [
            SourceSpec(**{**{f.name: getattr(s, f.name) for f in fields(s)}, "parse": parsers.get(s.slug)})
            for s in SPECS
        ]
    )


def expand_listing_urls(sources: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The crawl frontier: one row per source and page number.

    ``sources``: slug, listing_url, paging, first_page_bare, max_pages, per_page.
    """
    last = F.col("max_pages") if max_pages is None else F.lit(max_pages)
    page, base, size = F.col("page_no"), F.col("listing_url"), F.col("per_page")
    joint = F.when(base.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    number = F.concat(F.lit("page="), page.cast("string"))
    url = (
        F.when(
            F.col("paging") == "offset",
            F.concat(
                base, joint, F.lit("offset="), ((page - 1) * size).cast("string"),
                F.lit("&limit="), size.cast("string"),
            ),
        )
        .when(
            F.col("paging") == "page_per_page",
            F.concat(base, joint, number, F.lit("&per_page="), size.cast("string")),
        )
        .when((page == 1) & F.col("first_page_bare"), base)
        .otherwise(F.concat(base, joint, number))
    )
    return (
        sources.withColumn("page_no", F.explode(F.sequence(F.lit(1), last)))
        .select(F.col("slug").alias("source"), "page_no", url.alias("url"))
    )


def should_continue(page_no, jobs_found, max_pages=10):
    """Whether a crawl goes on after a page (columns or literals)."""
    limit = max_pages if not isinstance(max_pages, int) else F.lit(max_pages)
    return (page_no < limit) & (jobs_found > 0)
