"""Listings, links and page facts from fetched HTML.

One ``mapInArrow`` pass parses each page once; everything an expression can
tell from the text alone stays native.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions.text import source_job_id
from vacancylake.functions.urls import resolve_url
from vacancylake.operators.spread import attach, fill_cores
from vacancylake.sources import markup
from vacancylake.sources.specs import DEFAULT_CARD_RULE, RULE_SCHEMA, PageRule

# Words and elements that mark a page of listings.
LISTING_WORDS = ["job", "career", "position", "opportunity", "employment"]
LISTING_ELEMENTS = ".job, .listing, .position, article, .job-card"

# Signs of a bot challenge or a refusal, lower case.
CHALLENGE_TITLES = ["checking your browser", "just a moment", "cloudflare", "attention required"]
BLOCKED_KEYWORDS = [
    "access denied",
    "forbidden",
    "403",
    "rate limit",
    "blocked",
    "captcha",
    "reached limit",
]
CHALLENGE_KEYWORDS = [
    "cloudflare",
    "checking your browser",
    "please wait",
    "ray id",
    "browser check",
    "attention required",
    "ddos protection",
]

#: Pages whose text is held as Python objects at a time.
PAGES_AT_ONCE = 32

_EXTRACT_FIELDS = {
    "source": "string",
    "page_no": "int",
    "kind": "string",
    "pos": "int",
    "title": "string",
    "url": "string",
    "location": "string",
    "date_text": "string",
    "id_text": "string",
    "warning": "string",
    "next_page": "string",
}
_ARROW = {"string": pa.string(), "int": pa.int32()}


def _absolute(href: str, base: str | None) -> str:
    if not href or not base or href.startswith(("http://", "https://")):
        return href
    try:
        return urljoin(base, href)
    except ValueError:
        return href


def _text(node: markup.Node | None) -> str:
    return node.text() if node is not None else ""


def _listing(card: markup.Node, rule: dict) -> dict:
    """Fields of one container under one rule."""
    title = markup.select_one(card, rule["title"])
    place = markup.select_one(card, rule["location"])
    base = rule["base_url"]
    if rule["family"] == "browser":
        # Rendered cards: the title element is itself the link.
        own = title.attrs.get("href", "") if title is not None else ""
        url = own if not own or own.startswith("http") else f"{base}{own}"
        found = {
            "title": title.text("") if title is not None and url else "",
            "url": url,
            "location": place.text("") if place is not None else rule["default_location"],
            "silent": not url,
        }
    else:
        link = markup.select_one(card, rule["link"])
        if rule["url_attribute"] == "href":
            url = _absolute(markup.link_of(link), base)
        else:
            url = link.attrs.get(rule["url_attribute"], "") if link is not None else ""
        found = {
            "title": _text(title),
            "url": url,
            "location": _text(place) or rule["default_location"],
            "silent": False,
        }
    found["date_text"] = _text(markup.select_one(card, rule["date"]))
    found["id_text"] = card.attrs.get(rule["id_attribute"]) if rule["id_attribute"] else None
    return found


def _misread(rule: dict) -> str | None:
    """What is wrong with a rule's selectors."""
    for name in ("container", "title", "link", "location", "date", "next_page"):
        try:
            if rule[name]:
                markup.compile_selector(rule[name])
        except ValueError as problem:
            return f"{name}: {problem}"
    return None


def _page_rows(page: dict, need_url: bool, noun: str) -> Iterator[dict]:
    base = {"source": page["source"], "page_no": page["page_no"]}
    if problem := _misread(page):
        yield base | {"kind": "warning", "warning": problem}
        yield base | {"kind": "page", "pos": 0}
        return
    root = markup.parse(page["html"])
    cards = markup.select(root, page["container"])
    kept = 0
    if not cards and need_url and page["family"] != "browser":
        yield base | {
            "kind": "warning",
            "warning": f"Container selector '{page['container']}' matched no elements",
        }
    for pos, card in enumerate(cards):
        found = _listing(card, page)
        silent = found.pop("silent")
        if found["title"] and (found["url"] or not need_url):
            kept += 1
            yield base | found | {"kind": "job", "pos": pos}
        elif not found["title"] and not silent:
            yield base | {"kind": "warning", "pos": pos, "warning": f"Skipping {noun} without title"}
    following = markup.link_of(markup.select_one(root, page["next_page"])) or None
    yield base | {"kind": "page", "pos": kept, "next_page": following}


def _few_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same pages, few at a time, since each becomes a Python text."""
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            yield batch.slice(at, PAGES_AT_ONCE)


def _extract(pages: DataFrame, need_url: bool, noun: str) -> DataFrame:
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in _EXTRACT_FIELDS.items()])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_pages(batches):
            rows = [r for page in batch.to_pylist() for r in _page_rows(page, need_url, noun)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    columns = [
        "source", "page_no", "html", "family", "container", "title", "link", "location", "date",
        "url_attribute", "base_url", "default_location", "id_attribute", "next_page",
    ]
    returned = ", ".join(f"{name} {kind}" for name, kind in _EXTRACT_FIELDS.items())
    spread = fill_cores(pages.select(*columns), ["source", "page_no"])
    return spread.mapInArrow(parse, returned)


def extract_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Everything one parse yields for pages (source, page_no, html).

    ``kind`` is job, warning or page; a page row holds the number of listings
    kept in ``pos`` and the link to the next page. ``rules`` has one row per
    source; pages of a source without a rule yield nothing, those of one whose rule
    has a selector that cannot be read a warning and no listings.
    """
    ruled = attach(pages.select("source", "page_no", "html"), rules, ["source"], "inner")
    return _extract(ruled, need_url=True, noun="job")


def listings(extracted: DataFrame) -> DataFrame:
    """The job rows of :func:`extract_pages` as raw listing rows."""
    pattern_id = source_job_id(F.col("url"), F.col("source"))
    return extracted.filter("kind = 'job'").select(
        "source",
        "page_no",
        "pos",
        F.coalesce("id_text", pattern_id).alias("source_job_id"),
        "title",
        "location",
        "url",
        F.nullif("date_text", F.lit("")).alias("date_posted"),
        F.lit(None).cast("string").alias("raw_data"),
    )


def extraction_warnings(extracted: DataFrame) -> DataFrame:
    return extracted.filter("kind = 'warning'").select("source", "page_no", "pos", "warning")


def page_summary(extracted: DataFrame) -> DataFrame:
    """Per page: listings found and next-page link."""
    return extracted.filter("kind = 'page'").select(
        "source", "page_no", F.col("pos").alias("jobs_found"), "next_page"
    )


def extract_listings(pages: DataFrame, rules: DataFrame) -> DataFrame:
    return listings(extract_pages(pages, rules))


def _one_rule(pages: DataFrame, rule: PageRule, base_url: Column | None) -> DataFrame:
    keep = [c for c in ("source", "page_no", "html") if c in pages.columns]
    values = {"family": "html", **rule.__dict__}
    types = dict(part.strip().split(" ") for part in RULE_SCHEMA.split(","))
    columns = [
        F.lit(values[n]).cast(types[n]).alias(n)
        for n in types
        if n not in ("source", "base_url")
    ]
    base = F.lit(rule.base_url) if base_url is None else base_url
    return pages.select(*keep, *columns, base.alias("base_url"))


def extract_cards(
    pages: DataFrame, rule: PageRule = DEFAULT_CARD_RULE, base_url: Column | None = None
) -> DataFrame:
    """Card rows by default selectors; a title is enough to keep a card."""
    return _extract(_one_rule(pages, rule, base_url), need_url=False, noun="card")


def next_page_url(pages: DataFrame, selector: str = DEFAULT_CARD_RULE.next_page) -> DataFrame:
    """Pages with the href of their next-page link, null when there is none."""
    rule = PageRule(container="html-without-such-element", next_page=selector)
    return page_summary(_extract(_one_rule(pages, rule, None), False, "card")).select(
        "source", "page_no", "next_page"
    )


def with_match_counts(pages: DataFrame, selectors: list[str], key: list[str]) -> DataFrame:
    """``key`` columns of each page and a map of selector to match count.

    A text that is no selector counts 0; an unsupported selector raises here.
    """
    for selector in selectors:
        with suppress(markup.InvalidSelector):
            markup.compile_selector(selector)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pages.select(*key).schema.fields]
    counts = pa.map_(pa.string(), pa.int32())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_pages(batches):
            roots = map(markup.parse, batch.column("html").to_pylist())  # one at a time
            found = [[(s, markup.count(root, s)) for s in selectors] for root in roots]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in key] + [pa.array(found, counts)],
                names=[*key, "match_counts"],
            )

    return fill_cores(pages.select(*key, "html"), key).mapInArrow(
        tally, ", ".join(fields) + ", match_counts map<string,int>"
    )


def count_selector_matches(pages: DataFrame, selectors: list[str], key: list[str]) -> DataFrame:
    """(page key, selector, match_count, matched) for every selector."""
    counted = with_match_counts(pages, selectors, key)
    return counted.select(*key, F.explode("match_counts").alias("selector", "match_count")).withColumn(
        "matched", F.col("match_count") > 0
    )


def _without_hidden(html: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(html, r"(?s)<!--.*?-->", " "),
        r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>",
        " ",
    )


def visible_text(html: Column) -> Column:
    """Page text with markup removed, for keyword tests."""
    return F.regexp_replace(_without_hidden(html), r"<[^>]*>", "")


def _referred(reference: Column) -> Column:
    """The character a numeric reference stands for; an ampersand stays a reference."""
    digits = F.regexp_extract(reference, "([0-9a-fA-F]+);", 1)
    number = F.when(F.lower(reference).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    sound = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    code = F.lpad(F.hex(F.when(sound, number).otherwise(0xFFFD)), 8, "0")
    return F.when(number == 38, "&amp;").otherwise(F.decode(F.unhex(code), "UTF-32"))


def unescape(text: Column) -> Column:
    """Text with numeric character references and those to markup signs decoded."""
    numeric = F.array_distinct(F.regexp_extract_all(text, F.lit("&#(?:[xX][0-9a-fA-F]{1,8}|[0-9]{1,9});"), F.lit(0)))
    decoded = F.aggregate(numeric, text, lambda done, r: F.replace(done, r, _referred(r)))
    text = F.when(text.contains("&#"), decoded).otherwise(text)
    for entity, char in (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def extract_links(pages: DataFrame, base_url: Column, key: list[str]) -> DataFrame:
    """Anchors that look like listing links, made absolute, in page order."""
    anchors = F.regexp_extract_all(
        _without_hidden(F.col("html")),
        F.lit(r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""),
        F.lit(1),
    )
    href = unescape(F.regexp_replace("_href", r"""^["']|["']$""", ""))
    return (
        pages.select(*key, base_url.alias("_base"), F.posexplode(anchors).alias("pos", "_href"))
        .withColumn("_href", href)
        .filter(
            (F.col("_href") != "")
            & (F.lower("_href").contains("job") | F.col("_href").contains("/careers/"))
        )
        .select(
            *key,
            "pos",
            F.when(F.col("_href").startswith("http"), F.col("_href"))
            .otherwise(resolve_url(F.col("_base"), F.col("_href")))
            .alias("url"),
        )
    )


def is_listing_page(pages: DataFrame, key: list[str]) -> DataFrame:
    """Pages with two listing words in their text or two listing elements."""
    words = sum(
        (F.lower(visible_text(F.col("html"))).contains(w).cast("int") for w in LISTING_WORDS),
        F.lit(0),
    )
    # The word count rides along through the parse, so no join is needed.
    worded = pages.withColumn("_words", words)
    counted = with_match_counts(worded, [LISTING_ELEMENTS], [*key, "_words"])
    elements = F.least(F.element_at("match_counts", LISTING_ELEMENTS), F.lit(5))
    return counted.select(
        *key,
        F.col("_words").alias("word_matches"),
        elements.alias("element_matches"),
        ((F.col("_words") >= 2) | (elements >= 2)).alias("is_listing"),
    )


def _any_of(text: Column, words: list[str], mode: str) -> Column:
    if mode == "word":
        quoted = "|".join(w.replace(" ", r"\s+") for w in words)
        return text.rlike(rf"\b({quoted})\b")
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def challenge_type(html: Column, mode: str = "substring") -> Column:
    """title, blocked or challenge when a page looks like a bot wall, else null.

    ``mode="word"`` asks for whole words, so that a number such as 1403 does
    not count as 403.
    """
    if mode not in ("substring", "word"):
        raise ValueError(f"unknown mode: {mode}")
    lowered = F.lower(html)
    title = F.regexp_extract(lowered, r"(?s)<title[^>]*>(.*?)</title>", 1)
    return (
        F.when(_any_of(title, CHALLENGE_TITLES, mode), "title")
        .when(_any_of(lowered, BLOCKED_KEYWORDS, mode), "blocked")
        .when(_any_of(lowered, CHALLENGE_KEYWORDS, mode), "challenge")
    )


def classify_challenge(pages: DataFrame, mode: str = "substring") -> DataFrame:
    kind = challenge_type(F.col("html"), mode)
    return pages.withColumn("challenge_type", kind).withColumn(
        "challenge_detected", F.col("challenge_type").isNotNull()
    )
