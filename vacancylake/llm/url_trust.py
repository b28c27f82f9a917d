"""URL filter: explicit rules first, link-graph trust for the hosts they leave open.

Host edges come from the pages' links and from the domain hierarchy. Trust is a
personalised PageRank from the hosts of allowed pages along the edges, distrust
one from the hosts of blocked pages against them. A host whose distrust exceeds
its trust is blocked. Everything is DataFrame work; state is one row per host.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.session import materialize

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)\b(?:href|src)\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"
DAMPING = 0.85
ROUNDS = 8
#: Scores this share apart count as equal, and equal scores allow. A share, since masses shrink as hosts are added.
TIE = 1e-9


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def apply_rules(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none does."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.host + r.path) if rule is None else F.when(fits, r.host + r.path).otherwise(rule)
        verdict = F.when(fits, r.verdict) if verdict is None else F.when(fits, r.verdict).otherwise(verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """Weighted edges (src, dst, weight) between different hosts, from pages (host, html).

    Links count once a page; the weight is log(1 + pages). Each host is also tied
    to its parent domain, both ways, with weight 1.
    """
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)),
                                          lambda h: F.translate(h, CAPITALS, SMALL)))
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
    links = links.filter("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    links = links.select("src", "dst", F.log1p("n").alias("weight"))
    hosts = pages.filter("host <> ''").select("host").union(links.select("dst")).distinct()
    labels = F.split("host", r"\.")
    # a.b.example.org climbs to b.example.org and example.org, never to a bare suffix
    chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = hosts.filter(F.size(labels) >= 3).select(chain.alias("chain"))
    steps = F.transform(F.sequence(F.lit(0), F.size("chain") - 2),
                        lambda i: F.struct(F.get("chain", i).alias("a"), F.get("chain", i + 1).alias("b")))
    steps = chain.select(F.explode(steps).alias("s")).select("s.a", "s.b").distinct()
    ties = steps.union(steps.select("b", "a")).select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1.0))
    return links.union(ties).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` steps; seeds are (kind, host, mass)."""
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    steps = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(backward)
    out = steps.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    steps = steps.join(out, ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("total")).alias("share"))
    steps = materialize(steps)
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))
    seeds = materialize(seeds.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("mass")))
    state = seeds
    base = seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass"))
    for step in range(rounds):
        moved = state.join(steps, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
        state = base.union(moved).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if step % 3 == 2:
            state = materialize(state)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0))
    return state.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, trust, distrust).

    A null url, or one without ``://``, has an empty host and path, no rule, and
    is allowed. Hosts that neither score reaches are allowed. Repeated rows are
    judged each; further columns of ``pages`` are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    kind = F.when(F.col("ruled") == "allow", "trust").when(F.col("ruled") == "block", "distrust")
    seeds = ruled.select(kind.alias("kind"), "host").filter("kind is not null and host <> ''")
    seeds = seeds.groupBy("kind", "host").agg(F.count(F.lit(1)).cast("double").alias("mass"))
    scores = propagate(host_edges(parsed.select("host", "html")), seeds)
    joined = ruled.join(scores, "host", "left")
    method = F.when(F.col("distrust") > F.col("trust") * (1 + TIE), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")


def judge_sql(rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS, damping: float = DAMPING) -> str:
    """The same judgement, without the scores, as one DuckDB statement over ``pages``."""
    ordered = sorted(rules, key=lambda r: -len(r.host + r.path))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    case = lambda pick: "CASE " + " ".join(
        f"WHEN {f} THEN '{pick(r)}'" for f, r in zip(fits, ordered, strict=True)) + " END"
    lower = lambda x: f"translate({x}, '{CAPITALS}', '{SMALL}')"
    link = _LINK.replace("'", "''")
    parts = [
        f"parsed AS (SELECT page_id, html, {lower(f"coalesce(regexp_extract(url, '{_URL}', 1), '')")} AS host, "
        f"coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages)",
        f"ruled AS (SELECT page_id, host, path, {case(lambda r: r.host + r.path)} AS rule, "
        f"{case(lambda r: r.verdict)} AS ruled FROM parsed)",
        f"links AS (SELECT src, dst, ln(1 + count(*)) AS weight FROM (SELECT page_id, host AS src, unnest(list_distinct("
        f"list_transform(regexp_extract_all(html, '{link}', 1), lambda h: {lower('h')}))) AS dst FROM parsed WHERE host <> '') "
        "WHERE src <> dst GROUP BY ALL)",
        "climb AS (SELECT DISTINCT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM ("
        "SELECT l, unnest(range(1, len(l) - 1)) AS i FROM (SELECT string_split(host, '.') AS l FROM ("
        "SELECT host FROM parsed WHERE host <> '' UNION SELECT dst FROM links)) WHERE len(l) >= 3))",
        "edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT a, b, 1.0 FROM climb "
        "UNION ALL SELECT b, a, 1.0 FROM climb) GROUP BY ALL)",
        "steps AS (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS share FROM ("
        "SELECT 'trust' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges))",
        "seeds AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS mass FROM (SELECT CASE ruled WHEN 'allow' "
        "THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM ruled WHERE ruled IS NOT NULL AND host <> '' "
        "GROUP BY ALL))",
        "state0 AS (SELECT * FROM seeds)",
    ]
    parts += [
        f"state{i} AS (SELECT kind, host, sum(mass) AS mass FROM (SELECT kind, host, mass * {1 - damping!r} AS mass FROM seeds "
        f"UNION ALL SELECT s.kind, t.dst, s.mass * t.share * {damping!r} FROM state{i - 1} s JOIN steps t "
        "ON s.kind = t.kind AND s.host = t.src) GROUP BY ALL)"
        for i in range(1, rounds + 1)
    ]
    parts.append("scores AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS trust, "
                 f"coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS distrust FROM state{rounds} GROUP BY host)")
    return "WITH " + ",\n".join(parts) + (
        "\nSELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN distrust > trust * "
        f"(1 + {TIE!r}) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN scores USING (host)"
    )
