"""Quality rules with thresholds from quantile sketches per language and source.

Texts are measured in flat arrays. Every measure becomes an integer rate; a sketch
counts the rates of a group in cells whose width is at most a 32nd of their value
(six leading bits), so sketches of any rows merge by adding counts, take a bounded
number of cells, and give quantiles within that error, the same in every run. A
group's limits lie beyond the quartiles by three times their distance; groups of
few documents take the limits of their language's merged sketch, languages of few
documents those of all. The limits are joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare
from vacancylake.operators.spread import attach
from vacancylake.session import materialize

#: Bytes of text measured at a time.
SLAB = 4 << 20
#: Base rules: fewest words, and most repeated words in a hundred.
LEAST_WORDS = 50
REPEATED = 50
#: Distance of a limit from its quartile, in quartile distances.
REACH = 3
#: Documents from which a group has limits of its own.
ENOUGH = 100
_BITS = 6

#: Measures: numerator, denominator and what is added to it (so that one line of three
#: is no high rate), units of the rate, least quartile distance, judged below too.
RATES = {
    "symbols": ("n_symbols", "word_chars", 0, 1_000_000, 30_000, False),
    "dup_lines": ("n_dup_lines", "n_lines", 5, 1_000_000, 100_000, False),
    "repeats": ("n_repeat_words", "n_words", 0, 1_000_000, 100_000, False),
    "word_length": ("word_chars", "n_words", 0, 1_000, 500, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the marked bytes of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[offsets])


def _repeated(doc: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which entries share document and group with another one."""
    key = doc * (int(group.max()) + 1 if len(group) else 1) + group
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back] > 1


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of every text; a null text is empty."""
    raw, offsets = W.flat_bytes(texts)
    docs = len(offsets) - 1
    blank = W.BLANKS[raw]
    starts, ends = W.runs(~blank, offsets)
    bounds = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    out = {
        "n_words": np.diff(bounds),
        "word_chars": _sum_by(~blank & ((raw & 0xC0) != 0x80), offsets),
        "n_symbols": _sum_by(_SYMBOL[raw], offsets),
    }

    # lines with a word, and those equal to an earlier one
    line_starts, line_ends = W.runs(raw != 10, offsets)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    out["n_lines"] = np.bincount(line_doc, minlength=docs)
    _, own, line = W.distinct(raw, line_starts, line_ends - line_starts)
    once = np.unique(line_doc * max(1, len(own)) + line) // max(1, len(own))
    out["n_dup_lines"] = out["n_lines"] - np.bincount(once, minlength=docs)

    # words in windows of three that occur again in their text
    _, own, word = W.distinct(raw, starts, ends - starts)
    at = np.arange(max(0, len(word) - 2))
    at = at[doc[at] == doc[at + 2]]
    base = len(own) + 1
    pair = np.unique(word[at] * base + word[at + 1], return_inverse=True)[1]
    triple = np.unique(pair * base + word[at + 2], return_inverse=True)[1]
    again = at[_repeated(doc[at], triple)]
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[again + k] = True
    out["n_repeat_words"] = _sum_by(covered, bounds)
    return out


def measure(documents: DataFrame, into: str) -> DataFrame:
    """All columns of the documents and a struct ``into`` with :data:`COUNTS`."""
    prepare(documents.sparkSession)
    text = documents.columns.index("text")
    struct = StructType.fromDDL(", ".join(f"{c} bigint" for c in COUNTS))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(text), SLAB):
            part = batch.slice(lo, hi - lo)
            found = counts(part.column(text))
            values = pa.StructArray.from_arrays([pa.array(found[c].astype(np.int64)) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, into])

    return map_batches(documents, run, StructType([*documents.schema.fields]).add(into, struct))


def base_failed(m: str) -> Column:
    return F.expr(f"{m}.n_words < {LEAST_WORDS} or 100 * {m}.n_repeat_words > {REPEATED} * {m}.n_words")


def rate(name: str, m: str) -> Column:
    top, bottom, added, units, _, _ = RATES[name]
    return F.expr(f"{units} * {m}.{top} div greatest({m}.{bottom} + {added}, 1)")


def cell(value: Column) -> Column:
    """Lower end of the sketch cell of an integer: its six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - _BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame, m: str) -> DataFrame:
    """(lang, source, rule, cell, n): the sketches of the documents that pass the base rules."""
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), cell(rate(name, m)).alias("cell")) for name in RATES])
    rows = measured.filter(~base_failed(m)).select("lang", "source", F.explode(rules).alias("r"))
    return rows.groupBy("lang", "source", "r.rule", "r.cell").agg(F.count(F.lit(1)).alias("n"))


def merge(cells: DataFrame, *group: str) -> DataFrame:
    """Sketches of coarser groups."""
    return cells.groupBy(*group, "rule", "cell").agg(F.sum("n").alias("n"))


def limits(cells: DataFrame, *group: str) -> DataFrame:
    """One row a group: docs, and low_<rule> and high_<rule> of every rule.

    A sketch has at most about 2,000 cells, so the running sum of a group is bounded.
    """
    whole = Window.partitionBy(*group, "rule")
    upto = whole.orderBy("cell")
    ranked = cells.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(upto))
    quartile = [F.min(F.when(F.col("upto") >= F.expr(f"({k} * total + 3) div 4"), F.col("cell"))).alias(f"q{k}") for k in (1, 3)]
    quartiles = ranked.groupBy(*group, "rule").agg(F.max("total").alias("total"), *quartile)
    columns = [F.max("total").alias("docs")]
    for name, (*_, least, both) in RATES.items():
        reach = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * REACH
        own = F.col("rule") == name
        columns.append(F.max(F.when(own, F.col("q3") + reach)).alias(f"high_{name}"))
        columns.append(F.max(F.when(own, F.col("q1") - reach)).alias(f"low_{name}") if both else F.lit(-1).alias(f"low_{name}"))
    return quartiles.groupBy(*group).agg(*columns)


def thresholds(measured: DataFrame, m: str) -> DataFrame:
    """(lang, source, known, level, low_*, high_*) of every language and source that occurs.

    ``known`` is a key free of nulls. A group without documents that pass the base
    rules has no row: its documents have failed already.
    """
    own = materialize(sketches(measured, m))
    by_lang = materialize(merge(own, "lang"))
    names = [f"{side}_{name}" for name in RATES for side in ("low", "high")]

    def packed(cells: DataFrame, label: str, *group: str) -> DataFrame:
        return limits(cells, *group).select(*group, F.struct("docs", *names).alias(label))

    of_all = packed(merge(by_lang), "all_").select("all_")
    table = packed(own, "own", "lang", "source").alias("t")
    table = table.join(packed(by_lang, "language", "lang").alias("l"), F.expr("t.lang <=> l.lang")).select("t.*", "language")
    table = table.join(F.broadcast(of_all))  # one row
    level = F.when(F.col("own.docs") >= ENOUGH, "source").when(F.col("language.docs") >= ENOUGH, "language").otherwise("all")
    picked = [
        F.when(F.col("level") == "source", F.col(f"own.{c}")).when(F.col("level") == "language", F.col(f"language.{c}"))
        .otherwise(F.col(f"all_.{c}")).alias(c)
        for c in names
    ]
    table = table.withColumn("level", level)
    return materialize(table.select(_group(F.col("lang"), F.col("source")).alias("known"), "level", *picked))


def _group(lang: Column, source: Column) -> Column:
    """Language and source as one text, nulls told from every other value."""
    return F.to_json(F.struct(lang.alias("l"), source.alias("s")))


def judge(documents: DataFrame, limits_of: DataFrame, m: str) -> DataFrame:
    """Measured documents with (base_failed, failed, kept).

    ``failed`` names the rules broken, comma-joined, empty if none. A document that
    fails the base rules is not judged further.
    """
    names = [c for c in limits_of.columns if c != "known"]
    renamed = limits_of.select(F.col("known").alias("_known"), *(F.col(c).alias(f"_limit_{c}") for c in names))
    joined = attach(documents.withColumn("_known", _group(F.col("lang"), F.col("source"))), renamed, ["_known"], "left")
    broken = [
        F.when((rate(name, m) > F.col(f"_limit_high_{name}")) | (rate(name, m) < F.col(f"_limit_low_{name}")), F.lit(name))
        for name in RATES
    ]
    failed = F.when(base_failed(m), F.lit("")).otherwise(F.concat_ws(",", *broken))
    out = joined.withColumn("base_failed", base_failed(m)).withColumn("failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed") == "")).drop("_known", *(f"_limit_{c}" for c in names))


def rate_documents(documents: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed).

    Null texts are empty and fail by their number of words. A null language or
    source is a group like any other; equal rows are judged each; an empty table
    gives no rows; extra columns are not read.
    """
    m = "measures"
    measured = measure(documents.select("doc_id", "lang", "source", "text"), m).drop("text")
    measured = materialize(measured)
    judged = judge(measured, thresholds(measured, m), m)
    return judged.select("doc_id", *(F.col(f"{m}.{c}").alias(c) for c in COUNTS if c != "n_lines"), "base_failed", "kept", "failed")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    taken = set(documents.columns)
    m = next(name for name in ("measures", *(f"measures_{k}" for k in range(len(taken) + 1))) if name not in taken)
    light = materialize(measure(documents.select("lang", "source", "text"), m).select("lang", "source", m))
    held = documents.select("text", "lang", "source", F.struct(*[F.col(c) for c in documents.columns]).alias("row"))
    judged = judge(measure(held, m), thresholds(light, m), m)
    return judged.filter("kept").select("row.*")


def _sql() -> str:
    rates = " UNION ALL ".join(
        f"SELECT r, doc_id, lang, source, '{name}' AS rule, {units}::BIGINT * {top} // greatest({bottom} + {added}, 1) AS v FROM measured"
        for name, (top, bottom, added, units, _, _) in RATES.items()
    )
    least = "CASE rule " + " ".join(f"WHEN '{name}' THEN {least}" for name, (*_, least, _) in RATES.items()) + " END"
    both = ", ".join(f"'{name}'" for name, (*_, both) in RATES.items() if both)

    def quartiles(name: str, group: str) -> str:
        by = f"{group}, " if group else ""
        return f"""
{name}_cells AS (SELECT {by}rule, cell, count(*) AS n FROM cells GROUP BY ALL),
{name}_q AS (
    SELECT {by}rule, max(total) AS docs, min(cell) FILTER (upto >= (total + 3) // 4) AS q1,
        min(cell) FILTER (upto >= (3 * total + 3) // 4) AS q3
    FROM (SELECT *, sum(n) OVER (PARTITION BY {by}rule)::BIGINT AS total,
        sum(n) OVER (PARTITION BY {by}rule ORDER BY cell)::BIGINT AS upto FROM {name}_cells) GROUP BY ALL),
{name}_l AS (SELECT *, q3 + {REACH} * greatest(q3 - q1, {least}) AS high,
    CASE WHEN rule IN ({both}) THEN q1 - {REACH} * greatest(q3 - q1, {least}) ELSE -1 END AS low FROM {name}_q)"""

    return rf"""
WITH base AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT r, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
measured AS (
    SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM base LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed FROM measured),
rates AS ({rates}),
cells AS (
    SELECT rates.*, (v >> greatest(length(bin(v)) - {_BITS}, 0)) << greatest(length(bin(v)) - {_BITS}, 0) AS cell
    FROM rates JOIN judged USING (r) WHERE NOT base_failed),
{quartiles("own", "lang, source")}, {quartiles("tongue", "lang")}, {quartiles("every", "")},
broken AS (
    SELECT c.r, string_agg(c.rule, ',' ORDER BY list_position([{", ".join(f"'{n}'" for n in RATES)}], c.rule)) AS failed
    FROM cells c JOIN own_l o ON c.rule = o.rule AND c.lang IS NOT DISTINCT FROM o.lang AND c.source IS NOT DISTINCT FROM o.source
    JOIN tongue_l t ON c.rule = t.rule AND c.lang IS NOT DISTINCT FROM t.lang JOIN every_l e ON c.rule = e.rule
    WHERE c.v > CASE WHEN o.docs >= {ENOUGH} THEN o.high WHEN t.docs >= {ENOUGH} THEN t.high ELSE e.high END
       OR c.v < CASE WHEN o.docs >= {ENOUGH} THEN o.low WHEN t.docs >= {ENOUGH} THEN t.low ELSE e.low END
    GROUP BY c.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed
FROM judged LEFT JOIN broken USING (r)
"""


RULES_SQL = _sql()
