"""Ranked lexical search by an Aho-Corasick scan of every document.

The terms of all items, each between two guards, form one automaton. A text whose
separators are replaced by the guard yields the frequencies of exactly these terms
in one pass; the term's items are looked up behind its output. No index of the
documents is built: one scan counts how many documents hold each term, a second
one scores them. Items go out in blocks of bounded size, one broadcast at a time;
every task keeps the best documents of each item of the block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import prepare
from vacancylake.session import materialize

#: Terms: runs of ASCII letters and digits and of all other characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 10
#: Bytes of the terms of all items of a block, which bounds what is broadcast.
BLOCK_BYTES = 4 << 20
#: Bytes of text scanned at a time, cut between terms.
PIECE = 1 << 20
#: Scores worked out together.
CELLS = 1 << 21
_GUARD = " "
_SCANNED = bytes(32 if W.NOT_ALNUM[b] else int(W.LOWER[b]) for b in range(256))


class Terms(NamedTuple):
    """The terms of a block, and which items hold each."""

    spelled: list[str]
    item: np.ndarray  # of term t: item[bounds[t] : bounds[t + 1]]
    bounds: np.ndarray
    per_item: int  # most terms of one item


class Weights(NamedTuple):
    n_docs: int
    n_terms: int
    weight: np.ndarray


def terms_of(text: Column) -> Column:
    """All terms of a text, in order, with A-Z lowered; none for null."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


@lru_cache(maxsize=1)
def _automaton(token: str, spelled: tuple[str, ...]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, term in enumerate(spelled):
        automaton.add_word(f"{_GUARD}{term}{_GUARD}", k)
    automaton.make_automaton()
    return automaton


def frequencies(automaton: ahocorasick.Automaton, text: bytes) -> Counter:
    """How often each term stands in a text, counted between guards."""
    text = text.translate(_SCANNED)
    found: Counter = Counter()
    at = 0
    while at < len(text):
        to = at + PIECE
        to = len(text) if to >= len(text) else max(text.rfind(b" ", at, to), at) + 1
        if to <= at + 1 < len(text):  # a piece without a separator goes on to the next one
            to = text.find(b" ", at + PIECE) + 1 or len(text)
        found.update(map(itemgetter(1), automaton.iter(f"{_GUARD}{text[at:to].decode()}{_GUARD}")))
        at = to
    return found


def _counted(texts: pa.Array, automaton: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every text with repeats; text, term and frequency of those of the block."""
    n = np.diff(W.split(texts, W.NOT_ALNUM).bounds)
    raw, offsets = W.flat_bytes(texts)
    body = raw.tobytes()
    found = [frequencies(automaton, body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    sizes = [len(c) for c in found]
    total = sum(sizes)
    term = np.fromiter(chain.from_iterable(found), np.int64, total)
    tf = np.fromiter(chain.from_iterable(c.values() for c in found), np.int64, total)
    return n, np.repeat(np.arange(len(found)), sizes), term, tf


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """(item_id, term, block) of the distinct terms of every item, and the number of blocks."""
    pairs = items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    pairs = materialize(pairs)
    size = pairs.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    return pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), blocks


def _terms(pairs: pa.Table) -> tuple[Terms, pa.Array]:
    """Terms in order, and the item ids by number."""
    ids = pairs["item_id"].combine_chunks().dictionary_encode("encode")
    terms = pairs["term"].combine_chunks().dictionary_encode()
    item, term = ids.indices.to_numpy().astype(np.int64), terms.indices.to_numpy().astype(np.int64)
    order = np.lexsort((item, term))
    spelled = terms.dictionary.to_pylist()
    bounds = np.searchsorted(term[order], np.arange(len(spelled) + 1))
    return Terms(spelled, item[order], bounds, int(np.bincount(item).max())), ids.dictionary


def _document_counts(documents: DataFrame, sent, token: str, size: int) -> Weights:
    """Number of documents with terms, of all terms, and weight of each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, terms = np.zeros(size, np.int64), 0, 0
        automaton = _automaton(token, tuple(sent.value.spelled))
        for batch in batches:
            for lo, hi in W.slabs(batch.column(0), PIECE):
                n, _, term, _ = _counted(batch.column(0).slice(lo, hi - lo), automaton)
                docs, terms = docs + int(np.count_nonzero(n)), terms + int(n.sum())
                df += np.bincount(term, minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], held])), pa.array(np.concatenate([[docs, terms], df[held]]))], names=["term", "n"])

    counts = documents.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = counts.toArrow()  # a row a term of the block
    term, n = counts["term"].to_numpy(), counts["n"].to_numpy()
    df = np.zeros(size + 2, np.int64)
    df[term + 2] = n
    n_docs, n_terms = int(df[0]), int(df[1])
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df[2:].tolist()]
    return Weights(n_docs, n_terms, np.array(weight, np.int64))


class _Best:
    """The highest-scoring documents of each item so far."""

    def __init__(self, items: int, best: int):
        self.best, self.rows = best, np.zeros((4, 0), np.int64)  # item, -score, id is null, id
        self.least = np.zeros(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, absent: np.ndarray, doc_id: np.ndarray) -> None:
        keep = (score > 0) & (score >= self.least[item])
        rows = np.concatenate([self.rows, np.stack([item[keep], -score[keep], absent[keep], doc_id[keep]])], axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        starts = np.flatnonzero(np.diff(rows[0], prepend=-1))
        place = np.arange(rows.shape[1]) - np.repeat(starts, np.diff(np.append(starts, rows.shape[1])))
        self.rows = rows[:, place < self.best]
        full = place == self.best - 1
        self.least[rows[0, full]] = -rows[1, full]


def _sums(key: np.ndarray, value: np.ndarray, size: int, addends: int) -> np.ndarray:
    """Sums of integers by key, exact beyond what a double holds."""
    if not len(value) or int(value.max()) * addends < 1 << 53:
        return np.bincount(key, value, size).astype(np.int64)
    return (np.bincount(key, value >> 24, size).astype(np.int64) << 24) + np.bincount(key, value & 0xFFFFFF, size).astype(np.int64)


def _score(best: _Best, terms: Terms, known: Weights, ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
    m = 10 + 90 * n * known.n_docs // known.n_terms
    share = known.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    fan = np.diff(terms.bounds)[term]
    items = len(best.least)
    absent = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    per_doc = np.bincount(doc, fan, len(n)).astype(np.int64) + items
    ends = np.cumsum(per_doc)
    first = 0
    while first < len(n):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CELLS, "right")))
        a, b = np.searchsorted(doc, [first, last])
        item = terms.item[W.places(terms.bounds[term[a:b]], fan[a:b])]
        key = np.repeat((doc[a:b] - first) * items, fan[a:b]) + item
        score = _sums(key, np.repeat(share[a:b], fan[a:b]), (last - first) * items, terms.per_item)
        hit = np.flatnonzero(score)
        at, item = first + hit // items, hit % items
        best.add(item, score[hit], absent[at], names[at])
        first = last


def _best_of_block(documents: DataFrame, pairs: pa.Table, best: int) -> tuple[DataFrame, pa.Array]:
    """(item, doc_id, score) candidates of a block's items, ``best`` of each item a task."""
    spark = documents.sparkSession
    terms, ids = _terms(pairs)
    sent = spark.sparkContext.broadcast(terms)
    token = str(sent._jbroadcast.id())
    known = _document_counts(documents, sent, token, len(terms.spelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        automaton = _automaton(token, tuple(block.spelled))
        kept = _Best(int(block.item.max()) + 1, best)
        for batch in batches:
            for lo, hi in W.slabs(batch.column(1), PIECE):
                _score(kept, block, known, batch.column(0).slice(lo, hi - lo), *_counted(batch.column(1).slice(lo, hi - lo), automaton))
        item, score, absent, doc_id = kept.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc_id, mask=absent == 1), pa.array(-score)], names=["item", "doc_id", "score"])

    found = documents.select("doc_id", "text").mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    found = materialize(found)
    sent.destroy()
    return found, ids


def rank(documents: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents of each item: (item_id, rank, doc_id, score).

    Only scores above 0 count; equal scores go by ascending doc_id, null ids last.
    Every row is a document, equal rows too; rows of one item_id (null included) are
    one item with the terms of all. Items or documents without terms give no rows.
    """
    spark = documents.sparkSession
    prepare(spark)
    pairs, blocks = _blocks(items)
    kind = items.schema["item_id"].dataType.simpleString()
    out = None
    for k in range(blocks):
        block = pairs.filter(F.col("block") == k).select("item_id", "term").toArrow()
        if not block.num_rows:
            continue
        found, ids = _best_of_block(documents, block, best)
        names = pa.table({"item": pa.array(range(len(ids)), pa.int64()), "item_id": ids})
        named = spark.createDataFrame(names, f"item bigint, item_id {kind}")
        part = found.join(F.broadcast(named), "item").select("item_id", "doc_id", "score")  # a block's items
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")


#: The same ranking in DuckDB.
RANK_SQL = rf"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms FROM documents),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS terms FROM cut WHERE len(terms) > 0),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
held AS (
    SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM cut)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, total GROUP BY term),
shares AS (
    SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(c.terms) * docs) // t.terms))) AS share
    FROM held JOIN cut c USING (r) JOIN weights USING (term), total t),
scores AS (
    SELECT item_id, doc_id, r, sum(share)::BIGINT AS score FROM shares JOIN wanted USING (term) JOIN cut USING (r)
    GROUP BY ALL HAVING sum(share) > 0)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores)
WHERE rank <= {BEST}
"""
