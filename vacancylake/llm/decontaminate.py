"""Benchmark decontamination by pigeonhole edit matching.

A test item of n bytes may differ by k = rate * n edits. Cut into k + 1 pieces,
one piece of any such match is untouched, so exact piece hits find all
candidates: rolling hashes of every position are looked up among the pieces'.
Myers' bit-parallel distance verifies the text around each hit. Both sides are
compared as small letters and digits with single spaces between words. A short
item that may not differ at all is looked up whole, between word boundaries.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare

#: Edits allowed per byte of an item.
RATE = 0.06
#: Items shorter than this, in normalized bytes, for which the rate allows no edit, must stand as whole words.
MIN_BYTES = 24
#: Items are searched in blocks of about so many bytes; a block is sent to every worker.
BLOCK_BYTES = 2 << 20
_FILTER_BITS = 22
#: Scripts written without spaces between words; particles follow a Hangul word unspaced.
_UNSPACED = re.compile("[\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3100-\u9fff"
                       "\ua000-\ua4cf\uac00-\ud7af\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


class Item(NamedTuple):
    item_id: int
    text: bytes
    budget: int


class Index(NamedTuple):
    items: list[Item]
    width: int  # bytes of a piece that are hashed
    keys: np.ndarray  # piece hashes, ascending
    item: np.ndarray  # item of each piece
    begin: np.ndarray  # its place in the item
    size: np.ndarray
    passes: np.ndarray  # by the upper bits of a hash: some piece has them
    whole: dict[int, tuple[np.ndarray, np.ndarray]]  # by length, of items looked up whole: hashes, ascending, and items


def normalize(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, normalized, and the offsets of each."""
    words = W.split(pc.utf8_lower(texts), W.NOT_ALNUM)
    keep = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(keep, words.starts, 1)
    np.add.at(keep, words.ends, -1)
    keep = np.cumsum(keep[:-1]) > 0
    data = words.data.copy()
    doc_end = words.offsets[1:][words.doc]
    gaps = words.ends[(words.ends < doc_end)]
    gaps = gaps[~keep[gaps]]
    keep[gaps] = True
    data[gaps] = 32
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[words.offsets]


def build_index(items: list[tuple[int, str | None]], rate: float = RATE) -> Index:
    data, offsets = normalize(pa.array([t for _, t in items], pa.string()))
    found, rows, short = [], [], {}
    for (item_id, _), a, b in zip(items, offsets[:-1], offsets[1:], strict=True):
        text = data[a:b].tobytes().strip()
        budget = int(rate * len(text))
        if text and len(text) < MIN_BYTES and not budget:
            short.setdefault(len(text), []).append(len(found))
            found.append(Item(item_id, text, budget))
        elif text:
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            rows += [(len(found), lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
            found.append(Item(item_id, text, budget))
    whole = {}
    for size, items_of in short.items():
        joined = np.frombuffer(b"".join(found[k].text for k in items_of), np.uint8)
        starts = np.arange(len(items_of)) * size
        keys = W.hash_spans(joined, starts, starts + size)
        order = np.argsort(keys, kind="stable")
        whole[size] = keys[order], np.array(items_of)[order]
    if not rows:
        none = np.zeros(0, np.int64)
        return Index(found, 1, none.astype(np.uint64), none, none, none, np.zeros(1 << _FILTER_BITS, bool), whole)
    width = min(size for _, _, size in rows)
    heads = b"".join(found[k].text[lo : lo + width] for k, lo, _ in rows)
    starts = np.arange(len(rows)) * width
    keys = W.hash_spans(np.frombuffer(heads, np.uint8), starts, starts + width)
    order = np.argsort(keys, kind="stable")
    columns = np.array(rows)[order]
    passes = np.zeros(1 << _FILTER_BITS, bool)
    passes[keys >> np.uint64(64 - _FILTER_BITS)] = True
    return Index(found, width, keys[order], columns[:, 0], columns[:, 1], columns[:, 2], passes, whole)


def myers(pattern: bytes, text: bytes, budget: int) -> tuple[int, int] | None:
    """(least distance, first end in ``text``) of an approximate occurrence within ``budget``."""
    peq: dict[int, int] = {}
    for k, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << k
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance, best = mask, 0, m, None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        down = eq | minus
        rise = minus | (mask & ~(across | plus))
        fall = plus & across
        if rise & high:
            distance += 1
        elif fall & high:
            distance -= 1
        rise, fall = rise << 1 & mask, fall << 1 & mask
        plus, minus = fall | (mask & ~(down | rise)), rise & down
        if distance <= budget and (best is None or distance < best[0]):
            best = distance, j + 1
    return best


def _hits(index: Index, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, piece) of every exact piece hit."""
    n = len(data) - index.width + 1
    if n <= 0 or not len(index.keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, keys = [], []
    for lo in range(0, n, 1 << 20):
        at = np.arange(lo, min(n, lo + (1 << 20)))
        key = W.hash_spans(data, at, at + index.width)
        some = np.flatnonzero(index.passes[key >> np.uint64(64 - _FILTER_BITS)])
        places.append(at[some])
        keys.append(key[some])
    return _equal(index.keys, np.concatenate(places), np.concatenate(keys))


def _equal(known: np.ndarray, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, index into ``known``) of every known hash that a place's key equals."""
    first, last = np.searchsorted(known, key, "left"), np.searchsorted(known, key, "right")
    many = last - first
    ends = np.cumsum(many)
    spot = np.repeat(first - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
    return np.repeat(place, many), spot


def _joins(code: int) -> bool:
    """The character continues a word of a script with spaces between words."""
    return unicodedata.category(chr(code))[0] in "LMN" and not _UNSPACED.match(chr(code))


def _boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every place and the end: it stands between characters, and no word goes on over it."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kinds, back = np.unique(codes, return_inverse=True)
    joins = np.array([_joins(c) for c in kinds.tolist()], bool)[back]
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    edge = np.zeros(len(data) + 1, bool)
    edge[leads[1:]] = ~(joins[1:] & joins[:-1])
    edge[offsets] = True
    return edge


def _whole_items(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, index of the item, start, end, 0): the first place of each item that is looked up whole."""
    if not index.whole or not len(data):
        return []
    edge = _boundaries(data, offsets)
    starts, out = np.flatnonzero(edge[:-1]), []
    for size, (known, items) in index.whole.items():
        at = starts[starts + size <= len(data)]
        at = at[edge[at + size]]
        row = np.searchsorted(offsets, at, "right") - 1
        at = at[at + size <= offsets[row + 1]]
        place, spot = _equal(known, at, W.hash_spans(data, at, at + size))
        item, row = items[spot], np.searchsorted(offsets, place, "right") - 1
        _, first = np.unique(row * len(index.items) + item, return_index=True)
        for r, k, p in zip(row[first].tolist(), item[first].tolist(), place[first].tolist(), strict=True):
            if data[p : p + size].tobytes() == index.items[k].text:
                base = int(offsets[r])
                out.append((r, k, p - base, p - base + size, 0))
    return out


def matches(index: Index, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(row, item_id, start, end, distance): each item's best place in each text it occurs in."""
    data, offsets = normalize(texts)
    place, piece = _hits(index, data)
    raw = data.tobytes()
    row = np.searchsorted(offsets, place, "right") - 1
    whole = place + index.size[piece] <= offsets[row + 1]
    place, piece, row = place[whole], piece[whole], row[whole]
    item, start = index.item[piece], place - index.begin[piece]
    order = np.lexsort((start, item, row))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    done: dict[tuple[int, int], int] = {}
    for k in order.tolist():
        at, size = int(place[k]), int(index.size[piece[k]])
        found = index.items[item[k]]
        lo = int(index.begin[piece[k]])
        if raw[at : at + size] != found.text[lo : lo + size]:
            continue
        key = int(row[k]), int(item[k])
        if key in best and best[key][0] == 0 or key in done and done[key] >= int(start[k]):
            continue  # exact already, or the same place through another piece
        begin = max(int(offsets[key[0]]), int(start[k]) - found.budget)
        end = min(int(offsets[key[0] + 1]), int(start[k]) + len(found.text) + 2 * found.budget)
        done[key] = int(start[k]) + found.budget // 2
        got = myers(found.text, raw[begin:end], found.budget)
        if got is None:
            done.pop(key)
            continue
        if key not in best or got[0] < best[key][0]:
            tail = raw[begin : begin + got[1]][::-1]
            back = myers(found.text[::-1], tail[: len(found.text) + found.budget], got[0])
            base = int(offsets[key[0]])
            best[key] = got[0], begin + got[1] - (back[1] if back else len(found.text)) - base, begin + got[1] - base
    rows = [(r, i, s, e, d) for (r, i), (d, s, e) in best.items()] + _whole_items(index, data, offsets)
    return [(r, index.items[i].item_id, *place) for r, i, *place in sorted(rows)]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """The items, collected block by block, each of about ``limit`` bytes."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // limit
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = benchmark.filter(block == k) if blocks > 1 else benchmark
        yield [(r[0], r[1]) for r in rows.select("item_id", "text").collect()]


def find_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, start, end, distance): one row for each item in each document row.

    Places are bytes of the normalized text. Null and empty texts or items
    match nothing; of equally near places the first counts. Repeated rows and repeated items each match.
    """
    spark = documents.sparkSession
    prepare(spark)
    out = None
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(items, rate))  # bounded by BLOCK_BYTES

        def run(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            for lo, hi in W.slabs(batch.column(1)):
                rows = matches(shared.value, batch.column(1).slice(lo, hi - lo))
                if rows:
                    row, *rest = zip(*rows, strict=True)
                    names = batch.column(0).take(pa.array([lo + r for r in row]))
                    yield pa.RecordBatch.from_arrays([names, *(pa.array(c, pa.int64()) for c in rest)],
                                                     names=["doc_id", "item_id", "start", "end", "distance"])

        part = map_batches(documents.select("doc_id", "text"), run,
                           "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint")
        out = part if out is None else out.union(part)
    return out


def drop_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``documents``, all columns, in which no item occurs."""
    spark = documents.sparkSession
    prepare(spark)
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(items, rate))
        at = documents.columns.index("text")

        def run(batch: pa.RecordBatch, shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            keep = np.ones(batch.num_rows, bool)
            for lo, hi in W.slabs(batch.column(at)):
                keep[[lo + r[0] for r in matches(shared.value, batch.column(at).slice(lo, hi - lo))]] = False
            yield batch.filter(pa.array(keep))

        documents = map_batches(documents, run, documents.schema)
    return documents
