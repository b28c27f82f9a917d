"""Exact Jaccard join of word n-gram sets by a size-aware heavy-light join.

1. Every distinct set is cut into postings (shingle, set), dealt by shingle and
   counted; only shingles of two sets or more return to their sets. A set with
   too few of those for any partner drops out. This never groups by a hot shingle:
   postings of shingles found very often stream through.
2. Small sets (up to a size chosen by cost) enumerate their fixed-size subsets, as
   many shingles as a partner of each size must share. Large sets scan the
   inverted lists of their rarest shingles, the ones a partner cannot all lack.
3. In each list every member is compared with one head, and verified links form
   components. Lists that still hold several components get other heads, and at
   last all pairs across their components. A list of near copies thus costs as
   many comparisons as members, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.kneser_ney import pack, unpack
from vacancylake.llm.shared import components, map_batches, prepare
from vacancylake.session import materialize

SHINGLE = 5
#: Least similarity, as a fraction.
NUMERATOR, DENOMINATOR = 75, 100
#: Sizes for which subsets are considered at all.
MAX_SMALL = 12
#: Sets of a shingle that are told apart; a shingle of more counts as this frequent.
FREQUENT = 1000
#: Postings a reducer holds before it lets frequent shingles pass.
HELD = 6 << 20
_ID = 12  # bytes of a set's name
_LOW = 5  # bytes of a shingle within its bucket


def least_overlap(a: int, b: int) -> int:
    """Shingles that sets of sizes a and b must share."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def partners(a: int) -> range:
    """Sizes of the sets that can be similar to one of size a."""
    return range(-(-NUMERATOR * a // DENOMINATOR), DENOMINATOR * a // NUMERATOR + 1)


def shingles_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and their bounds."""
    words = W.split(texts)
    h, doc = W.hashes(words), words.doc
    last = words.bounds[1:][doc]
    at = np.arange(len(h))
    size = np.minimum(last - words.bounds[:-1][doc], SHINGLE)
    starts = np.flatnonzero(((size == SHINGLE) & (at + SHINGLE <= last)) | ((size < SHINGLE) & (at == words.bounds[:-1][doc])))
    length = size[starts]
    x = length.astype(np.uint64)
    for k in range(SHINGLE):
        there = length > k
        x[there] = W.mix(x[there] * np.uint64(0xD6E8FEB86659FD93) + h[starts[there] + k])
    bounds = np.searchsorted(starts, words.bounds)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            x[a:b].sort()
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    edges = bounds[:-1][bounds[:-1] < len(x)]
    keep[edges] = True
    return x[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def names_of(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 96-bit name of each set, alike for equal sets, as two columns of integers."""
    sums = []
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        run = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(x ^ np.uint64(salt)), dtype=np.uint64)])
        sums.append(W.mix(run[bounds[1:]] - run[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return np.stack([sums[0], sums[1] >> np.uint64(32)], axis=1)


def _name_bytes(names: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(names.astype("<u8")).view(np.uint8).reshape(-1, 16)[:, :_ID]


def _binary(rows: np.ndarray) -> list[bytes]:
    data, width = rows.tobytes(), rows.shape[1]
    return [data[i : i + width] for i in range(0, len(data), width)]


def shingle_sets(documents: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, n_shingles, name) and the carried string columns of every row.

    Null and empty texts have no name.
    """
    prepare(documents.sparkSession)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1)):
            x, bounds = shingles_of(batch.column(1).slice(lo, hi - lo))
            n = np.diff(bounds)
            names = pa.array(_binary(_name_bytes(names_of(x, bounds))), pa.binary(), mask=n == 0)
            rest = [batch.column(k).slice(lo, hi - lo) for k in range(2, 2 + len(carried))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), names, *rest],
                                             names=["doc_id", "n_shingles", "name", *carried])

    schema = ", ".join(["doc_id bigint, n_shingles bigint, name binary", *(f"{c} string" for c in carried)])
    return map_batches(documents.select("doc_id", "text", *carried), run, schema)


_POSTINGS = "bucket int, slab bigint, sets binary, runs binary, low binary"


def _postings(documents: DataFrame, buckets: int) -> DataFrame:
    """Packed postings of each slab of texts, a row a bucket, and a row with the slab's set names."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(0)):
            x, bounds = shingles_of(batch.column(0).slice(lo, hi - lo))
            names, n = names_of(x, bounds), np.diff(bounds)
            _, first = np.unique(names, axis=0, return_index=True)
            first = np.sort(first[n[first] > 0])  # equal sets of a slab once
            if not len(first):
                continue
            number = np.full(len(n), -1)
            number[first] = np.arange(len(first))
            owner = np.repeat(number, n)
            x, owner = x[owner >= 0], owner[owner >= 0]
            named = _name_bytes(names[first]).tobytes()
            slab = int(W.mix(np.array([names[first].sum(dtype=np.uint64)])).view(np.int64)[0])
            bucket = ((x >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, x, owner = bucket[order], x[order], owner[order]
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = [(slab % buckets, slab, named, None, n[first].astype("<u4").tobytes())]
            for a, b in zip(begins, [*begins[1:], len(x)], strict=True):
                starts = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                runs = np.diff(np.append(starts, b - a)).astype("<u2" if b - a < 65536 else "<u4")
                rows.append((int(bucket[a]), slab, owner[a:b][starts].astype("<u4").tobytes(),
                             runs.astype("<u4").tobytes(), pack(x[a:b], _LOW)))
            for k in range(0, len(rows), 128):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 128], strict=True),
                                                    (pa.int32(), pa.int64(), *[pa.binary()] * 3), strict=True)],
                    names=["bucket", "slab", "sets", "runs", "low"])

    return map_batches(documents.select("text"), run, _POSTINGS)


_SHARED = "slab bigint, sets binary, token binary, n binary"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings of one bucket: those of shingles in two sets or more, a row a slab."""
    slabs: list[int] = []
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    frequent = np.zeros(0, np.uint64)

    def send(slab: np.ndarray, member: np.ndarray, token: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(slab):
            return
        order = np.argsort(slab, kind="stable")
        slab, member, token, n = slab[order], member[order], token[order], n[order]
        begins = np.flatnonzero(np.diff(slab, prepend=-1))
        for a, b in zip(begins, [*begins[1:], len(slab)], strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([slabs[slab[a]]], pa.int64()),
                 *(pa.array([c.tobytes()], pa.binary()) for c in (
                     member[a:b].astype("<u4"), token[a:b].astype("<u8"), n[a:b].astype("<u4")))],
                names=["slab", "sets", "token", "n"])

    def settle(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, frequent
        if not held:
            return
        slab, member, token = (np.concatenate(c) for c in zip(*held, strict=True))
        names, back, n = np.unique(token, return_inverse=True, return_counts=True)
        n = np.where((n >= FREQUENT) | np.isin(names, frequent), FREQUENT, n)
        frequent = np.union1d(frequent, names[n >= FREQUENT])
        n = n[back]
        out = n >= (2 if last else FREQUENT)
        yield from send(slab[out], member[out], token[out], n[out])
        held = [] if last else [(slab[~out], member[~out], token[~out])]

    size = limit = 0
    limit = HELD
    bucket = None
    for batch in batches:
        for b, slab, sets, runs, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket:
                yield from settle(True)
                slabs, frequent, size, limit, bucket = [], np.zeros(0, np.uint64), 0, HELD, b
            if runs is None:  # the names of a slab's sets pass through
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slab], pa.int64()), pa.array([sets], pa.binary()), pa.array([None], pa.binary()),
                     pa.array([low], pa.binary())], names=["slab", "sets", "token", "n"])
                continue
            token = unpack(low, _LOW) | np.uint64(b) << np.uint64(40)
            member = np.repeat(np.frombuffer(sets, "<u4"), np.frombuffer(runs, "<u4"))
            held.append((np.full(len(token), len(slabs), np.int32), member, token))
            slabs.append(slab)
            size += len(token)
            if size >= limit:
                yield from settle(False)
                size = sum(len(h[2]) for h in held)
                limit = size + HELD
    yield from settle(True)


_SETS = "name binary, n int, tokens binary, scanned bigint"


def _regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From one slab's shared postings: its sets that can have a partner, rarest shingles first."""

    def finish(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        named = next(((r[1], r[3]) for r in rows if r[2] is None), None)
        rows = [r for r in rows if r[2] is not None]
        if named is None or not rows:
            return
        size = np.frombuffer(named[1], "<u4").astype(np.int64)
        member = np.concatenate([np.frombuffer(r[1], "<u4") for r in rows])
        token = np.concatenate([np.frombuffer(r[2], "<u8") for r in rows])
        n = np.concatenate([np.frombuffer(r[3], "<u4") for r in rows])
        order = np.lexsort((token, n, member))
        member, token, n = member[order], token[order], n[order]
        again = np.zeros(len(member), bool)  # a slab that occurs twice
        again[1:] = (member[1:] == member[:-1]) & (token[1:] == token[:-1])
        member, token, n = member[~again], token[~again], n[~again]
        bounds = np.searchsorted(member, np.arange(len(size) + 1))
        need = -(-NUMERATOR * size // DENOMINATOR)
        out = [], [], [], []
        for k in np.flatnonzero((np.diff(bounds) >= need) & (size > 0)).tolist():
            a, b = bounds[k], bounds[k + 1]
            out[0].append(named[0][_ID * k : _ID * (k + 1)])
            out[1].append(int(size[k]))
            out[2].append(token[a:b].astype("<u8").tobytes())
            out[3].append(int(n[a : b - need[k] + 1].sum()))
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int32(), pa.binary(), pa.int64()), strict=True)],
                names=["name", "n", "tokens", "scanned"])

    slab, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != slab:
                yield from finish(rows)
                slab, rows = row[0], []
            rows.append(row)
    yield from finish(rows)


def subset_count(a: int, largest: int) -> int:
    """Subsets that a set of size a enumerates for its partners up to size ``largest``."""
    return sum(comb(a, least_overlap(a, b)) for b in partners(a) if b <= largest)


def choose_boundary(costs: dict[int, tuple[int, int]]) -> int:
    """Largest size that enumerates subsets: the one of least total cost.

    ``costs`` gives, for each size up to :data:`MAX_SMALL`, the number of sets and
    the entries that scanning their lists would read.
    """
    def total(x: int) -> int:
        light = sum(k * subset_count(a, x) for a, (k, _) in costs.items() if a <= x)
        return light + sum(scan for a, (_, scan) in costs.items() if partners(a)[-1] > x)

    return min(range(MAX_SMALL + 1), key=lambda x: (total(x), x))


_SIGNATURES = "key bigint, side int, want int, name binary, n int, after int"


def _signatures(sets: DataFrame, boundary: int) -> DataFrame:
    """Keys under which sets meet: subsets (side: own size, want: the partner's) or rare shingles (0, 0).

    ``after`` counts the set's shingles from the one it meets by, in the order of
    rarity: all that a partner met there first can share.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = [], [], [], [], [], []
        for name, n, blob in zip(*(batch.column(c).to_pylist() for c in ("name", "n", "tokens")), strict=True):
            tokens = np.frombuffer(blob, "<u8")
            found = []
            if n <= boundary:
                whole = np.sort(tokens)
                for b in partners(n):
                    c = least_overlap(n, b)
                    if b <= boundary and c <= len(whole):
                        picked = whole[np.array(list(combinations(range(len(whole)), c)))]
                        key = np.full(len(picked), np.uint64(min(n, b) << 8 | max(n, b)))
                        for k in range(c):
                            key = W.mix(key * np.uint64(0xD6E8FEB86659FD93) + picked[:, k])
                        found.append((key, n, b, np.full(len(key), n)))
            if partners(n)[-1] > boundary:
                need = -(-NUMERATOR * n // DENOMINATOR)
                rare = tokens[: len(tokens) - need + 1]
                found.append((rare, 0, 0, len(tokens) - np.arange(len(rare))))
            for key, side, want, after in found:
                out[0].append(key)
                out[1].append(np.full(len(key), side, np.int32))
                out[2].append(np.full(len(key), want, np.int32))
                out[3].extend([name] * len(key))
                out[4].append(np.full(len(key), n, np.int32))
                out[5].append(after.astype(np.int32))
        if out[0]:
            key, side, want, n, after = (np.concatenate(out[k]) for k in (0, 1, 2, 4, 5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.astype("<u8").view(np.int64)), pa.array(side), pa.array(want), pa.array(out[3], pa.binary()),
                 pa.array(n), pa.array(after)], names=["key", "side", "want", "name", "n", "after"])

    return map_batches(sets.select("name", "n", "tokens"), run, _SIGNATURES)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose similarity, counted over their shared shingles, suffices."""
    sides = [sets.select(F.col("name").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}")) for s in "uv"]
    joined = pairs.join(sides[0], "u").join(sides[1], "v").select("u", "v", "n_u", "n_v", "t_u", "t_v")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
            both = len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
            keep.append(DENOMINATOR * both >= NUMERATOR * (a + b - both))
        yield batch.select([0, 1]).filter(pa.array(keep))

    return map_batches(joined, run, "u binary, v binary")


#: Sizes fit, and what both still have from the shingle on can make the least overlap.
_FITS = (
    f"greatest(a.n, b.n) * {NUMERATOR} <= least(a.n, b.n) * {DENOMINATOR} and "
    f"least(a.after, b.after) * {NUMERATOR + DENOMINATOR} >= (a.n + b.n) * {NUMERATOR}"
)


#: Heads of a list in turn: first the set with fewest rarer shingles of its own, the most central one.
_HEADS = ("max(struct(after - n, name, n, after))", "min(struct(name, n, after))")


def _with_heads(rows: DataFrame, head: str) -> DataFrame:
    """Each member of a list with one head of those on the side it wants."""
    heads = rows.groupBy("key", "side").agg(F.expr(head).alias("h"))
    heads = heads.select("key", F.col("side").alias("want"), "h.name", "h.n", "h.after")
    both = rows.alias("a").join(heads.alias("b"), ["key", "want"]).filter(F.expr(f"a.name <> b.name and {_FITS}"))
    return both.select(F.expr("greatest(a.name, b.name) u"), F.expr("least(a.name, b.name) v")).distinct()


def _open_rows(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows, with their component, of lists that still hold several components."""
    marked = rows.join(roots.select(F.col("node").alias("name"), "root"), "name", "left")
    marked = marked.withColumn("root", F.coalesce("root", "name"))
    lists = marked.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return marked.join(lists.select("key"), "key")


def link_sets(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Components of similar sets: (node, root), both names of sets, with links only."""
    spark = documents.sparkSession
    prepare(spark)
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    postings = _postings(documents, buckets).repartitionById(buckets, F.pmod("bucket", F.lit(buckets)).cast("int"))
    shared = postings.sortWithinPartitions("bucket").mapInArrow(_shared, _SHARED)
    slabs = shared.repartition(buckets, "slab").sortWithinPartitions("slab").mapInArrow(_regroup, _SETS)
    sets = materialize(slabs.dropDuplicates(["name"]))
    sizes = sets.filter(F.col("n") <= MAX_SMALL).groupBy("n").agg(F.count(F.lit(1)), F.sum("scanned"))
    boundary = choose_boundary({n: (k, scan) for n, k, scan in sizes.collect()})  # MAX_SMALL rows at most
    rows = _signatures(sets, boundary)
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    rows = materialize(rows.join(met, "key"))
    edges = materialize(_verified(_with_heads(rows, _HEADS[0]), sets))
    roots = components(edges)
    for head in (*_HEADS[1:], None):
        rows = materialize(_open_rows(rows, roots).drop("root"))
        if rows.isEmpty():
            return roots
        if head is not None:
            edges = edges.union(materialize(_verified(_with_heads(rows, head), sets)))
            roots = components(edges)
    rest = _open_rows(rows, roots)
    pairs = rest.alias("a").join(rest.alias("b"), F.expr("a.key = b.key and a.want = b.side and a.side = b.want"))
    pairs = pairs.filter(F.expr(f"a.name > b.name and a.root <> b.root and {_FITS}"))
    pairs = pairs.select(F.col("a.name").alias("u"), F.col("b.name").alias("v")).distinct()
    return components(edges.union(materialize(_verified(pairs, sets))))


def join(documents: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id).

    component_id is the smallest doc_id reachable over links. Null and empty
    texts have no shingles and are alone. A null doc_id takes part in links but
    names no component; alone, its component_id is null. Rows with one doc_id
    and different texts are separate; extra columns are not read.
    """
    prepare(documents.sparkSession)
    docs = materialize(shingle_sets(documents))
    rooted = _rooted(docs, link_sets(documents), F.min("doc_id"))
    labels = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    rooted = rooted.join(labels, "root").select("name", "component_id")
    out = docs.join(rooted, "name", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _rooted(docs: DataFrame, roots: DataFrame, low: Column) -> DataFrame:
    """(name, low, root) of every set, ``low`` aggregated over its documents."""
    least = docs.filter("name is not null").groupBy("name").agg(low.alias("low"))
    rooted = least.join(roots.select(F.col("node").alias("name"), "root"), "name", "left")
    return rooted.withColumn("root", F.coalesce("root", "name"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One row, all columns, of each component.

    The row with the smallest doc_id stays; null ids stand behind all others, and
    among equal ids the row of the least digest of all columns stays. Rows that
    share an id but no link are separate documents. Rows without a word (null,
    empty, blank texts) link with nothing, and all of them stay.
    """
    row = F.md5(F.to_json(F.struct(*[F.col(c) for c in documents.columns])).cast("binary"))
    digest = "row_digest"
    while digest in documents.columns:
        digest += "_"
    named = documents.withColumn(digest, row)
    docs = materialize(shingle_sets(named, digest))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(digest).alias(digest))
    rooted = _rooted(docs, link_sets(documents), F.min(order))
    first = rooted.groupBy("root").agg(F.min("low").alias("low")).select(f"low.{digest}")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # rows of one digest are the same in every column
    kept = named.filter(worded).join(first, digest, "left_semi").dropDuplicates([digest])
    return kept.unionByName(named.filter(~worded)).drop(digest)


#: The same join in DuckDB, by all pairs that share a shingle.
JOIN_SQL = rf"""
WITH RECURSIVE cut AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS g
    FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shares AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sets a JOIN sets b USING (g)
         WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shares JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
          WHERE {DENOMINATOR} * c >= {NUMERATOR} * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
