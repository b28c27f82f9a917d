"""Exact cosine threshold pairs within a label by cover trees and dual traversal.

Vectors of a label are dealt into blocks by the signs of fixed projections, so
that neighbours tend to meet, and by salt where a cell is still too large. Each
block is a cover tree: nested levels of centres with halving radii, every node
with the exact distance to its farthest point. Two blocks whose covering balls
are further apart than the threshold are never joined; of the others the trees
are walked together, and node pairs are dropped, or linked as a whole, by the
same bound. Exact copies are folded first and carry their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm.shared import components, map_batches, prepare
from vacancylake.session import materialize

THRESHOLD = 0.93
BLOCK = 2048
_BITS = 20
_SLACK = 1e-9


class Tree(NamedTuple):
    center: np.ndarray  # point of each node
    radius: np.ndarray  # to its farthest point
    first: np.ndarray  # children of node i: first[i] to first[i + 1], none for a leaf
    points: list[np.ndarray]  # of each node


def _distance(dot: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dot))


def build(x: np.ndarray) -> Tree:
    """Cover tree of unit vectors, in levels; a node of one point, or of equal ones, is a leaf."""
    d = _distance(x @ x.T)
    np.fill_diagonal(d, 0.0)
    center, points, first = [0], [np.arange(len(x))], [1]
    radius = [float(d[0].max())]
    reach = radius[0] / 2
    at = 0
    while at < len(center):
        level_end = len(center)
        for k in range(at, level_end):
            rest = points[k]
            if len(rest) > 1 and radius[k] > 0:
                open_, c = rest, center[k]  # the parent's centre stays one: levels are nested
                while True:
                    near = d[c, open_] <= reach
                    own = open_[near]
                    center.append(c)
                    points.append(own)
                    radius.append(float(d[c, own].max()))
                    open_ = open_[~near]
                    if not len(open_):
                        break
                    c = int(open_[0])
            first.append(len(center))
        at = level_end
        reach /= 2
    return Tree(np.array(center), np.array(radius), np.array(first), points)


def _dots(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    rows, a = np.unique(i, return_inverse=True)
    cols, b = np.unique(j, return_inverse=True)
    if len(rows) * len(cols) <= 4 * len(i):
        return (x[rows] @ y[cols].T)[a, b]
    return np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) for k in range(0, len(i), 65536)])


def _expand(tree: Tree, node: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = tree.first[node + 1] - tree.first[node]
    ends = np.cumsum(n)
    child = np.repeat(tree.first[node] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return child, np.repeat(other, n)


def walk(x: np.ndarray, y: np.ndarray, s: Tree, t: Tree, threshold: float) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(node pairs linked as a whole, as point lists; single linked pairs as rows (i, j))."""
    limit = float(np.sqrt(2.0 - 2.0 * threshold))
    wholes, singles = [], []
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaf_s, leaf_t = np.diff(s.first) == 0, np.diff(t.first) == 0
    while len(a):
        dot = _dots(x, y, s.center[a], t.center[b])
        d, slack = _distance(dot), s.radius[a] + t.radius[b]
        open_ = d - slack <= limit + _SLACK
        a, b, d, slack, dot = a[open_], b[open_], d[open_], slack[open_], dot[open_]
        flat = (s.radius[a] == 0) & (t.radius[b] == 0)
        whole = np.where(flat, dot >= threshold, d + slack <= limit - _SLACK)
        size = np.array([len(s.points[i]) * len(t.points[j]) for i, j in zip(a[whole], b[whole], strict=True)])
        pick = np.flatnonzero(whole)
        for k in pick[size > 1].tolist():
            wholes.append((s.points[a[k]], t.points[b[k]]))
        one = pick[size == 1] if len(pick) else pick
        singles.append(np.stack([s.center[a[one]], t.center[b[one]]], axis=1))
        rest = ~whole & ~flat
        a, b = a[rest], b[rest]
        down = leaf_t[b] | (~leaf_s[a] & (s.radius[a] >= t.radius[b]))
        left = _expand(s, a[down], b[down])
        right = _expand(t, b[~down], a[~down])
        a, b = np.concatenate([left[0], right[1]]), np.concatenate([left[1], right[0]])
    return wholes, np.concatenate(singles) if singles else np.zeros((0, 2), np.int64)


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least point reachable from each of n points."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def link_blocks(x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, threshold: float, same: bool):
    """Links of two blocks: (weights linked to each of x and y, roots of all points)."""
    s = build(x)
    t = s if same else build(y)
    wholes, singles = walk(x, y, s, t, threshold)
    n_x, n_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    u, v = [singles[:, 0]], [singles[:, 1]]
    n_x += np.bincount(singles[:, 0], wy[singles[:, 1]], len(x)).astype(np.int64)
    n_y += np.bincount(singles[:, 1], wx[singles[:, 0]], len(y)).astype(np.int64)
    for p, q in wholes:
        n_x[p] += wy[q].sum()
        n_y[q] += wx[p].sum()
        u += [np.full(len(q), p[0]), p]
        v += [q, np.full(len(p), q[0])]
    if same:  # every pair was met from both sides, and each point with itself
        return n_x - wx, None, _roots(len(x), np.concatenate(u), np.concatenate(v))
    return n_x, n_y, _roots(len(x) + len(y), np.concatenate(u), np.concatenate(v) + len(x))


@cache
def _planes(size: int) -> np.ndarray:
    return np.random.default_rng(size).standard_normal((_BITS, size))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, key, cell, vec): key is null where a vector can link with nothing.

    ``vec`` is the unit vector as doubles, ``key`` a digest of label and stored
    components, ``cell`` the signs of fixed projections.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, cells, units = [], [], []
        for e, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            v = np.array([np.nan if c is None else c for c in e], float) if e and label is not None else np.zeros(0)
            top = float(np.abs(v).max()) if len(v) else 0.0
            if not np.isfinite(top) or top == 0.0 or not np.isfinite(v).all():
                keys.append(None), cells.append(None), units.append(None)
                continue
            v = v + 0.0  # no negative zero
            keys.append(hashlib.blake2b(v.tobytes() + str((label, len(v))).encode(), digest_size=16).digest())
            v = v / top
            v = v / np.sqrt(v @ v)
            units.append(v.tobytes())
            cells.append(int((_planes(len(v)) @ v > 0) @ (1 << np.arange(_BITS))))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(cells, pa.int32()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "key", "cell", "vec"])

    return map_batches(vectors.select("vec_id", "embedding", F.col("label").cast("bigint").alias("label")), run,
                       "vec_id bigint, label bigint, key binary, cell int, vec binary")


_BLOCKS = "label bigint, size int, block bigint, keys binary, weights binary, vecs binary, center array<double>, radius double"


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One block as one row, with its ball."""
    rows = rows.sort_values("key")
    x = np.stack([np.frombuffer(v) for v in rows["vec"]])
    mean = x.mean(axis=0)
    center = x[int(np.argmax(x @ mean))]
    return pd.DataFrame([{
        "label": rows["label"].iloc[0], "size": x.shape[1], "block": rows["block"].iloc[0], "keys": b"".join(rows["key"]),
        "weights": rows["copies"].to_numpy("<i8").tobytes(), "vecs": x.tobytes(), "center": center.tolist(),
        "radius": float(_distance(x @ center).max()) + _SLACK}])


def blocks_of(folded: DataFrame, limit: int = BLOCK) -> DataFrame:
    """Folded vectors in blocks of about ``limit``."""
    sizes = folded.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit(_BITS), F.greatest(F.lit(0), F.floor(F.log2(F.col("n") / limit)))).cast("int")
    keyed = folded.join(sizes.withColumn("bits", bits), ["label", "size"])
    keyed = keyed.withColumn("part", F.expr(f"shiftright(cell, {_BITS} - bits)"))
    cells = keyed.groupBy("label", "size", "part").agg(F.count(F.lit(1)).alias("m"))
    salts = F.ceil(F.col("m") / limit)
    keyed = keyed.join(cells, ["label", "size", "part"]).withColumn("salt", F.pmod(F.xxhash64("key"), salts))
    keyed = keyed.withColumn("block", F.xxhash64("label", "size", "part", "salt"))
    return keyed.select("label", "block", "key", "copies", "vec").groupBy("label", "block").applyInPandas(_pack, _BLOCKS)


def _linked(pairs: DataFrame, threshold: float) -> DataFrame:
    """Rows (key, n, root): links found for a vector in one pair of blocks, and its component there."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            side = [(np.frombuffer(row[f"vecs_{s}"]).reshape(-1, row["size"]), np.frombuffer(row[f"weights_{s}"], "<i8"),
                     [row[f"keys_{s}"][k : k + 16] for k in range(0, len(row[f"keys_{s}"]), 16)]) for s in "ab"]
            same = row["block_a"] == row["block_b"]
            (x, wx, kx), (y, wy, ky) = side
            n_x, n_y, roots = link_blocks(x, y, wx, wy, threshold, same)
            keys, n = (kx, n_x) if same else (kx + ky, np.concatenate([n_x, n_y]))
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[k] for k in hit], pa.binary()), pa.array(n[hit]), pa.array([keys[r] for r in roots[hit]], pa.binary())],
                names=["key", "n", "root"])

    return map_batches(pairs, run, "key binary, n bigint, root binary")


def threshold_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Two vectors link if their labels are equal and not null and their cosine is at
    least ``threshold``. Vectors without label, null, empty, zero or with null or
    non-finite components, or of different sizes, do not link. Equal vectors
    count each other. A null vec_id links, but names no component; where none is
    known component_id is null and the row is kept.
    """
    spark = vectors.sparkSession
    prepare(spark)
    units = materialize(unit_vectors(vectors))
    folded = units.filter("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"), F.first("label").alias("label"),
        F.first("cell").alias("cell"), F.first("vec").alias("vec"))
    folded = materialize(folded.withColumn("size", F.expr("cast(octet_length(vec) / 8 as int)")))
    blocks = materialize(blocks_of(folded))
    balls = blocks.select("label", "size", "block", "center", "radius")
    gap = "aggregate(zip_with(a.center, b.center, (p, q) -> (p - q) * (p - q)), 0D, (s, e) -> s + e)"
    limit = float(np.sqrt(2.0 - 2.0 * threshold)) + _SLACK
    met = balls.alias("a").join(balls.alias("b"), ["label", "size"]).filter(
        F.expr(f"a.block <= b.block and sqrt({gap}) <= a.radius + b.radius + {limit!r}"))
    met = met.select(F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    sides = [blocks.select(F.col("block").alias(f"block_{s}"), "size" if s == "a" else F.lit(1).alias("unused"),
                           *(F.col(c).alias(f"{c}_{s}") for c in ("keys", "weights", "vecs"))) for s in "ab"]
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = met.join(sides[0], "block_a").join(sides[1], "block_b").drop("unused").repartition(tasks)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # rows of about 2 MB
    found = materialize(_linked(pairs, threshold))
    prepare(spark)
    roots = components(found.select(F.col("key").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    known = folded.select("key", "copies", "low").join(counts, "key", "left")
    known = known.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(least, "root").select("key", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = units.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


#: The same links in DuckDB, by all pairs of a label.
LINKS_SQL = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings
          UNION SELECT r.vec_id, l.v FROM reach r JOIN links l ON r.other = l.u),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""
