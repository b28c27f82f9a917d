"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Tokens are 56-bit word hashes. Tasks count the pairs of their own texts and send
them, packed, to the shard of the pair; each shard adds up its pairs and writes
them as sorted hash arrays into the shared folder, and passes on what it saw of
each word (count, distinct predecessors, continuations seen once, twice, more
often). Word shards add those up and write the word arrays. Workers map the
arrays into memory to score texts; nothing but one summary row a shard reaches
the driver. Words that follow each other very often would burden their shard, so
pairs that begin with one of a sample's frequent words are dealt by both words.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare, remainder, shared_path
from vacancylake.llm.token_files import _open

HELD_OUT = (7, 2)  # modulus and remainder of the rows not learnt from
#: Pairs a task counts before it sends them on.
PAIRS_HELD = 4 << 20
#: Texts read to find frequent words; this decides where pairs are counted, not the counts.
HOT_ROWS, HOT_CHARS, HOT_SHARE = 500, 4000, 0.002
#: Smoothing of the base score: added to every count.
ADDED = 1

_ID = 7  # bytes of a packed word id
BEGIN = np.uint64(1)
END = np.uint64(2)

_WORD = np.dtype([("id", "<u8"), ("n", "<u8"), ("before", "<u4"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


def pack(x: np.ndarray, size: int = _ID) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpack(data: bytes, size: int = _ID) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token ids, their predecessors, tokens before each text); one end token a text."""
    words = W.split(texts)
    ids = W.hashes(words) >> np.uint64(8)
    ids += np.uint64(3) * (ids < np.uint64(3))
    n = len(words.bounds) - 1
    bounds = words.bounds + np.arange(n + 1)
    token = np.empty(bounds[-1], np.uint64)
    token[bounds[1:] - 1] = END
    inside = np.ones(len(token), bool)
    inside[bounds[1:] - 1] = False
    token[inside] = ids
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[bounds[:-1]] = BEGIN
    return token, before, bounds


def shard_of(before: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each pair: by its first word, by both if the first is frequent."""
    by_word = W.mix(before)
    if len(hot):
        both = np.isin(before, hot)
        by_word[both] = pair_key(before[both], word[both])
    return (by_word % np.uint64(shards)).astype(np.int32)


def word_shard(ids: np.ndarray, shards: int) -> np.ndarray:
    return ((ids >> np.uint64(24)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


class Model(NamedTuple):
    folder: str
    shards: int
    hot: np.ndarray
    tokens: int  # N
    distinct: int  # V
    pairs: int  # distinct pairs
    discount: np.ndarray  # of pair counts 0, 1, 2 and 3 or more
    low_discount: np.ndarray  # of continuation counts
    low_weight: float  # mass that the continuation counts leave to unseen words


def discounts(seen: np.ndarray) -> np.ndarray:
    """Chen and Goodman's discounts from the numbers of items seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in seen)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = lambda a, b: a / b if b else 0.0
    found = [0.0, 1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3)]
    return np.clip(found, [0, 0.1, 0.1, 0.1], [0, 0.95, 1.95, 2.95])


def frequent_words(documents: DataFrame) -> np.ndarray:
    texts = [r[0] for r in documents.filter("text is not null")
             .select(F.substring("text", 1, HOT_CHARS)).limit(HOT_ROWS).collect()]
    token, _, _ = tokens_of(pa.array(texts, pa.string()))
    ids, n = np.unique(token, return_counts=True)
    return np.append(ids[n >= HOT_SHARE * max(1, len(token))], BEGIN)


def _pairs(documents: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    def count(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        word, before = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        _, first, n = np.unique(pair_key(before, word), return_index=True, return_counts=True)
        word, before = word[first], before[first]
        shard = shard_of(before, word, hot, shards)
        order = np.lexsort((before, shard))
        word, before, shard, n = word[order], before[order], shard[order], n[order].astype("<u4")
        begins = np.flatnonzero(np.diff(shard, prepend=-1))
        rows = []
        for a, b in zip(begins, [*begins[1:], len(shard)], strict=True):
            starts = np.flatnonzero(np.diff(before[a:b], prepend=~before[a : a + 1]))
            runs = np.diff(np.append(starts, b - a)).astype("<u4")
            rows.append((int(shard[a]), pack(before[a:b][starts]), runs.tobytes(), pack(word[a:b]), n[a:b].tobytes()))
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 64], strict=True),
                                                (pa.int32(), *[pa.binary()] * 4), strict=True)],
                names=["shard", "before", "runs", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lo, hi in W.slabs(batch.column(0)):
                word, before, _ = tokens_of(batch.column(0).slice(lo, hi - lo))
                held.append((word, before))
                size += len(word)
                if size >= PAIRS_HELD:
                    yield from count(held)
                    held, size = [], 0
        if held:
            yield from count(held)

    return documents.select("text").mapInArrow(run, "shard int, before binary, runs binary, word binary, n binary")


def _sum_pairs(batch: dict[str, list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, before, word, n) of one shard's pairs, ascending by key."""
    before = np.concatenate([np.repeat(unpack(b), np.frombuffer(r, "<u4"))
                             for b, r in zip(batch["before"], batch["runs"], strict=True)])
    word = np.concatenate([unpack(w) for w in batch["word"]])
    n = np.concatenate([np.frombuffer(x, "<u4") for x in batch["n"]])
    key, first, back = np.unique(pair_key(before, word), return_index=True, return_inverse=True)
    return key, before[first], word[first], np.bincount(back, n, len(key)).astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, list[bytes]]]]:
    """Rows of one shard at a time, from batches sorted by shard."""
    shard, held = None, {}
    for batch in batches:
        at = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if at[a] != shard:
                if held:
                    yield shard, held
                shard, held = int(at[a]), {name: [] for name in batch.schema.names[1:]}
            for k, name in enumerate(batch.schema.names[1:], 1):
                held[name] += batch.column(k).slice(a, b - a).to_pylist()
    if held:
        yield shard, held


def _put(system: fs.FileSystem, target: str, data: np.ndarray) -> None:
    """Write aside, then move: a retried task leaves one whole file."""
    with system.open_output_stream(aside := f"{target}.{os.getpid()}-{os.urandom(4).hex()}.part") as out:
        out.write(memoryview(np.ascontiguousarray(data)).cast("B") if data.size else b"")
    system.move(aside, target)


def train(documents: DataFrame, folder: str | None = None, shards: int | None = None) -> Model:
    """Count every text of ``documents`` and write the model into the shared folder."""
    spark = documents.sparkSession
    prepare(spark)
    folder = folder or shared_path(spark)
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = frequent_words(documents)
    system, place = _open(folder)
    system.create_dir(place, recursive=True)

    def add_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        for shard, rows in _groups(batches):
            key, before, word, n = _sum_pairs(rows)
            _put(system, f"{place}/{shard}.hi", (key >> np.uint64(32)).astype("<u4"))
            _put(system, f"{place}/{shard}.lo", (key >> np.uint64(16)).astype("<u2"))
            _put(system, f"{place}/{shard}.n", np.minimum(n, 255).astype("u1"))
            large = np.flatnonzero(n >= 255)
            _put(system, f"{place}/{shard}.large", np.stack([large, n[large]]).astype("<i8"))
            ids, back = np.unique(np.concatenate([word, before]), return_inverse=True)
            at_word, at_before = back[: len(word)], back[len(word) :]
            total = np.bincount(at_word, n, len(ids))
            columns = [np.bincount(at_word, minlength=len(ids)), *(
                np.bincount(at_before[chosen], minlength=len(ids)) for chosen in (n == 1, n == 2, n >= 3))]
            seen = [int((n == k).sum()) for k in (1, 2, 3, 4)]
            to = word_shard(ids, shards)  # ascends with the ids
            begins = np.flatnonzero(np.diff(to, prepend=-1))
            for a, b in zip(begins, [*begins[1:], len(to)], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(to[a])], pa.int32()), pa.array([pack(ids[a:b])], pa.binary()),
                     pa.array([total[a:b].astype("<u8").tobytes()], pa.binary()),
                     *(pa.array([c[a:b].astype("<u4").tobytes()], pa.binary()) for c in columns),
                     pa.array([np.array(seen if a == 0 else [0] * 4, "<i8").tobytes()], pa.binary())],
                    names=["shard", "ids", "n", "before", "n1", "n2", "n3", "seen"])

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        out = []
        for shard, rows in _groups(batches):
            ids, back = np.unique(np.concatenate([unpack(x) for x in rows["ids"]]), return_inverse=True)
            table = np.zeros(len(ids), _WORD)
            table["id"] = ids
            for name in ("n", "before", "n1", "n2", "n3"):
                kind = "<u8" if name == "n" else "<u4"
                table[name] = np.bincount(back, np.concatenate([np.frombuffer(x, kind) for x in rows[name]]), len(ids))
            _put(system, f"{place}/{shard}.words", table)
            seen = sum(np.frombuffer(x, "<i8") for x in rows["seen"])
            low = [int((table["before"] == k).sum()) for k in (1, 2, 3, 4)]
            out.append([int(table["n"].sum()), int((table["n"] > 0).sum()), int(table["before"].sum(dtype=np.int64)),
                        int((table["before"] >= 3).sum()), *seen.tolist(), *low])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([pa_row for pa_row in out], pa.list_(pa.int64()))], names=["sums"])

    pairs = _pairs(documents, hot, shards).repartitionById(shards, "shard").sortWithinPartitions("shard")
    stats = pairs.mapInArrow(
        add_pairs, "shard int, ids binary, n binary, before binary, n1 binary, n2 binary, n3 binary, seen binary")
    stats = stats.repartitionById(shards, "shard").sortWithinPartitions("shard")
    summary = stats.mapInArrow(add_words, "sums array<bigint>").collect()  # one short row a shard
    sums = np.array([r.sums for r in summary], np.int64).reshape(-1, 12).sum(axis=0)
    low = discounts(sums[8:12])
    mass = float(low[1] * sums[8] + low[2] * sums[9] + low[3] * sums[3])
    return Model(folder, shards, hot, int(sums[0]), int(sums[1]), int(sums[2]), discounts(sums[4:8]), low,
                 mass / sums[2] if sums[2] else 1.0)


class Arrays:
    """The model's arrays, mapped into this worker's memory shard by shard."""

    def __init__(self, folder: str):
        self.system, self.place = _open(folder)
        self.open: dict[tuple[str, np.dtype], np.ndarray] = {}

    def get(self, name: str, kind: np.dtype | str) -> np.ndarray:
        found = self.open.get((name, kind))
        if found is None:
            found = self.open[name, kind] = self._map(name, np.dtype(kind))
        return found

    def _map(self, name: str, kind: np.dtype) -> np.ndarray:
        info = self.system.get_file_info(f"{self.place}/{name}")
        if info.type == fs.FileType.NotFound or not info.size:  # a shard that no row was dealt to
            return np.zeros(0, kind)
        if isinstance(self.system, fs.LocalFileSystem):
            return np.memmap(info.path, kind, "r")
        # a remote folder: a private copy, unlinked at once and gone with the process
        with tempfile.NamedTemporaryFile() as copy, self.system.open_input_stream(info.path) as source:
            shutil.copyfileobj(source, copy, 4 << 20)
            copy.flush()
            return np.memmap(copy.name, kind, "r")


@cache
def arrays(folder: str) -> Arrays:
    return Arrays(folder)


def look_up_words(model: Model, ids: np.ndarray) -> np.ndarray:
    """Rows of the word table for ascending ids; zeros where a word is unknown."""
    out = np.zeros(len(ids), _WORD)
    shard = word_shard(ids, model.shards)
    begins = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(begins, [*begins[1:], len(shard)], strict=True):
        table = arrays(model.folder).get(f"{shard[a]}.words", _WORD)
        if len(table):
            at = np.minimum(np.searchsorted(table["id"], ids[a:b]), len(table) - 1)
            hit = table["id"][at] == ids[a:b]
            out[a:b][hit] = table[at[hit]]
    return out


def look_up_pairs(model: Model, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Counts of pairs."""
    shard, key = shard_of(before, word, model.hot, model.shards), pair_key(before, word)
    order = np.lexsort((key, shard))
    shard, key = shard[order], key[order]
    found = np.zeros(len(key), np.int64)
    begins = np.flatnonzero(np.diff(shard, prepend=-1))
    files = arrays(model.folder)
    for a, b in zip(begins, [*begins[1:], len(shard)], strict=True):
        hi, lo, n = (files.get(f"{shard[a]}.{x}", k) for x, k in (("hi", "<u4"), ("lo", "<u2"), ("n", "u1")))
        large = files.get(f"{shard[a]}.large", "<i8").reshape(2, -1)
        want_hi, want_lo = (key[a:b] >> np.uint64(32)).astype("<u4"), (key[a:b] >> np.uint64(16)).astype("<u2")
        at = np.searchsorted(hi, want_hi)
        open_ = np.arange(b - a)
        while len(open_):  # keys that share their upper half lie next to each other
            open_ = open_[at[open_] < len(hi)]
            open_ = open_[hi[at[open_]] == want_hi[open_]]
            hit = lo[at[open_]] == want_lo[open_]
            done = open_[hit]
            value = n[at[done]].astype(np.int64)
            if large.shape[1]:
                spot = np.minimum(np.searchsorted(large[0], at[done]), large.shape[1] - 1)
                value = np.where(large[0][spot] == at[done], large[1][spot], value)
            found[a + done] = value
            open_ = open_[~hit]
            at[open_] += 1
    out = np.empty_like(found)
    out[order] = found
    return out


def log10_probabilities(model: Model, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of each token's probability, its count in training)."""
    ids, back = np.unique(np.concatenate([token, before]), return_inverse=True)
    table = look_up_words(model, ids)
    w, v = table[back[: len(token)]], table[back[len(token) :]]
    step = lambda n: np.minimum(n, 3).astype(np.int64)
    low = (w["before"] - model.low_discount[step(w["before"])]) / max(1, model.pairs)
    low = low + model.low_weight / (model.distinct + 1)
    _, first, again = np.unique(pair_key(before, token), return_index=True, return_inverse=True)
    n = look_up_pairs(model, before[first], token[first])[again]
    follow = v["n"].astype(float)
    # the begin mark is no token: what follows it was counted with its pairs
    follow = np.where(before == BEGIN, float(model_begin(model)), follow)
    saved = model.discount[1] * v["n1"] + model.discount[2] * v["n2"] + model.discount[3] * v["n3"]
    known = (follow > 0) & (saved > 0)
    follow = np.where(known, follow, 1.0)
    p = np.where(known, (n - model.discount[step(n)]) / follow + saved / follow * low, low)
    return np.log10(np.maximum(p, 1e-300)), w["n"].astype(np.int64)


def model_begin(model: Model) -> int:
    """Texts learnt from: every one has one end token."""
    return int(look_up_words(model, np.array([END]))["n"][0])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every text.

    A null or empty text is one end token.
    """
    prepare(documents.sparkSession)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1), 4 << 20):
            token, before, bounds = tokens_of(batch.column(1).slice(lo, hi - lo))
            p, c = log10_probabilities(model, token, before)
            base = np.log10((c + ADDED) / (model.tokens + ADDED * (model.distinct + 1)))
            total = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(total((c > 0).astype(np.int64))),
                 pa.array(np.full(hi - lo, model.tokens)), pa.array(total(base)), pa.array(total(p))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_batches(
        documents.select("doc_id", "text"), run,
        "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def perplexity(documents: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score all: adds held_out and perplexity.

    A null doc_id is never held out. Repeated rows count and are scored each.
    """
    modulus, held = HELD_OUT
    held_out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    model = train(documents.filter(~held_out))
    scored = score(documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                         F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
