"""Toxicity by multiple-instance learning: documents labelled, sentences scored.

A sentence's logit is a bias plus the weights of its words; a word's weight is
that of itself and of its first 4 to 8 bytes, all hashed into one table. A
sentence without evidence for toxicity has probability 0, so that length alone makes
no document toxic. A document is toxic unless a small leak and every sentence are
clean: ``1 - (1 - leak) * prod(1 - p(sentence))`` (noisy-or). Weights and bias are
fitted through this very formula from document labels alone, which leaves each
sentence its own probability and so locates the offending ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare, remainder

#: Bound of the fit: so many rows of each label, texts of at most so many characters.
SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
SAMPLE_CHARS = 20_000
#: Bytes of texts whose features the fit holds at a time.
FIT_SLAB = 1 << 20
TABLE_BITS = 19
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.5
#: Longer sentences are judged in pieces of so many words.
SENTENCE_WORDS = 32
#: Standard errors by which a feature's log odds between labels must differ from 0.
#: Chosen among 2.5 to 9 by four-fold cross-validation on rows that may be learnt from.
EVIDENCE = 4.5
#: -log of the probability that a document is clean although no sentence speaks for toxicity.
LEAK = 1e-3

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = False
_NOT_LETTER[128:] = False
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


class Sentences(NamedTuple):
    doc: np.ndarray  # text of each sentence
    of: np.ndarray  # sentence of each feature
    feature: np.ndarray
    starts: np.ndarray  # bytes, within the slab
    ends: np.ndarray
    offsets: np.ndarray  # of texts, within the slab


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def featurize(texts: pa.Array) -> Sentences:
    """Sentences, or pieces of long ones, with at least one word, and the hashed features of their words."""
    words = W.split(texts, _NOT_LETTER)
    doc = words.doc
    place = np.cumsum(_ENDS[words.data])[words.starts] + doc if len(doc) else doc
    first = np.flatnonzero(np.diff(place, prepend=-1))
    within = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
    first = np.flatnonzero(within % SENTENCE_WORDS == 0)
    last = np.append(first[1:], len(place)) - 1 if len(place) else first
    sentence = np.repeat(np.arange(len(first)), last - first + 1)
    parts, owners = [W.hashes(words)], [sentence]
    for size in PREFIXES:
        chosen = words.ends - words.starts > size
        starts = words.starts[chosen]
        parts.append(W.hash_spans(words.data, starts, starts + size) ^ np.uint64(size))
        owners.append(sentence[chosen])
    feature = (np.concatenate(parts) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return Sentences(doc[first], np.concatenate(owners), feature, words.starts[first], words.ends[last], words.offsets)


def logits(model: Model, s: Sentences) -> np.ndarray:
    return model.bias + np.bincount(s.of, model.weights[s.feature], minlength=len(s.doc))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def toxic_mass(z: np.ndarray, bias: float) -> np.ndarray:
    """-log of the probability that a sentence is clean, given its logit and that of no evidence."""
    return np.maximum(0.0, np.logaddexp(0.0, z) - np.logaddexp(0.0, bias))


def _slabs(texts: pa.Array) -> Iterator[tuple[int, Sentences]]:
    """(index of the first text, sentences) of about a megabyte of texts at a time."""
    for lo, hi in W.slabs(texts, FIT_SLAB):
        yield lo, featurize(texts.slice(lo, hi - lo))


def telling(texts: pa.Array, y: np.ndarray) -> np.ndarray:
    """Features whose presence in a document speaks clearly for one label."""
    counts = np.zeros((2, 1 << TABLE_BITS), np.int64)
    for lo, s in _slabs(texts):
        feature, doc = np.divmod(np.unique(s.feature * len(y) + s.doc[s.of] + lo), max(1, len(y)))
        for kind in (0, 1):
            counts[kind] += np.bincount(feature[y[doc] == kind], minlength=1 << TABLE_BITS)
    names = np.flatnonzero(counts.sum(axis=0))
    b, a = counts[:, names] + 0.5
    n = np.array([(1 - y).sum(), y.sum()])
    odds = np.log(a / (n[1] - a + 1)) - np.log(b / (n[0] - b + 1))
    return names[np.abs(odds) >= EVIDENCE * np.sqrt(1 / a + 1 / b)]


def document_mass(model: Model, s: Sentences, n: int) -> np.ndarray:
    """-log of the probability that each of n documents is clean."""
    return LEAK + np.bincount(s.doc, toxic_mass(logits(model, s), model.bias), minlength=n)


def fit(texts: pa.Array, toxic: np.ndarray, rounds: int = 200, rate: float = 0.05, decay: float = 1e-5) -> Model:
    """Weights and bias that minimise the documents' log loss, by Adam over all rows.

    The texts are read twice in slabs: once for the features that tell, once to keep
    only those, so that what stays in memory is their occurrences and the sentences.
    """
    y = np.asarray(toxic, float)
    sparse = telling(texts, y)
    place = np.full(1 << TABLE_BITS, -1, np.int32)
    place[sparse] = np.arange(len(sparse))
    columns, owners, docs = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    sentences = 0
    for lo, s in _slabs(texts):
        column = place[s.feature]
        kept = column >= 0
        columns.append(column[kept])
        owners.append((s.of[kept] + sentences).astype(np.int32))
        docs.append((s.doc + lo).astype(np.int32))
        sentences += len(s.doc)
    column, owner, doc = (np.concatenate(parts) for parts in (columns, owners, docs))
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    share = np.sqrt(share)
    theta, bias = np.zeros(len(sparse)), -7.0
    m, v = np.zeros(len(sparse) + 1), np.zeros(len(sparse) + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(owner, theta[column], minlength=len(doc))
        mass = LEAK + np.bincount(doc, toxic_mass(z, bias), minlength=len(y))
        # d loss / d mass: 1 for clean rows, -(1 - P) / P for toxic ones
        slope = share * np.where(y == 1, -1.0 / np.expm1(mass), 1.0) / max(1, len(y))
        counts = slope[doc] * (z >= bias)  # sentences below no evidence add nothing
        dz = counts * _sigmoid(z)
        by_bias = dz.sum() - counts.sum() * _sigmoid(bias)
        grad = np.append(np.bincount(column, dz[owner], minlength=len(sparse)) + decay * theta, by_bias)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(1 << TABLE_BITS, np.float32)
    weights[sparse] = theta
    return Model(weights, float(bias))


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded, repeatable sample of labelled rows that may be learnt from.

    Rows whose crc32(doc_id) mod 5 is 0, null labels and null ids are left out; a
    document labelled twice counts as toxic if any row says so. Of several texts of
    one id the least in string order is learnt from.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder("doc_id", 5) != 0))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = [known.filter(F.col("toxic") == kind).orderBy(order, "doc_id").limit(size)
              for kind, size in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN ids, whatever the size of the tables
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    texts = documents.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS)
    return texts.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(documents, labels).toArrow().sort_by("doc_id")
    return fit(rows["text"].combine_chunks(), rows["toxic"].to_numpy())


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a null or empty text has no sentence and scores the leak, 0.001."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2 MB, fixed

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1)):
            s = featurize(batch.column(1).slice(lo, hi - lo))
            mass = document_mass(shared.value, s, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(-np.expm1(-mass))], names=["doc_id", "score"]
            )

    return map_batches(documents.select("doc_id", "text"), run, "doc_id bigint, score double")


def drop_toxic(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, that score below the threshold."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for lo, hi in W.slabs(batch.column(at)):
            s = featurize(batch.column(at).slice(lo, hi - lo))
            mass = document_mass(shared.value, s, hi - lo)
            keep += (-np.expm1(-mass) < threshold).tolist()
        yield batch.filter(pa.array(keep))

    return map_batches(documents, run, documents.schema)


def offending_sentences(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Sentences that are toxic by themselves: (doc_id, start, end, score), in bytes of the text."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1)):
            s = featurize(batch.column(1).slice(lo, hi - lo))
            p = -np.expm1(-toxic_mass(logits(shared.value, s), shared.value.bias))
            hit = np.flatnonzero(p >= threshold)
            base = s.offsets[s.doc[hit]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(s.doc[hit] + lo)), pa.array(s.starts[hit] - base),
                 pa.array(s.ends[hit] - base), pa.array(p[hit])],
                names=["doc_id", "start", "end", "score"],
            )

    return map_batches(documents.select("doc_id", "text"), run, "doc_id bigint, start bigint, end bigint, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    Repeated rows are scored each, null and empty texts 0.001, the leak; a null doc_id is never held out.
    """
    scored = score(documents, train(documents, labels))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
