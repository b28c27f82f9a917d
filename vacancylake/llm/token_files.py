"""Token-ID files: every document compressed by itself with one shared dictionary.

A file holds documents in ascending doc_id order, as zstandard frames of their
32-bit ids, and can give out any one of them::

    frames | index: doc_id, valid, begin, size, n_tokens per document | footer

The index is a little-endian table; the footer gives its place, the number of
documents and the hash of the dictionary, which lies beside the files and is
checked against the hash before anything is read with it.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.bpe import SLAB, ByteBpe, vocabulary_path
from vacancylake.llm.shared import map_batches, prepare, shared_path

END_ID = 0
#: Bound of the dictionary's training sample: rows, and characters of each text.
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 4000
DICTIONARY_BYTES = 64 << 10
LEVEL = 1
FILE_TOKENS = 64 << 20
#: New chunks that go to the library as one text.
JOINED = 1000

_INDEX = np.dtype([("doc_id", "<i8"), ("valid", "<i8"), ("begin", "<i8"), ("size", "<i8"), ("n_tokens", "<i8")])
_MAGIC = b"TOKFILE1"
_FOOTER = np.dtype([("index", "<i8"), ("docs", "<i8"), ("tokens", "<i8"), ("dictionary", "S32"), ("magic", "S8")])


class LibraryBpe(ByteBpe):
    """The cache of :class:`ByteBpe`, filled by the tokenizers library."""

    def __init__(self, path: str):
        # a task has one core; the library's threads would only wait on it
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def learn(self, chunks: list[bytes], several: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        # a space and one run of letters, digits or signs: the pattern cuts before each, so many go in one text
        joined = [not more and len(c) > 1 and c[0] == 32 and c[1] > 32 for c, more in zip(chunks, several, strict=True)]
        single = [k for k, one in enumerate(joined) if not one]
        many = [k for k, one in enumerate(joined) if one]
        ids, sizes = self._singly([chunks[k] for k in single])
        parts, counts, order = [ids], [sizes], single
        for at in range(0, len(many), JOINED):
            some = many[at : at + JOINED]
            ids, sizes = self._together([chunks[k] for k in some])
            parts.append(ids)
            counts.append(sizes)
            order = order + some
        pool, found = np.concatenate(parts), np.concatenate(counts)
        begins = np.cumsum(found) - found
        back = np.argsort(np.array(order, np.int64))
        return pool[W.places(begins[back], found[back])], found[back]

    def _together(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks encoded as one text, told apart by the library's word numbers."""
        found = self.library.encode_batch([b"".join(chunks).decode()], add_special_tokens=False)[0]  # the fast one has no word numbers
        words = found.word_ids
        if None in words or not words or words[-1] + 1 != len(chunks):
            return self._singly(chunks)
        return np.array(found.ids, np.int32), np.bincount(words, minlength=len(chunks))

    def _singly(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [c.decode() for c in chunks]
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes


@cache
def library(path: str) -> LibraryBpe:
    return LibraryBpe(path)


class TokenFiles(NamedTuple):
    folder: str
    manifest: list[tuple[str, int, int]]  # file, documents, ids; in the order of doc_id
    dictionary: str  # hash


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder; a bare path is local to all."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file" and rest and not rest.startswith("//"):
        uri = f"file://{rest}"
    return fs.FileSystem.from_uri(uri)


def encode_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with the end id after each, and how many each has."""
    ids, sizes = library(path).encode(texts)
    return np.insert(ids, np.cumsum(sizes), END_ID), sizes + 1


def train_dictionary(documents: DataFrame, path: str) -> bytes:
    """A dictionary from a bounded sample of serialized ids; empty if there is too little to learn from."""
    rows = documents.filter("text <> ''").select(F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    picked = [r.text for r in rows.limit(SAMPLE_ROWS).collect()]
    if not picked:
        return b""
    ids, sizes = encode_ids(pa.array(picked), path)
    ends = np.cumsum(sizes)
    raw = ids.astype("<u4").tobytes()
    try:
        samples = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, len(raw) // 20)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


@cache
def _dictionary(folder: str, digest: str) -> zstandard.ZstdCompressionDict | None:
    system, place = _open(folder)
    with system.open_input_file(f"{place}/{digest}.dict") as file:
        data = file.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"dictionary {digest} does not match its hash")
    return zstandard.ZstdCompressionDict(data) if data else None


def _write_file(system: fs.FileSystem, target: str, docs: list[tuple], digest: str) -> None:
    """Write aside, then move, so that a retried task leaves one whole file."""
    aside = f"{target}.{hashlib.sha256(repr((target, id(docs))).encode()).hexdigest()[:12]}.part"
    index = np.zeros(len(docs), _INDEX)
    at = 0
    with system.open_output_stream(aside) as out:
        for k, (doc_id, frame, n) in enumerate(docs):
            index[k] = (doc_id or 0, doc_id is not None, at, len(frame), n)
            out.write(frame)
            at += len(frame)
        footer = np.array([(at, len(docs), int(index["n_tokens"].sum()), bytes.fromhex(digest), _MAGIC)], _FOOTER)
        out.write(index.tobytes())
        out.write(footer.tobytes())
    system.move(aside, target)


def write(documents: DataFrame, folder: str | None = None, path: str | None = None, parts: int | None = None) -> TokenFiles:
    """Encode every text and write the files; returns where they are.

    Documents are compressed where they are read; only frames move, each to the
    range of doc_ids of its file. Null doc_ids come first, equal ones keep their
    place next to each other ordered by content. Null texts hold the end id alone.
    """
    spark = documents.sparkSession
    prepare(spark)
    folder = folder or shared_path(spark)
    path = path or vocabulary_path()
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    data = train_dictionary(documents, path)
    digest = hashlib.sha256(data).hexdigest()
    system, place = _open(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/{digest}.dict") as out:
        out.write(data)
    steps = [k / parts for k in range(1, parts)]
    bounds = np.array(sorted(set(documents.approxQuantile("doc_id", steps, 1 / (4 * parts)) if steps else [])))

    def compress(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = _dictionary(folder, digest)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True, write_dict_id=False)
        for lo, hi in W.slabs(batch.column(1), SLAB):
            ids, sizes = encode_ids(batch.column(1).slice(lo, hi - lo), path)
            raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes)
            frames = [press.compress(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            names = batch.column(0).slice(lo, hi - lo)
            range_ = np.searchsorted(bounds, names.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "left")
            yield pa.RecordBatch.from_arrays(
                [pa.array(range_.astype(np.int32)), names, pa.array(frames, pa.binary()), pa.array(sizes)],
                names=["part", "doc_id", "frame", "n_tokens"],
            )

    frames = map_batches(documents.select("doc_id", "text"), compress, "part int, doc_id bigint, frame binary, n_tokens bigint")
    dealt = frames.repartitionById(parts, "part").sortWithinPartitions("part", "doc_id", F.crc32("frame"), "frame")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        held, tokens, part, number = [], 0, None, 0
        done = []

        def close() -> None:
            nonlocal held, tokens, number
            if held:
                name = f"{part:06d}-{number:06d}.tok"
                _write_file(system, f"{place}/{name}", held, digest)
                done.append((name, len(held), tokens))
                held, tokens, number = [], 0, number + 1

        for batch in batches:
            for p, doc_id, frame, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    close()
                    part, number = p, 0
                held.append((doc_id, frame, n))
                tokens += n
                if tokens >= FILE_TOKENS:
                    close()
        close()
        names = ["file", "docs", "tokens"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True) if done else ([], [], []),
                                                  (pa.string(), pa.int64(), pa.int64()), strict=True)], names=names)

    # one row a file
    manifest = sorted(tuple(r) for r in dealt.mapInArrow(save, "file string, docs bigint, tokens bigint").collect())
    return TokenFiles(folder, manifest, digest)


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, ids) of every document; start counts the ids of all documents before it."""
    return _read(spark, files, False)


def digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), as read from the files."""
    return _read(spark, files, True)


def read_one(files: TokenFiles, file: str, k: int) -> np.ndarray:
    """Ids of the k-th document of a file; reads its index entry and its frame only."""
    system, place = _open(files.folder)
    with system.open_input_file(f"{place}/{file}") as source:
        end = source.size()
        footer = np.frombuffer(source.read_at(_FOOTER.itemsize, end - _FOOTER.itemsize), _FOOTER)[0]
        entry = np.frombuffer(source.read_at(_INDEX.itemsize, int(footer["index"]) + k * _INDEX.itemsize), _INDEX)[0]
        frame = source.read_at(int(entry["size"]), int(entry["begin"]))
    known = _dictionary(files.folder, files.dictionary)
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=known).decompress(frame), "<u4")


def _read(spark: SparkSession, files: TokenFiles, digest_only: bool) -> DataFrame:
    starts = np.concatenate([[0], np.cumsum([n for _, _, n in files.manifest], dtype=np.int64)])
    rows = [(name, int(at)) for (name, _, _), at in zip(files.manifest, starts[:-1], strict=True)]
    table = spark.createDataFrame(rows, "file string, start bigint").repartition(max(1, len(rows)))
    folder, digest = files.folder, files.dictionary

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(folder, digest))
        for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with system.open_input_file(f"{place}/{name}") as source:
                end = source.size()
                footer = np.frombuffer(source.read_at(_FOOTER.itemsize, end - _FOOTER.itemsize), _FOOTER)[0]
                if footer["magic"] != _MAGIC or footer["dictionary"].ljust(32, b"\0").hex() != digest:
                    raise ValueError(f"{name} is no file of dictionary {digest}")
                index = np.frombuffer(source.read_at(int(footer["docs"]) * _INDEX.itemsize, int(footer["index"])), _INDEX)
                for lo in range(0, len(index), 1000):
                    part = index[lo : lo + 1000]
                    first = int(part["begin"][0])
                    body = source.read_at(int(part["begin"][-1] + part["size"][-1]) - first, first)
                    raw = [unpack.decompress(body[b - first : b - first + s])
                           for b, s in zip(part["begin"].tolist(), part["size"].tolist(), strict=True)]
                    n = np.array([len(x) // 4 for x in raw], np.int64)
                    if not np.array_equal(n, part["n_tokens"]):
                        raise ValueError(f"{name} holds other lengths than its index")
                    begins = start + np.cumsum(n) - n
                    start += int(n.sum())
                    names = pa.array(part["doc_id"].astype(np.int64), mask=part["valid"] == 0)
                    if digest_only:
                        rest = [pa.array(n), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                    else:
                        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                        rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), "<i4")))]
                    yield pa.RecordBatch.from_arrays([names, pa.array(begins), *rest], names=columns)

    columns = ["doc_id", "start", *(["n_tokens", "ids_crc32"] if digest_only else ["ids"])]
    schema = "doc_id bigint, start bigint, " + ("n_tokens bigint, ids_crc32 bigint" if digest_only else "ids array<int>")
    return map_batches(table, run, schema)
