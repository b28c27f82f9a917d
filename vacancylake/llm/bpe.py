"""Byte-level BPE by numpy merge rounds over many words at once.

A column of texts is one flat byte array, cut where no word of the tokenizer's
pattern can span the cut. Equal chunks are found by hashing, compared byte by
byte, and looked up in a cache of arrays bounded in bytes, so no Python object is
made per word. The symbols of all new words lie in one flat array. Each round
forms the keys of adjacent symbols, finds their ranks by binary search over the
sorted pair keys of the merge table, takes every word's lowest rank and merges its
occurrences from the left. Words that have no pair left are set aside. Words of
very many symbols, which would need as many rounds, are merged by a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare

VOCABULARY = "byte_bpe_50k.json"
#: Bytes a worker keeps of chunks met before: their hashes, spellings and ids.
CACHE_BYTES = 16 << 20
#: Bytes of text encoded at a time; a longer text is taken alone.
SLAB = 2 << 20
#: Longest chunk, in bytes, that is kept.
KEPT_CHUNK = 64
#: Symbols from which a word is merged by a heap instead of in rounds.
LONG_WORD = 512

#: Unicode's White_Space characters. Fixed values.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: The tokenizer's word pattern, with white space written out.
_PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
#: Lead bytes of white space beyond ASCII, and what may follow each. Fixed values.
_WIDE = {
    0xC2: [(0x85,), (0xA0,)],
    0xE1: [(0x9A, 0x80)],
    0xE2: [*((0x80, b) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (0x81, 0x9F)],
    0xE3: [(0x80, 0x80)],
}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


#: ASCII letters, digits and other signs apart from white space; 0 where a byte alone does not tell.
_KIND = np.zeros(256, np.uint8)
_KIND[:128] = 3
_KIND[:128][W.BLANKS[:128]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1


def white_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 text belong to white space."""
    white = W.BLANKS[raw]
    for lead, tails in _WIDE.items():
        at = np.flatnonzero(raw == lead)
        for tail in tails:
            hit = at[at + len(tail) < len(raw)]
            for k, byte in enumerate(tail, 1):
                hit = hit[raw[hit + k] == byte]
            for k in range(len(tail) + 1):
                white[hit + k] = True
    return white


class _Known:
    """Chunks met before, sorted by hash, with their bytes and ids in flat arrays."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.place = np.zeros((4, 0), np.int32)  # begin and size in bytes, begin and size in ids
        self.used = np.zeros(0, bool)
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.int32)

    @property
    def size(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.place, self.used, self.bytes, self.ids))

    def find(self, h: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Entry of each chunk, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == h) & (self.place[1, at] == sizes))
        hit = np.delete(hit, W.differing(raw, starts[hit], self.bytes, self.place[0, at[hit]].astype(np.int64), sizes[hit]))
        found = np.full(len(h), -1)
        found[hit] = at[hit]
        self.used[at[hit]] = True
        return found

    def add(self, h: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Keep chunks of ascending hashes, those whose hash is taken aside."""
        at = np.searchsorted(self.hashes, h)
        if len(self.hashes):
            free = self.hashes[np.minimum(at, len(self.hashes) - 1)] != h
            begins = np.cumsum(n) - n
            h, at, starts, sizes, begins, n = (x[free] for x in (h, at, starts, sizes, begins, n))
            ids = ids[W.places(begins, n)]
        place = np.stack([len(self.bytes) + np.cumsum(sizes) - sizes, sizes, len(self.ids) + np.cumsum(n) - n, n])
        self.hashes = np.insert(self.hashes, at, h)
        self.place = np.insert(self.place, at, place.astype(np.int32), axis=1)
        self.used = np.insert(self.used, at, False)
        self.bytes = np.concatenate([self.bytes, raw[W.places(starts, sizes)]])
        self.ids = np.concatenate([self.ids, ids])
        if self.size > self.limit:
            self.trim()

    def trim(self) -> None:
        """Drop what was not met since the last trim, or everything if that frees too little."""
        begin, size, first, n = self.place[:, self.used].astype(np.int64)
        hashes, raw, ids = self.hashes[self.used], self.bytes[W.places(begin, size)], self.ids[W.places(first, n)]
        self.clear()
        if 2 * (raw.nbytes + ids.nbytes + 25 * len(hashes)) <= self.limit:
            self.hashes, self.bytes, self.ids = hashes, raw, ids
            self.place = np.stack([np.cumsum(size) - size, size, np.cumsum(n) - n, n]).astype(np.int32)
            self.used = np.zeros(len(hashes), bool)


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names, vocab = byte_names(), spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        marks = [re.escape(t) for t in sorted(self.special, key=len, reverse=True)]
        self.on_special = re.compile(b"|".join(marks) or rb"(?!)")
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(names[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token
        self.lengths = np.array([len(b) for b in spelled])
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.single = np.zeros(256, np.int64)
        for c, b in names.items():
            self.single[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made
        self.known = _Known(CACHE_BYTES)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        for k in np.flatnonzero(lengths > LONG_WORD).tolist():
            before, n_before = self.merge(pieces[:k])
            after, n_after = self.merge(pieces[k + 1 :])
            ids = self.merge_long(pieces[k])
            return np.concatenate([before, ids, after]), np.concatenate([n_before, [len(ids)], n_after])
        symbols = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)  # an empty piece owns nothing
        done_symbols, done_owner = [], []
        no_rank = len(self.keys)
        while len(symbols):
            pair = symbols[:-1] << 32 | symbols[1:]
            spot = np.minimum(np.searchsorted(self.keys, pair), no_rank - 1)
            rank = np.where((self.keys[spot] == pair) & (owner[:-1] == owner[1:]), self.ranks[spot], no_rank)
            rank = np.append(rank, no_rank)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            size = np.diff(np.append(first, len(owner)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), size)
            open_ = lowest < no_rank
            done_symbols.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols, owner, rank, lowest = symbols[open_], owner[open_], rank[open_], lowest[open_]
            hit = np.flatnonzero(rank == lowest)
            # of overlapping occurrences (aaa) every second one, from the left
            run = np.cumsum(np.diff(hit, prepend=-2) != 1)
            begin = np.searchsorted(run, run)
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols, owner = np.concatenate(done_symbols or [symbols]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(owner, minlength=len(pieces))

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long word: pairs leave a heap by rank, then place."""
        symbols = self.single[np.frombuffer(piece, np.uint8)].tolist()
        following = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        made: dict[tuple[int, int], tuple[int, int] | None] = {}

        def rank_of(pair: tuple[int, int]) -> tuple[int, int] | None:
            if pair not in made:
                key = pair[0] << 32 | pair[1]
                spot = min(int(np.searchsorted(self.keys, key)), len(self.keys) - 1)
                made[pair] = (int(self.ranks[spot]), int(self.made[self.ranks[spot]])) if self.keys[spot] == key else None
            return made[pair]

        heap: list[tuple[int, int, tuple[int, int]]] = []

        def offer(left: int) -> None:
            if left >= 0 and following[left] >= 0:
                pair = symbols[left], symbols[following[left]]
                if rank_of(pair) is not None:
                    heapq.heappush(heap, (rank_of(pair)[0], left, pair))

        for k in range(len(symbols) - 1):
            offer(k)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = following[left]
            if right < 0 or (symbols[left], symbols[right]) != pair:
                continue  # merged with another neighbour since
            symbols[left], symbols[right] = rank_of(pair)[1], -1
            following[left] = following[right]
            if following[left] >= 0:
                before[following[left]] = left
            following[right] = -1
            offer(before[left])
            offer(left)
        return np.array([x for x in symbols if x >= 0], np.int32)

    def learn(self, chunks: list[bytes], several: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks one after another, and how many each has.

        ``several`` tells which chunks may hold more than one piece or be a special token.
        """
        pieces, counts, marks = [], [], []
        for chunk, more in zip(chunks, several, strict=True):
            if not more:
                pieces.append(chunk)
                counts.append(1)
                continue
            if chunk in self.special:
                marks.append((len(pieces), self.special[chunk]))
                found = [b""]
            else:
                found = [p.encode() for p in _PIECES.findall(chunk.decode())]
            pieces += found
            counts.append(len(found))
        ids, sizes = self.merge(pieces)
        if marks:
            where, special = np.array(marks, np.int64).T
            ids = np.insert(ids, np.cumsum(sizes)[where], special)
            sizes[where] += 1
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts, dtype=np.int64)]
        return ids, np.diff(ends, prepend=0)

    def cut(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the chunks.

        White space always begins a piece of the pattern, its last one before a word
        begins another, and the word a third unless that one is a space. So do letters,
        digits and signs after each other, but for what follows an apostrophe. Special
        tokens stand alone.
        """
        white, marks = white_bytes(raw), []
        if self.special and np.any((raw[:-1] == 60) & (raw[1:] == 124)):
            text = raw.tobytes()
            for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                marks += [m.span() for m in self.on_special.finditer(text, first, last)]
        for first, last in marks:  # white space before them is left whole, as at a text's end
            white[first:last] = True
        turn = np.zeros(len(raw) + 1, bool)
        turn[: len(raw) - 1] = white[:-1] & ~white[1:]
        turn[offsets[1:] - 1] = False
        turn = np.flatnonzero(turn)  # last bytes of white space before a word
        begins = np.zeros(len(raw) + 1, bool)
        begins[turn - np.where(raw[turn] < 128, 0, np.where(raw[turn - 1] == 0xC2, 1, 2))] = True
        begins[turn[raw[turn] != 32] + 1] = True
        kind = _KIND[raw]
        begins[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (raw[:-1] != 39)
        begins[1:-1] |= white[1:] & ~white[:-1]
        begins[offsets] = True
        for first, last in marks:
            begins[first:last] = False
            begins[[first, last]] = True
        return np.flatnonzero(begins[: len(raw)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; a null text has none."""
        raw, offsets = W.flat_bytes(texts)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts = self.cut(raw, offsets)
        sizes = np.diff(np.append(starts, len(raw)))
        h, own, index = W.distinct(raw, starts, sizes)
        starts_of, sizes_of = starts[own], sizes[own]
        entry = np.append(self.known.find(h, raw, starts_of[: len(h)], sizes_of[: len(h)]), np.full(len(own) - len(h), -1))
        new = np.flatnonzero(entry < 0)
        text = raw.tobytes()
        spans = zip(starts_of[new].tolist(), (starts_of[new] + sizes_of[new]).tolist(), strict=True)
        hard = np.concatenate([[0], np.cumsum((raw >= 128) | (raw == 39) | (raw == 124))])
        hard = hard[starts_of[new] + sizes_of[new]] > hard[starts_of[new]]
        ids, n = self.learn([text[a:b] for a, b in spans], hard.tolist())
        old = np.flatnonzero(entry >= 0)
        begin, count = self.known.place[2:, entry[old]].astype(np.int64)
        pool = np.concatenate([self.known.ids[W.places(begin, count)], ids])
        number, size = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        size[old], size[new] = count, n
        number[old] = np.cumsum(count) - count
        number[new] = count.sum() + np.cumsum(n) - n
        keep = (new < len(h)) & (sizes_of[new] <= KEPT_CHUNK)
        met = new[keep]
        self.known.add(h[met], raw, starts_of[met], sizes_of[met], ids[W.places(number[met], n[keep]) - count.sum()], n[keep])
        size = size[index]
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, offsets)]
        return pool[W.places(number[index], size)], np.diff(ends)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a run of ids."""
        return self.spelling[W.places(self.begins[ids], self.lengths[ids])].tobytes()


@cache
def coder(path: str) -> ByteBpe:
    """One encoder a worker process, with its cache."""
    return ByteBpe(path)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; a null or empty text has no ids."""
    prepare(documents.sparkSession)
    path = path or vocabulary_path()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for lo, hi in W.slabs(batch.column(1), SLAB):
            ids, sizes = bpe.encode(batch.column(1).slice(lo, hi - lo))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=["doc_id", "ids"])

    return map_batches(documents.select("doc_id", "text"), run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    prepare(encoded.sparkSession)
    path = path or vocabulary_path()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        texts = [bpe.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every text; report sizes and digests, not the ids themselves.

    Rows: (doc_id, n_tokens, ids_sha256, decoded_sha256, intact), one per input row.
    Null texts count as empty: no token, and the digests of nothing.
    """
    prepare(documents.sparkSession)
    path = path or vocabulary_path()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for lo, hi in W.slabs(batch.column(1), SLAB):
            texts = batch.column(1).slice(lo, hi - lo)
            ids, sizes = bpe.encode(texts)
            ends = np.cumsum(sizes)
            raw, spelled = ids.astype("<u4").tobytes(), bpe.decode(ids)
            bytes_to = np.concatenate([[0], np.cumsum(bpe.lengths[ids])])
            rows = [], [], []
            for text, begin, end in zip(texts.to_pylist(), ends - sizes, ends, strict=True):
                back = spelled[bytes_to[begin] : bytes_to[end]]
                intact = back == (text or "").encode()
                if not intact:
                    back = back.decode("utf-8", "replace").encode()
                rows[0].append(_sha(raw[4 * begin : 4 * end]))
                rows[1].append(_sha(back))
                rows[2].append(intact)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(sizes), *map(pa.array, rows)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "intact"],
            )

    return map_batches(
        documents.select("doc_id", "text"), run,
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, intact boolean",
    )
