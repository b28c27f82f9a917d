"""Words of many texts at once: byte spans and 64-bit hashes in flat numpy arrays.

A column of texts is one UTF-8 buffer. Word boundaries come from a table of 256
byte classes, hashes from differences of a running polynomial, so no Python
object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII capitals to small letters, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that stand between words, by what counts as a word.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True

NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[48:58] = False
NOT_ALNUM[65:91] = False
NOT_ALNUM[97:123] = False
NOT_ALNUM[128:] = False

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPAN = 1 << 20  # bytes hashed at a time
_SLAB = 8 << 20  # bytes of text tokenized at a time


class Words(NamedTuple):
    data: np.ndarray  # bytes, capitals lowered
    offsets: np.ndarray  # of the texts in data, one more than there are texts
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]

    @property
    def doc(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slabs(texts: pa.Array | pa.ChunkedArray, limit: int = _SLAB) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and their bounds; a null text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    raw = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and body.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def split(texts: pa.Array, between: np.ndarray = BLANKS) -> Words:
    """Words of every text; a null text has none."""
    raw, offsets = flat_bytes(texts)
    starts, ends = runs(~between[raw], offsets)
    return Words(LOWER[raw], offsets, starts, ends, np.searchsorted(starts, offsets))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes, none across two texts."""
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(inside):
        before[0] = after[-1] = False
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]
        before[edges] = False
        after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of the spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def differing(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of the spans whose bytes are not the same in both arrays."""
    wrong = np.flatnonzero(a[places(a_starts, sizes)] != b[places(b_starts, sizes)])
    return np.unique(np.searchsorted(np.cumsum(sizes), wrong, "right"))


def distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different spans among those given: hashes, numbers of their first places, and the index of each span.

    Spans are grouped by hash and compared byte by byte. Those that share a hash
    with a span of other bytes come last, beyond the hashes, each by itself.
    """
    h, first, index = np.unique(hash_spans(data, starts, starts + sizes), return_index=True, return_inverse=True)
    same = sizes == sizes[first][index]
    odd, even = np.flatnonzero(~same), np.flatnonzero(same)
    odd = np.append(odd, even[differing(data, starts[even], data, starts[first][index[even]], sizes[even])])
    index[odd] = len(first) + np.arange(len(odd))
    return h, np.append(first, odd), index


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, whose starts ascend."""
    out = np.empty(len(starts), np.uint64)
    power = inverse = np.ones(1, np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, low + _SPAN)))
        size = int(ends[at:to].max() - low)
        if len(power) < size + 1:
            power, inverse = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]), dtype=np.uint64)
                for base in (_BASE, _INVERSE)
            )
        running = np.zeros(size + 1, np.uint64)
        np.cumsum((data[low : low + size].astype(np.uint64) + np.uint64(1)) * power[:size], out=running[1:])
        first, last = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (running[last] - running[first]) * inverse[first] + (last - first).astype(np.uint64)
        at = to
    return mix(out)


def hashes(words: Words) -> np.ndarray:
    return hash_spans(words.data, words.starts, words.ends)


def hash_of(word: str) -> np.uint64:
    """The hash that :func:`hashes` gives this one word."""
    data = LOWER[np.frombuffer(word.encode(), np.uint8)]
    return hash_spans(data, np.array([0]), np.array([len(data)]))[0]
