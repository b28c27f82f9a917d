"""Spelling variants: words one edit apart, found by scanning sorted word lists.

1. Runs of letters are counted in flat arrays. A run's checksum follows from the
   word's own and the document's, because crc32 is linear: only the few runs that
   lose a letter are handled one by one.
2. Words one edit apart share their first or their last k letters, k being half of
   the longer one's length less one. Every word joins the lists of its first and its
   reversed last letters, once as the longer or equal and once as the shorter word.
   A list of very many words is dealt out in parts, to each of which all its words
   put their question.
3. A list is sorted. The rows of the edit matrix, three cells wide, are worked out
   once per shared prefix: a range of the list splits where the common prefix of
   neighbours (LCP) ends, each part gets one more row, and a part whose row exceeds
   one edit in every cell is skipped with all its words. All questions of a block
   go down their ranges together.
4. Forms point to words at least twice as frequent; roots follow by pointer jumping.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare
from vacancylake.session import materialize

#: Bytes of text counted at a time.
SLAB = 4 << 20
#: Least length of a word in code points, and least number of its occurrences.
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Of so many checksums one loses a letter.
EVERY = 97
#: Bytes of a list beyond which it is dealt out in parts.
PART_BYTES = 1 << 18
#: Words whose questions go down the list together, and rows read before a scan.
QUESTIONS = 20_000
ROWS = 50_000
#: Lengths whose checksums are shifted by table; longer runs are summed whole.
_TABLED = 40

_LEAD = 0xC3  # of the two bytes of the letters from U+00C0 to U+00FF
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[65:91] = _LETTERS[_LEAD] = True


def letter_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes of all texts, starts and ends of their runs of letters, and the text of each run."""
    raw, offsets = W.flat_bytes(texts)
    inside = _LETTERS[raw]
    inside[1:] |= raw[:-1] == _LEAD
    starts, ends = W.runs(inside, offsets)
    return W.LOWER[raw], starts, ends, np.searchsorted(offsets, starts, "right") - 1


def checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray, own: np.ndarray,
              doc: np.ndarray, names: list[bytes]) -> np.ndarray:
    """crc32 of each text's name followed by the run, for all runs.

    crc32(name + run) is crc32(run) xor a linear function of crc32(name) that
    depends on the run's length alone; it is tabled per text and length.
    """
    text = data.tobytes()
    spans = zip(starts[own].tolist(), (starts[own] + sizes[own]).tolist(), strict=True)
    plain = np.array([zlib.crc32(text[a:b]) for a, b in spans], np.uint32)
    seeds = [zlib.crc32(name) for name in names]
    shift = np.zeros((len(names), _TABLED), np.uint32)
    for size in np.unique(sizes[sizes < _TABLED]).tolist():
        blank = bytes(size)
        zero = zlib.crc32(blank)
        shift[:, size] = [zlib.crc32(blank, seed) ^ zero for seed in seeds]
    out = plain[index] ^ shift[doc, np.minimum(sizes, _TABLED - 1)]
    for k in np.flatnonzero(sizes >= _TABLED).tolist():
        out[k] = zlib.crc32(text[starts[k] : starts[k] + sizes[k]], seeds[doc[k]])
    return out


def vocabulary(documents: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of enough letters and occurrences.

    A null text has no words; a null doc_id counts as an empty name. Texts are
    read whole, equal rows count each.
    """
    prepare(documents.sparkSession)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1), SLAB):
            data, starts, ends, doc = letter_runs(batch.column(1).slice(lo, hi - lo))
            sizes = ends - starts
            heads = np.concatenate([[0], np.cumsum(data == _LEAD)])
            points = sizes - (heads[ends] - heads[starts])
            keep = points >= LEAST_LENGTH
            starts, sizes, doc, points = starts[keep], sizes[keep], doc[keep], points[keep]
            if not len(starts):
                continue
            _, own, index = W.distinct(data, starts, sizes)
            names = [b"" if i is None else b"%d" % i for i in batch.column(0).slice(lo, hi - lo).to_pylist()]
            h = checksums(data, starts, sizes, index, own, doc, [n + b":" for n in names])
            lost = np.flatnonzero(h % EVERY == 0)
            counts = np.bincount(index, minlength=len(own)) - np.bincount(index[lost], minlength=len(own))
            found = np.flatnonzero(counts)
            place = starts[own[found]]
            offsets = np.concatenate([[0], np.cumsum(sizes[own[found]])])
            body = data[W.places(place, sizes[own[found]])]
            words = pa.StringArray.from_buffers(len(found), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body))
            yield pa.RecordBatch.from_arrays([words, pa.array(counts[found].astype(np.int64))], names=["word", "n"])
            changed = Counter()
            for k in lost.tolist():
                word = data[starts[k] : starts[k] + sizes[k]].tobytes().decode()
                at = int(h[k]) % len(word)
                if len(word) > LEAST_LENGTH:
                    changed[word[:at] + word[at + 1 :]] += 1
            if changed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(changed), pa.string()), pa.array(list(changed.values()), pa.int64())], names=["word", "n"])

    counted = map_batches(documents.select("doc_id", "text"), run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a letter of all words, one after another, and their bounds."""
    raw, offsets = W.flat_bytes(words)
    second = np.zeros(len(raw), bool)
    second[1:] = raw[:-1] == _LEAD
    letters = np.where(second, raw + np.uint8(0x40), raw)
    kept = raw != _LEAD
    return letters[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]


def common_prefixes(letters: np.ndarray, begins: np.ndarray, sizes: np.ndarray, group: np.ndarray, known: int) -> np.ndarray:
    """Length of the prefix each word shares with the one before it; -1 at a group's first word.

    Words of a group share their first ``known`` letters.
    """
    out = np.full(len(begins), -1)
    open_ = np.flatnonzero(group[1:] == group[:-1]) + 1
    out[open_] = depth = known
    while len(open_):
        more = (sizes[open_] > depth) & (sizes[open_ - 1] > depth)
        open_ = open_[more]
        open_ = open_[letters[begins[open_] + depth] == letters[begins[open_ - 1] + depth]]
        depth += 1
        out[open_] = depth
    return out


def scan(letters: np.ndarray, begins: np.ndarray, sizes: np.ndarray, prefixes: np.ndarray,
         q_letters: np.ndarray, q_begins: np.ndarray, q_sizes: np.ndarray,
         low: np.ndarray, high: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (question, word of its range low to high) exactly one edit apart.

    Both share their first ``known`` letters. A row of the matrix holds the cells
    one left of, on and one right of the diagonal; 2 stands for anything above 1.
    """
    asked = np.flatnonzero(low < high)
    low, high = low[asked], high[asked]
    row = np.empty((3, len(asked)), np.int8)
    row[0], row[1], row[2] = (1 if known else 2), 0, np.where(q_sizes[asked] > known, 1, 2)
    found_q, found_w = [], []
    depth = known
    while len(asked):
        turns = np.flatnonzero(prefixes <= depth)
        first, last = np.searchsorted(turns, low, "right"), np.searchsorted(turns, high, "left")
        parts = last - first + 1
        parent = np.repeat(np.arange(len(asked)), parts)
        lead = np.cumsum(parts) - parts
        start = np.empty(len(parent), np.int64)
        inner = np.ones(len(parent), bool)
        inner[lead] = False
        start[lead] = low
        start[inner] = turns[W.places(first, last - first)]
        end = np.empty_like(start)
        end[:-1] = start[1:]
        end[lead + parts - 1] = high
        asked, row = asked[parent], row[:, parent]
        size = q_sizes[asked]

        over = sizes[start] == depth  # the word ends here
        side = size - depth + 1
        exact = over & (side >= 0) & (side <= 2)
        exact[exact] = row[side[exact], np.flatnonzero(exact)] == 1
        found_q.append(asked[exact])
        found_w.append(start[exact])

        on = ~over
        asked, row, start, end, size = asked[on], row[:, on], start[on], end[on], size[on]
        letter = letters[begins[start] + depth]
        differs = np.ones((3, len(asked)), np.int8)  # from the question's letters in the three columns
        for k in range(3):
            column = depth - 1 + k
            there = np.flatnonzero((column >= 0) & (column < size))
            differs[k, there] = q_letters[q_begins[asked[there]] + column] != letter[there]
        left = np.minimum(row[1] + 1, row[0] + differs[0])
        left[size < depth] = 2
        middle = np.minimum(np.minimum(row[2] + 1, row[1] + differs[1]), left + 1)
        middle[size < depth + 1] = 2
        right = np.minimum(row[2] + differs[2], middle + 1)
        right[size < depth + 2] = 2
        row = np.minimum(np.stack([left, middle, right]), 2)
        alive = row.min(axis=0) <= 1
        asked, row, low, high = asked[alive], row[:, alive], start[alive], end[alive]
        depth += 1
    return np.concatenate(found_q or [asked]), np.concatenate(found_w or [asked])


_ROWS = "b int, turned int, part int, list bigint, listed boolean, spelled string, n bigint"
_NEAR = "word string, n bigint, n_near bigint, form_n bigint, form string"


def _near_of_block(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of the questions of whole lists that have one b."""
    b = table["b"][0].as_py()
    known = (b - 1) // 2
    spelled = table["spelled"].combine_chunks()
    letters, bounds = _latin(spelled)
    begins, sizes = bounds[:-1], np.diff(bounds)
    n = table["n"].to_numpy()
    turned = table["turned"].to_numpy() == 1
    group = np.cumsum(_list_starts(table))
    listed = np.flatnonzero(table["listed"].to_numpy())
    asking = np.flatnonzero(~table["asked"].to_numpy())
    prefixes = common_prefixes(letters, begins[listed], sizes[listed], group[listed], known)
    for k in range(0, len(asking), QUESTIONS):
        asked = asking[k : k + QUESTIONS]
        low, high = (np.searchsorted(group[listed], group[asked], side) for side in ("left", "right"))
        q, w = scan(letters, begins[listed], sizes[listed], prefixes, letters, begins[asked], sizes[asked], low, high, known)
        q, w = asked[q], listed[w]
        fits = np.maximum(sizes[q], sizes[w]) == b
        # words that share their first letters too have met in the list of these
        twice = turned[q].copy()
        for j in range(known):
            twice &= letters[bounds[q + 1] - 1 - j] == letters[bounds[w + 1] - 1 - j]
        q, w = q[fits & ~twice], w[fits & ~twice]
        if not len(q):
            continue
        by = np.lexsort((-n[w], q))
        q, w = q[by], w[by]
        heads = np.flatnonzero(np.diff(q, prepend=-1))
        counts = np.diff(np.append(heads, len(q)))
        best = w[heads]
        ties = np.repeat(n[best], counts) == n[w]
        tied = np.add.reduceat(ties.astype(np.int64), heads)
        def word(i: int) -> str:
            return letters[bounds[i] : bounds[i + 1]].tobytes().decode("latin-1")[:: -1 if turned[i] else 1]
        forms = [min(map(word, w[a : a + t].tolist())) for a, t in zip(heads.tolist(), tied.tolist(), strict=True)]
        q = q[heads]
        yield pa.RecordBatch.from_arrays(
            [pa.array([word(i) for i in q.tolist()], pa.string()), pa.array(n[q]), pa.array(counts.astype(np.int64)),
             pa.array(n[best]), pa.array(forms, pa.string())], names=["word", "n", "n_near", "form_n", "form"])


def _list_starts(table: pa.Table) -> np.ndarray:
    """Which rows begin another list (or part of one)."""
    out = np.zeros(table.num_rows, bool)
    for name in ("b", "turned", "part", "list"):
        out |= np.diff(table[name].to_numpy().astype(np.int64), prepend=0) != 0
    out[:1] = True
    return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan the lists of a task as they come; a list's own words come before those that only ask."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        b = table["b"].to_numpy()
        cuts = np.flatnonzero(np.diff(b, prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(b)], strict=True):
            yield from _near_of_block(table.slice(lo, hi - lo))

    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held.append(table.append_column("asked", pa.array(np.zeros(table.num_rows, bool))))
        size += table.num_rows
        if size < ROWS:
            continue
        table = pa.concat_tables(held)
        last = int(np.flatnonzero(_list_starts(table))[-1])
        rest = table.slice(last)
        if pc.all(rest["listed"]).as_py():  # the list may still grow
            yield from settle(table.slice(0, last)) if last else ()
        else:
            yield from settle(table)
            rest = rest.filter(rest["listed"])
            rest = rest.set_column(rest.schema.get_field_index("asked"), "asked", pa.array(np.ones(rest.num_rows, bool)))
        held = [rest]
        size = 0 if rest.num_rows >= ROWS else rest.num_rows
    if held:
        table = pa.concat_tables(held)
        if table.num_rows:
            yield from settle(table)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, n_near, form_n, form) per word: near words, and the most frequent of them.

    Ties go to the smallest form in code-point order; null where no word is near.
    """
    length = F.length("word")
    roles = [F.struct((length + more).alias("b"), F.lit(turned).alias("turned")) for more in (0, 1) for turned in (0, 1)]
    rows = vocabulary.select("word", "n", F.explode(F.array(*roles)).alias("role")).select("word", "n", "role.*")
    rows = rows.withColumn("spelled", F.when(F.col("turned") == 1, F.reverse("word")).otherwise(F.col("word")))
    rows = rows.withColumn("list", F.xxhash64(F.expr("left(spelled, (b - 1) div 2)")))
    lists = ["b", "turned", "list"]
    large = rows.groupBy(*lists).agg(F.ceil(F.count(F.lit(1)) * F.first("b") / PART_BYTES).cast("int").alias("parts"))
    rows = rows.join(large.filter("parts > 1"), lists, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word", F.lit(7)), "parts").cast("int"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("listed", F.col("part") == F.col("own"))
    # a fixed number: small rows, but much work for each
    tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, *lists, "part").sortWithinPartitions(*lists, "part", F.desc("listed"), "spelled")
    dealt = dealt.select("b", "turned", "part", "list", "listed", "spelled", "n")
    near = dealt.mapInArrow(_near, _NEAR)
    none = vocabulary.select("word", "n", F.lit(0).cast("bigint").alias("n_near"),
                             F.lit(None).cast("bigint").alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form")))
    out = near.union(none).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return out.select("word", "n", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the word where its forms end.

    Every round replaces a root by the root's own, so that a chain of c forms takes
    about log2(c) rounds; a form is twice as frequent as its word, so chains are short.
    """
    current = materialize(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(current.join(onward, "root", "left"))
        current = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next is not null").isEmpty():
            return current


def group_variants(documents: DataFrame, least_count: int = LEAST_COUNT, times: int = 2) -> DataFrame:
    """One row per word of the corpus: (word, form, root, n, n_near, form_n).

    form is the word's most frequent near word if at least ``times`` as frequent,
    root the end of the chain of forms, the word itself if it has none. Tables
    without words give no rows; extra columns are not read.
    """
    prepare(documents.sparkSession)
    words = materialize(vocabulary(documents, least_count))
    near = near_words(words)
    enough = F.col("form_n") >= times * F.col("n")
    near = materialize(near.select("word", "n", "n_near", *(F.when(enough, F.col(c)).alias(c) for c in ("form", "form_n"))))
    out = near.join(roots(near), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
