"""License scan by a positional index of rare words.

Licence notices are templates of known wording. Their words get an inverse document
frequency counted over all documents and form the index (word -> template,
position). Of each file the licence words with the highest frequency so weighted are
looked up, template by template: the file's own, not the template's, so that a
notice with a changed word is found by its other words. Every occurrence votes for
the place where the template would begin; a place that gathers enough of the
template's rare weight is a candidate, and counts if the template's mandatory
phrases stand in its window and none of those that tell it from a sister licence.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.llm import words as W
from vacancylake.llm.shared import map_batches, prepare


class Template(NamedTuple):
    label: str
    text: str
    mandatory: tuple[str, ...]  # each phrase, or one of those between bars
    absent: tuple[str, ...] = ()
    reach: int = 2  # words behind the notice in which the phrases may stand


#: Phrases that decide the base labels. Fixed values.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
_GNU_HEADER = (
    "you can redistribute it and or modify it under the terms of the gnu {name} public license as published by the "
    "free software foundation either version {version} of the license or at your option any later version"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met"
)
#: Notices by which licences are commonly declared. Fixed values.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "the mit license mit copyright c", ("mit license mit",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files the software to deal in the software without restriction",
             ("hereby granted free of charge", "any person obtaining a copy of this software")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("hereby granted free of charge", "any person obtaining a copy of this software")),
    Template("bsl-1", "boost software license version 1 0", ("boost software license",)),
    Template("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of "
             "the software and accompanying documentation covered by this license",
             ("any person or organization obtaining a copy",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted provided that the above copyright notice", ("with or without fee is hereby granted",)),
    Template("apache-2", "licensed under the apache license version 2.0", ("apache license", "2 0")),
    Template("cc-by-nc", "licensed under cc by-nc 4.0", ("cc by nc",), ("cc by nc sa", "cc by nc nd")),
    Template("cc-by-nc", "creative commons attribution noncommercial 4.0 international license",
             ("attribution noncommercial|attribution non commercial",),
             ("noncommercial sharealike", "noncommercial share alike", "noncommercial noderivatives", "noncommercial noderivs")),
    Template("cc-by-nc-sa", "licensed under cc by-nc-sa 4.0", ("cc by nc sa",)),
    Template("cc-by-nc-sa", "creative commons attribution noncommercial sharealike 4.0 international license",
             ("attribution noncommercial sharealike|attribution noncommercial share alike",)),
    Template("cc-by-nc-nd", "licensed under cc by-nc-nd 4.0", ("cc by nc nd",)),
    Template("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives 4.0 international license",
             ("attribution noncommercial noderivatives|attribution noncommercial noderivs",)),
    Template("cc-by-nd", "licensed under cc by-nd 4.0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by-sa 4.0", ("cc by sa",)),
    Template("cc-by-sa", "creative commons attribution sharealike 4.0 international license",
             ("commons attribution sharealike|commons attribution share alike",)),
    Template("cc-by", "licensed under cc by 4.0", ("cc by 4|cc by 3|cc by 2",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license",
             ("commons attribution 4 0|commons attribution 3 0|commons attribution 2 0",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0", "public domain dedication")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3|license v3|gpl v3|gplv3")),
    Template("gpl-2", "licensed under the gnu general public license version 2",
             ("gnu general public license", "version 2|license v2|gpl v2|gplv2")),
    Template("gpl-3", _GNU_HEADER.format(name="general", version="3"), ("gnu general public license", "either version 3|version 3 of the license")),
    Template("gpl-2", _GNU_HEADER.format(name="general", version="2"), ("gnu general public license", "either version 2|version 2 of the license")),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3",
             ("gnu lesser general public license", "version 3|license v3|lgpl v3|lgplv3")),
    Template("lgpl-2.1", "licensed under the gnu lesser general public license version 2.1",
             ("gnu lesser general public license", "version 2 1|license v2 1|lgpl v2 1")),
    Template("lgpl-3", _GNU_HEADER.format(name="lesser general", version="3"),
             ("gnu lesser general public license", "either version 3|version 3 of the license")),
    Template("lgpl-2.1", _GNU_HEADER.format(name="lesser general", version="2.1"),
             ("gnu lesser general public license", "either version 2 1|version 2 1 of the license")),
    Template("agpl-3", "licensed under the gnu affero general public license version 3",
             ("gnu affero general public license", "version 3|license v3|agpl v3|agplv3")),
    Template("agpl-3", _GNU_HEADER.format(name="affero general", version="3"),
             ("gnu affero general public license", "either version 3|version 3 of the license")),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2.0", ("mozilla public license", "2 0")),
    Template("epl-2", "under the terms of the eclipse public license v 2.0", ("eclipse public license", "2 0")),
    Template("bsd-3", _BSD, ("redistribution and use in source and binary forms", "neither the name"), reach=120),
    Template("bsd-2", _BSD, ("redistribution and use in source and binary forms", "binary form must reproduce"),
             ("neither the name",), 120),
    Template("bsd", _BSD, ("redistribution and use in source and binary forms",),
             ("neither the name", "binary form must reproduce"), 120),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the "
             "authors be held liable for any damages arising from the use of this software",
             ("authors be held liable for any damages",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)
#: Identifiers of SPDX lines and their labels. Fixed values.
SPDX = (
    ("mit", "mit"), ("apache 2 0", "apache-2"), ("isc", "isc"), ("bsl 1 0", "bsl-1"), ("mpl 2 0", "mpl-2"), ("epl 2 0", "epl-2"),
    ("bsd 2 clause", "bsd-2"), ("bsd 3 clause", "bsd-3"), ("gpl 2 0", "gpl-2"), ("gpl 3 0", "gpl-3"), ("lgpl 2 1", "lgpl-2.1"),
    ("lgpl 3 0", "lgpl-3"), ("agpl 3 0", "agpl-3"), ("cc by nc sa 4 0", "cc-by-nc-sa"), ("cc by nc nd 4 0", "cc-by-nc-nd"),
    ("cc by nc 4 0", "cc-by-nc"), ("cc by sa 4 0", "cc-by-sa"), ("cc by nd 4 0", "cc-by-nd"), ("cc by 4 0", "cc-by"),
    ("cc0 1 0", "cc0"), ("zlib", "zlib"), ("unlicense", "unlicense"),
)
TEMPLATES += tuple(Template(label, f"spdx license identifier {name}", (f"license identifier {name}",)) for name, label in SPDX)
#: Words of a file, the rarest first, that are looked up for one template.
RARE_WORDS = 6
#: Share of a template's rare weight that must agree on one place.
AGREE = 0.6


def _tokens(text: str) -> list[str]:
    data = pa.array([text])
    words = W.split(data, W.NOT_ALNUM)
    return [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]


def vocabulary() -> list[str]:
    return sorted({w for t in TEMPLATES for w in _tokens(t.text)})


def document_frequencies(documents: DataFrame) -> tuple[int, dict[str, int]]:
    """Rows, and for each template word the rows that hold it, counted over all texts."""
    prepare(documents.sparkSession)
    names = vocabulary()
    known = np.array([W.hash_of(w) for w in names], np.uint64)
    order = np.argsort(known)
    ranked = known[order]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(names), np.int64)
        for lo, hi in W.slabs(batch.column(0)):
            words = W.split(batch.column(0).slice(lo, hi - lo), W.NOT_ALNUM)
            h = W.hashes(words)
            spot = np.minimum(np.searchsorted(ranked, h), len(ranked) - 1)
            hit = ranked[spot] == h
            pairs = np.unique(words.doc[hit] * len(names) + order[spot[hit]])
            found += np.bincount(pairs % len(names), minlength=len(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*names, None], pa.string()), pa.array([*found.tolist(), batch.num_rows])], names=["word", "n"]
        )

    counted = map_batches(documents.select("text"), run, "word string, n bigint")
    rows = dict(counted.groupBy("word").agg(F.sum("n")).collect())  # one row per template word
    return rows.pop(None, 0), {w: rows.get(w, 0) for w in names}


class Postings(NamedTuple):
    words: np.ndarray  # of one template, the rarest first, as numbers in the vocabulary
    gain: np.ndarray  # idf of each, once for every place it has
    begins: np.ndarray  # places of vocabulary word i: begins[i] to begins[i + 1]
    positions: np.ndarray
    weight: float  # gain of the RARE_WORDS rarest
    length: int
    mandatory: list[list[np.ndarray]]  # phrases as word hashes, alternatives together
    absent: list[np.ndarray]


class Index(NamedTuple):
    hashes: np.ndarray  # of the vocabulary, ascending
    idf: np.ndarray
    templates: list[Postings]
    base: list[tuple[str, np.ndarray]]


def build_index(n_docs: int, frequencies: dict[str, int]) -> Index:
    names = sorted(frequencies, key=lambda w: int(W.hash_of(w)))
    number = {w: i for i, w in enumerate(names)}
    idf = np.array([np.log((n_docs + 1) / (frequencies[w] + 1)) + 1 for w in names])
    as_hashes = lambda phrase: np.array([W.hash_of(w) for w in _tokens(phrase)], np.uint64)
    templates = []
    for t in TEMPLATES:
        tokens = _tokens(t.text)
        order = np.array([number[w] for w in sorted(set(tokens), key=lambda w: (-idf[number[w]], w))])
        token = np.array([number[w] for w in tokens])
        count = np.bincount(token, minlength=len(names))
        gain = idf[order] * count[order]
        templates.append(Postings(
            order, gain, np.append(0, np.cumsum(count)), np.argsort(token, kind="stable"), float(gain[:RARE_WORDS].sum()), len(tokens),
            [[as_hashes(phrase) for phrase in either.split("|")] for either in t.mandatory], [as_hashes(p) for p in t.absent],
        ))
    return Index(np.array([W.hash_of(w) for w in names], np.uint64), idf, templates,
                 [(label, as_hashes(phrase)) for label, phrase in BASE])


def _places(h: np.ndarray, last: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Words where ``phrase`` stands whole; ``last`` is the end of each word's text."""
    at = np.flatnonzero(h == phrase[0])
    at = at[at + len(phrase) <= last[at]]
    for k, word in enumerate(phrase[1:], 1):
        at = at[h[at + k] == word]
    return at


def _candidates(index: Index, h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(template, text, first word, share of the rare weight) of every place that is agreed on.

    The first word may lie before its text, whose head then lacks the template's lead-in.
    """
    spot = np.minimum(np.searchsorted(index.hashes, h), len(index.hashes) - 1)
    at = np.flatnonzero(index.hashes[spot] == h)
    word = spot[at]
    doc = np.searchsorted(bounds, at, "right") - 1
    held = np.zeros((len(bounds) - 1, len(index.hashes)), bool)
    held[doc, word] = True
    for k, t in enumerate(index.templates):
        mine = held[:, t.words]
        mine &= np.cumsum(mine, axis=1) <= RARE_WORDS  # the file's rarest words of this template
        mine &= (mine @ t.gain >= AGREE * t.weight)[:, None]  # else no place can be agreed on
        if not mine.any():
            continue
        looked_up = np.zeros(held.shape, bool)
        looked_up[:, t.words] = mine
        use = looked_up[doc, word]
        here, of = at[use], word[use]
        many = t.begins[of + 1] - t.begins[of]
        position = t.positions[W.places(t.begins[of], many)]
        # as many places before each text as the template is long, so that no two texts share one
        place = np.repeat(here + (doc[use] + 1) * t.length, many) - position
        vote, one, back = np.unique(place, return_index=True, return_inverse=True)
        share = np.bincount(back, np.repeat(index.idf[of], many), minlength=len(vote)) / t.weight
        agreed = np.flatnonzero(share >= AGREE)
        text = np.repeat(doc[use], many)[one[agreed]]
        for d, first, s in zip(text.tolist(), (vote[agreed] - (text + 1) * t.length).tolist(), share[agreed].tolist(), strict=True):
            yield k, d, first, min(s, 1.0)


def _verified(t: Postings, window: np.ndarray) -> bool:
    """Whether the mandatory phrases stand in the window, and no phrase of a sister licence."""
    inside = np.full(len(window), len(window))
    stands = lambda phrase: len(window) > 0 and len(_places(window, inside, phrase)) > 0
    return all(any(map(stands, either)) for either in t.mandatory) and not any(map(stands, t.absent))


def scan(documents: DataFrame, index: Index | None = None) -> DataFrame:
    """One row per document: words, base phrases and their places, all labels, a score.

    A text may bear several labels. ``score`` is the largest share of a verified template's rare weight found at
    one place, 1 where a base phrase stands. Null and empty texts have no words:
    zero counts, null places, empty labels. A very long text is read whole. Repeated
    rows give repeated results.
    """
    prepare(documents.sparkSession)
    if index is None:
        index = build_index(*document_frequencies(documents))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi in W.slabs(batch.column(1)):
            words = W.split(batch.column(1).slice(lo, hi - lo), W.NOT_ALNUM)
            n, h, doc = hi - lo, W.hashes(words), words.doc
            first, last = words.bounds[:-1][doc], words.bounds[1:][doc]
            n_base = np.zeros(n, np.int64)
            low, high = np.full(n, len(h) + 1), np.full(n, -1)
            base = [set() for _ in range(n)]
            score = np.zeros(n)
            for label, phrase in index.base:
                at = _places(h, last, phrase)
                np.add.at(n_base, doc[at], 1)
                np.minimum.at(low, doc[at], at - first[at])
                np.maximum.at(high, doc[at], at - first[at])
                score[doc[at]] = 1.0
                for d in doc[at].tolist():
                    base[d].add(label)
            labels = [set(b) for b in base]
            found = {}
            for k, d, at, share in _candidates(index, h, words.bounds):
                t, (label, *_, reach) = index.templates[k], TEMPLATES[k]
                window = h[max(at, words.bounds[d]) : min(at + t.length + reach, words.bounds[d + 1])]
                if _verified(t, window):
                    labels[d].add(label)
                    found[d] = max(found.get(d, 0.0), share)
            for d, share in found.items():
                score[d] = max(score[d], share)
            some = n_base > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, n),
                    pa.array(np.diff(words.bounds)),
                    pa.array(n_base),
                    pa.array(low, mask=~some),
                    pa.array(high, mask=~some),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()),
                    pa.array([",".join(sorted(b)) for b in labels], pa.string()),
                    pa.array(score),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return map_batches(
        documents.select("doc_id", "text"), run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )
