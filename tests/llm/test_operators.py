"""Every corpus operator against a plain version, with the awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vacancylake.llm import (
    bpe, cover_tree, decontaminate, html_text, kneser_ney, licenses, ngram_join, shared, token_files, toxicity, url_trust,
)

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id bigint, text string, label string, hash string, key bigint, name string, n int, u string, root string"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def corpus():
    base = prose(120, 1)
    words = base.split()
    near = [" ".join(words[:k] + ["edit"] + words[k + 1 :]) for k in (3, 60, 117)]
    far = [" ".join(words[: 60]) + " " + prose(60, 9)]
    tiny = ["one two three four five six seven eight", "one two three four five six seven eight nine", "Two words", "two  words"]
    long = [prose(6000, 3), "x" * 30_000, prose(40, 4) + "\n" * 50]
    texts = [base, base.upper(), *near, *far, *tiny, *long, None, "", "   \n", "é Ünï 日本 <|endoftext|> ok", base]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, base.upper()), (None, base), (None, None)]
    return rows


def frame(spark, rows):
    """Rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "l", "h", 1, "n", 2, "u", "r") for i, t in rows], DOCS)


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def test_words_are_hashed_alike_everywhere():
    texts = ["Ab  cd", None, "", "ab", " \tcd ab\n", "Ä ab"]
    words = shared and __import__("vacancylake.llm.words", fromlist=["x"])
    found = words.split(pa.array(texts))
    h = words.hashes(found)
    assert np.diff(found.bounds).tolist() == [2, 0, 0, 1, 2, 2]
    assert h[0] == h[2] == h[4] == h[6] == words.hash_of("AB") and h[1] == h[3] and len(set(h.tolist())) == 3


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, shared.components(spark.createDataFrame(edges, "u int, v int")).collect()))
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}}
    assert shared.components(spark.createDataFrame([], "u int, v int")).count() == 0


# 9


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    names = {k: min((i for i in ids if i is not None), default=None) for k, ids in least.items()}
    return [(i, len(s), names[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=repr)


def test_join_equals_all_pairs(spark):
    rows = corpus()
    r = random.Random(2)
    for k in range(60):  # sizes on both sides of every boundary
        n = r.randint(4, 24)
        text = prose(n, k // 4).split()
        if k % 4 and len(text) > 5:
            text[r.choice([0, -1])] = "new"
        rows.append((1000 + k, " ".join(text)))
    got = ngram_join.join(frame(spark, rows)).collect()
    assert order(tuple(x) for x in got) == order(brute_components(rows))


@pytest.mark.parametrize("boundary", [0, 6, 12])
def test_join_is_the_same_for_every_boundary(spark, monkeypatch, boundary):
    monkeypatch.setattr(ngram_join, "choose_boundary", lambda costs: boundary)
    monkeypatch.setattr(ngram_join, "HELD", 40)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rows = [(k, " ".join(VOCABULARY[k % 3 : k % 3 + 4 + k % 13])) for k in range(60)]
    got = ngram_join.join(frame(spark, rows)).collect()
    assert order(tuple(x) for x in got) == order(brute_components(rows))


def test_join_of_nothing_and_keep_one(spark):
    assert ngram_join.join(frame(spark, [])).collect() == []
    kept = ngram_join.keep_one(frame(spark, corpus()))
    assert kept.columns == frame(spark, []).columns
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == [-1, 0, 5, 6, 8, 10, 11, 12, 13, 14, 15, 16]


def test_join_of_unrelated_documents(spark):
    rows = [(i, prose(40, 100 + i)) for i in range(20)]
    assert order(tuple(r) for r in ngram_join.join(frame(spark, rows)).collect()) == order(brute_components(rows))
    assert [tuple(r) for r in ngram_join.join(frame(spark, rows[:1])).collect()] == brute_components(rows[:1])
    assert ngram_join.keep_one(frame(spark, rows)).count() == 20


@pytest.mark.parametrize("shared", [False, True])
def test_full_buckets_keep_every_shared_shingle(monkeypatch, shared):
    monkeypatch.setattr(ngram_join, "HELD", 5)  # reached often, with and without a frequent shingle
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    tokens = {slab: [100 * slab + k for k in range(4)] + ([7, 8] if shared else []) + ([9] if slab < 2 else []) for slab in range(6)}
    batch = pa.RecordBatch.from_pylist([
        {"bucket": 0, "slab": slab, "sets": np.arange(len(t), dtype="<u4").tobytes(), "runs": np.ones(len(t), "<u4").tobytes(),
         "low": ngram_join.pack(np.array(t, np.uint64), 5)} for slab, t in tokens.items()])
    found = Counter()
    for out in ngram_join._shared(iter([batch])):
        found.update(np.frombuffer(out.column(2)[0].as_py(), "<u8").tolist())
    assert found == ({7: 6, 8: 6, 9: 2} if shared else {9: 2})


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    near = prose(60, 1).split()
    edits = [" ".join(near[:k] + ["edit"] + near[k + 1 :]) for k in (3, 40)]
    rows = [(0, " ".join(near)), (1, edits[0]), (1, edits[1]), (1, prose(60, 2)), (2, "  "), (2, "  ")]
    df = spark.createDataFrame([(i, t, {"k": i}) for i, t in rows], "doc_id bigint, text string, row_digest map<string, bigint>")
    kept = ngram_join.keep_one(df).collect()
    assert order((r.doc_id, r.text) for r in kept) == order([rows[0], rows[3], rows[4], rows[5]])
    assert all(r.row_digest == {"k": r.doc_id} for r in kept)


# 5 and 7


def test_bpe_of_awkward_texts_equals_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    r = random.Random(3)
    signs = ["a", "b", " ", " ", "  ", "\n", "\n\n", "\t", "\u2003", "\u3000", "\xa0", "\x85", "é", "日本", ".", "'s", "'", "1",
             "23", "<|", "<|endoftext|>", "<", "|>", "\u1680", "🙂", "\u200b", "\u205f", "\x1c"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["", None, " ", "".join(r.choice("abcdefghij") for _ in range(5000))]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)  # is trimmed and cleared on the way
    for coder in (bpe.ByteBpe(bpe.vocabulary_path()), token_files.LibraryBpe(bpe.vocabulary_path())):
        for first in range(0, len(texts), 300):
            ids, sizes = coder.encode(pa.array(texts[first : first + 300]))
            ends = np.cumsum(sizes)
            assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == want[first : first + 300]
            assert coder.known.size <= 20_000


def test_plain_chunks_go_to_the_library_together(monkeypatch):
    coder = token_files.LibraryBpe(bpe.vocabulary_path())
    chunks = [b" some", b"word", b" 123", b" ", b" !?", b" hyperventilating", "é".encode(), b" x"]
    want = [e.ids for e in coder.library.encode_batch([c.decode() for c in chunks], add_special_tokens=False)]
    alone, singly = [], coder._singly
    monkeypatch.setattr(coder, "_singly", lambda some: alone.extend(some) or singly(some))
    for joined in (1000, 2):
        monkeypatch.setattr(token_files, "JOINED", joined)
        ids, sizes = coder.learn(chunks, [any(b >= 128 for b in c) for c in chunks])
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == want
    assert alone == [b"word", b" ", "é".encode()] * 2


def test_bpe_and_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    rows = corpus() + [(50, "aaaaaa  aa \u3000\x1c\x85 don't I'LL <|endoftext|><|endoftext|>x <|"), (51, "\n a")]
    df = frame(spark, rows)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    digest = lambda ids: hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    back = lambda ids: hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    got = bpe.round_trip(df).collect()
    assert order(tuple(r)[:4] for r in got) == order((i, len(x), digest(x), back(x)) for i, x in want)
    encoded = bpe.encode(df)
    assert order(tuple(r) for r in encoded.collect()) == order(want)
    assert order(tuple(r) for r in bpe.decode(encoded).collect()) == order((i, t or "") for i, t in rows)
    files = token_files.write(df, parts=3)
    ids_of = [tuple(r) for r in token_files.read(spark, files).collect()]
    assert order((i, ids) for i, _, ids in ids_of) == order((i, [*x, 0]) for i, x in want)
    in_order = sorted(ids_of, key=lambda r: r[1])
    assert [r[1] for r in in_order] == np.cumsum([0, *(len(r[2]) for r in in_order[:-1])]).tolist()
    named = [r[0] for r in in_order]
    assert named == sorted(named, key=lambda i: -1 if i is None else i)
    assert order(tuple(r) for r in token_files.digests(spark, files).collect()) == order(
        (i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in ids_of)
    assert token_files.read_one(files, files.manifest[0][0], 0).tolist() == in_order[0][2]
    empty = token_files.write(frame(spark, []))
    assert token_files.digests(spark, empty).collect() == [] and bpe.round_trip(frame(spark, [])).collect() == []


# 3


def test_licenses_equal_a_plain_scan(spark):
    rows = [
        (1, "Released under the MIT License. " + prose(20, 1) + " licensed under the Apache-License, version 2.0"),
        (2, "CC BY-NC cc by nc 4.0"), (3, "under the mit  license"), (4, None), (5, ""), (6, prose(3000, 2)),
        (7, "This work is licensed under the GNU General Public License, Version 3."), (7, "mit licensee"), (None, "cc-by-nc"),
        (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ]
    got = licenses.scan(frame(spark, rows)).collect()
    want = []
    for i, text in rows:
        w = words_of(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        places, labels = [], set()
        for label, phrase in licenses.BASE:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    assert order(tuple(r)[:6] for r in got) == order(want)
    labels = {(r.doc_id, r.base_labels): r.labels for r in got}
    assert labels[7, ""] in ("gpl-3", "") and {r.labels for r in got if r.doc_id == 7} == {"gpl-3", ""}
    assert labels[8, ""] == "mit" and labels[1, "apache-2,mit"] == "apache-2,mit" and labels[6, ""] == ""
    assert all(0 <= r.score <= 1 for r in got) and licenses.scan(frame(spark, [])).collect() == []


def test_a_licence_at_the_head_of_a_text_needs_no_lead_in(spark):
    index = licenses.build_index(1000, dict.fromkeys(licenses.vocabulary(), 10))
    heads = {"GNU General Public License version 3": "gpl-3", "GNU General Public License, version 2": "gpl-2",
             "GNU Lesser General Public License version 3": "lgpl-3"}
    rows = [(0, "this work is licensed under the"), (1, "")]
    rows += [(10 * k + j, lead + head + tail) for k, head in enumerate(heads, 1)
             for j, (lead, tail) in enumerate([("", ""), ("", " " + prose(30, k)), ("one two three four five six ", "")])]
    rows += [(50, "this work is licensed under the gnu"), (51, "general public license version 3")]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows).coalesce(1), index).collect()}
    for k, label in enumerate(heads.values(), 1):
        assert [got[10 * k + j].labels for j in range(3)] == [label] * 3
        assert got[10 * k].score == got[10 * k + 1].score == got[10 * k + 2].score > 0
    assert {got[i].labels for i in (0, 1, 50, 51)} == {""}


NOTICES = [
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("gpl-2", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version"),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: 1. Redistributions of source code must retain the notice. 2. Redistributions in binary form must reproduce it."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: 1. Redistributions in binary form must reproduce it. 3. Neither the name of the holder may be used."),
    ("bsl-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license"),
    ("gpl-3", "SPDX-License-Identifier: GPL-3.0-only"), ("mit", "// SPDX-License-Identifier: MIT"), ("mit", "The MIT License (MIT)\n\nCopyright (c) 2020 A"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc-sa", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"), ("mpl-2", "the terms of the Mozilla Public License, v. 2.0."),
    ("", "the licence of this software is free of charge, with a public version"), ("", "GNU general public works, version 3 of the free text"),
]


def plain_labels(text, index_of):
    """Labels and best share of a text by a plain search over all places of all templates."""
    split = lambda t: words_of(t, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, labels, best = split(text), set(), 0.0
    has = lambda part, phrase: any(part[i : i + len(phrase)] == phrase for i in range(len(part)))
    for t in licenses.TEMPLATES:
        tokens = split(t.text)
        rarest = sorted(set(tokens), key=lambda x: (-index_of[x], x))
        weight = sum(index_of[x] * tokens.count(x) for x in rarest[: licenses.RARE_WORDS])
        own = [x for x in rarest if x in w][: licenses.RARE_WORDS]
        for first in range(-len(tokens), len(w)):
            share = sum(index_of[x] for i, x in enumerate(tokens) if x in own and 0 <= first + i < len(w) and w[first + i] == x) / weight
            window = w[max(first, 0) : max(first + len(tokens) + t.reach, 0)]
            if share >= licenses.AGREE and all(any(has(window, p.split()) for p in m.split("|")) for m in t.mandatory):
                if not any(has(window, p.split()) for p in t.absent):
                    labels.add(t.label)
                    best = max(best, min(share, 1.0))
    return labels, best


def test_licence_labels_equal_a_plain_search(spark):
    texts = [text for _, text in NOTICES] + ["Preface. " * 9 + text + " and more" for _, text in NOTICES]
    texts += [NOTICES[0][1].replace("redistribute", "reshare"), NOTICES[1][1] + " " + NOTICES[4][1], "mit license " * 40]
    rows = list(enumerate(texts)) + [(0, None), (1, ""), (2, texts[2])]
    frequencies = {w: sum(w in words_of(t, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") for _, t in rows) for w in licenses.vocabulary()}
    idf = {w: math.log((len(rows) + 1) / (n + 1)) + 1 for w, n in frequencies.items()}
    got = licenses.scan(frame(spark, rows)).collect()
    want = []
    for i, text in rows:
        labels, best = plain_labels(text, idf)
        words = " ".join(words_of(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
        base = {label for label, phrase in licenses.BASE if f" {phrase} " in f" {words} "}
        want.append((i, ",".join(sorted(labels | base)), 1.0 if base else best))
    for g, x in zip(order((r.doc_id, r.labels, round(r.score, 9)) for r in got), order((i, a, round(b, 9)) for i, a, b in want), strict=True):
        assert g == x
    named = {r.doc_id: r.labels for r in got if r.labels or r.doc_id > 2}
    for i, (label, _) in enumerate(NOTICES):
        assert named.get(i, "") == named.get(i + len(NOTICES), "") == label, NOTICES[i]


# 8


def test_language_model_equals_a_plain_one(spark):
    rows = [(i, t) for i, t in corpus()] + [(100 + k, prose(80, 50 + k // 2)) for k in range(30)]
    got = kneser_ney.perplexity(frame(spark, rows)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(i, [*words_of(t), 0]) for i, t in rows]
    c, pairs = Counter(), Counter()
    for i, w in texts:
        if not held(i):
            c.update(w)
            pairs.update(zip([1, *w], w))
    n, v = sum(c.values()), len(c)
    before, follow, kinds = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), k in pairs.items():
        follow[a] += k
        kinds[a][min(k, 3)] += 1
    count = lambda items: [Counter(items)[k] for k in (1, 2, 3, 4)]
    high, low = kneser_ney.discounts(count(pairs.values())), kneser_ney.discounts(count(before.values()))
    left = sum(low[min(k, 3)] for k in before.values()) / len(pairs)

    def p(a, w):
        lower = (before[w] - low[min(before[w], 3)]) / len(pairs) + left / (v + 1)
        if not follow[a]:
            return lower
        k = pairs[a, w]
        return (k - high[min(k, 3)]) / follow[a] + sum(high[j] * kinds[a][j] for j in (1, 2, 3)) / follow[a] * lower

    want = [(i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w),
             sum(math.log10(p(a, x)) for a, x in zip([1, *w], w))) for i, w in texts]
    for g, x in zip(order(tuple(r)[:7] for r in got), order(want)):
        assert g[:5] == x[:5] and g[5:] == pytest.approx(x[5:], rel=1e-9)
    assert sum(p(VOCABULARY[0], w) for w in c) + p(VOCABULARY[0], "?") == pytest.approx(1)
    assert kneser_ney.perplexity(frame(spark, [])).collect() == []


# 1


def plain_distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        up, row[0] = row[:], 0
        for i in range(1, len(row)):
            row[i] = min(up[i] + 1, row[i - 1] + 1, up[i - 1] + (pattern[i - 1] != c))
        best = min(best, row[-1])
    return best


def test_decontamination_finds_every_match_within_the_budget(spark):
    items = [(k, prose(25, 200 + k)) for k in range(6)] + [(6, None), (7, ""), (8, "short"), (None, prose(25, 300))]
    rows = []
    for k in range(40):
        text = list(items[k % 6][1])
        r = random.Random(k)
        for _ in range(k // 3):
            at = r.randrange(len(text))
            text[at : at + 1] = r.choice([[], ["q"], ["q", text[at]]])
        rows.append((k, prose(30, k) + "\n" + "".join(text).title().replace(" ", ",  ") + ". " + prose(10, k)))
    rows += [(90, None), (91, ""), (92, prose(5000, 1)), (0, rows[0][1]), (None, items[-1][1])]
    got = decontaminate.find_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    flat = lambda t: b" ".join(re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode()))
    want = []
    for i, text in rows:
        for item, pattern in items:
            p = flat(pattern)
            if len(p) >= decontaminate.MIN_BYTES and len(text or "") < 2000:
                d = plain_distance(p, flat(text))
                want += [(i, item, d)] if d <= int(decontaminate.RATE * len(p)) else []
    assert order((r.doc_id, r.item_id, r.distance) for r in got) == order(want)
    clean = decontaminate.drop_leaks(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert clean.count() == len(rows) - len({(k, i) for k, (i, _) in enumerate(rows) if i in {w[0] for w in want}})
    none = decontaminate.find_leaks(frame(spark, rows), spark.createDataFrame([], "item_id bigint, text string"))
    assert none.collect() == []


def test_short_items_and_items_clipped_at_a_text_start_are_found(spark):
    long = prose(20, 400)
    items = [(1, "Two plus two?"), (2, "日本の首都"), (3, "yes"), (4, "yes"), (5, long), (6, "!?"), (7, "who wrote hamlets")]
    rows = [
        (0, long[3:] + " " + prose(10, 1)), (1, "So: TWO, plus\n two"), (2, "two plus twofold"), (3, "問:日本の首都はどこ"), (4, "eyes yesterday yesé"),
        (5, "“Yes” or yes"), (6, "yes"), (7, prose(5, 2)), (8, None), (9, "Who wrote hamletsx"), (10, "xx who wrots hamlets"), (11, "two"), (12, "plus two"),
    ]
    leaks = {(0, 5), (1, 1), (3, 2), (5, 3), (5, 4), (6, 3), (6, 4), (9, 7), (10, 7)}
    table = spark.createDataFrame(items, "item_id bigint, text string")
    df = frame(spark, rows).coalesce(1)
    assert len(decontaminate.normalize(pa.array([items[-1][1]]))[0]) == 17  # one edit at the given rate
    got = decontaminate.find_leaks(df, table).collect()
    assert order((r.doc_id, r.item_id) for r in got) == order(leaks)
    places = {(r.doc_id, r.item_id): (r.start, r.end, r.distance) for r in got}
    assert places[1, 1] == (3, 15, 0) and places[0, 5][2] == 3
    kept = {r.doc_id for r in decontaminate.drop_leaks(df, table).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in leaks}


# 4


def test_links_equal_all_pairs(spark):
    r = np.random.default_rng(3)
    centers = r.standard_normal((12, 16))
    x = np.concatenate([centers[k % 12] + r.standard_normal((1, 16)) * (0.02 + 0.03 * (k % 9)) for k in range(400)]).astype(np.float32)
    rows = [(k, x[k].tolist(), k % 2) for k in range(400)] + [(400 + k, x[0].tolist(), 0) for k in range(5)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] + [1.0] * 15, 0), (504, x[0].tolist(), None),
             (505, [], 0), (506, (x[0] * 7).tolist(), 0), (507, [float("inf")] * 16, 0), (3, x[3].tolist(), 1)]
    df = spark.createDataFrame([(*row, "e") for row in rows], "vec_id bigint, embedding array<float>, label int, vec string")
    usable = [k for k, (_, e, l) in enumerate(rows) if l is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    unit = {k: np.array(rows[k][1], np.float32).astype(float) for k in usable}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    links = {k: [j for j in usable if j != k and rows[j][2] == rows[k][2] and unit[k] @ unit[j] >= 0.93] for k in usable}
    want = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min(rows[j][0] for j in seen)
        want.append((i, len(links.get(k, ())), low, low == i))
    for limit in (2048, 50):
        cover_tree.blocks_of.__defaults__ = (limit,)
        assert order(tuple(g) for g in cover_tree.threshold_links(df).collect()) == order(want)
    cover_tree.blocks_of.__defaults__ = (cover_tree.BLOCK,)
    assert cover_tree.threshold_links(df.limit(0)).collect() == []


def test_cover_tree_levels():
    x = np.random.default_rng(1).standard_normal((200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = cover_tree.build(x)
    leaves = [p for k, p in enumerate(tree.points) if tree.first[k] == tree.first[k + 1]]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(200))
    for k, points in enumerate(tree.points):
        children = range(tree.first[k], tree.first[k + 1])
        assert tree.center[k] in points and (not children or tree.center[children[0]] == tree.center[k])
        assert np.linalg.norm(x[points] - x[tree.center[k]], axis=1).max() <= tree.radius[k] + 1e-7


# 2 and 6


def test_url_rules_and_propagation(spark):
    pages = [
        (1, "https://A.Example.org/es/1?x", "<a href='//bad.net/q'>"), (2, "http://a.example.org/en/2", None), (3, None, None),
        (4, "no url", ""), (5, "x://com", ""), (6, "http://b.com/fr/", "<a href=http://good.net/>"), (7, "http://good.net/x", ""),
        (8, "http://bad.example.org/es/", "<a HREF=\"https://evil.net\">"), (9, "http://evil.net/a", "<a href='http://bad.example.org/'>"),
        (9, "http://evil.net/a", None), (10, "http://notexample.org/en/1", ""), (11, "http://x.com/de/a#f", ""), (12, "http://org?q", ""),
    ]
    df = spark.createDataFrame([(*p, "h", "v") for p in pages], "page_id bigint, url string, html string, host string, verdict string")
    got = sorted(tuple(r)[:5] for r in url_trust.judge(df).collect())
    assert got == sorted([
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "a.example.org", "/en/2", "org/", "allow"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "com", "", None, "allow"), (6, "b.com", "/fr/", "com/fr/", "allow"), (7, "good.net", "/x", None, "allow"),
        (8, "bad.example.org", "/es/", "example.org/es/", "block"), (9, "evil.net", "/a", None, "block"), (9, "evil.net", "/a", None, "block"),
        (10, "notexample.org", "/en/1", "org/", "allow"), (11, "x.com", "/de/a", "com/de/", "block"), (12, "org", "", None, "allow"),
    ], key=lambda r: (r[0], r[1]))
    assert url_trust.judge(df.limit(0)).collect() == []


def test_distrust_counts_however_thin_it_is_spread(spark):
    hops, pages = 6, [(0, "http://h0.com/de/", "")]
    for hop in range(hops):  # h<k+1> and 40 others link to h<k>
        sources = [f"h{hop + 1}"] + [f"h{hop}s{k}" for k in range(40)]
        pages += [(len(pages) + k, f"http://{s}.net/", f"<a href='//h{hop}.{'net' if hop else 'com'}/'>")
                  for k, s in enumerate(sources)]
    pages += [(1000, "http://alone.net/", ""), (1001, "http://good.com/fr/", "<a href='//even.net/'>")]
    pages += [(1002, "http://even.net/", "<a href='//h0.com/'>")]
    got = {r.host: r for r in url_trust.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    deep = got[f"h{hops}.net"]
    assert deep.trust == 0 and 0 < deep.distrust < 1e-9 and deep.verdict == "block"
    assert got["alone.net"].verdict == got["even.net"].verdict == "allow"


def test_main_text(spark):
    body = prose(60, 1)
    pages = [
        (1, f"<html><title>t</title><nav>Menu</nav><article><h1>A &amp; B</h1><p>{body}<p>one<br>two</article><footer>f</footer>", f"A & B\n\n{body}\n\none two"),
        (2, f"<div class='cookie-bar'>{body}</div><div><h2>T</h2><p>{body}</p><p>end.</p></div><div id=comments><p>{body}</p></div>", f"T\n\n{body}\n\nend."),
        (3, None, ""), (4, "", ""), (5, "<script>x</script><nav>a</nav>", ""), (6, "<p>unclosed <b>bold", "unclosed bold"),
        (7, f"<article><p>{body}</p><div class='ad'>Buy</div><form><p>f</p></form><aside>s</aside><p>z</p></article>", f"{body}\n\nz"),
    ]
    df = spark.createDataFrame([(i, "u", h, "t") for i, h, _ in pages], "page_id bigint, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert got == {i: (t, len(t)) for i, _, t in pages}
    assert html_text.extract(df.limit(0)).collect() == []


def test_main_text_is_searched_for_on_every_page_and_kept_whole():
    of = lambda page: html_text.main_lines(html_text.lines_of(page))
    p = lambda *texts: "".join(f"<p>{t}</p>" for t in texts)
    first, second, tiny = prose(60, 1), prose(30, 2), ["Home", "FAQ", "Map", "News", "Me"]
    menu = "<ul class=menu><li>a<li>b<li>c<li>d</ul>"
    assert of(p(first) + menu + p(second)) == [first, second]
    assert of(p(first, *tiny, second)) == [first, *tiny, second]
    assert of(p(*tiny, first, second, *tiny)) == [*tiny[-2:], first, second]
    short, many = [f"line {k} of five" for k in range(5)], [f"line {k} of very many" for k in range(10, 50)]
    assert of(p(*short)) == short and of(p(*many)) == many
    assert of(p("x") + "<article>" + p(*short) + menu + p(*short) + "</article>" + p(first)) == short + short
    assert of("<article>" + p("T", "By", "Me", "Now", first, *tiny) + "</article>") == ["T", "By", "Me", "Now", first, *tiny]
    assert of(f"<article>{p(first)}</article>{p(*tiny)}<article>{p(second)}</article>") == [first, second]


def test_main_text_is_not_lost_to_class_names():
    of = lambda page: html_text.main_lines(html_text.lines_of(page))
    body, more, own = prose(60, 1), prose(40, 2), "<p>own</p>"
    for name in ("content no-sidebar", "with-sidebar", "login-tutorial", "entry-header", "socialHistory"):
        assert of(f"<div class='{name}'><p>{body}</p></div><p>{more}</p>") == [body, more], name
    for name in ("sidebar", "site-footer", "relatedPosts", "main ad-slot", "comment-list", "user_comments", "discussion"):
        assert of(f"<div class='{name}'><p>{more}</p></div><p>{body}</p>") == [body], name
    assert of(f"<article><div class='entry-header'><h1 class=page-header>T</h1></div><section class=social-history>{own}</section>"
              f"<div class=notice>{own}</div><div class=related>{own}</div><p>{body}</p></article>") == ["T", "own", "own", body]
    # a bad name around nearly all text is no reason, a bad name inside it still is; comments stay out
    assert of(f"<p>Home</p><div class=banner><p>{body}</p><div class=ads>{own}</div><p>{more}</p></div>")[-2:] == [body, more]
    assert of(f"<p>Home</p><div id=comments><p>{body}</p><p>{more}</p></div>") == ["Home"]
    assert of(f"<div class=related><article>{own}</article></div><p>{body}</p>") == [body]
    # a small mark does not outweigh the page
    assert of(f"<article>{own}</article><p>{body}</p><p>{more}</p>") == ["own", body, more]


def test_main_text_keeps_lines_around_dropped_inline_elements():
    of = lambda page: html_text.main_lines(html_text.lines_of(page))
    body = prose(60, 1)
    assert of(f"<p>Press <button>OK</button> to go on</p><p>{body}</p>") == ["Press to go on", body]
    assert of(f"<p>a<span hidden>b<span>c</span></span>d</p><p>{body}") == ["a d", body]
    assert of(f"<p>a <button>OK</p><p>{body}</p>") == ["a", body]
    assert of(f"<p>a <select><option>x<li>y</select> b</p><p>{body}</p>") == ["a b", body]
    assert of("<button>only") == []


def test_main_text_without_marks_leaves_menu_and_rights_out():
    of = lambda page: html_text.main_lines(html_text.lines_of(page))
    body, more = prose(60, 1), prose(30, 2)
    links = "<div><a href=/>Home</a></div><div><a href=/a>About</a> <a href=/b>us</a></div>"
    assert of(links + f"<h1>T</h1><p>{body}</p><p>{more}</p><p>&copy; 2024 A. All rights reserved.</p>") == ["T", body, more]
    assert of(f"<p>Home</p><p>About</p><h1>T</h1><p>{body}</p>{links}") == ["T", body]
    assert of(f"<p>{body}</p>{links}<p>{more}</p>") == [body, "Home", "About us", more]
    assert of(links) == ["Home", "About us"]


def test_main_text_of_marked_pages_against_plain_search(spark):
    """Whole pages, marked or not, against the definition read off line by line."""
    r = random.Random(8)

    def plain(lines):
        lines = [line for line in lines if not line.dropped]
        sizes = [len(line.text) for line in lines]
        inside = sum(n for n, line in zip(sizes, lines, strict=True) if line.mark)
        if inside and 4 * inside >= sum(sizes) - inside:
            sizes = [n if line.mark else 0 for n, line in zip(sizes, lines, strict=True)]
            reach = {m: [k for k, line in enumerate(lines) if line.mark == m] for m in {line.mark for line in lines} - {0}}
        else:
            reach = {}
        spans = [reach.get(line.mark, [k]) for k, line in enumerate(lines)]
        total = [sum(sizes[k : k + 3]) for k in range(len(sizes))]
        surge = min(80, max(total, default=0) // 2 if max(total, default=0) % 2 == 0 else max(total) / 2)
        found, k = [], 0
        while k < len(sizes):
            if not sizes[k] or total[k] < surge:
                k += 1
                continue
            begin, end = spans[k][0], spans[k][-1] + 1
            while end < len(sizes) and (end + 3 > len(sizes) or 4 * sum(sizes[end : end + 3]) >= surge):
                end = spans[end][-1] + 1
            found.append([begin, end])
            k = end
        joined = found[:1]
        for begin, end in found[1:]:
            a, b = joined[-1]
            if sum(sizes[b:begin]) < min(sum(sizes[a:b]), sum(sizes[begin:end])):
                joined[-1][1] = end
            else:
                joined.append([begin, end])
        best = max(joined, key=lambda s: sum(sizes[s[0] : s[1]]), default=[0, 0])
        return [line.text for n, line in list(zip(sizes, lines, strict=True))[best[0] : best[1]] if n]

    pages = []
    for k in range(200):
        blocks = [f"<p>{prose(r.choice((1, 2, 4, 30, 60)), 50 * k + j)}x</p>" for j in range(r.randint(1, 14))]
        for _ in range(r.randint(0, 2)):
            a = r.randrange(len(blocks))
            b = r.randrange(a, len(blocks))
            blocks[a], blocks[b] = "<article>" + blocks[a], blocks[b] + "</article>"
        blocks.insert(r.randrange(len(blocks) + 1), "<ul class=menu><li>a<li>b<li>c</ul>")
        pages.append((None if k == 5 else k // 2, "u", "".join(blocks)))
    pages += [pages[0], (999, "u", f"<p>{prose(200_000, 7)}</p>")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    expected = sorted("\n\n".join(plain(html_text.lines_of(page))) for *_, page in pages)
    assert sorted(row.text for row in html_text.extract(df).collect()) == expected


# 10


def test_the_least_text_of_an_id_is_learnt_from(spark):
    rows = [(1, "b"), (1, None), (1, "a"), (1, "c"), (2, "x"), (2, "x"), (None, "n"), (3, None)]
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id bigint, toxic int")
    for order in (rows, rows[::-1]):
        documents = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        got = sorted(tuple(r) for r in toxicity.training_rows(documents, labels).select("doc_id", "text", "toxic").collect())
        assert got == [(1, "a", 1), (2, "x", 0)]


def test_toxic_sentences_are_learnt_from_document_labels(spark):
    r = random.Random(4)
    bad = ["scumbag", "moronic", "filthyrat"]
    rows, labels = [], []
    for k in range(400):
        sentences = [prose(8, 1000 + 20 * k + j) for j in range(r.randint(1, 12))]
        toxic = k % 4 == 0
        if toxic:
            sentences[r.randrange(len(sentences))] += " " + r.choice(bad) + " you"
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (7, 0, 0)]
    rows += [(1000, None), (1001, ""), (1002, prose(20000, 1)), (None, "you moronic x."), (0, rows[0][1])]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    df = frame(spark, rows)
    got = toxicity.classify(df, table).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    held = [x for x in got if x.held_out and x.doc_id < 400]
    assert np.mean([x.predicted == (x.doc_id % 4 == 0) for x in held]) > 0.95
    assert {x.predicted for x in got if x.doc_id in (1000, 1001, 1002)} == {0}
    model = toxicity.train(df, table)
    found = toxicity.offending_sentences(df, model).collect()
    texts = {i: (t or "").encode() for i, t in rows}
    right = [any(b in texts[x.doc_id][x.start : x.end].decode() for b in bad) for x in found]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert toxicity.drop_toxic(df, model).count() == sum(x.predicted == 0 for x in got)
    assert {x.score for x in toxicity.classify(df, table.limit(0)).collect()} <= {x.score for x in toxicity.score(df, toxicity.fit(pa.array([], pa.string()), np.zeros(0))).collect()}
