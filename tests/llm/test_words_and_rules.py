"""Ranked search, spelling variants and quality rules against plain versions, with the awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from vacancylake.llm import lexical, quality_rules, spelling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EXTRA = "doc_id bigint, text string, lang string, source string, term string, n bigint, word string, list bigint, measures string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def prose(n, seed, letters="aeiounrst"):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(120)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def frame(spark, rows):
    """Rows (id, text, lang, source) with extra columns whose names the operators use inside."""
    full = [(*r, *(None, None)[: 4 - len(r)], "t", 1, "w", 2, "m") for r in rows]
    return spark.createDataFrame(full, EXTRA)


def order(rows):
    return sorted(rows, key=repr)


# 11


def plain_ranking(rows, items, best=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in rows]
    docs, total = sum(1 for t in terms if t), sum(map(len, terms))
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(LOWER)))
    tf = [Counter(t) for t in terms]
    df = Counter(t for c in tf for t in c)
    out = []
    for item, held in wanted.items():
        scored = []
        for (i, _), t, c in zip(rows, terms, tf):
            m = 10 + 90 * len(t) * docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m))
                        for x in held if c[x])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:best])]
    return out


ITEMS = [(0, "The CAT sat; on the mat"), (1, "日本 été 12"), (2, None), (3, "..."), (None, "cat"), (4, "zebra"), (0, "extra words cat"),
         (5, prose(40, 3))]


def documents():
    rows = [(k, prose(random.Random(k).randint(1, 200), 3)) for k in range(60)]
    rows += [(100, "cat cat CAT, the mat"), (101, "concat catalog"), (102, None), (103, ""), (104, " ;; "), (105, "été　日本 12x 12"),
             (106, "cat-mat 日本。"), (106, "cat-mat 日本。"), (None, "the cat"), (None, None), (107, "word " * 9000 + "mat"),
             (108, "x" * 40_000 + " cat")]
    return rows


@pytest.mark.parametrize("block", [lexical.BLOCK_BYTES, 200])  # one block of items, several
def test_ranking_equals_a_plain_one(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    items = spark.createDataFrame([(*r, "x", 1) for r in ITEMS], "item_id int, text string, term string, block int")
    got = lexical.rank(frame(spark, documents()), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(tuple(r) for r in got.collect()) == order(plain_ranking(documents(), ITEMS))


def test_ranking_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical.rank(frame(spark, []), items).collect() == []
    assert lexical.rank(frame(spark, documents()), items.filter("item_id > 9")).collect() == []
    assert lexical.rank(frame(spark, [(1, None)]), items).collect() == []


def test_ranking_sql_holds(spark):
    rows = [r for r in documents() if r[0] is not None]
    con = duckdb.connect()
    con.register("d", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    con.register("b", pa.table({"item_id": pa.array([i for i, _ in ITEMS], pa.int32()), "text": [t for _, t in ITEMS]}))
    con.sql("create view documents as from d")
    con.sql("create view benchmark as from b")
    assert order(con.sql(lexical.RANK_SQL).fetchall()) == order(plain_ranking(rows, ITEMS))


def test_texts_are_scanned_in_pieces(monkeypatch):
    automaton = lexical._automaton("pieces", ("cat", "aa", "日本"))
    text = ("aa cat;cat 日本 " * 50 + "aa" * 30 + " cat").encode()
    whole = lexical.frequencies(automaton, text)
    assert whole == {0: 101, 1: 50, 2: 50}
    for piece in (1, 7, 16, 64):
        monkeypatch.setattr(lexical, "PIECE", piece)
        assert lexical.frequencies(automaton, text) == whole


def test_sums_stay_exact():
    value = np.array([(1 << 52) + 1, (1 << 52) + 3, 5])
    assert lexical._sums(np.array([0, 0, 1]), value, 2, 2).tolist() == [(1 << 53) + 4, 5]


# 12


def plain_words(rows, least=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_variants(words, times=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()]


def wordy():
    r = random.Random(4)
    stems = ["".join(r.choice("abcdé") for _ in range(r.randint(4, 9))) for _ in range(60)]
    rows = []
    for k in range(250):
        words = []
        for _ in range(r.randint(1, 60)):
            w = r.choice(stems[: r.randint(1, 60)])
            if r.random() < 0.4:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("abcdéÿ") + w[at:], w[:at] + r.choice("abcxÀ") + w[at + 1 :]])
            words.append(r.choice([w, w.upper(), w.capitalize()]))
        rows.append((k, r.choice([" ", ", ", "_", "9", "\n", "日"]).join(words)))
    long = "".join(r.choice("ab") for _ in range(3000))
    rows += [(None, None), (None, "abcde " * 5), (7, ""), (8, "×÷×÷× " * 4), (9, " ".join([long, long[1:], long[:-1] + "c", long[5:]] * 30)),
             (9, " ".join([long, long[1:], long[:-1] + "c", long[5:]] * 30))]
    return rows


@pytest.mark.parametrize("part", [spelling.PART_BYTES, 60])  # whole lists, lists dealt out in parts
def test_variants_equal_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART_BYTES", part)
    words = plain_words(wordy())
    got = [tuple(r) for r in spelling.group_variants(frame(spark, wordy())).collect()]
    want = plain_variants(words)
    assert len(words) > 150 and sum(1 for r in want if r[1]) > 50
    assert order(got) == order(want)


def test_lists_are_scanned_in_blocks(monkeypatch):
    """Rows of one list that arrive in many batches, asked in many blocks."""
    words = sorted({"abcd" + "".join(random.Random(k).choice("abc") for _ in range(4)) for k in range(200)})
    rows = [{"b": 8, "turned": 0, "part": 0, "list": 5, "listed": k % 3 != 0, "spelled": w, "n": 1} for k, w in enumerate(words)]
    rows.sort(key=lambda r: (not r["listed"], r["spelled"]))
    schema = pa.schema([("b", pa.int32()), ("turned", pa.int32()), ("part", pa.int32()), ("list", pa.int64()),
                        ("listed", pa.bool_()), ("spelled", pa.string()), ("n", pa.int64())])
    want = {w: sum(one_edit(w, v["spelled"]) for v in rows if v["listed"]) for w in words}
    for blocks in (1, 10, 1000):
        monkeypatch.setattr(spelling, "ROWS", blocks)
        monkeypatch.setattr(spelling, "QUESTIONS", blocks)
        batches = [pa.RecordBatch.from_pylist(rows[k : k + 7], schema) for k in range(0, len(rows), 7)]
        found = Counter()
        for out in spelling._near(iter(batches)):
            found.update(dict(zip(out.column(0).to_pylist(), out.column(2).to_pylist())))
        assert found == {w: n for w, n in want.items() if n}


def test_variants_of_nothing(spark):
    assert spelling.group_variants(frame(spark, [])).collect() == []
    assert spelling.group_variants(frame(spark, [(1, "few rare words"), (2, None)])).collect() == []


def test_chains_of_forms_end_at_their_root(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("w9", None), ("x", "w3")]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string"))
    assert dict(map(tuple, got.collect())) == {**{f"w{k}": "w9" for k in range(9)}, "x": "w9"}


# 13


def quality_rows():
    r = random.Random(1)
    rows = []
    for k in range(260):
        lang = "en" if k % 2 else "de"
        text = prose(r.randint(60, 90), k, "aeiounrst" if lang == "en" else "aeiounrstäö").replace(" ", "\n", 3)
        rows.append((k, text, lang, "big" if k % 3 else "small"))
    junk = " ".join(w + "#$%&|"[k % 5] * 3 for k, w in enumerate(prose(80, 5).split()))
    words = prose(80, 6).split()
    lines = "\n".join(" ".join(words[10 * k : 10 * k + 10]) for k in range(8))
    repeated = " ".join(words[:35]) + " " + " ".join(words[:8]) + " " + " ".join(words[40:]) + " " + " ".join(words[:8])
    rows += [(300, junk, "en", "big"), (301, lines + "\n" + "\n".join(["a b"] * 20), "de", "small"), (302, repeated, "en", "big"),
             (303, "wordwithoutend" * 3 + " " + prose(70, 9, "xyzäöü"), None, None),
             (304, "same " * 60, "en", "big"), (305, "short text", "en", "big"), (306, None, "en", None), (307, "", None, "big"),
             (308, "  \n \t", "xx", "yy"), (309, prose(70, 1), "xx", "yy"), (309, prose(70, 1), "xx", "yy"), (None, prose(70, 2), None, None),
             (310, " ".join("supercalifragilistic%03d" % k for k in range(70)), "en", "big"), (311, "日本語 " * 3 + prose(6000, 7), "ja", "q")]
    return rows


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_plain_counts():
    r = random.Random(8)
    texts = ["".join(r.choice(["a", "b", "a b", " ", "\n", "\n\n", "\t", "é", "日", "#", "$", "\r\n", "　", "ab "]) for _ in range(r.randint(0, 60)))
             for _ in range(400)] + [None, "", "x" * 9000, "a b c " * 3000]
    found = quality_rules.counts(pa.array(texts))
    got = list(zip(*(found[c].tolist() for c in quality_rules.COUNTS)))
    assert got == [plain_counts(t) for t in texts]


def plain_verdicts(rows):
    measured = [(i, lang, source, dict(zip(quality_rules.COUNTS, plain_counts(t)))) for i, t, lang, source in rows]

    def rate(c, rule):
        top, bottom, added, units, _, _ = quality_rules.RATES[rule]
        return units * c[top] // max(c[bottom] + added, 1)

    def failed(c):
        return c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]

    groups = defaultdict(list)
    for _, lang, source, c in measured:
        if not failed(c):
            for key in ((lang, source), (lang,), ()):
                groups[key].append(c)

    def limits(key, rule):
        cells = []
        for c in groups[key]:
            v = rate(c, rule)
            shift = max(v.bit_length() - 6, 0)
            cells.append(v >> shift << shift)
        cells.sort()
        q1, q3 = (cells[(k * len(cells) + 3) // 4 - 1] for k in (1, 3))
        *_, least, both = quality_rules.RATES[rule]
        reach = 3 * max(q3 - q1, least)
        return (q1 - reach if both else -1), q3 + reach

    out = []
    for i, lang, source, c in measured:
        broken = []
        if not failed(c):
            key = next((k for k in ((lang, source), (lang,)) if len(groups[k]) >= 100), ())
            for rule in quality_rules.RATES:
                low, high = limits(key, rule)
                if not low <= rate(c, rule) <= high:
                    broken.append(rule)
        base = tuple(c[x] for x in quality_rules.COUNTS if x != "n_lines")
        out.append((i, *base, failed(c), not failed(c) and not broken, ",".join(broken)))
    return out


def test_rules_equal_plain_ones(spark):
    rows = quality_rows()
    want = plain_verdicts(rows)
    got = [tuple(r) for r in quality_rules.rate_documents(frame(spark, rows)).collect()]
    assert order(got) == order(want)
    told = {r[0]: r[-1] for r in want}
    assert "symbols" in told[300] and "dup_lines" in told[301] and "word_length" in told[310]
    assert all(r[-2] for r in want if r[0] is not None and r[0] < 260)
    con = duckdb.connect()
    con.register("d", pa.table({c: [r[k] for r in rows] for k, c in enumerate(("doc_id", "text", "lang", "source"))}))
    con.sql("create view documents as from d")
    assert order(con.sql(quality_rules.RULES_SQL).fetchall()) == order(want)


def test_sketches_merge_into_the_sketch_of_all(spark):
    df = quality_rules.measure(frame(spark, quality_rows()).drop("measures"), "m")
    whole = quality_rules.merge(quality_rules.sketches(df, "m"))
    halves = [quality_rules.sketches(df.filter(f"coalesce(doc_id, 0) % 2 = {k}"), "m") for k in (0, 1)]
    merged = quality_rules.merge(halves[0].union(halves[1]))
    assert order(map(tuple, whole.collect())) == order(map(tuple, merged.collect()))


def test_kept_documents_keep_their_columns(spark):
    df = frame(spark, quality_rows())
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    want = [r[0] for r in plain_verdicts(quality_rows()) if r[-2]]
    assert order(r.doc_id for r in kept.collect()) == order(want)
    assert quality_rules.keep_good(frame(spark, [])).collect() == []
    assert quality_rules.rate_documents(frame(spark, [])).collect() == []
