"""The corpus pipeline against a plain run of its stages, with the awkward rows."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from vacancylake.llm import bpe, decontaminate, toxicity

from .test_operators import brute_components, order, plain_distance, prose

BAD = ["scumbag", "moronic", "filthyrat"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fixture():
    """Documents, labels and items; and which ids are toxic."""
    r = random.Random(6)
    items = [(k, prose(25, 700 + k)) for k in range(3)] + [(3, None)]
    texts, toxic = {}, set()
    for k in range(160):
        sentences = [prose(9, 5000 + 20 * k + j) for j in range(r.randint(3, 8))]
        if k % 4 == 0:
            sentences[r.randrange(len(sentences))] += f" {r.choice(BAD)} you"
            toxic.add(k)
        texts[k] = ". ".join(sentences) + "."
    for k in range(3):  # near copies, of the later of which one is toxic
        words = texts[41 + 2 * k].split()
        for j in range(4):
            texts[200 + 4 * k + j] = " ".join([*words[:j], "edit", *words[j + 1 :]])
    for k in range(6):  # leaks, one of them edited and one a copy of another
        leak = items[k % 3][1]
        leak = leak[:40] + "q" + leak[41:] if k == 2 else leak
        texts[300 + k] = prose(30, 800 + min(k, 4)) + "\n" + leak.upper() + ". " + prose(10, 900)
    texts |= {400: None, 401: "", 402: "  \n ", 403: prose(4000, 1), 404: "two words", 405: "two words"}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    rows += [(403, texts[403], "en", "s", 5), (None, prose(50, 2), None, None, None)]
    return rows, [(i, 1, int(i in toxic)) for i in texts if i is not None and i < 160], items, toxic


def plain_run(rows, items, rejected, library):
    rows = [r for r in rows if r[0] not in rejected]
    found = brute_components([r[:2] for r in rows])
    kept, met = [], set()
    for row, (doc_id, size, component) in sorted(zip(rows, found), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][4] or 0)):
        if size and component is not None and component in met:
            continue
        met |= {component} if size else set()
        kept.append(row)
    flat = lambda t: b" ".join(re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode()))
    patterns = [flat(t) for _, t in items if t]
    clean = [r for r in kept if len(r[1] or "") > 5000 or not any(
        plain_distance(p, flat(r[1])) <= int(decontaminate.RATE * len(p)) for p in patterns)]
    digest = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for doc_id, text, *_ in clean:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest((text or "").encode())))
    return out


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, labels, items):
        for name, data, schema in (("documents", rows, DOCS), ("labels", labels, "doc_id bigint, quality int, toxic int"),
                                   ("benchmark", items, "item_id bigint, text string")):
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def test_pipeline_equals_a_plain_run(spark, folder):
    from tokenizers import Tokenizer

    rows, labels, items, toxic = fixture()
    path = folder(rows, labels, items)
    got = corpus_pipeline.run(spark, path).collect()
    # fitted scores have no plain version: the verdicts are taken over, and held against what was planted
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    judged = toxicity.classify(spark.createDataFrame(rows, DOCS), table).collect()
    rejected = {r.doc_id for r in judged if r.predicted == 1}
    assert toxic <= rejected and len(rejected - toxic) <= 4
    want = plain_run(rows, items, rejected, Tokenizer.from_file(bpe.vocabulary_path()))
    assert order(tuple(r)[:4] for r in got) == order(want)
    ids = {r.doc_id for r in got}
    assert not ids & toxic and not ids & set(range(300, 306)) and {400, 401, 402, 404, None} <= ids and 405 not in ids


def test_every_stage_keeps_the_columns_and_takes_empty_tables(spark, folder):
    rows, labels, items, _ = fixture()
    path = folder([], labels, items)
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0
        assert name == "bpe" or out.columns == docs.columns
    docs = spark.createDataFrame(rows[-8:], DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == DOCS.replace(",", "").split()[::2]
    assert corpus_pipeline.run(spark, path).collect() == []
