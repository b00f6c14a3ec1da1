from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_DIR
from pressloom.llm import langid
from pressloom.llm.textbytes import slices

VOWELS = {"en": "the and ing tion er of".split(), "fr": "eau ment le é qui eux".split(), "de": "sch ung der ich ü keit".split()}


def written(rng, lang, n):
    return " ".join("".join(rng.choice(VOWELS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def network():
    rng = random.Random(1)
    langs = [rng.choice(list(VOWELS)) for _ in range(150)]
    return langid.fit([written(rng, x, 40).encode() for x in langs], langs, hidden=8, steps=60, batch=64)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    net = langid.Network.start(["a", "b", "c"], 4, 1)
    net.values = {k: v.astype(np.float64) for k, v in net.values.items()}
    codes, label = rng.integers(0, 257, (9, 5)), rng.integers(0, 3, 5)
    _, grads = net.gradient(codes, label)
    for name, value in net.values.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if name.endswith("_x"):
                at = (codes[rng.integers(0, 9), rng.integers(0, 5)], at[1])
            kept, losses = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = kept + step
                losses.append(net.gradient(codes, label)[0])
            value[at] = kept
            assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-5


def test_scores_are_those_of_one_step_at_a_time(network):
    """The recurrence written out for one window."""
    text = np.frombuffer("the sching eau".encode(), np.uint8)
    v = network.values
    total = np.zeros((len(text), len(network.languages)))
    for way, order in (("forward", range(len(text))), ("backward", range(len(text) - 1, -1, -1))):
        h = np.zeros(8)
        for t in order:
            x = v[f"{way}_x"][text[t]] + h @ v[f"{way}_u"]
            x = x / (1 + np.abs(x))
            h = h + (1 + x[:8]) / 2 * (x[8:] - h)
            total[t] += h @ v[f"{way}_o"]
    want = np.exp(total + v["bias"])
    want /= want.sum(axis=1, keepdims=True)
    scores = network.scores(text[:, None].astype(np.int16))[:, 0]
    got = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    assert np.allclose(got, want, atol=1e-5)


def test_whole_texts_are_read(network):
    """A long text is the mean of its windows; what stands at its end counts."""
    rng = random.Random(3)
    text = written(rng, "en", 30) + " " + written(rng, "de", 3000)
    ((_, _, data, bounds),) = slices(pa.array([text]))
    assert network.languages[langid.pooled(network, data, bounds)[0].argmax()] == "de"
    codes, row = langid.windows(data, bounds)
    assert (codes != langid.PAD).sum() == len(text.encode()) and len(row) == -(-len(text.encode()) // langid.WINDOW)


def test_identify(spark, documents, nothing, network):
    rng = random.Random(9)
    rows = [(i, written(rng, lang, 60), lang) for i, lang in enumerate(["en", "fr", "de"] * 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = langid.identify(df, network).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 29
    out = langid.identify(documents, network, keep_text=True)
    assert set(out.columns) == {*documents.columns, "lang_pred"}
    found = out.collect()
    assert len(found) == documents.count()
    for r in found:
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != langid.UNKNOWN) == letter and 0 <= r["score"] <= 1 and (r["score"] > 0) == letter
    assert langid.identify(nothing, network).count() == 0


def test_no_labels(spark, documents, nothing):
    net = langid.train(nothing)
    assert net.languages == []
    assert {r["lang_pred"] for r in langid.identify(documents, net).collect()} == {langid.UNKNOWN}


def test_training_rows_are_bounded_and_not_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    free = {r["text"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    rows = langid.training_rows(docs, 10, 3, "text", "lang", "doc_id")
    assert all(bytes(r["text"]).decode() in free for r in rows)
    counts = {}
    for r in rows:
        counts[r["lang"]] = counts.get(r["lang"], 0) + 1
    assert len(counts) == 3 and max(counts.values()) <= 10


def test_query_on_held_out_rows(spark):
    from pressloom.llm.queries import QUERIES

    out = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(out) == len(docs)
    assert all(out[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if out[d["doc_id"]]["held_out"] and d["lang"]]
    assert sum(out[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) >= 0.9 * len(held)
