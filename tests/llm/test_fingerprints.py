"""Fingerprints by a walk step by step, the order of documents, and the search against all pairs."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest import DOCUMENTS, sentence

from pressloom.llm import fingerprints as module
from pressloom.llm.fingerprints import SYMBOL, Walks, _moves, _output, _weights, codes, fingerprint, fingerprints, likeness, sampled, similar_documents, symbols


def slow(text):
    """Symbols of a text's walk, one step at a time."""
    own = [*codes(np.array([ord(c) for c in text], np.uint32)).tolist(), 0] if text else [0]
    wanted, out, i, step, octave = [], [], 0, 0, 0
    while own[i]:
        if not wanted:
            wanted, octave = sampled(octave).tolist(), octave + 1
        if step == wanted[0]:
            out.append(int(SYMBOL[own[i]]))
            wanted = wanted[1:]
        i += int(_moves()[step % module.STEPS][own[i]])
        step += 1
    return out


@pytest.mark.parametrize("n", [1, 60, 200])
def test_walks(n):
    rng = random.Random(n)
    texts = ["", "a", "ab", "é中\U0001f600\x00x", "x" * 9000, *(sentence(rng, rng.randint(1, 60)) for _ in range(n)), sentence(rng, 2000)]
    assert [s.tolist() for s in symbols(texts)] == [slow(t) for t in texts]
    assert symbols([]) == [] and all(SYMBOL[1:] > 0)


def test_sampled_steps():
    for k in range(20):
        steps = sampled(k)
        assert len(set(steps.tolist())) == min(1 << k, 32) and steps.min() >= (1 << k) - 1 and steps.max() < (2 << k) - 1
    assert _weights(63).sum() == 63 and _weights(95)[-1] == 2


def test_likeness_follows_edits():
    rng = random.Random(8)
    base = sentence(rng, 400)
    at = lambda k: "".join(("#" if rng.random() < k else "") + c for c in base)
    own, few, many, other = symbols([base, at(0.002), at(0.05), sentence(rng, 400)])
    assert likeness(own, own) == 1.0 > likeness(own, few) > 0.5 > likeness(own, many) > 0 and likeness(own, other) < 0.3
    assert likeness(own[:0], own[:0]) == 1.0 and likeness(own, own[:0]) == 0.0


def brute(rows):
    # equal ids go by the hash of the text; rows with equal ids have equal texts here
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = symbols([text, changed, following])
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(a), fingerprint(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def test_all_documents(spark, documents, nothing):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = sorted(map(tuple, fingerprints(documents).collect()), key=repr)
    assert got == brute(rows) and all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)
    by_text = {}
    for i, n, _, own, *_ in got:
        by_text.setdefault((i, n), set()).add(own)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints(nothing).collect() == []
    one = spark.createDataFrame([(3, "abcd", None, None, None)], DOCUMENTS)
    assert [(r["edited_sha256"], r["near_next"]) for r in fingerprints(one).collect()] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]


def test_held_in_pieces(monkeypatch):
    """A partition that is worked off in several pieces gives the same rows."""
    import pyarrow as pa

    rng = random.Random(3)
    texts = [sentence(rng, rng.randint(1, 30)) for _ in range(90)]
    batches = lambda: iter([pa.RecordBatch.from_pydict({"part": pa.array([4] * 30, pa.int32()), "doc_id": list(range(k, k + 30)), "text": texts[k : k + 30]}) for k in (0, 30, 60)])
    rows = lambda: sorted((r["kind"], r["doc_id"], r["fingerprint"], r["edited_fingerprint"], r["near_next"]) for b in module._in_order(batches()) for r in b.to_pylist() if r["kind"] == module.DONE)
    whole = rows()
    monkeypatch.setattr(module, "HELD_CHARS", 500)
    assert rows() == whole and len(whole) == 89


def test_search_against_all_pairs(spark, nothing):
    """Copies, texts with a few changes, a chain of them, unrelated texts, empty and null ones."""
    rng = random.Random(6)
    rows = []
    for n in (8, 40, 150, 600):
        for _ in range(6):
            base = sentence(rng, n)
            rows += [base, base] + [base[:k] + "#" + base[k:] for k in (len(base) // 2, 9 * len(base) // 10, len(base) // 20)]
    rows += ["", None, "", "x", "x", "y"] + [sentence(rng, 50) for _ in range(20)]
    rows = list(enumerate(rows))
    p = Walks(percent=80)
    texts = sorted({t for _, t in rows if t})
    outputs = {}
    for t in texts:
        outputs[t] = np.frombuffer(_output(bytes([*codes(np.array([ord(c) for c in t], np.uint32)).tolist(), 0])), np.uint8)
    parent = {t: t for t in texts}
    top = lambda t: t if parent[t] == t else top(parent[t])
    linked = 0
    for k, a in enumerate(texts):
        for b in texts[:k]:
            if p.alike(outputs[a], outputs[b]):
                parent[top(a)] = top(b)
                linked += 1
    lowest = {}
    for i, t in rows:
        if t:
            lowest.setdefault(top(t), i)
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCUMENTS).repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in similar_documents(df).collect()}
    assert linked > 40 and got == {i: lowest[top(t)] if t else i for i, t in rows}
    assert similar_documents(nothing).collect() == []
