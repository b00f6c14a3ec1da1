"""Hard negatives against all scores, and the bounds that spare most of them."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from pressloom.llm import hard_negatives as module
from pressloom.llm.hard_negatives import GROUP, Anchors, Best, Page, _norms, _page, directions, hard_negatives, scan

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank int, score string"


def whole(x):
    return int(math.floor(x * 256)) if abs(x) < 2.0**44 else int(x) * 256


def brute(rows, anchors, positives=5, negatives=3):
    good = lambda r: None not in (r[0], r[1], r[2]) and all(c is not None and math.isfinite(c) for c in r[1])
    rows = [(r[0], [whole(c) for c in r[1]], r[2]) for r in rows if good(r)]
    out = []
    for a in [(r[0], [whole(c) for c in r[1]], r[2]) for r in anchors if good(r)]:
        scored = [(-sum(x * y for x, y in zip(a[1], r[1], strict=True)), r[0], r[2]) for r in rows if r[0] != a[0] and len(r[1]) == len(a[1])]
        for p, i, _ in sorted((s for s in scored if s[2] == a[2]), key=lambda s: s[:2])[:positives]:
            window = sorted(s[:2] for s in scored if s[2] != a[2] and 50 * -p <= 100 * -s[0] <= 95 * -p)[:negatives]
            out += [(a[0], i, k, j, -p, -s) for k, (s, j) in enumerate(window, 1)]
    fits = lambda s: s if -(1 << 63) <= s < 1 << 63 else None
    return sorted((a, i, k, j, fits(p), fits(s)) for a, i, k, j, p, s in out)


def invented(n=2500, dim=12, seed=4):
    """Clusters across labels, copies, ties, one hot label, other lengths, zeros, nulls, and components of any size."""
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    rows = [(i, [h + rng.gauss(0, 0.3) for h in heads[rng.randrange(12)]], 0 if i % 3 == 0 else rng.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[5][1], i % 3) for i in range(60)]
    rows += [(n + 100 + i, [0.0] * dim, i % 2) for i in range(4)] + [(n + 110 + i, [float(i), 1.0], i % 2) for i in range(9)]
    rows += [(n + 130, [1e300] + [0.5] * (dim - 1), 0), (n + 131, [1e300] * dim, 0), (n + 132, [6e299] * dim, 1), (n + 133, [2.0**45] * dim, 0), (n + 134, [2.0**44] * dim, 2), (n + 135, [-1e5] * dim, 1), (n + 136, [1e5] * dim, 1)]
    rows += [(n + 140, None, 1), (n + 141, [None] * dim, 1), (n + 142, [float("nan")] * dim, 1), (n + 143, [float("inf")] * dim, 1), (n + 144, heads[0], None), (None, heads[0], 1), (n + 145, [], 0), (n + 146, [], 1)]
    return rows + [rows[7], rows[50], rows[50]]


def test_all_scores(spark, monkeypatch):
    monkeypatch.setattr(module, "ANCHOR_ROWS", 40)
    monkeypatch.setattr(module, "PART_ROWS", 300)
    rows = invented()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    asked = df.where("vec_id % 50 = 0 OR vec_id >= 2500")
    got = sorted(map(tuple, hard_negatives(df, asked).collect()), key=lambda r: r[:4])
    want = sorted(brute(rows, [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or r[0] >= 2500)]), key=lambda r: r[:4])
    assert len(want) > 500 and got == want


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(df, df).collect() == []
    one = spark.createDataFrame([(0, [1.0], 0, 1, "x")], SCHEMA)
    assert hard_negatives(one, one).collect() == []


def test_bounds_hold_and_spare_work():
    """No score is outside its group's bounds; on clustered rows a small part of the groups is scored."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    heads = rng.normal(size=(20, 32))
    y = np.floor(256 * (heads[np.repeat(np.arange(20), 50)] + 0.15 * rng.normal(size=(1000, 32))))
    references = directions(y[::10])
    column = pa.ListArray.from_arrays(pa.array(np.arange(0, 1001 * 32, 32, dtype=np.int32)), pa.array((y / 256).ravel()))
    batch = _page(pa.array(np.arange(1000)), column, (0, 32, False), {32: references})
    page = Page(batch.to_pylist()[0], len(references))
    a = Anchors(np.arange(40), np.arange(40) * 25, np.zeros(40, np.int64), y[::25] / 256, references)
    a.slot = np.arange(40)
    least, most = page.bounds(a)
    group = np.arange(1000) // GROUP
    score = a.y @ y.T
    assert (least[:, group] <= score).all() and (score <= most[:, group]).all()
    best = Best(np.full(40, -np.inf), np.full(40, np.inf), 5)
    calls = []
    add, best.add = best.add, lambda slots, score, ids: (calls.append(score.size), add(slots, score, ids))
    scan(page, a, best, 1)
    assert sum(calls) < 0.35 * score.size
    score[np.arange(40), a.ids] = -np.inf
    for i in range(40):
        assert best.ids[i].tolist() == np.lexsort((np.arange(1000), -score[i]))[:5].tolist()
    assert np.allclose(_norms(references), 1)
