from __future__ import annotations

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pressloom.llm import mtree, url_rules
from pressloom.llm.queries import FIXED_RULES


def nearest(rows, queries, k):
    """By the contract: every row but those with the query's own id is a candidate, a repeated one each time."""
    good = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {g for g in good if g[0] in queries}:
        best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(y) == len(x))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_top_k(spark, monkeypatch, spread):
    """Clusters, long and short vectors, many copies of one, ties, other lengths, bad rows."""
    monkeypatch.setattr(mtree, "TREE_ROWS", 150)
    rng = random.Random(6)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(900)]
    rows += [(1000 + i, list(centres[0])) for i in range(400)]
    rows += [(2000 + i, [float(rng.randint(-1, 1)), 0.0]) for i in range(20)] + [(3000, []), (3001, []), (3002, [1.0, 2.0, 3.0])]
    rows += [(4000, None), (4001, [1.0, None] + [0.0] * 6), (4002, [math.nan] + [0.0] * 7), (4003, [math.inf] + [0.0] * 7), (None, list(centres[1])), rows[0], rows[0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string").repartition(4)
    asked = [i for i, _ in rows if i is not None and i % 50 == 0]
    got = mtree.top_k(df, df.where(F.col("vec_id").isin(asked)), k=5)
    assert sorted(map(tuple, got.collect())) == nearest(rows, set(asked), 5)
    monkeypatch.setattr(mtree, "QUERY_ROWS", 7)
    few = asked[:20]
    got = mtree.top_k(df, df.where(F.col("vec_id").isin(few)), k=3)
    assert sorted(map(tuple, got.collect())) == nearest(rows, set(few), 3)


def test_top_k_of_long_vectors(spark, monkeypatch):
    """Finite components of any size as candidates and as queries; scores that floats cannot tell apart."""
    monkeypatch.setattr(mtree, "TREE_ROWS", 150)
    monkeypatch.setattr(mtree, "COMPARED", 5)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += [(400 + i, [rng.choice([-1, 1]) * rng.uniform(4096, 9000), rng.gauss(0, 1), rng.gauss(0, 1), 4095.5]) for i in range(12)]
    rows += [(500 + i, [2.0**40, 2.0**20 + i / 1024, rng.gauss(0, 1), -0.0]) for i in range(12)]  # equal in floats
    rows += [(600, [1e308, 1e300, 0.0, 1.0]), (601, [-1e308, 0.5, 0.0, 0.0]), (602, [3e15, -3e15, 0.25, 0.0]), (603, [5000.0]), (604, [1.0])]
    rows += [(605, [math.inf, 1.0, 1.0, 1.0]), (606, [5000.0, None, 1.0, 1.0]), (607, [math.nan, 9e9, 1.0, 1.0]), rows[300], rows[312]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = [i for i, _ in rows if i % 25 == 0 or i >= 400]
    exact = []
    good = [(i, tuple(math.floor(x) if abs(x) >= 2**60 else x for x in v)) for i, v in rows if all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in good]
    for q, x in {g for g in whole if g[0] in asked}:
        best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in whole if i != q and len(y) == len(x))[:5]
        exact += [(q, n + 1, i, -s if abs(s) < 1 << 63 else None) for n, (s, i) in enumerate(best)]
    key = lambda r: (r[0], r[1])
    got = mtree.top_k(df, df.where(F.col("vec_id").isin(asked)), k=5)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(exact, key=key)
    assert any(s is None for *_, s in exact) and any(i >= 400 for q, _, i, _ in exact if q < 300)
    numbers = [0, 1, -1, 127, 128, 255, 256, -128, -129, -256, 1 << 70, -(1 << 70), (1 << 70) + 1]
    assert sorted(numbers, key=mtree._sortable) == sorted(numbers)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, mtree.top_k(df, df, k=10).collect())) == nearest([(1, [1.0, 2.0]), (2, [0.5, 0.5])], {1, 2}, 10)
    assert mtree.top_k(df.limit(0), df.limit(0)).count() == 0
    assert mtree.top_k(df, df.limit(0)).count() == 0


def test_search_skips_most_of_a_clustered_table():
    """Stored distances spare computations: far fewer vectors are scored than there are."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = np.rint(np.repeat(rng.normal(0, 4000, (64, 16)), 64, axis=0) + rng.normal(0, 40, (4096, 16))).astype(np.int64)
    top = float((x * x).sum(axis=1).max())
    column = pa.array(list(x), pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([16] * 4096), pa.array([0] * 4096), pa.array([0] * 4096), pa.array(range(4096)), column], names=list("abcde"))
    tree = mtree.Tree(mtree._tree([batch], 16, top).to_pylist()[0])
    best = mtree.Best(np.arange(32), x[:32].astype(float), None, 10)
    mtree.search_trees([tree], best, top)
    assert best.scored < 32 * 4096 / 16
    for i in range(32):
        scores = x @ x[i]
        order = [j for j in np.lexsort((np.arange(4096), -scores)) if j != i][:10]
        assert best.found[i].tolist() == order


def test_search_over_several_trees():
    """A query starts in the tree that may hold its nearest vector, wherever it is stored; copies, fillers and one-row trees."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    centres = rng.normal(0, 4000, (24, 12))
    parts = [np.rint(c + rng.normal(0, 60, (n, 12))).astype(np.int64) for c, n in zip(centres, [1, 2, 63, 64, 65, 700] * 4, strict=True)]
    parts[3][:] = parts[3][0]
    x = np.concatenate(parts)
    top = float((x * x).sum(axis=1).max())
    trees, first = [], 0
    for part in parts:
        ids = np.arange(first, first + len(part))
        columns = [pa.array([12] * len(part)), pa.array([0] * len(part)), pa.array([0] * len(part)), pa.array(ids), pa.array(list(part), pa.list_(pa.int64()))]
        trees.append(mtree.Tree(mtree._tree([pa.RecordBatch.from_arrays(columns, names=list("abcde"))], 12, top).to_pylist()[0]))
        first += len(part)
    for tree in trees:  # every radius covers, every stored distance is to the parent's pivot
        for node, pages in enumerate(tree.pages_of):
            assert len(pages)
            for page in pages:
                held = tree.vectors[page][tree.ids[page] >= 0].astype(float)
                far = mtree._distance(mtree._augmented(held, top), tree.node_pivot[node])
                assert far.max() <= tree.node_radius[node] + 1e-6 and mtree._distance(mtree._augmented(held, top), tree.root).max() <= tree.root_radius + 1e-6
    asked = np.arange(0, len(x), 40)
    best = mtree.Best(asked, x[asked].astype(float), None, 7)
    mtree.search_trees(trees, best, top)
    for n, i in enumerate(asked.tolist()):
        scores = x @ x[i]
        assert best.found[n].tolist() == [j for j in np.lexsort((np.arange(len(x)), -scores)).tolist() if j != i][:7]
    assert best.scored < len(asked) * len(x) / 3


URLS = [
    ("http://a.net", "a.net", "", None),
    ("http://A.net/", "a.net", "/", ("block", "net/")),
    ("x://example.NET/en/1?q#f", "example.net", "/en/1", ("allow", "example.net/en/")),
    ("http://b.example.net/en", "b.example.net", "/en", ("block", "net/")),
    ("https://www.example.com/de/a.html#x?y", "www.example.com", "/de/a.html", ("block", "example.com/de/")),
    ("https://badexample.com/de/a", "badexample.com", "/de/a", None),
    ("http://org/fr/", "org", "/fr/", ("allow", "org/fr/")),
    ("http://q.org?x=/fr/", "q.org", "", None),
    ("no scheme", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("a://b://c/d", "b:", "//c/d", None),
]


def test_fixed_rules(spark):
    rows = [(i, u[0], "old") for i, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    none = spark.createDataFrame([], url_rules.RULE_SCHEMA)
    out = url_rules.judge(pages, FIXED_RULES, none).collect()
    assert len(out) == len(rows)
    for r in out:
        _, host, path, rule = URLS[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule and rule[1], rule[0] if rule else "allow")
    assert url_rules.judge(pages.limit(0), FIXED_RULES, none).count() == 0


def test_mined_rules(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        name = rng.choice(["good", "bad", "shop", "news"])
        words = rng.sample(["pills", "win", "cheap", "about", "map", "list"], rng.randint(1, 3))
        rows.append((f"http://{name}.example.org/{'/'.join(words)}/{i}", name == "bad" and "win" in words or "pills" in words and "cheap" in words))
    rows += [(rows[0][0], rows[0][1])] * 5 + [(None, True), (rows[1][0], None)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    rules = url_rules.mine(df, min_support=0.01, min_confidence=0.9, min_bad=1)
    tokens = {r["url"]: set(r["t"]) for r in df.where("url IS NOT NULL").select("url", url_rules.tokens(F.col("url")).alias("t")).collect()}
    labelled = [(tokens[u], bad) for u, bad in rows if u is not None and bad is not None]
    # brute force: all combinations of frequent tokens
    found = {}
    for own, _ in labelled:
        for n in range(1, len(own) + 1):
            for items in combinations(sorted(own), n):
                if items not in found:
                    match = [bad for t, bad in labelled if set(items) <= t]
                    found[items] = (sum(match) / len(match), sum(match) / len(labelled))
    good = {k: c for k, (c, s) in found.items() if c >= 0.9 and s >= 0.01}
    minimal = {k for k, c in good.items() if not any(set(p) < set(k) and good[p] >= c for p in good)}
    got = {tuple(r["items"]): r["confidence"] for r in rules.collect()}
    assert set(got) == minimal and all(abs(good[k] - c) < 1e-9 for k, c in got.items())
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    for r in url_rules.judge(pages, [], rules).collect():
        own = tokens.get(rows[r["page_id"]][0], set())
        assert r["verdict"] == ("block" if any(set(k) <= own for k in minimal) else "allow")
    assert url_rules.mine(df.limit(0)).count() == 0


def test_mined_rules_of_long_urls(spark, monkeypatch):
    """URLs of 13 to 18 frequent tokens against all combinations; the most frequent tokens decide some labels."""
    monkeypatch.setattr(url_rules, "NAMED_ITEMS", 1)
    rng = random.Random(9)
    words = [chr(97 + k) * 2 for k in range(15)]
    rows = []
    for _ in range(150):
        own = rng.sample(words, rng.randint(10, 14))
        bad = ("aa" in own and "bb" not in own) or ("cc" not in own and "dd" in own)
        rows.append((f"http://{rng.choice(['x', 'y'])}.z/{'/'.join(own)}", bad))
    df = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    rules = url_rules.mine(df, min_support=0.05, min_confidence=0.6, min_bad=1)
    tokens = {r["url"]: r["t"] for r in df.select("url", url_rules.tokens(F.col("url")).alias("t")).collect()}
    assert min(map(len, tokens.values())) > 12
    names = sorted({t for own in tokens.values() for t in own})
    bit = {t: 1 << k for k, t in enumerate(names)}
    masks = [(sum(bit[t] for t in tokens[u]), bad) for u, bad in rows]
    # number of URLs and of bad ones that hold each set of tokens
    n, n_bad = [0] * (1 << len(names)), [0] * (1 << len(names))
    for m, bad in masks:
        n[m] += 1
        n_bad[m] += bad
    for k in range(len(names)):
        for s in range(1 << len(names)):
            if not s >> k & 1:
                n[s] += n[s | 1 << k]
                n_bad[s] += n_bad[s | 1 << k]
    good = {s: n_bad[s] / n[s] for s in range(1, len(n)) if n_bad[s] >= 0.05 * len(rows) and n_bad[s] / n[s] >= 0.6}
    best = [0.0] * len(n)  # the greatest confidence of a proper part that is a rule
    for s in range(1, len(n)):
        best[s] = max([0.0, *[max(best[s ^ 1 << k], good.get(s ^ 1 << k, 0.0)) for k in range(len(names)) if s >> k & 1]])
    want = {tuple(t for t in names if s & bit[t]): (c, n_bad[s] / len(rows)) for s, c in good.items() if best[s] < c}
    got = {tuple(r["items"]): (r["confidence"], r["support"]) for r in rules.collect()}
    assert got.keys() == want.keys() and any(len(k) > 1 for k in want)
    assert all(abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k], strict=True))


def test_no_rule_rests_on_a_few_pages(spark):
    """Four bad pages of one host are too few, five are enough; a host with as many good ones has no rule."""
    rows = [(f"http://four.org/a{i}", True) for i in range(4)] + [(f"http://five.org/b{i}", True) for i in range(5)]
    rows += [(f"http://half.org/c{i}", i % 2 == 0) for i in range(40)] + [(f"http://good.org/d{i}", False) for i in range(40)]
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert rules and all(any("five.org" in x or x == "l:five" for x in r["items"]) and r["confidence"] == 1.0 for r in rules)
