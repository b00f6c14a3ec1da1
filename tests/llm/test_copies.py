"""Near duplicates, repeated strings and decontamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from conftest import SF_DIR
from pressloom.llm import suffix_dedup
from pressloom.llm.components import components
from pressloom.llm.decontam import documents_hit, phrase_matches, positional_index, proximity_matches
from pressloom.llm.near_dedup import near_duplicates, without_duplicates
from pressloom.llm.suffix_dedup import remove_repeats
from pressloom.llm.tables import stored

LOW = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(rows, percent=85):
    """component of each (id, text) by comparing all pairs that share a shingle."""
    sets = {(i, t): shingles(t) for i, t in rows}
    parent = {k: k for k in sets}
    top = lambda k: k if parent[k] == k else top(parent[k])
    where = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            where[x].append(k)
    common = Counter((a, b) for own in where.values() for n, b in enumerate(own) for a in own[:n])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[top(b)] = top(a)
    lowest = {}
    for k in sets:
        lowest[top(k)] = min([x for x in (lowest.get(top(k)), k[0]) if x is not None], default=None)
    return {k: (len(s), lowest[top(k)] if s else k[0]) for k, s in sets.items()}


def test_near_duplicates(documents, nothing):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = classes(rows)
    from pyspark.sql import functions as F

    out = near_duplicates(documents)
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").distinct()
    got = out.join(texts, out.doc_id.eqNullSafe(texts.doc_id) & (out.text_hash == texts.text_hash)).select(out.doc_id, "text", "n_shingles", "component_id", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[(r["doc_id"], r["text"])], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len({r["component_id"] for r in got}) < len(rows) - 15
    assert near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {k for k, (_, c) in classes(rows).items() if k[0] == c}
    out = without_duplicates(documents)
    assert out.columns == documents.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_id_with_texts_of_several_groups(spark):
    """Each group keeps a text, also if two groups have the same smallest id; of an id's texts in one group one stays."""
    a, b, c = ([f"{x}{k}" for k in range(200)] for x in "abc")
    near = lambda words, k: " ".join([*words[:k], "changed", *words[k + 1 :]])
    rows = [(7, " ".join(a)), (7, " ".join(b)), (8, near(a, 3)), (9, near(b, 5)), (5, " ".join(c)), (5, near(c, 9)), (6, near(c, 20)), (7, ""), (None, near(a, 50))]
    out = without_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2))
    got = sorted(((r["doc_id"], r["text"][:1]) for r in out.collect()), key=str)
    assert got == [(5, "c"), (7, ""), (7, "a"), (7, "b")]


def test_components(spark):
    rng = random.Random(2)
    edges = [(a, a + 1) for a in range(0, 60)] + [(100, b) for b in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    edges += [(5, 5), (100, 101), (101, 100), (None, 3)]
    parent = {x: x for e in edges if None not in e for x in e}
    top = lambda k: k if parent[k] == k else top(parent[k])
    for a, b in edges:
        if a is not None:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: top(x) for x in linked}


def test_components_of_stars_take_no_step(spark, monkeypatch):
    """Edges that are stars, as most rounds of links find them, are written once and counted; no table is made of a step."""
    from pressloom.llm import components as module

    written = []
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or stored(df, name))
    edges = [(1, b) for b in range(2, 30)] + [(b, 40) for b in range(41, 50)] + [(60, 61), (61, 60)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{x: 1 for x in range(1, 30)}, **{x: 40 for x in range(40, 50)}, 60: 60, 61: 60}
    assert len(written) == 1
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_links_of_few_meetings_take_two_rounds(spark, monkeypatch):
    """A bucket of 60 nodes, most of them unlike all others: after the first pivot all others are compared in one round."""
    from pressloom.llm import near_dedup as module

    written = []
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or stored(df, name))
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(50)]
    texts += [texts[3] + " a", texts[3] + " a b", texts[47] + " a", "z " + texts[49], *[f"{texts[20]} {k}" for k in range(6)]]
    node = [b"%04d" % (i * 37 % 60) for i in range(60)]
    sets = [shingles(t) for t in texts]
    buckets = [(1, n, 56, 56, [1, 2]) for n in node] + [(2, n, 56, 56, [1, 2]) for n in node[::2]]
    buckets = spark.createDataFrame(buckets, "key bigint, node binary, n bigint, shared bigint, keys array<bigint>")
    frame = spark.createDataFrame(list(zip(node, texts, strict=True)), "node binary, text string")
    got = {bytes(r["node"]): bytes(r["label"]) for r in module.links(buckets, frame, module.MinMax()).collect()}
    want = {}
    for i, a in enumerate(sets):
        alike = [j for j, b in enumerate(sets) if 100 * len(a & b) >= 85 * len(a | b)]
        if len(alike) > 1:
            want[node[i]] = min(node[j] for j in alike)
    assert got == want and len(got) == 14
    assert written.count("pairs") == 2 and written.count("state") == 1


def test_narrow_tables_have_few_files(spark):
    from pressloom.llm.tables import narrow

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        table = stored(narrow(spark.range(5000).repartition(64, "id")), "narrow")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(table.inputFiles()) == 8 and table.distinct().count() == 5000


def test_index_makes_arrays_by_byte_for_a_slice_at_a_time(spark, monkeypatch):
    """Words of a block come from slices of a MB, one longer text aside, and equal those of the block as a whole."""
    import pyarrow as pa

    from pressloom.llm import decontam
    from pressloom.llm.textbytes import ALNUM, SLICE_BYTES, words

    texts = [f"Word{k} and {'x' * (k % 7)} \u010d{k} " * 400 for k in range(300)]
    texts[5], texts[6], texts[299] = None, "", "long " * 300_000
    sizes = []
    monkeypatch.setattr(decontam, "words", lambda data, *rest: sizes.append(len(data)) or words(data, *rest))
    column = pa.array(["first", *texts]).slice(1)
    word, bounds = decontam._words(column)
    assert len(sizes) > 3 and sorted(sizes)[-2] <= SLICE_BYTES < max(sizes) == 1_500_000
    data = [(t or "").encode() for t in texts]
    ends = np.cumsum([0, *map(len, data)])
    _, _, want, want_bounds = words(np.frombuffer(b"".join(data), np.uint8), ends, ALNUM)
    assert (word == want).all() and (bounds == want_bounds).all() and bounds.dtype == want_bounds.dtype
    assert [len(x) for x in decontam._words(pa.array([], pa.string()))] == [0, 1]


def repeats(texts, length):
    seen = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans, last = [], False
        for i, g in enumerate([*gone, False]):
            if g and not last:
                spans.append([i, 0])
            if last and not g:
                spans[-1][1] = i
            last = g
        out.append((len(b), tuple(map(tuple, spans)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def check_repeats(df, length):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]
    want = Counter((i, *x) for (i, _), x in zip(rows, repeats([b for _, b in rows], length), strict=True))
    out = remove_repeats(df, length=length).collect()
    got = Counter((r["doc_id"], r["n_bytes"], tuple((s["first"], s["last"]) for s in r["spans"]), bytes(r["kept"])) for r in out)
    assert got == want
    return sum(len(x[2]) for x in want)


def test_repeated_strings(documents, nothing):
    assert check_repeats(documents, 400) > 10
    assert remove_repeats(nothing).count() == 0


def test_repeated_strings_at_every_edge(spark, monkeypatch):
    """Passages just shorter, equal and longer than the length, at the ends, and in large buckets."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (38, 39, 40, 41, 60, 100, 200)]
    texts = [word(rng.randint(0, 60)) + rng.choice(shared) + word(rng.randint(0, 60)) for _ in range(80)]
    texts += [s + word(10) for s in shared] + [word(10) + s for s in shared] + [shared[-1]] * 2 + ["ab" * 60, "z" * 90, shared[3], shared[4] * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check_repeats(df, 40)
    monkeypatch.setattr(suffix_dedup, "BUCKET_PIECES", 3)
    check_repeats(df, 40)


ITEMS = [(1, "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short ITEM here"), (3, None), (4, " ,. "), (5, "short item here"), (None, "nu xi omicron")]


def hits(words, windows):
    hit, items = set(), set()
    for w, own in windows.items():
        for k in range(len(words) - len(w) + 1):
            if tuple(words[k : k + len(w)]) == w:
                hit |= set(range(k, k + len(w)))
                items |= own
    return len(hit), sorted(items)


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def test_decontamination(spark, documents, nothing):
    rng = random.Random(4)
    first = ITEMS[0][1].split()
    planted = [
        " ".join(first),
        "x " + " ".join(first[:9]) + " y",
        "x " + " ".join(first[1:11]).upper() + " y " + " ".join(first[:10]),
        "a short item, here b short item",
        "nu XI omicron nu xi omicron",
        "kappa iota theta eta zeta epsilon delta gamma beta alpha",
    ]
    rows = [(1000 + i, t) for i, t in enumerate(planted)]
    rows += [(2000 + i, " ".join(rng.choice(["short", "item", "here", "now"]) for _ in range(40))) for i in range(10)]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add("" if i is None else str(i))
    want = Counter()
    for r in df.collect():
        w = split(r["text"])
        n, own = hits(w, windows)
        want[(r["doc_id"], len(w), n, tuple(own))] += 1
    index = positional_index(df)
    got = documents_hit(index, phrase_matches(index, items)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == want
    near = {r["doc_id"] for r in proximity_matches(index, items, slop=12).where("array_contains(items, '1')").collect()}
    assert near == {1000, 1002, 1005}
    assert {r["n_hit"] for r in documents_hit(index, phrase_matches(index, items.limit(0))).collect()} == {0}
    none = positional_index(nothing)
    assert documents_hit(none, phrase_matches(none, items)).count() == 0


def test_decontamination_in_rounds(spark, documents, monkeypatch):
    """A test set that does not fit one round gives the same hits."""
    from pressloom.llm import decontam

    items = documents.select(documents.doc_id.alias("item_id"), "text").where("doc_id < 30")
    index = positional_index(documents)
    key = lambda df: sorted((str(r["doc_id"]), r["n_hit"], tuple(r["items"])) for r in documents_hit(index, df).collect())
    once = key(phrase_matches(index, items))
    monkeypatch.setattr(decontam, "QUERY_WORDS", 200)
    assert key(phrase_matches(index, items)) == once


def test_queries_on_the_tables(spark):
    import hashlib

    from pressloom.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = classes(rows)
    got = {(r["doc_id"]): (r["n_shingles"], r["component_id"]) for r in QUERIES["op3_minmax_near_duplicates"](spark, SF_DIR).collect()}
    assert got == {k[0]: v for k, v in want.items()}
    texts = [(t or "").encode() for _, t in rows]
    want = {i: (n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for (i, _), (n, s, k) in zip(rows, repeats(texts, 400), strict=True)}
    out = QUERIES["op6_repeated_strings"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == want


def test_own_columns_survive(spark, documents):
    """Columns with the names that the operators use inside stay as they are."""
    from pyspark.sql import functions as F

    names = ["_id", "_hash", "_open", "__id", "__hash", "__key", "_key", "id", "text_hash", "label"]
    df = documents.select("doc_id", "text", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    out = without_duplicates(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert rows and all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in rows for n in names)
