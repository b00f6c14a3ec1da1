from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_DIR
from pressloom.llm.queries import ORACLES, QUERIES
from pressloom.llm.tables import stored
from tools.check_queries import compare, connect


def test_every_operator_has_one_query():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    good, note = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert good, note


def test_stages(spark):
    """Each stage's effect on what the one before kept; the shards hold the tokens of the mixed documents."""
    from collections import Counter

    from test_copies import classes, hits, split
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF_DIR), "stage"))
    assert all(k.columns == columns for k in kept[:-1])
    rows = [k.collect() for k in kept]
    language, single, clean, mixed, tokens = rows[1:]
    assert {r["doc_id"] for r in rows[0]} - {r["doc_id"] for r in language} == {r["doc_id"] for r in rows[0] if not any(c.isalpha() for c in r["text"] or "")}
    groups = classes([(r["doc_id"], r["text"]) for r in language], 80)
    assert {r["doc_id"] for r in single} == {k[0] for k, (_, c) in groups.items() if c == k[0]} and len(single) < len(language)
    windows = {}
    for b in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = split(b["text"])
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(b["item_id"]))
    dirty = {r["doc_id"] for r in single if hits(split(r["text"]), windows)[0]}
    assert dirty and {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - dirty
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) <= {r["doc_id"] for r in clean} and max(times.values()) <= 2
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    size = Counter()
    for r in mixed:
        size[r["doc_id"]] += len(library.encode(r["text"], add_special_tokens=False).ids) + 1
    found = Counter()
    for r in tokens:
        found[r["doc_id"]] += r["n_tokens"]
    assert found == size and sorted(r["slot"] for r in tokens) == list(range(len(tokens)))


def test_near_copies_from_similarity_080_on(spark):
    """Pairs around 0.80, 0.82, 0.85 and below: the stage keeps one of each pair at 0.80 or more."""
    from conftest import DOCUMENTS
    from test_copies import classes, shingles

    rows = []
    for n in range(60, 125):
        words = [f"w{n}x{k}" for k in range(n)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join([*words[: n - 8], *[f"v{n}x{k}" for k in range(8)]]))]
    alike = lambda a, b: len(a & b) / len(a | b)
    pairs = [alike(shingles(a[1]), shingles(b[1])) for a, b in zip(rows[::2], rows[1::2], strict=True)]
    assert sum(0.8 <= x < 0.85 for x in pairs) > 5 and min(pairs) < 0.8 and max(pairs) >= 0.85
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], DOCUMENTS)
    got = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, SF_DIR).collect()}
    assert got == {k[0] for k, (_, c) in classes(rows, 80).items() if c == k[0]}
    assert len(got) == len(rows) - sum(x >= 0.8 for x in pairs)


def test_run(spark):
    assert corpus_pipeline.ORACLE_SQL is None and corpus_pipeline.run(spark, SF_DIR).count() > 0
