"""The Merkle manifest against a tree built row by row."""

from __future__ import annotations

import hashlib
import zlib

from conftest import DOCUMENTS
from pyspark.sql import functions as F

from pressloom.llm import manifest as module
from pressloom.llm.manifest import manifest, verified

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha("".join(map(enc, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))


def tree(nodes):
    """(root, siblings (left, right) of each leaf, level by level)."""
    paths, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, covers = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for j in range(len(run)):
                for i in held[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha("".join(run)))
            covers.append(sum(held[at : at + 3], []))
        nodes, held = above, covers
    return nodes[0], paths


def brute(rows, changed):
    """Sorted results of `verified` for rows (dicts)."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), leaf_of(r, changed(r))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    root, upper = tree([below[s][0] for s in names])
    out = []
    for s, up in zip(names, upper, strict=True):
        for (known, i, leaf, now), path in zip(sorted(groups[s]), below[s][1], strict=True):
            h = now
            for left, right in path + up:
                h = sha(left + h + right)
            out.append((i if known else None, leaf, below[s][0], root, sha("".join(a + b for a, b in path + up)), h, h == root))
    return sorted(out, key=repr)


def run(df, column=None):
    now = None if column is None else [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), column]
    return sorted(map(tuple, verified(manifest(df, now=now)).collect()), key=repr)


def lost_column():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def lost(r):
    if r["doc_id"] is None or r["text"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2:
        return r["text"]
    return r["text"].replace("\n", "")


def test_all_rows(spark, documents, nothing):
    """Null ids, sources and texts, repeated rows, groups of one row, columns that the operator names itself."""
    more = documents.withColumns({"text": F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("\nx\n"))).otherwise(F.col("text")), "tree": F.lit(1), "digest": F.lit(2), "rank": F.lit(3), "now": F.lit(4)})
    rows = more.collect()
    got = run(more, lost_column())
    assert got == brute(rows, lost) and 0 < sum(r[-1] for r in got) < len(got)
    assert all(r[-1] for r in run(more)) and run(nothing) == []


def test_sizes_and_bands(spark, monkeypatch):
    """Trees of 0 to 30 leaves, and one of 400, in bands of two levels."""
    monkeypatch.setattr(module, "LEVELS", 2)
    monkeypatch.setattr(module, "WIDTH", 9)
    rows = [(1000 * n + i, f"text\n{i}", "en", f"s{n}" if n else None, i) for n in range(31) for i in range(n or 2)] + [(10**6 + i, "t", None, "hot", None) for i in range(400)]
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    dicts = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]
    assert run(df, lost_column()) == brute(dicts, lost)


def test_one_row(spark):
    df = spark.createDataFrame([(7, None, None, None, None)], DOCUMENTS)
    ((i, leaf, subroot, root, proof, folded, good),) = run(df)
    assert (i, leaf, subroot, root) == (7, sha("1:7----"), leaf, leaf) and proof == sha("") and folded == root and good
