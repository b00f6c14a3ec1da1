from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from pressloom.llm import chat
from pressloom.llm.mixing import budgets, mix


def share_out(budget, children):
    """Budgets of siblings {name: (weight, capacity)}: the tightest are filled first, the others share what is left."""
    open_, out = {k: v for k, v in children.items() if v[0] > 0 and v[1] > 0}, dict.fromkeys(children, 0)
    while open_:
        rate = Fraction(budget) / sum(w for w, _ in open_.values())
        full = [k for k, (w, c) in open_.items() if c <= rate * w]
        if not full:
            return out | {k: int(rate * w) for k, (w, _) in open_.items()}
        for k in full:
            out[k] = open_.pop(k)[1]
            budget -= out[k]
    return out


def weight(weights, path):
    return weights.get(path, weights.get(("*",) * (len(path) - 1) + path[-1:], 1))


def tree_budgets(supply, weights, budget, epochs):
    cap = {p: s * epochs if all(weight(weights, p[: i + 1]) > 0 for i in range(3)) else 0 for p, s in supply.items()}
    given = {(): min(budget, sum(cap.values()))}
    for level in range(3):
        children = defaultdict(dict)
        for p, c in cap.items():
            own = p[: level + 1]
            w, old = children[own[:-1]].get(own, (weight(weights, own), 0))
            children[own[:-1]][own] = (w, old + c)
        given = {k: v for parent, own in children.items() for k, v in share_out(given[parent], own).items()}
    return given


WEIGHTS = {("web",): 7, ("*", "fr"): 3, ("web", "de"): 0, ("*", "*", "s1"): 5, ("books", "en", "s2"): 2}


@pytest.mark.parametrize("budget", [0, 10, 1000, 2500, 5000, 100_000])
def test_budgets(spark, budget):
    names = [(d, x, s) for d in ("web", "books", "code") for x in ("en", "fr", "de") for s in ("s1", "s2", "s3")]
    supply = {p: (37 * i * i) % 211 for i, p in enumerate(names)}
    leaves = spark.createDataFrame([(*p, s) for p, s in supply.items()], "domain string, lang string, source string, supply bigint")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in budgets(leaves, WEIGHTS, budget, (1, 1), 3).collect()}
    assert got == tree_budgets(supply, WEIGHTS, budget, 3)


def test_mix(spark, documents, nothing):
    domain = F.when(F.col("source") == "src0", "web").when(F.col("source").isNotNull(), "books")
    out = mix(documents, WEIGHTS, domain, share=(1, 2), max_epochs=3, seed=4)
    assert set(out.columns) == {*documents.columns}
    rows = documents.collect()
    leaf = lambda r: ("web" if r["source"] == "src0" else "books" if r["source"] else "(none)", r["lang"] or "(none)", r["source"] or "(none)")
    size = lambda r: len((r["text"] or "").replace("\t", " ").replace("\n", " ").split())
    supply = Counter()
    for r in rows:
        supply[leaf(r)] += size(r)
    given = tree_budgets(supply, WEIGHTS, sum(supply.values()) // 2, 3)
    want = Counter()
    for p, s in supply.items():
        if s == 0:
            continue
        epochs, rest = divmod(given[p], s)
        units = defaultdict(list)
        for r in rows:
            if leaf(r) == p:
                key = ":".join(["4", str(epochs), *([str(r["doc_id"])] if r["doc_id"] is not None else [])])
                units[hashlib.md5(key.encode()).hexdigest()].append(r)
        before = 0
        for _, unit in sorted(units.items()):
            for r in unit:
                for e in range(epochs + (before < rest)):
                    want[(r["doc_id"], r["text"], e, p[0])] += 1
            before += sum(map(size, unit))
    got = Counter((r["doc_id"], r["text"], r["epoch"], r["domain"]) for r in out.collect())
    assert got == want and len(want) > 10
    assert mix(nothing, WEIGHTS, domain).count() == 0


TALKS = [
    (1, 0, "system", "be <|end|> kind \\ \\| </s>"),
    (1, 2, "assistant", "[INST] ok [/INST] <<SYS>> <|image|>"),
    (1, 1, "user", "a\nb <<|says|> \\<\\|"),
    (2, 0, "assistant", "first"),
    (2, 1, "assistant", None),
    (2, 2, "assistant", "é漢😀"),
    (3, 5, None, None),
    (3, None, "us<|says|>er\n", ""),
    (4, 0, "assistant", "same"),
    (4, 0, "assistant", "same"),
    (None, 1, "assistant", "lost"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TALKS, "conv_id bigint, turn bigint, role string, text string").withColumns({"n": F.lit(1), "spans": F.lit("x"), "formatted": F.lit("y")})
    out = chat.format_chat(df)
    rows = out.withColumns({"turns": chat.read_turns(F.col("formatted")), "learned": chat.read_loss(F.col("formatted"), F.col("loss"))}).collect()
    by_conv = defaultdict(list)
    for c, t, r, x in TALKS:
        by_conv[c].append((t is not None, t or 0, r or "", x or ""))
    assert len(rows) == len(by_conv)
    for row in rows:
        want = sorted(by_conv[row["conv_id"]])
        assert row["n_turns"] == len(want)
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, _, r, x in want]
        assert row["learned"] == "".join(x for _, _, r, x in want if r == "assistant")
        plain = row["formatted"].replace("<|turn|>", "").replace("<|says|>", "").replace("<|end|>", "")
        assert not any(w in plain for w in chat.Template().reserved)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_typed_parts(spark):
    image, audio, paper = ("image", None, "i.png", 7840.0), ("audio", None, "a.ogg", 2.0), ("document", None, "d.pdf", None)
    rows = [
        (1, 0, "user", [("text", "see <|image|> ", None, None), image, ("text", " and ", None, None), audio]),
        (1, 1, "assistant", [("text", "I ", None, None), paper, ("text", None, None, None), ("text", "read", None, None)]),
        (1, 2, "user", None),
        (1, 3, "user", [("video", None, "v", 8.0), ("text", "x", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")
    (row,) = chat.format_chat(df, parts=F.col("parts")).collect()
    assert row["formatted"] == (
        "<|turn|>user<|says|>see <\\|image|> <|image|> and <|audio|><|end|>"
        "<|turn|>assistant<|says|>I <|document|>read<|end|><|turn|>user<|says|><|end|><|turn|>user<|says|><|document|>x<|end|>"
    )
    got = [(a["type"], a["ref"], a["turn"], a["tokens"]) for a in row["attachments"]]
    assert got == [("image", "i.png", 0, 16), ("audio", "a.ogg", 0, 50), ("document", "d.pdf", 1, 1), ("document", "v", 3, 2)]
    assert row["expanded_tokens"] == 69
    assert [row["formatted"][s["first"] : s["last"]] for s in row["loss"]] == ["I ", "", "read"]


@pytest.mark.parametrize("name", ["op2_mixture", "op4_chat_format"])
def test_main_path_is_native(spark, name):
    from pressloom.llm.queries import QUERIES

    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
