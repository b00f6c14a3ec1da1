"""Columns of the input that are named like the operators' internal ones stay as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR
from pressloom.llm import url_rules
from pressloom.llm.mixing import mix
from pressloom.llm.near_dedup import without_duplicates
from pressloom.llm.queries import FIXED_RULES
from pressloom.llm.token_counts import token_counts

NAMES = ["id", "hash", "key", "text", "url", "hit", "lang", "domain", "source", "tokens", "epochs", "cut", "copies", "open", "label", "node"]
CLASHING = [f"{mark}{n}" for mark in ("_", "__") for n in NAMES]


def clashing(df):
    return df.withColumns({c: F.concat(F.lit(c), F.col(df.columns[0]).cast("string")) for c in CLASHING})


def kept_values(out, first):
    assert set(CLASHING) <= set(out.columns)
    rows = out.select(first, *CLASHING).collect()
    assert rows
    for r in rows:
        for c in CLASHING:
            assert r[c] == (None if r[first] is None else f"{c}{r[first]}")
    return len(rows)


@pytest.mark.parametrize("step", ["counts", "mix", "near copies", "decontaminate"])
def test_documents(spark, documents, tokenizer, step):
    docs = clashing(documents)
    if step == "counts":
        assert kept_values(token_counts(docs, tokenizer, limit=10), "doc_id") == documents.count()
    elif step == "mix":
        plain = mix(documents, {("web",): 2}, F.lit("web"), share=(1, 2), seed=3)
        assert kept_values(mix(docs, {("web",): 2}, F.lit("web"), share=(1, 2), seed=3), "doc_id") == plain.count()
    elif step == "near copies":
        assert kept_values(without_duplicates(docs), "doc_id") == without_duplicates(documents).count()
    else:
        out = corpus_pipeline.decontaminate(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        assert kept_values(out, "doc_id") == documents.count()


def test_pages(spark):
    rows = [(1, "http://a.net/x"), (2, None), (3, "http://b.org/fr/"), (4, "http://bad.com/p")]
    rules = spark.createDataFrame([(1, ["h:bad.com"], 1.0, 0.1)], url_rules.RULE_SCHEMA)
    out = url_rules.judge(clashing(spark.createDataFrame(rows, "page_id bigint, url string")), FIXED_RULES, rules)
    assert kept_values(out, "page_id") == 4
    assert {r["page_id"]: r["verdict"] for r in out.collect()} == {1: "block", 2: "allow", 3: "allow", 4: "block"}
