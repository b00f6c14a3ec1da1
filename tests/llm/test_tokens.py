from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_DIR
from pressloom.llm import pretokens, token_output
from pressloom.llm.tables import only, stored
from pressloom.llm.textbytes import slices
from pressloom.llm.token_counts import token_counts
from pressloom.llm.token_output import permute, read_layout, read_slots, write_training_order

PIECES = ["a", "s", "'", "'s", "'re", "ve", " ", "  ", "\n", "\t", "\r\n", "1", "23", ".", "!!", "é", "ß", "×", "÷", "漢", " ", "\x1c", "\x85", "\xa0"]
PIECES += ["<|endoftext|>", "<|", "\x00", "\x7f", "A"]


def test_pieces_are_the_library_s(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20))) for _ in range(6000)]
    library = Tokenizer.from_file(tokenizer)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bpe = pretokens.load(open(tokenizer).read())
    frequent = [b" a", b"!!", "é".encode()]
    from pressloom.llm.textbytes import Spans

    keys = [int(Spans(np.frombuffer(p, np.uint8)).of(np.array([0]), np.array([len(p)]))[0]) for p in frequent]
    table = pretokens.HashTable(np.array(keys, np.uint64), [bpe.piece(p) for p in frequent])
    encoder = pretokens.Encoder(bpe, table, {})
    for first, stop, data, bounds in slices(pa.array(texts), 4096):
        ids, at = encoder.ids(data, bounds)
        counts = encoder.counts(data, bounds)
        for i in range(first, stop):
            assert ids[at[i - first] : at[i - first + 1]].tolist() == want[i], repr(texts[i])
            assert counts[i - first] == len(want[i])


def test_every_character_is_classed_as_the_library_does(tokenizer):
    """Each stands between letters, after a space and beside itself."""
    chars = [chr(c) for c in (*range(0x3000), *range(0x3000, 0xD800, 7), *range(0xE000, 0x11000, 7), *range(0x1D000, 0x1FB00, 3), 0x10FFFF)]
    texts = [f"a{c}b {c}{c}1{c}" for c in chars]
    library = Tokenizer.from_file(tokenizer)
    encoder = pretokens.Encoder(pretokens.load(open(tokenizer).read()), pretokens.HashTable(np.zeros(0, np.uint64), []), {})
    for first, stop, data, bounds in slices(pa.array(texts)):
        ids, at = encoder.ids(data, bounds)
        for i in range(first, stop):
            assert ids[at[i - first] : at[i - first + 1]].tolist() == library.encode(texts[i], add_special_tokens=False).ids, repr(texts[i])


def test_few_texts_go_to_the_library(tokenizer, monkeypatch):
    """Mixed scripts, marks, curly quotes, wide spaces and emoji are cut here; special strings and separators are not."""
    parts = ["Привет", "мир", "数据", "处理", "データ", " ", "\u3000", "\xa0", "\u2028", "“", "”", "—", "€", "’s", "'s", "e\u0301", "हिन्दी", "١٢", "Ⅷ", "²", "🙂", "👩\u200d🔬", "a", "7", ".", "\n", "  "]
    rng = random.Random(8)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + ["数据处理" * 500, "", "a<|endoftext|>数", "a\x1c数"]
    want = [e.ids for e in Tokenizer.from_file(tokenizer).encode_batch(texts, add_special_tokens=False)]
    bpe = pretokens.Bpe(open(tokenizer).read())
    encoder = pretokens.Encoder(bpe, pretokens.HashTable(np.zeros(0, np.uint64), []), {})
    sent = []
    whole = bpe.texts
    monkeypatch.setattr(bpe, "texts", lambda some: sent.extend(some) or whole(some))
    for first, stop, data, bounds in slices(pa.array(texts), 8192):
        ids, at = encoder.ids(data, bounds)
        counts = encoder.counts(data, bounds)
        for i in range(first, stop):
            assert ids[at[i - first] : at[i - first + 1]].tolist() == want[i], repr(texts[i])
            assert counts[i - first] == len(want[i])
    assert set(sent) == set(texts[-2:])
    assert max(len(ids) for ids in encoder.cache.values()) <= 4 * pretokens.PIECE_BYTES


def test_pieces_that_the_table_lacks_are_encoded_in_one_call(tokenizer, monkeypatch):
    """Each slice's new ones at once; a cached one is not encoded again. Pieces with a zero byte are encoded one by one."""
    rng = random.Random(9)
    texts = ["".join(rng.choice(["zq", "数", "é", "9", "!", " ", "\n", "🙂", "x" * 300]) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    bpe = pretokens.Bpe(open(tokenizer).read())
    library, single, calls = Tokenizer.from_file(tokenizer), [], []
    piece, pieces = bpe.piece, bpe.pieces
    monkeypatch.setattr(bpe, "piece", lambda one: single.append(one) or piece(one))
    monkeypatch.setattr(bpe, "pieces", lambda data, starts, ends: calls.append(len(starts)) or pieces(data, starts, ends))
    encoder = pretokens.Encoder(bpe, pretokens.HashTable(np.zeros(0, np.uint64), []), {})
    for some in (texts, texts[:100], ["a\0b", "", "\0", "zq\0\0 zq", "c"], ["\0"]):
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        for first, stop, data, bounds in slices(pa.array(some)):
            ids, at = encoder.ids(data, bounds)
            assert [ids[at[i] : at[i + 1]].tolist() for i in range(stop - first)] == want[first:stop]
            assert encoder.counts(data, bounds).tolist() == [len(w) for w in want[first:stop]]
        if some is texts:
            assert calls[0] > 100 and not single
    assert any(b"\0" in one for one in single)


def test_counts(spark, documents, nothing, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    out = token_counts(documents, tokenizer, limit=1024)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "node", "key", "epoch", "domain", "score", "n_bytes", "n_tokens", "over_limit"]
    text = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    rows = out.collect()
    assert len(rows) == documents.count()
    for r in rows:
        n = len(library.encode(text[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text[r["doc_id"]].encode()), n, n > 1024)
    assert token_counts(nothing, tokenizer).count() == 0


def test_the_driver_holds_one_table_and_no_encoder(spark, documents, tokenizer, tmp_path, monkeypatch):
    """The tasks encode the frequent pre-tokens; one table of them serves the counts and the sequences."""
    made, frequent = [], pretokens.frequent
    monkeypatch.setattr(pretokens, "frequent", lambda *a: made.append(a) or frequent(*a))
    pretokens.load.cache_clear()
    write_training_order(documents, str(tmp_path / "order"), tokenizer)
    assert len(made) == 1 and pretokens.load.cache_info().currsize == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 1025])
def test_permutation(size):
    slots = permute(np.arange(size), size, key=9)
    assert sorted(slots.tolist()) == list(range(size))
    if size > 60:
        assert slots.tolist() != list(range(size)) and slots.tolist() != permute(np.arange(size), size, key=10).tolist()


def test_shards_round_trip(spark, documents, tokenizer, tmp_path):
    path = str(tmp_path / "order")
    layout = write_training_order(documents, path, tokenizer, sequence_length=64, shard_records=100, key=5)
    assert read_layout(spark, path) == layout
    library = Tokenizer.from_file(tokenizer)
    want = []
    for r in documents.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 50256]
        want += [(r["doc_id"], k, tuple(ids[64 * k : 64 * k + 64])) for k in range(-(-len(ids) // 64))]
    rows = read_slots(spark, path).collect()
    got = [(r["doc_id"], r["chunk"], tuple(np.frombuffer(r["tokens"], "<u2").tolist())) for r in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sorted(r["slot"] for r in rows) == list(range(layout.sequences))
    # a seek finds each record in its shard file, and a part is read alone
    by_slot = {r["slot"]: r for r in rows}
    files = sorted((tmp_path / "order").glob("shard=*/part-*"), key=lambda f: int(f.parent.name.split("=")[1]))
    assert len(files) == -(-layout.sequences // 100)
    for shard, file in enumerate(files):
        records = np.memmap(file, layout.dtype, "r")
        for i, record in enumerate(records):
            row = by_slot[100 * shard + i]
            assert row["byte_offset"] == i * layout.stride and record["n_tokens"] == row["n_tokens"]
            assert record["tokens"][: record["n_tokens"]].tobytes() == bytes(row["tokens"])
            assert (record["tokens"][record["n_tokens"] :] == layout.pad_id).all()
    part = {r["slot"] for r in read_slots(spark, path, 150, 120).collect()}
    assert part == set(range(150, 270))
    # the order depends on the rows and the key, not on how the rows are dealt
    again = str(tmp_path / "again")
    write_training_order(documents.repartition(7), again, tokenizer, sequence_length=64, shard_records=100, key=5)
    assert {(r["slot"], r["doc_id"], r["chunk"]) for r in read_slots(spark, again).collect()} == {(r["slot"], r["doc_id"], r["chunk"]) for r in rows}


def test_places_joined_by_a_shuffle(spark, documents, tokenizer, tmp_path, monkeypatch):
    """The plan of a table whose places are too many to be sent to all tasks writes the same records."""
    sent, joined = str(tmp_path / "sent"), str(tmp_path / "joined")
    write_training_order(documents, sent, tokenizer, sequence_length=64, shard_records=100, key=5)
    monkeypatch.setattr(token_output, "BROADCAST_BYTES", 0)
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_training_order(documents, joined, tokenizer, sequence_length=64, shard_records=100, key=5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
    assert read_layout(spark, sent) == read_layout(spark, joined)
    rows = [read_slots(spark, path).orderBy("slot").collect() for path in (sent, joined)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("names", [("doc_id", "text"), ("_doc_id", "_text")])
def test_texts_are_shuffled_once(spark, documents, names):
    """Single and repeated rows come from one shuffle of the texts, whatever the input's columns are called."""
    doc_id, text = names
    docs = documents.select(F.col("doc_id").alias(doc_id), F.col("text").alias(text), F.lit(1).alias("_text_hash"))
    docs = stored(docs, "docs")
    rows = only(docs, doc_id=F.col(doc_id).cast("bigint"), text_hash=F.xxhash64(text), text=text)
    places = stored(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies")).withColumn("base", F.monotonically_increasing_id()), "places")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, value in conf.items():
        spark.conf.set(c, value)
    try:
        placed = token_output._placed(docs, rows, places)
        both = placed.where("copies = 1").union(placed.where("copies > 1").dropDuplicates(["base"]))
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    assert plan.count("ReusedExchange") == 1
    assert {r["base"] for r in both.collect()} == {r["base"] for r in places.collect()}


def test_no_rows(spark, nothing, tokenizer, tmp_path):
    layout = write_training_order(nothing, str(tmp_path / "none"), tokenizer)
    assert layout.sequences == 0 and read_slots(spark, str(tmp_path / "none")).count() == 0


def test_query_reads_the_whole_table(spark, tokenizer):
    from pressloom.llm.queries import QUERIES

    out = QUERIES["op10_token_counts"](spark, SF_DIR).collect()
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    library = Tokenizer.from_file(tokenizer)
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {k: len(library.encode(v, add_special_tokens=False).ids) for k, v in text.items()}
