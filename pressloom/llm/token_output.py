"""Token ids in training order: a keyed permutation gives every sequence a slot, range partitions write binary shards.

Layout below the output folder: `shard=<k>/part-*.txt`, one file a shard, holds records of one fixed stride, in slot
order, `shard_records` of them (the last shard may have fewer). A record is

    doc_id int64 | chunk int32 | n_tokens int32 | has_doc_id uint8 | tokens uint16 or uint32 x sequence_length | newline

in little-endian order; unused token places hold the pad id. Record `slot` starts at byte `(slot % shard_records) * stride`
of shard `slot // shard_records`, so that a run can go on from any slot by a seek.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm import pretokens
from pressloom.llm.tables import only, ready, stored
from pressloom.llm.textbytes import binary_rows, mix, ranges, slices
from pressloom.llm.token_counts import shared_table, token_counts
from pressloom.operators.duplicates import free_name

#: documents per bucket of the base order; a constant of the layout, so that slots do not depend on the cluster
BUCKET_ROWS = 16_384
#: most that is broadcast of the documents' places, and an upper bound of one of them in memory
BROADCAST_BYTES = 64 << 20
PLACE_BYTES = 64


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know of the shards."""

    sequences: int
    sequence_length: int
    shard_records: int
    token_bytes: int
    end_id: int
    pad_id: int
    key: int

    @property
    def stride(self) -> int:
        return self.dtype.itemsize

    @property
    def dtype(self) -> np.dtype:
        token = "<u2" if self.token_bytes == 2 else "<u4"
        return np.dtype([("doc_id", "<i8"), ("chunk", "<i4"), ("n_tokens", "<i4"), ("has_doc_id", "u1"), ("tokens", token, (self.sequence_length,)), ("newline", "u1")])


def permute(index: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """The slots of some indices under a permutation of [0, size) that the key chooses.

    An unbalanced Feistel network over the fewest bits that hold `size`; a result outside is put through it again
    (cycle-walking), less than twice on average.
    """
    if size <= 1:
        return np.zeros(len(index), np.int64)
    bits = max(2, (size - 1).bit_length())
    keys = mix(np.arange(rounds, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & ((1 << 64) - 1)))
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left_bits, right_bits = bits // 2, bits - bits // 2
        for k in keys:
            left, right = x >> np.uint64(right_bits), x & np.uint64((1 << right_bits) - 1)
            mask = np.uint64((1 << left_bits) - 1)
            left = left ^ (mix(right + k) & mask)
            x = (right << np.uint64(left_bits)) | left
            left_bits, right_bits = right_bits, left_bits
        out[walking] = x
        walking = walking[x >= size]
    return out.astype(np.int64)


def _places(rows: DataFrame, tokenizer: str, length: int, shared: Broadcast) -> DataFrame:
    """Stored (doc_id, text_hash, copies, sequences, base): where a document's sequences begin in the base order.

    The order is by a hash bucket of the id, then id, then text hash, so it does not depend on how the rows are dealt. Only
    these narrow rows are shuffled.
    """
    spark = rows.sparkSession
    sizes = token_counts(rows, tokenizer, shared=shared).withColumn("sequences", F.ceil((F.col("n_tokens") + 1) / length))
    buckets = max(1, math.ceil(rows.count() / BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)).alias("bucket")
    keyed = sizes.groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies"), F.max("sequences").alias("sequences"))
    keyed = stored(keyed.select("*", bucket), "sizes")
    own = F.col("copies") * F.col("sequences")
    per_bucket = keyed.groupBy("bucket").agg(F.sum(own).alias("n")).orderBy("bucket").collect()
    starts = np.cumsum([0, *[r["n"] for r in per_bucket]]).tolist()
    start_rows = [(r["bucket"], s) for r, s in zip(per_bucket, starts, strict=False)]
    start = spark.createDataFrame(start_rows, "bucket bigint, start bigint")
    before = Window.partitionBy("bucket").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    base = (F.col("start") + F.coalesce(F.sum(own).over(before), F.lit(0))).alias("base")
    return stored(keyed.join(start, "bucket").select("doc_id", "text_hash", "copies", "sequences", base), "places")


def _placed(documents: DataFrame, rows: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, base, copies, text) of all rows.

    It is read twice, for single and for repeated rows. Under names that the input has not, the optimizer keeps the columns'
    aliases in both readings; else it drops them in one, the plans differ, and the texts are shuffled twice.
    """
    own = {c: free_name(documents, f"_{c}") for c in ("doc_id", "text_hash", "text")}
    rows = rows.select(*[F.col(c).alias(name) for c, name in own.items()])
    same = rows[own["doc_id"]].eqNullSafe(places["doc_id"]) & rows[own["text_hash"]].eqNullSafe(places["text_hash"])
    return rows.join(places, same).select(F.col(own["doc_id"]).alias("doc_id"), "base", "copies", F.col(own["text"]).alias("text"))


def write_training_order(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence_length: int = 512,
    shard_records: int = 4096,
    key: int = 0,
) -> Layout:
    """Cut every document's token ids (and an end id) into sequences and write them in the order of a keyed permutation.

    Token counts give each document its place in a base order; a second pass makes the sequences and shuffles each once, to
    its shard. A shard is what a reader holds at once, by default 4 MB. Shard k is one task's range of slots, so tasks have equal work whatever the sources are. Slots depend on the
    rows and the key only. A null or empty text is one sequence with the end id alone. A null id is 0 with `has_doc_id` 0.
    Repeated rows are repeated sequences. An empty table gives an empty folder. Other columns play no part.
    """
    spark = documents.sparkSession
    ready(spark)
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary, special_ids = pretokens.sizes(file.read())
    end_id = pad_id = max(special_ids, default=vocabulary)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text_hash=F.xxhash64(F.col(f"`{text}`")), text=text)
    shared = shared_table(rows, tokenizer)
    places = _places(rows, tokenizer, sequence_length, shared)
    total = places.agg(F.coalesce(F.sum(F.col("copies") * F.col("sequences")), F.lit(0)), F.count("*")).first()
    layout = Layout(int(total[0]), sequence_length, shard_records, width, end_id, pad_id, key)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.worker_encoder(*shared.value)
        dtype = layout.dtype
        for batch in batches:
            ids, base, copies = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for first, stop, data, bounds in slices(batch.column(3)):
                tokens, token_bounds = encoder.ids(data, bounds)
                # a document's tokens and its end id, cut every `sequence_length`
                sizes = np.diff(token_bounds) + 1
                chunks = -(-sizes // sequence_length)
                row = np.repeat(np.arange(len(sizes)), chunks)
                chunk = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                record = np.zeros(len(row), dtype)
                record["doc_id"], record["has_doc_id"] = ids[first:stop][row], known[first:stop][row]
                record["chunk"], record["newline"] = chunk, 10
                record["n_tokens"] = np.minimum(sizes[row] - chunk * sequence_length, sequence_length)
                places_of = chunks * sequence_length
                flat = np.full(int(places_of.sum()), pad_id, dtype["tokens"].base)
                starts = np.cumsum(places_of) - places_of
                flat[ranges(starts, sizes - 1)] = tokens
                flat[starts + sizes - 1] = end_id
                record["tokens"] = flat.reshape(len(row), sequence_length)
                # repeated rows come as one, with their number
                times = copies[first:stop][row]
                again = np.repeat(np.arange(len(row)), times)
                copy = ranges(np.zeros(len(row), np.int64), times)
                slot = permute(base[first:stop][row][again] + copy * chunks[row][again] + chunk[again], layout.sequences, key)
                for at in range(0, len(again), 1024):
                    some, place = again[at : at + 1024], slot[at : at + 1024]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": (place // shard_records).astype(np.int32),
                            "slot": place,
                            "record": binary_rows(record[some].view(np.uint8), np.arange(len(some) + 1) * dtype.itemsize),
                        }
                    )

    # the places are sent to all tasks only up to a size that is known from their number; beyond it the join is a shuffle
    sent = F.broadcast(places) if total[1] * PLACE_BYTES <= BROADCAST_BYTES else places
    placed = _placed(documents, rows, sent)
    single = placed.where("copies = 1")
    repeated = placed.where("copies > 1").dropDuplicates(["base"])
    shards = max(1, math.ceil(layout.sequences / shard_records))
    (
        single.union(repeated)
        .mapInArrow(sequences, "shard int, slot bigint, record binary")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        # the record's last byte is the line end that the text sink writes itself
        .select("shard", F.substring("record", 1, layout.stride - 1).cast("string").alias("value"))
        .write.partitionBy("shard")
        .option("lineSep", "\n")
        .option("compression", "none")
        .text(path)
    )
    spark.createDataFrame([asdict(layout)]).coalesce(1).write.json(f"{path}/_layout")
    return layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**spark.read.json(f"{path}/_layout").first().asDict())


def read_slots(spark: SparkSession, path: str, first: int = 0, count: int | None = None) -> DataFrame:
    """Records of the slots [first, first + count): slot, shard, byte_offset, doc_id, chunk, n_tokens, tokens (binary).

    Only the shards that hold these slots are read. The columns come from the written bytes.
    """
    ready(spark)
    layout = read_layout(spark, path)
    stop = layout.sequences if count is None else min(layout.sequences, first + count)
    schema = "slot bigint, shard int, byte_offset bigint, doc_id bigint, chunk int, n_tokens int, tokens binary"
    if stop <= first:
        return spark.createDataFrame([], schema)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("basePath", path)
        .load(f"{path}/shard=*")
        .where(F.col("shard").between(first // layout.shard_records, (stop - 1) // layout.shard_records))
        .select("shard", "content")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = np.frombuffer(content.as_buffer(), layout.dtype)
                slot = shard * layout.shard_records + np.arange(len(rows), dtype=np.int64)
                keep = (slot >= first) & (slot < stop)
                for at in range(0, len(rows), 1024):
                    r, s = rows[at : at + 1024][keep[at : at + 1024]], slot[at : at + 1024][keep[at : at + 1024]]
                    if not len(r):
                        continue
                    size = r["n_tokens"].astype(np.int64) * layout.token_bytes
                    used = np.arange(layout.sequence_length) < r["n_tokens"][:, None]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "slot": s,
                            "shard": np.full(len(r), shard, np.int32),
                            "byte_offset": (s % layout.shard_records) * layout.stride,
                            "doc_id": pa.array(r["doc_id"].copy(), mask=r["has_doc_id"] == 0),
                            "chunk": r["chunk"].copy(),
                            "n_tokens": r["n_tokens"].copy(),
                            "tokens": binary_rows(r["tokens"][used].view(np.uint8), np.concatenate(([0], np.cumsum(size)))),
                        }
                    )

    return files.mapInArrow(records, schema)
