"""Exact removal of repeated byte strings by bucket-pointer refinement.

Two places are in one bucket at depth d if the next d bytes are equal. A bucket's identifier at depth 100 is the fingerprint
of a q-gram; identifiers at depth 2d follow from those at depth d at the place and d bytes on, so refinement to depth 400
takes two steps (100, 200, 400), each of which sorts on the identifiers that the step before has made. A place alone in its
bucket is not refined further.

To keep the initial buckets small, a place is first filed under one q-gram inside its 400 bytes, the one with the smallest
rank; consecutive places that share it are a run. Equal 400-byte strings have equal q-grams at equal offsets, so they meet
in one bucket. A run whose whole extent is found again is repeated as a whole; only runs at the edge of a repeated passage
are refined place by place. Only they, as pieces of at most 400 + 301 bytes, leave their document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.tables import only, ready, stored, tasks
from pressloom.llm.textbytes import COEFFICIENTS, Spans, binary_rows, mix, ranges, slices

#: pieces of one bucket that a task refines at once; those of a larger bucket are refined as rows, by Spark
BUCKET_PIECES = 4096


def _runs(data: np.ndarray, bounds: np.ndarray, length: int, q: int):
    """Runs of the rows of a slice: (row, first place, last place, place of the q-gram, its identifier, identifier of the extent)."""
    n, window = len(data), length - q + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    spans = Spans(data)
    gram = mix(spans.of_width(q))
    # rank of a q-gram, ties to the leftmost: the high 40 bits of its identifier, then its place (a text of 16 MB gets more)
    shift = np.uint64(max(24, int(n - 1).bit_length()))
    rank = ((gram >> shift) << shift) | np.arange(len(gram), dtype=np.uint64)
    lowest = _sliding_min(rank, window)
    at = (lowest & np.uint64((1 << int(shift)) - 1)).astype(np.int64)
    place = np.arange(len(at), dtype=np.int64)
    row = np.searchsorted(bounds, place, side="right") - 1
    good = place + length <= bounds[row + 1]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]))) & good
    first = np.flatnonzero(new)
    if not len(first):
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    # a run ends before the next one or where its row has no more places
    last = np.minimum(np.concatenate((first[1:] - 1, [n - length])), bounds[row[first] + 1] - length)
    anchor = at[first]
    extent = spans.of(first, last + length) + (anchor - first).astype(np.uint64) * np.uint64(COEFFICIENTS[7])
    return row[first], first, last, anchor, gram[anchor], mix(extent)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each full window: minima to the right and to the left inside blocks of that width."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def _refine(bucket: np.ndarray, *steps) -> np.ndarray:
    """Indices of the places that share their bucket with another after all steps.

    `steps` give, for some places, the identifiers to refine by; a place alone in its bucket drops out after each.
    """
    kept = np.arange(len(bucket))
    for step in (None, *steps):
        by = np.zeros(len(kept), np.uint64) if step is None else step(kept)
        order = np.lexsort((by, bucket))
        b, s = bucket[order], by[order]
        edge = np.concatenate(([True], (b[1:] != b[:-1]) | (s[1:] != s[:-1]), [True]))
        shared = ~(edge[:-1] & edge[1:])
        pointer = np.cumsum(edge[:-1])[shared]
        order = order[shared]
        kept, bucket = kept[order], pointer
    return kept


class _Pieces:
    """Pieces of text (rows of a slice) with the place of their q-gram, as places to refine."""

    def __init__(self, data, bounds, bucket, offset, length: int, q: int) -> None:
        sizes = np.diff(bounds)
        places = np.maximum(sizes - length + 1, 0)
        self.piece = np.repeat(np.arange(len(sizes)), places)
        self.place = ranges(bounds[:-1], places)
        self.local = self.place - bounds[:-1][self.piece]
        # equal strings have their q-gram at the same distance
        distance = (offset[self.piece] - self.local).astype(np.uint64)
        self.bucket = bucket[self.piece] * np.uint64(2 * length) + distance if len(bucket) else bucket
        half = length // 2
        raw = Spans(data).of_width(q)
        place = np.arange(len(raw) - (half - q) if len(raw) >= half - q else 0)
        self.half = mix(raw[place] + mix(raw[place + half - q] + np.uint64(COEFFICIENTS[9])))
        self.step = half

    def by_half(self, kept: np.ndarray) -> np.ndarray:
        return self.half[self.place[kept]]

    def by_rest(self, kept: np.ndarray) -> np.ndarray:
        return self.half[self.place[kept] + self.step]


def _joined(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers in a sorted array."""
    new = np.concatenate(([True], low[1:] != low[:-1] + 1))
    first = np.flatnonzero(new)
    return low[first], low[np.concatenate((first[1:] - 1, [len(low) - 1]))]


SPAN = "array<struct<first:int,last:int>>"


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row: `spans` are the removed runs of bytes [first, last), `kept` the rest.

    A byte goes if it is covered by a string of `length` bytes (a multiple of 4) that also starts anywhere else, in the same
    or another row; overlaps count, all strings are judged on the input. Texts are UTF-8 bytes, null is empty, and no string
    crosses a row. Texts shorter than `length` are whole. Repeated rows are each other's repeats. `kept` may not be valid
    UTF-8, hence binary.
    """
    if length % 4:
        raise ValueError("length must be a multiple of 4")
    ready(documents.sparkSession)
    q = length // 4
    docs = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    # a row is known by its id and the hash of its text: rows that agree in both have the same result
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    runs = stored(_run_table(docs, length, q), "runs")
    marked = _marked(runs)
    found = stored(_with_runs(docs, marked), "found")
    needed = found.where("pieces IS NOT NULL")
    repeated = _refined(needed, length, q)
    per_doc = repeated.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("more"))
    hit = found.where("text IS NOT NULL")
    both = hit.join(per_doc, hit.doc_id.eqNullSafe(per_doc.doc_id) & (hit.text_hash == per_doc.text_hash), "left").select(hit.doc_id, "text", "whole", "more")
    clean = found.where("text IS NULL").select("doc_id", "n_bytes", F.array().cast(SPAN).alias("spans"), "kept")
    return clean.union(_cut(both, length))


def _run_table(docs: DataFrame, length: int, q: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for first, stop, data, bounds in slices(batch.column(2)):
                row, low, high, anchor, gram, extent = _runs(data, bounds, length, q)
                if not len(row):
                    continue
                base = bounds[row]
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": gram.view(np.int64),
                        "extent": extent.view(np.int64),
                        "doc_id": ids.take(pa.array(row + first)),
                        "text_hash": hashes.take(pa.array(row + first)),
                        "low": (low - base).astype(np.int32),
                        "high": (high - base).astype(np.int32),
                        "anchor": (anchor - base).astype(np.int32),
                    }
                )

    return docs.mapInArrow(rows, "gram bigint, extent bigint, doc_id bigint, text_hash bigint, low int, high int, anchor int")


def _marked(runs: DataFrame) -> DataFrame:
    """Runs whose q-gram is shared: `whole` if the extent is found again, `piece` if its text must be refined.

    Of equal runs one stands for all: it is refined against the others of its q-gram, and as a whole run needs no answer.
    """
    own = F.struct("doc_id", "text_hash", "low")
    # most q-grams are found once: their runs end here. What is joined is written first, so that both sides of each join
    # are plain shuffles, of which a hot q-gram's part can be split
    again = stored(runs.groupBy("gram").count().where("count > 1").select("gram"), "shared-grams")
    shared = stored(runs.join(again, "gram"), "shared-runs")
    extents = shared.groupBy("gram", "extent").agg(F.count("*").alias("n"), F.min(own).alias("chosen"))
    grams = shared.groupBy("gram", "extent").count().groupBy("gram").agg(F.count("*").alias("kinds"), F.min("count").alias("least"))
    facts = stored(extents.join(grams, "gram"), "extents")
    rows = shared.join(facts, ["gram", "extent"])
    # a bucket needs refinement if it has several extents, one of them found once
    open_ = (F.col("kinds") > 1) & (F.col("least") == 1)
    return rows.select(
        "doc_id",
        "text_hash",
        "low",
        "high",
        "anchor",
        "gram",
        "kinds",
        (F.col("n") > 1).alias("whole"),
        (open_ & F.col("chosen").eqNullSafe(own)).alias("piece"),
    ).where("whole OR piece")


def _with_runs(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Each document with its shared runs; one without any gets its final result here, and its text goes no further."""
    span = F.struct(F.col("low").alias("first"), F.col("high").alias("last"))
    piece = F.struct("low", "high", "anchor", "gram", "kinds", "whole")
    # copies have the same runs: one list for each id and text
    lists = marked.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("whole"), span)).alias("whole"), F.collect_set(F.when(F.col("piece"), piece)).alias("pieces")
    )
    joined = docs.join(lists, docs.doc_id.eqNullSafe(lists.doc_id) & (docs.text_hash == lists.text_hash), "left")
    shared = F.col("whole").isNotNull()
    return joined.select(
        docs.doc_id,
        docs.text_hash,
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.when(~shared, F.encode("text", "UTF-8")).alias("kept"),
        F.when(shared, F.col("text")).alias("text"),
        "whole",
        F.when(F.size("pieces") > 0, F.col("pieces")).alias("pieces"),
    )


def _refined(found: DataFrame, length: int, q: int) -> DataFrame:
    """(doc_id, text_hash, spans): places [first, last] of the pieces whose strings are found in another piece."""
    # rows with equal id and text have the same pieces: one of them is enough
    one = found.select("doc_id", "text_hash", "text", "pieces").dropDuplicates(["doc_id", "text_hash"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column(2)[row].as_py().encode()
                pieces = batch.column(3)[row].as_py()
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": pa.array([p["gram"] for p in pieces], pa.int64()),
                        "kinds": pa.array([p["kinds"] for p in pieces], pa.int64()),
                        "doc_id": pa.array([batch.column(0)[row].as_py()] * len(pieces), pa.int64()),
                        "text_hash": pa.array([batch.column(1)[row].as_py()] * len(pieces), pa.int64()),
                        "low": pa.array([p["low"] for p in pieces], pa.int32()),
                        "offset": pa.array([p["anchor"] - p["low"] for p in pieces], pa.int32()),
                        "whole": pa.array([p["whole"] for p in pieces], pa.bool_()),
                        "bytes": pa.array([raw[p["low"] : p["high"] + length] for p in pieces], pa.binary()),
                    }
                )

    schema = "gram bigint, kinds bigint, doc_id bigint, text_hash bigint, low int, offset int, whole boolean, bytes binary"
    pieces = stored(one.mapInArrow(cut, schema), "pieces")
    small = pieces.where(F.col("kinds") <= BUCKET_PIECES)
    hot = pieces.where(F.col("kinds") > BUCKET_PIECES)

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_buckets(batches):
            for _, spans in _refine_pieces(table, length, q):
                yield spans

    out = "doc_id bigint, text_hash bigint, spans array<struct<first:int,last:int>>"
    in_tasks = small.repartition(tasks(found.sparkSession), "gram").sortWithinPartitions("gram").mapInArrow(refine, out)
    return in_tasks.union(_refined_as_rows(hot, length, q))


def _whole_buckets(batches: Iterator[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[pa.Table]:
    """Tables of whole buckets (rows come sorted by q-gram), of about `limit` bytes or one bucket."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            # a step of some rows, so that one batch does not become one table
            step = batch.slice(at, 2048)
            at += step.num_rows
            grams = step.column(0).to_numpy()
            edges = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            if size >= limit:
                if grams[0] != held[-1].column(0)[-1].as_py():
                    cut = 0
                elif len(edges):
                    cut = int(edges[0])
                else:
                    cut = None
                if cut is not None:
                    yield pa.Table.from_batches([*held, step.slice(0, cut)])
                    held, size, step = [], 0, step.slice(cut)
            held.append(step)
            size += step.column(7).nbytes
    if held:
        yield pa.Table.from_batches(held)


def _refine_pieces(table: pa.Table, length: int, q: int):
    table = table.combine_chunks()
    raw = table.column("bytes").combine_chunks() if table.num_rows else None
    if raw is None:
        return
    raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
    grams = table.column("gram").to_numpy()
    _, bucket = np.unique(grams, return_inverse=True)
    offset = table.column("offset").to_numpy().astype(np.int64)
    _, _, data, bounds = next(iter(slices(raw, 1 << 40)))
    places = _Pieces(data, bounds, bucket.astype(np.uint64), offset, length, q)
    kept = _refine(places.bucket, places.by_half, places.by_rest)
    whole = table.column("whole").to_numpy()
    kept = kept[~whole[places.piece[kept]]]
    kept.sort()
    low = table.column("low").to_numpy()
    owner = places.piece[kept]
    which, at = np.unique(owner, return_index=True)
    spans, at = [], [*at.tolist(), len(owner)]
    for p, a, b in zip(which.tolist(), at, at[1:]):
        first, last = _joined(places.local[kept[a:b]] + low[p])
        spans.append([{"first": int(x), "last": int(y)} for x, y in zip(first, last, strict=True)])
    take = pa.array(which, pa.int64())
    yield table, pa.RecordBatch.from_pydict(
        {
            "doc_id": table.column("doc_id").combine_chunks().take(take),
            "text_hash": table.column("text_hash").combine_chunks().take(take),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        }
    )


def _refined_as_rows(pieces: DataFrame, length: int, q: int) -> DataFrame:
    """The same for buckets with very many pieces: a row for each place, counted by identifier with map-side sums."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                step = batch.slice(at, 2048)
                gram, offset = step.column(0).to_numpy(), step.column(5).to_numpy().astype(np.int64)
                low, row0 = step.column(4).to_numpy(), 0
                for first, stop, data, bounds in slices(step.column(7)):
                    own = _Pieces(data, bounds, np.arange(stop - first, dtype=np.uint64), offset[first:stop], length, q)
                    all_ = np.arange(len(own.place))
                    row = pa.array(own.piece + first + row0)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "gram": gram[first:stop][own.piece],
                            "distance": (offset[first:stop][own.piece] - own.local).astype(np.int32),
                            "half": own.by_half(all_).view(np.int64),
                            "rest": own.by_rest(all_).view(np.int64),
                            "doc_id": step.column(2).take(row),
                            "text_hash": step.column(3).take(row),
                            "whole": step.column(6).take(row),
                            "place": (own.local + low[first:stop][own.piece]).astype(np.int32),
                        }
                    )

    key = ["gram", "distance", "half", "rest"]
    rows = pieces.mapInArrow(
        places, "gram bigint, distance int, half bigint, rest bigint, doc_id bigint, text_hash bigint, whole boolean, place int"
    )
    shared = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    hit = rows.where("NOT whole").join(shared, key)
    return hit.select("doc_id", "text_hash", F.array(F.struct(F.col("place").alias("first"), F.col("place").alias("last"))).alias("spans"))


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of rows (doc_id, text, whole, more): lists of places [first, last]."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, bounds in slices(batch.column(1)):
                part = batch.slice(first, stop - first)
                spans, kept = [], []
                for i, places in enumerate(zip(part.column(2), part.column(3), strict=True)):
                    raw = data[bounds[i] : bounds[i + 1]]
                    covered = np.zeros(len(raw) + 1, np.int64)
                    for values in places:
                        if values.is_valid and len(values):
                            low, high = values.values.field(0).to_numpy(), values.values.field(1).to_numpy()
                            np.add.at(covered, low, 1)
                            np.add.at(covered, high + length, -1)
                    gone = np.cumsum(covered)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
                    spans.append([{"first": int(a), "last": int(b)} for a, b in edge.reshape(-1, 2)])
                    kept.append(raw[~gone].tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column(0),
                        "n_bytes": np.diff(bounds),
                        "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                        "kept": pa.array(kept, pa.binary()),
                    }
                )

    return rows.mapInArrow(cut, f"doc_id bigint, n_bytes bigint, spans {SPAN}, kept binary")
