"""A bitmap of hashes, sent to all tasks, that spares a join the rows which surely have no partner.

Its size is bounded. What it lets through is joined exactly, so it decides the work only: with more hashes than it has room
for it lets more rows through, in the end all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.tables import ready, tasks

#: bits of the bitmap, at least and at most (32 MB); bits per hash where there is room
LEAST_BITS = 1 << 16
MOST_BITS = 1 << 28
BITS_EACH = 16
#: bytes of a piece of the bitmap that a task hands on
PIECE = 1 << 12
#: bytes of a bitmap whose pieces are merged on the driver, as they come from the tasks; those of a larger one are merged before
DIRECT = 1 << 15


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (piece, bits) in order, one of each number."""
    last, held = None, None
    for batch in batches:
        for piece, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(bits, np.uint8)
            if piece != last:
                if last is not None:
                    yield pa.RecordBatch.from_pydict({"piece": pa.array([last], pa.int32()), "bits": [held.tobytes()]})
                last, held = piece, own.copy()
            else:
                held |= own
    if last is not None:
        yield pa.RecordBatch.from_pydict({"piece": pa.array([last], pa.int32()), "bits": [held.tobytes()]})


def maybe_in(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test of 64-bit hashes against those of `hashes` (one bigint column, stored): false only for a hash that is not there."""
    spark = hashes.sparkSession
    ready(spark)
    wanted = min(MOST_BITS, max(LEAST_BITS, BITS_EACH * hashes.count()))
    size = 1 << (wanted - 1).bit_length()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).drop_null().to_numpy().view(np.uint64) & np.uint64(size - 1)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        for piece in np.flatnonzero(bits.reshape(-1, PIECE).any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "bits": [bits[piece * PIECE : (piece + 1) * PIECE].tobytes()]})

    pieces = hashes.mapInArrow(mark, "piece int, bits binary")
    if size // 8 > DIRECT:
        dealt = pieces.repartition(min(tasks(spark), size // 8 // PIECE), "piece").sortWithinPartitions("piece")
        pieces = dealt.mapInArrow(_merged, "piece int, bits binary")
    bitmap = np.zeros(size // 8, np.uint8)
    for row in pieces.collect():
        bitmap[row["piece"] * PIECE : (row["piece"] + 1) * PIECE] |= np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf(T.BooleanType())
    def test(own: pa.Array) -> pa.Array:
        at = own.to_numpy().view(np.uint64) & np.uint64(size - 1)
        return pa.array((shared.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return test
