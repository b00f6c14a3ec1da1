"""Structured Streaming forms of collection and extraction. Files take the place of queues."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pressloom.operators.duplicates import free_name, lacks_key
from pressloom.plans.extract import extract
from pressloom.sources.index import INDEX_LINE, flatten_index

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_index_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Index lines as they arrive; a glob such as `queue/*` reads the folders of all domains."""
    return flatten_index(read_stream(spark, path, INDEX_LINE, "json", files_per_trigger))


def read_stream(
    spark: SparkSession, path: str, schema: StructType, form: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(form).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def drop_duplicates(
    stream: DataFrame, keys: Sequence[str], remember: str | None = None, at_most: int | None = None, buckets: int = 64
) -> DataFrame:
    """One row per key, the first to arrive (the batch form keeps the earliest crawl). Rows with a null key all pass.

    Captures of an archive come in no order of crawl time, so no row is ever late. All keys are remembered; use the
    RocksDB state store, which keeps them on disk. With `remember` (as "90 days") a key is forgotten when it has not
    arrived for that long, and a later copy passes again; that bounds the state, and still loses nothing. The
    checkpoint carries state over restarts. The source is read once; a row without a key takes a place in the state.

    With `at_most`, no more keys than that are remembered, as a broker's cache of message ids does: see `_bounded`.
    """
    if at_most is not None:
        return _bounded(stream, keys, remember, at_most, buckets)
    own = free_name(stream, "_own")
    keyed = stream.withColumn(own, F.when(lacks_key(keys), F.uuid()))
    if remember is None:
        return keyed.dropDuplicates([*keys, own]).drop(own)
    arrived = free_name(stream, "_arrived")
    timed = keyed.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, remember)
    return timed.dropDuplicatesWithinWatermark([*keys, own]).drop(own, arrived)


# Bytes of a key in the state, and keys of a segment of it.
KEY_BYTES = 16
SEGMENT = 4096


def _bounded(stream: DataFrame, keys: Sequence[str], remember: str | None, at_most: int, buckets: int) -> DataFrame:
    """The first row of each key among the latest `at_most` keys, of which each of the `buckets` remembers its share.

    A bucket's state is a row of segments of key digests (128 bits). New keys go to the last segment, and when the share is
    full, the oldest segment is forgotten as a whole: so every key is remembered until its bucket has seen its share, less one
    segment, of new ones. A forgotten key that comes again passes and is remembered anew. With `remember`, a segment to which
    nothing was added for that long is forgotten too, when its bucket gets rows again. Rows without a key pass without a place
    in the state.

    Keys are dealt to buckets by a hash, so that a hot key costs one bucket its rows of a micro-batch only. Needs the RocksDB state
    store, which is set for the session.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    share = max(1, at_most // buckets)
    segment = min(SEGMENT, max(1, share // 4))
    ttl = None if remember is None else int(pd.Timedelta(remember).total_seconds() * 1000)
    digest, bucket = free_name(stream, "_digest"), free_name(stream, "_bucket")
    # lengths keep the parts of a key apart
    parts = [x for k in keys for x in (F.octet_length(F.col(f"`{k}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{k}`").cast("string"))]
    known = F.unhex(F.md5(F.concat(*parts)))
    keyed = stream.withColumn(digest, F.when(~lacks_key(keys), known))
    spread = F.xxhash64(F.coalesce(F.col(digest), F.uuid().cast("binary")))
    dealt = keyed.withColumn(bucket, F.pmod(spread, F.lit(buckets)))
    return dealt.groupBy(bucket).transformWithStateInPandas(
        statefulProcessor=_latest_keys(stream.columns, share, segment, ttl),
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="None",
    )


def _latest_keys(names: list[str], share: int, segment: int, ttl: int | None):
    """The processor of a bucket; a class of its own here, so that workers need nothing but pandas to load it."""
    import time

    from pyspark.sql.streaming import StatefulProcessor

    size = KEY_BYTES

    class LatestKeys(StatefulProcessor):
        def init(self, handle) -> None:
            self.segments = handle.getMapState("segments", "number bigint", "digests binary, added bigint")
            self.span = handle.getValueState("span", "first bigint, last bigint")

        def handleInputRows(self, key, rows, timerValues):
            first, last = self.span.get() if self.span.exists() else (0, 0)
            now, held = int(time.time() * 1000), {}
            for n in range(first, last + 1):
                value = self.segments.getValue((n,))
                held[n] = bytes(value[0]) if value is not None else b""
                if value is not None and ttl is not None and value[1] + ttl < now:
                    self.segments.removeKey((n,))
                    held[n] = b""
            seen = {v[i : i + size] for v in held.values() for i in range(0, len(v), size)}
            changed = set()
            for frame in rows:
                # by place: names that begin with an underscore do not come through
                keep = []
                for d in frame.iloc[:, -2]:
                    d = None if d is None else bytes(d)
                    new = d is None or d not in seen
                    keep.append(new)
                    if new and d is not None:
                        if len(held.get(last, b"")) >= segment * size:
                            last += 1
                        held[last] = held.get(last, b"") + d
                        changed.add(last)
                        seen.add(d)
                        while sum(map(len, held.values())) > share * size:
                            gone = held.pop(first)
                            seen -= {gone[i : i + size] for i in range(0, len(gone), size)}
                            changed.discard(first)
                            self.segments.removeKey((first,))
                            first += 1
                            last = max(first, last)
                yield frame.loc[keep].iloc[:, :-2].set_axis(names, axis=1)
            for n in sorted(changed):
                self.segments.updateValue((n,), (held[n], now))
            self.span.update((first, last))

        def close(self) -> None:
            pass

    return LatestKeys()


def extract_stream(pages: DataFrame, **options) -> DataFrame:
    """Extraction is stateless, so the batch job runs as it is."""
    return extract(pages, **options)


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, form: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append to files with exactly-once bookkeeping; `available_now` drains the input and stops."""
    writer = stream.writeStream.format(form).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
