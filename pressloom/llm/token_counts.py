"""Token counts by a map-side lookup in two tiers, without a shuffle of pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pressloom.llm import pretokens
from pressloom.llm.tables import ready
from pressloom.llm.textbytes import slices
from pressloom.operators.duplicates import free_name


def shared_table(documents: DataFrame, tokenizer: str, text: str = "text") -> Broadcast:
    """The tokenizer file's text and its table of pre-tokens frequent in `documents`, for all tasks."""
    spark = documents.sparkSession
    ready(spark)
    with open(tokenizer, encoding="utf-8") as file:
        source = file.read()
    return spark.sparkContext.broadcast((source, pretokens.frequent(documents, text, source)))


def token_counts(documents: DataFrame, tokenizer: str, text: str = "text", limit: int | None = None, shared: Broadcast | None = None) -> DataFrame:
    """The rows of `documents` without their text, with `n_bytes` (UTF-8), `n_tokens` and, given a `limit`, `over_limit`.

    `tokenizer` is the path of a byte-level BPE file of the `tokenizers` library, on the driver. Its text and the table of
    frequent pre-tokens are broadcast; both are bounded (the file; TABLE_SIZE entries). Pre-tokens that the table lacks are
    encoded once per worker and kept in a bounded cache. `shared` is a table made before (`shared_table`). A null or empty text has 0 bytes and 0 tokens. Columns of the
    input that have one of the new names are replaced; all others stay, repeated rows too.
    """
    shared = shared or shared_table(documents, tokenizer, text)
    new = ["n_bytes", "n_tokens", "over_limit"][: 2 + (limit is not None)]
    kept = [c for c in documents.columns if c not in new and c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.worker_encoder(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, stop, data, bounds in slices(texts):
                part = batch.slice(first, stop - first)
                n = encoder.counts(data, bounds)
                columns = part.columns[:-1] + [pa.array(bounds[1:] - bounds[:-1]), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "n_bytes", "n_tokens"])

    keep = [F.col(f"`{c}`") for c in kept]
    rows = documents.select(*keep, F.col(f"`{text}`").alias(free_name(documents, "_text")))
    out_schema = documents.select(*keep).schema.add("n_bytes", LongType()).add("n_tokens", LongType())
    out = rows.mapInArrow(count, out_schema)
    if limit is not None:
        out = out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
    return out
