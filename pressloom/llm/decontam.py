"""Benchmark decontamination on a positional inverted index of the training documents.

The index is a table with one row per block of documents (a few MB of text): its distinct terms, and for each the sorted
list of word positions. Test texts are looked up in every block: of a window's terms the rarest in the block gives the
candidate starts, and the lists of its other terms, each shifted by the term's place in the window, are intersected with
them from the next rarest on. A block holds whole documents, so no posting is ever shuffled, however frequent its term is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.tables import only, ready, stored
from pressloom.llm.textbytes import ALNUM, ranges, slices, words

BLOCK_BYTES = 4 << 20
#: words of test texts that are sent to the tasks at once; a larger test set is looked up in several rounds
QUERY_WORDS = 1 << 20

INDEX_SCHEMA = "block bigint, doc_ids array<bigint>, doc_starts array<int>, terms binary, term_starts binary, positions binary"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word fingerprints of some texts and the bounds of each text's; arrays by byte are made for a slice at a time."""
    found, bounds, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for _, _, data, at in slices(texts):
        _, _, word, own = words(data, at, ALNUM)
        found.append(word)
        bounds.append(own[1:] + n)
        n += len(word)
    return np.concatenate(found), np.concatenate(bounds)


def positional_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index. Word positions count through a block; `doc_starts` are those of its documents, with the end.

    Words are maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased. A null or empty text has no words.
    """
    ready(documents.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, stop, _, _ in slices(batch.column(1), BLOCK_BYTES):
                word, word_bounds = _words(batch.column(1).slice(first, stop - first))
                order = np.argsort(word, kind="stable")
                ranked = word[order]
                change = np.flatnonzero(np.concatenate((ranked[:1] == ranked[:1], ranked[1:] != ranked[:-1])))
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [number],
                        "doc_ids": pa.array([batch.column(0).slice(first, stop - first)], pa.list_(pa.int64())),
                        "doc_starts": pa.array([word_bounds.astype(np.int32)], pa.list_(pa.int32())),
                        "terms": [ranked[change].tobytes()],
                        "term_starts": [np.concatenate((change, [len(word)])).astype(np.int32).tobytes()],
                        "positions": [order.astype(np.int32).tobytes()],
                    }
                )
                number += 1

    docs = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=text)
    return stored(docs.mapInArrow(blocks, INDEX_SCHEMA), "index")


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words): the fingerprints of each test text's words; texts without words are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, bounds in slices(batch.column(1)):
                _, _, word, at = words(data, bounds, ALNUM)
                out = [word[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({"item_id": batch.column(0).slice(first, stop - first), "words": pa.array(out, pa.binary())})

    return (
        only(items, item_id=F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")), text=text)
        .mapInArrow(rows, "item_id string, words binary")
        .where(F.length("words") > 0)
    )


class Windows:
    """The distinct windows of some test texts, by length, as term numbers of the texts' vocabulary."""

    def __init__(self, items: list[tuple[str, np.ndarray]], width: int) -> None:
        self.item_ids = [i for i, _ in items]
        self.vocabulary = np.unique(np.concatenate([w for _, w in items]))
        by_length: dict[int, list] = {}
        for number, (_, own) in enumerate(items):
            term = np.searchsorted(self.vocabulary, own)
            size = min(width, len(term))
            rows = np.lib.stride_tricks.sliding_window_view(term, size)
            by_length.setdefault(size, []).append((rows, np.full(len(rows), number)))
        self.groups = []
        for size, parts in sorted(by_length.items()):
            rows, owner = np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts])
            unique, inverse = np.unique(rows, axis=0, return_inverse=True)
            order = np.argsort(inverse, kind="stable")
            self.groups.append((size, unique, owner[order], np.searchsorted(inverse[order], np.arange(len(unique) + 1))))


class Block:
    """One row of the index."""

    def __init__(self, doc_starts, terms: bytes, term_starts: bytes, positions: bytes) -> None:
        self.doc_starts = np.asarray(doc_starts, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.term_starts = np.frombuffer(term_starts, np.int32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.int32).astype(np.int64)
        counts = np.diff(self.term_starts)
        # lists one after the other, each term's above the one before: sorted, so one search finds a term at a position
        self.postings = (np.repeat(np.arange(len(counts), dtype=np.int64), counts) << 32) | self.positions

    def numbers(self, vocabulary: np.ndarray) -> np.ndarray:
        """The block's number of each term, -1 where no document has it."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        return np.where(self.terms[at] == vocabulary, at, -1)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, position, side="right") - 1

    def _candidates(self, rows: np.ndarray):
        """(windows with all terms, their terms from rare to frequent, places in the window, each posting of the rarest)."""
        present = np.flatnonzero((rows >= 0).all(axis=1))
        terms = rows[present]
        size = np.diff(self.term_starts)[terms]
        place = np.argsort(size, axis=1, kind="stable")
        terms = np.take_along_axis(terms, place, axis=1)
        rarest = terms[:, 0]
        n = self.term_starts[rarest + 1] - self.term_starts[rarest]
        window = np.repeat(np.arange(len(present)), n)
        return present, terms, place, window, self.positions[ranges(self.term_starts[rarest], n)]

    def phrases(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first position) of every exact occurrence of the windows (rows of block term numbers)."""
        size = rows.shape[1]
        present, terms, place, window, position = self._candidates(rows)
        start = position - place[window, 0]
        inside = (start >= 0) & (start + size <= self.doc_starts[-1])
        window, start = window[inside], start[inside]
        whole = self.document(start) == self.document(start + size - 1)
        window, start = window[whole], start[whole]
        for k in range(1, size):
            if not len(window):
                break
            sought = (terms[window, k] << 32) | (start + place[window, k])
            at = np.minimum(np.searchsorted(self.postings, sought), len(self.postings) - 1)
            hit = self.postings[at] == sought
            window, start = window[hit], start[hit]
        return present[window], start

    def near(self, rows: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of the rarest term wherever every other term is at most `slop` words away, in any order."""
        present, terms, _, window, position = self._candidates(rows)
        for k in range(1, rows.shape[1]):
            if not len(window):
                break
            document = self.document(position)
            low = np.maximum(position - slop, self.doc_starts[document])
            high = np.minimum(position + slop, self.doc_starts[document + 1] - 1)
            own = terms[window, k] << 32
            hit = np.searchsorted(self.postings, own | low) < np.searchsorted(self.postings, own | high, side="right")
            window, position = window[hit], position[hit]
        return present[window], position


MATCH_SCHEMA = "block bigint, doc int, doc_id bigint, spans array<struct<first:int,last:int>>, items array<string>"


def _look_up(index: DataFrame, items: DataFrame, width: int, slop: int | None) -> DataFrame:
    spark = index.sparkSession
    items = stored(items, "items")
    total = items.agg(F.coalesce(F.sum(F.length("words")), F.lit(0)) / 8).first()[0]
    rounds = max(1, -(-int(total) // QUERY_WORDS))
    out = None
    for r in range(rounds):
        # at most about QUERY_WORDS words, whatever the size of the test set
        part = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(rounds)) == r).orderBy("item_id", "words").collect()
        if not part:
            continue
        shared = spark.sparkContext.broadcast(Windows([(x["item_id"], np.frombuffer(x["words"], np.uint64)) for x in part], width))

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sought: Windows = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    yield _block_matches(row, sought, slop)

        found = index.mapInArrow(match, MATCH_SCHEMA)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], MATCH_SCHEMA)


def _block_matches(row: dict, sought: Windows, slop: int | None) -> pa.RecordBatch:
    block = Block(row["doc_starts"], row["terms"], row["term_starts"], row["positions"])
    numbers = block.numbers(sought.vocabulary)
    documents, firsts, lasts, owners = [], [], [], []
    for size, rows, owner, at in sought.groups:
        window, start = block.phrases(numbers[rows]) if slop is None else block.near(numbers[rows], slop)
        n = at[window + 1] - at[window]
        again = np.repeat(start, n)
        documents.append(block.document(again))
        firsts.append(again)
        lasts.append(again + (size if slop is None else 1))
        owners.append(owner[ranges(at[window], n)])
    document, first, last, item = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (documents, firsts, lasts, owners))
    order = np.lexsort((last, first, document))
    document, first, last, item = document[order], first[order], last[order], item[order]
    which, at = np.unique(document, return_index=True)
    at = [*at.tolist(), len(document)]
    out = {"block": [], "doc": [], "doc_id": [], "spans": [], "items": []}
    for d, a, b in zip(which.tolist(), at, at[1:]):
        reach = np.maximum.accumulate(last[a:b])
        new = np.flatnonzero(np.concatenate(([True], first[a + 1 : b] > reach[:-1])))
        base = int(block.doc_starts[d])
        ends = reach[np.concatenate((new[1:] - 1, [b - a - 1]))]
        out["spans"].append([{"first": int(x) - base, "last": int(y) - base} for x, y in zip(first[a:b][new], ends, strict=True)])
        out["items"].append(sorted({sought.item_ids[i] for i in np.unique(item[a:b]).tolist()}))
        out["block"].append(row["block"])
        out["doc"].append(d)
        out["doc_id"].append(row["doc_ids"][d])
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    types = {"block": pa.int64(), "doc": pa.int32(), "doc_id": pa.int64(), "spans": span, "items": pa.list_(pa.string())}
    return pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})


def phrase_matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """(block, doc, doc_id, spans, items) of each document in which a window of `width` item words occurs.

    `spans` are the maximal runs of words [first, last) inside occurrences, `items` the ids (as strings) of the test texts.
    A test text of fewer words is one window; one without words is none. A null item id is the empty string. In a test set
    that takes several rounds a document may have a row for each; `documents_hit` merges them.
    """
    return _look_up(index, item_words(items, item_id, text), width, None)


def proximity_matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = 10, slop: int = 20) -> DataFrame:
    """As `phrase_matches`, for windows all of whose words stand, in any order, at most `slop` words from the rarest one.

    `spans` are the places of that rarest word.
    """
    return _look_up(index, item_words(items, item_id, text), width, slop)


def documents_hit(index: DataFrame, matches: DataFrame) -> DataFrame:
    """(block, doc, doc_id, n_words, n_hit, items) of every indexed document; no hit, 0 words and no items."""
    per_doc = matches.groupBy("block", "doc").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s.n + F.greatest(F.lit(0), x.last - F.greatest(x.first, s.end))).alias("n"), F.greatest(s.end, x.last).alias("end")),
    ).n
    hit = per_doc.select("block", "doc", covered.cast("bigint").alias("n_hit"), "items")
    docs = index.select("block", F.posexplode("doc_ids").alias("doc", "doc_id"), "doc_starts").select(
        "block", "doc", "doc_id", (F.get("doc_starts", F.col("doc") + 1) - F.get("doc_starts", "doc")).cast("bigint").alias("n_words")
    )
    return docs.join(hit, ["block", "doc"], "left").withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")), "items": F.coalesce("items", F.array().cast("array<string>"))}
    )
