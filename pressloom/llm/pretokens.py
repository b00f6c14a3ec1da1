"""Byte-level BPE in two tiers: a compact table of frequent pre-tokens, then a cache in each worker.

A pre-token is a piece that the tokenizer never merges across: a contraction, a run of letters, digits or other marks
with the space before it, or white space. Cutting them is done on the characters' classes for whole slices of texts, of any
script; the class of a character beyond ASCII is what the library's own cut says of it. Only a text with a special string or
with one of four control separators goes to the library itself.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.textbytes import Spans, ranges, slices

LETTER, DIGIT, OTHER, SPACE, BLANK, ODD = range(6)

_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[32] = SPACE
_CLASS[9:14] = BLANK
_CLASS[0x1C:0x20] = ODD
_CLASS[0x80:] = ODD

#: about so many rows are looked at for the frequent table, which has so many pre-tokens; they decide the speed only
SAMPLE_ROWS = 4096
TABLE_SIZE = 1 << 17
#: entries that a worker keeps before it starts its cache anew
CACHE_SIZE = 1 << 18
#: a longer pre-token (a long run of letters of a script without spaces) is in neither, and is encoded each time it comes
PIECE_BYTES = 256


def classify(data: np.ndarray, class_of: "Classes") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each byte, that of its character; first and last byte of each white space of several bytes)."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data >= 0xC0)
    byte = data[lead]
    size = 2 + (byte >= 0xE0).astype(np.int64) + (byte >= 0xF0)
    # UTF-8: the lead byte's last bits, then six of each byte that follows
    code = byte.astype(np.int32) & (0x7F >> size)
    for k in range(1, 4):
        more = slice(None) if k == 1 else np.flatnonzero(size > k)
        code[more] = code[more] << 6 | (data[lead[more] + k] & 0x3F)
    own = class_of(code)
    kind[lead] = own
    for k in range(1, 4):
        more = slice(None) if k == 1 else np.flatnonzero(size > k)
        kind[lead[more] + k] = own[more]
    blank = own == BLANK
    return kind, lead[blank], (lead + size)[blank] - 1


class Classes:
    """The class of characters beyond ASCII, asked of the library's own cut once for each character that comes up."""

    def __init__(self, cut: Callable[[str], list]) -> None:
        self.cut = cut
        self.known = np.full(0x110000, 255, np.uint8)

    def __call__(self, code: np.ndarray) -> np.ndarray:
        new = np.unique(code[self.known[code] == 255])
        for c in new.tolist():
            self.known[c] = self._ask(chr(c))
        return self.known[code]

    def _ask(self, char: str) -> int:
        """A character is cut off what stands before it unless that is of its class."""
        for before, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)):
            if len(self.cut(before + char)) == 1:
                return kind
        return BLANK


def cut_texts(data: np.ndarray, bounds: np.ndarray, bpe: "Bpe") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds of each row's pre-tokens, rows that must go to the library and have none)."""
    kind, wide, wide_last = classify(data, bpe.classes)
    found = [np.flatnonzero(kind == ODD)]
    raw = data.tobytes()
    for s in bpe.special:
        at, places = raw.find(s), []
        while at >= 0:
            places.append(at)
            at = raw.find(s, at + 1)
        found.append(np.array(places, np.int64))
    odd = np.unique(np.searchsorted(bounds, np.concatenate(found), side="right") - 1)
    return *_without(*cut(data, bounds, kind, wide, wide_last), odd), odd


def cut(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray, wide: np.ndarray, wide_last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of a slice: (starts, ends, bounds of each row's pre-tokens)."""
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    blank = kind >= SPACE
    before = np.ones(n, np.uint8) * ODD  # the class of the byte before, ODD at the start of a row
    before[1:] = kind[:-1]
    before[first[:-1]] = ODD
    text_next = np.zeros(n, bool)  # a byte of the same row follows and is no white space
    text_next[:-1] = ~blank[1:]
    text_next[first[1:]] = False
    after_blank = (before == SPACE) | (before == BLANK)
    start = np.where(blank, ~after_blank | text_next, (kind != before) & (before != SPACE))
    # the last white space before a text is a piece of its own: it starts at its first byte
    start[wide] |= text_next[wide_last]
    start[wide + 1] = start[wide_last] = False
    _contractions(data, kind, before, first, start)
    starts = np.flatnonzero(start)
    row_bounds = np.searchsorted(starts, bounds)
    ends = np.empty_like(starts)
    if len(starts):
        ends[:-1], ends[-1] = starts[1:], n
    return starts, ends, row_bounds


def _contractions(data, kind, before, first, start) -> None:
    """'s 't 'm 'd 're 've 'll, where a pre-token starts at the apostrophe: one piece, and what follows is another."""
    n = len(data)
    marks = np.flatnonzero((data == 39) & (before != OTHER) & (before != SPACE))
    for at in marks.tolist():
        tail = data[at + 1 : at + 3].tobytes()
        size = 2 if tail[:1] in (b"s", b"t", b"m", b"d") else 3 if tail in (b"re", b"ve", b"ll") else 0
        if size == 0 or first[at + 1 : at + size].any():
            continue
        start[at + 1 : at + size] = False
        end = at + size
        # white space keeps its own starts; text after the contraction begins a piece
        if end < n and not first[end] and kind[end] < SPACE:
            start[end] = True


class Bpe:
    """The tokenizer file, loaded where it is needed."""

    def __init__(self, source: str) -> None:
        self.source = source
        spec = json.loads(source)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.special_ids = [t["id"] for t in spec.get("added_tokens", [])]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = dict(zip(map(chr, printable), printable, strict=True))
        shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        import tiktoken

        self._pieces = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self._joined = tiktoken.Encoding("joined", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
        self._zero = ranks[b"\0"]
        self._library = None
        self.classes = Classes(lambda text: self.library().pre_tokenizer.pre_tokenize_str(text))
        self.size = len(spec["model"]["vocab"])

    def piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        return self._pieces.encode_ordinary(piece.decode())

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(token ids of some pre-tokens of a slice one after the other, as bytes; the bounds of each one's bytes).

        They are encoded in one call, with a zero byte behind each; where one has such a byte itself, one by one.
        """
        sizes = ends - starts + 1
        last = np.cumsum(sizes) - 1
        joined = data[np.minimum(ranges(starts, sizes), len(data) - 1)]
        joined[last] = 0
        if np.count_nonzero(joined == 0) > len(last):
            rows = [array("I", self.piece(data[a:b].tobytes())).tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            return b"".join(rows), np.cumsum([0, *map(len, rows)])
        ids = self._joined.encode_to_numpy(joined.tobytes().decode(), disallowed_special=())
        end = ids == self._zero
        return ids[~end].astype(np.uint32, copy=False).tobytes(), 4 * np.concatenate(([0], np.flatnonzero(end) - np.arange(len(last))))

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def texts(self, texts: list[str]) -> list[list[int]]:
        """Token ids of whole texts by the library."""
        return [e.ids for e in self.library().encode_batch(texts, add_special_tokens=False)]


def sizes(source: str) -> tuple[int, list[int]]:
    """(tokens of the vocabulary, ids of the special tokens), without the tables that encoding needs."""
    spec = json.loads(source)
    return len(spec["model"]["vocab"]), [t["id"] for t in spec.get("added_tokens", [])]


@lru_cache(maxsize=2)
def load(source: str) -> Bpe:
    return Bpe(source)


class HashTable:
    """Open addressing over 64-bit keys in three flat arrays: slot keys, and first id and number of ids of each."""

    def __init__(self, keys: np.ndarray, ids: Sequence[Sequence[int]]) -> None:
        self.bits = max(4, int(len(keys) * 3).bit_length())
        size = 1 << self.bits
        self.keys = np.zeros(size, np.uint64)
        self.begin = np.zeros(size, np.int64)
        self.count = np.zeros(size, np.int32)
        self.ids = np.array([i for row in ids for i in row], np.uint32)
        begin = 0
        for key, row in zip(keys.tolist(), ids, strict=True):
            slot = key >> (64 - self.bits)
            while self.keys[slot]:
                slot = (slot + 1) & (size - 1)
            self.keys[slot], self.begin[slot], self.count[slot] = key, begin, len(row)
            begin += len(row)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not in the table."""
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        seen = self.keys[slot]
        out = np.where(seen == keys, slot, -1)
        open_ = np.flatnonzero((seen != keys) & (seen != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (seen != 0)]
        return out


class Encoder:
    """Counts or token ids of the rows of slices."""

    def __init__(self, bpe: Bpe, table: HashTable, cache: dict) -> None:
        self.bpe, self.table, self.cache = bpe, table, cache

    def _missing(self, data, starts, ends, keys) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Token ids of each distinct key that the table lacks, as bytes, their numbers, and which of them each miss is."""
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.cache) > CACHE_SIZE:
            self.cache.clear()
        unique = unique.tolist()
        rows = list(map(self.cache.get, unique))
        new = [i for i, row in enumerate(rows) if row is None]
        if new:
            starts, ends = starts[where[new]], ends[where[new]]
            ids, bounds = self.bpe.pieces(data, starts, ends)
            bounds, short = bounds.tolist(), (ends - starts <= PIECE_BYTES).tolist()
            for i, first, stop, kept in zip(new, bounds, bounds[1:], short):
                rows[i] = ids[first:stop]
                if kept:
                    self.cache[unique[i]] = rows[i]
        return rows, np.fromiter(map(len, rows), np.int64, len(rows)) // 4, inverse

    def _library_rows(self, data, bounds, rows) -> list[list[int]]:
        return self.bpe.texts([data[bounds[r] : bounds[r + 1]].tobytes().decode() for r in rows.tolist()])

    def counts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each row."""
        if not len(data):
            return np.zeros(len(bounds) - 1, np.int64)
        starts, ends, row_bounds, odd = cut_texts(data, bounds, self.bpe)
        keys = Spans(data).of(starts, ends)
        slot = self.table.find(keys)
        size = self.table.count[slot].astype(np.int64)
        missed = np.flatnonzero(slot < 0)
        if len(missed):
            _, sizes, inverse = self._missing(data, starts[missed], ends[missed], keys[missed])
            size[missed] = sizes[inverse]
        total = np.concatenate(([0], np.cumsum(size)))
        out = total[row_bounds[1:]] - total[row_bounds[:-1]]
        if len(odd):
            out[odd] = [len(ids) for ids in self._library_rows(data, bounds, odd)]
        return out

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all rows one after the other, bounds of each row's ids)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        starts, ends, row_bounds, odd = cut_texts(data, bounds, self.bpe)
        keys = Spans(data).of(starts, ends)
        slot = self.table.find(keys)
        begin, size, pool = self.table.begin[slot], self.table.count[slot].astype(np.int64), self.table.ids
        missed = np.flatnonzero(slot < 0)
        if len(missed):
            rows, sizes, inverse = self._missing(data, starts[missed], ends[missed], keys[missed])
            begin[missed] = (np.cumsum(sizes) - sizes)[inverse] + len(pool)
            size[missed] = sizes[inverse]
            pool = np.concatenate((pool, np.frombuffer(b"".join(rows), np.uint32)))
        out = pool[ranges(begin, size)]
        total = np.concatenate(([0], np.cumsum(size)))[row_bounds]
        if not len(odd):
            return out, total
        parts, sizes, last = [], np.diff(total), 0
        for row, ids in zip(odd.tolist(), self._library_rows(data, bounds, odd), strict=True):
            parts += [out[last : total[row]], np.array(ids, np.uint32)]
            sizes[row], last = len(ids), total[row]
        return np.concatenate([*parts, out[last:]]), np.concatenate(([0], np.cumsum(sizes)))


def _without(starts, ends, row_bounds, rows):
    """Pre-tokens without those of some rows."""
    if not len(rows):
        return starts, ends, row_bounds
    keep = np.ones(len(starts), bool)
    for r in rows.tolist():
        keep[row_bounds[r] : row_bounds[r + 1]] = False
    kept = np.concatenate(([0], np.cumsum(keep)))
    return starts[keep], ends[keep], kept[row_bounds]


def frequent(documents: DataFrame, text: str, source: str, sample_rows: int = SAMPLE_ROWS, size: int = TABLE_SIZE) -> HashTable:
    """The table of the `size` most frequent pre-tokens in a sample of about `sample_rows` texts; tasks encode them."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [array("I", load(source).piece(p.as_py())).tobytes() for p in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "ids": pa.array(ids, pa.binary())})

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in slices(batch.column(0)):
                if not len(data):
                    continue
                starts, ends, _, _ = cut_texts(data, bounds, load(source))
                short = ends - starts <= PIECE_BYTES
                starts, ends = starts[short], ends[short]
                keys = Spans(data).of(starts, ends)
                unique, where, count = np.unique(keys, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": unique.view(np.int64),
                        "piece": pa.array([data[starts[i] : ends[i]].tobytes() for i in where.tolist()], pa.binary()),
                        "n": count.astype(np.int64),
                    }
                )

    share = min(1.0, sample_rows / max(1, documents.count()))
    sample = documents.select(F.col(f"`{text}`").alias("text")).sample(share, seed=1)
    rows = (
        sample.mapInArrow(pieces, "key bigint, piece binary, n bigint")
        .groupBy("key", "piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "key")
        .limit(size)
        .select("key", "piece")
        .mapInArrow(encoded, "key bigint, ids binary")
        .toArrow()
    )
    return HashTable(rows.column("key").to_numpy().view(np.uint64), [memoryview(ids.as_py()).cast("I") for ids in rows.column("ids")])


_caches: dict[str, dict] = {}


def worker_encoder(source: str, table: HashTable) -> Encoder:
    """An encoder whose cache lives as long as the Python worker."""
    return Encoder(load(source), table, _caches.setdefault(source, {}))
