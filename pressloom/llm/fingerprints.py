"""Document fingerprints by a randomised edit embedding.

All texts are read by one shared random walk: at step j the walk stands on a character c, puts it out, and goes on to the next
one if a random bit of (j, c) says so. Two walks that stand on the same rest of a text at the same step go on together; after an
insertion or deletion they soon do so again. So texts with a small edit distance have outputs with a small Hamming distance.

A fingerprint samples the output: steps [2^k - 1, 2^(k + 1) - 1) are octave k, and every octave gives up to 32 symbols, one hex digit
each (0 past the end). The weighted share of equal symbols estimates the Hamming likeness of the whole outputs. For a search,
bands take random samples (bit sampling) of a text's last two whole octaves; texts that share a band are candidates, and a candidate
is verified on the whole outputs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.near_dedup import links
from pressloom.llm.tables import only, ready, stored, tasks
from pressloom.llm.textbytes import mix, ranges

#: steps until the walk's random bits repeat; symbols that an octave gives
STEPS = 1 << 14
SAMPLES = 32
#: texts that are walked together at once; fewer are walked one by one
FEW = 40
#: characters that a task holds at once, unless one text is longer
HELD_CHARS = 1 << 22

_SEED = 0x5EED_0DD5


@lru_cache(maxsize=1)
def _moves() -> np.ndarray:
    """(STEPS, 256) of 0 or 1; code 0 is the place past the end, which no walk leaves."""
    words = mix(np.arange(STEPS * 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SEED))
    bits = np.unpackbits(words.view(np.uint8)).reshape(STEPS, 256)
    bits[:, 0] = 0
    return bits


@lru_cache(maxsize=1)
def _move_rows() -> list[bytes]:
    return [row.tobytes() for row in _moves()]


@lru_cache(maxsize=64)
def sampled(octave: int) -> np.ndarray:
    """Steps of an octave that a fingerprint keeps: one, at random, of each of 32 equal stretches."""
    width = 1 << octave
    count = min(width, SAMPLES)
    each = width // count
    i = np.arange(count, dtype=np.uint64)
    within = mix(i * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SEED + octave + 1)) % np.uint64(each)
    return (width - 1 + (i * np.uint64(each) + within)).astype(np.int64)


@lru_cache(maxsize=64)
def _first_symbol(octave: int) -> int:
    return sum(min(1 << k, SAMPLES) for k in range(octave))


def _weights(n: int) -> np.ndarray:
    """Steps that each of a fingerprint's first n symbols stands for."""
    out, k = [], 0
    while sum(map(len, out)) < n:
        count = min(1 << k, SAMPLES)
        out.append(np.full(count, (1 << k) // count, np.float64))
        k += 1
    return np.concatenate([*out, np.zeros(0)])[:n]


def codes(points: np.ndarray) -> np.ndarray:
    """One of 255 codes for each code point: ASCII as it is, all others by a hash."""
    hashed = 128 + (mix(points.astype(np.uint64) + np.uint64(_SEED)) % np.uint64(128))
    return np.where((points > 0) & (points < 128), points, hashed).astype(np.uint8)


#: the symbol of a code: 1 to 15, and 0 past the end
SYMBOL = np.concatenate(([0], 1 + mix(np.arange(1, 256, dtype=np.uint64) + np.uint64(_SEED)) % np.uint64(15))).astype(np.uint8)


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of all texts, each with a 0 at its end, where each begins, its length)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    data = np.zeros(len(points) + len(texts), np.uint8)
    data[ranges(starts, sizes)] = codes(points)
    return data, starts, sizes


def symbols(texts: list[str]) -> list[np.ndarray]:
    """The sampled symbols of each text's walk, up to its end."""
    data, starts, sizes = _laid_out(texts)
    moves = _moves()
    active = np.argsort(-sizes, kind="stable")
    active = active[sizes[active] > 0]
    at = starts[active].copy()
    blocks: list[np.ndarray] = []
    alone: dict[int, list[int]] = {}
    step, octave = 0, 0
    while len(active) >= FEW:
        targets = sampled(octave)
        block = np.zeros((len(texts), len(targets)), np.uint8)
        for s, target in enumerate(targets.tolist()):
            code, move = np.empty(len(at), np.uint8), np.empty(len(at), np.uint8)
            for j in range(step, target):
                np.take(data, at, out=code, mode="clip")
                np.take(moves[j % STEPS], code, out=move, mode="clip")
                at += move
            step = target
            np.take(data, at, out=code, mode="clip")
            block[active, s] = code
            left = code > 0
            if not left.all():
                active, at = active[left], at[left]
        blocks.append(block)
        octave += 1
    # the long texts that are left, one by one
    for text, place in zip(active.tolist(), at.tolist(), strict=True):
        own = data[place : starts[text] + sizes[text] + 1].tobytes()
        alone[text] = _walk_alone(own, step, octave)
    before = np.concatenate(blocks, axis=1) if blocks else np.zeros((len(texts), 0), np.uint8)
    out = []
    for i in range(len(texts)):
        own = np.concatenate((before[i], np.array(alone[i], np.uint8))) if i in alone else before[i]
        own = SYMBOL[own]
        full = np.flatnonzero(own)
        out.append(own[: full[-1] + 1] if len(full) else own[:0])
    return out


def _walk_alone(own: bytes, step: int, octave: int) -> list[int]:
    """Codes at the sampled steps from an octave on, for a walk that stands at the beginning of `own` (ends in 0)."""
    rows, i, out = _move_rows(), 0, []
    while True:
        for target in sampled(octave).tolist():
            while step < target:
                first = step % STEPS
                stop = min(STEPS, first + target - step)
                for row in rows[first:stop]:
                    i += row[own[i]]
                step += stop - first
            if not own[i]:
                return out
            out.append(own[i])
        octave += 1


def fingerprint(own: np.ndarray) -> str:
    return "".join("0123456789abcdef"[s] for s in own.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the steps, of those before the later end, at which the walks are estimated to put out the same; 1 for two empty texts."""
    n = max(len(a), len(b))
    if n == 0:
        return 1.0
    short = min(len(a), len(b))
    weight = _weight_table(n)
    same = float(weight[:short][a[:short] == b[:short]].sum())
    return same / float(weight.sum())


@lru_cache(maxsize=4096)
def _weight_table(n: int) -> np.ndarray:
    return _weights(n)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by the first as many of another text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FOUND = pa.schema(
    [
        ("part", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
    ]
)
FOUND_DDL = "part int, kind int, doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
#: kinds of rows: finished; a partition's last document, which wants the next one; its first document, for the partition before
DONE, LAST, FIRST = 0, 1, 2


def _finished(part: int, ids: list, texts: list[str], own: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of all but the last of consecutive documents."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    theirs = symbols(changed)
    rows = [
        {
            "part": part, "kind": DONE, "doc_id": i, "n_chars": len(text), "edited_sha256": hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": fingerprint(a), "edited_fingerprint": fingerprint(b), "near_edited": likeness(a, b), "near_next": likeness(a, c), "text": None,
        }
        for i, text, e, a, b, c in zip(ids, texts, changed, own, theirs, own[1:], strict=False)
    ]
    for at in range(0, len(rows), 1024):
        yield pa.RecordBatch.from_pylist(rows[at : at + 1024], FOUND)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents (part, doc_id, text) of one sorted partition with the one after each."""
    edge = lambda kind: {"part": part, "kind": kind, "doc_id": ids[-1], "n_chars": len(texts[-1]), "fingerprint": fingerprint(own[-1]), "text": texts[-1]}
    part, ids, texts, own, held = None, [], [], [], 0
    for batch in batches:
        for p, i, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            first, part = part is None, p
            ids.append(i)
            texts.append(text or "")
            held += len(texts[-1])
            if first:
                own += symbols(texts)
                yield pa.RecordBatch.from_pylist([edge(FIRST)], FOUND)
            if held >= HELD_CHARS:
                own += symbols(texts[len(own) :])
                yield from _finished(part, ids, texts, own)
                ids, texts, own, held = ids[-1:], texts[-1:], own[-1:], 0
    if part is not None:
        own += symbols(texts[len(own) :])
        yield from _finished(part, ids, texts, own)
        yield pa.RecordBatch.from_pylist([edge(LAST)], FOUND)


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a last document and the text after it (doc_id, text, following)."""
    for batch in batches:
        for i, text, following in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            texts = [text or "", following or ""]
            yield from _finished(0, [i], texts, symbols(texts))


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of `documents`.

    The next document is the one with the next smaller id (null ids come last), after the last one the first; of equal ids it
    goes by the text's hash. The edited text has the last half of the text replaced by the beginning of the next document's.
    `near_edited` and `near_next` are the likeness of the fingerprints of the text and of the edited text, or of the next
    document. Equal texts have equal fingerprints; a null text is an empty one, and that of an empty text is empty. A
    table of one row is its own next one. An empty table gives an empty result. Other columns play no part.

    Texts are shuffled once, sorted by ranges; each task reads its range as a stream. Only the first and the last document of
    each partition are joined with their neighbours.
    """
    spark = documents.sparkSession
    ready(spark)
    rows = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=text)
    # equal ids, and rows that repeat, are dealt to several ranges
    keyed = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), "hash", "row"]
    dealt = keyed.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    found = stored(dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(_in_order, FOUND_DDL), "fingerprints")
    # as many numbers as there are partitions
    parts = sorted(r["part"] for r in found.where(F.col("kind") == FIRST).select("part").collect())
    following = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, following int")
    lasts = found.where(F.col("kind") == LAST).join(following, "part").select("doc_id", "text", "following")
    heads = found.where(F.col("kind") == FIRST).select(F.col("part").alias("following"), F.col("text").alias("next_text"))
    edges = lasts.join(heads, "following").select("doc_id", "text", "next_text").mapInArrow(_at_edges, FOUND_DDL)
    done = found.where(F.col("kind") == DONE)
    return done.union(edges).drop("part", "kind", "text")


@dataclass(frozen=True)
class Walks:
    """Bands and symbols in a band; the least share of equal outputs in per cent."""

    bands: int = 32
    band: int = 8
    percent: int = 80
    seed: int = 3

    def keys(self, own: np.ndarray) -> list[int]:
        """Band keys of a text's symbols: of the last two octaves that it fills. None for an empty text."""
        whole = [k for k in range(64) if _first_symbol(k + 1) <= len(own) and own[_first_symbol(k) : _first_symbol(k + 1)].all()]
        out: list[int] = []
        for k in whole[-2:]:
            symbols = own[_first_symbol(k) : _first_symbol(k + 1)]
            chosen = _chosen(len(symbols), self.bands, self.band, self.seed)
            for b, row in enumerate(symbols[chosen]):
                out.append(int.from_bytes(hashlib.blake2b(bytes([k, b, *row.tolist()]), digest_size=8).digest(), "big", signed=True))
        return sorted(set(out))

    def members(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The whole outputs of the walks of a slice's texts, and their bounds."""
        outputs = []
        raw = data.tobytes()
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            text, starts, sizes = _laid_out([raw[a:b].decode("utf-8", "replace")])
            outputs.append(_output(text.tobytes()))
        sizes = np.fromiter(map(len, outputs), np.int64, len(outputs))
        return np.frombuffer(b"".join(outputs), np.uint8), np.concatenate(([0], np.cumsum(sizes)))

    def alike(self, own: np.ndarray, mine: np.ndarray) -> bool:
        short, n = min(len(own), len(mine)), max(len(own), len(mine))
        return 100 * int((own[:short] == mine[:short]).sum()) >= self.percent * n


@lru_cache(maxsize=64)
def _chosen(n: int, bands: int, band: int, seed: int) -> np.ndarray:
    """(bands, band) places of n symbols, each band's without repetition."""
    keys = mix(np.arange(bands * n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)).reshape(bands, n)
    return np.sort(np.argsort(keys, axis=1)[:, : min(band, n)], axis=1)


def _output(own: bytes) -> bytes:
    """All codes that the walk over a text (ends in 0) puts out."""
    rows, i, step, out = _move_rows(), 0, 0, bytearray()
    while own[i]:
        for row in rows[step % STEPS :]:
            code = own[i]
            if not code:
                break
            out.append(code)
            i += row[code]
            step += 1
    return bytes(out)


def similar_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", p: Walks = Walks()) -> DataFrame:
    """(doc_id, text_hash, class_id, kept) of every row of `documents`; the hash is Spark's xxhash64.

    Two texts are linked when their walks put out the same at `p.percent` per cent or more of the steps up to the later end; bands
    propose pairs, which are verified on the whole outputs. `class_id` is the smallest doc_id that links reach, `kept` marks it.
    Equal texts are one class. An empty or null text is linked with nothing. A null id counts as larger than any other. Repeated
    rows give repeated results. An empty table gives an empty result. Other columns play no part.

    Equal texts are one node, and the nodes of a bucket are compared with a few pivots, as in `near_dedup.links`; no bucket is cut.
    """
    ready(documents.sparkSession)
    docs = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=text)
    node = F.when(F.length("text") > 0, F.unhex(F.md5(F.col("text").cast("binary")))).alias("node")
    rows = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), node), "rows")
    texts = docs.select(node, "text").where("node IS NOT NULL").dropDuplicates(["node"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = symbols(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.keys(s) for s in own], pa.list_(pa.int64()))], names=["node", "text", "keys"])

    nodes = stored(texts.mapInArrow(keyed, "node binary, text string, keys array<bigint>"), "nodes")
    # no sizes that would rule out a pair: the length of a walk is known exactly when it is taken again only
    size = F.lit(1).cast("bigint")
    member = nodes.select(F.explode("keys").alias("key"), "node", size.alias("n"), size.alias("shared"), "keys")
    shared = member.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    labels = links(member.join(shared, "key"), nodes.select("node", "text"), p)
    first = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    lowest = stored(first.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id"), "lowest")
    group = lowest.join(lowest.groupBy("label").agg(F.min("doc_id").alias("class_id")), "label").select("node", "class_id")
    out = rows.join(group, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", "text_hash", own.alias("class_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
