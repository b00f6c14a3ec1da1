"""Near-duplicate groups by min-max hashing.

Every hash function of a shingle set is used twice: the smallest and the largest value under it are both kept, so that 60
functions give 120 signature values. 24 bands of 5 values propose pairs; a link is confirmed on the full sets. A pair
at the threshold of 0.85 is missed by all bands with probability (1 - 0.85^5)^24 < 1e-6, a more similar one less often.

Texts with equal shingle sets are one node throughout, so copies are never paired with each other. Shingles that only one
candidate has bound its similarity to all others; that spares most pairs of a bucket that are no link (`possible`). Within
a bucket nodes are compared with a few pivots, not with each other: see `links`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.components import components
from pressloom.llm.prefilter import maybe_in
from pressloom.llm.tables import narrow, only, ready, stored, tasks
from pressloom.llm.textbytes import COEFFICIENTS, NOT_SPACE, mix, slices, words
from pressloom.operators.duplicates import free_name


#: times that the nodes are counted again without those that no other can be linked with; it decides the work only
SIZE_ROUNDS = 2


@dataclass(frozen=True)
class MinMax:
    """Shingle width in words; hash functions (two values each); values in a band; least similarity in per cent."""

    width: int = 5
    functions: int = 60
    band: int = 5
    percent: int = 85
    seed: int = 11

    @property
    def bands(self) -> int:
        return 2 * self.functions // self.band

    def multipliers(self) -> tuple[np.ndarray, np.ndarray]:
        n = np.arange(1, 2 * self.functions + 1, dtype=np.uint64) + np.uint64(self.seed * 1_000_003)
        values = mix(n * np.uint64(0x9E3779B97F4A7C15))
        return values[: self.functions] | np.uint64(1), values[self.functions :]

    def members(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sets of a slice's texts and their bounds."""
        return shingle_sets(data, bounds, self.width)

    def alike(self, own: np.ndarray, mine: np.ndarray) -> bool:
        """Whether two sets are similar enough."""
        if 100 * min(len(own), len(mine)) < self.percent * max(len(own), len(mine)):
            return False
        places = np.searchsorted(own, mine)
        common = int((own[np.minimum(places, len(own) - 1)] == mine).sum())
        return 100 * common >= self.percent * (len(own) + len(mine) - common)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each row of a slice, and their bounds; no words, no shingle."""
    _, _, word, word_bounds = words(data, bounds, NOT_SPACE)
    n_words = np.diff(word_bounds)
    n = len(word)
    shingle = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        shingle += word[j : j + len(shingle)] * COEFFICIENTS[j + 1]
    shingle = mix(shingle)
    sets = []
    for first, size in zip(word_bounds[:-1].tolist(), n_words.tolist(), strict=True):
        if size >= width:
            own = np.unique(shingle[first : first + size - width + 1])
        elif size:
            # the whole short sequence is the only member; its length keeps it apart from full shingles
            own = mix((word[first : first + size] * COEFFICIENTS[1 : size + 1]).sum(keepdims=True) + COEFFICIENTS[100 + size])
        else:
            own = shingle[:0]
        sets.append(own)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else shingle[:0]), np.concatenate(([0], np.cumsum(sizes)))


def set_digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits of each set: equal sets are one node."""
    raw, at = memoryview(values).cast("B"), (bounds * 8).tolist()
    return [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(at, at[1:])]


def band_keys(values: np.ndarray, bounds: np.ndarray, p: MinMax) -> np.ndarray:
    """(rows, bands) keys from the smallest and the largest value under each hash function; all sets non-empty."""
    starts = bounds[:-1]
    signature = np.empty((2 * p.functions, len(starts)), np.uint64)
    for k, (a, b) in enumerate(zip(*p.multipliers(), strict=True)):
        hashed = values * a
        hashed += b
        np.minimum.reduceat(hashed, starts, out=signature[2 * k])
        np.maximum.reduceat(hashed, starts, out=signature[2 * k + 1])
    # a band takes values of different functions: rows k, k + bands, ... of the signature
    bands = p.bands
    keys = np.zeros((bands, len(starts)), np.uint64)
    for j in range(p.band):
        keys += mix(signature[j * bands : (j + 1) * bands]) * COEFFICIENTS[j + 1]
    return mix(keys + (np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]).T


def signatures(documents: DataFrame, p: MinMax) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, keys) of each row; node and keys are null for an empty set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, bounds in slices(batch.column(2)):
                values, at = shingle_sets(data, bounds, p.width)
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                keys = [None] * len(sizes)
                node = [None] * len(sizes)
                if len(full):
                    digests = set_digests(values, at)
                    for i, row in zip(full.tolist(), band_keys(values, at[np.concatenate((full, [len(sizes)]))], p).view(np.int64), strict=True):
                        node[i], keys[i] = digests[i], row
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(first, stop - first),
                        "text_hash": batch.column(1).slice(first, stop - first),
                        "n_shingles": sizes,
                        "node": pa.array(node, pa.binary()),
                        "keys": pa.array(keys, pa.list_(pa.int64())),
                    }
                )

    hashed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInArrow(rows, "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, keys array<bigint>")


def _confirmed(pairs: DataFrame, texts: DataFrame, p: MinMax, hot: int = 2048) -> DataFrame:
    """The pairs (pivot, node) whose full sets are similar enough.

    A pivot with more than `hot` partners is dealt to several tasks, each of which gets its text; a task streams over its
    pivots in order and holds one pivot's set at a time.
    """
    lanes = pairs.groupBy("pivot").agg((F.count("*") / hot).cast("bigint").alias("more"))
    spread = pairs.join(lanes, "pivot").withColumn("lane", F.pmod(F.xxhash64("node"), F.col("more") + 1))
    members = spread.join(texts, "node").select("pivot", "lane", F.lit(1).alias("part"), "node", "text")
    heads = (
        lanes.select(F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0).cast("bigint"), "more")).alias("lane"))
        .join(texts, "node")
        .select(F.col("node").alias("pivot"), "lane", F.lit(0).alias("part"), "node", "text")
    )
    sent = heads.union(members).repartition(tasks(pairs.sparkSession), "pivot", "lane").sortWithinPartitions("pivot", "lane", "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = own = None
        for batch in batches:
            parts, pivots, nodes = batch.column(1).to_numpy(), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            u, v = [], []
            for first, stop, data, bounds in slices(batch.column(3)):
                values, at = p.members(data, bounds)
                for i in range(first, stop):
                    mine = values[at[i - first] : at[i - first + 1]]
                    if parts[i] == 0:
                        pivot, own = pivots[i], mine.copy()
                        continue
                    assert pivots[i] == pivot
                    if p.alike(own, mine):
                        u.append(pivot)
                        v.append(nodes[i])
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    return sent.select("pivot", "part", "node", "text").mapInArrow(compare, "u binary, v binary")


def possible(n: Column, shared: Column, other_n: Column, other_shared: Column, p: MinMax) -> Column:
    """Whether sets of these sizes can be similar enough, if they can only have their `shared` members in common."""
    common = F.least(shared, other_shared)
    return 100 * common >= p.percent * (n + other_n - common)


def shared_members(texts: DataFrame, p: MinMax) -> DataFrame:
    """(id, shared): how many shingles of each candidate another candidate has too."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, stop, data, bounds in slices(batch.column(1), 1 << 18):
                values, at = shingle_sets(data, bounds, p.width)
                yield pa.RecordBatch.from_pydict({"shingle": values.view(np.int64), "id": np.repeat(ids[first:stop], np.diff(at))})

    rows = texts.select("id", "text").mapInArrow(members, "shingle bigint, id bigint")
    single = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    own = single.groupBy("id").agg(F.count("*").alias("own"))
    return texts.select("id", "node", "n").join(own, "id", "left").select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"))


def _open_buckets(buckets: DataFrame, sizes: DataFrame, p: MinMax) -> DataFrame:
    """(key, node, n, shared) of the nodes that some other node of the bucket may be linked with."""
    sized = buckets.join(sizes, "node")
    least = sized.groupBy("key").agg(F.min("n").alias("least"))
    # a partner is at least as large as the smallest node, and all its members may be shared
    partner = F.greatest("least", "shared")
    kept = stored(narrow(sized.join(least, "key").where(possible(F.col("n"), F.col("shared"), partner, partner, p)).drop("least")), "kept")
    return kept.join(kept.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "key")


def _few_meetings(open_: DataFrame, outside: str) -> bool:
    """Whether a node meets 64 of its bucket's nodes `outside` at most, on average over all buckets."""
    sizes = open_.groupBy("key").agg(F.count("*").cast("double").alias("n"), F.expr(f"count_if({outside})").alias("outside"))
    total = sizes.agg(F.sum(F.col("n") * F.col("outside")).alias("met"), F.sum("n").alias("n")).first()
    return total["met"] <= 64 * total["n"]


def links(buckets: DataFrame, texts: DataFrame, p: MinMax) -> DataFrame:
    """(node, label): the components of all confirmed links within buckets; nodes without a link are left out.

    The first pivot of a bucket is the node with the smallest part of its own, as the text that others were copied from.
    Round t takes at most 64^t more, one from each hash lane of the nodes that are not in the first one's component. Once a
    node of a bucket would meet at most 64 of them on average, all are pivots of a last round. Pivots are compared with the
    bucket's nodes of other components, unless the sizes rule out a link; a node and a pivot that share several buckets are
    compared in the first. A bucket is done when its nodes that have not been pivots are in one component: every other pair
    in it has been compared, is connected or cannot be a link. Copies of one text are done after a round or two; unrelated
    nodes that share a bucket are all compared, in about log64 of its size rounds. No bucket is cut.
    """
    tested, labels, t = None, None, 0
    state = ("key", "node", "n", "shared", "keys", "used", "label")
    open_ = stored(narrow(buckets.withColumns({"used": F.lit(False), "label": F.col("node")}).select(*state)), "buckets")
    first = F.min(F.struct((1 - F.col("shared") / F.col("n")).alias("own"), "node", "label", "n", "shared"))
    outside = "NOT used AND label <> main"
    while not open_.isEmpty():
        last = t > 0 and _few_meetings(open_, outside)
        if last:
            chosen = open_.where(outside).select("key", "node", "label", "n", "shared")
        else:
            lane = F.pmod(F.xxhash64("node", F.lit(t)), F.lit(min(64**t, 1 << 42)))
            lanes = open_.where(outside if t else "NOT used").groupBy("key", lane.alias("lane"))
            chosen = stored(narrow(lanes.agg(first.alias("p")).select("key", "p.node", "p.label", "p.n", "p.shared")), "pivots")
        facts = [F.first(c).alias(f"p_{c}") for c in ("label", "n", "shared")]
        pivots = chosen.groupBy(F.col("node").alias("p_node")).agg(*facts, F.collect_set("key").alias("p_keys")).withColumn("key", F.explode("p_keys"))
        met = open_.join(pivots, "key").where((F.col("node") != F.col("p_node")) & (F.col("label") != F.col("p_label")))
        met = met.where(possible(F.col("n"), F.col("shared"), F.col("p_n"), F.col("p_shared"), p))
        if last:
            met = met.where(f"NOT ({outside}) OR p_node < node")
        # a node meets a pivot in several buckets, but only in the first of them they are a pair
        met = met.where(F.col("key") == F.array_min(F.array_intersect("keys", "p_keys")))
        pairs = met.select(F.col("p_node").alias("pivot"), "node")
        if tested is not None:
            either = tested.union(tested.select(F.col("node").alias("pivot"), F.col("pivot").alias("node")))
            pairs = pairs.join(either, ["pivot", "node"], "left_anti")
        pairs = stored(narrow(pairs), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        if labels is None or not pairs.isEmpty():
            found = _confirmed(pairs, texts, p)
            labels = components(found if labels is None else labels.select(F.col("node").alias("u"), F.col("label").alias("v")).union(found))
        if last:
            break
        now = chosen.select("key", "node", F.lit(True).alias("now"))
        after = open_.drop("label").join(now, ["key", "node"], "left").join(labels, "node", "left")
        after = after.withColumns({"used": F.col("used") | F.col("now").isNotNull(), "label": F.coalesce("label", "node")})
        after = stored(narrow(after.select(*state)), "state")
        free = F.when(~F.col("used"), F.col("label"))
        left = after.groupBy("key").agg(F.min(free).alias("low"), F.max(free).alias("high"), first.alias("m")).where("low < high")
        open_ = stored(narrow(after.join(left.select("key", F.col("m.label").alias("main")), "key")), "buckets")
        t += 1
    return components(texts.select(F.col("node").alias("u"), F.col("node").alias("v"))) if labels is None else labels


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", p: MinMax = MinMax()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of each row of `documents`; the hash is Spark's xxhash64.

    `component_id` is the smallest doc_id that confirmed links reach, the row's own included; `kept` marks it. A text
    without words (null, empty, white space) has an empty set, is linked with nothing and is kept. A text of fewer words
    than a shingle has one member, its whole sequence. Repeated rows give repeated results, all kept if they hold the
    smallest id. A null doc_id counts as larger than any other; a group of null ids alone has a null component and is kept.
    """
    return _grouped(documents, doc_id, text, p).drop("label")


def _grouped(documents: DataFrame, doc_id: str, text: str, p: MinMax) -> DataFrame:
    """The columns of `near_duplicates` and the group's label, null for a text without words."""
    ready(documents.sparkSession)
    docs = only(documents, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=text)
    rows = stored(signatures(docs, p), "signatures")
    first = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("keys").alias("keys"))
    nodes = stored(narrow(first), "nodes")
    member = nodes.select(F.explode(F.array_distinct("keys")).alias("key"), "node")
    shared = member.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = stored(narrow(member.join(shared, "key")), "buckets")
    # one row for each node that needs its text
    ids = stored(narrow(nodes.join(buckets.select("node"), "node", "left_semi")), "candidates")
    texts = stored(_texts(docs, ids.select("node", "doc_id"), p).withColumn("id", F.monotonically_increasing_id()), "texts")
    for _ in range(SIZE_ROUNDS):
        # a node that cannot be linked with any other holds no shingle for the next round's counts
        sizes = stored(narrow(shared_members(texts, p)), "sizes")
        buckets = stored(narrow(_open_buckets(buckets.select("key", "node"), sizes, p)), "possible")
        texts = stored(texts.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "text", "n", "id"), "texts")
    buckets = buckets.join(ids.select("node", "keys"), "node")
    labels = links(buckets, texts.select("node", "text"), p)
    lowest = nodes.select("node", "doc_id").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id")
    lowest = stored(narrow(lowest), "lowest")
    group = lowest.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    group = lowest.join(group, "label").select("node", "label", "component_id")
    out = rows.drop("keys").join(group, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "label")


def without_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", p: MinMax = MinMax()) -> DataFrame:
    """The rows of `documents`, of each near-duplicate group only the one with the smallest id; of repeated rows one stays.

    An id may come with several texts; those in different groups stay for their groups. Texts without words are in no group
    and stay. A null id counts as larger than any other; of a group of null ids alone,
    every text stays once. Only rows that go or repeat, and few others, are shuffled with their text.
    """
    found = _grouped(documents, doc_id, text, p)
    # rows of one id with several texts in one group: the text with the smallest hash stays
    found = stored(narrow(found), "near-duplicates")
    first = found.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id", "label").agg(F.min("text_hash").alias("chosen"))
    judged = found.join(first, ["doc_id", "label"], "left")
    gone = judged.where("NOT kept OR (n_shingles > 0 AND text_hash <> chosen)").select(F.col("doc_id").alias("id"), "text_hash").distinct()
    gone = stored(narrow(gone), "removed")
    again = stored(narrow(found.groupBy(F.col("doc_id").alias("id"), "text_hash").count().where("count > 1").select("id", "text_hash")), "repeated")
    own_id, own_hash, open_ = (free_name(documents, c) for c in ("_id", "_hash", "_open"))
    rows = documents.withColumns({own_id: F.col(f"`{doc_id}`").cast("bigint"), own_hash: F.xxhash64(F.col(f"`{text}`"))})
    same = lambda other: rows[own_id].eqNullSafe(other["id"]) & (rows[own_hash] == other["text_hash"])
    # rows that are neither removed nor repeated, nearly all that stay, are not shuffled
    known = stored(narrow(gone.union(again).select(F.xxhash64("id", "text_hash").alias("h"))), "not-single")
    rows = rows.withColumn(open_, maybe_in(known)(F.xxhash64(own_id, own_hash)))
    kept = rows.where(~F.col(open_))
    rows = rows.where(open_)
    rows = rows.join(gone, same(gone), "left_anti")
    single = rows.join(again, same(again), "left_anti")
    repeated = rows.join(again, same(again), "left_semi").dropDuplicates([own_id, own_hash])
    return kept.union(single).union(repeated).drop(own_id, own_hash, open_)


def _texts(docs: DataFrame, ids: DataFrame, p: MinMax) -> DataFrame:
    """(node, text, n): a text and set size for each node of ids. An id may repeat with other texts, so the text must match."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            for first, stop, data, bounds in slices(batch.column(1)):
                values, at = shingle_sets(data, bounds, p.width)
                good = pa.array([nodes[first + i] == d for i, d in enumerate(set_digests(values, at))])
                part = batch.slice(first, stop - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(at))], names=["node", "text", "n"]).filter(good)

    # most documents are no candidates: their texts are not shuffled
    wanted = maybe_in(ids.select(F.xxhash64("doc_id")))
    some = docs.where(wanted(F.xxhash64("doc_id")))
    matched = some.join(ids, some.doc_id.eqNullSafe(ids.doc_id)).select("node", "text")
    return matched.mapInArrow(check, "node binary, text string, n bigint").dropDuplicates(["node"])
