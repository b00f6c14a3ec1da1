"""Exact top-k by inner product with a forest of M-trees.

The inner product is no metric, so each vector x gets one more component, sqrt(M^2 - |x|^2) for the greatest norm M, and a
query 0: then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the nearest vectors are those of the highest score.

A tree is a row of a stored table: a root, inner nodes, pages and entries. All but entries have a pivot and a covering radius,
all but roots the distance to their parent's pivot. A search keeps the trees, nodes and pages that it has met in one queue,
over all trees that a task holds, takes what may hold the nearest vector first, and ends when nothing left can reach the
k-th best; nodes, pages and entries are skipped by |d(q, parent) - d(parent, x)| before any distance to them is computed.
Vectors are dealt to trees by their nearest pivot of a bounded sample; a cell with many, as of copies, is several trees.

Scores of long vectors are not whole in floating point. These vectors are in no tree: every query is compared with all of
them, and a long query with all vectors (`_compare`), by floats with an error bound first and by integers what is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import ready, stored, tasks

#: vectors in a tree, at most about; entries of a page
TREE_ROWS = 4096
PAGE_ROWS = 64
#: pages below an inner node, on average
NODE_PAGES = 8
#: trees that a task searches at once, and pages that are taken from the queue together once a bound is known
TREES_HELD = 32
PAGES_TAKEN = 8
#: vectors of the sample that sets each query's first bound; some of them are the pivots that deal vectors to trees
MAX_PIVOTS = 1024
#: queries that are sent to the tasks at once; more are searched in several rounds
QUERY_ROWS = 16_384
#: vectors with a greater component or square of the norm (scaled) are in no tree: their scores might not be whole
LIMIT = 1 << 22
LIMIT_SQUARE = 1 << 52
#: from here on (not scaled) a double is a multiple of 1 / 1024
WHOLE = float(1 << 43)
#: queries that are compared with a batch at once
COMPARED = 1024

TREE_SCHEMA = "dim int, ids binary, vectors binary, entry_distance binary, page_pivot binary, page_radius binary, page_distance binary, page_node binary, node_pivot binary, node_radius binary, node_distance binary, root binary, root_radius double"
FOUND_SCHEMA = "query bigint, dim int, long boolean, query_id bigint, vec_id bigint, score bigint, beyond int, key binary"


def scaled(embedding: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of each component, as integers."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint"))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v, u) of the rows that take part: no null id, vector or component, none that is not finite.

    v holds the scaled integers; for a vector too long for a tree, it is null and u has them divided by 1024, as doubles.
    """
    x = F.transform(F.col(f"`{embedding}`"), lambda c: c.cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), x.alias("x"))
    rows = rows.where("vec_id IS NOT NULL AND x IS NOT NULL").where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    size = F.aggregate("x", F.lit(0.0), lambda s, c: s + F.floor(c * 1024) * F.floor(c * 1024).cast("double"))
    fits = F.forall("x", lambda c: F.abs(c) * 1024 < LIMIT)
    v = F.when(fits, F.when(size < float(LIMIT_SQUARE), scaled(F.col("x"))))
    u = F.transform("x", lambda c: F.when(F.abs(c) < WHOLE, F.floor(c * 1024).cast("double") / 1024).otherwise(c))
    return rows.withColumn("v", v).select("vec_id", "v", F.when(F.col("v").isNull(), u).alias("u"))


def _unscaled(rows: DataFrame) -> DataFrame:
    """(vec_id, u) of all rows."""
    return rows.select("vec_id", F.coalesce("u", F.transform("v", lambda c: c / F.lit(1024.0))).alias("u"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[len(column)].as_py()].reshape(len(column), dim).astype(np.float64)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate((x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0.0))[:, None]), axis=1)


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - p) ** 2).sum(axis=-1))


def build(rows: DataFrame, seed: int = 0) -> tuple[DataFrame, dict[int, tuple[np.ndarray, np.ndarray]], float]:
    """(stored trees, sample (ids, vectors) by dimension, square of the greatest norm) for rows (vec_id, v)."""
    top = rows.agg(F.max(F.aggregate("v", F.lit(0).cast("bigint"), lambda s, c: s + c * c))).first()[0]
    top = float(top or 0)
    count = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(MAX_PIVOTS).collect()
    shared = rows.sparkSession.sparkContext.broadcast(_block(sample[: max(1, count // 512)], "v"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(1).value_lengths())
            cell = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims).tolist():
                if dim not in shared.value:
                    continue
                at = np.flatnonzero(dims == dim)
                for part in np.array_split(at, -(-len(at) // 1024)):
                    x, p = _augmented(_matrix(batch.column(1).take(pa.array(part)), dim), top), _augmented(shared.value[dim][1], top)
                    cell[part] = ((p * p).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(dims.astype(np.int32))], names=["vec_id", "v", "cell", "dim"])

    dealt = stored(rows.mapInArrow(deal, "vec_id bigint, v array<bigint>, cell int, dim int"), "cells")
    sizes = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / TREE_ROWS).alias("trees"))
    keyed = dealt.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(seed + 1)), "trees")).drop("trees")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and keys[a] != last:
                    yield _tree(held, last[0], top)
                    held = []
                held.append(batch.slice(a, b - a))
                last = keys[a]
        if held:
            yield _tree(held, last[0], top)

    sorted_ = keyed.select("dim", "cell", "part", "vec_id", "v").repartition(tasks(rows.sparkSession), "dim", "cell", "part").sortWithinPartitions("dim", "cell", "part")
    return stored(sorted_.mapInArrow(trees, TREE_SCHEMA), "mtrees"), _block(sample, "v"), top


def _tree(batches: list[pa.RecordBatch], dim: int, top: float) -> pa.RecordBatch:
    """Bulk load: pages are the cells of some of the vectors, cut to the page size along the distance to the pivot; inner nodes
    are the cells of some of the pages' pivots."""
    ids = np.concatenate([b.column(3).to_numpy() for b in batches])
    x = np.concatenate([_matrix(b.column(4), dim) for b in batches])
    y = _augmented(x, top)
    heads = y[:: max(1, PAGE_ROWS)]
    near = ((heads * heads).sum(axis=1) - 2 * y @ heads.T).argmin(axis=1)
    far = _distance(y, heads[near])
    order = np.lexsort((far, near))
    within = np.arange(len(order)) - np.searchsorted(near[order], near[order])
    page = np.cumsum(np.concatenate(([0], (near[order][1:] != near[order][:-1]) | (within[1:] % PAGE_ROWS == 0))))
    # the vectors are stored page by page; short pages are filled up by repeating their last place with an infinite distance
    pages = int(page[-1]) + 1
    place = np.full((pages, PAGE_ROWS), -1, np.int64)
    place[page, within % PAGE_ROWS] = order
    pivot = heads[near[order[np.searchsorted(page, np.arange(pages))]]]
    distance = np.where(place >= 0, _distance(y[place], pivot[:, None, :]), np.inf)
    tops = pivot[::NODE_PAGES]
    node, page_node = np.unique(((tops * tops).sum(axis=1) - 2 * pivot @ tops.T).argmin(axis=1), return_inverse=True)
    tops = tops[node]
    # a node covers the entries below it, not just its pages' pivots
    below = np.where(place >= 0, _distance(y[place], tops[page_node][:, None, :]), 0).max(axis=1)
    node_radius = np.zeros(len(tops))
    np.maximum.at(node_radius, page_node, below)
    root = y.mean(axis=0)
    return pa.RecordBatch.from_pydict(
        {
            "dim": pa.array([dim], pa.int32()),
            "ids": [np.where(place >= 0, ids[place], -1).tobytes()],
            "vectors": [x[place].astype(np.int32).tobytes()],
            "entry_distance": [distance.tobytes()],
            "page_pivot": [pivot.tobytes()],
            "page_radius": [np.where(place >= 0, distance, 0).max(axis=1).tobytes()],
            "page_distance": [_distance(pivot, tops[page_node]).tobytes()],
            "page_node": [page_node.astype(np.int32).tobytes()],
            "node_pivot": [tops.tobytes()],
            "node_radius": [node_radius.tobytes()],
            "node_distance": [_distance(tops, root).tobytes()],
            "root": [root.tobytes()],
            "root_radius": [float(_distance(y, root).max())],
        }
    )


class Best:
    """The k best (score, id) of each query of a round, and the score that a candidate must reach."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: tuple[np.ndarray, np.ndarray] | None, k: int) -> None:
        self.k, self.ids, self.q = k, ids, vectors
        self.scored = 0
        self.score = [np.zeros(0, np.int64)] * len(ids)
        self.found = [np.zeros(0, np.int64)] * len(ids)
        self.floor = np.full(len(ids), -np.inf)
        if pivots is not None and len(pivots[0]) >= k:
            # these are rows of the table: the k-th best of them is reached for certain, those with the query's id left out
            reached = np.where(pivots[0] == ids[:, None], -np.inf, vectors @ pivots[1].T)
            self.floor = np.partition(reached, len(pivots[0]) - k, axis=1)[:, len(pivots[0]) - k]

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        self.scored += len(ids)
        good = (ids != self.ids[i]) & (score >= self.floor[i])
        if not good.any():
            return
        score, ids = np.concatenate((self.score[i], score[good])), np.concatenate((self.found[i], ids[good]))
        order = np.lexsort((ids, -score))[: self.k]
        self.score[i], self.found[i] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[i] = max(self.floor[i], float(self.score[i][-1]))


class Tree:
    """One row of the stored table."""

    def __init__(self, row: dict) -> None:
        self.dim = row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64).reshape(-1, PAGE_ROWS)
        pages = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(pages, PAGE_ROWS, self.dim)
        self.entry_distance = np.frombuffer(row["entry_distance"]).reshape(pages, PAGE_ROWS)
        self.page_pivot = np.frombuffer(row["page_pivot"]).reshape(pages, self.dim + 1)
        self.page_radius = np.frombuffer(row["page_radius"])
        self.page_distance = np.frombuffer(row["page_distance"])
        self.node_pivot = np.frombuffer(row["node_pivot"]).reshape(-1, self.dim + 1)
        self.node_radius = np.frombuffer(row["node_radius"])
        self.node_distance = np.frombuffer(row["node_distance"])
        page_node = np.frombuffer(row["page_node"], np.int32)
        self.pages_of = [np.flatnonzero(page_node == n) for n in range(len(self.node_pivot))]
        self.root = np.frombuffer(row["root"])
        self.root_radius = row["root_radius"]


TREE, NODE, PAGE = range(3)


class Forest:
    """Some trees of one dimension, their nodes and pages numbered through."""

    def __init__(self, trees: list[Tree]) -> None:
        whole = lambda name: np.concatenate([getattr(t, name) for t in trees])
        self.ids, self.vectors, self.entry_distance = whole("ids"), whole("vectors"), whole("entry_distance")
        self.pivot = np.stack([t.root for t in trees]), whole("node_pivot"), whole("page_pivot")
        self.radius = np.array([t.root_radius for t in trees]), whole("node_radius"), whole("page_radius")
        self.distance = None, whole("node_distance"), whole("page_distance")
        nodes, pages = (np.cumsum([0, *[len(getattr(t, name)) for t in trees]]) for name in ("node_pivot", "page_pivot"))
        below = [own + first for t, first in zip(trees, pages.tolist(), strict=False) for own in t.pages_of]
        self.below = [np.arange(a, b) for a, b in zip(nodes.tolist(), nodes[1:].tolist(), strict=False)], below

    def children(self, kind: int, index: int, q: np.ndarray, to_parent: float, reach: float) -> list[tuple[float, int, int, float]]:
        """(least distance to what it covers, kind, index, distance to its pivot) of the nodes or pages that may be within reach."""
        some, kind = self.below[kind][index], kind + 1
        radius = self.radius[kind][some]
        near = np.abs(to_parent - self.distance[kind][some]) - radius <= reach
        some, radius = some[near], radius[near]
        distance = _distance(self.pivot[kind][some], q)
        found = zip((distance - radius).tolist(), some.tolist(), distance.tolist(), strict=True)
        return [(least, kind, child, d) for least, child, d in found if least <= reach]

    def entries(self, pages: list[int], to_page: list[float], reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, vectors) that stored distances leave within reach; a filler, at an infinite distance, never is."""
        pages = np.array(pages)
        page, place = np.nonzero(np.abs(np.array(to_page)[:, None] - self.entry_distance[pages]) <= min(reach, 1e300))
        own = pages[page]
        return self.ids[own, place], self.vectors[own, place]


def search_trees(trees: list[Tree], best: Best, top: float) -> None:
    """Improve the best of every query by all vectors of some trees of its dimension, what may be nearest first."""
    forest = Forest(trees)
    q = np.concatenate((best.q, np.zeros((len(best.q), 1))), axis=1)
    square = (best.q * best.q).sum(axis=1) + top
    slack = 0.25 + 1e-9 * square
    # the greatest distance at which a vector can still reach the floor
    reach = lambda i: float(np.sqrt(max(square[i] - 2 * (best.floor[i] - slack[i]), 0.0))) if np.isfinite(best.floor[i]) else np.inf
    for i in range(len(q)):
        r = reach(i)
        to_root = _distance(forest.pivot[TREE], q[i])
        least = (to_root - forest.radius[TREE]).tolist()
        queue = [(first, TREE, t, d) for t, (first, d) in enumerate(zip(least, to_root.tolist(), strict=True)) if first <= r]
        heapq.heapify(queue)
        while queue and queue[0][0] <= r:
            _, kind, index, distance = heapq.heappop(queue)
            if kind != PAGE:
                for child in forest.children(kind, index, q[i], distance, r):
                    heapq.heappush(queue, child)
                continue
            pages, to_page = [index], [distance]
            while r < np.inf and queue and queue[0][1] == PAGE and queue[0][0] <= r and len(pages) < PAGES_TAKEN:
                _, _, index, distance = heapq.heappop(queue)
                pages.append(index)
                to_page.append(distance)
            ids, vectors = forest.entries(pages, to_page, r)
            if len(ids):
                best.add(i, (vectors.astype(np.float64) @ best.q[i]).astype(np.int64), ids)
                r = reach(i)


def _whole(u: np.ndarray) -> list[int]:
    """1024 u as integers, for components of any size."""
    return [int(c * 1024) if abs(c) < WHOLE else int(c) * 1024 for c in u.tolist()]


class Exact:
    """The k best (score, id) of each query among all the vectors that it is compared with; scores are integers of any size."""

    def __init__(self, ids: np.ndarray, u: np.ndarray, k: int) -> None:
        self.k, self.ids, self.u = k, ids, u
        self.norm = _norms(u)
        self.whole: list[list[int] | None] = [None] * len(ids)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, u: np.ndarray) -> None:
        known: dict[int, list[int]] = {}
        norm = _norms(u)
        for at in range(0, len(self.ids), COMPARED):
            some = slice(at, at + COMPARED)
            with np.errstate(all="ignore"):
                score = self.u[some] @ u.T
                error = (u.shape[1] + 8) * 2.0**-51 * self.norm[some][:, None] * norm
                least, most = score - error, score + error
            own = self.ids[some][:, None] == ids
            # an overflow leaves no bound
            least[~np.isfinite(least) | own] = -np.inf
            most[~np.isfinite(most)] = np.inf
            if len(ids) >= self.k:
                reached = np.partition(least, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
                self.floor[some] = np.maximum(self.floor[some], reached)
            for i, rows in enumerate((most >= self.floor[some][:, None]) & ~own, at):
                places = np.flatnonzero(rows).tolist()
                if not places:
                    continue
                if self.whole[i] is None:
                    self.whole[i] = _whole(self.u[i])
                for j in places:
                    if j not in known:
                        known[j] = _whole(u[j])
                new = [(-sum(a * b for a, b in zip(self.whole[i], known[j], strict=True)), int(ids[j])) for j in places]
                self.best[i] = sorted(self.best[i] + new)[: self.k]


def _norms(u: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.sqrt((u * u).sum(axis=1))


def _sortable(score: int) -> bytes:
    """Bytes in the order of the integers."""
    size = score.bit_length() // 8 + 1
    sign = size if score >= 0 else -size
    return (sign + (1 << 31)).to_bytes(4, "big") + (score % (1 << 8 * size)).to_bytes(size, "big")


def _compare(rows: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], long: bool, k: int) -> DataFrame:
    """The k best rows (vec_id, u) of each task for each query of the block (ids, u by dimension), compared with all."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Exact] = {}
        for batch in batches:
            dims = np.asarray(batch.column(1).value_lengths())
            for dim in np.unique(dims).tolist():
                if dim not in shared.value:
                    continue
                if dim not in best:
                    best[dim] = Exact(*shared.value[dim], k)
                part = batch.filter(pa.array(dims == dim))
                best[dim].add(part.column(0).to_numpy(), _matrix(part.column(1), dim))
        for dim, b in best.items():
            out = [(q, dim, long, int(b.ids[q]), i, -s) for q, own in enumerate(b.best) for s, i in own]
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "query": q, "dim": d, "long": w, "query_id": own, "vec_id": i,
                        "score": s if -(1 << 63) <= s < 1 << 63 else None,
                        "beyond": 0 if -(1 << 63) <= s < 1 << 63 else 1 if s > 0 else -1,
                        "key": _sortable(s),
                    }
                    for q, d, w, own, i, s in out
                ],
                pa.schema([("query", pa.int64()), ("dim", pa.int32()), ("long", pa.bool_()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.int32()), ("key", pa.binary())]),
            )

    return rows.mapInArrow(compare, FOUND_SCHEMA)


def _block(rows: list, column: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of queries by dimension."""
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r[column]), []).append(r)
    return {d: (np.array([x["vec_id"] for x in own]), np.array([x[column] for x in own], np.float64).reshape(len(own), d)) for d, own in by_dim.items()}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of the highest inner product of floor(1024 x), smaller ids first.

    Queries are searched in every tree, in rounds of QUERY_ROWS; a row with the query's own id is no candidate, and only
    vectors of the query's length are. Null ids, null vectors and those with a null, infinite or NaN component take no part.
    All scores are whole; one that is no bigint is null, but ranked by its value. A repeated row is a candidate each time, as a
    query it counts once. Fewer rows than k give as many. Empty tables give an empty result. Other columns play no part.
    """
    spark = vectors.sparkSession
    ready(spark)
    rows = stored(usable(vectors, vec_id, embedding), "vectors")
    trees, pivots, top = build(rows.where("v IS NOT NULL").select("vec_id", "v"))
    side = _unscaled(rows.where("v IS NULL"))
    asked = stored(usable(queries, vec_id, embedding).distinct(), "queries")
    any_side = not side.isEmpty()
    rounds = max(1, -(-asked.count() // QUERY_ROWS))
    out = None
    for r in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("vec_id", "v", "u"), F.lit(rounds)) == r).orderBy("vec_id", "v", "u").collect()
        block = _block([x for x in part if x["v"] is not None], "v")
        long_block = _block([x for x in part if x["v"] is None], "u")
        shared = spark.sparkContext.broadcast((block, pivots))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block, pivots = shared.value
            best: dict[int, Best] = {}
            held: dict[int, list[Tree]] = {}
            for batch in batches:
                for i in range(batch.num_rows):
                    tree = Tree(batch.slice(i, 1).to_pylist()[0])
                    if tree.dim not in block:
                        continue
                    if tree.dim not in best:
                        best[tree.dim] = Best(*block[tree.dim], pivots.get(tree.dim), k)
                    held.setdefault(tree.dim, []).append(tree)
                    if sum(map(len, held.values())) >= TREES_HELD:
                        for dim in list(held):
                            search_trees(held.pop(dim), best[dim], top)
            for dim, own in held.items():
                search_trees(own, best[dim], top)
            for dim, b in best.items():
                n = [len(s) for s in b.score]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query": np.repeat(np.arange(len(n)), n),
                        "dim": np.full(sum(n), dim, np.int32),
                        "query_id": np.repeat(b.ids, n),
                        "vec_id": np.concatenate([*b.found, np.zeros(0, np.int64)]),
                        "score": np.concatenate([*b.score, np.zeros(0, np.int64)]),
                    }
                )

        found = trees.mapInArrow(search, "query bigint, dim int, query_id bigint, vec_id bigint, score bigint")
        found = found.select("query", "dim", F.lit(False).alias("long"), "query_id", "vec_id", "score", F.lit(0).alias("beyond"), F.lit(None).cast("binary").alias("key"))
        if any_side and block:
            found = found.union(_compare(side, {d: (ids, x / 1024) for d, (ids, x) in block.items()}, False, k))
        if long_block:
            found = found.union(_compare(_unscaled(rows), long_block, True, k))
        # a query is known by its place in the round: an id may come with several vectors
        value = (F.desc("beyond"), F.desc("score"), F.desc(F.when(F.col("beyond") != 0, F.col("key"))))
        order = Window.partitionBy("dim", "long", "query").orderBy(*value, "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        out = ranked if out is None else out.union(ranked)
    return out
