"""Hard negatives for contrastive training, by angular triangle filtering.

An anchor's positives are its best rows of the same label; a hard negative is a row of another label whose score lies in a
window below a positive's, as 50 to 95 per cent of it. Scores are integer inner products.

Angles between directions obey the triangle inequality: with the stored angles of a row x and of an anchor a to a reference
direction r, |ar - xr| <= ax <= ar + xr. The tightest of all references gives an interval of the cosine, and the norms make
an interval of the score of it, widened by more than all rounding. Rows are stored in pages by label and nearest reference,
sorted by the angle to it, and bounds are taken for GROUP rows at a time. Only groups whose interval meets the scores that can
still count (the score window, and from the k-th best found so far on) are scored, exactly.

Vectors whose scores might not be whole in floating point are `wide`: they are in pages of their own, which have no bounds and
are scored with integers of any size; so is every page for a wide anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import ready, stored, tasks
from pressloom.session import shared_dir

SCALE = 256
#: reference directions, and the sample of rows that they are chosen from
REFERENCES = 16
SAMPLE = 1024
#: rows of a page, of a group with bounds of its own, and of the part of a cell that one task sorts, at most about
PAGE_ROWS = 1024
GROUP = 32
PART_ROWS = 1 << 16
#: anchors that are sent to the tasks at once; more are searched in several rounds
ANCHOR_ROWS = 4096
#: a product of two norms below this has a whole score in floating point
WIDE_SQUARE = float(1 << 50)
#: from here on (not scaled) a double is a multiple of 1 / 256
WHOLE = float(1 << 44)
#: wider than the error of an angle that is taken from a cosine and stored in 32 bits
ANGLE_SLACK = 2e-6

PAGE_SCHEMA = "label bigint, dim int, wide boolean, ids binary, rows binary, norms binary, angles binary"


def usable(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(vec_id, label, u) of the rows that take part: u has floor(256 x) / 256 of each component, as doubles."""
    x = F.transform(F.col(f"`{embedding}`"), lambda c: c.cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").cast("bigint").alias("label"), x.alias("x"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    u = F.transform("x", lambda c: F.when(F.abs(c) < WHOLE, F.floor(c * SCALE).cast("double") / SCALE).otherwise(c))
    return rows.select("vec_id", "label", u.alias("u"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[len(column)].as_py()].reshape(len(column), dim)


def _norms(y: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.sqrt((y * y).sum(axis=1))


def angles(y: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """(rows, references) angles; that of a zero vector, whose scores are all 0, is a right one."""
    with np.errstate(all="ignore"):
        cosine = np.where(norms[:, None] > 0, (y @ references.T) / norms[:, None], 0.0)
    return np.arccos(np.clip(np.nan_to_num(cosine), -1.0, 1.0))


def directions(sample: np.ndarray, wanted: int = REFERENCES) -> np.ndarray:
    """Unit vectors far apart: each next one is the sample's row with the greatest angle to the nearest of those before."""
    norms = _norms(sample)
    unit = sample[(norms > 0) & np.isfinite(norms)] / norms[(norms > 0) & np.isfinite(norms)][:, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(wanted, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def build(rows: DataFrame, seed: int = 0) -> tuple[DataFrame, dict[int, np.ndarray], dict[int, tuple]]:
    """(stored pages, reference directions by dimension, sample (ids, labels, scaled rows) by dimension) of rows (vec_id, label, u)."""
    spark = rows.sparkSession
    by_dim: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE).collect():
        by_dim.setdefault(len(r["u"]), []).append(r)
    references, sample = {}, {}
    for dim, own in by_dim.items():
        y = np.array([r["u"] for r in own], np.float64).reshape(len(own), dim) * SCALE
        slim = _norms(y) ** 2 < WIDE_SQUARE
        references[dim] = directions(y[slim])
        sample[dim] = (np.array([r["vec_id"] for r in own])[slim], np.array([r["label"] for r in own])[slim], y[slim])
    shared = spark.sparkContext.broadcast(references)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2).value_lengths())
            cell, angle, wide = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                with np.errstate(all="ignore"):
                    y = _matrix(batch.column(2).take(pa.array(at)), dim) * SCALE
                norms = _norms(y)
                wide[at] = ~(norms * norms < WIDE_SQUARE)
                own = shared.value.get(dim, np.zeros((0, dim)))
                if len(own):
                    every = angles(y, norms, own)
                    cell[at] = every.argmin(axis=1)
                    angle[at] = every[np.arange(len(at)), cell[at]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims.astype(np.int32)), pa.array(wide), pa.array(np.where(wide, 0, cell).astype(np.int32)), pa.array(angle)],
                names=["vec_id", "label", "u", "dim", "wide", "cell", "angle"],
            )

    dealt = stored(rows.mapInArrow(deal, "vec_id bigint, label bigint, u array<double>, dim int, wide boolean, cell int, angle double"), "cells")
    key = ["label", "dim", "wide", "cell"]
    # a label, or a cell with a group of copies, may hold any share of the rows: it is cut into parts
    parts = dealt.groupBy(*key).agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    keyed = dealt.join(parts, key).withColumn("part", F.pmod(F.xxhash64("vec_id", "u"), "parts")).drop("parts")
    order = [*key, "part", "angle", "vec_id"]
    dealt = keyed.select(*key, "part", "angle", "vec_id", "u").repartition(tasks(spark), *key, "part").sortWithinPartitions(*order)

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            own = list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))
            edges = [0, *[i for i in range(1, len(own)) if own[i] != own[i - 1]], len(own)]
            for a, b in zip(edges, edges[1:]):
                while a < b:
                    if held and (own[a] != last or sum(map(len, held)) == PAGE_ROWS):
                        yield _page(pa.concat_arrays([h.field(0) for h in held]), pa.concat_arrays([h.field(1) for h in held]), last, shared.value)
                        held = []
                    some = min(b - a, PAGE_ROWS - sum(map(len, held)))
                    held.append(pa.StructArray.from_arrays([batch.column(6).slice(a, some), batch.column(7).slice(a, some)], ["vec_id", "u"]))
                    last, a = own[a], a + some
        if held:
            yield _page(pa.concat_arrays([h.field(0) for h in held]), pa.concat_arrays([h.field(1) for h in held]), last, shared.value)

    return stored(dealt.mapInArrow(pages, PAGE_SCHEMA), "pages"), references, sample


def _page(ids: pa.Array, u: pa.Array, key: tuple, references: dict[int, np.ndarray]) -> pa.RecordBatch:
    label, dim, wide = key[:3]
    x = _matrix(u, dim)
    y = np.zeros_like(x) if wide else x * SCALE
    norms = _norms(y)
    every = angles(y, norms, references.get(dim, np.zeros((0, dim)))).astype(np.float32)
    return pa.RecordBatch.from_pydict(
        {
            "label": pa.array([label], pa.int64()),
            "dim": pa.array([dim], pa.int32()),
            "wide": pa.array([wide]),
            "ids": [ids.to_numpy().tobytes()],
            "rows": [(x if wide else y.astype(np.int32)).tobytes()],
            "norms": [norms.tobytes()],
            "angles": [every.tobytes()],
        }
    )


def _integers(u: np.ndarray) -> np.ndarray:
    """floor(256 x) as integers of any size."""
    flat = [int(c * SCALE) if abs(c) < WHOLE else int(c) * SCALE for c in u.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(u.shape)


class Page:
    """One row of the stored table, with the bounds of its groups."""

    def __init__(self, row: dict, references: int) -> None:
        self.label, self.dim, self.wide = row["label"], row["dim"], row["wide"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        n = len(self.ids)
        if self.wide:
            self.u = np.frombuffer(row["rows"]).reshape(n, self.dim)
            return
        self.y = np.frombuffer(row["rows"], np.int32).reshape(n, self.dim).astype(np.float64)
        starts = np.arange(0, n, GROUP)
        norms, every = np.frombuffer(row["norms"]), np.frombuffer(row["angles"], np.float32).reshape(n, references).astype(np.float64)
        self.norm_low, self.norm_high = np.minimum.reduceat(norms, starts), np.maximum.reduceat(norms, starts)
        self.angle_low, self.angle_high = np.minimum.reduceat(every, starts), np.maximum.reduceat(every, starts)

    def integers(self) -> np.ndarray:
        return _integers(self.u) if self.wide else _integers(self.y / SCALE)

    def bounds(self, a: Anchors) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) score of each anchor (not wide) with the rows of each group."""
        low, high = np.zeros((len(a.y), len(self.norm_low))), np.full((len(a.y), len(self.norm_low)), np.pi)
        for r in range(a.angles.shape[1]):
            own = a.angles[:, r, None]
            np.maximum(low, own - self.angle_high[:, r], out=low)
            np.maximum(low, self.angle_low[:, r] - own, out=low)
            np.minimum(high, own + self.angle_high[:, r], out=high)
        most, least = np.cos(np.maximum(low - ANGLE_SLACK, 0.0)), np.cos(np.minimum(high + ANGLE_SLACK, np.pi))
        most *= np.where(most >= 0, self.norm_high, self.norm_low)
        least *= np.where(least >= 0, self.norm_low, self.norm_high)
        slack = 1.0 + 1e-9 * a.norms[:, None] * self.norm_high
        return least * a.norms[:, None] - slack, most * a.norms[:, None] + slack


class Anchors:
    """The anchors of a round that have one dimension and are not wide; `place` is their number in the round."""

    def __init__(self, place: np.ndarray, ids: np.ndarray, labels: np.ndarray, u: np.ndarray, references: np.ndarray) -> None:
        self.place, self.ids, self.labels, self.u = place, ids, labels, u
        self.y = u * SCALE
        self.norms = _norms(self.y)
        self.angles = angles(self.y, self.norms, references)

    def take(self, some: np.ndarray) -> Anchors:
        out = object.__new__(Anchors)
        out.__dict__ = {k: v[some] for k, v in self.__dict__.items()}
        return out


class Best:
    """The k best (score, id) of each slot within its window of scores; an anchor has one slot, or one for each positive."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.k, self.high = k, high
        self.need = low.copy()
        self._empty()

    def _empty(self) -> None:
        self.score = np.full((len(self.need), self.k), -np.inf)
        self.ids = np.full((len(self.need), self.k), np.iinfo(np.int64).max)

    def add(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores (slots, ids) that may count; -inf where a row is no candidate."""
        good = (score >= self.need[slots][:, None]) & (score <= self.high[slots][:, None])
        hit = np.flatnonzero(good.any(axis=1))
        if not len(hit):
            return
        slots = slots[hit]
        score = np.concatenate((self.score[slots], np.where(good[hit], score[hit], -np.inf)), axis=1)
        ids = np.concatenate((self.ids[slots], np.broadcast_to(ids, (len(hit), len(ids)))), axis=1)
        order = np.lexsort((ids, -score), axis=1)[:, : self.k]
        self.score[slots], self.ids[slots] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
        self.need[slots] = np.maximum(self.need[slots], self.score[slots, -1])

    def only_floor(self) -> None:
        """Forget what was found, but not the score that k rows reach."""
        self._empty()

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, j = np.nonzero(np.isfinite(self.score))
        return slot, self.score[slot, j].astype(np.int64), self.ids[slot, j]


def scan(page: Page, a: Anchors, best: Best, slots: int) -> None:
    """Score the groups of a page that can still count for some slot; anchor i has the slots [i * slots, (i + 1) * slots)."""
    if not len(a.ids):
        return
    least, most = page.bounds(a)
    own = (a.slot[:, None] * slots + np.arange(slots)).ravel()
    wanted = lambda cols: ((most[:, None, cols] >= best.need[own].reshape(-1, slots, 1)) & (least[:, None, cols] <= best.high[own].reshape(-1, slots, 1))).any(axis=1)
    # the groups that may hold the highest scores come first: they raise what the others must reach
    for g in np.argsort(-np.minimum(most, best.high[own].reshape(-1, slots).max(axis=1)[:, None]).sum(axis=0)).tolist():
        some = np.flatnonzero(wanted(slice(g, g + 1))[:, 0])
        if not len(some):
            continue
        ids = page.ids[g * GROUP : (g + 1) * GROUP]
        score = a.y[some] @ page.y[g * GROUP : (g + 1) * GROUP].T
        score[a.ids[some][:, None] == ids] = -np.inf
        for s in range(slots):
            best.add(a.slot[some] * slots + s, score, ids)


def _clip(value: int) -> float:
    """A bound on whole scores below 2^50; what lies beyond may lie anywhere beyond."""
    return float(max(-(1 << 60), min(1 << 60, value)))


def sortable(score: int) -> bytes:
    """Bytes in the order of the integers."""
    size = score.bit_length() // 8 + 1
    return ((size if score >= 0 else -size) + (1 << 31)).to_bytes(4, "big") + (score % (1 << 8 * size)).to_bytes(size, "big")


FOUND = pa.schema([("place", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.string()), ("key", pa.binary())])


def _search(pages: DataFrame, anchors: list, references: dict[int, np.ndarray], sample: dict[int, tuple], same: bool, windows: list[list[tuple]], k: int) -> DataFrame:
    """(place, slot, vec_id, score, key): the k best rows of each task for each window of each anchor.

    `anchors` are (vec_id, label, u); `windows` has for each the whole numbers (least, most), None for no bound. Candidates have the
    anchor's label if `same`, else another. The key sorts as the score.
    """
    shared = pages.sparkSession.sparkContext.broadcast((anchors, references, sample, windows))
    slots = max((len(w) for w in windows), default=0)

    def prepared() -> tuple[dict[int, tuple[Anchors, Best]], list[int]]:
        anchors, references, sample, windows = shared.value
        by_dim: dict[int, list[int]] = {}
        wide = []
        for place, (_, _, u) in enumerate(anchors):
            with np.errstate(all="ignore"):
                square = float((np.array(u) * SCALE) @ (np.array(u) * SCALE))
            (by_dim.setdefault(len(u), []) if square < WIDE_SQUARE else wide).append(place)
        out = {}
        for dim, places in by_dim.items():
            own = references.get(dim, np.zeros((0, dim)))
            a = Anchors(np.array(places), np.array([anchors[p][0] for p in places]), np.array([anchors[p][1] for p in places]), np.array([anchors[p][2] for p in places]).reshape(len(places), dim), own)
            a.slot = np.arange(len(places))
            # a slot without a window takes nothing
            low, high = np.full((len(places), slots), np.inf), np.full((len(places), slots), -np.inf)
            for i, p in enumerate(places):
                for s, (least, most) in enumerate(windows[p]):
                    low[i, s], high[i, s] = -np.inf if least is None else _clip(least), np.inf if most is None else _clip(most)
            best = Best(low.ravel(), high.ravel(), k)
            if dim in sample:
                # the sample's rows are rows of the table: what k of them reach is reached for certain
                ids, labels, y = sample[dim]
                score = a.y @ y.T
                score[(a.ids[:, None] == ids) | ((a.labels[:, None] == labels) != same)] = -np.inf
                for s in range(slots):
                    best.add(a.slot * slots + s, score, ids)
                best.only_floor()
            out[dim] = (a, best)
        return out, wide

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, references, _, windows = shared.value
        slim, wide = prepared()
        wide_of = {p: _integers(np.array(anchors[p][2])) for p in wide}
        exact: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                page = Page(row, len(references.get(row["dim"], ())))
                a, best = slim.get(page.dim, (None, None))
                if a is not None and not page.wide:
                    scan(page, a.take(np.flatnonzero((a.labels == page.label) == same)), best, slots)
                # integers of any size: a wide page with all anchors, any page with the wide ones
                places = [*wide, *(a.place.tolist() if page.wide and a is not None else ())]
                places = [p for p in places if len(anchors[p][2]) == page.dim and (anchors[p][1] == page.label) == same]
                if places:
                    whole = page.integers()
                for p in places:
                    mine = wide_of.get(p)
                    mine = _integers(np.array(anchors[p][2])) if mine is None else mine
                    scores = (whole @ mine).tolist() if page.dim else [0] * len(page.ids)
                    for s, (least, most) in enumerate(windows[p]):
                        new = [(-x, j) for x, j in zip(scores, page.ids.tolist(), strict=True) if j != anchors[p][0] and (least is None or x >= least) and (most is None or x <= most)]
                        if new:
                            exact[p, s] = sorted(exact.get((p, s), []) + new)[:k]
        for a, best in slim.values():
            slot, score, ids = best.found()
            for at in range(0, len(slot), 8192):
                some = slice(at, at + 8192)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a.place[slot[some] // slots]),
                        pa.array((slot[some] % slots).astype(np.int32)),
                        pa.array(ids[some]),
                        pa.array([str(x) for x in score[some].tolist()], pa.string()),
                        pa.array([sortable(x) for x in score[some].tolist()], pa.binary()),
                    ],
                    schema=FOUND,
                )
        rows = [{"place": p, "slot": s, "vec_id": j, "score": str(-x), "key": sortable(-x)} for (p, s), own in exact.items() for x, j in own]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, FOUND)

    found = pages.mapInArrow(search, "place bigint, slot int, vec_id bigint, score string, key binary")
    order = Window.partitionBy("place", "slot").orderBy(F.desc("key"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its positives, the
    rows of other labels with the highest scores s for which least * p <= 100 * s <= most * p, p being the positive's score.

    An anchor's positives are the rows of its label with the highest scores; ties go to the smaller id. Scores are inner products
    of floor(256 x). Rows with a null id, label or vector, or a component that is null or not finite, take no part, and only
    vectors of the anchor's length are compared with it. A row with the anchor's own id is no candidate. Repeated rows are
    candidates each; a repeated anchor gives its results again. A positive with a negative score has no window. Scores are whole at
    any size; one that is no bigint is null. Empty tables give an empty result. Other columns play no part.

    The anchors are searched in rounds of a fixed number, each against all rows; only a round's anchors and windows are on the driver.
    """
    spark = vectors.sparkSession
    ready(spark)
    rows = stored(usable(vectors, vec_id, label, embedding), "vectors")
    pages, references, sample = build(rows)
    asked = stored(usable(anchors, vec_id, label, embedding), "anchors")
    path = shared_dir(spark, "hard-negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for some in batched(asked.toLocalIterator(), ANCHOR_ROWS):
        block = [(r["vec_id"], r["label"], r["u"]) for r in some]
        best: list[list[tuple[int, int]]] = [[] for _ in block]
        for r in _search(pages, block, references, sample, True, [[(None, None)]] * len(block), positives).orderBy("place", "rank").collect():
            best[r["place"]].append((r["vec_id"], int(r["score"])))
        # whole scores s with least * p <= 100 s <= most * p
        windows = [[(-(-least * p // 100), most * p // 100) for _, p in own] for own in best]
        found = _search(pages, block, references, sample, False, windows, negatives)
        told = [(q, s, block[q][0], i, str(p)) for q, own in enumerate(best) for s, (i, p) in enumerate(own)]
        told = spark.createDataFrame(told, "place bigint, slot int, anchor_id bigint, positive_id bigint, positive_score string")
        number = lambda c: F.col(c).try_cast("bigint").alias(c)
        out = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(F.broadcast(told), ["place", "slot"])
        out.select("anchor_id", "positive_id", "rank", "negative_id", number("positive_score"), number("negative_score")).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS y FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.y, c.y)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.y) = len(c.y) WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, s.vec_id, s.score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
WHERE rank <= 3"""
