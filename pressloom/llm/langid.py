"""Language ID by a bidirectional gated recurrent network over bytes, trained here by backpropagation through time.

A text is cut into windows of 128 bytes; the states start at zero in each, so every byte of a text is labelled, however
long it is, and windows of many texts run side by side. In each direction, with the byte's table row x and the state h:

    (z, c) = squash(x + h U),   gate g = (1 + z) / 2,   h' = h + g (c - h),   squash(v) = v / (1 + |v|)

A position's probabilities are the softmax over both directions' states; a text's are the mean over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from pressloom.llm.tables import only, ready
from pressloom.llm.textbytes import ranges, slices

WINDOW = 128
PAD = 256
UNKNOWN = "und"
#: windows that run side by side; their states stay in the processor's cache
LANES = 2048


@dataclass
class Network:
    """Parameters by name, and the languages of the output."""

    languages: list[str]
    values: dict[str, np.ndarray]

    @classmethod
    def start(cls, languages: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        values = {}
        for way in ("forward", "backward"):
            values[f"{way}_x"] = rng.normal(0, 0.5, (PAD + 1, 2 * hidden))
            values[f"{way}_u"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
            values[f"{way}_o"] = rng.normal(0, hidden**-0.5, (hidden, len(languages)))
        values["bias"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in values.items()})

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """(time, lanes, languages) before the softmax, for codes (time, lanes)."""
        v, (steps, lanes) = self.values, codes.shape
        out = np.empty((steps, lanes, len(self.languages)), np.float32)
        out[:] = v["bias"]
        hidden = v["forward_u"].shape[0]
        x, a, d = (np.empty((lanes, w), np.float32) for w in (2 * hidden, 2 * hidden, hidden))
        part = np.empty((lanes, len(self.languages)), np.float32)
        for way, times in (("forward", range(steps)), ("backward", range(steps - 1, -1, -1))):
            h = np.zeros((lanes, hidden), np.float32)
            table, u, o = v[f"{way}_x"], v[f"{way}_u"], v[f"{way}_o"]
            for t in times:
                np.matmul(h, u, out=x)
                x += table[codes[t]]
                np.abs(x, out=a)
                a += 1
                x /= a
                z = x[:, :hidden]
                z += 1
                z *= 0.5
                np.subtract(x[:, hidden:], h, out=d)
                d *= z
                h += d
                np.matmul(h, o, out=part)
                out[t] += part
        return out

    def gradient(self, codes: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the positions that hold a byte, and its gradient, back through all time steps."""
        v, (steps, lanes) = self.values, codes.shape
        hidden = v["forward_u"].shape[0]
        kept = {}
        logits = np.broadcast_to(v["bias"], (steps, lanes, len(self.languages))).copy()
        ways = {"forward": range(steps), "backward": range(steps - 1, -1, -1)}
        for way, times in ways.items():
            h = np.zeros((lanes, hidden), np.float32)
            states = []
            for t in times:
                pre = v[f"{way}_x"][codes[t]] + h @ v[f"{way}_u"]
                squash = pre / (1 + np.abs(pre))
                gate, new = (1 + squash[:, :hidden]) / 2, squash[:, hidden:]
                states.append((h, pre, gate, new))
                h = h + gate * (new - h)
                logits[t] += h @ v[f"{way}_o"]
            kept[way] = (states, h)
        probability = np.exp(logits - logits.max(axis=2, keepdims=True))
        probability /= probability.sum(axis=2, keepdims=True)
        real = codes != PAD
        n = real.sum()
        loss = -float(np.log(probability[:, np.arange(lanes), label] + 1e-9)[real].sum() / n)
        delta = probability
        delta[:, np.arange(lanes), label] -= 1
        delta *= (real / n)[:, :, None].astype(np.float32)
        grads = {k: np.zeros_like(x) for k, x in v.items()}
        grads["bias"] = delta.sum(axis=(0, 1))
        for way, times in ways.items():
            states, last = kept[way]
            u, o = v[f"{way}_u"], v[f"{way}_o"]
            back = np.zeros((lanes, hidden), np.float32)
            after = last
            for t, (h, pre, gate, new) in zip(reversed(times), reversed(states), strict=True):
                back = back + delta[t] @ o.T
                grads[f"{way}_o"] += after.T @ delta[t]
                slope = 1 / (1 + np.abs(pre)) ** 2
                d_pre = np.concatenate((back * (new - h) / 2, back * gate), axis=1) * slope
                grads[f"{way}_u"] += h.T @ d_pre
                np.add.at(grads[f"{way}_x"], codes[t], d_pre)
                back = back * (1 - gate) + d_pre @ u.T
                after = h
        return loss, grads


def windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of shape (window, WINDOW) padded with PAD, row of each window)."""
    count = -(-np.diff(bounds) // WINDOW)
    row = np.repeat(np.arange(len(count)), count)
    start = bounds[row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    size = np.minimum(WINDOW, bounds[row + 1] - start)
    codes = np.full((len(row), WINDOW), PAD, np.int16)
    codes[np.arange(WINDOW) < size[:, None]] = data[ranges(start, size)]
    return codes, row


def fit(texts: list[bytes], languages: list[str], hidden: int = 16, steps: int = 256, batch: int = 256, rate: float = 0.01, seed: int = 7, per_text: int = 4) -> Network:
    """Train by so many steps of Adam on up to `per_text` windows of each text, spread over it."""
    names = sorted(set(languages))
    rng = np.random.default_rng(seed)
    codes, label = [], []
    for text, language in zip(texts, languages, strict=True):
        own, _ = windows(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        own = own[np.unique(np.linspace(0, len(own) - 1, min(per_text, len(own))).astype(int))] if len(own) else own
        codes.append(own)
        label += [names.index(language)] * len(own)
    network = Network.start(names, hidden, seed)
    if not label or len(names) < 2:
        return network
    codes, label = np.concatenate(codes), np.array(label)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.values.items()}
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(label))
        part, order = order[:batch], order[batch:]
        _, grads = network.gradient(np.ascontiguousarray(codes[part].T), label[part])
        size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads.values()))
        slower = rate * 0.05 ** (step / steps)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m, s = moments[k]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            network.values[k] -= (slower * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def pooled(network: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, languages) mean probabilities over all positions of each row; zero for an empty row."""
    codes, row = windows(data, bounds)
    total = np.zeros((len(bounds) - 1, len(network.languages)))
    for at in range(0, len(row), LANES):
        part = codes[at : at + LANES]
        scores = network.scores(np.ascontiguousarray(part.T))
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        real = part != PAD
        if real.all():
            own = scores.sum(axis=0)
        else:
            own = np.einsum("tlk,lt->lk", scores, real.astype(np.float32))
        np.add.at(total, row[at : at + LANES], own)
    return total / np.maximum(np.diff(bounds), 1)[:, None]


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each row has a letter (Unicode category L)."""
    seen = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
    out = seen[bounds[1:]] > seen[bounds[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in data[bounds[i] : bounds[i + 1]].tobytes().decode())
    return out


def training_rows(documents: DataFrame, per_language: int, max_languages: int, text: str, lang: str, doc_id: str) -> list:
    """At most `per_language` rows of each of the `max_languages` most frequent languages, chosen by the hash of the id.

    Rows with crc32(doc_id) mod 4 = 2, a null id, language or text take no part.
    """
    rows = only(documents, doc_id=doc_id, lang=lang, text=text).where(
        "lang IS NOT NULL AND text IS NOT NULL AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 <> 2"
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return []
    # a threshold on the hash leaves about twice as many as are wanted, so that only these are ranked
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2 * per_language / r["count"]))])
    hashed = rows.withColumn("u", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31))
    few = hashed.where(F.col("u") < F.try_element_at(share, "lang"))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY u, doc_id, text)")
    return few.withColumn("n", rank).where(F.col("n") <= per_language).select("lang", F.col("text").cast("binary").alias("text")).orderBy("lang", "n").collect()


def train(documents: DataFrame, per_language: int = 512, max_languages: int = 64, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Network:
    """A network fitted on the driver on `training_rows`, a bounded sample."""
    rows = training_rows(documents, per_language, max_languages, text, lang, doc_id)
    return fit([bytes(r["text"]) for r in rows], [r["lang"] for r in rows])


def identify(documents: DataFrame, network: Network, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows of `documents` with `lang_pred` and `score`, the pooled probability; the text comes along only on request.

    A null text or one without a letter is `und` with score 0; with a network of no language all are. Only the text is
    looked at. Columns named like the new ones are replaced, others stay; repeated rows have equal results.
    """
    ready(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(network)
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in (text, "lang_pred", "score")]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network = shared.value
        names = np.array([*net.languages, UNKNOWN], object)
        for batch in batches:
            for first, stop, data, bounds in slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(first, stop - first)
                best = np.full(stop - first, len(names) - 1)
                score = np.zeros(stop - first)
                if len(net.languages):
                    probability = pooled(net, data, bounds)
                    known = has_letter(data, bounds)
                    best[known] = probability[known].argmax(axis=1)
                    score[known] = np.minimum(probability[known].max(axis=1), 1.0)
                last = part.num_columns - (not keep_text)
                columns = [*part.columns[:last], pa.array(names[best], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:last], "lang_pred", "score"])

    rows = documents.select(*kept, F.col(f"`{text}`"))
    schema = (rows if keep_text else rows.drop(text)).schema
    return rows.mapInArrow(label, StructType([*schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
