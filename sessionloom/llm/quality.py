"""Quality of documents: random-indexing word vectors, pooled per document, and a two-layer network.

A unit is a run of letters, digits or other signs. Its word is one of SLOTS places: eight shapes (lower, capital, upper, mixed
case, digits, one, two or more signs) times a hash of its bytes. Random indexing gives each place a sparse random
vector of -1, 0 and 1; a place's context is the sum of the vectors of the units within REACH of its occurrences, over the
whole texts of all documents: tasks sum up their own texts and Spark adds the sums, so what is gathered grows with
the input while the table of contexts keeps its size. A word vector is the context's mean and the own vector, less
the mean of all, at unit length. A document is the mean and the spread of its units'
vectors, the mean likeness of neighbours, and the number of units.

The network (one hidden layer) learns labels from a bounded sample: MOST_LABELLED labelled documents outside the
held-out fold, those with the smallest hash of their id; a fifth of them sets the temperature that
calibrates its probabilities. It is trained on the driver from the sample's pooled vectors. All documents are scored.

Defined cases: a null or empty text, or one without units, has the pooled vector zero and is scored like any other; a document labelled more
than once has the rounded mean label, null labels count for nothing; of several documents with one id in the sample one stands for
all; without labels of both kinds every score is the smoothed share of label 1 (0.5 without labels); a text of more than
PIECE bytes is read in pieces, cut at a space where there is one, and units in different pieces are no neighbours; documents without an id
are held out; other columns, whatever their names, are not read; repeated rows each get their row; empty tables give no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, written
from .language import held_out

SHAPES, SLOTS, WIDTH, NONZERO, REACH = 8, 1 << 14, 64, 4, 2
PIECE = 1 << 20
MOST_LABELLED = 20_000
HIDDEN, EPOCHS, DECAY = 24, 60, 1e-3
GOOD = 0.3
#: Features of a document: means, spreads, likeness of neighbours at each reach, log of the number of units.
FEATURES = 2 * WIDTH + REACH + 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@functools.lru_cache(1)
def _groups() -> np.ndarray:
    """For each byte: 0 space and controls, 1 letters (and parts of other characters), 2 digits, 3 other signs."""
    kinds = np.full(256, 3, np.uint8)
    kinds[:33] = 0
    kinds[128:] = 1
    for a, b in (("a", "z"), ("A", "Z")):
        kinds[ord(a) : ord(b) + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    return kinds


@functools.lru_cache(1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(place, sign) of the NONZERO components of each slot's random vector."""
    rng = np.random.default_rng(20_240_613)
    places = np.argsort(rng.random((SLOTS, WIDTH)), axis=1)[:, :NONZERO]
    return places, rng.choice(np.array([-1.0, 1.0]), (SLOTS, NONZERO))


def _pieces(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > PIECE:
        cut = text.rfind(b" ", start, start + PIECE) + 1
        cut = cut if cut > start else start + PIECE
        yield text[start:cut]
        start = cut
    yield text[start:]


def _together(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, bytes]]:
    """(documents, bytes) of about PIECE bytes each; a space ends each document's piece; documents are numbered by byte."""
    held, size = [], 0
    for doc, text in enumerate(texts):
        for piece in _pieces(text or b""):
            if held and size + len(piece) > PIECE:
                yield np.repeat([d for d, _ in held], [len(p) + 1 for _, p in held]), b" ".join(p for _, p in held) + b" "
                held, size = [], 0
            held.append((doc, piece))
            size += len(piece) + 1
    if held:
        yield np.repeat([d for d, _ in held], [len(p) + 1 for _, p in held]), b" ".join(p for _, p in held) + b" "


def slots(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(slot, first byte) of the units of a text, in order."""
    raw = np.frombuffer(text, np.uint8)
    group = _groups()[raw]
    edge = np.flatnonzero(np.diff(group, prepend=0, append=0))
    starts, ends = edge[:-1], edge[1:]
    unit = group[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[unit], ends[unit]
    if not len(starts):
        return np.zeros(0, np.int64), starts
    power, back = np.full(len(raw) + 1, _BASE), np.full(len(raw) + 1, _BACK)
    power[0] = back[0] = 1
    power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    mixed = (sums[ends] - sums[starts]) * back[starts]
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    upper = np.concatenate([np.zeros(1, np.int64), np.cumsum((raw >= 65) & (raw <= 90))])
    size, capitals, kind = ends - starts, upper[ends] - upper[starts], group[starts]
    first = (raw[starts] >= 65) & (raw[starts] <= 90)
    letters = np.select([capitals == 0, (capitals == 1) & first, (capitals >= 2) & (2 * capitals >= size)], [0, 1, 2], 3)
    shape = np.select([kind == 1, kind == 2], [letters, 4], 4 + np.minimum(size, 3))
    return shape * (SLOTS // SHAPES) + (mixed >> np.uint64(32)).astype(np.int64) % (SLOTS // SHAPES), starts


def contexts(texts: list[bytes | None]) -> np.ndarray:
    """(SLOTS, 1 + WIDTH) whole numbers: occurrences of each slot, and the sum of the vectors of its neighbours."""
    place, sign = index_vectors()
    out = np.zeros((SLOTS, 1 + WIDTH))
    flat = np.zeros(SLOTS * WIDTH)
    for docs, text in _together(texts):
        slot, start = slots(text)
        doc = docs[start]
        out[:, 0] += np.bincount(slot, minlength=SLOTS)
        for reach in range(1, REACH + 1):
            near = np.flatnonzero(doc[reach:] == doc[:-reach]) if len(doc) > reach else np.zeros(0, np.int64)
            for own, other in ((slot[near], slot[near + reach]), (slot[near + reach], slot[near])):
                for k in range(NONZERO):
                    flat += np.bincount(own * WIDTH + place[other, k], sign[other, k], SLOTS * WIDTH)
    out[:, 1:] = flat.reshape(SLOTS, WIDTH)
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """(SLOTS, WIDTH) unit vectors from the contexts of all documents."""
    place, sign = index_vectors()
    own = np.zeros((SLOTS, WIDTH))
    np.put_along_axis(own, place, sign, axis=1)
    seen = np.maximum(sums[:, :1], 1)
    made = sums[:, 1:] / seen + own
    made -= (made * sums[:, :1]).sum(axis=0) / max(sums[:, 0].sum(), 1)
    return (made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes | None], words: np.ndarray) -> np.ndarray:
    """(documents, FEATURES): mean and spread of the vectors of each text's units, likeness of neighbours, log of the units' number."""
    total, square = np.zeros((len(texts), WIDTH)), np.zeros((len(texts), WIDTH))
    alike, n = np.zeros((len(texts), REACH)), np.zeros(len(texts))
    for docs, text in _together(texts):
        slot, start = slots(text)
        if not len(slot):
            continue
        doc = docs[start]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        vectors = words[slot]
        total[doc[first]] += np.add.reduceat(vectors, first, axis=0)
        for reach in range(1, REACH + 1):
            near = np.einsum("ij,ij->i", vectors[reach:], vectors[:-reach]) * (doc[reach:] == doc[:-reach])
            alike[:, reach - 1] += np.bincount(doc[reach:], near, len(texts))
        np.multiply(vectors, vectors, out=vectors)
        square[doc[first]] += np.add.reduceat(vectors, first, axis=0)
        n += np.bincount(doc, minlength=len(texts))
    many = np.maximum(n, 1)[:, None]
    mean = total / many
    return np.concatenate([mean, np.sqrt(np.maximum(square / many - mean * mean, 0)), alike / many, np.log1p(n)[:, None]], axis=1)


@dataclass
class Network:
    """Standardised features, one hidden layer, one logit, divided by the temperature; or a constant."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def trained(features: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """The network of labelled pooled vectors; every fifth one sets the temperature and is not learned from."""
    none = np.zeros(0)
    if len(set(labels.tolist())) < 2 or min(labels.sum(), len(labels) - labels.sum()) < 5:
        return Network(none, none, none, none, none, 0.0, constant=float((labels.sum() + 1) / (len(labels) + 2)))
    held = np.arange(len(labels)) % 5 == 4
    x, y = features[~held], labels[~held].astype(float)
    rng = np.random.default_rng(seed)
    net = Network(x.mean(axis=0), x.std(axis=0) + 1e-6, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    x = (x - net.mean) / net.scale
    weights = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    size, step = 128, 0
    epochs = max(EPOCHS, 20_000 // max(1, len(y) // size + 1) // 10)
    for epoch in range(epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(y))
        for at in range(0, len(y), size):
            rows = order[at : at + size]
            hidden = np.tanh(x[rows] @ weights[0] + weights[1])
            off = (_sigmoid(hidden @ weights[2] + weights[3]) - y[rows]) / len(rows)
            back = off[:, None] * weights[2] * (1 - hidden * hidden)
            grads = [x[rows].T @ back + DECAY * weights[0], back.sum(axis=0), hidden.T @ off + DECAY * weights[2], off.sum(keepdims=True)]
            step += 1
            for w, g, (m, v) in zip(weights, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(weights[3][0])
    net.temperature = calibrated(net.logits(features[held]), labels[held])
    return net


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        return float(np.logaddexp(0, np.where(labels > 0, -z, z)).mean())

    low, high, ratio = np.log(0.1), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def all_contexts(docs: DataFrame) -> np.ndarray:
    """The contexts over the whole texts of ``docs`` (text): SLOTS rows, whatever the size of the corpus."""
    names = ["slot", *(f"s{i}" for i in range(1 + WIDTH))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SLOTS, 1 + WIDTH))
        for batch in pieces_of(batches, "text", 4 * PIECE):
            total += contexts(batch.column("text").cast(pa.binary()).to_pylist())
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c.astype(np.int64)) for c in total[used].T)], names=names)

    found = docs.select("text").mapInArrow(work, ", ".join(f"{n} long" for n in names)).groupBy("slot").agg(*(F.sum(n).alias(n) for n in names[1:])).toArrow()
    table = np.zeros((SLOTS, 1 + WIDTH))
    table[found.column("slot").to_numpy()] = np.stack([found.column(n).to_numpy() for n in names[1:]], axis=1)
    return table


@dataclass
class Model:
    words: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Word vectors from the texts of all ``docs`` (doc_id, text), the network from at most ``most`` of ``labels`` (doc_id, quality)."""
    words = word_vectors(all_contexts(docs))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    rank = F.xxhash64(F.lit("quality"), F.col("doc_id"))
    sample = known.where(~held_out("doc_id", 0, 5)).join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(rank, "doc_id").limit(most)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 * PIECE):
            made = pooled(batch.column("text").cast(pa.binary()).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([r.tobytes() for r in made], pa.binary())], names=["doc_id", "label", "features"])

    labelled = docs.join(F.broadcast(written(sample)), "doc_id").select("doc_id", "label", "text").mapInArrow(work, "doc_id long, label int, features binary")
    rows = labelled.groupBy("doc_id").agg(F.min("features").alias("features"), F.first("label").alias("label")).orderBy(rank, "doc_id").collect()  # at most ``most``
    features = np.frombuffer(b"".join(r.features for r in rows), np.float64).reshape(-1, FEATURES)
    return Model(words, trained(features, np.array([r.label for r in rows], np.int64)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces_of(batches, "text", 4 * PIECE):
            found = model.network.scores(pooled(batch.column("text").cast(pa.binary()).to_pylist(), model.words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, learned outside the held-out fold."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(own, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")), most)
    return score(own, model).select("doc_id", held_out("doc_id", 0, 5).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
