"""Language ID as a mixture of languages, fitted per document by expectation-maximisation.

The model of a language is the distribution of its character trigrams (letters lowered, runs of anything else one
gap), hashed to FEATURES places and smoothed. A document's trigrams are taken as drawn from a mixture of
languages; EM estimates the proportions, and a penalised likelihood (half the log of the number of trigrams for each
language more) decides which languages the document holds: from the best single language on, the learned language
that gains most is added, and then any dropped that the likelihood does not miss, one at a time, until the penalised
likelihood stops improving. No language is left out beforehand. The prediction is the largest of these.

Training reads a bounded sample: PER_LANGUAGE labelled rows of each language in expectation, whole texts, drawn by a
hash of the id; all rows are predicted.

Every language with a label is learned. The table of a model holds TABLE chances at most: beyond TABLE / FEATURES (256) languages
trigrams are hashed to fewer places.

Defined cases: null text or text without a letter: ``und`` with score 0; no labelled row: every row is ``und``; null
languages are not learned; of languages with equal shares the first in name order is predicted; repeated rows each get their
row; very long texts are counted whole; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces_of

FEATURES, TABLE = 1 << 16, 1 << 24
PER_LANGUAGE = 1_500
ROUNDS = 12
#: Trigrams times languages of one group of documents that are tried together.
TRIED_AT_ONCE = 4_000_000


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of a text, in order; none if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.uint16)
    points = np.where(letter, points, 0)
    gap = points == 0
    points = points[~(gap & np.r_[False, gap[:-1]])].astype(np.uint64)
    points = np.concatenate([np.zeros(1, np.uint64), points, np.zeros(1, np.uint64)])
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA77) + points[2:]
    mixed = (mixed ^ mixed >> np.uint64(15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(48)).astype(np.uint16)


@dataclass
class LanguageModel:
    """names[i] has the trigram distribution chance[:, i]; rows: hashed trigrams, or their leading bits."""

    names: list[str]
    chance: np.ndarray

    def mixtures(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """(language, its share, all languages of the selected set with shares) of each text."""
        shift = 16 - (len(self.chance).bit_length() - 1)
        grams = [np.unique(trigrams(t) >> shift, return_counts=True) for t in texts]
        size = np.array([len(u) for u, _ in grams])
        out: list = [("und", 0.0, [])] * len(texts)
        known = np.flatnonzero(size)
        if not len(known) or not self.names:
            return out
        share = np.zeros((len(known), len(self.names)))
        ends = np.cumsum(size[known])
        most = max(1, TRIED_AT_ONCE // len(self.names))
        start = 0
        while start < len(known):
            below = ends[start] - size[known[start]]
            stop = max(start + 1, int(np.searchsorted(ends, below + most, side="right")))
            share[start:stop] = self._shares([grams[i] for i in known[start:stop]])
            start = stop
        for row, i in enumerate(known):
            order = np.argsort(-share[row], kind="stable")
            found = [(self.names[j], float(share[row, j])) for j in order if share[row, j] > 0]
            out[i] = (found[0][0], min(1.0, found[0][1]), found)
        return out

    def _shares(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Shares (document, language) of the language sets that the penalised likelihood selects."""
        every = _Documents(self.chance[np.concatenate([u for u, _ in grams])], np.concatenate([n for _, n in grams]), np.array([len(u) for u, _ in grams]))
        alone = np.add.reduceat(np.log(every.chance, dtype=np.float64) * every.times[:, None], every.starts, axis=0)
        share = np.zeros(alone.shape)
        share[np.arange(len(grams)), alone.argmax(axis=1)] = 1
        score = alone.max(axis=1)
        fee = 0.5 * np.log(every.total)
        open_ = np.arange(len(grams)) if alone.shape[1] > 1 else np.zeros(0, np.int64)
        while len(open_):
            docs = every.of(open_)
            part, gain = docs.added(share[open_])
            gain[share[open_] > 0] = -np.inf
            new = gain.argmax(axis=1)
            row = np.arange(len(open_))
            taken = np.clip(part[row, new], 1e-6, 1 - 1e-6)
            tried = share[open_] * (1 - taken)[:, None]
            tried[row, new] = taken
            tried = docs.fitted(tried)
            reached = docs.likelihood(tried) - fee[open_] * ((tried > 0).sum(axis=1) - 1)
            better = np.isfinite(gain[row, new]) & (reached > score[open_])
            open_ = open_[better]
            share[open_], score[open_] = tried[better], reached[better]
            self._dropped(every, open_, share, score, fee)
        return share

    def _dropped(self, every: _Documents, those: np.ndarray, share: np.ndarray, score: np.ndarray, fee: np.ndarray) -> None:
        """Drops from the sets of ``those`` documents, in place, one language at a time while that improves the score."""
        those = those[(share[those] > 0).sum(axis=1) > 2]
        while len(those):
            best, found = score[those].copy(), share[those]
            for j in np.flatnonzero((share[those] > 0).any(axis=0)):
                row = np.flatnonzero(share[those, j] > 0)
                docs, tried = every.of(those[row]), share[those[row]]
                tried[:, j] = 0
                tried = docs.fitted(tried / tried.sum(axis=1, keepdims=True))
                reached = docs.likelihood(tried) - fee[those[row]] * ((tried > 0).sum(axis=1) - 1)
                win = reached > best[row]
                best[row[win]], found[row[win]] = reached[win], tried[win]
            better = best > score[those]
            share[those[better]], score[those[better]] = found[better], best[better]
            those = those[better]
            those = those[(share[those] > 0).sum(axis=1) > 2]


class _Documents:
    """Trigrams of several documents, one after the other: chance (trigram, language) and how often each occurs."""

    def __init__(self, chance: np.ndarray, times: np.ndarray, size: np.ndarray):
        self.chance, self.times, self.size = chance, times.astype(np.float32), size
        self.starts = np.cumsum(size) - size
        self.doc = np.repeat(np.arange(len(size)), size)
        self.total = np.add.reduceat(self.times, self.starts, dtype=np.float64)

    def of(self, docs: np.ndarray) -> _Documents:
        if len(docs) == len(self.size):
            return self
        inside = np.zeros(len(self.size), bool)
        inside[docs] = True
        own = inside[self.doc]
        return _Documents(self.chance[own], self.times[own], self.size[docs])

    def mixed(self, share: np.ndarray) -> np.ndarray:
        return np.einsum("fl,fl->f", self.chance, share.astype(np.float32)[self.doc])

    def likelihood(self, share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.log(self.mixed(share), dtype=np.float64) * self.times, self.starts)

    def fitted(self, share: np.ndarray) -> np.ndarray:
        """Shares after ROUNDS of EM."""
        for _ in range(ROUNDS):
            weight = self.times / self.mixed(share)
            share = share * np.add.reduceat(self.chance * weight[:, None], self.starts, axis=0) / self.total[:, None]
        return share / share.sum(axis=1, keepdims=True)

    def added(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each document and language: the share, about, at which it gains most beside the mixture as it is, and the gain."""
        ratio = self.chance / self.mixed(share)[:, None]
        useful = np.add.reduceat(ratio * self.times[:, None], self.starts, axis=0) > self.total[:, None]
        part = np.where(useful, 0.1, 0.0)
        for _ in range(ROUNDS):
            now = part.astype(np.float32)[self.doc]
            grown = ratio / (1 + now * (ratio - 1)) * self.times[:, None]
            part = np.clip(part * np.add.reduceat(grown, self.starts, axis=0) / self.total[:, None], 0, 1)
        gain = np.add.reduceat(np.log1p(part[self.doc] * (ratio - 1.0)) * self.times[:, None], self.starts, axis=0)
        return part, np.where(useful, gain, -np.inf)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The model of all languages in ``labelled`` from a sample of about ``per_language`` rows of each."""
    spark = labelled.sparkSession
    sizes = labelled.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).cast("string").alias("lang")).count()
    sizes = [tuple(r) for r in sizes.collect()]  # a row for each language that the model is of
    names = sorted(r[0] for r in sizes)
    shift = max(0, min(8, (len(names) - 1).bit_length() - (TABLE // FEATURES).bit_length() + 1))
    if not names:
        return LanguageModel([], np.ones((FEATURES, 0), np.float32))
    place = {n: i for i, n in enumerate(names)}
    parts = spark.createDataFrame([(place[n], n, min(1.0, per_language / c)) for n, c in sizes], "place int, name string, part double")
    drawn = F.pmod(F.xxhash64(F.lit("language"), F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.join(F.broadcast(parts), F.col(lang_col).cast("string") == F.col("name")).where(drawn < F.col("part")).select("place", F.col(text_col).cast("string").alias("text"))
    many = len(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 1 << 20):
            places = batch.column("place").to_pylist()
            found = [np.int64(i) << 16 | (trigrams(t) >> shift) for i, t in zip(places, batch.column("text").to_pylist(), strict=True)]
            key, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((key >> 16).astype(np.int32)), pa.array((key & 0xFFFF).astype(np.int32)), pa.array(n)], names=["place", "feature", "n"])

    counts = sample.mapInArrow(count, "place int, feature int, n long").groupBy("place", "feature").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((FEATURES >> shift, many), np.float32)
    table[counts.column("feature").to_numpy(), counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    chance = (table + 0.05) / (table.sum(axis=0, dtype=np.float64) + 0.05 * len(table))
    return LanguageModel(names, chance.astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages array<struct<lang, share>>) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in pieces_of(batches, "text", 1 << 20):
            found = shared.value.mixtures(batch.column("text").to_pylist())
            sets = [[{"lang": n, "share": s} for n, s in x[2]] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(sets, kind)], names=["doc_id", "lang_pred", "score", "languages"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Is crc32(id as text) mod ``folds`` equal to ``fold``? Rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def identified(docs: DataFrame) -> DataFrame:
    """Predicts every row of ``docs`` from a model learned outside the held-out fold: (doc_id, held_out, lang_pred, score, languages)."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all its columns) in which the model finds a language; ``und`` rows go."""
    model = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 1 << 20):
            found = shared.value.mixtures(batch.column("text").cast(pa.string()).to_pylist())
            yield batch.filter(pa.array([x[0] != "und" for x in found], pa.bool_()))

    return docs.mapInArrow(flag, docs.schema)
