"""The pipeline's third stage: five words, similarity of 0.8 or more."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sessionloom.llm import simhash

STAGE = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def likeness(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def prints(text):
    return simhash.fingerprint(text.encode(), distinct=True)


def expected(rows):
    """Candidates by distinct words at six bits, then each text in order goes that is like one that stays in its group."""
    label = list(range(len(rows)))
    near = [[(prints(a) ^ prints(b)).bit_count() <= 6 for _, b in rows] for _, a in rows]
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if near[i][j]) for i in range(len(rows))]
    stay = []
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        if not any(label[i] == label[j] and likeness(rows[i][1], rows[j][1]) >= 0.8 for j in stay):
            stay.append(i)
    return {rows[i][0] for i in stay}


def families(seed=2, many=12):
    """Families of texts with one to twenty words changed, and texts apart."""
    rng, rows = random.Random(seed), []
    for f in range(many):
        words = [f"w{f}x{rng.randrange(90)}" for _ in range(80)]
        for _ in range(rng.randrange(1, 9)):
            other = words[:]
            for _ in range(rng.randrange(0, 5)):
                other[rng.randrange(80)] = f"new{rng.randrange(1000)}"
            rows.append((len(rows) * 7 % 1009, " ".join(other)))
    return rows + [(2000, ""), (2001, " "), (2002, "a b"), (2003, "A  B"), (2004, "b a")]


@pytest.mark.parametrize("most,heads", [(1_000_000, 64), (300, 2), (0, 1)])
def test_candidates_are_verified(spark, monkeypatch, most, heads):
    monkeypatch.setattr(simhash, "GROUP_GRAMS", most)
    monkeypatch.setattr(simhash, "HEADS", heads)
    rows = families()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], KIND)
    wanted = expected(rows)
    assert {r.doc_id for r in STAGE(spark, docs, "").collect()} == wanted and 12 < len(wanted) < len(rows) - 10


@pytest.mark.parametrize("radius", [4, 6])
@pytest.mark.parametrize("small", [False, True])
def test_connections_by_brute_force(monkeypatch, radius, small):
    if small:
        monkeypatch.setattr(simhash, "SLICE", 500)
        monkeypatch.setattr(simhash, "LEAF", 1)
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    for _ in range(160):  # walks of a few bits: chains, clusters and what is just too far
        flip = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 9)).astype(np.uint64))
        fps = np.append(fps, rng.choice(fps) ^ flip)
    fps = np.unique(fps)
    root = simhash._connected(fps, np.full(len(fps), radius // 2), fps, 64, radius)
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    for _ in fps:
        label = np.array([label[row].min() for row in near])
    assert root.tolist() == label.tolist() and 10 < len(set(label.tolist())) < len(fps)


def test_one_row_of_a_text(spark):
    rows = [(None, "a b c d e f", "en", "s", 1)] * 3 + [(7, "x y z u v w", "en", "s", 1)] * 2 + [(7, "k l m n o p", "en", "t", 1)]
    got = Counter(r.text for r in STAGE(spark, spark.createDataFrame(rows, KIND), "").collect())
    assert got == Counter({"a b c d e f": 1, "x y z u v w": 1, "k l m n o p": 1})
