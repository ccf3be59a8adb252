"""Substring dedup: all marks come from subtrees, and the prefix of a frequent gram is lengthened until its suffixes fit."""

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F
from sessionloom.llm import repeats


def frequent(size):
    """A phrase whose first four words have a very small hash, so that they are the minimizer of every window with them."""
    rng = np.random.default_rng(size)
    best = None
    for _ in range(4_000):
        words = [f"q{x}" for x in rng.integers(0, 1 << 30, 4)]
        value = repeats._gram_hashes(np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in words], np.uint64), 4)[0]
        best = min(best or (value, words), (value, words))
    return best[1] + [f"p{i}" for i in range(size - 4)]


def rows(size, many=150):
    """Texts around one frequent phrase, in contexts of their own; every fifth text repeats an earlier one's."""
    rng, phrase, out = np.random.default_rng(1), frequent(size), []
    for i in range(many):
        front, back = ([f"w{x}" for x in rng.integers(0, 1 << 30, 18)] for _ in range(2))
        if i % 5 == 4:
            old = out[i - 3][1].split()
            front, back = (old[:18], back) if i % 2 else (front, old[-18:])
        out.append((i, " ".join([*front, *phrase, *back])))
    return out


def wanted(texts):
    seen, marks = set(), set()
    for i, t in texts:
        words = t.split()
        for p in range(len(words) - 19):
            key = tuple(words[p : p + 20])
            if key in seen:
                marks.add((i, p))
            seen.add(key)
    return marks


@pytest.mark.parametrize("size,levels", [(4, 2), (14, 3), (16, 3)])
def test_frequent_gram(spark, monkeypatch, size, levels):
    for name, value in {"HOT": 400, "LIMIT": 900, "BATCH_BYTES": 2_000, "LENGTHENED": 7}.items():
        monkeypatch.setattr(repeats, name, value)
    texts = rows(size)
    docs = spark.createDataFrame(texts, "id long, text string").withColumn("tag", F.lit(0).cast("long"))
    found = repeats._rounds(docs, 20, 3)
    assert len(found) == levels
    got = {(r.id, r.start + k) for r in repeats.repeats(docs, 20, 3).collect() for k in range(r.n)}
    assert got == wanted(texts) and got
    # What is left of the frequent prefix in the first round's groups is bounded: all its segments were dealt again.
    assert found[0].where("kind = 2").agg(F.sum("size")).first()[0] > 100 * 20


def test_marks_come_from_subtrees(spark, monkeypatch):
    """Each text is a batch of its own here, so that no repeat is inside a batch: the groups' subtrees find all of them."""
    monkeypatch.setattr(repeats, "BATCH_BYTES", 1)
    texts = rows(5, 40)
    docs = spark.createDataFrame(texts, "id long, text string").withColumn("tag", F.lit(0).cast("long"))
    found = repeats._rounds(docs, 20, 2)
    marks = found[0].where("kind = 1").mapInArrow(repeats._runs, "id long, tag long, start int, n int").collect()
    assert {(r.id, r.start + k) for r in marks for k in range(r.n)} == wanted(texts) and marks
