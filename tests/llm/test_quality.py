"""op13: contexts and pooled vectors against plain loops, scores against held-out labels, odd tables."""

import re
import zlib
from collections import Counter

import numpy as np

from sessionloom.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string, label int"


def units(text):
    """Runs of letters (and parts of other characters), of digits and of other signs, one by one."""
    return [m.group() for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x00-\x20A-Za-z0-9\x80-\xff]+", text)]


def one_slot(unit):
    found, _ = quality.slots(unit)
    assert len(found) == 1
    return int(found[0])


TEXTS = [None, b"", b" \n\t", b"one", b"the cat, the CAT; The 42 cats!!! *** a.b", "Über straße 日本 été ÉTÉ".encode(), b"and " * 40, b"x1y2 ** *", b"the cat"]


def test_contexts_and_pooled_vectors_as_plain_loops():
    place, sign = quality.index_vectors()
    sums = np.zeros((quality.SLOTS, 1 + quality.WIDTH))
    rows = [[one_slot(u) for u in units(t or b"")] for t in TEXTS]
    for row in rows:
        for i, s in enumerate(row):
            sums[s, 0] += 1
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(row):
                    for k in range(quality.NONZERO):
                        sums[s, 1 + place[row[j], k]] += sign[row[j], k]
    found = quality.contexts(TEXTS)
    assert (found == sums).all()
    words = quality.word_vectors(found)
    made = quality.pooled(TEXTS, words)
    for row, vector in zip(rows, made, strict=True):
        v = words[row].astype(float) if row else np.zeros((1, quality.WIDTH))
        alike = [sum(float(v[i] @ v[i + r]) for i in range(len(v) - r)) / len(v) for r in (1, 2)]
        assert np.allclose(vector, [*v.mean(axis=0), *v.std(axis=0), *alike, np.log1p(len(row))], atol=2e-3)


def test_equal_units_share_a_slot_and_shapes_never_do():
    shape = quality.SLOTS // quality.SHAPES
    assert one_slot(b"cat") == int(quality.slots(b"a dog cat")[0][2])
    assert [one_slot(u) // shape for u in (b"cat", b"Cat", b"CAT", b"cAt", b"42", b".", b"!!", b"***")] == list(range(8))
    places = Counter(one_slot(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}".encode()) for i in range(600))
    assert max(places.values()) < 6


def test_long_texts_are_read_whole():
    text = ("word " * 300_000 + "tail! ") * 2 + "y" * 2_500_000
    slot = np.concatenate([quality.slots(t)[0] for _, t in quality._together([text.encode()])])
    assert len(slot) - 2 * 300_000 - 4 <= 3 and (slot == one_slot(b"word")).sum() == 600_000
    assert quality.contexts([text.encode()])[one_slot(b"tail"), 0] == 2
    assert "".join(p.decode() for p in quality._pieces(text.encode())) == text


def test_held_out_labels_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in quality.classified(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    held = [(found[r.doc_id].score, r.quality) for r in labels.collect() if found[r.doc_id].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.99
    assert np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s < 0.3 for s in bad]) > 0.85
    loss = -np.mean([np.log(s if q else 1 - s) for s, q in ((min(max(s, 1e-9), 1 - 1e-9), q) for s, q in held)])
    assert loss < 0.08  # probabilities, not only an order


def test_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(-20, 1, 0, "t", 1), (-13, None, 0, "t", 1), (None, 1, 0, "t", 1), (-6, 0, 0, "t", 1), (-6, 1, 0, "t", 1)], LABELS)
    few = quality.classified(odd, labels).collect()
    assert len(few) == odd.count() and len({r.score for r in few}) == 1
    assert [r.held_out for r in few if r.doc_id is None] == [True]
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.classified(odd, none).collect()} == {0.5}
    assert quality.classified(empty, labels).collect() == []


def test_the_same_text_has_the_same_score_and_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    told = quality.classified(docs.union(docs.selectExpr("doc_id + 100000", "text", "lang", "source", "n_chars")), labels)
    scores = {r.doc_id: r.score for r in told.collect()}
    assert all(abs(scores[i] - scores[i + 100000]) < 1e-9 for i in range(1000))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    plain = {r.doc_id: r.score for r in quality.classified(docs, labels).collect()}
    assert plain == {r.doc_id: r.score for r in quality.classified(docs, turned).collect()}


def test_temperature_brings_the_loss_down():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(int)
    assert abs(quality.calibrated(z * 3, labels) - 3) < 0.4
