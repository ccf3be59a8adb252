"""op11 against a plain version with Python integers, and its tree against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from sessionloom.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int, vec string, code int, error string, of int, part int"


def plain(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error, sha) from sorted (vec_id, vector, label)."""
    whole = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if v and None not in v and all(math.isfinite(x) for x in v)]
    size = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v, _ in whole:
                held[near(v, p)[1]].append(cut(v, p))
            books[p] = [[sum(x) // len(h) for x in zip(*h, strict=True)] if h else e for h, e in zip(held, books[p], strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, [near(v, p) for p in range(parts)], c) for i, v, c in whole]
    total = {}
    for _, n, c in found:
        total[c] = total.get(c, 0) + sum(d for d, _ in n)
    return sorted((str(i), "".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n), total[c], sha) for i, n, c in found)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "v", 1, "e", 2, 3) for i, v, c in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def odd_rows(seed=3, n=300, wide=8):
    rng = random.Random(seed)
    rows = [(i * 3 - 40, [rng.choice([0.0, 0.25, -0.25, rng.gauss(0, 1)]) for _ in range(wide)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[5], rows[5]]  # repeated rows
    bad = [(1, None, 1), (2, [], 1), (3, [float("nan")] * wide, 1), (4, [float("inf")] + [0.0] * (wide - 1), 2), (5, [None] + [0.0] * (wide - 1), None)]
    return rows, bad


def test_as_plain_version_with_bad_rows_ties_and_repeats(spark):
    rows, bad = odd_rows()
    rows.append((None, [0.5] * 8, 2))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got(vectors.compressed(frame(spark, rows + bad), 4, 16, 2)) == plain(order, 4, 16, 2)


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 1.0]) * rng.random() * 10.0 ** rng.randrange(7) for _ in range(4)], 1) for i in range(60)]
    assert got(vectors.compressed(frame(spark, rows), 2, 8, 2)) == plain(rows, 2, 8, 2)
    huge = [(i, [1e15 + i, -1e15, 3.0, 1.0], 1) for i in range(9)]
    assert {r[2] for r in got(vectors.compressed(frame(spark, huge), 2, 4, 1))} == {r[2] for r in plain(huge, 2, 4, 1)}
    with pytest.raises(Exception, match="no exact code"):
        vectors.compressed(frame(spark, [(1, [1e25] * 4, 1)]), 2, 4, 1).collect()


def test_fewer_rows_than_entries_other_lengths_and_none(spark):
    rows = [(2, [0.1, 0.2], 1), (1, [0.3, 0.9], None)]
    assert got(vectors.compressed(frame(spark, [*rows, (3, [1.0] * 4, 1), (4, [1.0], 1)]), 2, 64, 2)) == plain(sorted(rows, key=lambda r: r[0]), 2, 64, 2)
    none = vectors.compressed(frame(spark, [(1, None, 1)]), 2, 4, 1)
    assert none.collect() == [] and vectors.compressed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert none.columns == vectors.compressed(frame(spark, rows), 2).columns


@pytest.mark.parametrize("kind", [np.int64, object])
def test_tree_finds_what_all_distances_find_and_visits_less(kind):
    rng = np.random.default_rng(5)
    for spread in (3, 40, 400):  # a small spread gives many equal distances and equal entries
        entries = rng.integers(-spread, spread, (64, 4)).astype(kind)
        points = np.concatenate([rng.integers(-spread, spread, (500, 4)).astype(kind), entries[:20]])
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=-1)
        tree = vectors.Tree(entries)
        index, squared = tree.nearest(points)
        best = every.min(axis=1)
        assert (squared == best).all()
        assert (index == np.array([np.flatnonzero(e == b)[0] for e, b in zip(every, best, strict=True)])).all()
    assert tree.visited < 0.75 * len(points) * len(entries)


def test_codes_decode_to_entries():
    books = vectors.Codebooks([[(1, 2), (3, 4)], [(5, 6), (7, 8)]], 4)
    assert books.decoded("0100") == [3, 4, 5, 6]
