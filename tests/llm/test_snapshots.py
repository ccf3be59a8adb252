"""Snapshots of exact dedup that are kept by name, and the path for keys that outgrow a broadcast."""

from collections import Counter

import pytest
from sessionloom.llm import exact


def test_snapshot_is_loaded_and_screens(spark, tmp_path):
    old = spark.createDataFrame([(1, "Ab"), (2, "two"), (3, None)], "doc_id long, text string")
    exact.save_snapshot(old, f"{tmp_path}/snap")
    new = spark.createDataFrame([(5, "aB", "x"), (6, "other", "y"), (7, "", "z"), (6, "other", "y")], "doc_id long, text string, key string")
    left = exact.new_rows(new, exact.load_snapshot(spark, f"{tmp_path}/snap"))
    assert left.columns == new.columns and Counter(map(tuple, left.collect())) == Counter({(6, "other", "y"): 2})


@pytest.mark.parametrize("most", [0, 40_000_000])
def test_same_groups_with_and_without_a_broadcast(spark, monkeypatch, documents, odd, most):
    monkeypatch.setattr(exact, "MOST_SENT", most)
    for docs in (documents, odd):
        rows = [(r.doc_id, (r.text or "").lower() if (r.text or "").isascii() else r.text) for r in docs.collect()]
        sizes = Counter(t for _, t in rows)
        assert Counter(r.group_size for r in exact.exact_groups(docs).collect()) == Counter(sizes[t] for _, t in rows)
        assert exact.keep_last(docs).count() == len(sizes)
