"""Queries over whole texts, against brute force."""

import pytest

import __spark_entry__ as driver


def fold(text):
    h, b = 2166136261, 16777619
    for i, c in enumerate(map(ord, text), 1):
        h = ((h ^ c) * 16777619) & 0xFFFFFFFF
        b = (b + c * i) % (1 << 32) * 2246822507 % (1 << 32)
    return f"{h:x}{b:x}"


@pytest.mark.parametrize("tails", [("x", "y"), ("", "é" * 4000)])
def test_slice_hash_reads_past_300_characters(spark, tmp_path, tails):
    texts = ["word " * 80 + t for t in tails]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.turn: r.h for r in driver.queries()["slice_hash_whole"](spark, str(tmp_path)).collect()}
    assert got == {i: fold(t) for i, t in enumerate(texts)} and len(set(got.values())) == 2
