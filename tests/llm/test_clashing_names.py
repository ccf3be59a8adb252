"""Stages over frames whose columns are called like helpers, in any case, and with maps."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import exact, mixing, simhash

NAMES = [
    "mix_source", "_mix_source", "MIX_BLOCK", "_mix_cdf", "mix_blocks", "mix_count", "mix_before", "mix_draws", "print", "_print", "_digest", "keep", "_Keep", "row", "_row", "tag", "_tag", "key", "copy", "shuffle_key", "fp", "grp", "place", "a b", "",
]


@pytest.fixture(scope="module")
def clashing(spark):
    text = "One two three four five six seven eight nine ten. "
    rows = [(i, [text * 3, text * 3 + "x", text * 3, None, "", "other words here", text.upper() * 3][i % 7], "en", f"s{i % 2}" if i % 5 else None, 9) for i in range(40)] + [(103, None, "en", None, 9), (None, text, None, "s1", None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return made.select("*", *(F.lit(f"own {n}").alias(n) for n in NAMES if n), F.create_map(F.lit("k"), F.col("source")).alias("m")).cache()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_hand_on_all_columns(spark, clashing, stage):
    made = stage(spark, clashing, "")
    assert made.columns == clashing.columns and made.dtypes == clashing.dtypes
    rows = made.collect()
    assert rows and all(r[n] == f"own {n}" for r in rows for n in NAMES if n) and all(set(r["m"]) == {"k"} for r in rows)
    plain = ("doc_id", "text", "lang", "source", "n_chars")
    key = lambda rows: Counter(tuple(r[c] for c in plain) for r in rows)
    assert key(rows) == key(stage(spark, clashing.select(*plain), "").collect())


def test_the_stages_on_no_rows(spark, clashing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing.limit(0), "").collect() == []


def test_copies_take_the_names_asked_for(clashing):
    made = mixing.mixed(clashing, copy_col="n", key_col="k2")
    assert made.columns == [*clashing.columns, "n", "k2"]
    assert mixing.mixed(clashing).columns == [*(c for c in clashing.columns if c not in ("copy", "shuffle_key")), "copy", "shuffle_key"]


def test_rows_that_differ_in_a_map_alone(spark):
    rows = [(1, "same text of some words here", {"a": "1"}), (1, "same text of some words here", {"a": "2"})]
    made = spark.createDataFrame(rows, "doc_id long, text string, m map<string,string>")
    for keep in (exact.keep_last, simhash.keep_first):
        one = keep(made).collect()
        assert len(one) == 1 and one == keep(made.repartition(4)).collect()
