"""One row of a rare source that fills a large share of a large mix."""

from sessionloom.llm import mixing


def test_one_row_many_times(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a", "rare"), (2, "b", "other"), (3, "c", "other")], "doc_id long, text string, source string")
    targets = {"rare": 0.5, "other": 0.5}
    whole = [tuple(r) for r in mixing.mixed(docs, targets, 60_000).collect()]
    monkeypatch.setattr(mixing, "BLOCK", 7)
    assert [tuple(r) for r in mixing.mixed(docs, targets, 60_000).collect()] == whole
    copies = sorted(r[3] for r in whole if r[0] == 1)
    assert copies == list(range(1, len(copies) + 1)) and abs(len(copies) - 30_000) < 1_000
