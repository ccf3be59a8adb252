"""keep_last leaves one row of each text, also where ids repeat or are null."""

from collections import Counter

from sessionloom.llm import exact


def test_one_row_of_each_text(spark):
    rows = [(1, "Ab", "x"), (1, "ab", "y"), (1, "ab", "y"), (None, "none", "p"), (None, "NONE", "q"), (None, "none", "p"), (2, "two", "z"), (3, "two", "z"), (None, "two", "z"), (4, "alone", "z"), (4, "other", "z"), (None, None, "n"), (None, "", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = exact.keep_last(docs).collect()
    assert Counter((r.text or "").lower() for r in kept) == Counter({"ab": 1, "none": 1, "two": 1, "alone": 1, "other": 1, "": 1})
    assert {r.doc_id for r in kept if r.text == "two"} == {3}
    assert {tuple(r) for r in kept} <= set(rows)
