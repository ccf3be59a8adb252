"""Acceptance that is killed between its tables and done again, and over a stream."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionloom import storage
from sessionloom.operators import accept as V


@pytest.fixture(scope="module")
def context(spark):
    turns = spark.createDataFrame([(f"j{j}", t, 10 * t, 10 * t + 9, f"h{t}", [], []) for j in range(6) for t in (1, 2)], "job_id string, turn_index long, from_line long, to_line long, slice_hash string, quote_ids array<string>, thinking_ids array<string>").cache()
    jobs = spark.createDataFrame([(f"j{j}", True, 0) for j in range(6)], "job_id string, last_window boolean, fails long").cache()
    return turns, jobs, jobs


def body(j):
    blocks = [{"turnIndex": t, "anchor": {"fromLine": 10 * t, "toLine": 10 * t + 9}, "action": f"did {t}", "thoughts": []} for t in ((1, 2) if j % 3 else (1,))]
    return json.dumps({"blocks": blocks})


def told(spark, out):
    made = V.accepted(spark, out)
    return [Counter(tuple(r) for r in made["records"].select("job_id", "turn_index", "slice_hash").collect()), Counter(tuple(r) for r in made["metrics"].select("job_id", "accepted", "blocks", "errors").collect()), Counter(tuple(r) for r in made["ledger"].select("job_id", "ev").collect())]


def test_killed_between_and_repeated(spark, context, tmp_path, monkeypatch):
    out, subs = str(tmp_path / "out"), spark.createDataFrame([(f"j{j}", body(j)) for j in range(6)], "job_id string, body string")
    real = storage.commit
    monkeypatch.setattr(V, "commit", lambda tables, batch: real(tables[:2], batch))  # the ledger is not reached
    V.accept(subs, *context, F.lit("t"), out, "b1")
    assert told(spark, out) == [Counter(), Counter(), Counter()]
    monkeypatch.undo()
    for _ in range(2):
        V.accept(subs, *context, F.lit("t"), out, "b1")
    records, metrics, ledger = told(spark, out)
    assert records == Counter((f"j{j}", t, f"h{t}") for j in (1, 2, 4, 5) for t in (1, 2))
    assert metrics == Counter((f"j{j}", j % 3 > 0, 2 if j % 3 else 0, 0 if j % 3 else 1) for j in range(6))
    assert ledger == Counter((f"j{j}", "submit-ok" if j % 3 else "submit-fail") for j in range(6))


def test_stream_of_submissions(spark, context, tmp_path):
    (tmp_path / "in").mkdir()
    for j in range(6):
        (tmp_path / "in" / f"{j}.json").write_text(json.dumps({"job_id": f"j{j}", "body": body(j)}) + "\n")
    out = str(tmp_path / "out")
    for _ in range(2):  # the second time there is nothing new
        rows = spark.readStream.schema("job_id string, body string").option("maxFilesPerTrigger", 3).json(str(tmp_path / "in"))
        V.accepting(rows, lambda: context, lambda: F.lit("t"), out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    records, metrics, ledger = told(spark, out)
    assert (sum(records.values()), sum(metrics.values()), sum(ledger.values())) == (8, 6, 6)


def test_documents_of_finished_sessions(spark, tmp_path):
    states = spark.createDataFrame([("a", "rendered"), ("b", "no analysis")], "session_key string, state string")
    documents = spark.createDataFrame([("a", "a.md", "# a\n"), ("b", "b.md", "# b\n")], "session_key string, file_name string, markdown string")
    assert [(r.path, r.kept) for r in V.render_final(states, documents, str(tmp_path)).collect()] == [("a.md", False)]
    assert [(r.path, r.kept) for r in V.render_final(states, documents, str(tmp_path)).collect()] == [("a.md", True)]
    assert (tmp_path / "a.md").read_text() == "# a\n" and len(list(tmp_path.iterdir())) == 1
