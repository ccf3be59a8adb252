"""Submissions of windows and sessions on small hand-made cases."""

import json

from pyspark.sql import functions as F

from sessionloom.operators import contracts as C
from sessionloom.operators import submissions as B

TURNS = "job_id string, turn_index bigint, from_line bigint, to_line bigint, quote_ids array<string>, thinking_ids array<string>, slice_hash string"


def block(i, first, last, thoughts=(), **more):
    return {"turnIndex": i, "anchor": {"fromLine": first, "toLine": last}, "action": f"a{i}", "thoughts": list(thoughts)} | more


def verdict(spark, blocks, last_window=True, **body):
    turns = spark.createDataFrame([("j", 1, 1, 3, ["q1"], [], "h1"), ("j", 2, 4, 6, ["q2"], [], "h2"), ("j", 3, 7, 9, ["q3"], ["q3"], "h3")], TURNS)
    subs = spark.createDataFrame([("j", json.dumps({"blocks": blocks} | body))], "job_id string, body string")
    jobs = spark.createDataFrame([("j", last_window)], "job_id string, last_window boolean")
    made = B.window_blocks(subs, turns)
    verdicts = B.window_verdicts(subs, turns, made, jobs)
    return verdicts.first(), B.sidecar_records(made, verdicts).orderBy("turn_index").collect()


THOUGHT = {"kind": "H", "source": "thinking", "text": "t", "q": "q3"}


def test_merged_turns_leave_a_record_each(spark):
    said, records = verdict(spark, [block(1, 1, 6), block(3, 7, 9, [THOUGHT], fallback=True)])
    assert said.accepted and said.errors == []
    assert [(r.turn_index, r.slice_hash, json.loads(r.result)["action"], r.fallback) for r in records] == [(1, "h1", "a1", False), (2, "h2", "a1", False), (3, "h3", "a3", True)]


def test_merging_rules(spark):
    said, records = verdict(spark, [block(1, 1, 3), block(2, 4, 9, [THOUGHT])])
    assert not said.accepted and records == []
    assert said.errors == ["turn 2: merges turns with thinking; merged turns can't have thoughts"]


def test_overlap_missing_and_odd_blocks(spark):
    said, _ = verdict(spark, [block(1, 1, 3), block(1, 1, 6), block(9, 20, 30), {"turnIndex": "x"}, 5], last_window=False)
    assert said.errors == ["turn 1: covers a turn again", "turn 9: covers no turn", "turn ?: turnIndex is no integer; anchor is no pair of integers", "turn ?: turnIndex is no integer; anchor is no pair of integers", "no block for turn 3", "digest missing"]
    said, _ = verdict(spark, [block(1, 1, 3), block(2, 4, 6), block(3, 7, 9, [THOUGHT])], digest={"goal": "g"})
    assert said.errors == ["digest: openHypotheses is no array", "digest: currentBelief missing"]
    assert verdict(spark, [])[0].errors == ["no blocks"] and verdict(spark, 4)[0].errors == ["no blocks"]


def test_unknown_quote_and_empty_tables(spark):
    said, _ = verdict(spark, [block(1, 1, 3), block(2, 4, 6), block(3, 7, 9, [THOUGHT | {"q": "q1"}])])
    assert said.errors == ["turn 3: thoughts[0].q is no quote of the turn"]
    subs = spark.createDataFrame([("j", None)], "job_id string, body string")
    none = spark.createDataFrame([], TURNS)
    jobs = spark.createDataFrame([], "job_id string, last_window boolean")
    assert B.window_verdicts(subs, none, B.window_blocks(subs, none), jobs).first().errors == ["no JSON object"]


def test_release_behind_the_twentieth_rejection(spark):
    verdicts = spark.createDataFrame([("a", False, ["e"]), ("b", False, ["e"]), ("c", True, [])], "job_id string, accepted boolean, errors array<string>")
    states = spark.createDataFrame([("a", 18), ("b", 19), ("c", 30)], "job_id string, fails bigint")
    assert sorted((r.job_id, r.ev) for r in B.ledger_events(verdicts, states, F.lit("t")).collect()) == [("a", "submit-fail"), ("b", "release"), ("b", "submit-fail"), ("c", "submit-ok")]


def test_typed_answers(spark):
    digest = '{"goal":"g","openHypotheses":[{"text":"h"}],"currentBelief":"b","checkpoint":{"intent":"i"}}'
    analysis = '{"arcs":[],"verdict":{"status":"success","why":"w"},"items":[{"title":"t"}]}'
    row = spark.range(1).select(C.as_digest(F.lit(digest)).alias("d"), C.as_digest(F.lit('{"goal":"g"}')).alias("bare"), C.as_analysis(F.lit(analysis)).alias("a"), C.as_block(F.lit("{bad")).alias("b")).first()
    assert (row.d.checkpoint.intent, row.d.checkpoint.files, row.bare.checkpoint) == ("i", "", None)
    assert row.a["items"][0].subject == [] and row.a["items"][0].evidence == []
