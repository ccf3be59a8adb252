"""What workers hand in for a window or a session: is it right, the records it leaves and the events of the ledger.

All joins are on job_id; what is gathered in one row is one window's turns or one submission's messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import contracts as C

#: Rejections since the last claim after which a job is released.
MOST_REJECTIONS = 20


def _bodies(submissions: DataFrame) -> DataFrame:
    return submissions.withColumn("value", F.try_parse_json(T.extract_json_object(F.col("body"))))


def window_blocks(submissions: DataFrame, turns: DataFrame) -> DataFrame:
    """(job_id, pos, turn_index, block, covered, errors): the blocks of submissions (job_id, body) against the turns of their windows
    (job_id, turn_index, from_line, to_line, quote_ids, thinking_ids, ...).

    A block covers the turns inside its anchor, must begin and end with them and share none with an earlier block. More than one turn
    may only be merged if none holds thinking, and then without thoughts; a turn with thinking needs a thought.
    """
    windows = turns.groupBy("job_id").agg(F.sort_array(F.collect_list(F.struct("from_line", *(c for c in turns.columns if c not in ("job_id", "from_line"))))).alias("turns"))
    blocks = _bodies(submissions).select("job_id", F.posexplode(C.list_at(F.col("value"), "blocks")).alias("pos", "block"))
    own = blocks.select("*", C.whole_at(F.col("block"), "turnIndex").alias("turn_index"), C.whole_at(F.col("block"), "anchor.fromLine").alias("b_from"), C.whole_at(F.col("block"), "anchor.toLine").alias("b_to"))
    rows = own.join(windows, "job_id", "left").withColumn("covered", F.filter("turns", lambda t: (t["from_line"] >= F.col("b_from")) & (t["to_line"] <= F.col("b_to")))).drop("turns")
    edge = lambda i: F.try_element_at("covered", F.lit(i))
    rows = rows.withColumn("aligned", F.coalesce((edge(1)["from_line"] == F.col("b_from")) & (edge(-1)["to_line"] == F.col("b_to")), F.lit(False)))

    held = rows.where("aligned").select("job_id", "pos", F.explode("covered.turn_index").alias("t"))
    again = held.withColumn("_n", F.row_number().over(Window.partitionBy("job_id", "t").orderBy("pos"))).where("_n > 1").select("job_id", "pos").distinct().withColumn("again", F.lit(True))
    rows = rows.join(again, ["job_id", "pos"], "left")

    thoughts = F.size(C.list_at(F.col("block"), "thoughts"))
    thinks = F.exists("covered", lambda t: F.size(t["thinking_ids"]) > 0)
    merged = F.size("covered") > 1
    rules = C.messages([(merged & thinks, "merges turns with thinking"), (merged & (thoughts > 0), "merged turns can't have thoughts"), (~merged & thinks & (thoughts == 0), "thinking without a thought")])
    quoted = F.array_distinct(F.flatten("covered.quote_ids"))
    placed = C.messages([(F.col("turn_index").isNull(), "turnIndex is no integer"), (F.col("b_from").isNull() | F.col("b_to").isNull(), "anchor is no pair of integers")])
    errors = (
        F.when(F.size(placed) > 0, placed).when(F.coalesce(F.size("covered"), F.lit(0)) < 1, F.array(F.lit("covers no turn"))).when(~F.col("aligned"), F.array(F.format_string("must cover whole turns, lines %d to %d", edge(1)["from_line"], edge(-1)["to_line"])))
        .when(F.coalesce("again", F.lit(False)), F.array(F.lit("covers a turn again"))).otherwise(F.concat(C.block_errors(F.col("block"), F.col("b_from"), F.col("b_to"), quoted), rules))
    )
    return rows.select("job_id", "pos", "turn_index", "block", F.when(F.col("aligned"), F.col("covered")).alias("covered"), errors.alias("errors"))


def window_verdicts(submissions: DataFrame, turns: DataFrame, blocks: DataFrame, jobs: DataFrame) -> DataFrame:
    """(job_id, accepted, errors): messages on the whole, by block and by missing turn, and on the digest, in this order. ``jobs`` are
    (job_id, last_window); every window but the last needs a digest."""
    bodies = _bodies(submissions).join(jobs.select("job_id", "last_window"), "job_id", "left")
    value, digest = F.col("value"), F.try_variant_get("value", "$.digest", "variant")
    listed = F.coalesce(F.size(C.list_at(value, "blocks")), F.lit(0)) > 0
    none = C.kind_of(value, "digest") == "VOID"
    left_out = C.messages([(none & ~F.col("last_window"), "digest missing")])
    told = F.when(none, left_out).otherwise(F.transform(C.digest_errors(digest), lambda m: F.concat(F.lit("digest: "), m)))
    whole = bodies.select("job_id", F.when(value.isNull(), F.array(F.lit("no JSON object"))).when(~listed, F.array(F.lit("no blocks"))).alias("fatal"), told.alias("digest"))

    line = lambda order, at, said: F.struct(F.lit(order).alias("o"), at.cast("bigint").alias("at"), said.alias("said"))
    wrong = blocks.where(F.size("errors") > 0).select("job_id", line(1, F.col("pos"), F.concat(F.lit("turn "), F.coalesce(F.col("turn_index").cast("string"), F.lit("?")), F.lit(": "), F.array_join("errors", "; "))).alias("m"))
    held = blocks.select("job_id", F.explode("covered.turn_index").alias("turn_index")).distinct()
    missing = turns.join(submissions.select("job_id"), "job_id", "left_semi").join(held, ["job_id", "turn_index"], "left_anti").select("job_id", line(2, F.col("turn_index"), F.format_string("no block for turn %d", "turn_index")).alias("m"))
    listed_errors = wrong.unionByName(missing).groupBy("job_id").agg(F.transform(F.sort_array(F.collect_list("m")), lambda m: m["said"]).alias("found"))
    errors = F.coalesce("fatal", F.concat(F.coalesce("found", F.array().cast("array<string>")), "digest"))
    return whole.join(listed_errors, "job_id", "left").select("job_id", errors.alias("errors")).select("job_id", (F.size("errors") == 0).alias("accepted"), "errors")


def sidecar_records(blocks: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A record of each turn of accepted submissions: the covered turn's columns and the block's JSON, the same for merged turns."""
    ok = verdicts.where("accepted").select("job_id")
    rows = blocks.join(ok, "job_id", "left_semi").select("job_id", F.explode("covered").alias("t"), F.to_json("block").alias("result"), F.coalesce(F.try_variant_get("block", "$.fallback", "boolean"), F.lit(False)).alias("fallback"))
    return rows.select("job_id", "t.*", "result", "fallback").drop("quote_ids", "thinking_ids")


def analysis_verdicts(submissions: DataFrame, jobs: DataFrame, parity: bool = False) -> DataFrame:
    """(job_id, accepted, errors, analysis, dropped) of session analyses; arcs outside the log (jobs: job_id, log_lines) are dropped and counted."""
    rows = submissions.withColumn("body", T.extract_json_object(F.col("body"))).join(jobs.select("job_id", "log_lines"), "job_id", "left")
    rows = rows.withColumn("errors", C.analysis_errors(F.try_parse_json("body"), parity)).withColumn("made", F.when(F.size("errors") == 0, C.as_analysis(F.col("body"))))
    inside = F.filter(F.col("made.arcs"), lambda a: F.col("log_lines").isNull() | a["fromLine"].between(F.lit(1), F.col("log_lines")))
    kept = F.when(F.col("made").isNotNull(), F.col("made").withField("arcs", inside))
    return rows.select("job_id", (F.size("errors") == 0).alias("accepted"), "errors", kept.alias("analysis"), (F.size("made.arcs") - F.size(inside)).alias("dropped"))


def ledger_events(verdicts: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """(job_id, ev, ts, errors): an acceptance or a rejection, and behind the twentieth rejection in a row the release of the job.
    Write them when the records are written."""
    rows = verdicts.join(states.select("job_id", "fails"), "job_id", "left").withColumn("fails", F.coalesce("fails", F.lit(0)))
    released = F.when(F.col("fails") + 1 >= MOST_REJECTIONS, F.array(F.lit("submit-fail"), F.lit("release"))).otherwise(F.array(F.lit("submit-fail")))
    events = rows.select("job_id", F.explode(F.when(F.col("accepted"), F.array(F.lit("submit-ok"))).otherwise(released)).alias("ev"), now.alias("ts"), "errors")
    return events.withColumn("errors", F.when(F.col("ev") == "submit-fail", F.col("errors")))
