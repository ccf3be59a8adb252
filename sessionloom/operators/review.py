"""Checks of what a model says against what the log says: anchors, quotes, facts, coverage, forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def gate_anchors(blocks: DataFrame, turns: DataFrame) -> DataFrame:
    """Claimed line ranges (session_key, turn_index, from_line, to_line) put right to their turn's; adds corrected."""
    t = turns.select("session_key", "turn_index", F.col("from_line").alias("t_from"), F.col("to_line").alias("t_to"))
    out = (F.col("from_line") < F.col("t_from")) | (F.col("to_line") > F.col("t_to"))
    rows = blocks.join(t, ["session_key", "turn_index"])
    return rows.select("session_key", "turn_index", F.when(out, F.col("t_from")).otherwise(F.col("from_line")).alias("from_line"), F.when(out, F.col("t_to")).otherwise(F.col("to_line")).alias("to_line"), out.alias("corrected"))


def gate_quotes(thoughts: DataFrame, quotes: DataFrame) -> DataFrame:
    """Thoughts (session_key, turn_index, source, q) whose quote isn't of their turn become inferred; adds quote_valid."""
    known = quotes.select("session_key", "turn_index", "q").distinct().withColumn("_hit", F.lit(True))
    needs = F.col("source").isin("thinking", "narration")
    valid = ~needs | F.coalesce("_hit", F.lit(False))
    return thoughts.join(known, ["session_key", "turn_index", "q"], "left").withColumn("quote_valid", valid).withColumn("source", F.when(valid, F.col("source")).otherwise("inferred")).drop("_hit")


def gate_facts(claims: DataFrame, sealed: DataFrame) -> DataFrame:
    """Disputes (session_key, turn_index, kind, claimed, sealed): claims (checks_run, checks_failed, exit_code) that the facts contradict."""
    c = claims.select("session_key", "turn_index", F.col("checks_run").alias("c_run"), F.col("checks_failed").alias("c_failed"), F.col("exit_code").alias("c_exit"))
    rows = c.join(sealed, ["session_key", "turn_index"])
    checks = rows.where("c_run is not null and checks_run is not null and (c_run <> checks_run or c_failed <> checks_failed)").select("session_key", "turn_index", F.lit("checks").alias("kind"), F.format_string("%d run / %d failed", "c_run", "c_failed").alias("claimed"), F.format_string("%d run / %d failed", "checks_run", "checks_failed").alias("sealed"))
    exits = rows.where("c_exit <> last_exit_code").select("session_key", "turn_index", F.lit("exitCode").alias("kind"), F.format_string("exit %d", "c_exit").alias("claimed"), F.format_string("exit %d", "last_exit_code").alias("sealed"))
    return checks.unionByName(exits)


def arc_gate(arcs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Arcs (session_key, from_line, ...) with kept: do they start inside their log (session_key, log_lines)?"""
    return arcs.join(sessions.select("session_key", "log_lines"), "session_key").withColumn("kept", F.col("from_line").between(F.lit(1), F.col("log_lines"))).drop("log_lines")


def reasoning_index(arcs: DataFrame) -> DataFrame:
    """Adds subject: the arc's own, else the head of its text."""
    own = F.col("subject") if "subject" in arcs.columns else F.lit(None).cast("string")
    return arcs.withColumn("subject", F.coalesce(own, F.left("text", F.lit(60))))


def sidecar_latest(records: DataFrame, schema_version: int = 3, prompt_hash: str | None = None) -> DataFrame:
    """The last record of each (session_key, from_line, to_line, slice_hash) of this schema and prompt; append_seq orders them."""
    rows = records.where(F.col("schema_version") == schema_version)
    if prompt_hash is not None:
        rows = rows.where(F.col("prompt_hash") == prompt_hash)
    last = Window.partitionBy("session_key", "from_line", "to_line", "slice_hash").orderBy(F.desc("append_seq"))
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


SLICE = ["session_key", "from_line", "to_line", "slice_hash"]


def pending_turns(turns: DataFrame, sidecar: DataFrame) -> DataFrame:
    return turns.join(sidecar.select(*SLICE), SLICE, "left_anti")


def covered_windows(turns: DataFrame, sidecar: DataFrame) -> DataFrame:
    """(session_key, window_index, covered): have all turns of the window a record?"""
    hit = sidecar.select(*SLICE).distinct().withColumn("_hit", F.lit(True))
    return turns.join(hit, SLICE, "left").groupBy("session_key", "window_index").agg(F.bool_and(F.coalesce("_hit", F.lit(False))).alias("covered"))


def submit_coverage(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """Turns of a window with n_blocks, how many submitted ranges (session_key, b_from, b_to) hold them: 0 is missing, more
    than one an overlap. Joined by session first, so the range test stays inside one session."""
    inside = (F.col("from_line") >= F.col("b_from")) & (F.col("to_line") <= F.col("b_to"))
    return turns.join(blocks, "session_key", "left").groupBy("session_key", "turn_index").agg(F.count_if(inside).alias("n_blocks"))


def merged_spans(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each turn with the range that swallowed it: the last one that begins at or before it and ends behind it."""
    marks = blocks.select("session_key", F.col("b_from").alias("at"), "b_to", F.lit(0).alias("o"), F.lit(None).cast("bigint").alias("turn_index"), F.lit(None).cast("bigint").alias("to_line"))
    rows = marks.unionByName(turns.select("session_key", F.col("from_line").alias("at"), F.lit(None).cast("bigint").alias("b_to"), F.lit(1).alias("o"), "turn_index", "to_line"))
    line = Window.partitionBy("session_key").orderBy("at", "o", "b_to").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("b", F.last(F.when(F.col("o") == 0, F.struct("at", "b_to")), ignorenulls=True).over(line)).where("o = 1")
    held = F.col("b.b_to") >= F.col("to_line")
    return seen.select("session_key", "turn_index", F.when(held, F.col("b.at")).alias("span_from"), F.when(held, F.col("b.b_to")).alias("span_to"))


def degraded_form(forms: DataFrame, budget: int = 25_000) -> DataFrame:
    """(session_key, level, form): the fullest of form0, form1 and form2 within the budget, else the last."""
    size = lambda c: T.estimate_tokens(F.col(c))
    level = F.when(size("form0") <= budget, 0).when(size("form1") <= budget, 1).otherwise(2)
    return forms.select("session_key", level.alias("level"), F.when(level == 0, F.col("form0")).when(level == 1, F.col("form1")).otherwise(F.col("form2")).alias("form"))


def grouped_forms(turns: DataFrame, lines: DataFrame, actions: DataFrame) -> DataFrame:
    """(session_key, turn_index, form0, form1, form2) from turns, tool lines (pos, text, tool_name, log_line) and actions.

    form1 keeps of a tool line its name and place, form2 only the header; the action always stays.
    """
    full = F.when(F.length("text") > 170, F.concat(F.left("text", F.lit(169)), F.lit("…"))).otherwise(F.col("text"))
    rows = lines.select("session_key", "turn_index", "pos", full.alias("full"), F.format_string("%s @L%d", "tool_name", "log_line").alias("short"))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", c))), lambda x: x[c]), "\n")
    text = rows.groupBy("session_key", "turn_index").agg(joined("full").alias("full"), joined("short").alias("short"))
    head = F.concat(F.format_string("#### b%d · @L%d–L%d", "turn_index", "from_line", "to_line"), F.when(F.col("tool_names") != "", F.concat(F.lit(" · "), F.col("tool_names"))).otherwise(""), F.when(F.col("interrupted"), "\n(turn cut off)").otherwise(""))
    tail = F.concat(F.lit("→ "), F.coalesce("action", F.lit("")))
    every = turns.join(text, ["session_key", "turn_index"], "left").join(actions, ["session_key", "turn_index"], "left")
    return every.select("session_key", "turn_index", *(F.concat_ws("\n", head, body, tail).alias(f"form{i}") for i, body in enumerate((F.col("full"), F.col("short"), F.lit(None).cast("string")))))
