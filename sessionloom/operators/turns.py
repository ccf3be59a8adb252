"""Turns, token windows and quotes of an entry table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .folds import ordered_fold

TURN_BUDGET, WINDOW_BUDGET = 8_000, 40_000


def entry_tokens() -> Column:
    kind = F.col("kind")
    return (
        F.when(kind == "tool_call", T.estimate_tokens(F.coalesce("tool_input", F.lit('""'))) + 16)
        .when(kind == "tool_result", T.estimate_tokens(F.coalesce("content", F.lit(""))) + 8)
        .when(kind == "compaction", F.lit(8).cast("bigint"))
        .otherwise(T.estimate_tokens(F.coalesce("text", F.lit(""))))
    )


def with_turns(entries: DataFrame, budget: int = TURN_BUDGET, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Adds tokens, turn_index (from 1) and pending, the calls still open behind the entry.

    The fold carries every column along; ``keep`` names those that are needed beside (session_key, seq, kind, tool_call_id), so that
    texts and outputs are dropped before the shuffle.

    A prompt is a turn of its own. Other entries gather; a turn that has reached the budget ends when the
    answer to its last open call arrives.
    """

    def step(s: dict, row: tuple) -> tuple:
        kind, call, tokens = row
        if kind == "user_text":
            s.update(turn=s["turn"] + 1, open=False, tokens=0, calls=set())
            return s["turn"], 0
        if not s["open"]:
            s.update(turn=s["turn"] + 1, open=True, tokens=0, calls=set())
        s["tokens"] += tokens
        if kind == "tool_call":
            s["calls"].add(call)
        elif kind == "tool_result" and call in s["calls"]:
            s["calls"].discard(call)
            s["open"] = bool(s["calls"]) or s["tokens"] < budget
        return s["turn"], len(s["calls"])

    sized = entries.withColumn("tokens", entry_tokens())
    if keep is not None:
        sized = sized.select(*dict.fromkeys(("session_key", "seq", "kind", "tool_call_id", "tokens", *keep)))
    return ordered_fold(sized, "session_key", ["seq"], ["kind", "tool_call_id", "tokens"], lambda: {"turn": 0, "open": False, "tokens": 0, "calls": set()}, step, "turn_index bigint, pending bigint")


def turns(entries: DataFrame, budget: int = TURN_BUDGET) -> DataFrame:
    """(session_key, turn_index, kind, from_line, to_line, tokens, tool_names, interrupted)."""
    named = F.sort_array(F.collect_list(F.when(F.col("kind") == "tool_call", F.struct("seq", "tool_name"))))
    return with_turns(entries, budget, ("log_line", "tool_name")).groupBy("session_key", "turn_index").agg(
        F.when(F.bool_or(F.col("kind") == "user_text"), "user").otherwise("assistant").alias("kind"), F.min("log_line").alias("from_line"), F.max("log_line").alias("to_line"), F.sum("tokens").alias("tokens"),
        F.array_join(F.array_distinct(F.transform(named, lambda x: x["tool_name"])), ",").alias("tool_names"), (F.max_by("pending", "seq") > 0).alias("interrupted"),
    )


def with_windows(turn_rows: DataFrame, budget: int = WINDOW_BUDGET) -> DataFrame:
    """Adds window_index: whole turns, packed until the next would pass the budget."""

    def step(s: dict, row: tuple) -> tuple:
        if s["tokens"] > 0 and s["tokens"] + row[0] > budget:
            s.update(window=s["window"] + 1, tokens=0)
        s["tokens"] += row[0]
        return (s["window"],)

    return ordered_fold(turn_rows, "session_key", ["turn_index"], ["tokens"], lambda: {"window": 1, "tokens": 0}, step, "window_index bigint")


def windows(turn_rows: DataFrame, budget: int = WINDOW_BUDGET) -> DataFrame:
    """(session_key, window_index, turns, tokens, from_line, to_line)."""
    return with_windows(turn_rows, budget).groupBy("session_key", "window_index").agg(F.count("*").alias("turns"), F.sum("tokens").alias("tokens"), F.min_by("from_line", "turn_index").alias("from_line"), F.max_by("to_line", "turn_index").alias("to_line"))


def quotes(entries: DataFrame, budget: int = TURN_BUDGET) -> DataFrame:
    """(session_key, turn_index, q, source, log_line, text): the first of each quote id in a turn, of non-blank thinking and narration."""
    spoken = F.col("kind").isin("assistant_text", "assistant_thinking")
    own = entries.withColumn("_said", F.when(spoken, F.col("text")))
    turned = with_turns(own, budget, ("log_line", "_said")).withColumnRenamed("_said", "text")
    said = turned.where(spoken & (F.length(T.trimmed(F.col("text"))) > 0))
    source = F.when(F.col("kind") == "assistant_thinking", "thinking").otherwise("narration")
    first = Window.partitionBy("session_key", "turn_index", "q").orderBy("seq")
    ranked = said.select("session_key", "turn_index", T.quote_id(F.col("text")).alias("q"), source.alias("source"), "log_line", "text", "seq").withColumn("_r", F.row_number().over(first))
    return ranked.where("_r = 1").drop("_r", "seq")


def slice_texts(entries: DataFrame, budget: int = TURN_BUDGET) -> DataFrame:
    """(session_key, turn_index, slice, slice_hash): kind, line and text length of each entry of a turn, by which its record is known."""
    said = F.when(F.col("kind").isin("user_text", "assistant_text", "assistant_thinking"), T.text_units(F.coalesce("text", F.lit("")))).otherwise(0)
    mark = F.concat_ws(":", "kind", F.col("log_line").cast("string"), said.cast("string"))
    marks = with_turns(entries.withColumn("mark", mark), budget, ("mark",)).select("session_key", "turn_index", F.struct("seq", "mark").alias("m"))
    joined = marks.groupBy("session_key", "turn_index").agg(F.array_join(F.transform(F.sort_array(F.collect_list("m")), lambda m: m["mark"]), "|").alias("slice"))
    return joined.withColumn("slice_hash", T.slice_hash(F.col("slice")))


def digest_carry(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Adds carried: the last known value before the row."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("carried", F.last(value, ignorenulls=True).over(before))
