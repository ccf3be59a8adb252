"""The whole deterministic pass over a tree of logs, as DataFrames or as files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import blocks, chains, facts, render, review, traces, turns, work
from .sources import discovery
from .storage import written


class Compressor(Protocol):
    """Turns prompts (session_key, turn_index, prompt) into actions (session_key, turn_index, action, fallback)."""

    def __call__(self, prompts: DataFrame, turn_rows: DataFrame) -> DataFrame: ...


def deterministic(prompts: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """The compressor without a model."""
    return render.floor_actions(turn_rows)


class Analyser(Protocol):
    """Turns session forms (session_key, level, form) and verdicts into analyses (session_key, status, why, ...)."""

    def __call__(self, forms: DataFrame, verdicts: DataFrame) -> DataFrame: ...


def from_facts(forms: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The analyser without a model: the verdict that the facts give."""
    return forms.join(verdicts, "session_key").select("session_key", "status", "why")


@dataclass(frozen=True)
class Options:
    turn_tokens: int = turns.TURN_BUDGET
    window_tokens: int = turns.WINDOW_BUDGET
    tight_ms: int = chains.TIGHT_MS
    loose_ms: int = chains.LOOSE_MS
    only: str | None = None
    root: str | None = None
    repo_bound: bool = False
    form_tokens: int = 25_000
    chain: bool = True
    most: int | None = None


def analyse(entries: DataFrame, options: Options | None = None, compressor: Compressor = deterministic) -> dict[str, DataFrame]:
    """All tables over an entry table."""
    o = options or Options()
    turned = turns.with_turns(entries, o.turn_tokens)
    turn_rows = turns.turns(entries, o.turn_tokens)
    return {
        "turns": turn_rows, "windows": turns.windows(turn_rows, o.window_tokens), "quotes": turns.quotes(entries, o.turn_tokens), "facts": facts.seal_facts(entries, o.turn_tokens), "accounting": facts.account_sessions(entries),
        "verdicts": facts.verdicts(entries), "blocks": blocks.blocks(entries), "tool_lines": blocks.tool_lines(entries), "ledger": blocks.file_ledger(entries), "sidechains": facts.sidechain_runs(entries), "repairs": facts.repair_cycles(entries),
        "actions": compressor(render.turn_prompts(entries, turned), turn_rows), "traces": render.traces(entries),
    }


def refine(entries: DataFrame, options: Options | None = None, compressor: Compressor = deterministic, analyser: Analyser = from_facts) -> dict[str, DataFrame]:
    """Compressed turns, their forms and the analysis of each session.

    actions: what the compressor made of each turn; turn_forms: header, tool lines and action at three levels; forms: the fullest one of
    a session that fits the budget; analyses: what the analyser made of it.
    """
    o = options or Options()
    main = entries.where("not sidechain")
    turned, turn_rows = turns.with_turns(main, o.turn_tokens), turns.turns(main, o.turn_tokens)
    actions = compressor(render.turn_prompts(main, turned), turn_rows)
    calls = blocks.rendered_calls(main).select("session_key", F.col("call_seq").alias("pos"), F.col("line").alias("text"))
    lines = turned.where("kind = 'tool_call'").select("session_key", "turn_index", F.col("seq").alias("pos"), "tool_name", "log_line").join(calls, ["session_key", "pos"])
    turn_forms = review.grouped_forms(turn_rows, lines, actions.select("session_key", "turn_index", "action"))
    whole = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn_index", c))), lambda x: x[c]), "\n").alias(c)
    forms = review.degraded_form(turn_forms.groupBy("session_key").agg(whole("form0"), whole("form1"), whole("form2")), o.form_tokens)
    return {"actions": actions, "turn_forms": turn_forms, "forms": forms, "analyses": analyser(forms, facts.verdicts(entries))}


def distill(spark: SparkSession, roots: list[discovery.Root], options: Options | None = None) -> dict[str, DataFrame]:
    """Entries, sessions, chains and all tables of the logs below the roots."""
    o = options or Options()
    entries, sessions = discovery.read(spark, roots, o.only, o.root)
    if o.most is not None:
        sessions = written(sessions.orderBy("started_at", "session_key").limit(o.most))
        entries = entries.join(sessions.select("session_key"), "session_key", "left_semi")
    entries, sessions = written(entries), written(sessions)  # the logs are parsed once; every table below reads these
    out = {"entries": entries, "sessions": sessions} | analyse(entries, o)
    # Read more than once below and by whoever writes the tables.
    out |= {name: written(out[name]) for name in ("blocks", "ledger", "traces")}
    paths = out["ledger"].groupBy("session_key").agg(F.collect_set("path").alias("paths"))
    mains = sessions.where("role = 'main'").join(paths, "session_key", "left").withColumns({"paths": F.coalesce("paths", F.array().cast("array<string>")), "started_at": F.try_to_timestamp("started_at"), "ended_at": F.try_to_timestamp("ended_at")})
    # One run has one root, and all its sessions are one line; without a root each working directory is a project.
    mains = mains.withColumn("project", F.lit(o.root) if o.root else F.coalesce("cwd", F.lit("")))
    chained = written(chains.chains(mains, o.tight_ms, o.loose_ms) if o.chain else chains.chains(mains.withColumns({c: F.lit(None).cast("string") for c in ("leaf_uuid", "logical_parent_uuid")}), -1, -1))
    out["chains"] = chained.join(sessions.select("session_key", "source"), "session_key")
    whole_chains = {"chain_blocks": traces.chain_blocks(out["blocks"], chained, "project"), "chain_ledger": traces.chain_ledger(entries, chained, "project"), "chain_tools": traces.chain_tools(entries, chained, "project"), "chain_verdicts": traces.chain_verdicts(entries, chained, "project")}
    out |= whole_chains
    shown = out["traces"]
    if o.repo_bound:
        shown = shown.withColumn("markdown", T.repo_bound(F.col("markdown"), o.root))
    names = sessions.select("session_key", "session_id", "started_at", "title")
    named = shown.join(names, "session_key")
    named = named.withColumn("base", T.trace_file_name(F.col("started_at"), F.array("session_id"), F.col("title")))
    out["traces"] = work.unique_names(named, "base", "session_key").drop("base")

    subs = sessions.where("role = 'subagent'").select("session_key", F.col("parent_thread_id").alias("parent_id")).join(sessions.select(F.col("session_id").alias("parent_id"), F.col("session_key").alias("parent_key")), "parent_id").drop("parent_id")
    whole = render.chain_traces(shown, chained, subs, sessions.select("session_key", "log_lines", "requests", "input", "output", "cache_read", "cache_write"))
    first = chained.where("session_index = 1").join(names, "session_key").select("project", "chain", F.col("started_at").alias("first_start"), F.col("title").alias("first_title"))
    ids = chained.join(names, "session_key").groupBy("project", "chain").agg(F.transform(F.sort_array(F.collect_list(F.struct("session_index", "session_id"))), lambda x: x["session_id"]).alias("session_ids"))
    whole = whole.join(first, ["project", "chain"]).join(ids, ["project", "chain"]).withColumn("base", T.trace_file_name(F.col("first_start"), F.col("session_ids"), F.col("first_title")))
    out["chain_traces"] = written(work.unique_names(whole, "base", "chain").drop("base", "first_start", "first_title", "session_ids"))
    return out


def write_markdown(traces: DataFrame, out: str) -> None:
    """Each trace (file_name, markdown) as a file below ``out``, a folder that driver and executors share. A file is complete or
    not there, and a task that runs again writes it again."""

    def write_part(rows: Iterator[Row]) -> None:
        os.makedirs(out, exist_ok=True)
        for row in rows:
            held = f"{out}/.{row.file_name}.{uuid.uuid4().hex}"
            with open(held, "w", encoding="utf-8") as f:
                f.write(row.markdown)
            os.replace(held, f"{out}/{row.file_name}")

    traces.select("file_name", "markdown").foreachPartition(write_part)


def write(tables: dict[str, DataFrame], out: str) -> None:
    """Each table as Parquet below ``out``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
