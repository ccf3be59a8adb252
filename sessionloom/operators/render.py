"""Markdown traces: one document a session, every line with its place in the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import written
from . import blocks as B
from . import chains as H
from . import facts as A


def _section(title: str, body: Column) -> Column:
    return F.when(F.length(body) > 0, F.concat(F.lit(f"\n## {title}\n\n"), body, F.lit("\n"))).otherwise("")


def traces(entries: DataFrame, files_shown: int = 20) -> DataFrame:
    """(session_key, verdict, log_tokens, trace_tokens, ratio, markdown) of each session.

    Header, verdict, task, working set, timeline of blocks with tool lines, notes and how to go back to the log. Entries are read, paired, folded into blocks and rendered once, into a
    table without their texts, from which each part is an ordered aggregate of its session; a session's trace is one row, as large as its compressed log.
    """
    rows = written(B.rendered_rows(entries.where("session_key is not null")))
    head = F.concat(F.format_string("### b%d · ", "block_index"), "label", F.lit(" · "), "summary", F.lit(" "), T.ref_range(F.col("line_from"), F.col("line_to")))
    block = B.block_lines(rows).withColumn("line", F.concat_ws("\n", head, F.col("assistant_text"), F.col("tools")))
    timeline = block.groupBy("session_key").agg(_in_order("block_index", "line").alias("timeline"))
    files = B.working_set(B.ledger_of(rows.where("path is not null"), ["session_key", "path"], ["seq"], F.col("op_line").cast("string"))).where(F.col("modified") | (F.col("rank") <= files_shown))
    files = files.withColumn("line", F.concat(F.lit("- `"), "path", F.lit("`"), F.format_string(" reads %d", "reads"), F.when(F.col("modified"), F.format_string(" · +%d/−%d @L%s", "added", "removed", "modify_refs")).otherwise("")))
    files = files.groupBy("session_key").agg(_in_order("rank", "line").alias("files"))
    main = ~F.col("sidechain")
    whole = rows.groupBy("session_key").agg(
        *A.signs(main), *A.check_signs(), F.count_if(main).alias("own"), F.min("ts").alias("started"), F.max("ts").alias("ended"), F.sum("chars").alias("chars"),
        _in_order("seq", "line", F.col("kind") == "user_text").alias("tasks"), _in_order("seq", "line", F.col("kind") == "system_note").alias("notes"),
    )
    out = A.with_verdict(whole.where("own > 0")).join(files, "session_key", "left").join(timeline, "session_key", "left")
    front = F.concat(F.lit("---\nsession: "), "session_key", F.lit("\nstarted: "), F.coalesce("started", F.lit("")), F.lit("\nended: "), F.coalesce("ended", F.lit("")), F.lit("\nverdict: "), "status", F.lit("\n---\n"))
    body = [_section(t, F.coalesce(c, F.lit(""))) for t, c in (("Verdict", F.concat("status", F.lit(": "), "why")), ("Task", F.col("tasks")), ("Working Set", F.col("files")), ("Timeline", F.col("timeline")), ("Notes", F.col("notes")), ("Trace Recovery", F.lit("> `@L<n>` is line n of the session's log.")))]
    made = out.withColumn("markdown", F.concat(front, *body)).withColumn("trace_tokens", T.estimate_tokens(F.col("markdown")))
    return made.select("session_key", F.col("status").alias("verdict"), F.ceil(F.col("chars") / F.lit(4.0)).cast("bigint").alias("log_tokens"), "trace_tokens", T.compression_ratio(F.col("chars"), F.col("trace_tokens")).alias("ratio"), "markdown")


def chain_traces(traced: DataFrame, chained: DataFrame, subs: DataFrame, stats: DataFrame, group: str = "project") -> DataFrame:
    """(group, chain, session_keys, markdown, and the sums of ``stats``): one document a chain.

    Header with the sums over the chain, list of sessions, sub-agents (``subs(session_key, parent_key)``) under the session that started them,
    then the traces of the sessions in order. A chain's document is one row, as large as its compressed logs.
    """
    listed = H.session_lines(chained, group)
    agents = H.subagents(subs, chained, group).withColumn("line", F.concat(F.lit("- "), "session_key", F.format_string(" · of s%d", "parent_index")))
    agents = agents.groupBy(group, "chain").agg(_in_order("parent_index", "line").alias("agents"))
    body = listed.join(traced.select("session_key", "markdown"), "session_key")
    body = body.withColumn("part", F.concat(F.format_string("\n# Session s%d\n\n", "session_index"), "markdown"))
    made = body.groupBy(group, "chain").agg(_in_order("session_index", "line").alias("lines"), _in_order("session_index", "part").alias("parts"), F.transform(F.sort_array(F.collect_list(F.struct("session_index", "session_key"))), lambda x: x["session_key"]).alias("session_keys"))
    sums = H.chain_stats(chained, stats, group)
    made = made.join(sums, [group, "chain"], "left").join(agents, [group, "chain"], "left")
    figures = F.concat_ws("\n", *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c), F.lit(0)).cast("string")) for c in sums.columns if c not in (group, "chain")))
    front = F.concat(F.format_string("---\nchain: %d\n", "chain"), figures, F.lit("\n---\n"))
    text = F.concat(front, _section("Sessions", F.col("lines")), _section("Sub-agents", F.coalesce("agents", F.lit(""))), "parts")
    return made.select(group, "chain", "session_keys", text.alias("markdown"), *(c for c in sums.columns if c not in (group, "chain")))


def _in_order(order: str, line: str, when: Column | None = None) -> Column:
    """Lines as one text, in order; only those of rows ``when``."""
    row = F.struct(order, line)
    return F.array_join(F.transform(F.sort_array(F.collect_list(row if when is None else F.when(when & F.col(line).isNotNull(), row))), lambda x: x[line]), "\n")


def turn_prompts(entries: DataFrame, turned: DataFrame) -> DataFrame:
    """(session_key, turn_index, prompt): the text from which a turn is compressed; results of large turns are cut harder."""
    size = turned.groupBy("session_key", "turn_index").agg(F.sum("tokens").alias("all_tokens"))
    rows = turned.join(size, ["session_key", "turn_index"])
    result = F.when(F.col("all_tokens") > 20_000, T.head_tail(F.col("content"), 300, 100)).when(F.col("all_tokens") > 8_000, T.head_tail(F.col("content"), 800, 200)).otherwise(T.head_tail(F.col("content"), 2000, 500))
    said = F.when(F.col("kind") == "tool_call", F.concat(F.lit("CALL "), "tool_name", F.lit(" "), F.coalesce("tool_input", F.lit("")))).when(F.col("kind") == "tool_result", F.concat(F.when(F.col("is_error"), "ERR ").otherwise("RESULT "), F.coalesce(result, F.lit("")))).otherwise(F.concat(F.upper("kind"), F.lit(" "), F.coalesce("text", F.lit(""))))
    lines = rows.withColumn("line", F.concat(T.ref_tag(F.col("log_line")), F.lit(" "), said))
    return lines.groupBy("session_key", "turn_index").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"]), "\n").alias("prompt"))


def floor_actions(turn_rows: DataFrame) -> DataFrame:
    """(session_key, turn_index, action, fallback): what stands for a turn that no model compressed."""
    tools = F.when(F.col("tool_names") == "", "no tools").otherwise(F.concat(F.lit("tools: "), "tool_names"))
    return turn_rows.select("session_key", "turn_index", F.concat(F.format_string("turn %d (%s), ", "turn_index", "kind"), tools, F.format_string(", lines %d–%d", "from_line", "to_line")).alias("action"), F.lit(True).alias("fallback"))
