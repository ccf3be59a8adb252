"""Pairs of calls and results, sealed facts, accounting, verdicts, activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tools as C
from .turns import with_turns


def call_results(entries: DataFrame) -> DataFrame:
    """Each call with its result, the last of its id: (session_key, tool_call_id, tool_name, tool_input, call_seq, call_line, result_seq, result_line, content, is_error)."""
    results = entries.where("kind = 'tool_result' and tool_call_id <> ''").groupBy("session_key", "tool_call_id").agg(F.max_by(F.struct("seq", "log_line", "content", "is_error", "interrupted", "diff_added", "diff_removed"), "seq").alias("r"))
    calls = entries.where("kind = 'tool_call'").select("session_key", "tool_call_id", "tool_name", "tool_input", F.col("seq").alias("call_seq"), F.col("log_line").alias("call_line"), "sidechain")
    return calls.join(results, ["session_key", "tool_call_id"], "left").select("*", F.col("r.seq").alias("result_seq"), F.col("r.log_line").alias("result_line"), F.col("r.content").alias("content"), F.col("r.is_error").alias("is_error"), F.col("r.interrupted").alias("interrupted"), F.col("r.diff_added").alias("diff_added"), F.col("r.diff_removed").alias("diff_removed")).drop("r")


def paired(entries: DataFrame) -> DataFrame:
    """entries, dealt by session, with the family of calls and the last rows of each one's id, in one pass: result, own_result (side chains' results left out) and owner, a call's family; null without one."""
    tied = Window.partitionBy("session_key", "tool_call_id")
    last = lambda when, *columns: F.max_by(F.struct(*columns), F.when(when & (F.col("tool_call_id") != ""), F.col("seq"))).over(tied)
    result = F.col("kind") == "tool_result"
    found = {"result": last(result, "log_line", "content", "is_error", "interrupted", "diff_added", "diff_removed"), "own_result": last(result & ~F.col("sidechain"), "log_line", "diff_added", "diff_removed")}
    call = F.col("kind") == "tool_call"
    known = entries.withColumn("family", F.when(call, C.classify_tool(F.col("tool_name"))))
    return known.repartition("session_key").withColumns(found | {"owner": F.max_by("family", F.when(call & (F.col("tool_call_id") != ""), F.col("seq"))).over(tied)})


def result_owners(entries: DataFrame) -> DataFrame:
    """Each result with the name and input of the call that owns it, the last of its id; null without one."""
    calls = entries.where("kind = 'tool_call' and tool_call_id <> ''").groupBy("session_key", "tool_call_id").agg(F.max_by(F.struct("tool_name", "tool_input"), "seq").alias("c"))
    rows = entries.where("kind = 'tool_result'").drop("tool_name", "tool_input").join(calls, ["session_key", "tool_call_id"], "left")
    return rows.withColumns({"tool_name": F.col("c.tool_name"), "tool_input": F.col("c.tool_input")}).drop("c")


def unanswered_calls(entries: DataFrame) -> DataFrame:
    results = entries.where("kind = 'tool_result'").select("session_key", "tool_call_id")
    return entries.where("kind = 'tool_call'").join(results, ["session_key", "tool_call_id"], "left_anti").select("session_key", "tool_call_id", "log_line")


def unmatched_results(entries: DataFrame) -> DataFrame:
    calls = entries.where("kind = 'tool_call'").select("session_key", "tool_call_id")
    return entries.where("kind = 'tool_result'").join(calls, ["session_key", "tool_call_id"], "left_anti").select("session_key", "tool_call_id", "log_line")


def checked(entries: DataFrame) -> DataFrame:
    """Adds _checks, the test summary of each result, as _facts needs it."""
    return entries.withColumn("_checks", F.when(F.col("kind") == "tool_result", C.detect_checks(F.coalesce("content", F.lit("")))))


def _facts(own: Column | None = None) -> list[Column]:
    """Aggregates over entries, or over those of ``own``."""
    among = F.lit(True) if own is None else own
    result = (F.col("kind") == "tool_result") & among
    last = lambda c: F.max_by(c, F.when(result & c.isNotNull(), F.col("seq")))
    return [
        F.count_if((F.col("kind") == "tool_call") & among).alias("tool_calls"), F.count_if(result & F.col("is_error")).alias("errors"), F.count_if(result & F.col("interrupted")).alias("interrupted_results"),
        last(F.col("exit_code")).alias("last_exit_code"), last(F.col("_checks.run")).alias("checks_run"), last(F.col("_checks.failed")).alias("checks_failed"),
        F.coalesce(F.sum(F.when(result, F.col("diff_added"))), F.lit(0)).cast("bigint").alias("diff_added"), F.coalesce(F.sum(F.when(result, F.col("diff_removed"))), F.lit(0)).cast("bigint").alias("diff_removed"),
    ]


def seal_facts(entries: DataFrame, budget: int = 8_000) -> DataFrame:
    """Machine facts of each turn, without side chains."""
    rows = with_turns(checked(entries), budget, ("sidechain", "is_error", "interrupted", "exit_code", "_checks", "diff_added", "diff_removed"))
    out = rows.groupBy("session_key", "turn_index").agg((F.max_by("pending", "seq") > 0).alias("cut"), *_facts(~F.col("sidechain")))
    return out.withColumn("interrupted", F.col("cut") | (F.col("interrupted_results") > 0)).drop("cut", "interrupted_results")


def render_facts() -> Column:
    """One line of a turn's facts."""
    return F.concat_ws(
        "; ", F.format_string("calls=%d", "tool_calls"), F.format_string("errors=%d", "errors"), F.when(F.col("last_exit_code").isNotNull(), F.format_string("lastExit=%d", "last_exit_code")),
        F.when(F.col("checks_run").isNotNull(), F.format_string("checks: %d run / %d failed", "checks_run", "checks_failed")),
        F.when((F.col("diff_added") > 0) | (F.col("diff_removed") > 0), F.format_string("diff +%d/−%d", "diff_added", "diff_removed")), F.when(F.col("interrupted"), "INTERRUPTED"),
    )


def facts_footer(facts: DataFrame) -> DataFrame:
    """(session_key, footer): the facts of all turns, a line each."""
    lines = facts.select("session_key", "turn_index", F.concat(F.format_string("b%d: ", "turn_index"), render_facts()).alias("line"))
    return lines.groupBy("session_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn_index", "line"))), lambda x: x["line"]), "\n").alias("footer"))


def account_sessions(entries: DataFrame) -> DataFrame:
    own = checked(entries.where(~F.col("sidechain")))
    return own.groupBy("session_key").agg(*_facts(), F.count_distinct(F.when(F.col("kind") == "tool_result", F.col("diff_path"))).alias("files_modified"), F.count_if(F.col("kind") == "compaction").alias("compactions"))


def tools_by_tool(entries: DataFrame) -> DataFrame:
    return entries.where("kind = 'tool_call' and not sidechain").groupBy("session_key", "tool_name").agg(F.count("*").alias("n"))


def session_checks(entries: DataFrame) -> DataFrame:
    """(session_key, run, failed, ever_failed): the last test summary of commands, and whether any failed."""
    ran = result_owners(entries).where(~F.col("sidechain")).where(C.classify_tool(F.col("tool_name")) == "execute").withColumn("checks", C.detect_checks(F.col("content"))).where("checks is not null")
    return ran.select("session_key", "seq", "checks.run", "checks.failed").groupBy("session_key").agg(*check_signs())


def check_signs() -> list[Column]:
    """Aggregates over rows with the run and failed checks of a test summary, null without one."""
    last = lambda c: F.max_by(c, F.when(F.col("run").isNotNull(), F.col("seq"))).alias(c)
    return [last("run"), last("failed"), F.bool_or(F.col("failed") > 0).alias("ever_failed")]


def signs(own: Column) -> list[Column]:
    """Aggregates over the entries of ``own`` that outcomes rest on, checks aside."""
    result = F.col("kind") == "tool_result"
    return [
        F.bool_or(F.when(own, result & F.col("interrupted"))).alias("cut"), F.count_if(own & result & F.col("is_error")).alias("errors"), F.count_if(own & (F.col("kind") == "tool_call")).alias("calls"),
        F.max_by("is_error", F.when(own & result, F.col("seq"))).alias("last_error"),
    ]


def outcome_signs(entries: DataFrame) -> DataFrame:
    """(session_key, cut, errors, calls, last_error, run, failed, ever_failed): what verdicts rest on; last_error is null without results, run and
    failed without checks."""
    base = entries.where(~F.col("sidechain")).groupBy("session_key").agg(*signs(F.lit(True)))
    return base.join(session_checks(entries), "session_key", "left")


def with_verdict(signs: DataFrame) -> DataFrame:
    """Adds status and why to rows of outcome_signs, of sessions or of more."""
    rows = signs.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("run", "failed")} | {c: F.coalesce(c, F.lit(False)) for c in ("ever_failed", "last_error")})
    ladder = [
        ("cut", "partial", F.lit("interrupted tool calls")), ("run > 0 and failed > 0", "failure", F.format_string("last checks run: %d failed out of %d", "failed", "run")), ("last_error", "failure", F.lit("the last tool call ended with an error")),
        ("ever_failed", "partial", F.lit("checks failed earlier and are green now")), ("errors > 0", "partial", F.format_string("tool errors: %d", "errors")), ("calls = 0", "unknown", F.lit("no tool calls")), ("run > 0", "success", F.format_string("checks ran (%d) and are green", "run")),
    ]
    status = why = None
    for test, name, reason in ladder:
        status = F.when(F.expr(test), name) if status is None else status.when(F.expr(test), name)
        why = F.when(F.expr(test), reason) if why is None else why.when(F.expr(test), reason)
    return rows.withColumns({"status": status.otherwise("unknown"), "why": why.otherwise("no tool errors; no checks")})


def verdicts(entries: DataFrame) -> DataFrame:
    """(session_key, status, why): what the facts say about the outcome."""
    return with_verdict(outcome_signs(entries)).select("session_key", "status", "why")


def active_time(rows: DataFrame, key: str, ts: str, most_ms: int = 120_000) -> DataFrame:
    """(key, active_us): the sum of gaps between neighbouring times that are not longer than ``most_ms``."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = at - F.lag(at).over(Window.partitionBy(key).orderBy(at))
    return rows.select(key, gap.alias("gap")).groupBy(key).agg(F.coalesce(F.sum(F.when(F.col("gap") <= most_ms * 1000, F.col("gap"))), F.lit(0)).cast("bigint").alias("active_us"))


def last_results(entries: DataFrame) -> DataFrame:
    return entries.where("kind = 'tool_result' and not sidechain").groupBy("session_key").agg(F.max_by("is_error", "seq").alias("last_error"), F.max("log_line").alias("log_line"))


def sidechain_runs(entries: DataFrame) -> DataFrame:
    """(session_key, run, line_from, line_to, calls, errors, first_text) of neighbouring side-chain entries."""
    line = Window.partitionBy("session_key").orderBy("seq")
    marked = entries.withColumn("run", F.sum(F.when(F.col("sidechain") & ~F.coalesce(F.lag("sidechain").over(line), F.lit(False)), 1).otherwise(0)).over(line))
    said = F.when(F.col("kind") == "assistant_text", F.col("seq"))
    return marked.where("sidechain").groupBy("session_key", "run").agg(F.min("log_line").alias("line_from"), F.max("log_line").alias("line_to"), F.count_if(F.col("kind") == "tool_call").alias("calls"), F.count_if((F.col("kind") == "tool_result") & F.col("is_error")).alias("errors"), T.cap_line(F.min_by("text", said), 160).alias("first_text"))


def repair_cycles(entries: DataFrame) -> DataFrame:
    """(session_key, repairs): calls that repeat the call of the last error, once an error.

    An error of a result without owner clears the memory; a success does not.
    """
    owned = result_owners(entries).where("is_error and not sidechain").select("session_key", "seq", C.call_key(F.col("tool_name"), C.tool_signature(F.col("tool_name"), F.col("tool_input"))).alias("key"), F.col("tool_name").isNotNull().alias("known"))
    errors = owned.select("session_key", "seq", F.lit("error").alias("what"), F.when(F.col("known"), F.col("key")).alias("key"))
    calls = entries.where("kind = 'tool_call' and not sidechain").select("session_key", "seq", F.lit("call").alias("what"), C.call_key(F.col("tool_name"), C.tool_signature(F.col("tool_name"), F.col("tool_input"))).alias("key"))
    line = Window.partitionBy("session_key").orderBy("seq")
    rows = errors.unionByName(calls).withColumn("last", F.last(F.when(F.col("what") == "error", F.struct("seq", "key")), ignorenulls=True).over(line))
    hits = rows.where("what = 'call' and last.key = key").select("session_key", F.col("last.seq").alias("error_seq")).distinct()
    return hits.groupBy("session_key").agg(F.count("*").alias("repairs"))
