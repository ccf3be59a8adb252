"""Activity blocks of a session, tool lines, runs of equal rows, the file ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tools as C
from .facts import call_results, paired
from .folds import ordered_fold

#: Calls after which a block may end at the next turn's start.
FULL = 8
FAMILIES = ("read", "search", "edit", "execute", "web", "agent", "mcp", "other")


def _block(s: dict, row: tuple) -> tuple:
    """The block of an entry; of one without kind none."""
    kind, family, turn_start = row
    if kind is None:
        return (None,)

    def opened() -> None:
        if not s["open"]:
            s.update(block=s["block"] + 1, open=True, calls={})

    if kind == "user_text":
        s["open"] = False
        opened()
    elif kind == "assistant_text":
        if s["open"] and s["calls"] and not turn_start:
            s["open"] = False
            return (s["block"],)
        if s["open"] and s["calls"]:
            s["open"] = False
        opened()
    else:
        calls = s["calls"]
        if s["open"] and calls and turn_start and (sum(calls.values()) >= FULL or max(calls, key=calls.get) != family):
            s["open"] = False
        opened()
        s["calls"][family] = s["calls"].get(family, 0) + 1
    return (s["block"],)


def _folded(rows: DataFrame, kind: str, dealt: bool = False) -> DataFrame:
    return ordered_fold(rows, "session_key", ["seq"], [kind, "family", "turn_start"], lambda: {"block": 0, "open": False, "calls": {}}, _block, "block_index bigint", dealt)


def with_blocks(entries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(session_key, seq, kind, family, turn_start, block_index from 1, and ``keep``) of the entries that make up blocks (no side chains).

    A prompt opens a block. Narration behind calls closes one, unless it opens a new turn. A turn that starts with another
    family than the block's commonest, or behind FULL calls, opens a new one.
    """
    own = entries.where("not sidechain").where(F.col("kind").isin("user_text", "assistant_text", "tool_call")).withColumn("family", F.when(F.col("kind") == "tool_call", C.classify_tool(F.col("tool_name"))))
    return _folded(own.select("session_key", "seq", "kind", "family", "turn_start", *keep), "kind")


def _label() -> Column:
    n = {f: F.col(f"n_{f}") for f in FAMILIES}
    read = n["read"] + n["search"]
    ahead = lambda x: (x > 0) & (x >= read) & (x >= n["execute"])
    return (
        F.when(F.col("calls") == 0, "outcome").when(n["agent"] > 0, "delegation").when(n["edit"] > 0, "edit").when(ahead(n["web"]), "web").when(ahead(n["mcp"]), "mcp")
        .when((read > 0) & (read >= n["execute"]), "research").when(n["execute"] > 0, "run").when(read > 0, "research").otherwise("tools")
    )


def _summary() -> Column:
    n = {f: F.col(f"n_{f}") for f in FAMILIES}
    shown = (("read/search ×%d", n["read"] + n["search"]), ("edits ×%d", n["edit"]), ("runs ×%d", n["execute"]), ("web ×%d", n["web"]), ("subagents ×%d", n["agent"]), ("mcp ×%d", n["mcp"]), ("other ×%d", n["other"]))
    parts = F.concat_ws(", ", *(F.when(x > 0, F.format_string(p, x)) for p, x in shown))
    return F.concat(F.when(parts == "", "no tool calls").otherwise(parts), F.when(F.col("errors") > 0, F.format_string("; errors: %d", "errors")).otherwise(""))


def blocks(entries: DataFrame) -> DataFrame:
    """(session_key, block_index, label, summary, assistant_text, calls, errors, line_from, line_to, started_at, ended_at)."""
    said = entries.withColumn("said", F.when(F.col("kind") == "assistant_text", F.col("text")))
    rows = with_blocks(said, ("log_line", "ts", "said"))
    pairs = call_results(entries).select("session_key", F.col("call_seq").alias("seq"), "result_line", F.col("is_error").alias("failed"))
    rows = rows.join(pairs, ["session_key", "seq"], "left")
    call = F.col("kind") == "tool_call"
    line = F.when(call, F.coalesce("result_line", "log_line"))
    shaped = rows.groupBy("session_key", "block_index").agg(
        *(F.count_if(F.col("family") == f).alias(f"n_{f}") for f in FAMILIES), F.count_if(call).alias("calls"), F.count_if(call & F.coalesce("failed", F.lit(False))).alias("errors"),
        F.max_by("said", F.when(F.col("kind") == "assistant_text", F.col("seq"))).alias("assistant_text"), F.coalesce(F.min(F.when(call, F.least("log_line", line))), F.lit(0)).alias("line_from"),
        F.coalesce(F.max(F.when(call, F.greatest("log_line", line))), F.lit(0)).alias("line_to"), F.min_by("ts", "seq").alias("started_at"), F.max_by("ts", "seq").alias("ended_at"),
    )
    return shaped.select("session_key", "block_index", _label().alias("label"), _summary().alias("summary"), T.cap_block(F.col("assistant_text"), 500).alias("assistant_text"), "calls", "errors", "line_from", "line_to", "started_at", "ended_at")


#: Tools whose result is told by changed lines, and by its size (fixed values).
EDIT_TOOLS = ("Edit", "MultiEdit", "Write", "apply_patch", "create_file", "str_replace_based_edit_tool", "NotebookEdit")
READ_TOOLS = ("Read", "view", "view_image")


def render_fact() -> Column:
    """What a call's result says, in short, from the columns of call_results: interrupted, error, changed lines, size of what was read, or its text."""
    content = F.col("content")
    body = F.when(F.startswith(content, F.lit("Chunk ID:")), C.strip_exec_header(content)).otherwise(content)
    spent = F.regexp_extract(content, r"Original token count: (\d+)", 1)
    own = F.when(F.col("tool_name") == "apply_patch", C.patch_diff(F.coalesce(F.get_json_object("tool_input", "$.input"), "tool_input"))).otherwise(C.edit_diff(F.col("tool_name"), F.col("tool_input")))
    added, removed = F.coalesce("diff_added", own["added"]), F.coalesce("diff_removed", own["removed"])
    tomb = lambda t: T.tombstone(F.length(t), T.count_lines(t), T.short_hash(content), F.col("result_line"))
    short = T.first_line(body, 140)
    tokens = F.when(F.startswith(content, F.lit("Chunk ID:")) & (spent != ""), F.concat(F.lit(", ~"), spent, F.lit(" tok"))).otherwise("")
    return (
        F.when(content.isNull(), "no result").when(F.col("interrupted"), "interrupted").when(F.col("is_error"), F.concat(F.lit("ERR "), T.first_line(body, 140)))
        .when(F.col("tool_name").isin(*EDIT_TOOLS) & added.isNotNull(), F.format_string("+%d/−%d", added, F.coalesce(removed, F.lit(0))))
        .when(F.col("tool_name").isin(*READ_TOOLS), F.concat(F.format_string("%d ln ", T.count_lines(content)), tomb(content)))
        .when(F.length(body) <= 160, F.when(F.length(short) > 0, short).otherwise("ok")).otherwise(F.concat(T.first_line(body, 90), F.lit(" "), tomb(body), tokens))
    )


def rendered_calls(entries: DataFrame, cwd: str | None = None) -> DataFrame:
    """call_results with signature, fact and line: the call, its place and what came of it; the result's place only if it isn't close by."""
    return _rendered(call_results(entries), C.tool_signature(F.col("tool_name"), F.col("tool_input")), cwd)


def _rendered(pairs: DataFrame, signature: Column, cwd: str | None = None) -> DataFrame:
    if cwd:
        signature = F.when(F.startswith(signature, F.lit(f"cd {cwd} && ")), F.substr(signature, F.lit(len(f"cd {cwd} && ") + 1))).otherwise(signature)
    rows = pairs.withColumn("signature", T.cap_line(signature, 110)).withColumn("fact", render_fact())
    called = F.concat_ws(" ", F.concat(F.lit("`"), T.display_name(F.col("tool_name")), F.lit("`")), F.nullif(F.col("signature"), F.lit("")), T.ref_tag(F.col("call_line")))
    far = F.when(F.col("result_line") - F.col("call_line") > 2, F.concat(F.lit(" "), T.ref_tag(F.col("result_line")))).otherwise("")
    return rows.withColumn("line", F.concat(called, F.lit(" → "), "fact", far))


def _alike() -> Column:
    """What equal calls have in common."""
    return F.concat_ws("|", "tool_name", "signature", F.coalesce("is_error", F.lit(False)).cast("string"), T.strip_refs(F.col("fact")))


def _times() -> Column:
    return F.when(F.col("occurrences") > 1, F.concat("line", F.format_string(" ×%d", "occurrences"))).otherwise(F.col("line"))


def tool_lines(entries: DataFrame, cwd: str | None = None) -> DataFrame:
    """(session_key, block_index, pos, text, log_line, is_error, family, occurrences): calls of a block, equal ones (places aside) as one line at
    the first place with the last one's text."""
    called = with_blocks(entries).where("kind = 'tool_call'").select("session_key", "seq", "block_index", "family")
    rows = called.join(rendered_calls(entries, cwd).withColumnRenamed("call_seq", "seq").drop("sidechain"), ["session_key", "seq"]).withColumn("key", _alike())
    merged = rows.groupBy("session_key", "block_index", "key").agg(F.min("seq").alias("pos"), F.max_by("line", "seq").alias("line"), F.max_by("call_line", "seq").alias("log_line"), F.first("is_error").alias("is_error"), F.first("family").alias("family"), F.count("*").alias("occurrences"))
    return merged.select("session_key", "block_index", "pos", _times().alias("text"), "log_line", F.coalesce("is_error", F.lit(False)).alias("is_error"), "family", "occurrences")


def rendered_rows(entries: DataFrame) -> DataFrame:
    """All entries without their texts, calls with what ``blocks``, ``tool_lines`` and ``file_ops`` make of them, from one shuffle on the session.

    (session_key, seq, log_line, kind, ts, sidechain, chars, block_index, family, said, line, key, result_line, is_error, interrupted, run, failed, path, op, op_line, added, removed): block_index,
    said (narration) and key (of equal calls) are null outside blocks; is_error and interrupted of a call are its result's.
    """
    call, result, main = F.col("kind") == "tool_call", F.col("kind") == "tool_result", ~F.col("sidechain")
    of = lambda c: F.when(call, F.col(f"result.{c}")).alias(c)
    mixed = lambda c: F.when(call, F.col(f"result.{c}")).otherwise(F.col(c)).alias(c)
    rows = paired(entries).select(
        "session_key", "seq", F.col("log_line"), F.col("log_line").alias("call_line"), "kind", "ts", "sidechain", "turn_start", F.length(F.coalesce("text", "content", "tool_input", F.lit(""))).alias("chars"), "tool_name", "tool_input",
        F.when(main & F.col("kind").isin("user_text", "assistant_text", "tool_call"), F.col("kind")).alias("part"), "family", F.when(main & (F.col("kind") == "assistant_text"), T.cap_block(F.col("text"), 500)).alias("said"), _told().alias("told"),
        F.when(result & main & (F.col("owner") == "execute"), C.detect_checks(F.col("content"))).alias("checks"),
        F.when(call, F.col("result.log_line")).alias("result_line"), of("content"), mixed("is_error"), mixed("interrupted"), of("diff_added"), of("diff_removed"), "own_result",
        F.when(call, C.tool_signature(F.col("tool_name"), F.col("tool_input"))).alias("whole"),
    )
    operated, edit = call & main & F.col("family").isin("read", "edit"), F.col("family") == "edit"
    rows = _rendered(rows.withColumn("own", F.when(operated & edit, C.edit_diff(F.col("tool_name"), F.col("tool_input")))), F.col("whole"))
    slim = rows.select(
        "session_key", "seq", "log_line", "kind", "ts", "sidechain", "turn_start", "chars", "part", "family", "said", F.when(call, F.col("line")).otherwise(F.col("told")).alias("line"),
        F.when(F.col("part") == "tool_call", _alike()).alias("key"), "result_line", "is_error", "interrupted", "checks.run", "checks.failed", F.when(operated, F.nullif(C.extract_path(F.col("whole")), F.lit(""))).alias("path"), F.when(edit, "modify").otherwise("read").alias("op"),
        F.when(edit, F.coalesce("own_result.log_line", "call_line")).otherwise(F.col("call_line")).alias("op_line"), *(F.when(edit, F.coalesce(f"own_result.diff_{c}", f"own.{c}")).alias(c) for c in ("added", "removed")),
    )
    return _folded(slim, "part", dealt=True).drop("part", "turn_start")


def _told() -> Column:
    """The line of a prompt or a note."""
    listed = F.col("subtype").isin("away_summary", "compaction_summary", "compact_boundary", "pr-link")
    prompt, note = (F.col("kind") == "user_text") & ~F.col("sidechain"), (F.col("kind") == "system_note") & listed
    return F.when(prompt, F.concat(F.lit("> "), T.cap_block(F.col("text"), 700), F.lit(" "), T.ref_tag(F.col("log_line")))).when(note, F.concat(F.lit("- "), T.cap_line(F.col("text"), 240), F.lit(" "), T.ref_tag(F.col("log_line"))))


def block_lines(rows: DataFrame) -> DataFrame:
    """``blocks`` and, as tools, their ``tool_lines``, from rendered_rows: (session_key, block_index, label, summary, assistant_text, tools, calls, errors, line_from, line_to)."""
    call = F.col("kind") == "tool_call"
    line = F.coalesce("result_line", "log_line")
    own = rows.where("block_index is not null").select("session_key", "block_index", "key", "seq", "family", "said", "line", "kind", F.coalesce("is_error", F.lit(False)).alias("failed"), F.when(call, F.least("log_line", line)).alias("at"), F.when(call, F.greatest("log_line", line)).alias("to"))
    alike = own.repartition("session_key").groupBy("session_key", "block_index", "key").agg(
        F.min("seq").alias("pos"), F.max_by("line", "seq").alias("line"), F.max("family").alias("family"), F.count_if(call).alias("occurrences"), F.count_if(call & F.col("failed")).alias("errors"),
        F.max_by("said", F.when(F.col("kind") == "assistant_text", F.col("seq"))).alias("said"), F.min("at").alias("at"), F.max("to").alias("to"),
    )
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("occurrences"))), F.lit(0)).cast("bigint")
    known = F.col("key").isNotNull()
    tools = F.sort_array(F.collect_list(F.when(known, F.struct("pos", F.concat(F.lit("- "), _times()).alias("line")))))
    shaped = alike.groupBy("session_key", "block_index").agg(
        *(total(F.col("family") == f).alias(f"n_{f}") for f in FAMILIES), total(known).alias("calls"), F.sum("errors").alias("errors"), F.max("said").alias("assistant_text"),
        F.coalesce(F.min("at"), F.lit(0)).alias("line_from"), F.coalesce(F.max("to"), F.lit(0)).alias("line_to"), F.array_join(F.transform(tools, lambda x: x["line"]), "\n").alias("tools"),
    )
    return shaped.select("session_key", "block_index", _label().alias("label"), _summary().alias("summary"), "assistant_text", F.when(F.col("calls") > 0, F.col("tools")).alias("tools"), "calls", "errors", "line_from", "line_to")


def collapse_identical(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, run, value of the last row, n, first, last): neighbouring rows whose value is equal without references."""
    line = Window.partitionBy(key).orderBy(order)
    bare = T.strip_refs(F.col(value))
    marked = rows.withColumn("_bare", bare).withColumn("_new", F.when(F.col("_bare").eqNullSafe(F.lag("_bare").over(line)) & F.lag(F.lit(True)).over(line).isNotNull(), 0).otherwise(1)).withColumn("run", F.sum("_new").over(line))
    return marked.groupBy(key, "run").agg(F.max_by(value, order).alias(value), F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def file_ops(entries: DataFrame, parity: bool = False) -> DataFrame:
    """(session_key, seq, path, op, line, added, removed): a row for each read or edit; with ``parity`` the result counts again."""
    calls = call_results(entries.where("not sidechain"))
    rows = calls.withColumn("family", C.classify_tool(F.col("tool_name"))).where("family in ('read', 'edit')")
    rows = rows.withColumn("own", C.edit_diff(F.col("tool_name"), F.col("tool_input")))
    edit = F.col("family") == "edit"
    made = rows.select(
        "session_key", F.col("call_seq").alias("seq"), C.extract_path(C.tool_signature(F.col("tool_name"), F.col("tool_input"))).alias("path"), F.when(edit, "modify").otherwise("read").alias("op"),
        F.when(edit, F.coalesce("result_line", "call_line")).otherwise(F.col("call_line")).alias("line"), F.when(edit, F.coalesce("diff_added", "own.added")).alias("added"), F.when(edit, F.coalesce("diff_removed", "own.removed")).alias("removed"), F.col("result_seq").isNotNull().alias("answered"),
    ).where("path <> ''")
    return made.drop("answered") if not parity else made.unionAll(made.where("answered")).drop("answered")


#: Places of each kind that a ledger entry keeps.
REFS = 4


def ledger_of(ops: DataFrame, by: list[str], order: list[str], line: Column) -> DataFrame:
    """(by, reads, read_refs, modified, added, removed, modify_refs) of file operations: the first REFS lines of each kind, in order. Only these are
    gathered: Spark cuts each task's rows of a group to its first ones before the shuffle."""
    first = Window.partitionBy(*by, "op").orderBy(*order)
    kept = ops.withColumn("n", F.row_number().over(first)).where(F.col("n") <= REFS).select(*by, "op", F.struct("n", line.alias("line")).alias("r"))
    refs = lambda op: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("op") == op, F.col("r")))), lambda x: x["line"]), ",")
    listed = kept.groupBy(*by).agg(refs("read").alias("read_refs"), refs("modify").alias("modify_refs"))
    sums = ops.groupBy(*by).agg(F.count_if(F.col("op") == "read").alias("reads"), F.bool_or(F.col("op") == "modify").alias("modified"), *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("added", "removed")))
    return sums.join(listed, by).select(*by, "reads", "read_refs", "modified", "added", "removed", "modify_refs")


def file_ledger(entries: DataFrame, parity: bool = False) -> DataFrame:
    """(session_key, path, reads, read_refs, modified, added, removed, modify_refs): the first four lines of each kind."""
    return ledger_of(file_ops(entries, parity), ["session_key", "path"], ["seq"], F.col("line").cast("string"))


def file_index(ledger: DataFrame) -> DataFrame:
    """(session_key, path, id): F1, F2, ... over modified paths, then over the others, both by name."""
    place = Window.partitionBy("session_key").orderBy(F.desc("modified"), "path")
    return ledger.select("session_key", "path", F.concat(F.lit("F"), F.row_number().over(place).cast("string")).alias("id"))


def working_set(ledger: DataFrame) -> DataFrame:
    """Adds rank, by reads and then by name."""
    return ledger.withColumn("rank", F.row_number().over(Window.partitionBy("session_key").orderBy(F.desc("reads"), "path")).cast("bigint"))
