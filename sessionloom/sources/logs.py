"""JSONL session logs of coding agents, as numbered lines and as entries.

Every adapter is one projection from a line's JSON text to an array of entries, exploded in place; lines that are blank, no JSON
or of an unknown type give no entries but keep their number. A source is a function from line columns to entries, so
another kind of log is another function in ADAPTERS.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tools as C
from ..storage import written
from . import sniff
from .tables import _OWN, _TYPES, COLUMNS
from .tables import entry as _entry


#: Bytes of a range, of a task's ranges, and of a batch of lines; logs of a task.
RANGE, TASK_BYTES, BATCH_BYTES, TASK_LOGS = 16 << 20, 32 << 20, 4 << 20, 4_000
#: The hint of joins with a row for each log. Spark takes such tables for small, as paths shrink to little on disk and texts that Python
#: adds have a fixed guess; it would gather them in the driver to broadcast them.
JOIN = "merge"
_CHANGED = "the ranges of a log changed while it was read"


def read_lines(spark: SparkSession, *paths: str, only: list[str] | None = None, range_bytes: int | None = None) -> DataFrame:
    """(log_file, log_bytes, log_line, raw): the lines of log files, numbered from 1 with blank ones counted but left out.

    A log is read in byte ranges; a line belongs to the range where it begins. A first pass counts the lines of each range, a prefix sum over a
    log's ranges gives each range its first number, and the second pass numbers lines inside their range. Neither pass
    shuffles lines, and no task holds more than one line. ``only``, a short list, leaves all other files unread and cuts ranges as
    Spark's text source does; else see ``listed_lines``.
    """
    if only is None and all(map(sniff.opens, paths)):
        return listed_lines(sniff.tree(spark, list(paths)).where("log_bytes > 0"), range_bytes)
    pinned = {"spark.sql.files.minPartitionNum": spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)}
    # Both passes must see the same ranges, also when executors come or go between them.
    for k, v in pinned.items():
        spark.conf.set(k, v)
    listed = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(list(paths))
    if only is not None:
        listed = listed.where(F.col("_metadata.file_path").isin(only))
    rows = listed.select("value", F.col("_metadata.file_path").alias("log_file"), F.col("_metadata.file_size").alias("log_bytes"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"))
    ranges = rows.groupBy("log_file", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    up_to = Window.partitionBy("log_file").orderBy("range")
    ranges = written(ranges.withColumn("before", F.sum("n").over(up_to) - F.col("n")))
    inside = F.col("at") - F.col("first")
    known = F.when((inside >= 0) & (inside < F.col("n")), F.col("before") + inside + 1).otherwise(F.raise_error(F.lit(_CHANGED)))
    return _without_blank(rows.join(ranges, ["log_file", "range"], "left").select("log_file", "log_bytes", known.cast("bigint").alias("log_line"), "value"))


def _without_blank(lines: DataFrame) -> DataFrame:
    """Lines (value) without their carriage return, as raw, but for blank ones."""
    raw = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return lines.select("log_file", "log_bytes", "log_line", raw.alias("raw")).where(F.trim("raw") != "")


def listed_lines(listed: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """The lines of listed logs (log_file, log_bytes), as ``read_lines`` gives them, written to a table at once.

    The ranges are rows of a table, each task reads many of them, and nothing of them passes through the driver. Logs of one range need no first pass.
    """
    size, spark = range_bytes or RANGE, listed.sparkSession
    ranges = written(listed.select("log_file", "log_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("log_bytes") - 1, F.lit(size).cast("long"))).alias("range")))
    sums = ranges.agg(F.sum(F.least(F.lit(size), F.col("log_bytes") - F.col("range"))).alias("bytes"), F.count("*").alias("n"), F.count_if(F.col("log_bytes") > size).alias("cut")).first()
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-(sums["bytes"] or 0) // TASK_BYTES), -(-sums["n"] // TASK_LOGS))
    before = ranges.where(F.col("log_bytes") <= size).select("*", F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("n"))
    if sums["cut"]:
        counted = ranges.where(F.col("log_bytes") > size).repartition(tasks, "log_file", "range").mapInArrow(_counting(size), "log_file string, log_bytes long, range long, n long")
        up_to = Window.partitionBy("log_file").orderBy("range")
        before = before.unionByName(written(counted.withColumn("before", F.sum("n").over(up_to) - F.col("n"))))
    read = before.repartition(tasks, "log_file", "range").mapInArrow(_numbering(size), "log_file string, log_bytes long, log_line long, value binary")
    return written(_without_blank(read.withColumn("value", F.col("value").cast("string"))))


def _counting(size: int):
    """Adds to ranges how many lines begin in each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path, whole, start in zip(*(batch.column(c).to_pylist() for c in ("log_file", "log_bytes", "range")), strict=True):
                left = min(size, whole - start) - (start == 0)
                n = int(start == 0)
                with sniff.opened(path) as f:
                    f.seek(max(0, start - 1))
                    while left > 0 and (piece := f.read(min(left, 1 << 20))):
                        n, left = n + piece.count(b"\n"), left - len(piece)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("log_file", "log_bytes", "range")), pa.array(counts, pa.int64())], names=["log_file", "log_bytes", "range", "n"])

    return work


def _numbering(size: int):
    """The lines of ranges; before: how many lines stand before a range, n: how many begin in it, if counted."""

    def begun(path: str, start: int, end: int) -> Iterator[bytes]:
        with sniff.opened(path) as f:
            stream = io.BufferedReader(f, min(1 << 20, end - start + 1))
            stream.seek(max(0, start - 1))
            at = start
            if start:
                skipped = stream.readline(end - start + 1)
                at += len(skipped) - 1
                if not skipped.endswith(b"\n"):
                    return
            while at < end and (line := stream.readline()):
                yield line.removeprefix(b"\xef\xbb\xbf") if at == 0 else line
                at += len(line)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        made = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["log_file", "log_bytes", "log_line", "value"])
        for batch in batches:
            for path, whole, start, before, n in zip(*(batch.column(c).to_pylist() for c in ("log_file", "log_bytes", "range", "before", "n")), strict=True):
                number = before
                for line in begun(path, start, min(whole, start + size)):
                    number += 1
                    rows.append((path, whole, number, line.removesuffix(b"\n")))
                    held += len(line) + 100
                    if held > BATCH_BYTES:
                        yield made()
                        rows, held = [], 0
                if n is not None and number != before + n:
                    raise ValueError(_CHANGED)
        if rows:
            yield made()

    return work


def _get(record: Column, path: str) -> Column:
    return F.get_json_object(record, f"$.{path}")


def _text(record: Column, path: str) -> Column:
    """A field's text, or empty."""
    return F.coalesce(_get(record, path), F.lit(""))


def _list(record: Column) -> Column:
    """The elements of a JSON array as JSON texts; of anything else none."""
    return F.when(F.startswith(F.ltrim(record), F.lit("[")), F.coalesce(F.from_json(record, "array<string>"), F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))


def _none() -> Column:
    return F.array().cast(f"array<struct<{','.join(f'{c}:{_TYPES[c]}' for c in _OWN)}>>")


def _one(entry: Column, when: Column) -> Column:
    return F.when(when, F.array(entry)).otherwise(_none())


def _filled(text: Column) -> Column:
    return F.length(T.trimmed(text)) > 0


def _joined(parts: Column, *fields: str) -> Column:
    """The texts of content parts, one a line; a plain string stands for itself."""
    texts = F.transform(_list(parts), lambda b: F.coalesce(*(_get(b, f) for f in fields), F.lit("")))
    return F.when(F.startswith(F.ltrim(parts), F.lit("[")), F.array_join(F.filter(texts, lambda t: t != ""), "\n")).otherwise(F.coalesce(parts, F.lit("")))


def _claude(raw: Column) -> Column:
    kind, content = _get(raw, "type"), _get(raw, "message.content")
    side = _get(raw, "isSidechain") == "true"
    diffed = _get(raw, "toolUseResult.type") == "file"
    patch = F.flatten(F.transform(_list(_get(raw, "toolUseResult.file.structuredPatch")), lambda h: _list(_get(h, "lines"))))
    signs = lambda s: F.size(F.filter(patch, lambda x: F.startswith(x, F.lit(s)))).cast("bigint")
    moved = diffed & (signs("+") + signs("-") > 0)

    def user(b: Column) -> Column:
        body = _get(b, "content")
        image = F.transform(_list(body), lambda c: F.when(_get(c, "type") == "image", "[image]").when(_get(c, "type") == "text", _text(c, "text")).otherwise(""))
        said = F.when(F.startswith(F.ltrim(body), F.lit("[")), F.array_join(F.filter(image, lambda t: t != ""), "\n")).otherwise(F.coalesce(body, F.lit("")))
        cut = (_get(raw, "toolUseResult.interrupted") == "true") | F.contains(said, F.lit("[Request interrupted by user"))
        result = _entry("tool_result", tool_call_id=_text(b, "tool_use_id"), content=said, is_error=_get(b, "is_error") == "true", interrupted=cut, sidechain=side, diff_added=F.when(moved, signs("+")), diff_removed=F.when(moved, signs("-")), diff_path=F.when(diffed, _get(raw, "toolUseResult.file.filePath")))
        own = T.clean_user_text(_text(b, "text"))
        return F.when((_get(b, "type") == "text") & own.isNotNull(), _entry("user_text", text=own, sidechain=side)).when(_get(b, "type") == "tool_result", result)

    def assistant(b: Column, i: Column) -> Column:
        what, first = _get(b, "type"), i == 0
        return (
            F.when((what == "text") & _filled(_text(b, "text")), _entry("assistant_text", text=_get(b, "text"), sidechain=side, turn_start=first))
            .when((what == "thinking") & _filled(_text(b, "thinking")), _entry("assistant_thinking", text=_get(b, "thinking"), sidechain=side, turn_start=first))
            .when(what == "tool_use", _entry("tool_call", tool_name=F.coalesce(_get(b, "name"), F.lit("unknown")), tool_input=_get(b, "input"), tool_call_id=_text(b, "id"), sidechain=side, turn_start=first))
        )

    plain = T.clean_user_text(content)
    listed = F.startswith(F.ltrim(content), F.lit("["))
    users = F.when(listed, F.transform(_list(content), user)).otherwise(_one(_entry("user_text", text=plain, sidechain=side), plain.isNotNull()))
    subtype = F.coalesce(_get(raw, "subtype"), F.lit("system"))
    note = lambda sub, text: _entry("system_note", subtype=sub, text=text, sidechain=side)
    compact = _entry("compaction", sidechain=side)
    inner = _get(raw, "content")
    tokens = F.when(_get(inner, "preTokens").isNotNull() & _get(inner, "postTokens").isNotNull(), F.concat(_get(inner, "preTokens"), F.lit("→"), _get(inner, "postTokens"), F.lit(" tokens")))
    boundary = F.concat_ws(", ", F.lit("history compacted"), F.concat(F.lit("trigger="), _get(inner, "trigger")), tokens)
    summary = F.left(_joined(content, "text"), F.lit(400))
    return (
        F.when((kind == "user") & (_get(raw, "isCompactSummary") == "true"), F.concat(F.array(compact), _one(note(F.lit("compaction_summary"), summary), summary != "")))
        .when((kind == "user") & (F.coalesce(_get(raw, "isMeta"), F.lit("")) != "true"), users)
        .when(kind == "assistant", F.transform(_list(content), assistant))
        .when((kind == "system") & (subtype == "compact_boundary"), F.array(compact, note(F.lit("compact_boundary"), boundary)))
        .when((kind == "system") & ~subtype.isin(*NOISY["claude"]), _one(note(subtype, inner), ~F.coalesce(inner, F.lit("")).isin("", "null")))
        .when((kind == "pr-link") & _get(raw, "prUrl").isNotNull(), F.array(note(F.lit("pr-link"), F.format_string("PR !%s: %s", _get(raw, "prNumber"), _get(raw, "prUrl")))))
    )


#: System subtypes that carry no content worth keeping (fixed values).
NOISY = {
    "claude": ("turn_duration", "status", "status_change"),
    "qwen": ("ui_telemetry", "attribution_snapshot", "file_history_snapshot", "turn_result", "branch_checkpoint", "slash_command", "goal_state"),
}


def _codex(raw: Column) -> Column:
    p = _get(raw, "payload")
    what, role = _get(p, "type"), _get(p, "role")
    said = _joined(_get(p, "content"), "text")
    noise = said.rlike(r"^(<user_instructions>|<ENVIRONMENT_CONTEXT>|<permissions|# AGENTS\.md)")
    inputs = F.transform(F.regexp_extract_all(said, F.lit(r"(?s)<input>(.*?)</input>"), F.lit(1)), lambda t: T.trimmed(t))
    wrapped = said.rlike(r"^\s*<(realtime|codex)_delegation>") & (F.size(inputs) > 0)
    asked = F.when(wrapped, F.concat(F.lit("[delegation:"), F.regexp_extract(said, r"^\s*<(realtime|codex)_delegation>", 1), F.lit("]\n"), F.array_join(inputs, "\n---\n"))).otherwise(said)
    mail = r"(?s)^Message Type:\s*(\S+).*?Payload:\s*\n?(.*)$"
    label = F.concat(F.lit("["), F.when(said.rlike(mail), F.regexp_extract(said, mail, 1)).otherwise("message"), F.lit("] "))
    body = F.when(said.rlike(mail), T.trimmed(F.regexp_extract(said, mail, 2))).otherwise("")
    hidden = F.concat(label, F.when(F.contains(_text(p, "content"), F.lit("encrypted_content")), "payload encrypted/hidden").otherwise("empty payload"), F.lit(" (sender "), F.coalesce(_get(p, "author"), F.lit("?")), F.lit(")"))
    output = F.when(F.startswith(F.ltrim(_text(p, "output")), F.lit("[")), _joined(_get(p, "output"), "text")).otherwise(_text(p, "output"))
    code = C.exit_code(output)
    patch = C.patch_diff(F.coalesce(_get(_get(p, "arguments"), "input"), _get(_get(p, "arguments"), "patch")))
    item = (
        F.when((what == "message") & (said != "") & (role == "user") & ~noise, _entry("user_text", text=asked)).when((what == "message") & (said != "") & (role == "assistant"), _entry("assistant_text", text=said))
        .when((what == "message") & (said != "") & role.isin("system", "developer"), _entry("system_note", subtype=role, text=F.left(said, F.lit(200))))
        .when((what == "reasoning") & (_joined(_get(p, "summary"), "text") != ""), _entry("assistant_thinking", text=_joined(_get(p, "summary"), "text")))
        .when(what == "function_call", _entry("tool_call", tool_name=F.coalesce(_get(p, "name"), F.lit("unknown")), tool_input=_get(p, "arguments"), tool_call_id=_text(p, "call_id"), diff_added=patch["added"], diff_removed=patch["removed"], diff_path=patch["file_path"]))
        .when(what == "function_call_output", _entry("tool_result", tool_call_id=_text(p, "call_id"), content=output, is_error=F.coalesce(code != 0, F.lit(False)), exit_code=code))
        .when((what == "agent_message") & (said != ""), _entry("system_note", subtype=F.lit("agent_message"), text=F.left(F.when(body != "", F.concat(label, body)).otherwise(hidden), F.lit(300))))
    )
    return F.when(_get(raw, "type") == "response_item", F.array(item))


def _blocks(content: Column, role: Column, noise: Column | None = None) -> Column:
    """Entries of {type: text | thinking | toolCall} blocks."""

    def one(b: Column) -> Column:
        what, said = _get(b, "type"), _text(b, "text")
        return (
            F.when((what == "text") & _filled(said) & (role == "user"), _entry("user_text", text=said)).when((what == "text") & _filled(said) & (role == "assistant"), _entry("assistant_text", text=said))
            .when((what == "thinking") & _filled(_text(b, "thinking")), _entry("assistant_thinking", text=_get(b, "thinking")))
            .when(what == "toolCall", _entry("tool_call", tool_name=F.coalesce(_get(b, "name"), F.lit("unknown")), tool_input=_get(b, "arguments"), tool_call_id=_text(b, "id")))
        )

    return F.transform(_list(content), one)


def _pi(raw: Column) -> Column:
    m = _get(raw, "message")
    role, content = _get(m, "role"), _get(m, "content")
    made = F.filter(_blocks(content, role), lambda e: ~((e["kind"] == "user_text") & e["text"].rlike(r"^(<user_instructions>|<ENVIRONMENT_CONTEXT>|<permissions|# AGENTS\.md)")))
    result = _entry("tool_result", tool_call_id=_text(m, "toolCallId"), content=_joined(content, "text"), is_error=_get(m, "isError") == "true")
    return F.when(_get(raw, "type") == "message", F.when(role == "toolResult", F.array(result)).otherwise(made))


def _qwen(raw: Column) -> Column:
    kind, parts = _get(raw, "type"), _list(_get(raw, "message.parts"))
    origin = F.coalesce(_get(raw, "provenance"), F.lit("real_user"))
    said = lambda b: T.trimmed(_text(b, "text"))
    user = lambda b: F.when(said(b) != "", F.when(origin.isin("system", "goal_runtime"), _entry("system_note", subtype=origin, text=said(b))).otherwise(_entry("user_text", text=said(b))))

    def assistant(b: Column) -> Column:
        call = _get(b, "functionCall")
        return (
            F.when(call.isNotNull(), _entry("tool_call", tool_name=F.coalesce(_get(call, "name"), F.lit("unknown")), tool_input=_get(call, "args"), tool_call_id=_text(call, "id")))
            .when(_filled(_text(b, "text")) & (F.coalesce(_get(b, "thought"), F.lit("")) == "true"), _entry("assistant_thinking", text=_get(b, "text"))).when(_filled(_text(b, "text")), _entry("assistant_text", text=_get(b, "text")))
        )

    started = F.transform(F.filter(F.transform(parts, assistant), lambda e: e.isNotNull()), lambda e, i: e.withField("turn_start", i == 0))
    answer = lambda b: F.when(_get(b, "functionResponse").isNotNull(), _entry("tool_result", tool_call_id=_text(b, "functionResponse.id"), content=F.coalesce(_get(b, "functionResponse.response.error"), _text(b, "functionResponse.response.output")), is_error=_get(b, "functionResponse.response.error").isNotNull()))
    subtype, load = F.coalesce(_get(raw, "subtype"), F.lit("system")), _get(raw, "systemPayload")
    counts = F.when(_get(load, "info.originalTokenCount").isNotNull() & _get(load, "info.newTokenCount").isNotNull(), F.concat(_get(load, "info.originalTokenCount"), F.lit("→"), _get(load, "info.newTokenCount"), F.lit(" tokens")))
    packed = F.concat_ws(", ", F.lit("history compacted"), F.concat(F.lit("trigger="), _get(load, "info.triggerReason")), counts)
    return (
        F.when(kind == "user", F.transform(parts, user)).when(kind == "assistant", started).when(kind == "tool_result", F.transform(parts, answer))
        .when((kind == "system") & (subtype == "chat_compression"), F.array(_entry("compaction"), _entry("system_note", subtype=F.lit("chat_compression"), text=packed)))
        .when((kind == "system") & ~subtype.isin("session_model", *NOISY["qwen"]), _one(_entry("system_note", subtype=subtype, text=load), ~F.coalesce(load, F.lit("{}")).isin("{}", "")))
    )


def _kimi_wire(message: Column, side: Column) -> Column:
    kind, p = _get(message, "type"), _get(message, "payload")
    asked = _joined(_get(p, "user_input"), "text")
    output = F.when(_text(p, "return_value.output") != "", _get(p, "return_value.output")).otherwise(_text(p, "return_value.message"))
    questions = F.array_join(F.filter(F.transform(_list(_get(p, "questions")), lambda q: _text(q, "question")), lambda t: t != ""), "; ")
    note = lambda sub, text: _entry("system_note", subtype=sub, text=text, sidechain=side)
    lines = lambda *parts: F.array_join(F.filter(F.array(*parts), lambda t: t != ""), "\n")
    return (
        F.when((kind == "TurnBegin") & _filled(asked), _entry("user_text", text=asked, sidechain=side))
        .when((kind == "ContentPart") & (_get(p, "type") == "think") & _filled(_text(p, "think")), _entry("assistant_thinking", text=_get(p, "think"), sidechain=side))
        .when((kind == "ContentPart") & (_get(p, "type") == "text") & _filled(_text(p, "text")), _entry("assistant_text", text=_get(p, "text"), sidechain=side))
        .when(kind == "ToolCall", _entry("tool_call", tool_name=F.coalesce(F.nullif(_text(p, "function.name"), F.lit("")), F.lit("unknown")), tool_input=_get(p, "function.arguments"), tool_call_id=_text(p, "id"), sidechain=side))
        .when(kind == "ToolResult", _entry("tool_result", tool_call_id=_text(p, "tool_call_id"), content=output, is_error=_get(p, "return_value.is_error") == "true", sidechain=side))
        .when(kind == "StepInterrupted", note(F.lit("step_interrupted"), F.lit("step interrupted"))).when(kind == "QuestionRequest", note(F.lit("question"), questions))
        .when(kind == "Notification", note(F.concat(F.lit("notification:"), F.coalesce(F.nullif(_text(p, "category"), F.lit("")), F.lit("general"))), lines(_text(p, "title"), _text(p, "body"))))
        .when(kind == "PlanDisplay", note(F.lit("plan"), lines(_text(p, "file_path"), _text(p, "content")))).when(kind == "CompactionBegin", _entry("compaction", sidechain=side))
    )


def _kimi(raw: Column) -> Column:
    message, kind = _get(raw, "message"), _get(raw, "type")
    nested = [message]
    for _ in range(3):  # wire messages of sub-agents can be wrapped again
        nested.append(F.when(_get(nested[-1], "type") == "SubagentEvent", _get(nested[-1], "payload.event")))
    wire = F.coalesce(_kimi_wire(nested[0], F.lit(False)), *(_kimi_wire(n, F.lit(True)) for n in nested[1:]))
    ev, asked, told = _get(raw, "event"), _joined(_get(raw, "input"), "text"), _joined(_get(message, "content"), "text")
    step = _get(ev, "type")
    result = F.when(_text(ev, "result.output") != "", _get(ev, "result.output")).otherwise(_text(ev, "result.note"))
    loop = (
        F.when((step == "content.part") & (_get(ev, "part.type") == "think") & _filled(_text(ev, "part.think")), _entry("assistant_thinking", text=_get(ev, "part.think")))
        .when((step == "content.part") & (_get(ev, "part.type") == "text") & _filled(_text(ev, "part.text")), _entry("assistant_text", text=_get(ev, "part.text")))
        .when(step == "tool.call", _entry("tool_call", tool_name=F.coalesce(_get(ev, "name"), F.lit("unknown")), tool_input=_get(ev, "args"), tool_call_id=F.coalesce(_get(ev, "toolCallId"), _text(ev, "uuid"))))
        .when(step == "tool.result", _entry("tool_result", tool_call_id=_text(ev, "toolCallId"), content=result, is_error=F.coalesce(_get(ev, "result.isError"), _text(ev, "result.is_error")) == "true"))
    )
    wrapped = told.rlike(r"(?s)^\s*<[^>]+>.*</[^>]+>\s*$")
    events = (
        F.when(kind.isin("turn.prompt", "turn.steer") & _filled(asked), _entry("user_text", text=asked, subtype=kind)).when(kind == "turn.cancel", _entry("system_note", subtype=F.lit("turn_cancel"), text=F.lit("turn cancelled")))
        .when((kind == "context.append_message") & (_get(message, "role") == "user") & _filled(told), F.when(wrapped, _entry("system_note", subtype=F.lit("context_message"), text=told)).otherwise(_entry("user_text", text=told, subtype=F.lit("mirror"))))
        .when(kind == "context.append_loop_event", loop).when(kind.isin("context.apply_compaction", "full_compaction.begin"), _entry("compaction"))
        .when(kind == "interaction.request", _entry("system_note", subtype=F.lit("question"), text=F.coalesce(_get(raw, "kind"), F.lit("interaction"))))
    )
    return F.array(F.when(kind.isNull(), wire).otherwise(events))


def _minimax(raw: Column) -> Column:
    m = _get(raw, "message")
    role, content = _get(m, "role"), _get(m, "content")
    made = F.transform(_blocks(content, role), lambda e: F.when(e["kind"] == "user_text", e.withField("text", T.trimmed(T.strip_envelopes(e["text"])))).otherwise(e))
    kept = F.filter(made, lambda e: e.isNotNull() & ((e["kind"] != "user_text") | (e["text"] != "")))
    result = _entry("tool_result", tool_call_id=_text(m, "toolCallId"), content=_joined(content, "text"), is_error=_get(m, "isError") == "true", diff_path=_get(m, "details.textFile.path"))
    packed = F.concat_ws(", ", F.lit("history compacted"), F.concat(_get(m, "tokensBefore"), F.lit(" tokens before")))
    return F.when(role.isin("user", "assistant"), kept).when(role == "toolResult", F.array(result)).when(role == "compactionSummary", F.array(_entry("compaction"), _entry("system_note", subtype=F.lit("compaction"), text=packed)))


def _cursor(raw: Column) -> Column:
    kind = _get(raw, "kind")
    return F.array(
        F.when(kind.isin("user_text", "assistant_thinking", "assistant_text") & _filled(_text(raw, "text")), _entry(kind, text=_get(raw, "text")))
        .when((kind == "tool_call") & _get(raw, "name").isNotNull(), _entry("tool_call", tool_name=_get(raw, "name"), tool_input=_get(raw, "input"), tool_call_id=_text(raw, "toolCallId")))
        .when((kind == "tool_result") & (_text(raw, "content") != ""), _entry("tool_result", tool_call_id=_text(raw, "toolCallId"), content=_get(raw, "content"), is_error=_get(raw, "isError") == "true"))
    )


@dataclass(frozen=True)
class Adapter:
    """How one kind of log is read."""

    entries: Callable[[Column], Column]
    stamp: Callable[[Column], Column]  # a line's time as ISO text, or null
    inherits: bool  # does a line without a time take the one before?
    session_id: Callable[[Column], Column] = lambda raw: F.lit(None).cast("string")
    cwd: Callable[[Column], Column] = lambda raw: F.lit(None).cast("string")
    model: Callable[[Column], Column] = lambda raw: F.lit(None).cast("string")
    title: Callable[[Column], Column] = lambda raw: F.lit(None).cast("string")
    usage: tuple[str, ...] = ()  # input, output, cache read, cache write, as JSON paths


def _millis(raw: Column, path: str) -> Column:
    return T.iso_from_millis(_get(raw, path).try_cast("double"))


_iso = lambda raw: _get(raw, "timestamp")
_kimi_time = lambda raw: F.coalesce(_millis(raw, "time"), T.iso_from_millis(_get(raw, "timestamp").try_cast("double") * 1000))

ADAPTERS: dict[str, Adapter] = {
    "claude": Adapter(_claude, _iso, True, lambda r: _get(r, "sessionId"), lambda r: _get(r, "cwd"), lambda r: _get(r, "message.model"), lambda r: F.coalesce(_get(r, "aiTitle"), _get(r, "customTitle")), ("message.usage.input_tokens", "message.usage.output_tokens", "message.usage.cache_read_input_tokens", "message.usage.cache_creation_input_tokens")),
    "codex": Adapter(_codex, _iso, True, lambda r: F.when(_get(r, "type") == "session_meta", _get(r, "payload.id")), lambda r: F.when(_get(r, "type") == "session_meta", _get(r, "payload.cwd")), lambda r: F.when(_get(r, "type") == "turn_context", _get(r, "payload.model"))),
    "pi": Adapter(_pi, _iso, True, lambda r: F.when(_get(r, "type") == "session", _get(r, "id")), lambda r: F.when(_get(r, "type") == "session", _get(r, "cwd")), lambda r: F.when(_get(r, "type") == "model_change", _get(r, "model")), usage=("message.usage.input", "message.usage.output", "message.usage.cacheRead", "message.usage.cacheWrite")),
    "qwen": Adapter(_qwen, _iso, True, lambda r: _get(r, "sessionId"), lambda r: _get(r, "cwd"), lambda r: F.coalesce(_get(r, "model"), _get(r, "systemPayload.modelId")), usage=("usageMetadata.promptTokenCount", "usageMetadata.candidatesTokenCount", "usageMetadata.cachedContentTokenCount", "usageMetadata.none")),
    "kimi": Adapter(_kimi, _kimi_time, True, cwd=lambda r: F.nullif(F.regexp_extract(r, r"Working directory: ([^\\\n\"'`]+)", 1), F.lit("")), model=lambda r: F.coalesce(_get(r, "model"), _get(r, "modelAlias")), usage=("usage.inputOther", "usage.output", "usage.inputCacheRead", "usage.inputCacheCreation")),
    "minimax": Adapter(_minimax, lambda r: _millis(r, "message.timestamp"), False, cwd=lambda r: F.nullif(F.trim(F.regexp_extract(r, r"YOUR WORKSPACE DIRECTORY:[ \t]*([^\\\n\"]+)", 1)), F.lit("")), model=lambda r: _get(r, "message.model"), usage=("message.usage.input", "message.usage.output", "message.usage.cacheRead", "message.usage.cacheWrite")),
    "cursor": Adapter(_cursor, lambda r: _get(r, "ts"), False),
}


def _stamped(lines: DataFrame, source: str) -> DataFrame:
    """Lines that are JSON objects, with ts."""
    own = lines.where(F.startswith(F.ltrim("raw"), F.lit("{")) & F.try_parse_json(F.col("raw")).isNotNull())
    ts = ADAPTERS[source].stamp(F.col("raw"))
    line = Window.partitionBy("log_file").orderBy("log_line").rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumn("ts", F.coalesce(F.last(ts, ignorenulls=True).over(line) if ADAPTERS[source].inherits else ts, F.lit("")))


def entries(lines: DataFrame, source: str) -> DataFrame:
    """The entry table of one source's log lines; session_key is made of the file's path."""
    made = _stamped(lines, source).withColumn("_e", F.filter(F.coalesce(ADAPTERS[source].entries(F.col("raw")), _none()), lambda e: e.isNotNull()))
    rows = made.select("log_file", "log_line", "ts", _get(F.col("raw"), "turn_id").alias("_turn"), _get(F.coalesce(_get(F.col("raw"), "message"), F.col("raw")), "type").alias("_type"), _get(F.col("raw"), "event.type").alias("_step"), F.posexplode_outer("_e").alias("_p", "_x"))
    flat = rows.select(T.session_key(F.col("log_file")).alias("session_key"), "log_line", "_p", "_turn", "_type", "_step", F.col("ts").alias("_ts"), "_x.*").drop("ts").withColumnRenamed("_ts", "ts")
    line = Window.partitionBy("session_key").orderBy("log_line", "_p")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    if source == "minimax":  # a new turn id starts a turn
        real = flat.where("kind is not null")
        flat = real.withColumn("turn_start", F.col("_turn").isNotNull() & ~F.col("_turn").eqNullSafe(F.last("_turn", ignorenulls=True).over(before)))
    if source == "kimi":
        opens = F.col("_type").isin("TurnBegin", "StepBegin", "turn.prompt", "turn.steer") | F.coalesce(F.col("_step") == "step.begin", F.lit(False))
        said = F.col("kind").isin("assistant_text", "assistant_thinking", "tool_call") & ~F.col("sidechain")
        mark = F.when(opens & ~F.coalesce("sidechain", F.lit(False)), True).when(said, False)
        flat = flat.withColumn("turn_start", F.coalesce(said & F.last(mark, ignorenulls=True).over(before), F.lit(False)))
        prompt = F.last(F.when(F.col("subtype") == "turn.prompt", F.col("text")), ignorenulls=True).over(before)
        flat = flat.withColumn("_mirror", (F.col("subtype") == "mirror") & (F.col("text") == prompt)).where("_mirror is null or not _mirror")
        flat = flat.withColumn("subtype", F.when(F.col("kind") != "user_text", F.col("subtype")))
    numbered = flat.where("kind is not null").withColumn("seq", F.row_number().over(line).cast("bigint"))
    return numbered.select(*COLUMNS)


def sessions(lines: DataFrame, source: str) -> DataFrame:
    """(session_key, source, session_id, log_file, log_lines, log_bytes, cwd, model, title, started_at, ended_at, requests, input, output, cache_read, cache_write)."""
    a, raw = ADAPTERS[source], F.col("raw")
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("log_line")))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("log_line")))
    known = F.when(F.col("ts") != "", F.col("ts"))
    ended = F.max(known) if source in ("kimi", "minimax") else last(known)
    number = lambda p: F.coalesce(F.sum(_get(raw, p).try_cast("bigint")), F.lit(0)).cast("bigint")
    paths = a.usage or ("none",) * 4
    stem = F.regexp_extract("log_file", r"([^/]+?)(?:\.jsonl)?$", 1)
    made = _stamped(lines, source).groupBy("log_file").agg(
        (first if source == "codex" else last)(a.session_id(raw)).alias("_id"), (last if source == "pi" else first)(a.cwd(raw)).alias("cwd"), (first if source in ("kimi", "minimax") else last)(a.model(raw)).alias("model"),
        F.coalesce(last(_get(raw, "aiTitle")), first(a.title(raw))).alias("title"), F.min(known).alias("started_at"), ended.alias("ended_at"), F.count(_get(raw, paths[0])).alias("requests"), *(number(p).alias(n) for p, n in zip(paths, ("input", "output", "cache_read", "cache_write"), strict=True)),
        first(F.when(_get(raw, "type") == "session_meta", _get(raw, "payload.source.subagent.thread_spawn.parent_thread_id"))).alias("parent_thread_id"), last(_get(raw, "uuid")).alias("last_uuid"), last(_get(raw, "leafUuid")).alias("leaf_uuid"), F.max_by(_get(raw, "logicalParentUuid"), F.when((_get(raw, "type") == "user") & (_get(raw, "isCompactSummary") == "true"), F.col("log_line"))).alias("logical_parent_uuid"),
    )
    sizes = lines.groupBy("log_file").agg(F.max("log_line").alias("log_lines"), F.max("log_bytes").alias("log_bytes"))
    rows = sizes.join(made.hint(JOIN), "log_file", "left")
    return rows.select(T.session_key(F.col("log_file")).alias("session_key"), F.lit(source).alias("source"), F.coalesce("_id", stem).alias("session_id"), "log_file", "log_lines", "log_bytes", F.coalesce("cwd", F.lit("")).alias("cwd"), "model", "title", "started_at", "ended_at", F.when(F.col("parent_thread_id").isNotNull(), "subagent").otherwise("main").alias("role"), "parent_thread_id", "last_uuid", "leaf_uuid", "logical_parent_uuid", "requests", "input", "output", "cache_read", "cache_write")


def codex_usage(lines: DataFrame) -> DataFrame:
    """(session_key, requests, input, output, cache_read) from cumulative counters: unchanged ones don't count, replayed metas reset the
    baseline, a first one without a last turn's figures is a baseline only."""
    p = _get(F.col("raw"), "payload")
    own = lines.withColumn("_meta", F.sum(F.when(_get(F.col("raw"), "type") == "session_meta", 1).otherwise(0)).over(Window.partitionBy("log_file").orderBy("log_line")))
    total = [F.coalesce(_get(p, f"info.total_token_usage.{k}").try_cast("bigint"), F.lit(0)) for k in ("input_tokens", "output_tokens", "cached_input_tokens")]
    rows = own.where((_get(p, "type") == "token_count") & _get(p, "info.total_token_usage").isNotNull()).withColumn("_t", F.array(*total)).withColumn("_last", _get(p, "info.last_token_usage"))
    line = Window.partitionBy("log_file", "_meta").orderBy("log_line")
    rows = rows.withColumn("_before", F.lag("_t").over(line)).where("_before is null or _t <> _before")
    real = F.col("_before").isNotNull() | F.col("_last").isNotNull()
    part = lambda i, k: F.when(F.col("_last").isNotNull(), F.coalesce(_get(F.col("_last"), k).try_cast("bigint"), F.lit(0))).when(F.col("_before").isNotNull(), F.greatest(F.lit(0), F.col("_t")[i] - F.col("_before")[i]))
    return rows.groupBy(T.session_key(F.col("log_file")).alias("session_key")).agg(F.count_if(real).alias("requests"), *(F.coalesce(F.sum(part(i, k)), F.lit(0)).cast("bigint").alias(n) for i, (k, n) in enumerate((("input_tokens", "input"), ("output_tokens", "output"), ("cached_input_tokens", "cache_read")))))


def under(sessions_: DataFrame, root: str) -> DataFrame:
    """Sessions whose working directory is ``root`` or below it."""
    clean = root.rstrip("/")
    return sessions_.where((F.col("cwd") == clean) | F.startswith(F.col("cwd"), F.lit(clean + "/")))
