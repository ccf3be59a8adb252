"""Queries that write conversations as logs of each kind, line by line, and read them back through the kind's adapter.

A conversation is a log: a header line, then four lines for each turn. A prompt is a user's turn; an answer is thinking, text and a
call, on one line or on three, and the call's result on the fourth line. Lines that hold nothing are the bare text, which is no JSON.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import logs as L

QUERIES, ORACLES = {}, {}

START = 1_714_557_600  # 2024-05-01T10:00:00Z
KEPT = ("session_key", "seq", "log_line", "kind", "text", "tool_name", "tool_input", "tool_call_id", "content", "is_error", "exit_code", "diff_added", "diff_removed", "diff_path", "subtype", "ts", "turn_start")


def _o(**fields: Column | str) -> Column:
    return F.struct(*((F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()))


def _json(**fields: Column | str) -> Column:
    """A line: null fields are left out."""
    return F.to_json(_o(**fields))


def _blocks(*blocks: dict[str, Column | str]) -> Column:
    """An array of objects that need not have the same fields."""
    names = list(dict.fromkeys(k for b in blocks for k in b))
    return F.array(*(_o(**{k: b.get(k, F.lit(None)) for k in names}) for b in blocks))


class _Line:
    """The columns that lines are made of."""

    def __init__(self):
        self.text, self.turn, self.call, self.cwd, self.slot = map(F.col, ("text", "turn", "id", "cwd", "slot"))
        self.user, self.assistant, self.system = (F.col("role") == r for r in ("user", "assistant", "system"))
        self.seconds = F.lit(START) + self.turn
        self.at = F.date_format(F.timestamp_seconds(self.seconds), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        self.bad = self.turn % 3 == 0
        self.path = F.concat(self.cwd, F.lit("/f.py"))
        self.input = _o(file_path=self.path)
        self.said = F.array(_o(type="text", text=self.text))
        self.used = _o(input=F.length(self.text), output=self.turn)
        self.answer = _blocks({"type": "thinking", "thinking": self.text}, {"type": "text", "text": self.text}, {"type": "toolCall", "id": self.call, "name": "Read", "arguments": self.input})


def _claude(r: _Line) -> Column:
    said = _blocks({"type": "thinking", "thinking": r.text}, {"type": "text", "text": r.text}, {"type": "tool_use", "id": r.call, "name": "Read", "input": r.input})
    patch = _o(type="file", file=_o(filePath=r.path, structuredPatch=F.array(_o(lines=F.array(F.lit("+a"), F.lit("-b"), F.lit(" c"), F.lit("+d"))))))
    return (
        F.when(r.slot == 0, _json(type="summary", sessionId=F.concat(F.lit("s-"), "conv_id"), cwd=r.cwd))
        .when((r.slot == 1) & r.user, _json(type="user", timestamp=r.at, message=_o(role="user", content=r.text)))
        .when((r.slot == 1) & r.assistant, _json(type="assistant", timestamp=r.at, message=_o(model="m-1", usage=_o(input_tokens=F.length(r.text), output_tokens=r.turn), content=said)))
        .when((r.slot == 1) & r.system, _json(type="system", subtype="away_summary", timestamp=r.at, content=r.text))
        .when((r.slot == 4) & r.assistant, _json(type="user", message=_o(content=F.array(_o(type="tool_result", tool_use_id=r.call, is_error=r.bad, content=r.text))), toolUseResult=patch))
    )


def _codex(r: _Line) -> Column:
    item = lambda **p: _json(type="response_item", timestamp=r.at, payload=_o(**p))
    said = F.array(_o(type="text", text=r.text))
    return (
        F.when(r.slot == 0, _json(type="session_meta", payload=_o(id=F.concat(F.lit("s-"), "conv_id"), cwd=r.cwd)))
        .when((r.slot == 1) & r.assistant, item(type="reasoning", summary=said)).when((r.slot == 1) & ~r.assistant, item(type="message", role=F.col("role"), content=said))
        .when((r.slot == 2) & r.user, _json(type="turn_context", payload=_o(model="m-1"))).when((r.slot == 2) & r.assistant, item(type="message", role="assistant", content=said))
        .when((r.slot == 3) & r.assistant, item(type="function_call", name="Read", call_id=r.call, arguments=F.to_json(r.input)))
        .when((r.slot == 4) & r.assistant, _json(type="response_item", payload=_o(type="function_call_output", call_id=r.call, output=F.concat(F.lit("Process exited with code "), (r.turn % 3).cast("string"), F.lit("\nOutput\n"), r.text))))
    )


def _pi(r: _Line) -> Column:
    return (
        F.when(r.slot == 0, _json(type="session", id=F.concat(F.lit("s-"), "conv_id"), cwd=r.cwd))
        .when((r.slot == 1) & r.assistant, _json(type="message", timestamp=r.at, message=_o(role="assistant", content=r.answer, usage=r.used)))
        .when(r.slot == 1, _json(type="message", timestamp=r.at, message=_o(role=F.col("role"), content=r.said)))
        .when((r.slot == 2) & r.user, _json(type="model_change", model="m-1"))
        .when((r.slot == 4) & r.assistant, _json(type="message", message=_o(role="toolResult", toolCallId=r.call, isError=r.bad, content=r.said)))
    )


def _qwen(r: _Line) -> Column:
    parts = _blocks({"text": r.text, "thought": F.lit(True)}, {"text": r.text}, {"functionCall": _o(id=r.call, name="Read", args=r.input)})
    answer = _o(id=r.call, name="Read", response=_o(output=F.when(~r.bad, r.text), error=F.when(r.bad, r.text)))
    return (
        F.when(r.slot == 0, _json(type="system", subtype="session_model", sessionId=F.concat(F.lit("s-"), "conv_id"), cwd=r.cwd, systemPayload=_o(modelId="m-1")))
        .when((r.slot == 1) & r.user, _json(type="user", timestamp=r.at, message=_o(parts=F.array(_o(text=r.text)))))
        .when((r.slot == 1) & r.assistant, _json(type="assistant", timestamp=r.at, usageMetadata=_o(promptTokenCount=F.length(r.text), candidatesTokenCount=r.turn), message=_o(parts=parts)))
        .when((r.slot == 1) & r.system, _json(type="system", subtype="reminder", timestamp=r.at, systemPayload=r.text))
        .when((r.slot == 4) & r.assistant, _json(type="tool_result", message=_o(parts=F.array(_o(functionResponse=answer)))))
    )


def _kimi_wire(r: _Line) -> Column:
    sent = lambda kind, **p: _json(timestamp=r.seconds, message=_o(type=kind, payload=_o(**p)))
    return (
        F.when(r.slot == 0, _json(type="metadata", note=F.concat(F.lit("Working directory: "), r.cwd)))
        .when((r.slot == 1) & r.user, sent("TurnBegin", user_input=r.said)).when((r.slot == 1) & r.assistant, sent("ContentPart", type="think", think=r.text))
        .when((r.slot == 1) & r.system, sent("Notification", category="task", title="note", body=r.text)).when((r.slot == 2) & r.assistant, sent("ContentPart", type="text", text=r.text))
        .when((r.slot == 3) & r.assistant, sent("ToolCall", id=r.call, function=_o(name="Read", arguments=F.to_json(r.input))))
        .when((r.slot == 4) & r.assistant, _json(message=_o(type="ToolResult", payload=_o(tool_call_id=r.call, return_value=_o(is_error=r.bad, output=r.text, message="m")))))
    )


def _kimi_events(r: _Line) -> Column:
    time = r.seconds * 1000
    loop = lambda when=time, **e: _json(type="context.append_loop_event", time=when, event=_o(**e))
    note = F.concat(F.lit("<note>"), r.text, F.lit("</note>"))
    return (
        F.when(r.slot == 0, _json(type="metadata", note=F.concat(F.lit("Working directory: "), r.cwd)))
        .when((r.slot == 1) & r.user, _json(type="turn.prompt", time=time, input=r.said))
        .when((r.slot == 2) & r.user, _json(type="context.append_message", time=time, message=_o(role="user", content=r.said)))
        .when((r.slot == 3) & r.user, _json(type="usage.record", time=time, model="m-1", usage=_o(inputOther=F.length(r.text), output=r.turn)))
        .when((r.slot == 1) & r.system, _json(type="context.append_message", time=time, message=_o(role="user", content=F.array(_o(text=note)))))
        .when((r.slot == 1) & r.assistant, loop(type="content.part", part=_o(type="think", think=r.text))).when((r.slot == 2) & r.assistant, loop(type="content.part", part=_o(type="text", text=r.text)))
        .when((r.slot == 3) & r.assistant, loop(type="tool.call", toolCallId=r.call, name="Read", args=r.input))
        .when((r.slot == 4) & r.assistant, loop(F.lit(None).cast("bigint"), type="tool.result", toolCallId=r.call, result=_o(output=r.text, isError=r.bad)))
    )


def _minimax(r: _Line) -> Column:
    sent = lambda **m: _json(turn_id=r.call, message=_o(**m))
    time = r.seconds * 1000
    return (
        F.when(r.slot == 0, _json(message=_o(role="custom", content=F.concat(F.lit("YOUR WORKSPACE DIRECTORY: "), r.cwd))))
        .when((r.slot == 1) & r.user, sent(role="user", timestamp=time, content=r.said)).when((r.slot == 1) & r.assistant, sent(role="assistant", timestamp=time, model="m-1", usage=r.used, content=r.answer))
        .when((r.slot == 1) & r.system, sent(role="compactionSummary", timestamp=time, tokensBefore=F.length(r.text)))
        .when((r.slot == 4) & r.assistant, sent(role="toolResult", toolCallId=r.call, isError=r.bad, content=r.said, details=_o(textFile=_o(path=r.path))))
    )


def _cursor(r: _Line) -> Column:
    return (
        F.when(r.slot == 0, _json(kind="meta")).when((r.slot == 1) & r.user, _json(kind="user_text", text=r.text, ts=r.at)).when((r.slot == 1) & r.assistant, _json(kind="assistant_thinking", text=r.text, ts=r.at))
        .when((r.slot == 2) & r.assistant, _json(kind="assistant_text", text=r.text, ts=r.at)).when((r.slot == 3) & r.assistant, _json(kind="tool_call", name="Read", input=r.input, toolCallId=r.call, ts=r.at))
        .when((r.slot == 4) & r.assistant, _json(kind="tool_result", toolCallId=r.call, content=r.text, isError=r.bad))
    )


#: Name of a query's part, source of its adapter, the log's lines.
KINDS: dict[str, tuple[str, Callable[[_Line], Column]]] = {
    "claude": ("claude", _claude), "codex": ("codex", _codex), "pi": ("pi", _pi), "qwen": ("qwen", _qwen), "kimi_wire": ("kimi", _kimi_wire), "kimi_events": ("kimi", _kimi_events), "minimax": ("minimax", _minimax), "cursor": ("cursor", _cursor),
}


def _lines(spark, d: str, kind: str) -> DataFrame:
    """The conversations as the lines of a kind of log."""
    r = _Line()
    talks = spark.read.parquet(f"{d}/conversations.parquet")
    places = F.when(F.col("turn") == 0, F.array(*map(F.lit, range(5)))).otherwise(F.array(*map(F.lit, range(1, 5))))
    rows = talks.select("*", F.concat_ws("-", "conv_id", "turn").alias("id"), F.format_string("/w/%d", "conv_id").alias("cwd"), F.explode(places).alias("slot"))
    return rows.select(F.format_string("/logs/%d.jsonl", "conv_id").alias("log_file"), F.lit(0).cast("bigint").alias("log_bytes"), F.when(r.slot == 0, 1).otherwise(4 * r.turn + r.slot + 1).cast("bigint").alias("log_line"), F.coalesce(KINDS[kind][1](r), r.text).alias("raw"))


_TALKS = """c AS (SELECT *, '/logs/' || conv_id || '.jsonl' AS log_file, conv_id || '-' || turn AS id, '/w/' || conv_id AS cwd, strftime(TIMESTAMP '2024-05-01 10:00:00' + to_seconds(turn), '%Y-%m-%dT%H:%M:%S.000Z') AS ts,
 coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') AS before FROM conversations)"""


def _expected(split: bool, first: str, result: str, notes: str = "", result_ts: str = "ts", prompt_first: str = "false") -> str:
    """SQL of a kind's entries: is an answer split over lines, when does thinking start a turn, and the result's own columns."""
    line = (1, 2, 3) if split else (1, 1, 1)
    return f"""WITH {_TALKS}, e AS (
SELECT log_file, turn, 1 AS slot, 1 AS line, 'user_text' AS kind, text, ts, {prompt_first} AS turn_start FROM c WHERE role = 'user'
UNION ALL BY NAME SELECT log_file, turn, 1 AS slot, {line[0]} AS line, 'assistant_thinking' AS kind, text, ts, {first} AS turn_start FROM c WHERE role = 'assistant'
UNION ALL BY NAME SELECT log_file, turn, 2 AS slot, {line[1]} AS line, 'assistant_text' AS kind, text, ts, false AS turn_start FROM c WHERE role = 'assistant'
UNION ALL BY NAME SELECT log_file, turn, 3 AS slot, {line[2]} AS line, 'tool_call' AS kind, 'Read' AS tool_name, '{{"file_path":"' || cwd || '/f.py"}}' AS tool_input, id AS tool_call_id, ts, false AS turn_start FROM c WHERE role = 'assistant'
UNION ALL BY NAME SELECT log_file, turn, 4 AS slot, 4 AS line, 'tool_result' AS kind, id AS tool_call_id, false AS turn_start, {result_ts} AS ts, {result} FROM c WHERE role = 'assistant'
{notes}
UNION ALL BY NAME SELECT NULL::VARCHAR AS tool_name, NULL::BIGINT AS diff_added, NULL::BIGINT AS diff_removed, NULL::VARCHAR AS diff_path, NULL::INT AS exit_code, NULL::VARCHAR AS subtype WHERE false)
SELECT substr(sha256(log_file), 1, 16) AS session_key, row_number() OVER (PARTITION BY log_file ORDER BY turn, slot) AS seq, 4 * turn + line + 1 AS log_line, kind, text, tool_name, tool_input, tool_call_id, content, coalesce(is_error, false) AS is_error, exit_code, diff_added, diff_removed, diff_path, subtype, ts, turn_start FROM e"""


_PLAIN = "text AS content, turn % 3 = 0 AS is_error"


def _note(subtype: str, said: str, kind: str = "system_note", slot: int = 1, first: str = "false") -> str:
    return f"UNION ALL BY NAME SELECT log_file, turn, {slot} AS slot, 1 AS line, '{kind}' AS kind, {subtype} AS subtype, {said} AS text, ts, {first} AS turn_start FROM c WHERE role = 'system'"


_AFTER_PROMPT = "before = 'user'"
_EXPECTED = {
    "claude": _expected(False, "true", f"{_PLAIN}, 2 AS diff_added, 1 AS diff_removed, cwd || '/f.py' AS diff_path", _note("'away_summary'", "text")),
    "codex": _expected(True, "false", "'Process exited with code ' || turn % 3 || chr(10) || 'Output' || chr(10) || text AS content, turn % 3 <> 0 AS is_error, (turn % 3)::INT AS exit_code", _note("'system'", "left(text, 200)")),
    "pi": _expected(False, "false", _PLAIN),
    "qwen": _expected(False, "true", _PLAIN, _note("'reminder'", "text")),
    "kimi_wire": _expected(True, _AFTER_PROMPT, _PLAIN, _note("'notification:task'", "'note' || chr(10) || text")),
    "kimi_events": _expected(True, _AFTER_PROMPT, _PLAIN, _note("'context_message'", "'<note>' || text || '</note>'")),
    "minimax": _expected(False, "true", f"{_PLAIN}, cwd || '/f.py' AS diff_path", _note("NULL", "NULL", "compaction", first="true") + "\n" + _note("'compaction'", "'history compacted, ' || length(text) || ' tokens before'", slot=2), "''", "true"),
    "cursor": _expected(True, "false", _PLAIN, result_ts="''"),
}


def _reader(kind: str):
    return lambda spark, d: L.entries(_lines(spark, d, kind), KINDS[kind][0]).select(*KEPT)


for _kind in KINDS:
    QUERIES[f"log_{_kind}"], ORACLES[f"log_{_kind}"] = _reader(_kind), _EXPECTED[_kind]


def log_headers(spark, d):
    """What the adapters say of each log as a whole."""
    one = lambda k: L.sessions(_lines(spark, d, k), KINDS[k][0]).select(F.lit(k).alias("kind"), "session_key", "session_id", "log_file", "cwd", "model", "log_lines", "started_at", "ended_at", "role", "requests", "input", "output")
    return reduce(DataFrame.unionByName, map(one, KINDS))


QUERIES["log_headers"] = log_headers
#: By kind: does the log name its session, its folder, its model (always, or by lines of a role) and use (on lines of a role)?
ORACLES["log_headers"] = f"""WITH {_TALKS}, k(kind, named, placed, model_by, used_by) AS (VALUES ('claude', true, true, 'assistant', 'assistant'), ('codex', true, true, 'user', ''), ('pi', true, true, 'user', 'assistant'), ('qwen', true, true, 'all', 'assistant'),
 ('kimi_wire', false, true, '', ''), ('kimi_events', false, true, 'user', 'user'), ('minimax', false, true, 'assistant', 'assistant'), ('cursor', false, false, '', ''))
SELECT kind, substr(sha256(log_file), 1, 16) AS session_key, CASE WHEN named THEN 's-' || conv_id ELSE conv_id::VARCHAR END AS session_id, log_file, CASE WHEN placed THEN '/w/' || conv_id ELSE '' END AS cwd,
 CASE WHEN model_by = 'all' OR count(*) FILTER (role = model_by) > 0 THEN 'm-1' END AS model, 4 * max(turn) + 5 AS log_lines, min(ts) FILTER (role <> 'system' OR kind <> 'cursor') AS started_at, max(ts) AS ended_at, 'main' AS role,
 count(*) FILTER (role = used_by) AS requests, coalesce(sum(length(text)) FILTER (role = used_by), 0)::BIGINT AS input, coalesce(sum(turn) FILTER (role = used_by), 0)::BIGINT AS output FROM c, k GROUP BY kind, named, placed, model_by, used_by, conv_id, log_file"""


def codex_usage(spark, d):
    """Cumulative counters of a user's events, as they stand in codex logs."""
    from pyspark.sql import Window

    line = Window.partitionBy("user_id").orderBy("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = spark.read.parquet(f"{d}/events.parquet").select("user_id", F.row_number().over(line).cast("bigint").alias("log_line"), *(F.sum(c).over(line).alias(n) for c, n in ((k, "a"), (k % 5, "b"), (k % 3, "c"))))
    counted = _o(input_tokens=F.col("a"), output_tokens=F.col("b"), cached_input_tokens=F.col("c"))
    lines = e.select(F.format_string("/logs/%d.jsonl", "user_id").alias("log_file"), "log_line", _json(type="event_msg", payload=_o(type="token_count", info=_o(total_token_usage=counted))).alias("raw"))
    return L.codex_usage(lines)


QUERIES["codex_usage"] = codex_usage
ORACLES["codex_usage"] = """WITH e AS (SELECT user_id, (props::JSON->>'$.k')::BIGINT AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT substr(sha256('/logs/' || user_id || '.jsonl'), 1, 16) AS session_key, count(*) FILTER (n > 1 AND k <> 0) AS requests, coalesce(sum(k) FILTER (n > 1), 0)::BIGINT AS input, coalesce(sum(k % 5) FILTER (n > 1), 0)::BIGINT AS output, coalesce(sum(k % 3) FILTER (n > 1), 0)::BIGINT AS cache_read FROM e GROUP BY user_id"""
