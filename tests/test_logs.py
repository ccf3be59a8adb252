"""Adapters over synthetic logs of each kind."""

import json

import pytest

from sessionloom.sources import logs


def write(path, rows, tail=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + tail)
    return str(path)


T0 = "2024-05-01T10:00:0{}.000Z"
CLAUDE = [
    {"type": "user", "sessionId": "s1", "cwd": "/w", "uuid": "u1", "timestamp": T0.format(0), "message": {"role": "user", "content": "do it <system-reminder>x\ny</system-reminder>"}},
    "", "not json", "null",
    {"type": "assistant", "timestamp": T0.format(1), "message": {"model": "m1", "usage": {"input_tokens": 5, "output_tokens": 7}, "content": [{"type": "text", "text": " "}, {"type": "thinking", "thinking": "hm"}, {"type": "tool_use", "id": "c1", "name": "Read", "input": {"file_path": "/a"}}]}},
    {"type": "user", "message": {"content": [{"type": "tool_result", "tool_use_id": "c1", "is_error": True, "content": [{"type": "text", "text": "a"}, {"type": "image"}]}]}, "toolUseResult": {"interrupted": True, "type": "file", "file": {"filePath": "/a", "structuredPatch": [{"lines": ["+x", "-y", " z", "+q"]}]}}},
    {"type": "system", "subtype": "status", "content": "x"}, {"type": "system", "subtype": "compact_boundary", "content": '{"trigger":"auto","preTokens":9,"postTokens":3}'},
    {"type": "pr-link", "prNumber": 4, "prUrl": "u"}, {"type": "user", "isMeta": True, "message": {"content": "no"}}, {"type": "ai-title", "aiTitle": "T"}, {"type": "assistant", "isSidechain": True, "timestamp": T0.format(3), "message": {"content": [{"type": "text", "text": "side"}]}},
]


def got(spark, source, *paths):
    rows = logs.entries(logs.read_lines(spark, *paths), source).orderBy("session_key", "seq").collect()
    return rows


def test_claude(spark, tmp_path):
    path = write(tmp_path / "p" / "one.jsonl", CLAUDE, "\r\n\n")
    rows = got(spark, "claude", path)
    assert [(r.log_line, r.kind) for r in rows] == [(1, "user_text"), (5, "assistant_thinking"), (5, "tool_call"), (6, "tool_result"), (8, "compaction"), (8, "system_note"), (9, "system_note"), (12, "assistant_text")]
    assert rows[0].text == "do it" and [r.turn_start for r in rows[1:3]] == [False, False]  # the blank text took the turn's start
    result = rows[3]
    assert (result.content, result.is_error, result.interrupted, result.diff_added, result.diff_removed, result.diff_path, result.ts) == ("a\n[image]", True, True, 2, 1, "/a", T0.format(1))
    assert rows[5].text == "history compacted, trigger=auto, 9→3 tokens" and rows[6].text == "PR !4: u" and rows[7].sidechain
    head = logs.sessions(logs.read_lines(spark, path), "claude").first()
    assert (head.session_id, head.cwd, head.model, head.title, head.log_lines, head.started_at, head.ended_at, head.requests, head.input, head.output) == ("s1", "/w", "m1", "T", 12, T0.format(0), T0.format(3), 1, 5, 7)
    assert logs.under(logs.sessions(logs.read_lines(spark, path), "claude"), "/w/").count() == 1


CODEX = [
    {"type": "session_meta", "timestamp": T0.format(0), "payload": {"id": "me", "cwd": "/w", "source": {"subagent": {"thread_spawn": {"parent_thread_id": "dad"}}}}},
    {"type": "response_item", "payload": {"type": "message", "role": "user", "content": [{"text": "<codex_delegation><input> a </input><input>b</input></codex_delegation>"}]}},
    {"type": "response_item", "payload": {"type": "message", "role": "user", "content": [{"text": "# AGENTS.md no"}]}},
    {"type": "response_item", "payload": {"type": "reasoning", "summary": [{"text": "r"}]}},
    {"type": "response_item", "payload": {"type": "function_call", "name": "shell", "arguments": '{"command":["ls","-l"]}', "call_id": "c"}},
    {"type": "response_item", "payload": {"type": "function_call_output", "call_id": "c", "output": "Process exited with code 101\nOutput\nboom"}},
    {"type": "response_item", "payload": {"type": "agent_message", "author": "x", "content": [{"text": "Message Type: NEW_TASK\nPayload:\n"}, {"type": "encrypted_content"}]}},
    {"type": "event_msg", "payload": {"type": "token_count", "info": {"total_token_usage": {"input_tokens": 100, "output_tokens": 10}}}},
    {"type": "event_msg", "payload": {"type": "token_count", "info": {"total_token_usage": {"input_tokens": 100, "output_tokens": 10}}}},
    {"type": "event_msg", "payload": {"type": "token_count", "info": {"total_token_usage": {"input_tokens": 130, "output_tokens": 14}}}},
    {"type": "session_meta", "payload": {"id": "old", "cwd": "/old"}},
    {"type": "event_msg", "payload": {"type": "token_count", "info": {"total_token_usage": {"input_tokens": 999, "output_tokens": 9}, "last_token_usage": {"input_tokens": 3, "output_tokens": 2}}}},
]


def test_codex(spark, tmp_path):
    path = write(tmp_path / "2024" / "05" / "r.jsonl", CODEX)
    rows = got(spark, "codex", path)
    assert [r.kind for r in rows] == ["user_text", "assistant_thinking", "tool_call", "tool_result", "system_note"]
    assert rows[0].text == "[delegation:codex]\na\n---\nb" and rows[3].exit_code == 101 and rows[3].is_error
    assert rows[4].text == "[NEW_TASK] payload encrypted/hidden (sender x)"
    lines = logs.read_lines(spark, path)
    head = logs.sessions(lines, "codex").first()
    assert (head.session_id, head.cwd, head.role, head.parent_thread_id) == ("me", "/w", "subagent", "dad")
    used = logs.codex_usage(lines).first()
    assert (used.requests, used.input, used.output) == (2, 33, 6)


def test_pi(spark, tmp_path):
    rows = [
        {"type": "session", "id": "p1", "cwd": "/w", "timestamp": T0.format(0)}, {"type": "model_change", "model": "mm"},
        {"type": "message", "message": {"role": "user", "content": [{"type": "text", "text": "hi"}, {"type": "text", "text": "# AGENTS.md"}]}},
        {"type": "message", "message": {"role": "assistant", "content": [{"type": "thinking", "thinking": "t"}, {"type": "toolCall", "id": "c", "name": "bash", "arguments": {"command": "x"}}], "usage": {"input": 3, "output": 4, "cacheRead": 1}}},
        {"type": "message", "message": {"role": "toolResult", "toolCallId": "c", "isError": True, "content": [{"text": "a"}, {"text": "b"}]}},
    ]
    path = write(tmp_path / "--w--" / "x.jsonl", rows)
    found = got(spark, "pi", path)
    assert [r.kind for r in found] == ["user_text", "assistant_thinking", "tool_call", "tool_result"] and found[3].content == "a\nb" and found[3].is_error and found[3].ts == T0.format(0)
    head = logs.sessions(logs.read_lines(spark, path), "pi").first()
    assert (head.session_id, head.cwd, head.model, head.input, head.cache_read) == ("p1", "/w", "mm", 3, 1)


def test_qwen(spark, tmp_path):
    rows = [
        {"type": "user", "sessionId": "q", "timestamp": T0.format(0), "message": {"parts": [{"text": " hi "}]}}, {"type": "user", "provenance": "system", "message": {"parts": [{"text": "bg"}]}},
        {"type": "assistant", "model": "m", "usageMetadata": {"promptTokenCount": 9}, "message": {"parts": [{"text": ""}, {"text": "th", "thought": True}, {"functionCall": {"id": "c", "name": "n", "args": {"a": 1}}}]}},
        {"type": "tool_result", "message": {"parts": [{"functionResponse": {"id": "c", "name": "n", "response": {"error": "bad"}}}]}},
        {"type": "system", "subtype": "chat_compression", "systemPayload": {"info": {"originalTokenCount": 9, "newTokenCount": 2, "triggerReason": "r"}}}, {"type": "system", "subtype": "turn_result", "systemPayload": {"a": 1}}, {"type": "system", "subtype": "odd", "systemPayload": {"a": 1}},
    ]
    found = got(spark, "qwen", write(tmp_path / "c" / "chats" / "q.jsonl", rows))
    assert [(r.kind, r.turn_start) for r in found] == [("user_text", False), ("system_note", False), ("assistant_thinking", True), ("tool_call", False), ("tool_result", False), ("compaction", False), ("system_note", False), ("system_note", False)]
    assert found[0].text == "hi" and found[4].is_error and found[4].content == "bad" and found[6].text == "history compacted, trigger=r, 9→2 tokens"


def test_kimi(spark, tmp_path):
    wire = [
        {"type": "metadata", "protocol_version": "1.9"}, {"timestamp": 1714557600.5, "message": {"type": "TurnBegin", "payload": {"user_input": [{"text": "go\nWorking directory: /w"}]}}},
        {"timestamp": 1714557601.0, "message": {"type": "ContentPart", "payload": {"type": "think", "think": "t"}}}, {"timestamp": 1714557602.0, "message": {"type": "ToolCall", "payload": {"id": "c", "function": {"name": "Shell", "arguments": '{"command":"x"}'}}}},
        {"timestamp": 1714557603.0, "message": {"type": "SubagentEvent", "payload": {"event": {"type": "ContentPart", "payload": {"type": "text", "text": "sub"}}}}}, {"timestamp": 1714557604.0, "message": {"type": "ToolResult", "payload": {"tool_call_id": "c", "return_value": {"is_error": True, "output": "", "message": "m"}}}},
        {"timestamp": 1714557605.0, "message": {"type": "StepBegin", "payload": {}}}, {"timestamp": 1714557606.0, "message": {"type": "ContentPart", "payload": {"type": "text", "text": "done"}}},
    ]
    found = got(spark, "kimi", write(tmp_path / "k" / "wire.jsonl", wire))
    assert [(r.kind, r.turn_start, r.sidechain) for r in found] == [("user_text", False, False), ("assistant_thinking", True, False), ("tool_call", False, False), ("assistant_text", False, True), ("tool_result", False, False), ("assistant_text", True, False)]
    assert found[4].content == "m" and found[0].ts == "2024-05-01T10:00:00.500Z"
    events = [
        {"type": "turn.prompt", "time": 1714557600000, "input": [{"text": "p"}]}, {"type": "context.append_message", "time": 1714557600001, "message": {"role": "user", "content": [{"text": "p"}]}},
        {"type": "context.append_message", "time": 1714557600002, "message": {"role": "user", "content": [{"text": "<note>n</note>"}]}}, {"type": "context.append_loop_event", "time": 1714557600003, "event": {"type": "tool.call", "toolCallId": "c", "name": "n", "args": {}}},
        {"type": "context.append_loop_event", "time": 1714557600004, "event": {"type": "tool.result", "toolCallId": "c", "result": {"output": "o", "isError": False}}}, {"type": "usage.record", "time": 1714557600005, "model": "mk", "usage": {"inputOther": 4, "output": 1}},
    ]
    path = write(tmp_path / "e" / "wire.jsonl", events)
    found = got(spark, "kimi", path)
    assert [(r.kind, r.subtype, r.turn_start) for r in found] == [("user_text", None, False), ("system_note", "context_message", False), ("tool_call", None, True), ("tool_result", None, False)]
    head = logs.sessions(logs.read_lines(spark, path), "kimi").first()
    assert (head.model, head.input, head.requests) == ("mk", 4, 1)


def test_minimax_and_cursor(spark, tmp_path):
    rows = [
        {"turn_id": "a", "message": {"role": "user", "timestamp": 1714557600000, "content": [{"type": "text", "text": "<system-reminder>x</system-reminder> <background-task-finished>y</background-task-finished>\nhello"}]}},
        {"turn_id": "a", "message": {"role": "assistant", "timestamp": 1714557601000, "model": "m", "content": [{"type": "text", "text": "ok"}, {"type": "toolCall", "id": "c", "name": "read", "arguments": {}}]}},
        {"turn_id": "b", "message": {"role": "toolResult", "toolCallId": "c", "isError": False, "timestamp": 1714557602000, "content": [{"text": "r"}], "details": {"textFile": {"path": "/f"}}}},
        {"turn_id": "b", "message": {"role": "custom", "content": []}}, {"message": {"role": "compactionSummary", "tokensBefore": 7}}, "{broken",
    ]
    found = got(spark, "minimax", write(tmp_path / "m" / "messages.jsonl", rows))
    assert [(r.kind, r.turn_start) for r in found] == [("user_text", True), ("assistant_text", False), ("tool_call", False), ("tool_result", True), ("compaction", False), ("system_note", False)]
    assert found[0].text == "hello" and found[3].diff_path == "/f"
    rows = [{"kind": "user_text", "text": "q", "ts": T0.format(0)}, {"kind": "tool_call", "name": "n", "input": {"b": 1}, "toolCallId": "c"}, {"kind": "tool_result", "toolCallId": "c", "content": ""}, {"kind": "tool_result", "toolCallId": "c", "content": "x", "isError": True}]
    found = got(spark, "cursor", write(tmp_path / "c" / "l.jsonl", rows))
    assert [(r.kind, r.log_line, r.ts) for r in found] == [("user_text", 1, T0.format(0)), ("tool_call", 2, ""), ("tool_result", 4, "")] and found[1].tool_input == '{"b":1}'


@pytest.mark.parametrize("source", sorted(logs.ADAPTERS))
def test_odd_lines_give_no_entries(spark, tmp_path, source):
    path = write(tmp_path / "x.jsonl", ["", "null", "[]", "1", "{}", '{"type": 3}', '{"type":"user"}', '{"message":null}', "{"])
    assert got(spark, source, path) == [] and logs.sessions(logs.read_lines(spark, path), source).first().log_lines == 9
