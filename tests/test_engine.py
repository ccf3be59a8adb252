"""The engine over log trees, stores and streams; folds against plain loops."""

import json
import random
import sqlite3

from pyspark.sql import functions as F

from sessionloom import engine
from sessionloom.functions import text as T
from sessionloom.functions import tools as C
from sessionloom.operators import blocks, facts, turns, work
from sessionloom.sources import discovery, sqlite
from sessionloom.sources.discovery import Root
from sessionloom.sources.tables import ENTRY, as_entries
from sessionloom.streaming import ledger
from sessionloom.streaming.tail import LogTail
from test_logs import CLAUDE, CODEX, write


def test_distill(spark, tmp_path):
    write(tmp_path / "a" / "p" / "one.jsonl", CLAUDE)
    write(tmp_path / "a" / "p" / "two.jsonl", [{**CLAUDE[0], "sessionId": "s2", "timestamp": "2024-05-01T10:02:00.000Z"}])
    write(tmp_path / "b" / "2024" / "05" / "01" / "r.jsonl", CODEX)
    (tmp_path / "a" / "p" / "empty.jsonl").write_text("")
    roots = [Root("claude", str(tmp_path / "a")), Root("codex", str(tmp_path / "b"))]
    listed = discovery.inventory(spark, roots)
    assert listed.count() == 3 and discovery.stale(listed, listed).count() == 0 and discovery.inventory(spark, roots, "two").count() == 1
    tables = engine.distill(spark, roots, engine.Options(repo_bound=True))
    engine.write(tables, str(tmp_path / "out"))
    made = {n: spark.read.parquet(f"{tmp_path}/out/{n}") for n in tables}
    assert made["sessions"].count() == 3 and made["traces"].count() == 3
    assert {(r.session_index, r.reason) for r in made["chains"].where("source = 'claude'").collect()} == {(1, None), (2, "time-gap")}
    assert {r.status for r in made["verdicts"].collect()} == {"partial", "failure", "unknown"}
    shown = made["traces"].where("session_id = 's1'").first()
    assert "@L" not in shown.markdown and shown.file_name == "2024-05-01-s1-t.md"
    engine.write_markdown(made["chain_traces"], str(tmp_path / "md"))
    files = {x.name: x.read_text() for x in (tmp_path / "md").iterdir()}
    assert len(files) == 1 and all(x.endswith(".md") for x in files)
    chain = next(t for t in files.values() if "sessions: 2\n" in t)
    assert chain.index("## Sessions") < chain.index("# Session s1") < chain.index("# Session s2") and "· time-gap" in chain
    alone = engine.distill(spark, roots, engine.Options(chain=False))
    assert alone["chain_traces"].count() == 2
    assert engine.distill(spark, roots, engine.Options(most=1))["sessions"].count() == 1
    assert engine.distill(spark, roots, engine.Options(root="/nowhere"))["traces"].count() == 0


def test_chain_traces_hold_sub_agents(spark):
    from sessionloom.operators import render

    traced = spark.createDataFrame([("a", "body a"), ("b", "body b"), ("c", "body c")], "session_key string, markdown string")
    chained = spark.createDataFrame([("p", 1, "a", 1, None), ("p", 1, "b", 2, "time-gap"), ("p", 2, "c", 1, None)], "project string, chain long, session_key string, session_index long, reason string")
    subs = spark.createDataFrame([("x", "b"), ("y", "gone")], "session_key string, parent_key string")
    stats = spark.createDataFrame([("a", 3, 1), ("b", 4, 0), ("c", 5, 2)], "session_key string, requests long, errors long")
    got = {r.chain: r for r in render.chain_traces(traced, chained, subs, stats).collect()}
    assert got[1].session_keys == ["a", "b"] and (got[1].requests, got[1].errors, got[2].requests) == (7, 1, 5)
    text = got[1].markdown
    assert text.index("requests: 7") < text.index("- s2 · b · time-gap") < text.index("- x · of s2") < text.index("body a") < text.index("body b")
    assert "Sub-agents" not in got[2].markdown


def test_links_across_sources(spark):
    from sessionloom.operators import chains
    from pyspark.sql import functions as F

    rows = [("a1", "a", 0, 1, None, None, "u1"), ("b1", "b", 2, 3, None, None, "u2"), ("a2", "a", 4, 5, None, None, "u3"), ("a3", "a", 6, 7, None, None, "u4"), ("b2", "b", 90_000, 90_001, "u4", None, "u5"), ("a4", "a", 190_000, 190_001, "gone", "u5", "u6")]
    made = spark.createDataFrame(rows, "session_key string, source string, s long, e long, leaf_uuid string, logical_parent_uuid string, last_uuid string")
    made = made.select("*", F.timestamp_seconds("s").alias("started_at"), F.timestamp_seconds("e").alias("ended_at"), F.array(F.lit("f")).alias("paths"), F.lit("p").alias("project"))
    got = {r.session_key: (r.chain, r.reason) for r in chains.chains(made).collect()}
    assert got == {"a1": (1, None), "b1": (2, None), "a2": (3, None), "a3": (3, "time-gap"), "b2": (3, "leaf-uuid"), "a4": (3, "leaf-uuid")}


def test_chains_over_many_ranges(spark):
    """One project over several ranges and small ones beside it, against a plain loop; no range holds a whole project."""
    from pyspark.sql import functions as F
    from sessionloom.operators import chains

    rng, rows = random.Random(11), []
    for project, n in (("big", 3000), ("small", 7), (None, 40), ("one", 1)):
        at = 0
        for i in range(n):
            at += rng.choice([0, 10, 200, 290, 1000, 2600, 4000])
            rows.append((f"{project}{i:05d}", project, rng.choice("ab"), at, at + rng.choice([0, 5, 300]), [rng.choice("fghij")], rng.choice([None, "u1"]), rng.choice([None, "u2"]), rng.choice(["u1", "u2", "u3"] * 3 + [None])))
    made = spark.createDataFrame(rows, "session_key string, project string, source string, s long, e long, paths array<string>, leaf_uuid string, logical_parent_uuid string, last_uuid string")
    made = made.select("*", F.timestamp_seconds("s").alias("started_at"), F.timestamp_seconds("e").alias("ended_at")).repartition(5)
    wanted = {}
    for project in ("big", "small", None, "one"):
        before, chain, index = None, 0, 0
        for r in sorted((r for r in rows if r[1] == project), key=lambda r: (r[3], r[0])):
            gap = None if before is None else r[3] - before[4]
            reason = None
            if before and before[8] and before[8] in (r[6], r[7]):
                reason = "leaf-uuid"
            elif before and before[2] == r[2] and gap >= 0:
                reason = "time-gap" if gap <= 300 else "time-gap-overlap" if gap <= 2700 and set(r[5]) & set(before[5]) else None
            chain, index = (chain, index + 1) if reason else (chain + 1, 1)
            wanted[r[0]] = (project, chain, index, reason)
            before = r
    got = {r.session_key: (r.project, r.chain, r.session_index, r.reason) for r in chains.chains(made, ranges=6).collect()}
    assert got == wanted
    sizes = [r["count"] for r in chains._slices(made, "project", 6).groupBy("slice").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * len(rows) / 6


def test_utf16_units(spark):
    from pyspark.sql import functions as F
    from sessionloom.functions import text as T

    def units(text):
        raw = text.encode("utf-16-be")
        return [int.from_bytes(raw[i : i + 2], "big") for i in range(0, len(raw), 2)]

    def fold(text):
        h = 2166136261
        for u in units(" ".join(text.split())):
            h = (h ^ u) * 16777619 & 0xFFFFFFFF
        return "q" + f"{h:08x}"[:6]

    texts = ["plain", "a😀b", "😀", "日本 \n 語", "", "x" * 50 + "🏳️‍🌈é"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.quote_id(F.col("t")).alias("q")).collect()
    assert [(r.t, r.q) for r in rows] == [(t, fold(t)) for t in texts]


def random_sessions(n):
    rng, rows = random.Random(5), []
    for s in range(n):
        open_calls = []
        for i in range(rng.randint(1, 40)):
            kind = rng.choice(["user_text", "assistant_text", "assistant_thinking", "tool_call", "tool_call", "tool_result", "tool_result"])
            call = f"c{i}" if kind == "tool_call" else rng.choice(open_calls or [""]) if kind == "tool_result" else None
            if kind == "tool_call":
                open_calls.append(call)
            rows.append({"session_key": f"s{s}", "seq": i, "log_line": i + 1, "kind": kind, "text": "x" * rng.randint(1, 200), "tool_name": rng.choice(["Read", "Edit", "Bash", "Task"]) if kind == "tool_call" else None, "tool_input": "{}", "tool_call_id": call, "content": "y" * rng.randint(1, 200), "turn_start": rng.random() < 0.4})
    return rows


def test_folds_match_plain_loops(spark):
    rows = random_sessions(60)
    entries = as_entries(spark.createDataFrame([tuple(r.values()) for r in rows], "session_key string, seq long, log_line long, kind string, text string, tool_name string, tool_input string, tool_call_id string, content string, turn_start boolean"))
    size = lambda r: -(-len(r["tool_input"]) // 4) + 16 if r["kind"] == "tool_call" else -(-len(r["content"]) // 4) + 8 if r["kind"] == "tool_result" else -(-len(r["text"]) // 4)
    wanted = set()
    for s in {r["session_key"] for r in rows}:
        groups, current, waiting = [], [], set()
        for r in (r for r in rows if r["session_key"] == s):
            if r["kind"] == "user_text":
                groups += [current] if current else []
                groups.append([r])
                current, waiting = [], set()
                continue
            current.append(r)
            if r["kind"] == "tool_call":
                waiting.add(r["tool_call_id"])
            elif r["kind"] == "tool_result" and r["tool_call_id"] in waiting:
                waiting.remove(r["tool_call_id"])
                if not waiting and sum(map(size, current)) >= 60:
                    groups.append(current)
                    current = []
        groups += [current] if current else []
        wanted |= {(s, i + 1, g[0]["log_line"], g[-1]["log_line"], sum(map(size, g))) for i, g in enumerate(groups)}
    got = {(r.session_key, r.turn_index, r.from_line, r.to_line, r.tokens) for r in turns.turns(entries, 60).collect()}
    assert got == wanted
    packed = turns.windows(turns.turns(entries, 60), 150).collect()
    assert sum(r.turns for r in packed) == len(wanted)

    family = {"Read": "read", "Edit": "edit", "Bash": "execute", "Task": "agent"}
    wanted = {}
    for s in {r["session_key"] for r in rows}:
        made, draft = [], None
        for r in (r for r in rows if r["session_key"] == s):
            if r["kind"] == "user_text":
                draft = []
                made.append(draft)
            elif r["kind"] == "assistant_text":
                if draft and not r["turn_start"]:
                    draft = None
                    continue
                if draft or draft is None:
                    draft = []
                    made.append(draft)
            elif r["kind"] == "tool_call":
                f = family[r["tool_name"]]
                if draft and r["turn_start"] and (len(draft) >= 8 or max(dict.fromkeys(draft), key=draft.count) != f):
                    draft = None
                if draft is None:
                    draft = []
                    made.append(draft)
                draft.append(f)
        wanted |= {(s, i + 1): len(d) for i, d in enumerate(made)}
    assert {(r.session_key, r.block_index): r.calls for r in blocks.blocks(entries).collect()} == wanted


def test_refine(spark):
    rows = random_sessions(6)
    entries = as_entries(spark.createDataFrame([tuple(r.values()) for r in rows], "session_key string, seq long, log_line long, kind string, text string, tool_name string, tool_input string, tool_call_id string, content string, turn_start boolean"))
    out = engine.refine(entries, engine.Options(turn_tokens=60, form_tokens=200))
    assert out["analyses"].count() == 6 and out["turn_forms"].count() == turns.turns(entries, 60).count()
    for r in out["forms"].collect():
        assert r.form.startswith("#### b1 · @L1") and r.level in (0, 1, 2) and (r.level == 2 or len(r.form) <= 800)


def test_sinks(spark, tmp_path):
    from sessionloom import storage

    for n in (2, 3):
        storage.append_lines(spark.range(n), str(tmp_path / "l"))
        storage.replace_table(spark.range(n), str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "l")).count() == 5 and spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_text_functions(spark):
    one = spark.range(1)
    ask = lambda c: one.select(c.alias("x")).first()[0]
    lit = F.lit
    assert ask(T.estimate_tokens(lit("😀y"))) == 1 and ask(T.text_units(lit("😀y"))) == 3 and ask(T.estimate_tokens(lit(""))) == 0
    assert ask(T.cap_line(lit("  a\t\nb ﻿"), 5)) == "a b" and ask(T.cap_line(lit("abcdef"), 4)) == "abc…"
    assert ask(T.slice_hash(lit(""))) == "811c9dc51000193" and ask(T.quote_id(lit(""))) == "q811c9d"
    assert ask(T.head_tail(lit("abcdefghij"), 2, 3)) == "ab…[5 chars dropped]…hij"
    assert ask(T.slugify(lit("--Ä!"))) == "session" and ask(T.count_lines(lit("a\nb\n"))) == 2 and ask(T.count_lines(lit(""))) == 0
    short = ask(T.truncate_centered(lit("x" * 50), 40))
    assert ask(T.truncate_centered(lit(short), 40)) == short and ask(T.truncate_centered(lit("x" * 40), 40)) == "x" * 40
    cut = ask(T.truncate_centered(lit("a\n" * 500 + "error: z"), 150, 80))
    assert cut.endswith("error: z") and len(cut) <= 230 and "…⟨truncated: 1008→" in cut
    assert ask(T.extract_json_object(lit("[1]"))) is None and ask(T.strip_refs(lit("a @L4–L9 ×3"))) == "a @L"
    assert ask(C.detect_checks(lit("--- FAIL: A\nFAIL x.ts > y\nTests:  1 failed | 2 passed (3)"))) == (3, 1, ["A", "x.ts > y"])
    assert ask(C.detect_checks(lit("fine"))) is None
    assert ask(C.tool_signature(lit("shell"), lit('{"command":["a","b"]}'))) == "a b" and ask(C.tool_signature(lit("mcp__x"), lit('{"z":"","b":"v"}'))) == "v"


def test_cursors_and_ids(spark):
    assert work.decode_cursor(work.encode_cursor(40)) == 40 and work.decode_cursor(None) == 0
    assert spark.range(1).select(work.parse_job_id(F.lit("p1-0123456789abcdef-w3"))).first()[0] == ("pass1", "0123456789abcdef", 3)


def test_no_entries(spark):
    empty = spark.createDataFrame([], ENTRY)
    assert all(df.count() == 0 for df in engine.analyse(empty).values()) and facts.verdicts(empty).count() == 0


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "s.db")
    db = sqlite3.connect(path)
    db.executescript("CREATE TABLE composerHeaders(composerId, createdAt, isSubagent); CREATE TABLE cursorDiskKV(key, value); CREATE TABLE meta(key, value); CREATE TABLE blobs(data);")
    db.executemany("INSERT INTO composerHeaders VALUES (?, 1, ?)", [("c1", 0), ("c2", 1)])
    tool = {"type": 2, "thinking": {"text": "t"}, "text": "a", "toolFormerData": {"name": "read", "rawArgs": "{}", "result": "r", "status": "error"}}
    db.executemany("INSERT INTO cursorDiskKV VALUES (?, ?)", [("bubbleId:c1:b1", json.dumps({"type": 1, "text": "q"})), ("bubbleId:c1:b2", json.dumps(tool)), ("bubbleId:c2:b3", json.dumps({"type": 1, "text": "no"}))])
    db.execute("INSERT INTO meta VALUES ('m', ?)", (json.dumps({"name": "x"}).encode().hex(),))
    db.execute("INSERT INTO blobs VALUES (?)", (json.dumps({"messages": [{"role": "user", "content": "hi"}, {"messages": [{"role": "assistant", "content": "yo"}]}]}),))
    db.commit()
    from sessionloom.sources import logs

    rows = logs.entries(sqlite.cursor_ide_lines(spark, path), "cursor").orderBy("seq").collect()
    assert [(r.kind, r.is_error) for r in rows] == [("user_text", False), ("assistant_thinking", False), ("assistant_text", False), ("tool_call", False), ("tool_result", True)]
    assert rows[3].tool_call_id == rows[4].tool_call_id == "b2:0"
    assert [r.text for r in logs.entries(sqlite.cursor_agent_lines(spark, path), "cursor").orderBy("seq").collect()] == ["hi", "yo"]
    assert sqlite.cursor_meta(spark, path).first().value == '{"name": "x"}'


def run(stream, mode, name):
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).start()
    query.processAllAvailable()
    return query


def test_streams(spark, tmp_path):
    rows = [("j", 1, "claim", "w", 9), ("j", 2, "submit-fail", None, None), ("k", 3, "claim", "v", 8), ("j", 4, "claim", "u", 7), ("k", 5, "submit-ok", None, None)]
    schema = "job_id string, seq long, ev string, worker string, lease_until long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    query = run(ledger.job_states(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), "update", "states")
    got = {tuple(r) for r in spark.table("states").collect()}
    query.stop()
    batch = {tuple(r) for r in work.job_states(spark.read.parquet(str(tmp_path / "in"))).collect()}
    assert got == batch == {("j", "claimed", "u", 7, 0, 2), ("k", "done", None, None, 0, 1)}

    times = spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-01 00:00:00'), ('a', timestamp'2024-01-01 00:02:00'), ('a', timestamp'2024-01-01 00:10:00') AS t(u, ts)")
    times.coalesce(1).write.parquet(str(tmp_path / "t"))
    query = run(ledger.activity(spark.readStream.schema(times.schema).parquet(str(tmp_path / "t")), "u", "ts"), "complete", "runs")
    assert sorted(r.n for r in spark.table("runs").collect()) == [1, 2]
    query.stop()

    spark.dataSource.register(LogTail)
    folder = tmp_path / "tail"
    folder.mkdir()
    (folder / "x.jsonl").write_text('{"a":1}\n\n{"a":2}\n{"half')
    query = run(spark.readStream.format("log_tail").load(str(folder)), "append", "tailed")
    with (folder / "x.jsonl").open("a") as f:
        f.write('":3}\n')
    query.processAllAvailable()
    assert sorted((r.log_line, r.raw) for r in spark.table("tailed").collect()) == [(1, '{"a":1}'), (3, '{"a":2}'), (4, '{"half":3}')]
    query.stop()
