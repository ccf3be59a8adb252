"""Logs on disk: byte ranges, claims, sniffing before parsing, what stands beside logs, files written."""

import base64
import json
import random

import pytest

from sessionloom import engine
from sessionloom.sources import discovery, export, logs, sniff
from sessionloom.sources.discovery import Root


def put(path, *records, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r, separators=(",", ":")) + end for r in records))
    return path


def plain_lines(path):
    return [(i, line.removesuffix("\r")) for i, line in enumerate(path.read_bytes().decode().split("\n"), 1) if line.removesuffix("\r").strip(" ")]


@pytest.mark.parametrize("size", [200, 3000, 1 << 20])
def test_lines_of_byte_ranges_have_plain_numbers(spark, tmp_path, size):
    rng = random.Random(size)
    for name in ("a.jsonl", "b.jsonl", "c c.jsonl", "one.jsonl"):
        lines = ["x" * rng.choice([0, 0, 1, 5, 70, 300]) + rng.choice(["", "é日本", "  "]) for _ in range(120)]
        lines[7] = "long " * 900
        (tmp_path / name).write_bytes("".join(x + rng.choice(["\n", "\r\n"]) for x in lines).encode() + rng.choice([b"", b"last"]))
    (tmp_path / "one.jsonl").write_bytes(b"y" * 5000)
    (tmp_path / "blank.jsonl").write_bytes(b"\n\r\n \n")
    made = logs.read_lines(spark, str(tmp_path), range_bytes=size)
    got = {}
    for r in made.collect():
        got.setdefault(r.log_file.rsplit("/", 1)[1].replace("%20", " "), []).append((r.log_line, r.raw))
    assert {n: sorted(v) for n, v in got.items()} == {p.name: plain_lines(p) for p in tmp_path.iterdir() if p.name != "blank.jsonl"}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(size)


def claude(cwd, n=3, at="2024-05-01T10:00:00.000Z"):
    return [{"type": "user", "cwd": cwd, "sessionId": "s", "timestamp": at, "message": {"role": "user", "content": f"do {i} " + "z" * 50}} for i in range(n)]


def test_one_log_below_two_roots_is_read_once(spark, tmp_path):
    put(tmp_path / "p" / "one.jsonl", *claude("/w"))
    roots = [Root("claude", str(tmp_path)), Root("cursor", str(tmp_path))]
    entries, sessions = discovery.read(spark, roots)
    assert [r.source for r in sessions.collect()] == ["claude"] and entries.count() == 3
    assert [r.source for r in discovery.read(spark, roots[::-1])[1].collect()] == ["cursor"]


def test_logs_elsewhere_are_opened_no_further_than_needed_and_not_parsed(spark, tmp_path):
    root = tmp_path / "claude"
    put(root / "p" / "in.jsonl", *claude("/w/app"))
    put(root / "p" / "late.jsonl", *[{"type": "hook", "note": "n" * 3000} for _ in range(12)], *claude("/w/app/deep"))
    put(root / "q" / "big.jsonl", *claude("/other", 5000))
    put(root / "q" / "near.jsonl", *claude("/w/apple", 500))
    put(root / "q" / "none.jsonl", {"type": "hook"})
    put(root / "q" / 'odd "name" ü.jsonl', *claude('/w/app/"q"\\ü'))
    rows = {r.log_file.rsplit("/", 1)[1]: r for r in discovery.census(spark, [Root("claude", str(root))], under="/w/app/").collect()}
    assert {n: r.skipped for n, r in rows.items() if "odd" not in n} == {"in.jsonl": None, "late.jsonl": None, "big.jsonl": "elsewhere", "near.jsonl": "elsewhere", "none.jsonl": "no cwd"}
    assert [r.cwd for n, r in rows.items() if "odd" in n] == ['/w/app/"q"\\ü']
    assert rows["big.jsonl"].read_bytes <= 8 << 10 < rows["big.jsonl"].log_bytes and rows["near.jsonl"].read_bytes <= 8 << 10
    assert rows["late.jsonl"].cwd == "/w/app/deep" and rows["late.jsonl"].read_bytes > 32 << 10
    kept = [r.log_file for r in rows.values() if r.skipped is None]
    lines = logs.read_lines(spark, str(root), only=kept)
    assert {r.log_file for r in lines.select("log_file").distinct().collect()} == set(kept)
    lines.collect()
    leaves = lines._jdf.queryExecution().executedPlan().executedPlan().plan().collectLeaves()
    scans = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    assert [m.get().value() for m in scans if m.isDefined()] == [3]  # the others are not read at all
    tables = engine.distill(spark, [Root("claude", str(root))], engine.Options(root="/w/app"))
    assert tables["sessions"].count() == 3


def test_heads_of_codex_and_pi(spark, tmp_path):
    codex = put(tmp_path / "2024" / "05" / "01" / "r.jsonl", {"type": "session_meta", "payload": {"id": "x", "cwd": "/w/a"}}, {"pad": "p" * 20000})
    far = put(tmp_path / "2024" / "05" / "02" / "r.jsonl", {"pad": "p" * 9000}, {"type": "session_meta", "payload": {"cwd": "/w/a"}})
    assert sniff.working_dir(str(codex), sniff.RULES["codex"]) == ("/w/a", 8192)
    assert sniff.working_dir(str(far), sniff.RULES["codex"]) == (None, 8192)
    pi = put(tmp_path / "pi.jsonl", {"type": "session", "id": "x", "cwd": "/w/b"})
    other = put(tmp_path / "no.jsonl", {"type": "message", "cwd": "/w/b"})
    assert sniff.working_dir(str(pi), sniff.RULES["pi"])[0] == "/w/b" and sniff.working_dir(str(other), sniff.RULES["pi"])[0] is None


def test_what_stands_beside_kimi_and_minimax_logs(spark, tmp_path):
    wire = lambda t: ({"type": "metadata", "protocol_version": "1.4", "created_at": 1714557600000}, {"timestamp": t, "message": {"type": "TurnBegin", "payload": {"user_input": "go"}}})
    kimi, mini = tmp_path / "kimi", tmp_path / "mini"
    put(kimi / "wd_app_6d9fbb7a2466" / "session_u1" / "state.json", {"workDir": "/w/app"})
    put(kimi / "wd_app_6d9fbb7a2466" / "session_u1" / "agents" / "main" / "wire.jsonl", *wire(1714557700))
    put(kimi / "wd_app_6d9fbb7a2466" / "session_u1" / "agents" / "agent-2" / "wire.jsonl", *wire(1714557701))
    put(kimi / "wd_other_6d9fbb7a2466" / "session_u2" / "agents" / "main" / "wire.jsonl", *wire(1714557702))
    put(kimi / "abc" / "u3" / "wire.jsonl", *wire(1714557703))
    put(kimi / "abc" / "u3" / "subagents" / "k" / "wire.jsonl", *wire(1714557704))
    code = base64.b64encode(b"mvs_12").decode().rstrip("=")
    said = lambda text: {"message": {"role": "user", "timestamp": 1714557600000, "content": [{"type": "text", "text": text}]}}
    put(mini / "2024" / f"10-00-00-000-session_{code}" / "messages.jsonl", said("<x>\nYOUR WORKSPACE DIRECTORY: /w/app\nmore"))
    put(mini / "2024" / "named-session_raw!" / "messages.jsonl", said("hi"))
    put(mini / "2024" / "named-session_raw!" / "manifest.json", {"sessionId": "mvs_9", "createdAtMs": 1714557600000})
    put(mini / "2024" / "bare" / "messages.jsonl", said("YOUR WORKSPACE DIRECTORY: /else"))
    roots = [Root("kimi", str(kimi)), Root("minimax", str(mini))]
    found = {r.ref_id + ("/" + r.ref_role if r.ref_role == "subagent" else ""): r for r in discovery.refs(spark, roots, discovery.inventory(spark, roots)).collect()}
    assert set(found) == {"u1", "u1/subagent", "u2", "u3", "u3/k/subagent", "mvs_12", "mvs_9", "bare"}
    assert (found["u1"].ref_cwd, found["u1"].ref_hint, found["u1"].ref_started, found["u1"].ref_ended) == ("/w/app", "app", "2024-05-01T10:00:00.000Z", "2024-05-01T10:01:40.000Z")
    assert found["u2"].ref_hint == "other" and found["u3"].ref_hint is None and found["mvs_9"].ref_started == "2024-05-01T10:00:00.000Z"
    skipped = {r.log_file.split(str(tmp_path))[1]: r.skipped for r in discovery.census(spark, roots, under="/w/app").collect()}
    assert sorted(p for p, s in skipped.items() if s) == ["/kimi/wd_other_6d9fbb7a2466/session_u2/agents/main/wire.jsonl", "/mini/2024/bare/messages.jsonl"]
    _, sessions = discovery.read(spark, roots, under="/w/app")
    assert {(r.session_id, r.role) for r in sessions.collect()} == {("u1", "main"), ("u1", "subagent"), ("u3", "main"), ("u3/k", "subagent"), ("mvs_12", "main"), ("mvs_9", "main")}


def test_files_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 3}/f {i % 7}.txt", i, f"line {i}\n") for i in range(500)] + [("none.txt", 0, None)], "path string, place long, body string").repartition(4)
    first = {r.path: (r.bytes, r.kept) for r in export.write_files(rows, str(tmp_path), keep=True).collect()}
    assert len(first) == 22 and not any(k for _, k in first.values())
    assert (tmp_path / "d1" / "f 1.txt").read_text() == "".join(f"line {i}\n" for i in range(500) if i % 21 == 1)
    (tmp_path / "d1" / "f 1.txt").write_text("mine")
    again = {r.path: (r.bytes, r.kept) for r in export.write_files(rows, str(tmp_path), keep=True).collect()}
    assert all(k for _, k in again.values()) and (tmp_path / "d1" / "f 1.txt").read_text() == "mine"
    export.write_files(rows, str(tmp_path))
    assert (tmp_path / "d1" / "f 1.txt").stat().st_size == first["d1/f 1.txt"][0]
    assert not [p for p in tmp_path.rglob("*") if p.name.endswith(".part")]


def test_chats_of_a_store_are_exported_once(spark, tmp_path):
    import sqlite3

    from sessionloom.sources import chats

    path, out = str(tmp_path / "s.db"), tmp_path / "out"
    db = sqlite3.connect(path)
    db.executescript("CREATE TABLE composerHeaders(composerId, value, createdAt, isSubagent); CREATE TABLE cursorDiskKV(key, value);")
    db.executemany("INSERT INTO composerHeaders VALUES (?, ?, 1, ?)", [("c1", None, 0), ("c2", json.dumps({"name": "head"}), 0), ("c3", None, 0), ("sub", None, 1), ("none", None, 0)])
    say = lambda text: json.dumps({"type": 1, "text": text})
    db.executemany("INSERT INTO cursorDiskKV VALUES (?, ?)", [
        ("composerData:c1", json.dumps({"name": "one", "createdAt": 1714557600000, "workspaceIdentifier": {"uri": {"fsPath": "/w/own"}}})), ("composerData:c2", json.dumps({"createdAt": "2024-05"})), ("composerData:c3", "{}"),
        ("bubbleId:c1:a", say("hi")), ("bubbleId:c2:a", say("x")), ("bubbleId:c2:b", say("Workspace Path:  /w/told \nmore")), ("bubbleId:c3:a", say("/h/projects/a and /h/projects/a/b /h/projects/a/b")), ("bubbleId:sub:a", say("no")),
    ])
    db.commit()
    first = {r.path: r.kept for r in chats.export_ide(spark, path, str(out), "/h").collect()}
    assert first == {f"c{i}{e}": False for i in (1, 2, 3) for e in (".jsonl", ".meta.json")}
    meta = {p.name[:2]: json.loads(p.read_text()) for p in out.glob("*.meta.json")}
    assert {c: (m.get("title"), m.get("createdAt"), m.get("workspacePath"), m["msgCount"]) for c, m in meta.items()} == {"c1": ("one", "2024-05-01T10:00:00.000Z", "/w/own", 1), "c2": ("head", "2024-05", "/w/told", 2), "c3": (None, None, "/h/projects/a/b", 1)}
    times = {p.name: p.stat().st_mtime_ns for p in out.iterdir()}
    (out / "c2.jsonl").unlink()
    assert [r.path for r in chats.export_ide(spark, path, str(out), "/h").collect() if not r.kept] == ["c2.jsonl"]
    assert all(p.stat().st_mtime_ns == times[p.name] for p in out.iterdir() if p.name != "c2.jsonl")
