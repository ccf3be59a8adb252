"""Logs are listed and read inside tasks: the driver gets no paths."""

import json

from pyspark.sql import functions as F

from sessionloom.sources import discovery, logs, sniff
from sessionloom.sources.discovery import Root

NAMES = ["a b/x%20y.jsonl", "q/[z]#?.jsonl", "q/ü 日.jsonl", "q/+,;$&=@~!'()*.jsonl", ".h/x.jsonl", "_h/x.jsonl", "_a=1/x.jsonl", "q/_y.jsonl", "q/x.jsonl._COPYING_", "q/deep/er/z.txt"]


def test_a_tree_is_listed_and_read_as_spark_does(spark, tmp_path):
    for name in NAMES:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"\xef\xbb\xbfa\r\n\n\xffb\n\xef\xbb\xbfc")
    meta = lambda c: F.col(f"_metadata.{c}")
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select(meta("file_path"), meta("file_size"), meta("file_modification_time")).collect()
    assert {tuple(r)[1:] for r in sniff.tree(spark, [str(tmp_path)]).collect()} == {tuple(r) for r in plain} and len(plain) == 6
    rows = lambda df: sorted(map(tuple, df.withColumn("raw", F.hex("raw")).collect()))
    assert rows(logs.read_lines(spark, str(tmp_path))) == rows(logs.read_lines(spark, str(tmp_path), only=[r[0] for r in plain]))


def test_no_paths_pass_through_the_driver(spark, tmp_path, monkeypatch):
    for i in range(40):
        place = tmp_path / f"wd_w_0123456789ab/session_{i}/agents/main/wire.jsonl"
        place.parent.mkdir(parents=True)
        place.write_text(json.dumps({"type": "turn.prompt", "time": 1714557600000, "input": "go"}) + "\n")
    kind, got, scans = type(spark.range(1)), [], []
    collect, load = kind.collect, type(spark.read).load
    monkeypatch.setattr(kind, "collect", lambda self: got.append(collect(self)) or got[-1])
    monkeypatch.setattr(type(spark.read), "load", lambda self, *a, **b: scans.append(a) or load(self, *a, **b))
    entries, sessions = discovery.read(spark, [Root("kimi", str(tmp_path)), Root("cursor", str(tmp_path))])
    assert max(map(len, got), default=0) <= 1 and not scans
    monkeypatch.undo()
    assert entries.count() == 40 and {r.session_id for r in sessions.collect()} == {str(i) for i in range(40)}


def test_many_ranges_are_one_task(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f"line {i}\n" for i in range(9000)))
    made = logs.read_lines(spark, str(tmp_path), range_bytes=200)
    assert len(made.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism
    assert [(r.log_line, r.raw) for r in made.orderBy("log_line").collect()] == [(i + 1, f"line {i}") for i in range(9000)]


def test_no_table_of_logs_is_broadcast(spark, tmp_path):
    pad = {"pad": "x" * 5000}
    for i in range(40):
        place = tmp_path / f"kimi/wd_w_0123456789ab/session_{i}/agents/main/wire.jsonl"
        place.parent.mkdir(parents=True)
        place.write_text("\n".join(map(json.dumps, [{"type": "turn.prompt", "time": 1714557600000, "input": "go", "pad": pad}, {"type": "turn.cancel", "time": 1714557700000, **pad}, {"type": "turn.cancel", "time": 1714557700000}])))
        (tmp_path / f"mini/named-session_{i}").mkdir(parents=True)
        (tmp_path / f"mini/named-session_{i}/messages.jsonl").write_text(json.dumps({"message": {"role": "custom", "content": "YOUR WORKSPACE DIRECTORY: /w"}, "pad": pad}))
        (tmp_path / f"mini/named-session_{i}/manifest.json").write_text(json.dumps({"sessionId": f"m-{i}", "createdAtMs": 1714557600000, "pad": pad}))
    roots = [Root("kimi", str(tmp_path / "kimi")), Root("minimax", str(tmp_path / "mini"))]
    kept = discovery.census(spark, roots, under="/w")
    sessions = discovery.read(spark, roots)[1]
    for made, n in ((kept, 80), (sessions, 80)):
        assert len(made.collect()) == n
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    told = {r.session_id: (r.started_at, r.ended_at) for r in sessions.collect()}
    assert told["7"] == ("2024-05-01T10:00:00.000Z", "2024-05-01T10:01:40.000Z") and told["m-7"] == ("2024-05-01T10:00:00.000Z", None)
