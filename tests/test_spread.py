"""Work that grows with the tables is dealt out, and stays away from the driver."""

from sessionloom.plans import catalogue

DATA = "/root/testdata/sf0.001"


def test_contracts_are_judged_by_many_tasks_and_parsed_once(spark):
    made = catalogue.QUERIES["contracts"](spark, DATA)
    assert made.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count("parsejson") <= 3


def test_waves_of_compression_broadcast_nothing(spark):
    from sessionloom.operators import compress as P

    turns, records, digests = (spark.createDataFrame([], s) for s in (P.TURNS, P.RECORDS, P.DIGESTS))
    plan = P.next_windows(turns, records, digests)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


def test_no_line_of_log_ranges_searches_its_path(spark):
    plan = catalogue.QUERIES["log_ranges"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "log_file" in plan and "regexp" not in plan.lower()


def test_traces_are_folded_once_and_made_of_the_same_parts(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from sessionloom.functions import text as T
    from sessionloom.operators import blocks, facts, render
    from sessionloom.sources.tables import as_entries

    pick, rows = random.Random(7), []
    for session in ("a", "b", "c", "d", "only side", None):
        for seq in range(60):
            kind = pick.choice(["user_text", "assistant_text", "tool_call", "tool_call", "tool_result", "tool_result", "system_note", "assistant_thinking"])
            tool, path = pick.choice(["Read", "Edit", "Bash", "Grep", "apply_patch"]), f"/p/{pick.randrange(4)}"
            given = pick.choice([f'{{"file_path":"{path}","old_string":"a","new_string":"b\\nc"}}', f'{{"command":"make {path}"}}', "plain", None])
            said = pick.choice([f"{seq % 5} passed, {seq % 3} failed", "x\n" * 90, "  ", "done", "Chunk ID: 1\nOutput\nend"])
            rows.append((session, seq, seq + 1, kind, said if kind[0] in "uas" else None, tool if kind == "tool_call" else None, given if kind == "tool_call" else None, pick.choice(["", "i", "j", f"k{seq // 8}", None]) if kind[:4] == "tool" else None,
                         said if kind == "tool_result" else None, pick.random() < 0.1, pick.random() < 0.02, pick.choice([None, 3]), pick.choice(["pr-link", "other"]), "2024", session == "only side" or pick.random() < 0.2, pick.random() < 0.3))
    entries = as_entries(spark.createDataFrame(rows, "session_key string, seq long, log_line long, kind string, text string, tool_name string, tool_input string, tool_call_id string, content string, is_error boolean, interrupted boolean, diff_added long, subtype string, ts string, sidechain boolean, turn_start boolean"))
    folds, fold = [], blocks.ordered_fold
    monkeypatch.setattr(blocks, "ordered_fold", lambda *a, **b: folds.append(a) or fold(*a, **b))
    got = {r.session_key: r for r in render.traces(entries).collect()}
    assert len(folds) == 1
    verdicts = {r.session_key: r for r in facts.verdicts(entries).collect() if r.session_key}
    assert set(got) == set(verdicts) == {"a", "b", "c", "d"}
    parts = sorted(blocks.blocks(entries).withColumn("at", T.ref_range(F.col("line_from"), F.col("line_to"))).collect(), key=lambda r: r.block_index)
    tools = sorted(blocks.tool_lines(entries).collect(), key=lambda r: r.pos)
    files = sorted(blocks.working_set(blocks.file_ledger(entries)).collect(), key=lambda r: r.rank)
    for key, v in verdicts.items():
        own = lambda b: [f"- {t.text}" for t in tools if (t.session_key, t.block_index) == (key, b.block_index)]  # noqa: B023, E731
        timeline = [x for b in parts if b.session_key == key for x in [f"### b{b.block_index} · {b.label} · {b.summary} {b.at}", *([b.assistant_text] if b.assistant_text is not None else []), *own(b)]]
        used = [f"- `{f.path}` reads {f.reads}" + (f" · +{f.added}/−{f.removed} @L{f.modify_refs}" if f.modified else "") for f in files if f.session_key == key]
        text = got[key].markdown
        for title, body in (("Verdict", [f"{v.status}: {v.why}"]), ("Timeline", timeline), ("Working Set", used)):
            assert f"\n## {title}\n\n" + "\n".join(body) + "\n" in text
        assert text.count("\n> ") == 1 + sum(r[0] == key and r[3] == "user_text" and not r[14] for r in rows)
