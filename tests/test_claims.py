"""Claims without a lock: rivals, replays, fencing, streams."""

import json
import random
from collections import Counter

from sessionloom.operators import claims as C
from sessionloom.plans import claim_queries

DATA = "/root/testdata/sf0.001"
JOBS = "job_id string, layer string, session_id string, window_index long, started_at string, project string, tokens long"


def jobs(spark, n=6):
    return spark.createDataFrame([(f"p1-s{i}-w1", "pass1", f"s{i}", 1, f"2024-05-0{i + 1}", "p", 10) for i in range(n)], JOBS)


def told(df):
    return Counter((r.job_id, r.ts, r.nonce, r.ev, r.epoch, r.outcome, r.holder, r.held_until, r.held_epoch, r.fails, r.done) for r in df.collect())


def test_rivals_see_one_winner_and_losers_go_on(spark, tmp_path):
    path, table = str(tmp_path / "ledger"), jobs(spark)
    read = lambda: C.read_ledger(spark, path)
    empty = read()
    # Both read an empty ledger and append; b's clock is a little ahead.
    for worker, now in (("b", 1_000), ("a", 1_002)):
        C.append_lines(C.bids(table, empty, worker, f"nonce-{worker}", now, 2), path)
    held = lambda w, at: sorted(r.job_id for r in C.held_by(read(), f"nonce-{w}", C.F.lit(at)).collect())
    assert held("b", 1_100) == ["p1-s4-w1", "p1-s5-w1"] and held("a", 1_100) == []
    C.claim(spark, path, table, "a", "nonce-a", 1_200)
    assert held("a", 1_300) == ["p1-s3-w1"]
    # b's leases run out, a takes the newest job, and what b then says of it does not count.
    late = 1_000 + C.LEASE_MS + 1
    C.claim(spark, path, table, "a", "nonce-a2", late)
    event = {"job_id": "p1-s5-w1", "ts": late + 5, "nonce": "nonce-b", "ev": "submit-ok", "worker": "b"}
    C.append_lines(spark.createDataFrame([json.dumps(event)], "string").selectExpr(f"from_json(value, '{C.EVENT}') AS e").select("e.*"), path)
    state = {r.job_id: r for r in C.states(read()).collect()}
    assert (state["p1-s5-w1"].status, state["p1-s5-w1"].worker, state["p1-s5-w1"].epoch, state["p1-s5-w1"].claims) == ("claimed", "a", 2, 2)
    assert [r.outcome for r in C.folded(read()).where("ev = 'submit-ok'").collect()] == ["foreign"]


def test_outcomes_do_not_depend_on_the_order_of_reading(spark):
    rows = [tuple(r) for r in claim_queries.ledger(spark, DATA).drop("event_id").collect()]
    wanted = told(C.folded(spark.createDataFrame(rows, C.EVENT)))
    random.Random(1).shuffle(rows)
    assert told(C.folded(spark.createDataFrame(rows, C.EVENT).repartition(7))) == wanted
    outcomes = Counter(k[5] for k in wanted.elements())
    assert {"won", "stale", "leased", "foreign", "ok", "done"} <= set(outcomes)
    won = Counter((k[0], k[4]) for k in wanted.elements() if k[5] == "won")
    assert max(won.values()) == 1


def test_twenty_rejections_release(spark):
    events = [("j", 1, "n", "claim", "w", 1, 10**12)] + [("j", 2 + i, "n", "submit-fail", "w", None, None) for i in range(21)]
    rows = sorted(C.folded(spark.createDataFrame(events, C.EVENT)).collect(), key=lambda r: r.ts)
    assert [r.outcome for r in rows] == ["won"] + ["ok"] * 19 + ["released", "foreign"]
    assert (rows[-1].holder, rows[-1].done) == (None, False)


def test_stream_gives_what_batch_gives(spark, tmp_path):
    from sessionloom.streaming import claims as S

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = claim_queries.ledger(spark, DATA).drop("event_id").orderBy("ts", "nonce", "ev", "epoch").collect()
        wanted = Counter((r.job_id, r.ts, r.nonce, r.ev, r.outcome, r.holder, r.held_until, r.held_epoch, r.fails, r.done) for r in C.folded(spark.createDataFrame(rows, C.EVENT)).collect())

        def run():
            made = S.outcomes(spark.readStream.schema(C.EVENT).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")))
            made.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()

        (tmp_path / "in").mkdir()
        for part in range(3):
            own = rows[part * len(rows) // 3 : (part + 1) * len(rows) // 3]
            (tmp_path / "in" / f"{part}.json").write_text("".join(json.dumps(r.asDict()) + "\n" for r in own))
            if part:
                run()  # the first time two files, then the rest from the checkpoint
        got = Counter(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("job_id", "ts", "nonce", "ev", "outcome", "holder", "held_until", "held_epoch", "fails", "done").collect())
        assert got == wanted
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
