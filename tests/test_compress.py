"""Compression that is stopped and goes on; commits that are cut off and repeated."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import compress as P
from sessionloom.plans.compress_queries import scripted
from sessionloom.storage import commit, committed


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(str(s), 1 + t // 2, t + 1, 2 * t + 1, 2 * t + 2, f"h{s}-{t}", f"TURN {t}", [f"q{t}"], [f"q{t}"] if t % 2 else [], None, 0, f"floor {t}", t // 2 == 1) for s in range(4) for t in range(4)]
    return spark.createDataFrame(rows, P.TURNS).cache()


def state(spark, path):
    records = Counter((r.session_key, r.turn_index, r.result, r.asked, r.fallback, r.disputed) for r in P.records_of(spark, path).collect())
    return records, Counter((r.session_key, r.window_index, r.digest, r.floor) for r in P.digests_of(spark, path).collect())


def test_a_stopped_run_goes_on_and_asks_nothing_again(spark, turns, tmp_path):
    once, again = str(tmp_path / "once"), str(tmp_path / "again")
    assert P.compress(turns, scripted, once) == 2
    wanted = state(spark, once)
    assert sum(wanted[0].values()) == 16 and sum(wanted[1].values()) == 4 and max(wanted[0].values()) == 1

    calls = []

    def failing(prompts):
        """Breaks off at the first digest, when the records of the first window are written, and counts what it is asked."""
        calls.append(prompts.select("session_key", "turn_index", "attempt").collect())
        if calls[-1] and calls[-1][0].turn_index == 0 and not broken:
            broken.append(True)
            raise ConnectionError("gone")
        return scripted(prompts)

    broken = []
    with pytest.raises(ConnectionError):
        P.compress(turns, failing, again)
    assert P.records_of(spark, again).count() == 8 and P.digests_of(spark, again).count() == 0
    assert P.compress(turns, failing, again, waves=1) == 1
    P.compress(turns, failing, again)
    assert state(spark, again) == wanted
    asked = Counter(tuple(r) for c in calls for r in c if r.turn_index)
    assert max(asked.values()) == 1  # no turn is asked at an attempt twice
    assert P.compress(turns, failing, again) == 0


def test_what_a_turn_is_told(spark, turns, tmp_path):
    seen = []

    def model(prompts):
        seen.extend(prompts.collect())
        return prompts.select(*P.KEY, F.lit(None).cast("string").alias("reply"))

    P.compress(turns.where("session_key = '0' and turn_index <= 2").withColumn("last_window", F.lit(True)), model, str(tmp_path / "none"))
    told = {(r.turn_index, r.attempt): [m.text for m in r.messages] for r in seen}
    assert [len(told[2, a]) for a in range(5)] == [1, 3, 5, 7, 1]
    assert "no JSON object" in told[2, 1][-1] and "thoughts must not be empty" in told[2, 2][-1] and "smallest" in told[1, 2][-1] and "fromLine 3, toLine 4" in told[2, 3][-1]
    rows = {r.turn_index: r for r in P.records_of(spark, str(tmp_path / "none")).collect()}
    assert rows[1].fallback and "floor 0" in rows[1].result and rows[1].asked == 5
    assert P.counts(P.records_of(spark, str(tmp_path / "none"))).first().fallbacks == 2


def test_commits_show_whole_batches_only_and_repeat_without_change(spark, tmp_path):
    records, ledger = str(tmp_path / "records"), str(tmp_path / "ledger")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    seen = lambda: (committed(spark, records, "id int, v string", by=ledger).count(), committed(spark, ledger, "id int, v string").count())
    broken = rows.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        commit([(rows, records), (broken, ledger)], "1")
    assert seen() == (0, 0) and committed(spark, records, "id int, v string").count() == 2
    for _ in range(2):
        commit([(rows, records), (rows, ledger)], "1")
        assert seen() == (2, 2)
    commit([(rows, records), (rows, ledger)], "2")
    assert seen() == (4, 4)
