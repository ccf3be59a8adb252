"""Job states and activity over streams of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATES = "job_id string, status string, worker string, lease_until long, fails long, claims long"


def job_states(events: DataFrame) -> DataFrame:
    """The current state of each job after each micro-batch, from a stream of ledger events (job_id, seq, ev, worker, lease_until)."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, worker, lease, fails, claims = state.get if state.exists else ("pending", None, None, 0, 0)
        rows = pd.concat(list(batches)).sort_values("seq")
        for ev, who, until in rows[["ev", "worker", "lease_until"]].itertuples(index=False):
            if ev == "claim":
                status, worker, lease, fails, claims = "claimed", who, int(until), 0, claims + 1
            elif ev == "submit-fail":
                fails += 1
            else:
                status, worker, lease = ("done" if ev == "submit-ok" else "pending"), None, None
        state.update((status, worker, lease, fails, claims))
        yield pd.DataFrame({"job_id": [key[0]], "status": [status], "worker": [worker], "lease_until": pd.array([lease], "Int64"), "fails": [fails], "claims": [claims]})

    held = "status string, worker string, lease_until long, fails long, claims long"
    return events.groupBy("job_id").applyInPandasWithState(fold, STATES, held, "update", GroupStateTimeout.NoTimeout)


def activity(events: DataFrame, key: str, ts: str, gap: str = "2 minutes", late: str = "10 minutes") -> DataFrame:
    """(key, started_at, ended_at, n): runs of events without a longer gap; a gap as long as the limit still joins."""
    runs = events.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"))
    return runs.select(key, "started_at", "ended_at", "n")


def tool_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(started_at, kind, n) of tumbling windows."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("started_at"), kind, "n")
