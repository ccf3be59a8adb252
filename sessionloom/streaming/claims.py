"""Claims over a stream of ledger events: the same fold as in batch, with one state a job."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.claims import Job

STATE = "epoch long, holder string, lease_until long, fails long, done boolean"
OUTCOMES = "job_id string, ts long, nonce string, ev string, outcome string, holder string, held_until long, held_epoch long, fails long, done boolean"


class Claims(StatefulProcessor):
    """Tells each event's outcome as soon as its batch is read; a batch's events of one job are taken in ledger order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        job = Job(*self.state.get()) if self.state.exists() else Job()
        batch = pd.concat(list(rows)).sort_values(["ts", "nonce", "ev", "epoch"])
        none = lambda x: None if pd.isna(x) else x
        out = []
        for r in batch.itertuples(index=False):
            epoch, lease = (None if pd.isna(x) else int(x) for x in (r.epoch, r.lease_until))
            out.append((key[0], r.ts, r.nonce, r.ev, *job.row(job.after(r.ev, int(r.ts), none(r.nonce), epoch, lease))))
        self.state.update((job.epoch, job.holder, job.lease_until, job.fails, job.done))
        made = pd.DataFrame(out, columns=[c.split()[0] for c in OUTCOMES.split(", ")])
        yield made.astype({"held_until": "Int64", "held_epoch": "Int64", "fails": "Int64"})

    def close(self) -> None:
        pass


def outcomes(events: DataFrame) -> DataFrame:
    """OUTCOMES of a stream of events (EVENT); needs the RocksDB state store."""
    return events.groupBy("job_id").transformWithStateInPandas(Claims(), OUTCOMES, "append", "none")
