"""Claims of jobs without a lock: rivals append claims to a ledger, and a fold of the ledger says who won.

A worker reads the ledger, appends a claim with the next epoch of a job and a nonce of its own, and reads again: of the claims of one
(job, epoch) the first in ledger order wins, every reader sees the same winner, and losers see at once that they lost. The order is
(ts, nonce), so it does not depend on which file an event lies in or when it was read. Submissions and releases carry the nonce and
count only from the job's holder: a worker whose lease ran out and whose job another one took can't change the job any more.

A claim that is appended late with an early time could overtake one that was believed already. Workers therefore append within
SETTLE_MS of their reading and believe a claim only SETTLE_MS after they appended it.

Folding is one sorted pass with one job's state in memory, whatever the number of its events; replays of the same events in any order
give the same outcomes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import append_lines
from . import work as W
from .folds import ordered_fold
from .submissions import MOST_REJECTIONS

LEASE_MS, SETTLE_MS = 45 * 60_000, 5_000
EVENT = "job_id string, ts long, nonce string, ev string, worker string, epoch long, lease_until long"
FOLDED = "outcome string, holder string, held_until long, held_epoch long, fails long, done boolean"


@dataclass
class Job:
    """What the events so far say of one job."""

    epoch: int = 0
    holder: str | None = None
    lease_until: int | None = None
    fails: int = 0
    done: bool = False

    def after(self, ev: str, ts: int, nonce: str | None, epoch: int | None, lease_until: int | None) -> str:
        """Takes one event and says what became of it: won, or done, stale, leased for lost claims; ok, released or foreign for the others."""
        if ev == "claim":
            if self.done:
                return "done"
            if epoch != self.epoch + 1:
                return "stale"
            if self.holder is not None and (self.lease_until or 0) > ts:
                return "leased"
            self.epoch, self.holder, self.lease_until, self.fails = epoch, nonce, lease_until, 0
            return "won"
        if self.holder is None or self.holder != nonce:
            return "foreign"
        self.fails += ev == "submit-fail"
        if ev == "submit-fail" and self.fails < MOST_REJECTIONS:
            return "ok"
        self.done = ev == "submit-ok"
        self.holder = self.lease_until = None
        return "released" if ev == "submit-fail" else "ok"

    def row(self, outcome: str) -> tuple:
        return outcome, self.holder, self.lease_until, self.epoch, self.fails, self.done


def folded(events: DataFrame) -> DataFrame:
    """Every event of EVENT with what became of it and the job's state behind it (FOLDED)."""

    def step(state: Job, values: tuple) -> tuple[Job, tuple]:
        return state.row(state.after(*values))

    return ordered_fold(events, "job_id", ["ts", "nonce", "ev", "epoch"], ["ev", "ts", "nonce", "epoch", "lease_until"], Job, step, FOLDED)


def states(events: DataFrame) -> DataFrame:
    """(job_id, status, worker, lease_until, fails, claims, epoch), as job_states gives them, of jobs with events."""
    rows = folded(events)
    at = F.struct("ts", "nonce", "ev", "epoch")
    last = lambda c: F.max_by(c, at)
    won = F.when(F.col("outcome") == "won", at)
    out = rows.groupBy("job_id").agg(last("done").alias("done"), last("holder").alias("holder"), last("held_until").alias("lease_until"), last("fails").alias("fails"), last("held_epoch").alias("epoch"), F.max_by("worker", won).alias("w"), F.count_if(F.col("outcome") == "won").alias("claims"))
    held = F.col("holder").isNotNull()
    return out.select("job_id", F.when(F.col("done"), "done").when(held, "claimed").otherwise("pending").alias("status"), F.when(held, F.col("w")).alias("worker"), "lease_until", "fails", "claims", "epoch")


def winners(events: DataFrame) -> DataFrame:
    """(job_id, epoch, worker, nonce, ts, lease_until) of the won claims."""
    return folded(events).where("outcome = 'won'").select("job_id", "epoch", "worker", "nonce", "ts", "lease_until")


def bids(jobs: DataFrame, events: DataFrame, worker: str, nonce: str, now: int, most: int = 1, lease_ms: int = LEASE_MS) -> DataFrame:
    """Claims (EVENT) of the first ``most`` jobs in claim order that may be claimed at ``now``, for the worker to append."""
    known = states(events)
    free = W.claimable(jobs, known, F.lit(now)).orderBy(*W.claim_order(jobs)).limit(most)
    rows = free.join(known.select("job_id", "epoch"), "job_id", "left")
    return rows.select("job_id", F.lit(now).cast("long").alias("ts"), F.lit(nonce).alias("nonce"), F.lit("claim").alias("ev"), F.lit(worker).alias("worker"), (F.coalesce("epoch", F.lit(0)) + 1).alias("epoch"), F.lit(now + lease_ms).cast("long").alias("lease_until"))


def held_by(events: DataFrame, nonce: str, now: Column) -> DataFrame:
    """(job_id, epoch, lease_until) of jobs that the nonce holds at ``now``."""
    rows = folded(events).groupBy("job_id").agg(*(F.max_by(c, F.struct("ts", "nonce", "ev", "epoch")).alias(c) for c in ("holder", "held_until", "held_epoch")))
    return rows.where((F.col("holder") == nonce) & (F.col("held_until") > now)).select("job_id", F.col("held_epoch").alias("epoch"), F.col("held_until").alias("lease_until"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The events of a ledger folder; a ledger that is not there yet has none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], EVENT)
    return spark.read.schema(EVENT).json(path)


def claim(spark: SparkSession, path: str, jobs: DataFrame, worker: str, nonce: str, now: int, most: int = 1, lease_ms: int = LEASE_MS) -> None:
    """Appends the worker's claims to the ledger at ``path``; ``held_by`` tells later which of them won."""
    append_lines(bids(jobs, read_ledger(spark, path), worker, nonce, now, most, lease_ms), path)
