"""Acceptance of submissions in batches: records, then metrics, then the ledger, each whole or not there, and the same after a repeat.

A batch is named by its caller: a file's name, or the number that a stream gives its micro-batch. Records and metrics of a batch count only once its
ledger events are written, so a run that is killed between leaves nothing that anyone sees, and doing the batch again
replaces what was left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..storage import commit, committed
from . import submissions as S

RECORDS = "job_id string, turn_index long, from_line long, to_line long, slice_hash string, result string, fallback boolean"
METRICS = "job_id string, accepted boolean, blocks long, fallbacks long, errors long, ts string"
EVENTS = "job_id string, ev string, ts string, errors array<string>"


def accept(submissions: DataFrame, turns: DataFrame, jobs: DataFrame, states: DataFrame, now: Column, out: str, batch: str) -> None:
    """Takes submissions (job_id, body), one for each job, against the turns of their windows (job_id, turn_index, from_line, to_line, slice_hash,
    quote_ids, thinking_ids) and jobs (job_id, last_window); of states, job_id and fails count."""
    submissions = submissions.groupBy("job_id").agg(F.min("body").alias("body"))
    blocks = S.window_blocks(submissions, turns)
    verdicts = S.window_verdicts(submissions, turns, blocks, jobs)
    records = S.sidecar_records(blocks, verdicts).select(*(f.split()[0] for f in RECORDS.split(", ")))
    sums = records.groupBy("job_id").agg(F.count("*").alias("blocks"), F.count_if("fallback").alias("fallbacks"))
    none = F.lit(0).cast("long")
    metrics = verdicts.join(sums, "job_id", "left").select("job_id", "accepted", F.coalesce("blocks", none).alias("blocks"), F.coalesce("fallbacks", none).alias("fallbacks"), F.size("errors").cast("long").alias("errors"), now.cast("string").alias("ts"))
    events = S.ledger_events(verdicts, states, now.cast("string")).select("job_id", "ev", "ts", "errors")
    commit([(records, f"{out}/records"), (metrics, f"{out}/metrics"), (events, f"{out}/ledger")], batch)


def accepted(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """records, metrics and ledger of all whole batches."""
    return {name: committed(spark, f"{out}/{name}", schema, by=f"{out}/ledger") for name, schema in (("records", RECORDS), ("metrics", METRICS), ("ledger", EVENTS))}


def accepting(submissions: DataFrame, context: Callable[[], tuple[DataFrame, DataFrame, DataFrame]], now: Callable[[], Column], out: str) -> DataStreamWriter:
    """The writer of a stream of submissions (job_id, body): each micro-batch is accepted under its number. ``context`` gives turns,
    jobs and states as they are when the micro-batch is taken."""

    def take(rows: DataFrame, number: int) -> None:
        accept(rows, *context(), now(), out, f"{number:012d}")

    return submissions.writeStream.foreachBatch(take)


def render_final(states: DataFrame, documents: DataFrame, folder: str) -> DataFrame:
    """Writes the document (session_key, file_name, markdown) of every finished session (session_key, state = 'rendered') as a file; files that are
    there already stay, so a repeat writes nothing. Returns (path, bytes, kept)."""
    from ..sources.export import write_files

    rows = documents.join(states.where("state = 'rendered'").select("session_key"), "session_key", "left_semi")
    return write_files(rows.select(F.col("file_name").alias("path"), F.lit(0).cast("long").alias("place"), F.col("markdown").alias("body")), folder, keep=True)
