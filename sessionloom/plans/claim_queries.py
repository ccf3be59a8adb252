"""Queries over rival claims: events of a user, twelve at a time, as the ledger of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import claims as C

QUERIES, ORACLES = {}, {}

HOUR = 3_600_000
_LEDGER = f"""RECURSIVE r AS (SELECT *, (props::JSON->>'$.k')::BIGINT AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
e AS (SELECT user_id || '-' || i // 12 AS job_id, epoch_us(ts) // 1000 AS ts, 'n' || k % 4 AS nonce, event_id,
 CASE WHEN event_type = 'error' THEN 'submit-fail' WHEN event_type <> 'purchase' THEN 'claim' WHEN k % 3 = 0 THEN 'submit-ok' ELSE 'release' END AS ev, k FROM r),
l AS (SELECT *, CASE WHEN ev = 'claim' THEN 1 + (count(*) FILTER (ev = 'claim') OVER (PARTITION BY job_id ORDER BY ts, event_id) - 1) // 2 END AS epoch, ts + k % 12 * {HOUR} AS lease_until FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts, nonce, ev, epoch NULLS FIRST) AS n FROM l),
f(job_id, n, event_id, outcome, holder, held_until, held_epoch, fails, done) AS (
 SELECT DISTINCT job_id, 0::BIGINT, NULL::BIGINT, '', NULL::VARCHAR, NULL::BIGINT, 0::BIGINT, 0::BIGINT, false FROM n UNION ALL
 SELECT job_id, n, event_id, o, CASE WHEN o = 'won' THEN nonce WHEN ends THEN NULL ELSE holder END, CASE WHEN o = 'won' THEN lease_until WHEN ends THEN NULL ELSE held_until END, CASE WHEN o = 'won' THEN epoch ELSE held_epoch END,
  CASE WHEN o = 'won' THEN 0 WHEN o <> 'foreign' AND ev = 'submit-fail' THEN fails + 1 ELSE fails END, done OR (o = 'ok' AND ev = 'submit-ok') FROM (
  SELECT *, o = 'released' OR (o = 'ok' AND ev <> 'submit-fail') AS ends FROM (
   SELECT n.job_id, n.n, n.event_id, n.ev, n.nonce, n.epoch, n.lease_until, f.holder, f.held_until, f.held_epoch, f.fails, f.done,
    CASE WHEN ev = 'claim' THEN CASE WHEN done THEN 'done' WHEN epoch <> held_epoch + 1 THEN 'stale' WHEN holder IS NOT NULL AND held_until > ts THEN 'leased' ELSE 'won' END
     WHEN holder IS NULL OR holder <> nonce THEN 'foreign' WHEN ev = 'submit-fail' AND fails + 1 >= 20 THEN 'released' ELSE 'ok' END AS o
   FROM f JOIN n ON n.job_id = f.job_id AND n.n = f.n + 1)))"""


def ledger(spark, d) -> DataFrame:
    """EVENT and event_id: about two rivals an epoch, leases of up to eleven hours."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    line = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = spark.read.parquet(f"{d}/events.parquet").withColumns({"k": k, "i": F.row_number().over(line) - 1})
    kind = F.col("event_type")
    ev = F.when(kind == "error", "submit-fail").when(kind != "purchase", "claim").when(F.col("k") % 3 == 0, "submit-ok").otherwise("release")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = rows.select(F.concat_ws("-", "user_id", F.floor(F.col("i") / 12)).alias("job_id"), ms.alias("ts"), F.concat(F.lit("n"), (F.col("k") % 4).cast("string")).alias("nonce"), "event_id", ev.alias("ev"), "k")
    job = Window.partitionBy("job_id").orderBy("ts", "event_id")
    epoch = F.when(F.col("ev") == "claim", 1 + F.floor((F.count_if(F.col("ev") == "claim").over(job) - 1) / 2))
    return rows.select("job_id", "ts", "nonce", "ev", F.col("nonce").alias("worker"), epoch.cast("bigint").alias("epoch"), (F.col("ts") + F.col("k") % 12 * HOUR).alias("lease_until"), "event_id")


def claim_outcomes(spark, d):
    """What became of every claim, submission and release, and the job's state behind it."""
    return C.folded(ledger(spark, d)).select("job_id", "event_id", "ev", "outcome", "holder", "held_until", "held_epoch", "fails", "done")


QUERIES["claim_outcomes"] = claim_outcomes
ORACLES["claim_outcomes"] = f"WITH {_LEDGER} SELECT f.job_id, f.event_id, n.ev, outcome, holder, held_until, held_epoch, fails, done FROM f JOIN n USING (job_id, n)"


def claim_winners(spark, d):
    return C.winners(ledger(spark, d))


QUERIES["claim_winners"] = claim_winners
ORACLES["claim_winners"] = f"WITH {_LEDGER} SELECT job_id, epoch, nonce AS worker, nonce, ts, lease_until FROM f JOIN n USING (job_id, n) WHERE outcome = 'won'"


def claim_states(spark, d):
    return C.states(ledger(spark, d))


QUERIES["claim_states"] = claim_states
ORACLES["claim_states"] = f"""WITH {_LEDGER}, z AS (SELECT * FROM f WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY n DESC) = 1), w AS (SELECT job_id, count(*) AS claims FROM f WHERE outcome = 'won' GROUP BY job_id)
SELECT job_id, CASE WHEN done THEN 'done' WHEN holder IS NOT NULL THEN 'claimed' ELSE 'pending' END AS status, holder AS worker, held_until AS lease_until, fails, coalesce(claims, 0) AS claims, held_epoch AS epoch FROM z LEFT JOIN w USING (job_id)"""
