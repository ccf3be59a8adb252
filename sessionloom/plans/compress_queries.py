"""Compression of conversations by a scripted model that fails at set places."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import compress as P
from ..operators import turns as U
from ..storage import shared_dir, written
from .session_queries import _TALK_TURNS, _packed_sql, _talks

QUERIES, ORACLES = {}, {}

WINDOW_TOKENS = 500


def turn_table(spark, d) -> DataFrame:
    """TURNS of conversations; turns of even number count their quotes as thinking, and every turn ended with exit code 0."""
    entries = _talks(spark, d)
    rows = U.with_windows(U.turns(entries), WINDOW_TOKENS).join(U.slice_texts(entries), ["session_key", "turn_index"])
    ids = U.quotes(entries).groupBy("session_key", "turn_index").agg(F.sort_array(F.collect_list("q")).alias("quote_ids"))
    last = rows.groupBy("session_key").agg(F.max("window_index").alias("last"))
    rows = rows.join(ids, ["session_key", "turn_index"], "left").join(last, "session_key")
    none = F.array().cast("array<string>")
    quotes = F.coalesce("quote_ids", none)
    return rows.select(
        "session_key", "window_index", "turn_index", "from_line", "to_line", "slice_hash", F.format_string("TURN b%d", "turn_index").alias("prompt"), quotes.alias("quote_ids"), F.when(F.col("turn_index") % 2 == 0, quotes).otherwise(none).alias("thinking_ids"),
        F.lit(None).cast("long").alias("checks_failed"), F.lit(0).cast("long").alias("exit_code"), F.format_string("turn %d", "turn_index").alias("floor"), (F.col("window_index") == F.col("last")).alias("last_window"),
    )


def _code(of: str, count: int) -> Column:
    return (F.col("session_key").cast("long") * 7 + F.col(of) * 3) % count


def scripted(rows: DataFrame) -> DataFrame:
    """A model whose answers follow from the turn and the attempt."""
    first, attempt, code = F.col("messages")[0]["text"], F.col("attempt"), _code("turn_index", 8)
    action = F.when(F.startswith(first, F.lit("State of the work")), "went on").otherwise("began")
    q = F.coalesce(F.get("quote_ids", F.lit(0)), F.lit("none"))

    def block(start: Column, thoughts: Column, claimed: Column | None = None) -> Column:
        facts = [F.struct(claimed.alias("exitCode")).alias("factsClaimed")] if claimed is not None else []
        return F.concat(F.lit("Here: "), F.to_json(F.struct(F.struct(start.alias("fromLine"), F.col("to_line").alias("toLine")).alias("anchor"), action.alias("action"), thoughts.alias("thoughts"), *facts)))

    thought = F.array(F.struct(F.lit("INSIGHT").alias("kind"), F.lit("narration").alias("source"), q.alias("q"), F.lit("an idea").alias("text")))
    none = F.array().cast(rows.select(thought.alias("t")).schema["t"].dataType)
    own_thoughts = F.when(F.size("quote_ids") > 0, thought).otherwise(none)
    good = block(F.col("from_line"), own_thoughts)
    reply = (
        F.when((code == 1) & (attempt < 1), "no object").when((code == 2) & (attempt < 2), block(F.col("to_line") + 5, own_thoughts)).when((code == 4) & (attempt < 4), "{broken").when(code == 5, "nothing")
        .when(code == 6, block(F.col("from_line"), own_thoughts, F.lit(99))).when((code == 7) & (attempt < 1), block(F.col("from_line"), none)).otherwise(good)
    )
    about, belief = _code("window_index", 4), F.when(F.startswith(first, F.lit("State before")), "carried").otherwise("first")
    body = F.to_json(F.struct(F.lit("g").alias("goal"), F.array().cast("array<string>").alias("openHypotheses"), belief.alias("currentBelief")))
    digest = F.when(about == 1, "none").when(about == 2, F.concat(F.lit("x" * P.LONGEST_DIGEST), body)).otherwise(body)
    told = rows.select(*P.KEY, F.when(F.col("turn_index") == 0, digest).otherwise(reply).alias("reply"), "attempt")
    return told.where(~((F.col("turn_index") > 0) & (code == 3) & (attempt < 3))).select(*P.KEY, "reply")


def _run(spark, d) -> str:
    turns = written(turn_table(spark, d))
    path = f"{shared_dir(spark)}/sessionloom/{uuid.uuid4().hex}"
    P.compress(turns, scripted, path)
    return path


_PACKED = f"""{_TALK_TURNS}, {_packed_sql('turns', WINDOW_TOKENS)},
q AS (SELECT session_key, turn_index, count(*) FILTER (role = 'assistant' AND text SIMILAR TO '(.|\\s)*\\S(.|\\s)*') AS quotes FROM (SELECT t.*, c.text FROM turned t JOIN conversations c ON c.conv_id::VARCHAR = t.session_key AND c.turn = t.turn) GROUP BY ALL),
t AS (SELECT session_key, window_index, turn_index, (session_key::BIGINT * 7 + turn_index * 3) % 8 AS code, turn_index % 2 = 0 AND quotes > 0 AS thinks FROM pack JOIN turns USING (session_key, turn_index) JOIN q USING (session_key, turn_index))"""


def compressed(spark, d):
    """How often each turn was asked for, what it came to, and whether it was told the state of earlier windows; in rows of turn 0
    which digests carry a session on, and which are the floor."""
    path = _run(spark, d)
    turns = P.records_of(spark, path).select("session_key", "window_index", "turn_index", "asked", "retries", "fresh", "fallback", "disputed", F.get_json_object("result", "$.action").alias("said"))
    no = F.lit(False)
    digests = P.digests_of(spark, path).select("session_key", "window_index", F.lit(0).cast("long").alias("turn_index"), F.lit(1).alias("asked"), F.lit(0).alias("retries"), no.alias("fresh"), F.col("floor").alias("fallback"), no.alias("disputed"), F.get_json_object("digest", "$.currentBelief").alias("said"))
    return turns.unionByName(digests)


QUERIES["compressed"] = compressed
ORACLES["compressed"] = f"""{_PACKED}, r AS (SELECT *, CASE code WHEN 5 THEN 4 WHEN 6 THEN 3 WHEN 7 THEN CASE WHEN thinks THEN 1 ELSE 0 END ELSE code END::INT AS retries FROM t),
w AS (SELECT DISTINCT session_key, window_index, (session_key::BIGINT * 7 + window_index * 3) % 4 AS code, max(window_index) OVER (PARTITION BY session_key) AS last FROM t)
SELECT session_key, window_index, turn_index, (retries + 1)::INT AS asked, retries, code = 4 AS fresh, code = 5 AS fallback, code = 6 AS disputed, CASE WHEN code = 5 THEN 'turn ' || turn_index WHEN window_index > 1 AND code <> 4 THEN 'went on' ELSE 'began' END AS said FROM r
UNION ALL SELECT session_key, window_index, 0, 1, 0, false, code IN (1, 2), false, CASE WHEN code IN (1, 2) THEN '(unknown)' WHEN window_index > 1 THEN 'carried' ELSE 'first' END FROM w WHERE window_index < last"""
