"""Compression of turns by a model, as a state machine that stops anywhere and goes on from its records.

Sessions advance a window at a time, all of them together: a wave takes each session's first unfinished window, asks for its turns, and then,
for every window but a session's last, for the digest that the next window starts from. A turn has ATTEMPTS answers in one
conversation, each told what was wrong with the one before, then one in a fresh conversation, and then the floor that needs no
model. Each attempt is one pass over the turns that are still open, so rules are the same column expressions that check other
submissions, and what is asked again shrinks from pass to pass. A wave writes its records, then its digests; a run that was
stopped finds the turns that have records and asks only for the others.

A model is a function from prompts (session_key, window_index, turn_index, attempt, from_line, to_line, quote_ids, messages array<struct<role, text>>) to
replies (session_key, window_index, turn_index, reply), one at most for each; turn_index 0 asks for the digest. Missing and null replies count as
answers without JSON.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import commit, committed, written
from . import contracts as C

ATTEMPTS = 4
#: A longer digest is no digest.
LONGEST_DIGEST = 4_000
KEY = ["session_key", "window_index", "turn_index"]
TURNS = "session_key string, window_index long, turn_index long, from_line long, to_line long, slice_hash string, prompt string, quote_ids array<string>, thinking_ids array<string>, checks_failed long, exit_code long, floor string, last_window boolean"
RECORDS = "session_key string, window_index long, turn_index long, from_line long, to_line long, slice_hash string, result string, asked int, retries int, fresh boolean, fallback boolean, disputed boolean"
DIGESTS = "session_key string, window_index long, digest string, floor boolean"

Model = Callable[[DataFrame], DataFrame]


def _shuffled(df: DataFrame) -> DataFrame:
    """One side of a join that Spark must not broadcast: each wave would send its tables through the driver again."""
    return df.hint("merge")


def _message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _next_prompt(attempt: int) -> Column:
    """What a turn is asked at an attempt after the first."""
    turn = F.format_string("turn %d", "turn_index")
    least = F.concat(F.lit("Answer with the smallest right JSON object for "), turn, F.format_string(": anchor (fromLine %d, toLine %d), action, and no thoughts.", "from_line", "to_line"))
    if attempt == 1:
        return F.concat(F.col("wrong"), F.lit("\nAnswer with the corrected JSON object for "), turn, F.lit("."))
    if attempt == 2:
        thinks = F.concat(F.lit("This turn holds thinking ("), F.array_join("thinking_ids", ", "), F.lit("), so thoughts must not be empty: give its main idea with source thinking and its q."))
        return F.when(F.size("thinking_ids") > 0, thinks).otherwise(least)
    return least


def _judged(rows: DataFrame, fresh: bool, last: bool) -> DataFrame:
    """Adds errors and disputed to answered turns; a fresh answer need not cite thinking, and facts are disputed until the last attempt."""
    rows = rows.withColumn("object", T.extract_json_object(F.col("reply"))).withColumn("value", F.try_parse_json("object"))
    value = F.col("value")
    none = F.array(F.lit("no JSON object"))
    errors = F.when(value.isNull(), none).otherwise(C.block_errors(value, F.col("from_line"), F.col("to_line"), F.col("quote_ids")))
    empty = C.list_at(value, "thoughts").isNotNull() & (F.size(C.list_at(value, "thoughts")) == 0)
    if not fresh:
        errors = F.when((F.size(errors) == 0) & empty & (F.size("thinking_ids") > 0), F.array(F.lit("thinking without a thought"))).otherwise(errors)
    claimed = lambda path, own: C.whole_at(value, path).isNotNull() & F.col(own).isNotNull() & (C.whole_at(value, path) != F.col(own))
    off = (F.size("errors") == 0) & (claimed("factsClaimed.checks.failed", "checks_failed") | claimed("factsClaimed.exitCode", "exit_code"))
    again = F.array(F.lit("factsClaimed contradicts the results of this turn"))
    told = rows.withColumn("errors", errors).withColumn("disputed", F.coalesce(off, F.lit(False)))
    return (told if fresh or last else told.withColumn("errors", F.when(F.col("disputed"), again).otherwise(F.col("errors")))).drop("value")


def _asked(open_: DataFrame, model: Model, attempt: int) -> DataFrame:
    """Open turns with the reply to their messages."""
    prompts = open_.select(*KEY, F.lit(attempt).alias("attempt"), "from_line", "to_line", "quote_ids", "messages")
    return open_.join(_shuffled(model(prompts).select(*KEY, "reply")), KEY, "left")


def wave_records(turns: DataFrame, carried: DataFrame, model: Model) -> DataFrame:
    """RECORDS of all of ``turns`` (TURNS); ``carried`` (session_key, digest) is what earlier windows hand on."""
    spark = turns.sparkSession
    before = F.when(F.col("digest").isNotNull(), F.array(_message("user", F.concat(F.lit("State of the work so far, for continuity only:\n"), "digest")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    open_ = turns.join(_shuffled(carried), "session_key", "left").withColumns({"messages": F.concat(before, F.array(_message("user", F.col("prompt")))), "wrong": F.lit(None).cast("string")})
    done = []
    for attempt in range(ATTEMPTS + 1):
        fresh = attempt == ATTEMPTS
        if fresh:
            open_ = open_.withColumn("messages", F.array(_message("user", F.col("prompt"))))
        answered = written(_judged(_asked(open_, model, attempt), fresh, attempt == ATTEMPTS - 1))
        right = answered.where(F.size("errors") == 0)
        done.append(right.select(*KEY, "from_line", "to_line", "slice_hash", F.col("object").alias("result"), F.lit(attempt + 1).alias("asked"), F.lit(attempt).alias("retries"), F.lit(fresh).alias("fresh"), F.lit(False).alias("fallback"), "disputed"))
        open_ = answered.where(F.size("errors") > 0)
        if open_.isEmpty():
            break
        if attempt + 1 < ATTEMPTS:
            told = F.concat(F.lit("The answer was rejected:\n- "), F.array_join("errors", "\n- "))
            open_ = open_.withColumn("wrong", told)
            open_ = open_.withColumn("messages", F.concat("messages", F.array(_message("assistant", F.coalesce("reply", F.lit(""))), _message("user", _next_prompt(attempt + 1)))))
        open_ = open_.drop("reply", "object", "errors", "disputed")
    else:
        block = F.to_json(F.struct(F.struct(F.col("from_line").alias("fromLine"), F.col("to_line").alias("toLine")).alias("anchor"), F.col("floor").alias("action"), F.array().cast("array<string>").alias("thoughts"), F.lit(True).alias("fallback")))
        done.append(open_.select(*KEY, "from_line", "to_line", "slice_hash", block.alias("result"), F.lit(ATTEMPTS + 1).alias("asked"), F.lit(ATTEMPTS).alias("retries"), F.lit(False).alias("fresh"), F.lit(True).alias("fallback"), F.lit(False).alias("disputed")))
    out = spark.createDataFrame([], RECORDS)
    for part in done:
        out = out.unionByName(part)
    return out


def floor_digest() -> Column:
    """The digest of a window that the model gave none for."""
    empty = F.struct(*(F.lit("").alias(c) for c in C.CHECKPOINT))
    return F.to_json(F.struct(F.format_string("(no digest of window %d)", "window_index").alias("goal"), F.array().cast("array<string>").alias("openHypotheses"), F.lit("(unknown)").alias("currentBelief"), empty.alias("checkpoint")))


def wave_digests(windows: DataFrame, records: DataFrame, carried: DataFrame, model: Model) -> DataFrame:
    """DIGESTS of ``windows`` (session_key, window_index) from the records of their turns."""
    said = F.format_string("b%d: %s", "turn_index", F.coalesce(F.get_json_object("result", "$.action"), F.lit("")))
    held = records.withColumn("said", said).groupBy("session_key", "window_index").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn_index", "said"))), lambda x: x["said"]), "\n").alias("all"))
    rows = windows.join(_shuffled(held), ["session_key", "window_index"], "left").join(_shuffled(carried), "session_key", "left")
    ask = F.concat(F.coalesce(F.concat(F.lit("State before this window:\n"), "digest", F.lit("\n")), F.lit("")), F.lit("Turns of this window:\n"), F.coalesce("all", F.lit("")), F.lit("\nAnswer with one JSON object that carries the state into the next window."))
    none = lambda t: F.lit(None).cast(t)
    prompts = rows.select("session_key", "window_index", F.lit(0).cast("long").alias("turn_index"), F.lit(0).alias("attempt"), none("long").alias("from_line"), none("long").alias("to_line"), none("array<string>").alias("quote_ids"), F.array(_message("user", ask)).alias("messages"))
    found = windows.join(_shuffled(model(prompts).select("session_key", "window_index", "reply")), ["session_key", "window_index"], "left")
    found = found.withColumn("object", T.extract_json_object(F.col("reply"))).withColumn("value", F.try_parse_json("object"))
    body, value = F.col("object"), F.col("value")
    right = F.coalesce(value.isNotNull() & (F.size(C.digest_errors(value)) == 0) & (T.text_units(F.col("reply")) <= LONGEST_DIGEST), F.lit(False))
    return found.select("session_key", "window_index", F.when(right, body).otherwise(floor_digest()).alias("digest"), (~right).alias("floor"))


def records_of(spark: SparkSession, path: str) -> DataFrame:
    return committed(spark, f"{path}/records", RECORDS)


def digests_of(spark: SparkSession, path: str) -> DataFrame:
    return committed(spark, f"{path}/digests", DIGESTS)


def next_windows(turns: DataFrame, records: DataFrame, digests: DataFrame) -> DataFrame:
    """(session_key, window_index, open_turns, last_window) of each session's first window that lacks a record or its digest."""
    slice_ = ["session_key", "from_line", "to_line", "slice_hash"]
    hit = records.select(*slice_).distinct().withColumn("hit", F.lit(True))
    told = digests.select("session_key", "window_index").distinct().withColumn("told", F.lit(True))
    rows = turns.join(_shuffled(hit), slice_, "left").groupBy("session_key", "window_index").agg(F.count_if(F.col("hit").isNull()).alias("open_turns"), F.bool_or("last_window").alias("last_window"))
    rows = rows.join(_shuffled(told), ["session_key", "window_index"], "left").where((F.col("open_turns") > 0) | (F.col("told").isNull() & ~F.col("last_window")))
    return rows.groupBy("session_key").agg(*(F.min_by(c, "window_index").alias(c) for c in ("open_turns", "last_window")), F.min("window_index").alias("window_index"))


def compress(turns: DataFrame, model: Model, path: str, waves: int | None = None) -> int:
    """Compresses all of ``turns`` (TURNS) into records and digests below ``path``; returns how many waves it took. ``waves`` stops earlier."""
    spark, n = turns.sparkSession, 0
    slice_ = ["session_key", "from_line", "to_line", "slice_hash"]
    while waves is None or n < waves:
        records, digests = records_of(spark, path), digests_of(spark, path)
        now = written(next_windows(turns, records, digests))
        if now.isEmpty():
            break
        n += 1
        before = F.col("d.window_index") == F.col("n.window_index") - 1
        carried = written(now.alias("n").join(_shuffled(digests.alias("d")), (F.col("d.session_key") == F.col("n.session_key")) & before).select("n.session_key", "d.digest").dropDuplicates(["session_key"]))
        own = turns.join(_shuffled(now.select("session_key", "window_index")), ["session_key", "window_index"], "left_semi")
        left = own.join(_shuffled(records.select(*slice_)), slice_, "left_anti")
        commit([(wave_records(left, carried, model), f"{path}/records")])
        records = records_of(spark, path)
        ask = now.where("not last_window").select("session_key", "window_index")
        if not ask.isEmpty():
            commit([(wave_digests(ask, records.join(_shuffled(own.select(*slice_)), slice_, "left_semi"), carried, model), f"{path}/digests")])
    return n


def counts(records: DataFrame) -> DataFrame:
    """(session_key, blocks, asked, retries, fresh, fallbacks, disputes) of each session."""
    return records.groupBy("session_key").agg(F.count("*").alias("blocks"), F.sum("asked").alias("asked"), F.sum("retries").alias("retries"), F.count_if("fresh").alias("fresh"), F.count_if("fallback").alias("fallbacks"), F.count_if("disputed").alias("disputes"))
