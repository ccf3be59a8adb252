"""Traces over chains: one numbering, one ledger and one verdict for sessions that continue one another.

``chained`` has (group, chain, session_key, session_index). Numbers of a session's own rows become numbers of the chain by adding what the
sessions before it hold, so rows of a chain never meet in one task; sums combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from . import facts as A


def offsets(rows: DataFrame, chained: DataFrame, group: str) -> DataFrame:
    """(group, chain, session_key, session_index, before): how many of ``rows`` (session_key, ...) the sessions before hold."""
    own = rows.groupBy("session_key").agg(F.count("*").alias("held"))
    line = Window.partitionBy(group, "chain").orderBy("session_index")
    counted = chained.select(group, "chain", "session_key", "session_index").join(own, "session_key", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    return counted.withColumn("before", F.sum("held").over(line) - F.col("held")).drop("held")


def chain_blocks(blocks: DataFrame, chained: DataFrame, group: str) -> DataFrame:
    """``blocks`` (session_key, block_index from 1, ...) with group, chain, session_index and number, from 1 over the chain."""
    return blocks.join(offsets(blocks, chained, group), "session_key").withColumn("number", (F.col("before") + F.col("block_index")).cast("bigint")).drop("before")


def place(line: str = "line") -> Column:
    """A line of a chain's session."""
    return F.concat(F.lit("s"), F.col("session_index").cast("string"), F.lit("@L"), F.col(line).cast("string"))


def chain_ledger(entries: DataFrame, chained: DataFrame, group: str, parity: bool = False) -> DataFrame:
    """(group, chain, path, reads, read_refs, modified, added, removed, modify_refs): files over the chain, each with the first places of either kind."""
    ops = B.file_ops(entries, parity).join(chained.select(group, "chain", "session_key", "session_index"), "session_key")
    return B.ledger_of(ops, [group, "chain", "path"], ["session_index", "seq"], place())


def chain_tools(entries: DataFrame, chained: DataFrame, group: str) -> DataFrame:
    """(group, chain, tool_name, n)."""
    return A.tools_by_tool(entries).join(chained.select(group, "chain", "session_key"), "session_key").groupBy(group, "chain", "tool_name").agg(F.sum("n").alias("n"))


def chain_verdicts(entries: DataFrame, chained: DataFrame, group: str) -> DataFrame:
    """(group, chain, sessions, errors, calls, run, failed, last_error, status, why): the last checks and the last result of the chain decide, whichever session has them."""
    rows = chained.select(group, "chain", "session_key", "session_index").join(A.outcome_signs(entries), "session_key", "left")
    last = lambda c, known: F.max_by(c, F.when(F.col(known).isNotNull(), F.col("session_index"))).alias(c)
    signs = rows.groupBy(group, "chain").agg(
        F.count("*").alias("sessions"), F.coalesce(F.bool_or("cut"), F.lit(False)).alias("cut"), *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("errors", "calls")), last("last_error", "last_error"), last("run", "run"), last("failed", "run"),
        F.bool_or("ever_failed").alias("ever_failed"),
    )
    return A.with_verdict(signs).select(group, "chain", "sessions", "errors", "calls", "run", "failed", "last_error", "status", "why")
