"""Sessions that continue one another, and traces over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written

TIGHT_MS, LOOSE_MS = 300_000, 2_700_000


def _slices(sessions: DataFrame, within: str, ranges: int | None) -> DataFrame:
    """Sessions dealt to ranges of (project, start, key), with the range's number: also one project's sessions lie in many ranges."""
    order = [within, "started_at", "session_key"]
    dealt = sessions.repartitionByRange(ranges, *order) if ranges else sessions.repartitionByRange(*order)
    return written(dealt.withColumn("slice", F.spark_partition_id()))


def linked_sessions(sessions: DataFrame, tight_ms: int = TIGHT_MS, loose_ms: int = LOOSE_MS, within: str = "project", ranges: int | None = None) -> DataFrame:
    """Adds reason: how a session continues the one before it, or null; and slice, the range of sessions that the row lies in.

    sessions: session_key, source, started_at and ended_at (timestamps), paths array<string>, leaf_uuid, logical_parent_uuid, last_uuid (the last
    three may be null). A pointer of either kind to the last entry of the session before decides first, then, in one source, the gap: tight, or
    loose with a common file. Overlapping sessions never chain by time. ``within`` is the column of the project: all its
    sessions, of whatever source, are one line by start, and a session's predecessor is always the one just before. The line is
    cut into ranges (``ranges`` of them, else as many as Spark shuffles into); the last session of each range is handed to the next one, so no task holds a whole project.
    """
    line = Window.partitionBy("slice").orderBy(within, "started_at", "session_key")
    tail = F.struct(F.col(within).alias("of"), "last_uuid", "source", "ended_at", "paths")
    rows = _slices(sessions, within, ranges)
    # One row for each range that holds sessions, so this window is small.
    handed = rows.groupBy("slice").agg(F.max_by(tail, F.struct(within, "started_at", "session_key")).alias("tail"))
    handed = handed.select("slice", F.lag("tail").over(Window.orderBy("slice")).alias("handed"), F.lit(1).alias("place"))
    placed = rows.withColumns({"place": F.row_number().over(line), "own": F.lag(tail).over(line)}).join(F.broadcast(handed), ["slice", "place"], "left")
    placed = placed.withColumn("b", F.coalesce("own", "handed"))
    before = lambda c: F.when(F.col("b.of").eqNullSafe(F.col(within)), F.col(f"b.{c}"))
    gap = (F.unix_micros(F.col("started_at")) - F.unix_micros(before("ended_at"))) / F.lit(1000)
    reason = (
        F.when((F.col("leaf_uuid") == before("last_uuid")) | (F.col("logical_parent_uuid") == before("last_uuid")), "leaf-uuid").when((F.col("source") != before("source")) | (gap < 0), None)
        .when(gap <= tight_ms, "time-gap").when((gap <= loose_ms) & F.arrays_overlap("paths", before("paths")), "time-gap-overlap")
    )
    return placed.withColumn("reason", reason).drop("place", "own", "handed", "b")


def chains(sessions: DataFrame, tight_ms: int = TIGHT_MS, loose_ms: int = LOOSE_MS, within: str = "project", ranges: int | None = None) -> DataFrame:
    """(within, chain, session_key, session_index, reason): chains numbered in their project, sessions in their chain.

    Numbers are counted inside each range of a project; what earlier ranges hold of it (sessions, chains, where the last chain began) is added
    from a table with a row for each range and project.
    """
    marked = linked_sessions(sessions, tight_ms, loose_ms, within, ranges).select(F.col(within).alias("of"), "slice", "started_at", "session_key", "reason")
    marked = written(marked)
    line = Window.partitionBy("slice", "of").orderBy("started_at", "session_key")
    opens = F.col("reason").isNull()
    local = marked.withColumn("n", F.row_number().over(line)).withColumns({"opened": F.sum(F.when(opens, 1).otherwise(0)).over(line), "began": F.max(F.when(opens, F.col("n"))).over(line)})
    sums = local.groupBy("slice", "of").agg(F.max("n").alias("held"), F.max("opened").alias("chains"), F.max("began").alias("last_began"))
    earlier = Window.partitionBy("of").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("n_before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    sums = sums.withColumns({"chains_before": F.coalesce(F.sum("chains").over(earlier), F.lit(0)), "began_before": F.max(F.col("n_before") + F.col("last_began")).over(earlier)})
    sums = sums.select(F.col("slice").alias("s"), F.col("of").alias("o"), "n_before", "chains_before", "began_before")
    whole = local.join(sums, (F.col("slice") == F.col("s")) & F.col("of").eqNullSafe(F.col("o")))
    index = F.col("n_before") + F.col("n") - F.coalesce(F.col("n_before") + F.col("began"), F.col("began_before")) + 1
    return whole.select(F.col("of").alias(within), (F.col("chains_before") + F.col("opened")).alias("chain"), "session_key", index.cast("bigint").alias("session_index"), "reason")


def chain_reasons(chained: DataFrame, group: str) -> DataFrame:
    """(group, chain, sessions, reasons): distinct reasons in the order of their first use."""
    first = chained.where("reason is not null").groupBy(group, "chain", "reason").agg(F.min("session_index").alias("at"))
    listed = first.groupBy(group, "chain").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "reason"))), lambda x: x["reason"]), ",").alias("reasons"))
    sizes = chained.groupBy(group, "chain").agg(F.count("*").alias("sessions"))
    return sizes.join(listed, [group, "chain"], "left").withColumn("reasons", F.coalesce("reasons", F.lit("")))


def subagents(subs: DataFrame, chained: DataFrame, group: str) -> DataFrame:
    """Sub-agent sessions (session_key, parent_key) with the chain of their parent."""
    return subs.join(chained.select(group, "chain", F.col("session_key").alias("parent_key"), F.col("session_index").alias("parent_index")), "parent_key")


def chain_stats(chained: DataFrame, stats: DataFrame, group: str) -> DataFrame:
    """(group, chain, sessions, ...): the sums of all number columns of ``stats(session_key, ...)`` over each chain."""
    numbers = [c for c, kind in stats.dtypes if kind in ("int", "bigint", "double")]
    rows = chained.select(group, "chain", "session_key").join(stats.select("session_key", *numbers), "session_key")
    return rows.groupBy(group, "chain").agg(F.count("*").alias("sessions"), *(F.sum(c).alias(c) for c in numbers))


def session_lines(chained: DataFrame, group: str) -> DataFrame:
    """(group, chain, session_key, session_index, before_key, line): each session of a chain as a line of the chain's list."""
    line = Window.partitionBy(group, "chain").orderBy("session_index")
    text = F.concat(F.format_string("- s%d · ", "session_index"), "session_key", F.when(F.col("reason").isNull(), "").otherwise(F.concat(F.lit(" · "), "reason")))
    return chained.select(group, "chain", "session_key", "session_index", F.lag("session_key").over(line).alias("before_key"), text.alias("line"))
