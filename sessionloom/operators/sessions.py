"""Session-level projections and joins: headers, roles, notes, workspaces, prompts, usage, finalising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Notes worth showing (fixed values).
NOTEWORTHY = ("away_summary", "compaction_summary", "compact_boundary", "pr-link")


def noteworthy(entries: DataFrame, cap: int = 240) -> DataFrame:
    rows = entries.where((F.col("kind") == "system_note") & F.col("subtype").isin(*NOTEWORTHY) & ~F.col("sidechain"))
    return rows.select("session_key", "log_line", "subtype", T.cap_line(F.col("text"), cap).alias("text"))


def by_role(sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Main sessions and sub-agents."""
    return sessions.where("role = 'main'"), sessions.where("role = 'subagent'")


def log_edges(lines: DataFrame, head: int, tail: int) -> DataFrame:
    """(log_file, head, tail): the first and last characters of each log, from as many lines as these can take."""
    size = F.length("raw") + 1
    up, down = Window.partitionBy("log_file").orderBy("log_line"), Window.partitionBy("log_file").orderBy(F.desc("log_line"))
    rows = lines.withColumn("_before", F.sum(size).over(up) - size).withColumn("_behind", F.sum(size).over(down) - size)
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, F.struct("log_line", "raw")))), lambda x: x["raw"]), "\n")
    edges = rows.where((F.col("_before") <= head) | (F.col("_behind") <= tail)).groupBy("log_file").agg(joined(F.col("_before") <= head).alias("head"), joined(F.col("_behind") <= tail).alias("tail"))
    return edges.select("log_file", F.left("head", F.lit(head)).alias("head"), F.right("tail", F.lit(tail)).alias("tail"))


def sniffed(lines: DataFrame, pattern: str, name: str) -> DataFrame:
    """(log_file, name): the group of the first line that matches, JSON escapes undone."""
    hit = F.nullif(F.regexp_extract("raw", pattern, 1), F.lit(""))
    found = lines.groupBy("log_file").agg(F.min_by(hit, F.when(hit.isNotNull(), F.col("log_line"))).alias(name))
    return found.withColumn(name, F.from_json(F.concat(F.lit('["'), name, F.lit('"]')), "array<string>")[0])


def workspace_by_mode(paths: DataFrame, key: str, path: str) -> DataFrame:
    """(key, workspace): the commonest path of each key; of equally common ones the longest, then the smallest."""
    counts = paths.groupBy(key, path).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(path, F.struct(-F.col("n"), -F.length(path), F.col(path))).alias("workspace"))


def with_meta(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Logs joined with their export's meta file by file stem."""
    stem = lambda c, end: F.regexp_replace(F.substring_index(c, "/", -1), rf"{end}$", "")
    return files.withColumn("stem", stem(F.col("log_file"), r"\.jsonl")).join(meta.withColumn("stem", stem(F.col("meta_file"), r"\.meta\.json")), "stem")


def drop_mirrored(prompts: DataFrame, key: str, order: str) -> DataFrame:
    """Prompts (key, order, mirror BOOL, text) without mirrors that repeat the last real prompt before them."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(~F.col("mirror"), F.col("text")), ignorenulls=True).over(before)
    return prompts.withColumn("_last", last).where(~F.col("mirror") | F.col("_last").isNull() | (F.col("text") != F.col("_last"))).drop("_last")


def usage_totals(usage: DataFrame, key: str) -> DataFrame:
    """Sums of requests, input, output, cache_read and cache_write, and the share of input that came from the cache."""
    names = ("requests", "input", "output", "cache_read", "cache_write")
    sums = usage.groupBy(key).agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names))
    whole = F.col("input") + F.col("cache_read")
    return sums.withColumn("cache_share", F.when(whole > 0, T.rounded(F.col("cache_read") / whole, 3)).otherwise(F.lit(0.0)))


def histogram(rows: DataFrame, key: str, *names: str) -> DataFrame:
    """(key, what, value, n) of each named column, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.col(n).cast("string").alias("value")) for n in names))).alias("p")
    return rows.select(key, pairs).select(key, "p.*").where("value is not null").groupBy(key, "what", "value").agg(F.count("*").alias("n"))


def compression(sessions: DataFrame, traces: DataFrame) -> DataFrame:
    """(chain, duration_ms, log_tokens, trace_tokens, ratio) of sessions (chain, started_at, ended_at, log_bytes) and traces (chain, trace_tokens)."""
    s = sessions.groupBy("chain").agg(F.min("started_at").alias("a"), F.max("ended_at").alias("b"), F.sum("log_bytes").alias("bytes"))
    out = s.join(traces, "chain")
    took = F.greatest(F.lit(0), F.floor((F.unix_micros("b") - F.unix_micros("a")) / F.lit(1000))).cast("bigint")
    return out.select("chain", took.alias("duration_ms"), F.ceil(F.col("bytes") / F.lit(4.0)).cast("bigint").alias("log_tokens"), "trace_tokens", T.compression_ratio(F.col("bytes"), F.col("trace_tokens")).alias("ratio"))


def finalised(registry: DataFrame, skeletons: DataFrame, results: DataFrame) -> DataFrame:
    """(session_key, state): rendered where a skeleton and an analysis are there, else what is missing. Running it again changes nothing."""
    s = skeletons.select("session_key").distinct().withColumn("_s", F.lit(True))
    r = results.select("session_key").distinct().withColumn("_r", F.lit(True))
    state = F.when(F.col("_s").isNull(), "no skeleton").when(F.col("_r").isNull(), "no analysis").otherwise("rendered")
    return registry.select("session_key").join(s, "session_key", "left").join(r, "session_key", "left").select("session_key", state.alias("state"))


def auto_done(covered: DataFrame, now: Column) -> DataFrame:
    """Ledger events that mark fully covered windows (session_key, window_index, covered) as done after a new segmentation."""
    job = F.format_string("p1-%s-w%d", "session_key", "window_index")
    return covered.where("covered").select(job.alias("job_id"), F.lit("submit-ok").alias("ev"), now.alias("ts"))


def pseudo_session(registry: DataFrame, skeletons: DataFrame) -> DataFrame:
    """Headers for rendering: the skeleton's fields, else the export's, else the epoch."""
    s = skeletons.select("session_key", F.col("cwd").alias("s_cwd"), F.col("started_at").alias("s_started"))
    rows = registry.join(s, "session_key", "left")
    return rows.select("session_key", F.coalesce("s_cwd", "workspace", F.lit("")).alias("cwd"), F.coalesce("s_started", "created_at", F.lit("1970-01-01T00:00:00.000Z")).alias("started_at"))


def read_log(lines: DataFrame, allowed: DataFrame, log_file: str, first: int, count: int, most: int = 16_384) -> DataFrame:
    """Lines of one allowed log, up to 40 from ``first`` and ``most`` characters in all, for an analyser that looks something up."""
    rows = lines.where((F.col("log_file") == log_file) & F.col("log_line").between(first, first + max(1, min(count, 40)) - 1)).join(allowed.select("log_file"), "log_file", "left_semi")
    before = F.sum(F.length("raw")).over(Window.partitionBy("log_file").orderBy("log_line")) - F.length("raw")
    return rows.withColumn("_b", before).where(F.col("_b") < most).select("log_line", F.substr("raw", F.lit(1), (F.lit(most) - F.col("_b")).cast("int")).alias("raw"))


#: Lines, characters and calls that an analyser may take of logs.
READ_LINES, READ_CHARS, READ_CALLS = 40, 16_384, 12


def read_requests(lines: DataFrame, requests: DataFrame, most_lines: int = READ_LINES, most_chars: int = READ_CHARS, most_calls: int = READ_CALLS) -> DataFrame:
    """(job, call, log_line, raw) for requests (job, call, log_file, first, count) of many jobs: up to ``most_lines`` lines from first and ``most_chars``
    characters a call, and the first ``most_calls`` calls of a job.

    An interval join: lines and requests meet on (log, block of ``most_lines`` lines), of which a request touches two at most.
    """
    turn = Window.partitionBy("job").orderBy("call")
    asked = requests.withColumn("_n", F.row_number().over(turn)).where(F.col("_n") <= most_calls)
    last = F.col("first") + F.greatest(F.lit(1), F.least(F.col("count"), F.lit(most_lines))) - 1
    asked = asked.select("job", "call", "log_file", "first", last.alias("last")).withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / most_lines), F.floor(F.col("last") / most_lines))))
    rows = lines.withColumn("block", F.floor(F.col("log_line") / most_lines)).join(asked, ["log_file", "block"]).where(F.col("log_line").between(F.col("first"), F.col("last")))
    before = F.sum(F.length("raw")).over(Window.partitionBy("job", "call").orderBy("log_line")) - F.length("raw")
    return rows.withColumn("_b", before).where(F.col("_b") < most_chars).select("job", "call", "log_line", F.substr("raw", F.lit(1), (F.lit(most_chars) - F.col("_b")).cast("int")).alias("raw"))
