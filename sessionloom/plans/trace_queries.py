"""Queries over chains as wholes: three users' sessions, one after the other, are a chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import contracts as C
from ..operators import facts as A
from ..operators import refined as N
from ..operators import traces as X
from ..sources.tables import conversation_entries
from ..storage import written
from .session_queries import _CHECKS, _E, _OPS, _events
from .session_queries import ORACLES as SESSION_SQL

QUERIES, ORACLES = {}, {}

_CHAINED = "chained AS (SELECT DISTINCT 'p' AS project, user_id // 3 AS chain, user_id::VARCHAR AS session_key, user_id % 3 + 1 AS session_index FROM events)"


def _chained(spark, d) -> DataFrame:
    users = spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct()
    return users.select(F.lit("p").alias("project"), F.floor(F.col("user_id") / 3).alias("chain"), F.col("user_id").cast("string").alias("session_key"), (F.col("user_id") % 3 + 1).alias("session_index"))


def _register(sql):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@_register(f"""WITH {_CHAINED}, b AS ({SESSION_SQL['blocks']})
SELECT project, chain, session_index, session_key, block_index, row_number() OVER (PARTITION BY chain ORDER BY session_index, block_index) AS number, label, line_from, line_to FROM b JOIN chained USING (session_key)""")
def chain_blocks(spark, d):
    """Blocks, numbered through over their chain."""
    made = X.chain_blocks(written(B.blocks(_events(spark, d))), _chained(spark, d), "project")
    return made.select("project", "chain", "session_index", "session_key", "block_index", "number", "label", "line_from", "line_to")


_PLACES = lambda op: f"coalesce(array_to_string((list('s' || session_index || '@L' || line ORDER BY session_index, seq) FILTER (op = '{op}'))[1:4], ','), '')"


@_register(f"""{_OPS}, {_CHAINED} SELECT project, chain, path, count(*) FILTER (op = 'read') AS reads, {_PLACES('read')} AS read_refs, bool_or(op = 'modify') AS modified, coalesce(sum(added), 0)::BIGINT AS added, coalesce(sum(removed), 0)::BIGINT AS removed,
 {_PLACES('modify')} AS modify_refs FROM ops JOIN chained USING (session_key) GROUP BY project, chain, path""")
def chain_ledger(spark, d):
    """Files over a chain."""
    return X.chain_ledger(_events(spark, d), _chained(spark, d), "project")


@_register(f"{_E}, {_CHAINED} SELECT project, chain, tool_name, count(*) AS n FROM entries JOIN chained USING (session_key) WHERE kind = 'tool_call' AND NOT sidechain GROUP BY ALL")
def chain_tools(spark, d):
    return X.chain_tools(_events(spark, d), _chained(spark, d), "project")


@_register(f"""{_E}, {_CHECKS}, {_CHAINED}, sums AS (SELECT session_key, bool_or(kind = 'tool_result' AND interrupted) AS cut, count(*) FILTER (kind = 'tool_result' AND is_error) AS errors, count(*) FILTER (kind = 'tool_call') AS calls, arg_max(is_error, seq) FILTER (kind = 'tool_result') AS last_error FROM entries WHERE NOT sidechain GROUP BY ALL),
s AS (SELECT project, chain, count(*) AS sessions, coalesce(bool_or(cut), false) AS cut, coalesce(sum(errors), 0)::BIGINT AS errors, coalesce(sum(calls), 0)::BIGINT AS calls, coalesce(arg_max(last_error, session_index) FILTER (last_error IS NOT NULL), false) AS last_error,
 coalesce(arg_max(run, session_index) FILTER (run IS NOT NULL), 0) AS run, coalesce(arg_max(failed, session_index) FILTER (run IS NOT NULL), 0) AS failed, coalesce(bool_or(ever_failed), false) AS ever_failed FROM chained LEFT JOIN sums USING (session_key) LEFT JOIN checks USING (session_key) GROUP BY project, chain)
SELECT project, chain, sessions, errors, calls, run, failed, last_error, CASE WHEN cut THEN 'partial' WHEN run > 0 AND failed > 0 OR last_error THEN 'failure' WHEN ever_failed OR errors > 0 THEN 'partial' WHEN calls = 0 THEN 'unknown' WHEN run > 0 THEN 'success' ELSE 'unknown' END AS status,
 CASE WHEN cut THEN 'interrupted tool calls' WHEN run > 0 AND failed > 0 THEN 'last checks run: ' || failed || ' failed out of ' || run WHEN last_error THEN 'the last tool call ended with an error' WHEN ever_failed THEN 'checks failed earlier and are green now'
   WHEN errors > 0 THEN 'tool errors: ' || errors WHEN calls = 0 THEN 'no tool calls' WHEN run > 0 THEN 'checks ran (' || run || ') and are green' ELSE 'no tool errors; no checks' END AS why FROM s""")
def chain_verdicts(spark, d):
    """The outcome of each chain, from its last checks and last result."""
    return X.chain_verdicts(_events(spark, d), _chained(spark, d), "project")


_HEADS = """h AS (SELECT conv_id::VARCHAR AS session_key, conv_id AS c, count(*) AS n, sum(length(text))::BIGINT AS size, max(turn) AS last FROM conversations GROUP BY conv_id)"""


@_register(f"""WITH {_HEADS}, f AS (SELECT *, strftime(TIMESTAMP '2024-05-01 10:00:00' + to_seconds(last * 60), '%Y-%m-%dT%H:%M:%S.000Z') AS ended, CASE WHEN c % 3 = 0 THEN 'not analysed' WHEN c % 3 = 1 THEN 'success' ELSE 'partial' END AS status FROM h),
m AS (SELECT session_key, status, size, concat('---', chr(10), 'session: s-', c, chr(10), 'source: claude', chr(10), 'log: /logs/', c, '.jsonl', chr(10), 'status: ', status, chr(10), '---', chr(10), '# ', CASE WHEN c % 2 = 0 THEN 'title ' || c ELSE 's-' || c END, chr(10), chr(10), '> `@L<n>` is line n of the log.', chr(10), chr(10),
 '## Compressed session', chr(10), chr(10), 'form of ', c, chr(10), chr(10), CASE WHEN c % 3 > 0 THEN concat('## Reasoning', chr(10), chr(10), '- **H** [open] an idea @L', last + 1, chr(10), '- **PIVOT** [confirmed] another @L1→L', last + 1, chr(10), chr(10)) ELSE '' END,
 '## Verdict', chr(10), chr(10), CASE WHEN c % 3 > 0 THEN '**' || status || '**: because (model)' ELSE 'No analysis; see the accounting below.' END, chr(10), chr(10), '## Accounting', chr(10), chr(10), '- session: `', left('s-' || c, 8), '` (claude)', chr(10),
 '- window: 2024-05-01T10:00:00.000Z → ', ended, ' (wall ', CASE WHEN last = 0 THEN '0s' ELSE last || 'm' END, ')', chr(10), '- calls: 0 (ok 0, err 0; success rate 100.0 %)', CASE WHEN n > 0 THEN concat(chr(10), '- model: `m-1` · requests ', n, ' · in ', size, ' (cache read ', size // 4, ', write 0) · out 7',
  CASE WHEN size // 4 > 0.1 * (size + size // 4) THEN concat(chr(10), '- cache: ', round((size // 4) * 100 / (size + size // 4)::DOUBLE, 0)::BIGINT, ' % of input tokens') ELSE '' END) END,
 chr(10), chr(10), '## Passes', chr(10), chr(10), 'turns ', n, ' · compressed ', n - 1, ' · fallback 1 · retries 2 · disputes 0', chr(10), chr(10)) AS markdown FROM f)
SELECT session_key, status, ceil(length(markdown) / 4.0)::BIGINT AS trace_tokens, markdown FROM m""")
def refined_traces(spark, d):
    """Traces of conversations, two of three analysed, with every section."""
    entries = conversation_entries(spark.read.parquet(f"{d}/conversations.parquet"))
    c, last = F.col("conv_id"), F.col("last")
    heads = spark.read.parquet(f"{d}/conversations.parquet").groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"), F.max("turn").alias("last")).withColumn("session_key", c.cast("string"))
    at = lambda seconds: F.date_format(F.timestamp_seconds(F.lit(1_714_557_600) + seconds), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    sessions = heads.select(
        "session_key", F.concat(F.lit("s-"), c).alias("session_id"), F.lit("claude").alias("source"), F.format_string("/logs/%d.jsonl", c).alias("log_file"), F.when(c % 2 == 0, F.format_string("title %d", c)).alias("title"), at(F.lit(0)).alias("started_at"), at(last * 60).alias("ended_at"),
        F.lit("m-1").alias("model"), F.col("size").alias("log_bytes"), F.col("n").alias("requests"), F.col("size").alias("input"), F.lit(7).cast("bigint").alias("output"), F.floor(F.col("size") / 4).alias("cache_read"), F.lit(0).cast("bigint").alias("cache_write"),
    )
    text = '{"arcs":[{"kind":"H","text":"an idea","status":"open","fromLine":%d},{"kind":"PIVOT","text":"another","status":"confirmed","fromLine":1,"toLine":%d}],"verdict":{"status":"%s","why":"because"},"items":[]}'
    body = F.format_string(text, last + 1, last + 1, F.when(c % 3 == 1, "success").otherwise("partial"))
    analyses = heads.where(c % 3 > 0).select("session_key", C.as_analysis(body).alias("analysis"))
    forms = heads.select("session_key", F.format_string("form of %d", c).alias("form"))
    counts = heads.select("session_key", F.col("n").alias("turns"), (F.col("n") - 1).alias("blocks"), F.lit(1).alias("fallbacks"), F.lit(2).alias("retries"), F.lit(0).alias("disputes"))
    return N.refined(sessions, forms, analyses, A.account_sessions(entries), counts).drop("ratio")
