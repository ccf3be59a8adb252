"""Queries over session headers, notes, logs as lines, usage and finalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sessions as S

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _talks(spark, d):
    return spark.read.parquet(f"{d}/conversations.parquet")


def _lines(spark, d):
    """Conversations as logs: a turn is a line."""
    return _talks(spark, d).select(F.col("conv_id").cast("string").alias("log_file"), (F.col("turn") + 1).alias("log_line"), F.col("text").alias("raw"))


@query(r"SELECT conv_id::VARCHAR AS session_key, turn + 1 AS log_line, 'pr-link' AS subtype, CASE WHEN length(t) <= 40 THEN t ELSE left(t, 39) || '…' END AS text FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations) WHERE role = 'system'")
def noteworthy(spark, d):
    from ..sources.tables import conversation_entries

    return S.noteworthy(conversation_entries(_talks(spark, d)), 40)


@query("SELECT conv_id::VARCHAR AS log_file, left(string_agg(text, chr(10) ORDER BY turn), 100) AS head, right(string_agg(text, chr(10) ORDER BY turn), 80) AS tail FROM conversations GROUP BY conv_id")
def log_edges(spark, d):
    return S.log_edges(_lines(spark, d), 100, 80)


@query(r"""WITH h AS (SELECT conv_id, turn, regexp_extract(text, '(\w{9,})', 1) AS hit FROM conversations) SELECT conv_id::VARCHAR AS log_file, arg_min(hit, turn) FILTER (hit <> '') AS word FROM h GROUP BY conv_id""")
def sniffed(spark, d):
    return S.sniffed(_lines(spark, d), r"(\w{9,})", "word")


ORACLES["sniffed"] = ORACLES["sniffed"].replace(r"\w", "[A-Za-z0-9_]")


@query("WITH c AS (SELECT user_id, (props::JSON->>'$.k')::BIGINT % 9 AS k, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT user_id, '/w/' || repeat('x', (k % 3)::INT) || k AS path, n FROM c) SELECT user_id, arg_min(path, {'a': -n, 'b': -length(path), 'c': path}) AS workspace FROM p GROUP BY user_id")
def workspace_by_mode(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint") % 9
    rows = spark.read.parquet(f"{d}/events.parquet").select("user_id", F.concat(F.lit("/w/"), F.repeat(F.lit("x"), (k % 3).cast("int")), k.cast("string")).alias("path"))
    return S.workspace_by_mode(rows, "user_id", "path")


@query("SELECT page_id AS a, page_id AS b, 'p' || page_id AS stem FROM pages WHERE page_id % 3 <> 0")
def meta_pairs(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.col("page_id").cast("string").alias("i"))
    files = p.select(F.col("page_id").alias("a"), F.concat(F.lit("/x/p"), "i", F.lit(".jsonl")).alias("log_file"))
    other = F.when(F.col("page_id") % 3 == 0, "/y/other").otherwise("/y/p")
    meta = p.select(F.col("page_id").alias("b"), F.concat(other, "i", F.lit(".meta.json")).alias("meta_file"))
    return S.with_meta(files, meta).select("a", "b", "stem")


@query("""WITH e AS (SELECT user_id, event_id, event_type = 'click' AS mirror, (props::JSON->>'$.k')::BIGINT % 3 AS v FROM events),
l AS (SELECT *, last_value(CASE WHEN NOT mirror THEN v END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM e)
SELECT user_id, event_id FROM l WHERE NOT mirror OR last IS NULL OR last <> v""")
def drop_mirrored(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").select("user_id", "event_id", (F.col("event_type") == "click").alias("mirror"), (F.get_json_object("props", "$.k").cast("bigint") % 3).cast("string").alias("text"))
    return S.drop_mirrored(rows, "user_id", "event_id").select("user_id", "event_id")


@query("""WITH u AS (SELECT user_id, (props::JSON->>'$.k')::BIGINT AS k FROM events), s AS (SELECT user_id, count(*) AS requests, sum(k)::BIGINT AS input, sum(k * 2)::BIGINT AS output, sum(k % 5)::BIGINT AS cache_read, 0::BIGINT AS cache_write FROM u GROUP BY user_id)
SELECT *, CASE WHEN input + cache_read > 0 THEN floor(cache_read / (input + cache_read) * 1000 + 0.5) / 1000 ELSE 0 END AS cache_share FROM s""")
def usage_totals(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = spark.read.parquet(f"{d}/events.parquet").select("user_id", F.lit(1).alias("requests"), k.alias("input"), (k * 2).alias("output"), (k % 5).alias("cache_read"), F.lit(0).alias("cache_write"))
    return S.usage_totals(rows, "user_id")


@query("SELECT source, 'lang' AS what, lang AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT source, 'half', (doc_id % 2)::VARCHAR, count(*) FROM documents GROUP BY ALL")
def histograms(spark, d):
    return S.histogram(spark.read.parquet(f"{d}/documents.parquet").withColumn("half", F.col("doc_id") % 2), "source", "lang", "half")


@query("""WITH s AS (SELECT user_id AS chain, min(ts) AS a, max(ts) AS b, sum(length(props) * 1000)::BIGINT AS bytes, count(*) AS t FROM events GROUP BY user_id)
SELECT chain, floor((epoch_us(b) - epoch_us(a)) / 1000.0)::BIGINT AS duration_ms, ceil(bytes / 4.0)::BIGINT AS log_tokens, t AS trace_tokens, floor(ceil(bytes / 4.0) / t * 10 + 0.5) / 10 AS ratio FROM s""")
def compression(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    at = F.col("ts").cast("timestamp")
    rows = e.select(F.col("user_id").alias("chain"), at.alias("started_at"), at.alias("ended_at"), (F.length("props") * 1000).alias("log_bytes"))
    return S.compression(rows, e.groupBy(F.col("user_id").alias("chain")).agg(F.count("*").alias("trace_tokens")))


@query("SELECT substr(sha256(page_id::VARCHAR), 1, 16) AS session_key, CASE WHEN page_id % 4 = 0 THEN 'no skeleton' WHEN page_id % 3 = 0 THEN 'no analysis' ELSE 'rendered' END AS state FROM pages")
def finalised(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select("page_id", T.session_key(F.col("page_id").cast("string")).alias("session_key"))
    of = lambda n: p.select(F.when(F.col("page_id") % n == 0, F.concat(F.lit("other-"), "session_key")).otherwise(F.col("session_key")).alias("session_key"))
    return S.finalised(p, of(4), of(3))


@query("SELECT 'p1-' || substr(sha256(page_id::VARCHAR), 1, 16) || '-w' || (page_id % 5) AS job_id, 'submit-ok' AS ev, 'now' AS ts FROM pages WHERE page_id % 2 = 0")
def auto_done(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select(T.session_key(F.col("page_id").cast("string")).alias("session_key"), (F.col("page_id") % 5).alias("window_index"), (F.col("page_id") % 2 == 0).alias("covered"))
    return S.auto_done(p, F.lit("now"))


@query("SELECT page_id::VARCHAR AS session_key, CASE WHEN page_id % 2 = 0 THEN '/s' WHEN page_id % 3 = 0 THEN '/e' ELSE '' END AS cwd, CASE WHEN page_id % 2 = 0 THEN '2024' ELSE '1970-01-01T00:00:00.000Z' END AS started_at FROM pages")
def pseudo_sessions(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").cast("string").alias("session_key"), F.when(F.col("page_id") % 3 == 0, "/e").alias("workspace"), F.lit(None).cast("string").alias("created_at"), "page_id")
    own = F.when(F.col("page_id") % 2 == 0, F.col("session_key")).otherwise(F.concat(F.lit("other-"), "session_key")).alias("session_key")
    return S.pseudo_session(p, p.select(own, F.lit("/s").alias("cwd"), F.lit("2024").alias("started_at")))


@query("SELECT turn + 1 AS log_line, left(text, greatest(0, 500 - b)::INT) AS raw FROM (SELECT *, coalesce(sum(length(text)) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM conversations WHERE conv_id = 1 AND turn + 1 BETWEEN 2 AND 41) WHERE b < 500")
def read_log(spark, d):
    lines = _lines(spark, d)
    return S.read_log(lines, lines.select("log_file").distinct(), "1", 2, 99, 500)


@query("""WITH r AS (SELECT DISTINCT conv_id AS job, k AS call, (conv_id + k) % (SELECT max(conv_id) + 1 FROM conversations) AS conv, 1 + k % 5 AS first, k % 7 AS n FROM conversations, range(1, 15) AS t(k)),
l AS (SELECT job, call, turn + 1 AS log_line, text, coalesce(sum(length(text)) OVER (PARTITION BY job, call ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM r JOIN conversations c ON c.conv_id = r.conv AND c.turn + 1 BETWEEN first AND first + greatest(1, least(n, 4)) - 1 WHERE call <= 12)
SELECT job, call, log_line, left(text, (700 - b)::INT) AS raw FROM l WHERE b < 700""")
def read_logs(spark, d):
    """Fourteen look-ups of each conversation's job in other conversations, of which twelve, four lines and 700 characters are allowed."""
    lines = _lines(spark, d)
    jobs = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id").distinct()
    many = jobs.agg(F.max("conv_id") + 1).first()[0] or 1
    k = F.col("call")
    asked = jobs.select(F.col("conv_id").alias("job"), F.explode(F.sequence(F.lit(1), F.lit(14))).alias("call"))
    asked = asked.select("job", "call", ((F.col("job") + k) % many).cast("string").alias("log_file"), (1 + k % 5).alias("first"), (k % 7).alias("count"))
    return S.read_requests(lines, asked, 4, 700, 12)
