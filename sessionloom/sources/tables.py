"""Session entries from plain tables: one row per entry, in one wide nullable schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The entry table: (session_key, seq) is unique.
ENTRY = (
    "session_key string, seq bigint, log_line bigint, kind string, text string, tool_name string, tool_input string, tool_call_id string, content string, "
    "is_error boolean, interrupted boolean, diff_added bigint, diff_removed bigint, diff_path string, exit_code int, subtype string, ts string, sidechain boolean, turn_start boolean"
)
COLUMNS = tuple(c.split()[0] for c in ENTRY.split(", "))
_TYPES = dict(c.split() for c in ENTRY.split(", "))
_OWN = tuple(c for c in COLUMNS if c not in ("session_key", "seq", "log_line"))
_FLAGS = {"is_error", "interrupted", "sidechain", "turn_start"}


def entry(kind: Column | str, **given: Column) -> Column:
    """One entry as a struct of all its fields; what isn't given is null, or false for flags."""
    fields = {"kind": F.lit(kind) if isinstance(kind, str) else kind} | given
    zero = lambda c: F.lit(False) if c in _FLAGS else F.lit(None)
    return F.struct(*(F.coalesce(fields[c], F.lit(False)).alias(c) if c in _FLAGS and c in fields else fields.get(c, zero(c)).cast(_TYPES[c]).alias(c) for c in _OWN))


def as_entries(df: DataFrame) -> DataFrame:
    """df with exactly the entry columns; missing ones are null, missing flags false."""
    flags = {"is_error", "interrupted", "sidechain", "turn_start"}
    return df.select(*(F.col(c).cast(_TYPES[c]).alias(c) if c in df.columns else (F.lit(False) if c in flags else F.lit(None).cast(_TYPES[c])).alias(c) for c in COLUMNS))


def conversation_entries(conversations: DataFrame) -> DataFrame:
    """A conversation is a session and each of its turns an entry."""
    kind = F.when(F.col("role") == "user", "user_text").when(F.col("role") == "assistant", "assistant_text").otherwise("system_note")
    return as_entries(conversations.select(F.col("conv_id").cast("string").alias("session_key"), F.col("turn").alias("seq"), (F.col("turn") + 1).alias("log_line"), kind.alias("kind"), "text", F.when(kind == "system_note", "pr-link").alias("subtype")))


def event_entries(events: DataFrame) -> DataFrame:
    """A user's events as a session: views read a file, purchases edit one, clicks run a command, sign-ups are prompts and
    errors are a second, failed result of the call before. Calls have their result at once."""
    line = Window.partitionBy("user_id").orderBy("ts", "event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = events.select(F.col("user_id").cast("string").alias("session_key"), "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ts"), k.alias("k"), F.row_number().over(line).cast("bigint").alias("i"), F.last(F.when(F.col("event_type").isin("view", "purchase", "click"), F.col("event_id")), ignorenulls=True).over(line).alias("call_id"))
    path = F.format_string("/p/f%d.py", F.col("k") % 20)
    tool = F.when(F.col("event_type") == "view", "Read").when(F.col("event_type") == "purchase", "Edit").otherwise("Bash")
    given = (
        F.when(tool == "Read", F.format_string('{"file_path":"%s"}', path))
        .when(tool == "Edit", F.format_string('{"file_path":"%s","old_string":"a","new_string":"b"}', path))
        .otherwise(F.format_string('{"command":"make t%d"}', F.col("k") % 5))
    )
    said = F.when(tool == "Bash", F.format_string("%d passed, %d failed", F.col("k"), F.col("k") % 3)).otherwise(F.format_string("line %d\nend", F.col("k")))
    called = F.col("event_type").isin("view", "purchase", "click")
    base = e.withColumns({"tool": tool, "given": given, "said": said, "path": path})
    edit, side = F.col("tool") == "Edit", F.col("k") % 13 == 0
    ts, own, call_id = F.col("ts"), F.col("event_id"), F.col("event_id").cast("string")
    prompt = entry("user_text", text=F.format_string("please do %d", F.col("k")), ts=ts)
    call = entry("tool_call", tool_name=F.col("tool"), tool_input=F.col("given"), tool_call_id=call_id, ts=ts, sidechain=side, turn_start=F.col("i") % 3 == 0)
    result = entry(
        "tool_result", tool_call_id=call_id, content=F.col("said"), ts=ts, sidechain=side, is_error=own % 11 == 0, interrupted=own % 397 == 0, exit_code=F.when(F.col("tool") == "Bash", F.col("k") % 3),
        diff_added=F.when(edit, F.col("k") % 10), diff_removed=F.when(edit, F.col("k") % 4), diff_path=F.when(edit, F.col("path")),
    )
    failed = entry("tool_result", tool_call_id=F.coalesce(F.col("call_id").cast("string"), F.lit("")), content=F.format_string("Error %d", F.col("k")), is_error=F.lit(True), ts=ts)
    made = F.when(called, F.array(call, result)).when(F.col("event_type") == "signup", F.array(prompt)).when(F.col("event_type") == "error", F.array(failed))
    rows = base.select("session_key", "i", F.posexplode(made).alias("p", "e")).select("session_key", (F.col("i") * 2 + F.col("p")).cast("bigint").alias("seq"), "e.*")
    return as_entries(rows.withColumn("log_line", F.col("seq")))


#: The same entries for the SQL engine that checks results.
EVENT_ENTRIES_SQL = r"""
ev AS (SELECT user_id::VARCHAR AS session_key, event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS ts, (props::JSON->>'$.k')::BIGINT AS k, row_number() OVER w AS i,
         last_value(CASE WHEN event_type IN ('view', 'purchase', 'click') THEN event_id END IGNORE NULLS) OVER w AS call_id,
         CASE event_type WHEN 'view' THEN 'Read' WHEN 'purchase' THEN 'Edit' ELSE 'Bash' END AS tool
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
base AS (SELECT *, '/p/f' || (k % 20) || '.py' AS path FROM ev),
entries AS (
  SELECT session_key, i * 2 AS seq, i * 2 AS log_line, 'user_text' AS kind, 'please do ' || k AS text, NULL::VARCHAR AS tool_name, NULL::VARCHAR AS tool_input, NULL::VARCHAR AS tool_call_id, NULL::VARCHAR AS content, false AS is_error, false AS interrupted,
         NULL::BIGINT AS diff_added, NULL::BIGINT AS diff_removed, NULL::VARCHAR AS diff_path, NULL::INT AS exit_code, ts, false AS sidechain, false AS turn_start FROM base WHERE event_type = 'signup'
  UNION ALL SELECT session_key, i * 2, i * 2, 'tool_call', NULL, tool, CASE tool WHEN 'Read' THEN '{"file_path":"' || path || '"}' WHEN 'Edit' THEN '{"file_path":"' || path || '","old_string":"a","new_string":"b"}' ELSE '{"command":"make t' || (k % 5) || '"}' END,
         event_id::VARCHAR, NULL, false, false, NULL, NULL, NULL, NULL, ts, k % 13 = 0, i % 3 = 0 FROM base WHERE event_type IN ('view', 'purchase', 'click')
  UNION ALL SELECT session_key, i * 2 + 1, i * 2 + 1, 'tool_result', NULL, NULL, NULL, event_id::VARCHAR, CASE tool WHEN 'Bash' THEN k || ' passed, ' || (k % 3) || ' failed' ELSE 'line ' || k || chr(10) || 'end' END, event_id % 11 = 0, event_id % 397 = 0,
         CASE WHEN tool = 'Edit' THEN k % 10 END, CASE WHEN tool = 'Edit' THEN k % 4 END, CASE WHEN tool = 'Edit' THEN path END, (CASE WHEN tool = 'Bash' THEN k % 3 END)::INT, ts, k % 13 = 0, false FROM base WHERE event_type IN ('view', 'purchase', 'click')
  UNION ALL SELECT session_key, i * 2, i * 2, 'tool_result', NULL, NULL, NULL, coalesce(call_id::VARCHAR, ''), 'Error ' || k, true, false, NULL, NULL, NULL, NULL, ts, false, false FROM base WHERE event_type = 'error')"""
