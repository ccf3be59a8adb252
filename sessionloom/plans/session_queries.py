"""Queries over sessions: turns, windows, facts, blocks, files, chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks as B
from ..operators import chains as H
from ..operators import facts as A
from ..operators import turns as U
from ..sources.tables import EVENT_ENTRIES_SQL, conversation_entries, event_entries

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, d: str) -> DataFrame:
    return event_entries(spark.read.parquet(f"{d}/events.parquet"))


def _talks(spark: SparkSession, d: str) -> DataFrame:
    return conversation_entries(spark.read.parquet(f"{d}/conversations.parquet"))


# Budgets of the queries, small enough for the tables' short sessions to reach them.
TURN_TOKENS, WINDOW_TOKENS = 60, 300

_TOKENS = "CASE kind WHEN 'tool_call' THEN ceil(length(tool_input) / 4.0)::BIGINT + 16 WHEN 'tool_result' THEN ceil(length(content) / 4.0)::BIGINT + 8 ELSE ceil(length(text) / 4.0)::BIGINT END"
_TURNS = f"""{EVENT_ENTRIES_SQL},
sized AS (SELECT *, {_TOKENS} AS tokens, row_number() OVER (PARTITION BY session_key ORDER BY seq) AS n FROM entries),
walk AS (
  SELECT session_key, n, seq, 0::BIGINT AS turn, false AS open, 0::BIGINT AS acc, []::VARCHAR[] AS calls FROM (SELECT DISTINCT session_key, 0 AS n, 0::BIGINT AS seq FROM sized)
  UNION ALL
  SELECT session_key, n, seq, turn, CASE WHEN kind = 'user_text' THEN false WHEN kind = 'tool_result' AND had AND len(calls) = 0 AND acc >= {TURN_TOKENS} THEN false ELSE true END, acc, calls
  FROM (SELECT s.session_key, s.n, s.seq, s.kind, w.turn + CASE WHEN s.kind = 'user_text' OR NOT w.open THEN 1 ELSE 0 END AS turn, CASE WHEN w.open AND s.kind <> 'user_text' THEN w.acc ELSE 0 END + s.tokens AS acc,
          w.open AND list_contains(w.calls, s.tool_call_id) AS had,
          CASE WHEN s.kind = 'user_text' THEN [] WHEN s.kind = 'tool_call' THEN list_append(CASE WHEN w.open THEN list_filter(w.calls, lambda c: c <> s.tool_call_id) ELSE [] END, s.tool_call_id)
               WHEN NOT w.open THEN [] WHEN s.kind = 'tool_result' THEN list_filter(w.calls, lambda c: c <> s.tool_call_id) ELSE w.calls END AS calls
        FROM walk w JOIN sized s ON s.session_key = w.session_key AND s.n = w.n + 1)),
turned AS (SELECT s.*, w.turn AS turn_index, len(w.calls)::BIGINT AS pending FROM sized s JOIN walk w USING (session_key, n)),
turns AS (SELECT session_key, turn_index, CASE WHEN bool_or(kind = 'user_text') THEN 'user' ELSE 'assistant' END AS kind, min(log_line) AS from_line, max(log_line) AS to_line, sum(tokens)::BIGINT AS tokens,
            list(tool_name ORDER BY seq) FILTER (WHERE tool_name IS NOT NULL) AS names,
            arg_max(pending, seq) > 0 AS interrupted FROM turned GROUP BY session_key, turn_index)"""
_NAMES = "coalesce(array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ','), '') AS tool_names"
_RECURSIVE = f"WITH RECURSIVE {_TURNS}"


@query(f"{_RECURSIVE} SELECT session_key, turn_index, kind, from_line, to_line, tokens, {_NAMES}, interrupted FROM turns")
def segment_turns(spark, d):
    return U.turns(_events(spark, d), TURN_TOKENS)


def _packed_sql(source: str, budget: int) -> str:
    return f"""
    numbered AS (SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY turn_index) AS n FROM {source}),
    pack AS (SELECT session_key, turn_index, n, tokens AS acc, 1::BIGINT AS window_index FROM numbered WHERE n = 1
      UNION ALL SELECT t.session_key, t.turn_index, t.n, CASE WHEN p.acc > 0 AND p.acc + t.tokens > {budget} THEN t.tokens ELSE p.acc + t.tokens END, p.window_index + CASE WHEN p.acc > 0 AND p.acc + t.tokens > {budget} THEN 1 ELSE 0 END
      FROM pack p JOIN numbered t ON t.session_key = p.session_key AND t.n = p.n + 1)"""


_TALK_TURNS = """WITH RECURSIVE sized AS (SELECT conv_id::VARCHAR AS session_key, turn, role, ceil(length(text) / 4.0)::BIGINT AS tokens,
    CASE WHEN role = 'user' OR lag(role) OVER w IS NULL OR lag(role) OVER w = 'user' THEN 1 ELSE 0 END AS fresh FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
turned AS (SELECT *, sum(fresh) OVER (PARTITION BY session_key ORDER BY turn)::BIGINT AS turn_index FROM sized),
turns AS (SELECT session_key, turn_index, min(turn) + 1 AS from_line, max(turn) + 1 AS to_line, sum(tokens)::BIGINT AS tokens FROM turned GROUP BY session_key, turn_index)"""


@query(f"{_TALK_TURNS}, {_packed_sql('turns', WINDOW_TOKENS)} SELECT session_key, turn_index, window_index FROM pack")
def pack_windows(spark, d):
    return U.with_windows(U.turns(_talks(spark, d)), WINDOW_TOKENS).select("session_key", "turn_index", "window_index")


@query(f"""{_TALK_TURNS}, {_packed_sql('turns', WINDOW_TOKENS)}
SELECT session_key, window_index, count(*) AS turns, sum(tokens)::BIGINT AS tokens, min(from_line) AS from_line, max(to_line) AS to_line FROM pack JOIN turns USING (session_key, turn_index) GROUP BY session_key, window_index""")
def window_totals(spark, d):
    return U.windows(U.turns(_talks(spark, d)), WINDOW_TOKENS)


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN text END AS v FROM conversations)
SELECT conv_id, turn, last_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM c""")
def digest_carry(spark, d):
    rows = spark.read.parquet(f"{d}/conversations.parquet").withColumn("v", F.when(F.col("role") == "system", F.col("text")))
    return U.digest_carry(rows, "conv_id", "turn", "v").select("conv_id", "turn", "carried")


_E = f"WITH {EVENT_ENTRIES_SQL}"
_PAIRS = f"""{_E}, results AS (SELECT session_key, tool_call_id, max(seq) AS result_seq, arg_max(content, seq) AS content, arg_max(is_error, seq) AS is_error, arg_max(log_line, seq) AS result_line FROM entries WHERE kind = 'tool_result' AND tool_call_id <> '' GROUP BY ALL),
pairs AS (SELECT c.session_key, c.tool_call_id, c.tool_name, c.tool_input, c.seq AS call_seq, c.log_line AS call_line, c.sidechain, r.result_seq, r.result_line, r.content, r.is_error FROM entries c LEFT JOIN results r USING (session_key, tool_call_id) WHERE c.kind = 'tool_call')"""


@query(f"{_PAIRS} SELECT session_key, tool_call_id, tool_name, call_seq, result_seq, content, is_error FROM pairs")
def call_result_pairs(spark, d):
    return A.call_results(_events(spark, d)).select("session_key", "tool_call_id", "tool_name", "call_seq", "result_seq", "content", "is_error")


@query(f"""{_E}, own AS MATERIALIZED (SELECT session_key, tool_call_id, kind, tool_name, seq FROM entries WHERE kind IN ('tool_call', 'tool_result')),
named AS (SELECT session_key, tool_call_id, arg_max(tool_name, seq) AS tool_name FROM own WHERE kind = 'tool_call' GROUP BY ALL)
SELECT session_key, seq, tool_call_id, n.tool_name FROM (SELECT session_key, tool_call_id, seq FROM own WHERE kind = 'tool_result') r LEFT JOIN named n USING (session_key, tool_call_id)""")
def result_owners(spark, d):
    return A.result_owners(_events(spark, d)).select("session_key", "seq", "tool_call_id", "tool_name")


@query(f"{_E} SELECT session_key, tool_call_id, log_line FROM entries e WHERE kind = 'tool_call' AND NOT EXISTS (SELECT 1 FROM entries r WHERE r.kind = 'tool_result' AND r.session_key = e.session_key AND CASE WHEN r.seq % 5 = 0 THEN 'lost-' || r.tool_call_id ELSE r.tool_call_id END = e.tool_call_id)")
def unanswered_calls(spark, d):
    lost = (F.col("kind") == "tool_result") & (F.col("seq") % 5 == 0)
    return A.unanswered_calls(_events(spark, d).withColumn("tool_call_id", F.when(lost, F.concat(F.lit("lost-"), "tool_call_id")).otherwise(F.col("tool_call_id"))))


@query(f"{_E} SELECT session_key, tool_call_id, log_line FROM entries WHERE kind = 'tool_result' AND tool_call_id = ''")
def unmatched_results(spark, d):
    return A.unmatched_results(_events(spark, d))


def _checks(c: str) -> str:
    """The summary of the events' synthetic outputs: run and failed of '<n> passed, <m> failed'."""
    return f"CASE WHEN contains({c}, ' passed, ') THEN regexp_extract({c}, '^(\\d+)', 1)::BIGINT + regexp_extract({c}, ', (\\d+)', 1)::BIGINT END", f"CASE WHEN contains({c}, ' passed, ') THEN regexp_extract({c}, ', (\\d+)', 1)::BIGINT END"


_RUN, _FAILED = _checks("content")
_FACTS = f"""count(*) FILTER (kind = 'tool_call') AS tool_calls, count(*) FILTER (kind = 'tool_result' AND is_error) AS errors, coalesce(arg_max(exit_code, seq) FILTER (kind = 'tool_result' AND exit_code IS NOT NULL), -1) AS last_exit_code,
 coalesce(arg_max({_RUN}, seq) FILTER (kind = 'tool_result' AND ({_RUN}) > 0), -1) AS checks_run, coalesce(arg_max({_FAILED}, seq) FILTER (kind = 'tool_result' AND ({_RUN}) > 0), -1) AS checks_failed,
 coalesce(sum(diff_added) FILTER (kind = 'tool_result'), 0)::BIGINT AS diff_added, coalesce(sum(diff_removed) FILTER (kind = 'tool_result'), 0)::BIGINT AS diff_removed"""


def _filled(df):
    """Unknown facts as -1, so that both engines give the same types."""
    return df.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("last_exit_code", "checks_run", "checks_failed")})


@query(f"""{_RECURSIVE}, own AS (SELECT session_key, turn_index, {_FACTS}, bool_or(interrupted AND kind = 'tool_result') AS cut FROM turned WHERE NOT sidechain GROUP BY ALL)
SELECT t.session_key, t.turn_index, coalesce(tool_calls, 0) AS tool_calls, coalesce(errors, 0) AS errors, coalesce(last_exit_code, -1) AS last_exit_code, coalesce(checks_run, -1) AS checks_run, coalesce(checks_failed, -1) AS checks_failed,
 coalesce(diff_added, 0) AS diff_added, coalesce(diff_removed, 0) AS diff_removed, t.interrupted OR coalesce(cut, false) AS interrupted FROM turns t LEFT JOIN own USING (session_key, turn_index)""")
def seal_facts(spark, d):
    return _filled(A.seal_facts(_events(spark, d), TURN_TOKENS))


@query(f"""{_E} SELECT session_key, {_FACTS}, count(*) FILTER (kind = 'tool_result' AND interrupted) AS interrupted_results, count(DISTINCT diff_path) FILTER (kind = 'tool_result') AS files_modified, 0::BIGINT AS compactions FROM entries WHERE NOT sidechain GROUP BY session_key""")
def account_sessions(spark, d):
    return _filled(A.account_sessions(_events(spark, d)))


@query(f"""{_E}, own AS (SELECT session_key, seq, seq AS turn_index, {_FACTS.replace("kind = 'tool_result' AND ", "").replace("(kind = 'tool_result')", "(true)")} FROM entries WHERE kind = 'tool_result' AND NOT sidechain GROUP BY ALL)
SELECT session_key, string_agg('b' || seq || ': calls=0; errors=' || errors || CASE WHEN last_exit_code >= 0 THEN '; lastExit=' || last_exit_code ELSE '' END || CASE WHEN checks_run >= 0 THEN '; checks: ' || checks_run || ' run / ' || checks_failed || ' failed' ELSE '' END
 || CASE WHEN diff_added > 0 OR diff_removed > 0 THEN '; diff +' || diff_added || '/−' || diff_removed ELSE '' END, chr(10) ORDER BY seq) AS footer FROM own GROUP BY session_key""")
def facts_footer(spark, d):
    e = _events(spark, d).where("kind = 'tool_result' and not sidechain")
    facts = A.checked(e).groupBy("session_key", F.col("seq").alias("turn_index"), "seq").agg(*A._facts()).withColumn("interrupted", F.lit(False))
    return A.facts_footer(facts)


@query(f"{_E} SELECT session_key, tool_name, count(*) AS n FROM entries WHERE kind = 'tool_call' AND NOT sidechain GROUP BY ALL")
def tools_by_tool(spark, d):
    return A.tools_by_tool(_events(spark, d))


_CHECKS = f"""ran AS (SELECT r.session_key, r.seq, {_checks('r.content')[0]} AS run, {_checks('r.content')[1]} AS failed FROM entries r JOIN entries c ON c.kind = 'tool_call' AND c.session_key = r.session_key AND c.tool_call_id = r.tool_call_id
  WHERE r.kind = 'tool_result' AND NOT r.sidechain AND c.tool_name = 'Bash'),
checks AS (SELECT session_key, arg_max(run, seq) AS run, arg_max(failed, seq) AS failed, bool_or(failed > 0) AS ever_failed FROM ran WHERE run > 0 GROUP BY session_key)"""


@query(f"{_E}, {_CHECKS} SELECT * FROM checks")
def session_checks(spark, d):
    return A.session_checks(_events(spark, d))


@query(f"""{_E}, {_CHECKS}, sums AS (SELECT session_key, bool_or(kind = 'tool_result' AND interrupted) AS cut, count(*) FILTER (kind = 'tool_result' AND is_error) AS errors, count(*) FILTER (kind = 'tool_call') AS calls, coalesce(arg_max(is_error, seq) FILTER (kind = 'tool_result'), false) AS last_error FROM entries WHERE NOT sidechain GROUP BY ALL)
SELECT session_key, CASE WHEN cut THEN 'partial' WHEN run > 0 AND failed > 0 OR last_error THEN 'failure' WHEN coalesce(ever_failed, false) OR errors > 0 THEN 'partial' WHEN calls = 0 THEN 'unknown' WHEN run > 0 THEN 'success' ELSE 'unknown' END AS status,
 CASE WHEN cut THEN 'interrupted tool calls' WHEN run > 0 AND failed > 0 THEN 'last checks run: ' || failed || ' failed out of ' || run WHEN last_error THEN 'the last tool call ended with an error' WHEN ever_failed THEN 'checks failed earlier and are green now'
   WHEN errors > 0 THEN 'tool errors: ' || errors WHEN calls = 0 THEN 'no tool calls' WHEN run > 0 THEN 'checks ran (' || run || ') and are green' ELSE 'no tool errors; no checks' END AS why FROM sums LEFT JOIN checks USING (session_key)""")
def verdicts(spark, d):
    return A.verdicts(_events(spark, d))


@query("""WITH g AS (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events)
SELECT user_id, coalesce(sum(gap) FILTER (gap <= 3600000000), 0)::BIGINT AS active_us FROM g GROUP BY user_id""")
def active_time(spark, d):
    return A.active_time(spark.read.parquet(f"{d}/events.parquet"), "user_id", "ts", 3_600_000)


@query(f"{_E} SELECT session_key, arg_max(is_error, seq) AS last_error, max(log_line) AS log_line FROM entries WHERE kind = 'tool_result' AND NOT sidechain GROUP BY session_key")
def last_results(spark, d):
    return A.last_results(_events(spark, d))


@query(f"""{_E}, m AS (SELECT *, CASE WHEN sidechain AND NOT coalesce(lag(sidechain) OVER w, false) THEN 1 ELSE 0 END AS fresh FROM entries WINDOW w AS (PARTITION BY session_key ORDER BY seq)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY session_key ORDER BY seq)::BIGINT AS run FROM m)
SELECT session_key, run, min(log_line) AS line_from, max(log_line) AS line_to, count(*) FILTER (kind = 'tool_call') AS calls, count(*) FILTER (kind = 'tool_result' AND is_error) AS errors, NULL::VARCHAR AS first_text FROM r WHERE sidechain GROUP BY session_key, run""")
def sidechain_runs(spark, d):
    return A.sidechain_runs(_events(spark, d))


_SIG = "c.tool_name || '::' || CASE WHEN c.tool_name = 'Bash' THEN c.tool_input::JSON->>'$.command' ELSE c.tool_input::JSON->>'$.file_path' END"


@query(f"""{_E}, errs AS (SELECT r.session_key, r.seq, 'error' AS what, {_SIG} AS key FROM entries r LEFT JOIN entries c ON c.kind = 'tool_call' AND c.session_key = r.session_key AND c.tool_call_id = r.tool_call_id AND r.tool_call_id <> '' WHERE r.kind = 'tool_result' AND r.is_error AND NOT r.sidechain),
rows_ AS (FROM errs UNION ALL SELECT c.session_key, c.seq, 'call', {_SIG} FROM entries c WHERE c.kind = 'tool_call' AND NOT c.sidechain),
l AS (SELECT *, last_value(CASE WHEN what = 'error' THEN {{'s': seq, 'k': key}} END IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY seq ROWS UNBOUNDED PRECEDING) AS last FROM rows_)
SELECT session_key, count(DISTINCT last.s) AS repairs FROM l WHERE what = 'call' AND last.k = key GROUP BY session_key""")
def repair_cycles(spark, d):
    return A.repair_cycles(_events(spark, d))


_BLOCK_WALK = f"""WITH RECURSIVE {EVENT_ENTRIES_SQL},
own AS (SELECT *, CASE tool_name WHEN 'Read' THEN 'read' WHEN 'Edit' THEN 'edit' WHEN 'Bash' THEN 'execute' END AS family, row_number() OVER (PARTITION BY session_key ORDER BY seq) AS n FROM entries WHERE NOT sidechain AND kind IN ('user_text', 'assistant_text', 'tool_call')),
walk AS (
  SELECT session_key, 0::BIGINT AS n, 0::BIGINT AS block, []::VARCHAR[] AS calls FROM (SELECT DISTINCT session_key FROM own)
  UNION ALL
  SELECT session_key, n, block + CASE WHEN fresh THEN 1 ELSE 0 END, CASE WHEN kind = 'user_text' THEN [] WHEN fresh THEN [family] ELSE list_append(calls, family) END FROM (
    SELECT o.session_key, o.n, o.kind, o.family, w.block, w.calls, o.kind = 'user_text' OR w.n = 0 OR (o.turn_start AND len(w.calls) > 0 AND (len(w.calls) >= 8 OR
      list_max(list_transform(['read', 'edit', 'execute'], lambda f: {{'n': len(list_filter(w.calls, lambda c: c = f)), 'p': -coalesce(list_position(w.calls, f), 999), 'f': f}})).f <> o.family)) AS fresh
    FROM walk w JOIN own o ON o.session_key = w.session_key AND o.n = w.n + 1)),
placed AS (SELECT o.*, w.block AS block_index FROM own o JOIN walk w USING (session_key, n))"""


@query(f"""{_BLOCK_WALK}, results AS (SELECT session_key, tool_call_id, arg_max(is_error, seq) AS failed, arg_max(log_line, seq) AS result_line FROM entries WHERE kind = 'tool_result' AND tool_call_id <> '' GROUP BY ALL),
b AS (SELECT session_key, block_index, count(*) FILTER (family = 'read') AS r, count(*) FILTER (family = 'edit') AS e, count(*) FILTER (family = 'execute') AS x, count(*) FILTER (kind = 'tool_call') AS calls, count(*) FILTER (kind = 'tool_call' AND failed) AS errors,
  coalesce(min(least(log_line, coalesce(result_line, log_line))) FILTER (kind = 'tool_call'), 0) AS line_from, coalesce(max(greatest(log_line, coalesce(result_line, log_line))) FILTER (kind = 'tool_call'), 0) AS line_to, arg_min(ts, seq) AS started_at, arg_max(ts, seq) AS ended_at
  FROM placed LEFT JOIN results USING (session_key, tool_call_id) GROUP BY session_key, block_index)
SELECT session_key, block_index, CASE WHEN calls = 0 THEN 'outcome' WHEN e > 0 THEN 'edit' WHEN r > 0 AND r >= x THEN 'research' ELSE 'run' END AS label,
  CASE WHEN calls = 0 THEN 'no tool calls' ELSE concat_ws(', ', CASE WHEN r > 0 THEN 'read/search ×' || r END, CASE WHEN e > 0 THEN 'edits ×' || e END, CASE WHEN x > 0 THEN 'runs ×' || x END) END || CASE WHEN errors > 0 THEN '; errors: ' || errors ELSE '' END AS summary,
  NULL::VARCHAR AS assistant_text, calls, errors, line_from, line_to, started_at, ended_at FROM b""")
def blocks(spark, d):
    return B.blocks(_events(spark, d))


# A result's line for the SQL side: Read shows size and hash, Edit the changed lines, Bash its text.
_FACT = """CASE WHEN r.content IS NULL THEN 'no result' WHEN r.cut THEN 'interrupted' WHEN r.is_error THEN 'ERR ' || split_part(r.content, chr(10), 1) WHEN c.tool_name = 'Edit' THEN '+' || coalesce(r.a, 0) || '/−' || coalesce(r.d, 0)
  WHEN c.tool_name = 'Read' THEN '2 ln …⟨' || length(r.content) || 'B, 2 ln, #' || substr(sha256(r.content), 1, 8) || ', @L' || CASE WHEN {0} THEN '' ELSE result_line::VARCHAR END || '⟩' ELSE r.content END"""
_RESULTS = """results AS (SELECT session_key, tool_call_id, arg_max(is_error, seq) AS is_error, arg_max(interrupted, seq) AS cut, arg_max(content, seq) AS content, arg_max(log_line, seq) AS result_line, arg_max({'v': diff_added}, seq).v AS a, arg_max({'v': diff_removed}, seq).v AS d FROM entries WHERE kind = 'tool_result' AND tool_call_id <> '' GROUP BY ALL)"""
_CALLED = """'`' || c.tool_name || '` ' || CASE WHEN c.tool_name = 'Bash' THEN c.tool_input::JSON->>'$.command' ELSE c.tool_input::JSON->>'$.file_path' END"""
_LINE = f"{_CALLED} || ' @L' || c.log_line || ' → ' || {_FACT.format('false')} || CASE WHEN result_line - c.log_line > 2 THEN ' @L' || result_line ELSE '' END"


@query(f"{_E}, {_RESULTS} SELECT c.session_key, c.tool_call_id, {_LINE} AS line FROM entries c LEFT JOIN results r USING (session_key, tool_call_id) WHERE c.kind = 'tool_call'")
def rendered_calls(spark, d):
    return B.rendered_calls(_events(spark, d)).select("session_key", "tool_call_id", "line")


@query(f"""{_BLOCK_WALK}, {_RESULTS}, l AS (SELECT c.session_key, block_index, c.seq, c.log_line, family, coalesce(r.is_error, false) AS is_error, {_LINE} AS line, {_CALLED} || {_FACT.format('true')} AS key FROM placed c LEFT JOIN results r USING (session_key, tool_call_id) WHERE c.kind = 'tool_call')
SELECT session_key, block_index, min(seq) AS pos, arg_max(line, seq) || CASE WHEN count(*) > 1 THEN ' ×' || count(*) ELSE '' END AS text, arg_max(log_line, seq) AS log_line, is_error, family, count(*) AS occurrences FROM l GROUP BY session_key, block_index, key, is_error, family""")
def tool_lines(spark, d):
    return B.tool_lines(_events(spark, d))


@query("""WITH r AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
runs AS (SELECT user_id, min(i) AS first, max(i) AS last, count(*) AS n, arg_max(event_id, i) AS last_id, any_value(event_type) AS t FROM r GROUP BY user_id, event_type, g)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY first) AS run, t || ' @L' || last_id AS line, n, first, last FROM runs""")
def collapse_identical(spark, d):
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint")
    rows = spark.read.parquet(f"{d}/events.parquet").select("user_id", i.alias("i"), F.concat("event_type", F.lit(" "), T.ref_tag(F.col("event_id"))).alias("line"))
    return B.collapse_identical(rows, "user_id", "i", "line")


_OPS = f"""{_PAIRS}, ops AS (SELECT p.session_key, p.call_seq AS seq, p.tool_input::JSON->>'$.file_path' AS path, CASE WHEN p.tool_name = 'Edit' THEN 'modify' ELSE 'read' END AS op, CASE WHEN p.tool_name = 'Edit' THEN coalesce(p.result_line, p.call_line) ELSE p.call_line END AS line,
  CASE WHEN p.tool_name = 'Edit' THEN coalesce(r.diff_added, 0) END AS added, CASE WHEN p.tool_name = 'Edit' THEN coalesce(r.diff_removed, 0) END AS removed
  FROM (SELECT c.*, (SELECT max(seq) FROM entries x WHERE x.kind = 'tool_result' AND NOT x.sidechain AND x.session_key = c.session_key AND x.tool_call_id = c.tool_call_id) AS rs FROM pairs c) p LEFT JOIN entries r ON r.session_key = p.session_key AND r.seq = p.rs WHERE NOT p.sidechain AND p.tool_name IN ('Read', 'Edit')),
ledger AS (SELECT session_key, path, count(*) FILTER (op = 'read') AS reads, coalesce(array_to_string((list(line ORDER BY seq) FILTER (op = 'read'))[1:4], ','), '') AS read_refs, bool_or(op = 'modify') AS modified, coalesce(sum(added), 0)::BIGINT AS added, coalesce(sum(removed), 0)::BIGINT AS removed,
  coalesce(array_to_string((list(line ORDER BY seq) FILTER (op = 'modify'))[1:4], ','), '') AS modify_refs FROM ops GROUP BY session_key, path)"""


@query(f"{_OPS} SELECT * FROM ledger")
def file_ledger(spark, d):
    return B.file_ledger(_events(spark, d))


@query(f"{_OPS} SELECT session_key, path, 'F' || row_number() OVER (PARTITION BY session_key ORDER BY modified DESC, path) AS id FROM ledger")
def file_index(spark, d):
    return B.file_index(B.file_ledger(_events(spark, d)))


@query(f"{_OPS} SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY reads DESC, path) AS rank FROM ledger")
def working_set(spark, d):
    return B.working_set(B.file_ledger(_events(spark, d)))


@query(r"SELECT event_id, 'open [F1] then [F2] then ' || chr(39) || '/p/x' || chr(39) || ' ' || event_id AS line FROM events")
def substitute_refs(spark, d):
    names = F.array(F.struct(F.lit("/p/f1").alias("path"), F.lit("[F2]").alias("id")), F.struct(F.lit("/p/f1/long.py").alias("path"), F.lit("[F1]").alias("id")))
    text = F.concat(F.lit("open /p/f1/long.py then /p/f1 then '/p/x' "), F.col("event_id").cast("string"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", T.substitute_refs(text, names).alias("line"))


#: Gaps of the chain queries; users' events lie hours apart.
TIGHT, LOOSE = 3_600_000, 43_200_000
_SESSIONS = "s AS (SELECT user_id, event_id, ts, (props::JSON->>'$.k')::BIGINT AS k, [(props::JSON->>'$.k')::BIGINT % 4] AS paths, CASE WHEN event_type = 'error' THEN 'b' ELSE 'a' END AS source FROM events)"
_LINKED = f"""WITH {_SESSIONS}, l AS (SELECT *, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1000.0 AS gap, lag(paths) OVER w AS before, lag(source) OVER w AS source_before, lag(k % 90 + 7) OVER w AS last_uuid FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR)),
r AS (SELECT *, CASE WHEN k = last_uuid OR k + 1 = last_uuid THEN 'leaf-uuid' WHEN source <> source_before THEN NULL WHEN gap <= {TIGHT} THEN 'time-gap' WHEN gap <= {LOOSE} AND list_has_any(paths, before) THEN 'time-gap-overlap' END AS reason FROM l),
c AS (SELECT *, sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR)::BIGINT AS chain FROM r),
x AS (SELECT user_id, chain, event_id::VARCHAR AS session_key, row_number() OVER (PARTITION BY user_id, chain ORDER BY ts, event_id::VARCHAR) AS session_index, reason FROM c)"""


def _chained(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    at, k = F.col("ts").cast("timestamp"), F.get_json_object("props", "$.k").cast("bigint")
    rows = e.select("user_id", F.col("event_id").cast("string").alias("session_key"), F.when(F.col("event_type") == "error", "b").otherwise("a").alias("source"), at.alias("started_at"), at.alias("ended_at"), F.array(F.get_json_object("props", "$.k").cast("bigint") % 4).alias("paths"), k.alias("leaf_uuid"), (k + 1).alias("logical_parent_uuid"), (k % 90 + 7).alias("last_uuid"))
    return H.chains(rows, TIGHT, LOOSE, "user_id", ranges=16)


@query(f"{_LINKED} SELECT * FROM x")
def chains(spark, d):
    return _chained(spark, d)


@query(f"""{_LINKED}, f AS (SELECT user_id, chain, reason, min(session_index) AS p FROM x WHERE reason IS NOT NULL GROUP BY ALL)
SELECT user_id, chain, count(*) AS sessions, coalesce((SELECT string_agg(reason, ',' ORDER BY p) FROM f WHERE f.user_id = x.user_id AND f.chain = x.chain), '') AS reasons FROM x GROUP BY user_id, chain""")
def chain_reasons(spark, d):
    return H.chain_reasons(_chained(spark, d), "user_id")


@query(f"{_LINKED} SELECT p.event_id::VARCHAR AS session_key, x.user_id, x.chain, x.session_key AS parent_key, x.session_index AS parent_index FROM events p JOIN x ON x.session_key = (p.event_id // 3)::VARCHAR")
def subagent_parents(spark, d):
    subs = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").cast("string").alias("session_key"), F.floor(F.col("event_id") / 3).cast("string").alias("parent_key"))
    return H.subagents(subs, _chained(spark, d), "user_id")


@query(f"""{_LINKED}, n AS (SELECT event_id::VARCHAR AS session_key, (props::JSON->>'$.k')::BIGINT AS requests, (event_type = 'error')::BIGINT AS errors FROM events)
SELECT user_id, chain, count(*) AS sessions, sum(requests)::BIGINT AS requests, sum(errors)::BIGINT AS errors FROM x JOIN n USING (session_key) GROUP BY user_id, chain""")
def chain_stats(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    stats = e.select(F.col("event_id").cast("string").alias("session_key"), F.get_json_object("props", "$.k").cast("bigint").alias("requests"), (F.col("event_type") == "error").cast("bigint").alias("errors"))
    return H.chain_stats(_chained(spark, d), stats, "user_id")


@query(f"""{_LINKED} SELECT user_id, chain, session_key, session_index, lag(session_key) OVER (PARTITION BY user_id, chain ORDER BY session_index) AS before_key,
 '- s' || session_index || ' · ' || session_key || CASE WHEN reason IS NULL THEN '' ELSE ' · ' || reason END AS line FROM x""")
def chain_sessions(spark, d):
    return H.session_lines(_chained(spark, d), "user_id")
