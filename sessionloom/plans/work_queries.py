"""Queries over reviews, jobs, the bank and rendered traces."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import accept as V
from ..operators import contracts as C
from ..operators import facts as A
from ..operators import render as M
from ..operators import review as R
from ..operators import submissions as B
from ..operators import turns as U
from ..operators import work as K
from ..storage import shared_dir, written
from .session_queries import _RECURSIVE, _TALK_TURNS, TURN_TOKENS, _events, _talks
from .text_queries import _SLUG

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _ev(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


# Claims, thoughts and records that a model might have left, made by arithmetic on turns of events.
_T = f"{_RECURSIVE}"


@query(f"""{_T}, c AS (SELECT session_key, turn_index, from_line - CASE WHEN turn_index % 3 = 0 THEN 1 ELSE 0 END AS f, to_line + CASE WHEN turn_index % 5 = 0 THEN 2 ELSE 0 END AS t, from_line, to_line FROM turns)
SELECT session_key, turn_index, CASE WHEN f < from_line OR t > to_line THEN from_line ELSE f END AS from_line, CASE WHEN f < from_line OR t > to_line THEN to_line ELSE t END AS to_line, f < from_line OR t > to_line AS corrected FROM c""")
def gate_anchors(spark, d):
    turns = U.turns(_events(spark, d), TURN_TOKENS)
    claims = turns.select("session_key", "turn_index", (F.col("from_line") - F.when(F.col("turn_index") % 3 == 0, 1).otherwise(0)).alias("from_line"), (F.col("to_line") + F.when(F.col("turn_index") % 5 == 0, 2).otherwise(0)).alias("to_line"))
    return R.gate_anchors(claims, turns)


_QUOTED = r"""s AS (SELECT conv_id::VARCHAR AS session_key, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations)"""


@query(rf"""WITH {_QUOTED} SELECT session_key, turn + 1 AS log_line, CASE WHEN turn % 3 = 0 AND role = 'assistant' THEN 'narration' WHEN turn % 3 = 1 AND role = 'assistant' THEN 'inferred' ELSE 'inferred' END AS source, (turn % 3 <> 1 OR role <> 'assistant') AS quote_valid FROM s WHERE role = 'assistant'""")
def gate_quotes(spark, d):
    quotes = U.quotes(_talks(spark, d))
    named = F.when(F.col("log_line") % 3 == 1, F.col("q")).when(F.col("log_line") % 3 == 2, F.lit("q000000"))
    source = F.when(F.col("log_line") % 3 == 0, "inferred").otherwise("narration")
    return R.gate_quotes(quotes.select("session_key", "turn_index", "log_line", named.alias("q"), source.alias("source")), quotes).select("session_key", "log_line", "source", "quote_valid")


@query("""WITH a AS (SELECT conv_id, turn, (turn * 3 - 2) AS from_line, text FROM conversations), s AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id::VARCHAR AS session_key, turn, from_line, from_line BETWEEN 1 AND n AS kept, left(text, 60) AS subject FROM a JOIN s USING (conv_id)""")
def arc_gate(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    arcs = R.reasoning_index(c.select(F.col("conv_id").cast("string").alias("session_key"), "turn", (F.col("turn") * 3 - 2).alias("from_line"), "text"))
    return R.arc_gate(arcs, c.groupBy(F.col("conv_id").cast("string").alias("session_key")).agg(F.count("*").alias("log_lines"))).drop("text")


_N1, _N2 = (f"try_cast(regexp_extract(content, '{p}', 1) AS BIGINT)" for p in (r"^(\d+) passed", r", (\d+) failed"))


@query(f"""{_T}, f AS (SELECT session_key, turn_index, arg_max(exit_code, seq) FILTER (exit_code IS NOT NULL) AS e, arg_max({_N1} + {_N2}, seq) FILTER ({_N1} + {_N2} > 0) AS run, arg_max({_N2}, seq) FILTER ({_N1} + {_N2} > 0) AS failed FROM turned WHERE kind = 'tool_result' AND NOT sidechain GROUP BY ALL)
SELECT session_key, turn_index, 'exitCode' AS kind, 'exit 1' AS claimed, 'exit ' || e AS sealed FROM f WHERE e <> 1
UNION ALL SELECT session_key, turn_index, 'checks', '9 run / 0 failed', run || ' run / ' || failed || ' failed' FROM f WHERE run <> 9 OR failed <> 0""")
def gate_facts(spark, d):
    sealed = A.seal_facts(_events(spark, d), TURN_TOKENS)
    claims = sealed.select("session_key", "turn_index", F.lit(9).alias("checks_run"), F.lit(0).alias("checks_failed"), F.lit(1).alias("exit_code"))
    return R.gate_facts(claims, sealed)


_RECORDS = f"""{_T}, records AS (SELECT session_key, from_line, to_line, CASE WHEN turn_index % 2 = 0 THEN '' ELSE 'gone-' END || turn_index AS slice_hash, 3 AS schema_version, turn_index AS append_seq, 'old' AS result FROM turns
UNION ALL SELECT session_key, from_line, to_line, CASE WHEN turn_index % 3 = 0 THEN '' ELSE 'gone-' END || turn_index, CASE WHEN turn_index % 5 = 0 THEN 2 ELSE 3 END, 100000 + turn_index, 'new' FROM turns),
latest AS (SELECT * FROM records WHERE schema_version = 3 QUALIFY row_number() OVER (PARTITION BY session_key, from_line, to_line, slice_hash ORDER BY append_seq DESC) = 1)"""


def _sliced(spark, d):
    return U.turns(_events(spark, d), TURN_TOKENS).withColumn("slice_hash", F.col("turn_index").cast("string"))


def _records(turns):
    base = ["session_key", "from_line", "to_line"]
    of = lambda n: F.when(F.col("turn_index") % n == 0, F.col("slice_hash")).otherwise(F.concat(F.lit("gone-"), "slice_hash")).alias("slice_hash")
    old = turns.select(*base, of(2), F.lit(3).alias("schema_version"), F.col("turn_index").alias("append_seq"), F.lit("old").alias("result"))
    new = turns.select(*base, of(3), F.when(F.col("turn_index") % 5 == 0, 2).otherwise(3).alias("schema_version"), (F.col("turn_index") + 100000).alias("append_seq"), F.lit("new").alias("result"))
    return old.unionByName(new)


def _far_blocks(turns):
    """A range for each turn: one in four swallows what follows, the others lie far behind the log."""
    off = F.when(F.col("turn_index") % 4 == 1, 0).otherwise(1_000_000)
    return turns.select("session_key", (F.col("from_line") + off).alias("b_from"), (F.col("to_line") + 4 + off).alias("b_to"))


@query(f"{_RECORDS} SELECT * FROM latest")
def sidecar_latest(spark, d):
    return R.sidecar_latest(_records(_sliced(spark, d)))


@query(f"{_RECORDS} SELECT session_key, turn_index FROM turns t WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.session_key = t.session_key AND l.from_line = t.from_line AND l.to_line = t.to_line AND l.slice_hash = t.turn_index::VARCHAR)")
def pending_turns(spark, d):
    turns = _sliced(spark, d)
    return R.pending_turns(turns, R.sidecar_latest(_records(turns))).select("session_key", "turn_index")


@query(f"{_RECORDS} SELECT t.session_key, t.turn_index // 3 AS window_index, bool_and(l.slice_hash IS NOT NULL) AS covered FROM turns t LEFT JOIN latest l ON l.session_key = t.session_key AND l.from_line = t.from_line AND l.to_line = t.to_line AND l.slice_hash = t.turn_index::VARCHAR GROUP BY ALL")
def covered_windows(spark, d):
    turns = _sliced(spark, d).withColumn("window_index", F.floor(F.col("turn_index") / F.lit(3)))
    return R.covered_windows(turns, R.sidecar_latest(_records(turns)))


@query(f"""{_T}, b AS (SELECT session_key, from_line + o AS b_from, to_line + 4 + o AS b_to FROM (SELECT *, CASE WHEN turn_index % 4 = 1 THEN 0 ELSE 1000000 END AS o FROM turns)) SELECT t.session_key, t.turn_index, count(b.b_from) AS n_blocks FROM turns t LEFT JOIN b ON b.session_key = t.session_key AND t.from_line >= b.b_from AND t.to_line <= b.b_to GROUP BY ALL""")
def submit_coverage(spark, d):
    turns = _sliced(spark, d)
    return R.submit_coverage(turns, _far_blocks(turns))


@query(f"""{_T}, b AS (SELECT session_key, from_line + o AS b_from, to_line + 4 + o AS b_to FROM (SELECT *, CASE WHEN turn_index % 4 = 1 THEN 0 ELSE 1000000 END AS o FROM turns)), m AS (SELECT t.session_key, t.turn_index, t.to_line, max(b_from) AS f, arg_max(b_to, b_from) AS e FROM turns t LEFT JOIN b ON b.session_key = t.session_key AND b.b_from <= t.from_line GROUP BY ALL)
SELECT session_key, turn_index, CASE WHEN e >= to_line THEN f ELSE -1 END AS span_from, CASE WHEN e >= to_line THEN e ELSE -1 END AS span_to FROM m""")
def merged_spans(spark, d):
    turns = _sliced(spark, d)
    return R.merged_spans(turns, _far_blocks(turns)).withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("span_from", "span_to")})


@query("""WITH f AS (SELECT conv_id::VARCHAR AS session_key, turn, text AS a, regexp_replace(text, '[aeiou ]', '', 'g') AS b FROM conversations)
SELECT session_key, turn, CASE WHEN ceil(length(a) / 4.0) <= 60 THEN 0 WHEN ceil(length(b) / 4.0) <= 60 THEN 1 ELSE 2 END::INT AS level, CASE WHEN ceil(length(a) / 4.0) <= 60 THEN a WHEN ceil(length(b) / 4.0) <= 60 THEN b ELSE 'b' || turn || ' ' || sha256(a) END AS form FROM f""")
def degraded_form(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    forms = c.select(F.concat_ws("|", "conv_id", "turn").alias("session_key"), F.col("text").alias("form0"), F.regexp_replace("text", "[aeiou ]", "").alias("form1"), F.concat(F.lit("b"), F.col("turn").cast("string"), F.lit(" "), F.sha2("text", 256)).alias("form2"))
    made = R.degraded_form(forms, 60)
    return made.select(F.split("session_key", r"\|")[0].alias("session_key"), F.split("session_key", r"\|")[1].cast("bigint").alias("turn"), "level", "form")


@query(f"""{_T}, l AS (SELECT session_key, turn_index, string_agg(tool_name || ' ' || tool_input, chr(10) ORDER BY seq) AS f, string_agg(tool_name || ' @L' || log_line, chr(10) ORDER BY seq) AS s FROM turned WHERE kind = 'tool_call' GROUP BY ALL),
h AS (SELECT t.session_key, t.turn_index, '#### b' || turn_index || ' · @L' || from_line || '–L' || to_line || CASE WHEN names IS NOT NULL THEN ' · ' || array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') ELSE '' END || CASE WHEN interrupted THEN chr(10) || '(turn cut off)' ELSE '' END AS head,
  chr(10) || '→ turn ' || turn_index || ' (' || kind || '), ' || CASE WHEN names IS NULL THEN 'no tools' ELSE 'tools: ' || array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') END || ', lines ' || from_line || '–' || to_line AS tail FROM turns t)
SELECT session_key, turn_index, head || coalesce(chr(10) || f, '') || tail AS form0, head || coalesce(chr(10) || s, '') || tail AS form1, head || tail AS form2 FROM h LEFT JOIN l USING (session_key, turn_index)""")
def grouped_forms(spark, d):
    entries = _events(spark, d)
    turned, turns = U.with_turns(entries, TURN_TOKENS), U.turns(entries, TURN_TOKENS)
    lines = turned.where("kind = 'tool_call'").select("session_key", "turn_index", F.col("seq").alias("pos"), F.concat_ws(" ", "tool_name", "tool_input").alias("text"), "tool_name", "log_line")
    return R.grouped_forms(turns, lines, M.floor_actions(turns).drop("fallback"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'anchor.fromLine outside the turn' WHEN 2 THEN 'anchor.toLine beyond the turn; action missing' WHEN 3 THEN 'action too long' WHEN 4 THEN 'no JSON object'
   ELSE 'anchor.toLine is no integer; thoughts[0].q is no quote of the turn; thoughts[1].kind must be H or ? if inferred; thoughts[2].source unknown; thoughts[2].text missing' END AS pass1,
 CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'verdict.status unknown; more than three items; items[3].title missing; items[3].polarity unknown' WHEN 2 THEN 'arcs is no array; verdict.why missing' ELSE 'arcs[1].status unknown; arcs[1].fromLine is no integer; items[0].subject is no array' END AS pass2,
 CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'goal missing; openHypotheses is no array; currentBelief missing; checkpoint is no object' ELSE 'goal too long; openHypotheses[1].text missing; checkpoint.files is no text; checkpoint.next too long' END AS digest FROM events""")
def contracts(spark, d):
    i = F.col("event_id")
    long = lambda n: F.repeat(F.lit("y"), F.lit(n))
    thoughts = '[{"kind":"H","source":"thinking","text":"t","q":"q9"},{"kind":"ALT","source":"inferred","text":"t"},{"kind":"H","source":"x","text":4}]'
    p1 = (
        F.when(i % 6 == 0, '{"anchor":{"fromLine":3,"toLine":9},"action":"x","thoughts":[{"kind":"?","source":"narration","text":"t","q":"q1"}]}').when(i % 6 == 1, '{"anchor":{"fromLine":1,"toLine":5},"action":"x"}')
        .when(i % 6 == 2, '{"anchor":{"fromLine":3,"toLine":99},"action":7}').when(i % 6 == 3, F.concat(F.lit('{"anchor":{"fromLine":3,"toLine":5},"action":"'), long(401), F.lit('"}'))).when(i % 6 == 4, "no")
        .otherwise(F.lit(f'{{"anchor":{{"fromLine":3,"toLine":"5"}},"action":"","thoughts":{thoughts}}}'))
    )
    item = '{"title":"t","description":"d","content":"c","polarity":"strategy","subject":["s"],"evidence":[{"line":1}]}'
    p2 = (
        F.when(i % 4 == 0, f'{{"arcs":[{{"kind":"H","status":"open","text":"t","fromLine":1}}],"verdict":{{"status":"success","why":"w"}},"items":[{item}]}}')
        .when(i % 4 == 1, f'{{"arcs":[],"verdict":{{"status":"odd","why":"w"}},"items":[{item},{item},{item},{{"description":"d","content":"c","polarity":"p","subject":[],"evidence":[]}}]}}')
        .when(i % 4 == 2, '{"arcs":{},"verdict":{"status":"partial"},"items":[]}')
        .otherwise('{"arcs":[{"kind":"H","status":"open","text":"t","fromLine":1},{"kind":"ALT","status":"maybe","text":"t","fromLine":1.5}],"verdict":{"status":"failure","why":"w"},"items":[' + item.replace('["s"]', '"s"') + "]}")
    )
    dig = (
        F.when(i % 3 == 0, '{"goal":"g","openHypotheses":[{"text":"h"}],"currentBelief":"b","checkpoint":{"intent":"i"}}').when(i % 3 == 1, '{"openHypotheses":"no","checkpoint":[]}')
        .otherwise(F.concat(F.lit('{"goal":"'), long(301), F.lit('","openHypotheses":[{"text":"h"},{}],"currentBelief":"b","checkpoint":{"files":[],"next":"'), long(601), F.lit('"}}')))
    )
    said = lambda errors: F.array_join(errors, "; ")
    # A row costs much more than its bytes tell: rows are dealt out evenly, and each answer is parsed once, before the rules.
    rows = _ev(spark, d).select("event_id").repartition(4 * spark.sparkContext.defaultParallelism, "event_id")
    parsed = rows.select("event_id", *(F.try_parse_json(x).alias(c) for x, c in ((p1, "v1"), (p2, "v2"), (dig, "v3"))))
    block = C.block_errors(F.col("v1"), F.lit(2), F.lit(7), F.array(F.lit("q1")))
    return parsed.select("event_id", said(block).alias("pass1"), said(C.analysis_errors(F.col("v2"))).alias("pass2"), said(C.digest_errors(F.col("v3"))).alias("digest"))


# Submissions for conversations, whose turns are a window each: right ones, and by conv_id % 6 a missing turn, an anchor off by a line,
# no digest, no JSON and thinking without a thought. Even turns think.
def _window_turns(spark, d):
    turns = U.turns(_talks(spark, d)).withColumnRenamed("session_key", "job_id")
    q = F.concat(F.lit("q"), F.col("turn_index").cast("string"))
    none = F.array().cast("array<string>")
    return turns.select("job_id", "turn_index", "from_line", "to_line", F.array(q).alias("quote_ids"), F.when(F.col("turn_index") % 2 == 0, F.array(q)).otherwise(none).alias("thinking_ids"))


def _submitted(spark, d):
    turns = written(_window_turns(spark, d))
    n, i = F.col("job_id").cast("bigint") % 6, F.col("turn_index")
    thought = F.struct(F.lit("H").alias("kind"), F.lit("thinking").alias("source"), F.lit("x").alias("text"), F.get("thinking_ids", F.lit(0)).alias("q"))
    thoughts = F.when((F.size("thinking_ids") > 0) & (n != 5), F.array(thought)).otherwise(F.array().cast(T_THOUGHTS))
    anchor = F.struct((F.col("from_line") - F.when((n == 2) & (i == 1), 1).otherwise(0)).alias("fromLine"), F.col("to_line").alias("toLine"))
    block = F.struct(i.alias("turnIndex"), anchor.alias("anchor"), F.format_string("did %d", i).alias("action"), thoughts.alias("thoughts"))
    gathered = turns.groupBy("job_id").agg(F.sort_array(F.collect_list(F.struct("turn_index", block.alias("b")))).alias("all"))
    blocks = F.transform(F.when(n == 1, F.slice("all", F.lit(1), F.size("all") - 1)).otherwise(F.col("all")), lambda x: x["b"])
    digest = F.struct(F.lit("g").alias("goal"), F.array().cast("array<string>").alias("openHypotheses"), F.lit("b").alias("currentBelief"))
    body = F.when(n == 4, "no").otherwise(F.concat(F.lit("Here:\n```json\n"), F.to_json(F.struct(blocks.alias("blocks"), F.when(n != 3, digest).alias("digest"))), F.lit("\n```")))
    subs = gathered.select("job_id", body.alias("body"))
    return subs, turns, gathered.select("job_id", (F.col("job_id").cast("bigint") % 12 >= 6).alias("last_window"), (F.col("job_id").cast("bigint") % 25).alias("fails"))


T_THOUGHTS = "array<struct<kind:string,source:string,text:string,q:string>>"
_VERDICTS = f"""{_TALK_TURNS}, j AS (SELECT session_key, session_key::BIGINT AS c, max(turn_index) AS last FROM turns GROUP BY ALL), t AS (SELECT * FROM turns JOIN j USING (session_key)),
m AS (SELECT session_key, 1 AS o, turn_index AS p, 'turn 1: must cover whole turns, lines ' || from_line || ' to ' || to_line AS said FROM t WHERE c % 6 = 2 AND turn_index = 1
UNION ALL SELECT session_key, 1, turn_index, 'turn ' || turn_index || ': thinking without a thought' FROM t WHERE c % 6 = 5 AND turn_index % 2 = 0
UNION ALL SELECT session_key, 2, turn_index, 'no block for turn ' || turn_index FROM t WHERE (c % 6 = 1 AND turn_index = last AND last > 1) OR (c % 6 = 2 AND turn_index = 1)
UNION ALL SELECT session_key, 3, 0, 'digest missing' FROM j WHERE c % 12 = 3
UNION ALL SELECT session_key, 0, 0, 'no JSON object' FROM j WHERE c % 6 = 4 UNION ALL SELECT session_key, 0, 0, 'no blocks' FROM j WHERE c % 6 = 1 AND last = 1),
verdicts AS (SELECT session_key AS job_id, c, count(said) = 0 AS accepted, coalesce(string_agg(said, chr(10) ORDER BY o, p), '') AS errors FROM j LEFT JOIN m USING (session_key) GROUP BY ALL)"""


@query(f"{_VERDICTS} SELECT job_id, accepted, errors FROM verdicts")
def window_verdicts(spark, d):
    subs, turns, jobs = _submitted(spark, d)
    made = B.window_verdicts(subs, turns, B.window_blocks(subs, turns), jobs)
    return made.withColumn("errors", F.array_join("errors", "\n"))


@query(f"{_VERDICTS} SELECT job_id, turn_index, from_line, to_line, 'did ' || turn_index AS action, false AS fallback FROM verdicts JOIN turns ON session_key = job_id WHERE accepted")
def sidecar_records(spark, d):
    subs, turns, jobs = _submitted(spark, d)
    blocks = B.window_blocks(subs, turns)
    made = B.sidecar_records(blocks, B.window_verdicts(subs, turns, blocks, jobs))
    return made.select("job_id", "turn_index", "from_line", "to_line", C.as_block(F.col("result"))["action"].alias("action"), "fallback")


@query(f"""{_VERDICTS} SELECT job_id, CASE WHEN accepted THEN 'submit-ok' ELSE 'submit-fail' END AS ev, 'now' AS ts, CASE WHEN NOT accepted THEN errors END AS errors FROM verdicts
UNION ALL SELECT job_id, 'release', 'now', NULL FROM verdicts WHERE NOT accepted AND c % 25 >= 19""")
def ledger_events(spark, d):
    subs, turns, jobs = _submitted(spark, d)
    made = B.ledger_events(B.window_verdicts(subs, turns, B.window_blocks(subs, turns), jobs), jobs, F.lit("now"))
    return made.withColumn("errors", F.array_join("errors", "\n"))


@query(f"""{_VERDICTS} SELECT job_id, accepted, CASE WHEN accepted THEN n ELSE 0 END AS blocks, CASE WHEN NOT accepted AND c % 25 >= 19 THEN 'release,submit-fail' WHEN accepted THEN 'submit-ok' ELSE 'submit-fail' END AS events
FROM verdicts JOIN (SELECT session_key, count(*) AS n FROM turns GROUP BY ALL) t ON t.session_key = job_id""")
def accepted_batches(spark, d):
    """All submissions in two batches, the first of them done twice, as records, metrics and ledger tell of them."""
    subs, turns, jobs = _submitted(spark, d)
    turns = turns.withColumn("slice_hash", F.concat(F.lit("h"), "turn_index"))
    out = f"{shared_dir(spark)}/sessionloom/{uuid.uuid4().hex}"
    for part in (0, 1, 0):
        V.accept(subs.where(F.col("job_id").cast("bigint") % 2 == part), turns, jobs, jobs, F.lit("now"), out, f"{part}")
    seen = V.accepted(spark, out)
    records = seen["records"].groupBy("job_id").agg(F.count("*").alias("blocks"))
    events = seen["ledger"].groupBy("job_id").agg(F.array_join(F.sort_array(F.collect_list("ev")), ",").alias("events"))
    return seen["metrics"].select("job_id", "accepted").join(records, "job_id", "left").join(events, "job_id").select("job_id", "accepted", F.coalesce("blocks", F.lit(0)).alias("blocks"), "events")


@query("""SELECT event_id::VARCHAR AS job_id, event_id % 3 <> 2 AS accepted, CASE WHEN event_id % 3 <> 2 THEN 'success' END AS status, CASE WHEN event_id % 3 <> 2 THEN (event_id % 3 + event_id % 5 > 0)::INT END AS arcs, CASE WHEN event_id % 3 <> 2 THEN (event_id % 3 + event_id % 5 = 0)::INT END AS dropped FROM events""")
def analysis_verdicts(spark, d):
    i = F.col("event_id")
    body = F.format_string('{"arcs":[{"kind":"H","status":"open","text":"t","fromLine":%d}],"verdict":{"status":"%s","why":"w"},"items":[]}', i % 3 + i % 5, F.when(i % 3 == 2, "odd").otherwise("success"))
    e = _ev(spark, d)
    made = B.analysis_verdicts(e.select(i.cast("string").alias("job_id"), body.alias("body")), e.select(i.cast("string").alias("job_id"), F.lit(9).alias("log_lines")))
    return made.select("job_id", "accepted", F.col("analysis.verdict.status").alias("status"), F.when(F.col("accepted"), F.size("analysis.arcs")).alias("arcs"), F.when(F.col("accepted"), F.col("dropped")).alias("dropped"))


@query(f"""{_TALK_TURNS.replace("conv_id::VARCHAR AS session_key, turn,", "conv_id::VARCHAR AS session_key, turn, CASE role WHEN 'user' THEN 'user_text' WHEN 'assistant' THEN 'assistant_text' ELSE 'system_note' END || ':' || (turn + 1) || ':' || CASE role WHEN 'system' THEN 0 ELSE length(text) END AS mark,")}
SELECT session_key, turn_index, string_agg(mark, '|' ORDER BY turn) AS slice FROM turned GROUP BY ALL""")
def slice_texts(spark, d):
    return U.slice_texts(_talks(spark, d)).select("session_key", "turn_index", "slice")


# A ledger from the events: a user's event type k % 4 of a job is a claim, a rejection, an acceptance or a release.
_LEDGER = """ledger AS (SELECT 'j' || (user_id * 10 + k % 10) AS job_id, event_id AS seq, CASE WHEN k % 4 = 0 THEN 'claim' WHEN k % 4 = 1 THEN 'submit-fail' WHEN k % 4 = 2 AND k % 3 = 0 THEN 'submit-ok' WHEN k % 4 = 3 AND k % 7 = 0 THEN 'release' ELSE 'submit-fail' END AS ev, 'w' || (event_id % 5) AS worker, event_id + 900 AS lease_until
 FROM (SELECT *, (props::JSON->>'$.k')::BIGINT AS k FROM events)),
f AS (SELECT job_id, arg_max(ev, seq) FILTER (ev <> 'submit-fail') AS ev, arg_max(worker, seq) FILTER (ev = 'claim') AS worker, arg_max(lease_until, seq) FILTER (ev = 'claim') AS lease_until, count(*) FILTER (ev = 'claim') AS claims, max(seq) FILTER (ev = 'claim') AS c FROM ledger GROUP BY job_id),
states AS (SELECT job_id, CASE f.ev WHEN 'claim' THEN 'claimed' WHEN 'submit-ok' THEN 'done' ELSE 'pending' END AS status, CASE WHEN f.ev = 'claim' THEN worker ELSE '' END AS worker, CASE WHEN f.ev = 'claim' THEN lease_until ELSE -1 END AS lease_until,
  (SELECT count(*) FROM ledger l WHERE l.job_id = f.job_id AND l.ev = 'submit-fail' AND l.seq > coalesce(f.c, -1)) AS fails, claims FROM f)"""
_JOBS = """jobs AS (SELECT 'j' || (user_id * 10 + n) AS job_id, CASE WHEN n = 9 THEN 'pass2' ELSE 'pass1' END AS layer, user_id::VARCHAR AS session_id, 'p' || (user_id % 7) AS project, CASE WHEN user_id % 6 = 0 THEN NULL ELSE (user_id * 37 % 101)::BIGINT END AS started_at, CASE WHEN n = 9 THEN 0 ELSE n END::BIGINT AS window_index, (user_id % 50 * 10 + n)::BIGINT AS tokens
 FROM (SELECT DISTINCT user_id FROM events), range(10) AS r(n))"""


def _ledger(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    ev = F.when(k % 4 == 0, "claim").when(k % 4 == 1, "submit-fail").when((k % 4 == 2) & (k % 3 == 0), "submit-ok").when((k % 4 == 3) & (k % 7 == 0), "release").otherwise("submit-fail")
    return _ev(spark, d).select(F.concat(F.lit("j"), (F.col("user_id") * 10 + k % 10).cast("string")).alias("job_id"), F.col("event_id").alias("seq"), ev.alias("ev"), F.concat(F.lit("w"), (F.col("event_id") % 5).cast("string")).alias("worker"), (F.col("event_id") + 900).alias("lease_until"))


def _jobs(spark, d):
    users = _ev(spark, d).select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("n"))
    u, n = F.col("user_id"), F.col("n")
    return users.select(F.concat(F.lit("j"), (u * 10 + n).cast("string")).alias("job_id"), F.when(n == 9, "pass2").otherwise("pass1").alias("layer"), u.cast("string").alias("session_id"), F.concat(F.lit("p"), (u % 7).cast("string")).alias("project"), F.when(u % 6 != 0, u * 37 % 101).alias("started_at"), F.when(n == 9, 0).otherwise(n).cast("bigint").alias("window_index"), (u % 50 * 10 + n).alias("tokens"))


@query(f"WITH {_LEDGER} SELECT * FROM states")
def job_states(spark, d):
    return K.job_states(_ledger(spark, d)).withColumns({"worker": F.coalesce("worker", F.lit("")), "lease_until": F.coalesce("lease_until", F.lit(-1))})


#: The clock of the lease queries.
NOW = 5_000
_ORDER = "started_at DESC NULLS LAST, project, session_id, layer, lpad(window_index::VARCHAR, 6, '0')"


@query(f"""WITH {_LEDGER}, {_JOBS}, r AS (SELECT j.*, coalesce(status, 'pending') AS status, coalesce(status = 'claimed' AND lease_until > {NOW}, false) AS active FROM jobs j LEFT JOIN states USING (job_id))
SELECT layer, count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (active) AS active, count(*) FILTER (status = 'claimed' AND NOT active) AS expired, count(*) FILTER (status = 'pending' OR status = 'claimed' AND NOT active) AS pending, coalesce(sum(tokens) FILTER (status = 'pending' OR status = 'claimed' AND NOT active), 0)::BIGINT AS tokens_pending FROM r GROUP BY layer""")
def layer_status(spark, d):
    return K.layer_status(_jobs(spark, d), K.job_states(_ledger(spark, d)), F.lit(NOW))


_CLAIMABLE = f"""WITH {_LEDGER}, {_JOBS}, r AS (SELECT j.*, coalesce(status = 'done', false) AS done, coalesce(status = 'claimed' AND lease_until > {NOW}, false) AS active FROM jobs j LEFT JOIN states USING (job_id)),
g AS (SELECT *, coalesce(lag(done) OVER (PARTITION BY session_id, layer ORDER BY window_index), true) AS before, sum(CASE WHEN layer = 'pass1' AND NOT done THEN 1 ELSE 0 END) OVER (PARTITION BY session_id) AS open1 FROM r),
c AS (SELECT job_id, layer, session_id, project, coalesce(started_at, -1) AS started_at, window_index, tokens FROM g WHERE NOT done AND NOT active AND CASE WHEN layer = 'pass1' THEN before ELSE open1 = 0 END)"""


@query(f"{_CLAIMABLE} SELECT * FROM c")
def claimable_jobs(spark, d):
    return K.claimable(_jobs(spark, d), K.job_states(_ledger(spark, d)), F.lit(NOW)).withColumn("started_at", F.coalesce("started_at", F.lit(-1)))


@query(f"{_CLAIMABLE} SELECT * FROM c ORDER BY {_ORDER} LIMIT 1")
def next_job(spark, d):
    return K.next_job(_jobs(spark, d), K.job_states(_ledger(spark, d)), F.lit(NOW)).withColumn("started_at", F.coalesce("started_at", F.lit(-1)))


@query(f"WITH {_JOBS} SELECT job_id, project, window_index FROM jobs WHERE layer = 'pass1' ORDER BY {_ORDER} LIMIT 20 OFFSET 40")
def layer_page(spark, d):
    return K.layer_page(_jobs(spark, d), "pass1", K.encode_cursor(40))[0].select("job_id", "project", "window_index")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'pass1' WHEN event_id % 3 = 1 THEN 'pass2' ELSE 'none' END AS layer, CASE WHEN event_id % 3 < 2 THEN substr(sha256(event_id::VARCHAR), 1, 16) ELSE '' END AS session_key, CASE WHEN event_id % 3 = 0 THEN event_id ELSE -1 END AS window_index FROM events")
def parse_job_ids(spark, d):
    i = F.col("event_id").cast("string")
    key = T.session_key(i)
    job = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("p1-"), key, F.lit("-w"), i)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("p2-"), key)).otherwise(F.concat(F.lit("p1-"), key))
    p = K.parse_job_id(job)
    return _ev(spark, d).select("event_id", F.coalesce(p["layer"], F.lit("none")).alias("layer"), F.coalesce(p["session_key"], F.lit("")).alias("session_key"), F.coalesce(p["window_index"], F.lit(-1)).alias("window_index"))


@query(r"""WITH i AS (SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm_title, text AS title, text AS description, source, CASE WHEN doc_id % 2 = 0 THEN 'strategy' ELSE 'guardrail' END AS polarity FROM documents)
SELECT norm_title, source AS subject0, arg_min(title, doc_id) AS title, arg_min(description, doc_id) AS description, arg_min(description, doc_id) AS content, arg_min(polarity, doc_id) AS polarity, source || ',x' AS subjects, count(*) AS evidence, min(doc_id) AS first_seen, max(doc_id) AS last_seen, CASE WHEN count(*) >= 3 THEN 'confirmed' ELSE 'candidate' END AS status FROM i GROUP BY ALL""")
def bank_merge(spark, d):
    return K.merge_bank(_items(spark, d)).withColumn("subjects", F.array_join("subjects", ","))


_BANK = ORACLES["bank_merge"]


@query(f"SELECT norm_title, subject0, '- **' || title || '** [' || polarity || '] (' || status || ', evidence ×' || evidence || ') — ' || description || ' · subjects: ' || subject0 || ', x' AS line FROM ({_BANK}) AS bank")
def bank_index(spark, d):
    return K.bank_index(K.merge_bank(_items(spark, d)))


@query(r"SELECT trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm_title, source AS subject0, doc_id AS seq, 't' || doc_id AS trace, 0 AS line FROM documents")
def bank_evidence(spark, d):
    return K.bank_evidence(_items(spark, d))


def _items(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select(F.col("text").alias("title"), F.col("text").alias("description"), F.col("text").alias("content"), F.when(F.col("doc_id") % 2 == 0, "strategy").otherwise("guardrail").alias("polarity"), F.array("source", F.lit("x")).alias("subject"), F.col("doc_id").alias("seen"), F.col("doc_id").alias("seq"), F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("trace"), F.lit(0).alias("line"))


@query("""WITH c AS (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'user') AS u, count(*) FILTER (role = 'system') AS s, sum(length(text))::BIGINT AS ch FROM conversations GROUP BY conv_id)
SELECT conv_id AS key, CASE WHEN n > 0 THEN floor(u / n * 1000 + 0.5) / 1000 ELSE 0 END AS coverage, CASE WHEN u > 0 THEN floor(s / u * 1000 + 0.5) / 1000 ELSE 0 END AS fallback_rate, CASE WHEN u > 0 THEN floor(n / u * 1000 + 0.5) / 1000 ELSE 0 END AS retry_rate, 0.0::DOUBLE AS dispute_rate,
 CASE WHEN u > 0 THEN 1.0::DOUBLE ELSE 0 END AS quote_rate, CASE WHEN n > 0 THEN floor(ch / n * 10 + 0.5) / 10 ELSE 0 END AS ratio FROM c""")
def pass_metrics(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    role = lambda r: F.count_if(F.col("role") == r)
    n = F.count("*")
    return K.rates(c.groupBy(F.col("conv_id").alias("key")).agg(n.alias("turns"), role("user").alias("blocks"), role("system").alias("fallbacks"), n.alias("retries"), F.lit(0).alias("disputes"), role("user").alias("quote_valid"), F.sum(F.length("text")).alias("orig_tokens"), n.alias("trace_tokens")))


@query("SELECT event_id, event_type AS log_file, event_id % 8 AS rank FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def first_per_path(spark, d):
    rows = _ev(spark, d).select("event_id", F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("log_file"), (F.col("event_id") % 8).alias("rank"))
    return K.first_per_path(rows, "event_id").withColumn("log_file", F.substring_index("log_file", "/", -1))


@query(rf"""WITH n AS (SELECT doc_id, {_SLUG.format('text', 40)} || '.md' AS base FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY doc_id) AS n FROM n)
SELECT doc_id, CASE WHEN n = 1 THEN base ELSE left(base, length(base) - 3) || '-' || n || '.md' END AS file_name FROM r""")
def unique_names(spark, d):
    names = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.concat(F.rtrim(F.left(F.btrim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", "-"), F.lit("-")), F.lit(40)), F.lit("-")), F.lit(".md")).alias("base"))
    return K.unique_names(names, "base", "doc_id").select("doc_id", "file_name")


@query()
def trace_markdown(spark, d):
    return M.traces(written(_events(spark, d)))


@query()
def turn_prompts(spark, d):
    entries = written(_events(spark, d))
    return M.turn_prompts(entries, U.with_turns(entries, TURN_TOKENS))
