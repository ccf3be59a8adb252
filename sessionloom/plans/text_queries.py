"""Queries over the text functions, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tools as C

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/conversations.parquet")


_SQ = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_HALF_UP = "printf('%.1f', floor(({0}) * 10 + 0.5) / 10)"


@query("SELECT conv_id, turn, ceil(length(text) / 4.0)::BIGINT AS tokens FROM conversations")
def est_tokens(spark, d):
    return _conversations(spark, d).select("conv_id", "turn", T.estimate_tokens(F.col("text")).alias("tokens"))


@query("SELECT doc_id, CASE WHEN length(text) <= 60 THEN text ELSE left(text, 40) || '…[' || (length(text) - 60) || ' chars dropped]…' || right(text, 20) END AS cut FROM documents")
def head_tail(spark, d):
    return _documents(spark, d).select("doc_id", T.head_tail(F.col("text"), 40, 20).alias("cut"))


@query(f"SELECT doc_id, CASE WHEN length({_SQ}) <= 80 THEN {_SQ} ELSE left({_SQ}, 79) || '…' END AS line FROM documents")
def cap_line(spark, d):
    return _documents(spark, d).select("doc_id", T.cap_line(F.col("text"), 80).alias("line"))


@query(r"""WITH one AS (SELECT doc_id, trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 50 THEN t ELSE left(t, 49) || '…' END AS line FROM one""")
def first_line(spark, d):
    return _documents(spark, d).select("doc_id", T.first_line(F.col("text"), 50).alias("line"))


@query(r"""WITH a AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents),
b AS (SELECT *, left(t, 200) AS cut FROM a), c AS (SELECT *, CASE WHEN contains(cut, chr(10)) THEN length(cut) - instr(reverse(cut), chr(10)) ELSE -1 END AS nl FROM b),
e AS (SELECT *, CASE WHEN nl > 100 THEN left(cut, nl) ELSE cut END AS kept FROM c)
SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE kept || chr(10) || '…[+' || (length(t) - length(kept)) || ' chars]' END AS block FROM e""")
def cap_block(spark, d):
    return _documents(spark, d).select("doc_id", T.cap_block(F.col("text"), 200).alias("block"))


@query(f"SELECT doc_id, '`' || replace(CASE WHEN length({_SQ}) <= 60 THEN {_SQ} ELSE left({_SQ}, 59) || '…' END, '`', chr(39)) || '`' AS code FROM documents")
def inline_code(spark, d):
    return _documents(spark, d).select("doc_id", T.inline_code(F.col("text"), 60).alias("code"))


@query("SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN length(x) > 50 THEN left(x, 50) || '…[+' || (length(x) - 50) || ' chars]' ELSE x END), chr(10)) ELSE text END AS capped FROM documents")
def cap_long_lines(spark, d):
    return _documents(spark, d).select("doc_id", T.cap_long_lines(F.col("text"), 50).alias("capped"))


def _centered_sql(head: int, tail: int) -> str:
    total = head + tail
    mark = lambda kept: f"'…⟨truncated: ' || n || '→' || ({kept}) || ' chars @L' || doc_id || '⟩'"
    long = "CASE WHEN contains({0}, chr(10)) THEN array_to_string(list_transform(string_split({0}, chr(10)), lambda x: CASE WHEN length(x) > 2000 THEN left(x, 2000) || '…[+' || (length(x) - 2000) || ' chars]' ELSE x END), chr(10)) ELSE {0} END"
    return rf"""
    WITH a AS (SELECT doc_id, text, length(text) AS n, CASE WHEN regexp_matches(right(text, 2048), '(?i)\b(error|exception|failed|fatal|traceback|panic|exit code|errno|denied)\b') THEN 0.3::DOUBLE ELSE 0.7::DOUBLE END AS share FROM documents),
    b AS (SELECT *, {total} - length({mark(total)}) AS room FROM a),
    c AS (SELECT *, floor(room * share)::INT AS h, (room - floor(room * share))::INT AS t FROM b),
    e AS (SELECT *, {long.format("left(text, h)")} AS p, {long.format("right(text, t)")} AS q FROM c),
    f AS (SELECT *, CASE WHEN contains(p, chr(10)) THEN length(p) - instr(reverse(p), chr(10)) ELSE -1 END AS pn, instr(q, chr(10)) AS qn FROM e),
    g AS (SELECT *, CASE WHEN pn > h * 0.5 THEN left(text, pn + 1) ELSE p END AS b1, CASE WHEN qn > 0 AND qn - 1 < t * 0.5 THEN substr(q, qn + 1) ELSE q END AS e1 FROM f),
    o AS (SELECT *, b1 || {mark("length(b1) + length(e1)")} || e1 AS made FROM g)
    SELECT doc_id, CASE WHEN n <= {total} OR length(made) >= n THEN text ELSE made END AS cut FROM o"""


@query(_centered_sql(200, 100))
def truncate_centered(spark, d):
    return _documents(spark, d).select("doc_id", T.truncate_centered(F.col("text"), 200, 100, F.col("doc_id")).alias("cut"))


@query(f"""WITH b AS (SELECT doc_id, n_chars, substr(sha256(text), 1, 8) AS hash, CASE WHEN n_chars < 1024 THEN n_chars || 'B' WHEN n_chars < 1048576 THEN {_HALF_UP.format("n_chars / 1024.0")} || 'kB' ELSE {_HALF_UP.format("n_chars / 1048576.0")} || 'MB' END AS size,
len(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS n_lines FROM documents)
SELECT doc_id, hash, size, n_lines::INT AS n_lines, '…⟨' || size || ', ' || n_lines || ' ln, #' || hash || ', @L' || doc_id || '⟩' AS tomb, '@L' || doc_id AS tag, CASE WHEN n_lines = 1 THEN '@L' || 1 ELSE '@L1–L' || n_lines END AS span FROM b""")
def references(spark, d):
    lines = T.count_lines(F.col("text"))
    rows = _documents(spark, d).select("doc_id", T.short_hash(F.col("text")).alias("hash"), T.format_bytes(F.col("n_chars")).alias("size"), lines.alias("n_lines"), "n_chars")
    return rows.withColumns({"tomb": T.tombstone(F.col("n_chars"), F.col("n_lines"), F.col("hash"), F.col("doc_id")), "tag": T.ref_tag(F.col("doc_id")), "span": T.ref_range(F.lit(1), F.col("n_lines"))}).drop("n_chars")


_CODES = "list_transform(range(1, length({0}) + 1), lambda i: unicode(substr({0}, i, 1))::BIGINT)"


@query(rf"""WITH s AS (SELECT conv_id, turn, {_SQ} AS t FROM conversations)
SELECT conv_id, turn, 'q' || substr(lpad(lower(to_hex(list_reduce(list_prepend(2166136261::BIGINT, {_CODES.format("t")}), lambda h, c: (xor(h, c) * 16777619) & 4294967295))), 8, '0'), 1, 6) AS q FROM s""")
def quote_id(spark, d):
    return _conversations(spark, d).select("conv_id", "turn", T.quote_id(F.col("text")).alias("q"))


@query(rf"""WITH s AS (SELECT conv_id, turn, text AS t FROM conversations), c AS (SELECT conv_id, turn, {_CODES.format("t")} AS cs FROM s)
SELECT conv_id, turn, lower(to_hex(list_reduce(list_prepend(2166136261::BIGINT, cs), lambda h, c: (xor(h, c) * 16777619) & 4294967295))) ||
  lower(to_hex((list_reduce(list_prepend({{'b': 16777619::BIGINT, 'i': 0::BIGINT}}, list_transform(range(1, len(cs) + 1), lambda i: {{'b': cs[i], 'i': i}})), lambda s, x: {{'b': (((s.b + x.b * x.i) % 4294967296)::HUGEINT * 2246822507 % 4294967296)::BIGINT, 'i': 0::BIGINT}})).b)) AS h FROM c""")
def slice_hash(spark, d):
    return _conversations(spark, d).select("conv_id", "turn", T.slice_hash(F.col("text")).alias("h"))


@query(rf"""WITH s AS (SELECT conv_id, turn, text AS t FROM conversations), c AS (SELECT conv_id, turn, {_CODES.format("t")} AS cs FROM s)
SELECT conv_id, turn, lower(to_hex(list_reduce(list_prepend(2166136261::BIGINT, cs), lambda h, c: (xor(h, c) * 16777619) & 4294967295))) ||
  lower(to_hex((list_reduce(list_prepend({{'b': 16777619::BIGINT, 'i': 0::BIGINT}}, list_transform(range(1, len(cs) + 1), lambda i: {{'b': cs[i], 'i': i}})), lambda s, x: {{'b': (((s.b + x.b * x.i) % 4294967296)::HUGEINT * 2246822507 % 4294967296)::BIGINT, 'i': 0::BIGINT}})).b)) AS h FROM c""")
def slice_hash_whole(spark, d):
    return _conversations(spark, d).select("conv_id", "turn", T.slice_hash(F.col("text")).alias("h"))


_SLUG = r"rtrim(left(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), {1}), '-')"


@query(rf"SELECT doc_id, CASE WHEN {_SLUG.format('text', 40)} <> '' THEN {_SLUG.format('text', 40)} ELSE 'session' END AS slug FROM documents")
def slugify(spark, d):
    return _documents(spark, d).select("doc_id", T.slugify(F.col("text")).alias("slug"))


@query(rf"""WITH c AS (SELECT conv_id, list(sha256(role || turn) ORDER BY turn) AS ids, min_by(text, turn) AS title FROM conversations GROUP BY conv_id)
SELECT conv_id, '1970-01-01-' || array_to_string(list_transform(ids[1:3], lambda x: left(x, 8)), '+') || CASE WHEN len(ids) > 3 THEN '+etc' ELSE '' END || '-' || CASE WHEN {_SLUG.format('title', 40)} <> '' THEN {_SLUG.format('title', 40)} ELSE 'session' END || '.md' AS file FROM c""")
def trace_file_name(spark, d):
    ident = F.sha2(F.concat("role", F.col("turn").cast("string")), 256)
    rows = _conversations(spark, d).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", ident.alias("i")))), lambda x: x["i"]).alias("ids"), F.min_by("text", "turn").alias("title"))
    return rows.select("conv_id", T.trace_file_name(F.lit(None).cast("string"), F.col("ids"), F.col("title")).alias("file"))


@query(rf"""WITH p AS (SELECT page_id, url, list_last(string_split(rtrim(url, '/'), '/')) AS base FROM pages)
SELECT page_id, substr(sha256(url), 1, 16) AS key, CASE WHEN {_SLUG.format('base', 50)} <> '' THEN {_SLUG.format('base', 50)} ELSE 'session' END AS project FROM p""")
def session_names(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", T.session_key(F.col("url")).alias("key"), T.project_slug(F.col("url")).alias("project"))


@query(f"""WITH e AS (SELECT event_id, (epoch_us(ts) // 1000) AS ms, event_id * 137 AS n FROM events)
SELECT event_id, strftime(make_timestamp(ms * 1000), '%H:%M') AS clock, strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
 CASE WHEN n < 60000 THEN floor(n / 1000.0 + 0.5)::BIGINT || 's' ELSE (n // 60000) || 'm' || CASE WHEN floor((n % 60000) / 1000.0 + 0.5) > 0 THEN ' ' || floor((n % 60000) / 1000.0 + 0.5)::BIGINT || 's' ELSE '' END END AS took,
 CASE WHEN n < 1000 THEN n::VARCHAR WHEN n < 100000 THEN {_HALF_UP.format("n / 1000.0")} || 'k' ELSE floor(n / 1000.0 + 0.5)::BIGINT || 'k' END AS num,
 CASE WHEN event_id = 1 THEN '1 event' ELSE event_id || ' events' END AS many FROM e""")
def formats(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    n = F.col("event_id") * 137
    rows = spark.read.parquet(f"{d}/events.parquet").withColumn("iso", T.iso_from_millis(ms))
    return rows.select("event_id", T.hhmm(F.col("iso")).alias("clock"), "iso", T.fmt_duration(n).alias("took"), T.fmt_number(n).alias("num"), T.plural(F.col("event_id"), "event", "events").alias("many"))


#: Tool calls to classify: names and inputs by event, fixed values.
TOOLS = ["Read", "Grep", "Edit", "Bash", "WebFetch", "Task", "mcp__git__status", "skills", "apply_patch", "Write"]
_TOOL_SQL = "CASE event_id % 10 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TOOLS)) + " END"
_FAMILY_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(name), '{p}') THEN '{f}'" for f, p in C.FAMILIES) + " ELSE 'other' END"


def _tool_rows(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    name = F.element_at(F.array(*map(F.lit, TOOLS)), (F.col("event_id") % 10 + 1).cast("int"))
    return e.select("event_id", name.alias("name"), F.get_json_object("props", "$.k").alias("k"))


@query(f"WITH t AS (SELECT event_id, {_TOOL_SQL} AS name FROM events) SELECT event_id, name, {_FAMILY_SQL} AS family, CASE WHEN starts_with(name, 'mcp__') THEN 'mcp:' || replace(substr(name, 6), '__', '/') ELSE name END AS shown FROM t")
def classify_tool(spark, d):
    return _tool_rows(spark, d).select("event_id", "name", C.classify_tool(F.col("name")).alias("family"), T.display_name(F.col("name")).alias("shown"))


@query(f"""WITH t AS (SELECT event_id, {_TOOL_SQL} AS name, props::JSON->>'$.k' AS k FROM events)
SELECT event_id, name || '::' || CASE name WHEN 'Read' THEN '/a/' || k || ':' || k || '-' || (k::BIGINT + 7) WHEN 'Edit' THEN '/a/' || k WHEN 'Write' THEN '/a/' || k WHEN 'Bash' THEN 'make ' || k WHEN 'Grep' THEN 'p' || k || ' in /a/' || k
  WHEN 'WebFetch' THEN 'http://' || k WHEN 'Task' THEN 'do ' || k ELSE 'make ' || k END AS key FROM t""")
def call_keys(spark, d):
    k = F.col("k")
    given = F.concat(F.lit('{"offset":'), k, F.lit(',"limit":7,"pattern":"p'), k, F.lit('","path":"/a/'), k, F.lit('","command":"make '), k, F.lit('","url":"http://'), k, F.lit('","description":"do '), k, F.lit('"}'))
    rows = _tool_rows(spark, d).withColumn("given", F.when(F.col("name").isin("Edit", "Write"), F.concat(F.lit('{"file_path":"/a/'), k, F.lit('"}'))).otherwise(given))
    return rows.select("event_id", C.call_key(F.col("name"), C.tool_signature(F.col("name"), F.col("given"))).alias("key"))


@query("SELECT event_id, (k % 4 - k % 3)::BIGINT AS edit_added, (k % 5 + 1)::BIGINT AS write_added, (k % 3 + 1)::BIGINT AS patch_added, (k % 2)::BIGINT AS patch_removed, '/a/' || k AS patch_path FROM (SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events)")
def diffs(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    path = F.concat(F.lit("/a/"), k.cast("string"))
    text = lambda n: F.concat(F.lit("x"), F.repeat(F.lit("\\ny"), n))
    edit = F.concat(F.lit('{"file_path":"f","old_string":"'), text(k % 3), F.lit('","new_string":"'), text(k % 4), F.lit('"}'))
    write = F.concat(F.lit('{"file_path":"f","content":"'), text(k % 5), F.lit('"}'))
    patch = F.concat(F.lit("*** Begin Patch\n*** Update File: "), path, F.lit("\n@@\n"), F.repeat(F.lit("+new\n"), k % 3 + 1), F.repeat(F.lit("-old\n"), k % 2), F.lit("*** End Patch"))
    e, w, p = C.edit_diff(F.lit("Edit"), edit), C.edit_diff(F.lit("Write"), write), C.patch_diff(patch)
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", e["added"].alias("edit_added"), w["added"].alias("write_added"), p["added"].alias("patch_added"), p["removed"].alias("patch_removed"), p["file_path"].alias("patch_path"))


@query("""WITH t AS (SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events)
SELECT event_id, CASE WHEN k = 0 THEN -1 ELSE CASE k % 5 WHEN 0 THEN k % 7 + k WHEN 1 THEN k + k % 4 WHEN 2 THEN k + k % 3 WHEN 3 THEN 0 ELSE -1 END END::BIGINT AS run, CASE WHEN k = 0 THEN -1 ELSE CASE k % 5 WHEN 0 THEN k % 7 WHEN 1 THEN k % 4 WHEN 2 THEN k % 3 WHEN 3 THEN 2 ELSE -1 END END::BIGINT AS failed,
 CASE WHEN k = 0 THEN NULL ELSE CASE k % 5 WHEN 3 THEN 'TestA,TestB' WHEN 1 THEN 'tests/t.py::x' WHEN 4 THEN NULL ELSE '' END END AS names FROM t""")
def detect_checks(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    out = (
        F.when(k % 5 == 0, F.format_string("Tests:  %d failed | %d passed (9)", k % 7, k)).when(k % 5 == 1, F.format_string("FAILED tests/t.py::x\n== %d passed, %d failed in 0.3s", k, k % 4))
        .when(k % 5 == 2, F.format_string("x\ntest result: ok. %d passed; %d failed; 0 ignored", k, k % 3)).when(k % 5 == 3, F.lit("--- FAIL: TestA\nok\n--- FAIL: TestB")).otherwise(F.lit("nothing here"))
    )
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_id", C.detect_checks(out).alias("c"))
    return rows.select("event_id", F.coalesce("c.run", F.lit(-1)).alias("run"), F.coalesce("c.failed", F.lit(-1)).alias("failed"), F.array_join("c.failed_names", ",").alias("names"))


@query("SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN props WHEN event_id % 4 = 2 THEN NULL ELSE '{\"a\":1}' END AS found FROM events")
def extract_json(spark, d):
    i = F.col("event_id") % 4
    said = F.when(i == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nbye"))).when(i == 1, F.concat(F.lit("so "), "props", F.lit(" done"))).when(i == 2, F.lit("[1, 2] and {broken")).otherwise(F.lit('```\n{"a":1}\n``` {"b":2}'))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", T.extract_json_object(said).alias("found"))


@query("SELECT event_id, 3 AS code, 'body ' || event_id AS body FROM events")
def exec_output(spark, d):
    out = F.concat(F.lit("Chunk ID: 1\nWall time: 2\nProcess exited with code 3\nOriginal token count: 9\nOutput\nbody "), F.col("event_id").cast("string"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", C.exit_code(out).alias("code"), C.strip_exec_header(out).alias("body"))


@query("SELECT conv_id, turn, regexp_replace(text, '^\\s+', '') AS bare, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS clean FROM conversations")
def envelopes(spark, d):
    wrapped = F.concat(F.lit("  <system-reminder>a\nb</system-reminder>\n<background-task-finished>x</background-task-finished> "), "text")
    noisy = F.concat(F.lit("<system-reminder>a\nb</system-reminder>"), "text", F.lit("\n<local-command-caveat>c</local-command-caveat>"))
    return _conversations(spark, d).select("conv_id", "turn", T.strip_envelopes(wrapped).alias("bare"), T.clean_user_text(noisy).alias("clean"))


@query("SELECT page_id, '- [x](~/k' || page_id || ') src/a.py ok' || chr(10) || chr(10) || '## Notes' || chr(10) || 'see ./b ~/c' AS md FROM pages")
def repo_bound(spark, d):
    i = F.col("page_id").cast("string")
    md = F.concat(F.lit("- [x](/home/ann/k"), i, F.lit(") /srv/app/src/a.py ok @L"), i, F.lit("–L9\n\n\n\n## Notes\nsee /srv/app/b /root/c"))
    md = F.regexp_replace(md, "see /srv/app/b", "see /srv/app/./b")
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", T.repo_bound(md, "/srv/app/", "/root").alias("md"))
