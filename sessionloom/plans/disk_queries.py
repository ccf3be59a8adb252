"""Queries that write conversations and texts as files into the shared folder and read them back from disk."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sessions as H
from ..sources import chats, discovery, export
from ..sources import logs as L
from ..storage import shared_dir
from .log_queries import _EXPECTED, _TALKS, KEPT, KINDS, _json, _lines, _o

QUERIES, ORACLES = {}, {}


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/sessionloom/{uuid.uuid4().hex}"


def _register(name, query, sql):
    QUERIES[name], ORACLES[name] = query, sql


def log_ranges(spark, d):
    """Texts as the lines of one log for each source, read in ranges of 64 KiB."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    end = F.when(F.col("doc_id") % 5 == 0, "\r\n").otherwise("\n")
    body = F.concat(F.coalesce("text", F.lit("")), end, F.when(F.col("doc_id") % 7 == 0, end).otherwise(""))
    folder = _folder(spark)
    export.write_files(docs.select(F.concat(F.coalesce("source", F.lit("none")), F.lit(".jsonl")).alias("path"), F.col("doc_id").alias("place"), body.alias("body")), folder)
    lines = L.read_lines(spark, folder, range_bytes=64 << 10)
    name = F.substring_index("log_file", "/", -1)
    return lines.select(F.left(name, F.length(name) - F.lit(len(".jsonl"))).alias("log"), "log_line", "raw")


_register("log_ranges", log_ranges, r"""WITH b AS (SELECT coalesce(source, 'none') AS log, doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 5 = 0 THEN chr(13) || chr(10) ELSE chr(10) END AS e FROM documents),
w AS (SELECT log, string_split(string_agg(t || e || CASE WHEN doc_id % 7 = 0 THEN e ELSE '' END, '' ORDER BY doc_id), chr(10)) AS ls FROM b GROUP BY log),
l AS (SELECT log, unnest(range(1, len(ls) + 1)) AS log_line, unnest(ls) AS x FROM w), r AS (SELECT log, log_line, CASE WHEN ends_with(x, chr(13)) THEN left(x, length(x) - 1) ELSE x END AS raw FROM l)
SELECT log, log_line, raw FROM r WHERE trim(raw, ' ') <> ''""")  # fmt: skip

#: Kind: where its log of conversation %d lies below the kind's root.
PLACES = {
    "claude": "p/%d.jsonl", "codex": "2024/05/01/%d.jsonl", "pi": "--w--/%d.jsonl", "qwen": "p/chats/%d.jsonl", "kimi_wire": "0a/%d/wire.jsonl", "kimi_events": "wd_w_0123456789ab/session_%d/agents/main/wire.jsonl",
    "minimax": "2024/x-session_%d/messages.jsonl", "cursor": "%d.jsonl",
}


def _conv() -> Column:
    """The number of the conversation that a log's path names."""
    return F.regexp_extract("log_file", r"/(?:session_|x-session_)?(\d+)(?:\.jsonl|/wire\.jsonl|/messages\.jsonl|/agents/main/wire\.jsonl)$", 1)


def _on_disk(spark, d, kinds) -> list[discovery.Root]:
    folder = _folder(spark)
    number = F.regexp_extract("log_file", r"(\d+)\.jsonl$", 1).cast("long")
    # Lines without a record are blank here: a log's lines must keep their numbers.
    rows = [_lines(spark, d, k).select(F.concat(F.lit(f"{k}/"), F.format_string(PLACES[k], number)).alias("path"), F.col("log_line").alias("place"), F.concat(F.regexp_replace("raw", "[\r\n]", " "), F.lit("\n")).alias("body")) for k in kinds]
    export.write_files(reduce(DataFrame.unionByName, rows), folder)
    return [discovery.Root(KINDS[k][0], f"{folder}/{k}") for k in kinds]


def _disk_logs(kinds):
    def query(spark, d):
        entries, sessions = discovery.read(spark, _on_disk(spark, d, kinds))
        named = sessions.select("session_key", "source", T.session_key(F.concat(F.lit("/logs/"), _conv(), F.lit(".jsonl"))).alias("own"))
        rows = entries.join(named, "session_key").withColumn("session_key", F.col("own"))
        return rows.select("source", *KEPT)

    return query


for _name, _kinds in {"disk_entries": ("claude", "codex", "pi", "qwen"), "disk_entries_beside": ("kimi_events", "minimax", "cursor")}.items():
    _register(_name, _disk_logs(_kinds), " UNION ALL ".join(f"SELECT '{KINDS[k][0]}' AS source, * FROM ({_EXPECTED[k]})" for k in _kinds))


def disk_sessions(spark, d):
    """What is known of logs whose kinds keep ids in folders' names; the first root claims a log that several hold."""
    roots = _on_disk(spark, d, ("kimi_wire", "kimi_events", "minimax"))
    _, sessions = discovery.read(spark, [*roots, discovery.Root("cursor", roots[0].path)])
    return sessions.select("source", _conv().alias("conv"), "session_id", "role", "cwd", "model", "log_lines", "started_at", "ended_at")


_register("disk_sessions", disk_sessions, f"""WITH {_TALKS}, k(kind, source, users_model, ends) AS (VALUES ('w', 'kimi', '', true), ('e', 'kimi', 'user', true), ('m', 'minimax', 'assistant', true))
SELECT source, conv_id::VARCHAR AS conv, conv_id::VARCHAR AS session_id, 'main' AS role, '/w/' || conv_id AS cwd, CASE WHEN count(*) FILTER (role = users_model) > 0 THEN 'm-1' END AS model, 4 * max(turn) + 5 AS log_lines, min(ts) AS started_at, max(ts) AS ended_at
FROM c, k GROUP BY kind, source, users_model, conv_id""")  # fmt: skip


def disk_census(spark, d):
    """Which logs lie under a working directory, told from their first bytes: claude's after a preamble, codex's and pi's in the header."""
    talks = spark.read.parquet(f"{d}/conversations.parquet")
    talks = talks.select("*", F.when(F.col("conv_id") % 5 != 0, F.format_string("/w/%d/%d", F.col("conv_id") % 3, F.col("conv_id"))).alias("cwd"))
    n = F.col("conv_id")
    head = {
        "claude": ("p/%d.jsonl", _json(type="summary", cwd=F.col("cwd"))), "codex": ("2024/05/01/%d.jsonl", _json(type="session_meta", payload=_o(cwd=F.col("cwd")))), "pi": ("--w--/%d.jsonl", _json(type="session", cwd=F.col("cwd"))),
    }
    rows = []
    for kind, (place, header) in head.items():
        path = F.concat(F.lit(f"{kind}/"), F.format_string(place, n))
        at = F.lit(10_000_000 if kind == "claude" else -1).cast("long")
        rows.append(talks.select(path.alias("path"), F.col("turn").cast("long").alias("place"), F.concat(_json(type="said", text=F.col("text")), F.lit("\n")).alias("body")))
        rows.append(talks.select(path.alias("path"), at.alias("place"), F.concat(header, F.lit("\n")).alias("body")).distinct())
    folder = _folder(spark)
    export.write_files(reduce(DataFrame.unionByName, rows), folder)
    found = discovery.census(spark, [discovery.Root(k, f"{folder}/{k}") for k in head], under="/w/1")
    return found.select("source", _conv().alias("conv"), "cwd", "skipped", F.when(F.col("source") != "claude", F.col("read_bytes") <= 8192).alias("short"))


_register("disk_census", disk_census, """WITH c AS (SELECT DISTINCT conv_id FROM conversations), k(source) AS (VALUES ('claude'), ('codex'), ('pi')),
w AS (SELECT source, conv_id, CASE WHEN conv_id % 5 <> 0 THEN '/w/' || conv_id % 3 || '/' || conv_id END AS cwd FROM c, k)
SELECT source, conv_id::VARCHAR AS conv, cwd, CASE WHEN cwd IS NULL THEN 'no cwd' WHEN conv_id % 3 <> 1 THEN 'elsewhere' END AS skipped, CASE WHEN source <> 'claude' THEN true END AS short FROM w""")


def exported_chats(spark, d):
    """Chats exported twice: the second time all files stay; each log is then paired with its meta file."""
    lines = _lines(spark, d, "cursor").withColumn("log_file", F.regexp_extract("log_file", r"(\d+)\.jsonl$", 1)).withColumn("raw", F.regexp_replace("raw", "[\r\n]", " "))
    meta = lines.groupBy(F.col("log_file").alias("chat")).agg(F.count("*").alias("msgCount")).withColumn("title", F.concat(F.lit("chat "), "chat"))
    folder = _folder(spark)
    runs = [chats.export_chats(lines, meta, folder).select(F.lit(n).alias("run"), "path", "kept") for n in (1, 2)]
    logs = L.read_lines(spark, folder).where(F.endswith("log_file", F.lit(".jsonl"))).select("log_file").distinct()
    told = spark.read.text(folder, wholetext=True, pathGlobFilter="*.meta.json").select(F.col("_metadata.file_path").alias("meta_file"), F.get_json_object("value", "$.msgCount").cast("bigint").alias("lines"))
    pairs = H.with_meta(logs, told).select(F.concat("stem", F.lit(".jsonl")).alias("path"), "lines")
    return runs[0].unionByName(runs[1]).join(pairs, "path", "left").select("run", "path", "kept", "lines")


_register("exported_chats", exported_chats, """WITH c AS (SELECT conv_id, 4 * count(*) + max((turn = 0)::INT) AS lines FROM conversations GROUP BY conv_id)
SELECT run, conv_id || ending AS path, run = 2 AS kept, CASE WHEN ending = '.jsonl' THEN lines END AS lines FROM c, (VALUES (1), (2)) AS r(run), (VALUES ('.jsonl'), ('.meta.json')) AS e(ending)""")
