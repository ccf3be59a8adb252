"""Where logs lie, and the inventory of all of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.work import first_per_path
from ..storage import written
from . import logs, sniff

#: Path patterns of each kind of log below its root, in the order in which kinds claim a file (fixed values).
PATTERNS = {
    "claude": r"/[^/]+/[^/]+\.jsonl$",
    "codex": r"/\d{4}/\d{2}/\d{2}/[^/]+\.jsonl$",
    "pi": r"/--[^/]*--/[^/]+\.jsonl$",
    "qwen": r"/chats/(?![^/]*\.ledger\.)[^/]+\.jsonl$",
    "kimi": r"/wire\.jsonl$",
    "minimax": r"/messages\.jsonl$",
    "cursor": r"/[^/]+\.jsonl$",
}
#: Folders that hold no logs, and files that the engine writes beside logs (fixed values).
SKIPPED = r"/(node_modules|\.git|vendor|dist)/|\.sidecar\.jsonl$"


@dataclass(frozen=True)
class Root:
    source: str
    path: str


def files(spark: SparkSession, *roots: Root) -> DataFrame:
    """(rank, source, log_file, log_bytes, log_mtime): non-empty logs of each root's kind; file contents are not read."""
    if all(sniff.opens(r.path) for r in roots):
        listed = sniff.tree(spark, [r.path for r in roots]).withColumnRenamed("root", "rank")
    else:  # a store that only Spark reads: the listing is the driver's
        meta = lambda c: F.col(f"_metadata.{c}")
        load = lambda p: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(p)
        parts = [load(r.path).select(F.lit(i).alias("rank"), meta("file_path").alias("log_file"), meta("file_size").alias("log_bytes"), meta("file_modification_time").alias("log_mtime")) for i, r in enumerate(roots)]
        listed = reduce(DataFrame.unionByName, parts)
    source, fits = F.lit(None).cast("string"), F.lit(False)
    for i, root in enumerate(roots):
        own = F.col("rank") == i
        source, fits = F.when(own, root.source).otherwise(source), F.when(own, F.col("log_file").rlike(PATTERNS[root.source])).otherwise(fits)
    found = listed.where((F.col("log_bytes") > 0) & F.endswith("log_file", F.lit(".jsonl")) & fits & ~F.col("log_file").rlike(SKIPPED))
    return found.select("rank", source.alias("source"), "log_file", "log_bytes", "log_mtime")


def inventory(spark: SparkSession, roots: list[Root], only: str | None = None) -> DataFrame:
    """(session_key, source, log_file, log_bytes, log_mtime) of all roots; a file belongs to the first kind that claims it."""
    union = files(spark, *roots)
    if only:
        union = union.where(F.contains("log_file", F.lit(only)))
    return first_per_path(union, "rank").select(T.session_key(F.col("log_file")).alias("session_key"), "source", "log_file", "log_bytes", "log_mtime")


def stale(found: DataFrame, known: DataFrame) -> DataFrame:
    """Logs of an inventory that ``known`` (an earlier one) lacks or has with another size or time."""
    return found.join(known.select("session_key", "log_bytes", "log_mtime"), ["session_key", "log_bytes", "log_mtime"], "left_anti")


def refs(spark: SparkSession, roots: list[Root], listed: DataFrame, stamps: bool = True) -> DataFrame:
    """(log_file, ref_id, ref_role, ref_cwd, ref_hint, ref_started, ref_ended): what stands beside the logs of kinds that keep it there. Without
    ``stamps`` no log is opened.

    kimi: role and id from the folders, the working directory from ``state.json`` or, as a hint, its last part from the
    folder's name, first and last time from the log's edges. minimax: id and times from ``manifest.json``, else the id from the folder's name.
    """
    none = F.lit(None).cast("string")
    own = listed.where(F.col("source").isin("kimi", "minimax")).select("source", "log_file")
    up = lambda n: F.regexp_replace("log_file", f"(/[^/]+){{{n}}}$", "")
    name = lambda c: F.substring_index(c, "/", -1)
    nested = F.col("log_file").rlike(r"/wd_[^/]*/session_[^/]+/agents/[^/]+/wire\.jsonl$")
    under = F.col("log_file").rlike(r"/[^/]+/subagents/[^/]+/wire\.jsonl$")
    folder = F.when(nested, up(3)).otherwise(up(1))
    kimi_id = F.when(nested, F.regexp_replace(name(up(3)), "^session_", "")).when(under, F.concat(name(up(3)), F.lit("/"), name(up(1)))).otherwise(name(up(1)))
    hint = F.when(nested, F.nullif(F.regexp_replace(F.regexp_replace(name(up(4)), "^wd_", ""), "_[0-9a-f]{8,16}$", ""), F.lit("")))
    kimi = F.col("source") == "kimi"
    suffix = F.regexp_extract(name(up(1)), r"^.*-session_(.+)$", 1)
    plain = F.try_to_binary(F.concat(suffix, F.repeat(F.lit("="), F.pmod(-F.length(suffix), F.lit(4)))), F.lit("base64")).cast("string")
    minimax_id = F.when(suffix == "", name(up(1))).when(plain.rlike(r"^[\x20-\x7e]+$"), plain).otherwise(suffix)
    role = F.when(kimi & ((nested & (name(up(1)) != "main")) | under), "subagent").otherwise("main")
    rows = own.select("source", "log_file", folder.alias("folder"), F.when(kimi, kimi_id).otherwise(minimax_id).alias("own_id"), role.alias("ref_role"), hint.alias("ref_hint"))
    if not any(r.source in ("kimi", "minimax") for r in roots):
        return rows.select("log_file", F.col("own_id").alias("ref_id"), "ref_role", none.alias("ref_cwd"), "ref_hint", none.alias("ref_started"), none.alias("ref_ended")).limit(0)
    # Fields and times are taken before the joins, so neither files nor edges are joined; for the hints see logs.JOIN.
    field = lambda p: F.nullif(F.get_json_object("body", f"$.{p}"), F.lit(""))
    stamp = lambda p: T.iso_from_millis(field(p).try_cast("double"))
    beside = sniff.beside(rows.select("folder", F.when(kimi, "state.json").otherwise("manifest.json").alias("name")))
    told = beside.select("folder", field("workDir").alias("told_cwd"), field("sessionId").alias("told_id"), stamp("createdAtMs").alias("told_started"), stamp("updatedAtMs").alias("told_ended")).dropDuplicates(["folder"])
    edges = sniff.edges(rows.where("source = 'kimi'").select("log_file"), 4096, 4096) if stamps else rows.limit(0).select("log_file", none.alias("head"), none.alias("tail"))
    first = F.coalesce(F.nullif(F.regexp_extract("head", r'"created_at"\s*:\s*(\d{12,})', 1), F.lit("")).cast("double"), F.nullif(F.regexp_extract("head", r'"timestamp"\s*:\s*(\d+(?:\.\d+)?)', 1), F.lit("")).cast("double") * 1000)
    last = F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all("tail", F.lit(r'("timestamp"\s*:\s*\d+(?:\.\d+)?|"time"\s*:\s*\d{12,})'), F.lit(1))), -1)
    last = F.nullif(F.regexp_extract(last, r"([\d.]+)$", 1), F.lit("")).cast("double") * F.when(F.startswith(last, F.lit('"timestamp"')), 1000).otherwise(1)
    times = edges.select("log_file", T.iso_from_millis(first).alias("first"), T.iso_from_millis(last).alias("last"))
    rows = rows.join(told.hint(logs.JOIN), "folder", "left").join(times.hint(logs.JOIN), "log_file", "left")
    return rows.select(
        "log_file", F.when(kimi, F.col("own_id")).otherwise(F.coalesce("told_id", "own_id")).alias("ref_id"), "ref_role", F.when(kimi, F.col("told_cwd")).alias("ref_cwd"), "ref_hint",
        F.when(kimi, F.col("first")).otherwise(F.col("told_started")).alias("ref_started"), F.when(kimi, F.col("last")).otherwise(F.col("told_ended")).alias("ref_ended"),
    )


def census(spark: SparkSession, roots: list[Root], only: str | None = None, under: str | None = None) -> DataFrame:
    """The inventory with cwd, read_bytes and why a log is left out (skipped), or null.

    Without ``under`` nothing is opened and cwd is null. With it, logs are opened only as far as their kind needs to find its working directory; a log
    without one is left out as ``no cwd``, or kept where its kind often has none (kimi, unless the folder's hint names another directory, and minimax).
    """
    listed = inventory(spark, roots, only)
    if not under:
        return listed.withColumns({"cwd": F.lit(None).cast("string"), "read_bytes": F.lit(0).cast("long"), "skipped": F.lit(None).cast("string")})
    clean = under.rstrip("/")
    known = refs(spark, roots, listed, stamps=False).select("log_file", "ref_cwd", "ref_hint")
    found = listed.join(sniff.working_dirs(listed).hint(logs.JOIN), "log_file").join(known.hint(logs.JOIN), "log_file", "left")
    cwd = F.when(F.col("source") == "kimi", F.col("ref_cwd")).otherwise(F.col("cwd"))
    below = (cwd == clean) | F.startswith(cwd, F.lit(clean + "/"))
    other_hint = (F.col("source") == "kimi") & (F.col("ref_hint") != clean.rsplit("/", 1)[-1])
    why = F.when(cwd.isNotNull(), F.when(~below, "elsewhere")).when(other_hint, "elsewhere").when(~F.col("source").isin("kimi", "minimax"), "no cwd")
    return found.select(*listed.columns, cwd.alias("cwd"), "read_bytes", why.alias("skipped"))


def read(spark: SparkSession, roots: list[Root], only: str | None = None, under: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, sessions) of all logs below the roots; a log below several roots is read once, by the first kind that claims it.

    Only the logs that the census keeps are read. Their paths stay in tables, but for stores that only Spark's readers open: there they pass through the driver.
    """
    listed = written(census(spark, roots, only, under))
    kept = listed.where("skipped is null")
    entries = sessions = None
    for source in dict.fromkeys(r.source for r in roots):
        own, paths = kept.where(F.col("source") == source), [r.path for r in roots if r.source == source]
        if all(map(sniff.opens, paths)):
            lines = logs.listed_lines(own)
        else:
            lines = logs.read_lines(spark, *paths, only=[r.log_file for r in own.select("log_file").collect()])
        e, s = logs.entries(lines, source), logs.sessions(lines, source)
        entries, sessions = (e, s) if entries is None else (entries.unionByName(e), sessions.unionByName(s))
    if any(r.source in ("kimi", "minimax") for r in roots):
        known = refs(spark, roots, kept)
        own = sessions.columns
        sessions = sessions.join(known.hint(logs.JOIN), "log_file", "left").withColumns({
            "session_id": F.coalesce("ref_id", "session_id"), "role": F.coalesce("ref_role", "role"), "cwd": F.coalesce(F.col("ref_cwd"), F.col("cwd")),
            "started_at": F.coalesce("started_at", "ref_started"), "ended_at": F.coalesce("ended_at", "ref_ended"),
        }).select(*own)
    return entries, sessions
