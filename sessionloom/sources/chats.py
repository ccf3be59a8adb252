"""Chats of an editor's store as one log and one meta file each; a chat that has its log is left alone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.sessions import workspace_by_mode
from . import export
from .sqlite import _get, cursor_ide_lines, rows

META = ("sessionId", "source", "msgCount", "title", "createdAt", "lastUpdatedAt", "workspacePath")


def _iso(value: Column) -> Column:
    """A time that is text, or a number of milliseconds."""
    millis = value.try_cast("double")
    return F.when(millis.isNotNull(), T.iso_from_millis(millis)).otherwise(F.nullif(value, F.lit("")))


def ide_workspaces(composers: DataFrame, lines: DataFrame, home: str | None = None) -> DataFrame:
    """(chat, workspace): the folder that a chat (chat, v: its JSON) names itself, else the first that its user's texts name, else the project
    below ``home`` that they mention most."""
    said = lines.where(_get(F.col("raw"), "kind") == "user_text").select(F.col("log_file").alias("chat"), "log_line", _get(F.col("raw"), "text").alias("text"))
    told = F.nullif(F.trim(F.regexp_extract("text", r"Workspace Path:\s*(.+)", 1)), F.lit(""))
    named = said.groupBy("chat").agg(F.min_by(told, F.when(told.isNotNull(), F.col("log_line"))).alias("told"))
    out = composers.select("chat", F.nullif(_get(F.col("v"), "workspaceIdentifier.uri.fsPath"), F.lit("")).alias("own")).join(named, "chat", "left")
    choice = [F.col("own"), F.col("told")]
    if home:
        found = F.explode(F.regexp_extract_all("text", F.lit(rf"({re.escape(home)}/projects/[A-Za-z0-9._-]+(?:/[A-Za-z0-9._-]+){{0,2}})"), F.lit(1)))
        out = out.join(workspace_by_mode(said.select("chat", found.alias("path")), "chat", "path"), "chat", "left")
        choice.append(F.col("workspace"))
    return out.select("chat", F.coalesce(*choice).alias("workspace"))


def ide_meta(spark: SparkSession, db: str, lines: DataFrame, home: str | None = None) -> DataFrame:
    """(chat, *META) of the chats in ``lines`` (log_file is the chat), from an IDE's store."""
    composers = rows(spark, db, "SELECT key, value FROM cursorDiskKV WHERE key LIKE 'composerData:%'").select(F.substring_index(_get(F.col("row"), "key"), ":", -1).alias("chat"), _get(F.col("row"), "value").alias("v"))
    heads = rows(spark, db, "SELECT * FROM composerHeaders").select(_get(F.col("row"), "composerId").alias("chat"), _get(F.col("row"), "value").alias("h"))
    counts = lines.groupBy(F.col("log_file").alias("chat")).agg(F.count("*").alias("n"))
    joined = counts.join(heads, "chat", "left").join(composers, "chat", "left").join(ide_workspaces(composers, lines, home), "chat", "left")
    either = lambda p: F.coalesce(F.nullif(_get(F.col("v"), p), F.lit("")), F.nullif(_get(F.col("h"), p), F.lit("")))
    made = (F.col("chat"), F.lit("cursor-ide"), F.col("n"), either("name"), _iso(either("createdAt")), _iso(either("lastUpdatedAt")), F.col("workspace"))
    return joined.select("chat", *(c.alias(n) for c, n in zip(made, META, strict=True)))


def export_chats(lines: DataFrame, meta: DataFrame, folder: str) -> DataFrame:
    """Writes ``<chat>.jsonl`` from lines (log_file is the chat, log_line, raw) and ``<chat>.meta.json`` from meta (chat, ...) into ``folder``; files that are
    there stay as they are. The meta file comes first, so a log never lacks it. Returns (path, bytes, kept)."""
    fields = [c for c in meta.columns if c != "chat"]
    told = meta.select(F.concat("chat", F.lit(".meta.json")).alias("path"), F.lit(0).cast("long").alias("place"), F.concat(F.to_json(F.struct(*fields)), F.lit("\n")).alias("body"))
    first = export.write_files(told, folder, keep=True)
    logs = lines.select(F.concat("log_file", F.lit(".jsonl")).alias("path"), F.col("log_line").alias("place"), F.concat("raw", F.lit("\n")).alias("body"))
    return first.unionByName(export.write_files(logs, folder, keep=True))


def export_ide(spark: SparkSession, db: str, folder: str, home: str | None = None) -> DataFrame:
    """Exports an IDE's chats that have lines; see export_chats."""
    lines = cursor_ide_lines(spark, db)
    return export_chats(lines, ide_meta(spark, db, lines, home), folder)
