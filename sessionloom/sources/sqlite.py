"""SQLite tables as a Spark data source: spark.read.format("sqlite_rows").option("query", ...).load(path).

Each file is a task. Columns come as text in ``row``, a JSON object; the file has to be readable on the executors.
"""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.query = options["path"], options["query"]

    def partitions(self) -> list[InputPartition]:
        found = sorted(glob.glob(self.path)) if glob.has_magic(self.path) else [self.path]
        return [_File(p) for p in found]

    def read(self, partition: _File):
        import sqlite3

        db = sqlite3.connect(f"file:{partition.path}?mode=ro", uri=True)
        try:
            cursor = db.execute(self.query)
            names = [c[0] for c in cursor.description]
            for i, row in enumerate(cursor):
                yield os.path.abspath(partition.path), i, json.dumps({n: v.decode("utf-8", "replace") if isinstance(v, bytes) else v for n, v in zip(names, row, strict=True)})
        finally:
            db.close()


class SqliteRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_rows"

    def schema(self) -> str:
        return "db_file string, row_number int, row string"

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options)


def rows(spark: SparkSession, path: str, query: str) -> DataFrame:
    spark.dataSource.register(SqliteRows)
    return spark.read.format("sqlite_rows").option("query", query).load(path)


def _get(c: Column, path: str) -> Column:
    return F.get_json_object(c, f"$.{path}")


def cursor_ide_lines(spark: SparkSession, db: str) -> DataFrame:
    """Log lines (log_file, log_line, raw) of the chats in an IDE's store: headers without sub-agents, joined with the chats'
    bubbles in order; a tool's call and result get the id bubble:index."""
    heads = rows(spark, db, "SELECT composerId, createdAt, isSubagent FROM composerHeaders").select(_get(F.col("row"), "composerId").alias("chat")).where(F.coalesce(_get(F.col("row"), "isSubagent"), F.lit("0")).isin("0", "false"))
    kv = rows(spark, db, "SELECT key, value FROM cursorDiskKV WHERE key LIKE 'bubbleId:%'")
    parts = F.split(_get(F.col("row"), "key"), ":")
    bubble = kv.select(parts[1].alias("chat"), parts[2].alias("bid"), "row_number", _get(F.col("row"), "value").alias("v"))
    said = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("input"), F.lit(None).cast("string").alias("content"), F.lit(False).alias("isError"))
    tool = _get(F.col("v"), "toolFormerData")
    used = lambda kind, content: F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("text"), _get(tool, "name").alias("name"), _get(tool, "rawArgs").alias("input"), content.alias("content"), (_get(tool, "status") == "error").alias("isError"))
    text, thought = _get(F.col("v"), "text"), _get(F.col("v"), "thinking.text")
    made = F.when(_get(F.col("v"), "type") == "1", F.array(said("user_text", text))).otherwise(
        F.array(F.when(thought.isNotNull(), said("assistant_thinking", thought)), F.when(F.length(text) > 0, said("assistant_text", text)), F.when(tool.isNotNull(), used("tool_call", F.lit(None).cast("string"))), F.when(_get(tool, "result").isNotNull(), used("tool_result", _get(tool, "result"))))
    )
    lines = bubble.join(heads, "chat").withColumn("made", F.filter(made, lambda x: x.isNotNull())).select("chat", "bid", "row_number", F.posexplode("made").alias("p", "e"))
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("chat").orderBy("row_number", "p")).cast("bigint")
    return lines.select(F.col("chat").alias("log_file"), F.lit(0).cast("bigint").alias("log_bytes"), n.alias("log_line"), F.to_json(F.struct("e.kind", "e.text", "e.name", "e.input", "e.content", "e.isError", F.concat_ws(":", "bid", F.lit("0")).alias("toolCallId"))).alias("raw"))


def cursor_agent_lines(spark: SparkSession, db: str) -> DataFrame:
    """Log lines of the chats in a command-line agent's stores: blobs in row order, messages nested up to eight deep."""
    blobs = rows(spark, db, "SELECT data FROM blobs ORDER BY rowid").select("db_file", "row_number", F.array(_get(F.col("row"), "data")).alias("level"))
    every = blobs.withColumn("all", F.array().cast("array<string>"))
    for _ in range(8):
        every = every.withColumn("all", F.concat("all", "level")).withColumn("level", F.flatten(F.transform("level", lambda m: F.coalesce(F.from_json(_get(m, "messages"), "array<string>"), F.array().cast("array<string>")))))
    said = every.select("db_file", "row_number", F.posexplode("all").alias("p", "m")).where(_get(F.col("m"), "role").isin("user", "assistant"))
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("db_file").orderBy("row_number", "p")).cast("bigint")
    kind = F.when(_get(F.col("m"), "role") == "user", "user_text").otherwise("assistant_text")
    return said.select(F.col("db_file").alias("log_file"), F.lit(0).cast("bigint").alias("log_bytes"), n.alias("log_line"), F.to_json(F.struct(kind.alias("kind"), _get(F.col("m"), "content").alias("text"))).alias("raw"))


def cursor_meta(spark: SparkSession, db: str) -> DataFrame:
    """(db_file, key, value): a store's meta table, whose values are JSON in hexadecimal."""
    found = rows(spark, db, "SELECT key, value FROM meta")
    return found.select("db_file", _get(F.col("row"), "key").alias("key"), F.decode(F.unhex(_get(F.col("row"), "value")), "UTF-8").alias("value"))
