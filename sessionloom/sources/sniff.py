"""What is known of a log before it is parsed: its first and last bytes, its working directory, and files beside it.

Spark's readers give whole files or whole ranges, so these open the listed files inside tasks and read only the bytes that they need. Files are opened through Arrow's
file systems, by the scheme of their path: local and mounted folders, HDFS, S3, GCS.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

#: Bytes of one read.
STEP = 8 << 10
#: A line's part that is kept between reads; no path is longer.
KEPT = 64 << 10
#: Files whose bytes make one batch.
FEW = 500


@dataclass(frozen=True)
class Rule:
    """Where a kind of log names its working directory: the pattern's first group, JSON text; within ``most`` bytes, or anywhere."""

    pattern: str
    most: int | None = None
    needs: str = ""


_CWD = r'"cwd":"((?:[^"\\]|\\.)*)"'
#: Patterns of the formats (fixed values).
RULES = {
    "claude": Rule(_CWD),
    "qwen": Rule(_CWD),
    "codex": Rule(_CWD, 8 << 10),
    "pi": Rule(_CWD, 4 << 10, '"type":"session"'),
    "minimax": Rule(r"YOUR WORKSPACE DIRECTORY:[ \t]*((?:[^\\\"\n]|\\[^n])+)", 256 << 10),
}


def store_of(path: str):
    """(Arrow file system, path inside it) of a path or URI."""
    from urllib.parse import quote

    from pyarrow import fs

    return fs.FileSystem.from_uri(quote(path, safe="/:%@?&=+,;~!$'()*") if re.match(r"[a-zA-Z][\w+.-]*:", path) else path)


def opened(path: str):
    """A file for reading, by its path or URI."""
    store, inner = store_of(path)
    return store.open_input_file(inner)


def _text(value: bytes) -> str | None:
    try:
        return json.loads(b'"' + value + b'"')
    except ValueError:
        return None


def working_dir(path: str, rule: Rule) -> tuple[str | None, int]:
    """(working directory, bytes read) of one log."""
    pattern, held, done = re.compile(rule.pattern.encode()), b"", 0
    with opened(path) as f:
        while rule.most is None or done < rule.most:
            piece = f.read(STEP if rule.most is None else min(STEP, rule.most - done))
            if not piece:
                break
            done += len(piece)
            held += piece
            hit = pattern.search(held)
            if hit and hit.end() < len(held) and rule.needs.encode() in held:
                return _text(hit[1].strip()) or None, done
            if rule.most is None:
                held = held[held.rfind(b"\n") + 1 :][-KEPT:]
    hit = pattern.search(held) if rule.needs.encode() in held else None
    return (_text(hit[1].strip()) or None) if hit else None, done


def working_dirs(listed: DataFrame) -> DataFrame:
    """(log_file, cwd, read_bytes) of listed logs (source, log_file); kinds without a rule are not opened."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("log_file").to_pylist()
            found = [working_dir(p, RULES[s]) if s in RULES else (None, 0) for s, p in zip(batch.column("source").to_pylist(), paths, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([c for c, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["log_file", "cwd", "read_bytes"])

    return _spread(listed.select("source", "log_file")).mapInArrow(work, "log_file string, cwd string, read_bytes long")


def edges(listed: DataFrame, head: int, tail: int) -> DataFrame:
    """(log_file, head, tail): the first and last bytes of listed files (log_file) as text; broken characters at the cuts are replaced."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            paths, rows = batch.column("log_file").to_pylist(), []
            for path in paths:
                with opened(path) as f:
                    first = f.read(head)
                    f.seek(max(0, f.size() - tail))
                    rows.append((first.decode("utf-8", "replace"), f.read(tail).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["log_file", "head", "tail"])

    return _spread(listed.select("log_file")).mapInArrow(work, "log_file string, head string, tail string")


def beside(folders: DataFrame) -> DataFrame:
    """(folder, body): the small files that stand in folders (folder, name); folders without one give no row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in _few(batches):
            rows = []
            for folder, name in zip(batch.column("folder").to_pylist(), batch.column("name").to_pylist(), strict=True):
                store, inner = store_of(f"{folder}/{name}")
                if store.get_file_info(inner).type == fs.FileType.File:
                    with store.open_input_file(inner) as f:
                        rows.append((folder, f.read()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["folder", "body"])

    found = _spread(folders.select("folder", "name").distinct(), "folder").mapInArrow(work, "folder string, body binary")
    return found.withColumn("body", F.col("body").cast("string"))


def opens(path: str) -> bool:
    """Does Arrow know the path's scheme?"""
    try:
        store_of(path)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def tree(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(root, log_file, log_bytes, log_mtime): all files below paths (root is a path's place in the list), but for hidden ones, as Spark's readers see them.

    Folders are listed inside tasks, a level of all of them at a time, so the driver holds neither files nor folders.
    """
    from pyspark.errors import AnalysisException

    out = "root int, log_file string, log_bytes long, log_mtime long, folder boolean"
    given, conf = [], spark.sparkContext._jsc.hadoopConfiguration()
    for i, path in enumerate(paths):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(conf)
        found = store.globStatus(store.makeQualified(place))
        if not found:
            raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {path}.")
        given += [(i, re.sub("^file:///", "file:/", x.getPath().toUri().toString()), x.getLen(), x.getModificationTime(), x.isDirectory()) for x in found]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        from pyarrow import fs

        hidden = re.compile(r"\.|_(?!.*=)|.*\._COPYING_$")
        encoded = lambda name: "".join(c if ord(c) > 160 else quote(c, safe="-_.!~'()*,;:$&+=@") for c in name)
        for batch in batches:
            for root, folder in zip(batch.column("root").to_pylist(), batch.column("log_file").to_pylist(), strict=True):
                store, inner = store_of(folder)
                held = [x for x in store.get_file_info(fs.FileSelector(inner)) if not hidden.match(x.base_name)]
                is_folder = [x.type == fs.FileType.Directory for x in held]
                yield pa.RecordBatch.from_arrays([
                    pa.array([root] * len(held), pa.int32()), pa.array([f"{folder.rstrip('/')}/{encoded(x.base_name)}" for x in held], pa.string()), pa.array([x.size or 0 for x in held], pa.int64()),
                    pa.array([(x.mtime_ns or 0) // 1_000_000 for x in held], pa.int64()), pa.array(is_folder, pa.bool_()),
                ], names=["root", "log_file", "log_bytes", "log_mtime", "folder"])

    level = spark.createDataFrame(given, out)
    files = level.where("not folder")
    while not (folders := level.where("folder")).isEmpty():
        level = written(_spread(folders.select("root", "log_file")).mapInArrow(work, out))
        files = files.unionByName(level.where("not folder"))
    return files.select("root", "log_file", "log_bytes", F.timestamp_millis("log_mtime").alias("log_mtime"))


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of FEW rows."""
    for batch in batches:
        yield from (batch.slice(at, FEW) for at in range(0, batch.num_rows, FEW))


def _spread(listed: DataFrame, by: str = "log_file") -> DataFrame:
    """A file costs an open, whatever its size: files are dealt out evenly by their path, to a number of tasks that Spark does not lower."""
    return listed.repartition(4 * listed.sparkSession.sparkContext.defaultParallelism, by)
