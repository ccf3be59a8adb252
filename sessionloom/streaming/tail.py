"""Growing log files as a stream: spark.readStream.format("log_tail").load(folder).

Spark's file source reads a file once; this one remembers for each file how many bytes were read and gives the complete lines behind them. Offsets live in the query's
checkpoint, so a restart goes on where the last committed batch ended.
"""

from __future__ import annotations

import os

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.suffix = options["path"], options.get("suffix", ".jsonl")

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        found = {}
        for folder, _, names in os.walk(self.folder):
            for name in names:
                if name.endswith(self.suffix):
                    path = os.path.join(folder, name)
                    found[path] = _whole(path)
        return {"files": found}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Part(p, start["files"].get(p, 0), n) for p, n in sorted(end["files"].items()) if n > start["files"].get(p, 0)]

    def read(self, partition: _Part):
        with open(partition.path, "rb") as f:
            line = f.read(partition.start).count(b"\n")
            for raw in f.read(partition.end - partition.start).split(b"\n")[:-1]:
                line += 1
                text = raw.decode("utf-8", "replace").rstrip("\r")
                if text.strip():
                    yield partition.path, line, text

    def commit(self, end: dict) -> None:
        pass


def _whole(path: str) -> int:
    """Bytes of a file up to its last line end, so that a line that is being written waits."""
    size = os.path.getsize(path)
    with open(path, "rb") as f:
        at = size
        while at > 0:
            step = min(at, 65_536)
            f.seek(at - step)
            found = f.read(step).rfind(b"\n")
            if found >= 0:
                return at - step + found + 1
            at -= step
    return 0


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "log_file string, log_line long, raw string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailReader(self.options)
