"""Tables as files: one file for each path, written inside tasks, complete or not there.

Files are opened through Arrow's file systems, by the scheme of the folder's path. A file is written under a name of its own and then
moved, so a task that runs again, or two at once, leave the same files. Rows are dealt by path and sorted, and a
file is written as a stream: no task holds a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written
from .sniff import store_of


def write_files(rows: DataFrame, folder: str, keep: bool = False) -> DataFrame:
    """Writes rows (path, place, body) as files ``folder/path``, a line for each row in order of place; line ends are the rows' own business.

    Returns (path, bytes, kept) of every file, after the files are there. With ``keep`` a file that exists already is left alone (kept is true).
    """
    out = "path string, bytes long, kept boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = store_of(folder)
        now = None

        def close() -> pa.RecordBatch:
            name, stream, held, size = now
            if stream is not None:
                stream.close()
                store.move(held, f"{base}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([size], pa.int64()), pa.array([stream is None], pa.bool_())], names=["path", "bytes", "kept"])

        for batch in batches:
            for path, body in zip(batch.column("path").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if now is None or now[0] != path:
                    if now is not None:
                        yield close()
                    place = f"{base}/{path}"
                    there = store.get_file_info(place) if keep else None
                    if there is not None and there.type == fs.FileType.File:
                        now = [path, None, None, there.size]
                    else:
                        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        held = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
                        now = [path, store.open_output_stream(held), held, 0]
                if now[1] is not None:
                    data = (body or "").encode("utf-8", "replace")
                    now[1].write(data)
                    now[3] += len(data)
        if now is not None:
            yield close()

    dealt = rows.select("path", "place", F.col("body").cast("string").alias("body")).repartition("path").sortWithinPartitions("path", "place")
    return written(dealt.select("path", "body").mapInArrow(work, out))
