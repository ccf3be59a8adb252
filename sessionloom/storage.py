"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, on local masters only, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        kept = context._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            return kept.get()
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sessionloom-")
        context.setCheckpointDir(found)
    return found


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sessionloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def append_lines(df: DataFrame, path: str) -> None:
    """Rows as JSON lines behind those that are there: ledger events, sidecar records, metrics."""
    df.write.mode("append").json(path)


def replace_table(df: DataFrame, path: str) -> None:
    """df in place of the table at ``path``: registry, job index, skeletons, bank. df must not read from it."""
    df.write.mode("overwrite").parquet(path)


def _batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table's batches that are whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [s.getPath() for s in store.listStatus(folder) if s.isDirectory()]
    return sorted(p.toString() for p in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def commit(tables: list[tuple[DataFrame, str]], batch: str | None = None) -> None:
    """Writes each (rows, path) as one batch of the table at path, one after the other: a later table's batch is there only when
    the earlier ones are. Doing a named batch again replaces it, so a repeat leaves the same tables; without a name each call is a new batch."""
    name = batch or uuid.uuid4().hex
    for df, path in tables:
        df.write.mode("overwrite").parquet(f"{path}/batch={name}")


def committed(spark: SparkSession, path: str, schema: str, by: str | None = None) -> DataFrame:
    """The rows of a table's whole batches; with ``by``, the last table of a commit, only of the batches that are whole there. A batch that
    was cut off while it was written is not seen."""
    whole = _batches(spark, path)
    if by is not None:
        last = {p.rsplit("/", 1)[1] for p in _batches(spark, by)}
        whole = [p for p in whole if p.rsplit("/", 1)[1] in last]
    return spark.read.schema(schema).parquet(*whole) if whole else spark.createDataFrame([], schema)
