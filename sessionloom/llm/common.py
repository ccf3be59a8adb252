"""What the corpus operators share: ASCII case, bounded batches, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import shared_dir, written

__all__ = ["SPACES", "ascii_lower", "checkpointed", "components", "every", "fresh", "give_back", "pieces_of", "released", "row_hash", "shared_dir", "written"]

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``; bytes.split() uses exactly this set.
SPACES = r"[\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint() into the shared folder; Spark removes the files when the frame is gone."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``docs`` is called so, whatever its case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def every(docs: DataFrame) -> list[Column]:
    """All columns of ``docs``, also those with dots or quotes in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; maps and variants, which Spark does not hash, count by their JSON."""
    kinds = [f.dataType.simpleString() for f in docs.schema.fields]
    return F.xxhash64(*(F.to_json(F.struct(c)) if "map<" in k or "variant" in k else c for c, k in zip(every(docs), kinds, strict=True)))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def give_back() -> None:
    """Returns memory that this Python worker no longer uses: Spark keeps workers for later tasks, also of other stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; before the first and behind the last one memory is given back."""
    give_back()
    yield from batches
    give_back()


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of ``column``, or one row."""
    import pyarrow.compute as pc

    for batch in released(batches):
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs), as (node, component); component is the smallest node.

    Alternating large-star and small-star rounds. Each round is two grouped minima and equi-joins;
    minima combine before the shuffle, so that a node with very many edges is no single task's list.
    Self-loops and repeated edges are allowed; no edges give no rows; nulls are left out.
    """
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        large = _star(now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), "b > a")
        small = _star(large, "true")
        now = checkpointed(small)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _star(edges: DataFrame, side: str) -> DataFrame:
    """Links each node's neighbours (those of ``side``) and itself to the smallest of all."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = edges.where(side).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if side == "true":
        linked = linked.union(least.select("a", "m"))
    return linked.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
