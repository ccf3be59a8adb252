"""Exact dedup against immutable snapshots through static binary-fuse filters.

A snapshot's keys (the first 64 bits of the normalised texts' SHA-256 digests) are dealt to buckets; each bucket has one binary-fuse filter
(8-bit fingerprints, three places a key), built once and kept as a table beside the snapshot's digests. Incoming keys meet
the filter of their bucket: those it refuses are new for certain. Those it lets pass join the snapshot's exact rows.
Duplicates inside the incoming batch are grouped apart. Only texts whose key occurs again are compared byte by byte: a second
filter, of just these keys, is broadcast while it stays small (MOST_SENT keys, about 1.2 bytes each) and drops all other
rows in the scan, so that texts without a copy never move. Beyond that size the rows are found by a join on the id, which
moves every text once; the results are the same. Equal texts of one task are one row in the shuffle, so that a group of
any size stays small.

Defined cases: a null text counts as empty; texts are equal when identical after lowering A-Z only; the row with
the largest doc_id of a group stays, null ids last; rows that repeat a doc_id and text count in group_size and
give a row each; an empty table gives no rows; very long texts are one value each; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, every, fresh, released, row_hash, written

#: Keys that a bucket holds on average; its filter then takes about 40 kB.
BUCKET_KEYS = 32_768


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys under a seed, every bit depending on all (the finaliser of splitmix64)."""
    z = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def _places(mixed: np.ndarray, segment: int, count: int) -> np.ndarray:
    """Three places of each key, in three consecutive segments; shape (3, keys)."""
    first = (mixed >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
    inside = np.uint64(segment - 1)
    return np.stack([(first + np.uint64(i)) * np.uint64(segment) + (mixed >> np.uint64(18 * i) & inside) for i in range(3)]).astype(np.int64)


def _short(mixed: np.ndarray) -> np.ndarray:
    return (mixed ^ mixed >> np.uint64(32)).astype(np.uint8)


class FuseFilter:
    """A static set of 64-bit keys: no key is missed, one in 256 others passes."""

    def __init__(self, seed: int, segment: int, count: int, table: np.ndarray):
        self.seed, self.segment, self.count, self.table = seed, segment, count, table

    @classmethod
    def of(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
        slots = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))) + 32
        count = max(1, -(-slots // segment) - 2)
        for seed in range(1, 200):
            mixed = _mixed(keys, seed)
            places = _places(mixed, segment, count)
            order = cls._peeled(places, (count + 2) * segment)
            if order is not None:
                table = np.zeros((count + 2) * segment, np.uint8)
                prints = _short(mixed)
                for own, slot in reversed(order):  # each slot is alone in its round, so a round is one step
                    rest = np.bitwise_xor.reduce(table[places[:, own]], axis=0)
                    table[slot] = prints[own] ^ rest ^ table[slot]
                return cls(seed, segment, count, table)
            if seed % 20 == 0:
                count += max(1, count // 8)
        raise RuntimeError("no seed peels these keys")

    @staticmethod
    def _peeled(places: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, their slots), each slot used by no other key that is still there; None if keys remain."""
        n = places.shape[1]
        degree = np.bincount(places.ravel(), minlength=slots)
        whose = np.zeros(slots, np.int64)
        for row in places:
            np.bitwise_xor.at(whose, row, np.arange(n))
        rounds, left = [], n
        single = np.flatnonzero(degree == 1)
        while len(single):
            own, at = np.unique(whose[single], return_index=True)
            rounds.append((own, single[at]))
            left -= len(own)
            for row in places[:, own]:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(whose, row, own)
            touched = np.unique(places[:, own].ravel())
            single = touched[degree[touched] == 1]
        return None if left else rounds

    def passes(self, keys: np.ndarray) -> np.ndarray:
        mixed = _mixed(keys.astype(np.uint64), self.seed)
        found = np.bitwise_xor.reduce(self.table[_places(mixed, self.segment, self.count)], axis=0)
        return found == _short(mixed)


def _digest(text: pa.Scalar) -> bytes:
    """SHA-256 of a text with A-Z lowered; bytes.lower() lowers nothing else."""
    return hashlib.sha256((text.as_py() or b"").lower()).digest()


def _keys(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(_digest(x)[:8] for x in texts.cast(pa.binary())), ">i8").astype(np.int64)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest string, key long, row_tag long) of every row; digest: SHA-256 of the text with A-Z lowered,
    key: its first eight bytes, row_tag: hash of the text as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_digest(x) for x in batch.column(1).cast(pa.binary())]
            keys = np.frombuffer(b"".join(x[:8] for x in raw), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.hex() for x in raw], pa.string()), pa.array(keys), batch.column(2)], names=["doc_id", "digest", "key", "row_tag"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_tag")).mapInArrow(work, "doc_id long, digest string, key long, row_tag long")


def snapshot_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """(bucket, seed, segment, count, bits): one filter for each bucket of an immutable snapshot's ``key`` column."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        made = FuseFilter.of(table.column("key").to_numpy().view(np.uint64))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "seed": pa.array([made.seed], pa.int32()), "segment": pa.array([made.segment], pa.int32()), "count": pa.array([made.count], pa.int32()), "bits": pa.array([made.table.tobytes()], pa.binary())})

    own = snapshot.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), "key").distinct()
    return own.groupBy("bucket").applyInArrow(build, "bucket int, seed int, segment int, count int, bits binary")


def screened(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct incoming ``key`` values that their bucket's filter lets pass."""

    def screen(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"key": pa.array([], pa.int64())})
        row = {n: right.column(n)[0].as_py() for n in right.column_names}
        made = FuseFilter(row["seed"], row["segment"], row["count"], np.frombuffer(row["bits"], np.uint8))
        return pa.table({"key": left.column("key").filter(pa.array(made.passes(left.column("key").to_numpy().view(np.uint64))))})

    own = incoming.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), "key").distinct()
    return own.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(screen, "key long")


def save_snapshot(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the digests and filters of ``docs`` under ``path``, for load_snapshot() in later runs."""
    digests(docs, id_col, text_col).write.parquet(f"{path}/digests")
    kept = docs.sparkSession.read.parquet(f"{path}/digests")
    buckets = kept.count() // BUCKET_KEYS + 1
    snapshot_filters(kept, buckets).withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/filters")


def load_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(digests, filters, buckets) of a snapshot that save_snapshot() wrote; nothing is built again."""
    filters = spark.read.parquet(f"{path}/filters")
    some = filters.first()
    return spark.read.parquet(f"{path}/digests"), filters.drop("buckets"), some.buckets if some else 1


def new_rows(docs: DataFrame, snapshot: tuple[DataFrame, DataFrame, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all their columns) whose normalised text is not in a loaded snapshot. The snapshot keeps no
    texts, so equality is that of SHA-256 digests here. Texts that the filter refuses stay where they are."""
    old, filters, buckets = snapshot
    keys = digests(docs, id_col, text_col).select("key", "digest").distinct()
    passed = screened(keys, filters, buckets)
    held = keys.join(passed, "key", "left_semi").join(old.select("digest"), "digest", "left_semi")
    print_ = fresh(docs, "print")[0]
    held = written(held.select("key", F.col("digest").alias(print_)))
    sure, maybe = parted(docs, held.select("key"), text_col=text_col)
    digest = F.sha2(ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return sure.unionByName(maybe.withColumn(print_, digest).join(held.select(print_), print_, "left_anti").select(*every(docs)))


#: Keys that a broadcast filter holds at most (about 1.2 bytes each).
MOST_SENT = 40_000_000


def passing(keys: DataFrame) -> Callable[[np.ndarray], np.ndarray] | None:
    """A test, for use in tasks, of whether int64 keys may be in ``keys``: no key is missed, one in 256 others passes. None
    beyond MOST_SENT keys."""
    number = keys.count()
    if number > MOST_SENT:
        return None
    buckets = number // BUCKET_KEYS + 1
    rows = snapshot_filters(keys, buckets).toArrow().to_pylist()
    shared = keys.sparkSession.sparkContext.broadcast({r["bucket"]: r for r in rows})

    def passes(own: np.ndarray) -> np.ndarray:
        bucket = np.mod(own, buckets)
        out = np.zeros(len(own), bool)
        for at in np.unique(bucket):
            row = shared.value.get(int(at))
            if row:
                made = FuseFilter(row["seed"], row["segment"], row["count"], np.frombuffer(row["bits"], np.uint8))
                inside = bucket == at
                out[inside] = made.passes(own[inside].view(np.uint64))
        return out

    return passes


def sifted(rows: DataFrame, passes: Callable[[np.ndarray], np.ndarray], wanted: bool, key_col: str | None = None, text_col: str = "text") -> DataFrame:
    """The rows whose key passes, or does not. The key is ``key_col`` or, without one, that of the normalised text."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            keys = batch.column(key_col).to_numpy(zero_copy_only=False) if key_col else _keys(batch.column(text_col).cast(pa.string()))
            yield batch.filter(pa.array(passes(keys) == wanted))

    return rows.mapInArrow(sift, rows.schema)


def parted(rows: DataFrame, keys: DataFrame, key_col: str | None = None, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose key is not in ``keys`` for certain, and the others (written, as they are few and read more than
    once). The first part is empty where the keys outgrow a broadcast."""
    passes = passing(keys)
    if passes is None:
        return rows.where("false"), rows
    return sifted(rows, passes, False, key_col, text_col), written(sifted(rows, passes, True, key_col, text_col))


def _prints(docs: DataFrame, snapshot_below: int | None, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, Column]:
    """(digests of all rows, keys that occur more than once, is a row inside the snapshot?)."""
    prints = written(digests(docs, id_col, text_col))
    if snapshot_below is None:
        low, high = prints.agg(F.min("doc_id"), F.max("doc_id")).first()
        snapshot_below = 0 if low is None else low + (high - low + 1) // 2
    inside = F.coalesce(F.col("doc_id") < F.lit(snapshot_below), F.lit(False))
    old, new = prints.where(inside), prints.where(~inside)
    buckets = max(8, old.count() // BUCKET_KEYS + 1)

    filters = written(snapshot_filters(old, buckets))
    passed = screened(new, filters, buckets)
    met = passed.join(old.select("key").distinct(), "key", "left_semi")
    again = new.groupBy("key").count().where("count > 1").select("key")
    old_again = old.groupBy("key").count().where("count > 1").select("key")
    return prints, written(met.union(again).union(old_again).distinct()), inside


def _grouped(docs: DataFrame, prints: DataFrame, double: DataFrame, inside: Column, id_col: str, text_col: str) -> DataFrame:
    """(text_sha256, keep_id, group_size) of the groups of two or more equal texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    passes = passing(double)
    if passes is None:
        wanted = prints.join(double, "key", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
        rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    else:
        rows = sifted(rows, passes, True)
    rows = rows.withColumn("text", ascii_lower(F.coalesce("text", F.lit(""))))
    # Equal texts of a task are one row from here on.
    parts = rows.groupBy("text", inside.alias("inside")).agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
    groups = parts.groupBy("text").agg(F.sum("n").alias("group_size"), F.max("top").alias("keep_id")).where("group_size > 1")
    return groups.select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")


def exact_groups(docs: DataFrame, snapshot_below: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, row_tag) of every row of ``docs``.

    Rows with an id below ``snapshot_below`` are the immutable snapshot and the others the incoming batch (default:
    the middle of the id range, so that either is about half).
    """
    prints, double, inside = _prints(docs, snapshot_below, id_col, text_col)
    groups = _grouped(docs, prints, double, inside, id_col, text_col)
    out = prints.withColumnRenamed("digest", "text_sha256").join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256", "row_tag")


def keep_last(docs: DataFrame) -> DataFrame:
    """One row (all its columns) of each group of equal texts in ``docs``: that with the largest doc_id (null ids last), then
    the smallest hash of the row. Rows whose text has no copy stay in their task.

    Defined cases: null and empty texts are equal; texts of any length are compared whole; rows that are alike in all
    columns are copies; further columns may have any name and type, maps too; an empty table gives no rows.
    """
    print_, keep, row = fresh(docs, "print", "keep", "row")
    prints, double, inside = _prints(docs, None, "doc_id", "text")
    groups = written(_grouped(docs, prints, double, inside, "doc_id", "text").select(F.col("text_sha256").alias(print_), F.col("keep_id").alias(keep)))
    keys = F.conv(F.substring(print_, 1, 16), 16, -10).cast("long")
    sure, maybe = parted(docs, groups.select(keys.alias("key")))
    digest = F.sha2(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary"), 256)
    maybe = maybe.withColumn(print_, digest)
    lone = maybe.join(groups.select(print_), print_, "left_anti")
    best = maybe.join(groups, print_).where(F.col("doc_id").cast("long").eqNullSafe(F.col(keep)))
    # Minima combine before the shuffle, so rows that repeat id and text are one row a task.
    first = best.groupBy(print_).agg(F.min_by(F.struct(*every(docs)), row_hash(docs)).alias(row))
    return sure.union(lone.select(*every(docs))).union(first.select(f"{row}.*"))
