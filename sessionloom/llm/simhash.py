"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most 2r bits apart have a value between them that is at most r bits from both. Every
distinct fingerprint therefore emits all values of its ball of half the radius (for radius 4: 1 + 64 + 2016),
and equal values meet. Members of one such bucket are all within the radius of each other, so a bucket needs
only a chain of its members, never all pairs, and the chains together connect exactly what all pairs would.

The shuffle deals by the leading bits of the variants (the cell): a fingerprint goes once to each cell that holds
some of its variants, with the flips that remain, and the cell's task makes its variants there. So a
fingerprint costs 1 + b + b(b-1)/2 rows for b cell bits and not 2081. b follows the number of distinct
fingerprints; crowded cells are split by further bits, and each cell is worked off in slices of bounded size. In its task a cell's
variants are made bit group by bit group, and only where they can still meet: a group of variants that one fingerprint alone can reach
ends there, one that few can reach is settled by comparing these, and one whose fingerprints are connected already is dropped.

The stage keep_first() is not bound to op6's shingles: its candidates have fingerprints of their distinct words at six
bits or fewer apart, which finds nine of ten pairs with a five-word similarity of 0.8 or more (README), and it removes only what an
exact comparison of the five-word shingles confirms.

Defined cases: null and empty texts have fingerprint zero and link like any other; rows that repeat a doc_id and
its text are the same node; of rows with one doc_id and other texts each keeps its fingerprint and both join
that id's component; a null doc_id gets its fingerprint and a null component; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, every, fresh, give_back, pieces_of, row_hash, written
from .exact import parted, passing, sifted

#: A cell is crowded, and split by SPLIT_BITS further bits while it has under MOST_BITS, if it holds over HOT fingerprints
#: and over HOT_TIMES as many as the cells do on average: an ordinary load grows with the corpus and is no reason to split.
HOT, HOT_TIMES, SPLIT_BITS, MOST_BITS = 50_000, 4, 6, 44
#: Fingerprints over the number of cells, at most: a cell's rows are so many times the flips that reach it.
CELL_ROWS = 30_000
#: Variants that one slice of a cell holds at most, about (32 bytes each, and as much again for the order), and fingerprints that are compared pair by pair.
SLICE, LEAF = 500_000, 24
#: Shingles of a group of candidates that one task compares, the texts that a round takes from larger groups, and how their rest is salted.
GROUP_GRAMS, HEADS, SALTS = 1_000_000, 64, 16
#: Shingles of a group behind which its task gives memory back.
LARGE = 200_000
SHINGLES_AT_ONCE = 200_000


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42, distinct: bool = False) -> int:
    """64-bit SimHash of the word shingles of an ASCII-lowered text, each occurrence counted; distinct: of its distinct words."""
    import xxhash

    found = (text or b"").lower().split()
    if distinct:
        found, words = sorted(set(found)), 1
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    width = min(words, len(found))
    total = len(found) - width + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        some = found[start : start + SHINGLES_AT_ONCE + width - 1]
        grams = map(b" ".join, zip(*(some[i:] for i in range(width)), strict=False))
        hashes = np.array([digest(g, seed) for g in grams], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * ones > total).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(doc_id, fp long) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.fromiter((fingerprint(x.as_py(), words, distinct=distinct) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, "doc_id long, fp long")


def _split(value: np.ndarray, left: np.ndarray, free: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Deals values to the cells of their next ``bits`` bits: (row, value in that cell, flips left, cell)."""
    shift = np.uint64(free - bits)
    for flip in range(1 << bits):
        row = np.flatnonzero(left >= flip.bit_count())
        if len(row):
            moved = value[row] ^ (np.uint64(flip) << shift)
            yield row, moved, left[row] - flip.bit_count(), (moved >> shift & np.uint64((1 << bits) - 1)).astype(np.int64)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Connects the rows a with the rows b, in place; root: for each row the smallest one that it is connected with."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(shorter := root[root], root):
            root[:] = shorter


def _near(root: np.ndarray, fps: np.ndarray, owner: np.ndarray, cell: np.ndarray, radius: int, reach: int) -> None:
    """Connects rows up to ``reach`` places apart that are in one cell and at ``radius`` or fewer differing bits."""
    for k in range(1, min(reach, len(owner) - 1) + 1):
        at = np.flatnonzero(cell[k:] == cell[:-k])
        if not len(at):
            return
        a, b = owner[at], owner[at + k]
        near = (root[a] != root[b]) & (np.bitwise_count(fps[a] ^ fps[b]) <= radius)
        _joined(root, a[near], b[near])


def _open(root: np.ndarray, owner: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sorted by cell, of the cells in which rows are not all connected; how many their cell has)."""
    order = np.argsort(cell)
    begin = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0][: len(order)])
    own = root[owner[order]]
    mixed = np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin) if len(own) else begin > 0
    size = np.diff(np.r_[begin, len(order)])
    kept = np.repeat(mixed, size)
    return order[kept], np.repeat(size, size)[kept]


def _settled(root: np.ndarray, fps: np.ndarray, radius: int, value: np.ndarray, left: np.ndarray, owner: np.ndarray, cell: np.ndarray, free: int) -> list[tuple]:
    """Settles the cells that can be settled; the others' rows, sorted by cell, as a list of one block or none."""
    kept, size = _open(root, owner, cell)
    few = size <= LEAF if free else np.ones(len(size), bool)
    # Where all bits are dealt, a cell is one variant: its fingerprints are all near each other, and a chain connects them.
    _near(root, fps, owner[kept[few]], cell[kept[few]], radius, LEAF if free else 1)
    rest = kept[~few]
    return [(value[rest], left[rest], owner[rest], cell[rest], free)] if len(rest) else []


def _connected(value: np.ndarray, left: np.ndarray, fps: np.ndarray, free: int, radius: int) -> np.ndarray:
    """For each fingerprint of one cell the smallest row that common variants in this cell connect it with."""
    root = np.arange(len(fps))
    for turn in range(0, 64, 8):  # what lies side by side in some order is connected without any variants
        turned = fps << np.uint64(turn) | fps >> np.uint64((64 - turn) % 64)
        order = np.argsort(turned)
        _near(root, fps, order, np.zeros(len(order), np.int8), radius, 2)
    stack = _settled(root, fps, radius, value, left.astype(np.int8), np.arange(len(fps), dtype=np.int32), np.zeros(len(fps), np.int64), free)
    while stack:
        value, left, owner, cell, free = stack.pop()
        bits = min(4, free)
        fresh = np.r_[True, np.diff(cell) != 0]
        number = np.cumsum(fresh) - 1
        part = (np.cumsum(np.array([1, 5, 11, 15, 16])[np.minimum(left, 4)]) // SLICE)[np.flatnonzero(fresh)][number]
        cuts = np.flatnonzero(np.diff(part)) + 1
        if len(cuts):  # too much at once: cells are dealt on slice by slice, so that the stack holds few variants
            stack += [tuple(x[i:j].copy() for x in (value, left, owner, cell)) + (free,) for i, j in zip([0, *cuts], [*cuts, len(cell)], strict=True)]
            continue
        row, moved, rest, nibble = (np.concatenate(x) for x in zip(*_split(value, left, free, bits), strict=True))
        stack += _settled(root, fps, radius, moved, rest.astype(np.int8), owner[row], number[row] << bits | nibble, free - bits)
    return root


def links(reps: DataFrame, radius: int = 4, cell_bits: int | None = None) -> DataFrame:
    """Links (a, b) between representatives ``reps(rep long, fp long)`` of distinct fingerprints that connect
    exactly the fingerprints at ``radius`` (even) or fewer differing bits: a spanning forest of each cell."""
    half = radius // 2
    number = reps.count()
    if cell_bits is None:
        cell_bits = max(5, min(20, math.ceil(math.log2(max(1, number) / CELL_ROWS))))

    usual = number * sum(math.comb(cell_bits, k) for k in range(half + 1)) / (1 << cell_bits)
    limit = max(HOT, int(HOT_TIMES * usual))
    hot: dict[int, np.ndarray] = {}
    dealt, bits = _dealt(reps, half, cell_bits, hot), cell_bits
    while bits < MOST_BITS:  # crowded cells, as copies of one text with small changes make them, go to finer ones
        crowded = dealt.where(F.col("bits") == bits).groupBy("cell").count().where(F.col("count") > limit).select("cell").toArrow()
        if not crowded.num_rows:
            break
        hot = hot | {bits: np.sort(crowded.column("cell").to_numpy())}
        dealt, bits = _dealt(reps, half, cell_bits, hot), bits + SPLIT_BITS

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rep, fps = (table.column(n).to_numpy() for n in ("rep", "fp"))
        fps = fps.view(np.uint64)
        free = 64 - key[1].as_py()
        prefix = np.uint64(key[0].as_py())
        moved = fps & np.uint64((1 << free) - 1)
        left = half - np.bitwise_count(fps >> np.uint64(free) ^ prefix).astype(np.int64)
        order = np.argsort(rep)
        rep, fps, moved, left = rep[order], fps[order], moved[order], left[order]
        root = _connected(moved, left, fps, free, radius)
        own = np.flatnonzero(root != np.arange(len(rep)))
        return pa.table({"a": pa.array(rep[own], pa.int64()), "b": pa.array(rep[root[own]], pa.int64())})

    return dealt.groupBy("cell", "bits").applyInArrow(meet, "a long, b long")


def _dealt(reps: DataFrame, half: int, cell_bits: int, hot: dict[int, np.ndarray]) -> DataFrame:
    """(cell, bits, rep, fp): each fingerprint in all cells that hold variants of it. hot: by their bits, the cells that
    are split; each holds over HOT rows, which bounds their number."""

    def cells(value: np.ndarray, left: np.ndarray, row: np.ndarray, above: np.ndarray, free: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for own, moved, rest, cell in _split(value, left, free, bits):
            cell = above[own] << bits | cell
            depth = 64 - free + bits
            split = np.isin(cell, hot[depth]) if depth in hot else np.zeros(len(cell), bool)
            yield row[own[~split]], cell[~split], depth
            if split.any():
                yield from cells(moved[split], rest[split], row[own[split]], cell[split], free - bits, SPLIT_BITS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(rep), 4096):
                some = fps[at : at + 4096]
                for row, cell, depth in cells(some, np.full(len(some), half), np.arange(len(some)), np.zeros(len(some), np.int64), 64, cell_bits):
                    if len(row):
                        columns = [pa.array(cell), pa.array(np.full(len(row), depth, np.int32)), pa.array(rep[at:][row]), pa.array(some[row].view(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["cell", "bits", "rep", "fp"])

    return reps.select("rep", "fp").mapInArrow(deal, "cell long, bits int, rep long, fp long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest doc_id reachable by links
    of ``radius`` or fewer bits, the row's own included."""
    prints = written(fingerprints(docs, words, id_col, text_col))
    known = prints.where("doc_id is not null")
    reps = written(known.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # One doc_id can carry several texts: its smallest fingerprint's representative stands for all of them.
    shared = known.groupBy("doc_id").agg(F.min("fp").alias("fp"), F.max("fp").alias("fp2")).where("fp <> fp2")
    same_id = known.join(shared.select("doc_id"), "doc_id", "left_semi").join(reps, "fp").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    home = components(links(reps, radius).union(same_id))
    ids = reps.join(home.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(ids, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _gram_sets(docs: DataFrame, words: int) -> DataFrame:
    """Columns of ``docs(tag, grp, doc_id, text)`` but the text, and grams: hashes of the text's distinct word shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in pieces_of(batches, "text", 2 << 20):
            sets = []
            for text in batch.column("text").cast(pa.binary()):
                found = (text.as_py() or b"").lower().split()
                width = min(words, len(found))
                sets.append(np.array(sorted({xxhash.xxh64_intdigest(b" ".join(found[i : i + width]), 42) for i in range(len(found) - width + 1)} if found else ()), np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("tag"), batch.column("grp"), batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["tag", "grp", "doc_id", "grams"])

    return docs.select("tag", "grp", "doc_id", "text").mapInArrow(work, "tag long, grp long, doc_id long, grams array<long>")


def _thinned(least: float):
    """Of a group's rows (tag, doc_id, grams), in the order of their doc_id: the tags of those that are like one that stays."""

    def thin(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = sorted(range(table.num_rows), key=lambda i, d=table.column("doc_id").to_pylist(), t=table.column("tag").to_pylist(): (d[i] is None, d[i] or 0, t[i]))
        lists, tags, gone = table.column("grams").combine_chunks(), table.column("tag").to_pylist(), []
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        many = lists.value_lengths().to_numpy()
        stop = np.r_[0, np.cumsum(many)]
        names, grams = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        # Postings of the texts that stay as chains in three arrays: a gram's last posting, each posting's text and the one before it.
        last, text_of, before = np.full(len(names), -1, np.int32), np.empty(len(grams), np.int32), np.empty(len(grams), np.int32)
        size: list[int] = []
        used = 0
        for i in order:
            own = grams[stop[i] : stop[i + 1]]
            at, met = last[own], []
            while len(at := at[at >= 0]):
                met.append(text_of[at])
                at = before[at]
            if met:
                found, n = np.unique(np.concatenate(met), return_counts=True)
                alike = (n / (len(own) + np.array(size)[found] - n) >= least).any()
            else:
                alike = not len(own) and 0 in size
            if alike:
                gone.append(tags[i])
                continue
            new = np.arange(used, used + len(own), dtype=np.int32)
            text_of[new], before[new] = len(size), last[own]
            last[own] = new
            used += len(own)
            size.append(len(own))
        if len(grams) > LARGE:
            del lists, names, grams, last, text_of, before
            give_back()
        return pa.table({"tag": pa.array(gone, pa.int64())})

    return thin


def near_copies(docs: DataFrame, words: int = 5, radius: int = 6, least: float = 0.8) -> DataFrame:
    """(tag) of the distinct texts of ``docs(doc_id, text, tag)`` that go: of the texts that fingerprints of their distinct words
    at ``radius`` or fewer bits connect, in the order of their doc_id, each goes whose exact Jaccard similarity of
    word shingles with one that stays is ``least`` or more.

    A group of up to GROUP_GRAMS shingles is one task's. A larger one is worked off in rounds: its first HEADS texts are thinned,
    and all others, spread by a salt, are compared with those that stay; what is like them goes. So copies of one text are
    gone in a round however many they are, no task holds an unbounded group, and no pairs are listed.
    """
    prints = written(fingerprints(docs, 1, "tag", distinct=True).distinct())
    reps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    edges = links(reps, radius).union(prints.join(reps, "fp").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    groups = written(components(edges).select(F.col("node").alias("tag"), F.col("component").alias("grp")))
    passes = passing(groups.select(F.col("tag").alias("key")))
    rows = docs if passes is None else sifted(docs, passes, True, "tag")
    texts = rows.join(groups, "tag").groupBy("tag", "grp").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    left, gone = written(_gram_sets(texts, words)), []
    order = (F.col("doc_id").isNull(), "doc_id", "tag")
    while True:
        crowded = left.groupBy("grp").agg(F.sum(F.size("grams")).alias("n")).where(F.col("n") > GROUP_GRAMS).select("grp")
        gone.append(left.join(crowded, "grp", "left_anti").groupBy("grp").applyInArrow(_thinned(least), "tag long"))
        large = written(left.join(crowded, "grp", "left_semi"))
        if large.isEmpty():
            break
        first = large.select("grp", "tag", "doc_id").withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(*order))).where(F.col("r") <= HEADS)
        heads = written(large.join(first.select("tag"), "tag", "left_semi"))
        dropped = written(heads.groupBy("grp").applyInArrow(_thinned(least), "tag long"))
        stay = heads.join(dropped, "tag", "left_anti").select("grp", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.col("grams").alias("theirs"))
        rest = large.join(heads.select("tag"), "tag", "left_anti").withColumn("salt", F.pmod(F.xxhash64("tag"), F.lit(SALTS)).cast("int"))
        # Only sets of like size can be alike; empty sets are alike.
        both = F.size(F.array_intersect("grams", "theirs"))
        sizes = F.coalesce(F.least(F.size("grams"), F.size("theirs")) / F.nullif(F.greatest(F.size("grams"), F.size("theirs")), F.lit(0)), F.lit(1.0)) >= least
        either = F.size("grams") + F.size("theirs") - both
        like = sizes & (F.coalesce(both / F.nullif(either, F.lit(0)), F.lit(1.0)) >= least)
        same = rest.join(stay, (rest.grp == stay.grp) & (rest.salt == stay.salt) & like, "left_semi").select("tag")
        gone += [dropped, same := written(same)]
        left = written(rest.drop("salt").join(same, "tag", "left_anti"))
    return functools.reduce(DataFrame.union, gone)


def keep_first(docs: DataFrame, words: int = 5, radius: int = 6, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` (all its columns) without near_copies; of rows with one text, whatever their ids, one
    stays: that with the smallest doc_id (null ids last), then by a hash of the row. Rows that neither concerns stay in their task.

    Defined cases: null and empty texts are one text, and like texts without words; texts of any length count whole; further columns may have
    any name and type, maps too; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    tag = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), tag.alias("tag"))
    again = written(rows.groupBy("tag").count().where("count > 1").select("tag"))
    gone = written(near_copies(rows, words, radius, least))
    touched = gone.union(again)
    own, row = fresh(docs, "tag", "row")
    sure, maybe = parted(docs.withColumn(own, tag), touched.select(F.col("tag").alias("key")), own)
    out = sure.drop(own).union(maybe.join(touched.withColumnRenamed("tag", own), own, "left_anti").select(*every(docs)))
    if again.isEmpty():
        return out
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row_hash(docs))
    kept = maybe.join(again.join(gone, "tag", "left_anti").withColumnRenamed("tag", own), own)
    return out.union(kept.groupBy(own).agg(F.min_by(F.struct(*every(docs)), order).alias(row)).select(f"{row}.*"))
