"""Substring dedup with prefix-partitioned suffix trees, cut at the depth of a window.

Every start of a window of ``window`` words is a suffix. A suffix is dealt to its group by a prefix whose length varies. The first
prefix ends with the window's minimizer, the gram of GRAM words with the smallest hash, and its deal uses just that gram, so
that neighbouring suffixes travel as one segment of text. Equal windows have equal minimizers in the same place, so they meet. A group
is one subtree; where a gram's suffixes outgrow HOT words (after repeats are gone), its prefixes are lengthened and the
suffixes dealt once more: those that begin at most half of what the window leaves before the gram take words behind it, the others words
before it, so that all of them hold the lengthened gram whole (12 and 13 words for windows of 20). What outgrows HOT again is dealt by the whole
window. At that depth all suffixes of one prefix are one node, of which a task keeps one, so no prefix needs a third lengthening.

A subtree is built from ranks by prefix doubling: word numbers (by the words themselves, not by hashes) give ranks at
depth 1, pairs of ranks those at depths 2, 4, 8, 16, and two overlapping ones that of the window. Suffixes with one rank at full depth hang under one
internal node at least that deep: a repeat. In each such node all suffixes but the earliest are marked; runs of marked starts are
the maximal repeats (a run of n starts is n + window - 1 words), and the words they cover are removed.

Before the shuffle each batch of text is such a subtree itself: it marks its own repeats and ships the earliest suffix of each node only, so
that a passage of a third of all rows is one segment a batch. A group that outgrows LIMIT words on the way is worked off in
turns that keep the earliest suffix of each node.

Defined cases: a null text has no words; earlier means smaller doc_id, then (for rows that share an id) the smaller hash of the
text, then the earlier start; rows that repeat both are the same document; rows without an id come first; texts below
``window`` words lose nothing; very long texts are cut into as many segments as they need; other columns, whatever their names, are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, written

GRAM = 4
#: Text bytes of the input for each group and of a batch, words that a group gathers before a turn, and words that a turn ranks at once.
GROUP_BYTES, BATCH_BYTES, LIMIT, RANKED = 12 << 20, 5 << 20, 8_000_000, 600_000
#: Words that suffixes of one prefix may hold before it is lengthened, and the most partitions of the shuffle.
HOT, MOST_PARTS = 2_000_000, 20_000
#: Segments that are lengthened together.
LENGTHENED = 10_000
NO_ID = -(1 << 63)


class _Words(dict):
    """Word to its number; hashes[number] is the word's 64-bit hash."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        import xxhash

        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring grams as one."""
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` words from each place; shorter by width - 1."""
    done, size, out = h, 1, None
    at, rest = 0, width
    while rest:
        if rest & 1:
            part = done[at : at + len(h) - width + 1]
            out = part if out is None else _join(out, part)
            at += size
        rest >>= 1
        if rest:
            done, size = _join(done[:-size], done[size:]), 2 * size
    return out


def _ranges(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers as runs (start, length)."""
    if not len(at):
        return at, at
    first = np.flatnonzero(np.r_[True, np.diff(at) != 1])
    return at[first], np.diff(np.r_[first, len(at)])


def _packed(arrays: list[np.ndarray], text: bytes) -> bytes:
    body = b"".join([np.int64(len(arrays[0])).tobytes(), *(a.tobytes() for a in arrays), text])
    return np.int64(len(body)).tobytes() + pa.Codec("zstd", 6).compress(body, asbytes=True)


def _unpacked(blob: bytes, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    body = pa.Codec("zstd").decompress(blob[8:], int(np.frombuffer(blob[:8], np.int64)[0]), asbytes=True)
    n, at, arrays = int(np.frombuffer(body[:8], np.int64)[0]), 8, []
    for kind in kinds:
        arrays.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return arrays, body[at:]


#: id, tag, start, number of suffixes, place of the dealt gram after the start, short hash of the prefix; the words follow, a line a segment.
_SEGMENT = ("i8", "i8", "i4", "u1", "u1", "u4")
#: id, tag, start, number of suffixes that repeat.
_MARKED = ("i8", "i8", "i4", "i4")
#: What a row holds: segments for their group, marked runs, segments for the group of a longer prefix.
_DEALT, _MARKS, _LONGER = 0, 1, 2
_ROWS = "part int, kind int, level int, size long, blob binary"


def _nodes(word: np.ndarray, suffix: np.ndarray, window: int) -> np.ndarray:
    """The node at window depth under which each suffix hangs, from ranks at doubled depths; each suffix has ``window`` words."""
    rank, depth = word, 1
    while 2 * depth <= window and len(rank) > depth:
        rank = np.unique(rank[:-depth].astype(np.int64) << 32 | rank[depth:], return_inverse=True)[1]
        depth *= 2
    if depth == window:
        return rank[suffix]
    return np.unique(rank[suffix].astype(np.int64) << 32 | rank[suffix + window - depth], return_inverse=True)[1]


def _repeated(node: np.ndarray, where: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes of each node, the earliest first: (those at another place than the first, all but the first)."""
    order = np.lexsort((*where[::-1], node))
    fresh = np.r_[True, np.diff(node[order]) != 0][: len(order)]
    first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    same = np.logical_and.reduce([x[order] == x[first] for x in where])
    return order[~same], order[~fresh]


def _batch(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["part", "kind", "level", "size", "blob"])


def _segments(level: int, kind: int, groups: int, columns: tuple[np.ndarray, ...], texts: Callable[[np.ndarray], list[bytes]], key: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
    """Rows of segments (id, tag, start, count, gram place), dealt to groups by the 64-bit hash of their prefix."""
    part = (key >> np.uint64(40)) % np.uint64(groups)
    order = np.argsort(part, kind="stable")
    out = []
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(own):
            text = b"\n".join(texts(own))
            out.append((int(part[own[0]]), kind, level, len(text), _packed([*(c[own] for c in columns), (key[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32)], text)))
    return out


def _deal(window: int, groups: int):
    """Batches of (id, tag, text) to rows: segments for their groups, and what repeats inside the batch."""
    span = window - GRAM + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Words()
        for batch in pieces_of(batches, "text", BATCH_BYTES):
            if len(numbers) > 200_000:
                numbers = _Words()
            rows = sorted({(i, t): k for k, (i, t) in enumerate(zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(), strict=True))}.items())
            texts = batch.column("text").cast(pa.binary())
            words = [(texts[k].as_py() or b"").split() for _, k in rows]
            size = np.array([len(w) for w in words])
            if not len(size) or size.max() < window:
                continue
            ids, tags = (np.array([r[0][j] for r in rows], np.int64) for j in (0, 1))
            flat = [w for own in words for w in own]
            del words
            word = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
            length = np.fromiter(map(len, flat), np.int64, len(flat))
            joined, ends = b" ".join(flat), np.cumsum(length + 1) - 1
            del flat
            begin = np.cumsum(size) - size
            doc = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(word)) - begin[doc]
            start = np.flatnonzero(place + window <= size[doc])

            again, gone = _repeated(_nodes(word, start, window), (start,))
            marked, dropped = (np.zeros(len(word), bool) for _ in range(2))
            marked[start[again]], dropped[start[gone]] = True, True
            kept = start[~dropped[start]]

            gram = _gram_hashes(np.array(numbers.hashes, np.uint64)[word], GRAM)
            view = np.lib.stride_tricks.sliding_window_view(gram, span)
            anchor = np.concatenate([kept[i : i + 65_536] + view[kept[i : i + 65_536]].argmin(axis=1) for i in range(0, len(kept), 65_536)] or [kept])
            cut = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(kept) != 1)])
            count = np.diff(np.r_[cut, len(kept)])
            begun = kept[cut]
            left, right = (ends - length)[begun], ends[begun + count + window - 2]
            columns = (ids[doc[begun]], tags[doc[begun]], place[begun].astype(np.int32), count.astype(np.uint8), (anchor[cut] - begun).astype(np.uint8))
            out = _segments(0, _DEALT, groups, columns, lambda own, l=left, r=right, t=joined: [t[x:y] for x, y in zip(l[own].tolist(), r[own].tolist(), strict=True)], gram[anchor[cut]] * np.uint64(0x9E3779B97F4A7C15))
            at, many = _ranges(np.flatnonzero(marked))
            if len(at):
                blob = _packed([ids[doc[at]], tags[doc[at]], place[at].astype(np.int32), many.astype(np.int32)], b"")
                out.append((int(at[0]) % groups, _MARKS, 0, 0, blob))
            yield _batch(out)

    return deal


class _Subtree:
    """The suffixes of one group, dealt at a level: 0 by minimizers, 1 by lengthened grams, 2 by whole windows."""

    def __init__(self, window: int, level: int, groups: int, bounds: tuple[int, int, int, int]):
        self.window, self.level, self.groups = window, level, groups
        self.limit, self.at_once, self.most, self.chunk = bounds
        self.words, self.next, self.held = 0, self.limit, []
        self.hot = np.zeros(0, np.uint32)

    def add(self, blob: bytes) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
        """Takes segments in; gives back those whose prefix is lengthened already."""
        (ids, tags, start, count, gram, key), text = _unpacked(blob, _SEGMENT)
        own = (ids, tags, start, (1 << count.astype(np.int64)) - 1, gram, key, np.array(text.split(b"\n"), object))
        if len(self.hot):
            out = np.isin(key, self.hot)
            yield from self._lengthened(tuple(c[out] for c in own))
            own = tuple(c[~out] for c in own)
        self.held.append(own)
        self.words += sum(map(len, own[6])) // 6

    def turn(self) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
        """Rows of the suffixes that repeat, and of segments whose prefix has to be longer; what stays is the earliest suffix
        of each node. Segments of one prefix are ranked together, RANKED words or one prefix at a time."""
        columns = [np.concatenate([x[i] for x in self.held]) for i in range(7)]
        order = np.argsort(columns[5], kind="stable")
        ids, tags, start, alive, gram, key, text = (c[order] for c in columns)
        self.held, columns = [], []
        group = np.cumsum(np.r_[0, np.diff(key.astype(np.int64)) != 0])[: len(key)]
        met = np.flatnonzero(np.bincount(group)[group] > 1) if len(key) else np.zeros(0, np.int64)
        size = np.fromiter(map(len, text[met]), np.int64, len(met)) // 6
        chunk = np.cumsum(size) // self.at_once
        fresh = np.r_[True, np.diff(group[met]) != 0][: len(met)]
        chunk = chunk[np.maximum.accumulate(np.where(fresh, np.arange(len(met)), 0))] if len(met) else chunk
        for own in np.split(met, np.flatnonzero(np.diff(chunk)) + 1):
            if len(own):
                found, gone = self._ranked(ids[own], tags[own], start[own], alive[own], text[own])
                alive[own] &= ~gone
                if len(found[0]):
                    yield [(0, _MARKS, self.level, 0, _packed(list(found), b""))]
        left = np.flatnonzero(alive)
        ids, tags, start, alive, gram, key, text = (c[left] for c in (ids, tags, start, alive, gram, key, text))
        size = np.fromiter(map(len, text), np.int64, len(text)) // 6
        if self.level < 2 and len(key):
            known, at = np.unique(key, return_inverse=True)
            self.hot = np.union1d(self.hot, known[np.bincount(at, size) > self.most])
            out = np.isin(key, self.hot)
            yield from self._lengthened(tuple(c[out] for c in (ids, tags, start, alive, gram, key, text)))
            ids, tags, start, alive, gram, key, text, size = (c[~out] for c in (ids, tags, start, alive, gram, key, text, size))
        self.held = [(ids, tags, start, alive, gram, key, text)]
        self.words = int(size.sum())
        self.next = max(self.limit, 2 * self.words)

    def _ranked(self, ids: np.ndarray, tags: np.ndarray, start: np.ndarray, alive: np.ndarray, text: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        known: dict[bytes, int] = {}
        split = [x.split() for x in text]
        size = np.fromiter(map(len, split), np.int64, len(split))
        word = np.array([known.setdefault(w, len(known)) for s in split for w in s], np.int64)
        del split, known
        begin = np.cumsum(size) - size
        row, offset = np.nonzero(alive[:, None] >> np.arange(64)[None, : self.window] & 1)
        again, gone = _repeated(_nodes(word, begin[row] + offset, self.window), (ids[row], tags[row], start[row] + offset))
        bits = np.zeros(len(ids), np.int64)
        np.bitwise_or.at(bits, row[gone], np.int64(1) << offset[gone])
        at, many = _ranges(np.sort(row[again] * 128 + offset[again]))
        return (ids[at // 128], tags[at // 128], start[at // 128] + (at % 128).astype(np.int32), many.astype(np.int32)), bits

    def _lengthened(self, own: tuple[np.ndarray, ...]) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
        """The segments' suffixes under longer prefixes, as rows for the next round."""
        import xxhash

        half = (self.window - GRAM) // 2  # a suffix that begins at most so far before the gram takes the words behind it
        for begin in range(0, len(own[0]), self.chunk):
            ids, tags, start, alive, gram, _, text = (c[begin : begin + self.chunk] for c in own)
            out, keys = [], []
            for row in range(len(ids)):
                words, at = text[row].split(), int(gram[row])
                for first, last in self._runs([i for i in range(64) if int(alive[row]) >> i & 1], at - half):
                    if self.level:
                        prefix = words[first : first + self.window]
                    elif first >= at - half:
                        prefix = words[at : at + self.window - half]
                    else:
                        prefix = words[at - half - 1 : at + GRAM]
                    keys.append(xxhash.xxh3_64_intdigest(b" ".join(prefix)))
                    out.append((ids[row], tags[row], start[row] + first, last - first + 1, at - first, b" ".join(words[first : last + self.window])))
            if out:
                columns = tuple(np.array([x[i] for x in out], kind) for i, kind in enumerate(_SEGMENT[:5]))
                yield _segments(self.level + 1, _LONGER, self.groups, columns, lambda own, out=out: [out[i][5] for i in own], np.array(keys, np.uint64))

    def _runs(self, starts: list[int], middle: int) -> list[tuple[int, int]]:
        """Starts as runs that share a prefix: single ones at the last level, else those before ``middle`` and those from it on."""
        runs: list[list[int]] = []
        for i in starts:
            joined = runs and runs[-1][1] == i - 1 and self.level == 0 and i != middle
            if joined:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        return [(a, b) for a, b in runs]


def _grow(window: int, level: int, groups: int, bounds: tuple[int, int, int, int]):
    """Sorted (part, kind, level, size, blob) rows of a level to rows of marked runs, and of segments for the next level."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree = None, _Subtree(window, level, groups, bounds)
        for batch in batches:
            for here, kind, blob in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                if here != part or tree.words > tree.next:
                    if tree.held:
                        yield from map(_batch, tree.turn())
                    if here != part:
                        part, tree = here, _Subtree(window, level, groups, bounds)
                if kind == _MARKS:
                    yield _batch([(here, _MARKS, level, 0, blob.as_py())])
                else:
                    yield from map(_batch, tree.add(blob.as_py()))
        if tree.held:
            yield from map(_batch, tree.turn())

    return grow


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marked runs (id, tag, start, n) of rows that hold them."""
    for batch in batches:
        for blob in batch.column("blob"):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _unpacked(blob.as_py(), _MARKED)[0]], names=["id", "tag", "start", "n"])


def _rounds(docs: DataFrame, window: int, groups: int | None) -> list[DataFrame]:
    """The rows that each level's subtrees gave: the first level's, and those of longer prefixes where some were needed."""
    if window < GRAM + 1 or window > 60:
        raise ValueError("windows have 5 to 60 words")
    if groups is None:
        groups = int((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES) + 8
    rows, found = docs.mapInArrow(_deal(window, groups), _ROWS), []
    for level in range(3):
        dealt = rows.repartitionById(min(groups, MOST_PARTS), F.col("part")).sortWithinPartitions("part", "kind")
        found.append(written(dealt.mapInArrow(_grow(window, level, groups, (LIMIT, RANKED, HOT, LENGTHENED)), _ROWS)))
        rows = found[-1].where(F.col("kind") == _LONGER)
        size = rows.agg(F.sum("size")).first()[0]
        if not size:
            break
        groups = int(size // GROUP_BYTES) + 8
    return found


def repeats(docs: DataFrame, window: int = 20, groups: int | None = None) -> DataFrame:
    """(id, tag, start, n): the windows of ``docs(id, tag, text)`` whose words start earlier too, as runs of starts. A run is
    a repeat of n + window - 1 words; runs of one document that follow each other make up its maximal repeats."""
    marks = functools.reduce(DataFrame.union, _rounds(docs, window, groups)).where(F.col("kind") == _MARKS)
    return marks.select("blob").mapInArrow(_runs, "id long, tag long, start int, n int")


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            out = []
            for text, runs in zip(batch.column("text").cast(pa.binary()), batch.column("runs"), strict=True):
                words = (text.as_py() or b"").split()
                gone = 0
                if runs.is_valid and len(runs.values):
                    edge = np.zeros(len(words) + 1, np.int32)
                    start, many = (runs.values.field(i).to_numpy() for i in (0, 1))
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + many + window - 1, -1)
                    keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    gone, words = len(words) - len(keep), [words[i] for i in keep.tolist()]
                kept = b" ".join(words)
                out.append((len(words) + gone, gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
            n, gone, digest, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest), pa.array(kept)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return cut


def without_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row; kept: the words left, joined by one space."""
    ident, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    source = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    marked = repeats(source.select("id", "tag", "text"), window)
    runs = marked.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = source.join(runs, ["id", "tag"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
