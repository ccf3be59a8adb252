"""Compression of vectors to short codes by product quantisation.

Each vector becomes integers, floor(256 * x), and is cut into PARTS equal parts; each part position has a codebook of
at most ENTRIES entries and a part's code is the index of its nearest entry. Nearest entries are found by a
vantage-point tree for each part position: an inner node holds one entry and the range of radii of the entries nearer
and farther than its median. A branch is left out only if its lower bound, from radii rounded outwards, exceeds the
best distance so far, so that branches that could hold an equal distance are visited; distances themselves are
compared as integers, with ties to the lower index. A batch of parts walks the tree together.

The codebooks start as the parts of the first vectors and are refined by whole passes over all vectors: tasks sum up
their own parts, Spark adds the sums, and the driver holds nothing but the entries (PARTS * ENTRIES).

Defined cases: rows whose vector is null, empty, of a length that PARTS does not divide, or holds null or non-finite
components are left out, and rows of another length than the first kept row. Equal ids are ordered by their
vectors, null ids come last. Fewer rows than ENTRIES give smaller codebooks, an empty table no rows. Repeated
rows each get their row. Null labels are one label. Components above LARGEST raise ValueError; an error beyond
a long is null. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Entries of a leaf of the tree.
LEAF = 6
LARGEST = 1e20
#: Labels whose sums are sent to every executor; more are joined by a shuffle.
MOST_LABELS = 1_000_000


def _down(squared: np.ndarray) -> np.ndarray:
    """Distances from squared ones, rounded down with a margin."""
    return np.sqrt(np.asarray(squared).astype(np.float64)) * (1 - 2.0**-50)


def _up(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squared).astype(np.float64)) * (1 + 2.0**-50)


@dataclass
class _Node:
    """One entry, or the entries of a leaf; below an inner node the nearer and the farther half with their radii."""

    ids: np.ndarray
    near: _Node | None = None
    far: _Node | None = None
    near_radii: tuple[float, float] = (0.0, 0.0)
    far_radii: tuple[float, float] = (0.0, 0.0)


class Tree:
    """Vantage-point tree over the entries (rows of integers) of one part position."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._grown(np.arange(len(entries)))

    def _grown(self, ids: np.ndarray) -> _Node:
        if len(ids) <= LEAF:
            return _Node(np.sort(ids))
        # The entry farthest from the first one lies at the rim, where a ball around it splits best.
        away = self._squared(self.entries[ids], self.entries[ids[0]])
        top = ids[np.argmax(away)]
        rest = ids[ids != top]
        squared = self._squared(self.entries[rest], self.entries[top])
        order = np.argsort(squared, kind="stable")
        rest, squared = rest[order], squared[order]
        half = len(rest) // 2
        radii = [(float(_down(s[0])), float(_up(s[-1]))) for s in (squared[:half], squared[half:])]
        return _Node(np.array([top]), self._grown(rest[:half]), self._grown(rest[half:]), *radii)

    @staticmethod
    def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        apart = a - b
        return (apart * apart).sum(axis=-1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry; of equal ones the lowest index."""
        index = np.full(len(points), len(self.entries))
        squared = self._squared(points, self.entries[0])
        self.visited = 0
        if len(points):
            self._visit(self.root, points, np.arange(len(points)), index, squared)
        return index, squared

    def _offered(self, rows: np.ndarray, ids: np.ndarray | int, found: np.ndarray, index: np.ndarray, squared: np.ndarray) -> None:
        now = squared[rows]
        better = (found < now) | ((found == now) & (ids < index[rows]))
        ids = ids[better] if isinstance(ids, np.ndarray) else ids
        index[rows[better]], squared[rows[better]] = ids, found[better]

    def _visit(self, node: _Node, points: np.ndarray, rows: np.ndarray, index: np.ndarray, squared: np.ndarray) -> None:
        self.visited += len(rows) * len(node.ids)
        if node.near is None:
            every = self._squared(points[rows, None, :], self.entries[node.ids])
            least = every.argmin(axis=1)
            self._offered(rows, node.ids[least], every[np.arange(len(rows)), least], index, squared)
            return
        found = self._squared(points[rows], self.entries[node.ids[0]])
        self._offered(rows, int(node.ids[0]), found, index, squared)
        low, high = _down(found), _up(found)
        inside = high <= node.near_radii[1]
        for side, order in ((inside, ("near", "far")), (~inside, ("far", "near"))):
            for name in order:
                least, most = getattr(node, f"{name}_radii")
                bound = np.maximum(least - high[side], low[side] - most)
                open_ = rows[side][bound <= _up(squared[rows[side]])]
                if len(open_):
                    self._visit(getattr(node, name), points, open_, index, squared)


@dataclass(frozen=True)
class Codebooks:
    """entries[part][index] is a tuple of integers; parts is the number of part positions."""

    entries: list[list[tuple[int, ...]]]
    width: int

    @property
    def parts(self) -> int:
        return len(self.entries)

    def sha256(self) -> str:
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decoded(self, code: str) -> list[int]:
        """The integers that a code stands for."""
        return [x for p in range(self.parts) for x in self.entries[p][int(code[2 * p : 2 * p + 2], 16)]]

    def trees(self, kind: type) -> list[Tree]:
        return [Tree(np.array(part, dtype=kind)) for part in self.entries]


class _Coder:
    """Assigns batches of vectors; exact Python integers take over where a long could overflow."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.most = max((abs(x) for part in books.entries for entry in part for x in entry), default=0)
        self.kept: dict[type, list[Tree]] = {}

    def parts_of(self, vectors: pa.ListArray) -> np.ndarray:
        """(row, part, position) integers."""
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if len(flat) and np.abs(flat).max() > LARGEST:
            raise ValueError(f"components above {LARGEST} have no exact code")
        whole = np.floor(flat * 256)
        most = max(float(np.abs(whole).max()) if len(whole) else 0.0, float(self.most))
        kind = np.int64 if 4 * most * most * self.books.width < 2.0**62 else object
        whole = whole.astype(np.int64) if kind is np.int64 else np.array([int(x) for x in whole], dtype=object)
        return whole.reshape(len(vectors), self.books.parts, -1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) indexes and squared distances."""
        kind = object if parts.dtype == object else np.int64
        if kind not in self.kept:
            self.kept[kind] = self.books.trees(kind)
        index = np.zeros(parts.shape[:2], np.int64)
        squared = np.zeros(parts.shape[:2], kind)
        for p, tree in enumerate(self.kept[kind]):
            index[:, p], squared[:, p] = tree.nearest(parts[:, p])
        return index, squared


def kept(vectors: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, vec, label) of the rows with a whole vector."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & (F.size("vec") % parts == 0) & finite)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks over all of ``rows`` (as from ``kept``); None if there are none."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    first = rows.select("vec_id", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "vec")
    start = first.limit(entries).collect()
    if not start:
        return None
    width = len(start[0].vec)
    if any(len(r.vec) != width for r in start):
        start = first.where(F.size("vec") == width).limit(entries).collect()
    now = _Coder(Codebooks([[] for _ in range(parts)], width)).parts_of(pa.array([r.vec for r in start], pa.list_(pa.float64())))
    books = Codebooks([[tuple(int(x) for x in row[p]) for row in now] for p in range(parts)], width)
    for _ in range(rounds):
        sums: dict[tuple[int, int], dict[int, int]] = {}
        for r in _sums(rows, books).collect():  # a row for each component of each entry
            sums.setdefault((r.part, r.entry), {})[r.position] = int(r.total) // r.n
        books = Codebooks([[tuple(sums[p, e][i] for i in range(len(old))) if (p, e) in sums else old for e, old in enumerate(part)] for p, part in enumerate(books.entries)], width)
    return books


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, position, n, total): sums of the parts that are nearest to each entry."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, coder = shared.value, _Coder(shared.value)
        size = books.width // books.parts
        most = len(books.entries[0])
        counts = np.zeros(books.parts * most, np.int64)
        totals = np.zeros((books.parts * most, size), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = coder.parts_of(batch.column("vec"))
            place = (coder.nearest(parts)[0] + most * np.arange(books.parts)).ravel()
            counts += np.bincount(place, minlength=len(counts))
            flat, order = parts.reshape(-1, size), np.argsort(place, kind="stable")
            seen, starts = np.unique(place[order], return_index=True)
            totals[seen] += np.add.reduceat(flat[order], starts, axis=0).astype(object)
        used = np.flatnonzero(counts)
        spread = np.repeat(used, size)
        columns = [pa.array((spread // most).astype(np.int32)), pa.array((spread % most).astype(np.int32)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(used))), pa.array(np.repeat(counts[used], size))]
        total = pa.array([Decimal(int(x)) for x in totals[used].ravel()], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*columns, total], names=["part", "entry", "position", "n", "total"])

    own = rows.where(F.size("vec") == books.width).select("vec")
    return own.mapInArrow(work, "part int, entry int, position int, n long, total decimal(38,0)").groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of every row of the codebooks' width."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kinds = rows.select("vec_id", "label").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(shared.value)
        wide = 2 * shared.value.parts
        for batch in batches:
            if not batch.num_rows:
                continue
            index, squared = coder.nearest(coder.parts_of(batch.column("vec")))
            digits = index.astype(np.uint8).tobytes().hex()
            errors = [int(x) for x in squared.sum(axis=1)]
            codes = pa.array([digits[i : i + wide] for i in range(0, len(digits), wide)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), codes, pa.array([x if x < 1 << 63 else None for x in errors], pa.int64())], names=["vec_id", "label", "code", "error"])

    from pyspark.sql.types import LongType, StringType, StructType

    out = StructType([*kinds.fields]).add("code", StringType()).add("error", LongType())
    return rows.where(F.size("vec") == books.width).select("vec_id", "vec", "label").mapInArrow(work, out)


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a whole vector."""
    rows = kept(vectors, parts)
    books = fit(rows, parts, entries, rounds)
    digest = F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    if books is None:
        return rows.limit(0).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), digest)
    coded = written(encode(rows, books))
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    right = F.broadcast(sums) if sums.count() <= MOST_LABELS else sums
    return coded.join(right, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", digest)


def oracle() -> str:
    """SQL of the query's rows over ``embeddings`` of 64 components."""
    size = 4
    names = [f"x{i}" for i in range(size)]
    ctes = [
        "whole AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS (SELECT r, vec_id, label, p, {', '.join(f'v[{size} * p + {i + 1}] AS {n}' for i, n in enumerate(names))} FROM whole, range({PARTS}) AS t(p))",
        f"book0 AS (SELECT p, r - 1 AS e, {', '.join(names)} FROM parts WHERE r <= {ENTRIES})",
    ]
    apart = " + ".join(f"(a.{n} - b.{n}) * (a.{n} - b.{n})" for n in names)
    for k in range(ROUNDS + 1):
        ctes.append(f"near{k} AS (SELECT r, p, min({{'d': {apart}, 'e': e}}) AS m FROM parts a JOIN book{k} b USING (p) GROUP BY r, p)")
        if k < ROUNDS:
            floors = ", ".join(f"((sum({n}) - (sum({n}) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS {n}" for n in names)
            ctes.append(f"mean{k} AS (SELECT p, m.e AS e, {floors} FROM near{k} JOIN parts USING (r, p) GROUP BY ALL)")
            ctes.append(f"book{k + 1} AS (SELECT p, e, {', '.join(f'coalesce(m.{n}, b.{n}) AS {n}' for n in names)} FROM book{k} b LEFT JOIN mean{k} m USING (p, e))")
    joined = ", ',', ".join(names)
    ctes.append(f"digest AS (SELECT sha256(string_agg(concat({joined}), ',' ORDER BY p, e)) AS h FROM book{ROUNDS})")
    ctes.append(f"coded AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)")
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM coded JOIN whole USING (r), digest"
