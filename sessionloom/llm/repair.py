"""Repair of damaged conversations: the cheapest edits that give a lawful order of turns.

The edit lattice of a conversation has a node for each (rows read, state of the order), where the states are start, after
system, after user and after assistant. An edge keeps, reroles or deletes the next row or inserts a turn. A* searches it
with a heuristic that never exceeds the true cost: suffix sums of the deletions that blank and repeated rows force and of
the least charge (deletion) of truncated ones. Open nodes are ordered by (cost plus heuristic, audit), so that the
first arrival at a node is its cheapest one with the ASCII-least audit.

Long conversations are cut into blocks of BLOCK rows. A block's search from each state gives a table of 4 x 4 (cost,
audit), and tables are joined like shortest paths: no insertion ends a block, hence no audit of the same rows is a
prefix of another and the order of audits survives joining. Rows are dealt by ranges of (conversation, turn), so that one very long
conversation is spread over tasks; only the tables of conversations that a range bound cuts meet again.
Texts are not part of this; they move once, afterwards, to their conversation's edits and are hashed in
order as a stream, with the audit of one conversation in memory and no rows.

Defined cases: nulls of any column read as one space (a null conversation is one of its own); rows of equal turns are ordered by
a digest of role and text, so repeats are adjacent; a conversation without rows after damage has zeros, an empty
audit and the hash of no text; empty tables give no rows; texts are read whole; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of one search.
BLOCK = 256
START, SYSTEM, USER, ASSISTANT = range(4)
#: What ends a conversation from each state.
TAILS = ("", "II", "I", "")
#: Kinds of rows: system, user, assistant or another role; FORCED rows must go, CUT ones cost while they stay.
KINDS, FORCED, CUT = "sua", 4, 8
SPACE = " \t\n\x0b\f\r"
LAWFUL = ("su", "ua", "au")

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SEGMENT = (
    "conv_id long, place int, open boolean, n long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
    "least_turn long, most_turn long, turns long, costs array<long>, audits array<string>"
)


def _turned(state: int) -> int:
    """The state after one more user or assistant turn, whichever is lawful."""
    return ASSISTANT if state == USER else USER


def _edits(state: int, row: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, next state) of what may become of a row."""
    yield DELETE, "D", state
    if row & FORCED:
        return
    fee = TRUNCATED if row & CUT else 0
    kind = row & 3
    if (kind == 0 and state == START) or (kind == 1 and state != USER) or (kind == 2 and state == USER):
        yield KEEP + fee, "K", kind + 1
    yield REROLE + fee, "R", _turned(state)


@functools.lru_cache(1 << 16)
def search(rows: bytes, source: int) -> tuple[tuple[int, str] | None, ...]:
    """A* from a state through a block: for each state behind its last row the least cost and the least audit of that cost."""
    left = [0]
    for row in reversed(rows):
        left.append(left[-1] + (DELETE if row & FORCED else min(DELETE, TRUNCATED) if row & CUT else 0))
    left.reverse()
    ends: list[tuple[int, str] | None] = [None] * 4
    done = set()
    heap = [(left[0], "", 0, source)]
    while heap:
        reached, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = reached - left[i]
        if i == len(rows):
            ends[state] = (cost, audit)
            continue
        for more, letter, then in _edits(state, rows[i]):
            if (i + 1, then) not in done:
                heapq.heappush(heap, (cost + more + left[i + 1], audit + letter, i + 1, then))
        if (i, _turned(state)) not in done:
            heapq.heappush(heap, (cost + INSERT + left[i], audit + "I", i, _turned(state)))
    return tuple(ends)


Table = tuple[tuple[tuple[int, str] | None, ...], ...]


class Path:
    """Cheapest ways from one state through the tables of blocks that follow each other."""

    def __init__(self, source: int):
        # (cost, place of the audit among all, chain of block audits) for each state
        self.ways: list[tuple[int, int, tuple | None] | None] = [None] * 4
        self.ways[source] = (0, 0, None)

    def through(self, table: Table) -> None:
        found: list[tuple[int, int, str, tuple | None] | None] = [None] * 4
        for way, row in zip(self.ways, table, strict=True):
            if way is None:
                continue
            for then, end in enumerate(row):
                if end is not None and (found[then] is None or (way[0] + end[0], way[1], end[1]) < found[then][:3]):
                    found[then] = (way[0] + end[0], way[1], end[1], way[2])
        order = {key: i for i, key in enumerate(sorted({f[1:3] for f in found if f}))}
        self.ways = [(f[0], order[f[1:3]], (f[3], f[2])) if f else None for f in found]

    def ends(self) -> list[tuple[int, str] | None]:
        return [(w[0], _joined(w[2])) if w else None for w in self.ways]

    def finished(self) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        return min((e[0] + INSERT * len(t), e[1] + t) for e, t in zip(self.ends(), TAILS, strict=True) if e)


def _joined(chain: tuple | None) -> str:
    parts = []
    while chain is not None:
        chain, part = chain
        parts.append(part)
    return "".join(reversed(parts))


@dataclass
class _Segment:
    """What one task sees of a conversation, in order."""

    conv: int | None
    sources: tuple[int, ...]
    block: bytearray = field(default_factory=bytearray)
    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    least: int | None = None
    most: int | None = None
    turns: int = 0

    def __post_init__(self) -> None:
        self.paths = [Path(s) for s in self.sources]

    def add(self, turn: int | None, initial: str, copies: int, blank: bool, cut: bool, fresh: bool) -> None:
        for i in range(copies):
            again = not blank and not (fresh and i == 0)
            short = cut and not blank and not again
            self.blank += blank
            self.duplicate += again
            self.truncated += short
            self.illegal += self.n > 0 and f"{self.last}{initial}" not in LAWFUL
            self.first = initial if self.n == 0 else self.first
            self.last = initial
            self.n += 1
            kind = KINDS.find(initial) if initial else -1
            self.block.append((kind if kind >= 0 else 3) | (FORCED if blank or again else 0) | (CUT if short else 0))
            if len(self.block) == BLOCK:
                self.flush()
        if copies and turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def flush(self) -> None:
        if self.block:
            rows = bytes(self.block)
            wanted = {s for p in self.paths for s, w in enumerate(p.ways) if w}
            table = tuple(search(rows, s) if s in wanted else (None,) * 4 for s in range(4))
            for path in self.paths:
                path.through(table)
            self.block.clear()

    def row(self, place: int, open_: bool) -> tuple:
        self.flush()
        table = [(None,) * 4] * 4
        for source, path in zip(self.sources, self.paths, strict=True):
            table[source] = path.ends()
        flat = [e for row in table for e in row]
        return (
            self.conv, place, open_, self.n, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.least, self.most, self.turns,
            [e and e[0] for e in flat], [e and e[1] for e in flat],
        )


def closed(segments: list[tuple]) -> tuple:
    """The RESULT row of a conversation from all its segments in order."""
    path = Path(START)
    turns = blank = duplicate = truncated = illegal = 0
    least = most = last = None
    for _, _, _, n, b, d, t, i, first, end, low, high, own, costs, audits in segments:
        flat = [None if c is None else (int(c), a) for c, a in zip(costs, audits, strict=True)]
        path.through(tuple(tuple(flat[4 * s : 4 * s + 4]) for s in range(4)))
        blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + i
        if n:
            illegal += last is not None and f"{last}{first}" not in LAWFUL
            last = end
        if low is not None:
            turns += own - (low == most)
            least, most = low if least is None else least, high
    cost, audit = path.finished()
    gaps = 0 if least is None else most - least + 1 - turns
    return segments[0][0], gaps, blank, duplicate, truncated, illegal, cost, audit


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a sorted range; only the first and the last one can go on elsewhere."""
    from pyspark import TaskContext

    place = TaskContext.get().partitionId()
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _SEGMENT.split(", "))])
    now, made = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

    leading = True
    for batch in batches:
        for conv, *rest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "copies", "blank", "cut", "fresh")), strict=True):
            if now is None:
                now = _Segment(conv, (START, SYSTEM, USER, ASSISTANT))
            elif conv != now.conv:
                made.append(now.row(place, leading))
                leading = False
                now = _Segment(conv, (START,))
            now.add(*rest)
        if len(made) >= 2000:
            yield out()
            made = []
    if now is not None:
        made.append(now.row(place, True))
    if made:
        yield out()


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, mark): rows after damage; copies is 0 for dropped rows and 2 for repeated ones."""
    rows = turns.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = rows.withColumn("hit", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)
    made = hit.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    return made.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text")), 256)))


def edits(rows: DataFrame) -> DataFrame:
    """RESULT of every conversation of ``rows`` (conv_id, turn, role, text, copies, mark): counts, the least cost and its audit."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    short = rows.select("conv_id", "turn", "mark", "copies", F.left("role", F.lit(1)).alias("initial"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    short = written(short.groupBy("conv_id", "turn", "mark").agg(F.sum("copies").cast("int").alias("copies"), *(F.first(c).alias(c) for c in ("initial", "blank", "cut"))))
    # Where role and text come again in another turn, the earliest turn has the first of them.
    again = short.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("mark").alias("m")).agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn").alias("turn"))).alias("least"), F.count("*").alias("n")).where("n > 1")
    told = short.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    told = told.select("conv_id", "turn", "mark", "initial", "copies", "blank", "cut", (F.col("n").isNull() | F.col("turn").eqNullSafe(F.col("least.turn"))).alias("fresh"))
    order = ["conv_id", "turn", "mark"]
    parts = written(told.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_segments, _SEGMENT))
    whole = parts.where("open").groupBy("conv_id").applyInArrow(lambda t: _results([sorted(_rows(t), key=lambda r: r[1])]), RESULT)
    return whole.unionByName(parts.where("not open").mapInArrow(_alone, RESULT))


def _rows(table: pa.Table | pa.RecordBatch) -> list[tuple]:
    return list(zip(*(c.to_pylist() for c in table.columns), strict=True))


def _results(conversations: list[list[tuple]]) -> pa.Table:
    names = [f.split()[0] for f in RESULT.split(", ")]
    columns = zip(*map(closed, conversations), strict=True)
    return pa.table({n: pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, columns, strict=True)})


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _results([[r] for r in _rows(batch)]).to_batches()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each repaired conversation, from its audit and then its rows in order."""
    conv, letters, state, first, digest, out = None, iter(""), START, True, None, []

    def put(role: str, text: str) -> None:
        nonlocal first
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False

    def turned() -> str:
        nonlocal state
        state = _turned(state)
        return "assistant" if state == ASSISTANT else "user"

    def end() -> None:
        for _ in letters:  # only insertions are left
            put(turned(), "")
        out.append((conv, digest.hexdigest()))

    def made() -> pa.RecordBatch:
        convs, hashes = zip(*out, strict=True) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for own, kind, audit, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "audit", "role", "text", "copies")), strict=True):
            if kind == 0:
                if digest is not None:
                    end()
                conv, letters, state, first, digest = own, iter(audit), START, True, hashlib.sha256()
                continue
            for _ in range(copies):
                letter = next(letters)
                while letter == "I":
                    put(turned(), "")
                    letter = next(letters)
                if letter == "K":
                    state = KINDS.index(role[0]) + 1
                    put(role, text)
                elif letter == "R":
                    put(turned(), text)
        if out:
            yield made()
            out.clear()
    if digest is not None:
        end()
        yield made()


def repaired(turns: DataFrame) -> DataFrame:
    """RESULT and repaired_sha256 of every conversation of ``turns`` after damage."""
    rows = damaged(turns)
    found = written(edits(rows))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    heads = found.select("conv_id", F.lit(0).alias("kind"), none("turn", "long"), none("mark", "binary"), "audit", none("role", "string"), none("text", "string"), F.lit(0).alias("copies"))
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "mark", none("audit", "string"), "role", "text", "copies")
    order = ["conv_id", "kind", "turn", "mark"]
    hashes = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    return found.join(hashes.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def _edge_rows() -> Iterator[str]:
    """(state, letters, role that they need or null, new turns' text, role to write or null, next state, cost) for the SQL."""
    for state in range(4):
        now, extra = state, ""
        for k in range(4):
            head, fee = "I" * k, INSERT * k
            yield f"({state}, '{head}D', NULL, '{extra}', 'D', NULL, {now}, {fee + DELETE})"
            for kind, letter in enumerate(KINDS):
                if (kind == 0 and now == START) or (kind == 1 and now != USER) or (kind == 2 and now == USER):
                    yield f"({state}, '{head}K', '{letter}', '{extra}', 'K', NULL, {kind + 1}, {fee})"
            then = _turned(now)
            name = "assistant" if then == ASSISTANT else "user"
            yield f"({state}, '{head}R', NULL, '{extra}', 'R', '{name}', {then}, {fee + REROLE})"
            now, extra = then, f"{extra}|{name}:"


def oracle() -> str:
    """SQL of the query's rows over ``conversations``: dynamic programming, one turn of every conversation a step."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))"
    crc = f"xor(list_reduce([4294967295] || list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT), lambda c, b: {bits}), 4294967295)"
    edges = ", ".join(_edge_rows())
    return rf"""
    WITH RECURSIVE edges(g, letters, needs, extra, what, name, g2, fee) AS (VALUES {edges}),
    tails(g, letters, extra) AS (VALUES (0, '', ''), (1, 'II', '|user:|assistant:'), (2, 'I', '|assistant:'), (3, '', '')),
    hit AS (SELECT *, {crc} % 20 AS h FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k FROM conversations)),
    damaged AS (SELECT coalesce(conv_id::VARCHAR, ' ') AS c, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                FROM hit, range(2) AS t(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, ':', text))) AS p FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY p) > 1 AS again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
                    lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY p) || substr(role, 1, 1) AS pair FROM placed),
    told AS (SELECT *, final = '' AS blank, final <> '' AND again AS dup, final <> '' AND NOT again AND final NOT IN ('.', '!', '?') AS cut FROM seen),
    counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
                      count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM told GROUP BY c),
    walk(c, i, g, cost, audit, done) AS (
        SELECT c, 0::BIGINT, 0, 0, '', '' FROM counts
        UNION ALL
        SELECT c, i, g, cost, audit, done FROM (
            SELECT w.c, w.i + 1 AS i, e.g2 AS g, w.cost + e.fee + CASE WHEN cut AND what <> 'D' THEN {TRUNCATED} ELSE 0 END AS cost, w.audit || e.letters AS audit,
                   w.done || replace(e.extra, '|', chr(10)) || CASE WHEN what = 'D' THEN '' ELSE chr(10) || coalesce(e.name, t.role) || ':' || t.text END AS done
            FROM walk w JOIN told t ON t.c = w.c AND t.p = w.i + 1 JOIN edges e ON e.g = w.g AND (what = 'D' OR NOT (blank OR dup)) AND (needs IS NULL OR needs = substr(t.role, 1, 1)))
        QUALIFY row_number() OVER (PARTITION BY c, g ORDER BY cost, audit) = 1),
    ended AS (SELECT w.c, cost + {INSERT} * length(letters) AS cost, audit || letters AS audit, substr(done || replace(extra, '|', chr(10)), 2) AS done
              FROM walk w JOIN counts k ON k.c = w.c AND w.i = k.n JOIN tails USING (g) QUALIFY row_number() OVER (PARTITION BY w.c ORDER BY cost + {INSERT} * length(letters), audit || letters) = 1)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
           coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(done, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts k ON k.c = coalesce(o.conv_id::VARCHAR, ' ') LEFT JOIN ended e ON e.c = k.c"""
