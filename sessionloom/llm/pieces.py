"""SentencePiece encoding and decoding that keeps offsets.

A text is first normalised as its model says: the compiled character map (a double-array trie and replacement
texts) is searched for the longest prefix at every place; each normalised code point remembers the source byte range
it came from. Spaces become U+2581 and one may go in front. The normalised text is then merged from code points by the
scores of the model's pieces (the best pair first, of equal ones the leftmost), and code points that no piece covers become
byte pieces or the unknown piece. The pieces tile the normalised text, so the alignment projects each of them to a range of
the original UTF-8 bytes.

Where no piece holds U+2581 behind another character, pieces never cross from one run of letters into the next run of
spaces: texts are cut into chunks there, each distinct chunk of a batch is merged once, and the batch's ids and spans are put
together from those of its chunks as arrays. Decoding starts from the ids alone. Models for which this does not hold are merged text by text.

Byte-pair models are supported; other kinds, and pieces that are user-defined or unused, raise ValueError. The library of
the format is used to read the model file only.

Defined cases: null and empty texts have no ids, no spans and decode to the empty text; very long texts are handled chunk by
chunk; repeated rows each get their row; bytes that are no UTF-8 decode to U+FFFD; other columns, whatever their names, are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of

SPACE = "\u2581"
#: Text bytes that are encoded together.
BATCH_BYTES = 2 << 20
#: Ids that are spelled out at once.
IDS_TOGETHER = 1 << 16
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Lengths up to which chunks are merged together, how many at once, and the rank of what is no pair.
TOGETHER, ROWS_TOGETHER, NEVER = (6, 9, 12, 16, 24), 50_000, np.int32((1 << 31) - 1)
#: What the unknown piece decodes to.
UNKNOWN_TEXT = " \u2047 "


class CharacterMap:
    """The compiled map of a model's normaliser: longest prefix to replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size :] if size else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes that match at ``at``, their replacement), or None."""
        if not self.units:
            return None
        units, best = self.units, None
        node = self._child(0, units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & (1 << 31 | 0xFF) != data[i]:
                break
            node = self._child(node, unit)
            if unit >> 8 & 1:
                best = i + 1 - at, units[node] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]

    @staticmethod
    def _child(node: int, unit: int) -> int:
        return node ^ (unit >> 10) << ((unit & 1 << 9) >> 6)


@dataclass(frozen=True)
class Encoded:
    ids: tuple[int, ...]
    ends: tuple[int, ...]  # of the pieces, in bytes of the source from its start
    starts: tuple[int, ...]
    decoded: str


class PieceCoder:
    """Encoder and decoder of one model file, with spans."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or trainer.treat_whitespace_as_suffix or not spec.escape_whitespaces or {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only byte-pair models without user-defined or unused pieces are supported")
        self.map, self.dummy, self.collapse = CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.surface = [p.piece for p in model.pieces]
        self.byte_ids = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.control_ids = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.unknown_id = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_text = trainer.unk_surface if trainer.HasField("unk_surface") else UNKNOWN_TEXT
        self.bytes_of = {b: i for i, b in self.byte_ids.items()} if trainer.byte_fallback else {}
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.ordinary = set(self.id_of.values())
        self.cost = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self._pairs()
        self.by_chunk = SPACE in self.id_of and not any(re.search(f"[^{SPACE}]{SPACE}", x) for x in self.surface)
        self.names = [str(i) for i in range(len(self.surface))]
        spelled = [p.replace(SPACE, " ").encode() for p in self.surface]
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled = np.r_[0, np.cumsum([len(x) for x in spelled])].astype(np.int64)
        self.is_ordinary = np.array([i in self.ordinary for i in range(len(self.surface))])

    def _pairs(self) -> None:
        """Tables for merging many chunks at once: the symbol of each code point, and for each pair of symbols that is a piece its key, rank and symbol."""
        symbol = self.id_of | {c: -1 for c in {c for p in self.id_of for c in p} - self.id_of.keys()}
        self.symbol = np.full(0x110000, -1, np.int32)
        for byte, number in self.bytes_of.items():
            if byte < 128:  # such a code point is its byte piece, which no pair holds
                self.symbol[byte] = number
        for c, number in symbol.items():
            if len(c) == 1:
                self.symbol[ord(c)] = number
        found = [(self.id_of[p[:i]], self.id_of[p[i:]], p) for p in self.id_of for i in range(1, len(p)) if p[:i] in self.id_of and p[i:] in self.id_of]
        keys = np.array([a << 32 | b for a, b, _ in found], np.int64)
        order = np.argsort(keys)
        costs = {c: i for i, c in enumerate(sorted(set(self.cost.values())))}
        self.keys = np.r_[keys[order], np.int64((1 << 63) - 1)]
        self.ranks = np.r_[np.array([costs[self.cost[p]] for _, _, p in found], np.int32)[order], NEVER]
        self.joined = np.r_[np.array([self.id_of[p] for _, _, p in found], np.int32)[order], np.int32(-1)]
        self.length = np.array([1 if i in self.byte_ids else len(p) for i, p in enumerate(self.surface)], np.int32)

    def normalised(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """(normalised text, start and end in source bytes of each of its code points)."""
        data = text.encode()
        if not self.map.units and not self.collapse:  # nothing matches: each code point stands for itself
            first = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80).astype(np.int32)
            last = np.r_[first[1:], np.int32(len(data))][: len(first)].astype(np.int32)
            if not (self.dummy and text):
                return text.replace(" ", SPACE), first, last
            return SPACE + text.replace(" ", SPACE), np.r_[np.int32(0), first], np.r_[np.int32(0), last]
        at, out = 0, []
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                out.append((data[at : at + size].decode(), at, at + size))
            else:
                size, text_ = found
                out += [(c, at, at + size) for c in text_.decode()]
            at += size
        if self.collapse:
            kept = [x for i, x in enumerate(out) if x[0] != " " or i and out[i - 1][0] != " "]
            while kept and kept[-1][0] in (" ", SPACE):
                kept.pop()
            out = kept
        if self.dummy and out:
            out.insert(0, (" ", out[0][1], out[0][1]))
        return "".join(c for c, _, _ in out).replace(" ", SPACE), np.array([s for _, s, _ in out], np.int32), np.array([e for _, _, e in out], np.int32)

    def merged(self, text: str) -> list[str]:
        """The pieces of a normalised text: its code points, merged pair by pair while a pair is a piece of the model."""
        cost, parts, n = self.cost, list(text), len(text)
        heap = [(cost[p], i, p) for i, p in enumerate(map(str.__add__, parts, parts[1:])) if p in cost]
        if len(heap) > 1:
            heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j == n or parts[i] + parts[j] != pair or not parts[i]:
                continue  # one of the two has been merged with another meanwhile
            k = after[j]
            parts[i], parts[j], after[i] = pair, "", k
            if k < n:
                before[k] = i
                p = pair + parts[k]
                if p in cost:
                    heapq.heappush(heap, (cost[p], i, p))
            h = before[i]
            if h >= 0:
                p = parts[h] + pair
                if p in cost:
                    heapq.heappush(heap, (cost[p], h, p))
        return [p for p in parts if p]

    def chunk(self, text: str) -> tuple[list[int], list[int]]:
        """A normalised text, encoded: its ids, and how many code points each goes on. Of the bytes of one code point the first goes on
        by one, the others by none; neighbouring unknown code points are one piece."""
        ids: list[int] = []
        steps: list[int] = []
        unknown = False
        for piece in self.merged(text):
            number = self.id_of.get(piece)
            if number is None and unknown and not self.bytes_of:
                steps[-1] += 1
                continue
            own = [number] if number is not None else [self.bytes_of[b] for b in piece.encode()] if self.bytes_of else [self.unknown_id]
            ids.extend(own)
            steps.extend([len(piece)] + [0] * (len(own) - 1))
            unknown = number is None
        return ids, steps

    def chunks(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """chunk() of each of ``texts``: all ids, all steps, how many each text has. Chunks of ordinary length and letters are merged
        together, one pair of each a round."""
        data, edges = _bytes(texts)
        points, lead = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.flatnonzero(data & 0xC0 != 0x80)
        starts = np.searchsorted(lead, edges[:-1])
        size = np.diff(np.r_[starts, len(points)])
        symbols = self.symbol[points]
        strange = np.r_[0, np.cumsum(symbols < 0)]
        alone = (size > TOGETHER[-1]) | (strange[starts + size] > strange[starts])
        many = np.zeros(len(texts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # texts, ids, steps
        below = 0
        for most in TOGETHER:
            group = np.flatnonzero((size > below) & (size <= most) & ~alone)
            below = most
            for own in (group[i : i + ROWS_TOGETHER] for i in range(0, len(group), ROWS_TOGETHER)):
                place = np.arange(most)
                inside = place < size[own][:, None]
                rows = np.full(inside.shape, -1, np.int32)
                rows[inside] = symbols[(starts[own][:, None] + place)[inside]]
                rows = self._merged_rows(rows)
                many[own] = (rows >= 0).sum(axis=1)
                ids = rows[rows >= 0]
                found.append((own, ids, self.length[ids]))
        rest = np.flatnonzero(alone)
        held = [self.chunk(x) for x in texts.take(pa.array(rest)).to_pylist()]
        if held:
            many[rest] = [len(h[0]) for h in held]
            found.append((rest, *(np.array([x for h in held for x in h[i]], np.int32) for i in (0, 1))))
        begin = np.cumsum(many) - many
        ids, steps = np.zeros(many.sum(), np.int32), np.zeros(many.sum(), np.int32)
        for own, some, on in found:
            to = _gathered(begin[own], many[own])
            ids[to], steps[to] = some, on
        return ids, steps, many

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the tables, or the last place."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, len(self.keys) - 1)

    def _merged_rows(self, rows: np.ndarray) -> np.ndarray:
        """Rows of symbols, merged: in each round the leftmost of the best pairs of each row."""
        done, open_ = rows.copy(), np.arange(len(rows))
        place = np.arange(rows.shape[1])
        rank = np.full(rows.shape, NEVER, np.int32)
        rank[:, :-1] = self.ranks[self._found(rows[:, :-1], rows[:, 1:])]
        while len(open_):
            at = rank.argmin(axis=1)
            live = rank[np.arange(len(rank)), at] < NEVER
            if not live.all():
                done[open_[~live]] = rows[~live]
                open_, rows, rank, at = open_[live], rows[live], rank[live], at[live]
            own = np.arange(len(rows))
            new = self.joined[self._found(rows[own, at], rows[own, at + 1])]
            source = np.minimum(place + (place > at[:, None]), rows.shape[1] - 1)
            full = rows[:, -1] >= 0
            rows, rank = np.take_along_axis(rows, source, 1), np.take_along_axis(rank, source, 1)
            rows[full, -1], rank[:, -1] = -1, NEVER
            rows[own, at] = new
            after = np.minimum(at + 1, rows.shape[1] - 1)
            rank[own, at] = np.where(after > at, self.ranks[self._found(new, rows[own, after])], NEVER)
            some = np.flatnonzero(at > 0)
            rank[some, at[some] - 1] = self.ranks[self._found(rows[some, at[some] - 1], new[some])]
        return done

    def _joined(self, ids: Iterable[int], front: bool = False) -> str:
        """The text of ids. front: without the spaces that encoding puts in front of a text, one in front of the first piece or, for models
        that drop extra spaces, of each piece before which there is no text yet."""
        out, held, front = [], bytearray(), front and (self.dummy or self.collapse)
        for i in ids:
            if i in self.byte_ids:
                held.append(self.byte_ids[i])
                continue
            piece = "" if i in self.control_ids else self.unknown_text if i == self.unknown_id else self.surface[i]
            front = front and not held and not any(out)
            if front and i in self.ordinary and piece.startswith(SPACE):
                piece, front = piece[1:], self.collapse
            out += (_text(held), piece.replace(SPACE, " "))
            held.clear()
        return "".join(out) + _text(held)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids."""
        return self._joined(ids, front=True)

    def decode_all(self, ids: np.ndarray, many: np.ndarray) -> list[str]:
        """The text of each row of ids, ``many`` of each: the pieces' own bytes put in a row, for rows of ordinary pieces alone."""
        stop = np.r_[0, np.cumsum(many)]
        ends = np.r_[0, np.cumsum(self.spelled[ids + 1] - self.spelled[ids])]
        data = np.empty(ends[-1], np.uint8)
        for at in range(0, len(ids), IDS_TOGETHER):  # places are eight times as large as the bytes that they give
            some = ids[at : at + IDS_TOGETHER]
            data[ends[at] : ends[at + len(some)]] = self.spelling[_gathered(self.spelled[some], self.spelled[some + 1] - self.spelled[some])]
        ends = ends[stop]
        odd = np.r_[0, np.cumsum(~self.is_ordinary[ids])][stop]
        texts = []
        for a, b, start, end, strange in zip(stop[:-1].tolist(), stop[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist(), (np.diff(odd) > 0).tolist(), strict=True):
            if strange or self.collapse:
                texts.append(self.decode(ids[a:b].tolist()))
            else:  # the space that encoding puts in front goes
                skip = self.dummy and end > start and data[start] == 32
                texts.append(data[start + skip : end].tobytes().decode())
        return texts

    def _cut(self, shapes: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """(chunks of all normalised texts in a row, how many each text has); a space behind something that is no space opens one."""
        whole = pa.array(shapes, pa.string())
        if not self.by_chunk:
            return whole.filter(pa.array([bool(x) for x in shapes], pa.bool_())), np.array([bool(x) for x in shapes], np.int64)
        data, edges = _bytes(whole)
        mark = SPACE.encode()
        space = np.zeros(len(data) + 3, bool)  # three places on: is there a space here?
        if len(data) > 2:
            space[3:-2] = (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
        opens = space[3:] & ~space[:-3]
        opens[edges[:-1][np.diff(edges) > 0]] = True
        cuts = np.flatnonzero(opens)
        many = np.searchsorted(cuts, edges[1:]) - np.searchsorted(cuts, edges[:-1])
        return pa.StringArray.from_buffers(len(cuts), pa.py_buffer(np.r_[cuts, len(data)].astype(np.int32)), pa.py_buffer(data)), many

    def coded(self, texts: list[str | None]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids joined by commas, decoded text) of each text; of all texts in a row: ids, starts, ends in bytes of their own text; how many ids each has."""
        shapes = [self.normalised(t or "") for t in texts]
        chunks, held = self._cut([s for s, _, _ in shapes])
        known = chunks.dictionary_encode()
        ids, steps, many = self.chunks(known.dictionary)
        which = known.indices.to_numpy()
        source = _gathered((np.cumsum(many) - many)[which], many[which])
        numbers, steps = ids[source], steps[source]
        last = np.cumsum(steps, dtype=np.int64)
        starts = np.concatenate([s for _, s, _ in shapes] or [np.zeros(0, np.int32)])[last - np.maximum(steps, 1)]
        ends = np.concatenate([e for _, _, e in shapes] or [np.zeros(0, np.int32)])[last - 1]
        stop = np.r_[0, np.cumsum(held)]
        edges = np.r_[0, np.cumsum(many[which])][stop]
        decoded = self.decode_all(numbers, np.diff(edges))
        joined = [",".join(map(self.names.__getitem__, numbers[a:b].tolist())) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return joined, decoded, numbers, starts, ends, np.diff(edges)

    def full(self, text: str | None) -> Encoded:
        """Ids, spans and decoded text of one text."""
        _, decoded, ids, starts, ends, _ = self.coded([text])
        return Encoded(tuple(ids.tolist()), tuple(ends.tolist()), tuple(starts.tolist()), decoded[0])


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 of all texts in a row, where each begins and the last ends)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


def _gathered(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, ``many`` of each."""
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _text(held: bytearray) -> str:
    """Bytes as text; each byte that is no part of a UTF-8 character becomes U+FFFD."""
    out, at = [], 0
    while at < len(held):
        lead = held[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        try:
            out.append(bytes(held[at : at + size]).decode() or "\ufffd")
            at += size or 1
        except UnicodeDecodeError:
            out.append("\ufffd")
            at += 1
    return "".join(out)


@functools.lru_cache(2)
def coder(model_file: str) -> PieceCoder:
    return PieceCoder(model_file)


def _lists(values: np.ndarray, many: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(many)].astype(np.int32), np.ascontiguousarray(values))


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends, decoded): ids of every row's text and the source byte span of each; the file
    has to be at ``model_file`` on every executor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", BATCH_BYTES):
            _, text, ids, starts, ends, many = coder(model_file).coded(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), *(_lists(x, many) for x in (ids, starts, ends)), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts", "ends", "decoded"])

    return _two(docs, id_col, text_col).mapInArrow(work, "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string")


def decoded(rows: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, decoded) of rows (doc_id, ids)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [coder(model_file).decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(work, "doc_id long, decoded string")


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) of every row, and ids if asked for. spans_sha256 is over the
    starts and then the ends of the spans, as little-endian int32s."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string" + ", ids array<int>" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", BATCH_BYTES):
            ids, text, numbers, starts, ends, many = coder(model_file).coded(batch.column("text").to_pylist())
            stop = np.cumsum(many)
            spans = [_sha(starts[a:b].tobytes() + ends[a:b].tobytes()) for a, b in zip((stop - many).tolist(), stop.tolist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array(many, pa.int64()), *(pa.array(x, pa.string()) for x in ([_sha(i.encode()) for i in ids], [_sha(t.encode()) for t in text], spans))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
            if with_ids:
                columns, names = [*columns, _lists(numbers, many)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _two(docs, id_col, text_col).mapInArrow(work, schema)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
