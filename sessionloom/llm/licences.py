"""License scans through a positional rare-token index.

Every template is a word sequence: whole licence texts of up to a few hundred words, and short notices. Words get an IDF from the
document frequencies of the whole corpus. The index posts each whole text under the words that its key phrases don't hold, with their
positions. A file is looked up by the LOOKED_UP licence words of highest IDF of each of its stretches of STRETCH words, so that several licences
in a file don't displace each other. A posting and the word's place in the file give the place where the text would start; where
the starts of enough of the text's rare words fall within DRIFT of its length, there is a candidate. Last, its key phrases
are verified: each has to stand near its own place, its words in order with at most GAP others among them. A candidate without its key phrases
is dropped, and key phrases without the rest of the text are no candidate. A notice is its own only key phrase, looked up by its rarest
word and verified word for word, so every place of one is found and nothing else.

Defined cases: a null text counts as empty and has no words; overlapping places all count; ties of IDF go to the
smaller word; repeated rows each get their row; very long texts are one file each; other columns, whatever their names, are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of
from .licence_texts import BASE, NOTICES, TEMPLATES

#: Words of a stretch that are looked up, words of a stretch, and other words within a key phrase.
LOOKED_UP, STRETCH, GAP = 24, 256, 2
#: How far words may stand from their places: DRIFT of the template's length, or LEAST_DRIFT words.
DRIFT, LEAST_DRIFT = 0.1, 8
#: Words that have to agree on a start: SHARE of those that a stretch can look up, but VOTES at least.
SHARE, VOTES = 0.3, 3
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered."""
    return (text or b"").translate(_WORDS).split()


@dataclass
class Template:
    words: tuple[bytes, ...]
    label: str
    keys: list[tuple[int, tuple[bytes, ...]]]  # place in the template, words
    base: bool = False

    @property
    def whole(self) -> bool:
        """Is it more than its key phrase?"""
        return len(self.keys[0][1]) < len(self.words)

    @property
    def drift(self) -> int:
        return max(LEAST_DRIFT, int(DRIFT * len(self.words))) if self.whole else 0

    @property
    def outside(self) -> list[tuple[int, bytes]]:
        """(place, word) of the words that no key phrase holds."""
        held = {w for _, p in self.keys for w in p}
        return [(i, w) for i, w in enumerate(self.words) if w not in held]

    @property
    def votes(self) -> int:
        return max(VOTES, math.ceil(SHARE * min(LOOKED_UP, len({w for _, w in self.outside}))))


def notice(phrase: str, label: str, base: bool = False) -> Template:
    own = tuple(words(phrase.encode()))
    return Template(own, label, [(0, own)], base)


def whole_text(label: str, text: str, keys: list[str]) -> Template:
    """A licence text; each key phrase has its place where it occurs first."""
    own = tuple(words(text.encode()))
    phrases = [tuple(words(k.encode())) for k in keys]
    return Template(own, label, [(next(i for i in range(len(own)) if own[i : i + len(p)] == p), p) for p in phrases])


def templates(base: dict[str, str] | None = None, notices: dict[str, str] | None = None, texts: list[tuple[str, str, list[str]]] | None = None) -> list[Template]:
    found = [notice(p, label, True) for p, label in (BASE if base is None else base).items()]
    found += [notice(p, label) for p, label in (NOTICES if notices is None else notices).items()]
    return found + [whole_text(*t) for t in (TEMPLATES if texts is None else texts)]


@dataclass
class RareTokenIndex:
    """postings: word -> (whole text, its place there), for words that its key phrases don't hold; anchors: a phrase's rarest word -> (phrase, its place in it)."""

    templates: list[Template]
    idf: dict[bytes, float]
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=dict)
    anchors: dict[bytes, list[tuple[tuple[bytes, ...], int]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.notices: dict[tuple[bytes, ...], list[int]] = {}
        for t, template in enumerate(self.templates):
            if template.whole:
                for i, w in template.outside:
                    self.postings.setdefault(w, []).append((t, i))
            else:
                self.notices.setdefault(template.words, []).append(t)
        for phrase in self.notices:
            rarest = min(phrase, key=self.order)
            self.anchors.setdefault(rarest, []).append((phrase, phrase.index(rarest)))
        # A file without any of these words holds neither a notice nor the first key phrase of a whole text.
        self.needed = [*self.anchors, *{min(t.keys[0][1], key=self.order) for t in self.templates if t.whole}]
        self.weight = [sum(self.idf[w] for w in set(t.words)) for t in self.templates]
        self.top = max(self.weight, default=0.0) or 1.0

    def order(self, word: bytes) -> tuple[float, bytes]:
        return -self.idf.get(word, 0.0), word

    def places(self, text: bytes, found: list[bytes]) -> dict[int, list[int]]:
        """Template -> the word numbers at which it starts (where its text would, if its first key phrase stands at its place)."""
        folded = text.translate(_WORDS)
        if not any(a in folded for a in self.needed):
            return {}
        where: dict[bytes, list[int]] = {}
        for i, w in enumerate(found):
            if w in self.idf:
                where.setdefault(w, []).append(i)
        out: dict[int, list[int]] = {}
        for a in self.anchors.keys() & where.keys():
            for phrase, k in self.anchors[a]:
                starts = [i - k for i in where[a] if i >= k and tuple(found[i - k : i - k + len(phrase)]) == phrase]
                for t in self.notices[phrase] if starts else ():
                    out[t] = starts
        for t, starts in self._candidates(where).items():
            fit = sorted({x for s in starts for x in [self._verified(self.templates[t], s, where, found)] if x is not None})
            if fit:
                out[t] = fit
        return dict(sorted(out.items()))

    def _candidates(self, where: dict[bytes, list[int]]) -> dict[int, list[int]]:
        """Whole text -> starts on which enough of the file's rarest licence words agree."""
        stretches: dict[int, dict[bytes, list[int]]] = {}
        for w in where.keys() & self.postings.keys():
            for i in where[w]:
                stretches.setdefault(i // STRETCH, {}).setdefault(w, []).append(i)
        told: dict[int, list[tuple[int, bytes]]] = {}
        for held in stretches.values():
            for w in sorted(held, key=self.order)[:LOOKED_UP]:
                for t, at in self.postings[w]:
                    told.setdefault(t, []).extend((i - at, w) for i in held[w])
        return {t: found for t, votes in told.items() if (found := _agreed(sorted(votes), 2 * self.templates[t].drift, self.templates[t].votes))}

    @staticmethod
    def _verified(template: Template, start: int, where: dict[bytes, list[int]], found: list[bytes]) -> int | None:
        """The start that the first key phrase gives, if all key phrases stand near their places."""
        first = None
        for at, phrase in template.keys:
            here = where.get(phrase[0], ())
            near = 2 * template.drift
            place = next((i for i in here[bisect_left(here, start + at - near) : bisect_left(here, start + at + near + 1)] if _in_order(phrase, found, i)), None)
            if place is None:
                return None
            first = place - at if first is None else first
        return first

    def likeness(self, found: list[bytes], t: int, start: int) -> float:
        """The IDF weight of the template's distinct words that stand in its stretch of the file, relative to the largest template."""
        own, near = self.templates[t], self.templates[t].drift
        inside = set(found[max(0, start - near) : start + len(own.words) + near])
        return min(1.0, sum(self.idf[w] for w in sorted(inside.intersection(own.words))) / self.top)


def _agreed(votes: list[tuple[int, bytes]], width: int, least: int) -> list[int]:
    """Middles of the stretches of ``width`` that hold the starts of ``least`` different words; of stretches that overlap the one with most."""
    inside: dict[bytes, int] = {}
    out: list[tuple[int, int]] = []
    left = 0
    for start, word in votes:
        inside[word] = inside.get(word, 0) + 1
        while start - votes[left][0] > width:
            gone = votes[left][1]
            left += 1
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
        if len(inside) >= least:
            found = (len(inside), (votes[left][0] + start) // 2)
            if not out or found[1] - out[-1][1] > width:
                out.append(found)
            elif found[0] > out[-1][0]:
                out[-1] = found
    return [middle for _, middle in out]


def _in_order(phrase: tuple[bytes, ...], found: list[bytes], at: int) -> bool:
    """Do the phrase's words stand in order from ``at`` on, with at most GAP others among them?"""
    i, end = at, at + len(phrase) + GAP
    for w in phrase:
        while i < end and i < len(found) and found[i] != w:
            i += 1
        if i >= end or i >= len(found):
            return False
        i += 1
    return True


def document_frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """(rows, in how many of them each word of the vocabulary occurs), over all rows; bounded by the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, int] = dict.fromkeys(vocabulary, 0)
        rows = 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                rows += 1
                for w in vocabulary.intersection(words(text.as_py())):
                    sums[w] += 1
        sums[b""] = rows
        yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in sums]), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

    table = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    found = {r[0].encode(): r[1] for r in table.groupBy("word").agg(F.sum("n")).collect()}
    return found.pop(b"", 0), found


def scanned(docs: DataFrame, known: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    score is the likeness of the best fitting template: 0 without one, 1 for a whole copy of the most telling text.
    """
    known = templates() if known is None else known
    vocabulary = {w for t in known for w in t.words}
    rows, df = document_frequencies(docs, vocabulary, text_col)
    index = RareTokenIndex(known, {w: math.log((rows + 1) / (df.get(w, 0) + 1)) for w in vocabulary})
    longs, strings = ("doc_id", "n_words", "n_base", "first_word", "last_word"), ("base_labels", "labels")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            out = []
            for text in batch.column("text").cast(pa.binary()):
                raw = text.as_py() or b""
                found = words(raw)
                places = index.places(raw, found)
                starts = [x for t, s in places.items() if known[t].base for x in s]
                labels = [",".join(sorted({known[t].label for t in places if not base or known[t].base})) for base in (True, False)]
                score = max((index.likeness(found, t, s) for t, own in places.items() for s in own), default=0.0)
                out.append((len(found), len(starts), min(starts, default=None), max(starts, default=None), *labels, score))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:6]), pa.array(columns[6], pa.float64())], names=[*longs, *strings, "score"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(work, ", ".join([*(f"{n} long" for n in longs), *(f"{n} string" for n in strings), "score double"]))
