"""Secret scans with multipart credential linking, in DataFrame functions only.

Base findings (assignments, access keys, hexadecimal runs) are reported as they are. Weak parts - names that look like account
identifiers, mixed strings that look like keys, endpoints - say nothing alone; they are reported only where parts that complement
each other lie in one scope. Parts become rows; an interval join on (document, SCOPE-sized stretch) finds the complements, so that
very long documents spread over tasks and the number of pairs is bounded by what fits a stretch.

The places of all matches of a pattern come from the lengths of the pieces between them (split) and of the matches
themselves (regexp_extract_all), both leftmost and without overlap, in code points. They are summed up in blocks, so that a text
with very many matches costs time in proportion to them.

Defined cases: a null text counts as empty; a repeated row gets its own row with the same findings; overlapping findings of different kinds
all count; parts farther apart than SCOPE code points are not linked; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Code points between parts of one credential, at most.
SCOPE = 256
#: Matches whose places are summed up together.
BLOCK = 256

# The base patterns.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
# Weak parts.
WEAK_ID = r"(?i:access_?key_?id|client_?id|account|user_?name|user|login)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)"
WEAK_SECRET = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])(?=[0-9a-z+/]*+[A-Z])(?=[0-9A-Z+/]*+[a-z])[A-Za-z0-9+/]{20,}={0,2}"
ENDPOINT = r"[a-z][a-z0-9+]{1,15}://[^\x00-\x20\"'<>]+"
#: Kinds in the order in which spans of one start are listed, with the role of each.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}

_SPANS = "array<struct<start:bigint,end:bigint>>"


def spans(text: Column, pattern: str, gate: Column, value_group: int = 0, least: int = 0) -> Column:
    """Places (start, end) of all matches whose group has ``least`` characters or more; none where ``gate`` is false."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    value = F.transform(hits, lambda h: F.length(F.regexp_extract(h, pattern, value_group))) if value_group else F.transform(hits, F.length)
    sizes = F.transform(F.arrays_zip(F.slice(between, 1, F.size(hits)).alias("gap"), F.transform(hits, F.length).alias("hit"), value.alias("value")), lambda x: x)
    found = F.filter(_let(sizes, _running), lambda s: s["value"] >= F.lit(least))
    return F.when(gate, F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).otherwise(F.array().cast(_SPANS))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(sizes: Column) -> Column:
    """(start, end, value) of each of ``sizes(gap, hit, value)``. Appending to an array copies it, so running sums are made
    inside blocks of BLOCK matches and over the blocks, never over all matches at once."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:int>>")
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(sizes) - F.lit(1), F.lit(0)) / F.lit(BLOCK)).cast("int")), lambda b: F.slice(sizes, b * F.lit(BLOCK) + F.lit(1), BLOCK))
    zero = F.lit(0).cast("bigint")

    def total(block: Column) -> Column:
        return F.aggregate(block, zero, lambda sum_, s: sum_ + s["gap"] + s["hit"])

    def step(done: Column, s: Column) -> Column:
        start = done["at"] + s["gap"]
        end = start + s["hit"]
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value")))).alias("out"))

    def whole(held: Column) -> Column:
        begins = F.aggregate(held, F.array(zero), lambda sums, block: F.concat(sums, F.array(F.element_at(sums, -1) + total(block))))
        return _let(begins, lambda at: F.flatten(F.transform(held, lambda block, i: F.aggregate(block, F.struct(F.get(at, i).alias("at"), none.alias("out")), step, lambda done: done["out"]))))

    return _let(blocks, whole)


def parts(text: Column) -> dict[str, Column]:
    """The spans of each kind in a text; cheap tests keep the costly patterns to texts that can match."""
    return {
        "assign": spans(text, ASSIGN, text.rlike(ASSIGN), 2, 8),
        "access": spans(text, ACCESS, F.contains(text, F.lit("AKIA")), 0, 16),
        "hex": spans(text, HEX, text.rlike(HEX)),
        "weak_id": spans(text, WEAK_ID, text.rlike(WEAK_ID)),
        "weak_secret": spans(text, WEAK_SECRET, text.rlike(WEAK_SECRET)),
        "endpoint": spans(text, ENDPOINT, F.contains(text, F.lit("://"))),
    }


def _stretches(low: Column, high: Column) -> Column:
    """The SCOPE-sized stretches that an interval meets."""
    return F.explode(F.sequence(F.floor(F.greatest(low, F.lit(0)) / F.lit(SCOPE)), F.floor(high / F.lit(SCOPE))))


def _roles(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(ROLES[kind]).alias("role"), s["start"].alias("start"), s["end"].alias("end")))


def linked(found: DataFrame) -> DataFrame:
    """(doc_id, row_tag, kind, start, end): the weak parts of ``found`` that have a complement in their scope: an
    identifier needs a secret, a secret an identifier or an endpoint, an endpoint a secret."""
    listed = F.concat(*map(_roles, KINDS))
    some = found.where(F.size("weak_id") + F.size("weak_secret") + F.size("endpoint") > 0).where((F.size("weak_id") + F.size("access") > 0).cast("int") + (F.size("endpoint") > 0).cast("int") + (F.size("assign") + F.size("hex") + F.size("weak_secret") > 0).cast("int") > 1)
    rows = some.select("doc_id", "row_tag", F.explode(listed).alias("p")).select("doc_id", "row_tag", "p.*").distinct()
    weak = rows.where(F.col("kind").isin("weak_id", "weak_secret", "endpoint")).withColumn("stretch", _stretches(F.col("start") - F.lit(SCOPE), F.col("end") + F.lit(SCOPE)))
    others = rows.select(F.col("doc_id").alias("o_id"), F.col("row_tag").alias("o_tag"), F.col("role").alias("o_role"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    others = others.withColumn("o_stretch", _stretches(F.col("o_start"), F.col("o_end"))).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("row_tag") == F.col("o_tag")) & (F.col("stretch") == F.col("o_stretch"))
    near = (F.col("o_start") <= F.col("end") + F.lit(SCOPE)) & (F.col("o_end") >= F.col("start") - F.lit(SCOPE))
    apart = (F.col("o_start") >= F.col("end")) | (F.col("o_end") <= F.col("start"))
    fits = F.when(F.col("role") == "secret", F.col("o_role") != "secret").otherwise(F.col("o_role") == "secret")
    return weak.join(others, same & near & apart & fits, "left_semi").select("doc_id", "row_tag", "kind", "start", "end").distinct()


def _joined(entries: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")


def _entries(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(source.select("doc_id", F.xxhash64("text").alias("row_tag"), *(c.alias(k) for k, c in parts(text).items())))
    rank = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    more = linked(found).groupBy("doc_id", "row_tag").agg(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind")).alias("linked"))
    more = more.select(F.col("doc_id").alias("l_id"), F.col("row_tag").alias("l_tag"), "linked")
    out = found.join(more, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("row_tag") == F.col("l_tag")), "left")
    base = F.concat(_entries("assign"), _entries("access"), _entries("hex"))
    every = F.concat(base, F.coalesce("linked", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")))
    counts = (F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex"))
    return out.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"), F.greatest(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"))
