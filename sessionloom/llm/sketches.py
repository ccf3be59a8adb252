"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

The sketch of a text is the k smallest distinct hashes of its five-word shingles. Sketches of parts merge to the sketch of
the whole. Two sketches estimate resemblance (the share of the k smallest of both that is in both), containment and
the number of distinct shingles.

Defined cases: a null text counts as empty and has an empty sketch; a text of one to four words has one shingle, all its words;
two empty sketches resemble each other fully, an empty and another one not at all; white space between words doesn't count.
Ids are any 64-bit numbers, spread as they like; rows without an id come last of all; rows that share one are ordered by
the hash of their text; very long texts are one value each; columns of other names are not read; an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import SPACES

K = 128
WIDTH = 5
#: Rows that a bucket of neighbours holds on average, and the most buckets (their bounds are part of the plan, some 40 bytes each).
BUCKET_ROWS, MOST_BUCKETS = 2_000, 16_384


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The k smallest distinct shingle hashes of a text, ascending."""
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), SPACES)
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        last = F.greatest(F.size(h) - F.lit(width), F.lit(0))
        whole = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(h, i + F.lit(j)) for j in range(width))))
        return F.slice(F.sort_array(F.array_distinct(whole)), 1, k)

    found = F.element_at(F.transform(F.array(hashed), shingles), 1)
    return F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"), found).otherwise(F.array().cast("array<bigint>"))


def fingerprint(sketch_: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal."""
    return F.array_join(F.transform(sketch_, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact below k."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the shingles of ``a`` that ``b`` has too."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def group_sketches(rows: DataFrame, key: str, sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch): the merged sketch of each group. Ranks are cut to k before the shuffle, so that a group of any size
    moves k hashes a task."""
    hashes = rows.select(key, F.explode(sketch_col).alias("h")).distinct()
    ranked = hashes.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("h"))).where(F.col("r") <= k)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def _place(id_col: str, text_col: str) -> Column:
    """What rows are ordered by: rows with an id above those without, then the id, then the hash of the text."""
    ident = F.col(id_col).cast("long")
    return F.struct(ident.isNotNull().alias("known"), F.coalesce(ident, F.lit(0).cast("long")).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("tag"))


def _constant(places: list[Row]) -> Column:
    """Places as an array that the optimiser folds to one constant."""
    listed = json.dumps([{"known": p.known, "id": p.id, "tag": p.tag} for p in places])
    return F.from_json(F.lit(listed), "array<struct<known: boolean, id: bigint, tag: bigint>>")


def _bounds(docs: DataFrame, id_col: str, text_col: str) -> tuple[list[Row], list[Row]]:
    """The smallest and the largest place of each bucket. Spark's range partitioning of the places alone (24 bytes a row)
    makes buckets of like size however the ids are spread; at most MOST_BUCKETS pairs come back."""
    places = docs.select(_place(id_col, text_col).alias("p"))
    buckets = max(1, min(MOST_BUCKETS, places.count() // BUCKET_ROWS))
    cut = places.repartitionByRange(buckets, "p").groupBy(F.spark_partition_id().alias("b")).agg(F.min("p").alias("low"), F.max("p").alias("high"))
    found = cut.orderBy("low").collect()
    return [r.low for r in found], [r.high for r in found]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sketch, next_id, next_text, next_sketch): each row with the next one by descending id, the last with the first.

    Rows are dealt to buckets of neighbouring ids, about BUCKET_ROWS each; the largest row of each bucket also visits the next
    higher bucket (that of the highest the lowest), so that the text moves once. A row finds its bucket by binary search
    in the bounds; rows that repeat an id and a text share a bucket.
    """
    lows, highs = _bounds(docs, id_col, text_col)
    number = max(1, len(lows))
    steps = [1 << k for k in reversed(range((number - 1).bit_length()))]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _place(id_col, text_col).alias("_place"))

    def further(at: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(_constant(lows), at + step) <= F.col("_place"), F.lit(False)), at + step).otherwise(at)

    own = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further) if steps else F.lit(0)
    placed = source.withColumn("_own", own)
    guest = F.col("_place") == F.get(_constant(highs), F.col("_own")) if highs else F.lit(False)
    home = F.array(F.struct(F.col("_own").alias("b"), F.lit(False).alias("guest")))
    away = F.array(F.struct(F.pmod(F.col("_own") + F.lit(1), F.lit(number)).alias("b"), F.lit(True).alias("guest")))
    dealt = placed.select("doc_id", "text", "_place", F.explode(F.when(guest, F.concat(home, away)).otherwise(home)).alias("_at"))
    dealt = dealt.select("doc_id", "text", "_place", F.col("_at.b").alias("_bucket"), F.col("_at.guest").alias("_guest")).repartition("_bucket")
    sketched = dealt.withColumn("sketch", sketch(F.col("text")))
    line = Window.partitionBy("_bucket").orderBy("_guest", F.desc("_place"))
    out = sketched.select("doc_id", "text", "sketch", "_guest", *(F.lead(c).over(line).alias(f"next_{n_}") for c, n_ in (("doc_id", "id"), (F.coalesce("text", F.lit("")), "text"), ("sketch", "sketch"))))
    return out.where(~F.col("_guest")).drop("_guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_edited, distinct_shingles)
    of every row; the edited text has its last half replaced by the first half's length of the next row's text."""
    text = F.coalesce("text", F.lit(""))
    size = F.length(text)
    half = F.floor(size / F.lit(2)).cast("int")
    edited = F.concat(F.substr(text, F.lit(1), size - half), F.substr(F.col("next_text"), F.lit(1), half))
    both = with_next(docs, id_col, text_col).select("doc_id", size.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    both = both.withColumn("edited_sketch", sketch(F.col("edited"))).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("contained_edited"), distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )
