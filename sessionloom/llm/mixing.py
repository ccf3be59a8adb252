"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with n rows that shall fill the share w of a mix of ``total`` rows repeats each row w * total / n times on
average. Each row draws its own count: a hash of seed, id and draw number gives a uniform number, and the
inverse of the Poisson distribution turns it into a count. The same rows give the same mix on every run,
cluster and partitioning, also after executors are lost. A mean above SPLIT is drawn as the sum of several draws of
equal means, so that exp(-mean) stays in range. Rows repeat by explode, and one shuffle on a hash of (seed, id, copy)
with a sort by that hash inside the partitions is the global order.

Defined cases: null sources are a source of their own; rows with a null id count as id ''; rows that repeat an id draw the
same count; a source that targets leave out gets no rows; columns named copy or shuffle_key are replaced; weights need not add up to 1; empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: The largest mean of one draw; the table of its distribution then has under 120 entries.
SPLIT = 16.0
ENTRIES = 120
#: Draws of a row that are made together: no array of a row is longer than its draws by BLOCK, or BLOCK times SPLIT copies or so.
BLOCK = 1_024
#: Sources up to this number are broadcast (under 100 MB); more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def hash_unit(*parts: Column) -> Column:
    """A uniform number in [0, 1) with 52 bits, from the MD5 of the parts joined by ':'."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def rates(docs: DataFrame, targets: dict[str, float] | None, total: int | None, power: float, source_col: str = "source") -> DataFrame:
    """(source, n, mean): the mean repetition of each source's rows; without targets a source's weight is n ** power."""
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if targets is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        wanted = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items() if v > 0], "target string, w double")
        weighted = counts.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("target"))).drop("target")
    all_w, all_n = weighted.agg(F.sum("w"), F.sum("n")).first()
    rows = F.lit(float((all_n or 0) if total is None else total))
    return weighted.select("source", "n", (F.col("w") / F.lit(all_w or 1.0) * rows / F.col("n")).alias("mean"))


def with_distribution(rated: DataFrame) -> DataFrame:
    """Adds draws (how many), and cdf: P(count <= k) of one draw for k = 0, 1, ..."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("mean") / F.lit(SPLIT))).cast("int")
    one = F.col("mean") / F.col("draws")
    first = F.struct(F.exp(-one).alias("term"), F.array(F.exp(-one)).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * one / k
        return F.struct(term.alias("term"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + term)).alias("cdf"))

    return rated.withColumn("draws", draws).withColumn("cdf", F.aggregate(F.sequence(F.lit(1), F.lit(ENTRIES)), first, step)["cdf"])


def mixed(docs: DataFrame, targets: dict[str, float] | None = None, total: int | None = None, power: float = 0.5, seed: int = 42, id_col: str = "doc_id", source_col: str = "source", copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, in a seeded global order.

    targets: weight by source; without it the weight is (rows of the source) ** power. total: expected rows of
    the mix (default: as many as come in from the sources with a weight). Adds copy (1, 2, ...) and shuffle_key, under the
    names given, in place of columns that are called so; all other columns, whatever their names, are kept.
    """
    own, draws_, cdf, blocks, block, count, before = fresh(docs, "mix_source", "mix_draws", "mix_cdf", "mix_blocks", "mix_block", "mix_count", "mix_before")
    rated = with_distribution(rates(docs, targets, total, power, source_col))
    rated = rated.select(F.col("source").alias(own), F.col("draws").alias(draws_), F.col("cdf").alias(cdf))
    if docs.select(source_col).distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = F.broadcast(rated)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))

    def one_block(number: Column) -> Column:
        draws = F.sequence(number * F.lit(BLOCK) + F.lit(1), F.least(F.col(draws_), (number + F.lit(1)) * F.lit(BLOCK)))
        units = F.transform(draws, lambda j: hash_unit(F.lit(f"poisson-{seed}"), ident, j))
        return F.aggregate(units, F.lit(0), lambda sum_, u: sum_ + F.size(F.filter(cdf, lambda c: c <= u)))

    counts = F.transform(F.sequence(F.lit(0), F.floor((F.col(draws_) - F.lit(1)) / F.lit(BLOCK)).cast("int")), one_block)
    joined = docs.join(rated, F.col(source_col).cast("string").eqNullSafe(F.col(own)))
    counted = joined.withColumn(blocks, counts).drop(own, draws_, cdf, copy_col, key_col)
    # Each block of draws becomes a row with the copies that the blocks before it made, then each of its copies a row.
    spread = counted.select("*", F.posexplode(blocks).alias(block, count)).where(F.col(count) > 0)
    made = F.aggregate(F.slice(blocks, F.lit(1), F.col(block)), F.lit(0), lambda sum_, n: sum_ + n)
    spread = spread.withColumn(before, made).drop(blocks, block)
    copies = spread.withColumn(copy_col, F.explode(F.sequence(F.col(before) + F.lit(1), F.col(before) + F.col(count)))).drop(before, count)
    keyed = copies.withColumn(key_col, F.substring(F.md5(F.concat_ws(":", F.lit(f"order-{seed}"), ident, F.col(copy_col).cast("string"))), 1, 16))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, key_col).sortWithinPartitions(key_col, copy_col)


def oracle(table: str = "documents", power: float = 0.5, seed: int = 42) -> str:
    """DuckDB SQL for mixed(documents, power=power, seed=seed)."""
    return f"""
    WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
    weighted AS (SELECT source, n, pow(n::DOUBLE, {power}) AS w FROM counts),
    rated AS (SELECT source, w / (SELECT sum(w) FROM weighted) * (SELECT sum(n) FROM weighted)::DOUBLE / n AS mean FROM weighted),
    drawn AS (SELECT source, mean / greatest(1, ceil(mean / {SPLIT})) AS one, greatest(1, ceil(mean / {SPLIT}))::INT AS draws FROM rated),
    cdf AS (SELECT source, one, draws, 0 AS k, exp(-one) AS term, exp(-one) AS acc FROM drawn
            UNION ALL SELECT source, one, draws, k + 1, term * one / (k + 1), acc + term * one / (k + 1) FROM cdf WHERE k < {ENTRIES}),
    tables AS (SELECT source, any_value(draws) AS draws, list(acc ORDER BY k) AS cdf FROM cdf GROUP BY source),
    units AS (SELECT d.*, t.cdf, unnest(range(1, t.draws + 1)) AS j FROM {table} d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
    counted AS (SELECT doc_id, any_value(text) AS text, any_value(lang) AS lang, any_value(source) AS source, any_value(n_chars) AS n_chars,
                  sum(len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('poisson-{seed}:' || doc_id || ':' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)))::INT AS times
                FROM units GROUP BY doc_id),
    copies AS (SELECT *, unnest(range(1, times + 1))::INT AS copy FROM counted)
    SELECT doc_id, text, lang, source, n_chars, copy, substr(md5('order-{seed}:' || doc_id || ':' || copy), 1, 16) AS shuffle_key FROM copies"""
