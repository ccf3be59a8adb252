"""URL filters by a sort-merge range join over reversed hosts.

The canonical key of a host is its labels in reverse, each closed by a control character; all hosts under a rule's host are then
the interval of keys that start with the rule's key. URLs and rules are dealt to the same key ranges (a rule to
every range that its interval meets), each range is sorted, and one sweep goes through it with a stack of the rules whose
interval is open: a rule is pushed at its start and popped when a key no longer starts with it. Intervals of prefixes
nest, so the stack holds exactly the rules of the host's own ancestors. The paths of one open host's rules are prefixes and
nest as well: they are kept sorted, each with the next shorter rule that contains it, so that a URL's path finds the
innermost one by binary search and a walk outwards. Of the open hosts' finds the longest rule decides.

Rows travel without the page; a key that fills several ranges, like a very common host, is spread over all of them.

Defined cases: null or no ``://``: host and path are empty and no rule fits; without a fitting rule the verdict is
the default; repeated rules count once, of equally long rules the first in text order decides; an empty label
is a label; control characters in hosts are ordinary characters (the key escapes those it uses itself); a null page_id stays null; very long
URLs are keys like any other; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: Closes each label of a key, and the sign that stands before those of a host's own characters that a key uses.
END, ESCAPE = "\x01", "\x02"
#: Pages that one key range holds on average.
RANGE_ROWS = 50_000
MOST_RANGES = 4_096


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substr(url, F.instr(url, "://") + F.lit(3)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.instr(url, "://") > 0, ascii_lower(host)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    after = F.substr(url, F.instr(url, "://") + F.lit(3))
    bare = F.substring_index(F.substring_index(after, "?", 1), "#", 1)
    return F.when((F.instr(url, "://") > 0) & (F.instr(bare, "/") > 0), F.substr(bare, F.instr(bare, "/"))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse, each closed by END. END and ESCAPE in the host are written as ESCAPE and a letter."""
    plain = F.replace(F.replace(host, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(END), F.lit(ESCAPE + "s"))
    return F.concat(F.array_join(F.reverse(F.split(plain, r"\.")), END), F.lit(END))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` under ``rules(host, path, verdict)``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("key", host_key(F.col("host")))
    known = rules.where("host is not null and path is not null").select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
    known = known.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn("key", host_key(F.col("host")))

    cuts = _cuts(rows)
    # A row goes to the ranges that its key meets: usually one; a key that is itself a cut fills several.
    spread = F.pmod(F.xxhash64("page_id", "path"), F.col("high") - F.col("low") + F.lit(1)).cast("int")
    dealt = rows.select("key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    dealt = _placed(dealt, cuts).withColumn("part", F.col("low") + spread)
    opened = known.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    opened = _placed(opened, cuts).withColumn("part", F.explode(F.sequence("low", "high")))
    both = dealt.unionByName(opened).drop("low", "high").repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "key", "kind", "path")
    return both.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")


def _placed(rows: DataFrame, cuts: list[str]) -> DataFrame:
    """Adds low and high, the first and last range that a page's key, or a rule's interval, meets."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column("key").to_pylist(), batch.column("kind").to_pylist(), strict=True))
            low = pa.array([bisect_left(cuts, k) for k, _ in pairs], pa.int32())
            high = pa.array([bisect_right(cuts, k if kind else k + "\U0010ffff") for k, kind in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, low, high], names=[*batch.schema.names, "low", "high"])

    return rows.mapInArrow(place, "key string, kind int, page_id long, host string, path string, verdict string, low int, high int")


def _cuts(rows: DataFrame) -> list[str]:
    """Keys that cut the rows into ranges of about RANGE_ROWS, from a sample of bounded size; at most MOST_RANGES - 1."""
    n = rows.count()
    ranges = min(MOST_RANGES, n // RANGE_ROWS + 1)
    if ranges == 1:
        return []
    wanted = 20 * ranges
    sample = sorted(r[0] for r in rows.select("key").sample(False, min(1.0, 2 * wanted / n), seed=7).limit(4 * wanted).collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


class _OpenHost:
    """The rules of one host whose interval is open. They come sorted by path."""

    def __init__(self, key: str):
        self.key = key
        self.paths: list[str] = []
        self.rules: list[tuple[int, str, str]] = []  # length of the rule, its text, verdict
        self.outer: list[int] = []  # the longest other rule that contains it, or -1

    def add(self, host: str, path: str, verdict: str) -> None:
        self.outer.append(self._inside(len(self.paths) - 1, path))
        self.paths.append(path)
        self.rules.append((len(host) + len(path), host + path, verdict))

    def find(self, path: str) -> tuple[int, str, str] | None:
        """The longest rule whose path is a prefix of ``path``."""
        at = self._inside(bisect_right(self.paths, path) - 1, path)
        return self.rules[at] if at >= 0 else None

    def _inside(self, at: int, path: str) -> int:
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at


def _sweep(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_OpenHost] = []
        part = None
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("key", "kind", "part", "page_id", "host", "path", "verdict")}
            out: list[tuple] = []
            for key, kind, here, page, host, path, verdict in zip(*columns.values(), strict=True):
                if here != part:
                    part, stack = here, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_OpenHost(key))
                    stack[-1].add(host, path, verdict)
                    continue
                fit = [r for r in (o.find(path) for o in stack) if r] if host else []
                best = min(fit, key=lambda r: (-r[0], r[1])) if fit else None
                out.append((page, host, path, best and best[1], best[2] if best else default))
            if out:
                page, *rest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(page, pa.int64()), *(pa.array(x, pa.string()) for x in rest)], names=["page_id", "host", "path", "rule", "verdict"])

    return sweep
