"""The job server's tables: ledger, job states, claims, pages, bank, metrics, inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def job_states(ledger: DataFrame) -> DataFrame:
    """(job_id, status, worker, lease_until, fails, claims) from events (job_id, seq, ev, worker, lease_until): the last claim, acceptance
    or release decides; fails count since the last claim."""
    event = F.col("ev")
    last = lambda c, kinds: F.max_by(c, F.when(event.isin(*kinds), F.col("seq")))
    out = ledger.groupBy("job_id").agg(
        last("ev", ("claim", "submit-ok", "release")).alias("ev"), last("worker", ("claim",)).alias("worker"), last("lease_until", ("claim",)).alias("lease_until"), F.count_if(event == "claim").alias("claims"),
        F.max(F.when(event == "claim", F.col("seq"))).alias("claim_seq"), F.sort_array(F.collect_list(F.when(event == "submit-fail", F.col("seq")))).alias("fail_seqs"),
    )
    status = F.when(F.col("ev") == "claim", "claimed").when(F.col("ev") == "submit-ok", "done").otherwise("pending")
    fails = F.size(F.filter("fail_seqs", lambda s: F.col("claim_seq").isNull() | (s > F.col("claim_seq")))).cast("bigint")
    held = F.col("ev") == "claim"
    return out.select("job_id", status.alias("status"), F.when(held, F.col("worker")).alias("worker"), F.when(held, F.col("lease_until")).alias("lease_until"), fails.alias("fails"), "claims")


def lease_active(now: Column) -> Column:
    return (F.col("status") == "claimed") & (F.col("lease_until") > now)


def layer_status(jobs: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """(layer, total, done, active, expired, pending, tokens_pending); expired claims are pending too."""
    rows = jobs.join(states, "job_id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))
    active, claimed = F.coalesce(lease_active(now), F.lit(False)), F.col("status") == "claimed"
    waits = (F.col("status") == "pending") | (claimed & ~active)
    return rows.groupBy("layer").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "done").alias("done"), F.count_if(active).alias("active"), F.count_if(claimed & ~active).alias("expired"), F.count_if(waits).alias("pending"), F.coalesce(F.sum(F.when(waits, F.col("tokens"))), F.lit(0)).cast("bigint").alias("tokens_pending"))


def claim_order(jobs: DataFrame) -> list[Column]:
    """Newest sessions first, unknown starts last, then project, session, layer and window."""
    return [F.desc_nulls_last("started_at"), F.asc("project"), F.asc("session_id"), F.asc("layer"), F.lpad(F.col("window_index").cast("string"), 6, "0").asc()]


def claimable(jobs: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """Jobs that may be claimed: not done, no active lease, the window before done, and for pass2 all windows of the session done."""
    rows = jobs.join(states.select("job_id", "status", "lease_until"), "job_id", "left").withColumn("done", F.coalesce(F.col("status") == "done", F.lit(False)))
    line = Window.partitionBy("session_id", "layer").orderBy("window_index")
    whole = Window.partitionBy("session_id")
    gated = rows.withColumn("before", F.coalesce(F.lag("done").over(line), F.lit(True))).withColumn("open1", F.sum(F.when((F.col("layer") == "pass1") & ~F.col("done"), 1).otherwise(0)).over(whole))
    free = ~F.col("done") & ~F.coalesce(lease_active(now), F.lit(False))
    return gated.where(free & F.when(F.col("layer") == "pass1", F.col("before")).otherwise(F.col("open1") == 0)).select(*jobs.columns)


def next_job(jobs: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    return claimable(jobs, states, now).orderBy(*claim_order(jobs)).limit(1)


def layer_page(jobs: DataFrame, layer: str, cursor: str | None = None, limit: int = 20) -> tuple[DataFrame, str]:
    """One page of a layer in claim order, and the cursor of the next."""
    start = decode_cursor(cursor)
    return jobs.where(F.col("layer") == layer).orderBy(*claim_order(jobs)).offset(start).limit(limit), encode_cursor(start + limit)


def encode_cursor(offset: int) -> str:
    import base64

    return base64.urlsafe_b64encode(f"off:{offset}".encode()).decode().rstrip("=")


def decode_cursor(cursor: str | None) -> int:
    import base64

    if not cursor:
        return 0
    text = base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)).decode()
    if not text.startswith("off:") or not text[4:].isdigit():
        raise ValueError("not a cursor")
    return int(text[4:])


def parse_job_id(job: Column) -> Column:
    """struct<layer, session_key, window_index> of p1-<16 hex>-w<n> or p2-<16 hex>; null for others."""
    p1, p2 = r"^p1-([0-9a-f]{16})-w(\d+)$", r"^p2-([0-9a-f]{16})$"
    made = lambda layer, key, n: F.struct(F.lit(layer).alias("layer"), key.alias("session_key"), n.alias("window_index"))
    return F.when(job.rlike(p1), made("pass1", F.regexp_extract(job, p1, 1), F.regexp_extract(job, p1, 2).try_cast("bigint"))).when(job.rlike(p2), made("pass2", F.regexp_extract(job, p2, 1), F.lit(None).cast("bigint")))


def _bank_key(items: DataFrame) -> DataFrame:
    return items.withColumn("norm_title", T.normalize_title(F.col("title"))).withColumn("subject0", F.coalesce(F.get("subject", F.lit(0)), F.lit("general")))


def merge_bank(items: DataFrame) -> DataFrame:
    """Bank entries of items (title, description, content, polarity, subject, seen, seq), one for each normalised title and first subject.

    The first item gives the texts and all subjects; three or more confirm it. Entries of an existing bank come in as rows too, with
    the evidence that they have in a column evidence; a row without it counts once.
    """
    rows = _bank_key(items).withColumn("_n", F.coalesce("evidence", F.lit(1)) if "evidence" in items.columns else F.lit(1))
    subjects = F.when(F.size("subject") > 0, F.col("subject")).otherwise(F.array(F.lit("general")))
    return rows.withColumn("subjects", subjects).groupBy("norm_title", "subject0").agg(
        *(F.min_by(c, "seq").alias(c) for c in ("title", "description", "content", "polarity", "subjects")), F.sum("_n").alias("evidence"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"),
        F.when(F.sum("_n") >= 3, "confirmed").otherwise("candidate").alias("status"),
    )


def bank_evidence(items: DataFrame) -> DataFrame:
    """(norm_title, subject0, seq, trace, line): what each entry of the bank rests on, in the order of seq; a row for each item, so that an
    entry with very much evidence is no single row."""
    return _bank_key(items).select("norm_title", "subject0", "seq", "trace", "line")


def bank_index(bank: DataFrame) -> DataFrame:
    """(norm_title, subject0, line): a line of the index for each entry of a bank."""
    line = F.concat(F.lit("- **"), "title", F.lit("** ["), "polarity", F.lit("] ("), "status", F.format_string(", evidence ×%d) — ", "evidence"), "description", F.lit(" · subjects: "), F.array_join("subjects", ", "))
    return bank.select("norm_title", "subject0", line.alias("line"))


def rates(counters: DataFrame) -> DataFrame:
    """Rates of pass counters (key, turns, blocks, fallbacks, retries, disputes, quote_valid, orig_tokens, trace_tokens), three decimals; 0 where nothing was."""
    part = lambda a, b: F.when(F.col(b) > 0, T.rounded(F.col(a) / F.col(b), 3)).otherwise(F.lit(0.0))
    return counters.select("key", part("blocks", "turns").alias("coverage"), part("fallbacks", "blocks").alias("fallback_rate"), part("retries", "blocks").alias("retry_rate"), part("disputes", "blocks").alias("dispute_rate"), part("quote_valid", "blocks").alias("quote_rate"), F.when(F.col("trace_tokens") > 0, T.rounded(F.col("orig_tokens") / F.col("trace_tokens"), 1)).otherwise(F.lit(0.0)).alias("ratio"))


def first_per_path(files: DataFrame, rank: str) -> DataFrame:
    """One row for each log_file: that of the source with the smallest rank."""
    return files.withColumn("_r", F.row_number().over(Window.partitionBy("log_file").orderBy(rank))).where("_r = 1").drop("_r")


def unique_names(names: DataFrame, base: str, order: str) -> DataFrame:
    """Adds file_name: the base name, from the second use on with -2, -3, ... before .md."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return names.withColumn("file_name", F.when(n == 1, F.col(base)).otherwise(F.concat(F.regexp_replace(base, r"\.md$", ""), F.lit("-"), n.cast("string"), F.lit(".md"))))
