"""Traces of sessions that a model has read: compressed form, arcs of reasoning, verdict, accounting and metrics as one document each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def _section(title: str, body: Column) -> Column:
    return F.when(F.length(body) > 0, F.concat(F.lit(f"## {title}\n\n"), body, F.lit("\n\n"))).otherwise("")


def _item(when: Column, text: Column) -> Column:
    return F.when(when, F.concat(F.lit("- "), text))


def arcs_text(arcs: Column) -> Column:
    """Arcs (kind, status, text, fromLine, toLine), a line each."""
    one = lambda a: F.concat(F.lit("- **"), a["kind"], F.lit("** ["), a["status"], F.lit("] "), a["text"], F.format_string(" @L%d", a["fromLine"]), F.when(a["toLine"].isNotNull(), F.format_string("→L%d", a["toLine"])).otherwise(""))
    return F.coalesce(F.array_join(F.transform(arcs, one), "\n"), F.lit(""))


def accounting_text() -> Column:
    """What can be counted, from columns of sessions and account_sessions; lines without figures are left out."""
    calls, errors = F.coalesce("tool_calls", F.lit(0)), F.coalesce("errors", F.lit(0))
    rate = F.when(calls > 0, T.rounded((calls - errors) * 100 / calls, 1)).otherwise(F.lit(100.0))
    whole = F.col("input") + F.col("cache_read") + F.col("cache_write")
    wall = F.greatest(F.lit(0), F.unix_millis(F.try_to_timestamp("ended_at")) - F.unix_millis(F.try_to_timestamp("started_at")))
    return F.concat_ws(
        "\n",
        _item(F.lit(True), F.concat(F.lit("session: `"), F.left("session_id", F.lit(8)), F.lit("` ("), "source", F.lit(")"))),
        _item(wall.isNotNull(), F.concat(F.lit("window: "), "started_at", F.lit(" → "), "ended_at", F.lit(" (wall "), T.fmt_duration(wall), F.lit(")"))),
        _item(F.lit(True), F.concat(F.format_string("calls: %d (ok %d, err %d; success rate ", calls, calls - errors, errors), rate.cast("string"), F.lit(" %)"))),
        _item((F.coalesce("diff_added", F.lit(0)) > 0) | (F.coalesce("diff_removed", F.lit(0)) > 0), F.format_string("edits: +%d/−%d in %d files", "diff_added", "diff_removed", "files_modified")),
        _item(F.col("checks_run").isNotNull(), F.format_string("checks: %d run / %d failed", "checks_run", "checks_failed")),
        _item(F.coalesce("compactions", F.lit(0)) > 0, F.format_string("history compactions: %d", "compactions")),
        _item(F.col("requests") > 0, F.concat(F.lit("model: `"), F.coalesce("model", F.lit("?")), F.format_string("` · requests %d · in %d (cache read %d, write %d) · out %d", "requests", "input", "cache_read", "cache_write", "output"))),
        _item((whole > 0) & (F.col("cache_read") / F.nullif(whole, F.lit(0)) > 0.1), F.concat(F.lit("cache: "), F.round(F.col("cache_read") * 100 / F.nullif(whole, F.lit(0)), 0).cast("bigint").cast("string"), F.lit(" % of input tokens"))),
    )


def metrics_text() -> Column:
    """Figures of the passes, from columns turns, blocks, fallbacks, retries and disputes."""
    none = lambda c: F.coalesce(c, F.lit(0))
    return F.format_string("turns %d · compressed %d · fallback %d · retries %d · disputes %d", none("turns"), none("blocks"), none("fallbacks"), none("retries"), none("disputes"))


def refined(sessions: DataFrame, forms: DataFrame, analyses: DataFrame, accounts: DataFrame, counts: DataFrame) -> DataFrame:
    """(session_key, status, trace_tokens, ratio, markdown) of sessions (as the log adapters give them).

    forms: session_key, form. analyses: session_key, analysis (a struct with arcs and verdict), for sessions that a model has read. accounts: account_sessions.
    counts: session_key, turns, blocks, fallbacks, retries, disputes.
    """
    rows = sessions.join(forms.select("session_key", "form"), "session_key", "left").join(analyses.select("session_key", "analysis"), "session_key", "left").join(accounts, "session_key", "left").join(counts, "session_key", "left")
    read = F.col("analysis").isNotNull()
    status = F.when(read, F.col("analysis.verdict.status")).otherwise("not analysed")
    verdict = F.when(read, F.concat(F.lit("**"), status, F.lit("**: "), F.coalesce("analysis.verdict.why", F.lit("")), F.lit(" (model)"))).otherwise("No analysis; see the accounting below.")
    title = F.coalesce("title", "session_id")
    front = F.concat(F.lit("---\nsession: "), "session_id", F.lit("\nsource: "), "source", F.lit("\nlog: "), "log_file", F.lit("\nstatus: "), status, F.lit("\n---\n# "), title, F.lit("\n\n> `@L<n>` is line n of the log.\n\n"))
    body = [_section("Compressed session", F.coalesce("form", F.lit(""))), _section("Reasoning", F.when(read, arcs_text(F.col("analysis.arcs"))).otherwise("")), _section("Verdict", verdict), _section("Accounting", accounting_text()), _section("Passes", metrics_text())]
    made = rows.withColumn("markdown", F.concat(front, *body)).withColumn("status", status).withColumn("trace_tokens", T.estimate_tokens(F.col("markdown")))
    return made.select("session_key", "status", "trace_tokens", T.compression_ratio(F.col("log_bytes"), F.col("trace_tokens")).alias("ratio"), "markdown")
