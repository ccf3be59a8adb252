"""All registered queries of the session engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import claim_queries, compress_queries, disk_queries, header_queries, log_queries, session_queries, text_queries, trace_queries, work_queries

_PARTS = (text_queries, session_queries, header_queries, log_queries, disk_queries, claim_queries, compress_queries, trace_queries, work_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for p in _PARTS for k, f in p.QUERIES.items()}
ORACLES: dict[str, str] = {k: s for p in _PARTS for k, s in p.ORACLES.items()}
