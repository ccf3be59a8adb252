"""Documents to training tokens: language ID, exact and near dedup, source mixing, tokenisation.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame that is
written as Parquet and read again as the next one's input; all but the last return the columns of documents.

Defined cases of every stage: null texts count as empty (language ID rejects both); null ids, sources and languages are values like others;
texts of any length are read whole; rows may repeat, in part or in all columns; further columns may have any type, and any name that Spark's mapInArrow
takes (no dots or backticks), and are handed on; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm import common, exact, language, mixing, pieces, queries, simhash


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found."""
    return language.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lowering A-Z, the one with the largest doc_id stays."""
    return exact.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word Jaccard similarity of 0.8 or more, found by SimHash at up to 6 bits) the one with the smallest doc_id stays."""
    return simhash.keep_first(docs, words=5, radius=6, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources fill their target weights, in a global seeded order."""
    copy, key = common.fresh(docs, "copy", "shuffle_key")
    return mixing.mixed(docs, copy_col=copy, key_col=key).drop(copy, key)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of the decoded text."""
    return pieces.digests(docs, queries.model_file(), with_ids=True)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenise),
]

#: Language ID, SimHash and SentencePiece have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs)
    return docs
