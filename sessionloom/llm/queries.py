"""One registered query for each corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact, language, licences, mixing, pieces, quality, repair, repeats, secrets, simhash, sketches, urls, vectors


def model_file() -> str:
    """The public vocabulary that op8 encodes with; the same path on every executor."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_documents(spark, sf_dir)).drop("kept")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(_documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(_documents(spark, sf_dir))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_documents(spark, sf_dir))


#: (host, path, verdict) of op5's rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.rules_frame(spark, URL_RULES))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(_documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_documents(spark, sf_dir), model_file())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_documents(spark, sf_dir)).drop("row_tag")


def op11_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_fingerprints": op2_fingerprints,
    "op3_secrets": op3_secrets,
    "op4_language": op4_language,
    "op5_urls": op5_urls,
    "op6_simhash": op6_simhash,
    "op7_licences": op7_licences,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_mixing": op9_mixing,
    "op10_exact": op10_exact,
    "op11_vectors": op11_vectors,
    "op12_repair": op12_repair,
    "op13_quality": op13_quality,
}

#: translate() has A-Z only, as the normalisation of op10 does.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLES: dict[str, str] = {
    "op1_repeats": r"""
    WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM split WHERE len(ws) >= 20)),
    marked AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, i + j AS i FROM marked, range(20) AS r(j)),
    every AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM split),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM every ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM split LEFT JOIN kept USING (doc_id)""",
    "op5_urls": rf"""
    WITH rules(rh, rp, verdict) AS (VALUES {_RULES}),
    cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ranked AS (SELECT page_id, host, path, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, rh || rp) AS r
               FROM parts LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE r = 1""",
    "op9_mixing": mixing.oracle(),
    "op10_exact": f"""
    WITH lowered AS (SELECT doc_id, {_LOWER} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM lowered""",
    "op11_vectors": vectors.oracle(),
    "op12_repair": repair.oracle(),
}
