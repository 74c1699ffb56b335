"""The corpus queries: each applies one operator to the whole table of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    bpe, exact, jaccard, langid, linededup, merkle, mixing, quality, repeats, secrets, spelling,
    tokencount, tokenfiles,
)
from .common import documents, sorted_lines

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "coded.*")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir), words=4, percent=85)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir)).select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(sorted_lines("assign", "access", "hex"), 256).alias("base_sha256"),
        sorted_lines("assign", "access", "hex", "random").alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assessed(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "votes", F.round("quality", 6).alias("quality"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        mixing.mixture(documents(spark, sf_dir))
        .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select(
            "doc_id", F.col("size").cast("long").alias("size"), "source_size", "target", "taken",
            F.get("positions", F.lit(0)).alias("first_position"),
        )
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfiles.new_folder(spark)
    tokenfiles.write_token_files(
        documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json")
    )
    return tokenfiles.read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", tokenfiles.ids_crc32("ids").alias("ids_crc32")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", tokencount.utf8_bytes("text").alias("n_bytes")
    )
    return tokencount.counted(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir), first_stays=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(spelling.document_words(documents(spark, sf_dir)))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.col("n_chars") + F.when(
        F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1
    ).otherwise(0)
    rows = merkle.manifest(documents(spark, sf_dir), claims={"n_chars": tampered})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"),
        merkle.folded(F.coalesce("claim", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_secret_scans": op3_secret_scans,
        "op4_quality_rules": op4_quality_rules,
        "op5_line_dedup": op5_line_dedup,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_language_id": op7_language_id,
        "op8_mixing": op8_mixing,
        "op9_token_files": op9_token_files,
        "op10_token_counts": op10_token_counts,
        "op11_suffix_dedup": op11_suffix_dedup,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }


LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, x, trim(x, ' ' || chr(9) || chr(13)) AS bare
  FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
           generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
  )
), solid AS (
  SELECT doc_id, i, bare, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p,
         count(*) OVER (PARTITION BY doc_id) AS n
  FROM lines WHERE bare <> ''
), windows AS (
  SELECT doc_id, p, n, [bare, lead(bare) OVER w, lead(bare, 2) OVER w] AS content
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY content ORDER BY doc_id, p) AS k
    FROM windows WHERE p <= greatest(n - 2, 1)
  ) WHERE k > 1
), gone AS (
  SELECT DISTINCT s.doc_id, s.i
  FROM later JOIN solid s ON s.doc_id = later.doc_id AND s.p BETWEEN later.p AND later.p + 2
), rest AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(l.x, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
  GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed, r.text
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    known = {"op5_line_dedup": LINE_DEDUP, "op6_exact_dedup": EXACT_DEDUP}
    if corpus_pipeline.ORACLE_SQL is not None:
        known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return known
