"""Registered queries of the training-data operators, with production
parameters over their whole tables, and the DuckDB text of those that SQL can
express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (bpe_codec, exact_dedup, hard_negatives, html_extract, language_id, line_dedup, minhash,
               packing, simhash, spelling, substring_dedup, token_counts, topk)
from .common import SPACE, table


def op1_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_language_id(spark, sf_dir):
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op7_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_bpe_codec(spark, sf_dir):
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"))


def op10_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_minhash(spark, sf_dir):
    return minhash.minhash_components(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_html_extract, op2_substring_dedup, op3_best_fit_packing, op4_line_dedup, op5_exact_dedup,
    op6_language_id, op7_simhash,
    op8_token_counts, op9_bpe_codec, op10_top_k,
    op11_spelling_variants, op12_minhash, op13_hard_negatives)}

ORACLE = {
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_exact_dedup": rf"""
WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS n,
                  regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS t FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM w
""",
    "op10_top_k": topk.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_minhash": minhash.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
