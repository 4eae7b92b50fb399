"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainscope.llm import (byte_bpe, conversation_repair, language_id, pii, piece_bpe, quality_rules, quartile_digest,
                            secret_forest, simhash, soft_mixing, suffix_tree, token_alignment, weak_quality)
from chainscope.llm.common import table
from chainscope.llm.oracle import ORACLE  # noqa: F401 - read by the entry


def op1_soft_mixing(spark, sf_dir):
    rows = soft_mixing.rates(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumn("copies", soft_mixing.copies(F.col("rate"), F.col("doc_id")))


def op2_quartile_digest(spark, sf_dir):
    return quartile_digest.compare(spark, table(spark, sf_dir, "documents"))


def op3_suffix_tree(spark, sf_dir):
    return suffix_tree.score(spark, table(spark, sf_dir, "documents"))


def op4_weak_quality(spark, sf_dir):
    return weak_quality.score(spark, table(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    return language_id.identify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op6_secret_forest(spark, sf_dir):
    return secret_forest.scan(spark, table(spark, sf_dir, "documents"))


def op7_golay_simhash(spark, sf_dir):
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op8_pii_spans(spark, sf_dir):
    return pii.spans(table(spark, sf_dir, "documents"))


def op9_line_quality(spark, sf_dir):
    return quality_rules.annotate(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "lost_chars")


def op10_byte_bpe(spark, sf_dir):
    return byte_bpe.digests(spark, table(spark, sf_dir, "documents"))


def op11_piece_bpe(spark, sf_dir):
    return piece_bpe.digests(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.align(spark, table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_soft_mixing, op2_quartile_digest, op3_suffix_tree, op4_weak_quality, op5_language_id, op6_secret_forest,
    op7_golay_simhash, op8_pii_spans, op9_line_quality, op10_byte_bpe, op11_piece_bpe,
    op12_token_alignment, op13_conversation_repair)}
