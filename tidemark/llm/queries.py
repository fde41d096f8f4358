"""The registered queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import anchors, bpe, bpe_stream, byte_dedup, fm_index, katz, licenses, line_dedup, line_rules, phrases, quality_model, simhash, vector_codes
from tidemark.llm.common import fold, load

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: A line in more than 50 documents of its host, or in more than 2 % of them but not in five or fewer.
LINE_LIMITS = {"most_docs": 50, "most_share": 0.02, "fewest": 5}
TOKENIZER_FILE = "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.kept_lines(load(spark, sf_dir, "documents"), least=0.8, grams=True)
    n_removed = F.col("n_lines") - F.size("kept")
    return found.select("doc_id", "n_lines", n_removed.alias("n_removed"), F.col("kept").alias("kept_lines"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_dedup.drop_repeats(load(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.drop_repeats(load(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_spans")


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_quality(load(spark, sf_dir, "documents"), **LINE_LIMITS)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(load(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"), width=4, bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["past"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.score_documents(
        load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), fold("doc_id", 3) != 1
    )
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        load(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    )


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents"), least=10, longest=3, top=2000, cover=50)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(load(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    found = vector_codes.with_label_error(coded)
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def op13_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_stream.round_trip(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_line_rules": op4_line_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_vector_codes": op12_vector_codes,
    "op13_bpe_stream": op13_bpe_stream,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_rules": line_rules.line_quality_sql(**LINE_LIMITS),
    "op9_license_scan": licenses.scan_sql(),
}
