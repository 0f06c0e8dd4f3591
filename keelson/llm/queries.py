"""The registered corpus queries: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fertility, hard_negatives, licenses, lines, minhash, phrases, pieces, quality, recompression, simhash, substrings, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(_table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.dedup_word_windows(_table(spark, sf_dir, "documents"), words=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def _model(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents"), full=False)


def op5_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    names = ("byte_bpe_50k", "byte_bpe_multi_50k")
    return tokens.token_totals(documents, labels, *(_model(f"{n}.tiktoken") for n in names), *names)


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(_table(spark, sf_dir, "documents"), _model("piece_bpe_32k.model"), full=False)


def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(_table(spark, sf_dir, "documents"), _model("piece_bpe_32k.model"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_sets(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_license_digests": op3_license_digests,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_totals": op5_token_totals,
    "op6_quality_trees": op6_quality_trees,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_fertility_rules": op8_fertility_rules,
    "op9_recompression_dedup": op9_recompression_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op3_license_digests": licenses.ORACLE,
    "op9_recompression_dedup": recompression.ORACLE,
    "op11_minhash_near_dedup": minhash.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_phrase_collocations": phrases.ORACLE,
}
