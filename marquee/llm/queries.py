"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import (
    fertility,
    html_text,
    importance,
    jaccard,
    licences,
    mixing,
    nra,
    packing,
    permutation_index,
    pitman_yor,
    quality,
    secret_scan,
    token_files,
)
from marquee.llm.common import read
from marquee.session import run_folder


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents")).drop("node", "component")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "token-files")
    docs = read(spark, sf_dir, "documents")
    token_files.write_token_files(docs, folder)
    rows = token_files.read_token_files(spark, folder, docs)
    return rows.selectExpr("key as doc_id", "start", "n_tokens", "ids_crc32")


def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fertility.judge(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "entropy_ratio", "script",
    )


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "p")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.draw(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op13_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_packing": op2_packing,
    "op3_html_text": op3_html_text,
    "op4_licences": op4_licences,
    "op5_permutation_index": op5_permutation_index,
    "op6_token_files": op6_token_files,
    "op7_fertility": op7_fertility,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_importance": op11_importance,
    "op12_secrets": op12_secrets,
    "op13_nra": op13_nra,
}

ORACLE_SQL: dict[str, str] = {
    "op1_jaccard": jaccard.ORACLE_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
    "op11_importance": importance.ORACLE_SQL,
    "op13_nra": nra.ORACLE_SQL,
}
