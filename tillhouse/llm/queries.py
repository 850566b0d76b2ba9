"""The queries of this subpackage, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import alignment, arc, bitslice, bpe, chat, compression, dialogue, factorisation, golay, language_model, linededup, packing, simhash
from tillhouse.llm.text import table


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_recurrent_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return factorisation.score(docs, factorisation.learn(docs, table(spark, sf_dir, "labels")))


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.components(table(spark, sf_dir, "documents"))


def op5_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitslice.top_k(vectors, bitslice.every_nth(vectors))


def op6_three_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeats(docs, count="n_removed")


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.report(table(spark, sf_dir, "documents"))


def op8_legacy_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(table(spark, sf_dir, "pages"))


def op9_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op10_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op11_simhash_block_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op12_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.report(table(spark, sf_dir, "conversations"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_harmonic_packing,
        op2_recurrent_language_model,
        op3_factorisation_machine,
        op4_golay_simhash,
        op5_bit_sliced_top_k,
        op6_three_line_windows,
        op7_compression_bands,
        op8_legacy_archives,
        op9_byte_pairs,
        op10_perspective_rotation,
        op11_simhash_block_tables,
        op12_four_russians_repair,
        op13_tokenizer_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op6_three_line_windows": linededup.ORACLE,
    "op10_perspective_rotation": chat.ORACLE,
}
