"""The operators as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.llm.alignment import alignment_summary
from histora.llm.binary_output import packed_output
from histora.llm.common import table
from histora.llm.decontaminate import contaminated
from histora.llm.hnsw import nearest_neighbours
from histora.llm.html_text import page_texts
from histora.llm.maxent import maxent_scores
from histora.llm.neardup import near_duplicates
from histora.llm.oracles import ORACLES
from histora.llm.packing import pack_documents
from histora.llm.quality import quality_scores
from histora.llm.sharding import shard_by_bytes
from histora.llm.surrogates import replace_pii
from histora.llm.toxicity import toxicity_scores
from histora.llm.whitening import whitened_components


#: For the test tables only: whoever has the key can undo the surrogates by trying values
TEST_KEY = b"key of the test tables"


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


def op2_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return replace_pii(table(spark, folder, "documents"), TEST_KEY)


def op3_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_factorisation_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_hnsw_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_binary_output(spark: SparkSession, folder: str) -> DataFrame:
    return packed_output(table(spark, folder, "documents"))


def op9_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"))


def op10_maxent_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_scores(table(spark, folder, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_summary(table(spark, folder, "documents"))


def op12_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitened_components(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_html_text_density(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_minhash_neardup": op3_minhash_neardup,
    "op4_factorisation_quality": op4_factorisation_quality,
    "op5_hnsw_neighbours": op5_hnsw_neighbours,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_kneser_ney_toxicity": op7_kneser_ney_toxicity,
    "op8_binary_output": op8_binary_output,
    "op9_minimax_sharding": op9_minimax_sharding,
    "op10_maxent_scoring": op10_maxent_scoring,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_lanczos_whitening": op12_lanczos_whitening,
    "op13_html_text_density": op13_html_text_density,
}

__all__ = ["ORACLES", "QUERIES"]
