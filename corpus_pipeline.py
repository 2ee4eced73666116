"""A training-data pipeline over `documents`: quality, near duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.llm.common import free_name, saved, ship, table
from histora.llm.decontaminate import contaminated
from histora.llm.neardup import near_duplicates
from histora.llm.packing import pack_documents
from histora.llm.quality import scored, train
from histora.llm.queries import TEST_KEY
from histora.llm.surrogates import with_surrogates

#: Some stages have no SQL form; they are tested against brute force.
ORACLE_SQL = None


#: Setting that names the key of the surrogates; without it they are made with a key that is no secret
KEY_SETTING = "spark.histora.surrogateKey"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Documents that the factorisation machine scores `threshold` or more.

    Null and empty texts are scored like others, by their structure alone; rows with a null id are scored but teach nothing; repeated
    rows get equal scores and stay or go together; without labels the prior decides for all. An empty table stays empty.
    """
    ship(spark)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    model = train(texts, labels, "quality", buckets=1 << 15, rank=8, max_rows=6000)
    score = free_name(docs, "_quality")
    kept = scored(docs, model, "text", score).where(F.col(score) >= threshold)
    return kept.select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Repeated rows are one document and stay. Null, empty and blank texts are near nothing and stay, as do groups in which all
    ids are null. An empty table stays empty.
    """
    id_, hash_ = free_name(docs, "_id"), free_name(docs, "_hash")
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    return docs.join(gone, same, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, verbatim or edited.

    Texts decide, so repeated rows go together, whatever their ids. Null, empty and blank texts hold nothing and stay; null,
    empty and blank items are held by nothing. An empty table stays empty, and without a benchmark all rows stay.
    """
    hash_ = free_name(docs, "_hash")
    texts = docs.select(F.xxhash64("text").alias(hash_), "text")
    hits = contaminated(texts, table(spark, sf_dir, "benchmark"), id_col=hash_).select(hash_).distinct()
    return docs.join(hits, F.xxhash64("text") == F.col(hash_), "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str, key: bytes | None = None) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the text.

    The key is the one given, else that of the session (KEY_SETTING). Null, empty and blank texts and texts without entities
    stay as they are, with their n_chars; repeated rows and null ids are treated like others. An empty table stays empty.
    """
    key = key or spark.conf.get(KEY_SETTING, TEST_KEY.decode()).encode()
    count = free_name(docs, "_entities")
    found = with_surrogates(docs, "text", key, count)
    if "n_chars" in docs.columns:
        length = F.when(F.col(count) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return found.select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their places in sequences of 2048.

    Null and empty texts are a piece of the separator alone; repeated rows and rows with a null id are packed like others. An empty
    table gives no pieces.
    """
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what a stage keeps is written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
