"""From raw documents to packed training sequences: quality, toxicity, near duplicates, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import near_copies, packing, pii, quality_cnn, toxicity_chain
from tidemark.llm.queries import QUALITY_THRESHOLD, TOXIC_THRESHOLD, _toxicity_model
from tidemark.llm.scratch import free, stored, table
from tidemark.llm.token_units import default_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold, all columns; null texts score as empty ones, repeated rows alike."""
    model, score = quality_cnn.fit(docs, table(spark, sf_dir, "labels")), free("score", docs.columns)
    return quality_cnn.scored(docs, model, score_col=score).where(F.col(score) >= QUALITY_THRESHOLD).select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic, all columns; null texts score as empty ones, repeated rows alike."""
    scores = free("scores", docs.columns)
    scored = toxicity_chain.scored(docs, _toxicity_model(spark, sf_dir, docs), scores_col=scores)
    return scored.where(F.get(scores, F.lit(1)) < TOXIC_THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group whose sets of five-word shingles have a Jaccard similarity of 0.8.

    Rows with a null id stay; of rows with one id, the one with the least hash comes first.
    """
    return near_copies.keep_first(docs, words=5, similarity=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text. A null text stays null, its n_chars as well."""
    spans = free("spans", docs.columns)
    found = pii.find(docs, spans_col=spans)
    text = found.withColumn("text", pii.redacted(found["text"], found[spans]))
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins; repeated rows and null ids are packed as others, null texts as empty ones."""
    return packing.packed(packing.token_lengths(docs, default_path("byte_bpe_50k.json")))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("pack", pack)]

#: The classifiers and the packing cannot be expressed in SQL; tests/llm/test_pipeline.py and test_near_copies.py hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
