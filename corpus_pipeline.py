"""The corpus pipeline: toxic documents go, one of each group of near copies stays, sources are mixed to
their target weights, and the mixed documents are encoded.

Stages up to the last one return the columns of ``documents``; the mix repeats a document as often as it
takes it. The last returns one row per mixed document with its ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curatrix.llm import mixing, sentencepiece_fst, near_texts, toxicity
from curatrix.llm.queries import _file
from curatrix.llm.shared import shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7; the model is fitted on the labels beside the documents.

    Null and empty texts score as clean and stay; repeated rows stay or go together; null ids have no label.
    """
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts whose five-word shingles are alike to 0.8 or more.

    Null and empty texts are one group; of equal ids one row stays, null ids come last; no row goes for its id alone.
    """
    return near_texts.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole, in the order of the curriculum.

    Null sources are one source; null and empty texts have no words and are not taken; repeated rows count each.
    """
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and n_byte_tokens of each mixed document; null and empty texts have no ids."""
    return sentencepiece_fst.encode_texts(docs, _file(spark, "sentencepiece", "piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Fingerprints and encodings have no SQL form; a brute-force version tests the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet into the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
