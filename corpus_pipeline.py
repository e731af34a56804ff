"""The corpus pipeline: documents to training sequences, in four stages.

Each stage takes what its predecessor kept. All but the last return the columns of documents. Empty tables pass
through every stage; other columns, whatever their names, are carried along by all but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asfalto.llm import quality_pu, secret_cnn, swap_packing, weighted_minhash
from asfalto.llm.batches import bound_batches
from asfalto.llm.queries import WORD_VOCABULARY, _vocabulary
from asfalto.session import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null text counts as empty; whole texts are scored, row by row, so equal rows share a fate. A score equal to
    the threshold stays. Without trusted texts to learn from every row scores a half and stays.
    """
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_pu.reject_low(docs, quality_pu.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies stays, the one of the least doc_id.

    Null texts and texts without words are copies of nothing and stay, as do rows with a null doc_id. Of rows that
    repeat a doc_id one stays. Long texts are compared whole.
    """
    bound_batches(spark)
    return weighted_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out of the texts, and n_chars follows; every document stays.

    Null texts stay null. Whole texts are searched, row by row.
    """
    bound_batches(spark)
    return secret_cnn.redact(docs, secret_cnn.train(docs), length_column="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 2048 tokens.

    A null or empty text is one piece with the end token alone; longer texts than a sequence are cut into pieces.
    Repeated rows are packed one by one, and an empty table gives no rows.
    """
    bound_batches(spark)
    return swap_packing.pack_documents(docs, _vocabulary(WORD_VOCABULARY), end_id=0)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

# Trained models, tokenizers and packing are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
