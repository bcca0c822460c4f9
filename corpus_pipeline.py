"""A training-data pipeline over `documents`: rank quality, drop near copies, mask secrets, mix sources, encode.

Every stage is a function of (spark, docs, sf_dir) that calls one operator of the llm subpackage and returns a
DataFrame; all but the last return the columns of documents. Rows that are equal in id and text are one document to the
near-copy stage, which keeps the one with the smallest id of every component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import jaccard, mixing, pieces, quality, secrets
from termloom.operators.lineage import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality ranker accepts; it learns from the labelled documents of its input, held-out fold aside."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(~quality.held_out()))
    return quality.accepted(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of 5-word shingle sets with a Jaccard similarity of 0.8 or more."""
    return jaccard.one_of_each(docs, words=5, pct=80).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every reported secret and linked part; n_chars follows the text."""
    out = secrets.redact_documents(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents as the schedule takes the blocks that hold their first words."""
    return mixing.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every document, with their digest and whether they decode to the text."""
    return pieces.encode(docs, pieces.Pieces.load(), remember=100_000, together=1_000_000)


STAGES = [
    ("quality classifier", rank_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode_pieces),
]

#: A fitted ranker and Viterbi segmentation have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
