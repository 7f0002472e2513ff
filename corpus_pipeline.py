"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. A stage works on all rows that its predecessor kept. An empty table gives empty
tables all along; columns beyond those named are carried to the last stage but one, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessarea.llm.jaccard_join import first_of_each
from tessarea.llm.packing import encode_pieces, pack_pieces
from tessarea.llm.quality_rules import clean
from tessarea.llm.queries import vocabulary
from tessarea.llm.secret_scan import fit_on_documents, redact
from tessarea.llm.weak_quality import accept, fit
from tessarea.session import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the linear scorer rejects go.

    Null and empty texts are rejected; a null doc_id is no reason to go; repeated rows are judged alike."""
    return accept(docs, fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, and documents that the rules reject go.

    Null and empty texts, and those with fewer than 50 words, are rejected; repeated rows are judged alike; n_chars follows the text."""
    return clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 or more of their five-word shingles, the one with the smallest doc_id stays.

    A document without a doc_id stays only if no other of its group has one; rows equal in doc_id and text are one document."""
    return first_of_each(docs, size=5, num=4, den=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked, and no row goes; what is ordinary is learned from all texts. A null text stays null, an empty one empty; n_chars follows the text."""
    return redact(docs, fit_on_documents(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the ids of each piece of each document lie in the training sequences.

    A null or empty text is one piece with just the end id; a null doc_id is carried; repeated rows are packed each."""
    pieces = encode_pieces(docs, vocabulary("word_bpe_49k.json"), 2048)
    return pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# SQL can't express expectation-maximisation, the trained scorer, the Markov models or the packing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs
