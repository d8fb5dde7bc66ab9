"""A cleaning pipeline over ``documents``: each stage works on what its predecessor kept.

Between stages the documents are written as Parquet and read again. All stages but the last return the
columns of ``documents``; a document's id stays its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import language_mix, minhash, pii_tagger, piece_tokens, pivotal_mix
from textloom.session import materialize

# share of a document's units that its main language must have
LEAST_LANGUAGE_SHARE = 0.5


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that are mainly in one known language; ``lang`` becomes the predicted one."""
    model = language_mix.train(docs.select("doc_id", "text", "lang").filter(~language_mix.held_out()))
    return language_mix.keep_identified(docs, model, LEAST_LANGUAGE_SHARE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates, whether or not it has an id."""
    return minhash.without_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by its kind in angle brackets."""
    return pii_tagger.masked(docs, pii_tagger.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return pivotal_mix.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, round_trip) per document of the mix."""
    encoded = piece_tokens.encode(docs)
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("language_id", keep_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
# learnt models and sampling by hashes have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
