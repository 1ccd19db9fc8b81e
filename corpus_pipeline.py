"""From raw documents to token ids: five stages, each an operator of chatmill.llm over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.llm.codec import with_round_trip
from chatmill.llm.minhash import drop_near_duplicates
from chatmill.llm.mixing import Mix
from chatmill.llm.pii import with_pseudonyms
from chatmill.llm.queries import table, vocabulary
from chatmill.llm.toxicity import drop_toxic
from chatmill.operators.staging import stage

# A pseudonym key of one's own belongs here; this one is for examples.
PSEUDONYM_KEY = "an example key"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the lexicon, learned from the labelled ones among them, takes for toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of smallest id, of each group of near copies, which share 80 % of their shingles or more."""
    return drop_near_duplicates(docs, least=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms of the same format."""
    return with_pseudonyms(docs, PSEUDONYM_KEY, every_phone=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row for each round that takes words of a document, with these words as its text."""
    return Mix(docs, keep=True).texts()


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number and hashes of ids and decoded text."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    coded = with_round_trip(docs.select("doc_id", "source", "text"), ranks)
    return coded.select(
        "doc_id",
        "source",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pseudonyms", pseudonyms), ("mixing", mixing), ("tokens", tokens)]

# Learned weights, Feistel rounds and byte-pair merging are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
