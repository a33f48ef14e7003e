"""A training corpus from raw documents, in five stages.

Each stage is f(spark, docs, sf_dir) -> DataFrame. Its result is written as Parquet
and read again as the next stage's docs. All but the last return the columns of
docs. Rows with null or empty texts pass the filters (nothing speaks against them)
and end with no ids; rows that repeat a document pass or go together, except in
the near-duplicate stage, which keeps the smallest id of every group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.llm import bpe, decontaminate, pii, shingle_join, toxicity
from entityflow.llm._common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model gives grade 1 or more with a probability of one half go."""
    return toxicity.non_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: Jaccard similarity 0.8 on five-word shingles."""
    return shingle_join.one_of_each(docs, 5, 80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified overlap with a benchmark item go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes [KIND]; n_chars follows."""
    return pii.redact(docs, pii.bootstrap(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the ids of each text."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("bpe", encode),
]

#: No SQL can express the trained and iterative stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
