"""Training corpus from ``documents``: reject toxic texts, keep one document
of each near-duplicate group, mask secrets, mix the sources to their target
weights, encode to token ids.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's docs.  All stages but the last return the
columns of ``documents``; the mixing stage's order is that of its files and
rows, which the encoder keeps.

ORACLE_SQL is None: the classifier, the graph's components and the encoder
have no SQL form; tests compare the stages with brute force instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.bpe import encode_documents
from gleaner.llm.jaccard import drop_near_duplicates
from gleaner.llm.mixing import mix_documents
from gleaner.llm.secret_scan import redact_secrets
from gleaner.llm.toxicity import drop_toxic
from gleaner.session import materialize

VOCABULARY = "byte_bpe_50k.tiktoken"
# Target weights of the sources: five at three parts, five at two, the rest at one.
MIX_WEIGHTS = {**{f"src{i}": 3.0 for i in range(5)}, **{f"src{i}": 2.0 for i in range(5, 10)},
               **{f"src{i}": 1.0 for i in range(10, 20)}}

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, MIX_WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", near_duplicates), ("secrets", secrets),
          ("mixing", mixing), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
