"""Registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import (ann, bpe, cuckoo, jaccard, langid, merkle, mixing, neardup, negatives, oracles, passages, secret_scan,
                         toxicity, url_filter)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Where SQL can express the result by plain means.
ORACLES: dict[str, str] = {"op3_secret_scan": oracles.SECRETS, "op4_ngram_jaccard": oracles.JACCARD,
                           "op8_embedding_dedup": oracles.VECTOR_LINKS, "op11_cuckoo_dedup": oracles.EXACT_DUPLICATES,
                           "op12_merkle_manifest": oracles.MERKLE, "op13_hard_negatives": oracles.HARD_NEGATIVES}


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_source_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(table(spark, sf_dir, "documents"), corpus_pipeline.MIX_WEIGHTS)


@query("op2_ann_int8")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(corpus_pipeline.VOCABULARY),
                             public_tokenizers.PATTERN)


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicate_passages(table(spark, sf_dir, "documents"))


@query("op8_embedding_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_cuckoo_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_leaves(table(spark, sf_dir, "documents"), merkle.one_in_seven())


@query("op13_hard_negatives")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.query_labels(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
