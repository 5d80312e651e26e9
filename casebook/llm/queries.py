"""Queries of the training-data operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import centroids, fertility, jaccard, langid, matroska, negatives, ordinal, packing, secrets, sharding, tokenfile, urls, viterbi
from casebook.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.describe(matroska.store_samples(table(spark, sf_dir, "documents")))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabularies = [public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")]
    return fertility.measure_and_judge(docs, table(spark, sf_dir, "labels"), vocabularies)


def op7_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.train(docs, table(spark, sf_dir, "labels")))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op10_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read_tokens(tokenfile.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("exact")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_packing, op2_jaccard, op3_media, op4_langid, op5_secrets, op6_fertility, op7_viterbi, op8_ordinal, op9_urls, op10_tokenfile, op11_centroids, op12_negatives, op13_sharding)}
QUERIES["pipeline"] = pipeline
ORACLE_SQL: dict[str, str] = {"op9_urls": urls.SQL, "op11_centroids": centroids.SQL, "op12_negatives": negatives.SQL, "op13_sharding": sharding.SQL}
