"""The training-data pipeline: five stages over `documents`, each over all that the one before it kept.

In every stage: very long texts are taken whole; repeated rows have the same verdict (near_duplicates keeps one of those
of a doc_id); an empty table gives no row; further columns, whatever their names, come out as they went in (packing
leaves them out).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from casebook.llm import jaccard, langid, ordinal, packing, secrets
from casebook.llm.common import materialise, table

#: Near copies share this many hundredths of their shingles of so many words.
NEAR_WORDS, NEAR_LEAST = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go. Labels without a document, or with nulls, are ignored; without
    usable labels every document has the prior, and the same verdict."""
    return ordinal.select(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too), or in no clear language, go. Equal letters go to the language
    that sorts first. Without training rows nothing is clear, so all go."""
    return langid.select(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: the least doc_id, of repeated rows of one doc_id any. Texts without
    a word link with nothing and stay, as do null doc_ids. Links are at NEAR_WORDS and NEAR_LEAST, not at op2's values."""
    return jaccard.select(docs, NEAR_WORDS, NEAR_LEAST)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, overlapping ones by one mask; every row stays, null texts null."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, every row's ids once. A null text is empty: its end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("redaction", redaction), ("packing", packed)]

#: Fitted models, links and token ids are beyond SQL. Tests compare links and ids with brute force; the quality and language
#: stages only with their operators' own scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
