"""A corpus from raw documents to packed sequences: language, toxicity, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import langid, minhash, packing, toxicity
from strata.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; junk without a language goes."""
    model = langid.fit(langid.training_rows(docs), "doc_id", "text", "lang")
    return langid.keep(docs, model)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a chain learned from the labels of those that came so far."""
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return minhash.keep(docs, minhash.Params(words=5, percent=80))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048).drop("ids")


STAGES = [
    ("language_id", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("packing", sequences),
]

#: SQL has neither the trained models nor the tokenizer; the tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
