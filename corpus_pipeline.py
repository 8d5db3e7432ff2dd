"""A corpus pipeline of five stages over the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
documents; the last returns the packing.  `run` writes every stage's result as Parquet in
the shared scratch folder and reads it back for the next.

A document is (doc_id, text, lang, source, n_chars).  Other columns are dropped by the first
stage that sees them, whatever their names; a stage given an empty table returns one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from berthline.llm import decontam, langid, packing, secret_scan, simhash
from berthline.llm.base import keep, prepared, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text some learned language accepts; the models learn from the labelled ones.

    Null texts, texts without a letter and those far from all learned languages go, and all of them if nothing is labelled; a null
    lang, source or id changes nothing else; repeated rows stay or go together.
    """
    prepared(spark)
    model = langid.train(langid.training_rows(docs))
    return langid.identify(docs.select(*COLUMNS), model).filter("not rejected").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the least id, null ids last.

    Null and empty texts are one group; of rows equal in id and text one stays.
    """
    prepared(spark)
    return simhash.one_of_each(docs.select(*COLUMNS), words_per_shingle=4, max_bits=4)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates; null and empty texts stay, an empty benchmark drops none."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars follows.  Null and empty texts and repeated rows stay as they are."""
    prepared(spark)
    return secret_scan.redacted(docs.select(*COLUMNS), secret_scan.Model.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their bins.  Documents without a text have one empty piece, repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Character models, fingerprints and packing can't be said in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
