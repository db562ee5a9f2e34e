"""Corpus pipeline over ``documents``; each stage calls one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicegrid.llm import decontaminate, exact_dedup, jaccard_join, langid, sentencepiece_codec
from devicegrid.llm.common import read, written
from devicegrid.llm.queries import language_model, piece_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null or no letter) go."""
    return langid.with_language(docs, language_model(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and their number."""
    return sentencepiece_codec.encode(docs, piece_model(), ["doc_id", "lang", "source"]).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

#: Language identification and SentencePiece are beyond SQL; tests/llm holds
#: run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
