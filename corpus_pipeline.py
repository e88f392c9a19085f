"""A cleaning pipeline over ``documents``: language, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read back as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquill.llm import decontaminate, language, near_duplicates, packing
from starquill.llm.common import table
from starquill.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: their text has letters and a language that is
    more likely than all others together.  Learns from the documents that name theirs."""
    found = language.identify(docs, language.fit(docs))
    return found.filter((F.col("lang_pred") != language.UNDETERMINED)
                        & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles with a similarity of 0.8
    or more: the one with the smallest id."""
    return near_duplicates.distinct_documents(docs, words=5, percent=80).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [("language identification", identify_language),
          ("n-gram Jaccard join", drop_near_duplicates),
          ("benchmark decontamination", drop_contaminated),
          ("best-fit packing", pack_sequences)]

# tokenizer, classifier and packing plan can't be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
