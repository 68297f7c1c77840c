"""A training corpus out of the documents table: language, near copies, benchmark, secrets, packing.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and gives a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import decontaminate, jaccard_join, language, packing, secrets, store
from maskloom.llm.queries import TOKENIZER
from maskloom.session import tune


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter go. The trees learn from the labelled ones."""
    tune(spark)
    return language.drop_unidentified(docs, language.train(docs, F.lit(True)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more hang together, the one with the least doc_id stays."""
    tune(spark)
    return jaccard_join.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item (or a whole shorter one) go."""
    tune(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, n_chars follows; every document stays."""
    tune(spark)
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of 2048 tokens."""
    tune(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language", known_language), ("jaccard_join", one_of_each), ("decontaminate", no_benchmark), ("secrets", masked_secrets),
    ("pack", packed),
]

#: SQL has no context trees, nested key encodings or tokenizers; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
