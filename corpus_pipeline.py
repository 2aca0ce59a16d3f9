"""From documents to packed sequences: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes as Parquet and reads again. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from equigauge.llm import decontam, packing, quality, simhash, toxicity
from equigauge.llm.common import prepare_session, table
from equigauge.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go."""
    prepare_session(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go."""
    prepare_session(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    prepare_session(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare_session(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    prepare_session(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-fit packing", pack),
]

#: The stages fit models, hash with XXH64 and tokenize, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = materialize(stage(spark, out, sf_dir), name.replace(" ", "-"))
    return out
