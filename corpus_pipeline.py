"""A corpus pipeline of five stages, each one operator over all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
one's docs. All but the last return the columns of documents: rejected documents and copies are gone, documents that
the mix takes twice are there twice. The last returns one row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from posledger.llm import exact_dedup, minhash, mixing, packing, quality_rules
from posledger.llm.queries import tokenizer_path
from posledger.sources.tables import shared_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.drop_rejected(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The fingerprints of op1 and, beyond their two bits, a five-word Jaccard of 0.8.
    return minhash.drop_near_copies(docs, fingerprints=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), with_ids=False).drop("ids")


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Fingerprints, minimum hashes, the balanced draw and token ids have no SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for nr, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if nr + 1 < len(STAGES):
            out.write.parquet(f"{folder}/{nr}")
            out = spark.read.parquet(f"{folder}/{nr}")
        docs = out
    return docs
