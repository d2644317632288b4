"""A corpus from raw documents: low quality, copies, near-copies and benchmark leaks go, the
rest is encoded. Each stage is written as Parquet to the shared folder and read again, so a
lost executor costs a part of one stage.

ORACLE_SQL is None: the first stage scores with a trained network, which SQL cannot express.
``tests/llm/test_pipeline.py`` holds the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdance.llm import bytebpe, decontaminate, exactcopies, nearcopies, quality
from verdance.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactcopies.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bytebpe.encode(docs, keys=("doc_id",), with_ids=True)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document that stays."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
