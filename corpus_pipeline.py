"""The corpus pipeline: quality, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes it as Parquet in the shared folder and reads it again for the next
stage. All but the last return the columns of docs. Null texts, repeated rows and rows without an id go through
as the operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import covering_simhash, decontaminate, packing, pii_crf, quality_cnn
from folioforge.llm.common import read, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network doesn't reject. It learns from the labelled rows of docs."""
    return quality_cnn.without_rejected(docs, quality_cnn.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of SimHash near-duplicates."""
    return covering_simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows."""
    return pii_crf.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, one after another."""
    docs, folder = read(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    name, stage = STAGES[-1]
    stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")
