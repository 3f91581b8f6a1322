"""The queries of this package and the SQL that they are compared with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}
MODULES = ("text_queries", "registry_queries", "quality_queries", "table_queries", "vector_queries", "source_queries")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with SQL that gives the same rows, where SQL can."""

    def put(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _oracle[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table. Documents in fewer splits than there are cores (a file of one row group can't be split) are dealt out, so that work on texts uses all
    cores; a table large enough to matter has more splits, and isn't touched."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name == "documents" and df.rdd.getNumPartitions() < cores else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _load() -> None:
    for m in MODULES:
        import_module(f"{__package__}.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracle)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents: language, signals, confidence."""
    return queries()["confidence_scores"](spark, sf_dir)
