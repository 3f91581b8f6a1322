"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only on one machine, as in tests, a temporary folder is set where it is unset; a cluster raises."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioforge-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor doesn't cost the whole lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n: the folds of labelled data. A null id belongs to no fold (null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def map_arrow(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """per_batch over Arrow batches. schema: of the result, as DDL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := per_batch(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
