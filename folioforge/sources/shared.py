"""The folder that the driver and all executors share, and tables kept there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. On one machine, where it is unset, a temporary folder; a cluster raises."""
    named, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioforge-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: what is used twice is computed once, and a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
