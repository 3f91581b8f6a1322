"""The row-wise transforms as an incremental stream. Corpus-wide figures (percentiles, counts) need the batch tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import clean_text, with_language, with_signals


def score_texts(df: DataFrame) -> DataFrame:
    """Cleaned text, language and signals of df(doc_id, text): no state, so a batch and a stream give the same rows."""
    return with_signals(with_language(df.withColumn("text", clean_text("text"))))


def run_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = score_texts) -> StreamingQuery:
    """Reads Parquet files that weren't read before, once, and appends their rows to target. Exactly once by the checkpoint."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
