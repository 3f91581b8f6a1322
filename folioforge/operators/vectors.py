"""Vectors: normalisation, checks, an index with stable row numbers, exact inner-product search."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOP = 10
#: Queries held by a task at once; larger sets go in blocks.
QUERY_BLOCK = 4096
REQUIRED = ["doc_id", "chunk_id", "source", "format", "phenomenon", "position", "num_tokens", "text"]


def is_finite(v: Column) -> Column:
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def l2_normalize(v: Column) -> Column:
    """A vector of length one; zero vectors stay as they are."""
    x = F.transform(v, lambda e: e.cast("double"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, e: a + e * e))
    return F.when(norm == 0, x).otherwise(F.transform(x, lambda e: e / norm))


def invalid_chunks(chunks: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Chunks that lack a required field or have a blank text."""
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required if c in chunks.columns), *(F.lit(c) for c in required if c not in chunks.columns)))
    return chunks.withColumn("missing", missing).where((F.size("missing") > 0) | (F.trim("text") == ""))


def encode(chunks: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 64) -> DataFrame:
    """chunks with `vector`: load() gives a worker its encoder, once; its answers must be finite, and are normalised."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for x in batches:
            texts = x["text"].tolist()
            parts = [np.asarray(model(texts[a : a + batch]), np.float32) for a in range(0, len(texts), batch)]
            out = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
            if not np.isfinite(out).all() or len(out) != len(texts):
                raise ValueError("an encoder must give one finite vector for each text")
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            yield x.assign(vector=list(out / np.where(norm > 0, norm, 1)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema)
    return chunks.mapInPandas(run, f"{fields}, vector array<float>")


def numbered(vectors: DataFrame, order: list[str]) -> DataFrame:
    """vectors with index_id, 0, 1, ... in the order of some columns, dealt by range: sizes of ranges are counted, then each is numbered by itself."""
    ranged = vectors.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    ranged = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1)
    sizes = vectors.repartitionByRange(*order).groupBy(F.spark_partition_id().alias("__p")).agg(F.count("*").alias("__s"))
    before = F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    return ranged.join(F.broadcast(sizes.select("__p", F.coalesce(before, F.lit(0)).alias("__b"))), "__p").withColumn("index_id", F.col("__b") + F.col("__n")).drop("__p", "__n", "__b")


def index_contract(vectors: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row: vectors, metadata lines, dimensions, largest token and character counts, and whether the contract holds."""
    v = vectors.agg(F.count("*").alias("vectors"), F.min(F.size("vector")).alias("dimension"), F.count_distinct(F.size("vector")).alias("dimensions"))
    m = metadata.agg(F.count("*").alias("lines"), F.max("num_tokens").alias("max_tokens"), F.max(F.length("text")).alias("max_characters"))
    return v.crossJoin(m).withColumn("holds", (F.col("vectors") == F.col("lines")) & (F.col("dimensions") <= 1))  # a row of totals each


def search(queries: DataFrame, index: DataFrame, k: int = TOP, query_vector: str = "vector", index_vector: str = "vector") -> DataFrame:
    """(query_id, rank, index_id, score): the exact k largest inner products of queries(query_id, vector) with index(index_id, vector).

    A stated query set against all rows: queries travel to the tasks in blocks of bounded size; each batch of the index keeps its own k best, and
    only these are ranked. Ties go to the smaller index_id; negative ids are skipped.
    """
    n = queries.count()
    out = None
    for b in range(max(1, -(-n // QUERY_BLOCK))):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-n // QUERY_BLOCK)))) == b).select("query_id", query_vector).toPandas()
        ids, q = part["query_id"].to_numpy(), np.array(part[query_vector].tolist(), np.float64)

        def run(batches: Iterator[pd.DataFrame], ids=ids, q=q) -> Iterator[pd.DataFrame]:
            for x in batches:
                if not len(x) or not len(ids):
                    continue
                rows, scores = x["index_id"].to_numpy(), q @ np.array(x["v"].tolist(), np.float64).T
                order = np.lexsort((np.broadcast_to(rows, scores.shape), -scores), axis=1)[:, :k]
                yield pd.DataFrame({"query_id": np.repeat(ids, order.shape[1]), "index_id": rows[order].ravel(), "score": np.take_along_axis(scores, order, 1).ravel()})

        own = index.where("index_id >= 0").select("index_id", F.col(index_vector).alias("v")).mapInPandas(run, "query_id long, index_id long, score double")
        out = own if out is None else out.unionByName(own)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "index_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "index_id", "score")


def resolve_hits(hits: DataFrame, metadata: DataFrame) -> DataFrame:
    return hits.join(metadata, "index_id", "left")


def manifest(vectors: int, dimension: int, model: str, versions: dict[str, str]) -> dict:
    """What an index is: count, dimension, how vectors were made, and versions."""
    return {"vectors": vectors, "dimension": dimension, "dtype": "float32", "metric": "inner_product", "normalized": True, "model": model, "versions": versions}
