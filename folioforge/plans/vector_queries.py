"""Queries of the vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vectors as V
from .registry import query, read

UNIT = "unit as (select vec_id, list_transform(embedding, lambda x: x :: double / sqrt(list_sum(list_transform(embedding, lambda y: (y :: double) * y)))) as v from embeddings)"


def _unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("index_id"), V.l2_normalize(F.col("embedding")).alias("vector"))


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda y: (y :: double) * y))), 6) as norm, 1.0 as unit_norm from embeddings")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(norm(F.col("embedding")), 6).alias("norm"), F.round(norm(V.l2_normalize(F.col("embedding"))), 6).alias("unit_norm"))


_SEARCH_SQL = f"""with {UNIT}, s as (select q.vec_id as query_id, c.vec_id as index_id, list_inner_product(q.v, c.v) as score from unit q, unit c where q.vec_id % 100 = 0),
 r as (select *, row_number() over (partition by query_id order by score desc, index_id) as rank from s) select query_id, rank, index_id, round(score, 6) as score from r where rank <= 10"""


@query(_SEARCH_SQL)
def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = _unit(spark, sf_dir)
    hits = V.search(unit.where("index_id % 100 = 0").withColumnRenamed("index_id", "query_id"), unit)
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), "index_id", F.round("score", 6).alias("score"))


@query("select count(*) as vectors, count(*) as lines, 64 as dimension, max(10 + vec_id % 37) :: int as max_tokens, max(length('text ' || vec_id)) :: int as max_characters, true as holds from embeddings")
def index_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = _unit(spark, sf_dir)
    meta = unit.select("index_id", (10 + F.col("index_id") % 37).cast("int").alias("num_tokens"), F.concat(F.lit("text "), "index_id").alias("text"))
    return V.index_contract(unit, meta).select("vectors", "lines", F.col("dimension").cast("int").alias("dimension"), "max_tokens", "max_characters", "holds")


@query("select count(*) as vectors, count(*) - count_if(vec_id % 50 = 0) as lines, count_if(vec_id % 50 = 0) = 0 as holds from embeddings")
def index_contract_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata lines are missing: the contract has to fail."""
    unit = _unit(spark, sf_dir)
    meta = unit.where("index_id % 50 <> 0").select("index_id", F.lit(1).alias("num_tokens"), F.lit("t").alias("text"))
    return V.index_contract(unit, meta).select("vectors", "lines", "holds")


@query("select query_id, rank, index_id, label from (" + _SEARCH_SQL + ") join embeddings on vec_id = index_id")
def search_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits resolved to the metadata of what they hit."""
    meta = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("index_id"), "label")
    return V.resolve_hits(vector_search(spark, sf_dir), meta).select("query_id", "rank", "index_id", "label")


@query("select vec_id, row_number() over (order by label, vec_id) - 1 as index_id from embeddings")
def index_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.numbered(read(spark, sf_dir, "embeddings").select("vec_id", "label"), ["label", "vec_id"]).select("vec_id", F.col("index_id").cast("long").alias("index_id"))


@query("select doc_id, case when doc_id % 4 = 0 then 1 else 0 end as n_missing from documents where doc_id % 4 = 0 or doc_id % 9 = 0")
def invalid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    c = read(spark, sf_dir, "documents").select("doc_id", F.when(i % 4 != 0, "c").alias("chunk_id"), F.when(i % 9 == 0, " ").otherwise("x").alias("text"))
    return V.invalid_chunks(c, ["doc_id", "chunk_id", "text"]).select("doc_id", F.size("missing").alias("n_missing"))
