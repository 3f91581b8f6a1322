import duckdb

from folioforge.operators import registry as R
from folioforge.plans import registry


def test_work_of_one_path_is_taken_by_doc_id(spark):
    rows = [(i, "b" if i % 10 else "a", "retrievable", "pending") for i in reversed(range(100))] + [(100, None, "retrievable", "pending"), (-1, "a", "noise", "pending")]
    docs = spark.createDataFrame(rows, "doc_id long, path string, role string, status string").repartition(3)
    assert [r.doc_id for r in R.select_work(docs, None, 12).collect()] == [*range(0, 100, 10), 1, 2]
    assert R.select_work(docs.drop("doc_id"), None, 101).collect()[-1].path is None


def test_work_query_where_paths_tie_at_the_limit(spark, tmp_path):
    """900 rows of one source, 100 of them of the first path. One row group, which DuckDB reads in order; over more of them its own choice changes with the run."""
    duck = duckdb.connect()
    duck.execute(f"copy (select range * 34 as doc_id, 'x' as text, 'en' as lang, 'src0' as source, 1 as n_chars from range(900) order by 1) to '{tmp_path}/documents.parquet'")
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    want = duck.execute(registry.oracle_sql()["registry_work"]).fetchall()
    assert len({path for _, path in want}) == 1
    assert sorted(map(tuple, registry.queries()["registry_work"](spark, str(tmp_path)).collect())) == sorted(want)
