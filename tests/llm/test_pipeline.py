import random
from collections import Counter

import corpus_pipeline
from folioforge.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, DATA).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= left.count()
        left = out
    assert left.where("text rlike '[a-z]@mail[0-9]'").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, DATA).toPandas()
    assert set(pieces["doc_id"]) == {r.doc_id for r in left.select("doc_id").collect()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0


def test_stages_on_odd_rows(spark):
    """Nulls, repeated rows, rows without id, an empty and a very long text, and columns whose names the operators use inside."""
    rng = random.Random(41)
    words = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").where("n_chars between 500 and 1500 and lang = 'en'").select("text").limit(8).collect()]
    passage = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    long = " ".join(f"word{rng.randrange(10**6)}" for _ in range(60_000))
    rows = [(i, t) for i, t in enumerate(words)] + [(0, words[0]), (50, words[0]), (None, words[1]), (51, None), (None, None), (52, ""), (53, long), (54, f"{words[2]} {passage} tail"), (55, words[3] + " write to jo.do@mail7.example.com")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "c", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, fp long, label string, __times int")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA).cache()
        assert out.columns == docs.columns, name
        sizes[name] = Counter((r.doc_id, r.text) for r in out.collect())
    assert not sizes["quality"] - Counter(rows)
    kept = sizes["near_duplicates"]
    assert kept[0, words[0]] == 1 and not kept[50, words[0]] and kept[1, words[1]] == 1 and not kept[None, words[1]] and kept[53, long] == 1
    assert sum(n for (_, t), n in kept.items() if not t) == 1 and not kept - Counter(rows)
    assert Counter(rows) - sizes["decontamination"] == Counter([(54, f"{words[2]} {passage} tail")])
    assert sizes["personal_data"][55, words[3] + " write to [email]"] == 1 and sizes["personal_data"][None, None] == 1 and sum(sizes["personal_data"].values()) == len(rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert pieces.where("start = 0").count() == len(rows) and pieces.agg({"length": "sum"}).first()[0] == pieces.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]


def test_every_operator_has_its_query():
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES)
    assert numbers == list(range(1, 11)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
