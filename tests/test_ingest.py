import json

from pyspark.sql import functions as F

from folioforge.operators import chunking, ingest, vectors
from folioforge.plans import table_queries


def test_files_to_chunks(spark):
    prose = "INTRODUCTION\nThe report of the house is on the state of the water and it was made in the year for all of us.\n\n" + "It is the long way of the river that they have been on for a time, and we know it well. " * 8
    texts = spark.createDataFrame([("t1", prose), ("t2", prose + "\f" + prose), ("t3", "")], "doc_id string, text string")
    alert = {"title": "Alert", "alerta_meta": {"codigo": "1-20", "tema_clave": "The topic of the day", "municipios": "A (B)"}, "body_paragraphs": ["One of the two is here."]}
    article = {"title": "Title", "content": ["A text of the day."], "url": "u"}
    raws = [("j1", json.dumps(alert)), ("j2", json.dumps(article)), ("j3", json.dumps([article, article])), ("j4", json.dumps({"x": {"description": "a text that nobody knows the shape of, but long"}})), ("j5", "[]"), ("j6", "{")]
    blocks = ingest.parse_texts(texts).unionByName(ingest.parse_json_files(spark.createDataFrame(raws, "doc_id string, text string")))
    got = {r.doc_id: r for r in blocks.groupBy("doc_id").agg(F.count("*").alias("n"), F.min_by("type", "ord").alias("first"), F.max("block_id").alias("last")).collect()}
    assert got["t1"].first == "heading" and got["t1"].last == "t1:1:block:%06d" % got["t1"].n and got["t2"].n == 2 * got["t1"].n
    assert (got["j1"].n, got["j2"].n, got["j3"].n, got["j4"].n, got["j4"].first) == (3, 2, 4, 1, "page_text") and not {"t3", "j5", "j6"} & set(got)
    sources = spark.createDataFrame([(d, "S", None, None, ["empty_list__x"] if d == "j5" else []) for d in ("t1", "t2", "t3", "j5")], "doc_id string, source string, checks array<struct<type:string,passed:boolean,score:double>>, flags array<string>, warnings array<string>")
    scored = ingest.score_documents(blocks, sources)
    m = {r.doc_id: r for r in ingest.manifest(scored).collect()}
    assert m["t1"].status == "success" and m["t1"].language == "en" and m["t3"].status == "quarantined" and m["t3"].basis == "unverified" and m["j5"].status == "success"
    chunks = chunking.chunk(blocks.withColumn("method", F.lit("native")))
    records = chunking.chunk_records(chunks, spark.createDataFrame([("t1", "", "f.txt", "p/f.txt", "TXT", "F2", "en", "latin", 0.9, "intrinsic_only")], "doc_id string, url string, file_name string, path string, format string, phenomenon string, language string, script string, score double, basis string"))
    row = records.first()
    assert (row.source, row.format, row.phenomenon, row.section) == ("f.txt", "txt", 2, "INTRODUCTION")
    assert vectors.invalid_chunks(records.withColumn("chunk_id", F.lit("c")), ["doc_id", "chunk_id", "text"]).count() == 0


def test_routing_errors_and_rescore(spark):
    files = spark.createDataFrame([("a/X.PDF", b"1"), ("a/amazon.csv", b"bad"), ("a/z", b"")], "path string, content binary")
    assert [r.reader for r in ingest.route(files, {"amazon": "groups"}).collect()] == ["pdf", "groups", None]

    def parse(path, content):
        if content == b"bad":
            raise ValueError("no " * 200)
        return [{"n": len(content)}]

    out = {r.path: r for r in ingest.guarded(files, parse, "n int").collect()}
    assert out["a/X.PDF"].n == 1 and len(out["a/amazon.csv"].error) == 300
    known, new = ingest.rescore(files.select("path"), spark.createDataFrame([("a/z", 0.5, 1), ("gone", 0.1, 2)], "path string, score double, n int"))
    assert [tuple(r) for r in known.collect()] == [("a/z", 1)] and new.count() == 2
    keys = spark.range(1).select(ingest.stage_keys(F.lit("h"), {"extract": "1", "segment": "2"}).alias("k")).first().k
    assert len(set(keys.values())) == 2 and all(len(v) == 32 for v in keys.values())


def test_tagged_pages(spark):
    spans = [("d", 1, 0, 0, 0, "Big ", 20.0), ("d", 1, 0, 0, 1, "title", 20.0), ("d", 1, 1, 0, 0, "body text inter-", 10.0), ("d", 1, 1, 1, 0, "nal goes on", 10.0), ("d", 1, 2, 0, 0, "- item", 10.0), ("d", 1, 3, 0, 0, "12", 10.0), ("d", 1, 4, 0, 0, " ", 50.0)]
    out = ingest.tagged_blocks(spark.createDataFrame(spans, "doc_id string, page int, block int, line int, n int, text string, size double")).orderBy("block").collect()
    assert [(r.type, r.text) for r in out] == [("heading", "Big title"), ("paragraph", "body text internal goes on"), ("list_item", "- item"), ("caption", "12")] and out[0].confidence == 0.95


def test_quarantine(spark):
    rows = spark.createDataFrame([("ocr", ["a", "b"]), ("ocr", ["a"]), ("review", [])], "action string, reasons array<string>")
    by_action, by_reason = ingest.quarantine(rows)
    assert [tuple(r) for r in by_action.collect()] == [("ocr", 2), ("review", 1)] and by_reason.first().reason == "a"


def test_json_holds_whole_lines(spark, tmp_path):
    line = "word " * 80 + "end"
    spark.createDataFrame([(2, line), (3, line)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = table_queries._json(spark, str(tmp_path)).selectExpr("to_json(v) as v").collect()
    assert len(rows) == 2 and all(line in r.v for r in rows)
