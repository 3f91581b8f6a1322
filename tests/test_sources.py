import zipfile

from pyspark.sql import functions as F

from folioforge.sources import binary, files
from folioforge.streaming import ingest


def workbook(path, rows):
    cell = lambda r, c, v: f'<c r="{c}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in row.items()) + "</row>" for r, row in rows.items())
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets><sheet name="S" r:id="i1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="i1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{body}</sheetData></worksheet>")


def test_scan(spark, tmp_path):
    (tmp_path / "in/a").mkdir(parents=True)
    (tmp_path / "in/a/x.pdf").write_bytes(b"%PDF-1.7 more than sixteen")
    (tmp_path / "in/y.txt").write_bytes(b"caf\xe9")
    rows = files.scan(spark, str(tmp_path / "in")).collect()
    assert [(r.path, r.size, bytes(r.magic)[:4]) for r in rows] == [("a/x.pdf", 26, b"%PDF"), ("y.txt", 4, b"caf\xe9")]
    assert len(rows[0].sha256) == 64
    assert files.read_texts(spark, str(tmp_path / "in/y.txt")).first().text == "caf�"


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "i.xlsx", {1: {"A": "DOC_ID", "C": "Name"}, 2: {"A": "d1", "C": "one"}, 3: {"C": "no id"}, 5: {"A": "d2"}})
    cells = files.read_workbooks(spark, str(tmp_path / "i.xlsx"))
    assert [(r.doc_id, r.name) for r in files.load_index(cells, {"doc_id": "DOC_ID", "name": "Name"}).collect()] == [("d1", "one"), ("d2", None)]
    assert [list(r["values"]) for r in files.dataset_rows(cells).orderBy("row").collect()] == [["d1", "one"], [None, "no id"], ["d2", None]]
    workbook(tmp_path / "g.xlsx", {1: {"A": "notes"}, 2: {"A": "Q", "B": "F", "C": "D"}, 3: {"A": "q1", "B": "f1", "C": "a.pdf"}, 4: {"B": "f2", "C": "b.pdf"}, 5: {"A": "q2"}})
    gold = files.load_gold(files.read_workbooks(spark, str(tmp_path / "g.xlsx")), "Q", "F", "D").orderBy("row").collect()
    assert [(r.question, r.fragment) for r in gold] == [("q1", "f1"), ("q1", "f2")]


def test_csv_and_jsonl(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('a\tb\n1\t"x\ny"\n2\t"say ""hi"""\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "t.tsv"), "a int, b string", "\t").collect()] == [(1, "x\ny"), (2, 'say "hi"')]
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    files.to_json_lines(spark.createDataFrame([(1, None)], "a int, b string")).coalesce(1).write.text(str(tmp_path / "j"))
    assert [tuple(r) for r in files.read_jsonl(spark, str(tmp_path / "j"), "a int, b string").collect()] == [(1, None)]


def test_publish(spark, tmp_path):
    to = str(tmp_path / "out")
    files.publish(spark.range(3), to)
    files.publish(spark.range(5), to)
    assert spark.read.parquet(to).count() == 5 and not (tmp_path / "out.tmp").exists() and not (tmp_path / "out.old").exists()
    try:
        files.publish(spark.range(5).select(F.raise_error(F.lit("no")).alias("x")), to)
    except Exception:
        pass
    assert spark.read.parquet(to).count() == 5


def test_missing_tools_are_reported(spark):
    df = spark.createDataFrame([("a.pdf", bytearray(b"%PDF"))], "path string, content binary")
    if not binary.available()["pdftotext"]:
        assert "not installed" in binary.pdf_pages(df).first().error


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the cat and the dog of the house in a day"), (2, "x")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "s"))
    args = (spark, str(tmp_path / "s"), "doc_id long, text string", str(tmp_path / "t"), str(tmp_path / "c"))
    ingest.run_available(*args)
    ingest.run_available(*args)  # nothing new
    got = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert len(got) == 2 and all(got[r.doc_id].asDict()["characters"] == r.characters for r in ingest.score_texts(docs).collect())
