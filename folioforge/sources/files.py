"""Readers of files: scans with hashes, JSON lines, tables of fixed schemas, workbooks, texts; and writers that publish whole results."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import normalize_value

# Delimiters of table families, by a part of the file name, the longest part first.
CSV_FAMILIES = {"lit-covid": ("\t", 3), "pubmed-nlp": (",", 11), "pubmed": (",", 12), "clinicaltrials": (",", 27), "amazonunderworld": (",", 32)}
CELLS = "path string, sheet string, sheet_order int, row int, cells map<string,string>"


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, size, magic, sha256) of all files below a folder, path relative to it, by path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    top = root.rstrip("/").split("://")[-1].lstrip("/")
    path = F.regexp_replace("path", "^[a-z0-9]+:/*(?:[^/]*/)*?" + re.escape(top) + "/+", "")
    return raw.select(path.alias("path"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.substring("content", 1, 16).alias("magic"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; a path that isn't there is an empty table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row a file, whole; bytes that aren't UTF-8 are replaced."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def csv_family(name: Column) -> Column:
    """struct<delimiter, columns> by file name; a comma and no count for others."""
    out = F.struct(F.lit(",").alias("delimiter"), F.lit(None).cast("int").alias("columns"))
    for key in sorted(CSV_FAMILIES, key=len):
        sep, n = CSV_FAMILIES[key]
        out = F.when(F.contains(F.lower(name), F.lit(key)), F.struct(F.lit(sep).alias("delimiter"), F.lit(n).alias("columns"))).otherwise(out)
    return out


def read_csv(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """A table with quoted line breaks kept; its first row is the header."""
    return spark.read.schema(schema).csv(path, sep=delimiter, header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True)


def _sheets(content: bytes) -> Iterator[tuple[str, int, int, dict[str, str]]]:
    """(sheet, place, row, cells by column letters) of a workbook, which is a ZIP of XML: shared strings, sheets by their relations."""
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    text = lambda e: "".join(t.text or "" for t in e.iter() if local(t) == "t")
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = [text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        targets = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        for place, sheet in enumerate(e for e in book.iter() if local(e) == "sheet"):
            target = targets[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
            part = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for at, row in enumerate((e for e in part.iter() if local(e) == "row"), 1):
                cells = {}
                for c in (e for e in row if local(e) == "c"):
                    column = re.sub(r"\d", "", c.get("r", ""))
                    raw = next((e.text for e in c if local(e) == "v"), None)
                    if c.get("t") == "inlineStr":
                        cells[column] = text(c)
                    elif raw is not None:
                        cells[column] = shared[int(raw)] if c.get("t") == "s" else raw
                yield sheet.get("name"), place, int(row.get("r") or at), cells


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, sheet_order, row, cells) of XLSX files; cells are texts by column letters, sparse."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for p, content in zip(x["path"], x["content"], strict=True):
                rows = list(_sheets(bytes(content)))
                for a in range(0, len(rows), 5000):
                    yield pd.DataFrame([(p, *r) for r in rows[a : a + 5000]], columns=["path", "sheet", "sheet_order", "row", "cells"])

    return raw.mapInPandas(run, CELLS)


def _named_columns(cells: DataFrame, headers: list[str], header_row: DataFrame) -> DataFrame:
    """cells with a map from header to value, by the letters under which header_row(path, sheet, letters) has each header."""
    both = cells.join(header_row, ["path", "sheet"])
    values = F.map_from_arrays(F.array(*map(F.lit, headers)), F.transform(F.array(*map(F.lit, headers)), lambda h: normalize_value(F.try_element_at("cells", F.try_element_at("letters", h)))))
    return both.where(F.col("row") > F.col("header_row")).select("path", "sheet", "sheet_order", "row", values.alias("values"))


def load_index(cells: DataFrame, columns: dict[str, str], sheet: str | None = None, key: str = "doc_id") -> DataFrame:
    """Rows of a workbook's index, `columns` being header by result name; a header that is missing is an error, rows without the key are dropped."""
    own = cells if sheet is None else cells.where(F.col("sheet") == sheet)
    wanted = list(columns.values())
    flip = F.map_from_entries(F.filter(F.transform(F.map_entries("cells"), lambda e: F.struct(normalize_value(e["value"]).alias("k"), e["key"].alias("v"))), lambda e: e["k"].isin(*wanted)))
    head = own.groupBy("path", "sheet").agg(F.min_by(F.struct("cells", F.col("row").alias("header_row")), "row").alias("h")).select("path", "sheet", "h.header_row", F.col("h.cells").alias("cells")).withColumn("letters", flip).drop("cells")
    lost = F.array_except(F.array(*map(F.lit, wanted)), F.map_keys("letters"))
    head = head.withColumn("letters", F.when(F.size(lost) == 0, F.col("letters")).otherwise(F.raise_error(F.concat(F.lit("index without columns: "), F.array_join(lost, ", "))).cast("map<string,string>")))
    rows = _named_columns(own, wanted, head)
    out = rows.select(*(F.nullif(F.element_at("values", h), F.lit("")).alias(n) for n, h in columns.items()))
    return out.where(F.col(key).isNotNull())


def load_gold(cells: DataFrame, question: str, fragment: str, document: str) -> DataFrame:
    """(path, sheet, row, question, fragment, document): the header row is the first of a sheet that has all three headers; a question holds for the rows
    below it that have none; rows without a fragment are dropped."""
    wanted = [question, fragment, document]
    entries = F.transform(F.map_entries("cells"), lambda e: F.struct(normalize_value(e["value"]).alias("k"), e["key"].alias("v")))
    letters = F.map_from_entries(F.filter(entries, lambda e: e["k"].isin(*wanted)))
    heads = cells.withColumn("letters", letters).where(F.size(F.array_intersect(F.map_keys("letters"), F.array(*map(F.lit, wanted)))) == len(wanted))
    head = heads.groupBy("path", "sheet").agg(F.min_by(F.struct("letters", F.col("row").alias("header_row")), "row").alias("h")).select("path", "sheet", "h.*")
    rows = _named_columns(cells, wanted, head)
    value = lambda h: F.nullif(F.element_at("values", h), F.lit(""))
    w = Window.partitionBy("path", "sheet").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.select("path", "sheet", "row", F.last(value(question), ignorenulls=True).over(w).alias("question"), value(fragment).alias("fragment"), value(document).alias("document"))
    return filled.where(F.col("fragment").isNotNull())


def dataset_rows(cells: DataFrame) -> DataFrame:
    """(path, sheet, row, names, values) of workbooks as data: blank rows skipped, the first other row being the header."""
    filled = cells.where(F.exists(F.map_values("cells"), lambda v: F.coalesce(normalize_value(v), F.lit("")) != ""))
    first = filled.groupBy("path", "sheet").agg(F.min_by(F.struct("cells", F.col("row").alias("h")), "row").alias("x")).select("path", "sheet", F.col("x.cells").alias("head"), F.col("x.h").alias("header_row"))
    both = filled.join(first, ["path", "sheet"]).where("row > header_row")
    letters = F.array_sort(F.map_keys("head"), lambda a, b: F.when(F.length(a) != F.length(b), F.length(a) - F.length(b)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return both.select("path", "sheet", "row", F.transform(letters, lambda k: F.element_at("head", k)).alias("names"), F.transform(letters, lambda k: normalize_value(F.try_element_at("cells", k))).alias("values"))


def to_json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON text; nulls are left out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("value"))


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Writes beside the target and renames at the end: readers see the old result or the whole new one, and a failure leaves the old."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, temp, old = (jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", ".tmp", ".old"))
    fs = target.getFileSystem(conf)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).format(fmt).save(temp.toString())
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(temp, target):
        fs.rename(old, target)
        raise OSError(f"can't publish {path}")
    fs.delete(old, True)


def write_documents(documents: DataFrame, blocks: DataFrame, root: str) -> None:
    """Documents and their blocks as two tables, however many blocks a document has."""
    publish(documents, f"{root}/documents")
    publish(blocks, f"{root}/blocks")


def dangling_blocks(documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """Documents that count blocks and have none."""
    return documents.where("block_count > 0").join(blocks.select("doc_id").distinct(), "doc_id", "left_anti")
