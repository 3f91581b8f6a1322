"""From files to scored documents: routing, guarded parsing, rescoring, tagged pages, quarantine reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.metadata import cache_key, extension
from . import json_docs, quality, segmentation
from .reports import most_common

# Which reader takes a file.
READERS = {".pdf": "pdf", ".json": "json", ".csv": "table", ".tsv": "table", ".xlsx": "workbook", ".txt": "text", ".jpg": "image", ".jpeg": "image", ".png": "image", ".pbf": "tile"}
DERIVED = ["matched_code", "score", "basis", "all_flags"]
MESSAGE = 300


def route(files: DataFrame, special: dict[str, str] | None = None) -> DataFrame:
    """files(path) with reader: by a part of the name first, then by the extension, whatever its case; null where none reads it."""
    name, out = F.lower(F.element_at(F.split("path", "/"), -1)), F.try_element_at(F.create_map(*(F.lit(x) for kv in READERS.items() for x in kv)), extension("path"))
    for part, reader in (special or {}).items():
        out = F.when(F.contains(name, F.lit(part)), reader).otherwise(out)
    return files.withColumn("reader", out)


def guarded(files: DataFrame, parse: Callable[[str, bytes], list[dict]], fields: str) -> DataFrame:
    """(path, fields..., error) of files(path, content): what parse gives for each file, or one row with the error's first characters. One bad file never fails the job."""
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for path, content in zip(x["path"], x["content"], strict=True):
                try:
                    rows += [{"path": path, **r, "error": None} for r in parse(path, bytes(content))]
                except Exception as e:  # noqa: BLE001  the row says what happened
                    rows.append({"path": path, "error": f"{type(e).__name__}: {e}"[:MESSAGE]})
            yield pd.DataFrame(rows, columns=["path", *names, "error"])

    return files.select("path", "content").mapInPandas(run, f"path string, {fields}, error string")


def rescore(registry: DataFrame, persisted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a rescore takes up: persisted documents of registry(path) without what was derived, and the paths that must be read again."""
    known = persisted.drop(*[c for c in DERIVED if c in persisted.columns])
    return known.join(registry.select("path"), "path", "left_semi"), registry.join(persisted.select("path"), "path", "left_anti")


def stage_keys(file_hash: Column, versions: dict[str, str]) -> Column:
    """Keys of the stages, each made of the one before it and its version: map<stage, key>."""
    entries, last = [], file_hash
    for stage, version in versions.items():
        last = cache_key(last, F.lit(stage), F.lit(version))
        entries += [F.lit(stage), last]
    return F.create_map(*entries)


def tagged_blocks(spans: DataFrame) -> DataFrame:
    """(doc_id, page, block, type, text, confidence) of spans(doc_id, page, block, line, n, text, size) of a tagged page.

    The page's commonest size is its body; a short block set larger by 15 % is a heading, surer at nine tenths of the largest; lists and page numbers go by
    their text.
    """
    real = spans.where(F.trim("text") != "").withColumn("size", F.round("size", 1))
    sizes = real.groupBy("doc_id", "page").agg(F.mode("size").alias("body"), F.max("size").alias("largest"))
    lines = real.groupBy("doc_id", "page", "block", "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "").alias("text"), F.sum("size").alias("s"), F.count("*").alias("c"))
    blocks = lines.groupBy("doc_id", "page", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]).alias("lines"), (F.sum("s") / F.sum("c")).alias("size")).join(sizes, ["doc_id", "page"])
    text = T.join_lines(F.array_join("lines", "\n"))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    heading = (F.col("size") >= F.col("body") * 1.15) & (words <= segmentation.HEADING_WORDS)
    listed = F.element_at("lines", 1).rlike(r"^\s*([•·–—\-*o]|\(?[a-z0-9]{1,3}[.)])\s+")
    kind = F.when(heading, "heading").when(listed, "list_item").when(text.rlike(segmentation.PAGE_NUMBER), "caption").otherwise("paragraph")
    sure = F.when(heading, F.when(F.col("size") >= F.col("largest") * 0.9, 0.95).otherwise(0.85)).when(listed, 0.85).otherwise(0.9)
    return blocks.select("doc_id", "page", "block", kind.alias("type"), text.alias("text"), sure.alias("confidence"))


def parse_texts(files: DataFrame, version: str = "1") -> DataFrame:
    """Blocks of files(doc_id, text): cleaned, cut at form feeds into pages, segmented and numbered."""
    pages = files.select("doc_id", F.posexplode(F.split("text", "\f")).alias("page", "raw")).select("doc_id", (F.col("page") + 1).alias("page"), T.clean_text("raw").alias("text"))
    return segmentation.number_blocks(segmentation.segment_pages(pages.withColumn("is_tabular", segmentation.is_tabular(F.col("text"))), segmentation.boilerplate(pages)), version)


def parse_json_files(files: DataFrame, version: str = "1") -> DataFrame:
    """Blocks of files(doc_id, text) of JSON, of any known shape; unknown shapes give what text they hold."""
    docs = json_docs.read_json(files.select("doc_id", F.col("text").alias("raw"))).select("doc_id", "v", "shape")
    one = lambda shape, parse: parse(docs.where(F.col("shape") == shape)).select("doc_id", F.posexplode("blocks").alias("n", "b")).select("doc_id", "n", "b.type", "b.text")
    parts = [one("alert", json_docs.parse_alerts), one("journal", json_docs.parse_journal), one("institutional", json_docs.parse_institutional), one("article", json_docs.parse_articles)]
    items = json_docs.list_items(docs.where("shape = 'article_list'"))
    listed = json_docs.parse_articles(items.select(F.struct("doc_id", "item").alias("doc_id"), "v"))
    parts.append(listed.select("doc_id.doc_id", "doc_id.item", F.posexplode("blocks").alias("k", "b")).select("doc_id", (F.col("item") * 100_000 + F.col("k")).alias("n"), "b.type", "b.text"))
    odd = json_docs.harvest(docs.where("shape = 'unrecognized'").select("doc_id", "v"))
    parts.append(odd.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("path")) - 1).alias("n"), F.lit("page_text").alias("type"), "text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.col("n").cast("int").alias("n"), "type", "text", F.lit(False).alias("is_boilerplate"), F.when(F.col("type") == "page_text", 0.3).otherwise(1.0).alias("confidence"))
    return segmentation.number_blocks(out, version)


def score_documents(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """sources(doc_id, source, checks, flags, warnings) with text, language, signals, percentiles' flags, score, basis and usable.

    A document's text is its blocks in order. One shuffle brings blocks together, one calibrates all signals.
    """
    text = blocks.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda b: b["text"]), "\n\n").alias("text"))
    d = T.with_signals(T.with_language(sources.join(text, "doc_id", "left").withColumn("text", F.coalesce("text", F.lit("")))))
    rated = quality.calibrate(quality.signals_long(d, ["doc_id", "source", "script"]), ["source", "script"])
    low = rated.where("flag is not null").groupBy("doc_id").agg(F.collect_set(F.concat("name", F.lit("_outlier_in_"), "source")).alias("outliers"))
    d = d.join(low, "doc_id", "left").withColumn("flags", F.concat(F.coalesce("flags", F.array().cast("array<string>")), F.coalesce("outliers", F.array().cast("array<string>")))).drop("outliers")
    d = quality.confidence(d)
    return d.withColumn("usable", quality.is_usable(F.col("score"), F.col("basis"), F.col("characters"), F.coalesce("warnings", F.array().cast("array<string>"))))


def manifest(scored: DataFrame) -> DataFrame:
    """One flat row for each document."""
    return scored.select("doc_id", "source", F.when(F.col("usable"), "success").otherwise("quarantined").alias("status"), "score", "basis", "language", "script", F.col("characters").cast("long").alias("characters"), F.slice(F.coalesce("warnings", F.array().cast("array<string>")), 1, 10).alias("warnings"), F.col("all_flags").alias("flags"))


def quarantine(rows: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Quarantined rows(action, reasons) by action, and by the k commonest reasons."""
    return most_common(rows, "action"), most_common(rows.select(F.explode("reasons").alias("reason")), "reason", k)
