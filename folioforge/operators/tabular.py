"""Rows of tables: texts, typed values, groups merged by key, columns turned into arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.metadata import multi_values, row_text, typed_cell
from ..functions.text import normalize_value


def parse_rows(rows: DataFrame, names: list[str], multi: list[str] = ()) -> DataFrame:
    """rows(row, names...) without blank rows, row numbers kept, with `text` and `data`, a VARIANT of typed values."""
    blank = F.lit(True)
    for n in names:
        blank = blank & (F.coalesce(normalize_value(n), F.lit("")) == "")
    fields = []
    for n in names:
        value = F.nullif(normalize_value(n), F.lit(""))
        number = typed_cell(value)["i"]
        if n in multi:
            fields.append(F.to_json(multi_values(value)))
        else:
            fields.append(F.coalesce(number.cast("string"), F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")))
    entries = [F.when(F.coalesce(normalize_value(n), F.lit("")) != "", F.concat(F.lit(f'"{n}":'), f)) for n, f in zip(names, fields, strict=True)]
    data = F.parse_json(F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*entries)), ","), F.lit("}")))
    return rows.where(~blank).select("row", row_text(names).alias("text"), data.alias("data"))


def ragged(rows: DataFrame, cells: str, width: int) -> DataFrame:
    """One row: how many rows there are and how many haven't the header's width."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.size(cells) != width).alias("ragged"))


def flags_to_array(prefix: str, columns: list[str], yes: str = "SI") -> Column:
    """Names, without prefix, of the columns that say yes, in the columns' order."""
    return F.array_compact(F.array(*(F.when(F.upper(F.col(c)) == yes, F.lit(c[len(prefix) :])) for c in columns)))


def merge_groups(rows: DataFrame, key: Column, first: list[str], groups: str, row: str = "row") -> DataFrame:
    """One row for each key: the first rows' values of `first`, the rows merged, and the union of the arrays `groups` in the order first seen.

    Group members are cut to their first rows before they meet, so a key with many rows carries its distinct members only; the list of merged rows is the result's own size.
    """
    keyed = rows.withColumn("key", key)
    base = keyed.groupBy("key").agg(*(F.min_by(c, row).alias(c) for c in first), F.array_sort(F.collect_list(row)).alias("source_rows"))
    seen = keyed.select("key", row, F.posexplode(groups).alias("place", "member")).groupBy("key", "member").agg(F.min(F.struct(row, "place")).alias("at"))
    union = seen.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "member"))), lambda x: x["member"]).alias("members"))
    return base.join(union, "key", "left").withColumn("members", F.coalesce("members", F.array().cast("array<string>")))


def count_by(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def abandoned_sheet(declared: Column, data: Column) -> Column:
    """A sheet that declares over fifty rows and over five times those it has."""
    return (declared > 50) & (declared > 5 * data)


def forward_fill(df: DataFrame, column: str, partition: list[str], order: list[str]) -> DataFrame:
    """Nulls of a column replaced by the last value before them."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def split_documents(df: DataFrame, column: str) -> DataFrame:
    """A row for each line of a cell that names documents; `name` and, after white space, an older id."""
    lines = F.filter(F.transform(F.split(column, "\n"), normalize_value), lambda x: x != "")
    return df.withColumn("__line", F.explode(lines)).withColumns({"name": F.regexp_extract("__line", r"^(\S.*?\.\w{2,5})(?:\s|$)", 1), "legacy": F.nullif(F.regexp_extract("__line", r"^\S.*?\.\w{2,5}\s+(\S+)$", 1), F.lit(""))}).drop("__line")
