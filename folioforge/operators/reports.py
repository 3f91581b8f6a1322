"""Reports: counts, distributions, roll-ups and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRONG, WEAK = ("entity_crosscheck", "gold_fragment"), ("ocr_agreement", "title_match", "mirror_match")


def most_common(df: DataFrame, by: str, k: int | None = None) -> DataFrame:
    """(by, n), the commonest first; ties by value."""
    out = df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by)
    return out if k is None else out.limit(k)


def summary(registry: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for several columns, in one pass."""
    return registry.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))


def pdf_pages(documents: DataFrame) -> DataFrame:
    """One row of page sums of documents that have pages."""
    own = documents.where(F.coalesce("pages_total", F.lit(0)) > 0)
    return own.agg(F.count("*").alias("documents"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages_total", "pages_native", "pages_ocr", "pages_quarantined")))


def coverage(documents: DataFrame) -> DataFrame:
    """One row: how many documents have strong, weak, intrinsic and no evidence."""
    n = lambda *b: F.count_if(F.col("basis").isin(*b))
    return documents.agg(n(*STRONG).alias("strong"), n(*WEAK).alias("weak"), n("intrinsic_only").alias("intrinsic"), n("unverified").alias("unverified"))


def score_distribution(df: DataFrame, score: str) -> DataFrame:
    """One row: n, min, p25, median, p75, max and mean; quartiles are the values at n // 4 and 3n // 4 of the sorted list.

    Counts of equal scores meet, not the scores: scores have four decimals, so the sorted list is at most 10,001 rows.
    """
    hist = df.where(F.col(score).isNotNull()).groupBy(F.round(score, 4).alias("s")).agg(F.count("*").alias("c"))
    from pyspark.sql.window import Window

    cum = hist.withColumn("upto", F.sum("c").over(Window.orderBy("s"))).withColumn("n", F.sum("c").over(Window.partitionBy()))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("s")))
    n = F.col("n")
    median = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    r = lambda x: F.round(x, 4)
    return cum.agg(F.max("n").alias("n"), r(F.min("s")).alias("min"), r(at(F.floor(n / 4))).alias("p25"), r(median).alias("median"), r(at(F.floor(3 * n / 4))).alias("p75"), r(F.max("s")).alias("max"), r(F.sum(F.col("s") * F.col("c")) / F.max("n")).alias("mean"))


def fidelity(extracted: DataFrame, reference: DataFrame) -> DataFrame:
    """(path, extracted, reference, ratio) of two tables of character counts."""
    return extracted.join(reference, "path").withColumn("ratio", F.try_divide("extracted", "reference"))


def global_fidelity(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.sum("extracted").alias("extracted"), F.sum("reference").alias("reference"), F.round(F.sum("extracted") / F.sum("reference"), 4).alias("ratio"))


def low_fidelity(pairs: DataFrame, threshold: float = 0.95, least: int = 2000, k: int = 25) -> DataFrame:
    return pairs.where((F.col("reference") > least) & (F.col("ratio") < threshold)).orderBy("ratio", "path").limit(k)


def warning_heads(warnings: DataFrame, k: int = 25) -> DataFrame:
    """Warnings by what stands before the colon; violated invariants count as one kind."""
    head = F.when(F.col("warning").rlike(r"^I\d+"), "invariant_violation").otherwise(F.element_at(F.split("warning", ":"), 1))
    return most_common(warnings.select(head.alias("head")), "head", k)


def failed(manifest: DataFrame) -> DataFrame:
    """Written or quarantined documents with a failed check or no evidence."""
    return manifest.where(F.col("status").isin("success", "quarantined") & (F.exists("checks", lambda c: ~c["passed"]) | (F.col("basis") == "unverified")))


def diagnose(failed_docs: DataFrame) -> DataFrame:
    """(type, n) of failed checks."""
    return most_common(failed_docs.select(F.explode(F.filter("checks", lambda c: ~c["passed"])).alias("c")).select("c.type"), "type")


def find(df: DataFrame, needle: str, columns: list[str], k: int = 40) -> DataFrame:
    """Rows that have a text in one of some columns, whatever its case; the first k by the first column."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(c), F.lit(needle.lower()))
    return df.where(hit).orderBy(columns[0]).limit(k)


def manifest_row(warnings: Column, k: int = 10) -> Column:
    return F.slice(F.coalesce(warnings, F.array().cast("array<string>")), 1, k)


def all_manifests(parsed: DataFrame, skipped: DataFrame) -> DataFrame:
    return parsed.unionByName(skipped, allowMissingColumns=True)
