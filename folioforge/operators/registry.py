"""The registry of files: format, role, reconciliation with an index, catalog references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.metadata import extension, is_success, standard_name, stem

# First bytes of formats, as hex, and the format that an extension promises.
SIGNATURES = [("25504446", "pdf"), ("89504E470D0A1A0A", "png"), ("FFD8FF", "jpeg"), ("474946383761", "gif"), ("474946383961", "gif"), ("504B0304", "zip"), ("1F8B", "gzip")]
HTML_MARKS = ("<!doctype", "<html", "<?xml", "<head", "<body")
EXPECTED = {".pdf": "pdf", ".json": "json", ".csv": "csv", ".tsv": "csv", ".xlsx": "zip", ".txt": "text", ".jpg": "jpeg", ".jpeg": "jpeg", ".png": "png", ".avif": "avif", ".pbf": "pbf"}
DOCUMENT_ENDINGS = (".pdf", ".doc", ".docx")


@dataclass(frozen=True)
class Rules:
    """What a corpus keeps apart. Paths and names are the corpus's own."""

    evaluation: tuple[str, ...] = ()
    index: tuple[str, ...] = ()
    noise: tuple[str, ...] = (".DS_Store", "Thumbs.db")
    catalog: str = r"(?i)(_catalog[-_.]|_catalogo\.|_registro\.|-catalog\.|tiles-index)"
    skip_names: dict[str, str] = field(default_factory=dict)
    skip_extensions: dict[str, str] = field(default_factory=lambda: {".pbf": "geometry_only__attributes_available_in_csv", ".avif": "profile_photo__no_informational_value"})
    structured: tuple[str, ...] = ("pubmed-", "clinicaltrials-", "lit-covid")


def detect_format(magic: Column, ext: Column) -> Column:
    """The format that a file's first 16 bytes show; text formats have none and go by their extension."""
    code = F.hex(magic)
    out = F.when(F.startswith(code, F.lit("504B0304")) & (ext == ".xlsx"), "xlsx")
    for sign, name in SIGNATURES:
        out = out.when(F.startswith(code, F.lit(sign)), name)
    head = F.lower(F.ltrim(F.regexp_replace(F.decode(F.substring(magic, 1, 16), "ISO-8859-1"), r"^\s+", "")))
    out = out.when(head.rlike("^(?:" + "|".join(m.replace("?", r"\?") for m in HTML_MARKS) + ")"), "html")
    out = out.when(F.substring(code, 9, 8) == "66747970", "avif").when((ext == ".pbf") & F.startswith(code, F.lit("1A")), "pbf")
    for e in (".json", ".csv", ".tsv", ".txt"):
        out = out.when(ext == e, EXPECTED[e])
    return out.otherwise("unknown")


def is_mismatch(detected: Column, ext: Column) -> Column:
    expected = F.try_element_at(F.create_map(*(F.lit(x) for kv in EXPECTED.items() for x in kv)), ext)
    return F.when(expected.isNull() | (detected == "unknown"), False).when(ext == ".xlsx", ~detected.isin("xlsx", "zip")).otherwise(detected != expected)


def classify(files: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """files(path, magic) with ext, detected, mismatch, role, status, reason and hint; the first rule that holds wins."""
    name = F.element_at(F.split("path", "/"), -1)
    of = lambda x, by: F.try_element_at(F.create_map(*(F.lit(v) for kv in by.items() for v in kv)), x) if by else F.lit(None).cast("string")
    files = files.withColumns({"name": name, "ext": extension("path")})
    files = files.withColumn("detected", F.when(F.col("name").isin(*rules.noise), None).otherwise(detect_format(F.col("magic"), F.col("ext"))))
    verdict = lambda role, status, reason: F.struct(F.lit(role).alias("role"), F.lit(status).alias("status"), (reason if isinstance(reason, Column) else F.lit(reason)).cast("string").alias("reason"))
    by_name, by_ext = of(F.col("name"), rules.skip_names), of(F.col("ext"), rules.skip_extensions)
    found = (
        F.when(F.col("name").isin(*rules.noise), verdict("noise", "intentional_skip", "noise"))
        .when(F.col("path").isin(*(rules.evaluation or ("",))), verdict("evaluation", "intentional_skip", "evaluation_artifact"))
        .when(F.col("path").isin(*(rules.index or ("",))), verdict("metadata", "intentional_skip", "master_index"))
        .when(F.col("ext").isin(".json", ".csv") & F.col("name").rlike(rules.catalog), verdict("metadata", "intentional_skip", "metadata_source"))
        .when((F.col("ext") == ".pdf") & (F.col("detected") != "pdf"), verdict("retrievable", "invalid_source", F.concat(F.lit("declared_pdf_but_detected_"), "detected", F.lit("__failed_download"))))
        .when(by_name.isNotNull(), verdict("retrievable", "intentional_skip", by_name))
        .when(by_ext.isNotNull(), verdict("retrievable", "intentional_skip", by_ext))
        .otherwise(verdict("retrievable", "pending", None))
    )
    hint = F.when((F.col("v.role") == "retrievable") & (F.col("v.status") == "pending") & F.lower("name").rlike("|".join(rules.structured)), "structured_only").otherwise("full")
    out = files.withColumn("v", found).withColumns({"mismatch": F.coalesce(is_mismatch(F.col("detected"), F.col("ext")), F.lit(False)), "hint": hint})
    return out.select(*files.columns, "mismatch", "v.role", "v.status", "v.reason", "hint")


def select_work(registry: DataFrame, only: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Retrievable, pending rows, those named in only(doc_id) if given, the first so many by path, of rows of one path by doc_id; rows without a path come last."""
    out = registry.where("role = 'retrievable' and status = 'pending'")
    out = out if only is None else out.join(only, "doc_id", "left_semi")
    return out if limit is None else out.orderBy(F.asc_nulls_last("path"), *(c for c in out.columns if c == "doc_id")).limit(limit)


def reconcile(disk: DataFrame, index: DataFrame) -> DataFrame:
    """disk(path, ...) against index(path, ...): every path of either side once, with `side` in (both, extra, missing)."""
    marked = disk.withColumn("__d", F.lit(1)).join(index.withColumn("__i", F.lit(1)), "path", "full")
    side = F.when(F.col("__d").isNull(), "missing").when(F.col("__i").isNull(), "extra").otherwise("both")
    return marked.withColumn("side", side).drop("__d", "__i")


def unexpected(reconciled: DataFrame, expected: DataFrame) -> DataFrame:
    """Extra paths that expected(path) doesn't name."""
    return reconciled.where("side = 'extra'").select("path").join(expected, "path", "left_anti").distinct()


def reconciliation_totals(reconciled: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row: counts of each side, the files scanned(role) and the noise among them, and whether indexed + extras + noise makes the files scanned.

    The identity fails where a path stands more than once in the index or on the disk, or where a file was lost on the way to reconciliation.
    """
    n = lambda s: F.count_if(F.col("side") == s)
    sides = reconciled.agg(n("both").alias("indexed"), n("extra").alias("extras"), n("missing").alias("missing"))
    disk = scanned.agg(F.count("*").alias("scanned"), F.count_if(F.col("role") == "noise").alias("noise"))
    return sides.crossJoin(disk).withColumn("identity", F.col("indexed") + F.col("extras") + F.col("noise") == F.col("scanned"))  # a row of totals each


def unequal_sets(actual: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """(column, side) of the values that one side has and the other hasn't: `unexpected` or `missing`. Empty if the sets are equal; nulls are a value."""
    a, b = actual.select(column).distinct(), expected.select(column).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("unexpected")).unionByName(b.exceptAll(a).withColumn("side", F.lit("missing")))


def assert_same_set(actual: DataFrame, expected: DataFrame, column: str, what: str = "values") -> None:
    """Raises, naming some of them, if one side has values that the other hasn't: the strict mode."""
    if odd := unequal_sets(actual, expected, column).orderBy("side", column).limit(10).collect():
        raise ValueError(f"{what} differ: " + ", ".join(f"{r['side']} {r[column]}" for r in odd))


def catalog_references(records: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """records(catalog, ord, code, url, title, date, status) that point to a document, with candidate file name and whether the download worked."""
    clean = F.lower(F.trim(F.try_url_decode(F.replace(F.element_at(F.split("url", r"\?"), 1), F.lit("+"), F.lit("%2B")))))
    named = records.where(F.lower("url").rlike("^https?://") & clean.rlike("(?:" + "|".join(e.replace(".", r"\.") for e in DOCUMENT_ENDINGS) + ")$"))
    return named.withColumns({"ok": is_success("status"), "candidate": standard_name("url", F.col("code"))})


def resolve_references(refs: DataFrame, disk: DataFrame) -> DataFrame:
    """refs(catalog, ord, code, candidate, ...) with resolved path and kind of match, from disk(path, disk_order).

    Probes in order: the exact name, the name with -2, the stem without its code, the code and stem; stems match with any
    extension. The first probe with a hit wins, and of its hits the first on the disk. All probes are equi-joins.
    """
    low = F.lower("candidate")
    base, ext, head = F.regexp_replace(low, r"\.[^.]*$", ""), F.regexp_extract(low, r"\.([^.]*)$", 1), F.concat(F.lower("code"), F.lit("_"))
    bare = F.when(F.startswith(base, head), F.substring(base, F.length(head) + 1, F.length(base))).otherwise(base)
    probe = lambda order, kind, by, key: F.struct(F.lit(order).alias("prio"), F.lit(kind).alias("kind"), F.lit(by).alias("by"), key.alias("key"))
    probes = F.array(probe(1, "exact", "name", low), probe(2, "suffix-2", "name", F.concat(base, F.lit("-2."), ext)), probe(3, "prefix", "stem", bare), probe(4, "prefix", "stem", F.concat(head, bare)))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    side = disk.select("path", "disk_order", F.explode(F.array(F.struct(F.lit("name").alias("by"), name.alias("key")), F.struct(F.lit("stem").alias("by"), stem(name).alias("key")))).alias("x")).select("x.by", "x.key", "path", "disk_order")
    first = side.groupBy("by", "key").agg(F.min_by("path", "disk_order").alias("path"))
    asked = refs.select("catalog", "ord", F.explode(probes).alias("p")).select("catalog", "ord", "p.*")
    best = asked.join(first, ["by", "key"]).groupBy("catalog", "ord").agg(F.min_by(F.struct("path", "kind"), "prio").alias("hit"))
    return refs.join(best, ["catalog", "ord"], "left").select(*refs.columns, F.col("hit.path").alias("resolved"), F.col("hit.kind").alias("match_kind"))


def first_reference(resolved: DataFrame) -> DataFrame:
    """One reference for each resolved path: the first by catalog and place."""
    w = Window.partitionBy("resolved").orderBy("catalog", "ord")
    return resolved.where("resolved is not null").withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def catalog_stats(resolved: DataFrame) -> DataFrame:
    """For each catalog with references: how many there are and how they were met. Failed downloads are no references."""
    kind = lambda k: F.count_if(F.col("ok") & (F.col("match_kind") == k))
    out = resolved.groupBy("catalog").agg(F.count_if("ok").alias("refs"), kind("exact").alias("exact"), kind("suffix-2").alias("suffix2"), kind("prefix").alias("prefix"), F.count_if(F.col("ok") & F.col("resolved").isNull()).alias("unresolved"), F.count_if(~F.col("ok")).alias("failed_download"))
    return out.where("refs > 0")


def folder_code(path: Column, folders: dict[str, str]) -> Column:
    """The code of the first folder name, in the order given, that stands in a path."""
    out = F.lit(None).cast("string")
    for code, folder in reversed(folders.items()):
        out = F.when(F.array_contains(F.split(path, "/"), folder), code).otherwise(out)
    return out


def with_provenance(documents: DataFrame, index: DataFrame, references: DataFrame) -> DataFrame:
    """documents(path, ...) with their index record and catalog reference, where there is one."""
    return documents.join(index, "path", "left").join(references.withColumnRenamed("resolved", "path"), "path", "left")


def match_gold(gold: DataFrame, documents: DataFrame, codes: list[str]) -> DataFrame:
    """gold(question, name) to documents(path): by the exact lower-case file name, else by the standard name under each code, the first code winning; path is null if nothing fits."""
    known = documents.select("path", F.lower(F.element_at(F.split("path", "/"), -1)).alias("key")).groupBy("key").agg(F.min("path").alias("path"))
    probes = F.array(F.struct(F.lit(0).alias("prio"), F.lower("name").alias("key")), *(F.struct(F.lit(i).alias("prio"), F.lower(standard_name("name", F.lit(c))).alias("key")) for i, c in enumerate(codes, 1)))
    asked = gold.select("question", "name", F.explode(probes).alias("p")).select("question", "name", "p.*")
    best = asked.join(known, "key").groupBy("question", "name").agg(F.min_by("path", "prio").alias("path"))
    return gold.join(best, ["question", "name"], "left")




def expectations(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, check, expected, actual, ok): numbers of two tables side by side, in long form."""
    values = [c for c in expected.columns if c not in keys]
    long = lambda df, v: df.unpivot(keys, values, "check", v)
    both = long(expected, "expected").join(long(actual, "actual"), [*keys, "check"], "full")
    return both.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
