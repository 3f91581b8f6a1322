"""Scores of extracted text: percentiles within groups, page gate, cross-checks, confidence, usability, invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.metadata import bare_title, extension, title_of
from ..functions.text import SIGNALS, comparison_form, token_overlap
from ..sources.shared import kept

# Fixed values.
BASIS_ORDER = ["entity_crosscheck", "gold_fragment", "ocr_agreement", "mirror_match", "title_match"]
WEIGHTS = {"entity_crosscheck": 0.55, "gold_fragment": 0.55, "ocr_agreement": 0.45, "mirror_match": 0.50, "title_match": 0.30}
OUTLIERS = ("known_word_ratio", "char_distribution", "printable_ratio")
LEAST_GROUP, OUTLIER_SHARE, USABLE = 8, 0.05, 0.35
DENSE_SCRIPTS = ("han", "kana", "hangul", "arabic", "hebrew")
GRAM_SIZES = (12, 8, 5)


def signals_long(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., name, value): the signal columns as rows."""
    return df.unpivot(keys, SIGNALS, "name", "value")


def calibrate(signals: DataFrame, group: list[str]) -> DataFrame:
    """signals(group..., name, value) with pctile, the share of smaller values of the group (null in groups under eight), and flag.

    A group value that is null counts as `unknown`. Values are rounded, so a group has few different ones whatever its size: these are counted, the
    counts added up in order, and the shares joined back. No group of documents is sorted.
    """
    parts = {f"__{g}": F.coalesce(F.col(g).cast("string"), F.lit("unknown")) for g in group}
    keys = [*parts, "name"]
    marked = kept(signals.withColumns(parts))  # signals are dear, and used twice
    counts = marked.groupBy(*keys, "value").agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys)
    less = F.coalesce(F.sum("c").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = F.sum("c").over(w)
    shares = counts.select(*(F.col(k).alias(f"{k}_") for k in keys), F.col("value").alias("value_"), F.when(n >= LEAST_GROUP, F.round(less / n, 4)).alias("pctile"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}_"))
    out = marked.join(shares, same & F.col("value").eqNullSafe(F.col("value_"))).drop(*parts, *(f"{k}_" for k in keys), "value_")
    return out.withColumn("flag", F.when((F.col("pctile") <= OUTLIER_SHARE) & F.col("name").isin(*OUTLIERS), "outlier_low_in_source"))


def group_sizes(documents: DataFrame, group: list[str]) -> DataFrame:
    return documents.groupBy(*(F.coalesce(F.col(g).cast("string"), F.lit("unknown")).alias(g) for g in group)).agg(F.count("*").alias("n"))


def intrinsic_score(script: Column) -> Column:
    """0 to 1 from the signal columns."""
    least = lambda x: F.least(x, F.lit(1.0))
    known = F.when(script.isin(*DENSE_SCRIPTS), least(F.col("known_word_ratio") / 0.85)).otherwise(least(F.col("known_word_ratio") / 0.28))
    score = 0.40 * known + 0.20 * least(F.col("printable_ratio") / 0.99) + 0.20 * F.col("char_distribution")
    score = score + 0.10 * (1 - least(F.col("single_char_token_ratio") / 0.5)) + 0.10 * (1 - least(F.col("repetition_ratio")))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def confidence(df: DataFrame) -> DataFrame:
    """df(signals..., script, checks array<struct<type, passed, score>>, flags array<string>) with score, basis and all_flags.

    Checks draw the intrinsic score to their weighted mean, by at most 0.7; the strongest kind of check names the basis.
    """
    weight = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))
    of = lambda c: F.coalesce(F.try_element_at(weight, c["type"]), F.lit(0.3))
    checks = F.coalesce("checks", F.array().cast("array<struct<type:string,passed:boolean,score:double>>"))
    total = F.aggregate(checks, F.lit(0.0), lambda a, c: a + of(c))
    drawn = F.aggregate(checks, F.lit(0.0), lambda a, c: a + of(c) * F.coalesce(c["score"], F.lit(0.0))) / total
    alpha = F.least(F.lit(0.7), total)
    base = intrinsic_score(F.col("script"))
    score = F.when(F.size(checks) == 0, base).otherwise((1 - alpha) * base + alpha * drawn)
    basis = F.lit("intrinsic_only")
    kinds = F.transform(checks, lambda c: c["type"])
    for kind in reversed(BASIS_ORDER):
        basis = F.when(F.array_contains(kinds, kind), kind).otherwise(basis)
    silent = F.coalesce(F.col("characters") == 0, F.lit(True))
    failed = F.transform(F.filter(checks, lambda c: ~c["passed"]), lambda c: F.concat(F.lit("crosscheck_failed:"), c["type"]))
    flags = F.concat(F.coalesce("flags", F.array().cast("array<string>")), failed, F.when(silent, F.array(F.lit("no_text_extracted"))).otherwise(F.array().cast("array<string>")))
    return df.withColumns({"score": F.when(silent, F.lit(0.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4)), "basis": F.when(silent, "unverified").otherwise(basis), "all_flags": F.array_sort(F.array_distinct(flags))})


def is_usable(score: Column, basis: Column, characters: Column, warnings: Column) -> Column:
    excused = F.exists(warnings, lambda w: w.rlike("^(?:empty_list|pbf_disabled|information_graphic)"))
    return F.when(characters == 0, excused).when(basis == "unverified", False).otherwise(score >= USABLE)


def recommended_action(pages_quarantined: Column) -> Column:
    return F.when(pages_quarantined > 0, "ocr").otherwise("review")


def flags_of_warnings(warnings: Column, known: list[str]) -> Column:
    """Heads, before a colon, of warnings that are flags too."""
    return F.filter(F.transform(warnings, lambda w: F.element_at(F.split(w, ":"), 1)), lambda h: h.isin(*known))


def page_gate(pages: DataFrame) -> DataFrame:
    """pages(text, image_coverage, language, script, signals...) with characters trimmed, reasons and verdict (accept or ocr)."""
    chars = F.length(F.trim(F.regexp_replace("text", r"^\s+|\s+$", "")))
    cover = F.col("image_coverage")
    said = lambda head, x: F.concat(F.lit(head), x.cast("string"))
    latin = (F.col("script") == "latin") & (chars > 500)
    corrupt = F.array_compact(
        F.array(
            F.when(F.col("printable_ratio") < 0.95, said("low_printable_ratio_", F.col("printable_ratio"))),
            F.when(F.col("char_distribution") < 0.35, said("anomalous_char_distribution_", F.col("char_distribution"))),
            F.when(latin & F.col("language").isNull(), "latin_script_but_no_language_detected").when(latin & (F.col("known_word_ratio") < 0.25), said("low_known_word_ratio_", F.col("known_word_ratio"))),
            F.when((F.col("single_char_token_ratio") > 0.45) & (chars > 300), said("broken_spacing_", F.col("single_char_token_ratio"))),
        )
    )
    decisive = latin & (F.col("language").isNull() | ((F.col("known_word_ratio") < 0.10) & (chars > 800)))
    broken = (F.size(corrupt) >= 2) | F.coalesce(decisive, F.lit(False))
    low = (chars < 200) & (cover > 0.4)
    out = lambda reasons, verdict: F.struct(reasons.alias("reasons"), verdict.alias("verdict"))
    one = lambda x: F.array(x)
    none = F.array().cast("array<string>")
    noted = F.when(F.size(corrupt) > 0, F.concat(corrupt, one(F.lit("single_signal_only__accepted_with_flag")))).otherwise(none)
    judged = (
        F.when((chars < 50) & (cover >= 0.55), out(one(F.concat(F.lit("image_page__coverage_"), F.format_string("%.2f", cover))), F.lit("ocr")))
        .when(chars == 0, out(one(F.lit("empty_page__no_text_no_image")), F.lit("accept")))
        .when(chars < 50, out(one(F.concat(F.lit("very_low_text__"), chars.cast("string"), F.lit("_chars"))), F.when(cover > 0.2, "ocr").otherwise("accept")))
        .when(broken, out(F.concat(one(F.lit("corrupt_text")), corrupt), F.lit("ocr")))
        .otherwise(out(F.concat(noted, F.when(low, one(F.concat(F.lit("low_text_with_images__"), chars.cast("string"), F.lit("_chars")))).otherwise(none)), F.when(low, "ocr").otherwise("accept")))
    )
    return pages.withColumn("trimmed_characters", chars).withColumn("g", judged).select("*", "g.reasons", "g.verdict").drop("g")


def selective_ocr(native: Column, recognised: Column) -> Column:
    """struct<text, method, verdict>: recognised text takes a page's place only if it is longer than the native text and than 50 characters."""
    better = F.coalesce(F.length(recognised) > F.greatest(F.length(native), F.lit(50)), F.lit(False))
    return F.struct(F.when(better, recognised).otherwise(native).alias("text"), F.when(better, "ocr").otherwise("native").alias("method"), F.when(better, "accept").otherwise("review").alias("verdict"))


def _check(kind: str, score: Column, passed: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.coalesce(passed, F.lit(False)).alias("passed"), F.round(score, 4).alias("score"))


def title_match(title: Column, text: Column, head: int = 6000) -> Column:
    """Check that half of the title's words stand in the first characters; null for titles under 8 characters and texts without any."""
    part = F.substring(text, 1, head)
    overlap = token_overlap(comparison_form(title), comparison_form(part))
    return F.when((F.length(F.trim(title)) >= 8) & (F.trim(part) != ""), _check("title_match", overlap, overlap >= 0.5))


def generic_titles(names: DataFrame, name: str = "name", least: int = 3) -> DataFrame:
    """(title, n): titles that so many files share, but for a number at the end: they name none of them."""
    return names.select(bare_title(title_of(name)).alias("title")).where("title is not null").groupBy("title").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def expected_titles(documents: DataFrame, least: int = 3) -> DataFrame:
    """documents(name, reference_title, ...) with `expected`: the title that its text should hold. A catalog's title goes before the name's; tables have none,
    since a dataset doesn't name itself, and a generic title is none."""
    generic = generic_titles(documents, least=least).select(F.col("title").alias("__title"), F.lit(True).alias("__generic"))
    wanted = F.coalesce("reference_title", title_of("name"))
    marked = documents.withColumn("__wanted", wanted).join(generic, bare_title(F.col("__wanted")) == F.col("__title"), "left")
    none = extension("name").isin(".csv", ".tsv", ".xlsx") | F.coalesce("__generic", F.lit(False))
    return marked.withColumn("expected", F.when(~none, F.col("__wanted"))).drop("__wanted", "__title", "__generic")


def entity_check(code: Column, municipalities: Column, date: Column, text: Column) -> Column:
    """Check that a code, the places and the year of an alert stand in a text: the mean of those that are asked for."""
    norm = comparison_form(text)
    has = lambda x: F.contains(norm, comparison_form(x))
    places = F.filter(municipalities, lambda m: F.trim(m) != "")
    share = F.size(F.filter(places, has)) / F.size(municipalities)
    year = F.substring(date, 1, 4)
    parts = F.array_compact(F.array(F.when(F.trim(code) != "", has(code).cast("double")), F.when(F.size(municipalities) > 0, share), F.when(year != "", F.contains(text, year).cast("double"))))
    score = F.when(F.size(parts) == 0, F.lit(0.0)).otherwise(F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / F.size(parts))
    return _check("entity_crosscheck", score, score >= 0.5)


def gold_fragment(fragment: Column, text: Column) -> Column:
    """Check that a fragment stands in a text. Both in comparison form: whole, else the best share of its word n-grams, sizes 12, 8 and 5, stopping at a size above 0.8."""
    words = F.split(fragment, " ")

    def share(k: int) -> Column:
        n = F.size(words) - k + 1
        hits = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.contains(text, F.array_join(F.slice(words, i, F.lit(k)), " "))))
        return F.when(n > 0, hits / n).otherwise(F.lit(0.0))

    best = share(GRAM_SIZES[-1])
    for k in reversed(GRAM_SIZES[:-1]):
        own = share(k)
        best = F.when(own > 0.8, own).otherwise(F.greatest(own, best))
    score = F.when((fragment == "") | (text == ""), F.lit(0.0)).when(F.contains(text, fragment), F.lit(1.0)).otherwise(best)
    return _check("gold_fragment", score, score >= 0.5)


def gold_verdict(score: Column) -> Column:
    return F.when(score.isNull(), "missing").when(score >= 0.95, "exact").when(score >= 0.5, "partial").otherwise("fail")


def mirror_check(a: DataFrame, b: DataFrame, value_columns: list[str], sample: int = 200) -> DataFrame:
    """One row: how well two tables, each with `row`, agree in length and in the values of their first rows, side by side."""
    values = lambda t: t.select("row", F.array_distinct(F.filter(F.transform(F.array(*(F.col(c).cast("string") for c in value_columns)), lambda v: comparison_form(v)), lambda v: v.isNotNull())).alias("v"))
    sizes = a.agg(F.count("*").alias("rows_a")).crossJoin(b.agg(F.count("*").alias("rows_b")))  # two rows of totals
    first = lambda t: values(t.where(F.col("row") <= sample))
    both = first(a).withColumnRenamed("v", "va").join(first(b).withColumnRenamed("v", "vb"), "row")
    alike = (F.size("va") > 0) & (F.size("vb") > 0) & (F.size(F.array_intersect("va", "vb")) / F.size(F.array_union("va", "vb")) >= 0.6)
    met = both.agg(F.count_if(alike).alias("alike"), F.count("*").alias("compared"))
    ratio = F.coalesce(F.try_divide(F.least("rows_a", "rows_b"), F.greatest("rows_a", "rows_b")), F.lit(0.0))
    agree = F.coalesce(F.try_divide("alike", "compared"), F.lit(0.0))
    return sizes.crossJoin(met).select("rows_a", "rows_b", F.round(ratio, 4).alias("row_ratio"), F.round(agree, 4).alias("value_agreement"), F.round(0.4 * ratio + 0.6 * agree, 4).alias("score"), (0.4 * ratio + 0.6 * agree >= 0.8).alias("passed"))


def ocr_agreement(native: Column, recognised: Column) -> Column:
    """Check by Jaccard of the words; null unless both comparison forms have 100 characters."""
    from ..functions.text import jaccard

    a, b = comparison_form(native), comparison_form(recognised)
    score = jaccard(a, b)
    return F.when((F.length(a) >= 100) & (F.length(b) >= 100), _check("ocr_agreement", score, score >= 0.45))


def document_problems(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, problems): invariants of blocks(doc_id, block_id, ord, type, text, structured, page) and documents(doc_id, format, basis, pages_total)."""
    w = Window.partitionBy("doc_id").orderBy("place")
    seen = blocks.withColumn("down", F.col("ord") < F.lag("ord").over(w))
    blank = (F.trim("text") == "") & ~((F.col("type") == "table_row") & F.col("structured").isNotNull())
    per = seen.groupBy("doc_id").agg((F.count("*") != F.count_distinct("block_id")).alias("twice"), F.bool_or("down").alias("down"), F.bool_or(F.contains("text", F.lit("\x00"))).alias("nul"), F.bool_or(blank).alias("blank"), F.max("page").alias("last_page"))
    pdf = F.col("format") == "pdf"
    said = F.array_compact(
        F.array(
            F.when(F.col("twice"), "I8: duplicate block_id"),
            F.when(F.col("down"), "I8: block order"),
            F.when(F.col("nul"), "I4: NUL in text"),
            F.when(F.col("blank"), "empty block without structured data"),
            F.when(F.col("basis").isNull(), "I6: confidence without basis"),
            F.when(pdf & (F.coalesce("pages_total", F.lit(0)) < 1), "I5: no page count"),
            F.when(pdf & (F.col("last_page") > F.col("pages_total")), "I5: block beyond the last page"),
        )
    )
    return documents.join(per, "doc_id", "left").select("doc_id", said.alias("problems"))


def corpus_problems(registry: DataFrame, written: int, expected: int) -> DataFrame:
    """One row of invariants over registry(doc_id, role, status, reason): true where it holds."""
    indexed = F.col("doc_id").isNotNull()
    dropped = F.col("status").isin("intentional_skip", "invalid_source", "failure") & (F.coalesce("reason", F.lit("")) == "")
    return registry.agg(
        (F.count("*") == expected).alias("i1_every_file"),
        (F.count_if(indexed & (F.col("status") == "pending")) == 0).alias("i3_terminal_status"),
        (F.count_if(dropped) == 0).alias("i7_reasons"),
        (F.count_if((F.col("role") == "evaluation") & (F.col("status") == "success")) == 0).alias("i10_no_leakage"),
        (F.count_if(indexed & F.col("status").isNotNull()) == F.count_if(indexed)).alias("status_sum"),
        (F.count_if(indexed & (F.col("status") == "success")) == written).alias("written"),
    )


def id_stability(before: DataFrame, now: DataFrame) -> DataFrame:
    """Blocks (doc_id, block_id, hash) that came, went or changed between two runs."""
    both = before.withColumnRenamed("hash", "h1").join(now.withColumnRenamed("hash", "h2"), ["doc_id", "block_id"], "full")
    return both.where(~F.col("h1").eqNullSafe(F.col("h2")))
