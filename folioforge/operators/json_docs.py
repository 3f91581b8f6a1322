"""JSON documents of several shapes to metadata and blocks, over VARIANT values; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metadata import clean_authors, normalize_date
from ..functions.text import clean_text, normalize_value, strip

# Keys that carry text, in documents of known and of unknown shapes.
TEXT_LISTS = ("body_paragraphs", "paragraphs", "content")
TEXT_KEYS = ("text", "content", "body", "descripcion", "description", "abstract", "paragraphs", "sections", "valor", "value")
SHORT_WORDS, PLACEHOLDER_CHARS, HARVEST_CHARS, HARVEST_DEPTH = 50, 120, 40, 6


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _kind(v: Column, path: str) -> Column:
    """array, object, scalar or null, of the value at a path."""
    raw = F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant"))
    return F.when(F.startswith(raw, F.lit("ARRAY")), "array").when(F.startswith(raw, F.lit("OBJECT")), "object").when(raw == "VOID", "null").otherwise(F.when(raw.isNotNull(), "scalar"))


def shape(v: Column) -> Column:
    """alert, journal, institutional, article, list, empty_list or unrecognized; the most special first."""
    root = F.schema_of_variant(v)
    has = lambda k: _kind(v, k).isNotNull()
    lists = F.lit(False)
    for k in TEXT_LISTS:
        lists = lists | F.coalesce(_kind(v, k) == "array", F.lit(False))
    return (
        F.when(F.startswith(root, F.lit("ARRAY")), F.when(F.to_json(v) == "[]", "empty_list").otherwise("article_list"))
        .when(~F.startswith(root, F.lit("OBJECT")), "unexpected_root")
        .when(_kind(v, "alerta_meta") == "object", "alert")
        .when(has("abstract") & (has("doi") | has("issue")), "journal")
        .when((_kind(v, "sections") == "array") | has("contenido_limitado"), "institutional")
        .when(lists & (has("title") | has("url")), "article")
        .otherwise("unrecognized")
    )


def read_json(files: DataFrame) -> DataFrame:
    """files(doc_id, raw) with v, the parsed value, null where raw is no JSON, and its shape."""
    return files.withColumn("v", F.try_parse_json("raw")).withColumn("shape", shape(F.col("v")))


def _strings(v: Column, path: str) -> Column:
    """The texts of a list; other members are left out."""
    items = F.coalesce(F.try_variant_get(v, f"$.{path}", "array<variant>"), F.array().cast("array<variant>"))
    return F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))


def _blocks(kind: str, texts: Column) -> Column:
    cleaned = F.filter(F.transform(texts, lambda t: clean_text(t, True)), lambda t: t.isNotNull() & (t != ""))
    return F.transform(cleaned, lambda t: F.struct(F.lit(kind).alias("type"), t.alias("text")))


def _one(kind: str, text: Column) -> Column:
    return _blocks(kind, F.array(text))


NO_BLOCKS = "array<struct<type:string,text:string>>"


def municipalities(raw: Column) -> Column:
    """array<struct<municipality, department>> of `Name (Department); ...`, each pair once; names split at ; and , where nothing has that form."""
    form = r"\s*([^(;,]+?)\s*\(([^)]+)\)\s*"
    names, places = F.regexp_extract_all(raw, F.lit(form), F.lit(1)), F.regexp_extract_all(raw, F.lit(form), F.lit(2))
    pair = lambda m, d: F.struct(m.alias("municipality"), d.alias("department"))
    pairs = F.filter(F.zip_with(names, places, lambda m, d: pair(normalize_value(m), normalize_value(d))), lambda p: p["municipality"] != "")
    same = lambda a, b: (F.lower(a["municipality"]) == F.lower(b["municipality"])) & (F.lower(a["department"]) == F.lower(b["department"]))
    once = F.aggregate(pairs, F.expr("cast(array() as array<struct<municipality:string,department:string>>)"), lambda a, p: F.when(F.exists(a, lambda x: same(x, p)), a).otherwise(F.concat(a, F.array(p))))
    loose = F.transform(F.filter(F.transform(F.split(raw, "[;,]"), normalize_value), lambda x: x != ""), lambda m: pair(m, F.lit("")))
    return F.when(raw.isNull(), None).when(F.size(pairs) > 0, once).otherwise(loose)


def departments(places: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(places, lambda p: p["department"]), lambda d: d != "")))


def parse_alerts(docs: DataFrame) -> DataFrame:
    """docs(doc_id, v) of shape alert: blocks, code, type, date, topic, municipalities, departments, warnings."""
    v = F.col("v")
    topic = normalize_value(F.coalesce(_get(v, "alerta_meta.tema_clave"), F.lit("")))
    body = F.filter(_strings(v, "body_paragraphs"), lambda p: clean_text(p, True) != topic)
    docs = docs.select("doc_id", F.concat(_one("heading", _get(v, "title")), F.filter(F.array(F.struct(F.lit("paragraph").alias("type"), topic.alias("text"))), lambda b: b["text"] != ""), _blocks("paragraph", body)).alias("blocks"), F.nullif(normalize_value(_get(v, "alerta_meta.codigo")), F.lit("")).alias("code"), F.nullif(normalize_value(_get(v, "alerta_meta.tipo")), F.lit("")).alias("type"), normalize_date(_get(v, "alerta_meta.fecha_emision")).alias("date"), F.nullif(topic, F.lit("")).alias("topic"), municipalities(_get(v, "alerta_meta.municipios")).alias("municipalities"))
    words = F.aggregate("blocks", F.lit(0), lambda a, b: a + F.size(F.filter(F.split(b["text"], r"\s+"), lambda w: w != "")))
    return docs.withColumns({"departments": departments(F.col("municipalities")), "warnings": F.array_compact(F.array(F.when(words < SHORT_WORDS, "short_document__summary_not_full_report"), F.when(F.col("code").isNull(), "missing_alert_code")))})


def parse_articles(docs: DataFrame) -> DataFrame:
    """docs(doc_id, v) of shape article: blocks of the title, the first list that isn't empty, and an excerpt that doesn't repeat them."""
    v = F.col("v")
    lists = [_strings(v, k) for k in TEXT_LISTS]
    chosen = lists[-1]
    for own in reversed(lists[:-1]):
        chosen = F.when(F.size(own) > 0, own).otherwise(chosen)
    docs = docs.select("doc_id", "v", F.concat(_one("heading", _get(v, "title")), _blocks("paragraph", chosen)).alias("b"))
    excerpt = strip(F.coalesce(_get(v, "excerpt"), F.lit("")))
    new = (excerpt != "") & ~F.exists("b", lambda x: F.contains(x["text"], F.substring(excerpt, 1, 60)))
    blocks = F.concat("b", F.when(new, _one("caption", excerpt)).otherwise(F.array().cast(NO_BLOCKS)))
    authors = clean_authors(_strings(v, "authors"))
    docs = docs.select("doc_id", blocks.alias("blocks"), F.nullif(strip(_get(v, "title")), F.lit("")).alias("title"), _get(v, "url").alias("url"), authors["authors"].alias("authors"), authors["dropped"].alias("dropped_authors"), normalize_date(_get(v, "date")).alias("date"))
    chars = F.aggregate("blocks", F.lit(0), lambda a, b: a + F.length(b["text"]))
    return docs.withColumn("warnings", F.array_compact(F.array(F.when((chars > 0) & (chars < PLACEHOLDER_CHARS), "possible_placeholder__body_too_short"))))


def parse_institutional(docs: DataFrame) -> DataFrame:
    """docs(doc_id, v) of shape institutional: title, sections with their paragraphs, list items of one level."""
    v = F.col("v")
    sections = F.coalesce(F.try_variant_get(v, "$.sections", "array<variant>"), F.array().cast("array<variant>"))
    of_section = F.flatten(F.transform(sections, lambda s: F.concat(_one("heading", _get(s, "heading")), _blocks("paragraph", _strings(s, "paragraphs")))))
    lists = F.coalesce(F.try_variant_get(v, "$.lists", "array<variant>"), F.array().cast("array<variant>"))
    items = F.flatten(F.transform(lists, lambda x: F.when(F.startswith(F.schema_of_variant(x), F.lit("ARRAY")), F.try_variant_get(x, "$", "array<string>")).otherwise(F.array(F.try_variant_get(x, "$", "string")))))
    out = docs.select("doc_id", F.concat(_one("heading", _get(v, "title")), of_section, _blocks("list_item", items)).alias("blocks"), _get(v, "url").alias("url"), _get(v, "contenido_limitado", "boolean").alias("limited"))
    return out.withColumn("warnings", F.array_compact(F.array(F.when(F.col("limited"), "source_declares_limited_content"), F.when(F.size("blocks") == 0, "no_extractable_text"))))


def parse_journal(docs: DataFrame) -> DataFrame:
    """docs(doc_id, v) of shape journal: title and abstract, keywords split at commas."""
    v = F.col("v")
    words = F.filter(F.transform(F.split(_get(v, "keywords"), ","), normalize_value), lambda k: k != "")
    authors = clean_authors(_strings(v, "authors"))
    return docs.select("doc_id", F.concat(_one("heading", _get(v, "title")), _one("paragraph", _get(v, "abstract"))).alias("blocks"), authors["authors"].alias("authors"), words.alias("keywords"), _get(v, "doi").alias("doi"), _get(v, "issue").alias("issue"), normalize_date(_get(v, "date")).alias("date"), F.array(F.lit("abstract_only__full_text_not_in_corpus")).alias("warnings"))


def list_items(docs: DataFrame) -> DataFrame:
    """The objects of docs(doc_id, v) of shape article_list as rows (doc_id, item, v)."""
    items = docs.select("doc_id", F.posexplode(F.try_variant_get("v", "$", "array<variant>")).alias("item", "v"))
    return items.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))


def harvest(docs: DataFrame) -> DataFrame:
    """(doc_id, path, text): texts of 40 characters and more of docs(doc_id, v), below known keys or inside containers, six levels deep.

    One explode for each level, as wide as the documents are.
    """
    level = docs.select("doc_id", F.lit("").alias("path"), "v", F.lit(False).alias("named"))
    out = None
    for _ in range(HARVEST_DEPTH + 1):
        kind = F.schema_of_variant("v")
        text = strip(F.try_variant_get("v", "$", "string"))
        texts = level.where(kind == "STRING").select("doc_id", "path", text.alias("text")).where(F.length("text") >= HARVEST_CHARS)
        out = texts if out is None else out.unionByName(texts)
        deeper = level.where(F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))).lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("v").outer())).select("doc_id", F.concat("path", F.lit("/"), F.coalesce("key", F.lpad(F.col("pos").cast("string"), 6, "0"))).alias("path"), F.col("value").alias("v"), F.lower("key").alias("key"))
        inner = F.schema_of_variant("v")
        level = deeper.where(F.col("key").isNull() | F.col("key").isin(*TEXT_KEYS) | F.startswith(inner, F.lit("OBJECT")) | F.startswith(inner, F.lit("ARRAY"))).select("doc_id", "path", "v", F.lit(True).alias("named"))
    return out


def catalog_records(files: DataFrame) -> DataFrame:
    """Records (catalog, ord, v) of catalog files(catalog, raw): the objects of a list, or of the first list in an object."""
    v = F.try_parse_json("raw")
    as_map = F.try_variant_get(v, "$", "map<string,variant>")
    first = F.try_element_at(F.filter(F.map_values(as_map), lambda x: F.startswith(F.schema_of_variant(x), F.lit("ARRAY<OBJECT"))), F.lit(1))
    items = F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.try_variant_get(first, "$", "array<variant>"))
    return files.select("catalog", F.posexplode(items).alias("ord", "v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))


# What announces an alert's code, how far before it, what may stand before one that nothing announces, and the dashes of a code.
ANNOUNCED, WITHIN, NUMBERED, DASHES = r"(?:alerta[s]?\s+temprana[s]?|\bA\.?\s?T\.?\b)", 60, r"N[o°ºr.]{0,3}\s?", "-–—"


def alert_codes(head: Column) -> Column:
    """The codes nnn-yy that a text names, in order, numbers padded to three digits. Those announced as early alerts, dashes in blanks allowed; if there are
    none, those after a number sign, the dash being tight. No digit or dash may touch a code, else parts of addresses and ranges would count."""
    free = r"(?<![\d-])(\d{1,3})"
    announced = rf"(?iu){ANNOUNCED}[^\n]{{0,{WITHIN}}}?{free}\s?[{DASHES}]\s?(\d{{2}})(?![\d-])"
    numbered = rf"(?iu){NUMBERED}{free}[{DASHES}](\d{{2}})(?![\d-])"
    both = lambda p: F.zip_with(F.regexp_extract_all(head, F.lit(p), F.lit(1)), F.regexp_extract_all(head, F.lit(p), F.lit(2)), lambda n, y: F.concat(F.lpad(n, 3, "0"), F.lit("-"), y))
    return F.when(head.rlike(announced), both(announced)).otherwise(both(numbered))


def match_alerts(pdfs: DataFrame, alerts: DataFrame, limit: int = 20_000) -> DataFrame:
    """pdfs(doc_id, text) to alerts(code, municipalities array<string>) by the codes in the first characters; see alert_codes.

    The first whose alert has a place that the text names wins, else the first known one. An equi-join on the code; texts are normalised once.
    """
    from ..functions.metadata import pad_code
    from ..functions.text import comparison_form

    head = F.substring("text", 1, limit)
    asked = pdfs.select("doc_id", comparison_form(head).alias("norm"), F.posexplode(F.array_distinct(alert_codes(head))).alias("n", "code"))
    met = asked.join(alerts.select(pad_code(F.col("code")).alias("code"), "municipalities"), "code")
    named = F.exists("municipalities", lambda m: F.contains(F.col("norm"), comparison_form(m)))
    return met.groupBy("doc_id").agg(F.min_by(F.struct("code", named.alias("confirmed")), F.struct((~named).alias("unnamed"), F.col("n"))).alias("m")).select("doc_id", "m.code", "m.confirmed")


def latest_alert(alerts: DataFrame) -> DataFrame:
    """One alert for each code: the last by ord."""
    rest = [c for c in alerts.columns if c not in ("code", "ord")]
    return alerts.groupBy("code").agg(F.max_by(F.struct(*rest), "ord").alias("a")).select("code", "a.*")
