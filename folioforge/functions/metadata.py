"""Metadata functions as column expressions: file names, titles, dates, authors, fields and cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ACCENTED, PLAIN, let, normalize_value, strip

# Month names in three languages, and what marks an entry that isn't a person.
MONTHS = [
    ("january", "jan", "enero", "ene", "janeiro"),
    ("february", "feb", "febrero", "fevereiro", "fev"),
    ("march", "mar", "marzo", "março"),
    ("april", "apr", "abril", "abr"),
    ("may", "mayo", "maio"),
    ("june", "jun", "junio", "junho"),
    ("july", "jul", "julio", "julho"),
    ("august", "aug", "agosto", "ago"),
    ("september", "sep", "sept", "septiembre", "setembro", "set"),
    ("october", "oct", "octubre", "outubro", "out"),
    ("november", "nov", "noviembre", "novembro"),
    ("december", "dec", "diciembre", "dic", "dezembro", "dez"),
]
ROLES = [
    "fellow", "director", "researcher", "professor", "analyst", "associate", "senior", "junior", "chair", "president", "advisor", "adviser",
    "officer", "intern", "scholar", "lecturer", "head of", "member of", "expert", "investigador", "profesor", "analista", "miembro",
]
SENTENCE_MARKS = [" is ", " was ", " es ", " era ", " at ", " en el ", " de la "]
ALWAYS_REDUNDANT = ("body_text",)


def file_name_of(url: Column | str) -> Column:
    """The last part of a URL's path, decoded; a plus stays a plus."""
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    return F.try_url_decode(F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B")))


def standard_name(url: Column | str, code: Column) -> Column:
    """CODE_slug.ext from a URL: accents off, lower case, runs of other characters to hyphens, a leading code- dropped, .pdf where there is no extension."""
    name = strip(file_name_of(url))
    dot = F.regexp_extract(name, r"^(.*[^.].*?)(\.[^.]*)?$", 0)
    has = name.rlike(r"^.*[^.].*\.[^.]*$")
    ext = F.when(has & dot.isNotNull(), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))).otherwise(F.lit(".pdf"))
    stem = F.when(has, F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    slug = F.lower(F.regexp_replace(F.translate(stem, ACCENTED, PLAIN), r"\p{Mn}", ""))
    slug = F.regexp_replace(F.regexp_replace(F.translate(slug, "_ ", "--"), "[^a-z0-9.-]", "-"), "-{2,}", "-")
    slug = F.regexp_replace(slug, "^-+|-+$", "")
    head = F.concat(F.lower(code), F.lit("-"))
    slug = F.when(F.startswith(slug, head), F.substring(slug, F.length(head) + 1, F.length(slug))).otherwise(slug)
    return F.concat(code, F.lit("_"), slug, F.when(ext == ".", ".pdf").otherwise(ext))


def extension(path: Column | str) -> Column:
    """The lower-case extension with its dot, or an empty text."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))).otherwise(F.lit(""))


def stem(name: Column | str) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


# Words of file names that no title has.
NAME_NOISE = (
    "final", "compressed", "web", "web1", "web2", "web3", "web4", "layout", "draft", "copy", "rev", "rev1", "rev2", "rev3", "v1", "v2", "v3",
    "update", "updated", "print", "digital", "hr", "lr", "full", "report1",
)
#: Letters in a row beyond which a word is several that were run together; letters of a real word, and real words of a title, at least.
RUN_TOGETHER, REAL_LETTERS, REAL_WORDS = 16, 4, 3


def title_of(name: Column | str) -> Column:
    """A readable title from a file's name without its source prefix (3 to 12 capitals or digits). Null where the name begins with a compact date of 5
    to 8 digits, holds a word of NAME_NOISE or words run together, or has fewer than three real words."""
    bare = F.regexp_replace(stem(name), r"^[A-Z0-9]{3,12}[-_]", "")
    words = F.filter(F.split(bare, r"[-_\s]+"), lambda w: w != "")

    def of(ws: Column) -> Column:
        real = F.filter(ws, lambda w: (F.length(w) >= REAL_LETTERS) & w.rlike(r"\p{L}"))
        odd = F.exists(ws, lambda w: F.lower(w).isin(*NAME_NOISE) | w.rlike(rf"^\p{{L}}{{{RUN_TOGETHER},}}$"))
        return F.when((F.size(real) >= REAL_WORDS) & ~odd & ~F.element_at(ws, 1).rlike(r"^\d{5,8}$"), F.array_join(ws, " "))

    return let(words, of)


def bare_title(title: Column | str) -> Column:
    """A title without the number that tells files of one title apart."""
    return F.regexp_replace(title, r"\s+\d+$", "")


def pad_code(code: Column | str) -> Column:
    """A code n-yy with its number padded to three digits."""
    return F.concat(F.lpad(F.regexp_extract(code, r"^0*(\d+)-", 1), 3, "0"), F.lit("-"), F.regexp_extract(code, r"-(\d+)$", 1))


def normalize_date(raw: Column | str) -> Column:
    """struct<date string, confidence string, warning string>. Day and month are never guessed: both up to 12 is `ambiguous`; a year alone is `inferred`."""
    text = normalize_value(raw)
    pairs = [F.lit(x) for i, names in enumerate(MONTHS, 1) for name in names for x in (name, i)]
    month = F.create_map(*pairs)
    made = lambda y, m, d: F.date_format(F.try_to_date(F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.format_string("%04d-%02d-%02d", y, m, d)), "yyyy-MM-dd"), "yyyy-MM-dd")
    part = lambda p, i: F.try_to_number(F.regexp_extract(text, p, i), F.lit("9999")).cast("int")
    iso, slash, named, worded, year = r"^(\d{4})-(\d{2})-(\d{2})", r"^(\d{1,2})/(\d{1,2})/(\d{4})$", r"^([A-Za-zÀ-ÿ]+)\.?\s+(\d{1,2}),?\s+(\d{4})$", r"(?i)^(\d{1,2})\s+de\s+([A-Za-zÀ-ÿ]+)\s+de\s+(\d{4})$", r"^(\d{4})$"
    out = lambda d, c, w: F.struct(d.cast("string").alias("date"), c.alias("confidence"), w.cast("string").alias("warning"))
    none, exact, absent = F.lit(None), F.lit("exact"), F.lit("absent")
    said = lambda w: F.concat(F.lit(w), text)
    of_iso = made(part(iso, 1), part(iso, 2), part(iso, 3))
    of_named = made(part(named, 3), F.try_element_at(month, F.lower(F.regexp_extract(text, named, 1))), part(named, 2))
    of_worded = made(part(worded, 3), F.try_element_at(month, F.lower(F.regexp_extract(text, worded, 2))), part(worded, 1))
    a, b = part(slash, 1), part(slash, 2)
    joined = lambda m, d: F.concat(F.regexp_extract(text, slash, 3), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"), F.lpad(d.cast("string"), 2, "0"))
    return (
        F.when(text.isNull() | (text == ""), out(none, absent, none))
        .when(text.rlike(iso), F.when(of_iso.isNotNull(), out(of_iso, exact, none)).otherwise(out(none, absent, said("invalid_iso_date:"))))
        .when(text.rlike(named) & of_named.isNotNull(), out(of_named, exact, none))
        .when(text.rlike(worded) & of_worded.isNotNull(), out(of_worded, exact, none))
        .when(text.rlike(slash) & (a > 12) & (b <= 12), out(joined(b, a), exact, none))
        .when(text.rlike(slash) & (b > 12) & (a <= 12), out(joined(a, b), exact, none))
        .when(text.rlike(slash), out(none, F.lit("ambiguous"), said("ambiguous_day_month:")))
        .when(text.rlike(year), out(F.concat(text, F.lit("-01-01")), F.lit("inferred"), said("year_only:")))
        .otherwise(out(none, absent, said("unparsed_date:")))
    )


def promote_date(own: Column, own_confidence: Column, catalog: Column) -> Column:
    """The document's own date over the catalog's, if that is missing or its own is exact."""
    return F.when(own.isNotNull() & (catalog.isNull() | (own_confidence == "exact")), own).otherwise(F.coalesce(catalog, own))


def clean_authors(raw: Column | str) -> Column:
    """struct<authors array, dropped array>: biographies, roles, user names and over-long entries are set apart with the reason, never lost."""
    values = F.filter(F.transform(raw, normalize_value), lambda v: v.isNotNull() & (v != ""))

    def judged(v: Column) -> Column:
        low = F.lower(v)
        sentence = F.lit(False)
        for m in SENTENCE_MARKS:
            sentence = sentence | F.contains(low, F.lit(m))
        long = F.size(F.filter(F.split(v, r"\s+"), lambda w: w != "")) > 5
        reason = (
            F.when(sentence & long, F.concat(F.lit("biography:"), v))
            .when(low.rlike("^(?:" + "|".join(ROLES) + ")"), F.concat(F.lit("role:"), v))
            .when(v.rlike(r"^[a-z]{2,}\d*$"), F.concat(F.lit("cms_username:"), v))
            .when(F.length(v) > 90, F.concat(F.lit("too_long:"), F.substring(v, 1, 60), F.lit("…")))
        )
        return F.struct(v.alias("v"), reason.alias("r"))

    seen = F.transform(values, judged)
    return F.struct(F.transform(F.filter(seen, lambda s: s["r"].isNull()), lambda s: s["v"]).alias("authors"), F.transform(F.filter(seen, lambda s: s["r"].isNotNull()), lambda s: s["r"]).alias("dropped"))


def filter_fields(fields: Column, code: Column, always_empty: dict[str, tuple[str, ...]], unreliable: dict[str, tuple[str, ...]]) -> Column:
    """struct<fields map, warnings array> of a map<string,string> of JSON values: redundant, always-empty, unreliable and empty fields go. 0 and false stay."""
    named = lambda by: F.coalesce(F.try_element_at(F.create_map(*(x for k, v in by.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), code), F.array().cast("array<string>")) if by else F.array().cast("array<string>")
    empty, unsure = named(always_empty), named(unreliable)
    said = lambda names, why: F.transform(F.filter(names, lambda n: F.map_contains_key(fields, n)), lambda n: F.concat(F.lit(why), n))
    kept = F.map_filter(fields, lambda k, v: ~k.isin(*ALWAYS_REDUNDANT) & ~F.array_contains(empty, k) & ~F.array_contains(unsure, k) & v.isNotNull() & ~v.isin("", '""', "[]", "{}", "null"))
    return F.struct(kept.alias("fields"), F.concat(said(empty, "dropped_always_empty:"), said(unsure, "dropped_unreliable:")).alias("warnings"))


def first_present(*columns: Column) -> Column:
    """The first that isn't null or blank."""
    return F.coalesce(*(F.when(strip(c) != "", c) for c in columns))


def is_success(status: Column | str) -> Column:
    """A status that says the download worked; no status means it did."""
    return F.coalesce(F.lower(strip(status)).isin("ok", "200", "true", "success", "downloaded"), F.lit(True))


def typed_cell(v: Column | str) -> Column:
    """struct<i long, s string>: digits as a number, all else as text. A second minus sign makes it text."""
    number = F.when(v.rlike(r"^-?\d{1,18}$"), v.cast("long"))
    return F.struct(number.alias("i"), F.when(number.isNull(), v).alias("s"))


def multi_values(v: Column | str, separator: str = r"\|") -> Column:
    return F.filter(F.transform(F.split(v, separator), strip), lambda x: x != "")


def row_text(names: list[str]) -> Column:
    """`name: value; ...` of the columns that aren't blank."""
    parts = F.array(*(F.when(strip(F.col(n)) != "", F.concat(F.lit(f"{n}: "), strip(F.col(n)))) for n in names))
    return F.array_join(F.array_compact(parts), "; ")


def cache_key(*parts: Column) -> Column:
    """32 hex digits of the SHA-256 of the parts joined by a bar."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)
