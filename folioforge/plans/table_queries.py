"""Queries of JSON shapes, table rows, merges and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..operators import json_docs as J
from ..operators import reports, tabular
from ..sources import files
from .registry import query, read


def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON of six shapes, by their number."""
    i = F.col("doc_id")
    line = F.split("text", "\n")
    title = F.concat(F.lit("Title "), i.cast("string"))
    alert = F.to_json(F.struct(title.alias("title"), F.struct(F.concat((i % 400).cast("string"), F.lit("-21")).alias("codigo"), F.lit(" Key topic ").alias("tema_clave"), F.lit("2021-05-06").alias("fecha_emision"), F.concat(F.lit("Aldea (Norte); Villa (Sur); aldea (norte); M"), i.cast("string"), F.lit(" (Este)")).alias("municipios")).alias("alerta_meta"), line.alias("body_paragraphs")))
    journal = F.to_json(F.struct(title.alias("title"), F.lit("The abstract.").alias("abstract"), F.lit("10.1/x").alias("doi"), F.lit("one, two,, three ").alias("keywords"), F.array(F.lit("Ann Lee Smith")).alias("authors")))
    inst = F.to_json(F.struct(title.alias("title"), F.array(F.struct(F.lit("Part").alias("heading"), line.alias("paragraphs"))).alias("sections"), F.array(F.lit("item a"), F.lit("item b")).alias("lists"), F.lit(True).alias("contenido_limitado")))
    article = F.to_json(F.struct(title.alias("title"), F.array().cast("array<string>").alias("body_paragraphs"), line.alias("content"), F.lit("An excerpt of its own").alias("excerpt")))
    odd = F.to_json(F.struct(F.struct(F.concat(F.lit("A description of more than forty characters, number "), i.cast("string")).alias("description"), F.lit("x").alias("id")).alias("inner"), F.concat(F.lit("a long text under a key that isn't known at all, "), i.cast("string")).alias("note")))
    raw = F.when(i % 7 == 0, alert).when(i % 7 == 1, journal).when(i % 7 == 2, inst).when(i % 7 == 3, article).when(i % 7 == 4, odd).when(i % 7 == 5, "[]").otherwise("{broken")
    return J.read_json(read(spark, sf_dir, "documents").select("doc_id", raw.alias("raw")))


@query("select doc_id, case doc_id % 7 when 0 then 'alert' when 1 then 'journal' when 2 then 'institutional' when 3 then 'article' when 4 then 'unrecognized' when 5 then 'empty_list' end as shape from documents")
def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(spark, sf_dir).select("doc_id", F.when(F.col("v").isNotNull(), F.col("shape")).alias("shape"))


@query("""select doc_id, (doc_id % 400) || '-21' as code, '2021-05-06' as "date", 3 as n_places, 'Este,Norte,Sur' as departments from documents where doc_id % 7 = 0""")
def json_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = J.parse_alerts(_json(spark, sf_dir).where("shape = 'alert'"))
    return a.select("doc_id", "code", "date.date", F.size("municipalities").alias("n_places"), F.array_join("departments", ",").alias("departments"))


@query("""with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(substring(x, 1, 200), '[ \t]{2,}', ' ', 'g'))), lambda x: x <> '') as ls from documents where doc_id % 7 = 3) select doc_id, len(ls) + 2 as n_blocks, 'Title ' || doc_id as title from l""")
def json_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.parse_articles(_json(spark, sf_dir).where("shape = 'article'")).select("doc_id", F.size("blocks").alias("n_blocks"), "title")


@query("""with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(substring(x, 1, 200), '[ \t]{2,}', ' ', 'g'))), lambda x: x <> '') as ls from documents where doc_id % 7 = 2) select doc_id, len(ls) + 4 as n_blocks, 1 as n_warnings from l""")
def json_institutional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.parse_institutional(_json(spark, sf_dir).where("shape = 'institutional'")).select("doc_id", F.size("blocks").alias("n_blocks"), F.size("warnings").alias("n_warnings"))


@query("select doc_id, 2 as n_blocks, 'one|two|three' as keywords, 1 as n_authors from documents where doc_id % 7 = 1")
def json_journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.parse_journal(_json(spark, sf_dir).where("shape = 'journal'")).select("doc_id", F.size("blocks").alias("n_blocks"), F.array_join("keywords", "|").alias("keywords"), F.size("authors").alias("n_authors"))


@query("select doc_id, 'A description of more than forty characters, number ' || doc_id as text from documents where doc_id % 7 = 4")
def json_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.harvest(_json(spark, sf_dir).where("shape = 'unrecognized'").select("doc_id", "v")).select("doc_id", "text")


# Lines that announce a code, and lines that hold none: an address, a dialling code, a number in a range.
_ALERT_LINES = ["Carrera 9 no. 16 - 21, centro", "call the canton 555-12 today", "Alerta Temprana N° {a} – {b} de riesgo", "Alertas Tempranas de 2019: {a}-{b}", "resolucion Nº {a}-{b}", "A.T. {a}-{b}", "see {a}-{b} there", "paginas N° 1{a}-{b}-7"]
_RE2_CODE = r"(?i)(?:alerta[s]?\s+temprana[s]?|\bA\.?\s?T\.?\b)(?:[^\n]{0,59}?[^\n\d-]|)(\d{1,3})\s?[-–—]\s?(\d{2})(?:[^\d-]|$)"
_RE2_TIGHT = r"(?i)N[o°ºr.]{0,3}\s?(\d{1,3})[-–—](\d{2})(?:[^\d-]|$)"
_LINE_SQL = "[" + ", ".join("'" + x.replace("{a}", "' || (doc_id % 90) || '").replace("{b}", "' || (17 + doc_id % 3) || '") + "'" for x in _ALERT_LINES) + "][1 + doc_id % 8]"


@query(rf"""with t as (select doc_id, regexp_replace(substring(text, 1, 400), '[0-9]', '', 'g') || chr(10) || {_LINE_SQL} || chr(10) || case when doc_id % 5 = 0 then 'en Puérto  RICO' else substring(text, 401, 3000) end as text from documents),
 h as (select doc_id, substring(text, 1, 20000) as head from t),
 c as (select doc_id, head, case when regexp_matches(head, '{_RE2_CODE}') then regexp_extract(head, '{_RE2_CODE}', 1) when regexp_matches(head, '{_RE2_TIGHT}') then regexp_extract(head, '{_RE2_TIGHT}', 1) end as n,
   case when regexp_matches(head, '{_RE2_CODE}') then regexp_extract(head, '{_RE2_CODE}', 2) when regexp_matches(head, '{_RE2_TIGHT}') then regexp_extract(head, '{_RE2_TIGHT}', 2) end as y from h)
 select doc_id, lpad(n, 3, '0') || '-' || y as code, contains(trim(regexp_replace(regexp_replace(strip_accents(lower(head)), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), 'puerto rico') as confirmed from c where n :: int < 90 and y in ('17', '18', '19')""")
def alert_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with a line that names a code in one of eight ways; two of them are no codes."""
    i = F.col("doc_id")
    lines = F.array(*(F.replace(F.replace(F.lit(x), F.lit("{a}"), (i % 90).cast("string")), F.lit("{b}"), (17 + i % 3).cast("string")) for x in _ALERT_LINES))
    text = F.concat(F.regexp_replace(F.substring("text", 1, 400), "[0-9]", ""), F.lit("\n"), F.element_at(lines, (1 + i % 8).cast("int")), F.lit("\n"), F.when(i % 5 == 0, "en Puérto  RICO").otherwise(F.substring("text", 401, 3000)))
    alerts = spark.range(90 * 3).select(F.concat((F.col("id") % 90).cast("string"), F.lit("-"), (17 + F.floor(F.col("id") / 90)).cast("string")).alias("code"), F.array(F.lit("Puerto Rico")).alias("municipalities"))
    return J.match_alerts(read(spark, sf_dir, "documents").select("doc_id", text.alias("text")), alerts)


@query("""select o_orderkey, 'o_orderstatus: ' || o_orderstatus || case when o_orderkey % 4 = 0 then '' else '; o_orderpriority: ' || o_orderpriority end || '; n: ' || (o_custkey % 100) as text, o_custkey % 100 as n from orders""")
def row_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row"), "o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"), (F.col("o_custkey") % 100).cast("string").alias("n"))
    out = tabular.parse_rows(o, ["o_orderstatus", "o_orderpriority", "n"])
    return out.select(F.col("row").alias("o_orderkey"), "text", F.variant_get("data", "$.n", "bigint").alias("n"))


@query("""select p_partkey, array_to_string(list_filter([case when p_size % 2 = 0 then 'two' end, case when p_size % 3 = 0 then 'three' end, case when p_size % 5 = 0 then 'five' end], lambda x: x is not null), '|') as groups from part""")
def flags_to_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    for name, n in (("two", 2), ("three", 3), ("five", 5)):
        p = p.withColumn(f"grupo_{name}", F.when(F.col("p_size") % n == 0, "SI").otherwise("NO"))
    return p.select("p_partkey", F.array_join(tabular.flags_to_array("grupo_", ["grupo_two", "grupo_three", "grupo_five"]), "|").alias("groups"))


@query("""with f as (select user_id, event_type, min(event_id) as seen from events group by 1, 2), g as (select user_id, string_agg(event_type, '|' order by seen) as members from f group by 1)
 select user_id, arg_min(event_type, event_id) as first_type, count(*) as n_rows, min(event_id) as first_row, any_value(members) as members from events join g using (user_id) group by 1""")
def merge_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("groups", F.array("event_type"))
    m = tabular.merge_groups(e, F.col("user_id"), ["event_type"], "groups", "event_id")
    return m.select(F.col("key").alias("user_id"), F.col("event_type").alias("first_type"), F.size("source_rows").cast("long").alias("n_rows"), F.element_at("source_rows", 1).alias("first_row"), F.array_join("members", "|").alias("members"))


@query("""select event_id, last_value(case when event_id % 5 = 0 then event_type end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as filled from events""")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("filled"))
    return tabular.forward_fill(e, "filled", ["user_id"], ["event_id"]).select("event_id", "filled")


@query("""select p_partkey, list_filter(list_transform(string_split(p_type || '| |' || p_name, '|'), lambda x: trim(x)), lambda x: x <> '') as vals, case when p_partkey % 2 = 0 then p_partkey end as n from part""")
def typed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    cell = M.typed_cell(F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).otherwise(F.concat(F.lit("--"), F.col("p_partkey").cast("string"))))
    return p.select("p_partkey", M.multi_values(F.concat("p_type", F.lit("| |"), "p_name")).alias("vals"), cell["i"].alias("n"))


@query("""select doc_id, case when doc_id % 2 = 0 then 1 else 2 end as n_fields, case when doc_id % 2 = 0 then 1 else 0 end as n_warnings from documents""")
def filter_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(F.lit("body_text"), F.lit('"x"'), F.lit("tags"), F.lit('["a"]'), F.lit("n"), F.lit("0"), F.lit("empty"), F.lit("[]"))
    code = F.when(F.col("doc_id") % 2 == 0, "ONE").otherwise("TWO")
    return read(spark, sf_dir, "documents").select("doc_id", M.filter_fields(fields, code, {"ONE": ("tags", "absent")}, {"TRI": ("n",)}).alias("x")).select("doc_id", F.size("x.fields").alias("n_fields"), F.size("x.warnings").alias("n_warnings"))


@query("""select event_id, case when event_id % 6 = 0 then ',' when event_id % 6 = 1 then chr(9) else ',' end as delimiter, case event_id % 6 when 1 then 3 when 2 then 11 when 3 then 12 end as columns from events""")
def csv_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 6
    name = F.when(m == 1, "x_LIT-covid.csv").when(m == 2, "pubmed-nlp-2.csv").when(m == 3, "pubmed.csv").otherwise("other.csv")
    return read(spark, sf_dir, "events").select("event_id", files.csv_family(name).alias("x")).select("event_id", "x.delimiter", "x.columns")


@query("select event_type as head, count(*) as n from events group by 1 order by n desc, head limit 25")
def warning_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.warning_heads(read(spark, sf_dir, "events").select(F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")).alias("warning")))


@query("select 'title_match' as type, count_if(doc_id % 4 = 0) as n from documents where doc_id % 3 <> 0 having count_if(doc_id % 4 = 0) > 0")
def failure_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    check = F.struct(F.lit("title_match").alias("type"), (i % 4 != 0).alias("passed"))
    m = read(spark, sf_dir, "documents").select("doc_id", F.when(i % 3 == 0, "skipped").otherwise("success").alias("status"), F.array(check).alias("checks"), F.when(i % 5 == 0, "unverified").otherwise("title_match").alias("basis"))
    return reports.diagnose(reports.failed(m))


@query("select source, doc_id from documents where contains(lower(source), 'rc1') order by source, doc_id limit 1000000")
def find_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.find(read(spark, sf_dir, "documents").select("source", "doc_id"), "RC1", ["source"], k=1_000_000)


@query("select sum(length(trim(text))) :: bigint as extracted, sum(n_chars) :: bigint as reference, round(sum(length(trim(text))) / sum(n_chars), 4) as ratio from documents")
def extraction_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").withColumn("path", F.col("doc_id"))
    pairs = reports.fidelity(d.select("path", F.length(F.trim("text")).cast("long").alias("extracted")), d.select("path", F.col("n_chars").alias("reference")))
    return reports.global_fidelity(pairs)


@query("select count_if(doc_id % 4 > 0) as documents, sum(doc_id % 4) :: bigint as pages_total, sum(doc_id % 4) :: bigint as pages_native, 0 :: bigint as pages_ocr, count_if(doc_id % 4 > 0) as pages_quarantined from documents")
def pdf_page_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id") % 4
    return reports.pdf_pages(read(spark, sf_dir, "documents").select(n.alias("pages_total"), n.alias("pages_native"), F.lit(0).cast("long").alias("pages_ocr"), F.lit(1).cast("long").alias("pages_quarantined")))


@query("select r_regionkey, to_json({'r_regionkey': r_regionkey, 'r_name': r_name}) as value from region")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "region")
    lines = files.to_json_lines(r.select("r_regionkey", "r_name"))
    return lines.select(F.get_json_object("value", "$.r_regionkey").cast("int").alias("r_regionkey"), "value")


@query("select 'r' || (event_id % 12) as reason, count(*) as n from events where event_id % 3 = 0 group by 1 order by n desc, reason limit 10")
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.ingest import quarantine

    e = read(spark, sf_dir, "events").where("event_id % 3 = 0")
    return quarantine(e.select(F.lit("review").alias("action"), F.array(F.concat(F.lit("r"), F.col("event_id") % 12)).alias("reasons")))[1]


@query("""with p as (select doc_id as path, cast(floor(n_chars * (doc_id % 10) / 10.0) as bigint) as extracted, n_chars as reference from documents)
 select path, extracted, reference, round(extracted / reference, 6) as ratio from p where reference > 2000 and extracted / reference < 0.95 order by extracted / reference, path limit 25""")
def low_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").withColumn("path", F.col("doc_id"))
    pairs = reports.fidelity(d.select("path", F.floor(F.col("n_chars") * (F.col("doc_id") % 10) / 10.0).cast("long").alias("extracted")), d.select("path", F.col("n_chars").alias("reference")))
    return reports.low_fidelity(pairs).withColumn("ratio", F.round("ratio", 6))


@query("select p_partkey, p_size * 10 > 50 and p_size * 10 > 5 * (p_partkey % 60) as abandoned from part")
def abandoned_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", tabular.abandoned_sheet(F.col("p_size") * 10, F.col("p_partkey") % 60).alias("abandoned"))
