"""Queries of the registry: formats, reconciliation, references, names, dates, authors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..operators import quality as Q
from ..operators import registry as R
from ..operators import reports
from .registry import query, read

EXTS = [".pdf", ".json", ".csv", ".xlsx", ".txt", ".pbf", ".avif", ".jpg", ".doc"]
MAGICS = ["255044462D312E37", "3C21444F43545950", "504B0304140006", "1A0B0C0D", "0000001C6674797061766966", "7B2261223A317D", "FFD8FFE000104A46"]
FILES = f"""files as (select *, 'F1/' || source || '/' || case when doc_id % 17 = 0 then 'AB_catalog-2' when doc_id % 19 = 0 then 'pubmed-' || doc_id else 'AB_file-' || doc_id end || {EXTS}[doc_id % {len(EXTS)} + 1] as path, {MAGICS}[doc_id % {len(MAGICS)} + 1] as magic, {EXTS}[doc_id % {len(EXTS)} + 1] as ext from documents)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values) + 1).cast("int"))
    name = F.when(F.col("doc_id") % 17 == 0, "AB_catalog-2").when(F.col("doc_id") % 19 == 0, F.concat(F.lit("pubmed-"), "doc_id")).otherwise(F.concat(F.lit("AB_file-"), "doc_id"))
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("F1/"), "source", F.lit("/"), name, pick(EXTS)).alias("path"), F.unhex(pick(MAGICS)).alias("magic"))


CLASSIFIED = FILES + """, det as (select *, case when starts_with(magic, '25504446') then 'pdf' when starts_with(magic, '504B0304') and ext = '.xlsx' then 'xlsx' when starts_with(magic, '504B0304') then 'zip' when starts_with(magic, 'FFD8FF') then 'jpeg'
   when starts_with(magic, '3C21444F4354595045') or magic = '3C21444F43545950' and false then 'html' when substr(magic, 9, 8) = '66747970' then 'avif' when ext = '.pbf' and starts_with(magic, '1A') then 'pbf' when ext = '.json' then 'json' when ext = '.csv' then 'csv' when ext = '.txt' then 'text' else 'unknown' end as detected from files),
 cls as (select *, case when ext in ('.json', '.csv') and regexp_matches(path, '_catalog[-_.]') then 'metadata' else 'retrievable' end as role,
   case when ext in ('.json', '.csv') and regexp_matches(path, '_catalog[-_.]') then 'intentional_skip' when ext = '.pdf' and detected <> 'pdf' then 'invalid_source' when ext in ('.pbf', '.avif') then 'intentional_skip' else 'pending' end as status,
   case when detected = 'unknown' or ext = '.doc' then false when ext = '.xlsx' then detected not in ('xlsx', 'zip') else detected <> map {'.pdf': 'pdf', '.json': 'json', '.csv': 'csv', '.txt': 'text', '.pbf': 'pbf', '.avif': 'avif', '.jpg': 'jpeg'}[ext] end as mismatch from det)"""


@query(f"with {CLASSIFIED} select doc_id, detected, mismatch, role, status, case when role = 'retrievable' and status = 'pending' and contains(path, 'pubmed-') then 'structured_only' else 'full' end as hint from cls")
def registry_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.classify(_files(spark, sf_dir)).select("doc_id", "detected", "mismatch", "role", "status", "hint")


@query(f"with {CLASSIFIED}, long as (select unnest([['detected', detected], ['role', role], ['status', status]]) as x from cls) select x[1] as \"column\", x[2] as \"value\", count(*) as n from long group by 1, 2")
def registry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.summary(R.classify(_files(spark, sf_dir)), ["detected", "role", "status"])


@query(f"with {CLASSIFIED} select doc_id, path from cls where role = 'retrievable' and status = 'pending' and doc_id % 2 = 0 order by path limit 50")
def registry_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = R.classify(_files(spark, sf_dir))
    return R.select_work(docs, docs.where("doc_id % 2 = 0").select("doc_id"), 50).select("doc_id", "path")


SIDES = """sides as (select coalesce(d.p, i.p) as path, case when d.p is null then 'missing' when i.p is null then 'extra' else 'both' end as side from (select source || '/' || doc_id as p from documents where doc_id % 7 <> 0) d full join (select source || '/' || doc_id as p from documents where doc_id % 5 <> 0) i on d.p = i.p)"""


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "doc_id").alias("path"), "doc_id")
    return R.reconcile(d.where("doc_id % 7 <> 0").select("path"), d.where("doc_id % 5 <> 0").select("path", "doc_id"))


@query(f"with {SIDES} select path, side from sides")
def reconcile_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir).select("path", "side")


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of _sides' disk, and junk files as noise."""
    d = read(spark, sf_dir, "documents")
    disk = d.where("doc_id % 7 <> 0").select(F.lit("retrievable").alias("role"))
    return disk.unionByName(d.where("source = 'web' and length(text) < 40").select(F.lit("noise").alias("role")))


@query(f"""with {SIDES}, n as (select count_if(source = 'web' and length(text) < 40) as noise, count_if(doc_id % 7 <> 0) as files from documents)
 select count_if(side = 'both') as indexed, count_if(side = 'extra') as extras, count_if(side = 'missing') as missing, any_value(files + noise) as scanned, any_value(noise) as noise, count_if(side <> 'missing') + any_value(noise) = any_value(files + noise) as identity from sides, n""")
def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reconciliation_totals(_sides(spark, sf_dir), _scanned(spark, sf_dir))


@query(f"""with {SIDES}, n as (select count_if(source = 'web' and length(text) < 40) as noise, count_if(doc_id % 7 <> 0) as files from documents), l as (select * from sides where path not like '%9')
 select count_if(side = 'both') as indexed, count_if(side = 'extra') as extras, count_if(side = 'missing') as missing, any_value(files + noise) as scanned, any_value(noise) as noise, count_if(side <> 'missing') + any_value(noise) = any_value(files + noise) as identity from l, n""")
def reconcile_totals_of_lost_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that never reached reconciliation: the identity has to fail."""
    return R.reconciliation_totals(_sides(spark, sf_dir).where("path not like '%9'"), _scanned(spark, sf_dir))


@query("""with a as (select distinct source || '-' || (n_chars % 50) as v from documents where doc_id % 3 <> 0), b as (select distinct source || '-' || (n_chars % 50) as v from documents where doc_id % 4 <> 0)
 select v as value, 'unexpected' as side from a anti join b using (v) union all select v, 'missing' from b anti join a using (v)""")
def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("-"), F.col("n_chars") % 50).alias("value"))
    return R.unequal_sets(d.where("doc_id % 3 <> 0"), d.where("doc_id % 4 <> 0"), "value")


@query(f"with {SIDES} select path from sides where side = 'extra' and path not in (select source || '/' || doc_id from documents where doc_id % 3 = 0)")
def reconcile_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = read(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.concat_ws("/", "source", "doc_id").alias("path"))
    return R.unexpected(_sides(spark, sf_dir), expected)


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    records = d.select(F.concat(F.lit("catalog-"), F.col("doc_id") % 3).alias("catalog"), F.col("doc_id").alias("ord"), F.lit("AB").alias("code"), F.concat(F.lit("https://files.example.org/a%20b/Ré_sumé%20"), F.col("doc_id") - F.col("doc_id") % 2, F.lit(".pdf?x=1")).alias("url"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("date"), F.when(F.col("doc_id") % 23 == 0, "404").alias("status"))
    name = F.concat(F.when(F.col("doc_id") % 8 == 6, "").otherwise("AB_"), F.lit("re-sume-"), "doc_id", F.when(F.col("doc_id") % 8 == 2, "-2.pdf").when(F.col("doc_id") % 8 == 4, ".PDF").when(F.col("doc_id") % 8 == 6, ".docx").otherwise(".pdf"))
    disk = d.where("doc_id % 10 <> 0").select(F.concat(F.lit("x/"), name).alias("path"), F.col("doc_id").alias("disk_order"))
    return R.resolve_references(R.catalog_references(records), disk)


REFS = """refs as (select 'catalog-' || doc_id % 3 as catalog, doc_id as ord, doc_id - doc_id % 2 as k, coalesce(case when doc_id % 23 = 0 then false end, true) as ok from documents),
 res as (select catalog, ord, k, ok, case when k % 10 = 0 then null when k % 8 = 2 then 'x/AB_re-sume-' || k || '-2.pdf' when k % 8 = 4 then 'x/AB_re-sume-' || k || '.PDF' when k % 8 = 6 then 'x/re-sume-' || k || '.docx' else 'x/AB_re-sume-' || k || '.pdf' end as resolved, case when k % 10 = 0 then null when k % 8 = 2 then 'suffix-2' when k % 8 = 6 then 'prefix' else 'exact' end as match_kind from refs)"""


@query(f"with {REFS} select catalog, ord, ok, 'AB_re-sume-' || k || '.pdf' as candidate, resolved, match_kind from res")
def catalog_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark, sf_dir).select("catalog", "ord", "ok", "candidate", "resolved", "match_kind")


@query(f"with {REFS} select catalog, count_if(ok) as refs, count_if(ok and match_kind = 'exact') as exact, count_if(ok and match_kind = 'suffix-2') as suffix2, count_if(ok and match_kind = 'prefix') as prefix, count_if(ok and resolved is null) as unresolved, count_if(not ok) as failed_download from res group by 1")
def catalog_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.catalog_stats(_references(spark, sf_dir))


@query(f"with {REFS} select resolved, arg_min(ord, catalog || lpad(cast(ord as varchar), 12, '0')) as ord from res where resolved is not null group by 1")
def catalog_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.first_reference(_references(spark, sf_dir)).select("resolved", "ord")


@query("""with r as (select o_orderkey, o_orderdate::date as d, o_orderkey % 7 as m from orders),
 t as (select o_orderkey, d, m, year(d) as y, month(d) as mo, day(d) as da, ['january','february','march','april','may','june','july','august','september','october','november','december'][month(d)] as en, ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'][month(d)] as es from r)
 select o_orderkey, case when m in (0, 1, 2) then strftime(d, '%Y-%m-%d') when m = 3 and da > 12 then strftime(d, '%Y-%m-%d') when m = 5 then y || '-01-01' end as "date", case when m in (0, 1, 2) then 'exact' when m = 3 then case when da > 12 then 'exact' else 'ambiguous' end when m = 5 then 'inferred' else 'absent' end as confidence from t""")
def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, m = F.col("o_orderdate"), F.col("o_orderkey") % 7
    months = lambda i: F.element_at(F.array(*(F.lit(x[i]) for x in M.MONTHS)), F.month(d))
    es = F.element_at(F.array(*(F.lit(next(n for n in x if n in "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split())) for x in M.MONTHS)), F.month(d))
    raw = (
        F.when(m == 0, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00")))
        .when(m == 1, F.concat(F.initcap(months(0)), F.lit(" "), F.dayofmonth(d), F.lit(", "), F.year(d)))
        .when(m == 2, F.concat(F.dayofmonth(d), F.lit(" de "), es, F.lit(" de "), F.year(d)))
        .when(m == 3, F.date_format(d, "dd/MM/yyyy"))
        .when(m == 4, F.lit("someday"))
        .when(m == 5, F.year(d).cast("string"))
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", M.normalize_date(raw).alias("x")).select("o_orderkey", "x.date", "x.confidence")


@query("""select c_custkey, list_filter([c_name, 'Ana Maria ' || c_custkey], lambda x: true) as authors, ['role:Director of Studies', 'biography:Dr ' || c_name || ' is a fellow of the house', 'cms_username:sscott', 'too_long:' || repeat('Ab', 30) || '…'] as dropped from customer""")
def clean_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array(F.col("c_name"), F.lit("Director of Studies"), F.concat(F.lit("Dr "), "c_name", F.lit(" is a fellow of the house")), F.lit(" sscott"), F.concat(F.lit("Ana Maria "), F.col("c_custkey").cast("string")), F.lit(""), F.lit("Ab" * 50))
    return read(spark, sf_dir, "customer").select("c_custkey", M.clean_authors(raw).alias("x")).select("c_custkey", "x.authors", "x.dropped")


_NAMED = r"""names as (select doc_id, source, lang, ['ABC_', 'X1_', 'ABCDEFGHIJKLM-', 'F07-', '', 'AB_190626-'][1 + doc_id % 6] || replace(array_to_string(regexp_extract_all(text, '[\p{L}]+')[1:5], chr(1)), chr(1), ['-', '_', ' ', '--'][1 + doc_id % 4]) || ['', '-12', '_final', ' V2', '-harrisonjohnsonyoung'][1 + doc_id % 5] || ['.pdf', '.csv', '.json'][1 + doc_id % 3] as name from documents),
 w as (select *, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(name, '\.[^.]*$', ''), '^[A-Z0-9]{3,12}[-_]', ''), '[-_\s]+'), lambda x: x <> '') as ws from names),
 t as (select *, case when len(list_filter(ws, lambda x: length(x) >= 4 and regexp_matches(x, '\p{L}'))) >= 3 and not regexp_full_match(ws[1], '\d{5,8}') and len(list_filter(ws, lambda x: list_contains(NOISE, lower(x)) or regexp_full_match(x, '\p{L}{16,}'))) = 0 then array_to_string(ws, ' ') end as title from w)"""
NAMED = _NAMED.replace("NOISE", str(list(M.NAME_NOISE)))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names made of a document's first words, with prefixes, separators, endings and formats of several kinds."""
    one = lambda of, n: F.element_at(F.array(*map(F.lit, of)), (F.col("doc_id") % n + 1).cast("int"))
    words = F.slice(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)), 1, 5)
    joined = F.array_join(words, "\x01")
    name = F.concat(one(["ABC_", "X1_", "ABCDEFGHIJKLM-", "F07-", "", "AB_190626-"], 6), F.replace(joined, F.lit("\x01"), one(["-", "_", " ", "--"], 4)), one(["", "-12", "_final", " V2", "-harrisonjohnsonyoung"], 5), one([".pdf", ".csv", ".json"], 3))
    return read(spark, sf_dir, "documents").select("doc_id", "source", "lang", name.alias("name"))


@query(f"with {NAMED} select doc_id, title from t")
def file_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("doc_id", M.title_of("name").alias("title"))


@query(rf"""with f as (select doc_id, case when doc_id % 5 = 0 then 'Center for ' || source || ' studies' when doc_id % 5 = 1 then 'ABC_annual-report-about-' || lang || '-' || doc_id else 'ABC_' || array_to_string(regexp_extract_all(text, '\p{{L}}{{4,9}}')[1:4], '-') end || case when doc_id % 7 = 0 then '.csv' else '.pdf' end as name, case when doc_id % 11 = 0 then 'A title of catalog ' || doc_id end as reference_title from documents),
 w as (select *, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(name, '\.[^.]*$', ''), '^[A-Z0-9]{{3,12}}[-_]', ''), '[-_\s]+'), lambda x: x <> '') as ws from f),
 t as (select *, case when len(list_filter(ws, lambda x: length(x) >= 4 and regexp_matches(x, '\p{{L}}'))) >= 3 and len(list_filter(ws, lambda x: list_contains({list(M.NAME_NOISE)}, lower(x)))) = 0 then array_to_string(ws, ' ') end as title from w),
 g as (select regexp_replace(title, '\s+\d+$', '') as b from t where title is not null group by 1 having count(*) >= 3)
 select doc_id, case when name not like '%.csv' and regexp_replace(coalesce(reference_title, title), '\s+\d+$', '') not in (select b from g) then coalesce(reference_title, title) end as expected from t""")
def expected_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    words = F.slice(F.regexp_extract_all("text", F.lit(r"\p{L}{4,9}"), F.lit(0)), 1, 4)
    name = F.when(i % 5 == 0, F.concat(F.lit("Center for "), "source", F.lit(" studies"))).when(i % 5 == 1, F.concat(F.lit("ABC_annual-report-about-"), "lang", F.lit("-"), i)).otherwise(F.concat(F.lit("ABC_"), F.array_join(words, "-")))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.concat(name, F.when(i % 7 == 0, ".csv").otherwise(".pdf")).alias("name"), F.when(i % 11 == 0, F.concat(F.lit("A title of catalog "), i)).alias("reference_title"))
    return Q.expected_titles(docs).select("doc_id", "expected")


@query("""select doc_id, case when doc_id % 3 = 2 then null when doc_id % 3 = 1 then 'AB report on water quality ' || doc_id end as title, lpad(cast(doc_id % 1000 as varchar), cast(greatest(3, length(cast(doc_id % 1000 as varchar))) as integer), '0') || '-' || lpad(cast(doc_id % 100 as varchar), 2, '0') as code from documents""")
def names_and_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    name = F.when(i % 3 == 1, F.concat(F.lit("AB_report-on-water_quality-"), i, F.lit(".pdf"))).when(i % 3 == 0, F.concat(F.lit("AB_20230101-file-"), i, F.lit(".pdf"))).otherwise("AB_annualreportwithoutspaces.pdf")
    code = F.concat((i % 1000).cast("string"), F.lit("-"), F.lpad((i % 100).cast("string"), 2, "0"))
    return read(spark, sf_dir, "documents").select("doc_id", M.title_of(name).alias("title"), M.pad_code(code).alias("code"))


@query("select o_orderkey, substr(sha256(o_orderkey || '|' || o_orderstatus || '|v1'), 1, 32) as k from orders")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", M.cache_key(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.lit("v1")).alias("k"))


@query("""select doc_id, case when doc_id % 2 = 0 and (doc_id % 3 = 0 or doc_id % 5 = 0) then '2020-01-01' when doc_id % 3 = 0 then case when doc_id % 2 = 0 then '2020-01-01' end else '2021-02-02' end as chosen from documents""")
def date_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    own, sure, catalog = F.when(i % 2 == 0, "2020-01-01"), F.when(i % 5 == 0, "exact").otherwise("inferred"), F.when(i % 3 != 0, "2021-02-02")
    return read(spark, sf_dir, "documents").select("doc_id", M.promote_date(own, sure, catalog).alias("chosen"))


@query("select source, 'n' as \"check\", count(*) as expected, count_if(doc_id % 50 <> 0) as actual, count_if(doc_id % 50 = 0) = 0 as ok from documents group by 1")
def expectation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda d: d.groupBy("source").agg(F.count("*").alias("n"))
    d = read(spark, sf_dir, "documents")
    return R.expectations(n(d.where("doc_id % 50 <> 0")), n(d), ["source"])


@query("""select doc_id, case when doc_id % 4 = 3 then null when doc_id % 4 = 1 then 'x/CD_paper-' || doc_id || '.pdf' else 'x/AB_paper-' || doc_id || '.pdf' end as path from documents""")
def gold_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    d = read(spark, sf_dir, "documents")
    disk = d.select(F.concat(F.lit("x/"), F.when(i % 4 == 1, "CD_").otherwise("AB_"), F.lit("paper-"), i, F.lit(".pdf")).alias("path"))
    gold = d.select(i.alias("question"), F.when(i % 4 == 0, F.concat(F.lit("ab_PAPER-"), i, F.lit(".pdf"))).when(i % 4 == 3, "unknown.pdf").otherwise(F.concat(F.lit("Paper "), i, F.lit(".pdf"))).alias("name"))
    return R.match_gold(gold, disk, ["AB", "CD"]).select(F.col("question").alias("doc_id"), "path")


@query("select user_id as code, arg_max(event_type, event_id) as event_type from events group by 1")
def latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.json_docs import latest_alert

    return latest_alert(read(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.col("event_id").alias("ord"), "event_type")).select("code", "event_type")


@query("select o_orderkey as doc_id from orders where o_orderkey % 2 = 0 and o_orderkey not in (select l_orderkey from lineitem)")
def dangling_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.files import dangling_blocks as dangling

    docs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), (1 - F.col("o_orderkey") % 2).alias("block_count"))
    return dangling(docs, read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"))).select("doc_id")


@query(f"with {FILES} select doc_id, case when contains(path, 'pubmed') then 'biblio' when ext = '.pdf' then 'pdf' when ext = '.json' then 'json' when ext = '.csv' then 'table' when ext = '.xlsx' then 'workbook' when ext = '.txt' then 'text' when ext = '.pbf' then 'tile' when ext = '.jpg' then 'image' end as reader from files")
def file_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.ingest import route

    return route(_files(spark, sf_dir), {"pubmed": "biblio"}).select("doc_id", "reader")
