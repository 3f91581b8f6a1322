"""Queries that write a table to the shared folder and read it back with the sources, and joins of what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..operators import json_docs as J
from ..operators import quality as Q
from ..operators import registry as R
from ..operators import reports, tabular
from ..sources import binary, files
from .registry import query, read, scratch
from .text_queries import NORM


@query("select n_nationkey, n_name || chr(10) || '\"quoted\", ' || n_regionkey as note from nation")
def csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted line breaks, quotes and delimiters survive."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", F.concat("n_name", F.lit('\n"quoted", '), "n_regionkey").alias("note"))
    folder = scratch(spark, "csv")
    n.write.option("header", True).option("quote", '"').option("escape", '"').csv(folder)
    return files.read_csv(spark, folder, "n_nationkey int, note string")


@query("select c_custkey, case when c_custkey % 3 > 0 then c_name end as c_name, c_acctbal from customer")
def json_lines_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines, published whole and read with a declared schema."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("c_name"), "c_acctbal")
    folder = scratch(spark, "jsonl")
    files.publish(files.to_json_lines(c), folder, "text")
    return files.read_jsonl(spark, folder, "c_custkey long, c_name string, c_acctbal double")


@query("select doc_id, md5(text) as digest, length(text) as n from documents where text is not null")
def written_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their blocks written as two tables and put together again."""
    d = read(spark, sf_dir, "documents").where("text is not null")
    blocks = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    folder = scratch(spark, "documents")
    files.write_documents(blocks.groupBy("doc_id").agg(F.count("*").alias("block_count")), blocks, folder)
    docs, own = (spark.read.parquet(f"{folder}/{x}") for x in ("documents", "blocks"))
    whole = own.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return docs.join(whole, "doc_id").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").alias("n"))


@query("""select 'source=' || source || '/kind=t' as folder, strlen(text) + 1 as size, sha256(text || chr(10)) as sha256, lower(left(hex(text || chr(10)), 32)) as magic from documents where text is not null and text not like '%' || chr(10) || '%' and doc_id in (select min(doc_id) from documents where text is not null and text not like '%' || chr(10) || '%' group by source)""")
def scanned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file a source, found by a recursive scan with size, hash and first bytes."""
    d = read(spark, sf_dir, "documents").where("text is not null and not contains(text, '\n')")
    first = d.groupBy("source").agg(F.min_by("text", "doc_id").alias("text"))
    folder = scratch(spark, "scan")
    first.withColumn("kind", F.lit("t")).repartition("source").write.partitionBy("source", "kind").text(folder)
    found = files.scan(spark, folder).where("name like 'part-%'")
    return found.select(F.regexp_extract("path", r"(source=[^/]*/kind=t)/[^/]*$", 1).alias("folder"), "size", "sha256", F.lower(F.hex("magic")).alias("magic"))


@query("select p_partkey, p_name from part")
def whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files read whole; one row a file, its lines put apart again."""
    p = read(spark, sf_dir, "part").select(F.concat_ws("|", "p_partkey", "p_name").alias("line"))
    folder = scratch(spark, "texts")
    p.repartition(4).write.text(folder)
    lines = files.read_texts(spark, folder).where("path like '%part-%'").select(F.explode(F.split(F.trim("text"), "\n")).alias("line")).where("line <> ''")
    return lines.select(F.split("line", r"\|")[0].cast("long").alias("p_partkey"), F.split("line", r"\|")[1].alias("p_name"))


@query("""with d as (select doc_id, source || '/' || doc_id as path from documents), i as (select source || '/' || doc_id as path, lang from documents where doc_id % 5 <> 0), r as (select source || '/' || doc_id as path, 'u' || n_chars as url from documents where doc_id % 4 = 0)
 select doc_id, lang as index_lang, url from d left join i using (path) left join r using (path)""")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", "source", "doc_id"))
    index = d.where("doc_id % 5 <> 0").select("path", F.col("lang").alias("index_lang"))
    refs = d.where("doc_id % 4 = 0").select(F.col("path").alias("resolved"), F.concat(F.lit("u"), "n_chars").alias("url"))
    return R.with_provenance(d.select("doc_id", "path"), index, refs).select("doc_id", "index_lang", "url")


@query("""select page_id, case when list_contains(string_split(url, '/'), 'blog') then 'B' when list_contains(string_split(url, '/'), 'docs') then 'D' when list_contains(string_split(url, '/'), 'news') then 'N' end as code, coalesce(nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), ''), url) as title from pages""")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder codes of addresses, and the first title of a page that isn't blank."""
    found = lambda tag: F.regexp_extract("html", f"<{tag}>([^<]*)</{tag}>", 1)
    title = F.trim(M.first_present(found("title"), found("h1"), F.col("url")))
    return read(spark, sf_dir, "pages").select("page_id", R.folder_code(F.col("url"), {"B": "blog", "D": "docs", "N": "news"}).alias("code"), title.alias("title"))


@query("""select o_custkey, cast(row_number() over (partition by o_custkey order by o_orderkey) - 1 as integer) as ord, o_orderkey, o_orderpriority from orders""")
def catalog_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog files: a list of objects where the key is even, else the first list of objects in an object."""
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("items"))
    raw = F.when(F.col("o_custkey") % 2 == 0, F.to_json("items")).otherwise(F.to_json(F.struct(F.lit(1).alias("n"), F.array(F.lit(1)).alias("numbers"), "items")))
    found = J.catalog_records(o.select(F.col("o_custkey").alias("catalog"), raw.alias("raw")))
    return found.select(F.col("catalog").alias("o_custkey"), "ord", F.try_variant_get("v", "$.o_orderkey", "long").alias("o_orderkey"), F.try_variant_get("v", "$.o_orderpriority", "string").alias("o_orderpriority"))


@query("""with o as (select o_custkey, list(o_orderkey order by o_orderkey) as ks from orders group by 1) select o_custkey, cast(i - 1 as integer) as item, ks[i] as o_orderkey from (select o_custkey, ks, unnest(range(1, len(ks) + 1)) as i from o)""")
def json_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose root is a list: one row for each of its objects."""
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct("o_orderkey")))).alias("raw"))
    d = J.read_json(o.select(F.col("o_custkey").alias("doc_id"), "raw")).where("shape = 'article_list'")
    return J.list_items(d).select(F.col("doc_id").alias("o_custkey"), "item", F.try_variant_get("v", "$.o_orderkey", "long").alias("o_orderkey"))


@query("select doc_id, lang, case when doc_id % 3 = 0 then 'skipped' else 'success' end as status, case when doc_id % 3 > 0 then n_chars end as n_chars from documents")
def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed and skipped documents in one manifest; what a side lacks is null."""
    d = read(spark, sf_dir, "documents")
    parsed = d.where("doc_id % 3 <> 0").select("doc_id", "lang", F.lit("success").alias("status"), "n_chars")
    return reports.all_manifests(parsed, d.where("doc_id % 3 = 0").select("doc_id", "lang", F.lit("skipped").alias("status")))


@query("""with b as (select l_orderkey, l_linenumber, l_quantity * 2 as w, l_quantity as h from lineitem), o as (select l_orderkey, count(*) as n, sum(w * h) as covered, max(w * h) as largest from b group by 1)
 select l_orderkey, round(least(covered / 5000.0, 1.0), 6) as coverage, n :: int as images, case when largest >= 0.85 * 5000 and n <= 4 then 'embedded' else 'raster' end as source from o""")
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of 100 by 50 whose lines are images."""
    li = read(spark, sf_dir, "lineitem")
    boxes = li.groupBy("l_orderkey").agg(F.collect_list(F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity") * 2, F.col("l_quantity"))).alias("boxes"))
    w, h = F.lit(100.0), F.lit(50.0)
    x = binary.image_coverage(w, h, F.col("boxes"))
    return boxes.select("l_orderkey", F.round(x["coverage"], 6).alias("coverage"), x["images"].alias("images"), binary.image_source(w, h, F.col("boxes")).alias("source"))


@query("""select doc_id, len(p) as n, md5(array_to_string(p, chr(12))) as digest from (select doc_id, list_concat(ls[1:cast(1 + doc_id % 9 as int)], list_transform(range(greatest(0, 1 + doc_id % 9 - len(ls))), lambda x: '')) as p from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null))""")
def fitted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as pages, padded or cut to a declared number."""
    p = binary.fit_pages(F.split("text", "\n"), (1 + F.col("doc_id") % 9).cast("int"))
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(p).alias("n"), F.md5(F.array_join(p, "\f").cast("binary")).alias("digest"))


@query(f"""with t as (select doc_id, regexp_replace(text, '[aeiou]r', ' ', 'g') as seen, text from documents),
 n as (select doc_id, {NORM.format(x="text")} as a, {NORM.format(x="seen")} as b from t),
 w as (select doc_id, a, b, list_distinct(list_filter(string_split(a, ' '), lambda x: x <> '')) as wa, list_distinct(list_filter(string_split(b, ' '), lambda x: x <> '')) as wb from n)
 select doc_id, round(len(list_intersect(wa, wb)) / (len(wa) + len(wb) - len(list_intersect(wa, wb))), 4) as score, len(list_intersect(wa, wb)) / (len(wa) + len(wb) - len(list_intersect(wa, wb))) >= 0.45 as passed from w where length(a) >= 100 and length(b) >= 100""")
def recognition_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts against themselves with letters lost, as recognition loses them."""
    d = read(spark, sf_dir, "documents").select("doc_id", Q.ocr_agreement(F.col("text"), F.regexp_replace("text", "[aeiou]r", " ")).alias("x"))
    return d.where("x is not null").select("doc_id", "x.score", "x.passed")


@query("""select o_orderkey, case when i = 1 then o_orderpriority || '.pdf' else 'report ' || o_orderkey || '.docx' end as name, case when i = 1 then 'D-' || o_custkey end as legacy from orders, (select unnest([1, 2]) as i)""")
def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that name documents line by line, some with an older id."""
    cell = F.concat("o_orderpriority", F.lit(".pdf D-"), "o_custkey", F.lit("\n \nreport "), "o_orderkey", F.lit(".docx"))
    return tabular.split_documents(read(spark, sf_dir, "orders").withColumn("cell", cell), "cell").select("o_orderkey", "name", "legacy")


@query("select count(*) as rows, count_if(len(string_split(p_name, ' ')) <> 2) as ragged from part")
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tabular.ragged(read(spark, sf_dir, "part").withColumn("cells", F.split("p_name", " ")), "cells", 2)


@query("select n_regionkey, count(*) as n from nation group by 1")
def counts_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tabular.count_by(read(spark, sf_dir, "nation"), "n_regionkey")
