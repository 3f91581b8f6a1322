"""Queries of the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking, segmentation
from .registry import query, read

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def in_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


TOKENS = r"regexp_extract_all(lower(substring(text, 1, {n})), '[\p{{L}}\p{{Nl}}\p{{No}}]+')"
LATIN = r"[A-Za-zªµºÀ-ÖØ-öø-ɏḀ-ỿ]"
NORM = r"trim(regexp_replace(regexp_replace(strip_accents(lower({x})), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"

LANGUAGE = rf"""
 base as (select *, {TOKENS.format(n=40000)} as tk, lower(substring(text, 1, 20000)) as low,
   len(regexp_extract_all(substring(text, 1, 200000), '\p{{L}}')) as letters, len(regexp_extract_all(substring(text, 1, 200000), '{LATIN}')) as latin from documents),
 scored as (select *, case when letters = 0 then null when 2 * latin >= letters then 'latin' else 'other' end as script,
   {", ".join(f"coalesce(len(list_filter(tk, lambda x: list_contains({in_list(T.STOPWORDS[k])}, x))) / nullif(len(tk), 0), 0.0) + (case when {('regexp_matches(low, ' + chr(39) + '[' + T.DIACRITICS[k] + ']' + chr(39) + ')') if T.DIACRITICS[k] else 'false'} then 0.02 else 0.0 end) as s_{k}" for k in T.STOPWORDS)} from base),
 best as (select *, greatest(s_es, s_en, s_pt) as b, list_sort([s_es, s_en, s_pt])[2] as second from scored),
 lang as (select *, script = 'latin' and len(tk) >= 15 as able, case when script = 'latin' and len(tk) >= 15 and b >= 0.03 then case when s_es = b then 'es' when s_en = b then 'en' else 'pt' end end as language from best),
 sure as (select *, case when able then case when b >= 0.03 then round(greatest(least(1.0, b * 3) * (1 - least(0.9, second / greatest(b, 1e-9))), 0.1), 3) else b end else 0.0 end as language_confidence from lang)"""

SIGNALS = rf"""
 sig0 as (select *, {TOKENS.format(n=20000)} as t2, string_split(lower(regexp_replace(substring(text, 1, 50000), '\P{{L}}', '', 'g')), '') as ls,
   list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 15) as ln from sure),
 sig1 as (select *, list_aggregate(ls, 'entropy') as h, list_max(map_values(list_aggregate(ls, 'histogram'))) / len(ls) as top from sig0),
 sig as (select *, cast(length(text) as double) as characters,
   case when length(text) = 0 then 0.0 else round(1 - len(regexp_extract_all(text, '[\x00-\x08\x0b-\x1f\x7f-\x{{9f}}\p{{Cf}}\p{{Co}}]')) / length(text), 4) end as printable_ratio,
   case when length(text) = 0 then 0.0 else round(len(regexp_extract_all(text, '\p{{L}}')) / length(text), 4) end as alphabetic_ratio,
   case when len(ls) < 100 then 0.5 else round((case when h between 3.2 and 5.2 then 1.0 when h < 3.2 then greatest(0.0, h / 3.2) else greatest(0.0, 1 - (h - 5.2) / 3.0) end) * (case when top between 0.05 and 0.30 then 1.0 else 0.6 end), 4) end as char_distribution,
   case when language is null or len(t2) < 20 then 0.5 else round(len(list_filter(t2, lambda x: list_contains(case language {" ".join(f"when '{k}' then {in_list(T.STOPWORDS[k])}" for k in T.STOPWORDS)} end, x))) / len(t2), 4) end as known_word_ratio,
   case when len(t2) = 0 then 0.0 else round(list_sum(list_transform(t2, lambda x: length(x))) / len(t2), 3) end as average_word_length,
   case when len(t2) = 0 then 0.0 else round(len(list_filter(t2, lambda x: length(x) = 1)) / len(t2), 4) end as single_char_token_ratio,
   case when len(ln) < 5 then 0.0 else round(1 - len(list_distinct(ln)) / len(ln), 4) end as repetition_ratio,
   0.0 as nul_count from sig1)"""


@query(rf"""select doc_id, length(c) as n, md5(c) as digest from (select doc_id, regexp_replace(regexp_replace(regexp_replace(translate(text, chr(160) || chr(8199) || chr(8239) || chr(8288) || chr(65279) || chr(8232) || chr(8233) || chr(13) || chr(12), '     ' || chr(10) || chr(10) || chr(10) || chr(10)),
   '[\x00-\x08\x0b-\x1f\x7f-\x{{9f}}\p{{Cf}}\p{{Co}}]', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[{WS}]+|[{WS}]+$', '', 'g') as c from documents)""")
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.clean_text("text")
    return read(spark, sf_dir, "documents").select("doc_id", F.length(c).alias("n"), F.md5(c.cast("binary")).alias("digest"))


@query(f"select doc_id, md5({NORM.format(x='text')}) as digest from documents")
def text_comparison_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.comparison_form("text").cast("binary")).alias("digest"))


@query(rf"select doc_id, length(regexp_replace(text, '[\x00-\x1f{WS}]', '', 'g')) as n_audit from documents")
def text_audit_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.length(T.audit_form("text")).alias("n_audit"))


@query(rf"select doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]')) as n_tokens from documents")
def text_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.token_count("text").alias("n_tokens"))


@query(f"with {LANGUAGE} select doc_id, script, language, language_confidence from sure")
def text_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_language(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "script", "language", "language_confidence")


@query(f"with {LANGUAGE}, {SIGNALS} select doc_id, {', '.join(T.SIGNALS)} from sig")
def text_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_signals(T.with_language(read(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", *T.SIGNALS)


@query(rf"""with p as (select a.doc_id, list_distinct(list_filter(string_split({NORM.format(x='a.text')}, ' '), lambda x: x <> '')) as wa, list_distinct(list_filter(string_split({NORM.format(x='b.text')}, ' '), lambda x: x <> '')) as wb from documents a join documents b on b.doc_id = a.doc_id + 1)
 select doc_id, case when len(wa) = 0 then 0.0 else round(len(list_intersect(wa, wb)) / len(wa), 6) end as overlap, case when len(wa) + len(wb) = 0 then 0.0 else round(len(list_intersect(wa, wb)) / (len(wa) + len(wb) - len(list_intersect(wa, wb))), 6) end as jaccard from p""")
def text_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", T.comparison_form("text").alias("t"))
    pairs = d.join(d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u")), "doc_id")
    return pairs.select("doc_id", F.round(T.token_overlap(F.col("t"), F.col("u")), 6).alias("overlap"), F.round(T.jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"))


@query(r"""with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') as ls from documents)
 select doc_id, case when len(ls) < 3 then 0.5 else round(1 - len(list_filter(range(2, len(ls) + 1), lambda i: regexp_matches(ls[i], '^\s*\p{Ll}') and regexp_matches(ls[i - 1], '[.!?:;]\s*$'))) / (len(ls) - 1), 4) end as continuity from l""")
def structural_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", segmentation.structural_continuity(F.col("text")).alias("continuity"))


@query(rf"""with {LANGUAGE}, p as (select *, string_split(text, chr(10)) as lines, {TOKENS.format(n=20000)} as t2, regexp_extract_all(substring(text, 1, 20000), '[\p{{L}}\p{{N}}_]+-\n[\p{{L}}\p{{N}}_]+') as joins from sure),
 l as (select *, list_filter(lines, lambda x: trim(x) <> '') as ls from p),
 s as (select *, case when len(ls) < 3 then 0.5 else round(1 - len(list_filter(range(2, len(ls) + 1), lambda i: regexp_matches(ls[i], '^\s*\p{{Ll}}') and regexp_matches(ls[i - 1], '[.!?:;]\s*$'))) / (len(ls) - 1), 4) end as st,
   len(list_filter(t2, lambda x: list_contains(case language {" ".join(f"when '{k}' then {in_list(T.STOPWORDS[k])}" for k in T.STOPWORDS)} end, x))) / nullif(len(t2), 0) as share,
   case when len(joins) = 0 then 0.5 else len(list_filter(joins, lambda j: length(j) - 2 > 5)) / len(joins) end as hy from l)
 select doc_id, round(case when trim(text) = '' then 0.0 when script is distinct from 'latin' or language is null or len(t2) < 20 then st else 0.55 * least(share / 0.30, 1.0) + 0.15 * hy + 0.30 * st end, 4) as continuity from s""")
def reading_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.with_language(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", segmentation.reading_continuity(F.col("text"), F.col("language"), F.col("script")).alias("continuity"))


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a made-up physical layout: every third with a second column, every third with a table's gap."""
    text = F.regexp_replace("text", r"([^\n]{60})", "$1\n")
    lines = F.split(text, "\n")
    two = F.array_join(F.transform(lines, lambda x, i: F.when(i % 2 == 1, F.concat(F.lit(" " * 48), x)).otherwise(x)), "\n")
    table = F.array_join(F.transform(lines, lambda x: F.concat(F.rpad(F.substring(x, 1, 20), 20, "x"), F.lit(" " * 10), F.substring(x, 21, 40))), "\n")
    return read(spark, sf_dir, "documents").select("doc_id", text.alias("plain"), F.when(F.col("doc_id") % 3 == 0, two).when(F.col("doc_id") % 3 == 1, table).otherwise(text).alias("layout"))


@query()
def reading_order_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _layout(spark, sf_dir)
    d = T.with_language(d.withColumnRenamed("plain", "text")).withColumnRenamed("text", "plain")
    d = d.withColumn("x", segmentation.choose_mode(F.col("plain"), F.col("layout"), F.col("language"), F.col("script")))
    return d.select("doc_id", F.round(segmentation.gap_ratio(F.col("layout")), 4).alias("gap_ratio"), segmentation.indentation(F.col("layout")).alias("i"), "x.method", "x.tabular").select("doc_id", "gap_ratio", "i.mass", "i.alternations", "method", "tabular")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in pages of four lines."""
    lines = F.split("text", "\n")
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 4)), lambda p: F.array_join(F.slice(lines, (p * 4 + 1).cast("int"), F.lit(4)), "\n"))
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(pages).alias("page", "text"))


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) // 4 as page from documents),
 s as (select doc_id, count(distinct page) as pages from l group by 1 having count(distinct page) >= 4),
 k as (select doc_id, trim(line) as line, count(distinct page) as n from l where length(trim(line)) between 3 and 120 and not regexp_matches(line, '(?i)^\s*(page\s+)?\d{1,4}\s*$') group by 1, 2)
 select doc_id, line from k join s using (doc_id) where n >= greatest(4, floor(pages * 0.6))""")
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.boilerplate(_pages(spark, sf_dir))


@query(rf"""with k as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) // 4 as page from documents),
 g as (select doc_id, page, sum(length(regexp_replace(line, '[-{WS}]', '', 'g'))) as n from k where page % 7 = 6 group by 1, 2) select doc_id, page, n :: bigint as n_chars from g where n > 0""")
def segmented_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of tables: what their blocks hold, hyphens at line ends apart, is what the pages hold."""
    s = segment_pages(spark, sf_dir).where("page % 7 = 6")
    n = F.sum(F.length(F.regexp_replace("text", f"[-{T.WHITE}]", ""))).cast("long")
    return s.groupBy(F.col("doc_id").cast("long").alias("doc_id"), "page").agg(n.alias("n_chars")).where("n_chars > 0")


@query()
def segment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return segmentation.segment_pages(pages.withColumn("is_tabular", F.col("page") % 7 == 6), segmentation.boilerplate(pages))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's lines as blocks; the first is a heading where it is short."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    kind = F.when((F.col("ord") == 0) & (F.length("text") < 60), "heading").otherwise("paragraph")
    return d.select("doc_id", F.col("ord").cast("long").alias("ord"), F.concat(F.col("doc_id").cast("string"), F.lit(":1:block:"), F.lpad(F.col("ord").cast("string"), 6, "0")).alias("block_id"), kind.alias("type"), "text", F.lit(1).alias("page"), F.lit("native").alias("method"), F.lit(0.8).alias("confidence"), F.lit(False).alias("is_boilerplate"))


@query()
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk(_blocks(spark, sf_dir))


def _kept(chunks: DataFrame) -> DataFrame:
    """What a document's chunks hold together: tokens, text without white space, and how many are over the limit."""
    per = chunks.groupBy("doc_id").agg(F.sum("num_tokens").alias("n_tokens"), F.count_if(F.col("num_tokens") > chunking.MAX_TOKENS).alias("n_over"), F.array_sort(F.collect_list(F.struct("position", "text"))).alias("c"))
    whole = F.regexp_replace(F.array_join(F.transform("c", lambda c: c["text"]), ""), f"[{T.WHITE}]", "")
    in_order = F.transform("c", lambda c: c["position"]) == F.sequence(F.lit(0), F.size("c") - 1)
    return per.select(F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", "n_over", F.md5(whole.cast("binary")).alias("digest"), in_order.alias("in_order"))


_KEPT_SQL = rf"""select doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]')) as n_tokens, 0 as n_over, md5(regexp_replace(text, '[{WS}]', '', 'g')) as digest, true as in_order from documents where regexp_matches(text, '[^{WS}]')"""


@query(_KEPT_SQL)
def chunks_keep_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as blocks, short first ones as headings: nothing is lost and nothing is over."""
    return _kept(chunk_documents(spark, sf_dir))


@query(_KEPT_SQL)
def chunks_keep_whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(chunk_whole_documents(spark, sf_dir))


@query(_KEPT_SQL)
def chunks_keep_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second line is a heading, however long: in a row, at the end, over the limit."""
    return _kept(chunking.chunk(_blocks(spark, sf_dir).withColumn("type", F.when(F.col("ord") % 3 < 2, "heading").otherwise("paragraph"))))


_PIECES = rf"""p as (select doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '^[{WS}]+|[{WS}]+$', '', 'g'), '\n[{WS}]*\n+'), lambda x: regexp_replace(x, '^[{WS}]+|[{WS}]+$', '', 'g')), lambda x: x <> '') as ps from documents),
 t as (select doc_id, unnest(ps) as para, unnest(range(len(ps))) as i from p), k as (select doc_id, i, len(regexp_extract_all(para, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]')) as n from t)"""


@query(rf"with {_PIECES} select doc_id, i as paragraph, greatest(1, (n + 49) // 50) as n_pieces, least(n, 50) as most from k")
def hard_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs cut hard at 50 tokens, as documents of one heading each, which the chunker cuts so and not otherwise."""
    text = F.regexp_replace("text", rf"^[{T.WHITE}]+|[{T.WHITE}]+$", "")
    paragraphs = F.filter(F.transform(F.split(text, rf"\n[{T.WHITE}]*\n+"), lambda x: F.regexp_replace(x, rf"^[{T.WHITE}]+|[{T.WHITE}]+$", "")), lambda x: x != "")
    d = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(paragraphs).alias("i", "text"))
    block = F.struct(F.lit(0).cast("long").alias("ord"), F.lit("b").alias("block_id"), F.lit("heading").alias("type"), "text", F.lit(1).alias("page"), F.lit("native").alias("method"), F.lit(0.8).alias("confidence"))
    chunks = chunking.chunk_folded(d.select(F.concat_ws(":", "doc_id", "i").alias("doc_id"), F.array(block).cast(chunking.BLOCK).alias("blocks")), 50, ("doc_id", "num_tokens"))
    part = lambda n: F.element_at(F.split("doc_id", ":"), n).cast("long")
    return chunks.groupBy("doc_id").agg(F.count("*").alias("n_pieces"), F.max("num_tokens").alias("most")).select(part(1).alias("doc_id"), part(2).alias("paragraph"), "n_pieces", "most")


@query()
def chunk_whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one block each: no shuffle."""
    block = F.struct(F.lit(0).cast("long").alias("ord"), F.concat(F.col("doc_id").cast("string"), F.lit(":1:block:000000")).alias("block_id"), F.lit("page_text").alias("type"), "text", F.lit(1).alias("page"), F.lit("native").alias("method"), F.lit(0.8).alias("confidence"))
    docs = read(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), F.array(block).cast(chunking.BLOCK).alias("blocks"))
    return chunking.chunk_folded(docs)


@query(rf"""with d as (select doc_id, doc_id % 10 = 0 as skipped, regexp_matches(text, '[^{WS}]') as filled, length(text) as n from documents)
 select count(*) as seen, count_if(filled and not skipped) as chunked, count_if(skipped) as structured_only, count_if(not skipped and not coalesce(filled, false)) as empty, 0 as oversize from d""")
def chunk_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_statistics(spark, sf_dir).select("seen", "chunked", "structured_only", "empty", "oversize")


@query()
def chunk_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, "structured_only").otherwise("full").alias("hint"))
    blocks = _blocks(spark, sf_dir).join(docs.where("hint = 'full'"), "doc_id", "left_semi")
    return chunking.chunk_stats(docs, chunking.chunk(blocks))


@query(r"select doc_id, md5(trim(regexp_replace(regexp_replace(text, '([\p{L}\p{N}_]{2,})-[ \t]*\n\s*', '\1', 'g'), '\s*\n\s*', ' ', 'g'))) as digest from documents")
def join_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.join_lines("text").cast("binary")).alias("digest"))
