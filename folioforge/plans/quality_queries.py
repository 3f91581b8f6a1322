"""Queries of scores, gates, checks and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import quality as Q
from ..operators import reports
from .registry import query, read
from .text_queries import LANGUAGE, NORM, SIGNALS

INTRINSIC = """greatest(0.0, least(1.0, 0.40 * least(known_word_ratio / 0.28, 1.0) + 0.20 * least(printable_ratio / 0.99, 1.0) + 0.20 * char_distribution + 0.10 * (1 - least(single_char_token_ratio / 0.5, 1.0)) + 0.10 * (1 - least(repetition_ratio, 1.0))))"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_signals(T.with_language(read(spark, sf_dir, "documents").select("doc_id", "source", "text")))


@query(f"""with {LANGUAGE}, {SIGNALS}, long as (unpivot (select doc_id, source, script, {", ".join(T.SIGNALS)} from sig) on {", ".join(T.SIGNALS)} into name name value value),
 p as (select doc_id, name, value, case when count(*) over g >= 8 then round((rank() over (partition by source, coalesce(script, 'unknown'), name order by value) - 1) / count(*) over g, 4) end as pctile from long window g as (partition by source, coalesce(script, 'unknown'), name))
 select doc_id, name, value, pctile, case when pctile <= 0.05 and name in ('known_word_ratio', 'char_distribution', 'printable_ratio') then 'outlier_low_in_source' end as flag from p""")
def signal_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.calibrate(Q.signals_long(_scored(spark, sf_dir), ["doc_id", "source", "script"]), ["source", "script"]).select("doc_id", "name", "value", "pctile", "flag")


@query(f"with {LANGUAGE} select source, coalesce(script, 'unknown') as script, count(*) as n from sure group by 1, 2")
def calibration_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.group_sizes(T.with_language(read(spark, sf_dir, "documents").select("doc_id", "source", "text")), ["source", "script"])


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, and a check that the first words of the text before it stand in the document."""
    d = _scored(spark, sf_dir)
    titles = read(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("doc_id"), F.substring("text", 1, 60).alias("title"))
    d = d.join(titles, "doc_id", "left")
    check = Q.title_match(F.col("title"), F.col("text"))
    return d.withColumn("checks", F.when(F.col("doc_id") % 2 == 0, F.array_compact(F.array(check)))).withColumn("flags", F.lit(None).cast("array<string>"))


CONFIDENCE = f"""{LANGUAGE}, {SIGNALS}, tit as (select sig.*, substring(b.text, 1, 60) as title from sig left join documents b on b.doc_id = sig.doc_id - 1),
 ov as (select *, list_distinct(list_filter(string_split({NORM.format(x='title')}, ' '), lambda x: x <> '')) as wa, list_distinct(list_filter(string_split({NORM.format(x='substring(text, 1, 6000)')}, ' '), lambda x: x <> '')) as wb from tit),
 chk as (select *, doc_id % 2 = 0 and length(trim(title)) >= 8 and trim(substring(text, 1, 6000)) <> '' as checked, round(case when len(wa) = 0 then 0.0 else len(list_intersect(wa, wb)) / len(wa) end, 4) as overlap, {INTRINSIC} as base from ov),
 conf as (select *, case when characters = 0 then 0.0 when coalesce(checked, false) then round(0.7 * base + 0.3 * (0.3 * overlap / 0.3), 4) else round(base, 4) end as score, case when characters = 0 then 'unverified' when coalesce(checked, false) then 'title_match' else 'intrinsic_only' end as basis from chk)"""


@query(f"with {CONFIDENCE} select doc_id, round(score, 3) as score, basis, len(title) > 0 and coalesce(checked, false) and overlap < 0.5 as failed from conf")
def confidence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Q.confidence(_titled(spark, sf_dir))
    return d.select("doc_id", F.round("score", 3).alias("score"), "basis", F.array_contains("all_flags", "crosscheck_failed:title_match").alias("failed"))


@query(f"with {CONFIDENCE} select count_if(false) as strong, count_if(basis = 'title_match') as weak, count_if(basis = 'intrinsic_only') as intrinsic, count_if(basis = 'unverified') as unverified from conf")
def verification_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(Q.confidence(_titled(spark, sf_dir)))


@query("""with s as (select list_sort(list(round((n_chars % 10007) / 10007, 4))) as l from documents), n as (select l, len(l) as n from s)
 select n, round(l[1], 4) as min, round(l[n // 4 + 1], 4) as p25, round((l[(n - 1) // 2 + 1] + l[n // 2 + 1]) / 2, 4) as median, round(l[3 * n // 4 + 1], 4) as p75, round(l[n], 4) as max, round(list_sum(l) / n, 4) as mean from n""")
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_distribution(read(spark, sf_dir, "documents").select(F.round((F.col("n_chars") % 10007) / 10007, 4).alias("score")), "score")


GATE = f"""with {LANGUAGE}, {SIGNALS}, g as (select *, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) as c, (doc_id % 10) / 10.0 as cover from sig),
 r as (select *, script = 'latin' and c > 500 as lat,
   (case when printable_ratio < 0.95 then 1 else 0 end) + (case when char_distribution < 0.35 then 1 else 0 end) + (case when script = 'latin' and c > 500 and (language is null or known_word_ratio < 0.25) then 1 else 0 end) + (case when single_char_token_ratio > 0.45 and c > 300 then 1 else 0 end) as bad from g)
 select doc_id, case when c < 50 then case when cover >= 0.55 then 'ocr' when c = 0 then 'accept' when cover > 0.2 then 'ocr' else 'accept' end
   when bad >= 2 or coalesce(lat and (language is null or (known_word_ratio < 0.10 and c > 800)), false) then 'ocr' when c < 200 and cover > 0.4 then 'ocr' else 'accept' end as verdict,
   case when c < 50 then 1 when bad >= 2 or coalesce(lat and (language is null or (known_word_ratio < 0.10 and c > 800)), false) then bad + 1 else (case when bad > 0 then bad + 1 else 0 end) + (case when c < 200 and cover > 0.4 then 1 else 0 end) end as n_reasons from r"""


@query(GATE)
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Q.page_gate(_scored(spark, sf_dir).withColumn("image_coverage", (F.col("doc_id") % 10) / 10.0))
    return d.select("doc_id", "verdict", F.size("reasons").alias("n_reasons"))


@query(f"""with p as (select d.doc_id, b.item_id, case when d.doc_id % 3 = 0 then substring(d.text, 11, 300) else b.text end as frag, d.text from documents d join benchmark b on b.item_id = d.doc_id % 40),
 n as (select doc_id, item_id, {NORM.format(x='frag')} as f, {NORM.format(x='text')} as t from p), w as (select *, string_split(f, ' ') as ws from n),
 h as (select *, {", ".join(f"case when len(ws) >= {k} then len(list_filter(range(1, len(ws) - {k} + 2), lambda i: contains(t, array_to_string(ws[i:i + {k} - 1], ' ')))) / (len(ws) - {k} + 1) else 0.0 end as h{k}" for k in (12, 8, 5))} from w)
 select doc_id, item_id, round(case when f = '' or t = '' then 0.0 when contains(t, f) then 1.0 when h12 > 0.8 then h12 when greatest(h12, h8) > 0.8 then greatest(h12, h8) else greatest(h12, h8, h5) end, 4) as score from h""")
def gold_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % 40).alias("item_id"))
    b = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    pairs = d.join(b, "item_id").select("doc_id", "item_id", T.comparison_form("text").alias("t"), T.comparison_form(F.when(F.col("doc_id") % 3 == 0, F.substring("text", 11, 300)).otherwise(F.col("item"))).alias("f"))
    return pairs.select("doc_id", "item_id", Q.gold_fragment(F.col("f"), F.col("t"))["score"].alias("score"))


@query("""select doc_id, round(((case when doc_id % 2 = 0 then 1.0 else 0.0 end) + (case when doc_id % 4 < 2 then 1.0 else 0.5 end) + (case when doc_id % 5 = 0 then 1.0 else 0.0 end)) / 3, 4) as score from documents""")
def alert_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    text = F.concat(F.when(i % 2 == 0, "Alerta 012-19. ").otherwise("-"), F.lit(" Río Ñuñoa "), F.when(i % 4 < 2, " Puerto-Rico ").otherwise(""), F.when(i % 5 == 0, " en 2019").otherwise(""))
    check = Q.entity_check(F.lit("012-19"), F.array(F.lit("rio nunoa"), F.lit("Puerto Rico")), F.lit("2019-03-01"), text)
    return read(spark, sf_dir, "documents").select("doc_id", check["score"].alias("score"))


@query("""select doc_id, case when doc_id % 4 = 0 then doc_id % 8 = 0 when doc_id % 5 = 0 then false else (doc_id % 100) / 100.0 >= 0.35 end as usable, case when doc_id % 3 > 0 then 'ocr' else 'review' end as action, case when doc_id % 8 = 0 then 1 else 0 end as n_flags from documents""")
def usability_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    warnings = F.when(i % 8 == 0, F.array(F.lit("empty_list__nothing:x"), F.lit("other"))).otherwise(F.array(F.lit("other:1")))
    usable = Q.is_usable((i % 100) / 100.0, F.when(i % 5 == 0, "unverified").otherwise("intrinsic_only"), F.when(i % 4 == 0, 0).otherwise(10), warnings)
    return read(spark, sf_dir, "documents").select("doc_id", usable.alias("usable"), Q.recommended_action(i % 3).alias("action"), F.size(Q.flags_of_warnings(warnings, ["empty_list__nothing"])).alias("n_flags"))


@query("""select doc_id, case when doc_id % 3 = 0 and 2 * length(text) > greatest(length(text), 50) then 'ocr' else 'native' end as method, length(text) * (case when doc_id % 3 = 0 and 2 * length(text) > greatest(length(text), 50) then 2 else 1 end) as n from documents""")
def selective_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").withColumn("x", Q.selective_ocr(F.col("text"), F.when(F.col("doc_id") % 3 == 0, F.concat("text", "text"))))
    return d.select("doc_id", "x.method", F.length("x.text").alias("n"))


@query("""with b as (select doc_id, cast(unnest(range(len(string_split(text, chr(10))))) as bigint) as n from documents)
 select doc_id, doc_id || ':' || n as block_id from b where (doc_id % 13 = 0 and n = 0) or (doc_id % 11 = 0 and n = 1)""")
def id_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "text"))
    key = F.concat(F.col("doc_id").cast("string"), F.lit(":"), "n")
    before = b.select("doc_id", key.alias("block_id"), F.sha2("text", 256).alias("hash"))
    now = b.where(~((F.col("doc_id") % 11 == 0) & (F.col("n") == 1))).select("doc_id", key.alias("block_id"), F.sha2(F.when((F.col("doc_id") % 13 == 0) & (F.col("n") == 0), F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("hash"))
    return Q.id_stability(before, now).select("doc_id", "block_id")


@query("""with n as (select count(*) as a, count_if(s_suppkey % 10 <> 9) as b from supplier), m as (select least(200, b) as k, count(*) as h from n, (select s_suppkey, row_number() over (order by s_suppkey) as r from supplier) x where r <= least(200, b) group by b)
 select a as rows_a, b as rows_b, round(b / a, 4) as row_ratio, 1.0 as value_agreement, round(0.4 * b / a + 0.6, 4) as score, 0.4 * b / a + 0.6 >= 0.8 as passed from n, m""")
def mirror_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("nation"))
    row = lambda d: d.withColumn("row", F.row_number().over(Window.orderBy("s_suppkey")))  # noqa: E731  a table of one file
    a = row(s)
    b = a.join(s.where("s_suppkey % 10 <> 9").select("s_suppkey"), "s_suppkey", "left_semi")
    shorter = a.limit(b.count()).withColumn("s_name", F.upper("s_name"))
    return Q.mirror_check(a, shorter, ["s_name", "nation"])


@query("""select doc_id, case when doc_id % 7 = 0 then 1 else 0 end + case when doc_id % 5 = 0 then 1 else 0 end + case when doc_id % 3 = 0 then 1 else 0 end as n_problems from documents""")
def document_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    d = read(spark, sf_dir, "documents")
    docs = d.select("doc_id", F.lit("pdf").alias("format"), F.when(i % 5 != 0, "intrinsic_only").alias("basis"), F.lit(1).alias("pages_total"))
    blocks = d.select("doc_id", F.explode(F.array(*(F.struct(F.lit(k).alias("place"), (F.lit(k) + F.when((i % 7 == 0) & F.lit(k == 1), -5).otherwise(0)).alias("ord"), F.concat(F.lit("b"), F.lit(k)).alias("block_id"), F.lit("x").alias("text"), F.when(i % 3 == 0, 2).otherwise(1).alias("page")) for k in range(3)))).alias("b")).select("doc_id", "b.*", F.lit("paragraph").alias("type"), F.lit(None).cast("string").alias("structured"))
    return Q.document_problems(blocks, docs).select("doc_id", F.size("problems").alias("n_problems"))


@query("""select count(*) = 12 as i1_every_file, count_if(doc_id % 9 = 0) = 0 as i3_terminal_status, true as i7_reasons, true as i10_no_leakage, true as status_sum, false as written from documents""")
def corpus_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    d = read(spark, sf_dir, "documents").select("doc_id", F.lit("retrievable").alias("role"), F.when(i % 9 == 0, "pending").when(i % 9 == 1, "failure").otherwise("success").alias("status"), F.lit("why").alias("reason"))
    return Q.corpus_problems(d, written=-1, expected=12)


@query("""select doc_id, case when doc_id % 4 = 0 then 'missing' when doc_id % 4 = 1 then 'exact' when doc_id % 4 = 2 then 'partial' else 'fail' end as verdict from documents""")
def gold_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("doc_id") % 4 == 1, 0.97).when(F.col("doc_id") % 4 == 2, 0.6).when(F.col("doc_id") % 4 == 3, 0.2)
    return read(spark, sf_dir, "documents").select("doc_id", Q.gold_verdict(score).alias("verdict"))
