"""The registered query of each operator, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, covering_simhash, decontaminate, langid_ecoc, license_join, nn_descent, packing, pii_crf, quality_cnn, superkmer
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LICENSE_WORDS = rf"regexp_extract_all(translate({{x}}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PHRASES = " union all ".join(f"select '{p}' as p, '{label}' as label" for p, label in license_join.PHRASES.items())
_TEMPLATES = " union all ".join(f"select {i} as t, '{label}' as label, list_distinct(string_split('{text}', ' ')) as own" for i, (label, text) in enumerate(license_join.TEMPLATES))
_ESCAPED = r"length({x}) + length({x}) - length(regexp_replace({x}, '[<\[\\]', '', 'g'))"

ORACLE_SQL: dict[str, str] = {
    "op5_superkmer_dedup": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        win as (select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
        again as (select doc_id, i from win where h in (select h from win group by h having count(*) > 1)),
        gone as (select distinct doc_id, unnest(range(i, i + 35)) as k from again),
        kept as (select p.doc_id, string_agg(p.x, ' ' order by p.k) as t from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as k from d) p anti join gone g on p.doc_id = g.doc_id and p.k = g.k group by 1),
        n as (select doc_id, count(*) as n from gone group by 1)
        select d.doc_id, len(w) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (doc_id) left join n using (doc_id)""",
    "op6_event_chat": f"""
        with r as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
          cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
          cast(sum({len(chat_format.START + chat_format.SEP + chat_format.END)} + {_ESCAPED.format(x="role")} + {_ESCAPED.format(x="text")}) as bigint) as formatted_chars
        from r group by conv_id""",
    "op8_nn_descent": """
        with recursive e as (select vec_id, list_transform(embedding, lambda x: x :: double) as v from embeddings),
        u as (select vec_id, v from e where v is not null and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0 and list_sum(list_transform(v, lambda x: x * x)) > 0),
        links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95),
        reach as (select a as vec_id, b as dest from links union select r.vec_id, l.b from reach r join links l on r.dest = l.a),
        c as (select vec_id, min(dest) as least from reach group by 1), n as (select a as vec_id, count(*) as n from links group by 1)
        select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(least, vec_id)) as component_id, vec_id = least(vec_id, coalesce(least, vec_id)) as kept from e left join c using (vec_id) left join n using (vec_id)""",
    "op9_license_join": f"""
        with d as (select doc_id, coalesce(text, '') as text, {_LICENSE_WORDS.format(x="coalesce(text, '')")} as w from documents), ph as ({_PHRASES}), tp as ({_TEMPLATES}),
        hit as (select doc_id, label, unnest(list_filter(range(1, len(w) + 1), lambda i: array_to_string(w[i:i + len(string_split(p, ' ')) - 1], ' ') = p)) - 1 as k from d, ph),
        base as (select doc_id, count(*) as n, min(k) as f, max(k) as l, list_distinct(list(label)) as labels from hit group by 1),
        line as (select doc_id, list_distinct({_LICENSE_WORDS.format(x="line")}) as b from (select doc_id, unnest(string_split(text, chr(10))) as line from d)),
        met as (select doc_id, label, len(list_intersect(own, b)) / len(own) as share from line, tp where len(list_intersect(own, b)) >= ceil({license_join.CONTAINED} * len(own) - 1e-9)),
        more as (select doc_id, list_distinct(list(label)) as labels, max(share) as share from met group by 1),
        wide as (select doc_id, list_distinct({_LICENSE_WORDS.format(x="array_to_string(l[i:i + 2], chr(10))")}) as b from (select doc_id, l, unnest(range(1, greatest(len(l) - 2, 1) + 1)) as i from (select doc_id, string_split(text, chr(10)) as l from d))),
        wrap as (select doc_id, list_distinct(list(label)) as labels from wide, tp where len(list_intersect(own, b)) >= ceil({license_join.CONTAINED} * len(own) - 1e-9) group by 1)
        select doc_id, len(w) as n_words, coalesce(n, 0) as n_base, f as first_word, l as last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
          array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') as labels, case when n > 0 then 1.0 else coalesce(share, 0.0) end as score, coalesce(array_to_string(list_sort(wrap.labels), ','), '') as wrapped_labels
        from d left join base using (doc_id) left join more using (doc_id) left join wrap using (doc_id)""",
}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op5_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.digest_of_kept(read(spark, sf_dir, "documents"))


@query
def op3_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op7_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid_ecoc.identify(docs, langid_ecoc.fit(docs))


@query
def op4_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, read(spark, sf_dir, "labels")))


@query
def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(read(spark, sf_dir, "documents"), across=3)


@query
def op6_event_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"))
    return chat_format.digest(chat_format.render(chat_format.messages(chat_format.as_events(rows))))


@query
def op1_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find(read(spark, sf_dir, "documents"))


@query
def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read(spark, sf_dir, "embeddings"))
