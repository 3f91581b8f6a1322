"""License scans: places of known phrases, and an exact set-similarity join of text blocks with license templates.

A block is a line; where asked for, blocks of several consecutive lines are joined too, which find a template that is wrapped
over lines. A template is found in a block that holds at least CONTAINED of its distinct words. Words are ordered by
how often they stand in all documents, rarest first. A template of n words that needs m of them can only be met by a block that
holds one of its first n - m + 1 (prefix filter), that has m words (length filter), and that has m template words from
that one on in the order (positional filter). What is left is counted exactly. All of it is DataFrame operations.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_of, let

# Phrases with their labels, and sentences of public licenses.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary", "all rights reserved"),
    ("public-domain", "this work is dedicated to the public domain"),
]
CONTAINED = 0.8

_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrase(words: str) -> str:
    """A pattern of the words standing one after another; (?i) is for A-Z only."""
    return rf"(?<!{_WORD})" + _GAP.join(f"(?i:{w})" for w in words.split()) + rf"(?!{_WORD})"


def _words_in(text: Column | str) -> Column:
    return F.regexp_count(text, F.lit(f"{_WORD}+"))


def _lower_words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"{_WORD}+"), F.lit(0))


def word_order(texts: DataFrame, templates: list[tuple[str, str]]) -> list[str]:
    """The templates' words, those rarest in the column `text` first. Only counts of these words reach the driver."""
    words = sorted({w for _, t in templates for w in t.split()})
    whole = rf"(?<!{_WORD})(?i:{any_of(words)})(?!{_WORD})"
    seen = texts.select(F.explode(F.regexp_extract_all("text", F.lit(whole), F.lit(0))).alias("w")).select(F.translate("w", _UPPER, _LOWER).alias("w"))
    counts = {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _blocks(lines: Column, n: int) -> Column:
    """Structs (wide, line) of the runs of n of some lines (line, hit) that hold a hit; one run of all lines where there are fewer."""
    at = F.sequence(F.lit(0), F.greatest(F.size(lines) - n, F.lit(0)))
    hit = lambda i: F.greatest(*(F.get(lines, i + k)["hit"] for k in range(n))) if n > 1 else F.get(lines, i)["hit"]
    run = lambda i: F.struct(F.lit(n > 1).alias("wide"), F.concat_ws("\n", *(F.get(lines, i + k)["line"] for k in range(n))).alias("line"))
    return F.transform(F.filter(at, hit), run)


def join_templates(texts: DataFrame, keys: list[str], templates: list[tuple[str, str]], contained: float = CONTAINED, across: int = 1) -> DataFrame:
    """(keys..., wide, label, containment) for each block of texts(keys..., text) and template that it holds, repeats included.

    Blocks are lines (wide is false) and, with across > 1, each run of that many lines (wide is true), or the whole text where it has fewer.
    """
    spark = texts.sparkSession
    rank = {w: i for i, w in enumerate(word_order(texts, templates))}
    sets = [(label, sorted({rank[w] for w in t.split()})) for label, t in templates]
    index = []
    for i, (label, own) in enumerate(sets):
        need = ceil(contained * len(own) - 1e-9)
        index += [(r, i, label, own, need) for r in own[: len(own) - need + 1]]
    first = sorted({r for r, *_ in index})
    words = [w for w in rank if rank[w] in set(first)]
    known = F.create_map(*(F.lit(x) for w, i in rank.items() for x in (w, i)))
    pattern = rf"(?<!{_WORD})(?i:{any_of(words)})(?!{_WORD})"
    blocks_of = lambda lines: F.concat(_blocks(lines, 1), *([_blocks(lines, across)] if across > 1 else []))
    marked = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), x.rlike(pattern).alias("hit")))
    lines = texts.where(F.col("text").rlike(pattern)).select(*keys, F.explode(let(marked, blocks_of)).alias("x")).select(*keys, "x.wide", "x.line")
    keys = [*keys, "wide"]
    sized = lines.select(*keys, F.array_distinct(_lower_words("line")).alias("words"))
    ranks = F.array_sort(F.transform(F.filter("words", lambda w: F.map_contains_key(known, w)), lambda w: known[w]))
    blocks = sized.select(*keys, F.size("words").alias("size"), ranks.alias("ranks")).where(F.size("ranks") > 0)
    probes = blocks.select(*keys, "size", "ranks", F.explode(F.array_intersect("ranks", F.array(*map(F.lit, first)))).alias("r"))
    side = spark.createDataFrame(index, "r int, template int, label string, own array<int>, need int")
    met = probes.join(F.broadcast(side), "r").where((F.col("size") >= F.col("need")) & (F.size(F.filter("ranks", lambda x: x >= F.col("r"))) >= F.col("need")))
    both = F.size(F.array_intersect("ranks", "own"))
    return met.where(both >= F.col("need")).select(*keys, "label", (both / F.size("own")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED, across: int = 1) -> DataFrame:
    """One row for each row of docs: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), with across > 1 also wrapped_labels.

    Ids are integers. A null text counts as empty: no words, no places, empty label lists, score 0. Repeated rows get the same result each. The score is 1 with
    a phrase, else the largest share of a template that one line holds. wrapped_labels are those of templates that `across` consecutive lines hold
    together, which takes in those of single lines; empty without any.
    """
    no_id = F.lit(-(1 << 63))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), no_id).alias("did"), F.xxhash64(text_col).alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    patterns = {label: _phrase(p) for p, label in PHRASES.items()}
    any_phrase = "(?:" + "|".join(patterns.values()) + ")"
    n_base = F.regexp_count("text", F.lit(any_phrase)).cast("long")
    before_first = F.substring("text", F.lit(1), F.regexp_instr("text", F.lit(any_phrase)) - 1)
    before_last = F.regexp_extract("text", f"(?s)^(.*){any_phrase}", 1)
    base = texts.select("did", "th", _words_in("text").cast("long").alias("n_words"), n_base.alias("n_base"), "text").select(
        "did",
        "th",
        "n_words",
        "n_base",
        F.when(F.col("n_base") > 0, _words_in(before_first).cast("long")).alias("first_word"),
        F.when(F.col("n_base") > 0, _words_in(before_last).cast("long")).alias("last_word"),
        F.when(F.col("n_base") > 0, F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.lit(label)) for label, p in patterns.items())))).otherwise(F.array().cast("array<string>")).alias("base"),
    )
    line = ~F.col("wide")
    met = join_templates(texts, ["did", "th"], templates, contained, across).groupBy("did", "th").agg(
        F.collect_set(F.when(line, F.col("label"))).alias("more"), F.max(F.when(line, F.col("containment"))).alias("share"), F.collect_set("label").alias("wrapped")
    )
    joined = base.join(met, ["did", "th"], "left")
    names = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return joined.select(
        F.when(F.col("did") != no_id, F.col("did")).alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        names(F.col("base")).alias("base_labels"),
        names(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        *([names(F.coalesce("wrapped", F.array().cast("array<string>"))).alias("wrapped_labels")] if across > 1 else []),
    )
