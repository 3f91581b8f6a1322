"""Removal of word windows that occur more than once, found by super-k-mer partitioning.

Every window of 35 words has a minimiser: the leftmost of its 8-word grams with the smallest hash. Consecutive windows
with the same minimiser position are one super-k-mer; equal windows have equal minimisers, so they meet in the bucket of
that gram's hash. First the buckets are counted from hashes alone: a gram that is a minimiser only once in the corpus
can't hold a repeated window. Only super-k-mers of other buckets then travel, each as one packed string, equal ones
added up on the way. In its bucket, sorting brings equal windows together; equality is checked word by word.
A bucket of many different super-k-mers isn't gathered: each of these is partitioned anew by the minimiser among longer grams,
again as packed super-k-mers, so that the bucket falls apart into smaller ones, and so on. Grams as long as the window end
this, since a bucket then holds one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow

WINDOW, GRAM = 35, 8
#: Super-k-mers of one bucket, unless all are equal, beyond which it is partitioned anew; the grams by which that is done, one after another.
HOT, LONGER = 512, (20, 30, WINDOW)
#: Rows of whole buckets that are sorted at once.
AT_ONCE = 20_000
_P, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_UNP = np.uint64(pow(int(_P), -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    """The runs of characters other than space and U+0009 to U+000D."""
    return (text or "").encode("utf-8", "replace").split()


def super_kmers(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket (signed), first window, number of windows, and 31 bits of a hash of the words, of each super-k-mer."""
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    m = n - gram + 1
    g = h[:m].copy()
    for i in range(1, gram):
        g *= _P
        g += h[i : m + i]
    g ^= g >> np.uint64(31)
    g *= _MIX
    g ^= g >> np.uint64(32)
    at, width, span = np.arange(m), 1, window - gram + 1
    while width < span:
        step = min(width, span - width)
        a, b = at[:-step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        width += step
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    times = np.diff(np.r_[starts, len(at)])
    power = np.full(n, _P)
    power[0] = 1
    sums = np.r_[np.uint64(0), np.cumsum(h * np.cumprod(power))]
    back = np.full(n, _UNP)
    back[0] = 1
    said = (sums[starts + times + window - 1] - sums[starts]) * np.cumprod(back)[starts]
    said = (said ^ (said >> np.uint64(29))) * _MIX >> np.uint64(33)
    return g[at[starts]].view(np.int64), starts, times, said.astype(np.int64)


def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(did, th, text) to (key, did, th, start, n, said)."""
    found = [super_kmers(words_of(x)) for x in batch.column(2).to_pylist()]
    counts = [len(x[0]) for x in found]
    key, start, n, said = (np.concatenate([x[i] for x in found]) for i in range(4))
    did, th = (np.repeat(batch.column(i).to_numpy(), counts) for i in range(2))
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(did), pa.array(th), *(pa.array(x.astype(np.int32)) for x in (start, n, said))], names=["key", "did", "th", "start", "n", "said"])


def _pack(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(did, th, text, list of (key, start, n, hot)) to (did, th, start, key, hot, packed)."""
    did, th, starts, keys, hots, packed, owners = batch.column(0), batch.column(1), [], [], [], [], []
    for i, (text, own) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
        words = words_of(text)
        for x in own:
            s = x["start"]
            starts.append(s)
            keys.append(x["key"])
            hots.append(x["hot"])
            packed.append(b" ".join(words[s : s + x["n"] + WINDOW - 1]).decode())
            owners.append(i)
    at = pa.array(owners, pa.int32())
    return pa.RecordBatch.from_arrays([did.take(at), th.take(at), pa.array(starts, pa.int32()), pa.array(keys, pa.int64()), pa.array(hots, pa.bool_()), pa.array(packed, pa.string())], names=["did", "th", "start", "key", "hot", "packed"])


def repeated_windows(packed: list[bytes], times: np.ndarray) -> list[np.ndarray]:
    """For each packed super-k-mer, standing for so many equal ones: which of its windows occur more than once in all."""
    split = [x.split() for x in packed]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in chain.from_iterable(split)), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    n = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(split)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = first[owner] + within
    step = np.full(len(ids) + 1, _P)
    step[0] = 1
    back = np.full(len(ids) + 1, np.uint64(pow(int(_P), -1, 1 << 64)))
    back[0] = 1
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    sums = np.r_[np.uint64(0), np.cumsum(x * np.cumprod(step)[:-1])]
    value = (sums[at + WINDOW] - sums[at]) * np.cumprod(back)[at]
    order = np.argsort(value, kind="stable")
    value, ranked = value[order], at[order]
    same = value[1:] == value[:-1]
    pairs = np.flatnonzero(same)
    equal = np.ones(len(pairs), bool)
    for j in range(WINDOW):
        equal &= ids[ranked[pairs] + j] == ids[ranked[pairs + 1] + j]
    if equal.all():
        group = np.cumsum(np.r_[False, ~same])
    else:  # different words, same hash: number the windows themselves
        seen: dict[bytes, int] = {}
        group = np.array([seen.setdefault(ids[i : i + WINDOW].tobytes(), len(seen)) for i in ranked])
    total = np.bincount(group, weights=times[owner[order]])
    out = np.zeros(len(owner), bool)
    out[order] = total[group] >= 2
    return np.split(out, np.cumsum(n)[:-1])


def _runs(flags: np.ndarray) -> list[int]:
    """First and length of each run of true flags, one after the other."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return np.c_[edge[::2], edge[1::2] - edge[::2]].ravel().tolist()


def _count_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, packed, times, d1, d2), bucket after bucket, to (key, d1, d2, runs) of those with repeated windows."""

    def count(x: pd.DataFrame) -> pd.DataFrame:
        flags = repeated_windows([p.encode() for p in x["packed"]], x["times"].to_numpy())
        x = x[["key", "d1", "d2"]].assign(runs=[_runs(f) for f in flags])
        return x[[len(r) > 0 for r in x["runs"]]]

    rest = None
    for batch in batches:
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rest) >= AT_ONCE:
            key = rest["key"].to_numpy()
            if ends := int(np.flatnonzero(key != key[-1]).max(initial=-1)) + 1:
                yield count(rest.iloc[:ends])
                rest = rest.iloc[ends:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield count(rest)


def _split(gram: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """For rows (key, d1, d2, times, packed): the super-k-mers by longer grams inside each, as (p, p1, p2, times, at, key, packed)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, at, packed, owners = [], [], [], []
        for i, text in enumerate(batch.column(4).to_pylist()):
            words = words_of(text)
            for key, s, n, _ in zip(*(x.tolist() for x in super_kmers(words, WINDOW, gram)), strict=True):
                keys.append(key)
                at.append(s)
                packed.append(b" ".join(words[s : s + n + WINDOW - 1]).decode())
                owners.append(i)
        to = pa.array(owners, pa.int32())
        return pa.RecordBatch.from_arrays([*(batch.column(i).take(to) for i in range(4)), pa.array(at, pa.int32()), pa.array(keys, pa.int64()), pa.array(packed, pa.string())], names=["p", "p1", "p2", "times", "at", "key", "packed"])

    return run


def _digests(df: DataFrame) -> DataFrame:
    return df.withColumns({"d1": F.xxhash64("packed"), "d2": F.xxhash64(F.lit(7), "packed")})


def _marks(sums: DataFrame, longer: tuple[int, ...]) -> DataFrame:
    """(key, d1, d2, runs) of the super-k-mers with repeated windows. sums (key, d1, d2, packed, times, hot): different super-k-mers;
    hot ones are of buckets that are partitioned anew, by the first of the longer grams."""
    of = ["key", "d1", "d2"]
    calm = sums.where("not hot").select(*of, "times", "packed").repartition("key").sortWithinPartitions("key")
    marks = calm.mapInPandas(_count_buckets, "key long, d1 long, d2 long, runs array<int>")
    if not longer:
        return marks
    parts = _digests(map_arrow(sums.where("hot").select(*of, "times", "packed"), _split(longer[0]), "p long, p1 long, p2 long, times long, at int, key long, packed string"))
    inner = parts.groupBy(*of, "packed").agg(F.sum("times").alias("times"))
    often = inner.groupBy("key").agg(F.sum("times").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    hot = F.col("kinds") > HOT if len(longer) > 1 else F.lit(False)
    found = _marks(inner.join(often, "key").select(*of, "packed", "times", hot.alias("hot")), longer[1:])
    moved = F.transform("runs", lambda x, i: x + F.when(i % 2 == 0, F.col("at")).otherwise(0))  # runs are (first, length) pairs
    back = parts.select("p", "p1", "p2", "at", *of).join(found, of).groupBy("p", "p1", "p2").agg(F.flatten(F.collect_list(moved)).alias("runs"))
    return marks.unionByName(back.select(F.col("p").alias("key"), F.col("p1").alias("d1"), F.col("p2").alias("d2"), "runs"))


def covered(n: int, found: list[dict]) -> np.ndarray:
    """Which of n words lie in a repeated window. found: super-k-mers' starts and runs of windows."""
    edge = np.zeros(n + 1, np.int32)
    for x in found:
        for a, k in zip(x["runs"][::2], x["runs"][1::2], strict=True):
            edge[x["start"] + a] += 1
            edge[x["start"] + a + k + WINDOW - 1] -= 1
    return np.cumsum(edge[:n]) > 0


def mark_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, found) for each row: found lists the super-k-mers with repeated windows.

    Ids are integers. Null and short texts have none. Repeated rows repeat each other's windows. Rows are told apart by id and a hash
    of the text, so repeated ids and null ids do no harm; only rows alike in both meet in one task.
    """
    no_id = F.lit(-(1 << 63))
    kept = docs.select(F.coalesce(F.col(id_col).cast("long"), no_id).alias("did"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    rows = map_arrow(kept, _rows, "key long, did long, th long, start int, n int, said int")
    # Kept as a table, so that the join below deals both sides itself and Spark can split a bucket that is in many rows.
    counted = rows.groupBy("key").agg(F.count("*").alias("times"), F.min("said").alias("a"), F.max("said").alias("b")).where("times > 1")
    often = cut(counted.select("key", ((F.col("times") > HOT) & (F.col("a") != F.col("b"))).alias("hot")))
    flagged = rows.join(often, "key").select("did", "th", F.struct("key", "start", "n", "hot").alias("x"))
    of_doc = cut(flagged.groupBy("did", "th").agg(F.collect_set("x").alias("own")))
    texts = kept.repartition("did", "th")  # dealt once: both joins reuse it
    sent = map_arrow(texts.join(of_doc, ["did", "th"]).select("did", "th", "text", "own"), _pack, "did long, th long, start int, key long, hot boolean, packed string")
    sent = _digests(sent)
    sums = sent.groupBy("key", "d1", "d2", "packed").agg(F.count("*").alias("times"), F.bool_or("hot").alias("hot"))
    marks = _marks(sums, LONGER)
    places = sent.select("did", "th", "start", "key", "d1", "d2").join(marks, ["key", "d1", "d2"])
    found = places.groupBy("did", "th").agg(F.collect_set(F.struct("start", "runs")).alias("found"))
    return texts.join(found, ["did", "th"], "left").select(F.when(F.col("did") != no_id, F.col("did")).alias("doc_id"), "text", "found")


def digest_of_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, n_words, n_removed, kept_sha256)."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = words_of(text)
            gone = covered(len(words), found or [])
            kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x] if gone.any() else words
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        n, removed, sha = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    marked = mark_repeats(docs, id_col, text_col)
    return map_arrow(marked, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_removed): the texts without the words of repeated windows, joined by one space; a text that loses none, also an
    empty or null one, stays as it is. Rows, ids and ties as in mark_repeats; each row is judged on the input."""

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts = [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = words_of(text)
            gone = covered(len(words), found or [])
            counts.append(int(gone.sum()))
            texts.append(b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x).decode() if counts[-1] else text)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["doc_id", "text", "n_removed"])

    marked = mark_repeats(docs, id_col, text_col)
    return map_arrow(marked, strip, "doc_id long, text string, n_removed long")
