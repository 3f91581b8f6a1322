"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bit positions has a non-zero vector of three bits. The table of a non-zero vector v drops the positions
whose vector is orthogonal to v; two positions always have some v orthogonal to both, so a pair that differs in two bits
or fewer agrees on all kept bits of one of the 7 tables. The positions that a table drops are cut into three parts; a pair
with at most two different bits agrees on one part whole. So 21 keys a fingerprint meet every pair within the radius: no
pair is missed, whatever the data.

For a wider radius r the vectors have r + 1 bits; the dropped positions are then not cut further. Where there are fewer positions than vectors,
only vectors with the highest bit are dealt: each table then keeps half of the positions, and the one table that would keep all, which no pair needs,
goes. 64 positions and r = 6 give 126 tables of 32 kept bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, map_arrow
from .components import connected_components

RADIUS, SEED, WORDS = 2, 42, 3
#: Groups of up to so many fingerprints are compared in a search in width, larger ones (within RADIUS) by looking up each one's neighbours.
BY_PAIRS = 2048


@lru_cache(maxsize=8)
def masks(radius: int, parts: int, positions: tuple[int, ...] = tuple(range(64))) -> tuple[tuple[int, tuple[int, ...]], ...]:
    """For each key over some bit positions: the mask that it keeps of them, and the positions still free under it."""
    n, half = len(positions), 1 << radius
    few = n < 2 * half - 1
    vector = {p: half + i * half // n if few else i % (2 * half - 1) + 1 for i, p in enumerate(positions)}
    out = []
    for v in range(1, 2 * half):
        if few and v == half:
            continue
        kept = [i for i in positions if (vector[i] & v).bit_count() & 1]
        dropped = [i for i in positions if i not in kept]
        for part in range(parts):
            held = {*kept, *(dropped[part::parts] if parts > 1 else ())}
            out.append((sum(1 << i for i in held), tuple(i for i in dropped if i not in held)))
    return tuple(out)


MASKS = masks(RADIUS, RADIUS + 1)
#: Differing bits within which the pipeline's stage counts documents as near-duplicates; see keep_one.
WIDE = 6


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 for a text without words, or null.

    Words are runs of non-white ASCII-wise characters after lower-casing A-Z; shingles are three words, repeats included.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), max(1, len(words) - WORDS + 1)
    for at in range(0, n, 1 << 16):  # bounded memory for a text of any length
        part = words[at : at + (1 << 16) + WORDS - 1]
        if len(part) >= WORDS:
            hashes = [digest(b" ".join(x), SEED) for x in zip(part, part[1:], part[2:])]
        else:
            hashes = [digest(b" ".join(part), SEED)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", fp_col: str = "fp") -> DataFrame:
    """docs with the fingerprint as a signed 64-bit number."""
    at = docs.columns.index(text_col)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x) for x in batch.column(at).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=[*batch.schema.names, fp_col])

    from pyspark.sql.types import LongType, StructField, StructType

    return map_arrow(docs, add, StructType([*docs.schema.fields, StructField(fp_col, LongType())]))


def _reached(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each of some distinct fingerprints: one fingerprint of its linked set, by search in width.

    What a fingerprint reaches leaves the set that is still searched, so a group of near copies is soon done.
    """
    root, left = np.arange(len(fps)), np.arange(len(fps))
    while len(left):
        start, left = left[0], left[1:]
        queue = [start]
        while queue and len(left):
            near = np.bitwise_count(fps[left] ^ fps[queue.pop()]) <= radius
            if near.any():
                root[left[near]] = start
                queue += left[near].tolist()
                left = left[~near]
    return fps[root]


def _roots(fps: np.ndarray, free: tuple[int, ...], radius: int = RADIUS) -> np.ndarray:
    """The same for fingerprints that differ in free positions only: a large group within RADIUS looks up each one's neighbours instead."""
    n = len(fps)
    if n <= BY_PAIRS or radius > RADIUS:
        return _reached(fps, radius)
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    order = np.argsort(fps)
    ranked = fps[order]
    one = [np.uint64(1 << i) for i in free]
    for flip in [*one, *(a | b for k, a in enumerate(one) for b in one[k + 1 :])]:
        to = ranked ^ flip
        at = np.minimum(np.searchsorted(ranked, to), n - 1)
        for i in np.flatnonzero((ranked[at] == to) & (at > np.arange(n))):
            if (a := find(int(order[i]))) != (b := find(int(order[at[i]]))):
                parent[max(a, b)] = min(a, b)
    return fps[[find(i) for i in range(n)]]


def _links_of(radius: int, keys: tuple) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """From rows (k, held, fp) in the order of (k, held): a link from each fingerprint to one of its linked set in the group."""

    def links(x: pd.DataFrame) -> pd.DataFrame:
        k, held, fp = x["k"].to_numpy(), x["held"].to_numpy(), x["fp"].to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (held[1:] != held[:-1])])
        sizes = np.diff(np.r_[starts, len(k)])
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = [fp[two]], [fp[two + 1]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            own = fp[s : s + n]
            root = _roots(own, keys[k[s]][1], radius)
            a.append(own[root != own])
            b.append(root[root != own])
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            last = batch.iloc[-1]
            ends = int(((batch["k"] != last["k"]) | (batch["held"] != last["held"])).to_numpy().nonzero()[0].max(initial=-1)) + 1
            if ends:
                yield links(pd.concat([*rest, batch.iloc[:ends]], ignore_index=True))
                rest = [batch.iloc[ends:]]
            elif rest and (rest[0]["k"].iloc[0] != last["k"] or rest[0]["held"].iloc[0] != last["held"]):
                yield links(pd.concat(rest, ignore_index=True))
                rest = [batch]
            else:
                rest.append(batch)
        if rest:
            yield links(pd.concat(rest, ignore_index=True))

    return run


def fingerprint_components(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for each row of fps(fp), distinct fingerprints: root is the smallest fingerprint reached over links.

    Fingerprints are dealt out before each becomes its many keys, since Spark would make few tasks of rows so short.
    """
    own = MASKS if radius == RADIUS else masks(radius, 1)
    one = fps.select("fp")
    dealt = one.repartition(int(one.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    keys = dealt.select("fp", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("held")) for k, (m, _) in enumerate(own)))).alias("x")).select("x.k", "x.held", "fp")
    links = keys.repartition("k", "held").sortWithinPartitions("k", "held", "fp").mapInPandas(_links_of(radius, own), "a long, b long")
    found = connected_components(links)
    return one.join(found.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, fingerprint, component_id).

    Null and empty texts have fingerprint zero and link like any other. Repeated rows stay repeated. component_id is the
    smallest non-null id reachable, null where no row of the component has an id. Copies meet as one fingerprint, so no
    group of copies is ever gathered.
    """
    rows = cut(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "fp"))
    of_fp = component_of_fp(rows)
    return rows.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def component_of_fp(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for each distinct fp of rows (doc_id, fp)."""
    least = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    of_root = cut(fingerprint_components(least, radius).join(least, "fp"))
    return of_root.join(of_root.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = WIDE) -> DataFrame:
    """One row of each component, with all columns of docs: that with the smallest id, null ids after all others.

    Of rows with that id the one with the smallest hash of its text stays; of rows alike in id and text, the first in the order of all
    columns that can be ordered. Null and empty texts are one component. Near-duplicates are texts whose fingerprints differ in `radius` bits or fewer.
    Fingerprints are computed once; the text crosses the network once, to meet the decision on its row.
    """
    key = [F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__th")]
    rows = cut(with_fingerprints(docs.select(*key, F.col(text_col).alias("text")), "text", "fp").groupBy("__id", "__th", "fp").agg(F.count("*").alias("times")))
    root = component_of_fp(rows.select(F.col("__id").alias("doc_id"), "fp"), radius).select("fp", "root")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__th", "times")).alias("x")
    stay = rows.join(root, "fp").groupBy("root").agg(first).select(F.col("x.__id").alias("__id"), F.col("x.__th").alias("__th"), F.col("x.times").alias("__n_alike"))
    # All columns of docs travel as one struct, so that no name of theirs can clash.
    there = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("i"), F.xxhash64(text_col).alias("t"))
    left = there.join(stay, F.col("i").eqNullSafe(F.col("__id")) & (F.col("t") == F.col("__th")))
    order = [F.col("row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    again = left.where("__n_alike > 1").withColumn("r", F.row_number().over(Window.partitionBy("i", "t").orderBy(*order))).where("r = 1")
    return left.where("__n_alike = 1").select("row").unionByName(again.select("row")).select("row.*")
