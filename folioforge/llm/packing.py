"""Bounded-space online packing of tokenised documents into sequences.

Each partition keeps OPEN windows. The next piece goes to the fullest window that still holds it. When none does, the
fullest window is filled up with a cut of the piece, unless its gap is below MIN_CUT, and emitted. What the
partitions leave open is merged at the end, whole windows into each other, in groups of MERGED partitions.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SEQUENCE, END_ID = 2048, 1
#: Open windows a partition; shortest gap that is filled by a cut; partitions whose leftovers meet.
OPEN, MIN_CUT, MERGED = 8, 16, 32
#: Entries of a worker's cache of chunk ids; it is emptied when full.
CACHED = 400_000
TOKENIZER = "byte_bpe_50k"
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokens(dict):
    """Texts to their ids as little-endian unsigned 32-bit bytes.

    The tokenizer never merges across the start of a single space between two other characters, so the ids of such
    chunks are looked up by chunk. Texts with longer runs of white space are encoded whole. A text that holds a special
    token's string goes to the library of the JSON file, whose reading of it counts.
    """

    def __init__(self, name: str) -> None:
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.white = regex.compile(r"\s\s").search

    def __missing__(self, chunk: str) -> bytes:
        ids = array("I", self.plain(" " + chunk)).tobytes()
        if len(self) >= CACHED:
            self.clear()
        self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.white(text) or text[-1:] == " ":
            return array("I", self.plain(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.plain(first)).tobytes() + b"".join(map(self.__getitem__, rest))


_tokens: dict[str, Tokens] = {}


def tokens(name: str = TOKENIZER) -> Tokens:
    """The worker's own, made once."""
    return _tokens.get(name) or _tokens.setdefault(name, Tokens(name))


class Windows:
    """The open windows of a partition: (gap, number, pieces), the fullest first. A piece is (doc_id, start, length, crc32, doc_tokens)."""

    def __init__(self, size: int = SEQUENCE, keep: int = OPEN, min_cut: int = MIN_CUT) -> None:
        self.size, self.keep, self.min_cut = size, keep, min_cut
        self.open: list[tuple[int, int, list]] = []
        self.number = 0
        self.full: list[tuple[int, list]] = []

    def _put(self, k: int | None, piece: tuple) -> None:
        """Into window k, or a new one. A full window leaves."""
        if k is None:
            gap, number, pieces = self.size, self.number, []
            self.number += 1
        else:
            gap, number, pieces = self.open.pop(k)
        pieces.append(piece)
        if gap := gap - piece[2]:
            self.open.insert(bisect_left(self.open, (gap, number)), (gap, number, pieces))
        else:
            self.full.append((number, pieces))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // 4, 0

        def piece(n: int) -> tuple:
            return doc_id, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), total

        while at < total:
            n = min(total - at, self.size)
            k = bisect_left(self.open, (n,))
            if k < len(self.open):
                self._put(k, piece(n))
            elif len(self.open) < self.keep:
                self._put(None, piece(n))
            elif (n < self.size or self.min_cut <= 1) and self.open[0][0] >= self.min_cut:
                n = self.open[0][0]
                self._put(0, piece(n))
            elif n == self.size:
                self._put(None, piece(n))
            else:
                _, number, pieces = self.open.pop(0)
                self.full.append((number, pieces))
                continue
            at += n


def _pack(size: int, keep: int, min_cut: int, tokenizer: str, at_once: int = 4000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, windows, ids = TaskContext.get().partitionId(), Windows(size, keep, min_cut), tokens(tokenizer)
        end = array("I", [END_ID]).tobytes()

        def rows(ready: list[tuple[int, list]], open_: bool) -> pa.RecordBatch:
            out = []
            for number, pieces in ready:
                offset = 0
                for p in pieces:
                    out.append((*p, (part << 32) + number, offset, part if open_ else None))
                    offset += p[2]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                windows.add(doc_id, (ids.ids(text) if text else b"") + end)
                if len(windows.full) >= at_once:
                    yield rows(windows.full, False)
                    windows.full = []
        if windows.full:
            yield rows(windows.full, False)
        if windows.open:
            yield rows([(number, pieces) for _, number, pieces in windows.open], True)

    return run


def _merge(size: int):
    """Windows that were left open, put whole into each other: the longest first, each to the fullest that holds it."""

    def run(x: pd.DataFrame) -> pd.DataFrame:
        lengths = x.groupby("sequence_id")["length"].sum().sort_values(ascending=False, kind="stable")
        gaps: list[tuple[int, int]] = []  # sorted: gap, sequence
        moved: dict[int, tuple[int, int]] = {}
        for sequence, n in lengths.items():
            k = bisect_left(gaps, (n, -1))
            gap, to = gaps.pop(k) if k < len(gaps) else (size, sequence)
            moved[sequence] = (to, size - gap)
            if gap - n:
                gaps.insert(bisect_left(gaps, (gap - n, to)), (gap - n, to))
        to = x["sequence_id"].map(lambda s: moved[s][0])
        return x.assign(offset=x["offset"] + x["sequence_id"].map(lambda s: moved[s][1]), sequence_id=to)[[c.split()[0] for c in COLUMNS.split(", ")]]

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, keep: int = OPEN, min_cut: int = MIN_CUT, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row for each piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A row of docs gives its ids and the end id, so null and empty texts give one token. Repeated rows are packed as
    often as they stand, rows without an id under a null id. An empty table gives no piece. Offsets of a sequence run
    from 0 without a gap; what is left to its size is padding.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    done = cut(rows.mapInArrow(_pack(size, keep, min_cut, tokenizer), COLUMNS + ", part long"))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    left = done.where("part is not null").groupBy(F.floor(F.col("part") / MERGED).alias("met")).applyInPandas(_merge(size), COLUMNS)
    return done.where("part is null").select(*names).unionByName(left)
