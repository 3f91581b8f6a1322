"""Benchmark passages in documents, found through an embedding of edit distance into Hamming distance.

A document holds an item of n words if some run of its words can be turned into the item by at most n // 5 insertions,
deletions or changes of a word. Of the item-sized windows of a document, those that can hold nothing are left out
first, without loss: n // 5 + 1 disjoint seeds of an item can't all be hit by n // 5 edits, so one stands unchanged in the
document, at most n // 5 words off its place. All other windows are embedded by random walks (CGK): a walk copies the word at its
position again and again, and a shared random bit of step and word tells whether it moves on, so two texts that differ in few edits soon
walk together again. Each repetition samples a few places of a walk; windows and items that agree on them are candidates.
Exact edit distance then decides. An unchanged passage agrees everywhere and is always found.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One edit for so many words of an item: similarity of at least 0.8.
WORDS_PER_EDIT = 5
#: Walks, repetitions for each walk, and places sampled in a repetition. Measured recall of passages with n // 5 random edits: see the tests.
WALKS, REPEATS, SAMPLED = 6, 24, 3
LONGEST_SEED = 4
#: Benchmark text that is sent to every task at once; a larger benchmark goes in blocks of this size.
BLOCK_BYTES = 16 << 20
#: Windows embedded at once.
AT_ONCE = 20_000
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_P, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SCHEMA = "doc_id long, item_id long, item_words long, distance long, end_word long"


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return _WORD.findall((text or "").encode("utf-8", "replace").lower())


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def best_match(item: np.ndarray, run: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance between item and any run within run, and where the first such run ends."""
    n = len(item)
    row = np.arange(n + 1)
    best, end = n, 0
    steps = np.arange(n + 1)
    for j, word in enumerate(run, 1):
        new = np.empty(n + 1, np.int64)
        new[0] = 0
        new[1:] = np.minimum(row[:-1] + (item != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
        if row[n] < best:
            best, end = int(row[n]), j
    return best, end


class Items:
    """A block of benchmark items with their seeds and the signatures of their walks."""

    def __init__(self, items: Iterable[tuple[int, str | None]], walks: int = WALKS, repeats: int = REPEATS, sampled: int = SAMPLED) -> None:
        self.sampled = sampled
        self.items = [(i, hashes_of(w)) for i, t in items if (w := words_of(t))]
        self.edits = [len(w) // WORDS_PER_EDIT for _, w in self.items]
        self.walks, self.repeats = walks, repeats
        seeds: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # by length: hash, item, place
        for k, (_, w) in enumerate(self.items):
            n, parts = len(w), self.edits[k] + 1
            q = min(LONGEST_SEED, n // parts)
            g = self._grams(w, q)
            for p in range(parts):
                at = p * n // parts
                seeds[q].append((int(g[at]), k, at))
        self.seeds = {}
        for q, rows in seeds.items():
            rows.sort()
            self.seeds[q] = np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.int64)
        self.maybe = {q: self._bits(h) for q, (h, _) in self.seeds.items()}
        sizes = defaultdict(list)
        for k, (_, w) in enumerate(self.items):
            sizes[len(w)].append(k)
        self.by_size = {n: np.array(ks) for n, ks in sizes.items()}
        self.index = {}
        for n, ks in self.by_size.items():
            marks = self.signatures(np.stack([self.items[k][1] for k in ks]))  # (items, walks * repeats)
            flat = marks.ravel()
            order = np.argsort(flat, kind="stable")
            self.index[n] = flat[order], np.repeat(ks, marks.shape[1])[order]

    @staticmethod
    def _grams(h: np.ndarray, q: int) -> np.ndarray:
        m = len(h) - q + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        g = h[:m].copy()
        for i in range(1, q):
            g *= _P
            g += h[i : m + i]
        return _mix(g)

    @staticmethod
    def _bits(h: np.ndarray) -> np.ndarray:
        """One byte for each value of 20 bits: whether a seed has it."""
        out = np.zeros(1 << 20, bool)
        out[(h >> np.uint64(44)).astype(np.int64)] = True
        return out

    def signatures(self, windows: np.ndarray) -> np.ndarray:
        """For windows of n words each: a 64-bit signature for each repetition of each walk."""
        m, n = windows.shape
        padded = np.concatenate([windows, np.zeros((m, 1), np.uint64)], axis=1)
        rows, out = np.arange(m), np.empty((m, self.walks * self.repeats), np.uint64)
        for walk in range(self.walks):
            rng = np.random.default_rng([walk, n])
            at = np.zeros(m, np.int64)
            steps = 3 * n
            copied = np.empty((steps, m), np.uint64)
            salts = rng.integers(0, 1 << 63, steps, dtype=np.uint64)
            for s in range(steps):
                word = padded[rows, at]
                copied[s] = word
                at = np.minimum(at + (_mix(word + salts[s]) >> np.uint64(63)).astype(np.int64), n)
            for r in range(self.repeats):
                mark = np.full(m, np.uint64(walk * self.repeats + r + 1))
                for s in rng.integers(0, 2 * n, self.sampled):
                    mark = _mix(mark * _P + copied[s])
                out[:, walk * self.repeats + r] = mark
        return out

    def windows(self, h: np.ndarray) -> np.ndarray:
        """(item, first word) of the windows that seeds leave over, without repeats. Windows may reach beyond the text."""
        found = []
        for q, (seeds, places) in self.seeds.items():
            g = self._grams(h, q)
            hits = np.flatnonzero(self.maybe[q][(g >> np.uint64(44)).astype(np.int64)])
            if not len(hits):
                continue
            lo, hi = np.searchsorted(seeds, g[hits], "left"), np.searchsorted(seeds, g[hits], "right")
            counts = hi - lo
            which = np.repeat(lo, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            pos = np.repeat(hits, counts)
            found.append(np.c_[places[which, 0], pos - places[which, 1]])
        if not found:
            return np.zeros((0, 2), np.int64)
        out = np.unique(np.concatenate(found), axis=0)
        slack = np.array(self.edits)[out[:, 0]]
        spread = np.repeat(out, 2 * slack + 1, axis=0)
        spread[:, 1] += np.arange(len(spread)) - np.repeat(np.cumsum(2 * slack + 1) - 2 * slack - 1, 2 * slack + 1) - np.repeat(slack, 2 * slack + 1)
        return np.unique(spread, axis=0)

    def candidates(self, texts: list[np.ndarray], wanted: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(text, item, first word): windows of the texts that share a signature with an item of their size."""
        sizes = np.array([len(w) for _, w in self.items])
        own = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
        allof = np.concatenate(wanted) if wanted else np.zeros((0, 2), np.int64)
        by = sizes[allof[:, 0]] if len(allof) else np.zeros(0, np.int64)
        for n in np.unique(by).tolist():
            pick = np.flatnonzero(by == n)
            spots = np.unique(np.c_[own[pick], allof[pick, 1]], axis=0)
            flat, ks = self.index[n]
            for a in range(0, len(spots), AT_ONCE):
                part = spots[a : a + AT_ONCE]
                rows = np.zeros((len(part), n), np.uint64)
                for i, (t, s) in enumerate(part.tolist()):
                    piece = texts[t][max(0, s) : max(0, s + n)]
                    rows[i, max(0, -s) : max(0, -s) + len(piece)] = piece
                marks = self.signatures(rows)
                lo = np.searchsorted(flat, marks.ravel(), "left")
                hi = np.searchsorted(flat, marks.ravel(), "right")
                hit = np.flatnonzero(hi > lo)
                pairs = {(int(h // marks.shape[1]), int(k)) for h in hit for k in ks[lo[h] : hi[h]]}
                for i, k in sorted(pairs):
                    yield int(part[i, 0]), k, int(part[i, 1])

    def matches(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, end word), the best place of each item that a text holds."""
        wanted = [self.windows(h) for h in texts]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for t, k, s in self.candidates(texts, wanted):
            n, edits = len(self.items[k][1]), self.edits[k]
            if s <= done.get((t, k), -1 << 60) + edits:
                continue  # the run that was looked at holds this window's
            lo, hi = max(0, s - edits), max(0, s + n + 2 * edits)
            done[t, k] = s
            distance, end = best_match(self.items[k][1], texts[t][lo:hi])
            if distance <= edits and ((t, k) not in best or (distance, lo + end) < best[t, k]):
                best[t, k] = distance, lo + end
        return [(t, k, *x) for (t, k), x in sorted(best.items())]


def _blocks(benchmark: DataFrame) -> Iterator[tuple[tuple[int, str], ...]]:
    """The benchmark in parts of at most about BLOCK_BYTES, one at a time on the driver."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for b in range(n):
        yield tuple(tuple(r) for r in benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect())


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item that it holds: (doc_id, item_id, item_words, distance, end_word), the best place.

    end_word is the place in the document, from 1, of the last word of the first best run. Null and empty texts and
    items hold and are held by nothing. Repeated documents and items give repeated rows. No row crosses the network:
    each task reads its documents once for each block of the benchmark.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    found = None
    for block in _blocks(items):
        part = rows.mapInArrow(_search(block), SCHEMA)
        found = part if found is None else found.unionByName(part)
    return rows.sparkSession.createDataFrame([], SCHEMA) if found is None else found


@lru_cache(maxsize=2)
def _made(block: tuple[tuple[int, str], ...]) -> Items:
    """A worker's own, made once for all its tasks."""
    return Items(block)


def _search(block: tuple[tuple[int, str], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _made(block)
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), 256):
                own = [hashes_of(words_of(x)) for x in texts[a : a + 256]]
                for t, k, distance, end in items.matches(own):
                    out.append((batch.column(0)[a + t].as_py(), items.items[k][0], len(items.items[k][1]), distance, end))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less the rows whose text holds an item. Judged in the pass that reads the row, so ids play no part."""
    at = docs.columns.index(text_col)

    def keep(block: tuple[tuple[int, str], ...]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, held = batch.column(at).to_pylist(), set()
                for a in range(0, len(texts), 256):
                    held |= {a + t for t, *_ in _made(block).matches([hashes_of(words_of(x)) for x in texts[a : a + 256]])}
                yield batch.filter(pa.array([i not in held for i in range(len(texts))]))

        return run

    for block in _blocks(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
