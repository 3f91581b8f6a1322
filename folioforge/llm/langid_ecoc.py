"""Language identification by error-correcting output codes.

Each language has a codeword. One binary classifier over hashed byte n-grams predicts each of its bits; a text belongs to the language whose
codeword loses least, each bit's loss weighted by how well its classifier did in training. A text whose two
nearest codewords lose about the same is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_arrow

#: Bounds of the training sample: documents for each language; documents in all, beyond which each language gives fewer, though FEWEST at least.
PER_LANGUAGE, IN_ALL, FEWEST = 300, 60_000, 20
#: Languages whose counts are sent to every task.
FEW_LANGUAGES = 100_000
#: Parts into which a sampled text is cut, and the characters of a part at least; together they are the whole text.
PIECES, PIECE_CHARS = 3, 500
BINS_BITS = 12
BINS = 1 << BINS_BITS
#: Bytes whose n-grams are counted at once.
AT_ONCE = 1 << 20
#: Probability of the runner-up, against the winner's, from which a text counts as ambiguous.
AMBIGUOUS = 0.5
HELD_OUT = 1
NO_LANGUAGE = "und"
_letter = regex.compile(r"\p{L}").search


def counts(text: str) -> np.ndarray:
    """Hashed counts of the two- and three-byte n-grams of the lower-cased text, any length, in bounded memory."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    out = np.zeros(BINS, np.int64)
    for at in range(0, len(data), AT_ONCE):
        b = data[at : at + AT_ONCE + 2].astype(np.uint32)
        two = b[:-1] << 8 | b[1:] if len(data) > 1 else b
        three = two[:-1] << 8 | b[2:] if len(b) > 2 else two[:0]
        for grams in (two[:AT_ONCE], three):  # each from its own first byte, once
            out += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(32 - BINS_BITS), minlength=BINS)
    return out


def _scaled(counted: np.ndarray) -> np.ndarray:
    x = np.sqrt(counted.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def codewords(k: int) -> np.ndarray:
    """k codewords of -1 and 1: every split of the languages in two up to 7 of them, else the best of some random codes."""
    if k < 2:
        return np.ones((k, 1), np.float32)
    if k <= 7:
        bits = (np.arange(1, 1 << (k - 1))[None, :] >> np.arange(k)[:, None]) & 1
        return (bits * 2 - 1).astype(np.float32)
    rng, n = np.random.default_rng(0), int(np.ceil(10 * np.log2(k)))
    codes = [rng.choice(np.array([-1, 1], np.float32), (k, n)) for _ in range(50)]
    return max(codes, key=lambda m: np.min(n - (m @ m.T) + 2 * n * np.eye(k)))


class Model:
    """Learned languages with their codewords, and the linear classifiers of the bits."""

    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 8.0, decay: float = 1e-4) -> None:
        """x: scaled counts; y: places in languages."""
        self.languages, self.code = languages, codewords(len(languages))
        self.weights, self.bias = np.zeros((BINS, self.code.shape[1]), np.float32), np.zeros(self.code.shape[1], np.float32)
        if len(languages) < 2:
            self.bit_weights = np.ones(self.code.shape[1], np.float32)
            return
        target = self.code[y]
        share = (1 / np.maximum(np.bincount(y, minlength=len(languages)), 1))[y]
        share = (share / share.sum())[:, None].astype(np.float32)  # languages weigh the same
        speed = 0.0
        for _ in range(rounds):
            slope = -target / (1 + np.exp(np.clip(target * (x @ self.weights + self.bias), -30, 30))) * share
            speed = 0.9 * speed - rate * (x.T @ slope + decay * self.weights)
            self.weights += speed
            self.bias -= rate * slope.sum(axis=0)
        right = ((np.sign(x @ self.weights + self.bias) == target) * share).sum(axis=0)
        self.bit_weights = np.clip((right - 0.5) * 2, 0.05, 1).astype(np.float32)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the nearest codeword, its probability, and whether the text is ambiguous."""
        margin = np.clip(x @ self.weights + self.bias, -30, 30)
        loss = (self.bit_weights * np.log1p(np.exp(-self.code[None] * margin[:, None, :]))).sum(axis=2)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        top = p[np.arange(len(p)), best]
        p[np.arange(len(p)), best] = 0
        return best, top, p.max(axis=1, initial=0) >= AMBIGUOUS * top


def parts_of(text: str) -> list[str]:
    """The whole text in up to PIECES parts of about the same length, none shorter than PIECE_CHARS unless the text is."""
    n = max(1, min(PIECES, len(text) // PIECE_CHARS))
    return [text[i * len(text) // n : (i + 1) * len(text) // n] for i in range(n)]


def _count_parts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, h, text) to (lang, h, counted): the counts of each part, as little-endian 32-bit numbers."""
    found = [counts(p).astype("<u4").tobytes() for x in batch.column(2).to_pylist() for p in parts_of(x)]
    to = pa.array([i for i, x in enumerate(batch.column(2).to_pylist()) for _ in parts_of(x)], pa.int32())
    return pa.RecordBatch.from_arrays([batch.column(0).take(to), batch.column(1).take(to), pa.array(found, pa.binary())], names=["lang", "h", "counted"])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> Model:
    """A model of the rows outside the held-out fold, of every language that these hold. Whole texts of a bounded sample are counted where they are,
    about per_language documents of each language, chosen by hash, about in_all together; only their counts reach the driver."""
    rows = docs.select(crc_mod("doc_id", 3).alias("fold"), "text", "lang", F.xxhash64(F.lit("sample"), "doc_id").alias("h"))
    rows = rows.where(F.coalesce(F.col("fold") != HELD_OUT, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.count()
    per = max(FEWEST, min(per_language, in_all // max(1, languages)))
    # A few languages hold all rows, so a join by language would deal their texts to a few tasks; their counts are sent to all instead.
    chosen = rows.join(F.broadcast(sizes) if languages <= FEW_LANGUAGES else sizes, "lang").where(F.pmod("h", F.lit(1 << 24)) * F.col("n") < F.lit(float(per << 24)))
    found = sorted((r["lang"], r["h"], bytes(r["counted"])) for r in map_arrow(chosen.select("lang", "h", "text"), _count_parts, "lang string, h long, counted binary").toLocalIterator())
    languages = sorted({r[0] for r in found})
    if not languages:
        return Model([], np.zeros((0, BINS), np.float32), np.zeros(0, np.int64))
    place = {k: i for i, k in enumerate(languages)}
    return Model(languages, _scaled(np.array([np.frombuffer(r[2], "<u4") for r in found])), np.array([place[r[0]] for r in found]))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, held_out, lang_pred, score, ambiguous).

    `und` with score 0 where the text is null, empty or without a letter, or nothing was learned. held_out is false for a null
    id. Repeated rows are judged alike. Whole texts are read, once, without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lang, score, unsure = [NO_LANGUAGE] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            able = [i for i, t in enumerate(texts) if t and model.languages and _letter(t)]
            for a in range(0, len(able), 256):
                part = able[a : a + 256]
                best, p, close = model.decode(_scaled(np.array([counts(texts[i]) for i in part])))
                score[part], unsure[part] = p, close
                for i, k in zip(part, best, strict=True):
                    lang[i] = model.languages[k]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(crc_mod(id_col, 3) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, ambiguous boolean")
