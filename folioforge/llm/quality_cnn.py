"""A quality score from a byte-level convolutional network, written in numpy.

Bytes have learned vectors. Learned filters slide over them in chunks that overlap by the filters' width, so no place of a
document is left out; each chunk keeps its filters' largest answers and turns them into one logit. The mean and the
least logit of all chunks make the document's probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod

#: Bytes of a chunk's own places, of a filter, between places; size of a byte's vector; number of filters.
CHUNK, WIDTH, STRIDE, VECTOR, FILTERS = 512, 8, 4, 6, 32
FRAMES = CHUNK // STRIDE
#: Bounds of the training sample: documents of the commoner and of the rarer label, chunks of each document. Batches of training.
COMMON, RARE, PIECES, STEPS = 3000, 1200, 4, 800
HELD_OUT, THRESHOLD = 2, 0.7
#: Chunks that are computed at once.
AT_ONCE = 2048


def chunks(data: bytes) -> np.ndarray:
    """All of data in rows of CHUNK + WIDTH - STRIDE bytes, each CHUNK bytes after the last, padded with zero; one row at least."""
    long = CHUNK + WIDTH - STRIDE
    n = max(1, -(-(len(data) - (WIDTH - STRIDE)) // CHUNK))
    flat = np.zeros(n * CHUNK + WIDTH - STRIDE, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, long)[::CHUNK]


class Network:
    """The learned numbers, and what they say of documents."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.p = {
            "vectors": rng.normal(0, 0.5, (256, VECTOR)),
            "filters": rng.normal(0, (WIDTH * VECTOR) ** -0.5, (WIDTH * VECTOR, FILTERS)),
            "shift": np.zeros(FILTERS),
            "out": rng.normal(0, FILTERS**-0.5, FILTERS),
            "bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.mix = np.array([1.0, 0.0, 0.0])  # of the mean, the least and 1
        self.learned = False

    def _frames(self, rows: np.ndarray) -> np.ndarray:
        """(chunks, frames, bytes of a filter x vector)"""
        x = self.p["vectors"][rows].reshape(len(rows), -1)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * VECTOR, axis=1)[:, :: STRIDE * VECTOR]

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest answer of each filter in each chunk, and where it was."""
        z = (np.ascontiguousarray(self._frames(rows)).reshape(-1, WIDTH * VECTOR) @ self.p["filters"]).reshape(len(rows), FRAMES, FILTERS)
        return z.max(axis=1), z

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.float32)
        for a in range(0, len(rows), AT_ONCE):
            top, _ = self.pooled(rows[a : a + AT_ONCE])
            out[a : a + AT_ONCE] = np.maximum(top + self.p["shift"], 0) @ self.p["out"] + self.p["bias"]
        return out

    def combine(self, logits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A probability for each document from the logits of its chunks."""
        at = np.cumsum(sizes) - sizes
        x = np.c_[np.add.reduceat(logits.astype(np.float64), at) / sizes, np.minimum.reduceat(logits, at), np.ones(len(sizes))]
        return 1 / (1 + np.exp(-np.clip(x @ self.mix, -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 for each text; 0.5 from a network that hasn't learned."""
        if not self.learned or not texts:
            return np.full(len(texts), 0.5)
        rows = [chunks(t) for t in texts]
        sizes = np.array([len(r) for r in rows])
        if sizes.max() > 8 * AT_ONCE:  # a text of many megabytes is taken by itself
            logits = np.concatenate([self.logits(r) for r in rows])
        else:
            logits = self.logits(np.concatenate(rows))
        return self.combine(logits, sizes)

    def fit(self, docs: list[list[bytes]], labels: np.ndarray, steps: int = STEPS, batch: int = 64, rate: float = 4e-3, seed: int = 0) -> Network:
        """docs: pieces of CHUNK bytes of each document. Adam on the mean logit of a document's pieces, then a logistic fit of the mixture."""
        rows = np.concatenate([np.concatenate([chunks(p)[:1] for p in d]) for d in docs])
        sizes = np.array([len(d) for d in docs])
        first = np.cumsum(sizes) - sizes
        rng, step, epochs = np.random.default_rng(seed), 0, -(-steps * batch // len(docs))
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            order = rng.permutation(len(docs))
            for a in range(0, len(order), batch):
                own = order[a : a + batch]
                n = sizes[own]
                which = np.repeat(first[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc, x = np.repeat(np.arange(len(own)), n), rows[which]
                top, z = self.pooled(x)
                where = z.argmax(axis=1)
                act = np.maximum(top + self.p["shift"], 0)
                logit = np.bincount(doc, act @ self.p["out"] + self.p["bias"][0], len(own)) / n
                slope = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[own]) / len(own))[doc] / n[doc]
                back = (slope[:, None] * self.p["out"] * (act > 0)).astype(np.float32)  # (chunks, filters)
                frames = self._frames(x)[np.arange(len(x))[:, None], where]  # (chunks, filters, width x vector)
                g = {"out": slope @ act, "bias": np.array([slope.sum()]), "shift": back.sum(axis=0), "filters": np.einsum("cf,cfw->wf", back, frames)}
                to_bytes = (back[:, :, None] * self.p["filters"].T).reshape(len(x), FILTERS, WIDTH, VECTOR)
                at = x[np.arange(len(x))[:, None, None], (where * STRIDE)[:, :, None] + np.arange(WIDTH)].ravel()
                g["vectors"] = np.stack([np.bincount(at, to_bytes[..., i].ravel(), 256) for i in range(VECTOR)], axis=1)
                step += 1
                for k, d in g.items():
                    m[k] += 0.1 * (d - m[k])
                    v[k] += 0.001 * (d * d - v[k])
                    self.p[k] -= (rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        logits = self.logits(rows)
        x = np.c_[np.add.reduceat(logits.astype(np.float64), first) / sizes, np.minimum.reduceat(logits, first), np.ones(len(sizes))]
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(x @ self.mix, -30, 30)))
            slope = x.T @ (p - labels) / len(docs) + 1e-3 * self.mix * [1, 1, 0]
            curve = (x * (p * (1 - p))[:, None]).T @ x / len(docs) + 1e-3 * np.eye(3)
            self.mix = self.mix - np.linalg.solve(curve, slope)
        self.learned = True
        return self


def fit(docs: DataFrame, labels: DataFrame, common: int = COMMON, rare: int = RARE) -> Network:
    """A network of the labelled rows outside the held-out fold. About so many documents of either label, chosen by hash, give
    PIECES pieces each, spread over the text; nothing else reaches the driver. Scores are for the mix of labels of all labelled rows, not of the sample. Rows without text or label are left out. With one
    label only nothing is learned, and every text scores 0.5."""
    own = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    own = own.where(F.coalesce(crc_mod("doc_id", 4) != HELD_OUT, F.lit(False)) & F.col("quality").isin(0, 1)).withColumn("h", F.xxhash64(F.lit("sample"), "doc_id"))
    sizes = {r["quality"]: r["n"] for r in own.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Network()
    most = max(sizes, key=lambda k: (sizes[k], k))
    rates = {k: min(1.0, (common if k == most else rare) / n) for k, n in sizes.items()}
    share = F.create_map(*(F.lit(v) for k, rate in rates.items() for v in (k, rate)))
    own = own.where(F.pmod("h", F.lit(1 << 24)) < share[F.col("quality")] * (1 << 24))
    data, long = F.col("text").cast("binary"), CHUNK + WIDTH - STRIDE
    room = F.greatest(F.lit(0), F.octet_length("text") - long)
    pieces = F.array_distinct(F.array(*(F.substring(data, (room * i / max(1, PIECES - 1)).cast("int") + 1, F.lit(long)) for i in range(PIECES))))
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(own), "doc_id").select("h", "quality", pieces.alias("pieces"))
    found = sorted((r["h"], r["quality"], [bytes(p) for p in r["pieces"]]) for r in texts.toLocalIterator())
    if len({r[1] for r in found}) < 2:
        return Network()
    network = Network().fit([r[2] for r in found], np.array([r[1] for r in found], np.float64))
    network.mix[2] -= np.log(rates[1] / rates[0])  # the sample's mix of labels back to that of all
    return network


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs: (doc_id, held_out, score, predicted).

    Null texts are scored as empty ones; held_out is false for a null id; repeated rows are scored alike. Whole texts are
    read, once, without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column(2).to_pylist()]
            p = np.concatenate([network.score(texts[a : a + 64]) for a in range(0, len(texts), 64)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(crc_mod(id_col, 4) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def without_rejected(docs: DataFrame, network: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs less the rows that score below the threshold, all columns kept."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column(at).to_pylist()]
            p = np.concatenate([network.score(texts[a : a + 64]) for a in range(0, len(texts), 64)])
            yield batch.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)
