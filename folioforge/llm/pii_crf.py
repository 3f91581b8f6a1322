"""Personal data by patterns and by a linear-chain conditional random field over word shapes.

The field learns from a small labelled table of made-up token rows and labels each token of a line; lines are decoded by
Viterbi in numpy batches. It adds spans of kinds and forms that the patterns don't have: secrets, keys, telephone numbers
without a plus. Spans of the patterns always stay; added ones never overlap them.

A token is plain if it has neither a digit nor one of @ = + " _, nor names a digest. Once trained, the field is asked whether any label but
`O` can ever pay on a line of plain tokens only; if not, which is the rule, such lines need no decoding to be known.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *KINDS)
#: Lines in a batch of Viterbi. Tokens after which a line is cut at the next plain token, and at the latest; tokens that are gathered before decoding.
AT_ONCE, LONG_LINE, LONGEST_LINE, GATHERED = 512, 2000, 4000, 100_000

_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").finditer
_ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_base_sign = re.compile(r"[0-9@]").search
_sign = re.compile(r'[0-9@=+"_]')
_token = re.compile(r"\S+").finditer
#: Words before a string of hexadecimal digits that say it's a digest.
_DIGEST = {"commit", "sha", "sha1", "sha256", "md5", "revision", "rev", "checksum", "digest", "hash"}


def _is_plain(token: str) -> bool:
    return not _sign.search(token) and token.lower().strip(".,:;()") not in _DIGEST


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches, in linear time, by start and then by kind."""
    out: list[tuple[int, str, int]] = []
    if not _base_sign(text):
        return out
    last = 0
    for m in _domain(text):
        start = m.start()
        while start > last and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < m.start():
            out.append((start, "email", m.end()))
            last = m.end()
    out += [(m.start(), "ip", m.end()) for m in _ip(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _card(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), "card", m.end()))
    for m in _phone(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def shape(token: str) -> tuple[str, ...]:
    """The features of a token: its compressed shape, and coarse marks. Plain tokens differ by their first letter's case only."""
    if _is_plain(token):
        return ("plain", "capital" if token[:1].isupper() else "small")
    if token.lower().strip(".,:;()") in _DIGEST:
        return ("digest",)
    bare = token.strip(".,;:!?\"'()[]<>|*#&%$")
    classes = re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "0", bare))
    runs = re.sub(r"(.)\1+", lambda m: m.group(1) + ("+" if len(m.group()) < 8 else "*" if len(m.group()) < 12 else "#"), classes)
    key = re.match(r"(password|passwd|pwd|secret|token|api_?key|key)\b", token.lower())
    out = ["shape:" + runs[:24], f"long:{min(len(bare) // 4, 10)}"]
    out += [name for name, p in (("digits", r"[0-9]+"), ("dotted", r"[0-9]+(\.[0-9]+){3}"), ("hex", r"[0-9a-f]{12,}"), ("capitals", r"(?=.*[0-9])[A-Z0-9]{14,}"), ("pair", r"[0-9]{3,4}-[0-9]{4}"), ("dialled", r"[0-9]{3}-[0-9]{3}-[0-9]{4}"), ("mixed", r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]{14,}")) if re.fullmatch(p, bare)]
    out += [f"has:{c}" for c in '@=+"_' if c in token]
    if token[:1] in "+(":
        out.append("first:" + token[0])
    if key:
        out.append("key")
    return tuple(out)


def labelled_table() -> list[tuple[list[str], list[str]]]:
    """Token rows with their labels, made from a few forms and a fixed stream of numbers."""
    rng = np.random.default_rng(7)
    words = "the report was sent to our office on Monday and they asked for a copy Please call or write We met der und die las para con les des".split()
    pick = lambda s, n: "".join(rng.choice(list(s), n))
    digits, hexes, letters, caps = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    forms = [
        lambda: ([pick(letters, rng.integers(3, 9)) + "." + pick(digits, 2) + "@" + pick(letters, 5) + ".example." + str(rng.choice(["com", "org"]))], "email"),
        lambda: ([pick(letters, 6) + "@" + pick(letters, 5) + str(rng.integers(1, 9)) + ".com"], "email"),
        lambda: ([".".join(str(rng.integers(1, 255)) for _ in range(4))], "ip"),
        lambda: ([pick(digits, 16)], "card"),
        lambda: ([pick(digits, 4) for _ in range(4)], "card"),
        lambda: ([f"+{rng.integers(1, 99)}", f"({pick(digits, 3)})", f"{pick(digits, 3)}-{pick(digits, 4)}"], "phone"),
        lambda: ([f"({pick(digits, 3)})", f"{pick(digits, 3)}-{pick(digits, 4)}"], "phone"),
        lambda: ([f"{pick(digits, 3)}-{pick(digits, 3)}-{pick(digits, 4)}"], "phone"),
        lambda: (["password=" + pick(hexes, 18)], "secret"),
        lambda: (["api_key=" + pick(hexes, 24)], "secret"),
        lambda: (["token", "=", '"' + pick(hexes, 40) + '"'], "secret"),
        lambda: (["AKIA" + pick(caps, 16)], "secret"),
        lambda: (["secret:", pick(hexes, 32)], "secret"),
        lambda: ([pick(digits, 3), pick(digits, 3), pick(digits, 4)], "phone"),
        lambda: ([pick(hexes, 40)], "O"),
        lambda: ([str(rng.choice(sorted(_DIGEST))), pick(hexes, rng.choice([7, 12, 40, 64]))], "O"),
        lambda: ([pick(digits, rng.integers(1, 12))], "O"),
        lambda: ([pick(digits, rng.integers(1, 3)) for _ in range(rng.integers(2, 6))], "O"),
        lambda: ([pick(letters, rng.integers(1, 4)) + pick(digits, rng.integers(1, 3)) for _ in range(rng.integers(1, 5))], "O"),
        lambda: ([f"{rng.integers(1, 9)},{pick(digits, 3)},{pick(digits, 3)}"], "O"),
        lambda: ([f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}"], "O"),
        lambda: ([str(rng.integers(1, 99)) + "."], "O"),
        lambda: ([str(rng.integers(1900, 2030))], "O"),
        lambda: ([f"{rng.integers(1, 9)}.{rng.integers(0, 9)}."], "O"),
        lambda: ([f"{rng.integers(1, 99)}%"], "O"),
        lambda: (["a", "=", "b"], "O"),
        lambda: (['"' + str(rng.choice(words)) + '"'], "O"),
        lambda: (["#" + str(rng.choice(words))], "O"),
        lambda: ([str(rng.choice(words)) + "_" + str(rng.choice(words))], "O"),
        lambda: (["+", str(rng.integers(1, 99))], "O"),
        lambda: ([str(rng.choice(words)) + str(rng.choice([".", "!!", "###", "***"]))], "O"),
        lambda: ([pick(letters, rng.integers(6, 20)) + str(rng.choice(["###", ",###", ".###", "!"]))], "O"),
    ]
    rows = []
    for i in range(8 * len(forms)):
        tokens, label = forms[i % len(forms)]()
        before, after = rng.integers(0, 6, 2)
        a, b = rng.choice(words, before).tolist(), rng.choice(words, after).tolist()
        marks = [label] * len(tokens)
        if label == "secret" and len(tokens) > 1:
            marks = ["O"] * (len(tokens) - 1) + [label]
        rows.append((a + tokens + b, ["O"] * before + marks + ["O"] * after))
    return rows


class Field:
    """Weights of features for the labels of a token and of its neighbours, and of label pairs."""

    def __init__(self, rows: list[tuple[list[str], list[str]]], rounds: int = 60, rate: float = 0.2, decay: float = 2e-4) -> None:
        names = sorted({f"{d}:{f}" for tokens, _ in rows for t in tokens for f in shape(t) for d in (-1, 0, 1)} | {"-1:edge", "1:edge"})
        self.number = {f: i for i, f in enumerate(names)}
        k = len(LABELS)
        self.w, self.pairs = np.zeros((len(names), k)), np.zeros((k, k))
        xs = [self.features(tokens) for tokens, _ in rows]
        ys = [np.array([LABELS.index(x) for x in labels]) for _, labels in rows]
        m = [np.zeros_like(self.w), np.zeros_like(self.pairs)]
        v = [np.zeros_like(self.w), np.zeros_like(self.pairs)]
        for step in range(1, rounds + 1):
            gw, gp = decay * len(rows) * self.w, decay * len(rows) * self.pairs
            for x, y in zip(xs, ys, strict=True):
                if not len(y):
                    continue
                e = np.array([self.w[own].sum(axis=0) for own in x])
                one, two = self._marginals(e)
                one[np.arange(len(y)), y] -= 1
                for own, d in zip(x, one, strict=True):
                    gw[own] += d
                gp += two
                np.subtract.at(gp, (y[:-1], y[1:]), 1)
            for p, g, a, b in ((self.w, gw, m[0], v[0]), (self.pairs, gp, m[1], v[1])):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        self.cache: dict[str, np.ndarray] = {}
        plain = [self.of(t) for t in ("word", "Word")]
        gain = max(float((p[0] - p[0][0])[1:].max()) for p in plain) + 2 * max(float((p[d] - p[d][0])[1:].max()) for p in [*plain, self._edges()] for d in (1, 2) if d < len(p))
        self.plain_is_outside = gain + 2 * max(0.0, float((self.pairs - self.pairs[0, 0]).max())) < 0

    def features(self, tokens: list[str]) -> list[list[int]]:
        shapes = [shape(t) for t in tokens]
        out = []
        for i in range(len(tokens)):
            own = [f"0:{f}" for f in shapes[i]]
            own += [f"-1:{f}" for f in shapes[i - 1]] if i else ["-1:edge"]
            own += [f"1:{f}" for f in shapes[i + 1]] if i + 1 < len(tokens) else ["1:edge"]
            out.append([self.number[f] for f in own if f in self.number])
        return out

    def _edges(self) -> np.ndarray:
        return np.array([np.zeros(len(LABELS)), self.w[self.number["-1:edge"]], self.w[self.number["1:edge"]]])

    def of(self, token: str) -> np.ndarray:
        """What a token gives to its own label, to the next token's, and to the one's before it."""
        key = ("A" if token[:1].isupper() else "a") if _is_plain(token) else token
        found = self.cache.get(key)
        if found is None:
            s = shape(token)
            found = np.array([self.w[[self.number[f"{d}:{f}"] for f in s if f"{d}:{f}" in self.number]].sum(axis=0) for d in (0, -1, 1)])
            if len(self.cache) < 20_000:
                self.cache[key] = found
        return found

    def _marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = e.shape
        log = lambda x, axis: np.log(np.exp(x - (top := x.max(axis=axis, keepdims=True))).sum(axis=axis)) + top.squeeze(axis)
        a, b = np.empty((n, k)), np.zeros((n, k))
        a[0] = e[0]
        for i in range(1, n):
            a[i] = e[i] + log(a[i - 1][:, None] + self.pairs, 0)
        for i in range(n - 2, -1, -1):
            b[i] = log(self.pairs + e[i + 1] + b[i + 1], 1)
        z = log(a[-1], 0)
        two = np.zeros((k, k))
        for i in range(1, n):
            two += np.exp(a[i - 1][:, None] + self.pairs + e[i] + b[i] - z)
        return np.exp(a + b - z), two

    def emissions(self, tokens: list[str]) -> np.ndarray:
        given = np.array([self.of(t) for t in tokens])
        edges = self._edges()
        e = given[:, 0].copy()
        e[1:] += given[:-1, 1]
        e[:-1] += given[1:, 2]
        e[0] += edges[1]
        e[-1] += edges[2]
        return e

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each line, lines of like length together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
        order = sorted((i for i in range(len(lines)) if lines[i]), key=lambda i: len(lines[i]))
        at, k = 0, len(LABELS)
        while at < len(order):
            own = order[at : at + AT_ONCE]
            while len(own) > 1 and len(own) * len(lines[own[-1]]) > 200_000:
                own = own[: len(own) // 2]
            at += len(own)
            sizes = np.array([len(lines[i]) for i in own])
            e = np.zeros((len(own), sizes.max(), k))
            for r, i in enumerate(own):
                e[r, : sizes[r]] = self.emissions(lines[i])
            best, back = e[:, 0].copy(), np.zeros((len(own), sizes.max(), k), np.int8)
            for t in range(1, sizes.max()):
                ways = best[:, :, None] + self.pairs
                back[:, t] = ways.argmax(axis=1)
                live = (t < sizes)[:, None]
                best = np.where(live, ways.max(axis=1) + e[:, t], best)
            label = best.argmax(axis=1)
            path = np.zeros((len(own), sizes.max()), np.int64)
            for t in range(sizes.max() - 1, -1, -1):
                path[:, t] = label
                label = np.where((t < sizes) & (t > 0), back[np.arange(len(own)), t, label], label)
            for r, i in enumerate(own):
                out[i] = path[r, : sizes[r]]
        return out


@lru_cache(maxsize=1)
def field() -> Field:
    """The field of the labelled table, learned once on the driver and sent with the tasks."""
    return Field(labelled_table())


def _pieces(text: str, model: Field) -> Iterator[tuple[list[int], list[str]]]:
    """Starts and tokens of the lines to be decoded. A long line is cut after a plain token, which is known to be outside, or at LONGEST_LINE tokens."""
    at = 0
    while at <= len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        if end - at < 1 << 16 and model.plain_is_outside and not _sign.search(text[at:end]):
            at = end + 1
            continue
        starts, tokens = [], []
        for m in _token(text, at, end):
            starts.append(m.start())
            tokens.append(m.group())
            if len(tokens) >= LONG_LINE and (_is_plain(tokens[-1]) or len(tokens) >= LONGEST_LINE):
                yield starts, tokens
                starts, tokens = [], []
        if tokens:
            yield starts, tokens
        at = end + 1


def _can_be(kind: str, found: str) -> bool:
    """Card numbers have 12 to 19 digits and pass Luhn; telephone numbers have 7 to 15 digits and no letter."""
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 7 <= len(digits) <= 15 and not any(map(str.isalpha, found))


def added_spans(texts: list[str], base: list[list[tuple[int, str, int]]], model: Field) -> list[list[tuple[int, str, int]]]:
    """What the field finds in each text beyond the base spans, if it can be of that kind. Memory is bounded by GATHERED tokens, whatever a line's length."""
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    taken = [[0] * (len(b) + 1) for b in base]
    for own, b in zip(taken, base, strict=True):  # the furthest end of the first base spans, which are in the order of their starts
        for k, (_, _, e) in enumerate(b):
            own[k + 1] = max(own[k], e)

    def decode(gathered: list[tuple[int, list[int], list[str]]]) -> None:
        for (i, starts, tokens), labels in zip(gathered, model.decode([x[2] for x in gathered]), strict=True):
            if not labels.any():
                continue
            t = 0
            while t < len(labels):
                u = t + 1
                if labels[t]:
                    while u < len(labels) and labels[u] == labels[t]:
                        u += 1
                    start, end, kind = starts[t], starts[u - 1] + len(tokens[u - 1]), LABELS[labels[t]]
                    while start < end and texts[i][start] in "\"'[<":
                        start += 1
                    while start < end and texts[i][end - 1] in "\"'.,;:!?]>#*%&":
                        end -= 1
                    free = taken[i][bisect_left(base[i], (end,))] <= start
                    if start < end and free and _can_be(kind, texts[i][start:end]):
                        out[i].append((start, kind, end))
                t = u

    gathered, size = [], 0
    for i, text in enumerate(texts):
        if not _sign.search(text) and model.plain_is_outside:
            continue
        for starts, tokens in _pieces(text, model):
            gathered.append((i, starts, tokens))
            size += len(tokens)
            if size >= GATHERED:
                decode(gathered)
                gathered, size = [], 0
    decode(gathered)
    return out


def spans_of(texts: list[str], model: Field) -> tuple[list[list[tuple[int, str, int]]], list[list[tuple[int, str, int]]]]:
    """Base spans, and all spans, of each text."""
    base = [base_spans(t) for t in texts]
    more = added_spans(texts, base, model)
    return base, [sorted(b + m, key=lambda s: (s[0], KINDS.index(s[1]))) for b, m in zip(base, more, strict=True)]


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added).

    A null text counts as empty. Repeated rows are searched alike. Places are code points, ends exclusive. Whole texts are
    read, once, without a shuffle.
    """

    model = field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a in range(0, len(texts), 1000):
                for b, s in zip(*spans_of(texts[a : a + 1000], model), strict=True):
                    n = [sum(x[1] == k for x in b) for k in KINDS[:4]]
                    rows.append((*n, hashlib.sha256(_joined(b).encode()).hexdigest(), _joined(s), len(s) - len(b)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4]), pa.array(columns[5]), pa.array(columns[6], pa.int64())], names=["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "n_added"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with every span's text replaced by its kind in brackets, and chars_col, where docs has it, set to the new length. Null texts stay null."""
    at, model = docs.columns.index(text_col), field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a in range(0, len(texts), 1000):
                part = [t or "" for t in texts[a : a + 1000]]
                for i, (text, spans) in enumerate(zip(part, spans_of(part, model)[1], strict=True)):
                    if spans:
                        pieces, last = [], 0
                        for s, kind, e in spans:
                            if s >= last:
                                pieces += [text[last:s], f"[{kind}]"]
                            last = max(last, e)
                        texts[a + i] = "".join([*pieces, text[last:]])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(text_col).isNotNull(), F.length(text_col).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)))
    return out
