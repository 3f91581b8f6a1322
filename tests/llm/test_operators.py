"""Each operator against a brute-force version on small tables that hold nulls, empty, long, repeated and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioforge.llm import chat_format, components, covering_simhash, decontaminate, langid_ecoc, license_join, nn_descent, packing, pii_crf, quality_cnn, superkmer

WORDS = [a + b for a in "ka lo mi nu te ri so".split() for b in "ban del fin gor hus jat".split()]
DOCS = "doc_id long, text string, fp string, root string, key string"  # the last three clash with inner names


def texts(seed=0, n=60):
    rng = random.Random(seed)
    make = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    passage, base = make(60), [make(rng.randrange(1, 200)) for _ in range(n)]
    out = [*base, base[3], base[3], base[5] + " end", f"{base[7]} {passage} {base[8]}", f"{passage}\t{base[9]}", "", None, "  \n\t", "one", "one two", "same " * 90, make(3000), "é " * 50]
    return list(enumerate(out)) + [(3, base[3]), (None, base[4]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in texts()], DOCS).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def components_of(n, linked):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in linked:
        parent[find(i)] = find(j)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(501, 700)] + [(7, None)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    comp = components_of(701, [(a, b) for a, b in edges if b is not None])
    least = {}
    for i, c in enumerate(comp):
        least.setdefault(c, i)
    assert all(got[i] == least[comp[i]] for i in got) and {x for e in edges for x in e if None not in e and e[0] != e[1]} == set(got)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs):
    rows = texts()
    got = covering_simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = components_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    least = {}
    for (d, _), c in zip(rows, comp, strict=True):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    want = Counter((d, f"{f:016x}", least.get(c)) for (d, _), f, c in zip(rows, fps, comp, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert covering_simhash.near_duplicates(empty(spark)).count() == 0
    kept = covering_simhash.keep_one(docs, radius=2).collect()
    assert len(kept) == len(set(comp)) and kept[0].asDict().keys() == set(docs.columns)
    assert {r.doc_id for r in kept if r.doc_id is not None} == {least[c] for c in set(comp) if c in least}


@pytest.mark.parametrize("cut", [2048, 4])
def test_every_pair_in_the_radius_meets(spark, monkeypatch, cut):
    monkeypatch.setattr(covering_simhash, "BY_PAIRS", cut)
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:120]:
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))))
    dense = rng.getrandbits(64)
    fps |= {dense ^ (rng.getrandbits(6) << 3) for _ in range(60)}
    fps = sorted(fps)
    for mask, free in covering_simhash.MASKS:
        assert mask & sum(1 << i for i in free) == 0 and mask.bit_count() + len(free) == 64
    signed = [(f - (f >> 63 << 64),) for f in fps]
    got = {r.fp: r.root for r in covering_simhash.fingerprint_components(spark.createDataFrame(signed, "fp long")).collect()}
    comp = components_of(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    same = {}
    for (s,), c in zip(signed, comp, strict=True):
        same.setdefault(c, set()).add(got[s])
    assert all(len(x) == 1 for x in same.values()) and len({min(x) for x in same.values()}) == len(same)


def test_wide_masks_are_balanced_and_cover():
    masks = [m for m, _ in covering_simhash.masks(6, 1)]
    assert len(masks) == 126 and {m.bit_count() for m in masks} == {32}
    rng = random.Random(6)
    for _ in range(2000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
        assert any(m & d == 0 for m in masks)


@pytest.mark.parametrize("cut", [2048, 8])
def test_the_wide_radius(spark, monkeypatch, cut):
    monkeypatch.setattr(covering_simhash, "BY_PAIRS", cut)
    rng = random.Random(14)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:100]:
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.choice([3, 5, 6, 7, 8]))))
    dense = rng.getrandbits(64)
    fps |= {dense ^ (rng.getrandbits(9) << 20) for _ in range(60)}
    fps = sorted(fps)
    signed = [(f - (f >> 63 << 64),) for f in fps]
    got = {r.fp: r.root for r in covering_simhash.fingerprint_components(spark.createDataFrame(signed, "fp long"), 6).collect()}
    comp = components_of(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 6])
    same = {}
    for (x,), c in zip(signed, comp, strict=True):
        same.setdefault(c, set()).add(got[x])
    assert all(len(x) == 1 for x in same.values()) and len({min(x) for x in same.values()}) == len(same)


@pytest.mark.parametrize("hot", [512, 0])
def test_repeated_windows(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(superkmer, "HOT", hot)
    rows = texts()
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in superkmer.digest_of_kept(docs).collect()) == want
    assert superkmer.digest_of_kept(empty(spark)).count() == 0
    assert {r.doc_id: r.n_removed for r in superkmer.remove_repeats(docs.where("doc_id = 3")).collect()}[3] == len(words[3]) * (len(words[3]) >= 35)


def test_windows_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(superkmer, "_MIX", np.uint64(0))  # all windows get one hash
    a, b = (" ".join(f"{x}{i}" for i in range(36)).encode() for x in "ab")
    assert [f.tolist() for f in superkmer.repeated_windows([a, b, a[:0] + a], np.array([1, 1, 1]))] == [[True, True], [False, False], [True, True]]


def test_large_buckets_of_windows(spark):
    """One bucket of over 5,000 different super-k-mers and one of 100,000 copies, against a count of all windows."""
    rng = random.Random(31)
    common = [rng.choice(WORDS) + str(i) for i in range(34)]
    borders = [(f"u{rng.randrange(5300)}", f"v{rng.randrange(5300)}") for _ in range(5300)]
    rows = [(i, " ".join([a, *common, b])) for i, (a, b) in enumerate(borders)]
    copy = " ".join(rng.choice(WORDS) for _ in range(40))
    table = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.range(100_000).select((F.col("id") + 10_000).alias("doc_id"), F.lit(copy).alias("text")))
    got = {r.doc_id: r.n_removed for r in superkmer.digest_of_kept(table).where("doc_id < 10010").collect()}
    left, right = Counter(a for a, _ in borders), Counter(b for _, b in borders)
    assert max(left.values()) > 1
    for i, (a, b) in enumerate(borders):
        assert got[i] == (36 if left[a] > 1 and right[b] > 1 else 35 if left[a] > 1 or right[b] > 1 else 0), i
    assert all(got[i] == 40 for i in range(10_000, 10_010))


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    odd = [(900, "<|endoftext|> a"), (901, "a   b\n \n c"), (902, " lead"), (903, "trail "), (904, "x y " * 3000)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expect = Counter()
    for d, t in [*texts(), *odd]:
        expect[d, tuple([*ids.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    total = sum(len(k[1]) * n for k, n in expect.items())
    out = packing.pack(table, size=256).toPandas()
    assert out["length"].sum() == total and (out["length"] > 0).all()
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 256
    for d, seq in expect:
        own = out[out["doc_id"].isna() if d is None else out["doc_id"] == d]
        own = own[own["doc_tokens"] == len(seq)].sort_values("start")
        crc = lambda a, n: zlib.crc32(np.array(seq[a : a + n], "<u4").tobytes())
        assert len(own) and all(crc(a, n) == c for a, n, c in zip(own["start"], own["length"], own["ids_crc32"], strict=True) if expect[d, seq] == 1 and d is not None)
    sizes = out.groupby("sequence_id")["length"].sum()
    assert 1 - sizes.sum() / (256 * len(sizes)) < 0.12  # a small table: leftovers weigh
    assert packing.pack(empty(spark)).count() == 0


def test_personal_data(spark, docs):
    rng = random.Random(5)
    for _ in range(3000):
        t = "".join(rng.choice("ab@.-+ 0123()é\n9") for _ in range(rng.randrange(1, 40)))
        assert pii_crf.base_spans(t) == plain_spans(t), t
    rows = [(1, "mail a.b@c.de and +1 (555) 123-4567, 4111 1111 1111 1111 at 10.0.0.255 256.1.1.1"), (2, None), (3, ""), (4, "password=0a1b2c3d4e5f607182 x"), (5, "plain words only\nand more " * 500), (6, "é" * 50 + " x@y.zz")]
    out = {r.doc_id: r for r in pii_crf.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1].n_email, out[1].n_ip, out[1].n_card, out[1].n_phone) == (1, 1, 1, 1)
    assert out[2].spans == out[3].spans == out[5].spans == "" and "secret:0:27" in out[4].spans and out[6].spans == "email:51:57"
    assert out[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii_crf.find(empty(spark)).count() == 0
    safe = {r.doc_id: r for r in pii_crf.redact(spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")).collect()}
    assert safe[1].text.startswith("mail [email] and [phone], [card] at [ip]") and safe[1].n_chars == len(safe[1].text) and safe[2].text is None and safe[5].text == rows[4][1]


def test_personal_data_precision_and_recall():
    """Made-up lines that the labelled table doesn't hold, those without personal data being look-alikes."""
    rng, model = random.Random(32), pii_crf.field()
    pick = lambda s, n: "".join(rng.choice(s) for _ in range(n))
    digits, hexes, words = "0123456789", "0123456789abcdef", "the old house near this river was sold to them in spring".split()
    yes = [lambda: f'token = "{pick(hexes, 40)}"', lambda: f"password={pick(hexes, 18)}", lambda: f"api_key={pick(hexes, 24)}", lambda: f"({pick(digits, 3)}) {pick(digits, 3)}-{pick(digits, 4)}", lambda: f"{pick(digits, 3)}-{pick(digits, 3)}-{pick(digits, 4)}", lambda: f"{pick(digits, 3)} {pick(digits, 3)} {pick(digits, 4)}"]
    no = [lambda: f"commit {pick(hexes, 40)}", lambda: f"sha256 {pick(hexes, 64)}", lambda: pick("123456789", 1) + pick(digits, rng.randrange(4, 11)), lambda: f"{rng.randrange(1950, 2030)}", lambda: f"{rng.randrange(1, 9)},{pick(digits, 3)},{pick(digits, 3)}", lambda: f"version {rng.randrange(9)}.{rng.randrange(9)}", lambda: "4111 1111 1111 1112", lambda: f"2024-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", lambda: "x = y_1"]
    lines = [(" ".join([*rng.sample(words, 3), rng.choice(kind)(), *rng.sample(words, 3)]), kind is yes) for _ in range(300) for kind in (yes, no)]
    base, spans = pii_crf.spans_of([t for t, _ in lines], model)
    found = [len(a) > len(b) for a, b in zip(spans, base, strict=True)]
    right = sum(f and y for f, (_, y) in zip(found, lines, strict=True))
    assert right >= 0.95 * 300 and right >= 0.95 * sum(found), (right, sum(found))


def test_personal_data_in_one_very_long_line():
    text = "plain words " * 300_000 + 'token = "' + "0a1b2c3d4e" * 4 + '" and 1 2 3 ' + "x1 " * 20_000
    base, spans = pii_crf.spans_of([text], pii_crf.field())
    assert not base[0] and [(k, text[s:e]) for s, k, e in spans[0]] == [("secret", "0a1b2c3d4e" * 4)]


def test_the_field_learns_by_its_gradient():
    """Marginals against a sum over all paths."""
    from itertools import product

    model, tokens = pii_crf.field(), ["token", "=", '"0a1b"']
    e, k = model.emissions(tokens), len(pii_crf.LABELS)
    one, two = model._marginals(e)
    paths = list(product(range(k), repeat=3))
    w = np.exp([sum(e[i, y] for i, y in enumerate(p)) + model.pairs[p[0], p[1]] + model.pairs[p[1], p[2]] for p in paths])
    w /= w.sum()
    want, pairs = np.zeros((3, k)), np.zeros((k, k))
    for p, x in zip(paths, w, strict=True):
        for i, y in enumerate(p):
            want[i, y] += x
        pairs[p[0], p[1]] += x
        pairs[p[1], p[2]] += x
    assert np.allclose(one, want) and np.allclose(two, pairs)


def plain_spans(t):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii_crf.luhn(d):
            out.append((m.start(), "card", m.end()))
    out += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], pii_crf.KINDS.index(s[1])))


def test_viterbi_is_the_best_path():
    model = pii_crf.field()
    from itertools import product

    tokens = ["token", "=", '"0a1b2c3d4e5f60718293"', "x", "+1"]
    e = model.emissions(tokens)
    value = lambda p: sum(e[i, y] for i, y in enumerate(p)) + sum(model.pairs[a, b] for a, b in zip(p, p[1:], strict=False))
    best = max(product(range(len(pii_crf.LABELS)), repeat=len(tokens)), key=value)
    assert tuple(model.decode([tokens, ["a"], []])[0]) == best
    assert model.plain_is_outside and not model.decode([["some", "Plain", "words,"] * 30])[0].any()


def test_language(spark):
    rng = random.Random(6)
    of = {"en": "the of and that with from".split(), "de": "der die und nicht ein für".split(), "fr": "le des une avec dans été".split()}
    rows = [(i, " ".join(rng.choice(of[k]) for _ in range(rng.randrange(5, 40))), k) for i in range(300) for k in [rng.choice(list(of))]]
    rows += [(900, None, "en"), (901, "12 34 !!", "en"), (902, "", None), (903, "und der die", None), (None, "the of", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in langid_ecoc.identify(df, langid_ecoc.fit(df)).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902)) and out[903].lang_pred == "de" and not out[None].held_out
    held = [(out[i].lang_pred, k) for i, _, k in rows[:300] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items() if i is not None)
    blind = langid_ecoc.fit(df.limit(0))
    assert {r.lang_pred for r in langid_ecoc.identify(df, blind).collect()} == {"und"}
    code = langid_ecoc.codewords(12)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 8


@pytest.mark.parametrize("at_once", [1 << 20, 4, 5])
def test_ngrams_and_decoding_by_plain_loops(monkeypatch, at_once):
    monkeypatch.setattr(langid_ecoc, "AT_ONCE", at_once)
    for text in ["", "a", "ab", "Abc", "abcd", "Straße über", "x" * 23]:
        b, want = text.lower().encode(), np.zeros(langid_ecoc.BINS, np.int64)
        grams = [b[i] << 8 | b[i + 1] for i in range(len(b) - 1)] + [b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)] + ([b[0]] if len(b) == 1 else [])
        for g in grams:
            want[(g * 2654435761 & 0xFFFFFFFF) >> 32 - langid_ecoc.BINS_BITS] += 1
        assert (langid_ecoc.counts(text) == want).all(), text
        assert "".join(langid_ecoc.parts_of(text * 700)) == text * 700
    rng = np.random.default_rng(33)
    x, y = langid_ecoc._scaled(rng.integers(0, 9, size=(40, langid_ecoc.BINS))), np.arange(40) % 4
    model = langid_ecoc.Model(list("abcd"), x, y, rounds=3)
    best, score, unsure = model.decode(x)
    for i in range(40):
        margin = [float(x[i] @ model.weights[:, j] + model.bias[j]) for j in range(model.code.shape[1])]
        loss = [sum(float(model.bit_weights[j]) * np.log1p(np.exp(-float(model.code[k, j]) * m)) for j, m in enumerate(margin)) for k in range(4)]
        p = np.exp(min(loss) - np.array(loss))
        p /= p.sum()
        assert loss[best[i]] <= min(loss) + 1e-4 and abs(p.max() - score[i]) < 1e-3 and unsure[i] == (sorted(p)[-2] >= 0.5 * p.max()) or abs(sorted(p)[-2] - 0.5 * p.max()) < 1e-3


def test_languages_of_any_number_are_learned_and_numerals_are_no_letters(spark):
    rng = random.Random(34)
    own = {f"l{k:03}": [f"{a}{k % 10}{b}{k // 10}" for a in "abc" for b in "xyz"] for k in range(230)}
    rows = [(i, " ".join(rng.choice(w) for _ in range(20)), k) for i, (k, w) in enumerate(((k, w) for k, w in own.items() for _ in range(3)))]
    model = langid_ecoc.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) > 200
    odd = spark.createDataFrame([(1, "12 ½ ² ٣", "lang", 1), (2, "aé", "x", 2)], "doc_id long, text string, lang_pred string, score int")
    assert {r.doc_id: r.lang_pred == "und" for r in langid_ecoc.identify(odd, model).collect()} == {1: True, 2: False}


def test_convolution_and_its_slopes_by_plain_loops():
    q = quality_cnn
    net, rng = q.Network(3), np.random.default_rng(35)
    net.learned, net.mix = True, np.array([0.7, 0.4, -0.1])
    texts = [bytes(rng.integers(32, 127, n, dtype=np.uint8)) for n in (0, 5, 700, 1900)]
    for text, got in zip(texts, net.score(texts), strict=True):
        logits = []
        for own in q.chunks(text):
            top = np.full(q.FILTERS, -np.inf)
            for frame in range(q.FRAMES):
                window = np.concatenate([net.p["vectors"][byte] for byte in own[frame * q.STRIDE : frame * q.STRIDE + q.WIDTH]])
                top = np.maximum(top, window @ net.p["filters"])
            logits.append(float(np.maximum(top + net.p["shift"], 0) @ net.p["out"] + net.p["bias"][0]))
        z = 0.7 * np.mean(logits) + 0.4 * min(logits) - 0.1
        assert abs(1 / (1 + np.exp(-z)) - got) < 1e-4
    # One small step of learning lowers the loss of the documents that it saw.
    docs, labels = [[t] for t in texts[1:]] * 8, np.array([0.0, 1.0, 1.0] * 8)
    loss = lambda n: float(np.mean([np.log1p(np.exp(-(2 * y - 1) * n.logits(q.chunks(d[0])[:1])[0])) for d, y in zip(docs, labels, strict=True)]))
    before = loss(q.Network(3))
    assert loss(q.Network(3).fit(docs, labels, steps=4, batch=24, rate=1e-3)) < before


def test_quality(spark):
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(20, 300))) + "."
    rows = [(i, good() if i % 4 else good().upper().replace(" ", "!! ")) for i in range(600)]
    extra = [(9001, None), (9002, ""), (9003, "a"), (9004, good() * 400)]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows] + [(None, 1, 0), (9001, 0, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    net = quality_cnn.fit(df, labels)
    out = {r.doc_id: r for r in quality_cnn.score(df, net).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in set(held)) for i, _ in rows)
    assert np.mean([out[i].predicted == int(i % 4 > 0) for i in held]) >= 0.97 and all(0 <= r.score <= 1 for r in out.values())
    assert {r.score for r in quality_cnn.score(df, quality_cnn.fit(df, labels.limit(0))).collect()} == {0.5}
    assert quality_cnn.score(df.limit(0), net).count() == 0
    data = bytes(range(256)) * 9
    rows = quality_cnn.chunks(data)
    assert rows[:, : quality_cnn.CHUNK].tobytes()[: len(data)] == data and len(quality_cnn.chunks(b"")) == 1


def test_decontamination(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(k, [word() for _ in range(n)]) for k, n in enumerate([1, 2, 5, 9, 15, 24, 40, 59])]
    rows, want = [], {}
    for d in range(160):
        k, w = items[d % len(items)]
        own = list(w)
        for _ in range((d // len(items)) % (len(w) // 5 + 1)):
            at, how = rng.randrange(len(own)), rng.randrange(3)
            own[at : at + (how != 1)] = [] if how == 0 else [word()]
        rows.append((d, " ".join([word() for _ in range(rng.randrange(80))] + own + [word() for _ in range(rng.randrange(80))]).replace(" ", ", ", 3).upper()))
    rows += [(500, None), (501, ""), (502, " ".join(word() for _ in range(3000)))]
    bench = [(k, " ".join(w)) for k, w in items] + [(100, None), (101, "")]
    for d, t in rows:
        h = decontaminate.hashes_of(decontaminate.words_of(t))
        for k, w in items:
            if (x := decontaminate.best_match(decontaminate.hashes_of(decontaminate.words_of(" ".join(w))), h)[0]) <= len(w) // 5:
                want[d, k] = x
    docs, items_df = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, items_df).collect()}
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want) and all(k in got for k, x in want.items() if x == 0)
    left = {r.doc_id for r in decontaminate.without_contaminated(docs, items_df).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}
    assert decontaminate.contaminated(docs, items_df.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), items_df).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(40, 16))
    x = np.concatenate([centers, *(centers[:12] + rng.normal(scale=0.05, size=(12, 16)) for _ in range(6)), centers[0] + rng.normal(scale=0.04, size=(90, 16)), rng.normal(size=(150, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(9000, None, 0), (9001, [], 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] * 16, 0), (9004, [1.0, None] * 8, 0), (9005, [1.0, 2.0], 0), (9006, [float("inf")] * 16, 0)]
    table = spark.createDataFrame([*rows, *bad, rows[0], (9100, rows[0][1], 1)], "vec_id long, embedding array<float>, label int")
    ids = [*range(len(x)), 0, 9100]
    u = np.concatenate([x, x[:1], x[:1]]).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = components_of(len(u), list(zip(*np.nonzero(near), strict=True)))
    least = {}
    for i, c in zip(ids, comp, strict=True):
        least[c] = min(i, least.get(c, i))
    want = Counter((i, int(n), least[c], i == least[c]) for i, n, c in zip(ids, near.sum(axis=1), comp, strict=True))
    want.update((i, 0, i, True) for i, *_ in bad)
    got = Counter(tuple(r) for r in nn_descent.near_duplicates(table).collect())
    missed = sum((want - got).values())
    assert missed <= 0.02 * sum(want.values()) and all(got[k] for k in want if k[0] >= 9000)
    assert nn_descent.near_duplicates(table.limit(0)).count() == 0


def neighbours_off(spark, monkeypatch, x):
    """Unit vectors x through op8 without the audit's own links: (wrong rows, wrong n_links and components) against brute force."""
    monkeypatch.setattr(nn_descent, "AUDITED", 0)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    comp = components_of(len(x), list(zip(*np.nonzero(near), strict=True)))
    least = {}
    for i, c in enumerate(comp):
        least.setdefault(c, i)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(table).collect()}
    return {i for i in range(len(x)) if got[i] != (near[i].sum(), least[comp[i]])}, near


def unit_rows(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def test_two_linked_tight_groups_fill_their_lists(spark, monkeypatch):
    rng = np.random.default_rng(21)
    groups = []
    for _ in range(6):
        u, w = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
        for center in (u, 0.968 * u + np.sqrt(1 - 0.968**2) * w):
            groups.append(unit_rows(center + rng.normal(scale=0.05 / 8, size=(20, 64))))
    x = np.concatenate([*groups, unit_rows(rng.normal(size=(1000, 64)))])
    off, near = neighbours_off(spark, monkeypatch, x)
    assert near[:20, 20:40].all() and near[:20, :20].sum() == 380
    assert not off


def test_isolated_pairs_meet_in_the_leaves(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF_BLOCK", 160, raising=False)  # so that some leaves have several blocks
    rng = np.random.default_rng(22)
    u = unit_rows(rng.normal(size=(400, 64)))
    w = rng.normal(size=(400, 64))
    w = unit_rows(w - (w * u).sum(axis=1, keepdims=True) * u)
    cosine = rng.uniform(0.951, 0.97, size=(400, 1))
    off, near = neighbours_off(spark, monkeypatch, np.concatenate([u, cosine * u + np.sqrt(1 - cosine**2) * w, unit_rows(rng.normal(size=(2000, 64)))]))
    assert near.sum() == 800
    assert len(off) <= 8, len(off)


def test_audit_measures_and_adds_nothing(spark, monkeypatch):
    rng = np.random.default_rng(23)
    u = unit_rows(rng.normal(size=(700, 16)))
    x = np.concatenate([u, unit_rows(u[:40] + rng.normal(scale=0.02, size=(40, 16)))])
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>")
    linked, recall = nn_descent.graph_of(nodes, len(x))
    assert recall >= nn_descent.RECALL and linked.count() > 0
    leaves, descend = nn_descent._leaves, nn_descent._descend
    monkeypatch.setattr(nn_descent, "_leaves", lambda *a: leaves(*a).limit(0))
    monkeypatch.setattr(nn_descent, "_descend", lambda *a: descend(*a).limit(0))
    with pytest.raises(RuntimeError, match="audited links"):
        nn_descent.graph_of(nodes, len(x))


def test_rounds_raise_the_recall(spark, monkeypatch):
    """Isolated linked pairs among random vectors: the trees alone miss many, each round finds more of them."""
    rng = np.random.default_rng(25)
    n, pairs = 6000, 300
    u = unit_rows(rng.normal(size=(pairs, 64)))
    x = np.concatenate([u, unit_rows(u + rng.normal(scale=0.036, size=(pairs, 64))), unit_rows(rng.normal(size=(n - 2 * pairs, 64)))])
    true = {(i, i + pairs) for i in range(pairs) if x[i] @ x[i + pairs] >= 0.95}
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>").cache()
    share = lambda met: len({(min(r.a, r.b), max(r.a, r.b)) for r in met.where("link").select("a", "b").distinct().collect()} & true) / len(true)
    met = nn_descent._leaves(nodes, n, 0, 1, 0.95).cache()
    graph, seen, recalls = nn_descent._best(met.where("not link").drop("link"), 0.95, 8).cache(), met, []
    recalls.append(share(seen))
    for turn in range(3):
        met = nn_descent._descend(graph, nodes, n, turn, 0.95, 16).cache()
        graph, seen = nn_descent._best(graph.unionByName(met.where("not link").drop("link")), 0.95, 16).cache(), seen.unionByName(met)
        recalls.append(share(seen))
    assert len(true) > 250 and recalls[0] < 0.8 and recalls == sorted(recalls) and recalls[1] > recalls[0] + 0.1 and recalls[-1] >= 0.98, recalls


def test_links_of_a_large_group_of_near_copies(spark, monkeypatch):
    """A component beyond a block: a tight core whose links are counted without comparing, and vectors that link with a part of it."""
    rng = np.random.default_rng(26)
    center = unit_rows(rng.normal(size=(1, 32)))
    tight, loose = (unit_rows(center + rng.normal(scale=s, size=(k, 32))) for s, k in ((0.012, 900), (0.045, 500)))
    x = np.concatenate([tight, loose, unit_rows(rng.normal(size=(300, 32)))])
    monkeypatch.setattr(nn_descent, "BLOCK", 200)
    off, near = neighbours_off(spark, monkeypatch, x)
    assert near[:900, :900].sum() == 900 * 899 and near[900:1400, :1400].mean() < 0.9
    assert not off


def test_quality_scores_follow_the_mix_of_all_labels(spark):
    rng = random.Random(24)
    text = " ".join(rng.choice(WORDS) for _ in range(30))  # the same for all, so that the mix is all there is to learn
    table = spark.createDataFrame([(i, text, int(i % 6 > 0)) for i in range(720)], "doc_id long, text string, quality int")
    part, whole = (quality_cnn.score(table.limit(1), quality_cnn.fit(table, table, common, rare)).first().score for common, rare in ((80, 80), (3000, 1200)))
    assert abs(part - 5 / 6) < 0.08 and abs(whole - 5 / 6) < 0.03


def plain_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    at = sorted((i, label) for p, label in license_join.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    shares = []
    for line in (text or "").split("\n"):
        own = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), line)))
        for label, t in license_join.TEMPLATES:
            share = len(own & set(t.split())) / len(set(t.split()))
            if share >= license_join.CONTAINED:
                shares.append((share, label))
    base = sorted({x for _, x in at})
    return len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(base), ",".join(sorted({*base, *(x for _, x in shares)})), 1.0 if at else max([s for s, _ in shares], default=0.0)


def test_licenses(spark):
    rng = random.Random(10)
    vocab = sorted({w for _, t in license_join.TEMPLATES for w in t.split()}) + ["KelvinK", "é", "x1"]
    rows = ["MIT License, the mit-license; apache\nLICENSE", "permit license mit licenses", "GNU General\tPublic License v3", "All rights reserved.", "reserved rights. all!", "Licensed under CC BY-NC 4.0.", None, "", "émit license", "mit license mit license"]
    rows += [t.upper() for _, t in license_join.TEMPLATES]
    for _ in range(150):
        t = rng.choice(license_join.TEMPLATES)[1].split()
        own = [w for w in t if rng.random() < 0.85] + [rng.choice(vocab) for _ in range(rng.randrange(6))]
        rng.shuffle(own)
        rows.append(f"{' '.join(rng.choice(vocab) for _ in range(5))}\n{', '.join(own)}\n")
    rows.append(rows[0])
    df = spark.createDataFrame([(i % 150, t, "c") for i, t in enumerate(rows)], "doc_id long, text string, label string")
    got = Counter((*r[:-1], round(r[-1], 9)) for r in license_join.scan(df).collect())
    want = Counter((i % 150, *(x := plain_license(t))[:-1], round(x[-1], 9)) for i, t in enumerate(rows))
    assert got == want
    assert license_join.scan(df.limit(0)).count() == 0


def test_wrapped_licenses(spark):
    heads = {
        "apache": "# you may not use this file except in compliance with the License\n# You may obtain a copy of the License at",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License",
        "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
    }
    texts = [*heads.values(), *(f"first line\n{x}\nlast line" for x in heads.values()), "all\nrights\n\nreserved", "all\nrights\nreserved", None, "", "\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_join.scan(df, across=3).collect()}
    for i, label in enumerate([*heads, *heads]):
        assert label in got[i].wrapped_labels.split(",")
    assert got[3].labels == got[7].labels == got[9].labels == "" and got[9].wrapped_labels == "proprietary"
    assert [got[i].wrapped_labels for i in (8, 10, 11, 12)] == [""] * 4
    same = [tuple(r) for r in license_join.scan(df).orderBy("doc_id").collect()]
    assert same == [tuple(got[i])[:-1] for i in range(len(texts))]
    assert license_join.scan(df.limit(0), across=3).count() == 0


def test_chat(spark):
    odd = ["</s>[INST] ok [/INST]", "<|start|>user<|sep|>", "\\<|end|>\\\\", "[\\", "<\\", "", None, "a\nb", "é漢字"]
    rows = [(c, t, r, odd[(c + t) % len(odd)]) for c in range(9) for t, r in enumerate(["system", "user", "assistant", "user", "assistant", "ass<|sep|>\\", None])]
    rows += [(0, 1, "user", "again"), (0, 1, "user", "again"), (None, 0, "assistant", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.digest(chat_format.render(chat_format.messages(chat_format.as_events(table)))).collect()}
    assert len(got) == 10
    for c in got:
        turns = sorted((t, r or "", x or "") for i, t, r, x in rows if i == c)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
    rendered = chat_format.render(chat_format.messages(chat_format.as_events(table))).collect()
    for r in rendered:
        inner = re.split(r"<\|(?:start|sep|end)\|>", r.formatted)
        assert not any(mark in part for part in inner for mark in ("</s>", "[INST]", "<|"))
    assert chat_format.messages(chat_format.as_events(table.limit(0))).count() == 0


def test_event_log(spark):
    log = [
        (1, 0, 0, "message", "user", "Hi"), (1, 1, 0, "message", "assistant", "Hel"), (1, 1, 1, "delta", "assistant", "lo"), (1, 1, 2, "delta", None, None),
        (1, 2, 0, "message", "user", "typo"), (1, 2, 1, "edit", "user", "fixed"), (1, 3, 0, "message", "assistant", "bad"), (1, 3, 1, "regenerate", "assistant", None), (1, 3, 2, "delta", "assistant", "go"), (1, 3, 3, "delta", "assistant", "od"),
        (2, 5, 0, "delta", "assistant", "lone"), (2, 5, 1, "delta", "assistant", " delta"),
    ]
    df = spark.createDataFrame(log[::-1], "conv_id long, turn long, place long, kind string, role string, text string")
    got = {r.conv_id: [(m.role, m.text) for m in r.messages] for r in chat_format.messages(df).collect()}
    assert got == {1: [("user", "Hi"), ("assistant", "Hello"), ("user", "fixed"), ("assistant", "good")], 2: [("assistant", "lone delta")]}


def test_ids_and_folds(spark):
    from folioforge.llm.common import crc_mod

    df = spark.range(200).select("id", crc_mod("id", 4).alias("m"), F.lit(1))
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 4 for r in df.collect())
