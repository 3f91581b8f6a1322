import random

import pyarrow as pa
import pytest

from folioforge.operators import chunking as C


def block(i, kind, text, boilerplate=False, page=1):
    return {"ord": i, "block_id": f"b{i}", "type": kind, "text": text, "page": page, "method": "native", "confidence": 0.8, "is_boilerplate": boilerplate}


@pytest.mark.parametrize("text,at,said", [("This is a dr.", 12, True), ("El fin es.", 9, False), ("What is it?", 5, False), ("Point 1.", 7, True), ("Section A.", 9, True), ("the U.S.", 7, True), ("general.", 7, True)])
def test_abbreviations(text, at, said):
    assert C.is_abbreviation(text, at) is said


def test_sentences():
    assert C.sentences("This is one. This is two.") == ["This is one.", "This is two."]
    assert C.sentences('He said "go!" Then left.') == ['He said "go!"', "Then left."]
    assert C.sentences("no end") == ["no end"]


def test_hard_cut():
    assert C.cut_hard("", 50) == C.cut_hard("   ", 50) == []
    assert C.cut_hard("Hola mundo", 50) == ["Hola mundo"]
    pieces = C.cut_hard("token " * 500, 50)
    assert len(pieces) == 10 and all(C.count_tokens(p) == 50 for p in pieces)
    with pytest.raises(ValueError):
        C.cut_hard("a", 0)


def test_units():
    pieces, over, way = C.units("token " * 1000, 220)
    assert way == "hard_token_split" and over == 1 and max(map(C.count_tokens, pieces)) <= 220
    assert C.units("A short text.", 220) == (["A short text."], 0, "sentence")
    assert all(C.count_tokens(p) <= 10 for p in C.units("Word. " * 100, 10)[0])
    pieces, over, way = C.units("Short one. " + "w " * 300 + ". Short two.", 220)
    assert way == "sentence" and over == 1 and max(map(C.count_tokens, pieces)) <= 220
    assert C.units("One.\n\nTwo.", 220) == (["One.", "Two."], 0, "paragraph")


def test_headings():
    chunks = C.chunk_blocks("D", [block(0, "heading", "Old"), block(1, "heading", "New"), block(2, "paragraph", "Text here.")])
    assert [(c["text"], c["section"]) for c in chunks] == [("Old", "Old"), ("New\n\nText here.", "New")] and chunks[0]["chunk_id"] == "D-chunk-0000"
    chunks = C.chunk_blocks("D", [block(0, "heading", "h " * 10), block(1, "paragraph", "w " * 15)], 20)
    assert max(c["num_tokens"] for c in chunks) <= 20
    chunks = C.chunk_blocks("D", [block(0, "paragraph", "Body."), block(1, "heading", "h " * 300)])
    assert [c["block_types"] for c in chunks] == [["paragraph"], ["heading"], ["heading"]] and max(c["num_tokens"] for c in chunks) <= 220
    chunks = C.chunk_blocks("D", [block(0, "heading", "h " * 300), block(1, "paragraph", "Body.")])
    assert max(c["num_tokens"] for c in chunks) <= 220 and chunks[0]["strategy"] == "hard_token_split" and chunks[-1]["text"] == "Body."
    assert C.chunk_blocks("D", []) == []


def test_no_word_is_lost_and_none_is_over():
    rng = random.Random(1)
    for _ in range(50):
        blocks = [block(i, rng.choice(["paragraph", "paragraph", "list_item", "heading"]), " ".join(rng.choice(["a", "bb.", "c,", "dd!", "e\n\nf"]) for _ in range(rng.randrange(1, 120)))) for i in range(6)]
        chunks = C.chunk_blocks("D", blocks, 30)
        assert all(c["num_tokens"] <= 30 for c in chunks)
        words = lambda s: "".join(s.split())
        assert words("".join(c["text"] for c in chunks)) == words("".join(b["text"] for b in blocks))


def test_chunk_table(spark):
    rows = [("D", *block(i, k, t, b).values()) for i, (k, t, b) in enumerate([("heading", "Head", False), ("paragraph", "Text.", False), ("page_text", "gone", True), ("caption", "kept", True), ("paragraph", " ", False), ("paragraph", None, False)])]
    df = spark.createDataFrame(rows, "doc_id string, ord long, block_id string, type string, text string, page int, method string, confidence double, is_boilerplate boolean")
    out = C.chunk(df).collect()
    assert len(out) == 1 and out[0].text == "Head\n\nText.\n\nkept" and out[0].section == "Head" and list(out[0].block_ids) == ["b0", "b1", "b3"]
    docs = spark.createDataFrame([("D", "full"), ("E", "structured_only"), ("F", "full")], "doc_id string, hint string")
    s = C.chunk_stats(docs, C.chunk(df)).first()
    assert (s.seen, s.chunked, s.structured_only, s.empty, s.chunks, s.oversize) == (3, 1, 1, 1, 1, 0)
    assert C.chunk(df.limit(0)).count() == 0


class Worker:
    """Stands for a table of folded documents and gives the function that runs in the workers."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_a_long_heading_is_handed_on_in_small_batches():
    """Each of its chunks holds the whole heading as section: 400 x 100 kB here."""
    batch = pa.RecordBatch.from_pylist([{"doc_id": "D", "blocks": [block(0, "heading", "word " * 20_000)]}, {"doc_id": "E", "blocks": [block(0, "paragraph", "Text.")]}])
    sizes, rows = [], []
    for out in C.chunk_folded(Worker(), 50)(iter([batch])):
        sizes.append(out.nbytes)
        rows += out.select(["doc_id", "position", "num_tokens"]).to_pylist()
    assert max(sizes) < 5_000_000 and sum(sizes) > 400 * 99_000
    assert rows == [{"doc_id": "D", "position": i, "num_tokens": 50} for i in range(400)] + [{"doc_id": "E", "position": 0, "num_tokens": 2}]


def test_only_wanted_columns_are_written(spark):
    docs = spark.createDataFrame([("D", [(0, "b", "heading", "word " * 120, 1, "native", 0.8)])], f"doc_id string, blocks {C.BLOCK}")
    out = C.chunk_folded(docs, 50, ("doc_id", "num_tokens"))
    assert out.columns == ["doc_id", "num_tokens"] and [tuple(r) for r in out.collect()] == [("D", 50), ("D", 50), ("D", 20)]
    assert C.chunk_folded(docs, 50).schema.names == C.ARROW.names
