"""PDF inspection, two-mode extraction and recognition against stubs that record what they are asked."""

from folioforge.sources import binary as B


def make_raw_facts():
    def raw_facts(content):
        if content == b"locked":
            raise RuntimeError("pdf_encrypted_with_user_password")
        boxes = [[0.0, 0.0, 10.0, 10.0]] * (300 if content == b"many" else 1)
        return {"pages": [(10.0, 20.0, boxes), (10.0, 20.0, [])], "unlocked": content == b"many", "tagged": True, "producer": " X "}

    return raw_facts


def test_inspection(spark):
    files = spark.createDataFrame([("a", b"plain"), ("b", b"many"), ("c", b"locked")], "path string, content binary")
    out = {r.path: r for r in B.inspect_pdfs(files, make_raw_facts()).collect()}
    assert out["a"].page_count == 2 and out["a"].pages[0].coverage == 0.5 and out["a"].pages[1].coverage == 0 and out["a"].producer == "X"
    assert out["b"].pages[0].coverage == 1 and list(out["b"].warnings) == ["encrypted_empty_password", "image_enumeration_truncated:page_1"]
    assert out["c"].page_count is None and "pdf_encrypted" in out["c"].error
    missing = B.inspect_pdfs(files).collect()
    assert all(r.error for r in missing) or B.available()["pdf"]


def make_text_of():
    def text_of(content, layout, page):
        if content == b"bad":
            raise RuntimeError("damaged")
        pages = ["one", "two", "three"]
        if page:
            return (pages[page - 1] if page <= 3 else "") + "\f"
        return ("\f".join(pages) + "\f") if content == b"good" else "one two\fthree\f"

    return text_of


def test_both_modes_fall_back_to_single_pages(spark):
    files = spark.createDataFrame([("a", b"good", 3), ("b", b"merged", 3), ("c", b"merged", 4), ("d", b"bad", 2)], "path string, content binary, page_count int")
    out = {}
    for r in B.both_modes(files, make_text_of()).collect():
        out.setdefault(r.path, []).append((r.page, r.plain, r.error))
    assert [x[1] for x in sorted(out["a"])] == [x[1] for x in sorted(out["b"])] == ["one", "two", "three"]
    assert [x[1] for x in sorted(out["c"])] == ["one", "two", "three", ""]
    assert len(out["d"]) == 1 and out["d"][0][1] is None and "damaged" in out["d"][0][2]


def make_engine():
    def engine():
        made = []

        def read(image, language):
            made.append(1)
            if image == b"x":
                raise ValueError("no image")
            return f"{language}:{image.decode()}"

        return read

    return engine


def test_recognition(spark):
    pages = spark.createDataFrame([("a", 1, b"hello", "eng"), ("b", 1, b"x", "spa+eng")], "path string, page int, image binary, ocr_language string")
    out = {r.path: r for r in B.recognise(pages, make_engine()).collect()}
    assert out["a"].recognised == "eng:hello" and out["b"].recognised is None and "no image" in out["b"].error
    files = spark.createDataFrame([("d/a",), ("d/map-b",), ("d/c",), ("d/e",)], "path string")
    by_hand = spark.createDataFrame([("e", "typed")], "name string, text string")
    read = spark.createDataFrame([("d/a", "seen"), ("d/map-b", "lost"), ("d/c", " ")], "path string, recognised string")
    parsed = {r.path: (r.text, r.method, len(r.warnings)) for r in B.parse_images(files, by_hand, ["map-"], read).collect()}
    assert parsed == {"d/a": ("seen", "ocr", 0), "d/map-b": (None, "none", 1), "d/c": (None, "none", 1), "d/e": ("typed", "manual", 0)}
