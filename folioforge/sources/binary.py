"""Formats that need outside tools: PDF, images, tiles. What isn't installed is reported as such, never silently skipped."""

from __future__ import annotations

import importlib.util
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Recognition languages by script.
OCR_LANGUAGES = {"latin": "spa+eng", "cyrillic": "rus", "arabic": "ara", "han": "chi_sim", "hangul": "kor", "kana": "jpn"}
OCR_OF_LANGUAGE = {"es": "spa+eng", "en": "eng", "pt": "por"}
OCR_DEFAULT = "spa+eng"
#: Images of a page that are measured; share of a page that one image covers if it is the page; images beside which it still is.
MOST_IMAGES, WHOLE_PAGE, FEW_IMAGES = 200, 0.85, 4


def available() -> dict[str, bool]:
    return {"pdf": bool(importlib.util.find_spec("fitz")), "pdftotext": bool(shutil.which("pdftotext")), "tesseract": bool(shutil.which("tesseract"))}


def ocr_language(script: Column, language: Column | None = None, installed: list[str] | None = None) -> Column:
    """The recognition language: a known language's own, else that of the script; Latin letters and unknown scripts take the default.

    With `installed`, only packs that are there: of a choice like spa+eng those of its parts, and if none is there, the default's.
    """
    table = lambda by: F.create_map(*(F.lit(x) for kv in by.items() for x in kv))
    wanted = F.coalesce(*([F.try_element_at(table(OCR_OF_LANGUAGE), language)] if language is not None else []), F.try_element_at(table(OCR_LANGUAGES), script), F.lit(OCR_DEFAULT))
    if installed is None:
        return wanted
    there = F.filter(F.split(wanted, r"\+"), lambda x: x.isin(*installed))
    default = [x for x in OCR_DEFAULT.split("+") if x in installed]
    return F.when(F.size(there) > 0, F.array_join(there, "+")).otherwise(F.lit("+".join(default) or None))


def image_coverage(width: Column, height: Column, boxes: Column) -> Column:
    """struct<coverage, images, truncated> of a page: the area of the boxes (array of [x0, y0, x1, y1]) of its first MOST_IMAGES images against the page's, 1 at most."""
    area = F.when(width * height > 0, width * height).otherwise(F.lit(1.0))
    side = lambda b, i: F.greatest(F.lit(0.0), F.element_at(b, i + 2) - F.element_at(b, i))
    own = F.filter(F.slice(boxes, 1, MOST_IMAGES), lambda b: b.isNotNull())
    covered = F.aggregate(own, F.lit(0.0), lambda a, b: a + side(b, 1) * side(b, 2))
    n = F.greatest(F.size(boxes), F.lit(0))
    return F.struct(F.coalesce(F.least(covered / area, F.lit(1.0)), F.lit(0.0)).alias("coverage"), F.least(n, F.lit(MOST_IMAGES + 1)).alias("images"), (n > MOST_IMAGES).alias("truncated"))


def image_source(width: Column, height: Column, boxes: Column) -> Column:
    """Where a page's image for recognition comes from: `embedded` if one image covers WHOLE_PAGE of it and there are FEW_IMAGES at most, else `raster`."""
    one = F.exists(boxes, lambda b: (F.element_at(b, 3) - F.element_at(b, 1)) * (F.element_at(b, 4) - F.element_at(b, 2)) >= WHOLE_PAGE * width * height)
    return F.when(F.coalesce(one & F.size(boxes).between(1, FEW_IMAGES), F.lit(False)), "embedded").otherwise("raster")


def fit_pages(pages: Column, n: Column) -> Column:
    """Exactly n pages: those beyond are left out, missing ones are empty."""
    return F.concat(F.slice(pages, F.lit(1), n), F.array_repeat(F.lit(""), F.greatest(n - F.size(pages), F.lit(0))))


def _opened(content: bytes) -> dict:
    """What the PDF library says of a file. Raises where a password is needed."""
    import fitz

    doc = fitz.open(stream=content, filetype="pdf")
    locked = bool(doc.needs_pass)
    if locked and not doc.authenticate(""):
        raise RuntimeError("pdf_encrypted_with_user_password")
    pages = [(float(p.rect.width), float(p.rect.height), [list(map(float, i["bbox"])) for i in p.get_image_info()[: MOST_IMAGES + 1]]) for p in doc]
    marked = doc.xref_get_key(doc.pdf_catalog(), "MarkInfo/Marked")[1] == "true" or doc.xref_get_key(doc.pdf_catalog(), "StructTreeRoot")[0] != "null"
    return {"pages": pages, "unlocked": locked, "tagged": marked, "producer": (doc.metadata or {}).get("producer")}


def inspect_pdfs(files: DataFrame, opened: Callable[[bytes], dict] | None = None) -> DataFrame:
    """(path, page_count, tagged, producer, warnings, error, pages) of files(path, content); pages: array<struct<page, width, height, coverage, images, truncated>>.

    The number of pages is the structure's. A file that opens with an empty password is read, with a warning; one that fails, or a missing library, is a
    row with an error. `opened` gives a file's raw facts: the PDF library's, unless another is given.
    """
    open_ = opened or (_opened if available()["pdf"] else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for path, content in zip(x["path"], x["content"], strict=True):
                try:
                    if open_ is None:
                        raise RuntimeError("no PDF library is installed")
                    f = open_(bytes(content))
                    rows.append((path, len(f["pages"]), bool(f["tagged"]), (f["producer"] or "").strip() or None, bool(f["unlocked"]), None, [{"page": i, "width": w, "height": h, "boxes": b} for i, (w, h, b) in enumerate(f["pages"], 1)]))
                except Exception as e:  # one bad file mustn't end the run
                    rows.append((path, None, None, None, False, f"{type(e).__name__}: {e}"[:300], []))
            yield pd.DataFrame(rows, columns=["path", "page_count", "tagged", "producer", "unlocked", "error", "raw"])

    raw = files.select("path", "content").mapInPandas(run, "path string, page_count int, tagged boolean, producer string, unlocked boolean, error string, raw array<struct<page:int,width:double,height:double,boxes:array<array<double>>>>")
    facts = F.transform("raw", lambda p: F.struct(p["page"].alias("page"), p["width"].alias("width"), p["height"].alias("height"), image_coverage(p["width"], p["height"], p["boxes"]).alias("x")))
    pages = F.transform(facts, lambda p: F.struct(p["page"].alias("page"), p["width"].alias("width"), p["height"].alias("height"), p["x"]["coverage"].alias("coverage"), p["x"]["images"].alias("images"), p["x"]["truncated"].alias("truncated")))
    cut = F.transform(F.filter(pages, lambda p: p["truncated"]), lambda p: F.concat(F.lit("image_enumeration_truncated:page_"), p["page"].cast("string")))
    warnings = F.concat(F.when(F.col("unlocked"), F.array(F.lit("encrypted_empty_password"))).otherwise(F.array().cast("array<string>")), cut)
    return raw.select("path", "page_count", "tagged", "producer", warnings.alias("warnings"), "error", pages.alias("pages"))


def _poppler(content: bytes, layout: bool, page: int | None) -> str:
    with tempfile.NamedTemporaryFile(suffix=".pdf") as file:
        file.write(content)
        file.flush()
        only = ["-f", str(page), "-l", str(page)] if page else []
        done = subprocess.run([shutil.which("pdftotext") or "pdftotext", *(["-layout"] if layout else []), *only, "-enc", "UTF-8", file.name, "-"], capture_output=True)
    if done.returncode:
        raise RuntimeError(done.stderr.decode(errors="replace")[:300])
    return done.stdout.decode(errors="replace")


def both_modes(files: DataFrame, extract: Callable[[bytes, bool, int | None], str] = _poppler) -> DataFrame:
    """(path, page, plain, layout, error) of files(path, content, page_count): each page in reading order and in physical layout.

    A whole file is extracted at once; where its form feeds don't make page_count pages, it is extracted page by page. There are always page_count rows:
    missing pages are empty. A file that fails is one row with an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = []
            for path, content, n in zip(x["path"], x["content"], x["page_count"], strict=True):
                try:
                    modes = []
                    for layout in (False, True):
                        pages = extract(bytes(content), layout, None).split("\f")
                        pages = pages[:-1] if len(pages) > 1 and not pages[-1].strip() else pages
                        modes.append(pages if len(pages) == n else [extract(bytes(content), layout, i).replace("\f", "") for i in range(1, int(n) + 1)])
                    rows.append((path, *modes, int(n), None))
                except Exception as e:  # one bad file mustn't end the run
                    rows.append((path, [], [], None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["path", "plain", "layout", "n", "error"])

    raw = files.select("path", "content", "page_count").mapInPandas(run, "path string, plain array<string>, layout array<string>, n int, error string")
    n = F.coalesce("n", F.lit(1))
    zipped = F.arrays_zip(fit_pages(F.col("plain"), n).alias("plain"), fit_pages(F.col("layout"), n).alias("layout"))
    rows = raw.select("path", "error", F.posexplode(zipped).alias("i", "x"))
    return rows.select("path", F.when(F.col("error").isNull(), F.col("i") + 1).alias("page"), F.when(F.col("error").isNull(), F.col("x.plain")).alias("plain"), F.when(F.col("error").isNull(), F.col("x.layout")).alias("layout"), "error")


def _tesseract() -> Callable[[bytes, str], str]:
    def read(image: bytes, language: str) -> str:
        done = subprocess.run(["tesseract", "stdin", "stdout", "-l", language], input=image, capture_output=True)
        if done.returncode:
            raise RuntimeError(done.stderr.decode(errors="replace")[:300])
        return done.stdout.decode(errors="replace")

    return read


def best_engine() -> Callable[[], Callable[[bytes, str], str]] | None:
    """A maker of the best engine that is installed, or none."""
    return _tesseract if available()["tesseract"] else None


def recognise(images: DataFrame, engine: Callable[[], Callable[[bytes, str], str]] | None = None) -> DataFrame:
    """images(path, page, image, ocr_language) with recognised text and error. `engine` makes, once a worker, what reads an image in a language."""
    make = engine or best_engine()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = make() if make else None
        for x in batches:
            rows = []
            for path, page, image, language in zip(x["path"], x["page"], x["image"], x["ocr_language"], strict=True):
                try:
                    if read is None:
                        raise RuntimeError("no recognition engine is installed")
                    rows.append((path, page, read(bytes(image), language), None))
                except Exception as e:  # one bad image mustn't end the run
                    rows.append((path, page, None, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(rows, columns=["path", "page", "recognised", "error"])

    return images.select("path", "page", "image", "ocr_language").mapInPandas(run, "path string, page int, recognised string, error string")


def pdf_pages(files: DataFrame, layout: bool = False) -> DataFrame:
    """(path, page, text, error) of files(path, content): one row a page, pages cut at form feeds; one row with an error where the tool is missing or fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = shutil.which("pdftotext")
        for x in batches:
            rows = []
            for path, content in zip(x["path"], x["content"], strict=True):
                if not tool:
                    rows.append((path, None, None, "pdftotext is not installed"))
                    continue
                with tempfile.NamedTemporaryFile(suffix=".pdf") as file:
                    file.write(content)
                    file.flush()
                    done = subprocess.run([tool, *(["-layout"] if layout else []), "-enc", "UTF-8", file.name, "-"], capture_output=True)
                if done.returncode:
                    rows.append((path, None, None, done.stderr.decode(errors="replace")[:300]))
                else:
                    pages = done.stdout.decode(errors="replace").split("\f")
                    rows += [(path, i, t, None) for i, t in enumerate(pages[:-1] or pages, 1)]
            yield pd.DataFrame(rows, columns=["path", "page", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string, error string")


def tiles(files: DataFrame) -> DataFrame:
    """Vector tiles are recorded, not read."""
    return files.select("path", F.array(F.lit("pbf_disabled__attributes_available_in_csv")).alias("warnings"))


def images(files: DataFrame, transcriptions: DataFrame) -> DataFrame:
    """files(path) with a transcription(name, text) by file name; others are marked as graphics without text. See parse_images for recognition."""
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(transcriptions), "name", "left")
    return named.withColumn("warnings", F.when(F.col("text").isNull(), F.array(F.lit("information_graphic__no_transcription"))).otherwise(F.array().cast("array<string>")))


def parse_images(files: DataFrame, transcriptions: DataFrame, graphics: list[str], recognised: DataFrame) -> DataFrame:
    """(path, text, method, warnings) of files(path): the transcription by hand if there is one; an information graphic (by its file name's part) without
    one stays without text, as recognition would lose its structure; other images take the recognised(path, recognised) text."""
    named = images(files, transcriptions).join(recognised.select("path", "recognised"), "path", "left")
    graphic = F.lower("name").rlike("|".join(graphics)) if graphics else F.lit(False)
    read = F.col("recognised").rlike(r"\S")
    method = F.when(F.col("text").isNotNull(), "manual").when(graphic | ~F.coalesce(read, F.lit(False)), "none").otherwise("ocr")
    warnings = F.when(F.col("text").isNotNull(), F.array().cast("array<string>")).when(graphic, F.array(F.lit("information_graphic__requires_manual_transcription__ocr_would_lose_structure"))).when(F.coalesce(read, F.lit(False)), F.array().cast("array<string>")).otherwise(F.array(F.lit("image_without_text")))
    return named.select("path", F.when(method == "manual", F.col("text")).when(method == "ocr", F.col("recognised")).alias("text"), method.alias("method"), warnings.alias("warnings"))


def vocabulary(alerts: DataFrame) -> DataFrame:
    """Distinct words of places and codes of alerts(code, municipalities): a word list for recognition."""
    words = F.concat(F.array("code"), F.flatten(F.transform("municipalities", lambda m: F.split(m, r"\s+"))))
    return alerts.select(F.explode(words).alias("word")).where(F.length("word") >= 3).distinct()
