"""Token-bounded chunks of documents' blocks.

Sentence ends need a look at what stands before them and chunks are filled in order, so each document is folded in a
Python worker, Arrow batch by Arrow batch; everything around it is columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE

MAX_TOKENS = 220
# What a worker gathers before it hands a batch on.
CHARS_AT_ONCE, ROWS_AT_ONCE = 4_000_000, 2_000
# Fixed values.
ENDS, CLOSERS = ".!?。！？", "\"'”’»)]}"
ABBREVIATIONS = ("dr.", "mr.", "mrs.", "ms.", "sr.", "sra.", "prof.", "inc.", "ltd.", "etc.", "e.g.", "i.e.", "fig.", "al.", "no.", "art.", "vol.", "p.", "pp.")
LOOK_BACK = 20

_token = re.compile(r"\w+|[^\w\s]")
_initials = re.compile(r"\b[A-ZÁÉÍÓÚÜÑ](?:\.[A-ZÁÉÍÓÚÜÑ])+\.$")
_numbering = re.compile(r"(?:^|\s)(?:[A-ZÁÉÍÓÚÜÑa-záéíóúüñ]|[0-9]{1,3})\.$")
_end = re.compile(f"[{re.escape(ENDS)}]")
_after = re.compile(f"[{re.escape(CLOSERS)}]*(?=\\s|$)")
_paragraph = re.compile(r"\n\s*\n+")

BLOCK = "array<struct<ord:bigint,block_id:string,type:string,text:string,page:int,method:string,confidence:double>>"
CHUNK = "doc_id string, chunk_id string, position int, num_tokens int, text string, block_ids array<string>, block_types array<string>, page_start int, page_end int, method string, confidence double, strategy string, section string"


def count_tokens(text: str) -> int:
    return len(_token.findall(text))


def is_abbreviation(text: str, at: int) -> bool:
    """Whether the point at a place belongs to an abbreviation, initials or a number of a list."""
    back = text[max(0, at - LOOK_BACK) : at + 1].strip()
    return back.lower().endswith(ABBREVIATIONS) or bool(_initials.search(back) or _numbering.search(back))


def sentences(text: str) -> list[str]:
    """Cuts after an end mark with its closing quotes, where white space or the end follows and no abbreviation stands before."""
    out, start, at = [], 0, 0
    while m := _end.search(text, at):
        at = m.end()
        after = _after.match(text, at)
        if after and not is_abbreviation(text, m.start()):
            if piece := text[start : after.end()].strip():
                out.append(piece)
            start = at = after.end()
    if tail := text[start:].strip():
        out.append(tail)
    return out


def cut_hard(text: str, most: int) -> list[str]:
    """Pieces of exactly most tokens, the last one shorter, at their places in the text, ends stripped."""
    if most < 1:
        raise ValueError("a piece needs at least one token")
    bounds = [0, *(m.end() for i, m in enumerate(_token.finditer(text), 1) if i % most == 0), len(text)]
    return [p for a, b in zip(bounds, bounds[1:], strict=False) if (p := text[a:b].strip())]


def units(text: str, most: int) -> tuple[list[str], int, str]:
    """Pieces of up to most tokens, how many sentences were too long, and how the text was cut: paragraph, sentence or hard_token_split."""
    paragraphs = [p for x in _paragraph.split(text.strip()) if (p := x.strip())]
    if len(paragraphs) > 1:
        cut = [units(p, most) for p in paragraphs]
        return [u for own, _, _ in cut for u in own], sum(n for _, n, _ in cut), "paragraph"
    if count_tokens(text) <= most:
        return [text.strip()], 0, "sentence"
    parts = sentences(text)
    if len(parts) == 1:
        return cut_hard(text, most), 1, "hard_token_split"
    out, held, size, long = [], [], 0, 0
    for part in parts:
        n = count_tokens(part)
        if held and (n > most or size + n > most):
            out.append(" ".join(held))
            held, size = [], 0
        if n > most:
            out += cut_hard(part, most)
            long += 1
        else:
            held.append(part)
            size += n
    if held:
        out.append(" ".join(held))
    return out, long, "sentence"


@dataclass
class Draft:
    """The chunk that is being filled: (text, block) pairs."""

    parts: list[tuple[str, dict]] = field(default_factory=list)
    tokens: int = 0
    strategy: str = "sentence"

    def add(self, text: str, block: dict, tokens: int) -> None:
        self.parts.append((text, block))
        self.tokens += tokens

    def row(self, doc_id: str, position: int, section: str | None) -> dict | None:
        text = "\n\n".join(t.strip() for t, _ in self.parts if t.strip())
        if not text:
            return None
        blocks = [b for _, b in self.parts]
        pages = [b["page"] for b in blocks if b["page"] is not None]
        sure = [b["confidence"] for b in blocks if b["confidence"] is not None]
        return {
            "doc_id": doc_id,
            "chunk_id": f"{doc_id}-chunk-{position:04d}",
            "position": position,
            "num_tokens": self.tokens,
            "text": text,
            "block_ids": [b["block_id"] for b in blocks],
            "block_types": [b["type"] for b in blocks],
            "page_start": min(pages, default=None),
            "page_end": max(pages, default=None),
            "method": blocks[0]["method"],
            "confidence": sum(sure) / len(sure) if sure else None,
            "strategy": self.strategy,
            "section": section,
        }


def sections(blocks: list[dict]) -> Iterator[tuple[dict | None, list[dict]]]:
    """A heading, or none for what stands before the first, with the blocks up to the next heading. Blank blocks are left out."""
    heading, body = None, []
    for block in blocks:
        if not block["text"].strip():
            continue
        if block["type"] == "heading":
            if heading or body:
                yield heading, body
            heading, body = block, []
        else:
            body.append(block)
    if heading or body:
        yield heading, body


def section_items(heading: dict | None, body: list[dict], most: int) -> list[list[tuple[str, dict, int, str]]]:
    """What a section's chunks are filled with: runs of (text, block, tokens, how it was cut), of which each begins a new chunk.

    A heading leads the section's first chunk, whose first piece is cut to what the heading leaves free. A heading that leaves nothing, or has
    nothing below it, comes by itself, cut up where it's too long.
    """
    items = []
    for block in body:
        pieces, _, way = units(block["text"], most)
        items += [(p, block, count_tokens(p), way) for p in pieces]
    if not heading:
        return [items]
    title = heading["text"].strip()
    n = count_tokens(title)
    if n >= most or not items:
        alone = [(p, heading, count_tokens(p), "hard_token_split" if n > most else "sentence") for p in cut_hard(title, most)]
        return [*([x] for x in alone), items]
    first, block, size, _ = items[0]
    if size > most - n:
        same = [i for i, x in enumerate(items) if x[1] is block]
        rest = [(*x[:3], "hard_token_split") for x in items[1 : len(same)]]
        items = [*((p, block, count_tokens(p), "hard_token_split") for p in cut_hard(first, most - n)), *rest, *items[len(same) :]]
    return [[(title, heading, n, "sentence"), *items]]


def chunk_blocks(doc_id: str, blocks: list[dict], most: int = MAX_TOKENS) -> list[dict]:
    """The chunks of a document's blocks, in order: no word is lost, headings included, and none has more than `most` tokens.

    A chunk never reaches over a heading. Headings in a row and one at the very end are chunks of their own.
    """
    out: list[dict] = []
    for heading, body in sections(blocks):
        section = heading["text"].strip() if heading else None
        for run in section_items(heading, body, most):
            draft = Draft()
            for text, block, n, way in run:
                if draft.parts and draft.tokens + n > most:
                    out += filter(None, [draft.row(doc_id, len(out), section)])
                    draft = Draft()
                if way == "hard_token_split" or (way == "paragraph" and draft.strategy == "sentence"):
                    draft.strategy = way
                draft.add(text, block, n)
            out += filter(None, [draft.row(doc_id, len(out), section)])
    return out


def chunk(blocks: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """Chunks of blocks(doc_id, ord, block_id, type, text, page, method, confidence, is_boilerplate).

    Blank blocks are left out, boilerplate only where it is whole page text. A document's blocks meet in one row, which
    the fold in order needs; documents that are tables only should be filtered before (structured_only).
    """
    if most < 1:
        raise ValueError("a chunk needs at least one token")
    own = blocks.where(F.coalesce(F.col("text").rlike(f"[^{WHITE}]"), F.lit(False)) & ~(F.coalesce("is_boilerplate", F.lit(False)) & (F.col("type") == "page_text")))
    docs = own.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("ord", "block_id", "type", "text", "page", "method", "confidence"))).cast(BLOCK).alias("blocks"))
    return chunk_folded(docs, most)


def chunk_folded(docs: DataFrame, most: int = MAX_TOKENS, columns: tuple[str, ...] = ()) -> DataFrame:
    """Chunks of docs(doc_id, blocks), blocks being sorted arrays: no shuffle is needed where documents come whole.

    columns: those of CHUNK that are wanted, all if none is named. A section stands in each of its chunks, so what a long heading's chunks hold
    together grows with the square of its length; batches are handed on by size, and a section that isn't wanted isn't written.
    """
    schema = pa.schema([x for x in ARROW if not columns or x.name in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0
        for batch in batches:
            for d, b in zip(batch.column(0), batch.column(1), strict=True):
                for r in chunk_blocks(d.as_py(), b.as_py(), most):
                    rows.append(row := {c: r[c] for c in schema.names})
                    chars += sum(len(v) for v in row.values() if isinstance(v, str))
                    if chars >= CHARS_AT_ONCE or len(rows) >= ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, chars = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select("doc_id", "blocks").mapInArrow(run, ", ".join(x for x in CHUNK.split(", ") if x.split(" ")[0] in schema.names))


ARROW = pa.schema(
    [
        ("doc_id", pa.string()), ("chunk_id", pa.string()), ("position", pa.int32()), ("num_tokens", pa.int32()), ("text", pa.string()),
        ("block_ids", pa.list_(pa.string())), ("block_types", pa.list_(pa.string())), ("page_start", pa.int32()), ("page_end", pa.int32()),
        ("method", pa.string()), ("confidence", pa.float64()), ("strategy", pa.string()), ("section", pa.string()),
    ]
)


def source_label(url: Column, file_name: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.nullif(file_name, F.lit("")), path)


def phenomenon_number(value: Column) -> Column:
    """1, 2 or 3 from a label's digits; anything else is an error."""
    digits = F.regexp_replace(value, r"\D", "")
    return F.when(digits.isin("1", "2", "3"), digits.cast("int")).otherwise(F.raise_error(F.concat(F.lit("invalid phenomenon: "), F.coalesce(value, F.lit("null")))).cast("int"))


def chunk_records(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """chunks with their document's source(doc_id, url, file_name, path, format, phenomenon, language, script, score, basis)."""
    d = documents.select(F.col("doc_id").cast("string").alias("doc_id"), source_label(F.col("url"), F.col("file_name"), F.col("path")).alias("source"), F.lower("format").alias("format"), phenomenon_number(F.col("phenomenon")).alias("phenomenon"), "language", "script", "score", "basis")
    return chunks.join(d, "doc_id")


def chunk_stats(documents: DataFrame, chunks: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """One row of counters over documents(doc_id, hint) and their chunks."""
    per = chunks.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("num_tokens") > most).alias("over"), *(F.count_if(F.col("strategy") == s).alias(s) for s in ("sentence", "paragraph", "hard_token_split")))
    both = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "hint").join(per, "doc_id", "left")
    skipped = F.coalesce(F.col("hint") == "structured_only", F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return both.agg(F.count("*").alias("seen"), F.count_if(F.col("n") > 0).alias("chunked"), F.count_if(skipped).alias("structured_only"), F.count_if(~skipped & F.col("n").isNull()).alias("empty"), total("n").alias("chunks"), total("over").alias("oversize"), total("sentence").alias("sentence"), total("paragraph").alias("paragraph"), total("hard_token_split").alias("hard_token_split"))
