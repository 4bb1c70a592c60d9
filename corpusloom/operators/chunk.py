"""Adaptive chunks of a document's lines.

Chunks depend on what the ones before them left over, so a document is cut by one Python function; documents are rows of
Arrow batches and never shuffle. Tables are cut at rows with their header repeated, long paragraphs at words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain, groupby, pairwise
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET_PARTS, TARGET_LEAST, TARGET_MOST = 40, 1000, 2500
OVERLAP, LEAST_CHARS, MOST_CHUNKS = 120, 40, 120
#: characters of chunks after which a task gives on what it has made
BATCH = 4 << 20
_SEPARATOR = re.compile(r"^\s*\|?[\s:|]*-{2,}[\s:|-]*\|?\s*$")
_ROW = re.compile(r"^\s*\|.*\|\s*$")
_HTML_TABLE, _HTML_END = re.compile(r"<table[\s>]", re.I), re.compile(r"</table>", re.I)
_LINK, _TAG, _BREAK = re.compile(r"\[([^\]]*)\]\([^)]*\)"), re.compile(r"</?[a-zA-Z][^>]*>"), re.compile(r"<br\s*/?>", re.I)
#: fixed patterns: lines of navigation, logos, downloads and boilerplate headings
_DROPPED = [re.compile(p) for p in (
    r"^\s*#{0,6}\s*!\[", r"\[(PDF|파일)[^\]]*다운로드\]|javascript:void",
    r"^\s*(#{1,6}\s*)?(문서\s*목차|첨부파일|보고서명)\s*$",
)]


def meaningful(text: str) -> bool:
    return len(text) >= LEAST_CHARS and re.search("[가-힣A-Za-z]", text) is not None


def _one_line(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _cleaned(line: str) -> str | None:
    if any(p.search(line) for p in _DROPPED) or _SEPARATOR.match(line):
        return None
    text = line.replace("|", "  ") if _ROW.match(line) else line
    text = re.sub(r"^\s*#{1,6}\s*", "", _LINK.sub(r"\1", text).replace("*", ""))
    return _TAG.sub("", _BREAK.sub(" ", text)).rstrip()


def _cells(line: str) -> str:
    inner = re.sub(r"^\||\|$", "", line.strip())
    return _one_line(_LINK.sub(r"\1", "  ".join(c.strip() for c in inner.split("|"))).replace("*", ""))


def _html_rows(block: str) -> list[str]:
    out = []
    for row in re.findall(r"<tr[^>]*>(.*?)</tr>", block, re.I | re.S):
        cells = [_one_line(_TAG.sub("", _BREAK.sub(" ", c))) for c in re.findall(r"<t[hd][^>]*>(.*?)</t[hd]>", row, re.I | re.S)]
        out.append("  ".join(filter(None, cells)).strip())
    return [r for r in out if r]


@dataclass
class Block:
    """Rows of a table, or paragraphs."""

    parts: list[str] = field(default_factory=list)
    table: bool = False


def blocks(lines: list[str]) -> list[Block]:
    """Tables (HTML, or two Markdown rows and more) and the text between them, cleaned."""
    out: list[Block] = []
    text: list[str] = []

    def close() -> None:
        kept = [c for c in map(_cleaned, text) if c is not None]
        out.append(Block([p for p in map(_one_line, re.split(r"\n{2,}", "\n".join(kept))) if p]))
        text.clear()

    at = 0
    while at < len(lines):
        end = at
        if _HTML_TABLE.search(lines[at]):
            while end < len(lines) and not _HTML_END.search(lines[end]):
                end += 1
            end = min(end + 1, len(lines))
            rows = _html_rows("\n".join(lines[at:end]))
        else:
            while end < len(lines) and _ROW.match(lines[end]):
                end += 1
            rows = [c for c in (_cells(r) for r in lines[at:end] if not _SEPARATOR.match(r)) if c] if end - at > 1 else None
            end = end if rows is not None else at + 1
        if rows:
            close()
            out.append(Block(rows, table=True))
        elif rows is None or _HTML_TABLE.search(lines[at]):
            text += lines[at:end]
        at = end
    close()
    return [b for b in out if b.parts]


def table_chunks(rows: list[str], target: int) -> list[str]:
    """Rows up to the target size, the first row repeated on top of each chunk; a lone first row if it has meaning."""
    header, *data = rows
    if not data:
        return [header] if meaningful(header) else []
    groups, size = [[]], len(header)
    for row in data:
        if groups[-1] and size + len(row) + 1 > target:
            groups.append([])
            size = len(header)
        groups[-1].append(row)
        size += len(row) + 1
    return ["\n".join([header, *g]) for g in groups]


def split_words(paragraph: str, target: int) -> list[str]:
    """Pieces of whole words up to the target size; a longer word is a piece."""
    pieces: list[str] = []
    for word in paragraph.split(" "):
        if pieces and len(pieces[-1]) + 1 + len(word) <= target:
            pieces[-1] += " " + word
        else:
            pieces.append(word)
    return [p for p in pieces if p]


def flow(paragraphs: list[str], target: int) -> list[str]:
    """Paragraphs packed up to the target size; each text after the first starts with the end of the one before it."""

    def grown(size: int, more: int) -> int:
        return size + 1 + more if size + 1 + more <= target else min(size, OVERLAP) + 2 + more

    lengths = [len(p) for p in paragraphs]
    sizes = list(accumulate(lengths, grown))
    cuts = [0, *(i for i in range(1, len(lengths)) if sizes[i - 1] + 1 + lengths[i] > target), len(lengths)]
    texts: list[str] = []
    for first, end in pairwise(cuts):
        head = [texts[-1][-OVERLAP:] + " "] if texts else []
        texts.append(" ".join(head + paragraphs[first:end]))
    return texts


def drafts(found: list[Block], target: int) -> list[tuple[str, str]]:
    """(kind, text) in the order of the document.

    Kinds: ``piece`` of a table or a long paragraph; ``full`` text that what follows it closed; the ``rest`` at the end.
    """
    solid: list[tuple[bool, list[str]]] = []
    for block in found:
        if block.table:
            solid.append((True, table_chunks(block.parts, target)))
        else:
            solid += [(len(p) > target, split_words(p, target) if len(p) > target else [p]) for p in block.parts]
    out: list[tuple[str, str]] = []
    for is_solid, group in groupby(solid, key=itemgetter(0)):
        texts = list(chain.from_iterable(parts for _, parts in group))
        out += [("piece", t) for t in texts] if is_solid else [("full", t.strip()) for t in flow(texts, target)]
    if out and not solid[-1][0]:
        out[-1] = ("rest", out[-1][1])
    return out


def cut(lines: list[str]) -> tuple[list[str], int, bool]:
    """(chunks, content characters, whether the cap on chunks cut it short)."""
    found = blocks(lines)
    content = sum(len(p) for b in found for p in b.parts)
    target = max(TARGET_LEAST, min(TARGET_MOST, int(content / TARGET_PARTS + 0.5)))
    kept: list[str] = []
    for kind, text in drafts(found, target):
        # a piece needs room before it, a full text leaves none for what follows; the rest may just not fit
        if kind != "full" and len(kept) >= MOST_CHUNKS:
            return kept, content, kind == "piece"
        kept += [text] * meaningful(text)
        if kind == "full" and len(kept) >= MOST_CHUNKS:
            return kept, content, True
    return kept, content, False


def without_front_matter(lines: list[str]) -> list[str]:
    if lines[:1] == ["---"]:
        for i in range(1, min(len(lines), 40)):
            if lines[i] == "---":
                return lines[i + 1 :]
    return lines


_NAMES, _KINDS = ("seq", "body", "n_chars", "content_chars", "truncated"), (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.bool_())


def cut_batch(keys: pa.Array, texts: pa.Array, key: str, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The chunks of a batch of texts, about ``most`` characters at a time: one text at a time becomes Python's own."""

    def made(at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS)]
        return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *columns], [key, *_NAMES])

    at, rows, held = [], [], 0
    for i, value in enumerate(texts):
        found, content, short = cut(without_front_matter(re.split(r"\r?\n", (value.as_py() or "").replace("\0", ""))))
        for seq, body in enumerate(found or [None], 1):
            at.append(i)
            rows.append((seq if body else None, body, len(body) if body else None, content, short))
            held += len(body or "")
        if held >= most:
            yield made(at, rows)
            at, rows, held = [], [], 0
    if rows:
        yield made(at, rows)


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, seq, body, n_chars, content_chars, truncated): the chunks; a document without one has a row with seq null."""

    def run(batches):
        for batch in batches:
            yield from cut_batch(batch.column(0), batch.column(1), key)

    kind = docs.schema[key].dataType.simpleString()
    out = f"{key} {kind}, seq int, body string, n_chars int, content_chars long, truncated boolean"
    return docs.select(key, text).mapInArrow(run, out)


def chunk_report(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_articles, coverage, parse_status) of each document; coverage is at most 1."""
    sums = rows.groupBy(key).agg(
        F.count("seq").alias("n_articles"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("covered"),
        F.max("content_chars").alias("content"), F.max("truncated").alias("short"),
    )
    ratio = F.when(F.col("content") > 0, F.least(F.lit(1.0), F.round(F.col("covered") / F.col("content"), 3))).otherwise(0.0)
    status = F.when(F.col("n_articles") == 0, "empty").when(F.col("short"), "truncated").otherwise("chunked")
    return sums.select(key, "n_articles", ratio.alias("coverage"), status.alias("parse_status"))


def corpus_report(report: DataFrame) -> DataFrame:
    """One row over all documents of ``chunk_report``: documents, chunks, empty and cut documents, chunks a document."""
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0)).cast("long")
    chunks_ = F.coalesce(F.sum("n_articles"), F.lit(0))
    return report.agg(
        F.count("*").alias("docs"), chunks_.alias("chunks"), count(F.col("parse_status") == "empty").alias("empty_docs"),
        count(F.col("parse_status") == "truncated").alias("truncated_docs"),
        F.when(F.count("*") > 0, F.round(chunks_ / F.count("*"), 2)).otherwise(0.0).alias("avg_chunks_per_doc"),
    )
