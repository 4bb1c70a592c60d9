"""Workbooks (.xlsx) as long cells, a run of sheets a task.

A first job reads the lists of sheets, a second one walks over the XML of each sheet row by row, so a sheet of any length is
never held whole; a workbook's shared strings are, for as long as its sheets are read. Sheets are read in runs that hold as many
bytes as the shared strings, so however many sheets a workbook has, reading its strings costs no more than reading its sheets. ``readers.sheet_records`` makes
records of the cells.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.archives import archive_at, opened, runs_of

BATCH = 20_000
SHEETS = "file string, sheet string, place int, member string, run int"
CELLS = "file string, sheet string, row int, column int, value string"
#: fixed values: name spaces of the format
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
LINKS = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_number(reference: str) -> int:
    """The column of a cell reference, from 1: ``AB7`` is 28."""
    number = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def column_letters(number: int) -> str:
    letters = ""
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def sheet_members(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of a workbook's sheets in order."""
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links.iter(f"{LINKS}Relationship")}
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    at = lambda target: target[1:] if target.startswith("/") else f"xl/{target}"
    return [(s.get("name"), at(targets[s.get(LINK)])) for s in book.iter(f"{MAIN}sheet") if targets.get(s.get(LINK))]


def text_of(element: ElementTree.Element) -> str:
    """The text of a string element: its runs joined, without phonetic hints."""
    parts = [t.text or "" for t in element.findall(f"{MAIN}t")]
    parts += [t.text or "" for run in element.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]
    return "".join(parts)


def sheet_runs(archive: zipfile.ZipFile, found: list[tuple[str, str]]) -> list[int]:
    """The number of each sheet's run: consecutive sheets that together are as large as the shared strings."""
    sizes = {i.filename: i.file_size for i in archive.infolist()}
    own = [sizes.get(member, 0) for _, member in found]
    runs = runs_of(own, max(1, sizes.get("xl/sharedStrings.xml", 0)))
    return [k for k, (first, last, _) in enumerate(runs) for _ in range(first, last)]


def shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    out = []
    with archive.open("xl/sharedStrings.xml") as source:
        for _, element in ElementTree.iterparse(source):
            if element.tag == f"{MAIN}si":
                out.append(text_of(element))
                element.clear()
    return out


def cells_of(source, strings: list[str]) -> Iterator[tuple[int, int, str]]:
    """(row, column, value) of the cells of a sheet that have a value; places count on where none is written."""
    row = 0
    root = None
    for event, element in ElementTree.iterparse(source, events=("start", "end")):
        root = element if root is None else root
        if event == "start" or element.tag != f"{MAIN}row":
            continue
        row = int(element.get("r") or row + 1)
        column = 0
        for cell in element.findall(f"{MAIN}c"):
            column = column_number(cell.get("r") or "") or column + 1
            kind, value = cell.get("t"), cell.findtext(f"{MAIN}v")
            if kind == "inlineStr" and cell.find(f"{MAIN}is") is not None:
                value = text_of(cell.find(f"{MAIN}is"))
            elif kind == "s" and value is not None:
                value = strings[int(value)]
            if value is not None:
                yield row, column, value
        element.clear()
        for child in root.iter(f"{MAIN}sheetData"):
            child.clear()  # rows that are done


def sheets(files: DataFrame) -> DataFrame:
    """(file, sheet, place, member, run) of the sheets of the workbooks that ``files`` (path) lists."""

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with archive_at(path) as archive:
                    found = sheet_members(archive)
                    runs = sheet_runs(archive, found)
                columns = [[path] * len(found), [n for n, _ in found], list(range(len(found))), [m for _, m in found], runs]
                types = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32())
                names = ["file", "sheet", "place", "member", "run"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return files.select("path").mapInArrow(read, SHEETS)


def cells(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """(file, sheet, row, column, value) of the workbooks that ``files`` (path) lists; rows and columns from 1."""
    spark = files.sparkSession
    spread = sheets(files).repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "run")
    spread = spread.sortWithinPartitions("file", "run", "place")

    def batch_of(file: str, sheet: str, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([file] * len(rows)), pa.array([sheet] * len(rows), pa.string())]
        columns += [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["file", "sheet", "row", "column", "value"])

    def read(batches):
        held, strings = None, []
        for batch in batches:
            for file, sheet, _, member, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with archive_at(file) as archive:
                    if file != held:
                        held, strings = file, shared_strings(archive)
                    rows = []
                    with archive.open(member) as source:
                        for cell in cells_of(source, strings):
                            rows.append(cell)
                            if len(rows) >= BATCH:
                                yield batch_of(file, sheet, rows)
                                rows = []
                    if rows:
                        yield batch_of(file, sheet, rows)

    return spread.mapInArrow(read, CELLS)


HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def workbook(named: dict[str, list[list[str | None]]]) -> bytes:
    """A workbook of text cells, its strings shared."""
    numbers: dict[str, int] = {}
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for place, rows in enumerate(named.values(), 1):
            lines = []
            for r, row in enumerate(rows, 1):
                one = [f'<c r="{column_letters(c)}{r}" t="s"><v>{numbers.setdefault(v, len(numbers))}</v></c>' for c, v in enumerate(row, 1) if v is not None]
                lines.append(f'<row r="{r}">{"".join(one)}</row>')
            out.writestr(f"xl/worksheets/sheet{place}.xml", f'{HEAD}<worksheet xmlns="{MAIN[1:-1]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        shared = "".join(f'<si><t xml:space="preserve">{escape(v)}</t></si>' for v in numbers)
        out.writestr("xl/sharedStrings.xml", f'{HEAD}<sst xmlns="{MAIN[1:-1]}">{shared}</sst>')
        listed = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(named, 1))
        out.writestr("xl/workbook.xml", f'{HEAD}<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{LINK[1:-3]}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(named) + 1))
        out.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships xmlns="{LINKS[1:-1]}">{links}</Relationships>')
    return buffer.getvalue()


def write_workbooks(rows: DataFrame, folder: str, sheet: str, values: list[str], head: list[list[str | None]]) -> DataFrame:
    """A workbook for each partition, with a sheet for each value of ``sheet``: the ``head`` rows, then the rows' ``values`` as text.

    Returns (path, n_sheets). A partition is held whole, as the format wants it; deal rows out before.
    """

    def write(batches):
        named: dict[str, list[list[str | None]]] = {}
        for batch in batches:
            for name, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                named.setdefault(name or "", [list(h) for h in head]).append(row)
        if named:
            system, base = opened(folder)
            name = f"{uuid.uuid4().hex}.xlsx"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None) as out:
                out.write(workbook(named))
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([len(named)])], ["path", "n_sheets"])

    chosen = [F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate([sheet, *values])]
    return rows.select(*chosen).mapInArrow(write, T._parse_datatype_string("path string, n_sheets long"))
