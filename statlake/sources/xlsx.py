"""Spreadsheet workbooks (S2): a sheet of each as rows of text.

Files are listed and read by Spark (``binaryFile``), so a path may be on any
file system Spark knows. A workbook is a zip archive and cannot be split, like a gzip
file: it is one task, which streams the sheet's XML. One distributed pass
reads the header rows (all workbooks at once) to declare the schema; no data rows pass
through the driver.

Every value is read as text (numbers as stored, e.g. ``1987`` or ``0.25``);
typing is done later with ``try_cast``. Rows whose cells are all empty are
dropped.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree.ElementTree import iterparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# XML namespaces of the Office Open XML spreadsheet format.
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _tag(local: str) -> str:
    return f"{{{NS_MAIN}}}{local}"


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def column_index(ref: str) -> int:
    """``'C7'`` -> 2 (0-based column of a cell reference)."""
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _sheet_path(zf: zipfile.ZipFile, sheet: str | None) -> str:
    """Archive member holding the named (or first) sheet."""
    from xml.etree.ElementTree import fromstring

    book = fromstring(zf.read("xl/workbook.xml"))
    sheets = book.find(_tag("sheets"))
    if sheets is None or len(sheets) == 0:
        raise ValueError("workbook has no sheets")
    chosen = None
    for s in sheets:
        if sheet is None or s.get("name") == sheet:
            chosen = s
            break
    if chosen is None:
        names = [s.get("name") for s in sheets]
        raise ValueError(f"sheet {sheet!r} not found; sheets: {names}")
    rid = chosen.get(f"{{{NS_REL}}}id")
    rels = fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rid:
            target = rel.get("Target")
            if target.startswith("/"):
                return target.lstrip("/")
            return posixpath.normpath(posixpath.join("xl", target))
    raise ValueError(f"no relationship {rid} for sheet {sheet!r}")


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    """Shared string table (rich-text runs joined)."""
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out: list[str] = []
    with zf.open("xl/sharedStrings.xml") as fh:
        parts: list[str] = []
        for event, el in iterparse(fh, events=("start", "end")):
            if event == "start" and el.tag == _tag("si"):
                parts = []
            elif event == "end" and el.tag == _tag("t"):
                parts.append(el.text or "")
            elif event == "end" and el.tag == _tag("rPh"):
                # phonetic hints are not part of the text
                el.clear()
            elif event == "end" and el.tag == _tag("si"):
                out.append("".join(parts))
                el.clear()
    return out


def _cell_text(c, strings) -> str | None:
    kind = c.get("t")
    if kind == "inlineStr":
        is_el = c.find(_tag("is"))
        return "".join(t.text or "" for t in is_el.iter(_tag("t"))) if is_el is not None else None
    v = c.find(_tag("v"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return strings[int(v.text)]
    if kind == "b":
        return "true" if v.text.strip() == "1" else "false"
    return v.text


def iter_rows(zf: zipfile.ZipFile, member: str, strings) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column index: text}) for each row element, streaming."""
    last = 0
    with zf.open(member) as fh:
        for _event, el in iterparse(fh, events=("end",)):
            if el.tag == _tag("row"):
                ref = el.get("r")
                last = int(ref) if ref else last + 1
                cells: dict[int, str] = {}
                for pos, c in enumerate(el.iter(_tag("c"))):
                    ref = c.get("r")
                    idx = column_index(ref) if ref else pos
                    text = _cell_text(c, strings)
                    if text is not None and text != "":
                        cells[idx] = text
                yield last, cells
                el.clear()


def _header_names(cells: dict[int, str], first_blank: str) -> list[str]:
    width = max(cells) + 1 if cells else 0
    names, seen = [], set()
    for i in range(width):
        raw = cells.get(i)
        name = str(raw).strip() if raw is not None and str(raw).strip() else (first_blank if i == 0 else f"_c{i}")
        base, k = name, 1
        while name in seen:
            k += 1
            name = f"{base}_{k}"
        seen.add(name)
        names.append(name)
    return names


@dataclass(frozen=True)
class Sheet:
    """Which sheet (None: the first) and where its header stands (rows from 0)."""

    name: str | None = None
    header_row: int = 0
    skip_rows_after_header: int = 0
    first_blank_header: str = "Year"

    def rows(self, content: bytes, path: str) -> Iterator[list[str] | dict[int, str]]:
        """The header names, then the cells of each data row by column."""
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            member = _sheet_path(zf, self.name)
            strings = _shared_strings(zf)
            header_at, found = self.header_row + 1, False
            for number, cells in iter_rows(zf, member, strings):
                if number == header_at:
                    found = True
                    yield _header_names(cells, self.first_blank_header)
                elif number > header_at and not found:
                    break
                elif number > header_at + self.skip_rows_after_header and cells:
                    yield cells  # the skip is positional: the rows right after the header
            if not found:
                raise ValueError(f"{path}: header row {header_at} not found")


def read_xlsx(
    spark: SparkSession,
    path: str | Sequence[str],
    sheet: str | None = None,
    header_row: int = 0,
    skip_rows_after_header: int = 0,
    first_blank_header: str = "Year",
    source_column: str | None = None,
) -> DataFrame:
    """One sheet of each workbook, all values text.

    * ``path``: a workbook, a folder of workbooks, or a list of these. Each is
      taken literally: commas and glob characters are part of the name.
    * ``sheet``: its name (default: the first sheet).
    * ``header_row`` (from 0); ``skip_rows_after_header`` rows below it are dropped.
    * a blank header in the first column becomes ``first_blank_header``, others ``_c<i>``.
    * ``source_column``: if set, a column with the workbook's path.

    Columns are matched by name; a workbook without one has NULLs in it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    what = Sheet(sheet, header_row, skip_rows_after_header, first_blank_header)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load([literal_path(p) for p in paths])
    files = files.select("path", "content")

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [next(what.rows(c.as_py(), p.as_py())) for p, c in zip(batch.column("path"), batch.column("content"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(names, pa.list_(pa.string()))], ["path", "names"])

    # one row of names for each workbook
    found = sorted(files.mapInArrow(headers, "path string, names array<string>").collect(), key=lambda r: r["path"])
    if not found:
        raise FileNotFoundError(f"no workbook at {path!r}")
    names = list(dict.fromkeys(n for r in found for n in r["names"]))
    every = [*names, *([source_column] if source_column else [])]

    def data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, c in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = what.rows(c.as_py(), p)
                own = next(rows)
                held: list[dict[int, str]] = []
                for cells in rows:
                    held.append(cells)
                    if len(held) == 4096:
                        yield _columns(held, own, names, p if source_column else None, every)
                        held = []
                if held:
                    yield _columns(held, own, names, p if source_column else None, every)

    return files.mapInArrow(data, StructType([StructField(n, StringType(), True) for n in every]))


def _columns(rows: list[dict[int, str]], own: list[str], names: list[str], source: str | None, every: list[str]) -> pa.RecordBatch:
    at = {n: i for i, n in enumerate(own)}
    rows = [r for r in rows if any(i < len(own) for i in r)]
    columns = [pa.array([r.get(at[n]) if n in at else None for r in rows], pa.string()) for n in names]
    if source is not None:
        columns.append(pa.array([source] * len(rows), pa.string()))
    return pa.RecordBatch.from_arrays(columns, every)
