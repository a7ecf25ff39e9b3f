"""Workbooks as rows of text cells."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from datetime import date, datetime, timedelta
from functools import cached_property
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions.dates import to_moment
from formweave.operators.daterange import ACCEPT_RATIO, SAMPLE_ROWS
from formweave.session import materialise

WORKBOOK_SUFFIXES = (".xlsx", ".xlsm")

# Texts a spreadsheet reader takes for a missing cell.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

ROWS_SCHEMA = (
    "path string, sheet string, sheet_idx int, row_idx int, header array<string>, cells array<string>, error string"
)
_ROWS = pa.schema(
    [
        ("path", pa.string()),
        ("sheet", pa.string()),
        ("sheet_idx", pa.int32()),
        ("row_idx", pa.int32()),
        ("header", pa.list_(pa.string())),
        ("cells", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)
_ROWS_PER_BATCH = 5_000
# Parts up to this size are parsed at once, larger ones as they are read.
_SMALL_PART = 1 << 20
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _local(tag: str) -> str:
    return tag[tag.rfind("}") + 1 :]


def _texts(element) -> str:
    """All text of a shared or inline string, phonetic hints left out."""
    out = []
    for child in element:
        name = _local(child.tag)
        if name == "t":
            out.append(child.text or "")
        elif name == "r":
            out += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(out)


# Parts without comments, entities or anything unusual are read by patterns that take well-formed XML
# only, since a parser costs more than a small part; all other parts go to the parser.
_ODD = re.compile("[\0-\x08\x0b-\x1f&\ufffe\uffff]")
_DECLARED = re.compile(r'<\?xml version="1\.0"(?: encoding="(?i:utf-8)")?(?: standalone="(?:yes|no)")?\?>[ \t\n]*')
_ADDRESS = '"http://(?:schemas|purl)[.][a-zA-Z0-9./]+"'
_NAMES, _VALUE = f"(?: xmlns={_ADDRESS})?", r'"[^"<>\t\n]*"'
_CELL = (
    '<c(?: r="(?:([A-Z])|([A-Z]{2,3}))[0-9]+")?(?: s="([0-9]+)")?(?: t="(s|b|n|str|e|d)")?'
    "(?:/>|>(?:<f>[^<>]*</f>)?(?:<v>([^<>]*)</v>)?</c>)"
)
_ROW = '<row(?: r="([0-9]+)")?(?: spans="[0-9: ]*")?'
_ROWS_PART = re.compile(rf"<worksheet{_NAMES}><sheetData>(?:{_ROW}(?:/>|>(?:{_CELL})*+</row>))*+</sheetData></worksheet>[ \t\n]*")
_ROW_OR_CELL = re.compile(f"(<r){_ROW[2:]}|{_CELL}")
_STRINGS_PART = re.compile(rf'<sst{_NAMES}(?: count="[0-9]+")?(?: uniqueCount="[0-9]+")?>(?:<si><t>[^<>]*</t></si>)*+</sst>[ \t\n]*')
_STRING = re.compile("<t>([^<>]*)</t>")
_SHEET = f'<sheet name=({_VALUE}) sheetId="[0-9]+"(?: state="[a-zA-Z]+")? r:id=({_VALUE})/>'
_BOOK_PART = re.compile(
    rf'<workbook{_NAMES} xmlns:r={_ADDRESS}>(?:<workbookPr(?: date1904="([a-z0-9]*)")?/>)?<sheets>(?:{_SHEET})*+</sheets></workbook>[ \t\n]*'
)
_SHEET = re.compile(_SHEET)
_LINK = f"<Relationship Id=({_VALUE})(?: Type={_VALUE})? Target=({_VALUE})(?: TargetMode={_VALUE})?/>"
_LINKS_PART = re.compile(rf"<Relationships{_NAMES}>(?:{_LINK})*+</Relationships>[ \t\n]*")
_LINK = re.compile(_LINK)
_FORMAT, _STYLE = f'<numFmt numFmtId="([0-9]+)" formatCode=({_VALUE})/>', '<xf numFmtId="([0-9]+)"(?: fontId="[0-9]+")?(?: fillId="[0-9]+")?(?: borderId="[0-9]+")?/>'
_STYLES_PART = re.compile(
    rf'<styleSheet{_NAMES}>(?:<numFmts(?: count="[0-9]+")?>(?:{_FORMAT})*+</numFmts>)?<cellXfs(?: count="[0-9]+")?>(?:{_STYLE})*+</cellXfs></styleSheet>[ \t\n]*'
)
_FORMAT, _STYLE = re.compile(_FORMAT), re.compile(_STYLE)
# Of an entry of an archive's directory; times and attributes are passed over.
_ENTRY = struct.Struct("<4s2xHHH4xIIIHHHH6xI")

_LENGTHS = struct.Struct("<HH")


def _plain(raw: bytes | None, whole: re.Pattern) -> str | None:
    """The text of a part that has the form of a pattern; None for any other."""
    if raw is None:
        return None
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    if text[:2] == "<?" and (declared := _DECLARED.match(text)):
        text = text[declared.end() :]
    return text if whole.fullmatch(text) and not _ODD.search(text) and "]]>" not in text else None


def _directory(content: bytes) -> dict[str, tuple[int, int, int, int, int, int, bytes]] | None:
    """name: (method, flags, crc, packed size, size, offset, raw name) of an ordinary archive's parts; None for any other."""
    if content[-22:-18] != b"PK\5\6":
        return None
    disk, first, here, parts, size, start, comment = struct.unpack("<HHHHIIH", content[-18:])
    if disk or first or here != parts or comment or start + size + 22 != len(content):
        return None
    out, at, end, unpack = {}, start, start + size, _ENTRY.unpack_from
    for _ in range(parts):
        if at + 46 > end:
            return None
        mark, version, flags, method, crc, packed, full, named, extra, note, disk, offset = unpack(content, at)
        name = content[at + 46 : at + 46 + named]
        if mark != b"PK\1\2" or version > 45 or extra or note or disk or not name.isascii() or b"\0" in name:
            return None
        if packed == 0xFFFFFFFF or full == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            return None
        out[name.decode()] = method, flags, crc, packed, full, offset, name
        at += 46 + named
    return out if at == end else None


class _Book:
    """The parts of a workbook that its cells refer to."""

    def __init__(self, content: bytes):
        self.content = content
        self.parts = _directory(content)
        if self.parts is None:
            self.parts = {
                name: (i.compress_type, i.flag_bits, i.CRC, i.compress_size, i.file_size, i.header_offset, i.orig_filename.encode("utf-8" if i.flag_bits & 0x800 else "cp437"))
                for name, i in self.zip.NameToInfo.items()
            }
        self.base = datetime(1899, 12, 30)
        self.sheets: list[tuple[str, str]] = []
        self._link()
        self.shared = self._strings() if "xl/sharedStrings.xml" in self.parts else []
        self.date_styles = self._date_styles() if "xl/styles.xml" in self.parts else set()

    @cached_property
    def zip(self) -> zipfile.ZipFile:
        return zipfile.ZipFile(io.BytesIO(self.content))

    def read(self, part: str) -> bytes:
        raw = self._cut(part)
        return self.zip.read(part) if raw is None else raw

    def _cut(self, part: str) -> bytes | None:
        """The bytes of an ordinary part, cut from the book without a reader of their own; None for any other."""
        if part not in self.parts:
            return None
        method, flags, crc, packed, size, offset, name = self.parts[part]
        content, at = self.content, offset + 30
        if method not in (0, 8) or flags & 0x61 or len(content) < at or content[offset : offset + 4] != b"PK\3\4":
            return None
        named, more = _LENGTHS.unpack_from(content, offset + 26)
        start = at + named + more
        raw = content[start : start + packed]
        if content[at : at + named] != name or len(raw) != packed:
            return None
        if method:
            try:
                raw = zlib.decompress(raw, -15, size or 1)
            except zlib.error:
                return None
        return raw if len(raw) == size and zlib.crc32(raw) == crc else None

    def _small(self, part: str) -> bytes | None:
        """The bytes of a small ordinary part."""
        return self._cut(part) if part in self.parts and self.parts[part][4] <= _SMALL_PART else None

    def elements(self, part: str, name: str) -> Iterator[ElementTree.Element]:
        """The elements of a name in a part, in order; a large or broken part is parsed as it is read."""
        root = None
        if (raw := self._small(part)) is not None:
            try:
                root = ElementTree.fromstring(raw)
            except ElementTree.ParseError:
                pass
        if root is not None:
            end = "}" + name
            yield from [e for e in root.iter() if e.tag == name or e.tag.endswith(end)]
            return
        with self.zip.open(part) as f:
            for _, e in ElementTree.iterparse(f):
                if _local(e.tag) == name:
                    yield e
                    e.clear()

    def _link(self) -> None:
        """The base of dates, and each sheet's name and part."""
        book = self.read("xl/workbook.xml")
        text = _plain(book, _BOOK_PART)
        if text is not None:
            modes, sheets = [_BOOK_PART.match(text)[1]], [(name[1:-1], ref[1:-1]) for name, ref in _SHEET.findall(text)]
        else:
            found = list(ElementTree.fromstring(book).iter())
            modes = [e.get("date1904") for e in found if _local(e.tag) == "workbookPr"]
            sheets = [(e.get("name"), next(v for k, v in e.attrib.items() if _local(k) == "id")) for e in found if _local(e.tag) == "sheet"]
        rels = self.read("xl/_rels/workbook.xml.rels")
        text = _plain(rels, _LINKS_PART)
        if text is not None:
            targets = {ref[1:-1]: target[1:-1] for ref, target in _LINK.findall(text)}
        else:
            targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(rels)}
        if any(mode in ("1", "true") for mode in modes):
            self.base = datetime(1904, 1, 1)
        self.base_day = self.base.toordinal()
        for name, ref in sheets:
            target = targets[ref].lstrip("/")
            self.sheets.append((name, target if target.startswith("xl/") else f"xl/{target}"))

    def _strings(self) -> list[str]:
        text = _plain(self._small("xl/sharedStrings.xml"), _STRINGS_PART)
        if text is not None:
            return _STRING.findall(text)
        return [_texts(e) for e in self.elements("xl/sharedStrings.xml", "si")]

    def _date_styles(self) -> set[int]:
        raw = self.read("xl/styles.xml")
        text = _plain(raw, _STYLES_PART)
        if text is None:
            root = ElementTree.fromstring(raw)
            custom = {int(e.get("numFmtId")): e.get("formatCode") or "" for e in root.iter() if _local(e.tag) == "numFmt"}
            formats = [int(x.get("numFmtId") or 0) for e in root if _local(e.tag) == "cellXfs" for x in e]
        else:
            custom = {int(number): code[1:-1] for number, code in _FORMAT.findall(text)}
            formats = [int(number) for number in _STYLE.findall(text)]

        def is_date(number: int) -> bool:
            if number in _DATE_FORMATS or number not in custom:
                return number in _DATE_FORMATS
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", custom[number])
            return bool(re.search("[dmyhs]", code, re.IGNORECASE))

        return {i for i, number in enumerate(formats) if is_date(number)}

    def value(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return next((_texts(e) for e in cell if _local(e.tag) == "is"), None)
        raw = None
        for e in cell:
            if _local(e.tag) == "v":
                raw = e.text
                break
        return self.text(kind, raw, cell.get("s"))

    def text(self, kind: str, raw: str | None, style: str | None) -> str | None:
        """A cell's value as text."""
        if raw is None or kind == "e":
            return None
        if kind == "s":
            return self.shared[int(raw)]
        if kind == "b":
            return "True" if raw == "1" else "False"
        if kind == "d":
            return str(datetime.fromisoformat(raw.replace("Z", "")))
        if kind != "n":
            return raw
        if raw.isascii() and raw.isdigit() and len(raw) <= 6:
            # Whole days and numbers, the same as below.
            days = int(raw)
            return f"{date.fromordinal(self.base_day + days)} 00:00:00" if style and int(style) in self.date_styles else str(days)
        number = float(raw)
        if int(style or 0) in self.date_styles:
            moment = self.base + timedelta(milliseconds=round(number * 86_400_000))
            return str(moment)
        return str(int(number)) if number == int(number) else repr(number)

    def rows(self, part: str) -> Iterator[tuple[int, list[str | None]]]:
        """(row number from 0, cells) of a sheet; gaps are null cells."""
        text = _plain(self._small(part), _ROWS_PART)
        if text is not None:
            yield from self._plain_rows(text)
            return
        at = -1
        for e in self.elements(part, "row"):
            at = int(e.get("r")) - 1 if e.get("r") else at + 1
            cells: list[str | None] = []
            for cell in e:
                ref = cell.get("r")
                place = _column(ref) if ref else len(cells)
                cells += [None] * (place - len(cells))
                cells.append(self.value(cell))
            yield at, cells

    def _plain_rows(self, text: str) -> Iterator[tuple[int, list[str | None]]]:
        at, cells = -1, None
        for row, number, letter, letters, style, kind, raw in _ROW_OR_CELL.findall(text):
            if row:
                if cells is not None:
                    yield at, cells
                at, cells = int(number) - 1 if number else at + 1, []
                continue
            if letter or letters:
                place = ord(letter) - 65 if letter else _column(letters)
                if place > len(cells):
                    cells += [None] * (place - len(cells))
            cells.append(self.text(kind or "n", raw or None, style))
        if cells is not None:
            yield at, cells


def _column(ref: str) -> int:
    if ref[1:2].isdigit() and "A" <= ref[0] <= "Z":
        return ord(ref[0]) - 65
    number = 0
    for c in ref:
        if not c.isalpha():
            break
        number = number * 26 + ord(c.upper()) - 64
    return number - 1


def _header(cells: Sequence[str | None]) -> list[str]:
    """Unique column names: gaps are named by place, repeats numbered."""
    used: dict[str, int] = {}
    out = []
    for i, cell in enumerate(cells):
        name = f"Unnamed: {i}" if cell is None else cell
        n = used.get(name, 0)
        used[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def decode_workbooks(
    files: DataFrame,
    sheet: int | str | None = None,
    columns: Sequence[str] | None = None,
    header_row: int = 0,
    start_row: int | None = None,
    header_only: bool = False,
    dated: bool = False,
) -> DataFrame:
    """Rows of the workbooks in (path, content) files.

    Every data row carries its sheet's header, so no later step has to join
    headers to rows. ``sheet`` picks one by number or name; other sheets are
    not parsed. ``columns`` keeps those header names only. Rows count from 0;
    data starts below the header unless ``start_row`` says otherwise. A sheet
    without data gives one row with null cells, a broken file one with an error.
    ``dated`` adds date_idx, the place of the sheet's date column (as date_columns()
    finds it), with no group or join: a sheet is one task's work already.
    """
    first = header_row + 1 if start_row is None else start_row
    if dated and first <= header_row:
        raise ValueError("date columns need data below the header")
    keep = set(columns) if columns is not None else None

    def read(book: _Book, path: str, out: _Stretches) -> Iterator[None]:
        for i, (name, part) in enumerate(book.sheets):
            if sheet is not None and sheet not in (i, name):
                continue
            header, places, any_row = [], None, False
            out.open(path, name, i, header)
            for at, cells in book.rows(part):
                if at == header_row:
                    header = _header(cells)
                    if keep is not None:
                        places = [p for p, h in enumerate(header) if h.strip() in keep]
                        header = [header[p] for p in places]
                    out.open(path, name, i, header)
                    if header_only:
                        break
                if at >= first:
                    if places is not None:
                        cells = [cells[p] if p < len(cells) else None for p in places]
                    if len(out.ats) >= _ROWS_PER_BATCH:
                        if dated and out.sample is None and not _DATE_NAME.search("\n".join(header)):
                            out.sample = _first_rows(book.rows(part), first, places)
                        yield
                    any_row = True
                    out.add(at, cells)
            if not any_row:
                out.add(first, None)
            elif dated and out.sample is None and not _DATE_NAME.search("\n".join(header)):
                out.sample = _first_rows(out.rows(), first, None)

    def decode(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = _Stretches(dated)
            # A book at a time leaves the batch, and its rows in stretches.
            for path, content in zip(batch.column(0), batch.column(1)):
                path = path.as_py()
                try:
                    for _ in read(_Book(content.as_py()), path, out):
                        yield out.flush()
                except Exception as e:  # noqa: BLE001 - a broken file is a row, not a failed job
                    out.open(path, None, None, None)
                    out.add(None, None, f"{type(e).__name__}: {e}")
                if len(out.ats) >= _ROWS_PER_BATCH:
                    yield out.flush()
                    out.close()
            if out.ats:
                yield out.flush()

    found = files.select("path", "content").mapInArrow(decode, _STRETCH_SCHEMA + (", sample array<array<string>>" if dated else ""))
    names = [f.name for f in _ROWS]
    if dated:
        found, names = found.withColumn("date_idx", _date_place()), [*names, "date_idx"]
    return found.select("path", "sheet", "sheet_idx", "header", "error", *names[len(_ROWS) :], F.inline("rows")).select(*names)


_STRETCH_SCHEMA = (
    "path string, sheet string, sheet_idx int, header array<string>, error string, rows array<struct<row_idx int, cells array<string>>>"
)
# As rlike() in by_name() reads it: letters of any case are ASCII.
_DATE_NAME = re.compile("date|time|日期|时间", re.IGNORECASE | re.ASCII)


def _first_rows(rows: Iterable[tuple[int, list | None]], first: int, places: list[int] | None) -> list[list]:
    """The cells of a sheet's data rows that lie within SAMPLE_ROWS of its first, wherever they stand."""
    least, kept = None, []
    try:
        for at, cells in rows:
            if at < first or cells is None or (least is not None and at >= least + SAMPLE_ROWS):
                continue
            if least is None or at < least:
                least = at
                kept = [k for k in kept if k[0] < least + SAMPLE_ROWS]
            kept.append((at, cells if places is None else [cells[p] if p < len(cells) else None for p in places]))
    except Exception:  # noqa: BLE001 - rows before a break are read, the break is told by the caller
        pass
    return [cells for _, cells in kept]


class _Stretches:
    """Rows of sheets on their way out: one stretch holds rows of one sheet under one header."""

    def __init__(self, sampled: bool):
        self.sampled = sampled
        self.sample: list | None = None
        self.sheet: tuple | None = None
        self._clear()

    def _clear(self) -> None:
        self.heads: list[tuple] = []
        self.samples: list[list | None] = []
        self.starts: list[int] = []
        self.ats: list[int | None] = []
        self.ends: list[int | None] = [0]
        self.cells: list[str | None] = []
        self.size = 0
        self.opened = False

    def open(self, path: str | None, name: str | None, place: int | None, header: list[str] | None) -> None:
        """The rows that follow belong to this sheet and header."""
        self._end_sample()
        self.sheet, self.opened, self.sample = (path, name, place, header), False, None

    def close(self) -> None:
        self.opened, self.sample = False, None

    def _end_sample(self) -> None:
        if self.opened:
            self.samples[-1] = self.sample

    def add(self, at: int | None, cells: list[str | None] | None, error: str | None = None) -> None:
        if not self.opened:
            self.heads.append((*self.sheet, error))
            self.samples.append(None)
            self.starts.append(len(self.ats))
            self.opened = True
        self.ats.append(at)
        if cells is None:
            # A null row: an offset that is null leaves its cells out.
            self.ends[-1] = None
            self.ends.append(self.size)
        else:
            self.cells += cells
            self.size += len(cells)
            self.ends.append(self.size)

    def rows(self) -> Iterator[tuple[int, list[str | None]]]:
        """The rows of the open stretch."""
        ends, start = self.ends, self.starts[-1]
        for i in range(start, len(self.ats)):
            yield self.ats[i], self.cells[ends[i] : ends[i + 1]]

    def flush(self) -> pa.RecordBatch:
        """All rows so far; the open sheet goes on with its header and sample."""
        self._end_sample()
        path, name, place, header, error = zip(*self.heads)
        cells = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.cells, pa.string()))
        rows = pa.StructArray.from_arrays([pa.array(self.ats, pa.int32()), cells], names=["row_idx", "cells"])
        columns = [
            pa.array(path, pa.string()), pa.array(name, pa.string()), pa.array(place, pa.int32()), pa.array(header, pa.list_(pa.string())),
            pa.array(error, pa.string()), pa.ListArray.from_arrays(pa.array([*self.starts, len(self.ats)], pa.int32()), rows),
        ]
        names = ["path", "sheet", "sheet_idx", "header", "error", "rows"]
        if self.sampled:
            columns, names = [*columns, pa.array(self.samples, pa.list_(pa.list_(pa.string())))], [*names, "sample"]
        self._clear()
        return pa.record_batch(columns, names=names)


def _date_place() -> Column:
    """The place of the date column of a stretch's sheet, null if none."""
    width = F.array_max(F.transform("sample", F.size))

    def ratio(i: Column) -> Column:
        dates = F.aggregate("sample", F.lit(0.0), lambda n, cells: n + _readable(F.get(cells, i)))
        # A row too short for the column counts as a row without a date.
        return dates / F.size("sample")

    places = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.struct((-ratio(i)).alias("minus"), i.alias("i")))
    by_content = F.array_min(F.filter(places, lambda p: p["minus"] <= -ACCEPT_RATIO))["i"]
    return F.when(
        F.col("path").isNotNull() & F.col("sheet").isNotNull(), F.coalesce(_by_name(), F.when(width > 0, by_content))
    )


def headers(rows: DataFrame) -> DataFrame:
    """path, sheet, header: one row per sheet."""
    return rows.groupBy("path", "sheet_idx", "sheet").agg(F.any_value("header").alias("header"))


def long_cells(rows: DataFrame) -> DataFrame:
    """path, sheet, row_idx, col_idx, value: one row per filled cell."""
    return (
        rows.select("path", "sheet", "row_idx", F.posexplode("cells").alias("col_idx", "value"))
        .filter(F.col("value").isNotNull())
    )


def wide(rows: DataFrame, header: Sequence[str]) -> DataFrame:
    """Rows of sheets sharing ``header`` as an ordinary table."""
    cells = [_missing_to_null(F.get("cells", F.lit(i))).alias(h) for i, h in enumerate(header)]
    return rows.filter(F.col("cells").isNotNull()).select("path", "sheet", "row_idx", *cells)


def _missing_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(MISSING_TEXTS), cell)


def records(rows: DataFrame) -> DataFrame:
    """Rows as maps of stripped header name to cell, missing cells null."""
    names = F.transform("header", lambda h: F.trim(h))
    padded = F.transform(
        F.sequence(F.lit(0), F.size("header") - 1),
        lambda i: _missing_to_null(F.get("cells", i)),
    )
    filled = rows.filter(F.col("cells").isNotNull() & (F.size("header") > 0))
    return filled.select(
        "path", "sheet_idx", "sheet", "row_idx", F.map_from_arrays(names, padded).alias("record")
    )


def date_columns(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """path, sheet, date_idx: each sheet's date column, null if none.

    By name first, else by the share of the sheet's first rows that read as
    dates. Only sample rows take part, so the aggregate stays small.
    """
    keys = ["path", "sheet_idx", "sheet"]
    # One row per sheet; its size decides whether the rows below are shuffled.
    named = materialise(
        rows.groupBy(*keys).agg(F.min(_by_name()).alias("by_name"), F.min("row_idx").alias("first"))
    )
    small = rows.join(named.filter("by_name is null"), keys).filter(
        F.col("row_idx") < F.col("first") + sample_rows
    )
    ratios = (
        small.select(*keys, F.posexplode("cells").alias("i", "cell"))
        .groupBy(*keys, "i")
        .agg(F.sum(_readable(F.col("cell"))).alias("dates"))
        # A row too short for the column counts as a row without a date.
        .join(small.groupBy(*keys).agg(F.count("*").alias("sampled")), keys)
        .withColumn("ratio", F.col("dates") / F.col("sampled"))
        .filter(F.col("ratio") >= ACCEPT_RATIO)
        .groupBy(*keys)
        .agg(F.min_by("i", F.struct(-F.col("ratio"), F.col("i"))).alias("by_content"))
    )
    return named.join(ratios, keys, "left").select(
        *keys, F.coalesce("by_name", "by_content").alias("date_idx")
    )


def _by_name() -> Column:
    """The first column of the header whose name is that of a date."""
    return F.array_min(
        F.filter(
            F.transform("header", lambda h, i: F.when(h.rlike("(?i)date|time|日期|时间"), i)),
            lambda i: i.isNotNull(),
        )
    )


def _readable(cell: Column) -> Column:
    # A bare number is no date here: number cells are not date candidates.
    is_date = to_moment(cell).isNotNull() & ~cell.rlike("^[0-9.]+$")
    return F.coalesce(is_date, F.lit(False)).cast("double")


def filter_rows(
    rows: DataFrame, ranges: DataFrame, inclusive_day: bool = False, written: bool = False
) -> DataFrame:
    """Workbook rows in the range; sheets without a date column pass whole.

    Rows decoded with their date_idx are filtered where they lie; for others it is found first.
    """
    columns = [c for c in rows.columns if c != "date_idx"]
    if "date_idx" in rows.columns:
        dated = rows
    else:
        # Decoding is the dear part and the rows are read three times from here.
        rows = rows if written else materialise(rows)
        # One row per sheet: written, the planner sees whether it can be broadcast.
        dated = rows.join(materialise(date_columns(rows.filter("cells IS NOT NULL"))), ["path", "sheet_idx", "sheet"], "left")
    start = ranges.select("start_date").scalar()
    end = ranges.select("end_date").scalar()
    at = to_moment(F.get("cells", F.col("date_idx")))
    last = at < F.date_add(end, 1).cast("timestamp") if inclusive_day else at <= end.cast("timestamp")
    inside = (at >= start.cast("timestamp")) & last
    passes = F.col("date_idx").isNull() | F.col("cells").isNull()
    return dated.filter(passes | F.coalesce(inside, F.lit(False))).select(*columns)
