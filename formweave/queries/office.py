"""Minimal xlsx and docx bytes for tests and derived inputs."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from xml.sax.saxutils import escape

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_PKG = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def _ref(col: int, row: int) -> str:
    name = ""
    col += 1
    if col <= 26:
        return f"{chr(64 + col)}{row + 1}"
    while col:
        col, rest = divmod(col - 1, 26)
        name = chr(65 + rest) + name
    return f"{name}{row + 1}"


def xlsx(sheets: dict[str, list[list]], shared: bool = True, date1904: bool = False) -> bytes:
    """Cells: None, str, int/float, bool, ("date", serial), ("inline", text), ("error", text)."""
    strings: dict[str, int] = {}

    def cell(value, col, row):
        if value is None:
            return ""
        ref, kind = _ref(col, row), type(value)
        if kind is str:
            if not shared:
                return f'<c r="{ref}" t="str"><v>{escape(value)}</v></c>'
            return f'<c r="{ref}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'
        if kind is bool:
            return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
        if kind is tuple:
            kind, v = value
            if kind == "date":
                return f'<c r="{ref}" s="1"><v>{v}</v></c>'
            if kind == "error":
                return f'<c r="{ref}" t="e"><v>{v}</v></c>'
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>'

    parts = {}
    names = list(sheets)
    for n, name in enumerate(names, start=1):
        rows = "".join(
            f'<row r="{i + 1}">' + "".join(cell(v, j, i) for j, v in enumerate(row)) + "</row>"
            for i, row in enumerate(sheets[name])
            if row
        )
        parts[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet {_MAIN}><sheetData>{rows}</sheetData></worksheet>"
    listed = "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(names, start=1))
    base = '<workbookPr date1904="1"/>' if date1904 else "<workbookPr/>"
    parts["xl/workbook.xml"] = f"<workbook {_MAIN} {_REL}>{base}<sheets>{listed}</sheets></workbook>"
    rels = "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(names) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships {_PKG}>{rels}</Relationships>"
    items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
    parts["xl/sharedStrings.xml"] = f"<sst {_MAIN}>{items}</sst>"
    parts["xl/styles.xml"] = (
        f'<styleSheet {_MAIN}><numFmts><numFmt numFmtId="164" formatCode="yyyy/mm/dd"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
    )
    return _zip(parts)


def docx(
    paragraphs: list[str], table: list[list[str]] | None = None, header: str | None = None, footer: str | None = None
) -> bytes:
    def p(text):
        return f"<w:p><w:r><w:t>{escape(text)}</w:t></w:r></w:p>"

    body = "".join(p(t) for t in paragraphs)
    if table:
        rows = "".join(
            "<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in row) + "</w:tr>" for row in table
        )
        body += f"<w:tbl>{rows}</w:tbl>"
    parts, rels, refs = {}, "", ""
    for kind, text in (("header", header), ("footer", footer)):
        if text is not None:
            parts[f"word/{kind}1.xml"] = f"<w:hdr {_W}>{p(text)}</w:hdr>"
            rels += f'<Relationship Id="{kind}" Target="{kind}1.xml"/>'
            refs += f'<w:{kind}Reference w:type="default" r:id="{kind}"/>'
    body += f"<w:sectPr>{refs}</w:sectPr>"
    parts["word/document.xml"] = f"<w:document {_W} {_REL}><w:body>{body}</w:body></w:document>"
    parts["word/_rels/document.xml.rels"] = f"<Relationships {_PKG}>{rels}</Relationships>"
    return _zip(parts)


def _zip(parts: dict[str, str]) -> bytes:
    """A deflated archive of few small parts, laid out by hand: a writer object costs more than their bytes."""
    body, directory, at = [], [], 0
    for name, text in parts.items():
        shared, named, packed = _kept_part(name, text) if len(text) <= _KEPT else _part(name, text)
        body += [b"PK\3\4", shared, named, packed]
        directory += [b"PK\1\2\x14\0", shared, struct.pack("<HHHII", 0, 0, 0, 0, at), named]
        at += 30 + len(named) + len(packed)
    tail = b"".join(directory)
    end = struct.pack("<HHHHIIH", 0, 0, len(parts), len(parts), len(tail), at, 0)
    return b"".join([*body, tail, b"PK\5\6", end])


def _part(name: str, text: str) -> tuple[bytes, bytes, bytes]:
    """What both headers of a part share, its name and its deflated bytes."""
    raw, named = text.encode(), name.encode("ascii")
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15, 4)
    packed = deflate.compress(raw) + deflate.flush()
    # Version 2.0, deflated, 1980-01-01.
    return struct.pack("<HHHHHIIIHH", 20, 0, 8, 0, 33, zlib.crc32(raw), len(packed), len(raw), len(named), 0), named, packed


# Parts up to this size are remembered: styles and relations are the same in most files.
_KEPT = 1024
_kept_part = lru_cache(maxsize=256)(_part)
