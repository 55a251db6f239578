"""Workbooks (Office Open XML spreadsheets) as cells, and cells as workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_MAIN, _OFFICE, _PACKAGE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
# fixed values of the file format: numbers of built-in formats that show a date or a time (the last two ranges in East Asian versions)
_DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48), *range(27, 37), *range(50, 59)])
_DURATION_FORMAT = 46

_C, _V, _IS, _T, _READING, _ROW = (_NS[1:] + tag for tag in ("c", "v", "is", "t", "rPh", "row"))
_WHOLE = re.compile(r"-?\d+").fullmatch

Cell = tuple[str, int, int, int, str, str, bool]


def is_date_format(code: str) -> str | None:
    """'d' for a number format that shows a date or a time of day, 't' for one that shows a duration, else None. Literals,
    escaped characters, colours and conditions don't count, nor do the sections for negative numbers, zero and text."""
    first = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code).split(";")[0]
    if re.search(r"\[(h+|m+|s+)\]", first, re.I):
        return "t"
    return "d" if re.search(r"[dmhysDMHYS]", re.sub(r"\[[^\]]*\]|General", "", first)) else None


def _styles(book: zipfile.ZipFile) -> list[str | None]:
    """For each cell style, what ``is_date_format`` says of its number format."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): is_date_format(f.get("formatCode", "")) for f in root.iter(_NS + "numFmt")}
    built_in = {n: "t" if n == _DURATION_FORMAT else "d" for n in _DATE_FORMATS}
    formats = built_in | own
    styles = root.find(_NS + "cellXfs")
    return [formats.get(int(x.get("numFmtId", "0"))) for x in styles] if styles is not None else []


def _text(node) -> str:
    """Text of a string item: its runs, without phonetic readings."""
    runs = [t for x in node if x.tag != _NS + "rPh" for t in (x.iter(_NS + "t"))]
    return "".join(t.text or "" for t in runs)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if node.tag == _NS + "si":
                out.append(_text(node))
                node.clear()
    return out


def place(ref: str) -> tuple[int, int]:
    """(row, column) of a reference like AB12."""
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", ref).groups()
    col = 0
    for ch in letters:
        col = col * 26 + ord(ch) - 64
    return int(digits), col


@lru_cache(1 << 15)
def _column(letters: str) -> int:
    return place(letters + "1")[1]


def _column_of(ref: str) -> int:
    """The column of a reference."""
    return _column(ref.rstrip("0123456789")) if ref[-1:].isdigit() else place(ref)[1]


@lru_cache(1 << 15)
def column_letters(col: int) -> str:
    out = ""
    while col:
        col, rest = divmod(col - 1, 26)
        out = chr(65 + rest) + out
    return out


def _number(text: str) -> str:
    """A number as digits without an exponent; whole numbers without a point stay as they are."""
    if _WHOLE(text):
        return text
    x = float(text)
    plain = repr(x)
    return f"{x:f}".rstrip("0") if "e" in plain else plain


def serial_date(serial: float, since_1904: bool) -> tuple[str, str]:
    """(value, kind) of a date serial: an ISO date and time, or the time of day alone for a fraction of the first day."""
    seconds = round(serial * 86400)
    if 0 <= serial < 1 and seconds < 86400:
        return f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}", "t"
    start = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 31) if serial < 60 else datetime(1899, 12, 30)  # (1900 has a 29th of February there)
    return (start + timedelta(seconds=seconds)).isoformat(), "d"


def _typed(kind: str, style: int, given: str | None, inline: str | None, shared: list[str], styles: list[str | None], since_1904: bool) -> tuple[str, str] | None:
    """(value, kind) of a cell from its type, its style, its value (None: no such element) and its inline text; kinds: s text,
    n number, d date and time, t time or duration, b boolean."""
    if inline is not None:
        return inline, "s"
    if not given:
        return ("", "s") if kind == "str" and given is not None else None
    if kind == "s":
        return shared[int(given)], "s"
    if kind == "b":
        return ("True" if given.strip() in ("1", "true") else "False"), "b"
    if kind == "d":
        return datetime.fromisoformat(given.strip().removesuffix("Z")).isoformat(), "d"
    if kind != "n":
        return given, "s"
    shown = styles[style] if style < len(styles) else None
    text = given.strip()
    if shown == "d" and float(text) >= 0:
        return serial_date(float(text), since_1904)
    if shown == "t":
        seconds = round(abs(float(text)) * 86400)
        return f"{'-' * (float(text) < 0)}{seconds // 3600}:{seconds // 60 % 60:02d}:{seconds % 60:02d}", "t"
    return _number(text), "n"


def _merged(book: zipfile.ZipFile, part: str) -> list[str]:
    """The references of a sheet's merged ranges, which stand behind its rows; nothing else of the sheet is kept. Marks are
    looked at from the piece on that has the word, or from the start where it may be written in wider characters."""
    found = []

    def start(name, attributes):
        if name == _NS[1:] + "mergeCell":
            found.append(attributes["ref"])

    parser = expat.ParserCreate(namespace_separator="}")
    with book.open(part) as f:
        piece, looks = f.read(1 << 16), False
        while piece:
            more = f.read(1 << 16)
            if not looks and (b"mergeCell" in piece + more[:8] or b"\0" in piece):
                looks, parser.StartElementHandler = True, start
            parser.Parse(piece, not more)
            piece = more
    return found


def _rows(book, part, shared, styles, since_1904) -> Iterator[tuple[int, dict[int, tuple[str, str]]]]:
    """(row, {column: (value, kind)}) of a sheet, in the order of its rows; rows and cells may lack their references. The sheet
    passes by in pieces: no more than the rows of one are held, and no tree is made of them."""
    rows: list[tuple[int, dict[int, tuple[str, str]]]] = []
    depth = last = col = cell_at = 0
    cells = cell = given = inline = taken = None  # taken: where text goes, that up to the next mark
    reading = False  # whether such texts of the cell as stand where the parser is are shown

    def start(name, attributes):
        nonlocal depth, last, col, cell_at, cells, cell, given, inline, taken, reading
        depth += 1
        taken = None
        if cell is not None:
            if depth == cell_at + 1:
                if name == _V and given is None:
                    given = taken = []
                elif name == _IS and inline is None:
                    inline, reading = [], True
            elif reading:
                if depth == cell_at + 2 and name == _READING:
                    reading = False
                elif name == _T:
                    taken = inline
        elif name == _C:
            if cells is not None:
                cell, cell_at, given, inline, reading = attributes, depth, None, None, False
        elif name == _ROW:
            last, cells, col = int(attributes.get("r", last + 1)), {}, 0

    def end(name):
        nonlocal depth, col, cells, cell, taken, reading
        taken = None
        if cell is not None:
            if depth == cell_at:
                col = _column_of(cell["r"]) if cell.get("r") else col + 1
                typed = _typed(cell.get("t", "n"), int(cell.get("s", "0")), None if given is None else "".join(given), None if inline is None else "".join(inline), shared, styles, since_1904)
                if typed is not None:
                    cells[col] = typed
                cell = None
            elif depth == cell_at + 1:
                reading = False
            elif depth == cell_at + 2 and name == _READING:
                reading = True
        elif name == _ROW and cells is not None:
            rows.append((last, cells))
            cells = None
        depth -= 1

    def characters(text):
        if taken is not None:
            taken.append(text)

    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, characters
    with book.open(part) as f:
        more = True
        while more:
            more = f.read(1 << 16)
            parser.Parse(more, not more)
            yield from rows
            rows.clear()


def workbook_cells(data: bytes) -> Iterator[Cell]:
    """A4: (sheet, sheet_no, row_no, col_no, value, kind, merged) of every worksheet: the cached values, row by row, so a sheet
    is never held as a tree. Rows without values are left out and the others numbered. Every cell of a merged range has the
    value of its first cell, if that has one (A5)."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared, styles = _shared_strings(book), _styles(book)
    targets = {r.get("Id"): (r.get("Target"), r.get("Type", "")) for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    settings = root.find(_NS + "workbookPr")
    since_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    for number, sheet in enumerate(root.find(_NS + "sheets"), 1):
        target, kind = targets[sheet.get(_REL)]
        if kind and not kind.endswith("/worksheet"):
            continue  # a chart has no cells
        part = target.lstrip("/") if target.lstrip("/").startswith("xl/") else f"xl/{target}"
        starts: dict[int, list] = {}
        for ref in _merged(book, part):
            (r1, c1), (r2, c2) = (place(x) for x in (ref.split(":") * 2)[:2])
            starts.setdefault(r1, []).append((r2, c1, c2))
        row_no = 0
        for _, cells, merged in _filled(_rows(book, part, shared, styles, since_1904), starts):
            if cells:
                row_no += 1
                for col, (value, kind) in sorted(cells.items()):
                    yield sheet.get("name"), number, row_no, col, value, kind, col in merged


def _filled(rows, starts: dict[int, list]) -> Iterator[tuple[int, dict, set[int]]]:
    """Rows with the cells of merged ranges filled in, also where the sheet leaves a row out; only open ranges are held."""
    open_: list[tuple[int, int, int, tuple[str, str]]] = []  # last row, columns, value
    at = 0

    def one(r: int, cells: dict):
        nonlocal open_
        open_ += [(r2, c1, c2, cells[c1]) for r2, c1, c2 in starts.get(r, ()) if c1 in cells]
        merged = set()
        for _, c1, c2, typed in open_:
            cells |= {c: typed for c in range(c1, c2 + 1)}
            merged.update(range(c1, c2 + 1))
        open_ = [x for x in open_ if x[0] > r]
        return r, cells, merged

    for r, cells in rows:
        while open_ and at + 1 < r:
            at += 1
            yield one(at, {})
        at = r
        yield one(r, cells)
    while open_:
        at += 1
        yield one(at, {})


# ---- writing

#: Characters of the distinct texts that a workbook shares among its cells.
MOST_SHARED = 1 << 22
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'

_STYLES = f"""<styleSheet xmlns="{_MAIN}"><numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy&quot;年&quot;m&quot;月&quot;d&quot;日&quot;"/><numFmt numFmtId="165" formatCode="[h]:mm:ss"/></numFmts>
<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>"""


def _cell_xml(ref: str, value: str, kind: str, shared: dict[str, int]) -> str:
    if kind == "n":
        return f'<c r="{ref}"><v>{escape(value)}</v></c>'
    if kind in ("d", "t"):
        if kind == "d":
            gap = datetime.fromisoformat(value) - datetime(1899, 12, 30)
            serial, style = gap.days + gap.seconds / 86400, 2 if gap.seconds == 0 and gap.days % 2 else 1
        else:
            h, m, s = map(int, value.split(":"))
            serial, style = (h * 3600 + m * 60 + s) / 86400, 3
        return f'<c r="{ref}" s="{style}"><v>{serial!r}</v></c>'
    if kind == "b":
        return f'<c r="{ref}" t="b"><v>{int(value == "True")}</v></c>'
    if kind == "i":
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    return f'<c r="{ref}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'


class _Book:
    """One workbook, written as its cells come: sheet by sheet, in the order of rows and columns. Of its cells, no more than a
    row is held, and the distinct shared texts up to ``MOST_SHARED`` characters; further texts are written into their cells."""

    def __init__(self, merges: dict[str, list[str]]):
        self.merges, self.shared, self.left, self.sheets = merges, {}, MOST_SHARED, []
        self.out = io.BytesIO()
        self.book = zipfile.ZipFile(self.out, "w")
        self.part, self.name, self.row, self.cells, self.text = None, None, None, [], []

    def _entry(self, name: str) -> zipfile.ZipInfo:
        entry = zipfile.ZipInfo(name)
        entry.compress_type, entry.compress_level = zipfile.ZIP_DEFLATED, 1
        return entry

    def put(self, name: str, text: str) -> None:
        self.book.writestr(self._entry(name), _XML + text)

    def add(self, sheet: str, number: int, row: int, col: int, value: str, kind: str) -> None:
        if self.part is None or sheet != self.name:
            self._end_sheet()
            self.sheets.append([number, len(self.sheets) + 1, sheet])
            self.part, self.name = self.book.open(self._entry(f"xl/worksheets/sheet{len(self.sheets)}.xml"), "w", force_zip64=True), sheet
            self.part.write(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        if row != self.row:
            self._end_row()
            self.row = row
        self.sheets[-1][0] = min(self.sheets[-1][0], number)
        if kind not in ("n", "d", "t", "b", "i") and value not in self.shared:
            self.left -= len(value)
            kind = kind if self.left >= 0 else "i"
        self.cells.append(_cell_xml(f"{column_letters(col)}{row}", value, kind, self.shared))

    def _end_row(self) -> None:
        if self.cells:
            self.text.append(f'<row r="{self.row}">{"".join(self.cells)}</row>')
            self.cells = []
        if len(self.text) >= 1000:
            self._write()

    def _write(self) -> None:
        self.part.write("".join(self.text).encode())
        self.text = []

    def _end_sheet(self) -> None:
        if self.part is not None:
            self._end_row()
            ranges = [f'<mergeCell ref="{m}"/>' for m in self.merges.get(self.name, ())]
            self.text.append("</sheetData>" + (f'<mergeCells count="{len(ranges)}">{"".join(ranges)}</mergeCells>' if ranges else "") + "</worksheet>")
            self._write()
            self.part.close()
            self.part = self.row = None

    def close(self) -> bytes:
        self._end_sheet()
        names = [i for _, i, _ in self.sheets]
        put = self.put
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in names)
        put("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>{types}</Types>')
        put("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        put("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for _, i, n in sorted(self.sheets)) + "</sheets></workbook>")
        more = len(names)
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in names) + f'<Relationship Id="rId{more + 1}" Type="{_OFFICE}/styles" Target="styles.xml"/><Relationship Id="rId{more + 2}" Type="{_OFFICE}/sharedStrings" Target="sharedStrings.xml"/></Relationships>')
        put("xl/styles.xml", _STYLES)
        put("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">' + "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in self.shared) + "</sst>")
        self.book.close()
        return self.out.getvalue()


def to_workbooks(cells: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """(path, content): a workbook for each path of cells (path, sheet, sheet_no, row_no, col_no, value, kind), with merged
    ranges (path, sheet, min_row, max_row, min_col, max_col). The cells of a workbook are sorted in the engine and written as
    they pass, in one task: only its compressed bytes are held as a whole, since they are one value. Workbooks are independent.
    Kinds as ``workbook_cells`` gives them, and "i" for text that is written into its cell."""
    rows = cells.where("value is not null").select("path", "sheet", *[F.col(c).cast("int").alias(c) for c in ("sheet_no", "row_no", "col_no")], "value", "kind", F.lit(None).cast("int").alias("max_row"), F.lit(None).cast("int").alias("max_col"))
    if merges is not None:
        ranges = merges.select("path", "sheet", F.lit(0).alias("sheet_no"), F.col("min_row").cast("int").alias("row_no"), F.col("min_col").cast("int").alias("col_no"), F.lit("").alias("value"), F.lit("merge").alias("kind"), F.col("max_row").cast("int").alias("max_row"), F.col("max_col").cast("int").alias("max_col"))
        rows = rows.unionByName(ranges)

    def run(batches):
        path, book, merges = None, None, {}
        for batch in batches:
            for at, sheet, number, row, col, value, kind, last_row, last_col in zip(*[c.to_pylist() for c in batch.columns]):
                if book is None or at != path:
                    if book is not None:
                        yield made(path, book)
                    merges = {}
                    path, book = at, _Book(merges)
                if kind == "merge":
                    merges.setdefault(sheet, []).append(f"{column_letters(col)}{row}:{column_letters(last_col)}{last_row}")
                else:
                    book.add(sheet, number, row, col, value, kind)
        if book is not None:
            yield made(path, book)

    def made(path, book) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([book.close()], pa.binary())], ["path", "content"])

    rows = rows.repartition("path").sortWithinPartitions("path", ~F.col("kind").eqNullSafe("merge"), "sheet", "row_no", "col_no", "sheet_no")
    return rows.mapInArrow(run, "path string, content binary")
