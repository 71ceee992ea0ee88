"""XLSX workbook scan (first sheet, first row is the header).

Spark's ``binaryFile`` source lists and reads the workbooks (any Hadoop
filesystem, one file per row, partition pruning by glob), and each workbook
is unpacked inside an executor task with the standard library (``zipfile`` +
``ElementTree``) in ``mapInPandas``; rows come out as text and are cast to the
declared schema by Spark. Many workbooks scan in parallel. A sheet's rows are parsed
as they stream out of the archive and leave in batches of ``BATCH_ROWS``, so a task holds
the compressed file and one batch, not the sheet. The writer likewise streams rows
into the archive and begins another workbook after ``BOOK_ROWS`` rows, whatever
the size of its partition.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
BATCH_ROWS = 1 << 13
BOOK_ROWS = 1 << 16         # rows of a written workbook; the format's own limit is 2^20


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_name(z: zipfile.ZipFile) -> str:
    names = z.namelist()
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        first = wb.find("m:sheets/m:sheet", _NS)
        rid = first.get(f"{{{_REL_NS}}}id")
        for r in rels:
            if r.get("Id") == rid:
                target = r.get("Target").lstrip("/")
                return target if target.startswith("xl/") else f"xl/{target}"
    except (KeyError, AttributeError):
        pass
    sheets = sorted(n for n in names if n.startswith("xl/worksheets/sheet"))
    if not sheets:
        raise ValueError("workbook has no worksheet")
    return sheets[0]


def _elements(z: zipfile.ZipFile, name: str, tag: str) -> Iterator[ET.Element]:
    """Elements of one tag as they stream by; what was read is let go."""
    with z.open(name) as part:
        above: list[ET.Element] = []
        for event, e in ET.iterparse(part, ("start", "end")):
            if event == "start":
                above.append(e)
                continue
            above.pop()
            if e.tag == f"{{{_NS['m']}}}{tag}":
                yield e
                if above:
                    above[-1].clear()


def parse_xlsx(data: bytes) -> list[list[str | None]]:
    """All rows of the first sheet as text (None for empty cells)."""
    return list(sheet_rows(data))


def sheet_rows(data: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as text, one at a time (None for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in _elements(z, "xl/sharedStrings.xml", "si"):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        yield from _rows(z, shared)


def _rows(z: zipfile.ZipFile, shared: list[str]) -> Iterator[list[str | None]]:
    for row in _elements(z, _first_sheet_name(z), "row"):
        cells: dict[int, str | None] = {}
        for c in row.findall("m:c", _NS):
            ref, kind = c.get("r", ""), c.get("t", "n")
            m = _CELL_REF.match(ref)
            idx = _col_index(m.group(1)) if m else len(cells)
            if kind == "inlineStr":
                val = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            else:
                v = c.find("m:v", _NS)
                val = v.text if v is not None else None
                if val is not None and kind == "s":
                    val = shared[int(val)]
                elif val is not None and kind == "b":
                    val = "true" if val == "1" else "false"
            cells[idx] = val
        width = max(cells) + 1 if cells else 0
        yield [cells.get(i) for i in range(width)]


def _cell(ref: str, value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    text = (str(value).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(pdf: pd.DataFrame) -> bytes:
    """A minimal one-sheet workbook (header row + values) with inline strings."""
    buf = io.BytesIO()
    write_xlsx(buf, [pdf])
    return buf.getvalue()


def write_xlsx(out: BinaryIO, frames: Iterable[pd.DataFrame]) -> None:
    """The same from frames of like columns, at least one, whose rows stream into the archive."""
    workbook = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_REL_NS}"><sheets>'
                '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
            'relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    types = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
             '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
             'relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
             '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-'
             'officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/'
             'sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.'
             'worksheet+xml"/></Types>')
    root_rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                 'relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/'
                 'officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                 '</Relationships>')
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", types)
        z.writestr("_rels/.rels", root_rels)
        z.writestr("xl/workbook.xml", workbook)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
            sheet.write(('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                         f'<worksheet xmlns="{_NS["m"]}"><sheetData>').encode())
            r, letters = 0, []
            for pdf in frames:
                if not r:
                    letters = [_letters(i) for i in range(len(pdf.columns))]
                for at in range(0, max(len(pdf), 1), BATCH_ROWS):
                    part = pdf.iloc[at:at + BATCH_ROWS]
                    rows = part.astype(object).where(part.notna(), None).values.tolist()
                    if not r:
                        rows.insert(0, list(pdf.columns))
                    xml = []
                    for values in rows:
                        r += 1
                        xml.append(f'<row r="{r}">{"".join(_cell(f"{c}{r}", v) for c, v in zip(letters, values))}</row>')
                    sheet.write("".join(xml).encode())
            sheet.write(b"</sheetData></worksheet>")


def read_workbooks(spark: SparkSession, pattern: str, schema: str | StructType,
                   with_path: bool = False) -> DataFrame:
    """Rows of every workbook under the glob, cast to ``schema`` (matched by header name)."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = st.fieldNames()
    text_schema = ", ".join(f"`{n}` string" for n in names) + ", `_path` string"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                rows = sheet_rows(bytes(content))
                first = next(rows, None)
                if first is None:
                    continue
                header = [h.strip() if h else h for h in first]
                pos = {h: i for i, h in enumerate(header)}
                missing = [n for n in names if n not in pos]
                if missing:
                    raise ValueError(f"{path}: missing columns {missing}")
                while body := list(islice(rows, BATCH_ROWS)):
                    out = {n: [r[pos[n]] if pos[n] < len(r) else None for r in body] for n in names}
                    out["_path"] = [path] * len(body)
                    yield pd.DataFrame(out, columns=names + ["_path"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(pattern)
    raw = files.select("path", "content").mapInPandas(parse, text_schema)
    cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields]
    if with_path:
        cols.append(F.col("_path").alias("path"))
    return raw.select(*cols)


def local_path(path: str) -> str:
    """POSIX path of a ``file:`` URI; other schemes cannot be written from Python."""
    if path.startswith("file:"):
        rest = path[len("file:"):]
        return "/" + rest.lstrip("/")
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://", path):
        raise ValueError(f"workbook writer needs a POSIX-mounted shared folder, got {path}")
    return path


def write_workbooks(df: DataFrame, path: str) -> int:
    """Workbooks of at most ``BOOK_ROWS`` rows into a folder visible to all workers; returns file count."""
    import os

    path, book_rows = local_path(path), BOOK_ROWS

    from pyspark import TaskContext

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = (b.iloc[at:at + BATCH_ROWS] for b in batches for at in range(0, len(b), BATCH_ROWS))
        held = next(parts, None)

        def book():
            """Rows of the next workbook; what is beyond its limit stays in ``held``."""
            nonlocal held
            left = book_rows
            while held is not None and left:
                now, held = held.iloc[:left], held.iloc[left:]
                left -= len(now)
                if held.empty:
                    held = next(parts, None)
                yield now
        number = 0
        while held is not None:
            os.makedirs(path, exist_ok=True)
            # Named by partition and place there: a retried task rewrites its own files, never adds one.
            target = os.path.join(path, f"part-{TaskContext.get().partitionId():05d}-{number:05d}.xlsx")
            with open(target, "wb") as fh:
                write_xlsx(fh, book())
            number += 1
            yield pd.DataFrame({"file": [target]})

    return df.mapInPandas(write, "file string").count()
