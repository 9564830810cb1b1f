"""Feed files made from table rows, for the registered queries and the tests:
the job itself only reads workbooks.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.functions import date_tag
from fraudmart.session import ship_package
from fraudmart.sources.workbook import NS


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def workbook_bytes(sheet: str, header: Sequence[str], rows: Sequence[Sequence]) -> bytes:
    """A minimal single-sheet workbook: inline strings, numbers as numbers."""
    def cell(ref: str, v) -> str:
        if v is None:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
    lines = []
    for r, values in enumerate([list(header)] + [list(x) for x in rows], start=1):
        cells = "".join(cell(f"{_col_letters(i)}{r}", v) for i, v in enumerate(values))
        lines.append(f'<row r="{r}">{cells}</row>')
    sheet_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<worksheet xmlns="{NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    workbook = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
                f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{NS["rel"]}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
            'relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    root_rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<Relationships xmlns="{NS["rel"]}">'
                 '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/'
                 '2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    types = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
             '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
             'relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
             '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-'
             'officedocument.spreadsheetml.sheet.main+xml"/>'
             '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.'
             'openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", types)
        z.writestr("_rels/.rels", root_rels)
        z.writestr("xl/workbook.xml", workbook)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
    return buf.getvalue()


def write_workbooks(rows: DataFrame, day_col: str, prefix: str, sheet: str, header: Sequence[str],
                    folder: str) -> int:
    """Write ``<prefix>_DDMMYYYY.xlsx`` files below ``folder`` (a shared
    location), one per day and Arrow batch, so no file grows with the data; the
    number written."""
    header = list(header)
    tagged = rows.select(*header, date_tag(F.col(day_col)).alias("_day"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid
        for batch in batches:
            paths = []
            for day, part in batch.groupby("_day", sort=True):
                values = part[header].astype(object).where(part[header].notna(), None)
                sub = f"{folder}/{uuid.uuid4().hex[:12]}"
                if ":" in folder.split("/")[0]:
                    fs, base = pafs.FileSystem.from_uri(sub)
                else:
                    fs, base = pafs.LocalFileSystem(), sub
                fs.create_dir(base)
                with fs.open_output_stream(f"{base}/{prefix}_{day}.xlsx") as out:
                    out.write(workbook_bytes(sheet, header, values.values.tolist()))
                paths.append(f"{base}/{prefix}_{day}.xlsx")
            yield pd.DataFrame({"file_path": paths})

    ship_package(rows.sparkSession)
    return tagged.mapInPandas(build, "file_path string").count()
