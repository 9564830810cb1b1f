"""Workbook (XLSX) feeds read as a Spark job.

``binaryFile`` lists and reads the files in parallel; ``mapInPandas`` turns
each workbook's named sheet into rows on the executors (a workbook is a zip
of XML parts, parsed with the standard library). A workbook is not
splittable, so one file is one unit of work; everything after the parse is
ordinary DataFrame code.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import business_date, excel_serial_to_date
from fraudmart.session import ship_package

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def sheet_rows(content: bytes, sheet: str) -> list[list[str | None]]:
    """All rows of the named sheet as lists of cell texts (numbers as written)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rid = None
        for s in wb.iter(f"{{{NS['m']}}}sheet"):
            if s.get("name") == sheet:
                rid = s.get(f"{{{NS['r']}}}id")
        if rid is None:
            return []
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels.iter(f"{{{NS['rel']}}}Relationship")
                      if r.get("Id") == rid)
        target = target.lstrip("/")
        part = target if target.startswith("xl/") else f"xl/{target}"
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.iter(f"{{{NS['m']}}}si")]
        root = ET.fromstring(z.read(part))
    rows: list[list[str | None]] = []
    for row in root.iter(f"{{{NS['m']}}}row"):
        cells: dict[int, str | None] = {}
        for pos, c in enumerate(row.iter(f"{{{NS['m']}}}c")):
            ref = c.get("r")
            idx = _col_index(_CELL_REF.match(ref).group(1)) if ref else pos
            kind = c.get("t")
            v = c.find("m:v", NS)
            if kind == "s" and v is not None:
                val = shared[int(v.text)]
            elif kind == "inlineStr":
                is_ = c.find("m:is", NS)
                val = _text(is_) if is_ is not None else None
            else:
                val = v.text if v is not None else None
            cells[idx] = val
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i) for i in range(width)])
    return rows


#: Sheet rows per frame handed on.
FRAME_ROWS = 10_000


def _problem(content: bytes, sheet: str, columns: list[str]) -> tuple[str | None, list]:
    try:
        rows = sheet_rows(content, sheet)
    except (zipfile.BadZipFile, KeyError, ET.ParseError, StopIteration) as e:
        return f"not a workbook: {type(e).__name__}", []
    if not rows:
        return f"no rows in a sheet named {sheet}", []
    header = [(h or "").strip() for h in rows[0]]
    missing = [c for c in columns if c not in header]
    return ("no column " + ", ".join(missing), []) if missing else (None, rows)


def _parser(sheet: str, columns: Sequence[str], strict: bool):
    columns = list(columns)

    def frame(path: str, rows: list, pos: dict, first: int, problem: str | None = None) -> pd.DataFrame:
        out = {name: [r[i] if i is not None and i < len(r) else None for r in rows] for name, i in pos.items()}
        made = pd.DataFrame(out, columns=columns, dtype=object)
        if problem:
            made = pd.DataFrame([[None] * len(columns)], columns=columns, dtype=object)
        made["file_path"] = path
        made["row_no"] = 0 if problem else range(first, first + len(made))
        made["problem"] = problem
        return made

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["file_path"], batch["content"]):
                problem, rows = _problem(bytes(content), sheet, columns) if strict else (None, sheet_rows(bytes(content), sheet))
                if problem:
                    yield frame(path, [], dict.fromkeys(columns), 0, problem)
                if not rows:
                    continue
                header = [(h or "").strip() for h in rows[0]]
                pos = {name: header.index(name) if name in header else None for name in columns}
                for at in range(1, max(len(rows), 2), FRAME_ROWS):
                    yield frame(path, rows[at:at + FRAME_ROWS], pos, at)
    return parse


def _parsed(files: DataFrame, sheet: str, columns: Sequence[str], strict: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField("file_path", T.StringType()), T.StructField("row_no", T.LongType()),
                             T.StructField("problem", T.StringType())])
    ship_package(files.sparkSession)
    parsed = files.select("file_path", "content").mapInPandas(_parser(sheet, columns, strict), schema)
    name = F.element_at(F.split("file_path", "/"), -1)
    return parsed.withColumns({"file_name": name, "business_dt": business_date(name)})


def parse_workbooks(files: DataFrame, sheet: str, columns: Sequence[str]) -> DataFrame:
    """(file_path, content) rows -> one row per sheet row, all strings, with
    the file's name, its business date and the row number in the sheet."""
    return _parsed(files, sheet, columns, strict=False).drop("problem")


def checked_workbooks(files: DataFrame, sheet: str, columns: Sequence[str]) -> DataFrame:
    """``parse_workbooks`` with ``problem``: a workbook that cannot be read as asked (not
    a workbook, no such sheet, a missing column, no date in its name) gives one row
    that says so and no other. Store it: each workbook is then parsed once, whatever is
    asked of it."""
    undated = F.when(F.col("business_dt").isNull(), "no business date in the name")
    parsed = _parsed(files, sheet, columns, strict=True)
    return (parsed.withColumn("problem", F.coalesce("problem", undated))
            .filter(F.col("problem").isNull() | (F.col("row_no") <= 1)))


def read_workbooks(spark: SparkSession, landing: str, glob: str, sheet: str,
                   columns: Sequence[str]) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(landing)
             .select(F.col("path").alias("file_path"), "content"))
    return parse_workbooks(files, sheet, columns)


def cell_date(c: Column) -> Column:
    """A workbook date cell: a day serial (number) or ISO text."""
    num = c.try_cast("double")
    return F.when(num.isNotNull(), excel_serial_to_date(num)).otherwise(c.try_cast("date"))


def terminal_slices(parsed: DataFrame) -> DataFrame:
    """Parsed terminal workbooks -> slice rows for ``scd2_history``."""
    return parsed.select(*[F.trim(c).alias(c) for c in
                           ("terminal_id", "terminal_type", "terminal_city", "terminal_address")],
                         F.col("business_dt").alias("effective_from"), "row_no", "file_name")


def blacklist_rows(parsed: DataFrame) -> DataFrame:
    """Parsed blacklist workbooks -> (passport_num, entry_dt, effective_from)."""
    return parsed.select(F.trim("passport").alias("passport_num"),
                         cell_date(F.col("date")).alias("entry_dt"),
                         F.col("business_dt").alias("effective_from"), "file_name")


TERMINAL_COLUMNS = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
BLACKLIST_COLUMNS = ["passport", "date"]
