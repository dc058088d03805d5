"""XLSX scan (S2): many workbooks, decoded inside tasks.

Spark lists, packs and reads the workbooks (`binaryFile`), a mapper turns each into
Arrow batches of cell texts, and the declared types are applied by Spark. A workbook
cannot be split, but the format bounds a sheet to 1,048,576 rows, and a scan partition
holds at most `spark.sql.files.maxPartitionBytes` of workbooks or a single larger one.

Types that are not declared are taken from the cells of all workbooks by one more scan: every
workbook gives a row per column with the kinds of cell seen as bits, and the bits of a column
are joined by `bit_or`, which may merge them in any order and before the shuffle.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from decimal import Decimal
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from saleslake.functions.columns import standard_name
from saleslake.schemas import SourceSpec
from saleslake.session import ship_package

_ROWS_PER_BATCH = 10_000

# Kinds of cell, as bits. A column's kinds are the union over its cells.
_BOOLEAN, _WHOLE, _FRACTION, _DAY, _MOMENT, _TEXT = (1 << bit for bit in range(6))
#: The smallest type that holds all kinds of a column; any other mixture is text.
_TYPES = (
    (_BOOLEAN, BooleanType()),
    (_WHOLE, LongType()),
    (_WHOLE | _FRACTION, DoubleType()),
    (_DAY, DateType()),
    (_DAY | _MOMENT, TimestampType()),
)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(node: ElementTree.Element) -> str:
    """The text of a string item: plain or rich runs, without phonetic hints."""
    parts = []
    for child in node:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _elements(book: zipfile.ZipFile, part: str, name: str) -> Iterator[ElementTree.Element]:
    """Stream the elements called `name`, freeing each one after use."""
    with book.open(part) as stream:
        open_nodes = []
        for event, node in ElementTree.iterparse(stream, events=("start", "end")):
            if event == "start":
                open_nodes.append(node)
                continue
            open_nodes.pop()
            if _local(node.tag) == name:
                yield node
                open_nodes[-1].clear()


def _first_sheet(book: zipfile.ZipFile) -> str:
    """Part name of the first sheet in workbook order."""
    sheet = next(_elements(book, "xl/workbook.xml", "sheet"))
    rid = next(value for key, value in sheet.attrib.items() if _local(key) == "id")
    for link in _elements(book, "xl/_rels/workbook.xml.rels", "Relationship"):
        if link.get("Id") == rid:
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("the first sheet has no part")


def _column(reference: str) -> int:
    """Zero-based column of a cell reference such as `AB12`."""
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


# The built-in number formats that are dates or times.
_DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    formats = set(_DATE_FORMATS)
    for node in _elements(book, "xl/styles.xml", "numFmt"):
        # quoted text, escaped characters and [colours] aside, date codes are these letters
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", node.get("formatCode", ""))
        if re.search("[dmyhs]", code, re.IGNORECASE):
            formats.add(int(node.get("numFmtId")))
    styles = next(_elements(book, "xl/styles.xml", "cellXfs"), ())
    return {at for at, style in enumerate(styles) if int(style.get("numFmtId", 0)) in formats}


def _first_day(book: zipfile.ZipFile) -> dt.datetime:
    """The day that serial number 0 stands for."""
    for node in _elements(book, "xl/workbook.xml", "workbookPr"):
        if node.get("date1904") in ("1", "true"):
            return dt.datetime(1904, 1, 1)
    # 1900 counts as a leap year in this format, so day 60 is missing and earlier ones are off
    return dt.datetime(1899, 12, 30)


def _date_text(serial: str, first_day: dt.datetime) -> str:
    """ISO text of a day number, with the time of day if there is one."""
    days = Decimal(serial)
    if first_day.year == 1899 and days < 60:
        days += 1
    try:
        moment = first_day + dt.timedelta(seconds=round(days * 86_400))
    except OverflowError:
        return serial
    return moment.date().isoformat() if days == int(days) else moment.isoformat(" ")


def _cell(
    node: ElementTree.Element, strings: list[str], dates: set[int], first_day: dt.datetime
) -> str | None:
    kind = node.get("t", "n")
    if kind == "inlineStr":
        return next((_text(child) for child in node if _local(child.tag) == "is"), None)
    raw = next((child.text for child in node if _local(child.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind == "n" and int(node.get("s", -1)) in dates:
        return _date_text(raw, first_day)
    if kind == "n" and "E" in raw.upper():
        return f"{Decimal(raw):f}"
    return raw


def _cell_and_kind(
    node: ElementTree.Element, strings: list[str], dates: set[int], first_day: dt.datetime
) -> tuple[str | None, int]:
    """A cell's text and the bit of its kind; an error value or an empty cell is of none."""
    text, form = _cell(node, strings, dates, first_day), node.get("t", "n")
    if text is None or form == "e":
        return text, 0
    if form == "b":
        return text, _BOOLEAN
    if form == "d" or (form == "n" and re.match(r"\d+-", text)):
        return text, _DAY if len(text) == 10 else _MOMENT
    if form == "n":
        whole = re.fullmatch(r"-?\d+", text) and -(2**63) <= int(text) < 2**63
        return text, _WHOLE if whole else _FRACTION
    return text, _TEXT


def sheet_rows(content: bytes, cell: Callable = _cell) -> Iterator[list]:
    """Cell texts of the first sheet, row by row, gaps as None.

    Numbers in a date style become ISO dates, with the time if it is not midnight. Another
    `cell` gives something else than the text.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = []
        if "xl/sharedStrings.xml" in book.namelist():
            strings = [_text(node) for node in _elements(book, "xl/sharedStrings.xml", "si")]
        dates, first_day = _date_styles(book), _first_day(book)
        for row in _elements(book, _first_sheet(book), "row"):
            cells: list[str | None] = []
            for node in row:
                at = _column(node.get("r")) if node.get("r") else len(cells)
                cells.extend([None] * (at + 1 - len(cells)))
                cells[at] = cell(node, strings, dates, first_day)
            yield cells


def _unnamed(name: str, head: list[str | None]) -> int:
    """The place of a column that is called by it, where this workbook's header has no name."""
    number = re.fullmatch(r"_c(\d+)", name)
    at = int(number.group(1)) if number else -1
    return at if at >= len(head) or not head[at] else -1


def _workbook_batches(
    content: bytes, names: list[str], header: bool
) -> Iterator[list[list[str | None]]]:
    """Column lists of up to `_ROWS_PER_BATCH` rows, in the order of `names`."""
    rows = sheet_rows(content)
    positions = list(range(len(names)))
    if header:
        head = next(rows, [])
        found = {standard_name(cell or ""): at for at, cell in enumerate(head)}
        positions = [found.get(standard_name(name), _unnamed(name, head)) for name in names]
        if max(positions) < 0:
            raise ValueError(f"no header cell of the workbook is one of: {', '.join(names)}")
    columns: list[list[str | None]] = [[] for _ in names]
    for row in rows:
        if all(cell is None for cell in row):
            continue
        for column, at in zip(columns, positions, strict=True):
            column.append(row[at] if 0 <= at < len(row) else None)
        if len(columns[0]) == _ROWS_PER_BATCH:
            yield columns
            columns = [[] for _ in names]
    if columns[0]:
        yield columns


def _column_kinds(content: bytes, header: bool) -> list[tuple[str, int]]:
    """Name and kinds of every column of a workbook, in the order of the sheet.

    A column without a header cell is left out if it has no cell of a kind, else it is called
    by its place, as all are without a header.
    """
    rows = sheet_rows(content, _cell_and_kind)
    names = [cell and cell[0] for cell in next(rows, [])] if header else []
    kinds: list[int] = [0] * len(names)
    for row in rows:
        kinds.extend([0] * (len(row) - len(kinds)))
        for at, cell in enumerate(row):
            if cell is not None:
                kinds[at] |= cell[1]
    names.extend([None] * (len(kinds) - len(names)))
    found = [
        (name or f"_c{at}", seen)
        for at, (name, seen) in enumerate(zip(names, kinds, strict=True))
        if name or seen or not header
    ]
    keys = [standard_name(name) for name, _ in found]
    if len(set(keys)) < len(keys):
        raise ValueError(f"header cells of a workbook mean the same: {', '.join(keys)}")
    return found


def _type_of(kinds: int) -> DataType:
    """The declared type of a column with these kinds of cell; text if it has none."""
    return next((t for held, t in _TYPES if kinds and not kinds & ~held), StringType())


def inferred_schema(books: DataFrame, header: bool = True) -> StructType:
    """Columns and types of the workbooks (`path`, `content`), from all of their cells.

    Columns of workbooks are the same if their standardized names are; the first workbook by
    path that has one names it, and columns stand in the order of the first workbooks. Whole
    numbers are long, others double, days date or timestamp; numbers written as text are text,
    and so are columns of several kinds or of no cell. The driver gets a row per column.
    """
    ship_package(books.sparkSession)
    fields = "path string, place int, name string, key string, kinds int"
    names = [field.split()[0] for field in fields.split(", ")]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                found = _column_kinds(content.as_py(), header)
                columns = [
                    pa.array([path.as_py()] * len(found), pa.string()),
                    pa.array(range(len(found)), pa.int32()),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([standard_name(name) for name, _ in found], pa.string()),
                    pa.array([kinds for _, kinds in found], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    first = F.min(F.struct("path", "place", "name")).alias("first")
    found = (
        books.select("path", "content").mapInArrow(look, fields)
        .groupBy("key").agg(first, F.bit_or("kinds").alias("kinds")).orderBy("first").collect()
    )
    if not found:
        raise ValueError("no workbook with a column to take a schema from")
    return StructType([StructField(row.first.name, _type_of(row.kinds)) for row in found])


def decode_workbooks(books: DataFrame, schema: StructType, header: bool = True) -> DataFrame:
    """Rows of the workbooks in the binary column `content`, typed by `schema`.

    Header cells are matched to the schema by standardized name, so column order may
    differ between workbooks; a column a workbook lacks is NULL, and a workbook without any
    of them fails. Cells that do not fit the declared type become NULL.
    """
    ship_package(books.sparkSession)
    names = schema.names

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for columns in _workbook_batches(content.as_py(), names, header):
                    arrays = [pa.array(column, pa.string()) for column in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    texts = StructType([StructField(name, StringType(), True) for name in names])
    return books.select("content").mapInArrow(decode, texts).select(
        *(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def read_xlsx(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """Scan a workbook of any name, or every `.xlsx` and `.xlsm` of a folder.

    Suffixes are compared without regard to case. A glob or folder without a workbook has no
    rows; a named file is read whatever it is called, and fails if it is no workbook. Without
    a schema the columns and types are inferred from all cells, which reads the workbooks once
    more and needs at least one.
    """
    reader = spark.read.format("binaryFile").options(**spec.options)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not (files.exists(folder) and files.getFileStatus(folder).isFile()):
        reader = reader.option("pathGlobFilter", "*.[xX][lL][sS][xXmM]")
    books = reader.load(path)
    schema = spec.schema or inferred_schema(books, spec.header)
    return decode_workbooks(books, schema, spec.header)
