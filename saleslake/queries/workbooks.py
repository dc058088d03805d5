"""Writes a frame as a folder of XLSX workbooks, for queries that scan them.

Each task writes its own workbooks, named by partition and sequence, so a rerun of a
lost task replaces the same files with the same content.
"""

from __future__ import annotations

import datetime as dt
import io
import math
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from saleslake.session import ship_package

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


#: Cell styles 0 to 2: a number, a date, a date with its time.
_STYLES = (
    f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
    '<xf numFmtId="22"/></cellXfs></styleSheet>'
)
_DAY_0, _FIRST_DAY = dt.datetime(1899, 12, 30), dt.datetime(1900, 3, 1)


def _cell(value) -> str:
    """A cell of the value's own kind; what the format has no number for is text."""
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float | Decimal) and math.isfinite(value):
        return f"<c><v>{value}</v></c>"
    if isinstance(value, dt.date):
        timed = isinstance(value, dt.datetime)
        moment = value.replace(tzinfo=None) if timed else dt.datetime.combine(value, dt.time())
        if moment >= _FIRST_DAY:
            days = Decimal((moment - _DAY_0) // dt.timedelta(microseconds=1)) / 86_400_000_000
            return f'<c s="{1 + timed}"><v>{days}</v></c>'
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _row(values) -> str:
    return f"<row>{''.join(map(_cell, values))}</row>"


def workbook_bytes(names: list[str], rows) -> bytes:
    """A one-sheet workbook with a header row; None is an empty cell."""
    sheet = "".join([_row(names), *map(_row, rows)])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{_RELS}"><Relationship Id="rId1"'
            f' Type="{_DOC}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/styles.xml", _STYLES)
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{_MAIN}"><sheetData>{sheet}</sheetData></worksheet>',
        )
    return out.getvalue()


def _uri(spark: SparkSession, folder: str) -> str:
    """The folder as Arrow names it, on the file system that Spark takes it to be on.

    A path without a scheme lies on the cluster's default file system, not on a task's own disk.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = files.makeQualified(path).toString()
    if uri.startswith("file:") and not uri.startswith("file://"):
        return "file://" + uri.removeprefix("file:")
    # Arrow knows the object store by one name
    return re.sub("^s3[an]://", "s3://", uri)


def write_workbooks(df: DataFrame, folder: str) -> None:
    """Write every Arrow batch of `df` as a workbook in `folder`."""
    ship_package(df.sparkSession)
    names, uri = df.columns, _uri(df.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(uri)
        files.create_dir(base, recursive=True)
        partition = TaskContext.get().partitionId()
        for at, batch in enumerate(batches):
            columns = [column.to_pylist() for column in batch.columns]
            with files.open_output_stream(f"{base}/book-{partition:06d}-{at:04d}.xlsx") as out:
                out.write(workbook_bytes(names, zip(*columns, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["rows"])

    df.mapInArrow(write, "rows long").write.format("noop").mode("overwrite").save()
