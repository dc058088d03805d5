"""Readers for raw files and their dispatch."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from saleslake.plans.staging import stored
from saleslake.schemas import SOURCES, SourceSpec
from saleslake.sources.xlsx import read_xlsx


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path, those with the same header line together; one group without a look
    inside if there is one file only.

    The first lines come from a scan of the text; the driver gets the names of the files, which
    it lists for any scan.
    """
    listed = spark.read.format("binaryFile").load(path).select("path").limit(2).collect()
    if len(listed) < 2:
        return []
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [row.files for row in groups.orderBy("header").collect()]


def read_csv(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """CSV scan (S1): string columns named by the header, or the declared schema.

    Spark assigns columns by position. Files whose headers differ are therefore read apart, each
    kind by its own header, and put together by the columns' names; a file that lacks one of
    them or has another is an error. Each file's header is compared with what it is read by.
    """
    options = {"header": spec.header, "multiLine": spec.multi_line, **spec.options}
    reader = spark.read.options(**options)
    schema = spec.schema
    kinds = _files_by_header(spark, path) if spec.header else []
    if len(kinds) < 2:
        if schema is None and spec.header:
            schema = reader.csv(path).schema
        if schema is not None:
            reader = reader.schema(schema).option("enforceSchema", not spec.header)
        return reader.csv(path)
    frames = []
    for files in kinds:
        names = reader.csv(files[:1]).columns
        if schema is None:
            schema = reader.csv(files[:1]).schema
        if sorted(names) != sorted(schema.names):
            raise ValueError(f"columns of '{files[0]}' are not those of the other files")
        own = StructType([schema[name] for name in names])
        # a reader keeps what it was told, so each kind has one of its own
        frames.append(
            spark.read.options(**options).schema(own).option("enforceSchema", False).csv(files)
        )
    return reduce(DataFrame.unionByName, frames).select(*(f"`{name}`" for name in schema.names))


#: The text of a record that could not be read.
BROKEN = "broken_record"


def read_records(
    spark: SparkSession, spec: SourceSpec | str, path: str
) -> tuple[DataFrame, DataFrame]:
    """A JSON or CSV source with a schema, as its good rows and its broken records.

    A broken record is a line that is no object, or a value that does not fit its column; its
    text and its file's name make a row of the second frame, in one pass that is written once.
    Files' columns go by position here.
    """
    spec = source_for(spec) if isinstance(spec, str) else spec
    if spec.schema is None or spec.format not in ("json", "csv"):
        raise ValueError(f"source '{spec.name}' is not read by records")
    options = {"multiLine": spec.multi_line, **spec.options, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": BROKEN}
    if spec.format == "csv":
        options["header"] = spec.header
    marked = StructType([*spec.schema.fields, StructField(BROKEN, StringType())])
    try:
        rows = spark.read.schema(marked).options(**options).format(spec.format).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"'{path}' does not exist") from error
        raise
    held = stored(
        rows.select("*", F.col("_metadata.file_name").alias("broken_file"),
                    F.col(BROKEN).isNull().alias("whole")),
        f"records-{spec.format}",
    )
    good = held.filter("whole").select(*(f"`{name}`" for name in spec.schema.names))
    return good, held.filter("NOT whole").select(BROKEN, "broken_file")


def read_json(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """JSON scan with a declared schema (S3).

    One object per line by default, which Spark splits within a file. `multi_line`
    takes array-style files, each of which is then one task.
    """
    if spec.schema is None:
        raise ValueError(f"source '{spec.name}' needs a schema")
    return (
        spark.read.schema(spec.schema)
        .option("multiLine", spec.multi_line)
        .options(**spec.options)
        .json(path)
    )


_READERS = {"csv": read_csv, "json": read_json, "xlsx": read_xlsx}


def source_for(name: str) -> SourceSpec:
    """The registered spec of a file name, or of its extension's only spec."""
    if name in SOURCES:
        return SOURCES[name]
    extension = PurePosixPath(name).suffix.lstrip(".").lower()
    same_format = [spec for spec in SOURCES.values() if spec.format == extension]
    if not same_format:
        raise ValueError(f"unsupported file format '{extension}' of '{name}'")
    return replace(same_format[0], name=name)


def read_source(spark: SparkSession, spec: SourceSpec | str, path: str) -> DataFrame:
    """Read `path` (a file, a folder of files or a glob) as `spec` says.

    A missing path is a `FileNotFoundError` on every file system Spark can read (S5).
    """
    if isinstance(spec, str):
        spec = source_for(spec)
    if spec.format not in _READERS:
        raise ValueError(f"unsupported file format '{spec.format}' of '{spec.name}'")
    try:
        return _READERS[spec.format](spark, spec, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"'{path}' does not exist") from error
        raise
