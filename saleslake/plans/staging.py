"""Written intermediate results on storage that every executor and the driver share.

Lineage is cut by writing a table and reading it back, so a lost executor costs the
recomputation of its running tasks only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession

#: Where staged results lie in the shared folder.
STAGING = "saleslake/staging"


#: The shuffle files of a command go when it has ended, not when the driver next collects garbage.
BRIEF_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for some time."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=8)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"saleslake-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session, whose tasks all see one disk, may go without the setting.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return _local_folder(context.applicationId)


@lru_cache(maxsize=8)
def _application_folder(spark: SparkSession, shared: str, application: str) -> str:
    """A folder of this application's own, removed when its driver ends."""
    path = f"{shared}/saleslake/{application}-{uuid.uuid4().hex[:8]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses, below the shared folder.

    Its files go when the application ends, as frames that read them may live until then.
    """
    application = _application_folder(
        spark, shared_folder(spark), spark.sparkContext.applicationId
    )
    return f"{application}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it from there.

    Spark then knows its size, so later joins broadcast it only where it is small.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(
    df: DataFrame, purpose: str, partition_by: Sequence[str] = ()
) -> Iterator[DataFrame]:
    """Write `df` once as Parquet in the shared folder and hand out a frame that reads it.

    The files go when the block succeeds and are left for recovery when it fails, also
    beyond the end of the application.
    """
    path = staging_path(df.sparkSession, purpose)
    with settings(df.sparkSession, **BRIEF_SHUFFLES):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    remove(df.sparkSession, path)


def staging_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses, for rows that may be wanted after the application has ended."""
    return f"{shared_folder(spark)}/{STAGING}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def observed_counts(observation: Observation, *names: str) -> dict[str, int]:
    """The counts observed while a frame was written.

    Where adaptive execution finds the input empty, the node that counts goes with it and the
    row of metrics has no columns; the counts are zero then.
    """
    if not observation._jo.getRow().length():
        return dict.fromkeys(names, 0)
    return {name: observation.get[name] for name in names}
