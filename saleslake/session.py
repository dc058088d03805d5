"""Session settings the jobs are tuned for.

On a cluster the session is usually handed in; `tuning` then tells the operator of
the cluster what to set. All of it is plain Spark configuration.
"""

from __future__ import annotations

import shutil
import tempfile
import warnings
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

_TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024
_MAX_SHUFFLE_PARTITIONS = 200_000


def tuning(shuffle_bytes: int | None = None) -> dict[str, str]:
    """Settings for a job that shuffles about `shuffle_bytes`.

    The initial partition number is sized so that a reduce task holds one target
    worth of data before skew; AQE merges the small ones and splits the hot ones,
    which it can only tell apart if the usual partition is small. Beyond 200,000 partitions
    (25 TB a shuffle) the driver's own tables of blocks become the limit: the number stays there,
    partitions grow instead, and a warning says so.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TARGET_SHUFFLE_BYTES),
    }
    if shuffle_bytes is not None:
        wanted = -(-shuffle_bytes // _TARGET_SHUFFLE_BYTES)
        if wanted > _MAX_SHUFFLE_PARTITIONS:
            size = shuffle_bytes // _MAX_SHUFFLE_PARTITIONS >> 20
            warnings.warn(
                f"{wanted} shuffle partitions wanted, {_MAX_SHUFFLE_PARTITIONS} set: about {size}"
                " MB each instead of 128, so give tasks more memory",
                stacklevel=2,
            )
        conf["spark.sql.shuffle.partitions"] = str(min(max(wanted, 1), _MAX_SHUFFLE_PARTITIONS))
    return conf


def build_session(
    app: str = "saleslake", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with `tuning()` and the caller's own settings on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**tuning(), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Code that runs in them is the workbook decoder and writer and the corpus operators. Spark
    distributes the archive itself, so it need not be installed on the executors or on their path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="saleslake-package-")) / package.name
    context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
