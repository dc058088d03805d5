"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.session import ship_package

#: The white space that separates words: blank, tab, LF, VT, FF, CR.
BLANKS = " \t\n\x0b\f\r"


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply `function` to every Arrow batch of `df` in the tasks that hold them."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def as_bytes(array: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return array.cast(kind).to_pylist()


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of `df` as one struct, so that names added beside it cannot clash."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def unpacked(df: DataFrame, columns: list[str], replaced: dict[str, Column], name: str = "row"):
    """The columns that `packed` put away, some of them replaced."""
    return df.select(
        *(
            (replaced[c] if c in replaced else F.col(f"{name}.`{c}`")).alias(c) for c in columns
        )
    )


def lowest_reached(
    held: np.ndarray, x: np.ndarray, y: np.ndarray, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each of the ids `x` and `y` is connected to, itself included.

    `held` tells which of `x` (rows) and `y` (columns) are linked; with `same`, `x` and `y` are
    the same ids.
    """
    low_x, low_y = x.copy(), y.copy()
    far = np.iinfo(np.int64).max
    while True:
        new_y = np.minimum(low_y, np.where(held, low_x[:, None], far).min(axis=0))
        new_x = np.minimum(low_x, np.where(held, new_y[None, :], far).min(axis=1))
        if same:
            new_x = new_y = np.minimum(new_x, new_y)
        if (new_x == low_x).all() and (new_y == low_y).all():
            return low_x, low_y
        low_x, low_y = new_x, new_y
