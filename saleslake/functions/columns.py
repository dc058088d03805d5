"""Schema-level projections."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_USER = "system_user"


def standard_name(name: str) -> str:
    """Lower case, trimmed, inner spaces as underscores, hyphens deleted."""
    return name.lower().strip().replace(" ", "_").replace("-", "")


def standardize_names(df: DataFrame) -> DataFrame:
    """Rename every column to its standard name.

    Two columns that would end up with one name are an error: `toDF` would accept
    them and every later reference would be ambiguous.
    """
    names = [standard_name(name) for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns collide after renaming: {', '.join(clashes)}")
    return df.toDF(*names)


def date_column(as_of: dt.date | None) -> Column:
    """The run date: a literal when injected, else `current_date()`."""
    return F.current_date() if as_of is None else F.lit(as_of)


def with_audit(
    df: DataFrame,
    *,
    as_of: dt.date | None = None,
    user: str = DEFAULT_USER,
    updated: bool = False,
) -> DataFrame:
    """Stamp `created_dt`/`created_by`, and the `updated_*` pair on request."""
    day, by = date_column(as_of), F.lit(user)
    stamps = {"created_dt": day, "created_by": by}
    if updated:
        stamps |= {"updated_dt": day, "updated_by": by}
    return df.withColumns(stamps)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project `df` onto `schema`: its columns, order and types.

    Values that do not fit become NULL, and so do columns the frame lacks (K3).
    A column the schema does not know is an error rather than a silent drop.
    """
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the target schema: {', '.join(unknown)}")
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        )
    )
