"""Boilerplate lines by how many of a site's pages carry them (2).

For each host the pages that contain a line are counted once each and divided by the host's
pages. Lines on two pages or more and beyond a ratio are boilerplate of that host and are dropped; the
same line elsewhere stays. Only digests of lines are shuffled, after a partial count. A host
has at most (mean distinct lines of a page / ratio) such lines, as each takes that share of
its pages, so the set that goes with a host is bounded whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import BLANKS, packed, unpacked
from saleslake.plans.staging import stored

RATIO = 0.1
MIN_PAGES = 20


def _key(line: Column) -> Column:
    """128 bits that stand for a line, blanks at its ends left out."""
    return F.unhex(F.md5(F.btrim(line, F.lit(BLANKS)).cast("binary")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(
    pages: DataFrame, *, host_column: str = "source", text_column: str = "text",
    ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(host, keys): the digests of each host's boilerplate lines.

    Blank lines are none. A host with fewer than `min_pages` pages has none, as a ratio says
    little there. A null host is a host of its own.
    """
    rows = pages.select(
        F.col(f"`{host_column}`").cast("string").alias("host"),
        F.col(f"`{text_column}`").alias("text"),
    )
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    filled = F.filter(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    counts = (
        rows.select("host", F.explode(F.array_distinct(F.transform(filled, _key))).alias("key"))
        .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    counts, totals = stored(counts, "lines-counts").alias("c"), stored(totals, "lines-totals")
    frequent = counts.join(
        totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))
    ).filter((F.col("pages") >= min_pages) & (F.col("n") > ratio * F.col("pages")))
    return stored(
        frequent.select(F.col("c.host").alias("host"), "key")
        .groupBy("host").agg(F.collect_list("key").alias("keys")),
        "lines-boilerplate",
    )


def drop_boilerplate(
    pages: DataFrame, *, host_column: str = "source", text_column: str = "text",
    length_column: str | None = None, ratio: float = RATIO, min_pages: int = MIN_PAGES,
    count: bool = False,
) -> DataFrame:
    """The same rows without their host's boilerplate lines, other lines as they were.

    A null text stays null, and a text of boilerplate alone becomes empty. `length_column`
    is brought in line for texts that change; with `count` the columns `n_lines` and
    `n_dropped` follow, in place of columns of these names. Repeated rows count as pages of their
    own. Texts of any length are taken whole.
    """
    known = boilerplate(
        pages, host_column=host_column, text_column=text_column, ratio=ratio, min_pages=min_pages
    )
    text = F.col(f"row.`{text_column}`")
    host = F.col(f"row.`{host_column}`").cast("string")
    joined = pages.select(packed(pages)).join(known, host.eqNullSafe(F.col("host")), "left")
    kept = joined.select(
        "row",
        F.when(
            F.col("keys").isNotNull() & text.isNotNull(),
            F.filter(_lines(text), lambda x: ~F.array_contains(F.col("keys"), _key(x))),
        ).alias("lines"),
    )
    done = kept.select(
        "row", F.coalesce(F.array_join("lines", "\n"), text).alias("text"),
        F.when(text.isNotNull(), F.size(_lines(text))).otherwise(0).alias("n_lines"),
        F.when(F.col("lines").isNotNull(), F.size(_lines(text)) - F.size("lines")).otherwise(0)
        .alias("n_dropped"),
    )
    replaced = {text_column: F.col("text")}
    if length_column:
        kind = pages.schema[length_column].dataType
        replaced[length_column] = F.when(
            F.col("n_dropped") > 0, F.length("text").cast(kind)
        ).otherwise(F.col(f"row.`{length_column}`"))
    if not count:
        return unpacked(done, pages.columns, replaced)
    return done.select(
        *((replaced[c] if c in replaced else F.col(f"row.`{c}`")).alias(c)
          for c in pages.columns if c not in ("n_lines", "n_dropped")),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
    )
