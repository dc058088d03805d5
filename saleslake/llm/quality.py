"""Document quality by thresholds that adapt to each language and source (6).

Every document is measured by built-in functions alone. Each measure of each group of
language and source is summarised in a mergeable quantile sketch: a histogram whose buckets
grow with the value, so a quantile is off by one part in 32 at most. Sketches merge by
adding counts, in any order and with the same result, which gives the languages and the
whole corpus from the groups. A document is rejected if a measure lies far outside what is
usual in its group; a group with few documents takes its language's limits, a language with
few the corpus's. The limits are joined to the documents.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslake.llm.common import BLANKS
from saleslake.plans.staging import stored

# The base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Measures, all whole numbers: name, value of a measured document, least spread. A limit is
# as far beyond the upper quartile (below the lower) as REACH times its distance from the
# median, or the least spread if that is more.
MEASURES = (
    ("word_length", "100 * word_chars div greatest(n_words, 1)", 150),
    ("symbols", "1000 * n_symbols div greatest(n_words, 1)", 100),
    ("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 150),
    ("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 100),
)
REACH = 3
LOW, MIDDLE, HIGH = 0.25, 0.5, 0.75
MIN_GROUP = 100


def measured(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """The row, kept as a struct, and its counts.

    A window that occurs twice is found by sorting the hashes of a text's windows beside
    their places; texts whose hashes are all different skip that. A wrong pair of equal
    64-bit hashes in a text of 100,000 words has a probability of about 1e-10.
    """
    text = F.coalesce(F.col(f"row.`{text_column}`").cast("string"), F.lit(""))
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    split = rows.select(
        "row",
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(
            F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""
        ).alias("lines"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
        .alias("n_symbols"),
    )
    hashed = split.select(
        "row", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                lambda at: F.xxhash64(F.slice("words", at, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    )
    ordered = hashed.withColumn(
        "places",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.array_sort(F.transform("hashes", lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
        ),
    ).drop("hashes")
    starts = F.array_sort(
        F.transform(
            F.filter(
                "places",
                lambda p, k: (p["h"] == F.try_element_at("places", k + 2)["h"])
                | ((k > 0) & (p["h"] == F.try_element_at("places", F.greatest(k, F.lit(1)))["h"])),
            ),
            lambda p: p["at"].cast("long"),
        )
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end")),
        lambda acc, at: F.struct(
            (acc["total"] + at + WINDOW - F.greatest(acc["end"], at)).alias("total"),
            (at + WINDOW).alias("end"),
        ),
        lambda acc: acc["total"],
    )
    return ordered.withColumn(
        "n_repeat_words",
        F.when(F.col("places").isNull(), F.lit(0).cast("long")).otherwise(covered),
    ).drop("places").withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def bucket(value: Column) -> Column:
    """The lower edge of a value's sketch bucket: itself below 64, else six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): a sketch of each measure of each group.

    Rows are counted before the shuffle; what is shuffled is bounded by groups and buckets.
    """
    values = F.explode(
        F.array(*(
            F.struct(F.lit(k).alias("measure"), bucket(F.expr(value).cast("long")).alias("bucket"))
            for k, (_, value, _) in enumerate(MEASURES)
        ))
    ).alias("value")
    return (
        rows.select("lang", "source", values)
        .groupBy("lang", "source", "value.measure", "value.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _limits(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper limits of each measure from the sketches of some level."""
    per = W.partitionBy(*keys, "measure")
    ranked = merged.select(
        *keys, "measure", "bucket",
        F.sum("n").over(per.orderBy("bucket")).alias("upto"), F.sum("n").over(per).alias("total"),
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bucket")))

    spread = F.element_at(F.array(*(F.lit(s) for _, _, s in MEASURES)), F.col("measure") + 1)
    return (
        ranked.groupBy(*keys, "measure")
        .agg(
            quantile(LOW).alias("low"), quantile(MIDDLE).alias("middle"),
            quantile(HIGH).alias("high"), F.max("total").alias("total"),
        )
        .select(
            *keys, "measure", "total",
            (F.col("low") - REACH * F.greatest(F.col("middle") - F.col("low"), spread))
            .alias("least"),
            (F.col("high") + REACH * F.greatest(F.col("high") - F.col("middle"), spread))
            .alias("most"),
        )
    )


def limits(groups: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, limits): an array of (least, most) by measure, for every group."""
    by_lang = groups.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    overall = groups.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
    own = _limits(groups, ["lang", "source"]).alias("own")
    lang = _limits(by_lang, ["lang"]).alias("lang")
    whole = _limits(overall, []).alias("whole")
    joined = own.join(
        lang,
        F.col("own.lang").eqNullSafe(F.col("lang.lang"))
        & (F.col("own.measure") == F.col("lang.measure")),
    ).join(whole, F.col("own.measure") == F.col("whole.measure"))

    def pick(column: str) -> Column:
        return (
            F.when(F.col("own.total") >= min_group, F.col(f"own.{column}"))
            .when(F.col("lang.total") >= min_group, F.col(f"lang.{column}"))
            .otherwise(F.col(f"whole.{column}"))
            .alias(column)
        )

    return (
        joined.select(
            F.col("own.lang").alias("lang"), F.col("own.source").alias("source"),
            F.struct(F.col("own.measure").alias("measure"), pick("least"), pick("most"))
            .alias("limit"),
        )
        .groupBy("lang", "source")
        .agg(F.array_sort(F.collect_list("limit")).alias("limits"))
    )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    documents: DataFrame, *, text_column: str = "text", lang_column: str = "lang",
    source_column: str = "source", keep_rows: bool = False, carry: str | None = "doc_id",
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """Counts and verdicts of every row: `carry`, the counts, `base_failed`, `kept`.

    With `keep_rows` the whole row comes along as the struct `row`. A null text has no words
    and fails. Null languages and sources are groups of their own. Rows stay apart whatever
    their ids. Limits come from the rows that pass the base rules; a row at a limit is kept.
    """
    measures = measured(documents, text_column).select(
        *(["row"] if keep_rows else [F.col(f"row.`{carry}`").alias("id")]),
        F.col(f"row.`{lang_column}`").cast("string").alias("lang"),
        F.col(f"row.`{source_column}`").cast("string").alias("source"),
        *_COUNTS, "n_lines", "base_failed",
    )
    rows = stored(measures, "quality-counts")
    groups = stored(sketches(rows.filter(~F.col("base_failed"))), "quality-sketches")
    bounds = stored(limits(groups, min_group), "quality-limits").alias("b")
    outside = reduce(
        or_,
        (
            (F.expr(value) < F.col("limits")[k]["least"])
            | (F.expr(value) > F.col("limits")[k]["most"])
            for k, (_, value, _) in enumerate(MEASURES)
        ),
    )
    joined = rows.alias("r").join(
        bounds,
        F.col("r.lang").eqNullSafe(F.col("b.lang"))
        & F.col("r.source").eqNullSafe(F.col("b.source")),
        "left",
    )
    return joined.select(
        *(["row"] if keep_rows else [F.col("id").alias(carry)]),
        *_COUNTS, "base_failed",
        (~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))).alias("kept"),
    )


def keep_good(documents: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with their own columns."""
    return judge(documents, keep_rows=True, **options).filter("kept").select("row.*")
