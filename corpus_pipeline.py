"""From raw documents to packed token windows: the stages of a training corpus.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result
is written and read again as the next one's docs. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.common import packed, unpacked
from saleslake.llm.line_dedup import drop_boilerplate
from saleslake.llm.ngram_join import similar_components
from saleslake.llm.packing import pack
from saleslake.llm.quality import keep_good
from saleslake.llm.secret_scan import redact
from saleslake.plans.staging import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's limits; the others go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source repeats; `n_chars` follows the text."""
    return drop_boilerplate(docs, length_column="n_chars")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Of rows that share that id the one with the smallest text stays. Rows without an id are
    in no group and stay.
    """
    chosen = stored(
        similar_components(docs).filter("id = component_id").select(F.col("id").alias("doc_id"))
        .distinct(),
        "corpus-chosen",
    )
    order = Window.partitionBy("id").orderBy("row.text", "row.lang", "row.source", "row.n_chars")
    whole = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), packed(docs))
    first = (
        whole.join(chosen.withColumnRenamed("doc_id", "id"), "id", "left_semi")
        .withColumn("place", F.row_number().over(order)).filter("place = 1")
    )
    return unpacked(first, docs.columns, {}).unionByName(docs.filter("doc_id IS NULL"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; `n_chars` follows the text."""
    return redact(docs, length_column="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' tokens in windows of 2048."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

# Tokens, links of similar texts and redactions are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
