"""From raw documents to tokens, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's documents. All but the last return the
columns they are given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelight.llm import bpe, mixing, near_copies, neighbours, quality_rules
from parcelight.llm.common import remainder, store, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours vote for stay."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    return neighbours.keep_good(docs, labels)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted limits and are no outliers stay."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays; documents are linked by
    a similarity of 0.8 in five-word shingles, as SimHash measures it."""
    return near_copies.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources' blocks take turns."""
    return mixing.in_mixed_order(docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """What the last stage needs of a stored table's rows, with ``mix_order``: 0, 1, ...
    in the order of its part files and of the rows in them."""
    name = F.col("_metadata.file_name")
    placed = docs.select(
        "doc_id", "lang", "source", "text",
        name.alias("_file"), F.col("_metadata.row_index").alias("_row"),
    )
    part, piece = (
        F.regexp_extract("_file", r"^part-(\d+)-.*-c(\d+)", k).try_cast("long") for k in (1, 2)
    )
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy(part, piece, "_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    before = sizes.select("_file", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_file").select(
        "doc_id", "lang", "source", "text", (F.col("_before") + F.col("_row")).alias("mix_order")
    )


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded text, and
    its place in the mixed order, ``mix_order``."""
    return bpe.encode(
        _numbered(docs), public_tokenizers.path("byte_bpe_50k.json"), with_ids=True,
        kept=["doc_id", "lang", "source", "mix_order"],
        # Workers still hold what the stages before needed.
        remembered=100_000, slice_bytes=2 << 20,
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]

# Fitted models and iterations are not SQL; tests compare the stages with
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
