"""Tab-separated source tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.constants import SOURCE_COLUMNS, SOURCE_FILES
from parcelight.functions import missing_to_null
from parcelight.operators.shape import require_columns
from parcelight.sources.quoted import file_name, read_records

# Column holding the place of a row in its source file.
ORDINAL = "_ord"


_FORMAT = {"sep": "\t", "quote": '"', "escape": '"'}


def read_tsv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    ordinal: bool = True,
    line_breaks: bool = True,
) -> DataFrame:
    """Every column as text, names from the header, missing-value tokens as
    NULL; only ``columns`` are parsed when given.

    ``_ord`` is the row's place in file order (file, offset of the split,
    place in the split). It is fixed at the scan, so "first in the file" stays
    well defined after any shuffle.

    Quoted fields may hold line breaks. To find out, the files are read once here; if
    some do, their records are put together (:mod:`~parcelight.sources.quoted`), and files
    are split all the same. ``line_breaks=False`` saves that pass for files whose lines
    are known to be records.
    """
    raw = spark.read.options(header=True, **_FORMAT).csv(path)
    names = list(columns or raw.columns)
    require_columns(raw, names, path)
    records = read_records(spark, path) if line_breaks else None
    if records is None:
        place = F.struct(
            file_name(raw.inputFiles()).alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        )
    else:
        fields = ", ".join("`" + c.replace("`", "``") + "` string" for c in raw.columns)
        raw = records.withColumn("_fields", F.from_csv("value", fields, _FORMAT)).select(
            F.struct("file", "start", "row").alias("_place"), "_fields.*"
        )
        place = F.col("_place")
    return raw.select(
        *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in names],
        *([place.alias(ORDINAL)] if ordinal else []),
    )


def read_source_tables(
    spark: SparkSession, folder: str, files: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """The six appraisal tables of a folder, each cut to the columns used."""
    files = files or SOURCE_FILES
    return {
        table: read_tsv(spark, f"{folder.rstrip('/')}/{files[table]}", columns)
        for table, columns in SOURCE_COLUMNS.items()
    }


def source_version(
    spark: SparkSession, folder: str, files: dict[str, str] | None = None
) -> str:
    """Changes when a source file of a folder does: a digest of names, sizes and times."""
    seen = []
    for name in sorted((files or SOURCE_FILES).values()):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        seen += sorted(
            (name, s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found
        )
    return hashlib.sha256(repr(seen).encode()).hexdigest()[:32]
