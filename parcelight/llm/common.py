"""What several operators share: reading, held-out rows, working tables, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.storage import ensure_local_folder, new_path

# Texts handled together inside a task: bytes of text, not rows, bound memory.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a missing id counts as ''."""
    crc = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.pmod(crc, F.lit(divisor))


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names: where an operator adds them, its own win."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared working folder, and its path."""
    ensure_local_folder(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a working table that no later step reads."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each slice holds about ``limit`` bytes of
    ``column``; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        begin, total = 0, 0
        for row, size in enumerate(sizes):
            if row > begin and total + (size or 0) > limit:
                yield batch.slice(begin, row - begin)
                begin, total = row, 0
            total += size or 0
        if begin < len(sizes):
            yield batch.slice(begin)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case, as UTF-8.
    Byte strings lower and split by ASCII rules alone, which are these."""
    return text.encode().lower().split() if text else []


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
