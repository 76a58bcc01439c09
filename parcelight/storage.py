"""Shared working storage.

A few operators (global numbering, model input) need a result that stays put
between two passes. They write it as a table below the folder named by
``spark.checkpoint.dir``, which every executor can reach: a lost executor then
costs a re-read, never a different answer.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Observation

_chosen: dict[str, str] = {}


def use_folder(spark: SparkSession, path: str) -> None:
    """Names the shared folder of a running application that was started
    without ``spark.checkpoint.dir``."""
    _chosen[spark.conf.get("spark.app.id", "app")] = path


def ensure_local_folder(spark: SparkSession) -> None:
    """For entry points: gives a session on one machine that names no shared
    folder a temporary one. On a cluster the setting stays required."""
    app = spark.conf.get("spark.app.id", "app")
    named = spark.conf.get("spark.checkpoint.dir", None) or _chosen.get(app)
    if named is None and spark.conf.get("spark.master", "").split("[")[0] == "local":
        use_folder(spark, tempfile.mkdtemp(prefix="parcelight-"))


def working_dir(spark: SparkSession) -> str:
    """Folder for working tables of this application."""
    app = spark.conf.get("spark.app.id", "app")
    base = spark.conf.get("spark.checkpoint.dir", None) or _chosen.get(app)
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/parcelight/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{working_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Working tables made inside are deleted at the end: for steps whose
    results are stored elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As :func:`materialize`, with the row count observed during the write."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return stored, seen.get["rows"]


def clear_working_tables(spark: SparkSession) -> None:
    """Deletes the working tables of this application. Frames that read them
    are unusable afterwards: call it when a run's results are stored."""
    _delete(spark, working_dir(spark))
