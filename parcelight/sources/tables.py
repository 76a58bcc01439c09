"""Stage tables: Parquet folders below one root, listed by commits."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelight.constants import DETAIL_COLUMNS, TABLE_SCHEMAS
from parcelight.sources.commits import Commits, Part

# Buckets, by hash, that the keys of a large part are kept in.
BUCKETS = 64
BUCKET = "_bucket"


def key_bucket(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the layout of a stage table: columns by name, cast to their
    types (a value that does not fit is an error), absent ones missing. Columns
    the table does not have are an error."""
    known = TABLE_SCHEMAS[table]
    extra = sorted(set(df.columns) - set(known.names))
    if extra:
        raise ValueError(f"columns unknown to {table}: {extra}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in known
        ]
    )


class LeadTables:
    """The stage tables of one installation."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = Commits(spark, root)

    def parts(self, table: str, **tags: str) -> list[Part]:
        """The parts a table consists of, or those of them with these tags."""
        return [p for p in self.commits.newest().get(table, []) if p.has(tags)]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def new_part(self, table: str) -> str:
        """A folder, below the root, to write a part into."""
        return f"{table}/{uuid.uuid4().hex}"

    def folders(self, table: str, **tags: str) -> list[str]:
        return [f"{self.root}/{p.path}" for p in self.parts(table, **tags)]

    def read(self, table: str, schema: StructType | None = None, **tags: str) -> DataFrame:
        """Whole table as of now, or its parts with these tags; an absent one reads
        as empty. Later commits do not change what the frame reads."""
        return self.read_parts(schema or TABLE_SCHEMAS[table], self.parts(table, **tags))

    def read_parts(self, schema: StructType, parts: list[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in parts])

    def is_empty(self, table: str) -> bool:
        return not any(part.rows for part in self.parts(table))

    def rows(self, table: str) -> int:
        """Rows of a table, as its commits count them."""
        return sum(part.rows for part in self.parts(table))

    # -- leads ----------------------------------------------------------
    def leads_by_city(self, city: str) -> DataFrame:
        return by_city(self.read("leads"), city)

    def leads_by_codes(self, codes: list[str]) -> DataFrame:
        return by_codes(self.read("leads"), codes)

    def lead_details(self) -> DataFrame:
        return self.read("leads").select(*DETAIL_COLUMNS)

    # -- scores ---------------------------------------------------------
    def scores(self, run_id: str | None = None) -> DataFrame:
        """Scores of a run, by default the latest, in rank order."""
        if run_id is None:
            run_id = latest_run(self.read("scored_runs")).first()["run_id"]
        rows = self.read("scored_leads", run_id=run_id) if run_id else self.read("scored_leads")
        return scores_of_run(rows, run_id)


def by_city(leads: DataFrame, city: str) -> DataFrame:
    return leads.where(F.col("PHY_CITY") == city.upper())


def by_codes(leads: DataFrame, codes: list[str]) -> DataFrame:
    return leads.where(F.col("DOR_UC").isin(*codes))


def latest_run(rows: DataFrame, order: list[str] = ("created_at",)) -> DataFrame:
    """One row with the run id of the newest row."""
    newest = F.struct(*[F.col(c) for c in order], F.col("run_id"))
    return rows.agg(F.max_by("run_id", newest).alias("run_id"))


def scores_of_run(scores: DataFrame, run_id: str | None = None) -> DataFrame:
    wanted = F.lit(run_id) if run_id else latest_run(scores).scalar()
    return scores.where(F.col("run_id") == wanted).orderBy("rank")


def stage_input(
    given: DataFrame | None, tables: LeadTables, table: str
) -> DataFrame:
    """The frame handed over in this session, else the stored stage table;
    an error when there is neither."""
    df = given if given is not None else tables.read(table)
    if df.isEmpty():
        if given is not None and not tables.is_empty(table):
            return tables.read(table)
        raise ValueError(f"no input rows: {table} is empty")
    return df
