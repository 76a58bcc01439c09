"""Writing stage tables and the final list."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Observation
from pyspark.sql.types import IntegerType, StructField, StructType

from parcelight.constants import CLUSTERING, DERIVED, TABLE_SCHEMAS
from parcelight.operators.reduce import first_by_key
from parcelight.sources.commits import Conflict, Part, State
from parcelight.sources.tables import BUCKET, LeadTables, conform, key_bucket
from parcelight.storage import materialize


# Parts of about equal size that are merged into one, and rows of a part that stays.
FANOUT = 4
LARGE = 1_000_000
# Parts of so many rows keep their keys a second time, by bucket; smaller ones are read.
INDEXED = 100_000
# Rows of a page: what a scan of clustered rows reads beyond those it wants.
_PAGE_ROWS = 5_000
_AGAIN = 3


def write_part(
    df: DataFrame,
    tables: LeadTables,
    table: str,
    checks: dict[str, Column] | None = None,
    index_from: int | None = None,
    **tags: str,
) -> Part:
    """Writes the rows of a part, which no commit lists yet; the row count, and that of
    the rows that meet each of ``checks``, are observed during the write.

    Rows of a table that is read by some columns are sorted by them within each file, so
    the minima and maxima of pages let a scan pass over the others; nothing is shuffled
    for it. A part with a ``key`` tag keeps its keys by bucket if it has
    ``index_from`` rows (:data:`INDEXED`).
    """
    path = tables.new_part(table)
    seen = Observation()
    found = [F.count_if(c).alias(name) for name, c in (checks or {}).items()]
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *found)
    if table in CLUSTERING:
        rows = rows.sortWithinPartitions(*CLUSTERING[table])
    rows.write.option("parquet.page.row.count.limit", _PAGE_ROWS).parquet(f"{tables.root}/{path}")
    counts = dict(seen.get)
    part = Part(path, counts.pop("rows"), tags, counts=counts)
    if "key" in tags and part.rows >= (INDEXED if index_from is None else index_from):
        return replace(part, keys=_write_keys(tables, table, part, tags["key"]))
    return part


def _write_keys(tables: LeadTables, table: str, part: Part, key: str) -> str:
    """The keys of a part in a folder per bucket; returns where."""
    path = tables.new_part(f"{table}_keys")
    keys = tables.read_parts(TABLE_SCHEMAS[table], [part]).select(key)
    keys.select(key, key_bucket(key).alias(BUCKET)).repartition(BUCKET).write.partitionBy(
        BUCKET
    ).parquet(f"{tables.root}/{path}")
    return path


def compact(tables: LeadTables, table: str) -> None:
    """Merges :data:`FANOUT` parts of a level into one of the next, as long as there are
    so many, up to parts of :data:`LARGE` rows: appending n times leaves about log n
    parts. If others change the parts meanwhile, it is left to them."""
    while True:
        levels: dict[tuple, list[Part]] = {}
        for part in tables.parts(table):
            if part.rows < LARGE:
                levels.setdefault(tuple(sorted(part.tags.items())), []).append(part)
        ready = [parts for parts in levels.values() if len(parts) >= FANOUT]
        if not ready:
            return
        old = ready[0]
        rows = tables.read_parts(TABLE_SCHEMAS[table], old)
        tags = {**old[0].tags, "level": str(int(old[0].tags.get("level", "0")) + 1)}
        merged = write_part(rows.coalesce(1), tables, table, **tags)
        counted = set.intersection(*[set(part.counts) for part in old])
        merged = replace(
            merged, counts={name: sum(p.counts[name] for p in old) for name in sorted(counted)}
        )

        def swap(state: State) -> None:
            if not all(part in state.get(table, []) for part in old):
                raise Conflict(table)
            state[table] = [p for p in state[table] if p not in old] + [merged]

        try:
            tables.commits.commit(swap)
        except Conflict:
            return


def overwrite_table(
    df: DataFrame, tables: LeadTables, table: str, checks: dict[str, Column] | None = None
) -> int:
    """Replaces a stage table; its rows are there until the new ones are written."""
    part = write_part(conform(df, table), tables, table, checks)

    def change(state: State) -> None:
        state[table] = [part]
        for name in DERIVED.get(table, []):
            state.pop(name, None)

    tables.commits.commit(change)
    return part.rows


def append_rows(df: DataFrame, tables: LeadTables, table: str) -> int:
    """Appends rows as they are."""
    part = write_part(conform(df, table), tables, table)
    tables.commits.commit(lambda state: state.setdefault(table, []).append(part))
    compact(tables, table)
    return part.rows


def append_new_rows(
    batch: DataFrame,
    tables: LeadTables,
    table: str,
    key: str,
    order: Column | None = None,
    unique: bool = False,
    checks: dict[str, Column] | None = None,
    index_from: int | None = None,
) -> int:
    """Appends the rows whose key the table does not hold yet.

    Within the batch the first row of a key (by ``order``) wins; ``unique``
    states that there is only one. Known rows leave before any of that. Applying
    the same batch again changes nothing. The batch is brought into the layout
    of the table first. If others append meanwhile, it is done again on what they left.
    ``checks`` are counted over the rows appended, as they are written.
    """
    for last in (*[False] * (_AGAIN - 1), True):
        held = tables.parts(table)
        if any(part.keys for part in held):  # read for its buckets, then for its rows
            batch = materialize(batch, f"batch-{table}")
        stored = stored_keys(batch, tables, table, held, key)
        new = _unknown_rows(batch, stored, key, order, unique)
        fresh = conform(new, table)
        if "created_at" in fresh.columns and "created_at" not in batch.columns:
            fresh = fresh.withColumn("created_at", F.current_timestamp())
        part = write_part(fresh, tables, table, checks, index_from, key=key)
        if not part.rows:
            return 0
        try:
            tables.commits.commit(
                lambda state: state.setdefault(table, []).append(part), unchanged={table: held}
            )
            break
        except Conflict:  # others have appended: their keys are known now
            if last:
                raise
    compact(tables, table)
    return part.rows


def stored_keys(
    batch: DataFrame, tables: LeadTables, table: str, held: list[Part], key: str
) -> DataFrame:
    """The keys the parts hold, as far as the batch may know them: of a part that keeps
    its keys by bucket, only the buckets the batch has keys in are read (their numbers,
    at most ``BUCKETS``, pass through the driver)."""
    schema = TABLE_SCHEMAS[table]
    indexed = [p for p in held if p.keys and p.tags.get("key") == key]
    stored = tables.read_parts(schema, [p for p in held if p not in indexed]).select(key)
    if indexed:
        # Buckets are those of the stored type; a value that does not fit has none.
        kept = F.col(key).try_cast(schema[key].dataType)
        buckets = batch.where(kept.isNotNull()).select(key_bucket(kept).alias(BUCKET)).distinct()
        wanted = [row[BUCKET] for row in buckets.collect()]
        for part in indexed:
            keys = tables.spark.read.schema(
                StructType([schema[key], StructField(BUCKET, IntegerType())])
            ).parquet(f"{tables.root}/{part.keys}")
            stored = stored.union(keys.where(F.col(BUCKET).isin(wanted)).select(key))
    return stored


def _unknown_rows(
    batch: DataFrame, stored: DataFrame, key: str, order: Column | None, unique: bool
) -> DataFrame:
    order = order if order is not None else F.struct(*sorted(batch.columns))
    ordered = batch.withColumn("_order", order)
    new = ordered.where(F.col(key).isNotNull()).join(
        stored.select(F.col(key).cast(batch.schema[key].dataType)), key, "left_anti"
    )
    if not unique:
        new = first_by_key(new, key, [c for c in batch.columns if c != key], F.col("_order"))
    return new.select(*batch.columns)


def append_run_scores(
    scores: DataFrame,
    tables: LeadTables,
    run_id: str,
    mode: str,
    replace_run: bool = False,
) -> int:
    """Appends (OBJECTID, hot_lead_score, rank) of a run to ``scored_leads``.

    A parcel is scored once per run: a duplicate id, in the batch or already
    stored for the run, is an error and nothing is written. ``replace_run``
    swaps the run's part instead, for reruns. No rows, no change.
    """
    # Written once: the check and the append then see the same scores.
    tagged = materialize(
        scores.select(
            F.lit(run_id).alias("run_id"),
            F.col("OBJECTID").cast("bigint"),
            F.col("hot_lead_score").cast("double"),
            F.col("rank").cast("bigint"),
            F.lit(mode).alias("pipeline_mode"),
            F.current_timestamp().alias("created_at"),
        ),
        f"scores-{run_id}",
    )
    if tagged.isEmpty():
        return 0
    twice = tagged.groupBy("OBJECTID").count().where("count > 1").select("OBJECTID")
    held = tables.parts("scored_leads")
    stored = tables.read_parts(
        TABLE_SCHEMAS["scored_leads"], [p for p in held if p.has({"run_id": run_id})]
    )
    clash = tagged.join(stored, "OBJECTID", "left_semi").select("OBJECTID")
    if not (twice if replace_run else twice.union(clash)).isEmpty():
        raise ValueError(f"duplicate (run_id, OBJECTID) in run {run_id}")
    scored = write_part(conform(tagged, "scored_leads"), tables, "scored_leads", run_id=run_id)
    runs = tables.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("created_at")
    )
    registered = write_part(conform(runs, "scored_runs"), tables, "scored_runs")

    def add(state: State) -> None:
        kept = [p for p in state.get("scored_leads", [])
                if not (replace_run and p.has({"run_id": run_id}))]
        state["scored_leads"] = [*kept, scored]
        state.setdefault("scored_runs", []).append(registered)

    # Scores and the note that there are some appear together.
    tables.commits.commit(add, unchanged={"scored_leads": held})
    compact(tables, "scored_runs")
    return scored.rows


def empty_tables(tables: LeadTables, names: list[str] | None = None) -> None:
    """Removes all rows of the stage tables, of all at once."""

    def remove(state: State) -> None:
        for name in names or list(state):
            for gone in (name, *DERIVED.get(name, [])):
                state.pop(gone, None)

    tables.commits.commit(remove)


def write_ranked_file(df: DataFrame, path: str, order: str = "rank") -> None:
    """The ranked list as CSV with header: files in rank order, sorted within."""
    df.orderBy(order).write.mode("overwrite").option("header", True).csv(path)
