"""Incremental loading: lead rows that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from parcelight.sinks import append_new_rows
from parcelight.sources import LeadTables


def append_arrivals(
    rows: DataFrame,
    tables: LeadTables,
    table: str,
    key: str,
    checkpoint: str,
) -> StreamingQuery:
    """Appends every arriving row whose key the table does not hold, then
    stops; the next call goes on after the files already taken.

    A batch that is replayed after a failure adds nothing twice, because known
    keys are ignored.
    """

    def append(batch: DataFrame, _: int) -> None:
        append_new_rows(batch, tables, table, key)

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
