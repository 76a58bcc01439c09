"""Whole runs: ingest, train, predict.

Each stage reads the table of the stage before it, writes its own, and leaves
a row in the run log. An error is logged as ``failed`` and passed on.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.constants import LEAD_COLUMNS, LEADS_SCHEMA
from parcelight.plans import audit, scoring
from parcelight.plans.cleaning import clean_leads, fit_cleaning, sketch_load
from parcelight.plans.export import export_leads
from parcelight.plans.features import engineer
from parcelight.plans.ingest import build_leads, resume_slice
from parcelight.plans.profiling import load_checks
from parcelight.sinks import (
    append_new_rows,
    append_rows,
    append_run_scores,
    empty_tables,
    overwrite_table,
    write_part,
    write_ranked_file,
)
from parcelight.sources import LeadTables, read_source_tables, source_version, stage_input
from parcelight.storage import scratch

LOAD_MODE = "CAMA_LOAD"
REUSE_MODE = "DRY_RUN"


# Leads built from source files and not all loaded yet, tagged with these files.
BUILT = "leads_built"
SKETCHES = "value_sketches"


def _built_leads(tables: LeadTables, folder: str, strict_nulls: bool) -> DataFrame:
    """The numbered leads of the source files. They are built once and kept, by row
    number, for the loads that take them up; files that have changed are read again."""
    tag = f"{source_version(tables.spark, folder)}-{strict_nulls}"
    if not tables.parts(BUILT, source=tag):
        leads = build_leads(read_source_tables(tables.spark, folder), strict_nulls=strict_nulls)
        by_number = leads.select(*LEAD_COLUMNS).repartitionByRange("OBJECTID").sortWithinPartitions(
            "OBJECTID"
        )
        part = write_part(by_number, tables, BUILT, source=tag)
        tables.commits.commit(lambda state: state.update({BUILT: [part]}))
    return tables.read(BUILT, LEADS_SCHEMA, source=tag).select(*LEAD_COLUMNS)


def load_leads(
    tables: LeadTables,
    folder: str,
    goal: int | None = None,
    strict_nulls: bool = False,
    sketch: bool = False,
    profile: bool = False,
) -> int:
    """Loads leads from the source files of ``folder``, up to ``goal`` rows in
    total, after the rows already loaded. Returns the rows added. A load that stops
    short keeps what it has built: the next one reads its rows from there, not from the
    source files. When all are loaded, nothing is kept. ``sketch`` also stores a sketch of
    the values of this load, for an approximate fence; ``profile`` counts what
    ``profiling.load_profile`` tells, as the rows are written."""
    loaded = tables.rows("leads")
    if goal is not None and loaded >= goal:
        return 0
    if goal is None and not tables.parts(BUILT):
        leads = build_leads(read_source_tables(tables.spark, folder), strict_nulls=strict_nulls)
    else:
        leads = _built_leads(tables, folder, strict_nulls)
    rest = resume_slice(leads, loaded, goal).select(*LEAD_COLUMNS)
    added = append_new_rows(
        rest, tables, "leads", "OBJECTID", unique=True,
        checks=load_checks() if profile else None,
    )
    if tables.rows(BUILT) and tables.rows("leads") >= tables.rows(BUILT):
        tables.commits.commit(lambda state: state.pop(BUILT, None))
    if sketch and added:
        fresh = tables.read("leads").where(F.col("OBJECTID") > loaded)
        append_rows(sketch_load(fresh), tables, SKETCHES)
    return added


def load_sketches(tables: LeadTables) -> DataFrame | None:
    """The sketches of all loads, if they cover the leads: ranges that do not meet and
    together have as many rows as the table. Otherwise (a load has left none, rows came
    another way) None: the fence is then worked out from the rows."""
    sketches = tables.read(SKETCHES)
    ranges = sorted(sketches.select("first_id", "last_id", "loaded").collect())
    apart = all(one.last_id < two.first_id for one, two in zip(ranges, ranges[1:]))
    covered = sum(r.loaded for r in ranges)
    return sketches if ranges and apart and covered == tables.rows("leads") else None


def ingest(
    tables: LeadTables,
    run_mode: str,
    folder: str | None = None,
    strict_nulls: bool = False,
    sketch: bool = False,
) -> int:
    """Fills the leads table, or leaves a filled one alone; rows in it after."""
    if run_mode not in (LOAD_MODE, REUSE_MODE):
        raise ValueError(f"unknown run mode {run_mode!r}")
    if run_mode == LOAD_MODE and tables.is_empty("leads"):
        if folder is None:
            raise FileNotFoundError("no source folder given")
        load_leads(tables, folder, strict_nulls=strict_nulls, sketch=sketch)
    return tables.rows("leads")


class Run:
    """One run over a set of stage tables."""

    def __init__(
        self,
        tables: LeadTables,
        mode: str,
        run_mode: str = REUSE_MODE,
        folder: str | None = None,
        as_of_year: int | None = None,
        run_id: str | None = None,
        fresh: bool = False,
        strict_nulls: bool = False,
        sketch: bool = False,
    ):
        """``fresh`` empties all stage tables first: there is no way back.
        ``strict_nulls`` keeps unknown owner states and neighbourhoods unknown.
        ``sketch`` has loads leave a sketch of their values, and cleaning take the fence
        from these, approximately, where they cover all rows."""
        if fresh:
            empty_tables(tables)
        self.tables = tables
        self.mode = mode
        self.run_mode = run_mode
        self.folder = folder
        self.as_of_year = as_of_year
        self.strict_nulls = strict_nulls
        self.sketch = sketch
        self.run_id = run_id or audit.resume_run_id(tables, mode, fresh)
        self.modes = {"pipeline_mode": mode, "run_mode": run_mode}

    def _stage(
        self, name: str, rows_in: int, work: Callable[[], int], table: str | None = None
    ) -> int:
        """Runs one stage and logs it. A stage this run has already completed is
        left alone if its ``table`` has rows for the next one. A stage without
        rows has failed: what comes after it could do nothing."""
        log = self.tables.read("pipeline_log")
        there = table is None or not self.tables.is_empty(table)
        if there and audit.stage_status(log, self.run_id, name) == "completed":
            done = audit.run_summary(log, self.run_id).where(f"stage = '{name}'")
            return done.tail(1)[0]["records_out"]
        begin = time.monotonic()
        try:
            if table is None:
                rows_out = work()
            else:  # its result is in the table
                with scratch(self.tables.spark):
                    rows_out = work()
            if not rows_out:
                raise ValueError(f"stage {name} has no rows: {table or name} is empty")
        except Exception as error:
            audit.log_stage_error(self.tables, self.run_id, name, error, **self.modes)
            raise
        audit.log_stage(
            self.tables, self.run_id, name, "completed", rows_in, rows_out,
            time.monotonic() - begin, **self.modes,
        )
        return rows_out

    def through_features(self) -> int:
        """Ingest, clean and features; rows of the last."""
        tables = self.tables
        before = tables.rows("leads")
        rows = self._stage(
            "scraper", before,
            lambda: ingest(
                tables, self.run_mode, self.folder, self.strict_nulls, self.sketch
            ),
            "leads",
        )

        def clean() -> int:
            leads = stage_input(None, tables, "leads")
            sketches = load_sketches(tables) if self.sketch else None
            return overwrite_table(
                clean_leads(leads, fit_cleaning(leads, sketches)), tables, "leads_clean"
            )

        def features() -> int:
            rows = stage_input(None, tables, "leads_clean")
            return overwrite_table(
                engineer(rows, self.as_of_year, self.strict_nulls), tables, "leads_features"
            )

        rows = self._stage("cleaner", rows, clean, "leads_clean")
        return self._stage("features", rows, features, "leads_features")

    def train(self, model_path: str, **params) -> scoring.Training | None:
        """Ingest to model. None when this run had already trained."""
        rows = self.through_features()
        result: list[scoring.Training] = []

        def fit() -> int:
            features = stage_input(None, self.tables, "leads_features")
            result.append(scoring.train(features, model_path, **params))
            return rows

        self._stage("model", rows, fit)
        return result[0] if result else None

    def predict(self, model_path: str, export_path: str | None = None) -> int:
        """Ingest to ranked export. Returns the number of leads exported."""
        model = scoring.load_model(model_path)  # nothing to do without one
        rows = self.through_features()
        tables = self.tables

        def score() -> int:
            features = stage_input(None, tables, "leads_features")
            ranked = scoring.rank_leads(scoring.score(features, model))
            return append_run_scores(ranked, tables, self.run_id, self.mode)

        def export() -> int:
            leads = tables.read("leads")
            rows_out = overwrite_table(
                export_leads(tables.scores(self.run_id), leads), tables, "export_leads"
            )
            if export_path:
                write_ranked_file(tables.read("export_leads"), export_path)
            return rows_out

        rows = self._stage("predictor", rows, score, "scored_leads")
        return self._stage("export", rows, export, "export_leads")
