import pytest
from pyspark.sql import functions as F

from parcelight.constants import LEAD_COLUMNS, SOURCE_FILES, TABLE_SCHEMAS
from parcelight.plans import audit
from parcelight.plans.runs import Run, ingest, load_leads
from parcelight.streaming import append_arrivals
from workload import views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def county(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("county")
    for name, rows in views.source_tables(spark, SF).items():
        frame = rows.orderBy("_ord").drop("_ord").toPandas()
        frame.to_csv(folder / SOURCE_FILES[name], sep="\t", index=False, na_rep="NA")
    return str(folder)


def test_loading_resumes(spark, tables, county, monkeypatch):
    from parcelight.plans import runs

    assert load_leads(tables, county, goal=40) == 40
    assert load_leads(tables, county, goal=40) == 0
    with monkeypatch.context() as m:  # taken up from what is built, not from the files
        m.setattr(runs, "read_source_tables", None)
        assert load_leads(tables, county, goal=100) == 60
        rest = load_leads(tables, county)
    assert not tables.parts(runs.BUILT)  # all loaded
    assert load_leads(tables, county) == 0
    loaded = tables.read("leads")
    assert loaded.count() == 100 + rest
    whole = views.ingest.build_leads(views.source_tables(spark, SF))
    pick = LEAD_COLUMNS
    assert sorted(map(str, loaded.select(pick).collect())) == sorted(
        map(str, whole.select(pick).collect()))


def test_changed_files_are_built_again(spark, tables, county, tmp_path):
    import shutil

    from parcelight.plans import runs

    folder = shutil.copytree(county, tmp_path / "county")
    load_leads(tables, str(folder), goal=10)
    (built,) = tables.parts(runs.BUILT)
    file = folder / SOURCE_FILES["property"]
    lines = file.read_text().splitlines()
    file.write_text("\n".join(lines + [lines[1].replace(lines[1].split("\t")[0], "NEW1", 1)]) + "\n")
    load_leads(tables, str(folder), goal=20)
    (again,) = tables.parts(runs.BUILT)
    assert again.rows == built.rows + 1 and again.path != built.path
    load_leads(tables, str(folder))
    assert tables.rows("leads") == again.rows
    assert tables.read("leads").where("Parcel = 'NEW1'").count() == 1


def test_ingest_modes(tables, county):
    with pytest.raises(ValueError, match="FULL"):
        ingest(tables, "FULL")
    assert ingest(tables, "DRY_RUN") == 0
    with pytest.raises(FileNotFoundError):
        ingest(tables, "CAMA_LOAD")
    loaded = ingest(tables, "CAMA_LOAD", county)
    assert loaded > 100
    assert ingest(tables, "CAMA_LOAD", "/nowhere") == loaded  # filled: not read again


def test_train_and_predict(spark, tables, county, tmp_path):
    model = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        Run(tables, "PREDICT").predict(model)

    run = Run(tables, "TRAIN", "CAMA_LOAD", county, 2025, run_id="T1")
    trained = run.train(model, gate=0.0, cv_folds=0, trees=3)
    assert trained.saved
    log = tables.read("pipeline_log")
    assert audit.is_complete(log, "T1", "TRAIN")
    rows = {r.stage: (r.records_in, r.records_out) for r in audit.run_summary(log, "T1").collect()}
    leads, clean = tables.read("leads").count(), tables.read("leads_clean").count()
    assert rows == {"scraper": (0, leads), "cleaner": (leads, clean), "features": (clean, clean),
                    "model": (clean, clean)}
    assert run.train(model) is None  # nothing left to do

    scoring = Run(tables, "PREDICT", as_of_year=2025, run_id="P1")
    exported = scoring.predict(model, str(tmp_path / "list"))
    assert exported == clean
    out = tables.read("export_leads")
    assert out.columns == TABLE_SCHEMAS["export_leads"].names
    assert dict(out.dtypes) == {f.name: f.dataType.simpleString()
                                for f in TABLE_SCHEMAS["export_leads"]}
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, clean + 1))
    assert spark.read.option("header", True).csv(str(tmp_path / "list")).count() == clean
    assert tables.read("leads_features").drop("created_at").schema.names == [
        n for n in TABLE_SCHEMAS["leads_features"].names if n != "created_at"]
    assert audit.is_complete(tables.read("pipeline_log"), "P1", "PREDICT")
    assert tables.leads_by_city("nation_1").count() == tables.read("leads").where(
        "PHY_CITY = 'NATION_1'").count()
    assert tables.leads_by_codes(["001"]).count() > 0


def test_failure_is_logged_and_passed_on(tables):
    run = Run(tables, "TRAIN", run_id="F1")
    with pytest.raises(ValueError, match="leads is empty"):
        run.train("/nowhere")
    last = audit.run_summary(tables.read("pipeline_log"), "F1").tail(1)[0]
    assert (last.stage, last.status) == ("scraper", "failed") and "leads" in last.error_message


def test_a_run_that_loaded_nothing_is_taken_up(tables, county):
    first = Run(tables, "TRAIN", "DRY_RUN", as_of_year=2025)
    with pytest.raises(ValueError, match="no rows"):
        first.through_features()
    again = Run(tables, "TRAIN", "CAMA_LOAD", county, 2025)
    assert again.run_id == first.run_id
    assert again.through_features() > 0


def test_a_run_that_kept_nothing_is_taken_up(spark, tables, county):
    good = views.leads(spark, SF).drop("created_at")
    from parcelight.sinks import overwrite_table

    overwrite_table(good.withColumn("DOR_UC", F.lit("900")), tables, "leads")
    first = Run(tables, "TRAIN", as_of_year=2025)
    with pytest.raises(ValueError, match="leads_clean is empty"):
        first.through_features()
    log = audit.run_summary(tables.read("pipeline_log"), first.run_id).collect()
    assert [(r.stage, r.status) for r in log] == [("scraper", "completed"), ("cleaner", "failed")]
    overwrite_table(good, tables, "leads")
    again = Run(tables, "TRAIN", as_of_year=2025)
    assert again.run_id == first.run_id and again.through_features() > 0


def test_stages_leave_no_working_tables(spark, tables, county):
    import os

    from parcelight.storage import working_dir

    def there():
        folder = working_dir(spark)
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = there()
    assert Run(tables, "TRAIN", "CAMA_LOAD", county, 2025).through_features() > 0
    assert there() == before


def test_strict_nulls_rate_no_unknown_neighbourhood(tables, county):
    run = Run(tables, "TRAIN", "CAMA_LOAD", county, 2025, strict_nulls=True)
    assert run.through_features() > 0
    rows = tables.read("leads_features")
    unknown = rows.where("NBRHD_CD IS NULL")
    assert unknown.count() > 0
    assert unknown.where("neighborhood_value_ratio <> 1.0").isEmpty()


def test_fresh_run_starts_from_nothing(tables, county):
    ingest(tables, "CAMA_LOAD", county)
    audit.log_stage(tables, "OLD", "scraper", "completed")
    run = Run(tables, "TRAIN", "CAMA_LOAD", county, 2025, fresh=True)
    assert run.run_id != "OLD"
    assert tables.is_empty("leads") and tables.is_empty("pipeline_log")
    assert run.through_features() == tables.read("leads_features").count() > 0
    resumed = Run(tables, "TRAIN", as_of_year=2025)
    assert resumed.run_id == run.run_id  # features done, model still to come


def test_clean_rows_come_from_leads(spark):
    leads, clean = views.leads(spark, SF), views.clean(spark, SF)
    assert clean.join(leads, "OBJECTID", "left_anti").isEmpty()
    assert views.features(spark, SF).where("hot_lead <> int(%s >= 3)" % " + ".join([
        "never_sold", "is_absentee_owner", "is_out_of_state_owner", "int(property_age > 30)",
        "int(value_tier IN ('distressed', 'entry'))", "int(neighborhood_value_ratio < 0.8)",
        "distressed_sale_history"])).isEmpty()


def test_arriving_files_are_taken_once(spark, tables, tmp_path):
    inbox, marks = str(tmp_path / "inbox"), str(tmp_path / "marks")
    schema = "OBJECTID bigint, Parcel string"

    def arrive(*ids):
        spark.createDataFrame([(i, f"P{i}") for i in ids], schema).write.mode("append").parquet(inbox)

    def take():
        rows = spark.readStream.schema(schema).parquet(inbox)
        query = append_arrivals(rows, tables, "leads", "OBJECTID", marks)
        query.awaitTermination(120)
        return sorted(r.OBJECTID for r in tables.read("leads").collect())

    arrive(1, 2, 2)
    assert take() == [1, 2]
    arrive(2, 3)
    assert take() == [1, 2, 3]
    assert take() == [1, 2, 3]


def test_the_fence_of_stored_sketches(spark, tables, county, monkeypatch):
    from parcelight.plans import cleaning, runs

    load_leads(tables, county, goal=30, sketch=True)
    load_leads(tables, county, sketch=True)
    sketches = runs.load_sketches(tables)
    assert sketches.count() == 2 and sketches.agg(F.sum("loaded")).first()[0] == tables.rows("leads")
    # so few values are held whole: the quartiles are values on either side of the exact ones
    leads = tables.read("leads")
    values = sorted(r.JV for r in cleaning.eligible_leads(leads).collect())
    fence = cleaning.sketched_fence(sketches).first()
    for found, p in ((fence.q1, 0.25), (fence.q3, 0.75)):
        place = p * (len(values) - 1)
        assert values[max(int(place) - 1, 0)] <= found <= values[min(int(place) + 2, len(values) - 1)]
    with monkeypatch.context() as m:  # the leads are not asked
        m.setattr(cleaning, "fit_fence", None)
        run = Run(tables, "TRAIN", as_of_year=2024, run_id="R", sketch=True)
        run.through_features()
    kept = cleaning.filter_leads(leads, fence.upper_bound)
    assert tables.rows("leads_clean") == kept.count()


def test_sketches_that_do_not_cover_the_rows_are_not_used(spark, tables, county):
    from parcelight.plans import runs

    assert runs.load_sketches(tables) is None
    load_leads(tables, county, goal=30)
    load_leads(tables, county, goal=50, sketch=True)
    assert runs.load_sketches(tables) is None
    rows = tables.read("leads").select(*LEAD_COLUMNS).collect()
    schema = tables.read("leads").select(*LEAD_COLUMNS).schema
    runs.overwrite_table(spark.createDataFrame(rows[:20], schema), tables, "leads")
    assert not tables.parts(runs.SKETCHES)  # they went with the rows


def test_profiles_of_a_load_read_no_rows(spark, tables, county, monkeypatch):
    from parcelight.plans import profiling

    load_leads(tables, county, goal=30, profile=True)
    load_leads(tables, county, goal=60, profile=True)
    leads = tables.read("leads")
    expect = {("nulls", r.column, r.check): r.n for r in profiling.nulls_and_zeros(leads).collect()}
    expect |= {("coverage", r.field, "filled"): r.n
               for r in profiling.field_coverage(leads).collect()}
    expect |= {("bucket", r.column, r.bucket): r.n for r in profiling.range_buckets(leads).collect()}
    with monkeypatch.context() as m:
        m.setattr(tables, "read", None)
        counted = profiling.load_profile(tables).collect()
    assert {tuple(r)[:3]: r.n for r in counted if r.n or r.profile != "bucket"} == expect
    load_leads(tables, county)  # does not count: the rows are read
    scanned = profiling.load_profile(tables).collect()
    nulls = profiling.nulls_and_zeros(tables.read("leads")).collect()
    assert {(r.column, r.label): r.n for r in scanned if r.profile == "nulls"} == {
        (r.column, r.check): r.n for r in nulls}


def test_merged_parts_keep_what_was_counted(spark, tables):
    from parcelight import sinks
    from parcelight.plans import profiling

    for i in range(5):
        rows = spark.range(i * 10, i * 10 + 10).select(
            F.col("id").alias("OBJECTID"), F.when(F.col("id") % 3 == 0, 0.0).alias("JV"))
        sinks.append_new_rows(rows, tables, "leads", "OBJECTID", checks=profiling.load_checks())
    assert len(tables.parts("leads")) == 2
    found = {tuple(r)[:3]: r.n for r in profiling.load_profile(tables).collect()}
    assert found["nulls", "JV", "zeros"] == found["bucket", "JV", "zero"] == 17
    assert found["nulls", "JV", "nulls"] == 33 and found["nulls", "Parcel", "nulls"] == 50
