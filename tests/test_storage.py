import pytest
from pyspark.sql import functions as F

from parcelight import sinks, sources
from parcelight.constants import TABLE_SCHEMAS
from parcelight.plans import audit, export, scoring
from parcelight.storage import working_dir


def test_tsv_reading(spark, tmp_path):
    (tmp_path / "t.txt").write_text(
        "Parcel\tA\tB\tC\n"
        'p1\t NA\tNA\t"tab\tand ""quote"""\n'
        "p2\t\tN/A\tnull\n"
        "NaN\t1_000\t00100\t  x \n"
    )
    df = sources.read_tsv(spark, str(tmp_path / "t.txt"), ["Parcel", "C", "A"])
    rows = [tuple(r)[:3] for r in df.orderBy("_ord").collect()]
    assert rows == [("p1", 'tab\tand "quote"', " NA"), ("p2", None, None),
                    (None, "  x ", "1_000")]
    whole = sources.read_tsv(spark, str(tmp_path / "t.txt"), ordinal=False)
    assert whole.columns == ["Parcel", "A", "B", "C"]
    assert [r.B for r in whole.where("Parcel = 'p1' or Parcel = 'p2'").collect()] == [None, None]
    with pytest.raises(ValueError, match="Missing"):
        sources.read_tsv(spark, str(tmp_path / "t.txt"), ["Missing"])


def _written(path, rows):
    """Rows as any writer of such files quotes them."""
    import csv

    with open(path, "w", newline="") as out:
        csv.writer(out, delimiter="\t", lineterminator="\n").writerows(rows)


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in
            ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)),
                        spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    for k, v in keep.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed, split", [(1, 130), (2, 600), (3, 1 << 20)])
def test_quoted_line_breaks(spark, tmp_path, small_splits, seed, split):
    """Records over several lines, and over several splits, at random places."""
    import random

    rng = random.Random(seed)
    texts = ["plain", "a\nb", "\n", 'say "hi"', '"', '""\n"', "x\ty", "tab\t\n\tend", "",
             'quote at end"', "é\n\n\n" + "z" * 150, '5" pipe']
    head = ["Parcel", "A", "B C"]
    for part in range(2):
        rows = [[f"p{part}-{i:04d}", rng.choice(texts) if rng.random() < 0.3 else "c", rng.choice(texts)]
                for i in range(45)]
        _written(tmp_path / f"t{part}.txt", [head, *rows])
        expect = rows if part == 0 else expect + rows
    small_splits(split)
    df = sources.read_tsv(spark, str(tmp_path / "t*.txt"))
    found = [tuple(r)[:3] for r in df.orderBy("_ord").collect()]
    assert found == [tuple(c or None for c in r) for r in expect]
    if split < 200:
        assert df.select("_ord.file", "_ord.start").distinct().count() > 6  # files were split


def test_quotes_that_open_no_field(spark, tmp_path, small_splits):
    """A quote inside an unquoted field is a character: nothing is torn or joined."""
    lines = ["Parcel\tA", 'p1\t5" pipe', "p2\tx", 'p3\t6" "pipe', 'p4\t"in\nside"\t', "p5\ty"]
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n\n")
    small_splits(24)
    rows = sources.read_tsv(spark, str(tmp_path / "t.txt")).orderBy("_ord").collect()
    assert [(r.Parcel, r.A) for r in rows] == [
        ("p1", '5" pipe'), ("p2", "x"), ("p3", '6" "pipe'), ("p4", "in\nside"), ("p5", "y")]


def test_lines_without_breaks_are_read_directly(spark, tmp_path):
    (tmp_path / "t.txt").write_text('Parcel\tA\np1\t"a ""b"" c"\n')
    df = sources.read_tsv(spark, str(tmp_path / "t.txt"))
    assert "Window" not in df._jdf.queryExecution().toString()
    assert [r.A for r in df.collect()] == ['a "b" c']


def test_file_order_survives_splits(spark, tmp_path, small_splits):
    lines = [f"k{i % 7}\t{i}\t{'x' * 50}" for i in range(4000)]
    (tmp_path / "t.txt").write_text("Parcel\tN\tPad\n" + "\n".join(lines) + "\n")
    small_splits(20_000)
    df = sources.read_tsv(spark, str(tmp_path / "t.txt"))
    assert df.rdd.getNumPartitions() > 3
    order = [int(r.N) for r in df.repartition(5).orderBy("_ord").collect()]
    assert order == list(range(4000))


def test_absent_tables_read_as_empty(tables):
    for name, schema in TABLE_SCHEMAS.items():
        df = tables.read(name)
        assert df.isEmpty() and df.columns == schema.names


def test_stage_input(spark, tables):
    with pytest.raises(ValueError, match="leads_clean"):
        sources.stage_input(None, tables, "leads_clean")
    stored = spark.createDataFrame([(1,)], "OBJECTID bigint")
    assert sinks.overwrite_table(stored, tables, "leads_clean") == 1
    assert sources.stage_input(None, tables, "leads_clean").count() == 1
    given = spark.range(5)  # a frame handed over is taken as it is
    assert sources.stage_input(given, tables, "leads_clean").count() == 5
    assert sources.stage_input(given.limit(0), tables, "leads_clean").count() == 1


def test_append_ignores_known_keys(spark, tables):
    def batch(rows):
        return spark.createDataFrame(rows, "OBJECTID bigint, Parcel string, JV int")

    first = batch([(1, "a", 1), (2, "b", 1), (2, "b", 0)])
    assert sinks.append_new_rows(first, tables, "leads", "OBJECTID", F.col("JV")) == 2
    assert sinks.append_new_rows(first, tables, "leads", "OBJECTID", F.col("JV")) == 0
    assert sinks.append_new_rows(
        batch([(2, "z", 9), (3, "c", 1)]), tables, "leads", "OBJECTID") == 1
    rows = {r.OBJECTID: (r.Parcel, r.JV) for r in tables.read("leads").collect()}
    assert rows == {1: ("a", 1), 2: ("b", 0), 3: ("c", 1)}
    assert tables.read("leads").schema == TABLE_SCHEMAS["leads"]


def test_batches_are_brought_into_the_layout(spark, tables):
    narrow = spark.createDataFrame([(1, "a")], "OBJECTID int, Parcel string")
    sinks.append_new_rows(narrow, tables, "leads", "OBJECTID")
    wide = spark.createDataFrame([(2, "b", "7.5", "x")],
                                 "OBJECTID bigint, Parcel string, JV string, PHY_CITY string")
    sinks.append_new_rows(wide, tables, "leads", "OBJECTID")
    rows = {r.OBJECTID: (r.Parcel, r.JV, r.PHY_CITY) for r in tables.read("leads").collect()}
    assert rows == {1: ("a", None, None), 2: ("b", 7.5, "x")}
    with pytest.raises(ValueError, match="colour"):
        sinks.append_new_rows(wide.withColumnRenamed("PHY_CITY", "colour"), tables, "leads",
                              "OBJECTID")


def _scores(spark, ids):
    rows = [(i, 1.0 / n, n) for n, i in enumerate(ids, start=1)]
    return spark.createDataFrame(rows, "OBJECTID bigint, hot_lead_score double, rank int")


def test_scores_of_runs(spark, tables):
    assert sinks.append_run_scores(_scores(spark, []), tables, "R0", "PREDICT") == 0
    assert tables.read("scored_leads").isEmpty()
    assert sinks.append_run_scores(_scores(spark, [5, 6, 7]), tables, "R1", "PREDICT") == 3
    with pytest.raises(ValueError, match="R1"):
        sinks.append_run_scores(_scores(spark, [7, 8]), tables, "R1", "PREDICT")
    with pytest.raises(ValueError, match="R2"):
        sinks.append_run_scores(_scores(spark, [7, 7]), tables, "R2", "PREDICT")
    assert sinks.append_run_scores(_scores(spark, [9, 5]), tables, "R2", "TRAIN") == 2
    assert [r.OBJECTID for r in tables.scores().collect()] == [9, 5]
    assert [r.OBJECTID for r in tables.scores("R1").collect()] == [5, 6, 7]
    sinks.append_run_scores(_scores(spark, [1]), tables, "R1", "PREDICT", replace_run=True)
    assert [r.OBJECTID for r in tables.scores("R1").collect()] == [1]
    assert tables.read("scored_leads").where("run_id = 'R2'").count() == 2


def test_emptying_keeps_layout_and_stays_writable(spark, tables):
    sinks.append_run_scores(_scores(spark, [5]), tables, "R1", "PREDICT")
    sinks.append_new_rows(
        spark.createDataFrame([(1, "a")], "OBJECTID bigint, Parcel string"),
        tables, "leads", "OBJECTID")
    columns = tables.read("leads").columns
    sinks.empty_tables(tables)
    assert tables.read("leads").isEmpty() and tables.read("leads").columns == columns
    assert tables.read("scored_leads").isEmpty()
    assert sinks.append_run_scores(_scores(spark, [5]), tables, "R1", "PREDICT") == 1
    assert tables.scores().count() == 1


def test_export(spark, tables, tmp_path):
    leads = spark.createDataFrame(
        [(1, "P1", "ANN", 32601.7, 1990.0), (2, "P2", "BOB", None, 1991.0)],
        "OBJECTID bigint, Parcel string, OWN_NAME string, PHY_ZIPCD double, ACT_YR_BLT double")
    for c in export.DETAIL_COLUMNS:
        if c not in leads.columns:
            leads = leads.withColumn(c, F.lit(None).cast(
                "string" if c in ("OWN_ADDR1", "OWN_STATE_", "PHY_CITY", "DOR_UC", "NBRHD_CD")
                else "double"))
    scores = _scores(spark, [2, 1, 3]).withColumn("hot_lead_score", F.col("hot_lead_score") * 0.9)
    out = export.export_leads(scores, leads)
    assert out.columns == export.EXPORT_COLUMNS
    rows = [(r["rank"], r.temperature, r.Parcel, r.PHY_ZIPCD, r.ACT_YR_BLT) for r in out.collect()]
    assert rows == [(1, "HOT", "P2", 0, 1991), (2, "COLD", "P1", 32601, 1990),
                    (3, "COLD", None, 0, 0)]
    matched = export.matched_count(export.with_details(scores, leads)).first()
    assert (matched["records"], matched["matched"]) == (3, 2)
    sinks.write_ranked_file(out, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == export.EXPORT_COLUMNS and back.count() == 3


def test_top_leads_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9)], "OBJECTID bigint, hot_lead_score double")
    assert [r.OBJECTID for r in scoring.top_leads(df, 2).collect()] == [2, 1]


def test_run_log(tables):
    log = lambda run, stage, status, **kw: audit.log_stage(tables, run, stage, status, **kw)
    assert audit.last_run(tables.read("pipeline_log")).first()["run_id"] is None
    assert audit.stage_status(tables.read("pipeline_log"), "R1", "cleaner") is None
    for stage in ("scraper", "cleaner", "features"):
        log("R1", stage, "completed", records_out=5)
    audit.log_stage_error(tables, "R1", "model", ValueError("bad"))
    rows = tables.read("pipeline_log")
    assert not audit.is_complete(rows, "R1", "TRAIN")
    assert audit.resume_run_id(tables, "TRAIN") == "R1"
    assert audit.resume_run_id(tables, "PREDICT") != "R1"
    log("R1", "model", "completed", duration_secs=1.239)
    rows = tables.read("pipeline_log")
    assert audit.is_complete(rows, "R1", "TRAIN")
    assert audit.stage_status(rows, "R1", "model") == "completed"
    assert audit.resume_run_id(tables, "TRAIN") != "R1"
    summary = audit.run_summary(rows).collect()
    assert [r.stage for r in summary] == ["scraper", "cleaner", "features", "model", "model"]
    assert summary[3].error_message == "bad" and summary[4].duration_secs == 1.24


def test_working_dir_is_the_shared_folder(spark):
    assert working_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_working_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    from parcelight import storage

    monkeypatch.setattr(storage, "working_dir", lambda _: str(tmp_path / "work"))
    stored, rows = storage.materialize_counted(spark.range(7), "seven")
    assert rows == 7 and stored.count() == 7
    storage.clear_working_tables(spark)
    assert not (tmp_path / "work").exists()


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    conf = {"spark.master": "yarn", "spark.app.id": "a"}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_dir(cluster)
    conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert working_dir(cluster) == "hdfs:///shared/parcelight/a"


BOOM = "raise_error('executor gone')"


def test_a_write_that_dies_leaves_the_rows(spark, tables):
    rows = spark.range(9).withColumnRenamed("id", "OBJECTID")
    sinks.overwrite_table(rows, tables, "leads_clean")
    reader = tables.read("leads_clean")
    dying = rows.withColumn("JV", F.expr(f"IF(OBJECTID = 7, {BOOM}, 1.0)").cast("double"))
    with pytest.raises(Exception, match="executor gone"):
        sinks.overwrite_table(dying, tables, "leads_clean")
    with pytest.raises(Exception, match="executor gone"):
        sinks.append_new_rows(dying.withColumn("OBJECTID", F.col("OBJECTID") + 5), tables,
                              "leads_clean", "OBJECTID")
    assert tables.read("leads_clean").count() == tables.rows("leads_clean") == 9
    # what the jobs left behind goes, what a reader holds stays readable until then
    sinks.overwrite_table(rows.limit(2), tables, "leads_clean")
    assert reader.count() == 9 and tables.read("leads_clean").count() == 2
    assert tables.commits.vacuum() == 0  # too young
    assert tables.commits.vacuum(older_than_hours=-1) >= 2
    assert tables.read("leads_clean").count() == 2


def test_scores_and_their_run_are_there_together(spark, tables, monkeypatch):
    from parcelight.sinks import tables as module

    sinks.append_run_scores(_scores(spark, [1]), tables, "R1", "PREDICT")
    write = module.write_part

    def failing(df, tables, table, *checks, **tags):
        if table == "scored_runs":
            raise OSError("disk full")
        return write(df, tables, table, *checks, **tags)

    monkeypatch.setattr(module, "write_part", failing)
    for replace in (False, True):
        with pytest.raises(OSError):
            sinks.append_run_scores(_scores(spark, [2]), tables, "R2", "PREDICT", replace)
    assert [r.run_id for r in tables.scores().collect()] == ["R1"]
    assert tables.read("scored_leads").count() == tables.read("scored_runs").count() == 1


def test_a_run_reads_its_own_files(spark, tables):
    for run in ("R1", "R2", "R3"):
        sinks.append_run_scores(_scores(spark, [1, 2]), tables, run, "PREDICT")
    (part,) = tables.parts("scored_leads", run_id="R2")
    files = tables.scores("R2").inputFiles()
    assert files and all(part.path in f for f in files)


def test_writers_do_not_lose_each_others_rows(spark, tables, monkeypatch):
    def batch(*ids):
        return spark.createDataFrame([(i, f"P{i}") for i in ids], "OBJECTID bigint, Parcel string")

    from parcelight.sinks import tables as module

    write, others = module.write_part, [batch(2, 3)]

    def overtaken(df, tables, table, *checks, **tags):
        part = write(df, tables, table, *checks, **tags)
        if others:  # another writer commits first
            sinks.append_new_rows(others.pop(), tables, table, "OBJECTID")
        return part

    monkeypatch.setattr(module, "write_part", overtaken)
    assert sinks.append_new_rows(batch(1, 2), tables, "leads", "OBJECTID") == 1
    assert sorted(r.OBJECTID for r in tables.read("leads").collect()) == [1, 2, 3]


def test_taken_numbers_and_stale_changes(spark, tmp_path):
    commits = sources.Commits(spark, str(tmp_path / "c"))
    one, two = sources.Part("a/1", 1), sources.Part("a/2", 2)
    commits.commit(lambda s: s.update(a=[one]))
    assert not commits._put(0, {})  # its number is taken
    commits.commit(lambda s: s["a"].append(two), unchanged={"a": [one], "b": []})
    with pytest.raises(sources.Conflict, match="a has changed"):
        commits.commit(lambda s: s.clear(), unchanged={"a": [one]})
    assert commits.newest() == {"a": [one, two]}


def test_a_long_log_is_few_files(spark, tables, monkeypatch):
    schema = TABLE_SCHEMAS["pipeline_log"]
    rows = lambda i: spark.createDataFrame(
        [(i, f"R{i // 5}", "cleaner", "completed", 0, i, 0.0, None, None, None, None)], schema)
    for i in range(21):
        sinks.append_rows(rows(i), tables, "pipeline_log")
        assert len(tables.parts("pipeline_log")) <= 6
    log = tables.read("pipeline_log")
    assert sorted(r.id for r in log.collect()) == list(range(21))
    assert audit.last_run(log).first()["run_id"] is not None
    assert len(log.inputFiles()) <= 6


def test_many_stages_of_a_log(tables, monkeypatch):
    """Parts of a thousand rows, without writing them one by one."""
    import itertools

    from parcelight.sinks import tables as module

    class Memory:
        state = {}

        def newest(self):
            return self.state

        def commit(self, change, unchanged=None):
            change(self.state)

    class Rows(int):
        def coalesce(self, n):
            return int(self)

    count = itertools.count()
    monkeypatch.setattr(tables, "commits", Memory())
    monkeypatch.setattr(module, "write_part", lambda rows, t, table, **tags: sources.Part(
        f"{table}/{next(count)}", rows, tags))
    monkeypatch.setattr(
        tables, "read_parts", lambda schema, parts: Rows(sum(p.rows for p in parts)))
    for _ in range(1000):
        part = module.write_part(1, tables, "pipeline_log")
        tables.commits.commit(lambda s: s.setdefault("pipeline_log", []).append(part))
        module.compact(tables, "pipeline_log")
    assert len(tables.parts("pipeline_log")) < 20 and tables.rows("pipeline_log") == 1000


def _scanned(df):
    """Rows that the scan of a frame hands on, and the files it opens."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    metrics = [s.metrics() for s in scans if "FileSourceScan" in s.getClass().getName()]
    return tuple(sum(m.apply(name).value() for m in metrics)
                 for name in ("numOutputRows", "numFiles"))


def test_filtered_scans_pass_over_other_rows(spark, tables):
    """Cities and codes in no order before; what is read is what is found, and for each
    run of equal rows at most two pages more: one run a file for a city, one a file and
    city for a code."""
    rows = spark.range(200_000, numPartitions=2).select(
        F.col("id").alias("OBJECTID"),
        F.concat(F.lit("CITY"), F.pmod(F.xxhash64("id"), F.lit(5))).alias("PHY_CITY"),
        F.lpad(F.pmod(F.hash("id"), F.lit(8)).cast("string"), 3, "0").alias("DOR_UC"))
    sinks.overwrite_table(rows, tables, "leads")
    for found, runs in ((tables.leads_by_city("city3"), 2), (tables.leads_by_codes(["001"]), 2 * 5)):
        read, _ = _scanned(found.select("OBJECTID"))
        expected = found.count()
        assert expected <= read <= min(expected + runs * 2 * 5_000, 120_000)
    assert tables.read("leads").count() == 200_000
    assert tables.leads_by_city("city3").count() == rows.where("PHY_CITY = 'CITY3'").count()


@pytest.fixture
def small_indexes(monkeypatch):
    from parcelight.sinks import tables as module

    monkeypatch.setattr(module, "INDEXED", 100)
    return module


def test_a_small_batch_reads_few_keys(spark, tables, small_indexes):
    rows = spark.range(20_000).withColumnRenamed("id", "OBJECTID")
    assert sinks.append_new_rows(rows, tables, "leads", "OBJECTID") == 20_000
    (part,) = tables.parts("leads")
    assert part.keys and part.tags == {"key": "OBJECTID"}
    for batch in (spark.createDataFrame([(7,), (30_000,)], "OBJECTID bigint"),
                  spark.createDataFrame([("7",), ("30000",), (None,), ("x",)], "OBJECTID string")):
        stored = small_indexes.stored_keys(batch, tables, "leads", tables.parts("leads"), "OBJECTID")
        read, files = _scanned(stored)
        assert files <= 2 and 1 <= read < 20_000 / 64 * 2 * 1.5
        assert {r.OBJECTID for r in stored.collect()} >= {7}
    plan = stored._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan
    batch = spark.createDataFrame([(7,), (30_000,), (30_000,), (None,)], "OBJECTID bigint")
    assert sinks.append_new_rows(batch, tables, "leads", "OBJECTID") == 1
    assert sinks.append_new_rows(batch, tables, "leads", "OBJECTID") == 0
    assert tables.read("leads").count() == 20_001


def test_keys_of_all_kinds_of_parts_are_known(spark, tables, small_indexes):
    """Parts with and without buckets, merged ones, and others of the table."""
    def batch(begin, end):
        return spark.range(begin, end).withColumnRenamed("id", "OBJECTID")

    sinks.overwrite_table(batch(0, 300), tables, "leads")  # no key is known of it
    for begin in range(200, 900, 100):
        sinks.append_new_rows(batch(begin, begin + 150), tables, "leads", "OBJECTID")
    sinks.append_new_rows(batch(940, 960), tables, "leads", "OBJECTID")
    assert sorted(r.OBJECTID for r in tables.read("leads").collect()) == list(range(960))
    parts = tables.parts("leads")
    assert any(p.keys for p in parts) and not all(p.keys for p in parts)
    assert any("level" in p.tags for p in parts)
    # keys in use are kept, those of merged parts go
    assert tables.commits.vacuum(older_than_hours=-1) > 0
    assert sinks.append_new_rows(batch(0, 960), tables, "leads", "OBJECTID") == 0
    assert sinks.append_new_rows(batch(0, 0), tables, "leads", "OBJECTID") == 0


def test_an_index_that_dies_leaves_the_rows(spark, tables, small_indexes, monkeypatch):
    def failing(*args):
        raise OSError("disk full")

    monkeypatch.setattr(small_indexes, "_write_keys", failing)
    with pytest.raises(OSError):
        sinks.append_new_rows(
            spark.range(200).withColumnRenamed("id", "OBJECTID"), tables, "leads", "OBJECTID")
    assert tables.is_empty("leads") and tables.read("leads").count() == 0


@pytest.mark.parametrize("names", [
    ["a-01 é%20-end.txt", "a-02 é%20-end.txt", "a-10 é%20-end.txt"],
    ["a.txt", "ab.txt", "b.txt"], ["a-01.txt", "a-02.txt"], ["one.txt"],
])
def test_place_in_file_order_is_short(spark, tmp_path, names):
    """What all file names share does not travel with every row."""
    plain = names[0].isascii()
    folder = tmp_path / ("folder" if plain else "a folder, é%41")
    folder.mkdir()
    for broken in (False, True):
        for i, name in enumerate(names):
            second = '"x\ny"' if broken else "x"
            (folder / name).write_text(f"Parcel\tA\n{i}-0\tx\n{i}-1\t{second}\n")
        df = sources.read_tsv(spark, str(folder)).repartition(5).orderBy("_ord")
        rows = df.select("Parcel", "_ord.file").collect()
        assert [r.Parcel for r in rows] == [f"{i}-{k}" for i in range(len(names)) for k in range(2)]
        assert len({r.file for r in rows}) == len(names)
        # Paths that are written in two ways are kept whole.
        assert not plain or max(len(r.file) for r in rows) <= max(map(len, names))


def test_a_scanned_table_alone_is_written(spark, tmp_path, monkeypatch):
    """Scanning one file does not write the other five."""
    from workload import views

    written = []
    monkeypatch.setattr(views, "write_tsv", lambda rows, path: written.append(path))
    given = spark.createDataFrame([("k",)], "Parcel string")
    monkeypatch.setattr(views, "SOURCES", {t: lambda *_: given for t in views.SOURCES})
    path = views.source_file(spark, str(tmp_path), "owners")
    assert written == [path] and path == views.source_file(spark, str(tmp_path), "owners")
    folder = views.source_folder(spark, str(tmp_path))
    assert len(written) == len(set(written)) == 6 and path.startswith(f"{folder}/")
