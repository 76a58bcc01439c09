import threading

import pytest
from pyspark.sql import functions as F

from parcelight.constants import MODEL_COLUMNS
from parcelight.plans import diagnostics, scoring


@pytest.fixture(scope="module")
def features(spark):
    """Label depends on two of the inputs."""
    df = spark.range(1, 801).withColumnRenamed("id", "OBJECTID")
    for i, c in enumerate(MODEL_COLUMNS):
        noise = F.pmod(F.xxhash64("OBJECTID", F.lit(i)), F.lit(1000)).cast("double")
        df = df.withColumn(c, noise)
    label = ((F.col("JV") < 500) & (F.col("SALE_PRC1") < 800)).cast("int")
    return df.withColumn("hot_lead", label).withColumn(
        "TOT_LVG_AR", F.when(F.col("OBJECTID") % 10 != 0, F.col("TOT_LVG_AR")))


def test_split_is_stable_and_stratified(features):
    one = {r.OBJECTID: r.is_test for r in scoring.with_split(features.coalesce(1)).collect()}
    many = {r.OBJECTID: r.is_test for r in scoring.with_split(features.repartition(9)).collect()}
    assert one == many
    parts = scoring.with_split(features).groupBy("hot_lead").agg(
        F.count_if("is_test").alias("test"), F.count(F.lit(1)).alias("n")).collect()
    assert all(abs(r.test - 0.2 * r.n) <= 1 for r in parts)


def test_folds_share_out_a_rare_class(spark):
    rows = spark.createDataFrame([(i, int(i < 5)) for i in range(200)], "OBJECTID int, hot_lead int")
    folds = scoring.with_fold(rows.repartition(7)).groupBy("fold", "hot_lead").count().collect()
    assert {(r.fold, r.hot_lead): r["count"] for r in folds} == {
        (f, c): 39 if c == 0 else 1 for f in range(1, 6) for c in (0, 1)}


def test_a_score_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    scored = spark.range(1000).select(
        F.col("id").alias("OBJECTID"), (F.col("id") / 1000).alias("hot_lead_score"))
    ranked = scoring.rank_leads(scored.mapInArrow(count, scored.schema))
    assert ranked.count() == 1000 and seen.value == 1000


def test_scaling_uses_training_rows_only(features):
    rows = scoring.with_split(scoring.model_input(features)).withColumn("NO_BULDNG", F.lit(3.0))
    scaled = scoring.scale_columns(rows, MODEL_COLUMNS, ~F.col("is_test"))
    stats = scaled.where("NOT is_test").agg(
        F.avg("JV").alias("m"), F.stddev_pop("JV").alias("s"),
        F.max(F.abs("NO_BULDNG")).alias("constant")).first()
    assert stats["m"] == pytest.approx(0, abs=1e-9) and stats["s"] == pytest.approx(1)
    assert stats["constant"] == 0.0


def test_metrics(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "hot_lead int, prediction int")
    m = scoring.confusion_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (3, 1, 2, 4)
    assert (m.precision, m.recall) == (0.75, 0.6) and m.f1 == pytest.approx(2 / 3)
    nothing = scoring.confusion_metrics(df.where("hot_lead = 0 AND prediction = 0")).first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (0.0, 0.0, 0.0)


def test_train_gate_reload_and_rank(spark, features, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        scoring.load_model(path)
    rejected = scoring.train(features, path, gate=1.01, cv_folds=0, trees=2)
    assert not rejected.saved
    with pytest.raises(FileNotFoundError):
        scoring.load_model(path)

    trained = scoring.train(features, path, cv_folds=0, trees=10)
    assert trained.saved and trained.f1 >= 0.65
    shares = [(r.feature, r.importance) for r in trained.importance.collect()]
    assert {f for f, _ in shares[:2]} == {"JV", "SALE_PRC1"}
    assert sum(s for _, s in shares) == pytest.approx(1)

    fresh = scoring.score(features, trained.model)
    again = scoring.score(features, scoring.load_model(path))
    pick = ["OBJECTID", "hot_lead_score"]
    assert sorted(fresh.select(pick).collect()) == sorted(again.select(pick).collect())

    ranked = scoring.rank_leads(again).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 801))
    by_rank = sorted(ranked, key=lambda r: r["rank"])
    assert [(r.hot_lead_score, r.OBJECTID) for r in by_rank] == sorted(
        ((r.hot_lead_score, r.OBJECTID) for r in ranked), key=lambda t: (-t[0], t[1]))
    assert ranked[0].asDict().keys() == {"OBJECTID", "JV", "SALE_PRC1", "SALE_YR1",
                                         "hot_lead_score", "rank"}
    summary = scoring.score_summary(again).first()
    assert summary["scored"] == 800 and 0 < summary["mean_score"] < 1


def test_cross_validation_covers_every_row_once(features):
    folds = scoring.cross_validate(scoring.model_input(features), folds=3, trees=3)
    rows = folds.collect()
    assert [r.fold for r in rows] == [1, 2, 3]
    assert sum(r.tp + r.fp + r.fn + r.tn for r in rows) == 800
    summary = scoring.cv_summary(folds).first()
    assert min(r.f1 for r in rows) <= summary["mean_f1"] <= max(r.f1 for r in rows)


def test_missing_inputs_are_named(features):
    with pytest.raises(ValueError, match="LND_VAL"):
        scoring.model_input(features.drop("LND_VAL"))
    with pytest.raises(ValueError, match="no rows"):
        scoring.train(features.limit(0))


def test_diagnostics(spark):
    rows = [(1, 1, 1), (1, 0, 0), (1, 1, 0), (2, 1, 0), (2, 0, 1), (2, 0, 1), (2, 1, 0)]
    df = spark.createDataFrame(
        [(*r, 100.0 * i, 1990, 2000.0, "A" if i % 3 else "B") for i, r in enumerate(rows)],
        "fold int, hot_lead int, prediction int, JV double, ACT_YR_BLT int, SALE_YR1 double, "
        "PHY_CITY string")
    worst = diagnostics.worst_fold(df).first()
    assert (worst.fold, worst.f1, worst.collapsed) == (2, 0.0, True)
    assert (worst.missed, worst.false_alarms) == (2, 2)
    errors = {r.outcome: r.n for r in diagnostics.error_profile(df).collect()}
    assert errors == {"missed": 3, "false alarm": 2}
    rates = {r.fold: (r.hot_pct, r.top_city) for r in diagnostics.fold_label_rate(df).collect()}
    assert rates == {1: (66.6667, "A"), 2: (50.0, "A")}


def test_model_and_folds_are_fitted_side_by_side(spark, monkeypatch):
    names = ["JV", "LND_VAL"]
    rows = spark.range(200).select(
        F.col("id").alias("OBJECTID"), F.col("id").cast("double").alias("JV"),
        (F.col("id") % 7).cast("double").alias("LND_VAL"),
        (F.col("id") % 3 == 0).cast("int").alias("hot_lead"),
    )
    together, plain = threading.Barrier(4), scoring.fit

    def fit(*given, **params):
        together.wait(60)  # fails unless the four fits are under way at once
        return plain(*given, **params)

    monkeypatch.setattr(scoring, "fit", fit)
    trained = scoring.train(rows, columns=names, cv_folds=3, trees=2)
    assert trained.held_out.count() == 200 and trained.folds.count() == 3
