"""Training, evaluation and scoring with pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from parcelight.constants import (
    DISPLAY_COLUMNS,
    F1_GATE,
    FOLDS,
    LABEL_COLUMN,
    LEARNING_RATE,
    MODEL_COLUMNS,
    SEED,
    TEST_SHARE,
    TREE_DEPTH,
    TREES,
)
from parcelight.functions import spread_hash
from parcelight.operators import number_rows, require_columns
from parcelight.storage import materialize, working_dir


# Rows of model input to a task; a row is about a hundred bytes in memory.
ROWS_PER_TASK = 200_000


# -- input --------------------------------------------------------------------


def model_input(
    features: DataFrame, columns: Sequence[str] = MODEL_COLUMNS
) -> DataFrame:
    """Row id, label and model columns as doubles, missing values as 0."""
    require_columns(features, ["OBJECTID", *columns, LABEL_COLUMN], "model input")
    return features.select(
        "OBJECTID",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns],
        F.col(LABEL_COLUMN).cast("int").alias(LABEL_COLUMN),
    )


def class_balance(features: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    hot = F.count_if(F.col(label) == 1)
    return features.agg(
        F.count(F.lit(1)).alias("records"),
        hot.alias("hot"),
        F.count_if(F.col(label) == 0).alias("cold"),
        F.round(F.try_divide(hot * F.lit(100.0), F.count(F.lit(1))), 4).alias("hot_pct"),
    )


def with_split(
    df: DataFrame, share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``: of each class the first ``share`` of its rows, rounded,
    in the order of the row hash."""
    quota = F.floor(F.col("_size") * F.lit(share) + F.lit(0.5))
    return _placed(df, seed).withColumn("is_test", F.col("_place") < quota).drop(
        "_place", "_size"
    )


def with_fold(df: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``fold`` 1..folds: each class is cut into runs, in the order of the
    row hash, whose sizes differ by one row at most."""
    fold = F.floor(F.col("_place") * F.lit(folds) / F.col("_size")) + 1
    return _placed(df, seed).withColumn("fold", fold.cast("int")).drop("_place", "_size")


def _placed(df: DataFrame, seed: int, label: str = LABEL_COLUMN) -> DataFrame:
    """Adds the place of a row within its class, in the order of the row hash,
    and the size of the class. The hash depends on id and seed alone, so the
    result is the same for any partitioning; one range shuffle orders the rows."""
    hashed = df.withColumn("_hash", spread_hash("OBJECTID", seed))
    numbered = number_rows(
        hashed, [F.col(label), F.col("_hash"), F.col("OBJECTID")], "_nth", start=0
    ).drop("_hash")
    classes = numbered.groupBy(F.col(label).alias("_class")).agg(
        F.min("_nth").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    same = numbered[label].eqNullSafe(F.col("_class"))
    return (
        numbered.join(F.broadcast(classes), same)  # one row per class
        .withColumn("_place", F.col("_nth") - F.col("_first"))
        .drop("_nth", "_first", "_class")
    )


def scale_columns(
    df: DataFrame, columns: Sequence[str], fitted_on: Column
) -> DataFrame:
    """Columns centred and scaled by mean and population deviation of the rows
    meeting ``fitted_on``; a constant column is only centred."""
    stats = df.where(fitted_on).agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        ).alias("stats")
    )
    with_stats = df.withColumn("_stats", stats.scalar())

    def scaled(c: str) -> Column:
        deviation = F.col(f"_stats.s_{c}")
        divisor = F.when(deviation == 0, 1.0).otherwise(deviation)
        return (F.col(c) - F.col(f"_stats.m_{c}")) / divisor

    return with_stats.withColumns({c: scaled(c) for c in columns}).drop("_stats")


# -- model ----------------------------------------------------------------------


def classifier(
    columns: Sequence[str] = MODEL_COLUMNS,
    trees: int = TREES,
    rate: float = LEARNING_RATE,
    depth: int = TREE_DEPTH,
    seed: int = SEED,
) -> Pipeline:
    """Assemble, scale, boost. Scaler and trees are one object, so they cannot
    be stored or loaded apart."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="_raw"),
            StandardScaler(
                inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True
            ),
            GBTClassifier(
                featuresCol="_scaled", labelCol=LABEL_COLUMN, maxIter=trees,
                stepSize=rate, maxDepth=depth, seed=seed, checkpointInterval=10,
                maxMemoryInMB=1024,  # a level of the tree in one pass
            ),
        ]
    )


def _ensure_checkpoints(rows: DataFrame) -> None:
    """Boosting cuts its lineage every few trees once a folder is set."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{working_dir(rows.sparkSession)}/boosting")


def fit(rows: DataFrame, **params) -> PipelineModel:
    """Every tree is a few jobs over all rows, so small inputs get few tasks.
    The rows should be stored: they are read and cached by the fit."""
    _ensure_checkpoints(rows)
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK))
    return classifier(**params).fit(rows.coalesce(tasks))


def _side_by_side(spark, steps: Sequence[Callable], parallelism: int | None = None) -> list:
    """Results of ``steps``, run ``parallelism`` at a time (default: all)."""
    with ThreadPoolExecutor(parallelism or len(steps)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [run.result() for run in runs]


def confusion_metrics(
    predicted: DataFrame, by: Sequence[str] = (), label: str = LABEL_COLUMN
) -> DataFrame:
    """Confusion counts, precision, recall and F1 of the positive class;
    an undefined ratio is 0."""
    actual, guess = F.col(label) == 1, F.col("prediction") == 1
    counts = predicted.groupBy(*by).agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(~actual & ~guess).alias("tn"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def held_out_predictions(
    rows: DataFrame, folds: int = FOLDS, parallelism: int | None = None, **params
) -> DataFrame:
    """OBJECTID, fold, label and prediction of every row, by a model fitted on
    the other folds; stored. The scaler is fitted inside each fold. Folds are
    fitted side by side, ``parallelism`` at a time (default: all); each of them
    caches its own copy of its training rows, so give a lower number where
    that many copies do not fit."""
    rows = materialize(with_fold(rows, folds), "folds")
    _ensure_checkpoints(rows)
    steps = _fold_steps(rows, folds, params)
    return _held_out(_side_by_side(rows.sparkSession, steps, parallelism))


def _fold_steps(rows: DataFrame, folds: int, params: dict) -> list[Callable[[], DataFrame]]:
    """A step per fold of ``rows``: its predictions by a model fitted on the others."""

    def held_out(k: int) -> DataFrame:
        model = fit(rows.where(F.col("fold") != k), **params)
        return model.transform(rows.where(F.col("fold") == k)).select(
            "OBJECTID", "fold", LABEL_COLUMN, "prediction"
        )

    return [partial(held_out, k) for k in range(1, folds + 1)]


def _held_out(parts: Sequence[DataFrame]) -> DataFrame:
    return materialize(reduce(DataFrame.unionByName, parts), "held-out")


def cross_validate(
    rows: DataFrame, folds: int = FOLDS, parallelism: int | None = None, **params
) -> DataFrame:
    """Metrics of each fold of :func:`held_out_predictions`."""
    predicted = held_out_predictions(rows, folds, parallelism, **params)
    return confusion_metrics(predicted, ["fold"]).orderBy("fold")


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    return fold_metrics.agg(
        F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1")
    )


def feature_importance(
    model: PipelineModel, columns: Sequence[str], spark
) -> DataFrame:
    """Contribution of each input, highest first; the shares add up to 1."""
    shares = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(s)) for c, s in zip(columns, shares)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


@dataclass
class Training:
    model: PipelineModel
    f1: float
    precision: float
    recall: float
    saved: bool
    importance: DataFrame
    folds: DataFrame | None = None
    held_out: DataFrame | None = None
    path: str | None = None


def train(
    features: DataFrame,
    model_path: str | None = None,
    gate: float = F1_GATE,
    columns: Sequence[str] = MODEL_COLUMNS,
    cv_folds: int = FOLDS,
    parallelism: int | None = None,
    **params,
) -> Training:
    """Fits on the training rows, judges on the held-out rows, and stores the
    model only if its F1 reaches ``gate``. The model and those of the folds are
    fitted side by side (:func:`held_out_predictions`), ``parallelism`` at a time:
    a fit alone leaves executors idle between the levels of its trees."""
    given = model_input(features, columns)
    if given.isEmpty():
        raise ValueError("no rows to train on")
    rows = materialize(with_split(given), "model-input")
    params = {"columns": columns, **params}
    steps = [lambda: fit(rows.where(~F.col("is_test")), **params)]
    if cv_folds:
        steps += _fold_steps(materialize(with_fold(rows, cv_folds), "folds"), cv_folds, params)
    _ensure_checkpoints(rows)
    model, *parts = _side_by_side(rows.sparkSession, steps, parallelism)
    held_out = _held_out(parts) if parts else None
    folds = (
        confusion_metrics(held_out, ["fold"]).orderBy("fold") if cv_folds else None
    )
    tested = model.transform(rows.where("is_test"))
    result = confusion_metrics(tested).first()
    saved = model_path is not None and result["f1"] >= gate
    if saved:
        model.write().overwrite().save(model_path)
    return Training(
        model, result["f1"], result["precision"], result["recall"], saved,
        feature_importance(model, columns, features.sparkSession), folds, held_out,
        model_path if saved else None,
    )


def load_model(path: str) -> PipelineModel:
    """The stored model; an error when training has not stored one."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise FileNotFoundError(f"no trained model at {path}") from error


def score(
    features: DataFrame, model: PipelineModel, columns: Sequence[str] = MODEL_COLUMNS
) -> DataFrame:
    """Adds ``hot_lead_score``, the probability of the positive class."""
    require_columns(features, columns, "scoring input")
    kept = list(features.columns)
    filled = features.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    )
    return model.transform(filled).select(
        *kept, vector_to_array("probability")[1].alias("hot_lead_score")
    )


# -- ranking --------------------------------------------------------------------


def rank_leads(scored: DataFrame) -> DataFrame:
    """Sequential rank, hottest first; equal scores in OBJECTID order. Scores
    are stored before they are sorted, as a sort reads its input twice."""
    shown = [c for c in DISPLAY_COLUMNS if c in scored.columns]
    return number_rows(
        materialize(scored.select(*shown, "hot_lead_score"), "scores"),
        [F.desc("hot_lead_score"), F.asc("OBJECTID")],
        "rank",
    )


def top_leads(scored: DataFrame, k: int) -> DataFrame:
    return scored.orderBy(F.desc("hot_lead_score"), "OBJECTID").limit(k)


def score_summary(scored: DataFrame) -> DataFrame:
    value = F.col("hot_lead_score")
    return scored.agg(
        F.count(F.lit(1)).alias("scored"),
        F.round(F.avg(value), 6).alias("mean_score"),
        F.count_if(value > 0.5).alias("above_half"),
        F.count_if(value > 0.8).alias("above_hot"),
    )
