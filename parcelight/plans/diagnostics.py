"""How the model does on each cross-validation fold, and where it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.constants import F1_GATE, LABEL_COLUMN
from parcelight.plans.scoring import confusion_metrics


def fold_profile(rows: DataFrame) -> DataFrame:
    """Size, label rate, value range and sale years of each fold."""
    hot = F.count_if(F.col(LABEL_COLUMN) == 1)
    size = F.count(F.lit(1))
    return rows.groupBy("fold").agg(
        size.alias("size"),
        hot.alias("hot"),
        (size - hot).alias("cold"),
        F.round(F.try_divide(hot * F.lit(100.0), size), 4).alias("hot_pct"),
        F.min("JV").alias("jv_min"),
        F.max("JV").alias("jv_max"),
        F.round(F.avg("JV"), 4).alias("jv_mean"),
        F.min("SALE_YR1").alias("sale_year_min"),
        F.max("SALE_YR1").alias("sale_year_max"),
    )


def top_values(
    rows: DataFrame, group: str, column: str, n: int | None
) -> DataFrame:
    """Most frequent values of ``column`` within each group.

    Only counts reach the window, and Spark cuts each partition to its first
    ``n`` before the shuffle.
    """
    counts = (
        rows.where(F.col(column).isNotNull())
        .groupBy(group, F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(group).orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("place", F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col("place") <= n)


def several_top_values(
    rows: DataFrame, group: str, columns: dict[str, int | None]
) -> DataFrame:
    """Most frequent values of several columns within each group, from one scan
    and one count: (group, column, value, n, place). None keeps all values."""
    names = list(columns)
    texts = rows.select(group, *[F.col(c).cast("string") for c in names])
    counts = (
        texts.unpivot(group, names, "column", "value").where(F.col("value").isNotNull())
        .groupBy(group, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(group, "column").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("place", F.row_number().over(order))
    kept = F.lit(False)
    for column, n in columns.items():
        here = F.col("column") == column
        kept = kept | (here if n is None else here & (F.col("place") <= n))
    return ranked.where(kept)


def fold_top_values(
    rows: DataFrame, columns: dict[str, int | None]
) -> DataFrame:
    return several_top_values(rows, "fold", columns)


def fold_metrics(predicted: DataFrame) -> DataFrame:
    """F1 of each fold and whether the fold collapsed."""
    return confusion_metrics(predicted, ["fold"]).withColumn(
        "collapsed", F.col("f1") < F1_GATE
    )


def worst_fold(predicted: DataFrame) -> DataFrame:
    """The fold with the lowest F1 (the first of equals)."""
    order = F.struct("f1", "fold")
    best = F.min_by(F.struct("fold", "f1", "collapsed", "fn", "fp"), order)
    return fold_metrics(predicted).agg(best.alias("w")).select(
        F.col("w.fold").alias("fold"),
        F.round("w.f1", 6).alias("f1"),
        F.col("w.collapsed").alias("collapsed"),
        F.col("w.fn").alias("missed"),
        F.col("w.fp").alias("false_alarms"),
    )


def with_predictions(features: DataFrame, predicted: DataFrame) -> DataFrame:
    """Features with the fold and the prediction that cross-validation
    (``scoring.held_out_predictions``) made for the row. Ids are unique on both
    sides."""
    return features.join(predicted.select("OBJECTID", "fold", "prediction"), "OBJECTID")


def of_worst_fold(predicted: DataFrame) -> DataFrame:
    """The rows of the fold with the lowest F1."""
    return predicted.where(F.col("fold") == worst_fold(predicted).select("fold").scalar())


def outcome() -> Column:
    actual, guess = F.col(LABEL_COLUMN) == 1, F.col("prediction") == 1
    return (
        F.when(actual & ~guess, "missed")
        .when(~actual & guess, "false alarm")
        .when(actual & guess, "hit")
        .otherwise("correct reject")
    )


def error_profile(predicted: DataFrame) -> DataFrame:
    """What missed leads and false alarms look like; see :func:`of_worst_fold`
    for the rows to ask about."""
    wrong = predicted.withColumn("outcome", outcome()).where(
        F.col("outcome").isin("missed", "false alarm")
    )
    return wrong.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("JV"), 4).alias("jv_mean"),
        F.min("JV").alias("jv_min"),
        F.max("JV").alias("jv_max"),
        F.round(F.avg("ACT_YR_BLT"), 4).alias("year_built_mean"),
        F.round(F.avg("SALE_YR1"), 4).alias("sale_year_mean"),
    )


def error_top_values(
    predicted: DataFrame, columns: dict[str, int | None]
) -> DataFrame:
    """Most frequent values of several columns among missed leads and false
    alarms: (outcome, column, value, n, place)."""
    wrong = predicted.withColumn("outcome", outcome()).where(
        F.col("outcome").isin("missed", "false alarm")
    )
    return several_top_values(wrong, "outcome", columns)


def fold_label_rate(rows: DataFrame) -> DataFrame:
    """Label rate, mean value and most frequent city of each fold."""
    rates = rows.groupBy("fold").agg(
        F.round(F.avg(F.col(LABEL_COLUMN).cast("double")) * 100, 4).alias("hot_pct"),
        F.round(F.avg("JV"), 4).alias("jv_mean"),
    )
    city = top_values(rows, "fold", "PHY_CITY", 1).select(
        "fold", F.col("value").alias("top_city")
    )
    return rates.join(city, "fold", "left")
