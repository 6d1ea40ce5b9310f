"""Discrimination, calibration and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import number
from lossledger.operators.ordering import ordered_ranges, running_totals

RANK_METRICS = ["roc_auc", "gini", "ks", "average_precision"]


def binary_metrics(df: DataFrame, score: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact metrics of a score against a 0/1 target, per group of `by`.

    Positives and negatives are counted per distinct score first; ROC-AUC (ties one half), KS and
    average precision then follow in closed form from the running counts in descending score
    order. The rank metrics are NULL when a group has one class only.
    """
    keys = list(by) or ["_all"]
    data = df if by else df.withColumn("_all", F.lit(1))
    counted = (
        data.filter(F.col(score).isNotNull() & F.col(target).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("_score"))
        .agg(F.sum(F.col(target).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    order = [F.desc("_score")]
    ranked = running_totals(ordered_ranges(counted, keys, order), keys, order, ["pos", "neg"])

    s, pos, neg, n = (F.col(c) for c in ("_score", "pos", "neg", "n"))
    positives = F.nullif(F.col("all_pos"), F.lit(0))
    negatives = F.nullif(F.col("all_neg"), F.lit(0))
    hit_rate = F.col("cum_pos") / positives
    alarm_rate = F.col("cum_neg") / negatives
    area = neg * (F.col("cum_pos") - pos / 2) / positives / negatives
    precision_step = F.when(negatives.isNotNull(), pos / positives * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))))
    metrics = ranked.groupBy(*keys).agg(
        F.sum(n).alias("rows"),
        F.sum(area).alias("roc_auc"),
        F.greatest(F.max(hit_rate - alarm_rate), F.lit(0.0)).alias("_ks"),
        F.sum(precision_step).alias("average_precision"),
        (F.sum(pos * (1 - s) * (1 - s) + neg * s * s) / F.sum(n)).alias("brier_score"),
        (F.sum(s * n) / F.sum(n)).alias("mean_predicted_pd"),
        (F.sum(pos) / F.sum(n)).alias("observed_default_rate"),
    )
    return metrics.select(
        *by,
        "rows",
        "roc_auc",
        (2 * F.col("roc_auc") - 1).alias("gini"),
        F.when(F.col("roc_auc").isNotNull(), F.col("_ks")).alias("ks"),
        "average_precision",
        "brier_score",
        "mean_predicted_pd",
        "observed_default_rate",
    )


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Plain and weighted errors per group of `by`. Missing weights count 1, and no weight is below 1."""
    error = F.col(predicted) - F.col(actual)
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(actual).alias("mean_actual"),
        F.avg(predicted).alias("mean_predicted"),
    ]
    if weight is not None:
        w = exposure_weight(weight)
        measures += [
            (F.sum(w * F.abs(error)) / F.sum(w)).alias("weighted_mae"),
            F.sqrt(F.sum(w * error * error) / F.sum(w)).alias("weighted_rmse"),
        ]
    return df.groupBy(*by).agg(*measures)


def exposure_weight(name: str):
    return F.greatest(F.coalesce(number(F.col(name)), F.lit(1.0)), F.lit(1.0))


def best_model(metrics: DataFrame, measure: str, higher_is_better: bool, split: str = "oot") -> DataFrame:
    """The best row of a split; the first model name wins ties. Metrics reports have a few rows."""
    order = F.desc_nulls_last(measure) if higher_is_better else F.asc_nulls_last(measure)
    return metrics.filter(F.col("split") == split).orderBy(order, "model").limit(1)
