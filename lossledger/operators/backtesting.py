"""Backtesting of PD grades, calibration by bin, monotonicity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.credit import (
    PD_GRADES,
    binomial_p_value,
    p_value_light,
    pd_grade,
    rating_order,
    wilson_bounds,
)
from lossledger.functions.numeric import numeric_column, total
from lossledger.operators.ordering import after_ranks, count_below, last_ranks, quantiles


def scored_rows(predictions: DataFrame, pd_column: str, target: str) -> DataFrame:
    """Rows with a numeric score and target."""
    return predictions.withColumns(
        {pd_column: numeric_column(predictions, pd_column), target: numeric_column(predictions, target)}
    ).dropna(subset=[pd_column, target])


def _pd_measures(pd_column: str, target: str, defaults_name: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("facilities"),
        F.sum(target).cast("bigint").alias(defaults_name),
        F.avg(target).alias("observed_default_rate"),
        F.avg(pd_column).alias("avg_predicted_pd"),
        F.min(pd_column).alias("min_predicted_pd"),
        F.max(pd_column).alias("max_predicted_pd"),
    ]


def _calibration_error() -> Column:
    return F.col("avg_predicted_pd") - F.col("observed_default_rate")


def pd_backtest_by_grade(predictions: DataFrame, pd_column: str, target: str = "target_default_12m") -> DataFrame:
    """Observed against predicted default rates per PD grade, with Wilson bounds."""
    lower, upper = wilson_bounds(F.col("defaults"), F.col("facilities"))
    return (
        scored_rows(predictions, pd_column, target)
        .groupBy(pd_grade(F.col(pd_column)).alias("rating_grade"))
        .agg(*_pd_measures(pd_column, target, "defaults"))
        .withColumns(
            {
                "calibration_error": _calibration_error(),
                "observed_default_rate_lower_ci": lower,
                "observed_default_rate_upper_ci": upper,
            }
        )
        .orderBy(rating_order(F.col("rating_grade")))
    )


def rating_grade_summary(predictions: DataFrame, pd_column: str, target: str = "target_default_12m") -> DataFrame:
    """All six grades with their counts and rates; a grade nobody has gets zero counts and no rates."""
    observed = predictions.groupBy(pd_grade(F.col(pd_column)).alias("rating_grade")).agg(
        *_pd_measures(pd_column, target, "observed_defaults")
    )
    grades = predictions.sparkSession.createDataFrame([(g,) for g in PD_GRADES], "rating_grade string")
    return (
        F.broadcast(grades).join(observed, "rating_grade", "left")
        .withColumns(
            {
                "facilities": F.coalesce("facilities", F.lit(0)),
                "observed_defaults": F.coalesce("observed_defaults", F.lit(0)),
            }
        )
        .orderBy("rating_grade")
    )


def binomial_backtest(report: DataFrame) -> DataFrame:
    """Expected against observed defaults per grade with a p-value and a status."""
    p_value = binomial_p_value(F.col("defaults"), F.col("facilities"), F.col("avg_predicted_pd"))
    return (
        report.withColumn("expected_defaults", F.col("facilities") * F.col("avg_predicted_pd"))
        .withColumn("binomial_p_value", p_value)
        .select(
            "rating_grade",
            "facilities",
            F.col("defaults").alias("observed_defaults"),
            "expected_defaults",
            "avg_predicted_pd",
            "observed_default_rate",
            "binomial_p_value",
            p_value_light(F.col("binomial_p_value")).alias("traffic_light"),
        )
    )


def _adjacent_grades(report: DataFrame, grade: str, rate: str, min_facilities: int) -> DataFrame:
    # A grade report has at most seven rows.
    in_order = Window.partitionBy().orderBy(rating_order(F.col(grade)))
    return report.filter(F.col("facilities") >= min_facilities).select(
        F.lag(grade).over(in_order).alias("previous_grade"),
        F.col(grade).alias("current_grade"),
        F.lag(rate).over(in_order).alias("previous_default_rate"),
        F.col(rate).alias("current_default_rate"),
    )


def monotonicity_violations(
    report: DataFrame, grade: str = "rating_grade", rate: str = "observed_default_rate", min_facilities: int = 1
) -> DataFrame:
    """Adjacent grades where the worse grade has the lower observed rate."""
    return (
        _adjacent_grades(report, grade, rate, min_facilities)
        .filter(F.col("current_default_rate") < F.col("previous_default_rate"))
        .withColumn("violation", F.lit(1))
    )


def monotonicity_summary(
    report: DataFrame, grade: str = "rating_grade", rate: str = "observed_default_rate", min_facilities: int = 1
) -> DataFrame:
    """Monotonic within 1e-12; violations are counted without tolerance, so the two can differ."""
    step = F.col("current_default_rate") - F.col("previous_default_rate")
    return _adjacent_grades(report, grade, rate, min_facilities).agg(
        F.lit("rating_monotonicity").alias("check_name"),
        F.count(F.lit(1)).alias("ratings_checked"),
        F.coalesce(F.min(step >= -1e-12), F.lit(True)).alias("is_monotonic"),
        F.count(F.when(step < 0, 1)).alias("violations_count"),
    )


def with_rank_bins(df: DataFrame, score: str, bin_name: str, n_bins: int, tie: str = "facility_id") -> DataFrame:
    """Equal-count bins of a score, ties broken by key; one bin when the score is constant.

    Rows are neither ordered nor moved: the bins' last rows are selected, and a row's bin is a comparison with them. Rows
    without a score are in the first bin.
    """
    facts = df.agg(F.min(score).alias("low"), F.max(score).alias("high"), F.count(score).alias("rows")).first()
    if facts["low"] == facts["high"]:
        return df.withColumn(bin_name, F.lit(1).cast("bigint"))
    earlier = after_ranks(df, score, tie, last_ranks(facts["rows"], n_bins))
    return df.withColumn(bin_name, F.coalesce(earlier, F.lit(0)) + 1)


def pd_calibration_by_bin(
    predictions: DataFrame, pd_column: str, target: str = "target_default_12m",
    n_bins: int = 10, tie: str = "facility_id",
) -> DataFrame:
    rows = scored_rows(predictions, pd_column, target).select(tie, pd_column, target)
    return (
        with_rank_bins(rows, pd_column, "pd_decile", n_bins, tie)
        .groupBy("pd_decile")
        .agg(*_pd_measures(pd_column, target, "defaults"))
        .withColumn("calibration_error", _calibration_error())
        .orderBy("pd_decile")
    )


def severity_calibration_by_bin(
    df: DataFrame, actual: str, predicted: str, measure: str, n_bins: int = 5,
    weight: str = "ead_at_default", tie: str = "facility_id",
) -> DataFrame:
    """Actual against predicted LGD or CCF (`measure`) by bin of the prediction."""
    rows = df.select(tie, actual, predicted, weight)
    return (
        with_rank_bins(rows, predicted, f"{measure}_decile", n_bins, tie)
        .groupBy(f"{measure}_decile")
        .agg(*severity_measures(actual, predicted, measure), total(F.col(weight)).alias("total_ead"))
        .withColumn("prediction_error", F.col(f"avg_predicted_{measure}") - F.col(f"avg_actual_{measure}"))
        .orderBy(f"{measure}_decile")
    )


def severity_measures(actual: str, predicted: str, measure: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("facilities"),
        F.avg(actual).alias(f"avg_actual_{measure}"),
        F.avg(predicted).alias(f"avg_predicted_{measure}"),
    ]


def segment_report(
    df: DataFrame, actual: str, predicted: str, measure: str, segments: Sequence[str], weight: str = "ead_at_default"
) -> DataFrame:
    """Actual against predicted by each segment column present, stacked, in one scan.

    Facilities without a segment value form a group of their own.
    """
    present = [s for s in segments if s in df.columns]
    long = df.select(actual, predicted, weight, *[F.col(s).cast("string").alias(s) for s in present]).unpivot(
        [actual, predicted, weight], present, "segment_type", "segment"
    )
    return (
        long.groupBy("segment_type", "segment")
        .agg(
            *severity_measures(actual, predicted, measure),
            F.avg(weight).alias("avg_ead"),
            total(F.col(weight)).alias("total_ead"),
        )
        .withColumn("prediction_error", F.col(f"avg_predicted_{measure}") - F.col(f"avg_actual_{measure}"))
        .orderBy("segment_type", F.desc("facilities"), F.asc_nulls_last("segment"))
    )


def product_report(df: DataFrame, actual: str, predicted: str, measure: str, weight: str = "ead_at_default") -> DataFrame:
    return (
        df.groupBy("product_type")
        .agg(
            *severity_measures(actual, predicted, measure),
            F.avg(weight).alias("avg_ead"),
            total(F.col(weight)).alias("total_ead"),
        )
        .withColumn("prediction_error", F.col(f"avg_predicted_{measure}") - F.col(f"avg_actual_{measure}"))
        .orderBy(F.desc("facilities"), "product_type")
    )


def calibration_by_score_bin(scores: DataFrame, target: str = "target_default_12m", n_bins: int = 10) -> DataFrame:
    """Calibration per model over bins cut at the score's own quantiles.

    `scores` is long: model, predicted_pd and the target. Equal cut points collapse, so heavy
    ties leave fewer bins. Cut points are at most `n_bins` + 1 numbers per model.
    """
    rows = scores.filter(F.col("predicted_pd").isNotNull())

    def cut_fractions(distinct: Column) -> list[Column]:
        bins = F.least(distinct, F.lit(n_bins))
        return [F.when(bins >= i, F.lit(i) / bins) for i in range(n_bins + 1)]

    edges = (
        quantiles(rows.select("model", "predicted_pd"), ["model"], "predicted_pd", cut_fractions)
        .groupBy("model")
        .agg(F.collect_set("quantile").alias("_edges"))
    )
    below = count_below(F.col("predicted_pd"), "_edges", n_bins + 1)
    return (
        rows.join(edges, "model")
        .groupBy("model", F.greatest(F.lit(1), below).cast("bigint").alias("pd_decile"))
        .agg(*_pd_measures("predicted_pd", target, "observed_defaults"))
        .withColumn("calibration_error", _calibration_error())
        .orderBy("model", "pd_decile")
    )


def mean_observed_by_bin(report: DataFrame) -> DataFrame:
    """Observed rate per bin, averaged over the models of a calibration report."""
    return report.groupBy("pd_decile").agg(F.avg("observed_default_rate").alias("observed_default_rate")).orderBy("pd_decile")


def actual_vs_predicted(report: DataFrame, key: str, actual: str, predicted: str) -> DataFrame:
    """Long form of two report columns: key, series, value."""
    return report.unpivot([key], [actual, predicted], "series", "value")


def confidence_bands(report: DataFrame) -> DataFrame:
    """Grades in order (unknown last) with the distances from the observed rate to its bounds."""
    observed = F.col("observed_default_rate")
    return report.select(
        "rating_grade",
        F.coalesce(rating_order(F.col("rating_grade")), F.lit(99)).alias("grade_order"),
        "avg_predicted_pd",
        "observed_default_rate",
        F.greatest(observed - F.col("observed_default_rate_lower_ci"), F.lit(0.0)).alias("lower_error"),
        F.greatest(F.col("observed_default_rate_upper_ci") - observed, F.lit(0.0)).alias("upper_error"),
    ).orderBy("grade_order")
