"""Alternative rating scale that merges a sparse worst grade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.credit import PD_GRADES

REQUIRED = {"rating_grade", "facilities", "observed_defaults", "observed_default_rate", "avg_predicted_pd"}
# Order of the alternative scale.
ALTERNATIVE_SCALE = ["A", "B", "C", "D", "E", "E_F", "F"]


def _position(scale: list[str], grade: str):
    found = F.array_position(F.lit(scale), F.col(grade))
    return F.when(found > 0, found).otherwise(99)


def alternative_mapping(summary: DataFrame, min_bucket_size: int = 50) -> DataFrame:
    """Map grades to the alternative scale: E and F share a bucket when F is sparse."""
    missing = REQUIRED - set(summary.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    grade = F.col("rating_grade")
    # A grade summary has at most a row per grade.
    f_size = F.max(F.when(grade == "F", F.col("facilities"))).over(Window.partitionBy())
    sparse = F.coalesce(f_size < min_bucket_size, F.lit(False))
    return summary.select(
        grade.alias("original_rating_grade"),
        F.when(sparse & grade.isin("E", "F"), "E_F").otherwise(grade).alias("alternative_rating_grade"),
        F.when(sparse & (grade == "F"), "merge sparse F into E/F bucket")
        .when(sparse & (grade == "E"), "merge E with sparse F bucket")
        .otherwise("unchanged")
        .alias("rule"),
        F.col("facilities").cast("bigint").alias("original_facilities"),
        F.col("observed_defaults").cast("bigint").alias("original_observed_defaults"),
        F.col("observed_default_rate").alias("original_observed_default_rate"),
        F.col("avg_predicted_pd").alias("original_avg_predicted_pd"),
    ).orderBy(_position(PD_GRADES, "original_rating_grade"))


def alternative_backtest(summary: DataFrame, mapping: DataFrame) -> DataFrame:
    """The grade summary regrouped on the alternative scale, PDs weighted by facilities."""
    names = mapping.select(F.col("original_rating_grade").alias("rating_grade"), "alternative_rating_grade")
    grouped = (
        summary.join(F.broadcast(names), "rating_grade", "left")
        .withColumn("alternative_rating_grade", F.coalesce("alternative_rating_grade", "rating_grade"))
        .groupBy("alternative_rating_grade")
        .agg(
            F.sum("facilities").alias("facilities"),
            F.sum("observed_defaults").alias("observed_defaults"),
            F.coalesce(F.sum(F.col("facilities") * F.col("avg_predicted_pd")), F.lit(0.0)).alias("expected_defaults"),
            F.min("min_predicted_pd").alias("min_predicted_pd"),
            F.max("max_predicted_pd").alias("max_predicted_pd"),
        )
    )
    size = F.nullif(F.col("facilities"), F.lit(0))
    return (
        grouped.withColumn("observed_default_rate", F.col("observed_defaults") / size)
        .withColumn("avg_predicted_pd", F.col("expected_defaults") / size)
        .withColumn("calibration_error", F.col("avg_predicted_pd") - F.col("observed_default_rate"))
        .orderBy(_position(ALTERNATIVE_SCALE, "alternative_rating_grade"))
    )
