"""Impairment staging and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.credit import flag_is_true, rating_downgrade
from lossledger.functions.numeric import numeric_column, total

STAGE_3_REASON = "default_or_90dpd"
STAGE_1_REASON = "performing"


def assign_stage(df: DataFrame) -> DataFrame:
    """Add `ifrs9_stage` and `ifrs9_stage_reason`.

    Stage 3 for defaults, write-offs and 90 days past due; stage 2 for any sign of increased
    risk, named in a fixed order; stage 1 otherwise. Absent columns do not trigger anything.
    """
    data = df
    if "rating_downgrade_notches" not in df.columns:
        downgrade = F.lit(None).cast("int")
        if {"origination_rating_grade", "current_rating_grade"} <= set(df.columns):
            downgrade = rating_downgrade(F.col("origination_rating_grade"), F.col("current_rating_grade"))
        data = df.withColumn("rating_downgrade_notches", downgrade)

    dpd = numeric_column(data, "current_dpd")
    impaired = (
        flag_is_true(data, "default_flag")
        | flag_is_true(data, "writeoff_flag")
        | at_least(dpd, 90)
        | at_least(numeric_column(data, "dpd_at_default"), 90)
    )
    triggers = {
        "rating_downgrade_2plus": at_least(numeric_column(data, "rating_downgrade_notches"), 2),
        "pd_doubled": at_least(numeric_column(data, "pd_ratio_current_to_origination"), 2),
        "30dpd": at_least(dpd, 30),
        "watchlist": flag_is_true(data, "watchlist_flag"),
        "restructuring": flag_is_true(data, "restructuring_flag"),
    }
    reasons = F.concat_ws("+", *[F.when(hit, name) for name, hit in triggers.items()])
    return data.withColumns(
        {
            "ifrs9_stage": F.when(impaired, 3).when(reasons != "", 2).otherwise(1),
            "ifrs9_stage_reason": F.when(impaired, STAGE_3_REASON)
            .when(reasons != "", reasons)
            .otherwise(STAGE_1_REASON),
        }
    )


def at_least(value: Column, bound: float) -> Column:
    return F.coalesce(value >= bound, F.lit(False))


def stage_summary(staged: DataFrame) -> DataFrame:
    """Size, exposure and risk per stage."""
    return (
        staged.filter(F.col("ifrs9_stage").isNotNull())
        .groupBy("ifrs9_stage")
        .agg(
            F.count(F.lit(1)).alias("facilities"),
            total(F.col("outstanding_amount")).alias("total_outstanding"),
            F.avg("current_pd_estimate").alias("avg_current_pd"),
            F.avg("origination_pd_estimate").alias("avg_origination_pd"),
            F.avg("default_flag").alias("default_rate"),
        )
    )


def stage_distribution(staged: DataFrame) -> DataFrame:
    """`stage_summary` with each stage's share of facilities and exposure."""
    # One row per stage: the unpartitioned window sees three rows.
    whole = Window.partitionBy()
    return (
        stage_summary(staged)
        .withColumn("facility_share", F.col("facilities") / F.sum("facilities").over(whole))
        .withColumn(
            "outstanding_share",
            F.col("total_outstanding") / F.nullif(F.sum("total_outstanding").over(whole), F.lit(0.0)),
        )
        .orderBy("ifrs9_stage")
    )


def stage_by_rating(staged: DataFrame) -> DataFrame:
    """Stages within each current grade; facilities without a grade form their own group."""
    return (
        staged.groupBy("current_rating_grade", "ifrs9_stage")
        .agg(
            F.count(F.lit(1)).alias("facilities"),
            total(F.col("outstanding_amount")).alias("total_outstanding"),
            F.avg("current_pd_estimate").alias("avg_current_pd"),
            F.avg("default_flag").alias("default_rate"),
        )
        .orderBy(F.asc_nulls_last("current_rating_grade"), "ifrs9_stage")
    )


def rating_migrations(staged: DataFrame, missing: str = "missing") -> DataFrame:
    """Facilities by origination and current grade, a row per pair; missing grades are counted under `missing`."""
    return staged.groupBy(
        F.coalesce("origination_rating_grade", F.lit(missing)).alias("origination_rating_grade"),
        F.coalesce("current_rating_grade", F.lit(missing)).alias("current_rating_grade"),
    ).agg(F.count(F.lit(1)).alias("facilities"))


def rating_migration_matrix(staged: DataFrame, missing: str = "missing") -> DataFrame:
    """Facilities by origination grade (rows) and current grade (columns, all grades that occur)."""
    return (
        rating_migrations(staged, missing)
        .groupBy("origination_rating_grade")
        .pivot("current_rating_grade")
        .agg(F.sum("facilities"))
        .na.fill(0)
        .orderBy("origination_rating_grade")
    )
