"""Per-facility rollups of collateral, payments and recoveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import settled_total


def collateral_rollup(collateral: DataFrame) -> DataFrame:
    """Per facility, in one shuffle: a first grouping by type would move nearly as many rows twice.

    Values are cut into quantiles later, so totals of equal items have to be equal in every order of the items.
    """
    value, haircut = F.col("collateral_value"), F.col("haircut")
    return collateral.groupBy("facility_id").agg(
        F.max("collateral_type").alias("collateral_type"),
        settled_total(value).alias("collateral_value"),
        (settled_total(haircut) / F.nullif(F.count(haircut), F.lit(0))).alias("avg_collateral_haircut"),
        settled_total(value * (1 - haircut)).alias("effective_collateral_value"),
    )


def payment_profile(payments: DataFrame) -> DataFrame:
    """Payments per facility and days-past-due value.

    Keeps what every later question needs (the first date a delinquency was seen, counts and
    sums) in fixed-width buffers, so the largest raw table is hash-aggregated on the map side
    before its only shuffle, and a facility with very many payments shrinks to a few rows.
    """
    return payments.groupBy("facility_id", "days_past_due").agg(
        F.min("payment_date").alias("first_seen"),
        F.count(F.lit(1)).alias("payments"),
        F.sum("scheduled_amount").alias("scheduled"),
        F.sum("paid_amount").alias("paid"),
    )


def payment_rollup(facilities: DataFrame, payments: DataFrame, window_months: int = 12) -> DataFrame:
    """Payment history per facility; `facilities` has facility_id and observation_date.

    A delinquency value counts for the window when its first date falls into it. A facility
    without payments still has one observed month, as in a left join that is then counted.
    """
    horizon = F.add_months("observation_date", window_months)
    dpd = F.col("days_past_due")
    return (
        facilities.select("facility_id", "observation_date")
        .join(payment_profile(payments), "facility_id", "left")
        .groupBy("facility_id")
        .agg(
            F.max(dpd).alias("max_dpd_observed"),
            F.max(F.when(F.col("first_seen") <= horizon, dpd)).alias("max_dpd_12m"),
            F.greatest(F.coalesce(F.sum("payments"), F.lit(0)), F.lit(1)).alias("payment_months_observed"),
            F.sum("scheduled").alias("total_scheduled_amount"),
            F.sum("paid").alias("total_paid_amount"),
        )
    )


def recovery_rollup(recoveries: DataFrame) -> DataFrame:
    return recoveries.groupBy("facility_id").agg(
        settled_total(F.col("recovery_amount")).alias("total_recovery_amount"),
        settled_total(F.col("collection_cost")).alias("total_collection_cost"),
        F.count(F.lit(1)).alias("recovery_events_count"),
    )
