"""Population stability of features between two samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.operators.columns import bin_counts
from lossledger.operators.ordering import feature_quantiles

EPSILON = 1e-6
INFINITY = float("inf")


def psi_details(expected: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts, shares and PSI component per feature and bin, plus the missing counts per feature.

    Bins are cut at the distinct quantiles of the expected sample with open outer bounds, all
    features in two jobs: one for the cut points, one for the counts. Empty bins are kept. A
    feature without values on one side has no bins.
    """
    present = [f for f in features if f in expected.columns and f in actual.columns]
    fractions = [i / bins for i in range(bins + 1)]
    cuts = (
        feature_quantiles(expected, present, fractions)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("quantile")).alias("_cuts"))
        .select(
            "feature",
            F.when(F.size("_cuts") > 2, F.slice("_cuts", 2, F.size("_cuts") - 2))
            .otherwise(F.array().cast("array<double>"))
            .alias("_inner"),
        )
    )
    # Cut points: one row per feature.
    inner = {r["feature"]: r["_inner"] for r in cuts.collect()}
    cuts = expected.sparkSession.createDataFrame(list(inner.items()), "feature string, _inner array<double>")
    count, none = F.col("n"), F.lit(0).cast("bigint")
    sides = bin_counts(expected, present, inner).select("feature", "bin", count.alias("expected_count"), none.alias("actual_count")).unionByName(
        bin_counts(actual, present, inner).select("feature", "bin", none.alias("expected_count"), count.alias("actual_count"))
    )
    counts = sides.groupBy("feature", "bin").agg(
        F.sum("expected_count").alias("expected_count"), F.sum("actual_count").alias("actual_count")
    )
    # From here on the rows are features x bins.
    by_feature = counts.groupBy("feature").agg(
        F.sum("expected_count").alias("expected_rows"),
        F.sum("actual_count").alias("actual_rows"),
        F.sum(F.when(F.col("bin") == 0, F.col("expected_count")).otherwise(0)).alias("expected_missing"),
        F.sum(F.when(F.col("bin") == 0, F.col("actual_count")).otherwise(0)).alias("actual_missing"),
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("expected_count", "actual_count")))).alias("_by_bin"),
    )
    known_expected = F.col("expected_rows") - F.col("expected_missing")
    known_actual = F.col("actual_rows") - F.col("actual_missing")
    all_bins = (
        by_feature.join(F.broadcast(cuts), "feature", "left")
        .withColumn(
            "bin",
            F.explode_outer(
                F.when((known_expected > 0) & (known_actual > 0), F.sequence(F.lit(1), F.size("_inner") + 1))
            ),
        )
        .withColumn("_hit", F.try_element_at("_by_bin", F.col("bin")))
    )
    edges = F.concat(F.array(F.lit(-INFINITY)), "_inner", F.array(F.lit(INFINITY)))
    expected_share = F.coalesce("_hit.expected_count", F.lit(0)) / known_expected
    actual_share = F.coalesce("_hit.actual_count", F.lit(0)) / known_actual
    floored_expected = F.greatest(expected_share, F.lit(EPSILON))
    floored_actual = F.greatest(actual_share, F.lit(EPSILON))
    has_bin = F.col("bin").isNotNull()
    return all_bins.select(
        "feature",
        F.col("bin").cast("bigint").alias("bin"),
        F.when(has_bin, F.try_element_at(edges, F.col("bin"))).alias("lower_bound"),
        F.when(has_bin, F.try_element_at(edges, F.col("bin") + 1)).alias("upper_bound"),
        F.when(has_bin, F.coalesce("_hit.expected_count", F.lit(0))).alias("expected_count"),
        F.when(has_bin, F.coalesce("_hit.actual_count", F.lit(0))).alias("actual_count"),
        F.when(has_bin, expected_share).alias("expected_share"),
        F.when(has_bin, actual_share).alias("actual_share"),
        F.when(has_bin, (floored_actual - floored_expected) * F.ln(floored_actual / floored_expected)).alias("psi_component"),
        (F.col("expected_missing") / F.nullif(F.col("expected_rows"), F.lit(0))).alias("expected_missing_rate"),
        (F.col("actual_missing") / F.nullif(F.col("actual_rows"), F.lit(0))).alias("actual_missing_rate"),
    )


DETAIL_COLUMNS = [
    "feature", "bin", "lower_bound", "upper_bound", "expected_count", "actual_count",
    "expected_share", "actual_share", "psi_component",
]


def psi_summary(details: DataFrame) -> DataFrame:
    """PSI and missing rates per feature, least stable first; NULL where a side has no values."""
    return (
        details.groupBy("feature")
        .agg(
            F.sum("psi_component").alias("psi"),
            F.max("expected_missing_rate").alias("expected_missing_rate"),
            F.max("actual_missing_rate").alias("actual_missing_rate"),
        )
        # Features that are multiples of each other differ only by the rounding of their sums.
        .orderBy(F.desc_nulls_last(F.round("psi", 9)), "feature")
    )


def top_psi_details(details: DataFrame, top_n: int) -> DataFrame:
    """Bins of the `top_n` least stable features; all features when `top_n` is not positive."""
    rows = details.filter(F.col("bin").isNotNull()).select(*DETAIL_COLUMNS)
    if top_n <= 0:
        return rows
    top = psi_summary(details).limit(top_n).select("feature")
    return rows.join(F.broadcast(top), "feature", "left_semi")


def psi(expected: DataFrame, actual: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """PSI of one column as a one-row frame."""
    return psi_summary(psi_details(expected.select(column), actual.select(column), [column], bins))
