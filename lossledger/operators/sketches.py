"""Mergeable quantile sketches of features: stability of a new period without reading old rows.

A sketch per feature and period is a few kilobytes, stored beside the mart. Sketches of periods merge into that of their
union, so the reference sample of a stability report is a merge of stored rows, and only the new period is read. Ranks
are within `RANK_ERROR` of the exact ones; the exact report is `stability.psi_details`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of a sketch, and the error of its ranks that tests hold it to, as a share of the rows.
SKETCH_K, RANK_ERROR = 2048, 0.005
EPSILON = 1e-6


def feature_sketches(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`by`, feature, rows, known (rows with a value), sketch: one pass over the rows, partial per task.

    A feature without values in a group has no sketch.
    """
    numbers = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features}
    parts = [
        F.struct(
            F.lit(c).alias("feature"), F.count(F.lit(1)).alias("rows"), F.count(x).alias("known"),
            F.when(F.count(x) > 0, F.kll_sketch_agg_double(x, SKETCH_K)).alias("sketch"),
        )
        for c, x in numbers.items()
    ]
    return df.groupBy(*by).agg(F.array(*parts).alias("_parts")).select(*by, F.inline("_parts"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch per feature (and `by`) from those of many groups."""
    return sketches.groupBy(*by, "feature").agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch")
    ).withColumn("sketch", F.when(F.col("known") > 0, F.col("sketch")))


def ranks_at(sketch: Column, cuts: Mapping[str, Sequence[float]]) -> Column:
    """For a row of a feature, the shares of its sketch's values that are at most each of the feature's cuts.

    Cuts are literals, as Spark asks for; they are as many as a report has bins.
    """
    ranks = F.lit(None).cast("array<double>")
    for feature, values in cuts.items():
        found = F.kll_sketch_get_rank_double(sketch, F.lit([float(v) for v in values])) if values else F.array().cast("array<double>")
        ranks = F.when(F.col("feature") == feature, found).otherwise(ranks)
    return ranks


def psi_from_sketches(expected: DataFrame, actual: DataFrame, bins: int = 10) -> DataFrame:
    """feature, bin, lower_bound, upper_bound, expected_share, actual_share, psi_component of merged sketches.

    Bins are cut at the distinct quantiles of the expected sketch with open outer bounds, as in the exact report. A
    feature without values on one side has no bins.
    """
    fractions = F.lit([i / bins for i in range(bins + 1)])
    both = expected.filter("known > 0").select("feature", F.col("sketch").alias("e")).join(
        actual.filter("known > 0").select("feature", F.col("sketch").alias("a")), "feature"
    )
    found = both.select("feature", F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("e", fractions))).alias("cuts"))
    cuts = {r["feature"]: r["cuts"][1:-1] for r in found.collect()}  # bins - 1 numbers per feature
    share = lambda ranks: F.zip_with(
        F.concat(ranks, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), ranks), lambda high, low: high - low
    )
    inner = F.lit(None).cast("array<double>")
    for feature, values in cuts.items():
        inner = F.when(F.col("feature") == feature, F.lit(values) if values else F.array().cast("array<double>")).otherwise(inner)
    infinite = F.lit(float("inf"))
    parts = F.arrays_zip(
        F.concat(F.array(-infinite), inner).alias("lower_bound"), F.concat(inner, F.array(infinite)).alias("upper_bound"),
        share(ranks_at(F.col("e"), cuts)).alias("expected_share"), share(ranks_at(F.col("a"), cuts)).alias("actual_share"),
    )
    names = ["lower_bound", "upper_bound", "expected_share", "actual_share"]
    shares = both.select("feature", F.posexplode(parts).alias("at", "p")).select(
        "feature", (F.col("at") + 1).cast("bigint").alias("bin"), *[F.col("p")[n].alias(n) for n in names]
    )
    x, y = (F.greatest(F.col(c), F.lit(EPSILON)) for c in ("expected_share", "actual_share"))
    return shares.select("feature", "bin", *names, ((y - x) * F.ln(y / x)).alias("psi_component"))
