"""Sketches by period: merged ranks near the exact ones, and stability near the exact report."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossledger.operators import sketches, stability


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 20_000
    x, y, k = rng.lognormal(0, 2, n), rng.normal(size=n), rng.integers(0, 5, n)
    made = [(int(i % 24), float(a), float(b) if i % 7 else None, float(c), None) for i, (a, b, c) in enumerate(zip(x, y, k))]
    return spark.createDataFrame(made, "month int, x double, y double, k double, none double").repartition(6)


FEATURES = ["x", "y", "k", "none"]


def test_merged_ranks_are_near_the_exact_ones(rows):
    monthly = sketches.feature_sketches(rows, FEATURES, ["month"])
    assert monthly.count() == 24 * len(FEATURES)
    whole = {r["feature"]: r for r in sketches.merged(monthly).collect()}
    assert (whole["y"]["rows"], whole["y"]["known"]) == (20_000, rows.filter("y is not null").count())
    assert whole["none"]["sketch"] is None and whole["none"]["known"] == 0
    merged = sketches.merged(monthly)
    for c in ("x", "y", "k"):
        values = np.sort([r[0] for r in rows.select(c).dropna().collect()])
        cuts = [float(np.quantile(values, q)) for q in (0.001, 0.1, 0.37, 0.5, 0.9, 0.999)]
        got = merged.filter(F.col("feature") == c).select(sketches.ranks_at(F.col("sketch"), {c: cuts})).first()[0]
        for found, value in zip(got, cuts):
            assert abs(found - np.searchsorted(values, value, side="right") / len(values)) <= sketches.RANK_ERROR


def test_stability_is_near_the_exact_report(rows):
    old, new = rows.filter("month < 18"), rows.filter("month >= 18").withColumn("x", F.col("x") * 1.5)
    monthly = sketches.merged(sketches.feature_sketches(old, FEATURES, ["month"]))
    found = sketches.psi_from_sketches(monthly, sketches.merged(sketches.feature_sketches(new, FEATURES)))
    got = {r["feature"]: r["psi"] for r in found.groupBy("feature").agg(F.sum("psi_component").alias("psi")).collect()}
    exact = {r["feature"]: r["psi"] for r in stability.psi_summary(stability.psi_details(old, new, FEATURES)).collect()}
    assert set(got) == {"x", "y", "k"} and exact["none"] is None
    assert all(got[c] == pytest.approx(exact[c], abs=0.01) for c in got) and got["x"] > 0.01
    sums = found.groupBy("feature").agg(F.sum("expected_share"), F.sum("actual_share")).collect()
    assert all(r[1] == pytest.approx(1) and r[2] == pytest.approx(1) for r in sums)


def test_no_rows(rows):
    empty = sketches.feature_sketches(rows.limit(0), FEATURES)
    assert all(r["known"] == 0 and r["sketch"] is None for r in empty.collect())
    assert sketches.psi_from_sketches(sketches.merged(empty), sketches.merged(empty)).count() == 0
