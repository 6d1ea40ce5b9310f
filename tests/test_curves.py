"""Ridge, logistic curve and rising steps against closed forms, plain versions and Spark's own fits."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import functions as F

from lossledger.models import isotonic, ridge, sigmoid


def numbers(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    x, w = rng.normal(size=(n, 3)) * [1, 100, 0.01] + [0, 50, 3], rng.uniform(0.5, 4, n)
    y = x @ [0.3, -0.02, 5] + 0.4 + rng.normal(scale=0.1, size=n)
    rows = [(*map(float, a), float(b), float(c)) for a, b, c in zip(x, y, w)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, w double").repartition(5)


def test_ridge_equals_linear_regression(spark):
    df, columns = numbers(spark), ["a", "b", "c"]
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(df)
    for weight, penalty in (("w", 0.0), ("w", 3.0), (None, 1.5)):
        found = ridge.fit(df, columns, "y", weight, penalty)
        w = F.col(weight) if weight else F.lit(1.0)
        f = df.agg(F.sum(w).alias("w"), (F.sum(w * F.col("y")) / F.sum(w)).alias("m"), (F.sum(w * F.col("y") ** 2) / F.sum(w)).alias("s")).first()
        spread = math.sqrt(f["s"] - f["m"] ** 2)
        model = LinearRegression(
            featuresCol="v", labelCol="y", regParam=penalty * spread / f["w"], standardization=False, **({"weightCol": weight} if weight else {})
        ).fit(vectors)
        assert list(found.coefficients.values()) == pytest.approx(list(model.coefficients), abs=1e-6)
        assert found.intercept == pytest.approx(model.intercept, abs=1e-6)
        scored = model.transform(vectors).select("prediction", found.score().alias("mine")).agg(F.max(F.abs(F.col("prediction") - F.col("mine")))).first()[0]
        assert scored < 1e-6


def test_ridge_on_unusual_rows(spark):
    df = numbers(spark, 50)
    odd = df.unionByName(df.limit(5).withColumn("a", F.lit(None).cast("double"))).unionByName(df.limit(3).withColumn("y", F.lit(None).cast("double")))
    assert ridge.fit(odd, ["a", "b"], "y", "w").coefficients == pytest.approx(ridge.fit(df, ["a", "b"], "y", "w").coefficients)
    assert ridge.fit(df.limit(0), ["a"], "y") == ridge.RidgeFit({"a": 0.0}, 0.0)
    constant = df.withColumn("k", F.lit(7.0))
    assert ridge.fit(constant, ["a", "k"], "y").coefficients["k"] == pytest.approx(0)
    assert ridge.fit(df.withColumn("a2", F.col("a")), ["a", "a2"], "y").coefficients["a"] == pytest.approx(ridge.fit(df.withColumn("a2", F.col("a")), ["a", "a2"], "y").coefficients["a2"])


def test_one_pass_over_the_rows(spark):
    plan = ridge.cross_products(numbers(spark), ["a", "b", "c"], "y", "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "Sort" not in plan


def outcomes(spark, n=2000, seed=1, digits=2):
    rng = np.random.default_rng(seed)
    m = np.round(rng.normal(-2, 1.5, n), digits)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.6 * m + 0.5)))).astype(int)
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(m, y)], "margin double, label int").repartition(6)


def test_sigmoid_solves_its_equations(spark):
    report = sigmoid.fit_report(outcomes(spark)).first()
    assert abs(report["slope_score"]) < 1e-12 and abs(report["intercept_score"]) < 1e-12
    assert report["mean_calibrated"] == pytest.approx(report["mean_target"], abs=1e-12)
    assert report["slope"] == pytest.approx(0.6, abs=0.1)


@pytest.mark.parametrize("rows", [[(1.0, 0)] * 5 + [(1.0, 1)], [(-1.0, 0), (1.0, 1)], [(float(i), 1) for i in range(9)], [(-800.0, 0), (900.0, 1), (3.0, 0)] * 5])
def test_sigmoid_on_hard_rows(spark, rows):
    """One margin, separable rows, one class, and margins far out: the equations hold all the same."""
    report = sigmoid.fit_report(spark.createDataFrame(rows, "margin double, label int")).first()
    assert report["mean_calibrated"] == pytest.approx(report["mean_target"], abs=1e-6)
    assert all(math.isfinite(report[c]) for c in ("slope", "intercept"))


def test_sigmoid_needs_rows(spark):
    with pytest.raises(ValueError):
        sigmoid.fit(spark.createDataFrame([(None, 1), (1.0, None)], "margin double, label int"))


def plain_steps(pairs):
    """Least squares under order, as the largest of the smallest means."""
    by = {}
    for m, y in pairs:
        by.setdefault(m, []).append(y)
    margins = sorted(by)
    sums, counts = np.cumsum([0] + [sum(by[m]) for m in margins]), np.cumsum([0] + [len(by[m]) for m in margins])
    mean = lambda a, b: (sums[b + 1] - sums[a]) / (counts[b + 1] - counts[a])
    n = len(margins)
    return {margins[i]: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)}


@pytest.mark.parametrize("range_blocks", [1_000_000, 40, 7])
@pytest.mark.parametrize("shape", ["mixed", "falling", "rising", "flat"])
def test_steps_equal_max_min_in_any_number_of_ranges(spark, shape, range_blocks):
    draw = random.Random(5)
    label = {"mixed": lambda i: int(draw.random() < i / 120), "falling": lambda i: -i, "rising": lambda i: i, "flat": lambda i: 1}[shape]
    pairs = [(float(i % 97) / 4, float(label(i % 97))) for i in range(300)]
    steps = isotonic.fit(spark.createDataFrame(pairs, "margin double, label double"), range_blocks=range_blocks).orderBy("low").collect()
    assert all(a["high"] < b["low"] and a["value"] < b["value"] for a, b in zip(steps, steps[1:]))
    expected = plain_steps(pairs)
    for m, v in expected.items():
        (step,) = [s for s in steps if s["low"] <= m <= s["high"]]
        assert step["value"] == pytest.approx(v, abs=1e-12)
    assert {"falling": 1, "flat": 1, "rising": 97}.get(shape, len(steps)) == len(steps)


def test_calibrated_values_equal_the_library(spark):
    rows = outcomes(spark, digits=1)
    asked = spark.createDataFrame([(float(x),) for x in np.linspace(-9, 5, 200)] + [(None,), (0.1,), (0.1,)], "margin double")
    model = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="p").fit(rows.withColumn("label", F.col("label").cast("double")))
    library = {r["margin"]: r["p"] for r in model.transform(asked.dropna()).collect()}
    found = isotonic.calibrated(asked, isotonic.fit(rows, range_blocks=9)).collect()
    assert len(found) == 203
    for r in found:
        assert r["calibrated"] == (None if r["margin"] is None else pytest.approx(library[r["margin"]], abs=1e-9))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "margin double, label int")
    assert isotonic.fit(empty).count() == 0
    assert [r["calibrated"] for r in isotonic.calibrated(outcomes(spark, 3), isotonic.fit(empty)).collect()] == [None] * 3
