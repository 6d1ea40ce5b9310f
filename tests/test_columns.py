"""Passes over many columns: keys keep the order of doubles, counts and moments equal numpy's, rows are not multiplied."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossledger.functions.numeric import parse_number
from lossledger.operators import columns, ordering
from lossledger.operators.stability import psi_details

INF = float("inf")


def test_keys_are_in_the_order_of_doubles():
    values = np.array([-INF, -1e300, -2.0, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 2.0, 1e300, INF, np.nan])
    keys = columns.order_keys(values)
    assert (np.diff(keys.astype(object)) > 0).all()
    assert np.array_equal(columns.key_values(keys), values, equal_nan=True)
    assert columns.order_keys(np.array([-0.0]))[0] == columns.order_keys(np.array([0.0]))[0]
    assert columns.order_keys(np.array([-np.nan]))[0] == columns.HIGHEST_KEY


def shaped(spark, n=6000):
    draw = np.random.default_rng(3)
    made = zip(
        draw.normal(0, 1e-3, n).tolist(), (1000 + draw.random(n) * 1e-6).tolist(), draw.exponential(1e6, n).tolist(),
        draw.integers(0, 3, n).astype(float).tolist(), [None if i % 7 else float(i) for i in range(n)],
    )
    rows = [(*r, INF if i % 2 else -INF, float("nan") if i % 2 else 1.0) for i, r in enumerate(made)]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g double").repartition(5)


def test_quantiles_of_many_shapes_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BRACKET_ACCURACY", 100)
    rows, df = shaped(spark)
    fractions = [0.0, 0.013, 0.1, 0.5, 0.9, 0.999, 1.0]
    got = ordering.column_quantiles(df, list("abcde"), fractions)
    for i, c in enumerate("abcde"):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c] == pytest.approx({q: float(np.quantile(values, q)) for q in fractions}, rel=1e-12)
    ends = ordering.column_quantiles(df, ["g"], [0.0, 0.25])
    assert ends["g"] == {0.0: 1.0, 0.25: 1.0}
    # Few values are left to order, also where all lie within 1e-9 of each other.
    left = columns.value_counts(df, list("ac"), ordering.key_brackets(df, list("ac"), fractions))
    assert left.count() < 400 and left.agg(F.sum("n")).first()[0] == 2 * len(rows)


def test_bins_and_moments_equal_numpy(spark):
    rows, df = shaped(spark)
    cuts = {"a": [-1e-3, 0.0, 1e-3], "d": [0.0, 1.0], "g": [1.0]}
    found = {(r["feature"], r["bin"]): r["n"] for r in columns.bin_counts(df, list("adeg"), cuts).collect()}
    for i, c in ((0, "a"), (3, "d")):
        bins = 1 + np.searchsorted(cuts[c], [r[i] for r in rows])
        assert {b: n for (f, b), n in found.items() if f == c} == dict(zip(*[x.tolist() for x in np.unique(bins, return_counts=True)]))
    missing = sum(r[4] is None for r in rows)
    assert (found["e", 0], found["e", 1]) == (missing, len(rows) - missing)
    assert (found["g", 1], found["g", 2]) == (3000, 3000)  # a value that is no number lies beyond every cut
    moments = columns.filled_moments(df, {"b": 1000.0, "c": 7e5, "e": 3.0})
    for i, c, m in ((1, "b", 1000.0), (2, "c", 7e5), (4, "e", 3.0)):
        values = np.array([m if r[i] is None else r[i] for r in rows])
        assert moments[c] == pytest.approx((values.mean(), values.std()), rel=1e-9)
    assert columns.filled_moments(df.select(F.lit(2.5).alias("x")), {"x": 2.5}) == {"x": (2.5, 0.0)}
    assert columns.filled_moments(df, {}) == {}


def test_reports_form_no_row_per_feature_and_value(spark):
    _, df = shaped(spark, 300)
    plan = psi_details(df, df, list("abc"))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "posexplode" not in plan
    assert psi_details(df.limit(0), df, ["a"]).filter("bin is not null").count() == 0


def test_texts_that_are_no_numbers_are_not_cast(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "+inf", "Infinity", "-INF", "nan", "NaN", "1d", "0x1p3", "trade_finance", "", " ", "infra", "e", None, "-", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(~F.col("t").rlike(r"[0-9.][dDfF]\s*$") & ~F.isnan(F.col("t").try_cast("double")), F.col("t").try_cast("double"))
    rows = df.select("t", parse_number(F.col("t")).alias("x"), plain.alias("y")).collect()
    assert [r["x"] for r in rows] == [r["y"] for r in rows] and sum(r["x"] is not None for r in rows) == 8
