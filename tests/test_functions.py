"""Scalar expressions: missing values, grades, flags, statistics."""

import math

import pytest
from pyspark.sql import functions as F

from lossledger.functions import credit
from lossledger.functions.numeric import clip, clip_ccf, clip_lgd, number, parse_number, safe_divide
from lossledger.functions.ratios import with_financial_ratios


def values(spark, expression, data, schema="x double"):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in data], schema)
    return [r[0] for r in df.coalesce(1).select(expression).collect()]


def test_clip_keeps_missing(spark):
    x = F.col("x")
    assert values(spark, clip_lgd(x), [-0.5, 0.4, 1.7, None]) == [0.0, 0.4, 1.0, None]
    assert values(spark, clip_ccf(x), [-0.5, 0.4, 1.7, None]) == [0.0, 0.4, 1.5, None]
    assert values(spark, clip(number(x), 0.0, 1.0), [float("nan")]) == [None]


def test_text_numbers(spark):
    texts = ["1.5", " 2 ", "x", "1d", None, "NaN", "-3e2"]
    assert values(spark, parse_number(F.col("x")), texts, "x string") == [1.5, 2.0, None, None, None, None, -300.0]


def test_safe_divide(spark):
    quotient = safe_divide(F.col("a"), F.col("b"))
    data = [(10.0, 2.0), (5.0, 0.0), (12.0, 2.0), (1.0, None), (1e308, 1e-308)]
    assert values(spark, quotient, data, "a double, b double") == [5.0, None, 6.0, None, None]


def test_grades_are_left_closed(spark):
    pds = [0.001, 0.005, 0.010, 0.015, 0.025, 0.050, 0.100, 0.150, 0.200, None]
    assert "".join(values(spark, credit.pd_grade(F.col("x")), pds)) == "ABBCCDEFFF"


def test_downgrade(spark):
    change = credit.rating_downgrade(F.col("a"), F.col("b"))
    pairs = [("A", "C"), ("D", "B"), ("B", "B"), ("A", None), ("A", "Z"), ("F", "Default")]
    assert values(spark, change, pairs, "a string, b string") == [2, -2, 0, None, None, 1]


@pytest.mark.parametrize(
    "schema, data, expected",
    [
        ("x string", [" Yes", "TRUE", "1", "y", "0", "no", None], [True, True, True, True, False, False, False]),
        ("x int", [1, 2, 0, None], [True, True, False, False]),
        ("x double", [0.5, 0.0, float("nan"), None], [True, False, False, False]),
        ("x boolean", [True, False, None], [True, False, False]),
    ],
)
def test_flags(spark, schema, data, expected):
    df = spark.createDataFrame([(v,) for v in data], schema).coalesce(1)
    assert [r[0] for r in df.select(credit.flag_is_true(df, "x")).collect()] == expected
    assert df.select(credit.flag_is_true(df, "absent")).first()[0] is False


def test_wilson(spark):
    lower, upper = credit.wilson_bounds(F.col("k"), F.col("n"))
    df = spark.createDataFrame([(5, 100), (0, 0), (0, 10), (10, 10)], "k int, n int").coalesce(1)
    (lo, hi), missing, zero, full = [tuple(r) for r in df.select(lower, upper).collect()]
    assert 0 <= lo < 0.05 < hi <= 1
    assert missing == (None, None)
    assert zero[0] == 0.0 and full[1] == 1.0
    z = 1.96
    centre, half = (0.05 + z * z / 200) / (1 + z * z / 100), z * math.sqrt(0.05 * 0.95 / 100 + z * z / 40000) / (1 + z * z / 100)
    assert lo == pytest.approx(centre - half) and hi == pytest.approx(centre + half)


def test_erfc_relative_error(spark):
    points = [i / 10 for i in range(0, 80)]
    for x, got in zip(points, values(spark, credit.erfc(F.col("x")), points)):
        assert got == pytest.approx(math.erfc(x), rel=2e-7)


def test_binomial_p_value_reproduces_published_grades(spark):
    p = credit.binomial_p_value(F.col("k"), F.col("n"), F.col("p"))
    data = [(9.0, 429.0, 0.002768808142084383), (0.0, 15.0, 0.24744350067610474), (1.0, 0.0, 0.1)]
    a, f, none = values(spark, p, data, "k double, n double, p double")
    assert a == pytest.approx(7.077400522221818e-13, rel=1e-5)
    assert f == pytest.approx(0.026362899072238436, rel=1e-6)
    assert none is None


def test_statuses(spark):
    x = F.col("x")
    assert values(spark, credit.status_min_good(x, 0.30, 0.20), [0.35, 0.25, 0.10, None]) == ["GREEN", "AMBER", "RED", "UNKNOWN"]
    assert values(spark, credit.status_max_good(x, 0, 1), [0.0, 1.0, 2.0]) == ["GREEN", "AMBER", "RED"]
    band = credit.status_band_good(x, 0.05, 0.35, 0.01, 0.50)
    assert values(spark, band, [0.20, 0.40, 0.80]) == ["GREEN", "AMBER", "RED"]
    assert values(spark, credit.p_value_light(x), [0.05, 0.01, 0.009, None]) == ["GREEN", "AMBER", "RED", "UNKNOWN"]


STATEMENT = dict(
    revenue=1000.0, revenue_prev_year=800.0, ebitda=200.0, net_income=100.0, total_assets=2000.0, current_assets=600.0,
    inventory=100.0, current_liabilities=300.0, short_term_debt=200.0, long_term_debt=400.0, equity=800.0,
    interest_expense=50.0, operating_cash_flow=180.0, cash=150.0, outstanding_amount=500.0, collateral_value=1000.0,
)


def test_ratios(spark):
    got = with_financial_ratios(spark.createDataFrame([STATEMENT])).first().asDict()
    expected = dict(
        total_debt=600, current_ratio=2, quick_ratio=500 / 300, debt_to_equity=0.75, debt_to_assets=0.3, debt_to_ebitda=3,
        interest_coverage=4, ebitda_margin=0.2, net_profit_margin=0.1, operating_cf_to_debt=0.3,
        cash_to_short_term_debt=0.75, equity_to_assets=0.4, revenue_growth_yoy=0.25, loan_to_value=0.5, collateral_coverage=2,
    )
    for name, value in expected.items():
        assert got[name] == pytest.approx(value), name


def test_ratios_without_optional_fields(spark):
    fields = {k: v for k, v in STATEMENT.items() if k not in ("revenue_prev_year", "collateral_value", "inventory", "long_term_debt")}
    fields["equity"] = 0.0
    got = with_financial_ratios(spark.createDataFrame([fields])).first().asDict()
    assert "revenue_growth_yoy" not in got and "loan_to_value" not in got and "long_term_debt" not in got
    assert got["debt_to_equity"] is None and got["quick_ratio"] == 2.0 and got["total_debt"] == 200.0
