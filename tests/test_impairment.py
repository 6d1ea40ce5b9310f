"""Staging, expected loss and stress: golden values and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lossledger.operators import ecl, staging, stress

STAGE_SCHEMA = (
    "facility_id string, default_flag int, writeoff_flag int, current_dpd int, dpd_at_default int, watchlist_flag int, "
    "restructuring_flag int, pd_ratio_current_to_origination double, rating_downgrade_notches int"
)


def staged(spark, rows):
    df = staging.assign_stage(spark.createDataFrame(rows, STAGE_SCHEMA))
    return [(r["ifrs9_stage"], r["ifrs9_stage_reason"]) for r in df.orderBy("facility_id").collect()]


def test_stage_3(spark):
    rows = [("1", 1, 0, 0, 0, 0, 0, 1.0, 0), ("2", 0, 0, 95, 0, 0, 0, 1.0, 0), ("3", 0, 1, 0, 0, 0, 0, 1.0, 0), ("4", 0, 0, 0, 90, 0, 0, 1.0, 0)]
    assert staged(spark, rows) == [(3, "default_or_90dpd")] * 4


def test_stage_2_reasons_in_order(spark):
    rows = [
        ("1", 0, 0, 0, None, 0, 0, 2.2, 0), ("2", 0, 0, 0, None, 1, 0, 1.0, 0), ("3", 0, 0, 35, None, 0, 0, None, None),
        ("4", 0, 0, 0, None, 0, 1, 1.0, 0), ("5", 0, 0, 0, None, 0, 0, 1.0, 2), ("6", 0, 0, 30, None, 1, 1, 2.0, 2),
    ]
    assert staged(spark, rows) == [
        (2, "pd_doubled"), (2, "watchlist"), (2, "30dpd"), (2, "restructuring"), (2, "rating_downgrade_2plus"),
        (2, "rating_downgrade_2plus+pd_doubled+30dpd+watchlist+restructuring"),
    ]


def test_stage_1(spark):
    assert staged(spark, [("1", 0, 0, 0, 0, 0, 0, 1.0, 0), ("2", None, None, None, None, None, None, None, None)]) == [(1, "performing")] * 2


def test_downgrade_is_derived_when_absent(spark):
    df = spark.createDataFrame([("1", "A", "C"), ("2", "C", "C")], "facility_id string, origination_rating_grade string, current_rating_grade string")
    got = staging.assign_stage(df).orderBy("facility_id").collect()
    assert [(r["ifrs9_stage"], r["rating_downgrade_notches"]) for r in got] == [(2, 2), (1, 0)]


REPORT_SCHEMA = (
    "facility_id string, ifrs9_stage int, current_rating_grade string, origination_rating_grade string, outstanding_amount double, "
    "current_pd_estimate double, origination_pd_estimate double, default_flag int"
)
REPORT_ROWS = [
    ("1", 1, "A", "A", 100.0, 0.01, 0.02, 0), ("2", 1, None, "B", 300.0, None, 0.02, 0), ("3", 3, "F", None, 600.0, 0.2, 0.1, 1),
]


def test_stage_reports(spark):
    df = spark.createDataFrame(REPORT_ROWS, REPORT_SCHEMA)
    distribution = staging.stage_distribution(df).collect()
    assert [(r["ifrs9_stage"], r["facilities"], r["total_outstanding"]) for r in distribution] == [(1, 2, 400.0), (3, 1, 600.0)]
    assert sum(r["facility_share"] for r in distribution) == pytest.approx(1)
    assert distribution[1]["outstanding_share"] == pytest.approx(0.6)
    assert [r["current_rating_grade"] for r in staging.stage_by_rating(df).collect()] == ["A", "F", None]
    matrix = {r["origination_rating_grade"]: r.asDict() for r in staging.rating_migration_matrix(df).collect()}
    assert matrix["B"]["missing"] == 1 and matrix["missing"]["F"] == 1 and matrix["A"]["A"] == 1
    assert sum(v for r in matrix.values() for k, v in r.items() if k != "origination_rating_grade") == 3


def scalar(spark, column):
    return spark.range(1).select(column).first()[0]


def test_loss_kernels(spark):
    lit = F.lit
    assert scalar(spark, ecl.lifetime_pd(lit(0.10), lit(2.0))) == pytest.approx(0.19)
    assert scalar(spark, ecl.lifetime_pd(lit(0.10), lit(None).cast("double"))) == pytest.approx(0.10)
    assert scalar(spark, ecl.expected_loss(lit(0.10), lit(0.5), lit(1000.0))) == pytest.approx(50)
    assert scalar(spark, ecl.expected_loss(lit(0.10), lit(0.5), lit(None).cast("double"))) == 0
    stages = [scalar(spark, ecl.stage_ecl(lit(s), lit(0.10), lit(0.20), lit(0.5), lit(1000.0))) for s in (1, 2, 3, 9)]
    assert stages == pytest.approx([50, 100, 500, 50])
    unknown = ecl.stage_ecl(lit(None).cast("int"), lit(0.10), lit(0.20), lit(0.5), lit(1000.0))
    assert scalar(spark, unknown) == pytest.approx(50)
    losses = {"base": lit(100.0), "downside": lit(150.0), "upside": lit(80.0)}
    assert scalar(spark, ecl.scenario_weighted(losses, ecl.SCENARIO_WEIGHTS)) == pytest.approx(109.5)


ECL_SCHEMA = (
    "facility_id string, reporting_date date, maturity_date date, ifrs9_stage int, current_pd_estimate double, "
    "origination_pd_estimate double, current_outstanding_balance double, outstanding_amount double, undrawn_amount double, "
    "revolving_flag int, product_type string, effective_collateral_coverage double, collateral_type string, industry string, "
    "current_rating_grade string"
)
D = dt.date
ECL_ROWS = [
    ("1", D(2025, 12, 31), D(2027, 12, 31), 1, 0.02, 0.01, 1000.0, 1000.0, 500.0, 1, "credit_line", 0.5, "real_estate", "construction", "C"),
    ("2", D(2025, 12, 31), D(2026, 1, 10), 2, None, 0.05, 2000.0, 2100.0, 0.0, 0, "term_loan", None, None, "services", "D"),
    ("3", D(2025, 12, 31), None, 3, None, None, None, 500.0, 100.0, 1, "leasing", 9.0, "guarantee", "trade", None),
]


@pytest.fixture()
def portfolio(spark):
    return spark.createDataFrame(ECL_ROWS, ECL_SCHEMA)


def test_risk_parameters(portfolio):
    got = {r["facility_id"]: r for r in ecl.with_risk_parameters(portfolio).collect()}
    assert got["1"]["remaining_life_years"] == pytest.approx(730 / 365.25)
    assert got["2"]["remaining_life_years"] == 0.25 and got["3"]["remaining_life_years"] == 1.0
    assert [got[k]["pd_12m_base"] for k in "123"] == [0.02, 0.05, 0.02]
    assert [got[k]["lgd_base"] for k in "123"] == pytest.approx([0.58, 0.84, 0.05])
    assert [got[k]["ccf_base"] for k in "123"] == [0.45, 0.0, 0.40]
    assert [got[k]["ead_base"] for k in "123"] == pytest.approx([1225.0, 2000.0, 40.0])


def test_facility_ecl_and_reports_agree(portfolio):
    facility = ecl.facility_ecl(portfolio)
    for r in facility.collect():
        weighted = sum(r[f"ecl_{s}"] * w for s, w in ecl.SCENARIO_WEIGHTS.items())
        assert r["scenario_weighted_ecl"] == pytest.approx(weighted) and r["ecl_base"] > 0
        assert r["ecl_downside"] > r["ecl_base"] > r["ecl_upside"]
        assert 0 <= r["lifetime_pd_downside"] <= 1 and r["lgd_downside"] <= 1
    total = facility.agg(F.sum("scenario_weighted_ecl")).first()[0]
    for report in (ecl.ecl_by_stage, ecl.ecl_by_rating, ecl.ecl_by_industry):
        assert report(facility).agg(F.sum("total_ecl")).first()[0] == pytest.approx(total)
    by_dimension = ecl.ecl_cube(facility).groupBy("dimension").agg(F.sum("total_ecl").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r["dimension"], r["n"]) for r in by_dimension} == {("portfolio", 1), ("ifrs9_stage", 3), ("current_rating_grade", 3), ("industry", 3)}
    assert all(r["t"] == pytest.approx(total) for r in by_dimension)
    portfolio_row = ecl.ecl_portfolio(facility).first()
    assert portfolio_row["ecl_rate"] == pytest.approx(total / 3265.0) and portfolio_row["stage_2_share"] == pytest.approx(1 / 3)
    scenario = {r["scenario"]: r for r in ecl.ecl_by_scenario(portfolio).collect()}
    assert scenario["base"]["total_ecl"] == pytest.approx(facility.agg(F.sum("ecl_base")).first()[0])
    assert "ecl_rate" not in ecl.ecl_validation_summary(ecl.ecl_portfolio(facility)).columns


def test_empty_portfolio(portfolio):
    row = ecl.ecl_portfolio(ecl.facility_ecl(portfolio.limit(0))).first()
    assert row["facilities"] == 0 and row["total_ecl"] == 0 and row["ecl_rate"] == 0


def test_stress(portfolio):
    cube = stress.stress_cube(portfolio)
    summary = stress.stress_summary(cube).collect()
    by_name = {r["scenario"]: r for r in summary}
    assert [r["total_ecl"] for r in summary] == sorted((r["total_ecl"] for r in summary), reverse=True)
    assert by_name["severe_downturn"]["total_ecl"] > by_name["base"]["total_ecl"]
    assert by_name["base"]["ecl_change_vs_base"] == 0 and by_name["severe_downturn"]["ecl_change_pct_vs_base"] > 0
    facility = stress.facility_stress(portfolio)
    for name, row in by_name.items():
        assert row["total_ecl"] == pytest.approx(facility.agg(F.sum(f"stress_ecl_{name}")).first()[0])
    assert stress.stress_by_stage(cube).count() == 15 and stress.stress_by_industry(cube).count() == 15


def test_industry_multiplier(spark):
    industries = spark.createDataFrame([("construction",), ("services",), ("trade",), (None,), ("mining",)], "i string").coalesce(1)

    def of(factor, fx):
        return [r[0] for r in industries.select(stress.industry_stress_multiplier(F.col("i"), factor, fx)).collect()]

    assert of(1.0, False) == pytest.approx([1.35, 1.0, 1.15, 1.0, 1.0])
    assert of(1.15, True) == pytest.approx([1.4025, 1.0, 1.3725, 1.0, 1.0])
    assert max(of(9.0, True)) == 2.5


def test_migrations_count_every_facility(spark):
    rows = [("1", None, "A"), ("2", "A", None), ("3", "Default", "Default"), ("4", "odd", "A"), ("5", "A", "A"), ("6", "A", "A")]
    df = spark.createDataFrame(rows, "facility_id string, origination_rating_grade string, current_rating_grade string")
    found = {(r["origination_rating_grade"], r["current_rating_grade"]): r["facilities"] for r in staging.rating_migrations(df).collect()}
    assert found == {
        ("missing", "A"): 1, ("A", "missing"): 1, ("Default", "Default"): 1, ("odd", "A"): 1, ("A", "A"): 2,
    }
