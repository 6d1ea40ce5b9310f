"""The whole batch on the smallest testdata: stored marts, reports and their column contract."""

import datetime as dt

import pytest

from lossledger.plans import jobs
from lossledger.sources.portfolio import REPORTING_DATE, Portfolio

# Required reports and columns.
CONTRACT = {
    "pd_model_metrics": "model split rows default_rate roc_auc gini ks",
    "lgd_model_metrics": "model split mae rmse weighted_mae",
    "ead_ccf_model_metrics": "model split mae rmse weighted_mae",
    "pd_model_metrics_calibrated": "model calibration_method split rows roc_auc brier_score",
    "pd_calibration_before_after": "model pd_decile facilities calibration_error",
    "pd_rating_grade_summary": "rating_grade facilities observed_defaults",
    "ifrs9_stage_distribution": "ifrs9_stage facilities facility_share outstanding_share",
    "ifrs9_stage_by_rating": "current_rating_grade ifrs9_stage facilities",
    "ifrs9_rating_migration_matrix": "origination_rating_grade A",
    "ifrs9_ecl_portfolio_summary": "facilities total_ead total_ecl ecl_rate",
    "ifrs9_ecl_by_stage": "ifrs9_stage facilities total_ead total_ecl",
    "ifrs9_ecl_by_scenario": "scenario scenario_weight total_ecl",
    "stress_scenario_summary": "scenario total_ecl ecl_change_pct_vs_base",
    "stress_scenario_by_industry": "scenario industry total_ecl",
    "validation_summary": "area metric value",
    "validation_psi_summary": "feature psi",
    "validation_psi_details": "feature bin psi_component",
    "validation_pd_calibration_by_decile": "pd_decile facilities",
    "validation_pd_backtesting_by_rating": (
        "rating_grade facilities observed_default_rate avg_predicted_pd observed_default_rate_lower_ci observed_default_rate_upper_ci"
    ),
    "validation_rating_binomial_backtesting": "rating_grade observed_defaults expected_defaults binomial_p_value traffic_light",
    "validation_traffic_light_summary": "area metric value green_threshold amber_threshold red_threshold status comment",
    "rating_master_scale_alternative": "original_rating_grade alternative_rating_grade rule",
    "rating_backtesting_alternative": "alternative_rating_grade facilities observed_defaults",
    "data_quality_summary": "check_group check_name metric_value status checked_at",
    "executive_model_summary": "area metric value comment",
    "leakage_exclusion_report": "column reason category",
    "lgd_outlier_report": "area check_name metric_name metric_value status details",
    "ead_ccf_outlier_report": "area check_name metric_name metric_value status details",
}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("batch"))
    raw = Portfolio(spark, "/root/testdata/sf0.001").raw()
    jobs.run_all(raw, folder, REPORTING_DATE, checked_at=dt.datetime(2026, 1, 1))
    return folder


def test_reports_have_their_columns(spark, out):
    for name, columns in CONTRACT.items():
        df = spark.read.parquet(f"{out}/reports/{name}")
        assert set(columns.split()) <= set(df.columns), name
        assert df.count() > 0, name


def test_stored_marts_and_portfolios(spark, out):
    stored = jobs.read_marts(spark, out)
    facilities = stored["financial_ratios_mart"].count()
    assert stored["ifrs9_staging_sample"].count() == facilities
    for name in ("ifrs9_staged_portfolio", "ifrs9_ecl_facility_level", "stress_scenario_facility_level"):
        assert spark.read.parquet(f"{out}/portfolio/{name}").count() == facilities
    assert spark.read.parquet(f"{out}/reports/data_quality_summary").count() == 42
    assert spark.read.parquet(f"{out}/reports/executive_model_summary").count() == 28
    assert spark.read.parquet(f"{out}/reports/validation_traffic_light_summary").count() == 11
