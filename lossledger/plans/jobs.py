"""Batch jobs: raw tables to stored marts, and stored marts to reports in a folder.

Every job reads what an earlier one stored, so a lost run restarts at the job that failed. Reports
are small Parquet folders under `<out>/reports`, facility-level results under `<out>/portfolio`,
models under `<out>/models`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.models import calibration, training
from lossledger.operators import (
    backtesting,
    ecl,
    features,
    leakage,
    marts,
    master_scale,
    outliers,
    quality,
    reports,
    sketches,
    splitting,
    stability,
    staging,
    stress,
)
from lossledger.sources.publication import publish, read_published
from lossledger.sources.readers import read_reports
from lossledger.sources.writers import save_facility_level, save_report

MART_NAMES = {
    "financial_ratios_mart", "pd_modeling_sample", "lgd_modeling_sample", "ead_ccf_modeling_sample",
    "ifrs9_staging_sample",
}
MART_KEY, SKETCHES = "facility_id", "pd_feature_sketches"
TRAINING = {
    "pd": ("pd_modeling_sample", training.PD_SPEC, "pd_rating_grade_summary", "pd_calibration_by_decile"),
    "lgd": ("lgd_modeling_sample", training.LGD_SPEC, "lgd_by_segment", "lgd_calibration_by_decile"),
    "ead_ccf": ("ead_ccf_modeling_sample", training.CCF_SPEC, "ead_ccf_by_product", "ead_ccf_calibration_by_decile"),
}


def _save_reports(out: str, named: Mapping[str, DataFrame]) -> None:
    for name, df in named.items():
        save_report(df, f"{out}/reports/{name}")
        save_report(read_reports(df.sparkSession, f"{out}/reports", [name])[name], f"{out}/reports_csv/{name}", as_csv=True)


def read_marts(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    return {name: read_published(spark, f"{out}/marts/{name}") for name in sorted(MART_NAMES)}


def build_marts(raw: Mapping[str, DataFrame], out: str, reporting_date: dt.date) -> dict[str, DataFrame]:
    """Store the ratio mart once, then the four samples that read it.

    Each is published whole, in buckets of the facility, so joins by facility leave it in place.
    """
    macro = raw["macro_scenarios"]

    def store(name: str, df: DataFrame) -> DataFrame:
        return publish(df, f"{out}/marts/{name}", bucket_by=[MART_KEY])

    mart = store("financial_ratios_mart", marts.ratio_mart(raw))
    pd_sample = store("pd_modeling_sample", marts.pd_sample(mart))
    publish(monthly_sketches(pd_sample), f"{out}/marts/{SKETCHES}")
    return {
        "financial_ratios_mart": mart,
        "pd_modeling_sample": pd_sample,
        "lgd_modeling_sample": store("lgd_modeling_sample", marts.lgd_sample(mart, macro)),
        "ead_ccf_modeling_sample": store("ead_ccf_modeling_sample", marts.ccf_sample(mart, macro)),
        "ifrs9_staging_sample": store(
            "ifrs9_staging_sample",
            marts.staging_sample(mart, raw["rating_history"], raw["payments"], reporting_date),
        ),
    }


def monthly_sketches(sample: DataFrame) -> DataFrame:
    """Sketches of the PD features by month of observation: what stability of later periods needs of these rows."""
    numeric = features.numeric_features(sample, training.PD_SPEC.keys)
    return sketches.feature_sketches(sample.withColumn("month", F.trunc("observation_date", "MM")), numeric, ["month"])


def stability_of(sample: DataFrame, out: str, before: dt.date) -> DataFrame:
    """Stability of a new period's rows against all stored months before a date, whose rows are not read."""
    stored = read_published(sample.sparkSession, f"{out}/marts/{SKETCHES}").filter(F.col("month") < F.lit(before))
    return sketches.psi_from_sketches(sketches.merged(stored), sketches.merged(monthly_sketches(sample)))


def check_quality(
    raw: Mapping[str, DataFrame], stored: Mapping[str, DataFrame], out: str, checked_at: dt.datetime | None = None
) -> None:
    tables = {f"raw.{n}": df for n, df in raw.items()} | {f"mart.{n}": df for n, df in stored.items()}
    _save_reports(out, {"data_quality_summary": quality.data_quality(tables, checked_at)})


def run_staging(stored: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Stage the portfolio once; loss and stress jobs read the stored result."""
    path = f"{out}/portfolio/ifrs9_staged_portfolio"
    save_facility_level(staging.assign_stage(stored["ifrs9_staging_sample"]), path)
    staged = stored["ifrs9_staging_sample"].sparkSession.read.parquet(path)
    _save_reports(
        out,
        {
            "ifrs9_stage_distribution": staging.stage_distribution(staged),
            "ifrs9_stage_by_rating": staging.stage_by_rating(staged),
            "ifrs9_rating_migration_matrix": staging.rating_migration_matrix(staged),
            "validation_stage_summary": staging.stage_summary(staged),
        },
    )
    return staged


def run_ecl(staged: DataFrame, out: str, weights: Mapping[str, float] = ecl.SCENARIO_WEIGHTS) -> DataFrame:
    path = f"{out}/portfolio/ifrs9_ecl_facility_level"
    save_facility_level(ecl.facility_ecl(staged, weights), path)
    facility = staged.sparkSession.read.parquet(path)
    portfolio = ecl.ecl_portfolio(facility)
    _save_reports(
        out,
        {
            "ifrs9_ecl_portfolio_summary": portfolio,
            "ifrs9_ecl_by_stage": ecl.ecl_by_stage(facility),
            "ifrs9_ecl_by_rating": ecl.ecl_by_rating(facility),
            "ifrs9_ecl_by_industry": ecl.ecl_by_industry(facility),
            "ifrs9_ecl_by_scenario": ecl.ecl_by_scenario(staged, weights),
            "validation_ecl_summary": ecl.ecl_validation_summary(portfolio),
        },
    )
    return facility


def run_stress(staged: DataFrame, out: str) -> None:
    save_facility_level(stress.facility_stress(staged), f"{out}/portfolio/stress_scenario_facility_level")
    cube = stress.stress_cube(staged)
    _save_reports(
        out,
        {
            "stress_scenario_summary": stress.stress_summary(cube),
            "stress_scenario_by_stage": stress.stress_by_stage(cube),
            "stress_scenario_by_industry": stress.stress_by_industry(cube),
        },
    )


def run_diagnostics(stored: Mapping[str, DataFrame], out: str) -> None:
    _save_reports(
        out,
        {
            "lgd_outlier_report": outliers.lgd_outliers(stored["lgd_modeling_sample"]),
            "ead_ccf_outlier_report": outliers.ccf_outliers(stored["ead_ccf_modeling_sample"]),
            "leakage_exclusion_report": leakage.leakage_report(stored["pd_modeling_sample"]),
        },
    )


def run_training(stored: Mapping[str, DataFrame], out: str, model: str, **options) -> training.TrainingResult:
    """Train `pd`, `lgd` or `ead_ccf` and store models, predictions and reports."""
    sample, spec, group_report, calibration_report = TRAINING[model]
    result = training.train_and_evaluate(stored[sample], spec, **options)
    for name, fitted in result.models.items():
        fitted.write().overwrite().save(f"{out}/models/{model}/{name}")
    save_facility_level(result.oot_predictions, f"{out}/portfolio/{model}_oot_predictions")
    spark = stored[sample].sparkSession
    _save_reports(
        out,
        {
            f"{model}_feature_columns": spark.createDataFrame([(c,) for c in result.features], "feature string"),
            **(
                {"pd_excluded_suspicious_columns": spark.createDataFrame([(c,) for c in result.excluded], "column string")}
                if spec.binary else {}
            ),
            f"{model}_time_split_summary": result.split_summary,
            f"{model}_model_metrics": result.metrics,
            f"{model}_best_model_summary": result.best_row(),
            group_report: result.group_report(),
            calibration_report: result.calibration_report(),
        },
    )
    return result


def run_calibration(stored: Mapping[str, DataFrame], out: str) -> None:
    result = calibration.calibrate_pd(stored["pd_modeling_sample"])
    _save_reports(
        out,
        {
            "pd_model_metrics_calibrated": result.metrics,
            "pd_calibration_before_after": result.before_after(),
        },
    )


def run_rating_scale(spark: SparkSession, out: str, min_bucket_size: int = 50) -> None:
    name = "pd_rating_grade_summary"
    summary = read_reports(spark, f"{out}/reports", [name])[name]
    mapping = master_scale.alternative_mapping(summary, min_bucket_size)
    _save_reports(
        out,
        {
            "rating_master_scale_alternative": mapping,
            "rating_backtesting_alternative": master_scale.alternative_backtest(summary, mapping),
        },
    )


def run_validation(stored: Mapping[str, DataFrame], out: str, psi_top_n: int = 20) -> None:
    """Backtest the best PD model out of time and monitor the features."""
    target = training.PD_SPEC.target
    spark = stored["pd_modeling_sample"].sparkSession
    predictions = spark.read.parquet(f"{out}/portfolio/pd_oot_predictions")
    needed = read_reports(
        spark, f"{out}/reports", ["validation_stage_summary", "validation_ecl_summary"], ["pd_best_model_summary"]
    )
    best = needed["pd_best_model_summary"].first()["model"] if "pd_best_model_summary" in needed else None
    score = features.choose_pd_column(predictions.columns, best)
    backtest = backtesting.pd_backtest_by_grade(predictions, score, target)
    monotonicity = backtesting.monotonicity_summary(backtest)

    split = splitting.time_split(stored["pd_modeling_sample"])
    numeric = features.numeric_features(split, [*training.PD_SPEC.keys, "split"])
    details = stability.psi_details(
        splitting.split_part(split, "train"), splitting.split_part(split, "oot"), numeric
    )
    save_facility_level(details, f"{out}/portfolio/psi_all_bins")
    details = spark.read.parquet(f"{out}/portfolio/psi_all_bins")
    psi = stability.psi_summary(details)
    _save_reports(
        out,
        {
            "validation_pd_backtesting_by_rating": backtest,
            "validation_rating_binomial_backtesting": backtesting.binomial_backtest(backtest),
            "validation_pd_calibration_by_decile": backtesting.pd_calibration_by_bin(predictions, score, target),
            "validation_rating_monotonicity_summary": monotonicity,
            "validation_rating_monotonicity_violations": backtesting.monotonicity_violations(backtest),
            "validation_psi_summary": psi,
            "validation_psi_details": stability.top_psi_details(details, psi_top_n),
            "validation_summary": reports.validation_summary(
                backtest, monotonicity, psi, needed["validation_stage_summary"], needed["validation_ecl_summary"]
            ),
        },
    )


def run_summaries(spark: SparkSession, out: str) -> None:
    """Traffic lights and executive summary, from stored reports only."""
    required = [*reports.REQUIRED_REPORTS, "lgd_model_metrics", "ead_ccf_model_metrics"]
    found = read_reports(spark, f"{out}/reports", required, reports.OPTIONAL_REPORTS)
    _save_reports(
        out,
        {
            "validation_traffic_light_summary": reports.traffic_lights(found),
            "executive_model_summary": reports.executive_summary(found),
        },
    )


def run_all(
    raw: Mapping[str, DataFrame], out: str, reporting_date: dt.date, checked_at: dt.datetime | None = None,
    boosting: bool = False,
) -> None:
    """Marts, checks, staging, loss, stress, models and validation; `boosting` adds boosted trees to the models."""
    stored = build_marts(raw, out, reporting_date)
    spark = stored["financial_ratios_mart"].sparkSession
    check_quality(raw, stored, out, checked_at)
    staged = run_staging(stored, out)
    run_ecl(staged, out)
    run_stress(staged, out)
    run_diagnostics(stored, out)
    for model in TRAINING:
        run_training(stored, out, model, boosting=boosting)
    run_calibration(stored, out)
    run_rating_scale(spark, out)
    run_validation(stored, out)
    run_summaries(spark, out)
