"""Metrics, backtesting, calibration, stability against brute force and golden values."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossledger.operators import backtesting, master_scale, metrics, reports, stability


def brute_binary(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    cuts = np.unique(s)
    ks = max(max((pos >= c).mean() - (neg >= c).mean() for c in cuts), 0)
    ap, recall = 0.0, 0.0
    for c in cuts[::-1]:
        new = (pos >= c).mean()
        ap += (new - recall) * (pos >= c).sum() / (s >= c).sum()
        recall = new
    return auc, ks, ap, ((s - y) ** 2).mean()


def test_binary_metrics_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for group in ("a", "b"):
        for _ in range(400):
            score = 0.3 if rng.random() < 0.4 else round(rng.random(), 2)
            rows.append((group, score, int(rng.random() < score)))
    rows += [("one_class", rng.random(), 0) for _ in range(5)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r["g"]: r for r in metrics.binary_metrics(df, "s", "y", by=["g"]).collect()}
    for group in ("a", "b"):
        y, s = zip(*[(y, s) for g, s, y in rows if g == group])
        auc, ks, ap, brier = brute_binary(y, s)
        r = got[group]
        assert r["roc_auc"] == pytest.approx(auc) and r["gini"] == pytest.approx(2 * auc - 1)
        assert r["ks"] == pytest.approx(ks) and r["average_precision"] == pytest.approx(ap)
        assert r["brier_score"] == pytest.approx(brier) and r["rows"] == 400
        assert r["mean_predicted_pd"] == pytest.approx(np.mean(s)) and r["observed_default_rate"] == pytest.approx(np.mean(y))
    assert [got["one_class"][m] for m in metrics.RANK_METRICS] == [None] * 4
    assert got["one_class"]["observed_default_rate"] == 0


def test_perfect_ranking(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, s double")
    r = metrics.binary_metrics(df, "s", "y").first()
    assert (r["roc_auc"], r["gini"], r["ks"], r["observed_default_rate"]) == (1, 1, 1, 0.5)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.5), (2.0, 2.5, None), (3.0, 2.5, 4.0)], "y double, p double, w double")
    r = metrics.regression_metrics(df, "y", "p", "w").first()
    assert r["mae"] == pytest.approx(1 / 3) and r["rmse"] == pytest.approx(0.408248, abs=1e-6)
    assert r["weighted_mae"] == pytest.approx((0 * 1 + 0.5 * 1 + 0.5 * 4) / 6)


def test_best_model(spark):
    df = spark.createDataFrame([("b", "oot", 0.6), ("a", "oot", 0.6), ("c", "oot", None), ("z", "train", 0.9)], "model string, split string, roc_auc double")
    assert metrics.best_model(df, "roc_auc", True).first()["model"] == "a"
    assert metrics.best_model(df, "roc_auc", False).first()["model"] == "a"


def predictions(spark, scores, targets):
    rows = [(f"F{i:04}", t, s) for i, (s, t) in enumerate(zip(scores, targets))]
    return spark.createDataFrame(rows, "facility_id string, target_default_12m int, pd_model double")


def test_backtest_by_grade(spark):
    df = predictions(spark, [0.001, 0.003, 0.02, 0.2, None], [0, 1, 0, 1, 1])
    got = backtesting.pd_backtest_by_grade(df, "pd_model").collect()
    assert [(r["rating_grade"], r["facilities"], r["defaults"]) for r in got] == [("A", 2, 1), ("C", 1, 0), ("F", 1, 1)]
    for r in got:
        assert r["calibration_error"] == pytest.approx(r["avg_predicted_pd"] - r["observed_default_rate"])
        assert 0 <= r["observed_default_rate_lower_ci"] <= r["observed_default_rate"] <= r["observed_default_rate_upper_ci"] <= 1
    bands = backtesting.confidence_bands(backtesting.pd_backtest_by_grade(df, "pd_model")).collect()
    assert [r["grade_order"] for r in bands] == [1, 3, 6] and all(r["lower_error"] >= 0 for r in bands)
    long = backtesting.actual_vs_predicted(backtesting.pd_backtest_by_grade(df, "pd_model"), "rating_grade", "observed_default_rate", "avg_predicted_pd")
    assert long.count() == 6


def test_grade_summary_keeps_all_grades(spark):
    got = backtesting.rating_grade_summary(predictions(spark, [0.001, 0.02, 0.2], [0, 0, 1]), "pd_model").collect()
    assert [r["rating_grade"] for r in got] == list("ABCDEF")
    assert sum(r["facilities"] for r in got) == 3 and sum(r["observed_defaults"] for r in got) == 1
    assert got[1]["facilities"] == 0 and got[1]["avg_predicted_pd"] is None


def test_monotonicity(spark):
    report = spark.createDataFrame([("A", 100, 0.01), ("B", 100, 0.05), ("C", 100, 0.03)], "rating_grade string, facilities int, observed_default_rate double")
    summary = backtesting.monotonicity_summary(report).first()
    assert (summary["ratings_checked"], summary["is_monotonic"], summary["violations_count"]) == (3, False, 1)
    violation = backtesting.monotonicity_violations(report).first()
    assert (violation["previous_grade"], violation["current_grade"]) == ("B", "C")
    within_tolerance = report.withColumn("observed_default_rate", F.when(F.col("rating_grade") == "C", 0.05 - 1e-14).otherwise(F.col("observed_default_rate")))
    tolerant = backtesting.monotonicity_summary(within_tolerance).first()
    assert tolerant["is_monotonic"] is True and tolerant["violations_count"] == 1
    assert backtesting.monotonicity_summary(report, min_facilities=101).first()["is_monotonic"] is True


def test_binomial_backtest(spark):
    report = spark.createDataFrame([("A", 100, 1, 0.01, 0.01), ("B", 100, 10, 0.03, 0.10)], "rating_grade string, facilities int, defaults int, avg_predicted_pd double, observed_default_rate double")
    a, b = backtesting.binomial_backtest(report).orderBy("rating_grade").collect()
    assert a["expected_defaults"] == pytest.approx(1) and a["traffic_light"] == "GREEN" and b["traffic_light"] == "RED"
    assert b["binomial_p_value"] == pytest.approx(math.erfc(7 / math.sqrt(2.91) / math.sqrt(2)), rel=1e-5)


def test_pd_calibration_bins(spark):
    rng = random.Random(2)
    scores = [0.05 if rng.random() < 0.4 else rng.random() for _ in range(503)]
    targets = [int(rng.random() < s) for s in scores]
    got = backtesting.pd_calibration_by_bin(predictions(spark, scores, targets), "pd_model").collect()
    ranks = pd.Series(scores).rank(method="first")  # ties in order of facility_id
    frame = pd.DataFrame({"bin": pd.qcut(ranks, 10, labels=False) + 1, "s": scores, "t": targets})
    expected = frame.groupby("bin").agg(n=("t", "size"), d=("t", "sum"), low=("s", "min"), high=("s", "max"))
    assert [(r["facilities"], r["defaults"], r["min_predicted_pd"], r["max_predicted_pd"]) for r in got] == [tuple(r) for r in expected.itertuples(index=False)]
    constant = backtesting.pd_calibration_by_bin(predictions(spark, [0.1] * 10, [0] * 10), "pd_model").collect()
    assert [(r["pd_decile"], r["facilities"]) for r in constant] == [(1, 10)]


def test_score_bins_drop_duplicate_edges(spark):
    rng = random.Random(4)
    sets = {"raw": [rng.random() for _ in range(200)], "steps": [rng.choice([0.01, 0.02, 0.05]) for _ in range(200)], "tied": [0.5 if i % 3 else rng.random() for i in range(200)], "flat": [0.1] * 200}
    rows = [(m, s, i % 2) for m, scores in sets.items() for i, s in enumerate(scores)]
    report = backtesting.calibration_by_score_bin(spark.createDataFrame(rows, "model string, predicted_pd double, target_default_12m int"))
    got = {}
    for r in report.collect():
        got.setdefault(r["model"], []).append(r["facilities"])
    for model, scores in sets.items():
        bins = min(10, len(set(scores)))
        cut = pd.Series(1, index=range(200)) if bins < 2 else pd.qcut(pd.Series(scores), q=bins, labels=False, duplicates="drop")
        assert got[model] == list(cut.groupby(cut).size()), model
    assert backtesting.mean_observed_by_bin(report).count() == 10


def severity(spark):
    rows = [("1", "term_loan", "none", 0.5, 0.4, 100.0), ("2", "term_loan", None, 0.7, 0.6, 300.0), ("3", "overdraft", "none", 0.2, 0.3, 50.0)]
    return spark.createDataFrame(rows, "facility_id string, product_type string, collateral_type string, actual double, predicted double, ead_at_default double")


def test_segment_and_product_reports(spark):
    got = backtesting.segment_report(severity(spark), "actual", "predicted", "lgd", ["product_type", "collateral_type", "absent"]).collect()
    assert [(r["segment_type"], r["segment"], r["facilities"]) for r in got] == [
        ("collateral_type", "none", 2), ("collateral_type", None, 1), ("product_type", "term_loan", 2), ("product_type", "overdraft", 1),
    ]
    assert got[2]["total_ead"] == 400 and got[2]["avg_ead"] == 200 and got[2]["prediction_error"] == pytest.approx(-0.1)
    product = backtesting.product_report(severity(spark), "actual", "predicted", "ccf").collect()
    assert [r["product_type"] for r in product] == ["term_loan", "overdraft"] and sum(r["facilities"] for r in product) == 3


def test_severity_bins(spark):
    df = spark.range(10).select(F.col("id").alias("facility_id"), (F.col("id") / 10).alias("actual"), (F.col("id") / 12).alias("predicted"), F.lit(100.0).alias("ead_at_default"))
    got = backtesting.severity_calibration_by_bin(df, "actual", "predicted", "lgd").collect()
    assert [r["facilities"] for r in got] == [2] * 5 and sum(r["total_ead"] for r in got) == 1000


def psi_by_hand(expected, actual, bins=10):
    edges = np.unique(np.quantile(expected, np.arange(bins + 1) / bins))[1:-1]
    def shares(x):
        counts = np.bincount(np.searchsorted(edges, x, side="left"), minlength=len(edges) + 1)
        return np.maximum(counts / counts.sum(), 1e-6)
    e, a = shares(expected), shares(actual)
    return float(((a - e) * np.log(a / e)).sum())


def test_psi_brute_force(spark):
    rng = np.random.default_rng(8)
    train = pd.DataFrame({"x": rng.normal(size=700), "flag": rng.integers(0, 2, 700).astype(float), "hot": np.where(rng.random(700) < 0.5, 0.0, rng.normal(size=700)), "flat": 1.0})
    oot = pd.DataFrame({"x": rng.normal(0.4, 1, 300), "flag": rng.integers(0, 2, 300).astype(float), "hot": rng.normal(size=300), "flat": 2.0})
    train.loc[:69, "x"] = None
    e = spark.createDataFrame(train.astype(object).where(train.notna(), None), "x double, flag double, hot double, flat double")
    a = spark.createDataFrame(oot)
    details = stability.psi_details(e, a, ["x", "flag", "hot", "flat", "absent"])
    got = {r["feature"]: r for r in stability.psi_summary(details).collect()}
    for name in ("x", "flag", "hot"):
        assert got[name]["psi"] == pytest.approx(psi_by_hand(train[name].dropna(), oot[name]), abs=1e-9), name
    assert got["flat"]["psi"] == 0 and got["x"]["expected_missing_rate"] == pytest.approx(0.1)
    assert list(got)[0] == max(got, key=lambda n: got[n]["psi"])
    rows = stability.top_psi_details(details, 0)
    sums = {r["feature"]: (r[1], r[2]) for r in rows.groupBy("feature").agg(F.sum("expected_count"), F.sum("actual_count")).collect()}
    assert sums == {"x": (630, 300), "flag": (700, 300), "hot": (700, 300), "flat": (700, 300)}
    assert stability.top_psi_details(details, 1).select("feature").distinct().count() == 1


def test_psi_identity_shift_and_empty(spark):
    def frame(values):
        return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    assert stability.psi(frame(range(1, 6)), frame(range(1, 6)), "x").first()["psi"] == 0
    assert stability.psi(frame(range(1, 9)), frame(range(10, 18)), "x").first()["psi"] > 0
    empty = stability.psi(frame([None, None]), frame([1]), "x").first()
    assert empty["psi"] is None and empty["expected_missing_rate"] == 1


SUMMARY = [("A", 100, 1, 0.01, 0.004, 0.001, 0.0049), ("E", 80, 10, 0.125, 0.10, 0.08, 0.14), ("F", 10, 2, 0.2, 0.3, 0.2, 0.4)]
SUMMARY_SCHEMA = (
    "rating_grade string, facilities int, observed_defaults int, observed_default_rate double, avg_predicted_pd double, "
    "min_predicted_pd double, max_predicted_pd double"
)


def test_alternative_scale(spark):
    summary = spark.createDataFrame(SUMMARY, SUMMARY_SCHEMA)
    mapping = master_scale.alternative_mapping(summary)
    assert {r["original_rating_grade"]: r["alternative_rating_grade"] for r in mapping.collect()} == {"A": "A", "E": "E_F", "F": "E_F"}
    merged = {r["alternative_rating_grade"]: r for r in master_scale.alternative_backtest(summary, mapping).collect()}["E_F"]
    assert (merged["facilities"], merged["observed_defaults"]) == (90, 12)
    assert merged["avg_predicted_pd"] == pytest.approx((80 * 0.10 + 10 * 0.3) / 90)
    kept = master_scale.alternative_mapping(summary, min_bucket_size=10).collect()
    assert {r["rule"] for r in kept} == {"unchanged"}
    with pytest.raises(ValueError):
        master_scale.alternative_mapping(summary.drop("facilities"))


@pytest.fixture()
def report_set(spark):
    def one(row):
        return spark.createDataFrame([row])
    pd_row = dict(model="lr", split="oot", roc_auc=0.66, gini=0.31, ks=0.18, brier_score=0.09)
    severity_row = dict(model="rf", split="oot", mae=0.1, rmse=0.2, weighted_mae=0.15)
    return {
        "pd_model_metrics": spark.createDataFrame([pd_row, {**pd_row, "model": "dummy", "roc_auc": 0.5}, {**pd_row, "split": "train", "roc_auc": 0.9}]),
        "lgd_model_metrics": one(severity_row),
        "ead_ccf_model_metrics": one(severity_row),
        "validation_psi_summary": spark.createDataFrame([("a", 0.2), ("b", 0.1), ("c", None)], "feature string, psi double"),
        "validation_rating_monotonicity_summary": one(dict(violations_count=1)),
        "validation_rating_binomial_backtesting": spark.createDataFrame([("RED",), ("RED",), ("RED",)], "traffic_light string"),
        "ifrs9_ecl_portfolio_summary": one(dict(facilities=10, total_ead=1234567890.125, total_ecl=5.0, ecl_rate=0.05, stage_1_share=0.8, stage_2_share=0.4, stage_3_share=0.3)),
        "stress_scenario_summary": spark.createDataFrame([("severe_downturn", 9.0, 0.4), ("base", 5.0, 0.0)], "scenario string, total_ecl double, ecl_change_pct_vs_base double"),
        "data_quality_summary": spark.createDataFrame([("FAIL",), ("WARN",), ("PASS",)], "status string"),
    }


def test_traffic_lights(report_set):
    got = {r["metric"]: (r["value"], r["status"]) for r in reports.traffic_lights(report_set).collect()}
    assert len(got) == 11
    assert got["pd_oot_gini"] == (0.31, "GREEN") and got["pd_oot_ks"][1] == "AMBER" and got["pd_brier_score"][1] == "RED"
    assert got["max_feature_psi"] == (0.2, "AMBER") and got["rating_binomial_red_count"] == (3, "RED")
    assert got["stage_2_share"][1] == "AMBER" and got["stage_3_share"][1] == "RED" and got["data_quality_fail_count"][1] == "AMBER"


def test_optional_and_required_reports(report_set):
    fewer = {k: v for k, v in report_set.items() if k not in reports.OPTIONAL_REPORTS}
    assert reports.traffic_lights(fewer).count() == 8
    assert reports.executive_summary(fewer).count() == 25
    with pytest.raises(FileNotFoundError):
        reports.traffic_lights({k: v for k, v in report_set.items() if k != "validation_psi_summary"})


def test_executive_summary(report_set):
    got = {(r["area"], r["metric"]): r["value"] for r in reports.executive_summary(report_set).collect()}
    assert len(got) == 28
    assert got["PD", "best_oot_model"] == "lr" and got["IFRS9_ECL", "portfolio_facilities"] == "10"
    assert got["IFRS9_ECL", "portfolio_total_ead"] == "1234567890.13" and got["Monitoring", "max_psi_feature"] == "a"
