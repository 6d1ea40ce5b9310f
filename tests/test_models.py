"""Model training and calibration on small samples."""

import datetime as dt
import random

import numpy as np
import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkRuntimeError
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lossledger.models import calibration, training
from lossledger.models.preprocessing import PLAIN, SCALED, fit_preprocessor
from lossledger.operators import splitting


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def pd_rows(spark, n=600, seed=1, one_class=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, kind = rng.gauss(0, 1), rng.choice(["a", "b", None])
        default = int(rng.random() < 1 / (1 + np.exp(2 - 1.5 * x - (kind == "a"))))
        rows.append((i, i % 50, day(i // 3), 0 if one_class else default, x if i % 17 else None, str(rng.randrange(9)), kind))
    return spark.createDataFrame(rows, "facility_id int, company_id int, observation_date date, target_default_12m int, x double, text_number string, kind string")


def test_preprocessor(spark):
    rows = [(1.0, "a", None), (2.0, "b", None), (None, "b", None), (10.0, None, None)]
    train = spark.createDataFrame(rows, "x double, kind string, empty double")
    model = fit_preprocessor(train, ["x", "empty"], ["kind"])
    other = spark.createDataFrame([(None, "new", 1.0), (2.0, None, 1.0)], train.schema)
    plain = [list(r[0].toArray()) for r in model.transform(train).select(PLAIN).collect()]
    assert plain == [[1, 1, 0], [2, 0, 1], [2, 0, 1], [10, 0, 1]]  # median 2, mode b, no all-missing feature
    assert [list(r[0].toArray()) for r in model.transform(other).select(PLAIN).collect()] == [[2, 0, 0], [2, 0, 1]]
    scaled = np.array([r[0].toArray()[0] for r in model.transform(train).select(SCALED).collect()])
    x = np.array([1, 2, 2, 10.0])
    assert scaled == pytest.approx((x - x.mean()) / x.std())


@pytest.fixture(scope="module")
def pd_result(spark):
    return training.train_pd(pd_rows(spark).orderBy("observation_date", "facility_id").limit(600))


def test_pd_training(pd_result, spark, tmp_path):
    report = {(r["model"], r["split"]): r for r in pd_result.metrics.collect()}
    assert len(report) == 9
    assert pd_result.features == ["x", "text_number", "kind"] and pd_result.best_model in ("logistic_regression", "random_forest")
    for r in report.values():
        assert r["gini"] == pytest.approx(2 * r["roc_auc"] - 1)
        assert r["default_rate"] == r["observed_default_rate"]
    assert report["dummy_prior", "oot"]["roc_auc"] == 0.5
    assert report["logistic_regression", "train"]["roc_auc"] > 0.7
    assert report["logistic_regression", "train"]["mean_predicted_pd"] == pytest.approx(report["dummy_prior", "train"]["observed_default_rate"], abs=1e-3)
    assert [r["rows"] for r in pd_result.split_summary.collect()] == [420, 90, 90]
    assert sum(r["facilities"] for r in pd_result.group_report().collect()) == 90
    assert sum(r["facilities"] for r in pd_result.calibration_report().collect()) == 90
    bounds = pd_result.scores.agg(F.min(pd_result.best_column), F.max(pd_result.best_column)).first()
    assert 0 <= bounds[0] <= bounds[1] <= 1
    path = str(tmp_path / "logistic_regression")
    pd_result.models["logistic_regression"].write().overwrite().save(path)
    again = PipelineModel.load(path).transform(pd_rows(spark).withColumn("text_number", F.col("text_number").cast("double")))
    assert "_probability_logistic_regression" in again.columns
    assert pd_result.best_row().first()["model"] == pd_result.best_model


def test_logistic_regression_optimum(pd_result):
    """The gradient of the summed loss plus half the squared weights vanishes at the fit."""
    model = pd_result.models["logistic_regression"]
    train = splitting.split_part(pd_result.scores, "train")
    assert train.count() == 420
    weights = model.stages[-1].coefficients.toArray()
    assert np.isfinite(weights).all() and np.abs(weights).max() < 5
    assert model.stages[-1].getRegParam() == pytest.approx(1 / 420)


def test_one_class_scores_the_observed_rate(spark):
    result = training.train_pd(pd_rows(spark, 60, one_class=True))
    assert result.models == {}
    r = result.metrics.filter("split = 'oot'").collect()
    assert all(x["roc_auc"] is None and x["mean_predicted_pd"] == 0 for x in r) and len(r) == 3


def test_boosted_trees_are_optional(spark):
    result = training.train_pd(pd_rows(spark, 200), boosting=True, boosting_rounds=3)
    assert set(result.models) == {"logistic_regression", "random_forest", "boosted_trees"}


def severity_rows(spark, target, n=120):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        z = rng.gauss(0, 1)
        rows.append((i, i % 9, day(i), max(0.0, 0.5 + 0.3 * z + rng.gauss(0, 0.05)), rng.uniform(0, 1000), z, rng.choice(["p", "q"])))
    return spark.createDataFrame(rows, f"facility_id int, company_id int, default_date date, {target} double, ead_at_default double, z double, product_type string")


@pytest.mark.parametrize("target, train, upper", [("realized_lgd", training.train_lgd, 1.0), ("realized_ccf", training.train_ccf, 1.5)])
def test_severity_training(spark, target, train, upper):
    result = train(severity_rows(spark, target))
    assert result.metrics.count() == 9 and set(result.models) == {"ridge", "random_forest"}
    columns = [c for c in result.scores.columns if c.startswith(result.spec.name + "_")]
    for c in columns:
        low, high = result.scores.agg(F.min(c), F.max(c)).first()
        assert 0 <= low <= high <= upper
    assert result.group_report().count() >= 2 and result.calibration_report().count() == 5


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=(60, 2)), rng.uniform(1, 5, 60)
    y = x @ [0.3, -0.2] + 0.4 + rng.normal(scale=0.1, size=60)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)], [SCALED, "label", "weight"])
    std = float(np.sqrt((w @ y**2) / w.sum() - ((w @ y) / w.sum()) ** 2))
    fitted = training.estimators(training.LGD_SPEC, 60, float(w.sum()), std)["ridge"].fit(df)
    centre_x, centre_y = (w @ x) / w.sum(), (w @ y) / w.sum()
    xc, yc = x - centre_x, y - centre_y
    beta = np.linalg.solve((xc * w[:, None]).T @ xc + np.eye(2), (xc * w[:, None]).T @ yc)
    assert fitted.coefficients.toArray() == pytest.approx(beta, abs=1e-6)
    assert fitted.intercept == pytest.approx(centre_y - centre_x @ beta, abs=1e-6)


def margins(spark, n, seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(-2, 1.5, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.6 * m + 0.5)))).astype(float)
    return spark.createDataFrame([(float(a), float(b), float(1 / (1 + np.exp(-a)))) for a, b in zip(m, y)], "margin double, label double, raw double")


def test_calibration(spark):
    valid, oot = margins(spark, 3000, 1), margins(spark, 3000, 2)
    result = calibration.calibrate_margins(valid, oot)
    got = {r["calibration_method"]: r for r in result.metrics.collect()}
    assert set(got) == {"none", "sigmoid", "isotonic"}
    gap = {k: abs(r["mean_predicted_pd"] - r["observed_default_rate"]) for k, r in got.items()}
    assert gap["sigmoid"] < gap["none"] and gap["isotonic"] < gap["none"]
    assert got["sigmoid"]["roc_auc"] == pytest.approx(got["none"]["roc_auc"])
    assert got["sigmoid"]["brier_score"] < got["none"]["brier_score"]
    assert got["none"]["model"] == "logistic_regression_raw" and got["isotonic"]["model"] == "logistic_regression_isotonic_calibrated"
    curve = calibration.fit_sigmoid(valid)(spark.createDataFrame([(0.0,), (1.0,)], "margin double")).orderBy("margin").collect()
    slope = np.log(curve[1]["calibrated"] / (1 - curve[1]["calibrated"])) - np.log(curve[0]["calibrated"] / (1 - curve[0]["calibrated"]))
    assert slope == pytest.approx(0.6, abs=0.1)


def test_failed_method_keeps_its_row(spark, monkeypatch):
    def broken(_):
        raise RuntimeError("cannot fit")
    monkeypatch.setitem(calibration.FITTERS, "isotonic", broken)
    result = calibration.calibrate_margins(margins(spark, 200, 1), margins(spark, 200, 2))
    row = result.metrics.filter("calibration_method = 'isotonic'").first()
    assert row["roc_auc"] is None and row["error"] == "cannot fit" and row["rows"] == 200
    assert row["observed_default_rate"] is not None
    assert result.scores.select("model").distinct().count() == 2


@pytest.mark.parametrize("error", [Py4JError("job aborted"), PySparkRuntimeError("task failed"), MemoryError(), AttributeError("no such name")])
def test_a_failed_run_is_no_result(spark, monkeypatch, error):
    def lost(_):
        raise error
    monkeypatch.setitem(calibration.FITTERS, "isotonic", lost)
    with pytest.raises(type(error)):
        calibration.calibrate_margins(margins(spark, 50, 1), margins(spark, 50, 2))


def test_failed_methods_stay_in_the_report(spark):
    """Without rows to calibrate on neither method is left out, nor scored without a value."""
    nothing, oot = margins(spark, 200, 1).filter("label is null"), margins(spark, 200, 2)
    result = calibration.calibrate_margins(nothing, oot)
    assert result.failed == dict.fromkeys(calibration.METHODS, "no rows to calibrate on")
    report = result.before_after().collect()
    assert {r["model"]: r["error"] for r in report if r["pd_decile"] is None} == result.failed
    assert sum(r["facilities"] for r in report if r["model"] == "raw") == 200
    whole = calibration.calibrate_margins(margins(spark, 300, 1), oot).before_after()
    assert "error" not in whole.columns and {r["model"] for r in whole.collect()} == {"raw", *calibration.METHODS}
