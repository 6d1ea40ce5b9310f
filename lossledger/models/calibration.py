"""Probability calibration of the logistic PD model on the validation split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.models import isotonic, sigmoid
from lossledger.models.preprocessing import SCALED, fit_preprocessor, typed_features
from lossledger.models.training import PD_SPEC, estimators, prepare, with_label
from lossledger.operators import backtesting, metrics, splitting
from lossledger.session import materialize

METHODS = ["sigmoid", "isotonic"]
#: What says that a method cannot be fitted on its rows, or that there is no such method.
UNFITTED = (ValueError, ArithmeticError, LookupError, RuntimeError)
#: What says that Spark did not do its work: a lost job is no property of a method, and the whole run fails with it.
BROKEN_RUN = (PySparkException, Py4JError)


@dataclass(frozen=True)
class CalibrationResult:
    """Out-of-time metrics per method, the long out-of-time scores (model, predicted_pd, target), and the reason of each
    method that could not be fitted."""

    metrics: DataFrame
    scores: DataFrame
    failed: Mapping[str, str] = field(default_factory=dict)

    def before_after(self) -> DataFrame:
        """Calibration by score bin. A method that could not be fitted has a row without bin and figures, and the reason."""
        report = backtesting.calibration_by_score_bin(self.scores)
        if not self.failed:
            return report
        missing = self.scores.sparkSession.createDataFrame(list(self.failed.items()), "model string, error string")
        return report.withColumn("error", F.lit(None).cast("string")).unionByName(missing, allowMissingColumns=True)


def fit_sigmoid(valid: DataFrame, margin: str = "margin", label: str = "label"):
    """Logistic curve over the margin with smoothed targets."""
    curve = sigmoid.fit(valid, margin, label)
    return lambda rows: rows.withColumn("calibrated", curve.calibrated(F.col(margin)))


def fit_isotonic(valid: DataFrame, margin: str = "margin", label: str = "label"):
    """Rising steps over the margin."""
    steps = isotonic.fit(valid, margin, label)
    if steps.isEmpty():
        raise ValueError("no rows to calibrate on")
    return lambda rows: isotonic.calibrated(rows, steps, margin)


FITTERS = {"sigmoid": fit_sigmoid, "isotonic": fit_isotonic}


def calibrate_margins(
    valid: DataFrame, oot: DataFrame, methods: Sequence[str] = METHODS, target: str = PD_SPEC.target
) -> CalibrationResult:
    """Compare the raw probability with each calibration of its margin.

    Both frames have margin, label and raw (probability) columns. A method that cannot be fitted
    gets a row without metrics and the reason. A failure of Spark is raised: rows without a method
    would look like a result.
    """
    spark = oot.sparkSession
    scored = {"raw": oot.withColumn("calibrated", F.col("raw"))}
    failed: dict[str, str] = {}
    for method in methods:
        try:
            scored[method] = FITTERS[method](valid)(oot)
        except BROKEN_RUN:
            raise
        except UNFITTED as error:
            failed[method] = str(error)
    parts = [
        rows.select(
            F.lit(method).alias("model"), F.col("calibrated").alias("predicted_pd"), F.col("label").cast("int").alias(target)
        )
        for method, rows in scored.items()
    ]
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    scores = materialize(scores)

    report = metrics.binary_metrics(scores, "predicted_pd", target, by=["model"])
    if failed:
        report = report.withColumn("error", F.lit(None).cast("string"))
        facts = oot.agg(F.count(F.lit(1)).alias("rows"), F.avg("label").alias("rate")).first()
        missing = spark.createDataFrame(list(failed.items()), "model string, error string").select(
            "*", F.lit(facts["rows"]).alias("rows"), F.lit(facts["rate"]).alias("observed_default_rate")
        )
        report = report.unionByName(missing, allowMissingColumns=True)
    method = F.col("model")
    named = report.withColumns(
        {
            "calibration_method": F.when(method == "raw", "none").otherwise(method),
            "split": F.lit("oot"),
            "model": F.concat(
                F.lit("logistic_regression_"), method, F.when(method == "raw", "").otherwise("_calibrated")
            ),
        }
    )
    head = ["model", "calibration_method", "split", "rows"]
    return CalibrationResult(named.select(*head, *[c for c in report.columns if c not in head]), scores, failed)


def calibrate_pd(sample: DataFrame, methods: Sequence[str] = METHODS, max_fit_rows: int | None = None) -> CalibrationResult:
    """Fit the logistic model on train, calibrate it on valid, compare out of time."""
    prepared, _, _ = prepare(sample, PD_SPEC)
    typed = lambda df: with_label(typed_features(df, prepared.numeric, prepared.categorical), PD_SPEC)
    rows, train = typed(prepared.split), typed(prepared.train(PD_SPEC, max_fit_rows))
    preprocessor = fit_preprocessor(train, prepared.numeric, prepared.categorical)
    vectors = preprocessor.transform(train).select("label", SCALED).persist()
    estimator = estimators(PD_SPEC, vectors.count(), 1.0)["logistic_regression"]
    model = estimator.fit(vectors)
    vectors.unpersist()
    margins = model.transform(preprocessor.transform(rows.filter(F.col("split") != "train"))).select(
        "split",
        "label",
        vector_to_array(F.col("_margin_logistic_regression"))[1].alias("margin"),
        vector_to_array(F.col("_probability_logistic_regression"))[1].alias("raw"),
    )
    stored = materialize(margins)
    return calibrate_margins(splitting.split_part(stored, "valid"), splitting.split_part(stored, "oot"), methods)
