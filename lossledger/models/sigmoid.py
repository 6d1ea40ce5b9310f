"""Logistic curve over a margin with smoothed targets, by Newton steps from grouped statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.session import materialize

STEPS, TOLERANCE, HALVINGS = 50, 1e-12, 30


@dataclass(frozen=True)
class SigmoidFit:
    """1 / (1 + exp(-(slope * margin + intercept)))."""

    slope: float
    intercept: float

    def calibrated(self, margin: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * margin + F.lit(self.intercept))))


def grouped(rows: DataFrame, margin: str = "margin", label: str = "label") -> DataFrame:
    """(margin, n, pos): rows of one margin are one row with counts; all later passes read these."""
    known = rows.filter(F.col(margin).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(margin).alias("margin")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("pos")
    )


def smoothed(pos: float, neg: float) -> tuple[float, float]:
    """Targets of positive and negative rows."""
    return (pos + 1) / (pos + 2), 1 / (neg + 2)


def statistics(table: DataFrame, fit: SigmoidFit, high: float, low: float) -> dict[str, float]:
    """Loss, score (g1 for the slope, g0 for the intercept) and Hessian (h11, h10, h00) at a fit, in one aggregate."""
    m, z = F.col("margin"), F.lit(fit.slope) * F.col("margin") + F.lit(fit.intercept)
    p = 1 / (1 + F.exp(-z))
    target = F.col("pos") * high + (F.col("n") - F.col("pos")) * low
    # log(1 + exp(z)) without overflow
    soft = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
    wrong, spread = F.col("n") * p - target, F.col("n") * p * (1 - p)
    found = table.agg(
        F.sum(F.col("n") * soft - target * z).alias("loss"),
        F.sum(wrong * m).alias("g1"), F.sum(wrong).alias("g0"),
        F.sum(spread * m * m).alias("h11"), F.sum(spread * m).alias("h10"), F.sum(spread).alias("h00"),
    ).first().asDict()
    return {k: v or 0.0 for k, v in found.items()}


def fit_grouped(table: DataFrame) -> SigmoidFit:
    """The maximum of the likelihood of smoothed targets over `grouped` rows.

    A step that does not lower the loss is halved. A single margin has no slope of its own: the curve is flat there.
    """
    facts = table.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.min("margin").alias("low"), F.max("margin").alias("high")).first()
    if not facts["n"]:
        raise ValueError("no rows to calibrate on")
    high, low = smoothed(facts["pos"], facts["n"] - facts["pos"])
    rate = (facts["pos"] * high + (facts["n"] - facts["pos"]) * low) / facts["n"]
    fit = SigmoidFit(0.0, math.log(rate / (1 - rate)))
    if facts["low"] == facts["high"]:
        return fit
    here = statistics(table, fit, high, low)
    for _ in range(STEPS):
        det = here["h11"] * here["h00"] - here["h10"] ** 2
        if det <= 0:
            break
        slope = (here["h00"] * here["g1"] - here["h10"] * here["g0"]) / det
        intercept = (here["h11"] * here["g0"] - here["h10"] * here["g1"]) / det
        size = 1.0
        for _ in range(HALVINGS):
            there = SigmoidFit(fit.slope - size * slope, fit.intercept - size * intercept)
            found = statistics(table, there, high, low)
            if found["loss"] <= here["loss"] + 1e-12 * abs(here["loss"]):
                break
            size /= 2
        else:
            break
        fit, here = there, found
        if max(abs(size * slope), abs(size * intercept)) <= TOLERANCE * (1 + abs(fit.slope) + abs(fit.intercept)):
            break
    return fit


def fit(rows: DataFrame, margin: str = "margin", label: str = "label") -> SigmoidFit:
    return fit_grouped(materialize(grouped(rows, margin, label)))


def fit_report(rows: DataFrame, margin: str = "margin", label: str = "label") -> DataFrame:
    """slope, intercept, both score equations (0 at the fit), mean calibrated and mean smoothed target: one row."""
    table = materialize(grouped(rows, margin, label))
    found = fit_grouped(table)
    facts = table.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).first()
    high, low = smoothed(facts["pos"], facts["n"] - facts["pos"])
    n, pos, m = F.col("n"), F.col("pos"), F.col("margin")
    p, target = found.calibrated(m), pos * high + (n - pos) * low
    return table.agg(
        F.lit(found.slope).alias("slope"), F.lit(found.intercept).alias("intercept"),
        (F.sum((n * p - target) * m) / F.sum("n")).alias("slope_score"), (F.sum(n * p - target) / F.sum("n")).alias("intercept_score"),
        (F.sum(n * p) / F.sum("n")).alias("mean_calibrated"), (F.sum(target) / F.sum("n")).alias("mean_target"),
    )
