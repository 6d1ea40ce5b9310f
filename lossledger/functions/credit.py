"""Credit-risk scalar expressions: grades, flags, intervals, test statistics, statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.numeric import clip, number

# Rating scale in order, and upper PD cut-offs of the grades A to E.
RATING_SCALE = ["A", "B", "C", "D", "E", "F", "Default"]
PD_GRADES = ["A", "B", "C", "D", "E", "F"]
PD_CUTOFFS = [0.005, 0.015, 0.035, 0.075, 0.150]
TRUE_WORDS = ["1", "true", "yes", "y"]
WILSON_Z = 1.96

# Coefficients of the rational-exponential erfc approximation (Numerical Recipes, "erfcc"),
# lowest power first.
ERFC_COEFFICIENTS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def rating_order(grade: Column) -> Column:
    """Position of a grade in the scale, NULL for an unknown or missing grade."""
    scale = F.array(*[F.lit(g) for g in RATING_SCALE])
    return F.nullif(F.array_position(scale, grade), F.lit(0)).cast("int")


def rating_downgrade(origination: Column, current: Column) -> Column:
    return rating_order(current) - rating_order(origination)


def pd_grade(pd: Column) -> Column:
    """Grade of a PD; cut-offs belong to the worse grade, a missing PD is graded F."""
    chain = F.when(pd < PD_CUTOFFS[0], PD_GRADES[0])
    for grade, cutoff in zip(PD_GRADES[1:], PD_CUTOFFS[1:]):
        chain = chain.when(pd < cutoff, grade)
    return chain.otherwise(PD_GRADES[-1])


def flag_is_true(df: DataFrame, name: str) -> Column:
    """Flag of any type as boolean: words for text, non-zero for numbers, false when missing or absent."""
    if name not in df.columns:
        return F.lit(False)
    flag = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        truth = F.lower(F.trim(flag)).isin(TRUE_WORDS)
    elif isinstance(kind, T.BooleanType):
        truth = flag
    else:
        truth = number(flag) != 0
    return F.coalesce(truth, F.lit(False))


def wilson_bounds(events: Column, trials: Column, z: float = WILSON_Z) -> tuple[Column, Column]:
    """Wilson score interval of a rate, NULL when there are no trials."""
    n = F.when(trials > 0, trials.cast("double"))
    rate = events / n
    z2 = z * z
    scale = 1 + z2 / n
    centre = (rate + z2 / (2 * n)) / scale
    half_width = z * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n)) / scale
    return clip(centre - half_width, lower=0.0), clip(centre + half_width, upper=1.0)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, relative error below 1.2e-7."""
    t = 1 / (1 + x * 0.5)
    polynomial = F.lit(ERFC_COEFFICIENTS[-1])
    for coefficient in reversed(ERFC_COEFFICIENTS[:-1]):
        polynomial = polynomial * t + coefficient
    return t * F.exp(polynomial - x * x)


def binomial_p_value(events: Column, trials: Column, expected_rate: Column) -> Column:
    """Two-sided p-value of a binomial count, normal approximation."""
    n = F.when(trials > 0, trials.cast("double"))
    p = clip(expected_rate, 1e-9, 1 - 1e-9)
    z = (events - n * p) / F.sqrt(n * p * (1 - p))
    return clip(erfc(F.abs(z) / F.sqrt(F.lit(2.0))), 0.0, 1.0)


def p_value_light(p_value: Column) -> Column:
    return status_min_good(p_value, 0.05, 0.01)


def status_min_good(value: Column, green_min: float, amber_min: float) -> Column:
    return (
        F.when(value.isNull(), "UNKNOWN")
        .when(value >= green_min, "GREEN")
        .when(value >= amber_min, "AMBER")
        .otherwise("RED")
    )


def status_max_good(value: Column, green_max: float, amber_max: float) -> Column:
    return (
        F.when(value.isNull(), "UNKNOWN")
        .when(value <= green_max, "GREEN")
        .when(value <= amber_max, "AMBER")
        .otherwise("RED")
    )


def status_band_good(
    value: Column, green_low: float, green_high: float, amber_low: float, amber_high: float
) -> Column:
    return (
        F.when(value.isNull(), "UNKNOWN")
        .when(value.between(green_low, green_high), "GREEN")
        .when(value.between(amber_low, amber_high), "AMBER")
        .otherwise("RED")
    )
