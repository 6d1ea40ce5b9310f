"""Null-safe numeric Column helpers.

A missing number is NULL everywhere; NaN is turned into NULL where data enters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFINITY = float("inf")


def number(value: Column) -> Column:
    """Numeric column as double, NaN as NULL."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


# What a text needs to be a number at all. A cast that fails costs an exception, a hundred times the price of this look.
_MAYBE_NUMBER = r"[0-9]|^[\x00-\x20]*[+-]?[iI][nN][fF]"


def parse_number(text: Column) -> Column:
    """Text as double, NULL where it is not a number (a Java suffix as in '1d' is not one)."""
    return F.when(text.rlike(_MAYBE_NUMBER) & ~text.rlike(r"[0-9.][dDfF]\s*$"), number(text))


def numeric_column(df: DataFrame, name: str, default: float | None = None) -> Column:
    """Column `name` of `df` as a number, or the literal default when the frame lacks it."""
    if name not in df.columns:
        return F.lit(default).cast("double")
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(F.col(name))
    return number(F.col(name))


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value; a missing value stays missing (plain greatest/least would drop the NULL)."""
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def clip_probability(value: Column) -> Column:
    return clip(value, 0.0, 1.0)


def clip_lgd(value: Column) -> Column:
    return clip(value, 0.0, 1.0)


def clip_ccf(value: Column) -> Column:
    return clip(value, 0.0, 1.5)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL on a zero or missing denominator or a non-finite result."""
    quotient = F.try_divide(number(numerator), number(denominator))
    return F.when(F.abs(quotient) < INFINITY, quotient)


def safe_divide_sql(numerator: str, denominator: str) -> str:
    """`safe_divide` as SQL text over columns that are doubles without NaN."""
    quotient = f"try_divide({numerator}, {denominator})"
    return f"nullif(nullif({quotient}, double('inf')), double('-inf'))"


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def total(value: Column) -> Column:
    """Sum that is 0, not NULL, when nothing was added."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def sum_parts(value: Column) -> tuple[Column, Column]:
    """Sums of the whole and of the broken parts of a number: doubles add both exactly, up to 2**53 and for 1,000 rows of
    the worst broken parts.

    Added up, they are a total that does not depend on the order of the rows: equal sets of numbers have equal totals, so
    ties in them are ties. Broken parts are kept to 2**-44.
    """
    whole = F.rint(value)
    grid = 2.0**44
    broken = F.when(F.abs(value) < INFINITY, F.rint((value - whole) * grid) / grid).when(value.isNotNull(), 0.0)
    return F.sum(whole), F.sum(broken)


def settled_total(value: Column) -> Column:
    """Sum whose last digits do not depend on the order of the rows."""
    whole, broken = sum_parts(value)
    return whole + broken


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})
