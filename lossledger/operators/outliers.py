"""Outlier reports of the loss and exposure samples, and winsorising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import clip, numeric_column
from lossledger.operators.ordering import column_quantiles

HIGH_EAD_MULTIPLE = 3

# Accepted column names in order of preference.
CANDIDATES = {
    "lgd": ["realized_lgd", "lgd", "actual_lgd"],
    "ccf": ["realized_ccf", "ccf", "actual_ccf"],
    "ead": ["ead_at_default", "ead", "total_ead"],
    "recovery": ["total_recovery_amount", "recovery_amount", "recoveries_amount"],
    "cost": ["total_collection_cost", "collection_cost", "collection_costs"],
    "undrawn": ["undrawn_amount", "undrawn_balance"],
    "outstanding": ["outstanding_amount", "drawn_amount", "outstanding_balance"],
    "limit": ["limit_amount", "credit_limit"],
}


def first_existing_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def _resolve(df: DataFrame, names: Sequence[str]) -> tuple[dict[str, str], dict[str, Column]]:
    found = {n: c for n in names if (c := first_existing_column(df, CANDIDATES[n]))}
    return found, {n: numeric_column(df, c) for n, c in found.items()}


def _high_ead_bound(df: DataFrame, ead: Column) -> float | None:
    p99 = column_quantiles(df.select(ead.alias("ead")), ["ead"], [0.99])["ead"].get(0.99)
    return None if p99 is None or p99 <= 0 else p99 * HIGH_EAD_MULTIPLE


def _report(df: DataFrame, area: str, rows_details: str, checks: list[tuple]) -> DataFrame:
    """One aggregate with a conditional count per check, turned into one row per check."""
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count(F.when(bad, 1)).alias(f"m{i}") for i, (_, _, bad, _, _) in enumerate(checks)]
    rows = [_row(area, "rows", "rows", F.col("rows"), F.lit("INFO"), rows_details)]
    for i, (name, metric, _, bad_status, details) in enumerate(checks):
        count = F.col(f"m{i}")
        rows.append(_row(area, name, metric, count, F.when(count == 0, "PASS").otherwise(bad_status), details))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _row(area: str, name: str, metric: str, value: Column, status: Column, details: str) -> Column:
    return F.struct(
        F.lit(area).alias("area"),
        F.lit(name).alias("check_name"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        status.alias("status"),
        F.lit(details).alias("details"),
    )


def _exposure_checks(df: DataFrame, names: dict[str, str], columns: dict[str, Column]) -> list[tuple]:
    if "ead" not in names:
        return []
    ead, label = columns["ead"], names["ead"]
    checks = [("non positive ead", "invalid_count", ead <= 0, "FAIL", f"{label} should be positive.")]
    bound = _high_ead_bound(df, ead)
    if bound is not None:
        checks.append(
            ("very high ead", "outlier_count", ead > bound, "WARN",
             f"{label} greater than 3x p99 is treated as an exposure outlier.")
        )
    return checks


def lgd_outliers(df: DataFrame) -> DataFrame:
    """Bound and plausibility checks of the loss sample; checks on absent columns are left out."""
    names, columns = _resolve(df, ["lgd", "ead", "recovery", "cost"])
    checks: list[tuple] = []
    if "lgd" in names:
        lgd = columns["lgd"]
        checks.append(
            ("lgd outside 0 1 bounds", "invalid_count", (lgd < 0) | (lgd > 1), "FAIL",
             f"{names['lgd']} should be between 0 and 1.")
        )
    checks += _exposure_checks(df, names, columns)
    if "recovery" in names:
        recovery = columns["recovery"]
        checks.append(
            ("negative recoveries", "invalid_count", recovery < 0, "FAIL", f"{names['recovery']} should not be negative.")
        )
        if "ead" in names:
            checks.append(
                ("recovery greater than ead", "warning_count", recovery > columns["ead"], "WARN",
                 "Total recovery greater than EAD is possible in synthetic data but should be reviewed.")
            )
    if "cost" in names:
        cost = columns["cost"]
        checks.append(
            ("negative collection cost", "invalid_count", cost < 0, "FAIL", f"{names['cost']} should not be negative.")
        )
        if "ead" in names:
            checks.append(
                ("extreme collection cost", "warning_count", cost > columns["ead"] * 0.5, "WARN",
                 "Collection cost greater than 50% of EAD is treated as an outlier.")
            )
    return _report(df, "LGD", "Rows in LGD diagnostics input.", checks)


def ccf_outliers(df: DataFrame) -> DataFrame:
    """Bound and plausibility checks of the conversion-factor sample."""
    names, columns = _resolve(df, ["ccf", "ead", "undrawn", "outstanding", "limit"])
    checks: list[tuple] = []
    if "ccf" in names:
        ccf = columns["ccf"]
        checks.append(
            ("ccf outside 0 1.5 bounds", "invalid_count", (ccf < 0) | (ccf > 1.5), "FAIL",
             f"{names['ccf']} should be between 0 and 1.5.")
        )
    checks += _exposure_checks(df, names, columns)
    if "undrawn" in names:
        checks.append(
            ("zero or negative undrawn amount", "warning_count", columns["undrawn"] <= 0, "WARN",
             f"{names['undrawn']} should be positive for CCF modeling rows.")
        )
    if "outstanding" in names:
        checks.append(
            ("negative outstanding amount", "invalid_count", columns["outstanding"] < 0, "FAIL",
             f"{names['outstanding']} should not be negative.")
        )
    if "limit" in names and "ead" in names:
        checks.append(
            ("ead materially greater than limit", "warning_count", columns["ead"] > columns["limit"] * 1.5, "WARN",
             "EAD greater than 1.5x limit amount should be reviewed.")
        )
    return _report(df, "EAD_CCF", "Rows in EAD/CCF diagnostics input.", checks)


def winsorize(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip columns to their own quantiles; absent columns are skipped.

    Reads `df` once for the bounds (two numbers per column) and once for the result.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    bounds = column_quantiles(df, present, [lower, upper])
    return df.withColumns(
        {c: clip(F.col(c), bounds[c].get(lower), bounds[c].get(upper)) for c in present if bounds[c]}
    )
