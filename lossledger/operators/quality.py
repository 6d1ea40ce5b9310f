"""Data-quality checks over raw tables and marts.

Each table is aggregated once and the checks are read off that row; only the date-order checks need a pass of
their own. An empty table gives NULL sums, which fail.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = [
    "check_group", "check_name", "table_name", "metric_name", "metric_value", "threshold_value", "status", "details",
]

# Row-count checks as (table, check name, status when empty, details).
ROW_COUNT_CHECKS = [
    ("raw.companies", "raw companies rows", "FAIL", "Raw borrower table should not be empty."),
    ("raw.financial_statements", "raw financial statements rows", "FAIL",
     "Raw financial statements table should not be empty."),
    ("raw.loan_facilities", "raw loan facilities rows", "FAIL", "Raw loan facilities table should not be empty."),
    ("raw.payments", "raw payments rows", "FAIL", "Raw payments table should not be empty."),
    ("raw.defaults", "raw defaults rows", "WARN",
     "Defaults can be sparse, but the synthetic medium portfolio should contain default events."),
    ("raw.recoveries", "raw recoveries rows", "WARN", "Recoveries should exist for part of the defaulted portfolio."),
    ("raw.rating_history", "raw rating history rows", "FAIL", "Rating history table should not be empty."),
    ("raw.macro_scenarios", "raw macro scenarios rows", "FAIL", "Macro scenarios table should not be empty."),
    ("mart.financial_ratios_mart", "financial ratios mart rows", "FAIL", "Financial ratios mart should not be empty."),
    ("mart.pd_modeling_sample", "pd modeling sample rows", "FAIL", "PD modeling sample should not be empty."),
    ("mart.lgd_modeling_sample", "lgd modeling sample rows", "WARN", "LGD sample contains defaulted facilities only."),
    ("mart.ead_ccf_modeling_sample", "ead ccf modeling sample rows", "WARN",
     "EAD/CCF sample contains revolving defaulted facilities only."),
    ("mart.ifrs9_staging_sample", "ifrs9 staging sample rows", "FAIL", "IFRS 9 staging sample should not be empty."),
]

# Counts of bad rows as (group, check name, table, metric, condition, status when any, details).
BAD_ROW_CHECKS = [
    ("null_check", "company_id nulls", "raw.companies", "null_count", "company_id is null", "FAIL",
     "company_id is the primary borrower key."),
    ("null_check", "facility_id nulls", "raw.loan_facilities", "null_count", "facility_id is null", "FAIL",
     "facility_id is the primary facility key."),
    ("null_check", "payment_id nulls", "raw.payments", "null_count", "payment_id is null", "FAIL",
     "payment_id is the primary payment key."),
    ("amount_check", "negative revenue", "raw.financial_statements", "invalid_count", "revenue < 0", "FAIL",
     "Revenue should not be negative in this synthetic dataset."),
    ("amount_check", "negative total assets", "raw.financial_statements", "invalid_count", "total_assets < 0", "FAIL",
     "Total assets should not be negative."),
    ("amount_check", "negative facility amounts", "raw.loan_facilities", "invalid_count",
     "limit_amount < 0 or outstanding_amount < 0 or undrawn_amount < 0", "FAIL",
     "Limit, outstanding and undrawn amounts should not be negative."),
    ("amount_check", "negative collateral value", "raw.collateral", "invalid_count", "collateral_value < 0", "FAIL",
     "Collateral value should not be negative."),
    ("amount_check", "negative payment amounts", "raw.payments", "invalid_count",
     "scheduled_amount < 0 or paid_amount < 0 or outstanding_balance < 0", "FAIL",
     "Payment and outstanding amounts should not be negative."),
    ("amount_check", "negative recovery amounts", "raw.recoveries", "invalid_count",
     "recovery_amount < 0 or collection_cost < 0", "FAIL",
     "Recovery amount and collection cost should not be negative."),
    ("date_check", "maturity before origination", "raw.loan_facilities", "invalid_count",
     "maturity_date < origination_date", "FAIL", "Facility maturity date should not be earlier than origination date."),
    ("modeling_sample_check", "pd target nulls", "mart.pd_modeling_sample", "null_count",
     "target_default_12m is null", "FAIL", "PD target should not be null."),
    ("modeling_sample_check", "lgd bounds", "mart.lgd_modeling_sample", "invalid_count",
     "realized_lgd < 0 or realized_lgd > 1", "FAIL", "Realized LGD should be between 0 and 1 after clipping."),
    ("modeling_sample_check", "ccf bounds", "mart.ead_ccf_modeling_sample", "invalid_count",
     "realized_ccf < 0 or realized_ccf > 1.5", "FAIL", "Realized CCF should be between 0 and 1.5 after clipping."),
    ("ifrs9_check", "current dpd negative values", "mart.ifrs9_staging_sample", "invalid_count", "current_dpd < 0",
     "FAIL", "Current DPD should not be negative."),
]

# Uniqueness checks as (check name, table, key columns, details).
DUPLICATE_CHECKS = [
    ("duplicate company_id", "raw.companies", ["company_id"], "company_id should be unique."),
    ("duplicate facility_id", "raw.loan_facilities", ["facility_id"], "facility_id should be unique."),
    ("duplicate payment_id", "raw.payments", ["payment_id"], "payment_id should be unique."),
    ("duplicate company report date", "raw.financial_statements", ["company_id", "report_date"],
     "There should be one financial statement per company and report date."),
]

# Averages as (group, check name, table, metric, column, lower, upper, status outside, details).
AVERAGE_CHECKS = [
    ("modeling_sample_check", "pd default rate", "mart.pd_modeling_sample", "default_rate", "target_default_12m",
     0.001, 0.300, "WARN", "PD target default rate should be non-zero and plausible for the synthetic portfolio."),
    ("modeling_sample_check", "lgd average", "mart.lgd_modeling_sample", "avg_lgd", "realized_lgd",
     0.0, 1.0, "FAIL", "Average realized LGD should be within valid probability bounds."),
    ("modeling_sample_check", "ccf average", "mart.ead_ccf_modeling_sample", "avg_ccf", "realized_ccf",
     0.0, 1.5, "FAIL", "Average realized CCF should be within expected bounds."),
    ("ifrs9_check", "ifrs9 default flag rate", "mart.ifrs9_staging_sample", "default_flag_rate", "default_flag",
     0.001, 0.300, "WARN", "Default flag rate should be plausible for the synthetic portfolio."),
]

# Event-order checks as
# (check name, table, event date, other table, other date, days from other date, low/high, metric, status, details).
ORIGINATION = ("raw.loan_facilities", "origination_date")
DATE_ORDER_CHECKS = [
    ("payment more than 31 days before origination", "raw.payments", "payment_date", *ORIGINATION, None, -31,
     "invalid_count", "FAIL",
     "Payment date should not be materially earlier than facility origination date. "
     "A 31-day tolerance allows monthly synthetic payment snapshots."),
    ("payment within 31 days before origination", "raw.payments", "payment_date", *ORIGINATION, -31, 0,
     "warning_count", "WARN",
     "Some monthly synthetic payment snapshots can fall shortly before origination when a facility starts mid-month."),
    ("default before origination", "raw.defaults", "default_date", *ORIGINATION, None, 0,
     "invalid_count", "FAIL", "Default date should not be earlier than facility origination date."),
    ("recovery before default", "raw.recoveries", "recovery_date", "raw.defaults", "default_date", None, 0,
     "invalid_count", "FAIL", "Recovery date should not be earlier than default date."),
]

STAGE_DETAILS = "Stage proxy calculated from the same staging rules used in Python."


def _check(group, name, table, metric, value: Column, threshold: float | None, status, details) -> Column:
    return F.struct(
        F.lit(group).alias("check_group"),
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(metric).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(threshold).cast("double").alias("threshold_value"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        F.lit(details).alias("details"),
    )


def _pass_when(good: Column, otherwise: str) -> Column:
    return F.when(good, "PASS").otherwise(otherwise)


def stage_proxy() -> tuple[Column, Column]:
    """Whether a staging-sample row is in default, and whether its risk has increased."""
    def reached(name: str, bound: int) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) >= bound

    def is_one(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) == 1

    default = (F.col("default_flag") == 1) | is_one("writeoff_flag") | reached("current_dpd", 90) | reached("dpd_at_default", 90)
    increased = (
        reached("rating_downgrade_notches", 2)
        | reached("pd_ratio_current_to_origination", 2)
        | reached("current_dpd", 30)
        | is_one("watchlist_flag")
        | is_one("restructuring_flag")
    )
    return default, increased


def table_checks(table: str, df: DataFrame) -> DataFrame | None:
    """The checks of one table from one pass over it.

    A table with a uniqueness check is counted by its key first; the other counts are sums over the keys.
    """
    measures: dict[str, Column] = {"rows": F.count(F.lit(1))}
    checks: list[Column] = []

    def measure(column: Column) -> Column:
        name = f"m{len(measures)}"
        measures[name] = column
        return F.col(name)

    for name_table, name, empty_status, details in ROW_COUNT_CHECKS:
        if name_table == table:
            status = _pass_when(F.col("rows") > 0, empty_status)
            checks.append(_check("row_count", name, table, "rows", F.col("rows"), 1.0, status, details))
    for group, name, name_table, metric, condition, bad_status, details in BAD_ROW_CHECKS:
        if name_table == table:
            count = measure(F.sum(F.when(F.expr(condition), 1).otherwise(0)))
            checks.append(_check(group, name, table, metric, count, 0.0, _pass_when(count == 0, bad_status), details))
    for group, name, name_table, metric, column, low, high, bad_status, details in AVERAGE_CHECKS:
        if name_table == table:
            average = measure(F.avg(column))
            good = average.between(low, high)
            checks.append(_check(group, name, table, metric, average, None, _pass_when(good, bad_status), details))
    if table == "mart.ifrs9_staging_sample":
        default, increased = stage_proxy()
        stage = F.when(default, 3).when(increased, 2).otherwise(1)
        for number in (1, 2, 3):
            count = measure(F.count(F.when(stage == number, 1)))
            checks.append(
                _check("ifrs9_stage_distribution", f"stage {number} facilities", table, "facilities", count, None, "INFO", STAGE_DETAILS)
            )
    unique = next((c for c in DUPLICATE_CHECKS if c[1] == table), None)
    if unique is None:
        if not checks:
            return None
        return df.agg(*[c.alias(n) for n, c in measures.items()]).select(F.inline(F.array(*checks)))

    name, _, keys, details = unique
    # A single NULL key is not a distinct value; a composite key with a NULL part is.
    is_value = F.col(keys[0]).isNotNull() if len(keys) == 1 else F.lit(True)
    by_key = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    totals = by_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.when(is_value, 1)).alias("distinct"),
        *[F.sum(n).alias(n) for n in measures if n != "rows"],
    )
    count = F.col("rows") - F.col("distinct")
    checks.append(
        _check("duplicate_check", name, table, "duplicate_count", count, 0.0, _pass_when(count == 0, "FAIL"), details)
    )
    return totals.select(F.inline(F.array(*checks)))


def date_order_checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Events dated before the event they must follow; one inner join per pair of tables.

    The join is followed by a global count only, so a hot facility's partition can be split.
    """
    pairs: dict[tuple, list] = {}
    for check in DATE_ORDER_CHECKS:
        pairs.setdefault((check[1], check[2], check[3], check[4]), []).append(check)
    results = []
    for (table, event, other, reference), checks in pairs.items():
        if table not in tables or other not in tables:
            continue
        joined = tables[table].select("facility_id", event).join(
            tables[other].select("facility_id", reference), "facility_id"
        )
        counts, rows = {}, []
        for i, (name, _, _, _, _, low, high, metric, bad_status, details) in enumerate(checks):
            early = F.col(event) < F.date_add(reference, high)
            if low is not None:
                early = early & (F.col(event) >= F.date_add(reference, low))
            counts[f"m{i}"] = F.count(F.when(early, 1))
            value = F.col(f"m{i}")
            rows.append(_check("date_check", name, table, metric, value, 0.0, _pass_when(value == 0, bad_status), details))
        results.append(joined.agg(*[c.alias(n) for n, c in counts.items()]).select(F.inline(F.array(*rows))))
    return results


def data_quality(tables: Mapping[str, DataFrame], checked_at: dt.datetime | None = None) -> DataFrame:
    """The full check report, failures first. `tables` maps raw.<name> and mart.<name> to frames."""
    parts = [part for name, df in tables.items() if (part := table_checks(name, df)) is not None]
    parts += date_order_checks(tables)
    report = reduce(DataFrame.unionByName, parts)
    severity = F.when(F.col("status") == "FAIL", 1).when(F.col("status") == "WARN", 2).when(F.col("status") == "PASS", 3).otherwise(4)
    if checked_at is not None:
        report = report.withColumn("checked_at", F.lit(checked_at))
    return report.orderBy(severity, "check_group", "check_name")


def status_counts(report: DataFrame) -> DataFrame:
    """Failed, warned and passed checks as one row."""
    return report.agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(f"{s.lower()}_count") for s in ("FAIL", "WARN", "PASS")]
    )
