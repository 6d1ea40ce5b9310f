"""Borrower and facility ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import numeric_column, safe_divide_sql

DEBT = "(coalesce(short_term_debt, 0) + coalesce(long_term_debt, 0))"
# Numerator and denominator of each ratio over the statement fields.
STATEMENT_RATIO_PARTS = {
    "current_ratio": ("current_assets", "current_liabilities"),
    "quick_ratio": ("current_assets - {inventory}", "current_liabilities"),
    "debt_to_equity": (DEBT, "equity"),
    "debt_to_assets": (DEBT, "total_assets"),
    "debt_to_ebitda": (DEBT, "ebitda"),
    "interest_coverage": ("ebitda", "interest_expense"),
    "ebitda_margin": ("ebitda", "revenue"),
    "net_profit_margin": ("net_income", "revenue"),
    "operating_cf_to_debt": ("operating_cash_flow", DEBT),
    "cash_to_short_term_debt": ("cash", "short_term_debt"),
    "equity_to_assets": ("equity", "total_assets"),
    "revenue_growth_yoy": ("revenue - revenue_prev_year", "revenue_prev_year"),
}
COVERAGE_RATIO_PARTS = {
    "loan_to_value": ("outstanding_amount", "collateral_value"),
    "collateral_coverage": ("collateral_value", "outstanding_amount"),
    "effective_collateral_coverage": ("effective_collateral_value", "outstanding_amount"),
}
STATEMENT_RATIOS = list(STATEMENT_RATIO_PARTS)
STATEMENT_INPUTS = [
    "short_term_debt", "long_term_debt", "current_assets", "current_liabilities", "inventory", "equity",
    "total_assets", "ebitda", "interest_expense", "revenue", "revenue_prev_year", "net_income",
    "operating_cash_flow", "cash",
]
COVERAGE_INPUTS = ["outstanding_amount", "collateral_value", "effective_collateral_value"]


def statement_ratios(columns: list[str], missing_inventory_as_zero: bool = False) -> dict[str, Column]:
    """Total debt and the statement ratios over double columns.

    The mart counts a missing inventory as zero in the quick ratio; the stand-alone
    calculation leaves the ratio missing. Revenue growth needs last year's revenue.
    """
    inventory = "coalesce(inventory, 0)" if missing_inventory_as_zero else "inventory"
    if "inventory" not in columns:
        inventory = "0"
    ratios = {"total_debt": F.expr(DEBT)}
    for name, (numerator, denominator) in STATEMENT_RATIO_PARTS.items():
        if name == "revenue_growth_yoy" and "revenue_prev_year" not in columns:
            continue
        ratios[name] = F.expr(safe_divide_sql(numerator.format(inventory=inventory), denominator))
    return ratios


def coverage_ratios(columns: list[str]) -> dict[str, Column]:
    """Loan-to-value and collateral coverage, where the amounts are there."""
    return {
        name: F.expr(safe_divide_sql(numerator, denominator))
        for name, (numerator, denominator) in COVERAGE_RATIO_PARTS.items()
        if numerator in columns and denominator in columns
    }


def with_financial_ratios(df: DataFrame) -> DataFrame:
    """Add every ratio whose fields `df` has; text and NaN inputs are cleaned first."""
    data = df.withColumns({c: numeric_column(df, c) for c in STATEMENT_INPUTS + COVERAGE_INPUTS if c in df.columns})
    absent_debt = [c for c in ("short_term_debt", "long_term_debt") if c not in df.columns]
    data = data.withColumns({c: F.lit(None).cast("double") for c in absent_debt})
    return data.withColumns({**statement_ratios(df.columns), **coverage_ratios(df.columns)}).drop(*absent_debt)
