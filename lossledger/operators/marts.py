"""The facility-level ratio mart and the modelling and staging samples built from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.credit import rating_downgrade, rating_order
from lossledger.functions.numeric import safe_divide_sql
from lossledger.functions.ratios import coverage_ratios, statement_ratios
from lossledger.operators.asof import History, asof_join, latest_row
from lossledger.operators.rollups import collateral_rollup, payment_rollup, recovery_rollup

# Column contracts of the mart and samples.
FACILITY_TERMS = [
    "product_type", "limit_amount", "outstanding_amount", "undrawn_amount", "interest_rate",
    "term_months", "revolving_flag", "seniority", "currency", "repayment_type",
]
BORROWER_TRAITS = [
    "industry", "region", "company_size", "legal_form", "ownership_type", "years_in_business",
    "employees_count", "exporter_flag", "state_related_flag", "related_party_flag",
]
STATEMENT_FIELDS = [
    "revenue", "revenue_prev_year", "ebitda", "net_income", "total_assets", "current_assets", "cash",
    "inventory", "accounts_receivable", "total_liabilities", "current_liabilities", "short_term_debt",
    "long_term_debt", "equity", "interest_expense", "operating_cash_flow", "capex",
]
DEFAULT_SAMPLE_STATEMENT_FIELDS = [
    f for f in STATEMENT_FIELDS if f not in ("revenue_prev_year", "accounts_receivable")
]
RATIOS = [
    "current_ratio", "quick_ratio", "debt_to_equity", "debt_to_assets", "debt_to_ebitda",
    "interest_coverage", "ebitda_margin", "net_profit_margin", "operating_cf_to_debt",
    "cash_to_short_term_debt", "equity_to_assets", "revenue_growth_yoy",
]
COLLATERAL_FIELDS = [
    "collateral_type", "collateral_value", "avg_collateral_haircut", "effective_collateral_value",
    "loan_to_value", "collateral_coverage", "effective_collateral_coverage",
]
ORIGINATION_RATING = [
    "origination_rating_grade", "origination_pd_estimate", "watchlist_flag", "restructuring_flag",
]
PAYMENT_FIELDS = [
    "max_dpd_observed", "max_dpd_12m", "payment_months_observed", "total_scheduled_amount",
    "total_paid_amount", "payment_completion_rate",
]
DEFAULT_FIELDS = ["default_date", "default_type", "dpd_at_default", "ead_at_default", "writeoff_flag"]
RECOVERY_FIELDS = ["total_recovery_amount", "total_collection_cost", "recovery_events_count"]
MACRO_FIELDS = [
    "gdp_growth", "inflation", "base_rate", "unemployment", "fx_rate", "industry_stress_index",
]

RATIO_MART_COLUMNS = [
    "facility_id", "company_id", "observation_date", "maturity_date", *FACILITY_TERMS,
    "registration_date", *BORROWER_TRAITS[:5], "latent_profile", *BORROWER_TRAITS[5:],
    "report_date", *STATEMENT_FIELDS, "total_debt", *RATIOS, *COLLATERAL_FIELDS,
    "rating_date", *ORIGINATION_RATING, *PAYMENT_FIELDS, *DEFAULT_FIELDS, "target_default_12m",
    *RECOVERY_FIELDS, "realized_lgd", "realized_ccf",
]
PD_SAMPLE_COLUMNS = [
    "facility_id", "company_id", "observation_date", "target_default_12m", *FACILITY_TERMS,
    *BORROWER_TRAITS, *STATEMENT_FIELDS, "total_debt", *RATIOS, *COLLATERAL_FIELDS,
    "watchlist_flag", "restructuring_flag",
]
_DEFAULT_SAMPLE_HEAD = ["facility_id", "company_id", "observation_date", "default_date"]
_DEFAULT_SAMPLE_BODY = [
    *BORROWER_TRAITS, *DEFAULT_SAMPLE_STATEMENT_FIELDS, "total_debt", *RATIOS, *COLLATERAL_FIELDS,
    *ORIGINATION_RATING, *DEFAULT_FIELDS[1:],
]
LGD_SAMPLE_COLUMNS = [
    *_DEFAULT_SAMPLE_HEAD, *FACILITY_TERMS, *_DEFAULT_SAMPLE_BODY, *RECOVERY_FIELDS,
    "net_recovery_amount", *MACRO_FIELDS, "realized_lgd",
]
CCF_SAMPLE_COLUMNS = [
    *_DEFAULT_SAMPLE_HEAD, *FACILITY_TERMS[:4], "utilization_rate", *FACILITY_TERMS[4:],
    *_DEFAULT_SAMPLE_BODY, *MACRO_FIELDS, "realized_ccf",
]
STAGING_SAMPLE_COLUMNS = [
    "facility_id", "company_id", "reporting_date", "observation_date", "maturity_date", *FACILITY_TERMS,
    *BORROWER_TRAITS, *RATIOS, "collateral_type", "collateral_value", "effective_collateral_value",
    "collateral_coverage", "effective_collateral_coverage", "origination_rating_grade",
    "origination_rating_order", "origination_pd_estimate", "current_rating_date", "current_rating_grade",
    "current_rating_order", "current_pd_estimate", "latest_payment_date", "current_dpd",
    "current_outstanding_balance", "watchlist_flag", "restructuring_flag", "max_dpd_observed",
    "max_dpd_12m", "default_date", "default_type", "dpd_at_default", "writeoff_flag", "default_flag",
    "pd_ratio_current_to_origination", "rating_downgrade_notches", "target_default_12m",
]


def statement_history(statements: DataFrame) -> History:
    return History(statements, on="report_date", prefer=STATEMENT_FIELDS)


def origination_rating_history(ratings: DataFrame) -> History:
    renamed = ratings.withColumnsRenamed(
        {"rating_grade": "origination_rating_grade", "pd_estimate": "origination_pd_estimate"}
    )
    return History(renamed, on="rating_date", prefer=ORIGINATION_RATING)


def target_12m(observation: Column, default: Column) -> Column:
    """1 for a default up to twelve months after observation (with no lower bound), else 0."""
    return F.when(default <= F.add_months(observation, 12), 1).otherwise(0)


def raw_realized_lgd() -> Column:
    """Gross of cost and unbounded, as kept in the mart."""
    ead = F.col("ead_at_default")
    return F.when(ead > 0, 1 - F.coalesce("total_recovery_amount", F.lit(0.0)) / ead)


def raw_realized_ccf() -> Column:
    """Unbounded, as kept in the mart."""
    undrawn = F.col("undrawn_amount")
    applies = (F.col("revolving_flag") == 1) & (undrawn > 0) & F.col("ead_at_default").isNotNull()
    return F.when(applies, (F.col("ead_at_default") - F.col("outstanding_amount")) / F.nullif(undrawn, F.lit(0.0)))


def ratio_mart(raw: Mapping[str, DataFrame]) -> DataFrame:
    """One wide row per facility, as known at its observation date plus its later performance."""
    facilities = raw["loan_facilities"].withColumnRenamed("origination_date", "observation_date")
    observed = facilities.select("facility_id", "company_id", "observation_date")
    # Only keys and dates travel to the borrower's histories and attributes; the terms join by facility.
    dated = asof_join(
        observed,
        [statement_history(raw["financial_statements"]), origination_rating_history(raw["rating_history"])],
        by="company_id",
        left_on="observation_date",
        attributes=raw["companies"],
    )
    joined = (
        facilities.join(dated.drop("company_id", "observation_date"), "facility_id", "left")
        .join(collateral_rollup(raw["collateral"]), "facility_id", "left")
        .join(payment_rollup(observed, raw["payments"]), "facility_id", "left")
        .join(raw["defaults"], "facility_id", "left")
        .join(recovery_rollup(raw["recoveries"]), "facility_id", "left")
    )
    return joined.withColumns(
        {
            **statement_ratios(STATEMENT_FIELDS, missing_inventory_as_zero=True),
            **coverage_ratios(COLLATERAL_FIELDS + FACILITY_TERMS),
            "payment_completion_rate": F.expr(safe_divide_sql("total_paid_amount", "total_scheduled_amount")),
            "target_default_12m": target_12m(F.col("observation_date"), F.col("default_date")),
            "realized_lgd": raw_realized_lgd(),
            "realized_ccf": raw_realized_ccf(),
        }
    ).select(*RATIO_MART_COLUMNS)


def pd_outcomes(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Origination PD and twelve-month target per facility, from ratings and defaults alone."""
    observed = raw["loan_facilities"].select("facility_id", "company_id", F.col("origination_date").alias("observation_date"))
    rated = asof_join(
        observed, [origination_rating_history(raw["rating_history"])], by="company_id", left_on="observation_date"
    )
    defaults = raw["defaults"].select("facility_id", "default_date")
    return rated.join(defaults, "facility_id", "left").select(
        "facility_id", "observation_date",
        target_12m(F.col("observation_date"), F.col("default_date")).alias("target_default_12m"),
        "origination_pd_estimate",
    )


def pd_sample(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("target_default_12m").isNotNull()).select(*PD_SAMPLE_COLUMNS)


def with_macro(defaulted: DataFrame, macro: DataFrame, scenario: str = "base") -> DataFrame:
    """Macro values of the default month. One scenario is a row per month, so it is broadcast."""
    monthly = macro.filter(F.col("scenario") == scenario).select(F.col("month").alias("_month"), *MACRO_FIELDS)
    return (
        defaulted.withColumn("_month", F.trunc("default_date", "MM"))
        .join(F.broadcast(monthly), "_month", "left")
        .drop("_month")
    )


def lgd_sample(mart: DataFrame, macro: DataFrame) -> DataFrame:
    """Defaulted facilities with net loss given default in [0, 1]."""
    defaulted = mart.filter(F.col("default_date").isNotNull() & (F.col("ead_at_default") > 0))
    netted = defaulted.withColumns(
        {
            "total_recovery_amount": F.coalesce("total_recovery_amount", F.lit(0.0)),
            "total_collection_cost": F.coalesce("total_collection_cost", F.lit(0.0)),
            "recovery_events_count": F.coalesce("recovery_events_count", F.lit(0)),
        }
    ).withColumn(
        "net_recovery_amount",
        F.greatest(F.col("total_recovery_amount") - F.col("total_collection_cost"), F.lit(0.0)),
    )
    loss = 1.0 - F.col("net_recovery_amount") / F.nullif(F.col("ead_at_default"), F.lit(0.0))
    realized = F.least(F.lit(1.0), F.greatest(F.lit(0.0), loss))
    return with_macro(netted, macro).withColumn("realized_lgd", realized).select(*LGD_SAMPLE_COLUMNS)


def ccf_sample(mart: DataFrame, macro: DataFrame) -> DataFrame:
    """Defaulted revolving facilities with the conversion factor in [0, 1.5]."""
    defaulted = mart.filter(
        F.col("default_date").isNotNull()
        & (F.col("revolving_flag") == 1)
        & (F.col("undrawn_amount") > 0)
        & F.col("ead_at_default").isNotNull()
    )
    drawn = (F.col("ead_at_default") - F.col("outstanding_amount")) / F.nullif(F.col("undrawn_amount"), F.lit(0.0))
    return (
        with_macro(defaulted, macro)
        .withColumns(
            {
                "utilization_rate": F.expr(safe_divide_sql("outstanding_amount", "limit_amount")),
                "realized_ccf": F.least(F.lit(1.5), F.greatest(F.lit(0.0), drawn)),
            }
        )
        .select(*CCF_SAMPLE_COLUMNS)
    )


def current_rating(ratings: DataFrame, reporting_date: dt.date) -> DataFrame:
    """Latest rating per company on or before the reporting date."""
    names = {
        "rating_date": "current_rating_date",
        "rating_grade": "current_rating_grade",
        "pd_estimate": "current_pd_estimate",
        "watchlist_flag": "current_watchlist_flag",
        "restructuring_flag": "current_restructuring_flag",
    }
    return latest_row(
        ratings, by="company_id", on="rating_date",
        prefer=["rating_grade", "pd_estimate", "watchlist_flag", "restructuring_flag"],
        not_after=reporting_date,
    ).withColumnsRenamed(names)


def latest_payment(payments: DataFrame, reporting_date: dt.date) -> DataFrame:
    """Latest payment per facility on or before the reporting date; ties go to the highest payment_id."""
    wanted = payments.select("facility_id", "payment_date", "payment_id", "days_past_due", "outstanding_balance")
    return latest_row(
        wanted, by="facility_id", on="payment_date",
        prefer=["payment_id", "days_past_due", "outstanding_balance"],
        not_after=reporting_date,
    ).select(
        "facility_id",
        F.col("payment_date").alias("latest_payment_date"),
        F.col("days_past_due").alias("current_dpd"),
        F.col("outstanding_balance").alias("current_outstanding_balance"),
    )


def rated_facilities(facilities: DataFrame, rated: DataFrame) -> DataFrame:
    """Per facility the current ratings of its companies, as a list: one, but where a facility id comes again."""
    names = [c for c in rated.columns if c != "company_id"]
    held = facilities.select("facility_id", "company_id").join(rated, "company_id")
    return held.groupBy("facility_id").agg(F.collect_set(F.struct("company_id", *names)).alias("_rated"))


def staging_sample(
    mart: DataFrame, ratings: DataFrame, payments: DataFrame, reporting_date: dt.date, facilities: DataFrame | None = None
) -> DataFrame:
    """Every facility with its current rating, delinquency and default state at the reporting date.

    `facilities` has the facility_id and company_id of the mart's rows, for a mart that is not stored.
    """
    # The mart arrives partitioned by facility, so all joins are by facility and the mart's wide rows are not moved: the
    # ratings go from companies to facilities as narrow rows.
    rated = current_rating(ratings, reporting_date)
    found = F.get(F.filter("_rated", lambda r: r["company_id"] == F.col("company_id")), 0)
    joined = (
        mart.join(latest_payment(payments, reporting_date), "facility_id", "left")
        .join(rated_facilities(mart if facilities is None else facilities, rated), "facility_id", "left")
        .withColumn("_rated", found)
        .withColumns({c: F.col("_rated")[c] for c in rated.columns if c != "company_id"})
    )
    origination_pd, current_pd = F.col("origination_pd_estimate"), F.col("current_pd_estimate")
    zero = F.lit(0)
    in_default = (
        F.col("default_date").isNotNull()
        | (F.coalesce("writeoff_flag", zero) == 1)
        | (F.coalesce("dpd_at_default", zero) >= 90)
        | (F.coalesce("current_dpd", zero) >= 90)
    )
    return joined.withColumns(
        {
            "reporting_date": F.lit(reporting_date),
            "origination_rating_order": rating_order(F.col("origination_rating_grade")),
            "current_rating_order": rating_order(F.col("current_rating_grade")),
            "current_dpd": F.coalesce("current_dpd", zero),
            "current_outstanding_balance": F.coalesce("current_outstanding_balance", "outstanding_amount"),
            "watchlist_flag": F.coalesce("current_watchlist_flag", "watchlist_flag", zero),
            "restructuring_flag": F.coalesce("current_restructuring_flag", "restructuring_flag", zero),
            "default_flag": F.when(in_default, 1).otherwise(0),
            "pd_ratio_current_to_origination": F.when(origination_pd > 0, current_pd / origination_pd),
            "rating_downgrade_notches": rating_downgrade(
                F.col("origination_rating_grade"), F.col("current_rating_grade")
            ),
        }
    ).select(*STAGING_SAMPLE_COLUMNS)
