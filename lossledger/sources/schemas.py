"""Explicit schemas of the nine raw tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column contracts of the raw tables, as DDL.
RAW_DDL = {
    "companies": """
        company_id string, registration_date date, industry string, region string, company_size string,
        legal_form string, ownership_type string, latent_profile string, years_in_business double,
        employees_count int, exporter_flag int, state_related_flag int, related_party_flag int""",
    "financial_statements": """
        company_id string, report_date date, revenue double, revenue_prev_year double, ebitda double,
        net_income double, total_assets double, current_assets double, cash double, inventory double,
        accounts_receivable double, total_liabilities double, current_liabilities double,
        short_term_debt double, long_term_debt double, equity double, interest_expense double,
        operating_cash_flow double, capex double""",
    "loan_facilities": """
        facility_id string, company_id string, origination_date date, maturity_date date,
        product_type string, limit_amount double, outstanding_amount double, undrawn_amount double,
        interest_rate double, term_months int, revolving_flag int, seniority string, currency string,
        repayment_type string""",
    "collateral": """
        collateral_id string, facility_id string, collateral_type string, collateral_value double,
        haircut double, valuation_date date""",
    "payments": """
        payment_id string, facility_id string, payment_date date, scheduled_amount double,
        paid_amount double, days_past_due int, outstanding_balance double""",
    "defaults": """
        facility_id string, default_date date, default_type string, dpd_at_default int,
        ead_at_default double, writeoff_flag int""",
    "recoveries": """
        recovery_id string, facility_id string, recovery_date date, recovery_amount double,
        recovery_type string, collection_cost double""",
    "rating_history": """
        company_id string, rating_date date, rating_grade string, pd_estimate double,
        watchlist_flag int, restructuring_flag int""",
    "macro_scenarios": """
        month date, scenario string, scenario_weight double, gdp_growth double, inflation double,
        base_rate double, unemployment double, fx_rate double, industry_stress_index double""",
}

RAW_TABLES = list(RAW_DDL)


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL[table])


def raw_columns(table: str) -> list[str]:
    return raw_schema(table).fieldNames()
