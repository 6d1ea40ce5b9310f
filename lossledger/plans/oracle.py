"""DuckDB SQL giving the expected result of every registered query.

`CTES` lists named steps in dependency order; a query is the steps up to its own plus a final
select. The SQL is written independently of the Spark code: plain windows and correlated filters
where the Spark side uses aggregates and range partitions.
"""

from __future__ import annotations

from lossledger.plans.oracle_fits import fits
from lossledger.plans.oracle_sources import SOURCES
from lossledger.plans.oracle_values import (
    AVERAGE_CHECKS,
    BAD_ROW_CHECKS,
    CCF_SAMPLE_COLUMNS,
    DUPLICATE_CHECKS,
    LGD_SAMPLE_COLUMNS,
    PD_SAMPLE_COLUMNS,
    RATIO_MART_COLUMNS,
    ROW_COUNT_CHECKS,
    SCENARIO_FACTORS,
    SCENARIO_WEIGHTS,
    STAGE_DETAILS,
    STAGING_SAMPLE_COLUMNS,
    STRESS_SCENARIOS,
)

REPORTING_DATE = "DATE '2001-08-01'"

TEXT_FIELDS = {
    "product_type", "seniority", "currency", "repayment_type", "industry", "region", "company_size",
    "legal_form", "ownership_type", "collateral_type",
}
PSI_FEATURES = [
    c for c in PD_SAMPLE_COLUMNS
    if c not in TEXT_FIELDS | {"facility_id", "company_id", "observation_date", "target_default_12m"}
]


def _grade(pd: str) -> str:
    return (
        f"CASE WHEN {pd} < 0.005 THEN 'A' WHEN {pd} < 0.015 THEN 'B' WHEN {pd} < 0.035 THEN 'C' "
        f"WHEN {pd} < 0.075 THEN 'D' WHEN {pd} < 0.15 THEN 'E' ELSE 'F' END"
    )


def _grade_order(grade: str) -> str:
    return (
        f"CASE {grade} WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 "
        f"WHEN 'E' THEN 5 WHEN 'F' THEN 6 WHEN 'Default' THEN 7 END"
    )


def _clip(value: str, low: float, high: float) -> str:
    return f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END::DOUBLE"


RAW = {
    "companies": """
        SELECT c_custkey AS company_id,
               DATE '1985-01-01' + (c_custkey % 1800)::INTEGER AS registration_date,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'manufacturing'
                    WHEN 'AUTOMOBILE' THEN 'transport' WHEN 'FURNITURE' THEN 'trade'
                    WHEN 'HOUSEHOLD' THEN 'services' END AS industry,
               r_name AS region,
               CASE WHEN c_acctbal < 0 THEN 'micro' WHEN c_acctbal < 3000 THEN 'small'
                    WHEN c_acctbal < 8000 THEN 'medium' ELSE 'large' END AS company_size,
               CASE c_custkey % 3 WHEN 0 THEN 'llc' WHEN 1 THEN 'jsc' ELSE 'partnership' END AS legal_form,
               CASE WHEN c_custkey % 10 = 0 THEN 'state' WHEN c_custkey % 10 <= 2 THEN 'foreign'
                    ELSE 'private' END AS ownership_type,
               CASE WHEN c_custkey % 10 < 3 THEN 'strong' WHEN c_custkey % 10 < 7 THEN 'average'
                    ELSE 'weak' END AS latent_profile,
               (1 + c_custkey % 30)::DOUBLE AS years_in_business,
               (5 + (c_custkey * 37) % 2000)::INTEGER AS employees_count,
               (c_custkey % 4 = 0)::INTEGER AS exporter_flag,
               (c_custkey % 10 = 0)::INTEGER AS state_related_flag,
               (c_custkey % 25 = 0)::INTEGER AS related_party_flag
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "facility_terms": """
        SELECT o_orderkey AS facility_id, o_custkey AS company_id, o_orderdate::DATE AS origination_date,
               (o_orderdate::DATE + to_months((12 * (1 + o_orderkey % 5))::INTEGER))::DATE AS maturity_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'overdraft' WHEN '2-HIGH' THEN 'credit_line'
                    WHEN '3-MEDIUM' THEN 'trade_finance' WHEN '4-NOT SPECIFIED' THEN 'term_loan'
                    WHEN '5-LOW' THEN 'working_capital' END AS product_type,
               o_totalprice AS limit_amount,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                    THEN o_totalprice * (350 + 6 * (o_orderkey % 100)) / 1000
                    ELSE o_totalprice * (800 + 2 * (o_orderkey % 100)) / 1000 END AS outstanding_amount,
               0.08::DOUBLE + (o_orderkey % 100)::DOUBLE / 1000 AS interest_rate,
               (12 * (1 + o_orderkey % 5))::INTEGER AS term_months,
               (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))::INTEGER AS revolving_flag,
               CASE o_orderkey % 3 WHEN 0 THEN 'senior_secured' WHEN 1 THEN 'senior_unsecured'
                    ELSE 'subordinated' END AS seniority,
               CASE o_orderkey % 10 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'LCY' END AS currency
        FROM orders""",
    "loan_facilities": """
        SELECT *, limit_amount - outstanding_amount AS undrawn_amount,
               CASE WHEN revolving_flag = 1 THEN 'revolving' WHEN facility_id % 2 = 0 THEN 'annuity'
                    ELSE 'bullet' END AS repayment_type
        FROM facility_terms""",
    "company_lines": """
        SELECT o_custkey AS company_id, year(o_orderdate) AS y,
               round(l_extendedprice * 100)::BIGINT AS cents,
               round(l_discount * 100)::BIGINT AS dp, round(l_tax * 100)::BIGINT AS tp,
               l_returnflag = 'R' AND l_quantity >= 25 AS bad
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "statement_sums": """
        SELECT company_id, y, sum(cents)::DOUBLE / 100 AS revenue,
               sum(cents * (dp + tp))::DOUBLE / 10000 AS ebitda,
               sum(cents * (dp - tp))::DOUBLE / 10000 AS net_income
        FROM company_lines GROUP BY company_id, y""",
    "statement_assets": """
        SELECT *, lag(revenue) OVER (PARTITION BY company_id ORDER BY y) AS revenue_prev_year,
               revenue * 1.2::DOUBLE AS total_assets, company_id % 10 AS s
        FROM statement_sums""",
    "statement_liabilities": """
        SELECT *, total_assets * (30 + s) / 100 AS current_assets,
               total_assets * (40 + 4 * s) / 100 AS total_liabilities
        FROM statement_assets""",
    "statement_current": """
        SELECT *, total_liabilities * 0.45::DOUBLE AS current_liabilities FROM statement_liabilities""",
    "statement_debt": """
        SELECT *, current_liabilities * (5 * s) / 100 AS short_term_debt,
               (total_liabilities - current_liabilities) * 0.6::DOUBLE AS long_term_debt
        FROM statement_current""",
    "financial_statements": """
        SELECT company_id, make_date(y::INTEGER, 12, 31) AS report_date, revenue, revenue_prev_year, ebitda,
               net_income, total_assets, current_assets, current_assets * 0.1::DOUBLE AS cash,
               CASE WHEN s <> 3 THEN current_assets * 0.2::DOUBLE END AS inventory,
               current_assets * 0.25::DOUBLE AS accounts_receivable, total_liabilities, current_liabilities,
               short_term_debt, long_term_debt, total_assets - total_liabilities AS equity,
               (short_term_debt + long_term_debt) * 0.09::DOUBLE AS interest_expense,
               ebitda * 0.7::DOUBLE AS operating_cash_flow, revenue * 0.04::DOUBLE AS capex
        FROM statement_debt""",
    "rating_pds": """
        SELECT company_id, y,
               round(least(0.45::DOUBLE, 0.001::DOUBLE + 0.15::DOUBLE *
                     (sum(CASE WHEN bad THEN cents ELSE 0 END)::DOUBLE / sum(cents)::DOUBLE)), 6) AS pd_estimate
        FROM company_lines GROUP BY company_id, y""",
    "rating_history": f"""
        SELECT company_id, make_date(y::INTEGER, 1, 1) AS rating_date, {_grade('pd_estimate')} AS rating_grade,
               pd_estimate, ((7 * company_id + y) % 25 = 0)::INTEGER AS watchlist_flag,
               ((11 * company_id + y) % 60 = 0)::INTEGER AS restructuring_flag
        FROM rating_pds""",
    "payments": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payment_id,
               l_orderkey AS facility_id,
               o_orderdate::DATE + ((l_shipdate::DATE - DATE '1995-01-01') % 730)::INTEGER AS payment_date,
               l_extendedprice AS scheduled_amount, l_extendedprice * (1 - l_discount) AS paid_amount,
               CASE WHEN l_returnflag = 'R' AND l_quantity >= 49 THEN 95
                    WHEN l_returnflag = 'R' AND l_quantity >= 46 THEN 35
                    WHEN l_returnflag = 'A' AND l_quantity >= 40 THEN 15 ELSE 0 END AS days_past_due,
               l_extendedprice * l_discount AS outstanding_balance
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "defaults": """
        SELECT facility_id, origination_date + (90 + (37 * facility_id) % 900)::INTEGER AS default_date,
               CASE facility_id % 4 WHEN 0 THEN 'overdue' WHEN 1 THEN 'bankruptcy' WHEN 2 THEN 'distressed'
                    ELSE 'legal' END AS default_type,
               (90 + 30 * (facility_id % 4))::INTEGER AS dpd_at_default,
               outstanding_amount + undrawn_amount * (20 + facility_id % 66) / 100 AS ead_at_default,
               (facility_id % 100 = 7)::INTEGER AS writeoff_flag
        FROM loan_facilities WHERE facility_id % 20 = 7""",
    "recoveries": """
        SELECT concat_ws('-', 'R', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS recovery_id, facility_id,
               default_date + (10 * l_linenumber)::INTEGER AS recovery_date,
               l_extendedprice * (1 + l_linenumber) / 20 AS recovery_amount,
               l_extendedprice * (1 + l_linenumber) / 20 * 0.05::DOUBLE AS collection_cost
        FROM lineitem JOIN defaults ON l_orderkey = facility_id""",
    "collateral": """
        SELECT l_orderkey AS facility_id,
               CASE p_type WHEN 'ECONOMY' THEN 'none' WHEN 'MEDIUM' THEN 'equipment' WHEN 'PROMO' THEN 'inventory'
                    WHEN 'SMALL' THEN 'receivables' WHEN 'LARGE' THEN 'real_estate'
                    WHEN 'STANDARD' THEN 'guarantee' END AS collateral_type,
               CASE WHEN p_type = 'ECONOMY' THEN 0::DOUBLE ELSE l_extendedprice END AS collateral_value,
               (CASE p_type WHEN 'ECONOMY' THEN 1.0 WHEN 'MEDIUM' THEN 0.375 WHEN 'PROMO' THEN 0.5
                    WHEN 'SMALL' THEN 0.4375 WHEN 'LARGE' THEN 0.25 WHEN 'STANDARD' THEN 0.3125 END)::DOUBLE AS haircut
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "macro_scenarios": """
        SELECT (DATE '1995-01-01' + to_months(i::INTEGER))::DATE AS month, scenario,
               (30 + i % 12 - 20 * step)::DOUBLE / 1000 AS gdp_growth,
               (40 + i % 12 + 15 * step)::DOUBLE / 1000 AS inflation,
               (60 + 2 * (i % 12) + 20 * step)::DOUBLE / 1000 AS base_rate,
               (55 + i % 12 + 10 * step)::DOUBLE / 1000 AS unemployment,
               (1000 + 5 * (i % 12) + 100 * step)::DOUBLE / 10 AS fx_rate,
               (100 + 2 * (i % 12) + 25 * step)::DOUBLE / 100 AS industry_stress_index
        FROM range(120) AS months(i),
             (VALUES ('base', 0), ('downside', 1), ('severe', 3), ('upside', -1)) AS s(scenario, step)""",
}

_debt = "coalesce(short_term_debt, 0) + coalesce(long_term_debt, 0)"

MARTS = {
    "asof_statement": """
        SELECT lf.facility_id, m.* EXCLUDE (facility_id) FROM loan_facilities lf LEFT JOIN (
        SELECT facility_id, fs.* EXCLUDE (company_id) FROM (
            SELECT lf.facility_id, lf.company_id, max(fs.report_date) AS d
            FROM loan_facilities lf JOIN financial_statements fs
              ON fs.company_id = lf.company_id AND fs.report_date <= lf.origination_date
            GROUP BY ALL) x
        JOIN financial_statements fs ON fs.company_id = x.company_id AND fs.report_date = x.d) m
          ON m.facility_id = lf.facility_id""",
    "asof_rating": """
        SELECT lf.facility_id, m.* EXCLUDE (facility_id) FROM loan_facilities lf LEFT JOIN (
        SELECT facility_id, rh.rating_date, rh.rating_grade AS origination_rating_grade,
               rh.pd_estimate AS origination_pd_estimate, rh.watchlist_flag, rh.restructuring_flag
        FROM (SELECT lf.facility_id, lf.company_id, max(rh.rating_date) AS d
              FROM loan_facilities lf JOIN rating_history rh
                ON rh.company_id = lf.company_id AND rh.rating_date <= lf.origination_date
              GROUP BY ALL) x
        JOIN rating_history rh ON rh.company_id = x.company_id AND rh.rating_date = x.d) m
          ON m.facility_id = lf.facility_id""",
    "collateral_rollup": """
        SELECT facility_id, max(collateral_type) AS collateral_type, sum(collateral_value) AS collateral_value,
               avg(haircut) AS avg_collateral_haircut,
               sum(collateral_value * (1 - haircut)) AS effective_collateral_value
        FROM collateral GROUP BY facility_id""",
    "payment_rollup": """
        SELECT lf.facility_id, max(days_past_due) AS max_dpd_observed,
               max(CASE WHEN payment_date <= origination_date + INTERVAL 12 MONTH THEN days_past_due END) AS max_dpd_12m,
               count(*) AS payment_months_observed, sum(scheduled_amount) AS total_scheduled_amount,
               sum(paid_amount) AS total_paid_amount
        FROM loan_facilities lf LEFT JOIN payments p ON p.facility_id = lf.facility_id
        GROUP BY lf.facility_id""",
    "recovery_rollup": """
        SELECT facility_id, sum(recovery_amount) AS total_recovery_amount,
               sum(collection_cost) AS total_collection_cost, count(*) AS recovery_events_count
        FROM recoveries GROUP BY facility_id""",
    "ratio_mart": f"""
        SELECT lf.*, lf.origination_date AS observation_date, c.* EXCLUDE (company_id),
               st.* EXCLUDE (facility_id), {_debt} AS total_debt,
               current_assets / nullif(current_liabilities, 0) AS current_ratio,
               (current_assets - coalesce(inventory, 0)) / nullif(current_liabilities, 0) AS quick_ratio,
               ({_debt}) / nullif(equity, 0) AS debt_to_equity,
               ({_debt}) / nullif(total_assets, 0) AS debt_to_assets,
               ({_debt}) / nullif(ebitda, 0) AS debt_to_ebitda,
               ebitda / nullif(interest_expense, 0) AS interest_coverage,
               ebitda / nullif(revenue, 0) AS ebitda_margin,
               net_income / nullif(revenue, 0) AS net_profit_margin,
               operating_cash_flow / nullif({_debt}, 0) AS operating_cf_to_debt,
               cash / nullif(short_term_debt, 0) AS cash_to_short_term_debt,
               equity / nullif(total_assets, 0) AS equity_to_assets,
               (revenue - revenue_prev_year) / nullif(revenue_prev_year, 0) AS revenue_growth_yoy,
               ca.* EXCLUDE (facility_id),
               outstanding_amount / nullif(collateral_value, 0) AS loan_to_value,
               collateral_value / nullif(outstanding_amount, 0) AS collateral_coverage,
               effective_collateral_value / nullif(outstanding_amount, 0) AS effective_collateral_coverage,
               ra.* EXCLUDE (facility_id), pa.* EXCLUDE (facility_id),
               total_paid_amount / nullif(total_scheduled_amount, 0) AS payment_completion_rate,
               d.* EXCLUDE (facility_id),
               CASE WHEN default_date IS NOT NULL AND default_date <= origination_date + INTERVAL 12 MONTH
                    THEN 1 ELSE 0 END AS target_default_12m,
               re.* EXCLUDE (facility_id),
               CASE WHEN ead_at_default > 0 THEN 1 - coalesce(total_recovery_amount, 0) / ead_at_default END AS realized_lgd,
               CASE WHEN revolving_flag = 1 AND undrawn_amount > 0 AND ead_at_default IS NOT NULL
                    THEN (ead_at_default - outstanding_amount) / nullif(undrawn_amount, 0) END AS realized_ccf
        FROM loan_facilities lf LEFT JOIN companies c ON c.company_id = lf.company_id
        LEFT JOIN asof_statement st ON st.facility_id = lf.facility_id
        LEFT JOIN asof_rating ra ON ra.facility_id = lf.facility_id
        LEFT JOIN collateral_rollup ca ON ca.facility_id = lf.facility_id
        LEFT JOIN payment_rollup pa ON pa.facility_id = lf.facility_id
        LEFT JOIN defaults d ON d.facility_id = lf.facility_id
        LEFT JOIN recovery_rollup re ON re.facility_id = lf.facility_id""",
    "mart": f"SELECT {', '.join(RATIO_MART_COLUMNS)} FROM ratio_mart",
    "pd_sample": f"SELECT {', '.join(PD_SAMPLE_COLUMNS)} FROM mart",
    "lgd_base": """
        SELECT mart.* REPLACE (coalesce(total_recovery_amount, 0) AS total_recovery_amount,
                               coalesce(total_collection_cost, 0) AS total_collection_cost,
                               coalesce(recovery_events_count, 0) AS recovery_events_count),
               greatest(coalesce(total_recovery_amount, 0) - coalesce(total_collection_cost, 0), 0) AS net_recovery_amount,
               ms.* EXCLUDE (month, scenario)
        FROM mart LEFT JOIN macro_scenarios ms
          ON date_trunc('month', default_date)::DATE = ms.month AND ms.scenario = 'base'
        WHERE default_date IS NOT NULL AND ead_at_default > 0""",
    "lgd_sample": f"""
        SELECT {', '.join(LGD_SAMPLE_COLUMNS)} FROM (
            SELECT * REPLACE (least(1.0::DOUBLE, greatest(0.0::DOUBLE,
                1 - net_recovery_amount / nullif(ead_at_default, 0))) AS realized_lgd) FROM lgd_base)""",
    "ccf_sample": f"""
        SELECT {', '.join(CCF_SAMPLE_COLUMNS)} FROM (
            SELECT mart.* REPLACE (least(1.5::DOUBLE, greatest(0.0::DOUBLE,
                       (ead_at_default - outstanding_amount) / nullif(undrawn_amount, 0))) AS realized_ccf),
                   outstanding_amount / nullif(limit_amount, 0) AS utilization_rate, ms.* EXCLUDE (month, scenario)
            FROM mart LEFT JOIN macro_scenarios ms
              ON date_trunc('month', default_date)::DATE = ms.month AND ms.scenario = 'base'
            WHERE default_date IS NOT NULL AND revolving_flag = 1 AND undrawn_amount > 0
              AND ead_at_default IS NOT NULL)""",
    "current_rating": f"""
        SELECT company_id, rating_date AS current_rating_date, rating_grade AS current_rating_grade,
               pd_estimate AS current_pd_estimate, watchlist_flag AS current_watchlist_flag,
               restructuring_flag AS current_restructuring_flag
        FROM rating_history WHERE rating_date <= {REPORTING_DATE}
        QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY rating_date DESC) = 1""",
    "latest_payment": f"""
        SELECT facility_id, payment_date AS latest_payment_date, days_past_due AS current_dpd,
               outstanding_balance AS current_outstanding_balance
        FROM payments WHERE payment_date <= {REPORTING_DATE}
        QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY payment_date DESC, payment_id DESC,
                                   days_past_due DESC, outstanding_balance DESC) = 1""",
    "staging_sample": f"""
        SELECT {', '.join(STAGING_SAMPLE_COLUMNS)} FROM (
        SELECT m.* REPLACE (coalesce(cr.current_watchlist_flag, m.watchlist_flag, 0) AS watchlist_flag,
                            coalesce(cr.current_restructuring_flag, m.restructuring_flag, 0) AS restructuring_flag),
               {REPORTING_DATE} AS reporting_date,
               {_grade_order('origination_rating_grade')} AS origination_rating_order,
               current_rating_date, current_rating_grade,
               {_grade_order('current_rating_grade')} AS current_rating_order, current_pd_estimate,
               latest_payment_date, coalesce(lp.current_dpd, 0) AS current_dpd,
               coalesce(lp.current_outstanding_balance, m.outstanding_amount) AS current_outstanding_balance,
               CASE WHEN default_date IS NOT NULL OR coalesce(writeoff_flag, 0) = 1
                      OR coalesce(dpd_at_default, 0) >= 90 OR coalesce(lp.current_dpd, 0) >= 90
                    THEN 1 ELSE 0 END AS default_flag,
               CASE WHEN origination_pd_estimate > 0 THEN current_pd_estimate / origination_pd_estimate END
                    AS pd_ratio_current_to_origination,
               {_grade_order('current_rating_grade')} - {_grade_order('origination_rating_grade')}
                    AS rating_downgrade_notches
        FROM mart m LEFT JOIN current_rating cr ON cr.company_id = m.company_id
        LEFT JOIN latest_payment lp ON lp.facility_id = m.facility_id)""",
}

_impaired = "(default_flag = 1 OR coalesce(writeoff_flag, 0) = 1 OR coalesce(current_dpd, 0) >= 90 OR coalesce(dpd_at_default, 0) >= 90)"
_increased = (
    "(coalesce(rating_downgrade_notches, 0) >= 2 OR coalesce(pd_ratio_current_to_origination, 0) >= 2 "
    "OR coalesce(current_dpd, 0) >= 30 OR coalesce(watchlist_flag, 0) = 1 OR coalesce(restructuring_flag, 0) = 1)"
)


def _scenario_sql(prefix: str, scenario: str, f: dict, pd_factor: str = "") -> str:
    pd = f"least(1.0::DOUBLE, pd_12m_base * {f['pd']}::DOUBLE{pd_factor})"
    lgd = f"least(1.0::DOUBLE, lgd_base * {f['lgd']}::DOUBLE)"
    ccf = f"least(1.5::DOUBLE, ccf_base * {f['ccf']}::DOUBLE)"
    life = f"(1 - pow(1 - {pd}, remaining_life_years))"
    ead = f"(drawn + {ccf} * undrawn)"
    used = f"CASE ifrs9_stage WHEN 2 THEN {life} WHEN 3 THEN 1.0::DOUBLE ELSE {pd} END"
    return (
        f"{pd} AS {prefix}pd_12m_{scenario}, {life} AS {prefix}lifetime_pd_{scenario}, "
        f"{lgd} AS {prefix}lgd_{scenario}, {ccf} AS {prefix}ccf_{scenario}, {ead} AS {prefix}ead_{scenario}, "
        f"({used}) * {lgd} * {ead} AS {prefix}ecl_{scenario}"
    )


_sensitivity = (
    "CASE industry WHEN 'construction' THEN 1.35 WHEN 'real_estate' THEN 1.3 WHEN 'trade' THEN 1.15 "
    "WHEN 'transport' THEN 1.12 WHEN 'agriculture' THEN 1.1 WHEN 'manufacturing' THEN 1.08 "
    "WHEN 'services' THEN 1.0 WHEN 'energy' THEN 0.95 ELSE 1.0 END::DOUBLE"
)


def _industry_sql(scenario: str, factor: float) -> str:
    extra = ""
    if scenario == "fx_shock":
        extra = " + CASE WHEN industry IN ('trade','manufacturing','transport','agriculture') THEN 0.2::DOUBLE ELSE 0 END"
    return f" * greatest(0.75::DOUBLE, least(2.5::DOUBLE, 1 + ({_sensitivity} - 1) * {factor}::DOUBLE{extra}))"


_loss = (
    "count(*) AS facilities, sum(ead_base) AS total_ead, sum(scenario_weighted_ecl) AS total_ecl, "
    "avg(scenario_weighted_ecl) AS avg_ecl, avg(pd_12m_base) AS avg_pd_12m, avg(lgd_base) AS avg_lgd"
)
_stage_measures = (
    "count(*) AS facilities, sum(outstanding_amount) AS total_outstanding, avg(current_pd_estimate) AS avg_current_pd, "
    "avg(origination_pd_estimate) AS avg_origination_pd, avg(default_flag) AS default_rate"
)

IMPAIRMENT = {
    "staged": f"""
        SELECT *, CASE WHEN {_impaired} THEN 3 WHEN {_increased} THEN 2 ELSE 1 END AS ifrs9_stage,
               CASE WHEN {_impaired} THEN 'default_or_90dpd' WHEN {_increased} THEN
                 concat_ws('+', CASE WHEN rating_downgrade_notches >= 2 THEN 'rating_downgrade_2plus' END,
                   CASE WHEN pd_ratio_current_to_origination >= 2 THEN 'pd_doubled' END,
                   CASE WHEN current_dpd >= 30 THEN '30dpd' END,
                   CASE WHEN watchlist_flag = 1 THEN 'watchlist' END,
                   CASE WHEN restructuring_flag = 1 THEN 'restructuring' END)
               ELSE 'performing' END AS ifrs9_stage_reason
        FROM staging_sample""",
    "stage_assignment": "SELECT facility_id, ifrs9_stage, ifrs9_stage_reason FROM staged",
    "stage_validation_summary": f"SELECT ifrs9_stage, {_stage_measures} FROM staged GROUP BY ifrs9_stage",
    "stage_distribution": """
        SELECT *, facilities / sum(facilities) OVER () AS facility_share,
               total_outstanding / sum(total_outstanding) OVER () AS outstanding_share
        FROM stage_validation_summary""",
    "stage_by_rating": """
        SELECT current_rating_grade, ifrs9_stage, count(*) AS facilities,
               sum(outstanding_amount) AS total_outstanding, avg(current_pd_estimate) AS avg_current_pd,
               avg(default_flag) AS default_rate
        FROM staged GROUP BY current_rating_grade, ifrs9_stage""",
    "migration_matrix": """
        SELECT coalesce(origination_rating_grade, 'missing') AS origination_rating_grade,
               coalesce(current_rating_grade, 'missing') AS current_rating_grade, count(*) AS facilities
        FROM staged GROUP BY 1, 2""",
    "risk_parameters": """
        SELECT *,
               greatest(0.25::DOUBLE, (maturity_date - reporting_date) / 365.25::DOUBLE) AS remaining_life_years,
               coalesce(current_pd_estimate, origination_pd_estimate, 0.02::DOUBLE) AS pd_12m_base,
               least(0.95::DOUBLE, greatest(0.05::DOUBLE,
                   0.72::DOUBLE - 0.28::DOUBLE * least(2.5::DOUBLE, greatest(0::DOUBLE, coalesce(effective_collateral_coverage, 0)))
                   + CASE WHEN coalesce(collateral_type, 'none') = 'none' THEN 0.12::DOUBLE ELSE 0 END)) AS lgd_base,
               (CASE product_type WHEN 'credit_line' THEN 0.45 WHEN 'overdraft' THEN 0.75 WHEN 'trade_finance' THEN 0.35
                    ELSE CASE WHEN revolving_flag = 1 THEN 0.4 ELSE 0 END END)::DOUBLE AS ccf_base,
               greatest(current_outstanding_balance, 0) AS drawn, greatest(undrawn_amount, 0) AS undrawn
        FROM staged""",
    "ecl_base": "SELECT *, drawn + ccf_base * undrawn AS ead_base FROM risk_parameters",
    "ecl_scenarios": "SELECT * EXCLUDE (pd_12m_base, lgd_base, ccf_base, ead_base), " + ", ".join(_scenario_sql("", s, f) for s, f in SCENARIO_FACTORS.items()) + " FROM ecl_base",
    "ecl": "SELECT *, " + " + ".join(f"ecl_{s} * {w}::DOUBLE" for s, w in SCENARIO_WEIGHTS.items())
    + " AS scenario_weighted_ecl FROM ecl_scenarios",
    "ecl_facility": "SELECT facility_id, ifrs9_stage, remaining_life_years, "
    + ", ".join(f"{m}_{s}" for s in SCENARIO_FACTORS for m in ("pd_12m", "lifetime_pd", "lgd", "ccf", "ead", "ecl"))
    + ", scenario_weighted_ecl FROM ecl",
    "ecl_by_scenario": " UNION ALL ".join(
        f"SELECT '{s}' AS scenario, {SCENARIO_WEIGHTS[s]}::DOUBLE AS scenario_weight, sum(ecl_{s}) AS total_ecl, "
        f"avg(ecl_{s}) AS avg_ecl, sum(ead_{s}) AS total_ead, avg(pd_12m_{s}) AS avg_pd_12m, avg(lgd_{s}) AS avg_lgd FROM ecl"
        for s in SCENARIO_FACTORS
    ),
    "ecl_by_stage": f"SELECT ifrs9_stage, {_loss} FROM ecl GROUP BY ifrs9_stage",
    "ecl_by_rating": f"SELECT current_rating_grade, {_loss} FROM ecl GROUP BY current_rating_grade",
    "ecl_by_industry": f"SELECT industry, {_loss} FROM ecl GROUP BY industry",
    "ecl_cube": f"""
        SELECT 'portfolio' AS dimension, NULL::VARCHAR AS member, {_loss} FROM ecl
        UNION ALL SELECT 'ifrs9_stage', ifrs9_stage::VARCHAR, {_loss} FROM ecl GROUP BY ifrs9_stage
        UNION ALL SELECT 'current_rating_grade', current_rating_grade, {_loss} FROM ecl GROUP BY current_rating_grade
        UNION ALL SELECT 'industry', industry, {_loss} FROM ecl GROUP BY industry""",
    "ecl_portfolio": """
        SELECT count(*) AS facilities, sum(ead_base) AS total_ead, sum(scenario_weighted_ecl) AS total_ecl,
               sum(scenario_weighted_ecl) / sum(ead_base) AS ecl_rate, avg(pd_12m_base) AS avg_pd_12m,
               avg(lgd_base) AS avg_lgd, avg((ifrs9_stage = 1)::INTEGER) AS stage_1_share,
               avg((ifrs9_stage = 2)::INTEGER) AS stage_2_share, avg((ifrs9_stage = 3)::INTEGER) AS stage_3_share
        FROM ecl""",
    "ecl_validation_summary": "SELECT * EXCLUDE (ecl_rate) FROM ecl_portfolio",
    "stress": "SELECT *, "
    + ", ".join(_scenario_sql("stress_", s, f, _industry_sql(s, f["industry"])) for s, f in STRESS_SCENARIOS.items())
    + " FROM ecl_base",
    "stress_facility": "SELECT facility_id, industry, "
    + ", ".join(
        f"stress_{m}_{s}" for s in STRESS_SCENARIOS for m in ("pd_12m", "lifetime_pd", "lgd", "ccf", "ead", "ecl")
    )
    + " FROM stress",
    "stress_long": " UNION ALL ".join(
        f"SELECT '{s}' AS scenario, ifrs9_stage, industry, stress_ead_{s} AS ead, stress_ecl_{s} AS ecl, "
        f"stress_pd_12m_{s} AS pd, stress_lgd_{s} AS lgd, stress_ccf_{s} AS ccf FROM stress"
        for s in STRESS_SCENARIOS
    ),
    "stress_totals": """
        SELECT scenario, count(*) AS facilities, sum(ead) AS total_ead, sum(ecl) AS total_ecl,
               sum(ecl) / sum(ead) AS ecl_rate, avg(pd) AS avg_pd_12m, avg(lgd) AS avg_lgd, avg(ccf) AS avg_ccf
        FROM stress_long GROUP BY scenario""",
    "stress_summary": """
        SELECT t.*, t.total_ecl - b.total_ecl AS ecl_change_vs_base,
               (t.total_ecl - b.total_ecl) / b.total_ecl AS ecl_change_pct_vs_base
        FROM stress_totals t, (SELECT total_ecl FROM stress_totals WHERE scenario = 'base') b""",
    "stress_by_stage": """
        SELECT scenario, ifrs9_stage, count(*) AS facilities, sum(ead) AS total_ead, sum(ecl) AS total_ecl,
               avg(pd) AS avg_pd_12m, avg(lgd) AS avg_lgd FROM stress_long GROUP BY scenario, ifrs9_stage""",
    "stress_by_industry": """
        SELECT scenario, industry, count(*) AS facilities, sum(ead) AS total_ead, sum(ecl) AS total_ecl,
               avg(pd) AS avg_pd_12m, avg(lgd) AS avg_lgd FROM stress_long GROUP BY scenario, industry""",
}

_SQL_TABLES = {
    "mart.financial_ratios_mart": "mart", "mart.pd_modeling_sample": "pd_sample",
    "mart.lgd_modeling_sample": "lgd_sample", "mart.ead_ccf_modeling_sample": "ccf_sample",
    "mart.ifrs9_staging_sample": "staging_sample",
}


def _quality_sql() -> str:
    def table(name: str) -> str:
        return _SQL_TABLES.get(name, name.removeprefix("raw."))

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def check(group, name, tab, metric, value, threshold, status, details, source=None):
        return (
            f"SELECT '{group}' AS check_group, '{name}' AS check_name, '{tab}' AS table_name, '{metric}' AS metric_name, "
            f"({value})::DOUBLE AS metric_value, {threshold}::DOUBLE AS threshold_value, {status} AS status, "
            f"{quoted(details)} AS details FROM {source or table(tab)}"
        )

    rows = [
        check("row_count", name, tab, "rows", "count(*)", 1, f"CASE WHEN count(*) > 0 THEN 'PASS' ELSE '{empty}' END", details)
        for tab, name, empty, details in ROW_COUNT_CHECKS
    ]
    for group, name, tab, metric, condition, bad, details in BAD_ROW_CHECKS:
        n = f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"
        rows.append(check(group, name, tab, metric, n, 0, f"CASE WHEN {n} = 0 THEN 'PASS' ELSE '{bad}' END", details))
    for name, tab, keys, details in DUPLICATE_CHECKS:
        key = keys[0] if len(keys) == 1 else f"({', '.join(keys)})"
        n = f"count(*) - count(DISTINCT {key})"
        rows.append(check("duplicate_check", name, tab, "duplicate_count", n, 0, f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END", details))
    for group, name, tab, metric, column, low, high, bad, details in AVERAGE_CHECKS:
        a = f"avg({column})"
        rows.append(check(group, name, tab, metric, a, "NULL", f"CASE WHEN {a} BETWEEN {low} AND {high} THEN 'PASS' ELSE '{bad}' END", details))
    dates = [
        ("payment more than 31 days before origination", "raw.payments",
         "payments e JOIN loan_facilities r ON e.facility_id = r.facility_id WHERE payment_date < origination_date - 31",
         "invalid_count", "FAIL",
         "Payment date should not be materially earlier than facility origination date. A 31-day tolerance allows "
         "monthly synthetic payment snapshots."),
        ("payment within 31 days before origination", "raw.payments",
         "payments e JOIN loan_facilities r ON e.facility_id = r.facility_id "
         "WHERE payment_date < origination_date AND payment_date >= origination_date - 31", "warning_count", "WARN",
         "Some monthly synthetic payment snapshots can fall shortly before origination when a facility starts mid-month."),
        ("default before origination", "raw.defaults",
         "defaults e JOIN loan_facilities r ON e.facility_id = r.facility_id WHERE default_date < origination_date",
         "invalid_count", "FAIL", "Default date should not be earlier than facility origination date."),
        ("recovery before default", "raw.recoveries",
         "recoveries e JOIN defaults r ON e.facility_id = r.facility_id WHERE recovery_date < default_date",
         "invalid_count", "FAIL", "Recovery date should not be earlier than default date."),
    ]
    for name, tab, source, metric, bad, details in dates:
        status = f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE '{bad}' END"
        rows.append(check("date_check", name, tab, metric, "count(*)", 0, status, details, source))
    for number, condition in [
        (1, f"NOT {_impaired} AND NOT {_increased}"), (2, f"NOT {_impaired} AND {_increased}"), (3, _impaired),
    ]:
        rows.append(
            check("ifrs9_stage_distribution", f"stage {number} facilities", "mart.ifrs9_staging_sample", "facilities",
                  "count(*)", "NULL", "'INFO'", STAGE_DETAILS, f"staging_sample WHERE {condition}")
        )
    return " UNION ALL ".join(rows)


def _outlier_sql(area: str, source: str, rows_details: str, checks: list[tuple]) -> str:
    parts = [
        f"SELECT '{area}' AS area, 'rows' AS check_name, 'rows' AS metric_name, count(*)::DOUBLE AS metric_value, "
        f"'INFO' AS status, '{rows_details}' AS details FROM {source}"
    ]
    for name, metric, condition, bad, details in checks:
        parts.append(
            f"SELECT '{area}', '{name}', '{metric}', (count(*) FILTER ({condition}))::DOUBLE, "
            f"CASE WHEN count(*) FILTER ({condition}) = 0 THEN 'PASS' ELSE '{bad}' END, '{details}' FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _split_sql(source: str, date: str) -> str:
    return f"""
        SELECT * EXCLUDE (rn, n),
               CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train'
                    WHEN rn <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'valid' ELSE 'oot' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY {date}, facility_id) AS rn, count(*) OVER () AS n FROM {source})"""


def _split_summary_sql(source: str, date: str, target: str, rate: str) -> str:
    return (
        f"SELECT split, count(*) AS rows, min({date}) AS min_date, max({date}) AS max_date, avg({target}) AS {rate} "
        f"FROM {source} GROUP BY split"
    )


def _binned_sql(source: str, score: str, bins: int, name: str) -> str:
    return f"""
        SELECT * EXCLUDE (rn, n), greatest(1, ((rn - 1) * least({bins}, n) + n - 2) // (n - 1)) AS {name}
        FROM (SELECT *, row_number() OVER (ORDER BY {score}, facility_id) AS rn, count(*) OVER () AS n FROM {source})"""


def _binary_metrics_sql(source: str, keys: str) -> str:
    """Rank metrics by windows over every row, ties taken from RANGE frames."""
    return f"""
        SELECT {keys}, count(*) AS rows,
               sum(CASE WHEN y = 0 THEN above + ties / 2 END) / any_value(p) / any_value(q) AS roc_auc,
               2 * (sum(CASE WHEN y = 0 THEN above + ties / 2 END) / any_value(p) / any_value(q)) - 1 AS gini,
               greatest(max((above + ties) / p - (seen - above - ties) / q), 0) AS ks,
               sum(CASE WHEN y = 1 THEN (above + ties) / seen / p END) AS average_precision,
               avg((score - y) * (score - y)) AS brier_score, avg(score) AS mean_predicted_pd,
               avg(y) AS observed_default_rate
        FROM (SELECT {keys}, score, y::DOUBLE AS y,
                     sum(y) OVER (PARTITION BY {keys})::DOUBLE AS p, sum(1 - y) OVER (PARTITION BY {keys})::DOUBLE AS q,
                     sum(y) OVER (PARTITION BY {keys}, score)::DOUBLE AS ties,
                     (sum(y) OVER (PARTITION BY {keys} ORDER BY score DESC) - sum(y) OVER (PARTITION BY {keys}, score))::DOUBLE AS above,
                     (count(*) OVER (PARTITION BY {keys} ORDER BY score DESC))::DOUBLE AS seen
              FROM {source})
        GROUP BY {keys}"""


_pd_measures = (
    "count(*) AS facilities, sum({t})::BIGINT AS {d}, avg({t}) AS observed_default_rate, avg({s}) AS avg_predicted_pd, "
    "min({s}) AS min_predicted_pd, max({s}) AS max_predicted_pd"
)


def _pd_measures_sql(score: str, target: str, defaults: str) -> str:
    return _pd_measures.format(s=score, t=target, d=defaults)


_erfc_terms = [
    "-1.26551223", "1.00002368", "0.37409196", "0.09678418", "-0.18628806",
    "0.27886807", "-1.13520398", "1.48851587", "-0.82215223", "0.17087277",
]


def _erfc_sql(x: str) -> str:
    t = f"(1 / (1 + 0.5::DOUBLE * {x}))"
    series = " + ".join(f"({c}::DOUBLE) * pow({t}, {i})" for i, c in enumerate(_erfc_terms))
    return f"{t} * exp(-{x} * {x} + {series})"


_p_value = f"""(SELECT least(1, greatest(0, {_erfc_sql('z')})) FROM (SELECT
    abs(defaults - facilities * avg_predicted_pd) / sqrt(facilities * avg_predicted_pd * (1 - avg_predicted_pd)) / sqrt(2::DOUBLE) AS z))"""

_wilson_centre = "((observed_default_rate + 3.8416::DOUBLE / (2 * facilities)) / (1 + 3.8416::DOUBLE / facilities))"
_wilson_half = (
    "(1.96::DOUBLE * sqrt(observed_default_rate * (1 - observed_default_rate) / facilities "
    "+ 3.8416::DOUBLE / (4 * facilities * facilities)) / (1 + 3.8416::DOUBLE / facilities))"
)


def _severity_sql(keys: str, source: str, actual: str, predicted: str, m: str, with_mean: bool) -> str:
    mean = "avg(ead_at_default) AS avg_ead, " if with_mean else ""
    return (
        f"SELECT {keys}, count(*) AS facilities, avg({actual}) AS avg_actual_{m}, avg({predicted}) AS avg_predicted_{m}, "
        f"{mean}sum(ead_at_default) AS total_ead, avg({predicted}) - avg({actual}) AS prediction_error FROM {source}"
    )


_SEGMENTS = ["product_type", "collateral_type", "industry", "company_size", "origination_rating_grade"]
_w = "greatest(coalesce(ead_at_default, 1), 1)"


def _regression_sql(source: str, actual: str) -> str:
    e = f"(predicted - {actual})"
    return (
        f"SELECT model, split, count(*) AS rows, avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse, "
        f"avg({actual}) AS mean_actual, avg(predicted) AS mean_predicted, sum({_w} * abs({e})) / sum({_w}) AS weighted_mae, "
        f"sqrt(sum({_w} * {e} * {e}) / sum({_w})) AS weighted_rmse FROM {source} GROUP BY model, split"
    )


def _max_good(v: str, green: float, amber: float) -> str:
    return f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN {v} <= {green} THEN 'GREEN' WHEN {v} <= {amber} THEN 'AMBER' ELSE 'RED' END"


def _min_good(v: str, green: float, amber: float) -> str:
    return f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN {v} >= {green} THEN 'GREEN' WHEN {v} >= {amber} THEN 'AMBER' ELSE 'RED' END"


def _band_good(v: str, a: float, b: float, c: float, d: float) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN {v} BETWEEN {a} AND {b} THEN 'GREEN' "
        f"WHEN {v} BETWEEN {c} AND {d} THEN 'AMBER' ELSE 'RED' END"
    )


def _light_sql(area, metric, value, green, amber, red, status, comment, source) -> str:
    return (
        f"SELECT '{area}' AS area, '{metric}' AS metric, round(({value})::DOUBLE, 6) AS value, '{green}' AS green_threshold, "
        f"'{amber}' AS amber_threshold, '{red}' AS red_threshold, {status} AS status, '{comment}' AS comment FROM {source}"
    )


def _kpi_sql(area, metric, value, comment, source, digits=None) -> str:
    if digits is not None:
        value = f"round(({value})::DOUBLE, {digits})::DECIMAL(30, {digits})"
    return f"SELECT '{area}' AS area, '{metric}' AS metric, ({value})::VARCHAR AS value, '{comment}' AS comment FROM {source}"


_WINSORIZED = ["debt_to_ebitda", "interest_coverage", "revenue_growth_yoy"]

VALIDATION = {
    "data_quality": _quality_sql(),
    "lgd_p99": "SELECT quantile_cont(ead_at_default, 0.99) * 3 AS bound FROM lgd_sample",
    "lgd_checked": "SELECT * FROM lgd_sample, lgd_p99",
    "lgd_outliers": _outlier_sql("LGD", "lgd_checked", "Rows in LGD diagnostics input.", [
        ("lgd outside 0 1 bounds", "invalid_count", "realized_lgd < 0 OR realized_lgd > 1", "FAIL", "realized_lgd should be between 0 and 1."),
        ("non positive ead", "invalid_count", "ead_at_default <= 0", "FAIL", "ead_at_default should be positive."),
        ("very high ead", "outlier_count", "ead_at_default > bound", "WARN", "ead_at_default greater than 3x p99 is treated as an exposure outlier."),
        ("negative recoveries", "invalid_count", "total_recovery_amount < 0", "FAIL", "total_recovery_amount should not be negative."),
        ("recovery greater than ead", "warning_count", "total_recovery_amount > ead_at_default", "WARN", "Total recovery greater than EAD is possible in synthetic data but should be reviewed."),
        ("negative collection cost", "invalid_count", "total_collection_cost < 0", "FAIL", "total_collection_cost should not be negative."),
        ("extreme collection cost", "warning_count", "total_collection_cost > ead_at_default * 0.5", "WARN", "Collection cost greater than 50% of EAD is treated as an outlier."),
    ]),
    "ccf_p99": "SELECT quantile_cont(ead_at_default, 0.99) * 3 AS bound FROM ccf_sample",
    "ccf_checked": "SELECT * FROM ccf_sample, ccf_p99",
    "ccf_outliers": _outlier_sql("EAD_CCF", "ccf_checked", "Rows in EAD/CCF diagnostics input.", [
        ("ccf outside 0 1.5 bounds", "invalid_count", "realized_ccf < 0 OR realized_ccf > 1.5", "FAIL", "realized_ccf should be between 0 and 1.5."),
        ("non positive ead", "invalid_count", "ead_at_default <= 0", "FAIL", "ead_at_default should be positive."),
        ("very high ead", "outlier_count", "ead_at_default > bound", "WARN", "ead_at_default greater than 3x p99 is treated as an exposure outlier."),
        ("zero or negative undrawn amount", "warning_count", "undrawn_amount <= 0", "WARN", "undrawn_amount should be positive for CCF modeling rows."),
        ("negative outstanding amount", "invalid_count", "outstanding_amount < 0", "FAIL", "outstanding_amount should not be negative."),
        ("ead materially greater than limit", "warning_count", "ead_at_default > limit_amount * 1.5", "WARN", "EAD greater than 1.5x limit amount should be reviewed."),
    ]),
    "financial_ratios": f"""
        SELECT company_id, report_date, {_debt} AS total_debt, current_assets / nullif(current_liabilities, 0) AS current_ratio,
               (current_assets - inventory) / nullif(current_liabilities, 0) AS quick_ratio,
               ({_debt}) / nullif(equity, 0) AS debt_to_equity, ({_debt}) / nullif(total_assets, 0) AS debt_to_assets,
               ({_debt}) / nullif(ebitda, 0) AS debt_to_ebitda, ebitda / nullif(interest_expense, 0) AS interest_coverage,
               ebitda / nullif(revenue, 0) AS ebitda_margin, net_income / nullif(revenue, 0) AS net_profit_margin,
               operating_cash_flow / nullif({_debt}, 0) AS operating_cf_to_debt,
               cash / nullif(short_term_debt, 0) AS cash_to_short_term_debt, equity / nullif(total_assets, 0) AS equity_to_assets,
               (revenue - revenue_prev_year) / nullif(revenue_prev_year, 0) AS revenue_growth_yoy
        FROM financial_statements""",
    "winsor_bounds": "SELECT "
    + ", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in _WINSORIZED)
    + " FROM financial_ratios",
    "winsorized_ratios": "SELECT company_id, report_date, "
    + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN greatest({c}_lo, least({c}_hi, {c})) END AS {c}" for c in _WINSORIZED
    )
    + " FROM financial_ratios, winsor_bounds",
    "filled_columns": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS filled_rows FROM mart" for c in RATIO_MART_COLUMNS),
    "leakage_categories": """
        SELECT *, CASE
            WHEN "column" LIKE '%\\_id' ESCAPE '\\' THEN 'id'
            WHEN contains("column", 'target') THEN 'target'
            WHEN "column" IN ('default_date', 'default_type', 'dpd_at_default', 'ead_at_default') OR contains("column", 'writeoff') THEN 'default_outcome'
            WHEN regexp_matches("column", 'recover(y|ies|ed)|collection') THEN 'recovery_outcome'
            WHEN regexp_matches("column", 'realized_(lgd|ccf)|(lgd|ead)_proxy') THEN 'lgd_ead_outcome'
            WHEN regexp_matches("column", 'future|next_|12m|6m|max_dpd|max_observed|first_90|observed_mob') THEN 'future_performance'
            WHEN "column" LIKE '%\\_date' ESCAPE '\\' THEN 'date' END AS category
        FROM filled_columns""",
    "leakage_report": """
        SELECT "column", category, filled_rows, CASE category
            WHEN 'id' THEN 'Identifier columns are not model features.'
            WHEN 'date' THEN 'Date columns are used for splitting or event timing, not directly as PD features.'
            WHEN 'target' THEN 'Target columns directly encode the modeling outcome.'
            WHEN 'default_outcome' THEN 'Default outcome fields are only known after the observation date.'
            WHEN 'recovery_outcome' THEN 'Recovery and collection fields are post-default outcomes.'
            WHEN 'lgd_ead_outcome' THEN 'LGD/EAD realized outcome fields are not valid PD predictors.'
            WHEN 'future_performance' THEN 'Future performance fields can leak post-observation information.' END AS reason
        FROM leakage_categories WHERE category IS NOT NULL""",
    "order_texts": "SELECT o_orderkey::VARCHAR AS order_text, o_totalprice::VARCHAR AS price_text, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE o_custkey::VARCHAR END AS customer_text, "
    "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE o_custkey::VARCHAR END AS mostly_number_text, o_orderpriority FROM orders",
    "numeric_coercion": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS filled, count(try_cast({c} AS DOUBLE)) AS numeric FROM order_texts"
        for c in ["order_text", "price_text", "customer_text", "mostly_number_text", "o_orderpriority"]
    ),
    "pd_rows": "SELECT facility_id, observation_date, target_default_12m, origination_pd_estimate FROM mart",
    "pd_split": _split_sql("pd_rows", "observation_date"),
    "pd_time_split": _split_summary_sql("pd_split", "observation_date", "target_default_12m", "default_rate"),
    "lgd_split": _split_sql("lgd_sample", "default_date"),
    "lgd_time_split": _split_summary_sql("lgd_split", "default_date", "realized_lgd", "avg_lgd"),
    "ccf_split": _split_sql("ccf_sample", "default_date"),
    "ccf_time_split": _split_summary_sql("ccf_split", "default_date", "realized_ccf", "avg_ccf"),
    "pd_oot": "SELECT * FROM pd_split WHERE split = 'oot' AND origination_pd_estimate IS NOT NULL",
    "pd_binned": _binned_sql("pd_oot", "origination_pd_estimate", 10, "pd_decile"),
    "pd_calibration_bins": f"""
        SELECT *, avg_predicted_pd - observed_default_rate AS calibration_error FROM (
            SELECT pd_decile, {_pd_measures_sql('origination_pd_estimate', 'target_default_12m', 'defaults')}
            FROM pd_binned GROUP BY pd_decile)""",
    "lgd_scored": """
        SELECT *, least(0.95::DOUBLE, greatest(0.05::DOUBLE,
                   0.72::DOUBLE - 0.28::DOUBLE * least(2.5::DOUBLE, greatest(0::DOUBLE, coalesce(effective_collateral_coverage, 0)))
                   + CASE WHEN coalesce(collateral_type, 'none') = 'none' THEN 0.12::DOUBLE ELSE 0 END)) AS lgd_rule
        FROM lgd_split""",
    "ccf_scored": """
        SELECT *, (CASE product_type WHEN 'credit_line' THEN 0.45 WHEN 'overdraft' THEN 0.75 WHEN 'trade_finance' THEN 0.35
                    ELSE 0.4 END)::DOUBLE AS ccf_rule FROM ccf_split""",
    "lgd_oot": "SELECT * FROM lgd_scored WHERE split = 'oot'",
    "ccf_oot": "SELECT * FROM ccf_scored WHERE split = 'oot'",
    "lgd_binned": _binned_sql("lgd_oot", "lgd_rule", 5, "lgd_decile"),
    "lgd_calibration_bins": _severity_sql("lgd_decile", "lgd_binned", "realized_lgd", "lgd_rule", "lgd", False) + " GROUP BY lgd_decile",
    "ccf_binned": _binned_sql("ccf_oot", "ccf_rule", 5, "ccf_decile"),
    "ccf_calibration_bins": _severity_sql("ccf_decile", "ccf_binned", "realized_ccf", "ccf_rule", "ccf", False) + " GROUP BY ccf_decile",
    "lgd_by_segment": " UNION ALL ".join(
        _severity_sql(f"'{s}' AS segment_type, {s} AS segment", "lgd_oot", "realized_lgd", "lgd_rule", "lgd", True) + f" GROUP BY {s}"
        for s in _SEGMENTS
    ),
    "ccf_by_product": _severity_sql("product_type", "ccf_oot", "realized_ccf", "ccf_rule", "ccf", True) + " GROUP BY product_type",
    "two_pds": f"""
        SELECT * FROM ({_split_sql('staging_sample', 'observation_date')}) WHERE split = 'oot'""",
    "pd_scores_long": """
        SELECT 'origination' AS model, facility_id, target_default_12m, origination_pd_estimate AS predicted_pd FROM two_pds
        UNION ALL SELECT 'current', facility_id, target_default_12m, current_pd_estimate FROM two_pds""",
    "score_edges": """
        SELECT model, quantile_cont(predicted_pd, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges
        FROM pd_scores_long WHERE predicted_pd IS NOT NULL GROUP BY model""",
    "score_binned": """
        SELECT s.*, greatest(1, len(list_filter(list_distinct(edges), lambda e: e < predicted_pd))) AS pd_decile
        FROM pd_scores_long s JOIN score_edges USING (model) WHERE predicted_pd IS NOT NULL""",
    "quantile_calibration_bins": f"""
        SELECT *, avg_predicted_pd - observed_default_rate AS calibration_error FROM (
            SELECT model, pd_decile, {_pd_measures_sql('predicted_pd', 'target_default_12m', 'observed_defaults')}
            FROM score_binned GROUP BY model, pd_decile)""",
    "mean_observed_by_bin": "SELECT pd_decile, avg(observed_default_rate) AS observed_default_rate FROM quantile_calibration_bins GROUP BY pd_decile",
    "pd_model_rows": """
        SELECT 'origination_pd' AS model, split, origination_pd_estimate AS score, target_default_12m AS y FROM pd_split
        WHERE origination_pd_estimate IS NOT NULL
        UNION ALL
        SELECT 'dummy_prior', split, (SELECT avg(target_default_12m) FROM pd_split WHERE split = 'train'), target_default_12m
        FROM pd_split""",
    "binary_metrics": _binary_metrics_sql("pd_model_rows", "model, split"),
    "label_rows": "SELECT lang, n_chars::DOUBLE AS score, toxic AS y FROM labels JOIN documents USING (doc_id)",
    "label_all": "SELECT 'all' AS scope, score, y FROM label_rows",
    "label_metrics": "SELECT * EXCLUDE (brier_score) FROM (" + _binary_metrics_sql("label_all", "scope") + ")",
    "lgd_model_rows": """
        SELECT 'collateral_rule' AS model, split, realized_lgd, lgd_rule AS predicted, ead_at_default FROM lgd_scored
        UNION ALL SELECT 'dummy_mean', split, realized_lgd, (SELECT avg(realized_lgd) FROM lgd_scored WHERE split = 'train'),
               ead_at_default FROM lgd_scored""",
    "lgd_regression_metrics": _regression_sql("lgd_model_rows", "realized_lgd"),
    "ccf_model_rows": """
        SELECT 'product_rule' AS model, split, realized_ccf, ccf_rule AS predicted, ead_at_default FROM ccf_scored
        UNION ALL SELECT 'dummy_mean', split, realized_ccf, (SELECT avg(realized_ccf) FROM ccf_scored WHERE split = 'train'),
               ead_at_default FROM ccf_scored""",
    "ccf_regression_metrics": _regression_sql("ccf_model_rows", "realized_ccf"),
    "grade_report": f"""
        SELECT {_grade('origination_pd_estimate')} AS rating_grade,
               {_pd_measures_sql('origination_pd_estimate', 'target_default_12m', 'defaults')}
        FROM pd_oot GROUP BY 1""",
    "pd_backtest": f"""
        SELECT *, avg_predicted_pd - observed_default_rate AS calibration_error,
               greatest(0, {_wilson_centre} - {_wilson_half}) AS observed_default_rate_lower_ci,
               least(1, {_wilson_centre} + {_wilson_half}) AS observed_default_rate_upper_ci FROM grade_report""",
    "confidence_bands": f"""
        SELECT rating_grade, coalesce({_grade_order('rating_grade')}, 99) AS grade_order, avg_predicted_pd, observed_default_rate,
               greatest(observed_default_rate - observed_default_rate_lower_ci, 0) AS lower_error,
               greatest(observed_default_rate_upper_ci - observed_default_rate, 0) AS upper_error FROM pd_backtest""",
    "actual_vs_predicted": """
        SELECT rating_grade, 'observed_default_rate' AS series, observed_default_rate AS value FROM pd_backtest
        UNION ALL SELECT rating_grade, 'avg_predicted_pd', avg_predicted_pd FROM pd_backtest""",
    "rating_grade_summary": """
        SELECT g.rating_grade, coalesce(facilities, 0) AS facilities, coalesce(defaults, 0) AS observed_defaults,
               observed_default_rate, avg_predicted_pd, min_predicted_pd, max_predicted_pd
        FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E'), ('F')) g(rating_grade) LEFT JOIN grade_report USING (rating_grade)""",
    "binomial_p": f"SELECT *, {_p_value} AS binomial_p_value FROM grade_report",
    "binomial_backtest": """
        SELECT rating_grade, facilities, defaults AS observed_defaults, facilities * avg_predicted_pd AS expected_defaults,
               avg_predicted_pd, observed_default_rate, binomial_p_value,
               CASE WHEN binomial_p_value IS NULL THEN 'UNKNOWN' WHEN binomial_p_value >= 0.05 THEN 'GREEN'
                    WHEN binomial_p_value >= 0.01 THEN 'AMBER' ELSE 'RED' END AS traffic_light FROM binomial_p""",
    "adjacent_grades": """
        SELECT lag(rating_grade) OVER (ORDER BY rating_grade) AS previous_grade, rating_grade AS current_grade,
               lag(observed_default_rate) OVER (ORDER BY rating_grade) AS previous_default_rate,
               observed_default_rate AS current_default_rate FROM grade_report""",
    "monotonicity": """
        SELECT 'rating_monotonicity' AS check_name, count(*) AS ratings_checked,
               coalesce(bool_and(current_default_rate - previous_default_rate >= -1e-12), true) AS is_monotonic,
               count(*) FILTER (current_default_rate < previous_default_rate) AS violations_count FROM adjacent_grades""",
    "monotonicity_violations": "SELECT *, 1 AS violation FROM adjacent_grades WHERE current_default_rate < previous_default_rate",
    "psi_rows": _split_sql("pd_sample", "observation_date"),
    "psi_long": "SELECT split, feature, value FROM (SELECT split, "
    + ", ".join(f"{c}::DOUBLE AS {c}" for c in PSI_FEATURES)
    + f" FROM psi_rows) UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(PSI_FEATURES)})) WHERE split <> 'valid'",
    "psi_cuts": """
        SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts
        FROM psi_long WHERE split = 'train' AND value IS NOT NULL GROUP BY feature""",
    "psi_inner": "SELECT feature, cuts[2:len(cuts) - 1] AS inner_cuts FROM psi_cuts",
    "psi_bins": """
        SELECT feature, inner_cuts, unnest(range(1, len(inner_cuts) + 2)) AS bin FROM psi_inner""",
    "psi_hits": """
        SELECT l.feature, 1 + len(list_filter(inner_cuts, lambda c: c < value)) AS bin,
               count(*) FILTER (split = 'train') AS expected_count, count(*) FILTER (split = 'oot') AS actual_count
        FROM psi_long l JOIN psi_inner i ON i.feature = l.feature WHERE value IS NOT NULL GROUP BY ALL""",
    "psi_counts": """
        SELECT b.feature, b.bin, coalesce(inner_cuts[bin - 1], '-infinity'::DOUBLE) AS lower_bound,
               coalesce(inner_cuts[bin], 'infinity'::DOUBLE) AS upper_bound,
               coalesce(expected_count, 0) AS expected_count, coalesce(actual_count, 0) AS actual_count
        FROM psi_bins b LEFT JOIN psi_hits h USING (feature, bin)""",
    "psi_shares": """
        SELECT *, expected_count / sum(expected_count) OVER (PARTITION BY feature) AS expected_share,
               actual_count / sum(actual_count) OVER (PARTITION BY feature) AS actual_share FROM psi_counts""",
    "psi_all_details": """
        SELECT *, (greatest(actual_share, 1e-6) - greatest(expected_share, 1e-6))
                  * ln(greatest(actual_share, 1e-6) / greatest(expected_share, 1e-6)) AS psi_component FROM psi_shares""",
    "psi_summary": """
        SELECT feature, psi, expected_missing_rate, actual_missing_rate
        FROM (SELECT feature, avg((value IS NULL)::INTEGER) FILTER (split = 'train') AS expected_missing_rate,
                     avg((value IS NULL)::INTEGER) FILTER (split = 'oot') AS actual_missing_rate
              FROM psi_long GROUP BY feature)
        LEFT JOIN (SELECT feature, sum(psi_component) AS psi FROM psi_all_details GROUP BY feature) USING (feature)""",
    "psi_details": """
        SELECT * FROM psi_all_details WHERE feature IN (
            SELECT feature FROM psi_summary ORDER BY round(psi, 9) DESC NULLS LAST, feature LIMIT 20)""",
    "alt_scale_mapping": """
        SELECT rating_grade AS original_rating_grade,
               CASE WHEN sparse AND rating_grade IN ('E', 'F') THEN 'E_F' ELSE rating_grade END AS alternative_rating_grade,
               CASE WHEN sparse AND rating_grade = 'F' THEN 'merge sparse F into E/F bucket'
                    WHEN sparse AND rating_grade = 'E' THEN 'merge E with sparse F bucket' ELSE 'unchanged' END AS rule,
               facilities AS original_facilities, observed_defaults AS original_observed_defaults,
               observed_default_rate AS original_observed_default_rate, avg_predicted_pd AS original_avg_predicted_pd
        FROM rating_grade_summary, (SELECT facilities < 50 AS sparse FROM rating_grade_summary WHERE rating_grade = 'F')""",
    "alt_scale_backtest": """
        SELECT *, avg_predicted_pd - observed_default_rate AS calibration_error FROM (
            SELECT alternative_rating_grade, sum(facilities)::BIGINT AS facilities,
                   sum(observed_defaults)::BIGINT AS observed_defaults,
                   sum(facilities * avg_predicted_pd) AS expected_defaults, min(min_predicted_pd) AS min_predicted_pd,
                   max(max_predicted_pd) AS max_predicted_pd, sum(observed_defaults) / sum(facilities) AS observed_default_rate,
                   sum(facilities * avg_predicted_pd) / sum(facilities) AS avg_predicted_pd
            FROM rating_grade_summary JOIN alt_scale_mapping ON rating_grade = original_rating_grade GROUP BY 1)""",
    "validation_summary": """
        SELECT 'pd_backtesting' AS area, 'ratings_count' AS metric, count(*)::DOUBLE AS value FROM pd_backtest
        UNION ALL SELECT 'pd_backtesting', 'total_defaults', sum(defaults)::DOUBLE FROM pd_backtest
        UNION ALL SELECT 'rating_monotonicity', 'violations_count', violations_count::DOUBLE FROM monotonicity
        UNION ALL SELECT 'psi', 'max_feature_psi', max(psi) FROM psi_summary
        UNION ALL SELECT 'ifrs9_staging', 'stage_2_share', avg((ifrs9_stage = 2)::INTEGER) FROM staged
        UNION ALL SELECT 'ifrs9_ecl', 'total_ecl', total_ecl FROM ecl_portfolio""",
    "best_pd": "SELECT * FROM binary_metrics WHERE split = 'oot' ORDER BY roc_auc DESC NULLS LAST, model LIMIT 1",
    "best_lgd": "SELECT * FROM lgd_regression_metrics WHERE split = 'oot' ORDER BY weighted_mae, model LIMIT 1",
    "best_ccf": "SELECT * FROM ccf_regression_metrics WHERE split = 'oot' ORDER BY weighted_mae, model LIMIT 1",
    "severe": "SELECT * FROM stress_summary WHERE scenario = 'severe_downturn'",
    "dq_counts": "SELECT count(*) FILTER (status = 'FAIL') AS f, count(*) FILTER (status = 'WARN') AS w, count(*) FILTER (status = 'PASS') AS p FROM data_quality",
    "top_psi": "SELECT * FROM psi_summary ORDER BY round(psi, 9) DESC NULLS LAST, feature LIMIT 1",
    "red_grades": "SELECT count(*) FILTER (traffic_light = 'RED') AS red FROM binomial_backtest",
    "traffic_lights": " UNION ALL ".join([
        _light_sql("PD", "pd_oot_gini", "gini", ">= 0.30", ">= 0.20", "< 0.20", _min_good("gini", 0.3, 0.2), "OOT Gini for the best PD model.", "best_pd"),
        _light_sql("PD", "pd_oot_ks", "ks", ">= 0.20", ">= 0.15", "< 0.15", _min_good("ks", 0.2, 0.15), "OOT KS statistic for the best PD model.", "best_pd"),
        _light_sql("PD", "pd_brier_score", "brier_score", "<= 0.05", "<= 0.08", "> 0.08", _max_good("brier_score", 0.05, 0.08), "Brier score for PD probability calibration. Lower is better.", "best_pd"),
        _light_sql("Monitoring", "max_feature_psi", "psi", "<= 0.10", "<= 0.25", "> 0.25", _max_good("psi", 0.1, 0.25), "Maximum PSI across monitored features.", "top_psi"),
        _light_sql("Rating", "rating_monotonicity_violations", "violations_count", "= 0", "<= 1", "> 1", _max_good("violations_count", 0, 1), "Number of rating monotonicity violations.", "monotonicity"),
        _light_sql("Rating", "rating_binomial_red_count", "red", "= 0", "<= 2", "> 2", _max_good("red", 0, 2), "Number of rating grades with RED binomial backtesting status.", "red_grades"),
        _light_sql("IFRS9_Staging", "stage_2_share", "stage_2_share", "0.05 - 0.35", "0.01 - 0.50", "outside amber band", _band_good("stage_2_share", 0.05, 0.35, 0.01, 0.5), "Stage 2 facility share. This is a portfolio sanity check, not a model performance metric.", "ecl_portfolio"),
        _light_sql("IFRS9_Staging", "stage_3_share", "stage_3_share", "0.01 - 0.15", "0.00 - 0.25", "> 0.25", _band_good("stage_3_share", 0.01, 0.15, 0, 0.25), "Stage 3 facility share. This is a portfolio sanity check.", "ecl_portfolio"),
        _light_sql("Stress", "severe_downturn_ecl_change_pct", "ecl_change_pct_vs_base", "0.10 - 0.70", "0.00 - 1.00", "outside amber band", _band_good("ecl_change_pct_vs_base", 0.1, 0.7, 0, 1), "ECL increase under severe downturn versus base scenario.", "severe"),
        _light_sql("Data Quality", "data_quality_fail_count", "f", "= 0", "<= 1", "> 1", _max_good("f", 0, 1), "Number of failed SQL data quality checks.", "dq_counts"),
        _light_sql("Data Quality", "data_quality_warn_count", "w", "= 0", "<= 3", "> 3", _max_good("w", 0, 3), "Number of warning SQL data quality checks.", "dq_counts"),
    ]),
    "executive_summary": " UNION ALL ".join([
        _kpi_sql("PD", "best_oot_model", "model", "Best PD model selected by OOT ROC-AUC.", "best_pd"),
        _kpi_sql("PD", "pd_oot_roc_auc", "roc_auc", "PD model OOT ROC-AUC.", "best_pd", 6),
        _kpi_sql("PD", "pd_oot_gini", "gini", "PD model OOT Gini.", "best_pd", 6),
        _kpi_sql("PD", "pd_oot_ks", "ks", "PD model OOT KS.", "best_pd", 6),
        _kpi_sql("PD", "pd_oot_brier_score", "brier_score", "PD probability calibration loss.", "best_pd", 6),
        *[
            row
            for area, source, prefix, label in [("LGD", "best_lgd", "lgd", "LGD"), ("EAD_CCF", "best_ccf", "ead_ccf", "EAD/CCF")]
            for row in [
                _kpi_sql(area, "best_oot_model", "model", f"Best {label} model selected by OOT weighted MAE.", source),
                _kpi_sql(area, f"{prefix}_oot_mae", "mae", f"{label} OOT MAE.", source, 6),
                _kpi_sql(area, f"{prefix}_oot_rmse", "rmse", f"{label} OOT RMSE.", source, 6),
                _kpi_sql(area, f"{prefix}_oot_weighted_mae", "weighted_mae", f"{label} OOT weighted MAE.", source, 6),
            ]
        ],
        _kpi_sql("IFRS9_ECL", "portfolio_facilities", "facilities", "Number of facilities in the ECL portfolio.", "ecl_portfolio"),
        _kpi_sql("IFRS9_ECL", "portfolio_total_ead", "total_ead", "Total EAD.", "ecl_portfolio", 2),
        _kpi_sql("IFRS9_ECL", "portfolio_total_ecl", "total_ecl", "Scenario-weighted total ECL.", "ecl_portfolio", 2),
        _kpi_sql("IFRS9_ECL", "portfolio_ecl_rate", "ecl_rate", "Total ECL divided by total EAD.", "ecl_portfolio", 6),
        *[
            _kpi_sql("IFRS9_ECL", f"stage_{i}_share", f"stage_{i}_share", f"Facility share in Stage {i}.", "ecl_portfolio", 6)
            for i in (1, 2, 3)
        ],
        _kpi_sql("Stress", "severe_downturn_total_ecl", "total_ecl", "Total ECL under severe downturn.", "severe", 2),
        _kpi_sql("Stress", "severe_downturn_ecl_change_pct_vs_base", "ecl_change_pct_vs_base", "ECL increase versus base.", "severe", 6),
        _kpi_sql("Monitoring", "max_psi_feature", "feature", "Feature with the highest PSI.", "top_psi"),
        _kpi_sql("Monitoring", "max_psi_value", "psi", "Highest PSI value.", "top_psi", 6),
        _kpi_sql("Validation", "rating_monotonicity_violations", "violations_count", "Number of rating monotonicity violations.", "monotonicity"),
        _kpi_sql("Data Quality", "data_quality_fail_count", "f", "Number of failed data quality checks.", "dq_counts"),
        _kpi_sql("Data Quality", "data_quality_warn_count", "w", "Number of warning data quality checks.", "dq_counts"),
        _kpi_sql("Data Quality", "data_quality_pass_count", "p", "Number of passed data quality checks.", "dq_counts"),
    ]),
}

_NOT_FEATURES = {
    "pd": "facility_id company_id observation_date target_default_12m",
    "lgd": "facility_id company_id default_date realized_lgd total_recovery_amount total_collection_cost "
    "net_recovery_amount recovery_events_count writeoff_flag",
    "ccf": "facility_id company_id default_date realized_ccf ead_at_default default_type dpd_at_default writeoff_flag",
}
_SAMPLES = {"pd": PD_SAMPLE_COLUMNS, "lgd": LGD_SAMPLE_COLUMNS, "ccf": CCF_SAMPLE_COLUMNS}
_CATEGORICAL = TEXT_FIELDS | {"observation_date", "default_type", "origination_rating_grade"}


def _features_of(model: str) -> list[str]:
    return [c for c in _SAMPLES[model] if c not in _NOT_FEATURES[model].split()]


_PD_NUMBERS = [c for c in _features_of("pd") if c not in _CATEGORICAL]
_PD_TEXTS = [c for c in _features_of("pd") if c in _CATEGORICAL]


def _filled(c: str) -> str:
    return f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM pd_sample_split WHERE split = 'train'))"


def _checks_sql(split: str, target: str, baseline: str, models: list[str], settled: list[str]) -> str:
    names = ", ".join(f"('{m}')" for m in [baseline, *models])
    zero = ", ".join(f"'{m}'" for m in [baseline, *settled])
    free = f"'{baseline}'" + (", 'random_forest'" if settled else "")
    return f"""
        SELECT model, split, count(*) AS rows, count(*) AS bounded, avg({target}) AS actual,
               CASE WHEN split = 'train' AND model IN ({zero}) THEN 0::DOUBLE END AS train_gap,
               CASE WHEN split = 'train' AND model NOT IN ({free}) THEN true END AS better,
               CASE WHEN split = 'oot' AND model <> '{baseline}' THEN count(*) END AS reloaded,
               CASE WHEN split = 'oot' AND model IN ('random_forest', 'boosted_trees') THEN count(*) END AS walked
        FROM {split}, (VALUES {names}) AS m(model) GROUP BY model, split"""


PREPARATION = {
    "coerced_rows": "SELECT order_text::DOUBLE AS order_text, price_text::DOUBLE AS price_text, customer_text, "
    "try_cast(mostly_number_text AS DOUBLE) AS mostly_number_text, o_orderpriority FROM order_texts",
    "parsed_rows": "SELECT o_orderkey AS order_key, o_orderdate::DATE AS day, (o_orderkey % 3)::DOUBLE AS target FROM orders "
    "WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0",
    "earliest_fit_rows": "SELECT facility_id, observation_date FROM pd_split WHERE split = 'train' "
    "ORDER BY observation_date, facility_id LIMIT 500",
    "model_features": " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS feature, '{'categorical' if c in _CATEGORICAL else 'numeric'}' AS kind, "
        f"count({c}) AS filled FROM {m}_sample"
        for m in _SAMPLES for c in _features_of(m)
    ),
    "pd_sample_split": _split_sql("pd_sample", "observation_date"),
    "preparation_statistics": " UNION ALL ".join(
        [
            f"SELECT '{c}' AS feature, quantile_cont({c}::DOUBLE, 0.5) AS median, avg({_filled(c)}) AS mean, "
            f"stddev_pop({_filled(c)}) AS deviation, NULL::VARCHAR AS mode FROM pd_sample_split WHERE split = 'train'"
            for c in _PD_NUMBERS
        ]
        + [
            f"(SELECT '{c}', NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, {c} FROM pd_sample_split WHERE split = 'train' "
            f"AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            for c in _PD_TEXTS
        ]
    ),
    "category_positions": " UNION ALL ".join(
        f"""
        SELECT '{c}' AS feature, l.level, l.position, coalesce(h.n, 0) AS oot_rows
        FROM (SELECT level, (row_number() OVER (ORDER BY level) - 1)::INTEGER AS position FROM (
                SELECT DISTINCT coalesce({c}, (SELECT mode FROM preparation_statistics WHERE feature = '{c}')) AS level
                FROM pd_sample_split WHERE split = 'train')) l
        FULL JOIN (SELECT coalesce({c}, (SELECT mode FROM preparation_statistics WHERE feature = '{c}')) AS level, count(*) AS n
                   FROM pd_sample_split WHERE split = 'oot' GROUP BY 1) h ON h.level = l.level"""
        for c in _PD_TEXTS
    ),
    "pd_model_checks": _checks_sql(
        "pd_sample_split", "target_default_12m", "dummy_prior",
        ["logistic_regression", "random_forest", "boosted_trees"], ["logistic_regression"],
    ),
    "lgd_model_checks": _checks_sql("lgd_split", "realized_lgd", "dummy_mean", ["ridge", "random_forest", "boosted_trees"], []),
    "ccf_model_checks": _checks_sql(
        "ccf_split", "realized_ccf", "dummy_mean", ["ridge", "random_forest", "boosted_trees"], []
    ),
}

CTES = {**RAW, **MARTS, **IMPAIRMENT, **VALIDATION, **PREPARATION, **fits(_binary_metrics_sql), **SOURCES}


def oracle_query(step: str, digits: dict[str, int]) -> str:
    """Steps up to `step`, and its rows rounded as in the Spark query."""
    names = list(CTES)
    used = names[: names.index(step) + 1]
    body = ",\n".join(f"{name} AS ({CTES[name]})" for name in used)
    rounding = ", ".join(f"round({c}, {n}) AS {c}" for c, n in digits.items())
    replace = f" REPLACE ({rounding})" if rounding else ""
    return f"WITH {body}\nSELECT *{replace} FROM {step}"
