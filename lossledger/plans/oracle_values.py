"""Fixed values of the expected results, spelled out here so that a wrong value in an operator is seen."""

SCENARIO_FACTORS = {'base': {'pd': 1.0, 'lgd': 1.0, 'ccf': 1.0},
 'downside': {'pd': 1.35, 'lgd': 1.1, 'ccf': 1.15},
 'upside': {'pd': 0.85, 'lgd': 0.95, 'ccf': 0.9}}
SCENARIO_WEIGHTS = {'base': 0.6, 'downside': 0.25, 'upside': 0.15}
STRESS_SCENARIOS = {'base': {'pd': 1.0, 'lgd': 1.0, 'ccf': 1.0, 'industry': 1.0},
 'downside': {'pd': 1.35, 'lgd': 1.1, 'ccf': 1.15, 'industry': 1.15},
 'severe_downturn': {'pd': 1.9, 'lgd': 1.25, 'ccf': 1.3, 'industry': 1.35},
 'rate_shock': {'pd': 1.45, 'lgd': 1.08, 'ccf': 1.1, 'industry': 1.1},
 'fx_shock': {'pd': 1.3, 'lgd': 1.12, 'ccf': 1.12, 'industry': 1.15}}
RATIO_MART_COLUMNS = ['facility_id', 'company_id', 'observation_date', 'maturity_date', 'product_type', 'limit_amount',
 'outstanding_amount', 'undrawn_amount', 'interest_rate', 'term_months', 'revolving_flag', 'seniority',
 'currency', 'repayment_type', 'registration_date', 'industry', 'region', 'company_size', 'legal_form',
 'ownership_type', 'latent_profile', 'years_in_business', 'employees_count', 'exporter_flag',
 'state_related_flag', 'related_party_flag', 'report_date', 'revenue', 'revenue_prev_year', 'ebitda',
 'net_income', 'total_assets', 'current_assets', 'cash', 'inventory', 'accounts_receivable',
 'total_liabilities', 'current_liabilities', 'short_term_debt', 'long_term_debt', 'equity', 'interest_expense',
 'operating_cash_flow', 'capex', 'total_debt', 'current_ratio', 'quick_ratio', 'debt_to_equity',
 'debt_to_assets', 'debt_to_ebitda', 'interest_coverage', 'ebitda_margin', 'net_profit_margin',
 'operating_cf_to_debt', 'cash_to_short_term_debt', 'equity_to_assets', 'revenue_growth_yoy', 'collateral_type',
 'collateral_value', 'avg_collateral_haircut', 'effective_collateral_value', 'loan_to_value',
 'collateral_coverage', 'effective_collateral_coverage', 'rating_date', 'origination_rating_grade',
 'origination_pd_estimate', 'watchlist_flag', 'restructuring_flag', 'max_dpd_observed', 'max_dpd_12m',
 'payment_months_observed', 'total_scheduled_amount', 'total_paid_amount', 'payment_completion_rate',
 'default_date', 'default_type', 'dpd_at_default', 'ead_at_default', 'writeoff_flag', 'target_default_12m',
 'total_recovery_amount', 'total_collection_cost', 'recovery_events_count', 'realized_lgd', 'realized_ccf']
PD_SAMPLE_COLUMNS = ['facility_id', 'company_id', 'observation_date', 'target_default_12m', 'product_type', 'limit_amount',
 'outstanding_amount', 'undrawn_amount', 'interest_rate', 'term_months', 'revolving_flag', 'seniority',
 'currency', 'repayment_type', 'industry', 'region', 'company_size', 'legal_form', 'ownership_type',
 'years_in_business', 'employees_count', 'exporter_flag', 'state_related_flag', 'related_party_flag', 'revenue',
 'revenue_prev_year', 'ebitda', 'net_income', 'total_assets', 'current_assets', 'cash', 'inventory',
 'accounts_receivable', 'total_liabilities', 'current_liabilities', 'short_term_debt', 'long_term_debt',
 'equity', 'interest_expense', 'operating_cash_flow', 'capex', 'total_debt', 'current_ratio', 'quick_ratio',
 'debt_to_equity', 'debt_to_assets', 'debt_to_ebitda', 'interest_coverage', 'ebitda_margin',
 'net_profit_margin', 'operating_cf_to_debt', 'cash_to_short_term_debt', 'equity_to_assets',
 'revenue_growth_yoy', 'collateral_type', 'collateral_value', 'avg_collateral_haircut',
 'effective_collateral_value', 'loan_to_value', 'collateral_coverage', 'effective_collateral_coverage',
 'watchlist_flag', 'restructuring_flag']
LGD_SAMPLE_COLUMNS = ['facility_id', 'company_id', 'observation_date', 'default_date', 'product_type', 'limit_amount',
 'outstanding_amount', 'undrawn_amount', 'interest_rate', 'term_months', 'revolving_flag', 'seniority',
 'currency', 'repayment_type', 'industry', 'region', 'company_size', 'legal_form', 'ownership_type',
 'years_in_business', 'employees_count', 'exporter_flag', 'state_related_flag', 'related_party_flag', 'revenue',
 'ebitda', 'net_income', 'total_assets', 'current_assets', 'cash', 'inventory', 'total_liabilities',
 'current_liabilities', 'short_term_debt', 'long_term_debt', 'equity', 'interest_expense',
 'operating_cash_flow', 'capex', 'total_debt', 'current_ratio', 'quick_ratio', 'debt_to_equity',
 'debt_to_assets', 'debt_to_ebitda', 'interest_coverage', 'ebitda_margin', 'net_profit_margin',
 'operating_cf_to_debt', 'cash_to_short_term_debt', 'equity_to_assets', 'revenue_growth_yoy', 'collateral_type',
 'collateral_value', 'avg_collateral_haircut', 'effective_collateral_value', 'loan_to_value',
 'collateral_coverage', 'effective_collateral_coverage', 'origination_rating_grade', 'origination_pd_estimate',
 'watchlist_flag', 'restructuring_flag', 'default_type', 'dpd_at_default', 'ead_at_default', 'writeoff_flag',
 'total_recovery_amount', 'total_collection_cost', 'recovery_events_count', 'net_recovery_amount', 'gdp_growth',
 'inflation', 'base_rate', 'unemployment', 'fx_rate', 'industry_stress_index', 'realized_lgd']
CCF_SAMPLE_COLUMNS = ['facility_id', 'company_id', 'observation_date', 'default_date', 'product_type', 'limit_amount',
 'outstanding_amount', 'undrawn_amount', 'utilization_rate', 'interest_rate', 'term_months', 'revolving_flag',
 'seniority', 'currency', 'repayment_type', 'industry', 'region', 'company_size', 'legal_form',
 'ownership_type', 'years_in_business', 'employees_count', 'exporter_flag', 'state_related_flag',
 'related_party_flag', 'revenue', 'ebitda', 'net_income', 'total_assets', 'current_assets', 'cash', 'inventory',
 'total_liabilities', 'current_liabilities', 'short_term_debt', 'long_term_debt', 'equity', 'interest_expense',
 'operating_cash_flow', 'capex', 'total_debt', 'current_ratio', 'quick_ratio', 'debt_to_equity',
 'debt_to_assets', 'debt_to_ebitda', 'interest_coverage', 'ebitda_margin', 'net_profit_margin',
 'operating_cf_to_debt', 'cash_to_short_term_debt', 'equity_to_assets', 'revenue_growth_yoy', 'collateral_type',
 'collateral_value', 'avg_collateral_haircut', 'effective_collateral_value', 'loan_to_value',
 'collateral_coverage', 'effective_collateral_coverage', 'origination_rating_grade', 'origination_pd_estimate',
 'watchlist_flag', 'restructuring_flag', 'default_type', 'dpd_at_default', 'ead_at_default', 'writeoff_flag',
 'gdp_growth', 'inflation', 'base_rate', 'unemployment', 'fx_rate', 'industry_stress_index', 'realized_ccf']
STAGING_SAMPLE_COLUMNS = ['facility_id', 'company_id', 'reporting_date', 'observation_date', 'maturity_date', 'product_type',
 'limit_amount', 'outstanding_amount', 'undrawn_amount', 'interest_rate', 'term_months', 'revolving_flag',
 'seniority', 'currency', 'repayment_type', 'industry', 'region', 'company_size', 'legal_form',
 'ownership_type', 'years_in_business', 'employees_count', 'exporter_flag', 'state_related_flag',
 'related_party_flag', 'current_ratio', 'quick_ratio', 'debt_to_equity', 'debt_to_assets', 'debt_to_ebitda',
 'interest_coverage', 'ebitda_margin', 'net_profit_margin', 'operating_cf_to_debt', 'cash_to_short_term_debt',
 'equity_to_assets', 'revenue_growth_yoy', 'collateral_type', 'collateral_value', 'effective_collateral_value',
 'collateral_coverage', 'effective_collateral_coverage', 'origination_rating_grade', 'origination_rating_order',
 'origination_pd_estimate', 'current_rating_date', 'current_rating_grade', 'current_rating_order',
 'current_pd_estimate', 'latest_payment_date', 'current_dpd', 'current_outstanding_balance', 'watchlist_flag',
 'restructuring_flag', 'max_dpd_observed', 'max_dpd_12m', 'default_date', 'default_type', 'dpd_at_default',
 'writeoff_flag', 'default_flag', 'pd_ratio_current_to_origination', 'rating_downgrade_notches',
 'target_default_12m']
ROW_COUNT_CHECKS = [('raw.companies', 'raw companies rows', 'FAIL', 'Raw borrower table should not be empty.'),
 ('raw.financial_statements', 'raw financial statements rows', 'FAIL',
  'Raw financial statements table should not be empty.'),
 ('raw.loan_facilities', 'raw loan facilities rows', 'FAIL', 'Raw loan facilities table should not be empty.'),
 ('raw.payments', 'raw payments rows', 'FAIL', 'Raw payments table should not be empty.'),
 ('raw.defaults', 'raw defaults rows', 'WARN',
  'Defaults can be sparse, but the synthetic medium portfolio should contain default events.'),
 ('raw.recoveries', 'raw recoveries rows', 'WARN',
  'Recoveries should exist for part of the defaulted portfolio.'),
 ('raw.rating_history', 'raw rating history rows', 'FAIL', 'Rating history table should not be empty.'),
 ('raw.macro_scenarios', 'raw macro scenarios rows', 'FAIL', 'Macro scenarios table should not be empty.'),
 ('mart.financial_ratios_mart', 'financial ratios mart rows', 'FAIL',
  'Financial ratios mart should not be empty.'),
 ('mart.pd_modeling_sample', 'pd modeling sample rows', 'FAIL', 'PD modeling sample should not be empty.'),
 ('mart.lgd_modeling_sample', 'lgd modeling sample rows', 'WARN',
  'LGD sample contains defaulted facilities only.'),
 ('mart.ead_ccf_modeling_sample', 'ead ccf modeling sample rows', 'WARN',
  'EAD/CCF sample contains revolving defaulted facilities only.'),
 ('mart.ifrs9_staging_sample', 'ifrs9 staging sample rows', 'FAIL',
  'IFRS 9 staging sample should not be empty.')]
BAD_ROW_CHECKS = [('null_check', 'company_id nulls', 'raw.companies', 'null_count', 'company_id is null', 'FAIL',
  'company_id is the primary borrower key.'),
 ('null_check', 'facility_id nulls', 'raw.loan_facilities', 'null_count', 'facility_id is null', 'FAIL',
  'facility_id is the primary facility key.'),
 ('null_check', 'payment_id nulls', 'raw.payments', 'null_count', 'payment_id is null', 'FAIL',
  'payment_id is the primary payment key.'),
 ('amount_check', 'negative revenue', 'raw.financial_statements', 'invalid_count', 'revenue < 0', 'FAIL',
  'Revenue should not be negative in this synthetic dataset.'),
 ('amount_check', 'negative total assets', 'raw.financial_statements', 'invalid_count', 'total_assets < 0',
  'FAIL', 'Total assets should not be negative.'),
 ('amount_check', 'negative facility amounts', 'raw.loan_facilities', 'invalid_count',
  'limit_amount < 0 or outstanding_amount < 0 or undrawn_amount < 0', 'FAIL',
  'Limit, outstanding and undrawn amounts should not be negative.'),
 ('amount_check', 'negative collateral value', 'raw.collateral', 'invalid_count', 'collateral_value < 0',
  'FAIL', 'Collateral value should not be negative.'),
 ('amount_check', 'negative payment amounts', 'raw.payments', 'invalid_count',
  'scheduled_amount < 0 or paid_amount < 0 or outstanding_balance < 0', 'FAIL',
  'Payment and outstanding amounts should not be negative.'),
 ('amount_check', 'negative recovery amounts', 'raw.recoveries', 'invalid_count',
  'recovery_amount < 0 or collection_cost < 0', 'FAIL',
  'Recovery amount and collection cost should not be negative.'),
 ('date_check', 'maturity before origination', 'raw.loan_facilities', 'invalid_count',
  'maturity_date < origination_date', 'FAIL',
  'Facility maturity date should not be earlier than origination date.'),
 ('modeling_sample_check', 'pd target nulls', 'mart.pd_modeling_sample', 'null_count',
  'target_default_12m is null', 'FAIL', 'PD target should not be null.'),
 ('modeling_sample_check', 'lgd bounds', 'mart.lgd_modeling_sample', 'invalid_count',
  'realized_lgd < 0 or realized_lgd > 1', 'FAIL', 'Realized LGD should be between 0 and 1 after clipping.'),
 ('modeling_sample_check', 'ccf bounds', 'mart.ead_ccf_modeling_sample', 'invalid_count',
  'realized_ccf < 0 or realized_ccf > 1.5', 'FAIL',
  'Realized CCF should be between 0 and 1.5 after clipping.'),
 ('ifrs9_check', 'current dpd negative values', 'mart.ifrs9_staging_sample', 'invalid_count', 'current_dpd < 0',
  'FAIL', 'Current DPD should not be negative.')]
DUPLICATE_CHECKS = [('duplicate company_id', 'raw.companies', ['company_id'], 'company_id should be unique.'),
 ('duplicate facility_id', 'raw.loan_facilities', ['facility_id'], 'facility_id should be unique.'),
 ('duplicate payment_id', 'raw.payments', ['payment_id'], 'payment_id should be unique.'),
 ('duplicate company report date', 'raw.financial_statements', ['company_id', 'report_date'],
  'There should be one financial statement per company and report date.')]
AVERAGE_CHECKS = [('modeling_sample_check', 'pd default rate', 'mart.pd_modeling_sample', 'default_rate', 'target_default_12m',
  0.001, 0.3, 'WARN', 'PD target default rate should be non-zero and plausible for the synthetic portfolio.'),
 ('modeling_sample_check', 'lgd average', 'mart.lgd_modeling_sample', 'avg_lgd', 'realized_lgd', 0.0, 1.0,
  'FAIL', 'Average realized LGD should be within valid probability bounds.'),
 ('modeling_sample_check', 'ccf average', 'mart.ead_ccf_modeling_sample', 'avg_ccf', 'realized_ccf', 0.0, 1.5,
  'FAIL', 'Average realized CCF should be within expected bounds.'),
 ('ifrs9_check', 'ifrs9 default flag rate', 'mart.ifrs9_staging_sample', 'default_flag_rate', 'default_flag',
  0.001, 0.3, 'WARN', 'Default flag rate should be plausible for the synthetic portfolio.')]
STAGE_DETAILS = 'Stage proxy calculated from the same staging rules used in Python.'
