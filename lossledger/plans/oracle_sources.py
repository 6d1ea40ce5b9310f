"""DuckDB SQL for frames that went through a source or sink: the same numbers from the tables themselves."""

from __future__ import annotations

from lossledger.sources.schemas import RAW_DDL

_NUMBERS = ("double", "int")
#: Columns that the steps above leave out: always filled, and what the fourth adds up.
_LEFT_OUT = {"collateral_id": "1", "valuation_date": "1", "recovery_type": "1", "scenario_weight": "CASE scenario WHEN 'base' THEN 0.6 WHEN 'downside' THEN 0.25 WHEN 'severe' THEN 0.0 WHEN 'upside' THEN 0.15 END"}


def _totals(table: str) -> list[str]:
    parts = []
    for column in RAW_DDL[table].split(","):
        name, kind = column.split()
        value = _LEFT_OUT.get(name, name)
        total = f"sum({value})::DOUBLE" if kind in _NUMBERS else "NULL::DOUBLE"
        parts.append(f"SELECT '{table}' AS \"table\", '{name}' AS \"column\", count({value}) AS filled, {total} AS total FROM {table}")
    return parts


SOURCES = {
    "csv_round_trip": " UNION ALL ".join(p for t in RAW_DDL for p in _totals(t)),
    "published_mart": """
        SELECT product_type, count(*) AS facilities, sum(outstanding_amount) AS outstanding, coalesce(sum(n), 0)::BIGINT AS payments
        FROM loan_facilities LEFT JOIN (SELECT facility_id, count(*) AS n FROM payments GROUP BY facility_id) USING (facility_id)
        GROUP BY product_type""",
    "published_portfolio": "SELECT facility_id, ifrs9_stage::INTEGER AS ifrs9_stage, current_dpd FROM staged WHERE ifrs9_stage > 1",
    "report_read_back": "SELECT *, 1 AS reports FROM stage_distribution",
    "oot_scores": "SELECT origination_pd_estimate AS o, current_pd_estimate AS c FROM two_pds",
    "score_choice": """
        SELECT 'current' AS asked, 'pd_current' AS chosen, count(c) AS rows, avg(c) AS mean_score FROM oot_scores
        UNION ALL SELECT 'unknown', 'pd_origination', count(o), avg(o) FROM oot_scores
        UNION ALL SELECT NULL, 'pd_origination', count(o), avg(o) FROM oot_scores""",
}
