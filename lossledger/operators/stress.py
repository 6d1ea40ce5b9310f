"""Stress scenarios over the expected-loss parameters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import clip, total
from lossledger.operators.ecl import in_scenarios, scenario_measures, with_risk_parameters

# Stress multipliers and industry sensitivities.
STRESS_SCENARIOS = {
    "base": {"pd": 1.00, "lgd": 1.00, "ccf": 1.00, "industry": 1.00},
    "downside": {"pd": 1.35, "lgd": 1.10, "ccf": 1.15, "industry": 1.15},
    "severe_downturn": {"pd": 1.90, "lgd": 1.25, "ccf": 1.30, "industry": 1.35},
    "rate_shock": {"pd": 1.45, "lgd": 1.08, "ccf": 1.10, "industry": 1.10},
    "fx_shock": {"pd": 1.30, "lgd": 1.12, "ccf": 1.12, "industry": 1.15},
}
INDUSTRY_SENSITIVITY = {
    "construction": 1.35, "real_estate": 1.30, "trade": 1.15, "transport": 1.12,
    "agriculture": 1.10, "manufacturing": 1.08, "services": 1.00, "energy": 0.95,
}
FX_SENSITIVE_INDUSTRIES = ["trade", "manufacturing", "transport", "agriculture"]
FX_SURCHARGE = 0.20


def industry_stress_multiplier(industry: Column, factor: Column | float, fx_shock: Column | bool) -> Column:
    """PD multiplier of an industry, within [0.75, 2.5]; unknown industries are neutral.

    A currency shock adds a surcharge for the industries sensitive to it.
    """
    sensitivity = F
    for name, value in INDUSTRY_SENSITIVITY.items():
        sensitivity = sensitivity.when(industry == name, value)
    multiplier = 1 + (sensitivity.otherwise(1.0) - 1) * factor
    if fx_shock is not False:
        exposed = industry.isin(FX_SENSITIVE_INDUSTRIES)
        if fx_shock is not True:
            exposed = exposed & fx_shock
        multiplier = multiplier + F.when(exposed, FX_SURCHARGE).otherwise(0.0)
    return clip(multiplier, 0.75, 2.50)


def facility_stress(
    staged: DataFrame, scenarios: Mapping[str, Mapping[str, float]] = STRESS_SCENARIOS
) -> DataFrame:
    """Stressed parameters and loss per facility, six columns per scenario. One projection."""
    data = with_risk_parameters(staged)
    columns: dict[str, Column] = {}
    for scenario, factors in scenarios.items():
        industry = industry_stress_multiplier(F.col("industry"), factors["industry"], scenario == "fx_shock")
        measures = scenario_measures(data, F.col("pd_12m_base") * factors["pd"] * industry, factors["lgd"], factors["ccf"])
        columns |= {f"stress_{m}_{scenario}": c for m, c in measures.items()}
    return data.withColumns(columns)


def stress_cube(
    staged: DataFrame, scenarios: Mapping[str, Mapping[str, float]] = STRESS_SCENARIOS
) -> DataFrame:
    """Totals by scenario, by scenario and stage, and by scenario and industry, in one scan.

    The scenarios are rows, so one set of expressions serves them all.
    """
    rows = in_scenarios(with_risk_parameters(staged), scenarios)
    industry = industry_stress_multiplier(
        F.col("industry"), F.col("x_industry"), F.col("scenario") == "fx_shock"
    )
    measures = scenario_measures(rows, F.col("pd_12m_base") * F.col("x_pd") * industry, F.col("x_lgd"), F.col("x_ccf"))
    measured = rows.select("scenario", "ifrs9_stage", "industry", *[c.alias(m) for m, c in measures.items()])
    sets = [
        [F.col("scenario")],
        [F.col("scenario"), F.col("ifrs9_stage")],
        [F.col("scenario"), F.col("industry")],
    ]
    return measured.groupingSets(sets, "scenario", "ifrs9_stage", "industry").agg(
        F.grouping("ifrs9_stage").alias("_no_stage"),
        F.grouping("industry").alias("_no_industry"),
        F.count(F.lit(1)).alias("facilities"),
        total(F.col("ead")).alias("total_ead"),
        total(F.col("ecl")).alias("total_ecl"),
        F.avg("pd_12m").alias("avg_pd_12m"),
        F.avg("lgd").alias("avg_lgd"),
        F.avg("ccf").alias("avg_ccf"),
    )


def stress_summary(cube: DataFrame) -> DataFrame:
    """Totals per scenario, worst first, with the change against the base scenario."""
    # One row per scenario: the unpartitioned window sees a handful of rows.
    base = F.max(F.when(F.col("scenario") == "base", F.col("total_ecl"))).over(Window.partitionBy())
    change = F.col("total_ecl") - base
    ead = F.col("total_ead")
    return (
        cube.filter("_no_stage = 1 and _no_industry = 1")
        .select(
            "scenario",
            "facilities",
            "total_ead",
            "total_ecl",
            F.when(ead != 0, F.col("total_ecl") / ead).otherwise(0.0).alias("ecl_rate"),
            "avg_pd_12m",
            "avg_lgd",
            "avg_ccf",
            change.alias("ecl_change_vs_base"),
            F.when(base != 0, change / base).otherwise(0.0).alias("ecl_change_pct_vs_base"),
        )
        .orderBy(F.desc("total_ecl"))
    )


_KEYED = ["facilities", "total_ead", "total_ecl", "avg_pd_12m", "avg_lgd"]


def stress_by_stage(cube: DataFrame) -> DataFrame:
    stages = cube.filter("_no_stage = 0 and ifrs9_stage is not null")
    return stages.select("scenario", "ifrs9_stage", *_KEYED).orderBy("scenario", "ifrs9_stage")


def stress_by_industry(cube: DataFrame) -> DataFrame:
    industries = cube.filter("_no_industry = 0")
    return industries.select("scenario", "industry", *_KEYED).orderBy("scenario", F.asc_nulls_last("industry"))
