"""Expected credit loss: risk parameters, scenario calculation, reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import clip, clip_ccf, clip_lgd, clip_probability, numeric_column, or_zero, total

# Scenario multipliers, scenario weights, parameter floors and product factors.
SCENARIO_FACTORS = {
    "base": {"pd": 1.00, "lgd": 1.00, "ccf": 1.00},
    "downside": {"pd": 1.35, "lgd": 1.10, "ccf": 1.15},
    "upside": {"pd": 0.85, "lgd": 0.95, "ccf": 0.90},
}
SCENARIO_WEIGHTS = {"base": 0.60, "downside": 0.25, "upside": 0.15}
DEFAULT_PD = 0.02
MIN_LIFE_YEARS = 0.25
DEFAULT_LIFE_YEARS = 1.0
PRODUCT_CCF = {"credit_line": 0.45, "overdraft": 0.75, "trade_finance": 0.35}
OTHER_REVOLVING_CCF = 0.40


def lifetime_pd(annual_pd: Column, years: Column) -> Column:
    """Probability of at least one default over the remaining years (one year when unknown)."""
    horizon = clip(F.coalesce(years, F.lit(1.0)), lower=0.0)
    return clip_probability(1 - F.pow(1 - clip_probability(annual_pd), horizon))


def expected_loss(pd: Column, lgd: Column, ead: Column) -> Column:
    """PD x LGD x EAD with bounded factors; a missing exposure is zero."""
    return clip_probability(pd) * clip_lgd(lgd) * F.greatest(or_zero(ead), F.lit(0.0))


def stage_ecl(stage: Column, pd_12m: Column, pd_lifetime: Column, lgd: Column, ead: Column) -> Column:
    """Twelve-month loss in stage 1 (or an unknown stage), lifetime in stage 2, full loss in stage 3."""
    pd_used = F.when(stage == 2, pd_lifetime).when(stage == 3, 1.0).otherwise(pd_12m)
    return expected_loss(pd_used, lgd, ead)


def scenario_weighted(losses: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    weighted = F.lit(0.0)
    for scenario, loss in losses.items():
        weighted = weighted + or_zero(loss) * weights.get(scenario, 0.0)
    return weighted


def collateral_lgd(df: DataFrame) -> Column:
    """Loss rate falling with collateral coverage, higher when unsecured, within [0.05, 0.95]."""
    name = "effective_collateral_coverage"
    if name not in df.columns:
        name = "collateral_coverage"
    coverage = F.coalesce(numeric_column(df, name, 0.0), F.lit(0.0))
    kind = F.col("collateral_type") if "collateral_type" in df.columns else F.lit("none")
    unsecured = F.lower(F.coalesce(kind, F.lit("none"))) == "none"
    lgd = 0.72 - 0.28 * clip(coverage, 0.0, 2.5) + F.when(unsecured, 0.12).otherwise(0.0)
    return clip(lgd, 0.05, 0.95)


def product_ccf(df: DataFrame) -> Column:
    """Conversion factor by product; other revolving products share one factor."""
    product = F.col("product_type") if "product_type" in df.columns else F.lit("term_loan")
    chain = F
    for name, factor in PRODUCT_CCF.items():
        chain = chain.when(product == name, factor)
    return chain.when(numeric_column(df, "revolving_flag") == 1, OTHER_REVOLVING_CCF).otherwise(0.0)


def drawn_balance(df: DataFrame) -> Column:
    name = "current_outstanding_balance" if "current_outstanding_balance" in df.columns else "outstanding_amount"
    return F.greatest(or_zero(numeric_column(df, name)), F.lit(0.0))


def undrawn_balance(df: DataFrame) -> Column:
    return F.greatest(or_zero(numeric_column(df, "undrawn_amount")), F.lit(0.0))


def with_risk_parameters(df: DataFrame) -> DataFrame:
    """Add remaining life and the base PD, LGD, CCF and EAD."""
    days = F.datediff(F.col("maturity_date").try_cast("date"), F.col("reporting_date").try_cast("date"))
    life = clip(days / 365.25, lower=MIN_LIFE_YEARS)
    pd = F.coalesce(
        numeric_column(df, "current_pd_estimate"),
        numeric_column(df, "origination_pd_estimate"),
        F.lit(DEFAULT_PD),
    )
    parameters = df.withColumns(
        {
            "remaining_life_years": F.coalesce(life, F.lit(DEFAULT_LIFE_YEARS)),
            "pd_12m_base": clip_probability(pd),
            "lgd_base": collateral_lgd(df),
            "ccf_base": product_ccf(df),
        }
    )
    return parameters.withColumn("ead_base", drawn_balance(df) + F.col("ccf_base") * undrawn_balance(df))


MEASURES = ["pd_12m", "lifetime_pd", "lgd", "ccf", "ead", "ecl"]


def scenario_measures(
    df: DataFrame, pd: Column, lgd_factor: Column | float, ccf_factor: Column | float
) -> dict[str, Column]:
    """Scenario parameters and loss over a frame with risk parameters, for a scaled 12-month PD."""
    pd = clip_probability(pd)
    lgd = clip_lgd(F.col("lgd_base") * lgd_factor)
    ccf = clip_ccf(F.col("ccf_base") * ccf_factor)
    ead = drawn_balance(df) + ccf * undrawn_balance(df)
    life_pd = lifetime_pd(pd, F.col("remaining_life_years"))
    loss = stage_ecl(numeric_column(df, "ifrs9_stage"), pd, life_pd, lgd, ead)
    return dict(zip(MEASURES, [pd, life_pd, lgd, ccf, ead, loss]))


def in_scenarios(df: DataFrame, scenarios: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Every row once per scenario, with the scenario's name and multipliers (`x_<name>`) as columns."""
    rows = [
        F.struct(F.lit(name).alias("scenario"), *[F.lit(float(v)).alias(f"x_{k}") for k, v in factors.items()])
        for name, factors in scenarios.items()
    ]
    return df.select("*", F.inline(F.array(*rows)))


def facility_ecl(staged: DataFrame, weights: Mapping[str, float] = SCENARIO_WEIGHTS) -> DataFrame:
    """Loss per facility under every scenario, and the weighted loss. One projection, no shuffle."""
    data = with_risk_parameters(staged)
    columns: dict[str, Column] = {}
    for scenario, factors in SCENARIO_FACTORS.items():
        measures = scenario_measures(data, F.col("pd_12m_base") * factors["pd"], factors["lgd"], factors["ccf"])
        columns |= {f"{m}_{scenario}": c for m, c in measures.items()}
    losses = {scenario: F.col(f"ecl_{scenario}") for scenario in SCENARIO_FACTORS}
    return data.withColumns(columns).withColumn("scenario_weighted_ecl", scenario_weighted(losses, weights))


def ecl_by_scenario(staged: DataFrame, weights: Mapping[str, float] = SCENARIO_WEIGHTS) -> DataFrame:
    """Totals per scenario: the scenarios are rows here, so one set of expressions serves them all."""
    factors = {s: {**f, "weight": weights.get(s, 0.0)} for s, f in SCENARIO_FACTORS.items()}
    rows = in_scenarios(with_risk_parameters(staged), factors)
    measures = scenario_measures(rows, F.col("pd_12m_base") * F.col("x_pd"), F.col("x_lgd"), F.col("x_ccf"))
    return (
        rows.select("scenario", "x_weight", *[c.alias(m) for m, c in measures.items()])
        .groupBy("scenario", F.col("x_weight").alias("scenario_weight"))
        .agg(
            total(F.col("ecl")).alias("total_ecl"),
            F.avg("ecl").alias("avg_ecl"),
            total(F.col("ead")).alias("total_ead"),
            F.avg("pd_12m").alias("avg_pd_12m"),
            F.avg("lgd").alias("avg_lgd"),
        )
    )


def _loss_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("facilities"),
        total(F.col("ead_base")).alias("total_ead"),
        total(F.col("scenario_weighted_ecl")).alias("total_ecl"),
        F.avg("scenario_weighted_ecl").alias("avg_ecl"),
        F.avg("pd_12m_base").alias("avg_pd_12m"),
        F.avg("lgd_base").alias("avg_lgd"),
    ]


def ecl_by_stage(ecl: DataFrame) -> DataFrame:
    known = ecl.filter(F.col("ifrs9_stage").isNotNull())
    return known.groupBy("ifrs9_stage").agg(*_loss_measures()).orderBy("ifrs9_stage")


def ecl_by_rating(ecl: DataFrame) -> DataFrame:
    return ecl.groupBy("current_rating_grade").agg(*_loss_measures()).orderBy(F.asc_nulls_last("current_rating_grade"))


def ecl_by_industry(ecl: DataFrame) -> DataFrame:
    return ecl.groupBy("industry").agg(*_loss_measures()).orderBy(F.desc("total_ecl"))


def ecl_cube(ecl: DataFrame) -> DataFrame:
    """The stage, rating, industry and portfolio reports in one scan of the portfolio.

    `dimension` names the report and `member` the group as text; a missing grade or industry is
    a member of its own, told from a subtotal by the grouping id.
    """
    dimensions = ["ifrs9_stage", "current_rating_grade", "industry"]
    sets = [[F.col(d)] for d in dimensions] + [[]]
    grouped = ecl.groupingSets(sets, *dimensions).agg(
        F.grouping("ifrs9_stage").alias("_g0"),
        F.grouping("current_rating_grade").alias("_g1"),
        F.grouping("industry").alias("_g2"),
        *_loss_measures(),
    )
    dimension = F.lit("portfolio")
    for i, name in enumerate(dimensions):
        dimension = F.when(F.col(f"_g{i}") == 0, name).otherwise(dimension)
    member = F.coalesce(F.col("ifrs9_stage").cast("string"), "current_rating_grade", "industry")
    return grouped.select(
        dimension.alias("dimension"), member.alias("member"),
        "facilities", "total_ead", "total_ecl", "avg_ecl", "avg_pd_12m", "avg_lgd",
    )


def ecl_portfolio(ecl: DataFrame) -> DataFrame:
    def share(stage: int) -> Column:
        return F.avg(F.when(F.col("ifrs9_stage") == stage, 1.0).otherwise(0.0))

    return ecl.agg(
        F.count(F.lit(1)).alias("facilities"),
        total(F.col("ead_base")).alias("total_ead"),
        total(F.col("scenario_weighted_ecl")).alias("total_ecl"),
        F.avg("pd_12m_base").alias("avg_pd_12m"),
        F.avg("lgd_base").alias("avg_lgd"),
        share(1).alias("stage_1_share"),
        share(2).alias("stage_2_share"),
        share(3).alias("stage_3_share"),
    ).select(
        "facilities",
        "total_ead",
        "total_ecl",
        F.when(F.col("total_ead") != 0, F.col("total_ecl") / F.col("total_ead")).otherwise(0.0).alias("ecl_rate"),
        "avg_pd_12m",
        "avg_lgd",
        "stage_1_share",
        "stage_2_share",
        "stage_3_share",
    )


def ecl_validation_summary(portfolio: DataFrame) -> DataFrame:
    """The portfolio report without its rate."""
    return portfolio.drop("ecl_rate")
