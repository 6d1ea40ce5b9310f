"""Registered queries: every operator run over the whole portfolio derived from a testdata folder.

Validation queries score with the origination PD and with rule-based loss and conversion factors,
so they need no trained model. `digits` gives the decimals a result column is rounded to, in Spark
and in the oracle alike: sums and averages of doubles depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.functions.numeric import rounded
from lossledger.functions.ratios import STATEMENT_RATIOS, with_financial_ratios
from lossledger.models import calibration, isotonic, ridge, sigmoid, training
from lossledger.operators import (
    asof,
    backtesting,
    ecl,
    features,
    leakage,
    marts,
    master_scale,
    metrics,
    outliers,
    quality,
    reports,
    rollups,
    sketches,
    splitting,
    stability,
    staging,
    stress,
)
from lossledger.plans import model_checks, source_checks
from lossledger.plans.oracle import oracle_query
from lossledger.session import limit_generated_methods, materialize
from lossledger.sources.portfolio import REPORTING_DATE, Portfolio

PD, TARGET = "origination_pd_estimate", "target_default_12m"
SEGMENTS = ["product_type", "collateral_type", "industry", "company_size", "origination_rating_grade"]
WINSORIZED = ["debt_to_ebitda", "interest_coverage", "revenue_growth_yoy"]
PSI_TOP_N = 20
# The bound of a bounded fit, here as a report of its own.
EARLIEST_ROWS = 500


class Frames:
    """Shared intermediate frames of one query call. Stored ones are read by several jobs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.portfolio = Portfolio(spark, folder)
        self.raw = self.portfolio.raw()

    @cached_property
    def mart(self) -> DataFrame:
        return marts.ratio_mart(self.raw)

    @cached_property
    def stored_mart(self) -> DataFrame:
        return materialize(self.mart)

    @cached_property
    def staging_sample(self) -> DataFrame:
        return self._staging_sample(self.mart)

    def _staging_sample(self, mart: DataFrame) -> DataFrame:
        return marts.staging_sample(
            mart, self.raw["rating_history"], self.raw["payments"], REPORTING_DATE, self.raw["loan_facilities"]
        )

    @cached_property
    def staged(self) -> DataFrame:
        return staging.assign_stage(self.staging_sample)

    @cached_property
    def ecl(self) -> DataFrame:
        return ecl.facility_ecl(self.staged)

    @cached_property
    def stress_cube(self) -> DataFrame:
        return stress.stress_cube(self.staged)

    @cached_property
    def pd_split(self) -> DataFrame:
        return splitting.time_split(materialize(marts.pd_outcomes(self.raw)))

    @cached_property
    def pd_oot(self) -> DataFrame:
        return splitting.split_part(self.pd_split, "oot")

    @cached_property
    def lgd_split(self) -> DataFrame:
        sample = materialize(marts.lgd_sample(self.mart, self.raw["macro_scenarios"]))
        split = splitting.time_split(sample, "default_date", "realized_lgd")
        return split.withColumn("lgd_rule", ecl.collateral_lgd(split))

    @cached_property
    def ccf_split(self) -> DataFrame:
        sample = materialize(marts.ccf_sample(self.mart, self.raw["macro_scenarios"]))
        split = splitting.time_split(sample, "default_date", "realized_ccf")
        return split.withColumn("ccf_rule", ecl.product_ccf(split))

    @cached_property
    def psi_details(self) -> DataFrame:
        sample = marts.pd_sample(self.mart)
        # Of a stored mart the sample is a choice of rows and columns: a second copy would only take room.
        stored = sample if self.mart is self.__dict__.get("stored_mart") else materialize(sample)
        return psi_between_splits(splitting.time_split(stored))

    @cached_property
    def grade_report(self) -> DataFrame:
        return backtesting.pd_backtest_by_grade(self.pd_oot, PD)

    @cached_property
    def grade_summary(self) -> DataFrame:
        scored = self.pd_oot.filter(F.col(PD).isNotNull())
        return backtesting.rating_grade_summary(scored, PD)

    @cached_property
    def pd_metrics(self) -> DataFrame:
        return pd_metrics(self.pd_split)

    @cached_property
    def lgd_metrics(self) -> DataFrame:
        return severity_metrics(self.lgd_split, "realized_lgd", "lgd_rule", "collateral_rule")

    @cached_property
    def ccf_metrics(self) -> DataFrame:
        return severity_metrics(self.ccf_split, "realized_ccf", "ccf_rule", "product_rule")

    def quality_tables(self, mart: DataFrame, staging_sample: DataFrame | None = None) -> dict[str, DataFrame]:
        """The checked tables; `staging_sample` where it is stored already."""
        raw = {f"raw.{name}": df for name, df in self.raw.items()}
        macro = self.raw["macro_scenarios"]
        return {
            **raw,
            "mart.financial_ratios_mart": mart,
            "mart.pd_modeling_sample": marts.pd_sample(mart),
            "mart.lgd_modeling_sample": marts.lgd_sample(mart, macro),
            "mart.ead_ccf_modeling_sample": marts.ccf_sample(mart, macro),
            "mart.ifrs9_staging_sample": self._staging_sample(mart) if staging_sample is None else staging_sample,
        }

    def headline_reports(self) -> dict[str, DataFrame]:
        """The reports behind the traffic lights and the executive summary, over one stored mart."""
        self.mart = self.stored_mart
        self.staging_sample = materialize(self._staging_sample(self.mart))
        return {
            "pd_model_metrics": self.pd_metrics,
            "lgd_model_metrics": self.lgd_metrics,
            "ead_ccf_model_metrics": self.ccf_metrics,
            "validation_psi_summary": stability.psi_summary(self.psi_details),
            "validation_rating_monotonicity_summary": backtesting.monotonicity_summary(self.grade_report),
            "validation_rating_binomial_backtesting": backtesting.binomial_backtest(self.grade_report),
            "ifrs9_ecl_portfolio_summary": ecl.ecl_portfolio(self.ecl),
            "stress_scenario_summary": stress.stress_summary(self.stress_cube),
            "data_quality_summary": quality.data_quality(self.quality_tables(self.mart, self.staging_sample)),
        }


def psi_between_splits(split: DataFrame) -> DataFrame:
    """Train against out-of-time for every numeric feature of a split sample."""
    numeric = features.numeric_features(split, ["facility_id", "company_id", "observation_date", TARGET, "split"])
    train, oot = splitting.split_part(split, "train"), splitting.split_part(split, "oot")
    return stability.psi_details(train, oot, numeric)


def train_mean(split: DataFrame, target: str) -> float:
    return splitting.split_part(split, "train").agg(F.avg(target)).first()[0]


def pd_metrics(split: DataFrame) -> DataFrame:
    prior = train_mean(split, TARGET)
    scores = split.select(
        "split",
        TARGET,
        F.inline(
            F.array(
                F.struct(F.lit("origination_pd").alias("model"), F.col(PD).alias("score")),
                F.struct(F.lit("dummy_prior").alias("model"), F.lit(prior).alias("score")),
            )
        ),
    )
    return metrics.binary_metrics(scores, "score", TARGET, by=["model", "split"])


def severity_metrics(split: DataFrame, actual: str, rule: str, name: str) -> DataFrame:
    mean = train_mean(split, actual)
    rows = split.select(
        "split",
        actual,
        "ead_at_default",
        F.inline(
            F.array(
                F.struct(F.lit(name).alias("model"), F.col(rule).alias("predicted")),
                F.struct(F.lit("dummy_mean").alias("model"), F.lit(mean).alias("predicted")),
            )
        ),
    )
    return metrics.regression_metrics(rows, actual, "predicted", "ead_at_default", by=["model", "split"])


def asof_statement(f: Frames) -> DataFrame:
    base = f.raw["loan_facilities"].select("facility_id", "company_id", "origination_date")
    history = marts.statement_history(f.raw["financial_statements"])
    joined = asof.asof_join(base, [history], by="company_id", left_on="origination_date")
    return joined.drop("company_id", "origination_date")


def asof_rating(f: Frames) -> DataFrame:
    base = f.raw["loan_facilities"].select("facility_id", "company_id", "origination_date")
    history = marts.origination_rating_history(f.raw["rating_history"])
    joined = asof.asof_join(base, [history], by="company_id", left_on="origination_date")
    return joined.drop("company_id", "origination_date")


def payment_rollup(f: Frames) -> DataFrame:
    observed = f.raw["loan_facilities"].select("facility_id", F.col("origination_date").alias("observation_date"))
    return rollups.payment_rollup(observed, f.raw["payments"])


ECL_COLUMNS = ["facility_id", "ifrs9_stage", "remaining_life_years", "pd_12m_base", "lgd_base", "ccf_base", "ead_base"]


def ecl_facility(f: Frames) -> DataFrame:
    scenario = [f"{m}_{s}" for s in ecl.SCENARIO_FACTORS for m in ecl.MEASURES]
    columns = ECL_COLUMNS + [c for c in scenario if c not in ECL_COLUMNS] + ["scenario_weighted_ecl"]
    return f.ecl.select(*columns)


def stress_facility(f: Frames) -> DataFrame:
    columns = [f"stress_{m}_{s}" for s in stress.STRESS_SCENARIOS for m in ecl.MEASURES]
    return stress.facility_stress(f.staged).select("facility_id", "industry", *columns)


def winsorized_ratios(f: Frames) -> DataFrame:
    ratios = materialize(
        with_financial_ratios(f.raw["financial_statements"]).select("company_id", "report_date", *WINSORIZED)
    )
    return outliers.winsorize(ratios, WINSORIZED)


def order_texts(f: Frames) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    return f.portfolio.source("orders").select(
        key.cast("string").alias("order_text"),
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.when(key % 4 == 0, "n/a").otherwise(customer).alias("customer_text"),
        F.when(key % 10 == 0, "n/a").otherwise(customer).alias("mostly_number_text"),
        "o_orderpriority",
    )


def samples(f: Frames) -> dict[str, DataFrame]:
    macro = f.raw["macro_scenarios"]
    return {
        "pd": marts.pd_sample(f.mart), "lgd": marts.lgd_sample(f.mart, macro), "ccf": marts.ccf_sample(f.mart, macro),
    }


def two_pd_scores(f: Frames) -> DataFrame:
    columns = ["facility_id", "observation_date", TARGET, PD, "current_pd_estimate"]
    split = splitting.time_split(materialize(f.staging_sample.select(*columns)))
    return splitting.split_part(split, "oot").select(
        "facility_id",
        TARGET,
        F.inline(
            F.array(
                F.struct(F.lit("origination").alias("model"), F.col(PD).alias("predicted_pd")),
                F.struct(F.lit("current").alias("model"), F.col("current_pd_estimate").alias("predicted_pd")),
            )
        ),
    )


def label_metrics(f: Frames) -> DataFrame:
    rows = f.portfolio.source("labels").join(f.portfolio.source("documents").select("doc_id", "n_chars"), "doc_id")
    scored = rows.select(F.lit("all").alias("scope"), F.col("n_chars").cast("double").alias("score"), "toxic")
    return metrics.binary_metrics(scored, "score", "toxic", by=["scope"]).drop("brier_score")


def margins(f: Frames, part: str) -> DataFrame:
    """The origination PD as a score to calibrate: facility_id, label, raw, margin (its log odds)."""
    rows = splitting.split_part(f.pd_split, part).filter(F.col(PD).isNotNull())
    return rows.select(
        "facility_id", F.col(TARGET).alias("label"), F.col(PD).alias("raw"), F.log(F.col(PD) / (1 - F.col(PD))).alias("margin")
    )


def calibrated_rows(f: Frames) -> DataFrame:
    valid, oot = margins(f, "valid"), margins(f, "oot")
    curve = sigmoid.fit(valid).calibrated(F.col("margin"))
    stepped = isotonic.calibrated(oot, isotonic.fit(valid))
    return stepped.select("facility_id", curve.alias("sigmoid"), F.col("calibrated").alias("isotonic"))


def calibration_methods(f: Frames) -> DataFrame:
    """Three methods, of which the library has no third: its row stays, with the reason."""
    return calibration.calibrate_margins(margins(f, "valid"), margins(f, "oot"), [*calibration.METHODS, "beta"]).metrics


RIDGE_COLUMNS = ["term_years", "interest_rate", "dpd_quarters", "coverage"]


def ridge_rows(f: Frames) -> DataFrame:
    """Train rows of the loss model with four numbers of like size, and the exposure in 100,000 as weight."""
    ead = F.col("ead_at_default")
    return splitting.split_part(f.lgd_split, "train").select(
        "realized_lgd", (ead / 100_000).alias("exposure"), (F.col("term_months") / 12).alias("term_years"), "interest_rate",
        (F.col("dpd_at_default") / 90).alias("dpd_quarters"),
        F.least(F.coalesce(F.col("effective_collateral_value"), F.lit(0.0)) / ead, F.lit(5.0)).alias("coverage"),
    )


def cross_products(f: Frames) -> DataFrame:
    return ridge.cross_products(ridge_rows(f), RIDGE_COLUMNS, "realized_lgd", "exposure")


def ridge_coefficients(f: Frames) -> DataFrame:
    found = ridge.solve(materialize(cross_products(f)), RIDGE_COLUMNS, "realized_lgd")
    rows = [*found.coefficients.items(), (ridge.ONE, found.intercept)]
    return f.spark.createDataFrame(rows, "feature string, coefficient double")


def named_scores(f: Frames) -> DataFrame:
    columns = ["facility_id", "observation_date", TARGET, PD, "current_pd_estimate"]
    split = splitting.time_split(materialize(f.staging_sample.select(*columns)))
    return splitting.split_part(split, "oot").select(
        F.lit(0.5).alias("pd_dummy_prior"), F.col(PD).alias("pd_origination"), F.col("current_pd_estimate").alias("pd_current")
    )


def sketch_ranks(f: Frames) -> DataFrame:
    """feature, cuts, expected_within, actual_within: whether ranks of sketches merged from months are near the exact
    shares at all cuts of the exact report."""
    split = splitting.time_split(materialize(marts.pd_sample(f.mart))).withColumn("month", F.trunc("observation_date", "MM"))
    numeric = features.numeric_features(split, ["facility_id", "company_id", "observation_date", TARGET, "split", "month"])
    monthly = materialize(sketches.feature_sketches(split.filter("split <> 'valid'"), numeric, ["split", "month"]))
    whole = sketches.merged(monthly, ["split"])
    details = materialize(psi_between_splits(split.drop("month")))
    # A row per feature and bin.
    so_far = Window.partitionBy("feature").orderBy("bin")
    exact = details.filter("bin is not null").select(
        "feature", "upper_bound", F.sum("expected_share").over(so_far).alias("train"), F.sum("actual_share").over(so_far).alias("oot")
    ).filter(F.col("upper_bound") < float("inf"))
    cuts: dict[str, list[float]] = {}
    for r in exact.orderBy("feature", "upper_bound").select("feature", "upper_bound").collect():
        cuts.setdefault(r["feature"], []).append(r["upper_bound"])
    shares = exact.groupBy("feature").agg(*[
        F.array_sort(F.collect_list(F.struct("upper_bound", s)))[s].alias(s) for s in ("train", "oot")
    ])
    for s, name in (("train", "expected_within"), ("oot", "actual_within")):
        side = whole.filter(F.col("split") == s).select("feature", sketches.ranks_at(F.col("sketch"), cuts).alias("ranks"))
        near = F.zip_with("ranks", s, lambda x, y: F.abs(x - y) <= sketches.RANK_ERROR)
        shares = shares.join(side, "feature").withColumn(name, F.forall(near, lambda x: x)).drop("ranks")
    return shares.select("feature", F.size("train").cast("bigint").alias("cuts"), "expected_within", "actual_within")


def validation_summary(f: Frames) -> DataFrame:
    f.mart = f.stored_mart
    f.staging_sample = materialize(f.staging_sample)
    return reports.validation_summary(
        f.grade_report,
        backtesting.monotonicity_summary(f.grade_report),
        stability.psi_summary(f.psi_details),
        staging.stage_summary(f.staged),
        ecl.ecl_portfolio(f.ecl),
    )


def _digits(places: int, *columns: str) -> dict[str, int]:
    return dict.fromkeys(columns, places)


MART_SUMS = _digits(
    6, "collateral_value", "effective_collateral_value", "loan_to_value", "collateral_coverage",
    "effective_collateral_coverage",
)
PAYMENT_SUMS = _digits(6, "total_scheduled_amount", "total_paid_amount")
RECOVERY_SUMS = _digits(6, "total_recovery_amount", "total_collection_cost")
STAGE_DIGITS = {
    **_digits(2, "total_outstanding"), **_digits(6, "avg_current_pd", "avg_origination_pd", "default_rate"),
}
LOSS_DIGITS = {**_digits(2, "total_ead", "total_ecl"), **_digits(4, "avg_ecl"), **_digits(6, "avg_pd_12m", "avg_lgd")}
KEYED_STRESS = {**_digits(2, "total_ead", "total_ecl"), **_digits(6, "avg_pd_12m", "avg_lgd")}
SHARES = _digits(6, "stage_1_share", "stage_2_share", "stage_3_share")
PD_BINS = _digits(
    6, "observed_default_rate", "avg_predicted_pd", "min_predicted_pd", "max_predicted_pd", "calibration_error",
)
METRICS = _digits(6, *metrics.RANK_METRICS, "brier_score", "mean_predicted_pd", "observed_default_rate")
ERRORS = _digits(9, "mae", "rmse", "mean_actual", "mean_predicted", "weighted_mae", "weighted_rmse")


def _severity_digits(measure: str, mean_ead: bool) -> dict[str, int]:
    digits = {**_digits(9, f"avg_actual_{measure}", f"avg_predicted_{measure}", "prediction_error"), **_digits(2, "total_ead")}
    return {**digits, **_digits(4, "avg_ead")} if mean_ead else digits


def _scenario_digits(prefix: str, scenarios) -> dict[str, int]:
    return {
        f"{prefix}{m}_{s}": n for s in scenarios for m, n in [("lifetime_pd", 6), ("lgd", 6), ("ecl", 2)]
    }


@dataclass(frozen=True)
class Query:
    build: Callable[[Frames], DataFrame]
    oracle: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        limit_generated_methods(spark)
        return rounded(self.build(Frames(spark, folder)), self.digits)

    def sql(self) -> str | None:
        return oracle_query(self.oracle, self.digits) if self.oracle else None


QUERIES: dict[str, Query] = {
    # Point-in-time joins and rollups.
    "asof_statement": Query(asof_statement, "asof_statement"),
    "asof_rating": Query(asof_rating, "asof_rating"),
    "collateral_rollup": Query(
        lambda f: rollups.collateral_rollup(f.raw["collateral"]), "collateral_rollup",
        _digits(6, "collateral_value", "effective_collateral_value"),
    ),
    "payment_rollup": Query(payment_rollup, "payment_rollup", PAYMENT_SUMS),
    "recovery_rollup": Query(lambda f: rollups.recovery_rollup(f.raw["recoveries"]), "recovery_rollup", RECOVERY_SUMS),
    "current_rating": Query(lambda f: marts.current_rating(f.raw["rating_history"], REPORTING_DATE), "current_rating"),
    "latest_payment": Query(lambda f: marts.latest_payment(f.raw["payments"], REPORTING_DATE), "latest_payment"),
    # Marts and samples.
    "ratio_mart": Query(
        lambda f: f.mart, "mart",
        {**MART_SUMS, **PAYMENT_SUMS, **RECOVERY_SUMS, **_digits(6, "payment_completion_rate", "realized_lgd")},
    ),
    "pd_sample": Query(lambda f: marts.pd_sample(f.mart), "pd_sample", MART_SUMS),
    "lgd_sample": Query(
        lambda f: marts.lgd_sample(f.mart, f.raw["macro_scenarios"]), "lgd_sample",
        {**MART_SUMS, **RECOVERY_SUMS, **_digits(6, "net_recovery_amount", "realized_lgd")},
    ),
    "ccf_sample": Query(lambda f: marts.ccf_sample(f.mart, f.raw["macro_scenarios"]), "ccf_sample", MART_SUMS),
    "staging_sample": Query(
        lambda f: f.staging_sample, "staging_sample",
        {k: v for k, v in MART_SUMS.items() if k != "loan_to_value"},
    ),
    "financial_ratios": Query(
        lambda f: with_financial_ratios(f.raw["financial_statements"]).select(
            "company_id", "report_date", "total_debt", *STATEMENT_RATIOS
        ),
        "financial_ratios",
    ),
    # Staging.
    "stage_assignment": Query(
        lambda f: f.staged.select("facility_id", "ifrs9_stage", "ifrs9_stage_reason"), "stage_assignment"
    ),
    "stage_distribution": Query(
        lambda f: staging.stage_distribution(f.staged), "stage_distribution",
        {**STAGE_DIGITS, **_digits(6, "facility_share", "outstanding_share")},
    ),
    "stage_by_rating": Query(
        lambda f: staging.stage_by_rating(f.staged), "stage_by_rating",
        {k: v for k, v in STAGE_DIGITS.items() if k != "avg_origination_pd"},
    ),
    "stage_validation_summary": Query(
        lambda f: staging.stage_summary(f.staged), "stage_validation_summary", STAGE_DIGITS
    ),
    "migration_matrix": Query(lambda f: staging.rating_migrations(f.staged), "migration_matrix"),
    # Expected credit loss.
    "ecl_facility": Query(
        ecl_facility, "ecl_facility",
        {
            **_digits(6, "remaining_life_years"),
            **_scenario_digits("", ecl.SCENARIO_FACTORS),
            **_digits(2, "scenario_weighted_ecl"),
        },
    ),
    "ecl_by_scenario": Query(lambda f: ecl.ecl_by_scenario(f.staged), "ecl_by_scenario", LOSS_DIGITS),
    "ecl_by_stage": Query(lambda f: ecl.ecl_by_stage(f.ecl), "ecl_by_stage", LOSS_DIGITS),
    "ecl_by_rating": Query(lambda f: ecl.ecl_by_rating(f.ecl), "ecl_by_rating", LOSS_DIGITS),
    "ecl_by_industry": Query(lambda f: ecl.ecl_by_industry(f.ecl), "ecl_by_industry", LOSS_DIGITS),
    "ecl_cube": Query(lambda f: ecl.ecl_cube(f.ecl), "ecl_cube", LOSS_DIGITS),
    "ecl_portfolio": Query(
        lambda f: ecl.ecl_portfolio(f.ecl), "ecl_portfolio",
        {**KEYED_STRESS, **_digits(6, "ecl_rate"), **SHARES},
    ),
    "ecl_validation_summary": Query(
        lambda f: ecl.ecl_validation_summary(ecl.ecl_portfolio(f.ecl)), "ecl_validation_summary",
        {**KEYED_STRESS, **SHARES},
    ),
    # Stress.
    "stress_facility": Query(stress_facility, "stress_facility", _scenario_digits("stress_", stress.STRESS_SCENARIOS)),
    "stress_summary": Query(
        lambda f: stress.stress_summary(f.stress_cube), "stress_summary",
        {**KEYED_STRESS, **_digits(6, "ecl_rate", "avg_ccf", "ecl_change_pct_vs_base"), **_digits(2, "ecl_change_vs_base")},
    ),
    "stress_by_stage": Query(lambda f: stress.stress_by_stage(f.stress_cube), "stress_by_stage", KEYED_STRESS),
    "stress_by_industry": Query(lambda f: stress.stress_by_industry(f.stress_cube), "stress_by_industry", KEYED_STRESS),
    # Data quality, outliers, columns.
    "data_quality": Query(
        lambda f: quality.data_quality(f.quality_tables(f.stored_mart)), "data_quality", _digits(6, "metric_value")
    ),
    "lgd_outliers": Query(
        lambda f: outliers.lgd_outliers(materialize(marts.lgd_sample(f.mart, f.raw["macro_scenarios"]))), "lgd_outliers"
    ),
    "ccf_outliers": Query(
        lambda f: outliers.ccf_outliers(materialize(marts.ccf_sample(f.mart, f.raw["macro_scenarios"]))), "ccf_outliers"
    ),
    "winsorized_ratios": Query(winsorized_ratios, "winsorized_ratios", _digits(6, *WINSORIZED)),
    "leakage_report": Query(lambda f: leakage.leakage_coverage(f.mart), "leakage_report"),
    "numeric_coercion": Query(lambda f: features.numeric_like_profile(order_texts(f)), "numeric_coercion"),
    "coerced_rows": Query(lambda f: model_checks.typed_orders(order_texts(f)), "coerced_rows"),
    "parsed_rows": Query(lambda f: model_checks.dated_orders(f.portfolio.source("orders")), "parsed_rows"),
    "earliest_fit_rows": Query(
        lambda f: model_checks.earliest_fit_rows(f.pd_split, EARLIEST_ROWS), "earliest_fit_rows"
    ),
    "model_features": Query(lambda f: model_checks.model_features(samples(f)), "model_features"),
    "preparation_statistics": Query(
        lambda f: model_checks.preparation_statistics(marts.pd_sample(f.mart), training.PD_SPEC),
        "preparation_statistics", _digits(2, "median", "mean", "deviation"),
    ),
    "category_positions": Query(
        lambda f: model_checks.category_positions(marts.pd_sample(f.mart), training.PD_SPEC), "category_positions"
    ),
    "pd_model_checks": Query(
        lambda f: model_checks.model_checks(marts.pd_sample(f.mart), training.PD_SPEC), "pd_model_checks",
        _digits(6, "actual"),
    ),
    "lgd_model_checks": Query(
        lambda f: model_checks.model_checks(samples(f)["lgd"], training.LGD_SPEC), "lgd_model_checks",
        _digits(6, "actual"),
    ),
    "ccf_model_checks": Query(
        lambda f: model_checks.model_checks(samples(f)["ccf"], training.CCF_SPEC), "ccf_model_checks",
        _digits(6, "actual"),
    ),
    # Split, metrics, bins.
    "pd_time_split": Query(
        lambda f: splitting.split_summary(f.pd_split, "observation_date", TARGET), "pd_time_split",
        _digits(6, "default_rate"),
    ),
    "lgd_time_split": Query(
        lambda f: splitting.split_summary(f.lgd_split, "default_date", "realized_lgd", "avg_lgd"), "lgd_time_split",
        _digits(6, "avg_lgd"),
    ),
    "ccf_time_split": Query(
        lambda f: splitting.split_summary(f.ccf_split, "default_date", "realized_ccf", "avg_ccf"), "ccf_time_split",
        _digits(9, "avg_ccf"),
    ),
    "binary_metrics": Query(lambda f: f.pd_metrics, "binary_metrics", METRICS),
    "label_metrics": Query(
        label_metrics, "label_metrics", {k: v for k, v in METRICS.items() if k != "brier_score"}
    ),
    "lgd_regression_metrics": Query(lambda f: f.lgd_metrics, "lgd_regression_metrics", ERRORS),
    "ccf_regression_metrics": Query(lambda f: f.ccf_metrics, "ccf_regression_metrics", ERRORS),
    "pd_calibration_bins": Query(
        lambda f: backtesting.pd_calibration_by_bin(f.pd_oot, PD), "pd_calibration_bins", PD_BINS
    ),
    "lgd_calibration_bins": Query(
        lambda f: backtesting.severity_calibration_by_bin(
            splitting.split_part(f.lgd_split, "oot"), "realized_lgd", "lgd_rule", "lgd"
        ),
        "lgd_calibration_bins", _severity_digits("lgd", False),
    ),
    "ccf_calibration_bins": Query(
        lambda f: backtesting.severity_calibration_by_bin(
            splitting.split_part(f.ccf_split, "oot"), "realized_ccf", "ccf_rule", "ccf"
        ),
        "ccf_calibration_bins", _severity_digits("ccf", False),
    ),
    "quantile_calibration_bins": Query(
        lambda f: backtesting.calibration_by_score_bin(two_pd_scores(f)), "quantile_calibration_bins", PD_BINS
    ),
    "mean_observed_by_bin": Query(
        lambda f: backtesting.mean_observed_by_bin(backtesting.calibration_by_score_bin(two_pd_scores(f))),
        "mean_observed_by_bin", _digits(6, "observed_default_rate"),
    ),
    # Validation.
    "pd_backtest": Query(
        lambda f: f.grade_report, "pd_backtest",
        {**PD_BINS, **_digits(6, "observed_default_rate_lower_ci", "observed_default_rate_upper_ci")},
    ),
    "rating_grade_summary": Query(
        lambda f: f.grade_summary, "rating_grade_summary",
        {k: v for k, v in PD_BINS.items() if k != "calibration_error"},
    ),
    "confidence_bands": Query(
        lambda f: backtesting.confidence_bands(f.grade_report), "confidence_bands",
        _digits(6, "avg_predicted_pd", "observed_default_rate", "lower_error", "upper_error"),
    ),
    "actual_vs_predicted": Query(
        lambda f: backtesting.actual_vs_predicted(
            f.grade_report, "rating_grade", "observed_default_rate", "avg_predicted_pd"
        ),
        "actual_vs_predicted", _digits(6, "value"),
    ),
    "binomial_backtest": Query(
        lambda f: backtesting.binomial_backtest(f.grade_report), "binomial_backtest",
        _digits(6, "expected_defaults", "avg_predicted_pd", "observed_default_rate", "binomial_p_value"),
    ),
    "monotonicity": Query(lambda f: backtesting.monotonicity_summary(f.grade_report), "monotonicity"),
    "monotonicity_violations": Query(
        lambda f: backtesting.monotonicity_violations(f.grade_report), "monotonicity_violations",
        _digits(6, "previous_default_rate", "current_default_rate"),
    ),
    "psi_summary": Query(
        lambda f: stability.psi_summary(f.psi_details), "psi_summary",
        _digits(6, "psi", "expected_missing_rate", "actual_missing_rate"),
    ),
    "psi_details": Query(
        lambda f: stability.top_psi_details(f.psi_details, PSI_TOP_N), "psi_details",
        _digits(6, "lower_bound", "upper_bound", "expected_share", "actual_share", "psi_component"),
    ),
    "psi_all_details": Query(
        lambda f: stability.top_psi_details(f.psi_details, 0), "psi_all_details",
        _digits(6, "lower_bound", "upper_bound", "expected_share", "actual_share", "psi_component"),
    ),
    "sketch_ranks": Query(sketch_ranks, "sketch_ranks"),
    "alt_scale_mapping": Query(
        lambda f: master_scale.alternative_mapping(f.grade_summary), "alt_scale_mapping",
        _digits(6, "original_observed_default_rate", "original_avg_predicted_pd"),
    ),
    "alt_scale_backtest": Query(
        lambda f: master_scale.alternative_backtest(f.grade_summary, master_scale.alternative_mapping(f.grade_summary)),
        "alt_scale_backtest", {**PD_BINS, **_digits(6, "expected_defaults")},
    ),
    "lgd_by_segment": Query(
        lambda f: backtesting.segment_report(
            splitting.split_part(f.lgd_split, "oot"), "realized_lgd", "lgd_rule", "lgd", SEGMENTS
        ),
        "lgd_by_segment", _severity_digits("lgd", True),
    ),
    "ccf_by_product": Query(
        lambda f: backtesting.product_report(
            splitting.split_part(f.ccf_split, "oot"), "realized_ccf", "ccf_rule", "ccf"
        ),
        "ccf_by_product", _severity_digits("ccf", True),
    ),
    "validation_summary": Query(validation_summary, "validation_summary", _digits(2, "value")),
    "traffic_lights": Query(lambda f: reports.traffic_lights(f.headline_reports()), "traffic_lights"),
    "executive_summary": Query(lambda f: reports.executive_summary(f.headline_reports()), "executive_summary"),
    # Sources and sinks.
    "csv_round_trip": Query(lambda f: source_checks.csv_round_trip(f.raw), "csv_round_trip", _digits(2, "total")),
    "published_mart": Query(
        lambda f: source_checks.published_mart(f.mart, f.raw["payments"]), "published_mart", _digits(2, "outstanding")
    ),
    "published_portfolio": Query(lambda f: source_checks.published_portfolio(f.staged), "published_portfolio"),
    "report_read_back": Query(
        lambda f: source_checks.report_read_back(staging.stage_distribution(f.staged)), "report_read_back",
        {**STAGE_DIGITS, **_digits(6, "facility_share", "outstanding_share")},
    ),
    "score_choice": Query(lambda f: source_checks.score_choice(named_scores(f)), "score_choice", _digits(6, "mean_score")),
    # Fits whose optimum SQL reaches by another way.
    "sigmoid_fit": Query(
        lambda f: sigmoid.fit_report(margins(f, "valid")), "sigmoid_fit",
        _digits(6, "slope", "intercept", "slope_score", "intercept_score", "mean_calibrated", "mean_target"),
    ),
    "isotonic_steps": Query(
        lambda f: isotonic.fit(margins(f, "valid")).select("low", "high", "weight", "value"), "isotonic_steps",
        _digits(6, "low", "high", "value"),
    ),
    "calibrated_rows": Query(calibrated_rows, "calibrated_rows", _digits(6, "sigmoid", "isotonic")),
    "calibration_methods": Query(calibration_methods, "calibration_methods", METRICS),
    "cross_products": Query(cross_products, "cross_products", _digits(5, "total")),
    "ridge_coefficients": Query(ridge_coefficients, "ridge_coefficients", _digits(6, "coefficient")),
    # Trained models (no SQL equivalent).
    "pd_model_metrics": Query(lambda f: training.train_pd(marts.pd_sample(f.mart)).metrics),
    "lgd_model_metrics": Query(
        lambda f: training.train_lgd(marts.lgd_sample(f.mart, f.raw["macro_scenarios"])).metrics
    ),
    "ccf_model_metrics": Query(
        lambda f: training.train_ccf(marts.ccf_sample(f.mart, f.raw["macro_scenarios"])).metrics
    ),
    "pd_calibrated_metrics": Query(lambda f: calibration.calibrate_pd(marts.pd_sample(f.mart)).metrics),
    "pd_calibration_before_after": Query(
        lambda f: calibration.calibrate_pd(marts.pd_sample(f.mart)).before_after()
    ),
}
