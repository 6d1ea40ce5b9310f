"""Raw credit tables derived from the order, line-item, customer and part tables.

All selectors use integer and date arithmetic, and sums run over whole cents, so the
definitions give equal rows in any SQL engine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.functions.credit import pd_grade
from lossledger.sources.schemas import RAW_TABLES

REPORTING_DATE = dt.date(2001, 8, 1)
SHIFT_ORIGIN = dt.date(1995, 1, 1)
FIRST_MACRO_MONTH = dt.date(1995, 1, 1)
MACRO_MONTHS = 120

# How source categories map to portfolio categories (haircuts are binary fractions, so averages are exact).
INDUSTRY_OF_SEGMENT = {
    "BUILDING": "construction", "MACHINERY": "manufacturing", "AUTOMOBILE": "transport",
    "FURNITURE": "trade", "HOUSEHOLD": "services",
}
PRODUCT_OF_PRIORITY = {
    "1-URGENT": "overdraft", "2-HIGH": "credit_line", "3-MEDIUM": "trade_finance",
    "4-NOT SPECIFIED": "term_loan", "5-LOW": "working_capital",
}
REVOLVING_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
COLLATERAL_OF_TYPE = {
    "ECONOMY": ("none", 1.0), "MEDIUM": ("equipment", 0.375), "PROMO": ("inventory", 0.5),
    "SMALL": ("receivables", 0.4375), "LARGE": ("real_estate", 0.25), "STANDARD": ("guarantee", 0.3125),
}
# Scenario name, weight, severity step.
MACRO_SCENARIOS = [("base", 0.60, 0), ("downside", 0.25, 1), ("severe", 0.0, 3), ("upside", 0.15, -1)]


def _lookup(value: Column, mapping: dict) -> Column:
    chain = F
    for key, result in mapping.items():
        chain = chain.when(value == key, result)
    return chain


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


class Portfolio:
    """Lazy raw tables over one testdata folder. Nothing is read until an action runs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._sources: dict[str, DataFrame] = {}

    def source(self, table: str) -> DataFrame:
        if table not in self._sources:
            self._sources[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._sources[table]

    def _orders(self) -> DataFrame:
        return self.source("orders").withColumn("od", F.col("o_orderdate").cast("date"))

    def companies(self) -> DataFrame:
        c = F.col("c_custkey")
        return (
            self.source("customer")
            .join(F.broadcast(self.source("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(self.source("region")), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                c.alias("company_id"),
                F.date_add(F.lit(dt.date(1985, 1, 1)), (c % 1800).cast("int")).alias("registration_date"),
                _lookup(F.col("c_mktsegment"), INDUSTRY_OF_SEGMENT).alias("industry"),
                F.col("r_name").alias("region"),
                F.when(F.col("c_acctbal") < 0, "micro").when(F.col("c_acctbal") < 3000, "small")
                .when(F.col("c_acctbal") < 8000, "medium").otherwise("large").alias("company_size"),
                F.when(c % 3 == 0, "llc").when(c % 3 == 1, "jsc").otherwise("partnership").alias("legal_form"),
                F.when(c % 10 == 0, "state").when(c % 10 <= 2, "foreign").otherwise("private")
                .alias("ownership_type"),
                F.when(c % 10 < 3, "strong").when(c % 10 < 7, "average").otherwise("weak")
                .alias("latent_profile"),
                (1 + c % 30).cast("double").alias("years_in_business"),
                (5 + (c * 37) % 2000).cast("int").alias("employees_count"),
                _flag(c % 4 == 0).alias("exporter_flag"),
                _flag(c % 10 == 0).alias("state_related_flag"),
                _flag(c % 25 == 0).alias("related_party_flag"),
            )
        )

    def loan_facilities(self) -> DataFrame:
        k, limit = F.col("o_orderkey"), F.col("o_totalprice")
        revolving = F.col("o_orderpriority").isin(REVOLVING_PRIORITIES)
        outstanding = F.when(revolving, limit * (350 + 6 * (k % 100)) / 1000).otherwise(
            limit * (800 + 2 * (k % 100)) / 1000
        )
        months = (12 * (1 + k % 5)).cast("int")
        return self._orders().select(
            k.alias("facility_id"),
            F.col("o_custkey").alias("company_id"),
            F.col("od").alias("origination_date"),
            F.add_months("od", months).alias("maturity_date"),
            _lookup(F.col("o_orderpriority"), PRODUCT_OF_PRIORITY).alias("product_type"),
            limit.alias("limit_amount"),
            outstanding.alias("outstanding_amount"),
            (limit - outstanding).alias("undrawn_amount"),
            (0.08 + (k % 100) / 1000).alias("interest_rate"),
            months.alias("term_months"),
            _flag(revolving).alias("revolving_flag"),
            F.when(k % 3 == 0, "senior_secured").when(k % 3 == 1, "senior_unsecured")
            .otherwise("subordinated").alias("seniority"),
            F.when(k % 10 == 0, "USD").when(k % 10 == 1, "EUR").otherwise("LCY").alias("currency"),
            F.when(revolving, "revolving").when(k % 2 == 0, "annuity").otherwise("bullet")
            .alias("repayment_type"),
        )

    def _company_lines(self) -> DataFrame:
        """Amounts are made before the join, so that numbers move and not the texts and fractions they come from."""
        cents = _cents(F.col("l_extendedprice"))
        bad = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25)
        lines = self.source("lineitem").select(
            "l_orderkey",
            cents.alias("cents"),
            F.when(bad, cents).otherwise(0).alias("bad_cents"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("discount_pct"),
            F.round(F.col("l_tax") * 100).cast("bigint").alias("tax_pct"),
        )
        orders = self._orders().select("o_orderkey", F.col("o_custkey").alias("company_id"), F.year("od").alias("year"))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")

    def financial_statements(self) -> DataFrame:
        cents = F.col("cents")
        yearly = self._company_lines().groupBy("company_id", "year").agg(
            (F.sum(cents) / 100.0).alias("revenue"),
            (F.sum(cents * (F.col("discount_pct") + F.col("tax_pct"))) / 10000.0).alias("ebitda"),
            (F.sum(cents * (F.col("discount_pct") - F.col("tax_pct"))) / 10000.0).alias("net_income"),
        )
        by_company = Window.partitionBy("company_id").orderBy("year")
        s = F.col("company_id") % 10
        return (
            yearly.withColumn("revenue_prev_year", F.lag("revenue").over(by_company))
            .withColumn("total_assets", F.col("revenue") * 1.2)
            .withColumn("current_assets", F.col("total_assets") * (30 + s) / 100.0)
            .withColumn("total_liabilities", F.col("total_assets") * (40 + 4 * s) / 100.0)
            .withColumn("current_liabilities", F.col("total_liabilities") * 0.45)
            .withColumn("short_term_debt", F.col("current_liabilities") * (5 * s) / 100.0)
            .withColumn("long_term_debt", (F.col("total_liabilities") - F.col("current_liabilities")) * 0.6)
            .select(
                "company_id",
                F.make_date("year", F.lit(12), F.lit(31)).alias("report_date"),
                "revenue",
                "revenue_prev_year",
                "ebitda",
                "net_income",
                "total_assets",
                "current_assets",
                (F.col("current_assets") * 0.1).alias("cash"),
                F.when(s != 3, F.col("current_assets") * 0.2).alias("inventory"),
                (F.col("current_assets") * 0.25).alias("accounts_receivable"),
                "total_liabilities",
                "current_liabilities",
                "short_term_debt",
                "long_term_debt",
                (F.col("total_assets") - F.col("total_liabilities")).alias("equity"),
                ((F.col("short_term_debt") + F.col("long_term_debt")) * 0.09).alias("interest_expense"),
                (F.col("ebitda") * 0.7).alias("operating_cash_flow"),
                (F.col("revenue") * 0.04).alias("capex"),
            )
        )

    def rating_history(self) -> DataFrame:
        yearly = self._company_lines().groupBy("company_id", "year").agg(
            F.sum("cents").alias("all_cents"), F.sum("bad_cents").alias("bad_cents")
        )
        pd = F.round(F.least(F.lit(0.45), 0.001 + 0.15 * (F.col("bad_cents") / F.col("all_cents"))), 6)
        c, year = F.col("company_id"), F.col("year")
        return yearly.withColumn("pd_estimate", pd).select(
            "company_id",
            F.make_date("year", F.lit(1), F.lit(1)).alias("rating_date"),
            pd_grade(F.col("pd_estimate")).alias("rating_grade"),
            "pd_estimate",
            _flag((7 * c + year) % 25 == 0).alias("watchlist_flag"),
            _flag((11 * c + year) % 60 == 0).alias("restructuring_flag"),
        )

    def payments(self) -> DataFrame:
        price, quantity, returned = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_returnflag")
        shift = F.datediff(F.col("l_shipdate").cast("date"), F.lit(SHIFT_ORIGIN)) % 730
        # As with company lines, what moves to the orders is numbers.
        lines = self.source("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", shift.alias("shift"),
            (price * F.col("l_discount")).alias("outstanding_balance"),
            F.when((returned == "R") & (quantity >= 49), 95).when((returned == "R") & (quantity >= 46), 35)
            .when((returned == "A") & (quantity >= 40), 15).otherwise(0).alias("days_past_due"),
        )
        return lines.join(self._orders(), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
            F.col("l_orderkey").alias("facility_id"),
            F.date_add("od", F.col("shift")).alias("payment_date"),
            price.alias("scheduled_amount"),
            (price * (1 - F.col("l_discount"))).alias("paid_amount"),
            "days_past_due",
            "outstanding_balance",
        )

    def defaults(self) -> DataFrame:
        k = F.col("facility_id")
        return self.loan_facilities().filter(k % 20 == 7).select(
            "facility_id",
            F.date_add("origination_date", (90 + (37 * k) % 900).cast("int")).alias("default_date"),
            F.when(k % 4 == 0, "overdue").when(k % 4 == 1, "bankruptcy").when(k % 4 == 2, "distressed")
            .otherwise("legal").alias("default_type"),
            (90 + 30 * (k % 4)).cast("int").alias("dpd_at_default"),
            (F.col("outstanding_amount") + F.col("undrawn_amount") * (20 + k % 66) / 100.0)
            .alias("ead_at_default"),
            _flag(k % 100 == 7).alias("writeoff_flag"),
        )

    def recoveries(self) -> DataFrame:
        amount = F.col("l_extendedprice") * (1 + F.col("l_linenumber")) / 20.0
        returned = F.col("l_returnflag")
        return (
            self.source("lineitem")
            .join(self.defaults(), F.col("l_orderkey") == F.col("facility_id"))
            .select(
                F.concat_ws("-", F.lit("R"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
                .alias("recovery_id"),
                "facility_id",
                F.date_add("default_date", 10 * F.col("l_linenumber")).alias("recovery_date"),
                amount.alias("recovery_amount"),
                F.when(returned == "R", "collateral_sale").when(returned == "A", "cash").otherwise("legal")
                .alias("recovery_type"),
                (amount * 0.05).alias("collection_cost"),
            )
        )

    def collateral(self) -> DataFrame:
        kind = _lookup(F.col("p_type"), {k: v[0] for k, v in COLLATERAL_OF_TYPE.items()})
        haircut = _lookup(F.col("p_type"), {k: v[1] for k, v in COLLATERAL_OF_TYPE.items()})
        return (
            self.source("lineitem")
            .join(self.source("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.concat_ws("-", F.lit("C"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
                .alias("collateral_id"),
                F.col("l_orderkey").alias("facility_id"),
                kind.alias("collateral_type"),
                F.when(F.col("p_type") == "ECONOMY", 0.0).otherwise(F.col("l_extendedprice"))
                .alias("collateral_value"),
                haircut.alias("haircut"),
                F.col("l_shipdate").cast("date").alias("valuation_date"),
            )
        )

    def macro_scenarios(self) -> DataFrame:
        scenarios = self.spark.createDataFrame(
            MACRO_SCENARIOS, "scenario string, scenario_weight double, step int"
        )
        i = F.col("i")
        m, a = i % 12, F.col("step")
        return (
            scenarios.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(MACRO_MONTHS - 1))))
            .select(
                F.add_months(F.lit(FIRST_MACRO_MONTH), i).alias("month"),
                "scenario",
                "scenario_weight",
                ((30 + m - 20 * a) / 1000.0).alias("gdp_growth"),
                ((40 + m + 15 * a) / 1000.0).alias("inflation"),
                ((60 + 2 * m + 20 * a) / 1000.0).alias("base_rate"),
                ((55 + m + 10 * a) / 1000.0).alias("unemployment"),
                ((1000 + 5 * m + 100 * a) / 10.0).alias("fx_rate"),
                ((100 + 2 * m + 25 * a) / 100.0).alias("industry_stress_index"),
            )
        )

    def raw(self) -> "RawTables":
        return RawTables(self)


class RawTables(Mapping):
    """The raw tables by name, each planned when it is first asked for."""

    def __init__(self, portfolio: Portfolio):
        self._portfolio = portfolio
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(name)
        if name not in self._tables:
            self._tables[name] = getattr(self._portfolio, name)()
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)
