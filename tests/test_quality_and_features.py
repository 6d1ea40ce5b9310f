"""Data-quality suite, outliers, winsorising, leakage rules, feature selection."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lossledger.operators import features, leakage, outliers, quality
from lossledger.operators.marts import CCF_SAMPLE_COLUMNS, LGD_SAMPLE_COLUMNS, PD_SAMPLE_COLUMNS, RATIO_MART_COLUMNS
from lossledger.sources.schemas import RAW_TABLES, raw_schema

D = dt.date


def raw_tables(spark, **given):
    return {f"raw.{t}": spark.createDataFrame(given.get(t, []), raw_schema(t)) for t in RAW_TABLES}


def as_dict(report):
    return {r["check_name"]: (r["metric_value"], r["status"]) for r in report.collect()}


FACILITY = ("F1", "C1", D(2020, 5, 20), D(2023, 5, 20), "term_loan", 100.0, 80.0, 20.0, 0.1, 36, 0, "s", "USD", "bullet")


def test_faults_are_found(spark):
    tables = raw_tables(
        spark,
        companies=[("C1", D(2000, 1, 1), *["x"] * 6, 1.0, 1, 0, 0, 0)] * 2 + [(None, D(2000, 1, 1), *["x"] * 6, 1.0, 1, 0, 0, 0)],
        loan_facilities=[FACILITY, ("F2", "C1", D(2020, 1, 1), D(2019, 1, 1), "overdraft", 10.0, -1.0, 2.0, 0.1, 12, 1, "s", "USD", "x")],
        payments=[
            ("P1", "F1", D(2020, 4, 1), 1.0, 1.0, 0, 1.0), ("P2", "F1", D(2020, 5, 1), 1.0, -1.0, 0, 1.0),
            ("P3", "F1", D(2020, 6, 1), 1.0, 1.0, 0, 1.0), ("P3", "F9", D(2020, 6, 1), 1.0, 1.0, 0, 1.0),
        ],
        defaults=[("F1", D(2020, 1, 1), "t", 90, 50.0, 0)],
        recoveries=[("R1", "F1", D(2019, 12, 1), 5.0, "t", 1.0)],
        financial_statements=[("C1", D(2020, 12, 31)) + (1.0,) * 17] * 2 + [("C1", None) + (1.0,) * 17],
    )
    report = quality.data_quality(tables, checked_at=dt.datetime(2026, 1, 1))
    got = as_dict(report)
    assert got["duplicate company_id"] == (2, "FAIL")  # one repeat, one NULL
    assert got["company_id nulls"] == (1, "FAIL")
    assert got["duplicate company report date"] == (1, "FAIL")  # a NULL part still counts as a value
    assert got["duplicate payment_id"] == (1, "FAIL")
    assert got["negative facility amounts"] == (1, "FAIL") and got["negative payment amounts"] == (1, "FAIL")
    assert got["maturity before origination"] == (1, "FAIL")
    assert got["payment more than 31 days before origination"] == (1, "FAIL")
    assert got["payment within 31 days before origination"] == (1, "WARN")
    assert got["default before origination"] == (1, "FAIL") and got["recovery before default"] == (1, "FAIL")
    assert got["negative revenue"] == (0, "PASS")
    assert report.columns == [*quality.CHECK_COLUMNS, "checked_at"]
    statuses = [r["status"] for r in report.collect()]
    assert statuses == sorted(statuses, key=["FAIL", "WARN", "PASS", "INFO"].index)


def test_empty_tables(spark):
    got = as_dict(quality.data_quality(raw_tables(spark)))
    assert got["raw companies rows"] == (0, "FAIL") and got["raw defaults rows"] == (0, "WARN")
    assert got["company_id nulls"] == (None, "FAIL")  # a sum over nothing is not zero
    assert got["duplicate company_id"] == (0, "PASS") and got["default before origination"] == (0, "PASS")


def test_status_counts(spark):
    df = spark.createDataFrame([("FAIL",), ("PASS",), ("PASS",), ("INFO",)], "status string")
    assert quality.status_counts(df).first().asDict() == {"fail_count": 1, "warn_count": 0, "pass_count": 2}


def test_lgd_outliers(spark):
    df = spark.createDataFrame([(1.2, 100.0, 150.0, -10.0), (0.5, 100.0, 50.0, 60.0)], "realized_lgd double, ead_at_default double, total_recovery_amount double, total_collection_cost double")
    got = as_dict(outliers.lgd_outliers(df))
    assert got == {
        "rows": (2, "INFO"), "lgd outside 0 1 bounds": (1, "FAIL"), "non positive ead": (0, "PASS"), "very high ead": (0, "PASS"),
        "negative recoveries": (0, "PASS"), "recovery greater than ead": (1, "WARN"), "negative collection cost": (1, "FAIL"),
        "extreme collection cost": (1, "WARN"),
    }
    assert as_dict(outliers.lgd_outliers(df.select("realized_lgd"))) == {"rows": (2, "INFO"), "lgd outside 0 1 bounds": (1, "FAIL")}


def test_ccf_outliers(spark):
    df = spark.createDataFrame([("2.0", 100.0, 0.0, -1.0, 50.0), ("0.5", -5.0, 10.0, 20.0, 50.0)], "ccf string, ead double, undrawn_amount double, outstanding_amount double, limit_amount double")
    got = as_dict(outliers.ccf_outliers(df))
    assert got["ccf outside 0 1.5 bounds"] == (1, "FAIL") and got["non positive ead"] == (1, "FAIL")
    assert got["zero or negative undrawn amount"] == (1, "WARN") and got["negative outstanding amount"] == (1, "FAIL")
    assert got["ead materially greater than limit"] == (1, "WARN")


def test_winsorize(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (1000.0,), (None,)], "ratio double")
    got = sorted(r[0] for r in outliers.winsorize(df, ["ratio", "absent"], 0.25, 0.75).dropna().collect())
    assert got == pytest.approx([1.75, 2.0, 3.0, 252.25])
    assert outliers.winsorize(df, ["ratio"]).filter("ratio is null").count() == 1
    assert outliers.winsorize(df, ["absent"]) is df


def test_leakage_categories(spark):
    names = [
        "facility_id", "observation_date", "target_default_12m", "default_date", "total_recovery_amount", "debt_to_ebitda",
        "realized_lgd", "engine_score", "max_dpd_12m", "Rating_Date", "ead_at_default", "some_id", "collection_agent", "revenue",
    ]
    df = spark.createDataFrame([tuple("x" for _ in names)], names)
    report = leakage.leakage_report(df)
    got = {r["column"]: r["category"] for r in report.collect()}
    assert got == {
        "facility_id": "id", "some_id": "id", "observation_date": "date", "Rating_Date": "date", "target_default_12m": "target",
        "default_date": "default_outcome", "ead_at_default": "default_outcome", "total_recovery_amount": "recovery_outcome",
        "collection_agent": "recovery_outcome", "realized_lgd": "lgd_ead_outcome", "engine_score": "decision_engine_output",
        "max_dpd_12m": "future_performance",
    }
    order = list(leakage.REASONS)
    categories = [r["category"] for r in report.collect()]
    assert categories == sorted(categories, key=order.index)
    assert leakage.leakage_coverage(df).filter("filled_rows = 1").count() == len(got)


def test_feature_lists():
    pd_list, suspicious = features.pd_features(PD_SAMPLE_COLUMNS)
    assert len(pd_list) == 59 and not suspicious  # as in the published feature list
    assert len(features.lgd_features(LGD_SAMPLE_COLUMNS)) == 69
    assert len(features.ccf_features(CCF_SAMPLE_COLUMNS)) == 67
    assert "ead_at_default" in features.lgd_features(LGD_SAMPLE_COLUMNS)
    assert "ead_at_default" not in features.ccf_features(CCF_SAMPLE_COLUMNS)
    kept, suspicious = features.pd_features(RATIO_MART_COLUMNS)
    assert suspicious == [] or all("dpd" in c or "recovery" in c for c in suspicious)
    assert features.pd_features(["facility_id", "revenue", "future_dpd", "my_target"]) == (["revenue"], ["future_dpd", "my_target"])


def test_coercion(spark):
    df = spark.createDataFrame(
        [("1", "1", "x", "id1", None)] * 4 + [("2.5", "oops", "3", "7", None)], "mostly string, four_of_five string, few string, key string, empty string"
    )
    got = dict(features.coerce_numeric_like(df, protected=["key"]).dtypes)
    assert got == {"mostly": "double", "four_of_five": "double", "few": "string", "key": "string", "empty": "string"}
    assert dict(features.coerce_numeric_like(df, ["key"], 0.9).dtypes)["four_of_five"] == "string"
    numbers = df.select(F.lit(1).alias("n"))
    assert features.coerce_numeric_like(numbers) is numbers


def test_choose_pd_column():
    columns = ["facility_id", "pd_dummy_prior", "pd_lr", "pd_rf"]
    assert features.choose_pd_column(columns, "rf") == "pd_rf"
    assert features.choose_pd_column(columns, "gone") == "pd_lr"
    assert features.choose_pd_column(columns) == "pd_lr"
    with pytest.raises(ValueError):
        features.choose_pd_column(["pd_dummy_prior"])


def test_feature_types(spark):
    df = spark.createDataFrame([(1, 2.0, "a", D(2020, 1, 1))], "i int, d double, s string, t date")
    assert features.feature_types(df, df.columns) == (["i", "d"], ["s", "t"])
