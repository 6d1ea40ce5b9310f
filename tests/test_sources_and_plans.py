"""Readers, sinks, entry points, physical plans, hot keys."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from lossledger import session
from lossledger.operators import marts, rollups, staging
from lossledger.plans import catalog, source_checks
from lossledger.plans.catalog import QUERIES, Frames
from lossledger.sources import publication, readers, writers
from lossledger.sources.portfolio import REPORTING_DATE, Portfolio
from lossledger.sources.schemas import RAW_TABLES, raw_columns, raw_schema

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return Portfolio(spark, SMALL).raw()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_portfolio_has_the_raw_columns(raw):
    assert list(raw) == RAW_TABLES and len(raw) == 9
    for table in RAW_TABLES:
        assert set(raw[table].columns) == set(raw_columns(table)), table
    with pytest.raises(KeyError):
        raw["other"]


def test_raw_csv_round_trip(spark, raw, tmp_path):
    for table in RAW_TABLES:
        raw[table].select(*raw_columns(table)).write.option("header", True).csv(f"{tmp_path}/{table}.csv")
    loaded = readers.read_raw_csv(spark, str(tmp_path))
    for table in RAW_TABLES:
        assert loaded[table].dtypes == [(f.name, f.dataType.simpleString()) for f in raw_schema(table).fields]
        assert loaded[table].count() == raw[table].count()
    mart = marts.ratio_mart(loaded)
    assert mart.columns == marts.RATIO_MART_COLUMNS and mart.count() == raw["loan_facilities"].count()
    total = mart.agg(F.sum("target_default_12m"), F.sum("payment_months_observed")).first()
    assert total == marts.ratio_mart(raw).agg(F.sum("target_default_12m"), F.sum("payment_months_observed")).first()


def test_csv_path_is_required(spark):
    with pytest.raises(ValueError):
        readers.read_csv_table(spark, None)


def test_nan_becomes_null(spark):
    df = readers.nan_to_null(spark.createDataFrame([(float("nan"), 1)], "x double, n int"))
    assert df.first()["x"] is None


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("PGPASSWORD", "secret")
    plain = readers.jdbc_options("raw.payments", "h", 5432, "d", "u")
    assert plain["url"] == "jdbc:postgresql://h:5432/d" and plain["password"] == "secret" and "numPartitions" not in plain
    split = readers.jdbc_options("t", "h", 1, "d", "u", "p", "facility_id", 0, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("facility_id", "0", "100", "8")
    with pytest.raises(ValueError):
        readers.jdbc_options("t", "h", 1, "d", "u", "p", "facility_id")


def test_sinks_and_report_reading(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    writers.save_facility_level(df, f"{tmp_path}/facility", ["k"])
    assert spark.read.parquet(f"{tmp_path}/facility").count() == 10
    writers.save_report(df, f"{tmp_path}/one")
    writers.save_report(df, f"{tmp_path}/csv", as_csv=True)
    assert len([p for p in (tmp_path / "csv").iterdir() if p.suffix == ".csv"]) == 1
    found = readers.read_reports(spark, str(tmp_path), ["one"], ["absent"])
    assert list(found) == ["one"] and found["one"].count() == 10
    with pytest.raises(FileNotFoundError):
        readers.read_reports(spark, str(tmp_path), ["absent"])


def test_bucketed_mart_joins_without_shuffle(spark, tmp_path):
    left = spark.range(1000).withColumnRenamed("id", "facility_id")
    a, b = [
        publication.publish(left.withColumn(name, F.lit(1)), f"{tmp_path}/{name}", ["facility_id"], buckets=4) for name in ("a", "b")
    ]
    joined = a.hint("merge").join(b, "facility_id")
    assert "Exchange" not in plan(joined) and joined.count() == 1000


def test_stored_rows_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "configured_dir", lambda _: f"{tmp_path}/shared/")
    stored = session.materialize(spark.range(5))
    assert stored.count() == 5 and stored.inputFiles()[0].startswith(f"file://{tmp_path}/shared")


def test_no_folder_without_a_shared_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "configured_dir", lambda _: None)
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    stored = session.materialize(spark.range(5))
    assert stored.count() == 5 and stored.is_cached and not list(tmp_path.iterdir())
    stored.unpersist()


FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", ["ratio_mart", "staging_sample", "ecl_facility", "ecl_cube", "stress_summary", "lgd_sample"])
def test_plans_scale(spark, name):
    text = plan(QUERIES[name].run(spark, SMALL))
    for operator in FORBIDDEN:
        assert operator not in text, operator
    if name != "stress_summary":  # its change-against-base window sees one row per scenario
        assert "SinglePartition" not in text


def test_scans_are_pruned(raw):
    text = rollups.payment_profile(raw["payments"])._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in text and "l_linestatus" not in text
    latest = plan(marts.current_rating(raw["rating_history"], REPORTING_DATE))
    assert "l_discount" not in latest


def test_hot_borrower_and_hot_facility(spark, raw):
    """One borrower with most facilities and one facility with most payments: counts stay whole."""
    facilities = raw["loan_facilities"].withColumn("company_id", F.when(F.col("facility_id") % 3 > 0, 7).otherwise(F.col("company_id")))
    payments = raw["payments"].withColumn("facility_id", F.when(F.length("payment_id") % 2 == 0, 7).otherwise(F.col("facility_id")))
    tables = {**raw, "loan_facilities": facilities, "payments": payments}
    mart = marts.ratio_mart(tables)
    assert mart.count() == facilities.count()
    hot = mart.filter("facility_id = 7").first()
    expected = payments.filter("facility_id = 7").agg(F.count(F.lit(1)), F.max("days_past_due"), F.sum("scheduled_amount")).first()
    assert (hot["payment_months_observed"], hot["max_dpd_observed"]) == (expected[0], expected[1])
    assert hot["total_scheduled_amount"] == pytest.approx(expected[2])
    profile = rollups.payment_profile(payments).filter("facility_id = 7")
    assert profile.count() <= 4
    staged = staging.assign_stage(marts.staging_sample(mart, raw["rating_history"], payments, REPORTING_DATE))
    assert staged.count() == facilities.count()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_numbers_move_from_lines_to_orders(raw, no_broadcast):
    """Flags, quantities and timestamps become numbers below the shuffle of the line items."""
    fresh = Portfolio(raw["payments"].sparkSession, SMALL).raw()
    for table in ("payments", "rating_history", "financial_statements"):
        lines = plan(fresh[table]).split("\n")
        (moved,) = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line]
        columns = re.sub(r"(CASE|datediff\(|cast\(|\().*? AS ", "", moved)
        assert "Project" in moved and not re.search(r"[\[ ](l_returnflag|l_quantity|l_shipdate)#", columns), moved


def test_staging_moves_no_mart_rows_by_company(spark, no_broadcast):
    """Current ratings come to the facilities, so the outermost join is by facility."""
    text = plan(Frames(spark, SMALL).staging_sample)
    assert re.search(r"SortMergeJoin \[(\w+)#", text).group(1) == "facility_id"


def test_a_facility_id_that_comes_again_keeps_the_rating_of_its_company(spark):
    rated = spark.createDataFrame([(1, "A"), (2, "B")], "company_id bigint, current_rating_grade string")
    twice = spark.createDataFrame([(7, 1), (7, 2), (7, 2), (8, 3), (9, None)], "facility_id bigint, company_id bigint")
    lists = {r["facility_id"]: sorted(tuple(x) for x in r["_rated"]) for r in marts.rated_facilities(twice, rated).collect()}
    assert lists == {7: [(1, "A"), (2, "B")]}


def test_reports_store_the_mart_once(spark):
    """Over a stored mart the stability sample and the checked staging sample are not stored or built again."""
    frames = Frames(spark, SMALL)
    frames.mart = frames.stored_mart
    tables = frames.quality_tables(frames.mart, frames.mart)
    assert tables["mart.ifrs9_staging_sample"] is frames.mart
    with pytest.MonkeyPatch.context() as patch:
        stored = []
        patch.setattr(catalog, "materialize", lambda df: stored.append(df) or df)
        frames.psi_details
    assert not stored


def test_payment_window_and_missing_payments(spark):
    facilities = spark.createDataFrame([("f", dt.date(2020, 2, 29)), ("none", dt.date(2020, 1, 1))], "facility_id string, observation_date date")
    rows = [
        ("f", dt.date(2021, 2, 28), 30, 10.0, 5.0), ("f", dt.date(2021, 3, 1), 90, 10.0, 0.0), ("f", dt.date(2022, 1, 1), 30, 10.0, 10.0),
        ("f", dt.date(2019, 1, 1), None, 1.0, 1.0),
    ]
    payments = spark.createDataFrame(rows, "facility_id string, payment_date date, days_past_due int, scheduled_amount double, paid_amount double")
    got = {r["facility_id"]: r for r in rollups.payment_rollup(facilities, payments).collect()}
    assert (got["f"]["max_dpd_12m"], got["f"]["max_dpd_observed"], got["f"]["payment_months_observed"]) == (30, 90, 4)
    assert got["f"]["total_scheduled_amount"] == 31.0
    assert (got["none"]["payment_months_observed"], got["none"]["max_dpd_observed"]) == (1, None)


def test_stage_proxy_agrees_with_staging(spark):
    frames = Frames(spark, SMALL)
    from lossledger.operators.quality import table_checks

    proxy = {
        r["check_name"]: r["metric_value"]
        for r in table_checks("mart.ifrs9_staging_sample", frames.staging_sample).collect()
        if r["check_group"] == "ifrs9_stage_distribution"
    }
    stages = {f"stage {r['ifrs9_stage']} facilities": r["facilities"] for r in staging.stage_summary(frames.staged).collect()}
    assert proxy == stages


def test_entry(spark):
    got = spark_entry.entry(spark).collect()
    assert [r["ifrs9_stage"] for r in got] == [1, 2, 3] and all(r["total_ecl"] > 0 for r in got)


def test_registry():
    queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    without_sql = {"pd_model_metrics", "lgd_model_metrics", "ccf_model_metrics", "pd_calibrated_metrics", "pd_calibration_before_after"}
    # The operators for training text are registered on top and tested in their own folder.
    assert set(QUERIES) <= set(queries) and set(QUERIES) - set(oracles) == without_sql


def test_generated_methods_stay_small(spark):
    """Methods beyond 8,000 bytes are never compiled; a limit that the session names stays."""
    before = spark.conf.get(session.METHOD_SETTING)
    try:
        spark.conf.set(session.METHOD_SETTING, session.SPARKS_METHOD_BYTES)
        QUERIES["stress_facility"].run(spark, SMALL)
        assert int(spark.conf.get(session.METHOD_SETTING)) <= 8000
        spark.conf.set(session.METHOD_SETTING, "20000")
        QUERIES["stress_facility"].run(spark, SMALL)
        assert spark.conf.get(session.METHOD_SETTING) == "20000"
    finally:
        spark.conf.set(session.METHOD_SETTING, before)


def test_csv_round_trip_is_compressed(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(source_checks, "new_folder", lambda *_: str(tmp_path))
    found = {(r["table"], r["column"]): r["filled"] for r in source_checks.csv_round_trip(raw).collect()}
    assert found["payments", "payment_id"] == raw["payments"].count()
    written = [p.name for p in tmp_path.rglob("part-*")]
    assert written and all(name.endswith(".csv.snappy") for name in written)
