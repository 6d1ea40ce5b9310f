"""Frames that went through a source or sink and came back: raw tables as CSV, published marts, reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.operators import features
from lossledger.session import new_folder
from lossledger.sources.publication import publish, read_published
from lossledger.sources.readers import read_raw_csv, read_reports
from lossledger.sources.schemas import RAW_TABLES, raw_columns
from lossledger.sources.writers import save_report


def column_totals(df: DataFrame, table: str) -> DataFrame:
    """table, column, filled, total: values of each column, and their sum where they are numbers. One pass."""
    def total(f: T.StructField) -> Column:
        return F.sum(F.col(f.name).cast("double")) if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")

    rows = F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(f.name).alias("column"), F.count(f.name).alias("filled"), total(f).alias("total"))
        for f in df.schema.fields
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def csv_round_trip(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The nine raw tables written as compressed CSV and read with their schemas; a file is what one task wrote."""
    spark = raw["companies"].sparkSession
    folder = new_folder(spark, "csv")
    for name in RAW_TABLES:
        raw[name].select(*raw_columns(name)).write.option("header", True).option("compression", "snappy").csv(f"{folder}/{name}.csv")
    again = read_raw_csv(spark, folder)
    return reduce(DataFrame.unionByName, [column_totals(again[name], name) for name in RAW_TABLES])


def published_mart(mart: DataFrame, history: DataFrame) -> DataFrame:
    """A mart published twice, in buckets of the facility, read back and joined by facility with `history`: per product
    the facilities, their exposure, and the rows of `history`."""
    root = new_folder(mart.sparkSession, "mart")
    columns = ["facility_id", "product_type", "outstanding_amount"]
    publish(mart.select(*columns).filter("facility_id % 2 = 0"), root, ["facility_id"])
    publish(mart.select(*columns), root, ["facility_id"])
    counted = history.groupBy("facility_id").agg(F.count(F.lit(1)).alias("rows"))
    joined = read_published(mart.sparkSession, root).join(counted, "facility_id", "left")
    return joined.groupBy("product_type").agg(
        F.count(F.lit(1)).alias("facilities"), F.sum("outstanding_amount").alias("outstanding"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("payments"),
    )


def published_portfolio(staged: DataFrame) -> DataFrame:
    """A facility-level result published by stage and read back without one of its folders."""
    root = new_folder(staged.sparkSession, "portfolio")
    publish(staged.select("facility_id", "ifrs9_stage", "current_dpd"), root, partition_by=["ifrs9_stage"])
    return read_published(staged.sparkSession, root).filter("ifrs9_stage > 1").select(
        "facility_id", F.col("ifrs9_stage").cast("int").alias("ifrs9_stage"), "current_dpd"
    )


def report_read_back(report: DataFrame) -> DataFrame:
    """A report as one file and as CSV; what is optional and missing is left out."""
    folder = new_folder(report.sparkSession, "reports")
    save_report(report, f"{folder}/needed")
    found = read_reports(report.sparkSession, folder, ["needed"], ["missing"])
    return found["needed"].withColumn("reports", F.lit(len(found)))


def score_choice(scores: DataFrame) -> DataFrame:
    """asked, chosen, rows, mean_score: the score that each best model leads to."""
    rows = []
    for asked in ("current", "unknown", None):
        chosen = features.choose_pd_column(scores.columns, asked)
        rows.append(F.struct(
            F.lit(asked).cast("string").alias("asked"), F.lit(chosen).alias("chosen"), F.count(chosen).alias("rows"), F.avg(chosen).alias("mean_score")
        ))
    return scores.agg(F.array(*rows).alias("r")).select(F.inline("r"))
