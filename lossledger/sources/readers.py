"""Readers: CSV with explicit schemas, Parquet, JDBC with a partitioned scan, report folders."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.numeric import number
from lossledger.sources.schemas import RAW_TABLES, raw_schema


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: number(F.col(name)) for name in floats})


def read_csv_table(spark: SparkSession, path: str | None, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header. Without a schema all columns are text; see `coerce_numeric_like` for their types."""
    if not path:
        raise ValueError("a CSV path is required")
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.csv(path))


def read_raw_csv(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The nine raw tables from `<folder>/<table>.csv`."""
    return {t: read_csv_table(spark, f"{folder}/{t}.csv", raw_schema(t)) for t in RAW_TABLES}


def read_raw_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: nan_to_null(spark.read.parquet(f"{folder}/{t}")) for t in RAW_TABLES}


def jdbc_options(
    table: str,
    host: str,
    port: str | int,
    database: str,
    user: str,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a PostgreSQL scan, split over `partition_column` so that no task reads the table alone."""
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "dbtable": table,
        "user": user,
        "password": password if password is not None else os.environ.get("PGPASSWORD", ""),
        "fetchsize": str(fetch_size),
    }
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partitioned scan needs lower_bound, upper_bound and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc_table(spark: SparkSession, table: str, **connection) -> DataFrame:
    return nan_to_null(spark.read.format("jdbc").options(**jdbc_options(table, **connection)).load())


def read_reports(
    spark: SparkSession, folder: str, required: Iterable[str], optional: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Report tables by name; a missing required one is an error, a missing optional one is left out."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    configuration = spark.sparkContext._jsc.hadoopConfiguration()

    def exists(path: str) -> bool:
        location = hadoop.Path(path)
        return location.getFileSystem(configuration).exists(location)

    reports = {}
    for name, is_required in [(n, True) for n in required] + [(n, False) for n in optional]:
        path = f"{folder}/{name}"
        if exists(path):
            reports[name] = spark.read.parquet(path)
        elif is_required:
            raise FileNotFoundError(f"required report not found: {path}")
    return reports
