"""Shared helpers: tables in the shared folder, literal range edges, rows numbered in one global order."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.session import map_arrow, share_package  # noqa: F401

#: Of stored tables, which are written once and take the disk until the application ends.
CODEC = "zstd"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_local_dirs: dict[str, str] = {}


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="lossledger-llm-")
    return _local_dirs[context.applicationId]


def stored(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends here, a lost executor costs
    no recomputation, and numbers that depend on partitioning stay as they were. The folder goes when the
    application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lossledger-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, key: str) -> DataFrame:
    """As `stored`, in buckets of `key`: joins and groups by it leave these rows in place.

    A task writes a file for each bucket that its rows fall into, so `key` should have few values in a task. There are
    as many buckets as shuffle partitions; with fewer, Spark would move both sides of a join.
    """
    spark = df.sparkSession
    name = f"lossledger_llm_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/lossledger-llm/{spark.sparkContext.applicationId}/{name}"
    df.write.format("parquet").option("compression", CODEC).bucketBy(shuffle_partitions(spark), key).option("path", path).saveAsTable(name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.table(name)


def with_keys(docs: DataFrame) -> DataFrame:
    """Every row of `docs` as the struct `row`, so that its columns may have any name, with what names it: id and
    no_id (doc_id of any type, null or not) and digest (of its text)."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.col("doc_id").isNull().alias("no_id"), digest.alias("digest"),
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_edges(df: DataFrame, column: str, parts: int) -> list:
    """At most `parts` - 1 values of `column`, ascending, that cut its rows into ranges of about equal size.

    One aggregate; the driver gets `parts` numbers. They are literals from then on, so the range of a row is
    a function of the row alone.
    """
    if parts < 2:
        return []
    fractions = [i / parts for i in range(1, parts)]
    accuracy = max(10_000, 20 * parts)
    found = df.agg(F.percentile_approx(column, fractions, accuracy).alias("edges")).first()["edges"]
    return sorted(set(found or []))


def range_of(value: Column, edges: list) -> Column:
    """Number of edges below `value`: 0 for values up to the first edge. Nulls are in range 0."""
    if not edges:
        return F.lit(0)
    cuts = F.array(*[F.lit(e) for e in edges])
    below = F.aggregate(cuts, F.lit(0), lambda n, e: n + F.when(e < value, 1).otherwise(0))
    return F.coalesce(below, F.lit(0))


def sorted_names(df: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Integer names for the distinct `keys`, by sorting: range partitions, sorted inside, numbered.

    The table is stored before use, because the numbers depend on the ranges.
    """
    distinct = df.select(*keys).distinct()
    ordered = distinct.repartitionByRange(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    return stored(ordered.withColumn(name, F.monotonically_increasing_id()))
