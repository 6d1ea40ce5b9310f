"""Categories by a table of levels: positions are joined, so no level ever comes to the driver.

A string indexer collects the levels of a column and ships them with every task. Here they are counted, ordered and
numbered as rows, for all columns at once; a row of data meets its level by a join. One-hot vectors are sparse and are
made from positions and one size per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.operators.ordering import ordered_ranges, running_totals


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, level, position (from 0, in the order of the levels), levels (of the feature).

    Levels are numbered inside ranges and shifted by the ranges before, so a column of many levels is spread over tasks.
    Missing values are no level.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns]))
    distinct = df.select(pairs).filter("level is not null").distinct().withColumn("one", F.lit(1))
    keys = ["feature"], ["level"]
    numbered = running_totals(ordered_ranges(distinct, *keys), *keys, ["one"])
    return numbered.select(
        "feature", "level", (F.col("cum_one") - 1).cast("int").alias("position"), F.col("all_one").cast("int").alias("levels")
    )


def with_positions(df: DataFrame, table: DataFrame, columns: Sequence[str], prefix: str = "idx_") -> DataFrame:
    """`df` with the position of each column's value; null where the table does not have it."""
    for c in columns:
        own = table.filter(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("position").alias(f"{prefix}{c}"))
        df = df.join(own, F.col(c).cast("string") == F.col("_level"), "left").drop("_level")
    return df


def sizes(table: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Levels per column: a number for each column, which is all that the driver gets."""
    found = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def one_hot(df: DataFrame, table: DataFrame, columns: Sequence[str], prefix: str = "hot_") -> DataFrame:
    """`df` with a sparse one-hot vector per column; unknown and missing values have no position, and so does a column
    without levels.

    The sizes stand in the columns' metadata, so the encoder needs no pass over the rows.
    """
    counts = {c: n for c, n in sizes(table, columns).items() if n}
    if not counts:
        return df
    placed = with_positions(df, table, list(counts), "_idx_")

    def nominal(c: str, n: int) -> Column:
        attribute = {"ml_attr": {"type": "nominal", "name": f"_idx_{c}", "num_vals": n}}
        return F.coalesce(F.col(f"_idx_{c}"), F.lit(n)).cast("double").alias(f"_idx_{c}", metadata=attribute)

    kept = [c for c in placed.columns if c not in {f"_idx_{c}" for c in counts}]
    typed = placed.select(*kept, *[nominal(c, n) for c, n in counts.items()])
    encoder = OneHotEncoder(
        inputCols=[f"_idx_{c}" for c in counts], outputCols=[f"{prefix}{c}" for c in counts], handleInvalid="keep", dropLast=True
    )
    return encoder.fit(typed).transform(typed).drop(*[f"_idx_{c}" for c in counts])
