"""Chronological train/valid/oot split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import number
from lossledger.operators.ordering import global_rank

TRAIN_SIZE = 0.70
VALID_SIZE = 0.15
SPLITS = ["train", "valid", "oot"]


def clean_dates_and_target(df: DataFrame, date_col: str, target_col: str) -> DataFrame:
    """Parse the date and target, dropping rows where either is missing."""
    parsed = df.withColumns(
        {date_col: F.col(date_col).try_cast("date"), target_col: number(F.col(target_col))}
    )
    return parsed.dropna(subset=[date_col, target_col])


def earliest_rows(df: DataFrame, date_col: str, max_rows: int | None, tie: str = "facility_id") -> DataFrame:
    """The earliest `max_rows` rows, all rows when None."""
    if max_rows is None:
        return df
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    return df.orderBy(date_col, tie).limit(max_rows)


def split_points(
    df: DataFrame, date_col: str, tie: str = "facility_id",
    train_size: float = TRAIN_SIZE, valid_size: float = VALID_SIZE,
) -> tuple[Column, Column]:
    """Conditions "is in train" and "is in train or valid" over rows ordered by (date, tie).

    Rows are counted per date (at most one count per calendar day on the driver). Only the dates
    that straddle a boundary are ranked by the tie key, so no row outside them is moved.
    """
    counts = (
        df.filter(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count(F.lit(1)).alias("n")).orderBy(date_col)
    ).collect()
    rows = sum(r["n"] for r in counts)
    targets = [int(rows * train_size), int(rows * (train_size + valid_size))]

    placed: list[tuple[object, int] | None] = []
    for target in targets:
        seen = 0
        place = None
        for r in counts:
            if target < seen + r["n"]:
                place = (r[date_col], target - seen)
                break
            seen += r["n"]
        placed.append(place)

    # One ranking serves both dates: ranks of the later date follow the rows of the earlier one.
    sizes = {r[date_col]: r["n"] for r in counts}
    straddled = sorted({p[0] for p in placed if p and p[1]})
    wanted = {
        sum(sizes[d] for d in straddled if d < p[0]) + p[1] + 1: p for p in placed if p and p[1]
    }
    first_key = {}
    if wanted:
        rows_of_dates = df.filter(F.col(date_col).isin(straddled)).select(date_col, tie)
        ranked, _ = global_rank(rows_of_dates, [date_col, tie])
        for r in ranked.filter(F.col("rank").isin(list(wanted))).collect():
            first_key[wanted[r["rank"]]] = r[tie]

    def before(place) -> Column:
        if place is None:
            return F.lit(True)
        date, offset = place
        earlier = F.col(date_col) < F.lit(date)
        if not offset:
            return earlier
        return earlier | ((F.col(date_col) == F.lit(date)) & (F.col(tie) < F.lit(first_key[place])))

    return before(placed[0]), before(placed[1])


def time_split(
    df: DataFrame, date_col: str = "observation_date", target_col: str = "target_default_12m",
    tie: str = "facility_id", train_size: float = TRAIN_SIZE, valid_size: float = VALID_SIZE,
) -> DataFrame:
    """`df` with a `split` column; rows without date or target are dropped.

    Reads `df` up to three times, so pass a stored sample. `tie` must be unique: it fixes the
    order of rows of one date.
    """
    # Days, so that the driver gets a count per calendar day and not per instant.
    data = df.withColumn(date_col, F.col(date_col).cast("date")).dropna(subset=[date_col, target_col])
    in_train, in_train_or_valid = split_points(data, date_col, tie, train_size, valid_size)
    label = F.when(in_train, "train").when(in_train_or_valid, "valid").otherwise("oot")
    return data.withColumn("split", label)


def split_summary(split: DataFrame, date_col: str, target_col: str, rate_name: str = "default_rate") -> DataFrame:
    order = F.array_position(F.lit(SPLITS), F.col("split"))
    return (
        split.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(date_col).alias("min_date"),
            F.max(date_col).alias("max_date"),
            F.avg(target_col).alias(rate_name),
        )
        .orderBy(order)
    )


def split_part(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("split") == name).drop("split")
