"""Rising steps over a margin: pool adjacent violators inside ranges of margins, then across their borders.

Rows of one margin become one block first. Blocks are dealt to ranges; inside a range neighbours that fall are pooled.
Pooled blocks are dealt again by ranges of other borders, until no border has a fall. The result is the same as pooling
from left to right, because pooling in any order ends at the same blocks. The driver gets a first and a last block of
each range, never a block per margin, and ranges hold `RANGE_BLOCKS` blocks or so, however many margins there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.operators.ordering import ordered_ranges, running_totals
from lossledger.session import map_arrow, materialize

RANGE_BLOCKS = 200_000
#: Of a block: lowest and highest margin, weight, weighted sum of labels.
BLOCK = "low double, high double, weight double, total double"


def blocks_of(rows: DataFrame, margin: str = "margin", label: str = "label") -> DataFrame:
    """A block per distinct margin. Rows without margin or label do not count."""
    known = rows.filter(F.col(margin).isNotNull() & F.col(label).isNotNull())
    grouped = known.groupBy(F.col(margin).cast("double").alias("low")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum(F.col(label).cast("double")).alias("total")
    )
    return grouped.select("low", F.col("low").alias("high"), "weight", "total")


def pooled(low: np.ndarray, high: np.ndarray, weight: np.ndarray, total: np.ndarray) -> list[np.ndarray]:
    """Blocks in ascending order, neighbours pooled until their means rise. Equal neighbours stay apart or not: their
    value is the same; here they are pooled, so that a constant stretch is one block."""
    kept: list[list[float]] = []
    for block in zip(low.tolist(), high.tolist(), weight.tolist(), total.tolist()):
        now = list(block)
        while kept and kept[-1][3] * now[2] >= now[3] * kept[-1][2]:  # mean before >= mean now
            before = kept.pop()
            now = [before[0], now[1], before[2] + now[2], before[3] + now[3]]
        kept.append(now)
    return [np.array(c) for c in zip(*kept)] if kept else [np.empty(0)] * 4


def _pool_ranges(batches: Iterator) -> Iterator:
    """The blocks of one range, in ascending order over its batches."""
    import pyarrow as pa

    held = [np.empty(0)] * 4
    names = ["low", "high", "weight", "total"]
    for batch in batches:
        held = pooled(*[np.concatenate([h, batch.column(n).to_numpy()]) for h, n in zip(held, names)])
    yield pa.RecordBatch.from_arrays([pa.array(h, pa.float64()) for h in held], names=names)


def _falls(blocks: DataFrame) -> bool:
    """Whether the last block of some range has no smaller value than the first one of the next."""
    value = F.col("total") / F.col("weight")
    borders = blocks.groupBy("_range").agg(
        F.min("low").alias("low"), F.min_by(value, "low").alias("first"), F.max_by(value, "low").alias("last")
    ).collect()
    ordered = sorted(borders, key=lambda r: r["low"])
    return any(a["last"] >= b["first"] for a, b in zip(ordered, ordered[1:]))


def fit_blocks(blocks: DataFrame, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """Pooled blocks: low, high, weight, total, value, rising with low.

    Each round deals the blocks that are left to one range more than their number asks for, so that its borders lie
    elsewhere than those of the round before and a fall at a border is inside a range next time.
    """
    rounds = 0
    while True:
        ranges = -(-blocks.count() // range_blocks) or 1
        if ranges > 1:
            ranges += rounds
        dealt = blocks.select("low", "high", "weight", "total").repartitionByRange(ranges, "low").sortWithinPartitions("low")
        blocks = materialize(map_arrow(dealt, _pool_ranges, BLOCK).withColumn("_range", F.spark_partition_id()))
        if ranges == 1 or not _falls(blocks):
            return blocks.drop("_range").withColumn("value", F.col("total") / F.col("weight"))
        rounds += 1


def fit(rows: DataFrame, margin: str = "margin", label: str = "label", range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """The fitted steps of `rows`: low, high, weight, total, value."""
    return fit_blocks(materialize(blocks_of(rows, margin, label)), range_blocks)


def calibrated(rows: DataFrame, steps: DataFrame, margin: str = "margin") -> DataFrame:
    """`rows` with the calibrated value: that of the step that holds the margin, between two steps on the line that joins
    them, beyond the outer ones theirs. A missing margin has none.

    The number of steps up to a margin is a running total over ranges, so steps are found by an equality, however many
    there are.
    """
    asked = rows.select(F.col(margin).cast("double").alias("at")).filter("at is not null").distinct()
    marks = steps.select(F.col("low").alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step"), "high", "value").unionByName(
        asked.select("at", F.lit(1).alias("kind"), F.lit(0).alias("step")), allowMissingColumns=True
    )
    counted = running_totals(ordered_ranges(marks, [], ["at", "kind"]), [], ["at", "kind"], ["step"])
    numbered = counted.filter("kind = 0").select(F.col("cum_step").alias("number"), F.col("at").alias("low"), "high", "value")
    here = counted.filter("kind = 1").select("at", F.col("cum_step").alias("number"))
    after = numbered.select(
        (F.col("number") - 1).alias("number"), F.col("low").alias("next_low"), F.col("value").alias("next_value")
    )
    found = here.join(numbered.drop("low"), "number", "left").join(after, "number", "left")
    share = (F.col("at") - F.col("high")) / (F.col("next_low") - F.col("high"))
    between = F.col("value") + share * (F.col("next_value") - F.col("value"))
    value = (
        F.when(F.col("value").isNull(), F.col("next_value"))
        .when((F.col("at") <= F.col("high")) | F.col("next_value").isNull(), F.col("value")).otherwise(between)
    )
    # A row per distinct margin.
    answers = found.select("at", value.alias("calibrated"))
    return rows.join(answers, F.col(margin).cast("double") == F.col("at"), "left").drop("at")
