"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in order of doc_id, are cut into blocks of about `block_chars` characters by their
running total. With weight w, block j of a source (from 0) is released at slot floor(j / w) and due by slot
ceil((j + 1) / w); in every slot the released block with the earliest deadline runs. With weights that are whole
parts of a period the schedule repeats after that many slots, so the sequential part is one period, a table whose
size is a parameter. Everything else is arithmetic on block numbers, at any scale.

In every prefix of slots each source has less than one block more or less than its share, as long as none has run
out. Slots of a source that ran out stay empty; the others keep their proportions to each other.
"""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.llm.common import range_edges, range_of, shuffle_partitions

REST = "*"
BLOCK_CHARS = 65_536


def period_schedule(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block in period, slot) over one period of sum(weights) slots, earliest deadline first.

    Ties go to the source named first in `weights`.
    """
    if not weights or min(weights.values()) < 1:
        raise ValueError("weights have to be whole parts of at least 1")
    period, names = sum(weights.values()), list(weights)
    windows = sorted(
        (j * period // weights[s], -(-(j + 1) * period // weights[s]), i, j)
        for i, s in enumerate(names)
        for j in range(weights[s])
    )
    ready: list[tuple[int, int, int]] = []
    schedule, arriving = [], 0
    for slot in range(period):
        while arriving < period and windows[arriving][0] <= slot:
            _, deadline, i, j = windows[arriving]
            heapq.heappush(ready, (deadline, i, j))
            arriving += 1
        deadline, i, j = heapq.heappop(ready)
        assert slot < deadline
        schedule.append((names[i], j, slot))
    return schedule


def scheduled(docs: DataFrame, weights: dict[str, int], block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` with mix_source, mix_block, mix_release, mix_deadline, mix_slot, mix_at (characters of its block
    before it).

    Sources that `weights` does not name share the entry `*`, in order of doc_id; without that entry they raise
    an error in the job. A null source is unnamed. A null or empty text has length 0. Rows with equal doc_id stay
    together in the order of their text; a null doc_id comes last. Every row is kept. The running total goes by ranges of
    doc_id, so a hot source is split over as many tasks as the table.
    """
    spark, parts = docs.sparkSession, shuffle_partitions(docs.sparkSession)
    named = [s for s in weights if s != REST]
    other = F.lit(REST) if REST in weights else F.raise_error("a source without a weight")
    source = F.when(F.col("source").isin(named), F.col("source")).otherwise(other)
    # The row as one struct: columns of `docs` may have any name.
    sized = docs.select(
        F.struct(*docs.columns).alias("row"),
        source.alias("mix_source"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("chars"),
        range_of(F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)), range_edges(docs, "doc_id", parts)).alias("part"),
    )
    by_part = sized.groupBy("mix_source", "part").agg(F.sum("chars").alias("total"))
    before = Window.partitionBy("mix_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and range: at most len(weights) x partitions rows.
    offsets = by_part.withColumn("offset", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    inside = (
        Window.partitionBy("mix_source", "part").orderBy(F.col("row.doc_id").asc_nulls_last(), F.col("row.text"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn("within", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), ["mix_source", "part"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .withColumn("mix_block", F.expr(f"start div {block_chars}"))
        .withColumn("mix_at", F.col("start") % block_chars)
    )
    period = sum(weights.values())
    parts_of = _choose(F.col("mix_source"), weights)
    slots = _slot_table(spark, weights)
    j = F.col("mix_block")
    with_slot = (
        placed.withColumn("parts", parts_of)
        .withColumn("in_period", (j % F.col("parts")).cast("int"))
        .join(F.broadcast(slots), ["mix_source", "in_period"])
        .withColumn("mix_slot", F.expr("mix_block div parts") * period + F.col("slot"))
        .withColumn("mix_release", F.expr(f"(mix_block * {period}) div parts"))
        .withColumn("mix_deadline", -F.floor(-((j + 1) * period) / F.col("parts")).cast("bigint"))
    )
    added = ["mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_at"]
    return with_slot.select(*[F.col(f"row.{c}") for c in docs.columns if c not in added], *added)


def _choose(source: Column, weights: dict[str, int]) -> Column:
    return reduce(lambda c, kv: c.when(source == kv[0], kv[1]), weights.items(), F).cast("bigint")


def _slot_table(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """sum(weights) rows, the period of the schedule."""
    schema = "mix_source string, in_period int, slot bigint"
    return spark.createDataFrame(period_schedule(weights), schema)


def laid_out(docs: DataFrame, weights: dict[str, int], block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`scheduled` in the order of the schedule: partitions by ranges of slots, sorted inside."""
    order = ["mix_slot", "mix_source", "mix_block", "mix_at", "doc_id"]
    parts = shuffle_partitions(docs.sparkSession)
    if clash := [c for c in docs.columns if c.startswith("mix_")]:
        raise ValueError(f"columns of the schedule's own: {clash}")
    laid = scheduled(docs, weights, block_chars)
    return laid.repartitionByRange(parts, "mix_slot", "mix_at").sortWithinPartitions(*order)


def mixed(docs: DataFrame, weights: dict[str, int], block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`docs` in the order of the schedule, all rows and columns. A reader of several files may lose that order;
    what has to last takes the columns of `laid_out`."""
    # Columns of `docs` may have any name, those of the schedule too.
    plain = [c if c in ("doc_id", "source", "text") else f"_{i}" for i, c in enumerate(docs.columns)]
    return laid_out(docs.toDF(*plain), weights, block_chars).select(*plain).toDF(*docs.columns)
