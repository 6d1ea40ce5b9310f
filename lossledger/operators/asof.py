"""Point-in-time joins and latest-row selection over dated histories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class History:
    """A dated history to look up: `prefer` orders rows of one date, highest first."""

    rows: DataFrame
    on: str
    prefer: Sequence[str] = field(default_factory=tuple)


def _ordered_row(df: DataFrame, on: str, prefer: Sequence[str], by: str) -> Column:
    rest = [c for c in df.columns if c not in {by, on, *prefer}]
    return F.struct(on, *prefer, *rest)


def latest_row(df: DataFrame, by: str, on: str, prefer: Sequence[str] = (), not_after=None) -> DataFrame:
    """One row per key: the latest by date, then by `prefer`, then by the other columns.

    A plain aggregate, so the rows of a hot key are reduced before the shuffle.
    """
    rows = df.filter(F.col(by).isNotNull() & F.col(on).isNotNull())
    if not_after is not None:
        rows = rows.filter(F.col(on) <= F.lit(not_after))
    return rows.groupBy(by).agg(F.max(_ordered_row(df, on, prefer, by)).alias("_row")).select(by, "_row.*")


def asof_join(
    left: DataFrame, histories: Sequence[History], by: str, left_on: str, attributes: DataFrame | None = None
) -> DataFrame:
    """Left join each history's latest row dated on or before `left_on`.

    Both date columns must be DATEs. Each history becomes a row per key, with its rows in order of their days, at most one
    a day; each left row then picks the latest of its list that it may know. So a statement is moved once per borrower and
    not once per facility, no pairs are formed within a key, and the join back is one of narrow left rows with a row per
    key, where adaptive execution can split a key that holds a large part of the left rows. `attributes` (one row per
    key) ride along with the lists.
    """
    slots = [f"_row{i}" for i in range(len(histories))]
    known = left.select(by).distinct()
    for slot, history in zip(slots, histories):
        rows = history.rows.filter(F.col(by).isNotNull())
        daily = rows.groupBy(by, history.on).agg(F.max(_ordered_row(rows, history.on, history.prefer, by)).alias("_row"))
        known = known.join(daily.groupBy(by).agg(F.sort_array(F.collect_list("_row")).alias(slot)), by, "left")
    carried: list[str] = []
    if attributes is not None:
        known = known.join(attributes, by, "left")
        carried = [c for c in attributes.columns if c != by]
    known = known.withColumnsRenamed({by: "_by"})
    # A missing date is on or before nothing, on either side.
    latest = {
        slot: F.try_element_at(F.filter(slot, lambda row: row[history.on] <= F.col(left_on)), F.lit(-1))
        for slot, history in zip(slots, histories)
    }
    return (
        left.join(known, F.col(by).eqNullSafe(F.col("_by")), "left")
        .select(*left.columns, *carried, *[row.alias(slot) for slot, row in latest.items()])
        .select(*left.columns, *carried, *[f"{slot}.*" for slot in slots])
    )
