"""Global ranks, running totals and exact quantiles without a single-task window.

Rows are range-partitioned by the order key, numbered or summed inside each range, and shifted
by the totals of the ranges before it. A range is a partition of about equal size, so neither a
hot group nor a hot value ends up in one task as long as the order key is unique; callers
aggregate equal keys first or append a unique tie key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lossledger.operators import columns
from lossledger.session import materialize

# monotonically_increasing_id puts the partition number above the lower 33 bits.
_ROW_BITS = 33


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> tuple[DataFrame, int]:
    """`df` with the 1-based rank in ascending `order`, and the number of rows.

    The ranges are written once, so every later reader sees the same numbering; only one count
    per range (at most the number of shuffle partitions) comes to the driver.
    """
    ranges = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = {row["part"]: row["n"] for row in ranges.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return ranges.withColumn(name, F.lit(1).cast("bigint")).drop("_slot"), 0
    counts = [sizes.get(i, 0) for i in range(max(sizes) + 1)]
    before = [0, *accumulate(counts)][:-1]
    within = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    shift = F.element_at(F.lit(before), (part + 1).cast("int"))
    return ranges.withColumn(name, (shift + within + 1).cast("bigint")).drop("_slot"), sum(counts)


def ordered_ranges(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """`df` stored in ranges of (group, order), numbered by `_range`. Together they must identify a row."""
    return materialize(
        df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_range", F.spark_partition_id())
    )


def running_totals(ranges: DataFrame, group: Sequence[str], order: Sequence[Column | str], sums: Sequence[str]) -> DataFrame:
    """Add `cum_<x>` (inclusive running total in `order`) and `all_<x>` (group total) for each of `sums`.

    `ranges` comes from `ordered_ranges` with the same group and order.
    """
    group = list(group)
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    # One row per group and range it touches: at most groups + ranges rows.
    shifts = (
        ranges.groupBy(*group, "_range")
        .agg(*[F.sum(x).alias(f"_sum_{x}") for x in sums])
        .select(
            *group,
            "_range",
            *[F.coalesce(F.sum(f"_sum_{x}").over(earlier), F.lit(0)).alias(f"_before_{x}") for x in sums],
            *[F.sum(f"_sum_{x}").over(whole).alias(f"all_{x}") for x in sums],
        )
    )
    so_far = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranges.withColumns({f"cum_{x}": F.sum(x).over(so_far) for x in sums})
    joined = local.join(shifts, [*group, "_range"])
    return joined.withColumns({f"cum_{x}": F.col(f"cum_{x}") + F.col(f"_before_{x}") for x in sums}).drop(
        "_range", *[f"_before_{x}" for x in sums]
    )


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    fractions: Sequence[float] | Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """Exact linearly interpolated quantiles of `value` per group: columns group, fraction, quantile.

    `fractions` is a list of numbers, or a function from the group's number of distinct values to
    a list of columns (NULL where a group has fewer). Equal values are counted before anything is
    ordered. Missing values are left out.
    """
    if not group:
        raise ValueError("quantiles need a group to join by")
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    return counted_quantiles(counted, group, value, fractions)


def counted_quantiles(
    counted: DataFrame,
    group: Sequence[str],
    value: str,
    fractions: Sequence[float] | Callable[[Column], Sequence[Column]],
) -> DataFrame:
    """`quantiles` of values that are counted already: a row per group and value, with `n`."""
    group = list(group)
    ranges = ordered_ranges(counted, group, [value])
    sizes = ranges.groupBy(*group).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct"))
    wanted = fractions(F.col("distinct")) if callable(fractions) else [F.lit(float(q)) for q in fractions]
    # Two zero-based ranks per group and fraction: a table of groups x fractions rows.
    targets = (
        sizes.withColumn("fraction", F.explode(F.array(*wanted)))
        .filter(F.col("fraction").isNotNull())
        .withColumn("_at", F.col("fraction") * (F.col("rows") - 1))
        .select(
            *group,
            "fraction",
            (F.col("_at") - F.floor("_at")).alias("_share"),
            F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank"),
        )
    )
    ranked = running_totals(ranges, group, [value], ["n"])
    holds = (F.col("_rank") >= F.col("cum_n") - F.col("n")) & (F.col("_rank") < F.col("cum_n"))
    hits = ranked.withColumnsRenamed({g: f"_g_{g}" for g in group}).join(
        targets, reduce(Column.__and__, [F.col(g) == F.col(f"_g_{g}") for g in group], holds)
    )
    ends = hits.groupBy(*group, "fraction").agg(
        F.max("_share").alias("_share"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    return ends.select(
        *group,
        "fraction",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("quantile"),
    )


def count_below(value: Column, edges: str, size: int) -> Column:
    """How many of the first `size` entries of the array column `edges` lie below `value`."""
    return reduce(Column.__add__, [F.when(F.get(edges, F.lit(i)) < value, 1).otherwise(0) for i in range(size)])


BRACKET_ACCURACY = 10_000


def key_brackets(df: DataFrame, names: Sequence[str], fractions: Sequence[float]) -> dict[str, list[tuple[int, int]]]:
    """Per column disjoint ascending intervals of `columns.order_keys` that hold the order statistics around each fraction.

    Values are counted by the leading bits of their keys, then by further bits where a wanted rank lies: two passes, and
    the ranks are exact. Columns with fewer than 2 x BRACKET_ACCURACY values have no intervals.
    """
    first = columns.prefix_counts(df, names)
    sizes = [sum(counts.values()) for counts in first]
    ranks = [
        [(math.floor(q * (n - 1)), math.ceil(q * (n - 1))) for q in fractions] if n >= 2 * BRACKET_ACCURACY else []
        for n in sizes
    ]
    if not any(ranks):
        return {c: [] for c in names}

    def placed(counts: Mapping[int, int], rank: int, before: int = 0) -> tuple[int, int]:
        """The prefix that holds a 0-based rank, and how many values lie before it."""
        for prefix, n in sorted(counts.items()):
            if rank < before + n:
                return prefix, before
            before += n
        raise ValueError(f"rank {rank} is beyond the values")

    heads = [{r: placed(counts, r) for pair in wanted for r in pair} for counts, wanted in zip(first, ranks)]
    following = columns.prefix_counts(df, names, [{prefix for prefix, _ in found.values()} for found in heads])
    rest = 64 - columns.FIRST_BITS - columns.NEXT_BITS
    brackets: dict[str, list[tuple[int, int]]] = {}
    for c, wanted, found, counts in zip(names, ranks, heads, following):
        def bucket(rank: int) -> int:
            prefix, before = found[rank]
            own = {p: n for p, n in counts.items() if p >> columns.NEXT_BITS == prefix}
            return placed(own, rank, before)[0]

        brackets[c] = []
        for low, high in sorted({(bucket(a) << rest, (bucket(b) + 1 << rest) - 1) for a, b in wanted}):
            low, high = max(low, columns.LOWEST_KEY), min(high, columns.HIGHEST_KEY)
            if brackets[c] and low <= brackets[c][-1][1]:
                brackets[c][-1] = (brackets[c][-1][0], max(high, brackets[c][-1][1]))
            else:
                brackets[c].append((low, high))
    return brackets


def quantile_brackets(
    df: DataFrame, names: Sequence[str], fractions: Sequence[float]
) -> dict[str, list[tuple[float, float]]]:
    """`key_brackets` as intervals of values."""
    return {
        c: [tuple(columns.key_values(pair).tolist()) for pair in pairs] for c, pairs in key_brackets(df, names, fractions).items()
    }


def feature_quantiles(df: DataFrame, names: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Exact quantiles of whole columns: feature, fraction, quantile.

    Values outside the brackets are moved to the edge of the next one. That keeps their order and leaves the order
    statistics inside as they are, and all that has to be counted and ordered are the few values within brackets.
    """
    counted = columns.value_counts(df, names, key_brackets(df, names, fractions))
    return counted_quantiles(counted, ["feature"], "value", fractions)


def column_quantiles(df: DataFrame, names: Sequence[str], fractions: Sequence[float]) -> dict[str, dict[float, float]]:
    """Exact quantiles of whole columns on the driver: one number per column and fraction."""
    rows = feature_quantiles(df, names, fractions).collect()
    found: dict[str, dict[float, float]] = {c: {} for c in names}
    for row in rows:
        found[row["feature"]][row["fraction"]] = row["quantile"]
    return found


SELECTION_BUCKETS = 256


@dataclass(frozen=True)
class Boundary:
    """The value at a 1-based rank: `before` rows are smaller, `ties` rows equal it."""

    rank: int
    value: float | int
    before: int
    ties: int


def select_ranks(df: DataFrame, value: str, ranks: Sequence[int]) -> list[Boundary]:
    """The values at several ranks of a numeric column, without ordering the rows.

    A histogram of counts narrows the interval around each rank until its lowest and highest value are one. A round is
    one pass with at most len(ranks) x SELECTION_BUCKETS counts, which is what the driver gets; rows are never moved. A
    bucket keeps the lowest and highest value that it holds, so at least one value leaves an interval in every round,
    and about SELECTION_BUCKETS times fewer stay. Missing values are left out.
    """
    rows = df.select(F.col(value).alias("v")).filter("v is not null")
    whole = rows.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).first()
    if not whole["n"]:
        return []
    state = {r: (whole["low"], whole["high"], 0, whole["n"]) for r in ranks if 1 <= r <= whole["n"]}
    while True:
        # Intervals of different ranks are the same one or disjoint.
        open_ = sorted({(low, high, before) for low, high, before, _ in state.values() if low != high})
        if not open_:
            return [Boundary(r, low, before, n) for r, (low, _, before, n) in sorted(state.items())]
        v, code = F.col("v"), F.lit(None).cast("int")
        for k, (low, high, _) in enumerate(open_):
            # Halves, so that the width of the widest interval is still a number; rising with v, 0 at low, last at high.
            share = F.nanvl(F.coalesce(F.try_divide(v / 2 - F.lit(low) / 2, F.lit(high) / 2 - F.lit(low) / 2), F.lit(0.0)), F.lit(0.0))
            bucket = F.when(v <= low, 0).when(v >= high, SELECTION_BUCKETS - 1).otherwise(
                F.least(F.greatest(F.floor(share * SELECTION_BUCKETS), F.lit(0)), F.lit(SELECTION_BUCKETS - 1))
            )
            code = F.when(v.between(low, high), (k * SELECTION_BUCKETS + bucket).cast("int")).otherwise(code)
        counts = rows.select("v", code.alias("code")).filter("code is not null").groupBy("code").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        ).collect()
        held: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: r["code"]):
            held.setdefault(r["code"] // SELECTION_BUCKETS, []).append(r)
        place = {interval[:2]: k for k, interval in enumerate(open_)}
        for rank, (low, high, before, _) in list(state.items()):
            if low == high:
                continue
            for bucket in held[place[low, high]]:
                if rank <= before + bucket["n"]:
                    state[rank] = (bucket["low"], bucket["high"], before, bucket["n"])
                    break
                before += bucket["n"]


def after_ranks(df: DataFrame, value: str, tie: str, ranks: Sequence[int]) -> Column:
    """How many of `ranks` end before a row in the order of `value`, ties by `tie`: a comparison with literals.

    A rank that ends inside equal values is settled by selection among the rows that hold the value, on their keys; keys
    that are not numbers are ordered, but only those rows' keys. Rows that agree in both stay together.
    """
    v, terms = F.col(value), []
    for b in select_ranks(df, value, ranks):
        after = v > F.lit(b.value)
        if b.rank < b.before + b.ties:
            equal = df.filter(v == F.lit(b.value))
            within = b.rank - b.before
            if isinstance(df.schema[tie].dataType, NumericType):
                key = select_ranks(equal, tie, [within])[0].value
            else:
                ranked, _ = global_rank(equal.select(tie), [tie], "_at")
                key = ranked.filter(F.col("_at") == within).first()[tie]
            after = after | ((v == F.lit(b.value)) & (F.col(tie) > F.lit(key)))
        terms.append(after.cast("bigint"))
    return reduce(Column.__add__, terms, F.lit(0).cast("bigint"))


def last_ranks(rows: int, n_bins: int) -> list[int]:
    """The last rank of each quantile bin but the last, equal to right-closed quantile cuts of the ranks 1..rows.

    Not `ntile`: the first bin is closed on both sides.
    """
    q = min(n_bins, rows)
    return [1 + b * (rows - 1) // q for b in range(1, q)]
