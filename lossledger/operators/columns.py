"""Counts and sums of many numeric columns, one pass per question.

A row per column and value, or an aggregate per column, costs more than the reading of wide rows does. Here a task takes
its rows as Arrow columns and sends a few numbers per column; Spark adds them up by column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.session import map_arrow

_SIGN = np.uint64(1 << 63)
#: Of a 64-bit key: sign, exponent and 4 bits of the mantissa, then 8 more, which leaves 1 / 4096 of a value.
FIRST_BITS, NEXT_BITS = 16, 8


def order_keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of doubles: -0 is 0, NaN is one value beyond infinity."""
    settled = np.where(np.isnan(values), np.nan, values) + 0.0
    bits = settled.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def key_values(keys: np.ndarray) -> np.ndarray:
    """The doubles of `order_keys`."""
    keys = np.asarray(keys, np.uint64)
    return np.where(keys & _SIGN, keys ^ _SIGN, ~keys).view(np.float64)


LOWEST_KEY, HIGHEST_KEY = (int(k) for k in order_keys(np.array([-np.inf, np.nan])))


def _known(batch, i: int) -> np.ndarray:
    """Values of column `i` that are not null."""
    return batch.column(i).drop_null().to_numpy(zero_copy_only=False)


def _batch(names: Sequence[str], *parts: np.ndarray):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=list(names))


def _pass(df: DataFrame, columns: Sequence[str], run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """`run` over the rows of each task, `columns` as doubles."""
    return map_arrow(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), run, schema)


def _added(counts: Sequence[np.ndarray], names: Sequence[str], codes: Callable[[int, np.ndarray], np.ndarray]):
    """One batch of (column, code, n) of the counts that are not 0."""
    held = [(i, np.flatnonzero(n), n) for i, n in enumerate(counts)]
    return _batch(
        names, np.concatenate([np.full(len(at), i, np.int32) for i, at, _ in held]),
        np.concatenate([np.asarray(codes(i, at), np.int64) for i, at, _ in held]),
        np.concatenate([n[at] for _, at, n in held]),
    )


def prefix_counts(df: DataFrame, columns: Sequence[str], inside: Sequence[Sequence[int]] | None = None) -> list[dict[int, int]]:
    """Per column how many values have each prefix of `FIRST_BITS` bits of their key; with `inside`, a few such prefixes
    per column, each prefix of `NEXT_BITS` bits more within these.

    The driver gets at most 2**FIRST_BITS numbers per column, or 2**NEXT_BITS per prefix in `inside`; a column's values
    meet a few hundred of them.
    """
    bits = FIRST_BITS if inside is None else NEXT_BITS
    wanted = [np.array(sorted(p), np.uint64) for p in inside] if inside is not None else [np.zeros(1, np.uint64)] * len(columns)

    def run(batches: Iterator) -> Iterator:
        counts = [np.zeros(len(w) << bits, np.int64) for w in wanted]
        for batch in batches:
            for i, prefixes in enumerate(wanted):
                if not len(prefixes):
                    continue
                keys = order_keys(_known(batch, i))
                place = 0
                if inside is not None:
                    first = keys >> np.uint64(64 - FIRST_BITS)
                    place = np.minimum(np.searchsorted(prefixes, first), len(prefixes) - 1)
                    hit = prefixes[place] == first
                    keys, place = keys[hit], place[hit] << bits
                done = 0 if inside is None else FIRST_BITS
                digit = (keys >> np.uint64(64 - done - bits)) & np.uint64((1 << bits) - 1)
                codes = place + digit.astype(np.int64)
                if len(codes):
                    low = codes.min()
                    n = np.bincount(codes - low)
                    counts[i][low : low + len(n)] += n
        yield _added(counts, ["c", "p", "n"], lambda i, at: (wanted[i][at >> bits].astype(np.int64) << bits) + (at & ((1 << bits) - 1)))

    found = _pass(df, columns, run, "c int, p bigint, n bigint").groupBy("c", "p").agg(F.sum("n").alias("n")).collect()
    per_column: list[dict[int, int]] = [{} for _ in columns]
    for r in found:
        per_column[r["c"]][r["p"]] = r["n"]
    return per_column


def value_counts(df: DataFrame, columns: Sequence[str], brackets: Mapping[str, Sequence[tuple[int, int]]]) -> DataFrame:
    """feature, value, n: how often each value occurs. Keys outside a column's `brackets` (disjoint, ascending) are moved
    to the edge of the next one, or of the last, which keeps the order; without brackets they stay."""
    edges = [np.array(brackets.get(c) or [], np.uint64).reshape(-1, 2) for c in columns]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            parts = []
            for i, e in enumerate(edges):
                keys = order_keys(_known(batch, i))
                if len(e):
                    at = np.searchsorted(e[:, 1], keys)
                    keys = np.where(at < len(e), np.maximum(keys, e[np.minimum(at, len(e) - 1), 0]), e[-1, 1])
                keys, n = np.unique(keys, return_counts=True)
                parts.append((np.full(len(keys), i, np.int32), key_values(keys), n.astype(np.int64)))
            yield _batch(["c", "value", "n"], *[np.concatenate(p) for p in zip(*parts)])

    counted = _pass(df, columns, run, "c int, value double, n bigint").groupBy("c", "value").agg(F.sum("n").alias("n"))
    return counted.select(F.element_at(F.lit(list(columns)), F.col("c") + 1).alias("feature"), "value", "n")


def bin_counts(df: DataFrame, columns: Sequence[str], cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """feature, bin, n: bin 1 + the number of a column's ascending cuts below the value, bin 0 for missing ones."""
    inner = [np.array(cuts.get(c, ()), np.float64) for c in columns]

    def run(batches: Iterator) -> Iterator:
        counts = [np.zeros(len(e) + 2, np.int64) for e in inner]
        for batch in batches:
            for i, e in enumerate(inner):
                counts[i] += np.bincount(1 + np.searchsorted(e, _known(batch, i)), minlength=len(e) + 2)
                counts[i][0] += batch.column(i).null_count
        yield _added(counts, ["c", "bin", "n"], lambda i, at: at)

    counted = _pass(df, columns, run, "c int, bin bigint, n bigint").groupBy("c", "bin").agg(F.sum("n").alias("n"))
    return counted.select(F.element_at(F.lit(list(columns)), F.col("c") + 1).alias("feature"), F.col("bin").cast("int").alias("bin"), "n")


def filled_moments(df: DataFrame, filled: Mapping[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column of `filled` whose missing values are replaced by its number there.

    Sums are of distances to that number. It is to be the median, which is within one deviation of the mean, so that
    nothing is lost where the squares are subtracted.
    """
    names = list(filled)
    if not names:
        return {}
    centres = [filled[c] for c in names]

    def run(batches: Iterator) -> Iterator:
        rows, sums, squares = 0, np.zeros(len(centres)), np.zeros(len(centres))
        for batch in batches:
            rows += batch.num_rows
            for i, centre in enumerate(centres):
                away = _known(batch, i) - centre
                sums[i] += away.sum()
                squares[i] += (away * away).sum()
        at = np.arange(len(centres), dtype=np.int32)
        yield _batch(["c", "n", "s", "q"], at, np.full(len(at), rows, np.int64), sums, squares)

    added = _pass(df, names, run, "c int, n bigint, s double, q double").groupBy("c").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")
    )
    found = {}
    for r in added.collect():
        if r["n"]:
            shift = r["s"] / r["n"]
            found[names[r["c"]]] = (centres[r["c"]] + shift, float(np.sqrt(np.maximum(r["q"] / r["n"] - shift * shift, 0.0))))
    return found
