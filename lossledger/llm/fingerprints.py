"""Document fingerprints by winnowing, as Spark expressions.

The units are words (runs without white space), so a k-gram hash is one xxhash64 over the hashes of k words.
In each window of `window` grams the smallest hash is chosen, the rightmost of equal ones, and its position is
kept. Guarantee: two texts that share `window` + `k` - 1 consecutive words share a chosen hash. A text with
fewer words than k has one gram, all its words; with fewer grams than a window, one window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.llm.common import range_edges, range_of, shuffle_partitions

K, WINDOW = 3, 5


def with_marks(df: DataFrame, text: str, output: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add `output`: array<struct<hash, position>>, the winnowed marks of column `text` (null: empty).

    Each array that a lambda looks into is a column of its own: as part of the lambda it would be built again for
    every element.
    """
    step = f"{output}__step"
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t-\r]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    h, n = F.col(step), F.size(step)
    rolling = F.transform(
        F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])
    )
    none = F.array().cast("array<bigint>")
    grams = F.when(n >= k, rolling).when(n > 0, F.array(F.xxhash64(h))).otherwise(none)

    # `back` is minus the position: of equal hashes the smallest struct is the rightmost.
    placed = F.transform(step, lambda x, i: F.struct(x.alias("hash"), (-i).alias("back")))
    starts = F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1)))
    minima = F.when(n > 0, F.transform(starts, lambda s: F.array_min(F.slice(h, s, window)))).otherwise(h)

    # The minimum never moves left from one window to the next, so its repeats are neighbours.
    before = lambda i: F.get(h, F.greatest(i - 1, F.lit(0)))["back"]
    new = F.filter(step, lambda m, i: (i == 0) | (m["back"] != before(i)))
    marks = F.transform(new, lambda m: F.struct(m["hash"].alias("hash"), (-m["back"]).alias("position")))
    for column in (hashes, grams, placed, minima):
        df = df.withColumn(step, column)
    return df.withColumn(output, marks).drop(step)


def digest(marks: Column) -> Column:
    """Equal texts have equal digests: SHA-256 over the chosen hashes and positions."""
    lines = F.transform(marks, lambda m: F.concat_ws(":", F.hex(m["hash"]), m["position"].cast("string")))
    return F.sha2(F.array_join(lines, ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct chosen hashes in common, 0 to 1; 1 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def with_next(
    df: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] | None = None,
    derived: Sequence[str] = (), prefix: str = "next_",
) -> DataFrame:
    """Add `columns` of the next document in descending order of doc_id; after the last comes the first.

    `derive` adds the columns `derived` to rows in their place (a frame with the struct `row`), after the shuffle, so
    that they do not travel; theirs of the next document are added as well.

    Rows are dealt into ranges of doc_id with literal edges that are ids of real rows. The row after the last
    one of a range is the largest of the range below, so rows at an edge also go to the range above as guests,
    and those with the largest id to the lowest range. One shuffle; no range is larger for a hot source.
    Rows with equal ids follow each other by `columns`; a null id comes last.
    """
    top = df.agg(F.max("doc_id")).first()[0]
    edges = [e for e in range_edges(df, "doc_id", shuffle_partitions(df.sparkSession)) if e != top]
    part = range_of(F.col("doc_id"), edges)
    at_edge = F.col("doc_id").isin(edges) if edges else F.lit(False)
    seats = F.array(
        F.struct(part.alias("part"), F.lit(0).alias("guest")),
        F.when(at_edge, F.struct((part + 1).alias("part"), F.lit(1).alias("guest"))),
        # After the lowest range come the rows that begin the whole order.
        F.when(F.col("doc_id").eqNullSafe(F.lit(top)), F.struct(F.lit(0).alias("part"), F.lit(2).alias("guest"))),
    )
    # The row as one struct: columns of `df` may have any name.
    dealt = (
        df.select(F.struct(*df.columns).alias("row"), F.explode(F.filter(seats, lambda s: s.isNotNull())).alias("seat"))
        .select("row", F.col("seat.part").alias("part"), F.col("seat.guest").alias("guest"))
        .repartition(shuffle_partitions(df.sparkSession), "part")
    )
    placed = derive(dealt) if derive else dealt
    order = Window.partitionBy("part").orderBy(
        "guest", F.col("row.doc_id").desc_nulls_last(), *[F.col(f"row.{c}") for c in columns]
    )
    leads = [F.lead(f"row.{c}").over(order).alias(prefix + c) for c in columns]
    leads += [F.lead(c).over(order).alias(prefix + c) for c in derived]
    added = [*derived, *[prefix + c for c in [*columns, *derived]]]
    kept = [F.col(f"row.{c}") for c in df.columns if c not in added]
    return placed.select("row", "guest", *derived, *leads).filter("guest = 0").select(*kept, *added)


def edited_text(text: Column, n_chars: Column, next_text: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many of the next text."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.left(text, (n_chars - half).cast("int")), F.left(next_text, half))
