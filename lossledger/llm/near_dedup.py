"""Near duplicates by MinHash with tensored banding, verified on full shingle sets.

Two small collections of HALVES keys are made per text, each key from HALF_SIZE minhashes. A table key is a pair of
one key from either collection, so 2 x HALVES x HALF_SIZE minhashes serve HALVES ** 2 tables. With similarity s a
link is missed with probability 1 - (1 - (1 - s ** HALF_SIZE) ** HALVES) ** 2: below 1e-6 at s = 0.85. Another limit
takes as many keys as that needs (`halves_for`).

How the work stays bounded when a group of copies is huge:
* texts with equal sets are one class, found by grouping; only classes are compared;
* a key that no other class has cannot make a table key that another class has, so single keys are counted first
  and tables are formed only from the rest;
* a class whose set has more than 100 - `percent` % of shingles that occur in no other candidate cannot have a link
  (exact);
* a class first meets the best of the pivots of its keys alone, at most one pair a class; what is known so far is kept as
  an edge per class, never as all links;
* in a table all members that are not yet together are then compared with one pivot, the member with the fewest
  shingles of its own; verified links are contracted to components, and only members that are not yet with the pivot are compared further: with a
  second pivot, then with every member of another component that shares a shingle outside the pivot's set with it,
  or whose known overlap with the pivot leaves a link possible (exact bounds). Links inside a component are implied
  and never listed; no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm.common import map_arrow, stored, with_keys
from lossledger.llm.shingles import SHINGLE, mix, shingle_sets, text_pieces

HALVES, HALF_SIZE = 20, 4
LINK_PERCENT = 85
#: A link at the limit is missed at most so often.
MISS = 1e-6
GROUP_HASHES = 1 << 16

SIGNATURE = "doc_id bigint, n_shingles bigint, set_high bigint, set_low bigint, halves array<bigint>"
MEMBER = "class bigint, n bigint, shingles array<bigint>"


def halves_for(percent: int) -> int:
    """Keys of either collection with which a link at the limit is missed less often than MISS."""
    if not 1 <= percent <= 99:
        raise ValueError("the limit of a link has to be 1 to 99 percent")
    return max(1, math.ceil(math.log(MISS / 2) / math.log(1 - (percent / 100) ** HALF_SIZE)))


def _seeds(halves: int) -> tuple[np.ndarray, np.ndarray]:
    made = mix(np.arange(1, 2 * 2 * halves * HALF_SIZE + 1, dtype=np.uint64))
    half = len(made) // 2
    return made[:half], made[half:] | np.uint64(1)


def half_keys(sets: list[np.ndarray], halves: int = HALVES) -> list[np.ndarray]:
    """2 x `halves` keys for each non-empty set; the number of the key is part of it."""
    xors, factors = _seeds(halves)
    keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(sets)
    filled = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(filled):  # a group of sets fits the processor's cache
        to, total = at, 0
        while to < len(filled) and (to == at or total + len(sets[filled[to]]) <= GROUP_HASHES):
            total += len(sets[filled[to]])
            to += 1
        group = filled[at:to]
        flat = np.concatenate([sets[i] for i in group])
        starts = np.cumsum([0] + [len(sets[i]) for i in group[:-1]])
        minima = np.stack([np.minimum.reduceat((flat ^ x) * f, starts) for x, f in zip(xors, factors)], axis=1)
        made = np.zeros((len(group), 2 * halves), np.uint64)
        for j in range(HALF_SIZE):
            made = mix(made + minima[:, j::HALF_SIZE])
        made = mix(made + np.arange(2 * halves, dtype=np.uint64))
        for i, row in zip(group, made):
            keys[i] = row
        at = to
    return keys


def set_digest(values: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(hashlib.blake2b(values.tobytes(), digest_size=16).digest(), np.int64)
    return int(high), int(low)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sign(size: int, halves: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in text_pieces(batch, "text"):
                sets = shingle_sets(data, offsets, size)
                digests = np.array([set_digest(s) for s in sets], dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, to - row),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests[:, 0]), pa.array(digests[:, 1]), _lists(half_keys(sets, halves)),
                    ],
                    names=["doc_id", "n_shingles", "set_high", "set_low", "halves"],
                )

    return run


def _members(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sets of the wanted texts; rows that only share the doc_id of a wanted one are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in text_pieces(batch, "text"):
                sets = shingle_sets(data, offsets, size)
                wanted = zip(batch.column("set_high").slice(row, to - row).to_pylist(),
                             batch.column("set_low").slice(row, to - row).to_pylist())
                right = [i for i, (s, w) in enumerate(zip(sets, wanted)) if set_digest(s) == w]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("class").slice(row, to - row).take(pa.array(right, pa.int64())),
                        pa.array([len(sets[i]) for i in right], pa.int64()), _lists([sets[i] for i in right]),
                    ],
                    names=["class", "n", "shingles"],
                )

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of `edges` (a, b).

    Each round takes the smallest label among neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of the longest path. Every round is stored; only a count goes to the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")
    ))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        moved = stored(step.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label")))
        labels = moved.select("node", "label")
        if not moved.filter("old <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")


def _possible(percent: int, n: Column, own: Column, other_n: Column, other_own: Column) -> Column:
    """Exact bounds: the union holds one set and what the other has for itself, the overlap leaves own out."""
    return (
        (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n))
        & (100 * (n - own) >= percent * (n + other_own))
        & (100 * (other_n - other_own) >= percent * (other_n + own))
    )


def verified(pairs: DataFrame, members: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = members.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = members.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    link = 100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)
    return stored(both.filter(link).select("a", "b"))


def _pairs_with_pivot(seats: DataFrame, percent: int) -> DataFrame:
    """seats: key, class, n, own, component. Each member with the pivot of its key, where a link is possible."""
    pivot = seats.groupBy("key").agg(
        F.min(F.struct("own", "class", "n", "component")).alias("p"), F.count(F.lit(1)).alias("size")
    ).filter("size > 1").select("key", "p")
    return (
        seats.join(pivot, "key")
        .filter(F.col("component") != F.col("p.component"))
        .filter(_possible(percent, F.col("n"), F.col("own"), F.col("p.n"), F.col("p.own")))
        .select(F.col("class").alias("a"), F.col("p.class").alias("b"))
        .distinct()
    )


def _pairs_with_best_pivot(seats: DataFrame, percent: int) -> DataFrame:
    """As `_pairs_with_pivot`, but a member meets only the best of the pivots of its keys: one pair a member at most,
    however many keys a large group of copies shares."""
    best = F.min(F.struct("own", "class", "n", "component"))
    pivot = seats.groupBy("key").agg(best.alias("p"))
    met = seats.join(pivot, "key").groupBy("class").agg(
        F.first("n").alias("n"), F.first("own").alias("own"), F.min("p").alias("p")
    )
    return met.filter(F.col("class") != F.col("p.class")).filter(
        _possible(percent, F.col("n"), F.col("own"), F.col("p.n"), F.col("p.own"))
    ).select(F.col("class").alias("a"), F.col("p.class").alias("b"))


def linked_classes(docs: DataFrame, rows: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """node, component over classes with a link to another class."""
    half = halves_for(percent)
    firsts = rows.join(sets.select(F.col("class").alias("row")), "row", "left_semi")
    halves = firsts.select(F.col("row").alias("class"), F.posexplode("halves").alias("at", "half"))
    shared = stored(halves.groupBy("half").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("half"))
    side = lambda test: F.collect_list(F.when(test, F.col("half")))
    survivors = stored(
        halves.join(shared, "half").groupBy("class")
        .agg(side(F.col("at") < half).alias("one"), side(F.col("at") >= half).alias("two"))
        .filter((F.size("one") > 0) & (F.size("two") > 0))
    )

    wanted = rows.withColumnRenamed("row", "class").join(survivors.select("class"), "class", "left_semi").select(
        "class", F.col("doc_id").alias("wanted_id"), "set_high", "set_low"
    )
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    members = stored(map_arrow(texts.select("class", "set_high", "set_low", "text"), _members(size), MEMBER))
    if members.count() != survivors.count():  # repeated rows
        members = stored(members.dropDuplicates(["class"]))

    alone = (
        members.select("class", F.explode("shingles").alias("shingle")).groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("size"), F.min("class").alias("class")).filter("size = 1")
        .groupBy("class").agg(F.count(F.lit(1)).alias("own"))
    )
    active = (
        members.select("class", "n").join(alone, "class", "left")
        .withColumn("own", F.coalesce("own", F.lit(0)))
        .filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))
    )
    nodes = stored(survivors.join(active, "class"))

    def placed(found: DataFrame) -> DataFrame:
        """`nodes` with their component so far."""
        found = found.withColumnRenamed("node", "class")
        return nodes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))

    def grown(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components after the links among `pairs`. What is known is an edge per node, so all links so far are never
        walked again."""
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(known.union(verified(pairs, members, percent)))

    single = nodes.select("class", "n", "own", F.col("class").alias("component"), F.explode("one").alias("key"))
    found = components(verified(_pairs_with_best_pivot(single, percent), members, percent))

    tables = placed(found).select("class", "n", "own", "component", F.explode("one").alias("h"), "two").select(
        "class", "n", "own", "component", "h", F.explode("two").alias("g")
    ).withColumn("key", F.xxhash64("h", "g")).drop("h", "g")
    found = grown(found, _pairs_with_pivot(tables, percent))

    def seats(found: DataFrame) -> DataFrame:
        """Members by key of the first collection (each table is inside one), with their component so far; only
        keys that still have several components."""
        by_key = placed(found).select("class", "n", "own", "component", F.explode("one").alias("key"))
        head = by_key.groupBy("key").agg(
            F.min(F.struct("own", "class", "component")).alias("p"), F.min("component").alias("low"),
            F.max("component").alias("high"),
        ).filter("low <> high").select("key", F.col("p.component").alias("main"), F.col("p.class").alias("pivot"))
        return stored(by_key.join(head, "key"))

    loose = seats(found).filter("component <> main").drop("main", "pivot")
    found = grown(found, _pairs_with_pivot(loose, percent))
    return grown(found, _pairs_past_pivot(seats(found), members, percent))


def _pairs_past_pivot(open_seats: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Every pair of different components under one pivot whose sets can be similar enough.

    What two sets share lies inside the pivot's set or outside. If they share nothing outside, the overlap is at most
    the smaller of their overlaps with the pivot, which are known; for sets of the pivot's size that rules out every
    link of a set that is not linked with the pivot itself. Pairs that share something outside are found by joining
    on it: copies share little but what they were copied from.
    """
    seats = open_seats.select("pivot", "main", "class", "n", "own", "component").distinct()
    pivots = members.select(F.col("class").alias("pivot"), F.col("shingles").alias("of_pivot"))
    parted = stored(
        seats.join(members.select("class", "shingles"), "class").join(pivots, "pivot")
        .withColumn("outside", F.array_except("shingles", "of_pivot")).drop("shingles", "of_pivot")
        .withColumn("inside", F.col("n") - F.size("outside"))
    )
    loose = F.col("component") != F.col("main")
    columns = ["class", "n", "own", "component"]

    def side(df: DataFrame, name: str, bound: str, *keys: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{c}_{name}") for c in columns], F.col(bound).alias(f"bound_{name}"))

    overlap = F.least("bound_a", "bound_b")  # no two sets share more
    apart = (
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("main")) | (F.col("class_a") < F.col("class_b")))
        & _possible(percent, F.col("n_a"), F.col("own_a"), F.col("n_b"), F.col("own_b"))
        & (100 * overlap >= percent * (F.col("n_a") + F.col("n_b") - overlap))
    )
    # Nothing in common outside: n_b is at most so much. Sizes go by steps of 2 %, checked exactly afterwards.
    step = lambda n: F.floor(F.log(n) / 0.02).cast("int")
    most = F.least(
        F.floor(F.col("inside") * (100 + percent) / percent) - F.col("n"), F.floor(F.col("n") * 100 / percent)
    )
    least = F.ceil(F.col("n") * percent / 100)
    x = parted.filter(loose & (most >= least)).withColumn("size", F.explode(F.sequence(step(least), step(most))))
    by_size = side(x, "a", "inside", "pivot", "main", "size").join(
        side(parted.withColumn("size", step(F.col("n"))), "b", "inside", "pivot", "size"), ["pivot", "size"]
    ).filter(apart)

    outside = parted.withColumn("shingle", F.explode("outside")).drop("outside")
    met = stored(
        outside.groupBy("pivot", "shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("pivot", "shingle")
    )
    shared = outside.join(met, ["pivot", "shingle"])
    # Of what lies outside, only what another component has too can add to an overlap.
    reach = shared.groupBy("pivot", "class").agg((F.first("inside") + F.count(F.lit(1))).alias("reach"))
    shared = shared.join(reach, ["pivot", "class"])
    by_shingle = side(shared.filter(loose), "a", "reach", "pivot", "main", "shingle").join(
        side(shared, "b", "reach", "pivot", "shingle"), ["pivot", "shingle"]
    ).filter(apart)
    pairs = [found.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")) for found in (by_size, by_shingle)]
    return pairs[0].union(pairs[1]).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = LINK_PERCENT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Texts are linked if their sets have a Jaccard similarity of at least `percent` in a hundred.
    A text's set are its distinct shingles of `size` words, or all its words as one if it has fewer; null, empty and
    blank texts have none and no links. Repeated rows have equal sets, hence one component. kept: doc_id equals
    component_id (all rows of a repeated doc_id); a component of null doc_ids only has a null id and keeps them.
    Extra columns are ignored.
    """
    # Other columns could have names of ours.
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(map_arrow(docs, _sign(size, halves_for(percent)), SIGNATURE).withColumn("row", F.monotonically_increasing_id()))
    by_set = ["n_shingles", "set_high", "set_low"]
    sets = stored(rows.filter("n_shingles > 0").groupBy(*by_set).agg(F.min("row").alias("class")))
    linked = linked_classes(docs, rows, sets, size, percent).withColumnRenamed("node", "class")

    classed = rows.select("row", "doc_id", *by_set).join(sets, by_set, "left")
    placed = stored(
        classed.withColumn("class", F.coalesce("class", "row")).join(linked, "class", "left").select(
            "doc_id", "n_shingles", F.coalesce("component", "class").alias("component")
        )
    )
    ids = stored(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    return placed.join(ids, "component").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = LINK_PERCENT) -> DataFrame:
    """The rows of `docs` whose document stands for its component, with the columns of `docs`, which may have any name.

    doc_id is a whole number. Of rows that agree in doc_id and text, one stays.
    """
    kept = near_duplicates(docs, size, percent).filter("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("doc_id").isNull().alias("no_id")
    )
    rows = with_keys(docs).join(kept.distinct(), ["id", "no_id"], "left_semi")
    return rows.dropDuplicates(["id", "no_id", "digest"]).select("row.*")
