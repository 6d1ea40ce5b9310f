"""Equal-average search against a full search, codes against a plain version, and unusual rows."""

import math
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from lossledger.llm import vector_codes as vc


def plain(rows, rounds=vc.ROUNDS):
    """Rows of (vec_id, vector, label) in plain Python."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // 8
    cut = [[[math.floor(4096 * x) for x in v[p * width:(p + 1) * width]] for p in range(8)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:16]] for p in range(8)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            for k, members in groups.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    found = [[near(c[p], books[p]) for p in range(8)] for c in cut]
    digest = vc.codebooks_digest([np.array(b) for b in books])
    errors = [sum(d for d, _ in f) for f in found]
    of_label = defaultdict(int)
    for (_, _, label), e in zip(kept, errors):
        of_label[label] += e
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in f), e, of_label[label], digest) for (i, _, label), f, e in zip(kept, found, errors)), key=repr
    )


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def ran(spark, rows):
    found = vc.compressed(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def vectors(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(0, 0.2, dim).astype(np.float32).tolist(), int(rng.integers(0, 3)) or None) for i in rng.permutation(n)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4).flatmap(lambda d: st.tuples(
    st.lists(st.lists(st.integers(-4, 4), min_size=d, max_size=d), min_size=1, max_size=16),
    st.lists(st.lists(st.integers(-6, 6), min_size=d, max_size=d), min_size=1, max_size=20),
)))
def test_nearest_equals_full_search(case):
    book, parts = (np.array(x, np.int64) for x in case)
    index, distance = vc.nearest(parts, book)
    full = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert np.array_equal(index, full.argmin(axis=1)) and np.array_equal(distance, full.min(axis=1))


def test_large_components_do_not_overflow():
    top = int(vc.LARGEST * vc.SCALE)
    book = np.array([[top] * 64, [-top] * 64], np.int64)
    index, distance = vc.nearest(np.array([[top] * 64, [-top] * 64, [-top] * 63 + [top]], np.int64), book)
    assert index.tolist() == [0, 1, 1] and distance.tolist() == [0, 0, (2 * top) ** 2]


def test_equals_plain_version(spark):
    rows = vectors(300)
    assert ran(spark, rows) == plain(rows)


def test_unusual_rows(spark):
    rows = vectors(40)
    rows += [(100, None, 1), (101, [None] + [0.0] * 15, 1), (102, [float("nan")] + [0.0] * 15, None), (103, [float("inf")] * 16, 2)]
    rows += [rows[3], rows[3]] + [(200, rows[5][1], None)] * 30
    found = ran(spark, rows)
    assert found == plain(rows) and len(found) == 72
    assert len(ran(spark, vectors(5))) == 5 and ran(spark, vectors(5)) == plain(vectors(5))
    assert ran(spark, []) == [] and ran(spark, [(1, None, 1), (2, [], 1)]) == []
    odd = [*vectors(20), (500, [1.0] * 8, 1), (501, [1.0] * 7, 1)]
    assert ran(spark, odd) == plain(odd[:20])
    clashing = spark.createDataFrame([(1, [0.5] * 8, 1, 1, 1)], f"{SCHEMA}, of_label int, error int")
    assert vc.compressed(clashing).count() == 1


def test_codes_decode(spark):
    data = spark.createDataFrame(vectors(60), SCHEMA)
    books = vc.fit(data)
    by_id = {r["vec_id"]: r for r in vc.encode(data, books).collect()}
    for i, v, _ in vectors(60):
        whole = [math.floor(4096 * x) for x in v]
        assert sum((a - b) ** 2 for a, b in zip(whole, vc.decoded(by_id[i]["code"], books))) == by_id[i]["error"]
