"""Point-in-time joins, global ranks, quantiles and splits against brute force, with hot keys."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossledger.operators import ordering
from lossledger.operators.asof import History, asof_join, latest_row
from lossledger.operators.backtesting import with_rank_bins
from lossledger.operators.ordering import (
    column_quantiles,
    global_rank,
    ordered_ranges,
    quantiles,
    last_ranks,
    select_ranks,
    running_totals,
)
from lossledger.operators.splitting import earliest_rows, split_summary, time_split

START = dt.date(2020, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def test_asof_join_brute_force(spark):
    rng = random.Random(7)
    companies = ["hot"] * 60 + [f"c{i}" for i in range(30)] + [None]
    left = [(i, rng.choice(companies), day(rng.randrange(200)) if i % 40 else None) for i in range(900)]
    right = [(rng.choice(companies), day(rng.randrange(200)), rng.randrange(1000)) for _ in range(600)]
    other = [(rng.choice(companies), day(rng.randrange(200)), rng.random()) for _ in range(80)]
    names = [("hot", "H"), ("c1", "one")]
    got = asof_join(
        spark.createDataFrame(left, "id int, company string, seen date"),
        [
            History(spark.createDataFrame(right, "company string, rated date, grade int"), "rated", ["grade"]),
            History(spark.createDataFrame(other, "company string, filed date, revenue double"), "filed"),
        ],
        by="company",
        left_on="seen",
        attributes=spark.createDataFrame(names, "company string, label string"),
    ).collect()
    assert len(got) == len(left)

    def latest(history, company, seen):
        known = [(d, v) for c, d, v in history if c is not None and c == company and seen is not None and d <= seen]
        return max(known, default=(None, None))

    for r in got:
        assert (r["rated"], r["grade"]) == latest(right, r["company"], r["seen"])
        assert (r["filed"], r["revenue"]) == latest(other, r["company"], r["seen"])
        assert r["label"] == dict(names).get(r["company"])


def test_asof_join_moves_histories_once_per_key(spark):
    """Wide history rows go to their key and from there to the left rows: no timeline of all asked days carries them."""
    left = spark.createDataFrame([(i, i % 5, day(i)) for i in range(50)], "id int, k int, seen date")
    rows = spark.createDataFrame([(k, day(d), d) for k in range(5) for d in (3, 9, None) if d] + [(1, None, 7)], "k int, on date, v int")
    joined = asof_join(left, [History(rows, "on")], by="k", left_on="seen", attributes=spark.createDataFrame([(k, "x") for k in range(5)], "k int, label string"))
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Union" not in text
    assert sorted((r["id"], r["v"]) for r in joined.collect()) == [(i, 9 if i >= 9 else 3 if i >= 3 else None) for i in range(50)]


def test_latest_row(spark):
    data = [("a", day(1), "x", 1), ("a", day(5), "p", 2), ("a", day(5), "q", 3), ("a", day(9), "z", 4), ("b", day(8), "k", 5), (None, day(1), "n", 6)]
    df = spark.createDataFrame(data, "k string, d date, id string, v int")
    got = {r["k"]: (r["d"], r["id"], r["v"]) for r in latest_row(df, "k", "d", ["id"], not_after=day(6)).collect()}
    assert got == {"a": (day(5), "q", 3)}


def test_global_rank_with_hot_value(spark):
    rng = random.Random(3)
    data = [(i, 0.5 if rng.random() < 0.4 else round(rng.random(), 3)) for i in range(5000)]
    rng.shuffle(data)
    ranked, n = global_rank(spark.createDataFrame(data, "id int, score double").repartition(7), ["score", "id"])
    assert n == 5000
    expected = {i: r for r, (s, i) in enumerate(sorted((s, i) for i, s in data), start=1)}
    assert {r["id"]: r["rank"] for r in ranked.collect()} == expected


def test_global_rank_of_nothing(spark):
    ranked, n = global_rank(spark.createDataFrame([], "id int"), ["id"])
    assert n == 0 and ranked.count() == 0


def test_running_totals(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), i, rng.randrange(10)) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, o int, v bigint")
    got = {(r["g"], r["o"]): (r["cum_v"], r["all_v"]) for r in running_totals(ordered_ranges(df, ["g"], ["o"]), ["g"], ["o"], ["v"]).collect()}
    pdf = pd.DataFrame(data, columns=["g", "o", "v"]).sort_values("o")
    pdf["cum"], pdf["all"] = pdf.groupby("g").v.cumsum(), pdf.groupby("g").v.transform("sum")
    assert got == {(r.g, r.o): (r.cum, r["all"]) for _, r in pdf.iterrows()}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = np.where(rng.random(n) < 0.4, 1.0, np.round(rng.normal(size=n), 2))
    df = spark.createDataFrame([(float(v), float(-v)) for v in x] + [(None, None)], "x double, y double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = column_quantiles(df, ["x", "y"], qs)
    for q in qs:
        assert got["x"][q] == pytest.approx(np.quantile(x, q), abs=1e-12)
        assert got["y"][q] == pytest.approx(np.quantile(-x, q), abs=1e-12)


def test_quantiles_depending_on_distinct_values(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(20)] + [("b", 1.0), ("b", 2.0)], "g string, v double")
    def cuts(distinct):
        bins = F.least(distinct, F.lit(4))
        return [F.when(bins >= i, F.lit(i) / bins) for i in range(5)]
    got = {}
    for r in quantiles(df, ["g"], "v", cuts).collect():
        got.setdefault(r["g"], []).append(r["quantile"])
    assert sorted(got["a"]) == pytest.approx(np.quantile(range(20), [0, 0.25, 0.5, 0.75, 1]))
    assert sorted(got["b"]) == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("n, q", [(117, 5), (41, 5), (2347, 10), (10, 5), (3, 5), (2, 10), (100, 10)])
def test_rank_bins_match_quantile_cuts_of_ranks(spark, n, q):
    ends = last_ranks(n, q)
    got = [1 + sum(end < rank for end in ends) for rank in range(1, n + 1)]
    ranks = pd.Series(range(1, n + 1), dtype=float)
    assert got == list(pd.qcut(ranks, q=min(q, n), labels=False) + 1)


@pytest.mark.parametrize("hot_share", [0.0, 0.35, 1.0])
def test_time_split_brute_force(spark, hot_share):
    rng = random.Random(11)
    data = [(i, day(50) if rng.random() < hot_share else day(rng.randrange(100)), rng.randrange(2)) for i in range(1237)]
    df = spark.createDataFrame(data + [(9001, None, 1), (9002, day(1), None)], "facility_id int, d date, y int").repartition(5)
    got = {r["facility_id"]: r["split"] for r in time_split(df, "d", "y").collect()}
    ordered = [i for _, i in sorted((d, i) for i, d, _ in data)]
    a, b = int(1237 * 0.7), int(1237 * (0.7 + 0.15))
    assert got == {**dict.fromkeys(ordered[:a], "train"), **dict.fromkeys(ordered[a:b], "valid"), **dict.fromkeys(ordered[b:], "oot")}


def test_split_of_daily_rows(spark):
    df = spark.createDataFrame([(i, day(i), i % 2) for i in range(100)], "facility_id int, observation_date date, target_default_12m int")
    summary = {r["split"]: r for r in split_summary(time_split(df), "observation_date", "target_default_12m").collect()}
    assert [summary[s]["rows"] for s in ("train", "valid", "oot")] == [70, 15, 15]
    assert summary["train"]["max_date"] < summary["valid"]["min_date"] < summary["valid"]["max_date"] < summary["oot"]["min_date"]


def test_earliest_rows(spark):
    df = spark.createDataFrame([(i, day(i % 3)) for i in range(9)], "facility_id int, d date")
    assert [r["facility_id"] for r in earliest_rows(df, "d", 4).collect()] == [0, 3, 6, 1]
    assert earliest_rows(df, "d", None) is df
    with pytest.raises(ValueError):
        earliest_rows(df, "d", 0)


def test_bracketed_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BRACKET_ACCURACY", 100)
    rows = [(float(i * 7919 % 5003), float(i % 3), None if i % 2 else 1.5, None) for i in range(5003)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    fractions = [0.0, 0.1, 0.25, 0.5, 0.777, 1.0]
    brackets = ordering.quantile_brackets(df, ["a", "b", "c", "d"], fractions)
    assert len(brackets["a"]) == 6 and brackets["d"] == []
    got = ordering.column_quantiles(df, ["a", "b", "c", "d"], fractions)
    for i, c in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c] == pytest.approx({q: float(np.quantile(values, q)) for q in fractions})
    assert got["d"] == {}
    with pytest.raises(ValueError):
        ordering.quantiles(df, [], "a", fractions)


def selected(values, ranks, spark, kind="double"):
    return select_ranks(spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(5), "v", ranks)


@pytest.mark.parametrize("shape", ["normal", "wide", "few", "one", "tiny", "huge", "longs"])
def test_selected_ranks_equal_sorting(spark, shape):
    rng = np.random.default_rng(4)
    values = {
        "normal": lambda: rng.normal(size=3000).tolist(), "wide": lambda: (10.0 ** rng.uniform(-300, 300, 2000)).tolist() + [0.0, -1e308, 1.7e308],
        "few": lambda: rng.integers(0, 4, 2000).astype(float).tolist(), "one": lambda: [2.5] * 50 + [None] * 9, "tiny": lambda: [5e-324 * k for k in range(9)],
        "huge": lambda: [-1.7e308, 1.7e308, 1.0], "longs": lambda: [2**62 + int(x) for x in rng.integers(0, 5000, 1000)] + [-(2**62), 2**62 + 1],
    }[shape]()
    known = sorted(v for v in values if v is not None)
    ranks = sorted({1, 2, len(known) // 3 or 1, len(known) // 2 or 1, len(known) - 1 or 1, len(known)})
    for b in selected(values, ranks, spark, "bigint" if shape == "longs" else "double"):
        assert b.value == known[b.rank - 1]
        assert (b.before, b.ties) == (sum(v < b.value for v in known), known.count(b.value))


def test_rows_are_counted_and_never_moved(spark):
    """A third of all rows in one score; bins cut inside it are settled on keys; nothing is dealt to ranges."""
    draw = random.Random(9)
    rows = [(i, 0.5 if i % 3 == 0 else round(draw.random(), 3), f"k{i:05}") for i in range(2000)] + [(5000 + i, None, "x") for i in range(3)]
    df = spark.createDataFrame(rows, "facility_id bigint, score double, name string").repartition(6)
    for tie in ("facility_id", "name"):
        binned = with_rank_bins(df, "score", "bin", 10, tie)
        plan = binned._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Sort" not in plan
        frame = pd.DataFrame(rows, columns=["facility_id", "score", "name"]).dropna().sort_values(["score", tie]).reset_index(drop=True)
        wanted = dict(zip(frame["facility_id"], pd.qcut(pd.Series(range(1, 2001), dtype=float), q=10, labels=False) + 1))
        assert {r["facility_id"]: r["bin"] for r in binned.filter("score is not null").collect()} == wanted
    assert selected([], [1], spark) == []
