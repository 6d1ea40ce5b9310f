"""Totals of equal items are equal in whatever order the items come."""

from itertools import permutations

from pyspark.sql import functions as F

from lossledger.functions.numeric import settled_total
from lossledger.operators.rollups import collateral_rollup, recovery_rollup

AMOUNTS = [0.1, 0.2, 0.3, 10.7]


def test_totals_do_not_depend_on_the_order_of_items(spark):
    rows = [(k, "real_estate", v, 0.3) for k, order in enumerate(permutations(AMOUNTS)) for v in order]
    items = spark.createDataFrame(rows, "facility_id bigint, collateral_type string, collateral_value double, haircut double").coalesce(1)
    totals = collateral_rollup(items).select("collateral_value", "avg_collateral_haircut", "effective_collateral_value").distinct().collect()
    assert len(totals) == 1 and abs(totals[0]["collateral_value"] - 11.3) < 1e-12 and abs(totals[0]["effective_collateral_value"] - 7.91) < 1e-12
    paid = items.select("facility_id", F.col("collateral_value").alias("recovery_amount"), F.col("haircut").alias("collection_cost"))
    assert recovery_rollup(paid).select("total_recovery_amount", "total_collection_cost").distinct().count() == 1


def test_odd_numbers_keep_their_sum(spark):
    odd = spark.createDataFrame([(1, 1e300), (1, -1.5), (2, float("inf")), (2, 2.5), (3, None)], "k int, v double")
    found = {r["k"]: r["t"] for r in odd.groupBy("k").agg(settled_total(F.col("v")).alias("t")).collect()}
    assert found == {1: 1e300, 2: float("inf"), 3: None}


def test_collateral_moves_once(spark):
    """One exchange by facility, whatever the number of types; items without type, value or haircut keep their share."""
    rows = [
        (1, "equipment", 10.0, 0.5), (1, "real_estate", 20.0, 0.25), (1, "equipment", None, 0.75), (1, None, 4.0, None),
        (2, None, None, None),
    ]
    items = spark.createDataFrame(rows, "facility_id bigint, collateral_type string, collateral_value double, haircut double")
    rolled = collateral_rollup(items.repartition(4))
    assert rolled._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(facility_id") == 1
    assert {r["facility_id"]: tuple(r)[1:] for r in rolled.collect()} == {1: ("real_estate", 34.0, 0.5, 20.0), 2: (None,) * 4}
