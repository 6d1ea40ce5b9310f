"""Level tables against the string indexer, and a million levels."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lossledger.models import levels
from lossledger.models.preprocessing import PLAIN, fit_preprocessor


def test_one_hot_equals_the_fitted_preparation(spark):
    rows = [("b", "x"), ("a", "y"), ("c", "x"), ("b", "é"), ("Z", "x")]
    train = spark.createDataFrame(rows, "k string, m string")
    other = spark.createDataFrame([("a", "x"), ("new", "é"), ("Z", "y")], train.schema)
    table = levels.level_table(train, ["k", "m"])
    assert levels.sizes(table, ["k", "m", "none"]) == {"k": 4, "m": 3, "none": 0}
    assert [r["level"] for r in table.filter("feature = 'k'").orderBy("position").collect()] == ["Z", "a", "b", "c"]
    hot = levels.one_hot(other, table, ["k", "m"])
    mine = {(r["k"], r["m"]): r["v"] for r in hot.select("k", "m", F.concat(vector_to_array("hot_k"), vector_to_array("hot_m")).alias("v")).collect()}
    fitted = fit_preprocessor(train, [], ["k", "m"]).transform(other)
    assert mine == {(r["k"], r["m"]): r["v"] for r in fitted.select("k", "m", vector_to_array(PLAIN).alias("v")).collect()}
    missing = levels.one_hot(spark.createDataFrame([(None, "x")], train.schema), table, ["k", "m"]).first()
    assert missing["hot_k"].numNonzeros() == 0 and missing["hot_m"].numNonzeros() == 1
    assert levels.level_table(train.limit(0), ["k"]).count() == 0
    assert levels.one_hot(train, levels.level_table(train.limit(0), ["k"]), ["k"]).columns == train.columns


def test_a_million_levels(spark):
    n = 1_000_000
    rows = spark.range(2 * n).select(F.concat(F.lit("id-"), F.lpad((F.col("id") % n).cast("string"), 7, "0")).alias("k"))
    table = levels.level_table(rows, ["k"])
    wrong = table.filter(F.substring("level", 4, 7).cast("int") != F.col("position"))
    found = table.agg(F.count(F.lit(1)), F.max("position"), F.min("levels")).first()
    assert tuple(found) == (n, n - 1, n) and wrong.count() == 0
    hot = levels.one_hot(rows.limit(3), table, ["k"]).first()["hot_k"]
    assert hot.size == n and hot.numNonzeros() == 1
