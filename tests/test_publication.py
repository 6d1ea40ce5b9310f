"""Publication: readers see whole versions, a job that dies leaves the old one, bucketed marts join in place."""

import pytest
from pyspark.sql import functions as F

from lossledger.operators import marts
from lossledger.sources import publication
from lossledger.sources.portfolio import REPORTING_DATE, Portfolio

SMALL = "/root/testdata/sf0.001"


def numbers(spark, n, sign=1):
    return spark.range(n).select(F.col("id").alias("facility_id"), (sign * F.col("id")).cast("double").alias("v"), (F.col("id") % 3).alias("day"))


@pytest.mark.parametrize("layout", [{}, {"bucket_by": ["facility_id"], "buckets": 4}, {"partition_by": ["day"]}, {"bucket_by": ["facility_id"], "buckets": 3, "partition_by": ["day"]}])
def test_versions_replace_each_other_whole(spark, tmp_path, layout):
    root = f"{tmp_path}/mart"
    with pytest.raises(FileNotFoundError):
        publication.read_published(spark, root)
    first = publication.publish(numbers(spark, 10), root, **layout)
    assert first.count() == 10
    second = publication.publish(numbers(spark, 20, -1), root, **layout)
    assert second.agg(F.min("v")).first()[0] == -19
    assert first.count() == 10  # one that was opened before
    if layout.get("bucket_by"):  # a session that has not seen the table
        name = publication._table_name(root, publication.manifest_of(spark, root).version)
        spark.sql(f"DROP TABLE {name}")
        assert publication.read_published(spark, root).agg(F.count(F.lit(1)), F.min("v")).first() == (20, -19.0)
    # A table may be made from its own former version.
    third = publication.publish(publication.read_published(spark, root).filter("facility_id < 7"), root, **layout)
    assert third.count() == 7 and second.count() == 20
    versions = [p.name for p in (tmp_path / "mart" / "versions").iterdir()]
    assert sorted(versions) == sorted(publication.manifest_of(spark, root).history) and len(versions) == publication.KEPT


@pytest.mark.parametrize("layout", [{}, {"bucket_by": ["facility_id"], "buckets": 4}])
def test_a_job_that_dies_leaves_the_old_mart(spark, tmp_path, monkeypatch, layout):
    root = f"{tmp_path}/mart"
    publication.publish(numbers(spark, 10), root, **layout)
    broken = numbers(spark, 1000).withColumn("v", F.when(F.col("facility_id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        publication.publish(broken, root, **layout)
    assert publication.read_published(spark, root).count() == 10

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(publication, "_switch", killed)
    with pytest.raises(KeyboardInterrupt):
        publication.publish(numbers(spark, 50), root, **layout)
    monkeypatch.undo()
    assert publication.read_published(spark, root).count() == 10
    assert publication.publish(numbers(spark, 5), root, **layout).count() == 5


def lines_above(text, scan):
    """Operators above a scan, up to the first join."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
            if "Join" in line:
                break
    return above


def test_staging_joins_its_bucketed_mart_in_place(spark, tmp_path):
    raw = Portfolio(spark, SMALL).raw()
    mart = publication.publish(marts.ratio_mart(raw), f"{tmp_path}/ratio", ["facility_id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sample = marts.staging_sample(mart, raw["rating_history"], raw["payments"], REPORTING_DATE)
        text = sample._jdf.queryExecution().executedPlan().toString()
        above = lines_above(text, "Bucketed: true")
        assert above and "Join" in above[-1] and not any("Exchange" in line for line in above)
        assert sample.count() == mart.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
