"""Published tables: each write goes to a folder of its own, and one small file says which folder is current.

A reader opens the manifest and then that folder, so it sees the old table or the new one, never half of either. A job
that dies while it writes leaves the manifest as it was. Tables may be bucketed: the manifest keeps the bucket columns,
and a reader gets a catalog table whose joins on them need no exchange on its side.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

MANIFEST, VERSIONS = "CURRENT.json", "versions"
#: The current version and those before it that stay, for readers that opened them.
KEPT = 2


@dataclass(frozen=True)
class Manifest:
    """`version` is a folder under VERSIONS; `history` has the versions that stay, the newest first."""

    version: str
    schema: str
    bucket_by: list[str] = field(default_factory=list)
    buckets: int = 0
    partition_by: list[str] = field(default_factory=list)
    history: list[str] = field(default_factory=list)


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest_of(spark: SparkSession, root: str) -> Manifest | None:
    """What is current; None where nothing was ever published."""
    path, system = _path(spark, f"{root}/{MANIFEST}")
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _switch(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Replace the manifest in one rename: it is written beside the old one first."""
    beside = f"{root}/.{MANIFEST}.{uuid.uuid4().hex}"
    written, system = _path(spark, beside)
    stream = system.create(written, True)
    try:
        stream.write(bytearray(json.dumps(asdict(manifest)).encode()))
    finally:
        stream.close()
    current, _ = _path(spark, f"{root}/{MANIFEST}")
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = system.makeQualified(current)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(written), qualified, options)


def _table_name(root: str, version: str) -> str:
    return f"published_{re.sub('[^a-z0-9]+', '_', root.lower())[-60:]}_{version}"


def _register(spark: SparkSession, root: str, manifest: Manifest) -> str:
    """A catalog table over a bucketed version; the catalog may be the session's own."""
    name = _table_name(root, manifest.version)
    keys = ", ".join(f"`{c}`" for c in manifest.bucket_by)
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in manifest.partition_by)})" if manifest.partition_by else ""
    location = f"{root}/{VERSIONS}/{manifest.version}".replace("'", "\\'")
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({manifest.schema}) USING parquet{parted} CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {manifest.buckets} BUCKETS LOCATION '{location}'"
        )
        if manifest.partition_by:
            spark.catalog.recoverPartitions(name)
    return name


def publish(
    df: DataFrame, root: str, bucket_by: Sequence[str] = (), buckets: int | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write `df` as the new version of `root`, make it current, and read it back.

    There are at least as many buckets as shuffle partitions: with fewer, Spark would rather shuffle both sides of a
    join than leave this one in place. Rows go to their bucket before the write, so a bucket is one file.
    """
    spark = df.sparkSession
    before = manifest_of(spark, root)
    version = uuid.uuid4().hex
    location = f"{root}/{VERSIONS}/{version}"
    # A catalog table has its partition columns last.
    fields = sorted(df.schema.fields, key=lambda f: f.name in partition_by)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    count = 0
    if bucket_by:
        count = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
        name = _table_name(root, version)
        writer = df.repartition(count, *bucket_by).write.partitionBy(*partition_by).bucketBy(count, *bucket_by).sortBy(*bucket_by)
        try:
            writer.option("path", location).format("parquet").saveAsTable(name)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            raise
    else:
        df.write.partitionBy(*partition_by).parquet(location)
    kept = [version, *(before.history if before else [])]
    _switch(spark, root, Manifest(version, schema, list(bucket_by), count, list(partition_by), kept[:KEPT]))
    for old in kept[KEPT:]:
        path, system = _path(spark, f"{root}/{VERSIONS}/{old}")
        system.delete(path, True)
    return read_published(spark, root)


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The current version. It stays readable while the next one is written and becomes current."""
    manifest = manifest_of(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    if manifest.bucket_by:
        return spark.table(_register(spark, root, manifest))
    return spark.read.parquet(f"{root}/{VERSIONS}/{manifest.version}")
