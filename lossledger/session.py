"""Session settings and the shared work folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# The Java VM never compiles a method beyond 8,000 bytes, so a stage of many columns is interpreted row by row. Below this
# limit Spark generates small methods per operator instead.
METHOD_SETTING, METHOD_BYTES, SPARKS_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000", "65535"


def limit_generated_methods(spark: SparkSession) -> None:
    """Keep generated methods within what the Java VM compiles, unless the session names a limit of its own."""
    if spark.conf.get(METHOD_SETTING, SPARKS_METHOD_BYTES) == SPARKS_METHOD_BYTES:
        spark.conf.set(METHOD_SETTING, METHOD_BYTES)


def build_session(app_name: str = "lossledger", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on; `settings` override (dots as double underscores)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Hash instead of sort where every shuffled build partition is this small at run time.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        # Call-site capture costs several JVM calls per column operator.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(METHOD_SETTING, METHOD_BYTES)
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configured_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder the cluster names, if any."""
    context = spark.sparkContext
    return (
        spark.conf.get(CHECKPOINT_SETTING, None)
        or context.getConf().get(CHECKPOINT_SETTING)
        or context.getCheckpointDir()
    )


def work_dir(spark: SparkSession) -> str:
    """A folder that all executors share: the configured one. A session inside one process may do without; it gets one
    of its own then, as all its executors are there."""
    folder = configured_dir(spark)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lossledger-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under `work_dir` that nobody uses; it goes when the application ends."""
    path = f"{work_dir(spark)}/lossledger/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """`df` computed once, where several jobs read the same rows.

    With a configured shared folder it becomes a Parquet table there, which goes when the application ends.
    Without one Spark keeps the rows in its own storage; what an executor loses there is computed again. No folder
    of the machine is ever used.
    """
    spark = df.sparkSession
    folder = configured_dir(spark)
    if not folder:
        return df.persist()
    path = f"{folder.rstrip('/')}/lossledger/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also if it is not installed there and the
    driver runs in another folder. On a cluster it is installed or shipped with --py-files."""
    root, variables = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in variables.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        variables["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    share_package(df.sparkSession)
    return df.mapInArrow(run, schema)
