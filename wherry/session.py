"""Session builder and the shared-folder helpers that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wherry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and ANSI mode; any setting can be overridden by keyword (dots as __)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors share. Where none is named, a local session gets a temporary one; on a cluster that is an error."""
    jsc = spark.sparkContext._jsc.sc()
    found = jsc.getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("no shared folder: set spark.checkpoint.dir to one that the driver and all executors can reach")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="wherry-checkpoint-"))
    return jsc.getCheckpointDir().get()


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialize(df: DataFrame, label: str = "stage") -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and reread it: lineage ends there, and any executor can read it.

    The folder goes when the application ends; `discard` removes it earlier.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    target, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that `materialize` wrote."""
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)
