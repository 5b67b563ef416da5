"""Sessions from a stream: every batch rebuilds its dirty visitors from their whole history.

There is no watermark: a late page changes its visitor's sessions however late it is, and those of the
visitor who had it before, if it comes again under another. Batches append page rows and
then session versions to Parquet folders, each under its batch number, so a batch that runs again replaces
its own output; readers take the latest version of each visitor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.operators.sessions import session_rollup, sessionize
from wherry.operators.versions import latest_by


def rebuild(pages: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream of pages (page_id, visitor, ts) to its end, keeping pages and session versions under path."""
    spark = pages.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/pages/batch_part={number}")
        everything = spark.read.parquet(f"{path}/pages").filter(F.col("batch_part") <= number)
        once = latest_by(everything, ["page_id"], [F.col("batch_part").desc()])
        new = spark.read.parquet(f"{path}/pages/batch_part={number}").select("page_id", "visitor")
        former = everything.filter(F.col("batch_part") < number).join(new.select("page_id").distinct(), "page_id", "left_semi").select("visitor")
        dirty = new.select("visitor").unionByName(former).distinct()
        history = once.join(dirty, "visitor", "left_semi").select("page_id", "visitor", "ts")
        built = session_rollup(sessionize(history))
        empty = dirty.join(built.select("visitor"), "visitor", "left_anti")  # a version without sessions, so that the former one is not read
        built.unionByName(empty, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}/sessions/version={number}")

    started = pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()


def current_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The sessions of each visitor's latest version."""
    rows = spark.read.parquet(f"{path}/sessions")
    newest = rows.groupBy("visitor").agg(F.max("version").alias("version"))
    return rows.join(newest, ["visitor", "version"]).drop("version").filter("session_id is not null")
