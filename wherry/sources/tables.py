"""Reading and writing: Parquet tables, NDJSON landings, streams, and replace/append copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of an event landing, as JSON paths bind them; unknown fields are ignored.
EVENT_LANDING = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; timestamps without a zone are read as they stand and treated as UTC."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType = EVENT_LANDING) -> DataFrame:
    """One JSON object a line, with a declared schema: a missing field is null, a broken line is a row of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def stream_ndjson(spark: SparkSession, path: str, schema: T.StructType = EVENT_LANDING, files: int = 100) -> DataFrame:
    """A stream of the NDJSON files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream of a Parquet folder, or of one file by its name in its folder."""
    reader = spark.readStream.schema(schema)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isFile():
        return reader.option("pathGlobFilter", target.getName()).parquet(target.getParent().toString())
    return reader.parquet(path)


def copy_append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def copy_replace(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table, or with partition_by only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def literal_rows(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """A policy table from literals."""
    return spark.createDataFrame(list(rows), schema)


def micros(column: str | Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without a zone."""
    return F.unix_micros(F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp"))
