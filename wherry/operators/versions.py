"""Current state from versioned rows: latest per key, tombstones, overlays, conflicts, replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order: row_number() = 1, which Spark prunes before the shuffle (window group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def live(df: DataFrame, deleted: str = "is_deleted") -> DataFrame:
    """Rows that are not tombstones; apply it after latest_by, never before."""
    return df.filter(~F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)))


def collapse(df: DataFrame, keys: list[str], order: list[Column], deleted: str = "is_deleted") -> DataFrame:
    """Latest version per key, without the keys whose latest version is a tombstone."""
    return live(latest_by(df, keys, order), deleted)


def overlay(seed: DataFrame, delta: DataFrame, keys: list[str], deleted: str = "is_deleted") -> DataFrame:
    """Delta rows, and seed rows whose key has no delta. A deleted delta row hides the seed row."""
    kept = seed.join(delta.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(live(delta, deleted).select(*seed.columns))


def conflicts(df: DataFrame, keys: list[str], content: str) -> DataFrame:
    """Keys (version included) that carry more than one content."""
    return df.groupBy(*keys).agg(F.countDistinct(content).alias("n_contents")).filter("n_contents > 1")


def without_conflicts(df: DataFrame, keys: list[str], content: str) -> DataFrame:
    """df, or an error that names some keys if one version carries more than one content."""
    found = conflicts(df, keys, content).limit(5).collect()
    if found:
        raise ValueError("different contents under one version: " + ", ".join(str(tuple(r[k] for k in keys)) for r in found))
    return df


def after_last_delete(df: DataFrame, keys: list[str], order: list[str], deleted: str = "is_deleted") -> DataFrame:
    """The latest row after a key's last deletion: a deletion removes until a later observation recreates."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ahead = df.withColumn("_deleted_later", F.max(F.col(deleted).cast("int")).over(w)).filter("_deleted_later = 0").drop("_deleted_later")
    return latest_by(ahead, keys, [F.col(c).desc() for c in order])
