"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is a partial aggregation (the smallest neighbour of a node) and an equi-join back, so hub nodes are
summed map-side and skewed joins can be split by AQE. Rounds are cut by Parquet tables in the shared folder:
a lost executor costs the round in progress only. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.session import discard, materialize

MAX_ROUNDS = 500


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Edges with a null end or equal ends are dropped. Repeated edges count once. An empty table gives an empty result.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null and a <> b")
    clean = ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current, path = materialize(clean.distinct(), "edges")
    state = _state(current)
    for _ in range(MAX_ROUNDS):
        following, next_path = materialize(_small_star(_large_star(current)), "edges")
        next_state = _state(following)
        discard(spark, path)
        current, path = following, next_path
        if next_state == state:
            break
        state = next_state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
