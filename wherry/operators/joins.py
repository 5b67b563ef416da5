"""Joins that Spark has no keyword for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def left_any(left: DataFrame, right: DataFrame, on: list[str], prefer: list[Column]) -> DataFrame:
    """A left join with at most one match: the first row of each key on the right in the order `prefer`."""
    w = Window.partitionBy(*on).orderBy(*prefer)
    one = right.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
    return left.join(one, on, "left")


def null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    """A join condition under which null keys match each other."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in on])


def full_on(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """A full join on null-safe keys with the keys coalesced, and has_left / has_right as markers."""
    a, b = left.withColumn("has_left", F.lit(1)).alias("a"), right.withColumn("has_right", F.lit(1)).alias("b")
    condition = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on])
    keys = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in on]
    rest = [F.col(f"a.{c}") for c in left.columns if c not in on] + [F.col(f"b.{c}") for c in right.columns if c not in on]
    marks = [F.coalesce(F.col(m), F.lit(0)).alias(m) for m in ("has_left", "has_right")]
    return a.join(b, condition, "full").select(*keys, *rest, *marks)


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, columns: list[str], tie: str) -> DataFrame:
    """Each left row with `columns` of the latest right row of its key at or before its time (null if none, or if a part of its key is null).

    One union and one window: no row is paired with every earlier one. Rows without a key go past the window.
    """
    keyed = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in by])
    payload = F.struct(*[F.col(c) for c in columns])
    empty = F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType)
    a = left.select(*by, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), empty.alias("_p"), F.struct("*").alias("_l"))
    nothing = F.lit(None).cast(left.select(F.struct("*").alias("l")).schema["l"].dataType)
    b = right.filter(keyed).select(*by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_p"), nothing.alias("_l"))
    w = Window.partitionBy(*by).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = a.filter(keyed).unionByName(b).withColumn("_p", F.last("_p", ignorenulls=True).over(w)).filter("_side = 1").unionByName(a.filter(~keyed))
    return met.select("_l.*", *[F.col(f"_p.{c}").alias(c) for c in columns])


def policy_join(df: DataFrame, policy: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows with every policy row (that meets the condition); the policy table is checked to be small before it is sent."""
    n = policy.limit(BROADCAST_ROWS + 1).count()
    if n > BROADCAST_ROWS:
        raise ValueError(f"a policy table of more than {BROADCAST_ROWS} rows")
    small = F.broadcast(policy)
    return df.crossJoin(small) if condition is None else df.join(small, condition)


def page_after(df: DataFrame, keys: list[str], cursor: tuple | None, size: int) -> DataFrame:
    """A keyset page: the first `size` rows after the cursor, by keys."""
    if cursor is not None:
        after = F.struct(*[F.lit(x).cast(df.schema[k].dataType).alias(k) for k, x in zip(keys, cursor)])
        df = df.filter(F.struct(*keys) > after)
    return df.orderBy(*keys).limit(size)
