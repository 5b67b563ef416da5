"""Multi-touch attribution: first, last and 40/20/40 credit, with paid variants that keep their weight.

A profile's touches are ordered by time and id. Direct touches count only in first place, so the positions of a profile are the
same for all its conversions, and a conversion's journey is a prefix of them: its first n positions. Credits then
need no touch-by-conversion pairs: conversions are summed by (profile, n) and each touch takes, of those sums,
first if it is in first place, last where n is its place, and a middle share where n is greater.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.functions.calendar import weighted

PAID_MEDIUMS = ("cpc", "paid", "paid_social")
PAID_SOURCES = ("google", "meta")
MODELS = ("first", "last", "multi", "first_paid", "last_paid", "multi_paid")


def is_direct() -> Column:
    return F.coalesce(F.col("source"), F.lit("direct")) == "direct"


def is_paid() -> Column:
    paid = F.col("source").isin(*PAID_SOURCES) & F.col("medium").isin(*PAID_MEDIUMS) & F.col("campaign").isNotNull() & F.col("ad").isNotNull()
    return F.coalesce(paid, F.lit(False))


def positions(touches: DataFrame) -> DataFrame:
    """Touches that can have credit (profile, touch_id, touch_time, is_paid, ...) with their place among them."""
    order = Window.partitionBy("profile").orderBy("touch_time", "touch_id")
    counted = touches.withColumn("is_paid", is_paid()).withColumn("_first", F.row_number().over(order) == 1)
    kept = counted.filter(~is_direct() | F.col("_first")).drop("_first")
    return kept.withColumn("place", F.row_number().over(order))


def weight(place: Column, n: Column) -> Column:
    """40/20/40 credit of a place among n; halves for two, all for one."""
    middle = F.lit(0.2) / (n - 2)
    return F.when(n == 1, 1.0).when(n == 2, 0.5).when((place == 1) | (place == n), 0.4).otherwise(middle)


def journeys(touches: DataFrame, conversions: DataFrame) -> DataFrame:
    """One row per conversion and credited touch with the weights of each model; a conversion without touch has one offline row."""
    placed = positions(touches).withColumnRenamed("profile", "_profile")
    near = (F.col("profile") == F.col("_profile")) & (F.col("touch_time") <= F.col("conversion_time"))
    pairs = conversions.join(placed, near, "left").drop("_profile")
    n = F.count("touch_id").over(Window.partitionBy("conversion_id"))
    rows = pairs.withColumn("n_touches", n)
    place = F.col("place")
    offline = F.col("touch_id").isNull()
    one = lambda hit: F.when(offline | hit, 1.0).otherwise(0.0)
    rows = rows.withColumn("first_weight", one(place == 1)).withColumn("last_weight", one(place == F.col("n_touches")))
    rows = rows.withColumn("multi_weight", F.when(offline, 1.0).otherwise(weight(place, F.col("n_touches"))))
    paid = F.coalesce(F.col("is_paid"), F.lit(False))
    return rows.withColumns({f"{m}_paid_weight": F.when(paid, F.col(f"{m}_weight")).otherwise(0.0) for m in ("first", "last", "multi")})


def revenue_split(rows: DataFrame, amount: str = "amount") -> DataFrame:
    """journeys with the amount divided by each model's weight, in exact decimals of nine places."""
    return rows.withColumns({f"{m}_revenue": weighted(F.col(amount), F.col(f"{m}_weight")) for m in MODELS})


def _placed(touches: DataFrame, conversions: DataFrame, measures: list[str]) -> DataFrame:
    """profile, n, touch_id, is_paid and the measures summed: for each place its touch and the conversions that reach no further; n is 0 for those that reach none.

    One union and one exchange on the profile: in order of time, touches before conversions, a running count gives a touch its place
    and a conversion the places it has reached.
    """
    touch_type = touches.schema["touch_id"].dataType
    marks = touches.select("profile", F.col("touch_time").alias("_t"), F.lit(0).alias("_side"), "touch_id", is_paid().alias("is_paid"), is_direct().alias("_direct"), *[F.lit(None).cast("double").alias(m) for m in measures])
    ends = conversions.select("profile", F.col("conversion_time").alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(touch_type).alias("touch_id"), F.lit(None).cast("boolean").alias("is_paid"), F.lit(False).alias("_direct"), *[F.col(m).cast("double").alias(m) for m in measures])
    upto = Window.partitionBy("profile").orderBy("_t", "_side", "touch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = marks.unionByName(ends).withColumn("_seen", F.sum(1 - F.col("_side")).over(upto))
    counts = (F.col("_side") == 0) & (~F.col("_direct") | (F.col("_seen") == 1)) & F.col("profile").isNotNull()
    rows = rows.withColumn("_counts", counts).withColumn("n", F.sum(F.col("_counts").cast("int")).over(upto)).filter("_counts or _side = 1")
    return rows.groupBy("profile", "n").agg(F.max("touch_id").alias("touch_id"), F.max("is_paid").alias("is_paid"), *[F.sum(m).alias(m) for m in measures])


def credits(touches: DataFrame, conversions: DataFrame, measures: list[str]) -> DataFrame:
    """Per touch and measure the credit of all six models, in time linear in touches plus conversions.

    Columns: profile, touch_id, is_paid, and <model>_<measure> for each of MODELS. Conversions without a touch have a row with touch_id null.
    Everything is partitioned by the profile, so there is one exchange; suffix sums give what lies beyond a place.
    """
    placed = _placed(touches, conversions, measures)
    later = Window.partitionBy("profile").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.col("n")
    credited = {}
    for m in measures:
        here = F.coalesce(F.col(m), F.lit(0.0))
        beyond = F.sum(here).over(later) - here
        share = F.when(n > 2, here * 0.2 / (n - 2)).otherwise(0.0)
        middle = F.sum(share).over(later) - share
        two = F.when(n == 1, F.sum(F.when(n == 2, here).otherwise(0.0)).over(later)).otherwise(0.0)
        own = F.when(n <= 1, here).when(n == 2, here * 0.5).otherwise(here * 0.4)
        credited[f"first_{m}"] = F.when(n == 1, here + beyond).when(n == 0, here).otherwise(0.0)
        credited[f"last_{m}"] = here
        credited[f"multi_{m}"] = own + F.when(n == 0, 0.0).when(n == 1, 0.5 * two + 0.4 * (beyond - two)).otherwise(middle)
    paid = {f"{k}_paid_{m}": F.when(F.coalesce("is_paid", F.lit(False)), F.col(f"{k}_{m}")).otherwise(0.0) for m in measures for k in ("first", "last", "multi")}
    rows = placed.withColumns(credited)
    return rows.select("profile", "touch_id", F.coalesce("is_paid", F.lit(False)).alias("is_paid"), *credited, *[c.alias(k) for k, c in paid.items()])
