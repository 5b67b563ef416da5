"""Identity resolution: facts with identifiers become profiles by shared identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.operators.components import connected_components
from wherry.operators.versions import collapse

#: Which kind of identifier names a profile, best first.
WINNER_ORDER = ("email", "canonical_email", "user_id", "anonymous_id", "phone")


def star_edges(evidence: DataFrame, fact: str = "fact", key: str = "key") -> DataFrame:
    """The smallest key of each fact with each other key of it: n - 1 edges for n keys."""
    distinct = evidence.select(fact, key).distinct()
    hub = distinct.groupBy(fact).agg(F.min(key).alias("v"))
    return distinct.join(hub, fact).filter(F.col(key) != F.col("v")).select(F.col(key).alias("u"), "v").distinct()


def components(evidence: DataFrame, fact: str = "fact", key: str = "key") -> DataFrame:
    """(key, component) for every key; a key that no fact links is a component of its own."""
    found = connected_components(star_edges(evidence, fact, key)).withColumnRenamed("node", key)
    alone = evidence.select(key).filter(F.col(key).isNotNull()).distinct().join(found, key, "left_anti").withColumn("component", F.col(key))
    return found.unionByName(alone)


def priority(kind: Column, order: tuple[str, ...] = WINNER_ORDER) -> Column:
    ranks = F.create_map(*[x for k, name in enumerate(order) for x in (F.lit(name), F.lit(k))])
    return F.coalesce(ranks[kind], F.lit(len(order)))


def profiles(evidence: DataFrame, labels: DataFrame, order: tuple[str, ...] = WINNER_ORDER) -> DataFrame:
    """(component, winner, profile_id, n_facts): the winner is the best kind, then the first seen (never seen last), then the least value."""
    rows = evidence.join(labels, "key")
    rank = F.struct(priority(F.split_part("key", F.lit(":"), F.lit(1)), order), F.col("seen_at").isNull(), F.col("seen_at"), F.col("key"))
    named = rows.groupBy("component").agg(F.min_by("key", rank).alias("winner"), F.countDistinct("fact").alias("n_facts"))
    return named.withColumn("profile_id", F.md5("winner"))


#: A request names at most so many identifiers; what goes beyond is an error.
MOST_KEYS = 5


def resolve(requests: DataFrame, mapping: DataFrame, most: int | None = None) -> DataFrame:
    """One row per request (request_id, keys in falling preference): the profile of its best known key, null if none is known.

    With `version` among its columns, mapping is first reduced to the latest version of each key; tombstones (`is_deleted`) then know nothing.
    With `most`, a request of more keys is an error.
    """
    if "version" in mapping.columns:
        mapping = collapse(mapping, ["key"], [F.col("version").desc(), F.col("profile_id").asc_nulls_last()]).select("key", "profile_id")
    keys = F.col("keys")
    if most is not None:
        keys = F.when(F.size("keys") <= most, keys).otherwise(F.raise_error(F.lit(f"a request of more than {most} identifiers")).cast("array<string>"))
    each = requests.select("request_id", F.posexplode_outer(keys).alias("at", "key"))
    hit = each.join(mapping, "key", "left").withColumn("_order", F.struct(F.col("profile_id").isNull(), "at"))
    best = hit.withColumn("_n", F.row_number().over(Window.partitionBy("request_id").orderBy("_order"))).filter("_n = 1")
    return best.select("request_id", F.when(F.col("profile_id").isNotNull(), F.col("key")).alias("matched_key"), "profile_id")
