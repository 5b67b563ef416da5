"""Version collapse, tombstones, overlays and checks over orders as a versioned feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wherry.operators.versions import after_last_delete, collapse, conflicts, latest_by, overlay
from wherry.plans.registry import query
from wherry.sources.tables import load


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of orders from two sources: the first load, price changes of open orders, removals of low-priority ones and their return."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), "o_orderstatus", "o_orderpriority")
    row = lambda df, source, version, deleted, price: df.select("key", F.lit(source).alias("source"), F.lit(version).cast("bigint").alias("version"), F.lit(deleted).alias("is_deleted"), price.alias("price"))
    price = F.col("price")
    return (
        row(o, "export", 1, 0, price)
        .unionByName(row(o.filter("o_orderstatus = 'O'"), "export", 2, 0, F.round(price * 1.1 + 1e-6, 2)))
        .unionByName(row(o.filter("o_orderpriority = '5-LOW'"), "export", 3, 1, price))
        .unionByName(row(o.filter("o_orderpriority = '5-LOW' and o_orderstatus = 'F'"), "export", 4, 0, price))
        .unionByName(row(o.filter("o_orderpriority = '1-URGENT'"), "live", 1, 0, price + 1))
        .unionByName(row(o.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'"), "live", 2, 1, price))
    )


_FEED_SQL = """feed AS (
  SELECT o_orderkey AS key, 'export' AS source, 1 AS version, 0 AS is_deleted, o_totalprice AS price FROM orders
  UNION ALL SELECT o_orderkey, 'export', 2, 0, round(o_totalprice * 1.1 + 1e-6, 2) FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, 'export', 3, 1, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT o_orderkey, 'export', 4, 0, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'live', 1, 0, o_totalprice + 1 FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'live', 2, 1, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""


@query(f"WITH {_FEED_SQL} SELECT key, source, CAST(version AS BIGINT) AS version, price FROM (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY key ORDER BY CASE source WHEN 'live' THEN 0 ELSE 1 END, version DESC) = 1) WHERE is_deleted = 0")
def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best source goes first, then the highest version; a tombstone that wins hides what it outranks."""
    order = [F.when(F.col("source") == "live", 0).otherwise(1).asc(), F.col("version").desc()]
    return collapse(feed(spark, sf_dir), ["key"], order).drop("is_deleted")


@query(f"WITH {_FEED_SQL}, cut AS (SELECT key, source, coalesce(max(version) FILTER (WHERE is_deleted = 1), 0) AS v FROM feed GROUP BY ALL) SELECT f.key, f.source, CAST(f.version AS BIGINT) AS version, price FROM feed f JOIN cut c ON c.key = f.key AND c.source = f.source AND f.version > c.v QUALIFY row_number() OVER (PARTITION BY f.key, f.source ORDER BY f.version DESC) = 1")
def delete_and_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return after_last_delete(feed(spark, sf_dir), ["key", "source"], ["version"]).drop("is_deleted")


@query(f"""WITH {_FEED_SQL}, seed AS (SELECT key, price FROM feed WHERE source = 'export' AND version = 1), delta AS (SELECT key, price, is_deleted FROM feed WHERE source = 'live' QUALIFY row_number() OVER (PARTITION BY key ORDER BY version DESC) = 1)
  SELECT key, price FROM seed WHERE key NOT IN (SELECT key FROM delta) UNION ALL SELECT key, price FROM delta WHERE is_deleted = 0""")
def seed_delta_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed(spark, sf_dir)
    delta = latest_by(rows.filter("source = 'live'"), ["key"], [F.col("version").desc()])
    return overlay(rows.filter("source = 'export' and version = 1").select("key", "price"), delta.select("key", "price", "is_deleted"), ["key"])


@query(f"WITH {_FEED_SQL} SELECT key, CAST(version AS BIGINT) AS version, count(DISTINCT md5(CAST(round(price * 100) AS BIGINT)::VARCHAR)) AS n_contents FROM feed GROUP BY key, version HAVING count(DISTINCT md5(CAST(round(price * 100) AS BIGINT)::VARCHAR)) > 1")
def version_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose sources disagree about one version."""
    hashed = feed(spark, sf_dir).withColumn("hash", F.md5(F.round(F.col("price") * 100).cast("bigint").cast("string")))
    return conflicts(hashed, ["key", "version"], "hash")


_DELIVERY_SQL = "delivery AS (SELECT l_suppkey AS producer, l_orderkey AS sequence, l_partkey AS event, md5(l_partkey || '|' || l_quantity::BIGINT) AS payload FROM lineitem)"


@query(f"""WITH {_DELIVERY_SQL}, one AS (SELECT producer, sequence, count(*) AS n, count(DISTINCT event) AS events, count(DISTINCT payload) AS payloads FROM delivery GROUP BY ALL),
  g AS (SELECT *, sequence - lag(sequence) OVER (PARTITION BY producer ORDER BY sequence) AS step FROM one)
  SELECT producer, count(*) AS n_sequences, count(*) FILTER (WHERE step > 1) AS n_gaps, CAST(sum(n - payloads) AS BIGINT) AS n_replays, count(*) FILTER (WHERE events > 1) AS n_reused FROM g GROUP BY 1""")
def delivery_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps, exact replays and reused sequence numbers per producer."""
    payload = F.md5(F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string")))
    one = load(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("producer"), F.col("l_orderkey").alias("sequence")).agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("events"), F.countDistinct(payload).alias("payloads"))
    stepped = one.withColumn("step", F.col("sequence") - F.lag("sequence").over(Window.partitionBy("producer").orderBy("sequence")))
    return stepped.groupBy("producer").agg(F.count("*").alias("n_sequences"), F.count_if(F.col("step") > 1).alias("n_gaps"), F.sum(F.col("n") - F.col("payloads")).alias("n_replays"), F.count_if(F.col("events") > 1).alias("n_reused"))


@query(f"WITH {_DELIVERY_SQL} SELECT producer, sequence, min(event) AS event FROM (SELECT DISTINCT * FROM delivery) GROUP BY ALL")
def idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed batches give each stage key once."""
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("producer"), F.col("l_orderkey").alias("sequence"), F.col("l_partkey").alias("event"))
    return rows.unionByName(rows).dropDuplicates().groupBy("producer", "sequence").agg(F.min("event").alias("event"))
