"""Aggregation and windows, one query for each kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wherry.functions.calendar import net_price, ratio
from wherry.operators.versions import latest_by
from wherry.plans.registry import query
from wherry.sources.tables import load


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS sum_disc,
          round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def group_by_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"),
        F.round(F.sum(net_price()), 2).cast("double").alias("sum_disc"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n"),
    )


@query("""SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END * o_totalprice), 2) AS urgent_spend FROM orders GROUP BY 1""")
def conditional_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT").cast("int") * F.col("o_totalprice")
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_done"), F.round(F.sum(urgent), 2).alias("urgent_spend"))


@query("""SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY 1""")
def distinct_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))
    return load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct(returned).alias("n_returned"))


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'click') AS last_click, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY 1""")
def arg_max_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "events").createOrReplaceTempView("wherry_events")
    return spark.sql("SELECT user_id, max_by(event_id, struct(ts, event_id)) FILTER (WHERE event_type = 'click') AS last_click, min_by(event_type, struct(ts, event_id)) AS first_type FROM wherry_events GROUP BY user_id")


@query("""SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS priorities, list_sort(list(o_orderkey)) AS keys FROM orders GROUP BY 1""")
def sorted_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"), F.array_sort(F.collect_list("o_orderkey")).alias("keys"))


@query("""SELECT o_custkey, sha256(array_to_string(list_sort(list(md5(o_orderkey || '|' || o_orderstatus))), ',')) AS digest FROM orders GROUP BY 1""")
def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.md5(F.concat_ws("|", "o_orderkey", "o_orderstatus"))
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), ","), 256).alias("digest"))


@query("SELECT user_id, count(DISTINCT event_type) AS n_types FROM events GROUP BY 1 HAVING count(DISTINCT event_type) = 5")
def having_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy("user_id").agg(F.countDistinct("event_type").alias("n_types")).filter("n_types = 5")


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS largest FROM orders GROUP BY 1""")
def mergeable_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily partial states, merged to months: counts, sums and maxima merge; they cannot take a correction back."""
    day = F.col("o_orderdate").cast("date").alias("day")
    states = load(spark, sf_dir, "orders").groupBy(day).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("largest"))
    return states.groupBy(F.trunc("day", "month").alias("month")).agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), F.max("largest").alias("largest"))


@query("SELECT event_type, count(DISTINCT user_id) AS reach, 'type' AS level FROM events GROUP BY 1 UNION ALL SELECT '*', count(DISTINCT user_id), 'all' FROM events")
def reach_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reach is counted at each level and never summed across levels."""
    events = load(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    each = events.groupBy("event_type").agg(F.count("user_id").alias("reach"), F.lit("type").alias("level"))
    whole = events.agg(F.lit("*").alias("event_type"), F.countDistinct("user_id").alias("reach"), F.lit("all").alias("level"))
    return each.unionByName(whole.select("event_type", "reach", "level"))


@query("SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(load(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts ASC NULLS FIRST, event_id) = 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(load(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts").asc_nulls_first(), F.col("event_id").asc()])


@query("""SELECT event_id, lag(event_id) OVER w AS earlier, count(*) FILTER (WHERE event_type = 'click') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS clicks,
          count(*) OVER (PARTITION BY user_id) AS n_user, min(ts) OVER (PARTITION BY user_id) AS first_ts, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS ever_bought
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def window_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = Window.partitionBy("user_id")
    order = whole.orderBy("ts", "event_id")
    ran = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return load(spark, sf_dir, "events").select(
        "event_id", F.lag("event_id").over(order).alias("earlier"), F.count_if(F.col("event_type") == "click").over(ran).alias("clicks"), F.count("*").over(whole).alias("n_user"),
        F.min("ts").over(whole).alias("first_ts"), F.max((F.col("event_type") == "purchase").cast("int")).over(whole).alias("ever_bought"),
    )


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY coalesce(CAST(nullif(o_custkey % 5, 0) AS VARCHAR), o_orderpriority) ORDER BY o_orderkey) AS n FROM orders""")
def composite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.coalesce(F.expr("nullif(o_custkey % 5, 0)").cast("string"), F.col("o_orderpriority"))
    return load(spark, sf_dir, "orders").withColumn("key", key).select("o_orderkey", F.row_number().over(Window.partitionBy("key").orderBy("o_orderkey")).alias("n"))


@query("""SELECT grain AS grain, round(sum(revenue), 2) AS revenue, CAST(round(sum(cost), 2) AS DOUBLE) AS cost, CASE WHEN sum(cost) <> 0 THEN round(sum(revenue) / CAST(sum(cost) AS DOUBLE), 6) END AS roas
          FROM (SELECT l_returnflag AS grain, l_extendedprice AS revenue, CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) END AS cost FROM lineitem) GROUP BY 1""")
def guarded_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.when(F.col("l_returnflag") == "N", F.lit(0)).otherwise(F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)"))
    sums = load(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("grain")).agg(F.sum("l_extendedprice").alias("r"), F.sum(cost).alias("c"))
    return sums.select("grain", F.round("r", 2).alias("revenue"), F.round("c", 2).cast("double").alias("cost"), F.round(ratio(F.col("r"), F.col("c").cast("double")), 6).alias("roas"))
