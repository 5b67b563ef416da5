"""Delivery, performance and landing-page marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.functions.calendar import local_date, local_hour, ratio, report_window
from wherry.operators.joins import full_on
from wherry.operators.versions import latest_by
from wherry.plans.attribution import JOURNEY_SQL, TIE, conversions
from wherry.plans.registry import query
from wherry.plans.sessions import TOUCH_SQL, touchpoints
from wherry.operators.attribution import is_paid, journeys
from wherry.sources.tables import load

_LOCAL = "timezone('America/Los_Angeles', timezone('UTC', {}))"


@query(f"""SELECT CAST(date_trunc('hour', {_LOCAL.format('ts')}) AS TIMESTAMP) AS local_hour, CAST({_LOCAL.format('ts')} AS DATE) AS local_day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def local_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour and day grain of the local zone."""
    rows = load(spark, sf_dir, "events").select(local_hour(F.col("ts")).cast("timestamp_ntz").alias("local_hour"), local_date(F.col("ts")).alias("local_day"), "value")
    return rows.groupBy("local_hour", "local_day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ad delivery by campaign and ad: views cost a cent of their value, clicks are counted."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = load(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click")).select(
        F.col("ts").cast("date").alias("day"), F.when(k % 13 != 0, F.concat(F.lit("c"), k % 7)).alias("campaign"), F.when(k % 11 != 0, F.concat(F.lit("a"), k % 3)).alias("ad"), "event_type", "value", "user_id"
    )
    view = F.col("event_type") == "view"
    return rows.groupBy("day", "campaign", "ad").agg(F.count_if(view).alias("impressions"), F.count_if(~view).alias("clicks"), F.countDistinct("user_id").alias("reach"), F.sum(F.when(view, F.col("value") / 100).otherwise(0.0)).alias("spend"))


_DELIVERY_SQL = """delivery AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN k % 13 <> 0 THEN 'c' || (k % 7) END AS campaign, CASE WHEN k % 11 <> 0 THEN 'a' || (k % 3) END AS ad, count(*) FILTER (WHERE event_type = 'view') AS impressions,
  count(*) FILTER (WHERE event_type = 'click') AS clicks, count(DISTINCT user_id) AS reach, sum(CASE WHEN event_type = 'view' THEN value / 100 ELSE 0 END) AS spend
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type IN ('view', 'click')) GROUP BY ALL)"""


@query(f"WITH {_DELIVERY_SQL} SELECT day, campaign, ad, impressions, clicks, reach, round(spend + 1e-7, 4) AS spend, CASE WHEN reach <> 0 THEN round(impressions / reach, 6) END AS frequency, CASE WHEN impressions <> 0 THEN round(clicks / impressions, 6) END AS click_rate FROM delivery")
def ad_delivery_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = lambda a, b: F.round(ratio(F.col(a), F.col(b)), 6)
    return delivery(spark, sf_dir).select("day", "campaign", "ad", "impressions", "clicks", "reach", F.round(F.col("spend") + TIE, 4).alias("spend"), rate("impressions", "reach").alias("frequency"), rate("clicks", "impressions").alias("click_rate"))


@query("""WITH h AS (SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00:00 - ' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':59:59' AS bucket, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS spend FROM events WHERE event_type = 'view')
  SELECT day, CAST(split_part(bucket, ':', 1) AS BIGINT) AS hour, count(*) AS n, CAST(sum(spend) AS DOUBLE) AS spend FROM h GROUP BY ALL""")
def ad_delivery_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour parsed from buckets that read "HH:MM:SS - HH:MM:SS"; spend is exact."""
    at = F.lpad(F.hour("ts").cast("string"), 2, "0")
    rows = load(spark, sf_dir, "events").filter("event_type = 'view'").select(F.col("ts").cast("date").alias("day"), F.concat(at, F.lit(":00:00 - "), at, F.lit(":59:59")).alias("bucket"), F.col("value").cast("decimal(18,2)").alias("spend"))
    return rows.groupBy("day", F.split_part("bucket", F.lit(":"), F.lit(1)).cast("bigint").alias("hour")).agg(F.count("*").alias("n"), F.sum("spend").cast("double").alias("spend"))


def paid_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir)).filter("is_paid")
    return rows.groupBy(F.col("conversion_time").cast("date").alias("day"), "campaign", "ad").agg(F.sum("multi_weight").alias("conversions"), F.sum(F.col("multi_weight") * F.col("amount")).alias("revenue"))


_PAID_SQL = f"WITH {JOURNEY_SQL}, {_DELIVERY_SQL}, bought AS (SELECT CAST(conversion_time AS DATE) AS day, campaign, ad, sum(m) AS conversions, sum(m * amount) AS revenue FROM weights WHERE paid GROUP BY ALL)"


@query(f"""{_PAID_SQL} SELECT coalesce(d.day, b.day) AS day, coalesce(d.campaign, b.campaign) AS campaign, coalesce(d.ad, b.ad) AS ad, CASE WHEN d.day IS NULL THEN 0 ELSE 1 END AS has_left, CASE WHEN b.day IS NULL THEN 0 ELSE 1 END AS has_right,
  coalesce(clicks, 0) AS clicks, round(coalesce(spend, 0) + 1e-7, 4) AS spend, round(coalesce(conversions, 0), 6) AS conversions, round(coalesce(revenue, 0) + 1e-7, 4) AS revenue, CASE WHEN coalesce(spend, 0) <> 0 THEN round(coalesce(revenue, 0) / spend + 1e-7, 3) END AS roas
  FROM delivery d FULL JOIN bought b ON d.day = b.day AND d.campaign IS NOT DISTINCT FROM b.campaign AND d.ad IS NOT DISTINCT FROM b.ad""")
def ad_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery beside attributed conversions on null-safe grain; the return on spend is null without spend."""
    met = full_on(delivery(spark, sf_dir).select("day", "campaign", "ad", "clicks", "spend"), paid_conversions(spark, sf_dir), ["day", "campaign", "ad"])
    filled = met.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("clicks", "spend", "conversions", "revenue")})
    return filled.select(
        "day", "campaign", "ad", "has_left", "has_right", "clicks", F.round(F.col("spend") + TIE, 4).alias("spend"), F.round("conversions", 6).alias("conversions"), F.round(F.col("revenue") + TIE, 4).alias("revenue"),
        F.round(ratio(F.col("revenue"), F.col("spend")) + TIE, 3).alias("roas"),
    )


@query(f"""WITH {JOURNEY_SQL}, s AS (SELECT profile[-1:] AS tenant, CAST(touch_time AS DATE) AS day, source, medium, campaign, ad, count(*) AS sessions FROM touches WHERE medium NOT IN ('cpc', 'paid', 'paid_social') GROUP BY ALL),
  c AS (SELECT profile[-1:] AS tenant, CAST(conversion_time AS DATE) AS day, source, medium, campaign, ad, sum(m) AS conversions FROM weights WHERE touch_id IS NOT NULL AND medium NOT IN ('cpc', 'paid', 'paid_social') GROUP BY ALL)
  SELECT coalesce(s.tenant, c.tenant) AS tenant, coalesce(s.day, c.day) AS day, coalesce(s.source, c.source) AS source, coalesce(s.medium, c.medium) AS medium, coalesce(s.campaign, c.campaign) AS campaign, coalesce(s.ad, c.ad) AS ad,
    coalesce(sessions, 0) AS sessions, round(coalesce(conversions, 0), 6) AS conversions
  FROM s FULL JOIN c ON s.tenant = c.tenant AND s.day = c.day AND s.source = c.source AND s.medium = c.medium AND s.campaign IS NOT DISTINCT FROM c.campaign AND s.ad IS NOT DISTINCT FROM c.ad""")
def organic_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpaid sessions beside the conversions they are credited with, by six keys of which two may be null."""
    organic = ~F.col("medium").isin("cpc", "paid", "paid_social")
    keys = ["tenant", "day", "source", "medium", "campaign", "ad"]
    touches = touchpoints(spark, sf_dir)
    tenant = F.right("profile", F.lit(1))
    sessions = touches.filter(organic).withColumns({"tenant": tenant, "day": F.col("touch_time").cast("date")}).groupBy(*keys).agg(F.count("*").alias("sessions"))
    rows = journeys(touches, conversions(spark, sf_dir)).filter(F.col("touch_id").isNotNull() & organic).withColumns({"tenant": tenant, "day": F.col("conversion_time").cast("date")})
    met = full_on(sessions, rows.groupBy(*keys).agg(F.sum("multi_weight").alias("conversions")), keys)
    return met.select(*keys, F.coalesce("sessions", F.lit(0)).alias("sessions"), F.round(F.coalesce("conversions", F.lit(0.0)), 6).alias("conversions"))


@query(f"""{_PAID_SQL}, o AS (SELECT CAST(conversion_time AS DATE) AS day, sum(m) AS conversions FROM weights WHERE touch_id IS NOT NULL AND NOT paid GROUP BY 1)
  SELECT 'paid' AS kind, day, round(sum(conversions), 6) AS conversions FROM bought GROUP BY day UNION ALL SELECT 'organic', day, round(conversions, 6) FROM o""")
def all_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir)).filter("touch_id is not null")
    kind = F.when(F.col("is_paid"), "paid").otherwise("organic")
    return rows.groupBy(kind.alias("kind"), F.col("conversion_time").cast("date").alias("day")).agg(F.round(F.sum("multi_weight"), 6).alias("conversions"))


@query(f"""WITH {TOUCH_SQL}, s AS (SELECT CAST(touch_time AS DATE) AS day, coalesce(campaign, 'none') AS page, count(*) AS sessions, count(*) FILTER (WHERE n_pages = 1) AS bounced, count(*) FILTER (WHERE n_pages > 1 OR seconds >= 10) AS engaged, count(DISTINCT profile) AS visitors FROM touches GROUP BY ALL)
  SELECT *, round(bounced / sessions, 6) AS bounce_rate, round(engaged / sessions, 6) AS engagement_rate FROM s""")
def landing_page_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = touchpoints(spark, sf_dir).groupBy(F.col("touch_time").cast("date").alias("day"), F.coalesce("campaign", F.lit("none")).alias("page")).agg(
        F.count("*").alias("sessions"), F.count_if(F.col("n_pages") == 1).alias("bounced"), F.count_if((F.col("n_pages") > 1) | (F.col("seconds") >= 10)).alias("engaged"), F.countDistinct("profile").alias("visitors")
    )
    return rows.withColumn("bounce_rate", F.round(ratio(F.col("bounced"), F.col("sessions")), 6)).withColumn("engagement_rate", F.round(ratio(F.col("engaged"), F.col("sessions")), 6))


@query(f"""WITH {TOUCH_SQL}, {_DELIVERY_SQL}, s AS (SELECT CAST(touch_time AS DATE) AS day, campaign, source AS page, count(*) AS sessions FROM touches WHERE campaign IS NOT NULL GROUP BY ALL), d AS (SELECT day, campaign, sum(spend) AS spend FROM delivery WHERE campaign IS NOT NULL GROUP BY ALL)
  SELECT s.day, page, round(sum(spend * sessions / total) + 1e-7, 4) AS cost, CAST(sum(sessions) AS BIGINT) AS sessions FROM (SELECT *, sum(sessions) OVER (PARTITION BY day, campaign) AS total FROM s) s JOIN d ON d.day = s.day AND d.campaign = s.campaign GROUP BY ALL""")
def cost_by_landing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A campaign's daily spend, shared among pages by sessions."""
    from pyspark.sql import Window

    s = touchpoints(spark, sf_dir).filter("campaign is not null").groupBy(F.col("touch_time").cast("date").alias("day"), "campaign", F.col("source").alias("page")).agg(F.count("*").alias("sessions"))
    s = s.withColumn("total", F.sum("sessions").over(Window.partitionBy("day", "campaign")))
    d = delivery(spark, sf_dir).filter("campaign is not null").groupBy("day", "campaign").agg(F.sum("spend").alias("spend"))
    return s.join(d, ["day", "campaign"]).groupBy("day", "page").agg(F.round(F.sum(F.col("spend") * F.col("sessions") / F.col("total")) + TIE, 4).alias("cost"), F.sum("sessions").alias("sessions"))


@query("""WITH h AS (SELECT p_partkey AS ad, 1 AS version, p_name AS name, p_brand AS campaign FROM part UNION ALL SELECT p_partkey, 2, nullif(upper(p_name), ''), CASE WHEN p_size > 25 THEN p_brand END FROM part WHERE p_size > 10)
  SELECT ad, arg_max(name, version) FILTER (WHERE name IS NOT NULL) AS name, arg_max(campaign, version) FILTER (WHERE campaign IS NOT NULL) AS campaign, CAST(max(version) AS BIGINT) AS version FROM h GROUP BY 1""")
def ad_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest non-null name and campaign per ad from its history."""
    part = load(spark, sf_dir, "part")
    first = part.select(F.col("p_partkey").alias("ad"), F.lit(1).cast("bigint").alias("version"), F.col("p_name").alias("name"), F.col("p_brand").alias("campaign"))
    later = part.filter("p_size > 10").select(F.col("p_partkey").alias("ad"), F.lit(2).cast("bigint").alias("version"), F.expr("nullif(upper(p_name), '')").alias("name"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("campaign"))
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("version"))).alias(c)
    return first.unionByName(later).groupBy("ad").agg(known("name"), known("campaign"), F.max("version").alias("version"))


@query("""WITH w AS (SELECT TIMESTAMP '2024-01-19 16:30:00' AS as_of), l AS (SELECT as_of, timezone('America/Los_Angeles', timezone('UTC', as_of)) AS local FROM w),
  a AS (SELECT as_of, CASE WHEN local < date_trunc('week', local) + INTERVAL 10 HOUR THEN date_trunc('week', local) + INTERVAL 10 HOUR - INTERVAL 7 DAY ELSE date_trunc('week', local) + INTERVAL 10 HOUR END AS anchor FROM l),
  b AS (SELECT timezone('UTC', timezone('America/Los_Angeles', anchor)) AS s, date_trunc('hour', as_of) AS e FROM a)
  SELECT CASE WHEN ts >= s AND ts < e THEN 'current' ELSE 'earlier' END AS week, count(*) AS n, round(sum(value), 2) AS total FROM events, b WHERE (ts >= s AND ts < e) OR (ts >= s - INTERVAL 168 HOUR AND ts < e - INTERVAL 168 HOUR) GROUP BY 1""")
def report_weeks(spark: SparkSession, sf_dir: str, as_of: str = "2024-01-19 16:30:00") -> DataFrame:
    """The report week to the last completed hour, beside the same stretch 168 hours earlier; the clock is a parameter."""
    w = report_window(F.to_timestamp(F.lit(as_of)))
    at = F.col("ts").cast("timestamp")
    current = (at >= w["window_start"]) & (at < w["window_end"])
    earlier = (at >= w["earlier_start"]) & (at < w["earlier_end"])
    rows = load(spark, sf_dir, "events").withColumn("week", F.when(current, "current").when(earlier, "earlier")).filter("week is not null")
    return rows.groupBy("week").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(f"WITH {JOURNEY_SQL} SELECT campaign, count(*) AS n_first, min(name) AS campaign_name FROM weights JOIN (SELECT 'c' || n_nationkey AS c, n_name AS name FROM nation) ON c = campaign WHERE place = 1 GROUP BY 1")
def names_after_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are joined to the groups, not to the rows."""
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir)).filter("place = 1").groupBy("campaign").agg(F.count("*").alias("n_first"))
    names = load(spark, sf_dir, "nation").select(F.concat(F.lit("c"), "n_nationkey").alias("campaign"), F.col("n_name").alias("campaign_name"))
    return rows.join(names, "campaign")


@query(f"WITH {TOUCH_SQL} SELECT profile, campaign, ad, touch_time FROM touches WHERE source IN ('google', 'meta') AND campaign IS NOT NULL AND ad IS NOT NULL QUALIFY row_number() OVER (PARTITION BY profile ORDER BY touch_time DESC, touch_id DESC) = 1")
def last_paid_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(touchpoints(spark, sf_dir).filter(is_paid()), ["profile"], [F.col("touch_time").desc(), F.col("touch_id").desc()]).select("profile", "campaign", "ad", "touch_time")
