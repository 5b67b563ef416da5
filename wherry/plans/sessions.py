"""Sessions and touchpoints over the event table: views and clicks are pages, user_id is the visitor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.functions.text import hash_key
from wherry.operators.sessions import session_rollup as rollup
from wherry.operators.sessions import sessionize, visitor_key
from wherry.plans.registry import query
from wherry.sources.tables import load, micros


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    visitor = visitor_key(F.lit(None).cast("string"), F.col("user_id"), F.col("event_id"))
    return rows.select(F.col("event_id").alias("page_id"), visitor.alias("visitor"), "ts", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def touchpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One touchpoint per session; source, medium, campaign and ad follow from the first page's k."""
    sessions = rollup(sessionize(page_views(spark, sf_dir)), carried=("k",))
    k = F.col("k")
    source = F.when(k % 5 == 0, "direct").when(k % 5 == 1, "google").when(k % 5 == 2, "meta").when(k % 5 == 3, "bing").otherwise("site")
    medium = F.when(k % 5 == 0, "none").when(k % 5 == 1, "cpc").when(k % 5 == 2, "paid").when(k % 5 == 3, "organic").otherwise("referral")
    return sessions.select(
        hash_key(F.col("session_id"), F.lit("website_session")).alias("touch_id"), F.col("visitor").alias("profile"), F.col("session_start").alias("touch_time"), "session_id", "n_pages", "seconds",
        source.alias("source"), medium.alias("medium"), F.when(k % 13 != 0, F.concat(F.lit("c"), k % 7)).alias("campaign"), F.when(k % 11 != 0, F.concat(F.lit("a"), k % 3)).alias("ad"),
    )


#: Pages with session_number, as DuckDB has them; `sessions` and `touches` are built on it.
SESSION_SQL = """pages AS (SELECT event_id AS page_id, CAST(user_id AS VARCHAR) AS visitor, ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type IN ('view', 'click') AND ts IS NOT NULL),
  gaps AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY visitor ORDER BY ts, page_id) AS gap FROM pages),
  numbered AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap >= 1860000000 THEN 1 ELSE 0 END) OVER (PARTITION BY visitor ORDER BY ts, page_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number FROM gaps),
  named AS (SELECT *, md5(visitor || '|' || session_number) AS session_id FROM numbered),
  sessions AS (SELECT visitor, session_number, session_id, arg_min(page_id, (ts, page_id)) AS first_page, arg_max(page_id, (ts, page_id)) AS last_page, count(*) AS n_pages, min(ts) AS session_start, max(ts) AS session_end,
    arg_min(k, (ts, page_id)) AS k, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds FROM named GROUP BY ALL)"""
TOUCH_SQL = SESSION_SQL + """,
  touches AS (SELECT md5(session_id || '|website_session') AS touch_id, visitor AS profile, session_start AS touch_time, session_id, n_pages, seconds,
    CASE k % 5 WHEN 0 THEN 'direct' WHEN 1 THEN 'google' WHEN 2 THEN 'meta' WHEN 3 THEN 'bing' ELSE 'site' END AS source,
    CASE k % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'cpc' WHEN 2 THEN 'paid' WHEN 3 THEN 'organic' ELSE 'referral' END AS medium,
    CASE WHEN k % 13 <> 0 THEN 'c' || (k % 7) END AS campaign, CASE WHEN k % 11 <> 0 THEN 'a' || (k % 3) END AS ad FROM sessions)"""


@query(f"WITH {SESSION_SQL} SELECT page_id, visitor, ts, session_number, session_id FROM named")
def session_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize(page_views(spark, sf_dir)).select("page_id", "visitor", "ts", "session_number", "session_id")


@query(f"WITH {SESSION_SQL} SELECT visitor, session_number, session_id, first_page, last_page, n_pages, session_start, session_end, seconds FROM sessions")
def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(sessionize(page_views(spark, sf_dir)))


@query(f"WITH {TOUCH_SQL} SELECT * FROM touches")
def session_touchpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return touchpoints(spark, sf_dir)


@query(f"""WITH {TOUCH_SQL}, c AS (SELECT *, CASE WHEN source = 'meta' THEN concat_ws('-', campaign, ad) END AS fbclid, profile[-1:] AS tenant FROM touches)
  SELECT touch_id, tenant, fbclid, min(touch_time) OVER w AS first_seen, CASE WHEN fbclid IS NOT NULL THEN 'fb.1.' || epoch_us(min(touch_time) OVER w) // 1000 || '.' || fbclid END AS fbc FROM c WINDOW w AS (PARTITION BY tenant, fbclid)""")
def first_seen_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each touchpoint with the time its click id was first seen for the tenant, by anyone, and the cookie made of both; none without a click id.

    The times are a grouped table, joined back: a click id that many share is summed before the shuffle.
    """
    rows = touchpoints(spark, sf_dir).withColumn("fbclid", F.when(F.col("source") == "meta", F.concat_ws("-", "campaign", "ad"))).withColumn("tenant", F.right("profile", F.lit(1)))
    times = rows.groupBy("tenant", "fbclid").agg(F.min("touch_time").alias("first_seen"))
    found = rows.alias("r").join(times.alias("t"), F.expr("r.tenant = t.tenant and r.fbclid <=> t.fbclid"))
    cookie = F.concat(F.lit("fb.1."), F.floor(micros("first_seen") / 1000), F.lit("."), F.col("r.fbclid"))
    return found.select("touch_id", "r.tenant", "r.fbclid", "first_seen", cookie.alias("fbc"))


@query(f"""WITH {SESSION_SQL.replace("CAST(user_id AS VARCHAR) AS visitor", "(user_id % 3) || ':' || (user_id // 3) AS visitor")} SELECT CAST(split_part(visitor, ':', 1) AS BIGINT) AS tenant, split_part(visitor, ':', 2) AS visitor, session_number, md5(split_part(visitor, ':', 1) || '|' || split_part(visitor, ':', 2) || '|' || session_number) AS session_id, n_pages, session_start FROM sessions""")
def tenant_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of several tenants whose visitors have the same names: the tenant is part of every key."""
    rows = load(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    pages = rows.select((F.col("user_id") % 3).alias("tenant"), F.floor(F.col("user_id") / 3).cast("string").alias("visitor"), F.col("event_id").alias("page_id"), "ts")
    rolled = rollup(sessionize(pages, ["tenant", "visitor"]), ["tenant", "visitor"])
    return rolled.select("tenant", "visitor", "session_number", "session_id", "n_pages", "session_start")


@query(f"WITH {SESSION_SQL} SELECT n_pages > 1 OR seconds >= 10 AS engaged, count(*) AS n, count(*) FILTER (WHERE n_pages = 1) AS n_bounced, round(avg(seconds), 4) AS mean_seconds FROM sessions GROUP BY 1")
def session_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rollup(sessionize(page_views(spark, sf_dir)))
    return rows.groupBy(((F.col("n_pages") > 1) | (F.col("seconds") >= 10)).alias("engaged")).agg(F.count("*").alias("n"), F.count_if(F.col("n_pages") == 1).alias("n_bounced"), F.round(F.avg("seconds"), 4).alias("mean_seconds"))
