"""Business rules that are easy to lose, each as a query of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.functions.calendar import local_hour, ratio
from wherry.functions.text import canonical_email, first_known, lowered_key, nanp_phone
from wherry.operators.joins import full_on
from wherry.operators.versions import latest_by, live
from wherry.plans.attribution import JOURNEY_SQL, TIE, conversions, registration_funnel
from wherry.plans.attribution import _REGISTRATION_SQL as REGISTRATION_SQL
from wherry.plans.channels import _CONTACT_SQL as CONTACT_SQL
from wherry.plans.channels import contacts
from wherry.operators.attribution import journeys
from wherry.plans.registry import query
from wherry.plans.sessions import TOUCH_SQL, touchpoints
from wherry.sources.tables import load

_LOCAL_HOUR = "CAST(date_trunc('hour', timezone('America/Los_Angeles', timezone('UTC', {}))) AS TIMESTAMP)"


@query(f"""WITH {TOUCH_SQL}, delta AS (SELECT CAST(c_custkey AS VARCHAR) AS profile, 'c' || c_nationkey AS new_profile, c_acctbal < 0 AS is_deleted FROM customer WHERE c_mktsegment = 'BUILDING')
  SELECT touch_id, CASE WHEN d.profile IS NULL THEN t.profile WHEN NOT is_deleted THEN new_profile END AS profile FROM touches t LEFT JOIN delta d ON d.profile = t.profile""")
def touchpoint_profile_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base profile unless a delta exists; a deleted delta means no profile, not the base."""
    delta = load(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit("c"), "c_nationkey").alias("new_profile"), (F.col("c_acctbal") < 0).alias("is_deleted"))
    rows = touchpoints(spark, sf_dir).join(delta, F.col("profile") == F.col("key"), "left")
    return rows.select("touch_id", F.when(F.col("key").isNull(), F.col("profile")).when(~F.col("is_deleted"), F.col("new_profile")).alias("profile"))


@query(rf"""WITH {CONTACT_SQL}, n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN lower(trim(email)) END AS email, regexp_replace(phone, '\D', '', 'g') AS digits FROM contact),
  t AS (SELECT *, CASE WHEN length(digits) = 11 AND digits[1] = '1' THEN digits[2:] ELSE digits END AS ten FROM n)
  SELECT c_custkey, coalesce('email:' || email, CASE WHEN regexp_matches(ten, '^[2-9][0-9]{{2}}[2-9][0-9]{{6}}$') AND ten[4:6] <> '555' AND ten[4:10] <> repeat(ten[10], 7) AND ten NOT IN ('0123456789', '1234567890', '9876543210') AND ten[1:9] <> '234567890' THEN 'phone:+1' || ten END) AS anchor FROM t""")
def payment_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The email key, else the key of a valid phone, else none."""
    email = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("email:"), lowered_key(F.col("email"))))
    phone = nanp_phone(F.col("phone"))
    return contacts(spark, sf_dir).select("c_custkey", F.coalesce(email, F.concat(F.lit("phone:"), phone)).alias("anchor"))


@query("""WITH n AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN upper(c_name) WHEN c_acctbal > 2000 THEN ' ' END AS profile_name, replace(c_name, '#', ' ') AS payment_name FROM customer)
  SELECT c_custkey, coalesce(nullif(trim(profile_name), ''), split_part(payment_name, ' ', 1)) AS first_name, CASE WHEN nullif(trim(profile_name), '') IS NULL THEN split_part(payment_name, ' ', 2) END AS last_name FROM n""")
def payer_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile's name, else the payment's name, split."""
    profile = first_known(F.when(F.col("c_acctbal") > 5000, F.upper("c_name")).when(F.col("c_acctbal") > 2000, " "))
    given = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    part = lambda n: F.split_part(given, F.lit(" "), F.lit(n))
    return load(spark, sf_dir, "customer").select("c_custkey", F.coalesce(profile, part(1)).alias("first_name"), F.when(profile.isNull(), part(2)).alias("last_name"))


@query("""WITH delta AS (SELECT o_orderkey AS key, o_custkey AS profile, o_orderpriority AS batch, o_orderdate AS version, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_deleted FROM orders), activated AS (SELECT DISTINCT o_orderpriority AS batch FROM orders WHERE o_orderpriority < '4')
  SELECT profile, key FROM (SELECT * FROM delta WHERE batch IN (SELECT batch FROM activated) QUALIFY row_number() OVER (PARTITION BY profile ORDER BY version DESC, key DESC) = 1) WHERE is_deleted = 0""")
def activated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of batches that are not activated are not seen, whatever their version."""
    o = load(spark, sf_dir, "orders")
    delta = o.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("profile"), F.col("o_orderpriority").alias("batch"), F.col("o_orderdate").alias("version"), (F.col("o_orderstatus") == "P").alias("is_deleted"))
    activated = o.filter("o_orderpriority < '4'").select(F.col("o_orderpriority").alias("batch")).distinct()
    return live(latest_by(delta.join(activated, "batch", "left_semi"), ["profile"], [F.col("version").desc(), F.col("key").desc()])).select("profile", "key")


@query("""WITH e AS (SELECT CAST(ts AS DATE) AS day, 'c' || (k % 7) AS campaign, 's' || (k % 4) AS adset, user_id FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'view')),
  l AS (SELECT day, 'account' AS level, '*' AS id, count(*) AS impressions, count(DISTINCT user_id) AS reach FROM e GROUP BY day UNION ALL SELECT day, 'campaign', campaign, count(*), count(DISTINCT user_id) FROM e GROUP BY ALL UNION ALL SELECT day, 'adset', campaign || '/' || adset, count(*), count(DISTINCT user_id) FROM e GROUP BY ALL)
  SELECT *, round(impressions / reach, 6) AS frequency FROM l""")
def delivery_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reach and frequency of each level, counted there: reach does not add up."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = load(spark, sf_dir, "events").filter("event_type = 'view'").select(F.col("ts").cast("date").alias("day"), F.concat(F.lit("c"), k % 7).alias("campaign"), F.concat(F.lit("s"), k % 4).alias("adset"), "user_id")
    level = lambda name, id_: F.struct(F.lit(name).alias("level"), id_.alias("id"))
    each = e.select("day", "user_id", F.inline(F.array(level("account", F.lit("*")), level("campaign", F.col("campaign")), level("adset", F.concat_ws("/", "campaign", "adset")))))
    rows = each.groupBy("day", "level", "id").agg(F.count("*").alias("impressions"), F.countDistinct("user_id").alias("reach"))
    return rows.withColumn("frequency", F.round(ratio(F.col("impressions"), F.col("reach")), 6))


@query(f"""WITH {JOURNEY_SQL}, d AS (SELECT {_LOCAL_HOUR.format('ts')} AS hour, CASE WHEN k % 13 <> 0 THEN 'c' || (k % 7) END AS campaign, count(*) FILTER (WHERE event_type = 'click') AS clicks, sum(CASE WHEN event_type = 'view' THEN value / 100 ELSE 0 END) AS spend
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type IN ('view', 'click')) GROUP BY ALL),
  b AS (SELECT {_LOCAL_HOUR.format('conversion_time')} AS hour, campaign, sum(m) AS conversions, sum(m * amount) AS revenue FROM weights WHERE paid GROUP BY ALL)
  SELECT coalesce(d.hour, b.hour) AS hour, coalesce(d.campaign, b.campaign) AS campaign, coalesce(clicks, 0) AS clicks, round(coalesce(spend, 0) + 1e-7, 4) AS spend, round(coalesce(conversions, 0), 6) AS conversions, round(coalesce(revenue, 0) + 1e-7, 4) AS revenue
  FROM d FULL JOIN b ON d.hour = b.hour AND d.campaign IS NOT DISTINCT FROM b.campaign""")
def ad_performance_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery beside attributed conversions by local hour."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    view = F.col("event_type") == "view"
    hour = lambda c: local_hour(F.col(c)).cast("timestamp_ntz").alias("hour")
    events = load(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click")).select(hour("ts"), F.when(k % 13 != 0, F.concat(F.lit("c"), k % 7)).alias("campaign"), "event_type", "value")
    d = events.groupBy("hour", "campaign").agg(F.count_if(~view).alias("clicks"), F.sum(F.when(view, F.col("value") / 100).otherwise(0.0)).alias("spend"))
    paid = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir)).filter("is_paid")
    b = paid.groupBy(hour("conversion_time"), "campaign").agg(F.sum("multi_weight").alias("conversions"), F.sum(F.col("multi_weight") * F.col("amount")).alias("revenue"))
    met = full_on(d, b, ["hour", "campaign"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    return met.select("hour", "campaign", zero("clicks").alias("clicks"), F.round(zero("spend") + TIE, 4).alias("spend"), F.round(zero("conversions"), 6).alias("conversions"), F.round(zero("revenue") + TIE, 4).alias("revenue"))


@query(f"""WITH {REGISTRATION_SQL}, each AS (SELECT {_LOCAL_HOUR.format('a.registered_at')} AS hour, a.registration_id, a.purchase_id, unnest(['first', 'last', 'solo']) AS method, unnest([campaigns[1], campaigns[-1], CASE WHEN n_clicks = 1 THEN campaigns[1] END]) AS campaign FROM applicable a JOIN path p ON p.registration_id = a.registration_id)
  SELECT hour, method, campaign, count(DISTINCT registration_id) AS n_registrations, count(DISTINCT registration_id) FILTER (WHERE purchase_id IS NOT NULL) AS n_purchasers, 900 * count(DISTINCT registration_id) FILTER (WHERE purchase_id IS NOT NULL) AS value FROM each WHERE campaign IS NOT NULL GROUP BY ALL""")
def registration_reporting_hourly(spark: SparkSession, sf_dir: str, purchaser_value: int = 900) -> DataFrame:
    """Registrations by hour, method and campaign; the value of a purchaser is a constant."""
    rows = registration_funnel(spark, sf_dir).filter("n_clicks > 0").withColumn("hour", local_hour(F.col("registered_at")).cast("timestamp_ntz"))
    option = lambda name, c: F.struct(F.lit(name).alias("method"), c.alias("campaign"))
    first, last = F.get("campaigns", F.lit(0)), F.element_at("campaigns", -1)
    each = rows.select("hour", "registration_id", "purchase_id", F.inline(F.array(option("first", first), option("last", last), option("solo", F.when(F.col("n_clicks") == 1, first))))).filter("campaign is not null")
    bought = F.countDistinct(F.when(F.col("purchase_id").isNotNull(), F.col("registration_id")))
    return each.groupBy("hour", "method", "campaign").agg(F.countDistinct("registration_id").alias("n_registrations"), bought.alias("n_purchasers"), (purchaser_value * bought).alias("value"))


@query(rf"""WITH {CONTACT_SQL}, n AS (SELECT split_part(lower(trim(email)), '@', 1) AS local, split_part(lower(trim(email)), '@', 2) AS host FROM contact)
  SELECT host, count(*) AS n, count(DISTINCT CASE WHEN host IN ('gmail.com', 'googlemail.com') THEN replace(split_part(local, '+', 1), '.', '') END) AS n_canonical FROM n GROUP BY 1""")
def email_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses per host and, for Gmail's hosts, different mailboxes."""
    host = F.split_part(lowered_key(F.col("email")), F.lit("@"), F.lit(2))
    return contacts(spark, sf_dir).groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.countDistinct(canonical_email(F.col("email"))).alias("n_canonical"))
