"""Attribution over session touchpoints; purchases and signups are conversions, their value is the amount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.functions.calendar import weighted
from wherry.functions.text import is_host_of
from wherry.operators.attribution import MODELS, credits, is_paid, journeys, positions
from wherry.operators.versions import latest_by
from wherry.plans.registry import query
from wherry.plans.sessions import TOUCH_SQL, touchpoints
from wherry.sources.tables import load


#: Added before rounding, so that sums in another order do not fall on the other side of a half.
TIE = 1e-7


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "signup"))
    return rows.select(F.col("event_id").alias("conversion_id"), F.col("user_id").cast("string").alias("profile"), F.col("ts").alias("conversion_time"), F.col("event_type").alias("conversion_type"), F.col("value").alias("amount"))


JOURNEY_SQL = TOUCH_SQL + """,
  conv AS (SELECT event_id AS conversion_id, CAST(user_id AS VARCHAR) AS profile, ts AS conversion_time, event_type AS conversion_type, value AS amount FROM events WHERE event_type IN ('purchase', 'signup')),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY touch_time, touch_id) AS k, coalesce(source IN ('google', 'meta') AND medium IN ('cpc', 'paid', 'paid_social') AND campaign IS NOT NULL AND ad IS NOT NULL, false) AS is_paid FROM touches),
  placed AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY touch_time, touch_id) AS place FROM ranked WHERE source <> 'direct' OR k = 1),
  pairs AS (SELECT c.*, p.touch_id, p.place, p.is_paid, p.source, p.medium, p.campaign, p.ad, p.touch_time, count(p.touch_id) OVER (PARTITION BY c.conversion_id) AS n FROM conv c LEFT JOIN placed p ON p.profile = c.profile AND p.touch_time <= c.conversion_time),
  w0 AS (SELECT *, CASE WHEN touch_id IS NULL OR place = 1 THEN 1.0 ELSE 0.0 END AS f, CASE WHEN touch_id IS NULL OR place = n THEN 1.0 ELSE 0.0 END AS l,
    CASE WHEN touch_id IS NULL OR n = 1 THEN 1.0 WHEN n = 2 THEN 0.5 WHEN place = 1 OR place = n THEN 0.4 ELSE 0.2 / (n - 2) END::DOUBLE AS m, coalesce(is_paid, false) AS paid FROM pairs),
  weights AS (SELECT *, CASE WHEN paid THEN f ELSE 0.0 END AS fp, CASE WHEN paid THEN l ELSE 0.0 END AS lp, CASE WHEN paid THEN m ELSE 0.0 END AS mp FROM w0)"""
LABEL_SQL = r"""CASE WHEN touch_id IS NULL THEN 'unattributed' WHEN source = 'meta' AND medium IN ('paid', 'cpc', 'ppc', 'paid_social') THEN 'meta / paid'
  WHEN source = 'meta' AND medium IN ('referral', 'social', 'organic') OR regexp_matches(lower(source), '(^|\.)(facebook\.com|instagram\.com)$') THEN 'meta / organic'
  WHEN source = 'google' AND medium IN ('referral', 'organic') OR regexp_matches(lower(source), '(^|\.)(google\.com|google\.[a-z]{2,3})$') OR starts_with(lower(source), 'com.google.') THEN 'google / organic'
  WHEN source = 'bing' AND medium IN ('referral', 'organic') OR regexp_matches(lower(source), '(^|\.)(bing\.com)$') THEN 'bing / organic'
  WHEN source = 'youtube' AND medium IN ('referral', 'organic') OR regexp_matches(lower(source), '(^|\.)(youtube\.com|youtu\.be)$') THEN 'youtube / organic'
  WHEN source = 'trustpilot' AND medium IN ('company_profile', 'referral') OR regexp_matches(lower(source), '(^|\.)(trustpilot\.com)$') OR lower(source) = 'trustpilot' THEN 'trustpilot / referral'
  ELSE source || ' / ' || medium END"""

#: Channel -> the mediums under which its name counts as unpaid.
UNPAID_MEDIUMS = {"meta": ("referral", "social", "organic"), "google": ("referral", "organic"), "bing": ("referral", "organic"), "youtube": ("referral", "organic"), "trustpilot": ("company_profile", "referral")}


def channel_label() -> Column:
    """The name that reports show for a touch: a channel by name and medium or by host, else source / medium."""
    source, medium = F.col("source"), F.col("medium")
    label = F.when(F.col("touch_id").isNull(), "unattributed").when((source == "meta") & medium.isin("paid", "cpc", "ppc", "paid_social"), "meta / paid")
    for channel, mediums in UNPAID_MEDIUMS.items():
        named = (source == channel) & medium.isin(*mediums) | is_host_of(source, channel)
        if channel == "trustpilot":
            named = named | (F.lower(source) == channel)
        label = label.when(named, f"{channel} / {'referral' if channel == 'trustpilot' else 'organic'}")
    return label.otherwise(F.concat(source, F.lit(" / "), medium))


@query(f"WITH {JOURNEY_SQL} SELECT conversion_id, touch_id, CAST(place AS BIGINT) AS place, n AS n_touches, f AS first_weight, l AS last_weight, round(m, 9) AS multi_weight, fp AS first_paid_weight, lp AS last_paid_weight, round(mp, 9) AS multi_paid_weight FROM weights")
def attribution_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir))
    return rows.select("conversion_id", "touch_id", F.col("place").cast("bigint").alias("place"), "n_touches", *[F.round(f"{m}_weight", 9).alias(f"{m}_weight") for m in MODELS])


@query(f"WITH {JOURNEY_SQL} SELECT conversion_id, round(sum(f), 9) AS first_total, round(sum(l), 9) AS last_total, round(sum(m), 9) AS multi_total FROM weights GROUP BY 1")
def attribution_weight_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every total is 1."""
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir))
    return rows.groupBy("conversion_id").agg(*[F.round(F.sum(f"{m}_weight"), 9).alias(f"{m}_total") for m in ("first", "last", "multi")])


@query(f"""WITH {JOURNEY_SQL} SELECT CAST(conversion_time AS DATE) AS day, {LABEL_SQL} AS channel, conversion_type,
  {', '.join(f"round(sum({c}), 6) AS {m}_conversions, round(sum(amount * {c}) + 1e-7, 4) AS {m}_amount" for m, c in zip(MODELS, ('f', 'l', 'm', 'fp', 'lp', 'mp')))} FROM weights GROUP BY ALL""")
def attribution_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions and amounts of all six models by day, channel and type."""
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir)).withColumn("channel", channel_label())
    measures = [x for m in MODELS for x in (F.round(F.sum(f"{m}_weight"), 6).alias(f"{m}_conversions"), F.round(F.sum(F.col("amount") * F.col(f"{m}_weight")) + TIE, 4).alias(f"{m}_amount"))]
    return rows.groupBy(F.col("conversion_time").cast("date").alias("day"), "channel", "conversion_type").agg(*measures)


@query(f"WITH {JOURNEY_SQL} SELECT touch_id, profile, {', '.join(f'round(sum({c}), 6) AS {m}_n, round(sum(amount * {c}) + 1e-7, 4) AS {m}_amount' for m, c in zip(('first', 'last', 'multi'), 'flm'))} FROM weights WHERE touch_id IS NOT NULL GROUP BY ALL HAVING round(sum(m), 6) > 0")
def attribution_credits_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same credits per touch without pairing touches and conversions."""
    measured = conversions(spark, sf_dir).withColumn("n", F.lit(1.0))
    found = credits(touchpoints(spark, sf_dir), measured.select("profile", "conversion_id", "conversion_time", F.col("n").alias("ones"), "amount"), ["ones", "amount"])
    rounded = found.select("touch_id", "profile", *[F.round(F.col(f"{m}_{c}") + e, d).alias(f"{m}_{a}") for m in ("first", "last", "multi") for c, a, d, e in (("ones", "n", 6, 0.0), ("amount", "amount", 4, TIE))])
    return rounded.filter("touch_id is not null and multi_n > 0")


@query(f"WITH {JOURNEY_SQL} SELECT {LABEL_SQL} AS channel, CAST(sum(round(CAST(amount AS DECIMAL(20,9)) * CAST(round(m, 9) AS DECIMAL(17,9)), 9)) AS DOUBLE) AS multi_revenue FROM weights WHERE conversion_type = 'purchase' GROUP BY ALL")
def revenue_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase amounts split in exact decimals of nine places; conversions without touch are offline."""
    rows = journeys(touchpoints(spark, sf_dir), conversions(spark, sf_dir).filter("conversion_type = 'purchase'")).withColumn("channel", channel_label())
    part = weighted(F.col("amount"), F.round("multi_weight", 9))
    return rows.groupBy("channel").agg(F.sum(part).cast("double").alias("multi_revenue"))


@query(f"WITH {TOUCH_SQL} SELECT profile, arg_min(source, (touch_time, touch_id)) AS first_source, arg_min(campaign, (touch_time, touch_id)) FILTER (WHERE campaign IS NOT NULL) AS first_campaign, arg_max(campaign, (touch_time, touch_id)) FILTER (WHERE campaign IS NOT NULL) AS last_campaign FROM touches GROUP BY 1")
def profile_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last known values."""
    key = F.struct("touch_time", "touch_id")
    known = F.when(F.col("campaign").isNotNull(), key)  # max_by and min_by skip null keys
    return touchpoints(spark, sf_dir).groupBy("profile").agg(F.min_by("source", key).alias("first_source"), F.min_by("campaign", known).alias("first_campaign"), F.max_by("campaign", known).alias("last_campaign"))


@query("SELECT event_id AS conversion_id, CAST(user_id AS VARCHAR) AS profile, event_type AS conversion_type, ts AS conversion_time FROM events WHERE event_type IN ('purchase', 'signup') QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(conversions(spark, sf_dir), ["profile", "conversion_type"], [F.col("conversion_time").asc(), F.col("conversion_id").asc()]).drop("amount")


@query(f"WITH {TOUCH_SQL} SELECT * FROM touches QUALIFY row_number() OVER (PARTITION BY profile ORDER BY touch_time, touch_id) = 1")
def touchpoints_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(touchpoints(spark, sf_dir), ["profile"], [F.col("touch_time").asc(), F.col("touch_id").asc()])


@query(f"WITH {TOUCH_SQL} SELECT * FROM touches QUALIFY row_number() OVER (PARTITION BY profile ORDER BY touch_time DESC, touch_id DESC) = 1")
def touchpoints_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(touchpoints(spark, sf_dir), ["profile"], [F.col("touch_time").desc(), F.col("touch_id").desc()])


@query(f"WITH {JOURNEY_SQL} SELECT conversion_type, {LABEL_SQL} AS channel, count(*) AS n FROM (SELECT * FROM weights WHERE touch_id IS NULL OR place = 1) WHERE conversion_id IN (SELECT event_id FROM events WHERE event_type IN ('purchase', 'signup') QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1) GROUP BY ALL")
def first_conversion_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel that first brought each profile, at its first conversion of each type."""
    first = first_conversions(spark, sf_dir).withColumn("amount", F.lit(0.0))
    rows = journeys(touchpoints(spark, sf_dir), first).filter("touch_id is null or place = 1").withColumn("channel", channel_label())
    return rows.groupBy("conversion_type", "channel").agg(F.count("*").alias("n"))


_REGISTRATION_SQL = TOUCH_SQL + """,
  reg AS (SELECT event_id AS registration_id, CAST(user_id AS VARCHAR) AS profile, ts AS registered_at FROM events WHERE event_type = 'signup'),
  earliest AS (SELECT profile, min(registered_at) AS since FROM reg GROUP BY 1),
  buy AS (SELECT e.event_id AS purchase_id, CAST(e.user_id AS VARCHAR) AS profile, e.ts AS bought_at FROM events e JOIN earliest r ON r.profile = CAST(e.user_id AS VARCHAR) WHERE e.event_type = 'purchase' AND e.value > 50 AND e.ts >= r.since QUALIFY row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) = 1),
  applicable AS (SELECT r.*, b.purchase_id, b.bought_at FROM reg r LEFT JOIN buy b ON b.profile = r.profile WHERE b.bought_at IS NULL OR r.registered_at <= b.bought_at QUALIFY row_number() OVER (PARTITION BY r.profile ORDER BY r.registered_at DESC NULLS LAST, r.registration_id DESC) = 1),
  clicks AS (SELECT a.registration_id, t.touch_id, t.touch_time, t.campaign FROM applicable a JOIN touches t ON t.profile = a.profile AND t.touch_time < a.registered_at WHERE t.source IN ('google', 'meta') AND t.medium IN ('cpc', 'paid') AND t.campaign IS NOT NULL AND t.ad IS NOT NULL),
  path AS (SELECT registration_id, count(*) AS n_clicks, list(campaign ORDER BY touch_time, touch_id) AS campaigns FROM clicks GROUP BY 1)"""


def registration_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest applicable registration per profile with its first qualifying purchase and the paid clicks before it."""
    events = load(spark, sf_dir, "events").withColumn("profile", F.col("user_id").cast("string"))
    reg = events.filter("event_type = 'signup'").select(F.col("event_id").alias("registration_id"), "profile", F.col("ts").alias("registered_at"))
    earliest = reg.groupBy("profile").agg(F.min("registered_at").alias("since"))
    qualifying = events.filter("event_type = 'purchase' and value > 50").join(earliest, "profile").filter("ts >= since")
    buy = latest_by(qualifying.select(F.col("event_id").alias("purchase_id"), "profile", F.col("ts").alias("bought_at")), ["profile"], [F.col("bought_at").asc(), F.col("purchase_id").asc()])
    open_ = reg.join(buy, "profile", "left").filter("bought_at is null or registered_at <= bought_at")
    applicable = latest_by(open_, ["profile"], [F.col("registered_at").desc_nulls_last(), F.col("registration_id").desc()])
    paid = touchpoints(spark, sf_dir).filter(is_paid())
    clicks = applicable.select("registration_id", "profile", "registered_at").join(paid, "profile").filter("touch_time < registered_at")
    step = F.struct("touch_time", "touch_id", "campaign")
    path = clicks.groupBy("registration_id").agg(F.count("*").alias("n_clicks"), F.transform(F.array_sort(F.collect_list(step)), lambda x: x["campaign"]).alias("campaigns"))
    return applicable.join(path, "registration_id", "left")


@query(f"WITH {_REGISTRATION_SQL} SELECT a.registration_id, a.profile, a.registered_at, a.purchase_id, coalesce(n_clicks, 0) AS n_clicks, array_to_string(campaigns, '>') AS click_path, campaigns[1] AS first_click, campaigns[-1] AS last_click, coalesce(n_clicks, 0) = 1 AS is_solo, coalesce(CAST(bought_at AS DATE) = CAST(registered_at AS DATE), false) AS same_day FROM applicable a LEFT JOIN path p ON p.registration_id = a.registration_id")
def registration_acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = registration_funnel(spark, sf_dir)
    n = F.coalesce("n_clicks", F.lit(0))
    same = F.coalesce(F.col("bought_at").cast("date") == F.col("registered_at").cast("date"), F.lit(False))
    return rows.select(
        "registration_id", "profile", "registered_at", "purchase_id", n.cast("bigint").alias("n_clicks"), F.array_join("campaigns", ">").alias("click_path"),
        F.get("campaigns", F.lit(0)).alias("first_click"), F.element_at("campaigns", -1).alias("last_click"), (n == 1).alias("is_solo"), same.alias("same_day"),
    )


@query(f"""WITH {_REGISTRATION_SQL}, each AS (SELECT a.registration_id, a.purchase_id, unnest(['first', 'last', 'solo']) AS method, unnest([campaigns[1], campaigns[-1], CASE WHEN n_clicks = 1 THEN campaigns[1] END]) AS campaign FROM applicable a JOIN path p ON p.registration_id = a.registration_id)
  SELECT method, campaign, count(DISTINCT registration_id) AS n_registrations, count(DISTINCT registration_id) FILTER (WHERE purchase_id IS NOT NULL) AS n_purchasers FROM each WHERE campaign IS NOT NULL GROUP BY ALL""")
def registration_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations by first, last and solo click; solo needs exactly one."""
    rows = registration_funnel(spark, sf_dir).filter("n_clicks > 0")
    option = lambda name, c: F.struct(F.lit(name).alias("method"), c.alias("campaign"))
    first, last = F.get("campaigns", F.lit(0)), F.element_at("campaigns", -1)
    each = rows.select("registration_id", "purchase_id", F.inline(F.array(option("first", first), option("last", last), option("solo", F.when(F.col("n_clicks") == 1, first))))).filter("campaign is not null")
    bought = F.when(F.col("purchase_id").isNotNull(), F.col("registration_id"))
    return each.groupBy("method", "campaign").agg(F.countDistinct("registration_id").alias("n_registrations"), F.countDistinct(bought).alias("n_purchasers"))


@query(f"WITH {_REGISTRATION_SQL} SELECT a.registration_id, t.touch_id FROM applicable a JOIN touches t ON t.profile = a.profile AND t.touch_time >= a.registered_at WHERE t.source IN ('google', 'meta') AND t.medium IN ('cpc', 'paid') AND t.campaign IS NOT NULL AND t.ad IS NOT NULL")
def post_registration_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = registration_funnel(spark, sf_dir).select("registration_id", "profile", "registered_at")
    return rows.join(touchpoints(spark, sf_dir).filter(is_paid()), "profile").filter("touch_time >= registered_at").select("registration_id", "touch_id")


@query(f"WITH {JOURNEY_SQL} SELECT profile, touch_id, CAST(place AS BIGINT) AS place, is_paid FROM placed")
def touch_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(touchpoints(spark, sf_dir)).select("profile", "touch_id", F.col("place").cast("bigint").alias("place"), "is_paid")


@query(f"WITH {JOURNEY_SQL} SELECT conversion_id, profile, amount FROM weights WHERE touch_id IS NULL AND conversion_type = 'purchase'")
def unattributed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = conversions(spark, sf_dir).filter("conversion_type = 'purchase'")
    first = touchpoints(spark, sf_dir).groupBy("profile").agg(F.min("touch_time").alias("first_touch"))
    return bought.join(first, "profile", "left").filter("first_touch is null or first_touch > conversion_time").select("conversion_id", "profile", "amount")
