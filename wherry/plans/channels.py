"""URL parameters, channel classification and identifier normalization over pages and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.functions.text import canonical_email, evidence_keys, first_known, is_host_of, lowered_key, nanp_phone, query_parameter, url_host, url_path
from wherry.plans.registry import query
from wherry.sources.tables import load

#: Configuration: click identifiers by falling priority, and our own sites.
CLICK_IDS = ("gclid", "gbraid", "wbraid", "fbclid", "ttclid", "li_fat_id", "rdt_cid", "twclid")
OWN_DOMAINS = ("example.com",)
#: How campaign links write a Meta source, and mediums that are paid for.
META_SOURCES = ("fb", "ig", "facebook", "instagram", "meta", "an", "th", "msg")
PAID_MEDIUMS = ("paid", "paid_social", "cpc", "ppc")

_QUERY = r"regexp_extract(split_part(url, '#', 1), '\?(.*)$', 1)"


def _param(name: str, source: str = _QUERY) -> str:
    return rf"nullif(regexp_extract({source}, '(?:^|&){name}=([^&]*)', 1), '')"


_HOST = r"nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '^www\.', ''), '')"
_PATH = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"


@query(f"""SELECT page_id, {_HOST} AS host, CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS path, {_param('utm_source')} AS utm_source, {_param('ref')} AS ref, {_param('page')} AS page FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return load(spark, sf_dir, "pages").select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), query_parameter(url, "utm_source").alias("utm_source"), query_parameter(url, "ref").alias("ref"), query_parameter(url, "page").alias("page")
    )


#: Query strings and referrers as ad links and other sites give them, dealt to pages by page_id.
LANDINGS = (
    ("utm_source=google&utm_medium=cpc&utm_campaign=c1&gclid=g1", None), ("utm_source=fb&utm_medium=paid_social&utm_campaign=c2&utm_content=a2&fbclid=f1", None),
    ("fbclid=f2", "https://l.facebook.com/"), ("utm_source=newsletter&utm_medium=email", None), ("gbraid=b1&gclid=g2", None),
    ("utm_source=IG&utm_medium=PPC&utm_campaign=c3&utm_content=a3", None), ("x=1", "https://www.google.com/search?q=x"), ("x=1", "https://shop.example.com/a"),
    ("utm_source=meta&utm_medium=ppc&utm_id=i1&h_ad_id=h1", None), ("utm_source=an&utm_campaign=c4", None), ("x=1", "https://notgoogle.com/"), ("x=1", "https://badexample.com/"),
    ("x=1", "https://l.facebook.com/l.php"), ("x=1", "https://m.youtube.com/watch"), ("utm_source=trustpilot&utm_medium=company_profile", None), ("x=1", "https://uk.trustpilot.com/review"),
    ("x=1", "android-app://com.google.android.gm/"), ("utm_source=adwords&utm_medium=referral", None), ("ttclid=t1&utm_medium=video", None), ("x=1", None), ("utm_source=news.google.de&utm_medium=social", "https://www.bing.com/"),
)


def landing_urls(pages: DataFrame) -> DataFrame:
    """pages with a landing URL that carries campaign parameters, as ad links have them, and a referrer."""
    link = F.concat(F.split_part("url", F.lit("#"), F.lit(1)), F.when(F.col("url").contains("?"), "&").otherwise("?"))
    given = F.get(F.array(*[F.struct(F.lit(q).alias("q"), F.lit(r).alias("r")) for q, r in LANDINGS]), (F.col("page_id") % len(LANDINGS)).cast("int"))
    return pages.select("page_id", F.concat(link, given["q"]).alias("url"), given["r"].alias("referrer"))


_LANDING_SQL = f"""given AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{q}', {'NULL' if r is None else repr(r)})" for k, (q, r) in enumerate(LANDINGS))}) v(k, q, referrer)),
  landing AS (SELECT page_id, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || q AS url, referrer FROM pages JOIN given ON k = page_id % {len(LANDINGS)})"""


def classify(landings: DataFrame) -> DataFrame:
    """Click id by priority, source by click id, host and alias, the paid Meta test, and channel source and medium with the referrer as fallback."""
    url = F.col("url")
    rows = landings.withColumns({f"utm_{name}": query_parameter(url, f"utm_{name}") for name in ("source", "medium", "campaign", "content", "id")})
    rows = rows.withColumns({p: query_parameter(url, p) for p in CLICK_IDS}).withColumns({"h_ad_id": query_parameter(url, "h_ad_id"), "host": url_host(F.col("referrer"))})
    rows = rows.withColumn("click_id", F.coalesce(*CLICK_IDS)).withColumn("click_type", F.coalesce(*[F.when(F.col(p).isNotNull(), p) for p in CLICK_IDS]))
    raw, medium = F.coalesce(F.lower(F.trim("utm_source")), F.lit("")), F.coalesce(F.lower("utm_medium"), F.lit(""))
    click = lambda *names: F.coalesce(*names).isNotNull()
    source = F.when(click("fbclid") | raw.isin(*META_SOURCES) & F.col("utm_campaign").isNotNull(), "meta").when(click("gclid", "gbraid", "wbraid"), "google").when(click("ttclid"), "tiktok")
    for channel in ("meta", "google", "bing", "youtube", "trustpilot"):
        source = source.when(is_host_of(raw, channel) | (raw == channel if channel == "trustpilot" else F.lit(False)), channel)
    source = source.when(raw.isin(*META_SOURCES), "meta").when(raw.isin("google", "adwords"), "google").when(raw.isin("tiktok", "tt"), "tiktok").when(raw != "", raw)
    rows = rows.withColumn("source", source)
    named = F.coalesce("utm_campaign", "utm_id").isNotNull() & F.coalesce("utm_content", "h_ad_id").isNotNull()
    rows = rows.withColumn("is_paid_meta", F.coalesce((F.col("source") == "meta") & named & (medium.isin(*PAID_MEDIUMS) | F.col("fbclid").isNotNull()), F.lit(False)))
    host, own = F.col("host"), F.col("host").rlike(rf"(^|\.)({'|'.join(d.replace('.', chr(92) + '.') for d in OWN_DOMAINS)})$")
    by_host = F.when(host.isNull() | own, "direct")
    organic = F.when(host.isNull() | own, "none")
    for channel in ("meta", "google", "bing", "youtube", "trustpilot"):
        by_host = by_host.when(is_host_of(host, channel), channel)
        if channel != "trustpilot":
            organic = organic.when(is_host_of(host, channel), "organic")
    src = F.coalesce("source", F.lit(""))
    by_rule = (
        F.when(F.col("is_paid_meta"), "paid").when(src == "meta", "social").when(medium.isin(*PAID_MEDIUMS), "cpc").when(src.isin("google", "bing", "youtube") & medium.isin("organic", "referral", "social"), "organic")
        .when(src.isin("google", "tiktok"), "cpc").when((src == "trustpilot") & (medium == "company_profile"), "referral").when(medium != "", medium)
    )
    return rows.withColumn("channel_source", F.coalesce("source", by_host.otherwise(host))).withColumn("channel_medium", F.coalesce(by_rule, organic.otherwise("referral")))


_CLICKS_SQL = [_param(p, "q") for p in CLICK_IDS]


def _hosted(of: str, *patterns: tuple[str, str]) -> str:
    return " ".join(f"WHEN regexp_matches({of}, '{pattern}') THEN '{name}'" for pattern, name in patterns)


_SITES = ((r"(^|\.)(facebook\.com|instagram\.com)$", "meta"), (r"(^|\.)google\.(com|[a-z]{2,3})$|^com\.google\.", "google"), (r"(^|\.)bing\.com$", "bing"), (r"(^|\.)(youtube\.com|youtu\.be)$", "youtube"))
_META = "('fb', 'ig', 'facebook', 'instagram', 'meta', 'an', 'th', 'msg')"
_CLASSIFY_SQL = rf"""WITH {_LANDING_SQL},
  p AS (SELECT *, {_QUERY} AS q FROM landing),
  u AS (SELECT *, coalesce(lower(trim({_param('utm_source', 'q')})), '') AS raw, coalesce(lower({_param('utm_medium', 'q')}), '') AS m, {_param('utm_campaign', 'q')} AS utm_campaign, {_param('utm_content', 'q')} AS utm_content, {_param('utm_id', 'q')} AS utm_id, {_param('h_ad_id', 'q')} AS h_ad_id,
    coalesce({', '.join(_CLICKS_SQL)}) AS click_id, coalesce({', '.join(f"CASE WHEN {c} IS NOT NULL THEN '{n}' END" for n, c in zip(CLICK_IDS, _CLICKS_SQL))}) AS click_type,
    {_param('fbclid', 'q')} AS fbclid, coalesce({', '.join(_CLICKS_SQL[:3])}) AS gclick, {_param('ttclid', 'q')} AS ttclid, {_HOST.replace('url', 'referrer')} AS host FROM p),
  s AS (SELECT *, CASE WHEN fbclid IS NOT NULL OR (raw IN {_META} AND utm_campaign IS NOT NULL) THEN 'meta' WHEN gclick IS NOT NULL THEN 'google' WHEN ttclid IS NOT NULL THEN 'tiktok' {_hosted('raw', *_SITES)}
    WHEN regexp_matches(raw, '(^|\.)trustpilot\.com$') OR raw = 'trustpilot' THEN 'trustpilot' WHEN raw IN {_META} THEN 'meta' WHEN raw IN ('google', 'adwords') THEN 'google' WHEN raw IN ('tiktok', 'tt') THEN 'tiktok' WHEN raw <> '' THEN raw END AS source,
    coalesce(host IS NULL OR regexp_matches(host, '(^|\.)example\.com$'), true) AS own FROM u),
  c AS (SELECT *, coalesce(source = 'meta' AND coalesce(utm_campaign, utm_id) IS NOT NULL AND coalesce(utm_content, h_ad_id) IS NOT NULL AND (m IN ('paid', 'paid_social', 'cpc', 'ppc') OR fbclid IS NOT NULL), false) AS is_paid_meta FROM s)
  SELECT page_id, click_id, click_type, coalesce(utm_campaign, utm_id) AS campaign, coalesce(utm_content, h_ad_id) AS ad, is_paid_meta,
    coalesce(source, CASE WHEN own THEN 'direct' {_hosted('host', *_SITES)} WHEN regexp_matches(host, '(^|\.)trustpilot\.com$') THEN 'trustpilot' ELSE host END) AS channel_source,
    CASE WHEN is_paid_meta THEN 'paid' WHEN source = 'meta' THEN 'social' WHEN m IN ('paid', 'paid_social', 'cpc', 'ppc') THEN 'cpc' WHEN source IN ('google', 'bing', 'youtube') AND m IN ('organic', 'referral', 'social') THEN 'organic'
      WHEN source IN ('google', 'tiktok') THEN 'cpc' WHEN source = 'trustpilot' AND m = 'company_profile' THEN 'referral' WHEN m <> '' THEN m WHEN own THEN 'none' {_hosted('host', *((x, 'organic') for x, _ in _SITES))} ELSE 'referral' END AS channel_medium FROM c"""


@query(_CLASSIFY_SQL)
def channel_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify(landing_urls(load(spark, sf_dir, "pages")))
    campaign, ad = F.coalesce("utm_campaign", "utm_id").alias("campaign"), F.coalesce("utm_content", "h_ad_id").alias("ad")
    return rows.select("page_id", "click_id", "click_type", campaign, ad, "is_paid_meta", "channel_source", "channel_medium")


@query(f"WITH {_LANDING_SQL} SELECT page_id, coalesce(nullif(trim(stored), ''), {_param('utm_source')}, 'none') AS source FROM (SELECT *, CASE WHEN page_id % 3 = 0 THEN ' ' WHEN page_id % 3 = 1 THEN 'stored' END AS stored FROM landing)")
def stored_over_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored parameter goes before that of the URL; blanks count as missing."""
    stored = F.when(F.col("page_id") % 3 == 0, " ").when(F.col("page_id") % 3 == 1, "stored")
    rows = landing_urls(load(spark, sf_dir, "pages"))
    return rows.select("page_id", first_known(stored, query_parameter(F.col("url"), "utm_source"), F.lit("none")).alias("source"))


_CONTACT_SQL = r"""contact AS (SELECT c_custkey, ' ' || replace(c_name, '#', '.') || CASE c_custkey % 3 WHEN 0 THEN '+news@GoogleMail.com ' WHEN 1 THEN '@gmail.com' ELSE '@Example.org ' END AS email,
    CASE c_custkey % 4 WHEN 0 THEN '(' || (200 + c_custkey % 700) || ') 234-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') WHEN 1 THEN '1-212-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') WHEN 2 THEN CASE WHEN c_custkey % 8 = 2 THEN '2122222222' ELSE '234567890' || (c_custkey % 10) END ELSE '1' || (3000000000 + c_custkey) END AS phone FROM customer)"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an email and a phone as people write them."""
    k = F.col("c_custkey")
    last = F.lpad((k % 10000).cast("string"), 4, "0")
    email = F.concat(F.lit(" "), F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.when(k % 3 == 0, "+news@GoogleMail.com ").when(k % 3 == 1, "@gmail.com").otherwise("@Example.org "))
    phone = F.when(k % 4 == 0, F.concat(F.lit("("), 200 + k % 700, F.lit(") 234-"), last)).when(k % 4 == 1, F.concat(F.lit("1-212-555-"), last)).when(k % 8 == 2, "2122222222").when(k % 8 == 6, F.concat(F.lit("234567890"), k % 10)).otherwise(F.concat(F.lit("1"), F.lit(3000000000) + k))
    return load(spark, sf_dir, "customer").select("c_custkey", email.alias("email"), phone.alias("phone"))


@query(rf"""WITH {_CONTACT_SQL}, n AS (SELECT c_custkey, lower(trim(email)) AS email, split_part(lower(trim(email)), '@', 1) AS local, split_part(lower(trim(email)), '@', 2) AS host, regexp_replace(phone, '\D', '', 'g') AS digits FROM contact),
  t AS (SELECT *, CASE WHEN length(digits) = 11 AND digits[1] = '1' THEN digits[2:] ELSE digits END AS ten, CASE WHEN host IN ('gmail.com', 'googlemail.com') THEN replace(split_part(local, '+', 1), '.', '') || '@gmail.com' END AS canonical FROM n),
  v AS (SELECT *, CASE WHEN regexp_matches(ten, '^[2-9][0-9]{{2}}[2-9][0-9]{{6}}$') AND ten[4:6] <> '555' AND ten[4:10] <> repeat(ten[10], 7) AND ten NOT IN ('0123456789', '1234567890', '9876543210') AND ten[1:9] <> '234567890' THEN '+1' || ten END AS phone FROM t)
  SELECT c_custkey, email, canonical, phone, array_to_string(list_sort(list_filter(['canonical_email:' || canonical, 'email:' || email, 'phone:' || phone], lambda x: x IS NOT NULL)), ' ') AS evidence FROM v""")
def normalized_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contacts(spark, sf_dir).select("c_custkey", lowered_key(F.col("email")).alias("email"), canonical_email(F.col("email")).alias("canonical"), nanp_phone(F.col("phone")).alias("phone"))
    keys = evidence_keys(email=F.col("email"), canonical_email=F.col("canonical"), phone=F.col("phone"))
    return rows.withColumn("evidence", F.array_join(keys, " "))
