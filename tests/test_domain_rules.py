"""Rules of the domain with rows written out by hand: inputs and what must come of them."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from wherry.functions.text import nanp_phone
from wherry.operators.attribution import credits, journeys
from wherry.operators.identity import MOST_KEYS, profiles, resolve
from wherry.operators.joins import as_of
from wherry.operators.sessions import dirty_visitors, session_rollup, sessionize
from wherry.operators.versions import without_conflicts
from wherry.plans.attribution import channel_label
from wherry.plans.channels import classify
from wherry.streaming.sessions import current_sessions, rebuild

MODULES = ("relational", "aggregates", "sessions", "attribution", "channels", "identity", "versions", "payments", "marts", "rules", "incremental", "registry")


def test_every_module_can_be_the_first_import():
    code = "import importlib, sys; importlib.import_module(sys.argv[1]); from wherry.plans import QUERIES; assert len(QUERIES) > 100"
    running = [subprocess.Popen([sys.executable, "-c", code, f"wherry.plans.{m}"]) for m in MODULES]
    assert [p.wait() for p in running] == [0] * len(MODULES)


PHONES = {
    "(415) 234-5678": "+14152345678", "1-415-234-5678": "+14152345678", "+1 415 234 5678": "+14152345678", "3456789012": "+13456789012", "2012223334": "+12012223334",
    "2345678900": None, "2345678905": None, "2345678901": None, "2122222222": None, "2222222222": None, "9876543210": None, "1234567890": None, "0123456789": None,
    "4155551234": None, "1152345678": None, "4151345678": None, "415234567": None, "24152345678": None, "": None, "abc": None, "2135000000": "+12135000000",
}


def test_phones(spark):
    rows = spark.createDataFrame([(p,) for p in PHONES] + [(None,)], "p string").select("p", nanp_phone(F.col("p")).alias("n")).collect()
    assert {r["p"]: r["n"] for r in rows} == PHONES | {None: None}


#: query string, referrer -> source, medium, paid Meta
LANDINGS = [
    ("utm_source=meta&utm_medium=ppc&utm_campaign=c&utm_content=a", None, ("meta", "paid", True)),
    ("utm_source=fb&utm_medium=cpc&utm_id=7&h_ad_id=9", None, ("meta", "paid", True)),
    ("utm_source=fb&utm_medium=email&utm_campaign=c&utm_content=a", None, ("meta", "social", False)),
    ("utm_campaign=c&utm_content=a&fbclid=x", None, ("meta", "paid", True)),
    ("fbclid=x", "https://l.facebook.com/", ("meta", "social", False)),
    ("gclid=x", None, ("google", "cpc", False)),
    ("utm_source=google&utm_medium=organic", None, ("google", "organic", False)),
    ("ttclid=t", None, ("tiktok", "cpc", False)),
    ("utm_source=Newsletter&utm_medium=Email", None, ("newsletter", "email", False)),
    ("", None, ("direct", "none", False)),
    ("", "https://shop.example.com/", ("direct", "none", False)),
    ("", "https://badexample.com/", ("badexample.com", "referral", False)),
    ("", "https://notgoogle.com/", ("notgoogle.com", "referral", False)),
    ("", "https://www.google.co.uk/", ("google.co.uk", "referral", False)),
    ("", "https://www.google.de/", ("google", "organic", False)),
    ("", "android-app://com.google.android.gm/", ("google", "organic", False)),
    ("", "https://l.facebook.com/", ("meta", "organic", False)),
    ("", "https://youtu.be/x", ("youtube", "organic", False)),
    ("", "https://uk.trustpilot.com/x", ("trustpilot", "referral", False)),
    ("utm_source=trustpilot&utm_medium=company_profile", None, ("trustpilot", "referral", False)),
]


def test_channels(spark):
    rows = spark.createDataFrame([(k, f"https://site.example.com/p?{q}", r) for k, (q, r, _) in enumerate(LANDINGS)], "page_id long, url string, referrer string")
    found = {r["page_id"]: (r["channel_source"], r["channel_medium"], r["is_paid_meta"]) for r in classify(rows).collect()}
    assert [found[k] for k in range(len(LANDINGS))] == [want for _, _, want in LANDINGS]


def test_channel_labels(spark):
    wanted = {
        (None, None, None): "unattributed", ("t", "meta", "ppc"): "meta / paid", ("t", "meta", "social"): "meta / organic", ("t", "m.facebook.com", "referral"): "meta / organic", ("t", "google", "organic"): "google / organic",
        ("t", "google", "cpc"): "google / cpc", ("t", "google.fr", "referral"): "google / organic", ("t", "bing", "referral"): "bing / organic", ("t", "direct", "none"): "direct / none", ("t", "notgoogle.com", "referral"): "notgoogle.com / referral",
        ("t", "trustpilot", "anything"): "trustpilot / referral", ("t", "youtube", "referral"): "youtube / organic", ("t", "meta", "email"): "meta / email",
    }
    rows = spark.createDataFrame(list(wanted), "touch_id string, source string, medium string").select("*", channel_label().alias("label")).collect()
    assert {(r["touch_id"], r["source"], r["medium"]): r["label"] for r in rows} == wanted


def test_null_keys_do_not_meet_in_as_of(spark):
    left = spark.createDataFrame([(1, None, "x", 5), (2, "a", None, 5), (3, "a", "x", 5), (4, None, None, 5)], "id int, k string, m string, t int")
    right = spark.createDataFrame([(None, "x", 1, 20), ("a", None, 1, 21), ("a", "x", 1, 22), (None, None, 1, 23)], "k string, m string, t int, v int")
    assert {(r["id"], r["v"]) for r in as_of(left, right, ["k", "m"], "t", "t", ["v"], "v").collect()} == {(1, None), (2, None), (3, 22), (4, None)}


def test_a_winner_without_a_time_comes_last(spark):
    evidence = spark.createDataFrame([(1, "email:a", 5), (2, "email:b", None), (2, "email:a", 9)], "fact int, key string, seen_at int")
    labels = spark.createDataFrame([("email:a", "c"), ("email:b", "c")], "key string, component string")
    assert [r["winner"] for r in profiles(evidence, labels).collect()] == ["email:a"]


def stream_of(spark, tmp_path, batches):
    schema = "page_id string, visitor string, ts timestamp"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
        rebuild(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return sorted((r["visitor"], r["n_pages"]) for r in current_sessions(spark, str(tmp_path / "out")).collect())


def test_a_page_that_changes_its_visitor_leaves_the_former_one(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 12)
    assert stream_of(spark, tmp_path, [[("p", "a", at)], [("p", "b", at)]]) == [("b", 1)]


def test_a_late_page_may_retract_a_session(spark, tmp_path):
    """Two sessions become one when the page between them comes late: what was counted before must go."""
    minute = lambda m: dt.datetime(2024, 1, 1, 12) + dt.timedelta(minutes=m)
    first = [("p1", "a", minute(0)), ("p3", "a", minute(50))]
    assert stream_of(spark, tmp_path / "one", [first]) == [("a", 1), ("a", 1)]
    assert stream_of(spark, tmp_path / "two", [first, [("p2", "a", minute(25))]]) == [("a", 3)]


def test_gaps_and_tenants(spark):
    at = dt.datetime(2024, 1, 1, 12)
    gap = dt.timedelta(minutes=30, seconds=59, microseconds=999_999)
    rows = [(1, "v", "p1", at), (1, "v", "p2", at + gap), (1, "v", "p3", at + gap + dt.timedelta(minutes=31)), (2, "v", "p4", at)]
    pages = spark.createDataFrame(rows, "tenant int, visitor string, page_id string, ts timestamp")
    found = session_rollup(sessionize(pages, ["tenant", "visitor"]), ["tenant", "visitor"]).collect()
    assert sorted((r["tenant"], r["session_number"], r["n_pages"]) for r in found) == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]
    assert len({r["session_id"] for r in found}) == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_credits_of_many_measures_and_paid_models_equal_the_journeys(spark, seed):
    t = spark.range(300).selectExpr(
        f"concat('p', pmod(hash(id, {seed}), 20)) profile", "concat('t', id) touch_id", f"timestamp_seconds(1700000000 + pmod(hash(id, {seed}, 1), 5000)) touch_time",
        f"case pmod(hash(id, {seed}, 2), 3) when 0 then 'direct' when 1 then 'google' else 'bing' end source", "if(id % 2 = 0, 'cpc', 'none') medium", "'c' campaign", "'a' ad",
    )
    c = spark.range(200).selectExpr(f"concat('p', pmod(hash(id, {seed}, 5), 25)) profile", "id conversion_id", f"timestamp_seconds(1700000000 + pmod(hash(id, {seed}, 6), 5000)) conversion_time", "cast(id % 7 as double) m1", "cast(-id as double) m2")
    names = ("first", "last", "multi", "first_paid", "last_paid", "multi_paid")
    pairs = journeys(t, c).filter("touch_id is not null")
    want = pairs.groupBy("touch_id").agg(*[F.sum(F.col(m) * F.col(f"{n}_weight")).alias(f"{n}_{m}") for n in names for m in ("m1", "m2")]).collect()
    got = {r["touch_id"]: r for r in credits(t, c, ["m1", "m2"]).filter("touch_id is not null").collect()}
    for r in want:
        for n in names:
            for m in ("m1", "m2"):
                assert got[r["touch_id"]][f"{n}_{m}"] == pytest.approx(r[f"{n}_{m}"], abs=1e-6)


def test_conflicting_versions_are_an_error(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, "x"), ("b", 2, "y")], "key string, version int, hash string")
    assert without_conflicts(rows.filter("key = 'a'"), ["key", "version"], "hash").count() == 2
    with pytest.raises(ValueError, match=r"\('b', 2\)"):
        without_conflicts(rows, ["key", "version"], "hash")


def test_resolving_drops_tombstones_and_takes_the_latest_mapping(spark):
    mapping = spark.createDataFrame([("k1", "old", 1, False), ("k1", "new", 2, False), ("k2", "p2", 1, False), ("k2", "p2", 2, True)], "key string, profile_id string, version int, is_deleted boolean")
    requests = spark.createDataFrame([(1, ["k2", "k1"]), (2, ["k2"]), (3, []), (4, ["zz"])], "request_id int, keys array<string>")
    found = {r["request_id"]: (r["matched_key"], r["profile_id"]) for r in resolve(requests, mapping, MOST_KEYS).collect()}
    assert found == {1: ("k1", "new"), 2: (None, None), 3: (None, None), 4: (None, None)}
    with pytest.raises(Exception, match="more than 5 identifiers"):
        resolve(spark.createDataFrame([(1, list("abcdef"))], "request_id int, keys array<string>"), mapping, MOST_KEYS).collect()


def test_every_cause_of_a_dirty_visitor(spark):
    pages = spark.createDataFrame([("a", 1, "f1"), ("b", 9, "f1"), ("c", 1, None), ("d", 1, None), ("d", 1, None), ("e", 1, None), ("g", 1, "f2")], "visitor string, ingested_at long, fbclid string")
    built = spark.createDataFrame([("a", 1), ("c", 1), ("d", 1), ("e", 1), ("g", 1), ("gone", 4)], "visitor string, n_pages long")
    names = lambda **more: {r[0] for r in dirty_visitors(pages, 5, more.pop("built", None), **more).collect()}
    assert names() == {"b"}
    assert names(click="fbclid") == {"a", "b"}  # a saw the click first
    assert names(built=built.select("visitor")) == {"b"}
    assert names(built=built) == {"b", "d", "gone"}  # d has a page more, the pages of gone went
    assert names(changed=spark.createDataFrame([("c",)], "visitor string")) == {"b", "c"}
