"""Hand-made cases and properties of the operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wherry.functions.calendar import local_date, local_hour, report_window, weighted
from wherry.functions.text import canonical_email, hash_key, nanp_phone, query_parameter
from wherry.operators.attribution import credits, journeys
from wherry.operators.components import connected_components
from wherry.operators.joins import as_of, full_on, left_any, page_after, policy_join
from wherry.operators.sessions import dirty_visitors, revision, session_rollup, sessionize
from wherry.operators.versions import after_last_delete, collapse, conflicts, overlay
from wherry.sources.tables import copy_append, copy_replace, literal_rows, read_ndjson, stream_ndjson
from wherry.streaming.sessions import current_sessions, rebuild

PAGES = "page_id long, visitor string, ts timestamp_ntz"


def at(text):
    return dt.datetime.fromisoformat(text)


def test_session_gap_is_whole_minutes(spark):
    rows = [(1, "a", at("2024-01-01T12:00:59.900000")), (2, "a", at("2024-01-01T12:31:59.899999")), (3, "b", at("2024-01-01T12:00:00")), (4, "b", at("2024-01-01T12:31:00")), (5, "b", None), (6, "c", at("2024-01-01T00:00:00")), (7, "c", at("2024-01-01T00:00:00"))]
    found = {r["page_id"]: r["session_number"] for r in sessionize(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 2, 6: 1, 7: 1}


def test_late_page_joins_sessions_and_renumbers(spark):
    first = [(1, "a", at("2024-01-01T10:00:00")), (2, "a", at("2024-01-01T10:50:00")), (3, "a", at("2024-01-01T12:00:00"))]
    late = [*first, (4, "a", at("2024-01-01T10:25:00"))]
    count = lambda rows: session_rollup(sessionize(spark.createDataFrame(rows, PAGES))).count()
    assert (count(first), count(late)) == (3, 2)
    roll = lambda rows: session_rollup(sessionize(spark.createDataFrame(rows, PAGES))).drop("visitor")
    changes = {r["change"] for r in revision(roll(first), roll(late)).collect()}
    assert changes == {"changed", "removed"}


def test_sessions_do_not_depend_on_input_order(spark):
    rows = [(k, f"v{k % 5}", at("2024-01-01T00:00:00") + dt.timedelta(minutes=random.Random(k).randrange(3000))) for k in range(200)]
    shuffled = random.Random(1).sample(rows, len(rows))
    one, two = (sorted(map(tuple, session_rollup(sessionize(spark.createDataFrame(x, PAGES))).collect())) for x in (rows, shuffled))
    assert one == two


def test_streaming_equals_batch_with_late_pages(spark, tmp_path):
    rows = [(k, f"v{k % 4}", f"2024-01-01T{k * 7 % 24:02d}:{k * 13 % 60:02d}:00") for k in range(120)]
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "page_id long, visitor string, ts timestamp_ntz"
    for n in range(3):  # three arrivals, times mixed, some rows twice
        part = rows[n::3] + rows[:5]
        (folder / f"{n}.json").write_text("\n".join(f'{{"page_id": {p}, "visitor": "{v}", "ts": "{t}"}}' for p, v, t in part))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    rebuild(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = session_rollup(sessionize(spark.createDataFrame([(p, v, at(t)) for p, v, t in rows], PAGES)))
    got = current_sessions(spark, str(tmp_path / "out")).select(batch.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_dirty_visitors(spark):
    pages = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "visitor string, ingested_at long")
    built = spark.createDataFrame([("a",), ("b",)], "visitor string")
    assert {r[0] for r in dirty_visitors(pages, 1, None, upto=5).collect()} == {"b"}
    assert {r[0] for r in dirty_visitors(pages, 100, built).collect()} == {"c"}


TOUCH = "profile string, touch_id string, touch_time timestamp_ntz, source string, medium string, campaign string, ad string"
CONVERSION = "profile string, conversion_id long, conversion_time timestamp_ntz, amount double"


def touches_of(spark, *marks):
    paid = {"d": ("direct", "none", None, None), "g": ("google", "cpc", "c", "a"), "o": ("bing", "organic", None, None)}
    rows = [("p", f"t{k}", at(f"2024-01-01T{k:02d}:00:00"), *paid[m]) for k, m in enumerate(marks)]
    return spark.createDataFrame(rows, TOUCH)


@pytest.mark.parametrize(("marks", "weights"), [("d", [1.0]), ("dgg", [0.4, 0.2, 0.4]), ("gd", [1.0]), ("go", [0.5, 0.5]), ("gogog", [0.4, 0.2 / 3, 0.2 / 3, 0.2 / 3, 0.4])])
def test_weights(spark, marks, weights):
    conversion = spark.createDataFrame([("p", 1, at("2024-01-02T00:00:00"), 10.0)], CONVERSION)
    rows = journeys(touches_of(spark, *marks), conversion).orderBy("place").collect()
    assert [r["multi_weight"] for r in rows] == pytest.approx(weights)
    for r in rows:
        assert r["multi_paid_weight"] == pytest.approx(r["multi_weight"] if r["is_paid"] else 0.0)


def test_touch_at_conversion_time_counts_and_later_ones_do_not(spark):
    touches = touches_of(spark, "g", "g")
    rows = [("p", 1, at("2024-01-01T00:00:00"), 1.0), ("p", 2, at("2023-12-31T00:00:00"), 1.0)]
    found = {r["conversion_id"]: (r["touch_id"], r["multi_weight"]) for r in journeys(touches, spark.createDataFrame(rows, CONVERSION)).collect()}
    assert found == {1: ("t0", 1.0), 2: (None, 1.0)}


def test_linear_credits_equal_pairs(spark):
    r = random.Random(7)
    kinds = [("direct", "none", None, None), ("google", "cpc", "c", "a"), ("bing", "organic", None, None)]
    touch = [(f"p{r.randrange(6)}", f"t{k}", at("2024-01-01T00:00:00") + dt.timedelta(hours=r.randrange(50)), *r.choice(kinds)) for k in range(80)]
    conv = [(f"p{r.randrange(7)}", k, at("2024-01-01T00:00:00") + dt.timedelta(hours=r.randrange(60)), float(r.randrange(-5, 50))) for k in range(90)]
    t, c = spark.createDataFrame(touch, TOUCH), spark.createDataFrame(conv, CONVERSION)
    pairs = journeys(t, c).groupBy("profile", "touch_id").agg(*[F.sum(F.col("amount") * F.col(f"{m}_weight")).alias(m) for m in ("first", "last", "multi")])
    want = {(x["profile"], x["touch_id"]): (x["first"], x["last"], x["multi"]) for x in pairs.collect()}
    got = {(x["profile"], x["touch_id"]): (x["first_amount"], x["last_amount"], x["multi_amount"]) for x in credits(t, c, ["amount"]).collect()}
    for key, value in got.items():
        assert value == pytest.approx(want.get(key, (0.0, 0.0, 0.0)), abs=1e-6)
    assert set(want) <= set(got)


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(90)] + [(k, k + 1) for k in range(200, 230)]
    edges = [(a, b) for a, b in edges if a != b]
    found = dict(map(tuple, connected_components(spark.createDataFrame([*edges, (None, 3), (5, 5)], "u long, v long")).collect()))
    assert found == union_find(edges)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_versions(spark):
    rows = spark.createDataFrame([("a", 1, 0, "x"), ("a", 2, 1, "y"), ("b", 1, 0, "x"), ("b", 1, 0, "z"), ("c", 1, 1, "x"), ("c", 2, 0, "w")], "key string, version int, is_deleted int, h string")
    order = [F.col("version").desc(), F.col("h").desc()]
    assert {(r["key"], r["h"]) for r in collapse(rows, ["key"], order).collect()} == {("b", "z"), ("c", "w")}
    assert [r["key"] for r in conflicts(rows, ["key", "version"], "h").collect()] == ["b"]
    assert {r["key"] for r in after_last_delete(rows, ["key"], ["version", "h"]).collect()} == {"b", "c"}
    seed = spark.createDataFrame([("a", "s"), ("z", "s")], "key string, h string")
    assert {r["key"] for r in overlay(seed, rows.filter("key = 'a' and version = 2"), ["key"]).collect()} == {"z"}


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, g string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("d", 4)], "g string, v int")
    assert left_any(left, right, ["g"], [F.col("v").desc()]).count() == 3
    full = {(r["g"], r["id"], r["v"], r["has_left"], r["has_right"]) for r in full_on(left, right, ["g"]).collect()}
    assert (None, 2, 3, 1, 1) in full and ("d", None, 4, 0, 1) in full and ("c", 3, None, 1, 0) in full
    assert [r["id"] for r in page_after(left.select("id"), ["id"], (1,), 1).collect()] == [2]
    with pytest.raises(ValueError, match="policy"):
        policy_join(left, spark.range(200_000))


def test_as_of(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 5, 51), ("a", 6, 60)], "k string, t int, v int")
    assert {(r["id"], r["v"]) for r in as_of(left, right, ["k"], "t", "t", ["v"], "v").collect()} == {(1, 51), (2, None), (3, None)}


def test_identifiers(spark):
    rows = spark.createDataFrame([(" Jo.Ann+x@GoogleMail.com ", "(212) 234-5678"), ("a@b.org", "212-555-1234"), (None, "2222222222"), ("", "+1 415 234 5678")], "e string, p string")
    found = rows.select(canonical_email(F.col("e")).alias("e"), nanp_phone(F.col("p")).alias("p")).collect()
    assert [tuple(r) for r in found] == [("joann@gmail.com", "+12122345678"), (None, None), (None, None), (None, "+14152345678")]
    url = spark.createDataFrame([("https://a.b/?x=1&utm=&y=2#utm=3",)], "u string").select(query_parameter(F.col("u"), "y"), query_parameter(F.col("u"), "utm"), hash_key(F.lit("a"), F.lit(None).cast("string"))).first()
    assert tuple(url) == ("2", None, None)


def test_calendar_across_clock_changes(spark):
    rows = spark.createDataFrame([("2024-03-10 09:59:00",), ("2024-03-10 10:00:00",), ("2024-11-03 08:30:00",), ("2024-11-03 09:30:00",)], "t string").withColumn("t", F.to_timestamp("t"))
    hours = [r[0].hour for r in rows.select(local_hour(F.col("t")).cast("timestamp_ntz")).collect()]
    assert hours == [1, 3, 1, 1]
    assert rows.select(local_date(F.col("t"))).first()[0] == dt.date(2024, 3, 10)


def test_report_window_before_and_after_monday_ten(spark):
    rows = spark.createDataFrame([("2024-01-22 17:59:00",), ("2024-01-22 18:30:00",)], "t string").withColumn("t", F.to_timestamp("t"))
    found = [r[0] for r in rows.select(report_window(F.col("t"))["window_start"].cast("timestamp_ntz")).collect()]
    assert found == [dt.datetime(2024, 1, 15, 18), dt.datetime(2024, 1, 22, 18)]


def test_impossible_date_fails(spark):
    from pyspark.errors import PySparkException

    from wherry.functions.calendar import in_range

    with pytest.raises(PySparkException):
        spark.range(1).withColumn("t", F.current_timestamp()).filter(in_range(F.col("t"), "2026-02-30", "2026-03-01")).collect()


def test_money_keeps_nine_places(spark):
    found = spark.range(1).select(weighted(F.lit("100.00").cast("decimal(38,9)"), F.lit(1 / 3)).alias("x")).first()["x"]
    assert str(found) == "33.333333300"


def test_copies_and_landing(spark, tmp_path):
    path = str(tmp_path / "t")
    copy_append(literal_rows(spark, "k int, v int", (1, 1), (2, 2)), path, ("k",))
    copy_replace(literal_rows(spark, "k int, v int", (2, 5)), path, ("k",))
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, 1), (2, 5)}
    folder = tmp_path / "nd"
    folder.mkdir()
    (folder / "a.json").write_text('{"event_id": 1, "extra": 2}\nbroken\n')
    assert [r["event_id"] for r in read_ndjson(spark, str(folder)).collect()] == [1, None]
    assert stream_ndjson(spark, str(folder)).isStreaming
