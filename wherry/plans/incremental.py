"""Change capture, commit pointers, pinned generations and the streaming rebuild."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.operators.sessions import dirty_visitors, revision, session_rollup, sessionize
from wherry.operators.versions import latest_by, overlay
from wherry.plans.registry import query
from wherry.plans.sessions import SESSION_SQL, page_views
from wherry.session import shared_dir
from wherry.sources.tables import load, stream_parquet
from wherry.streaming.sessions import current_sessions, rebuild

_SINCE, _UPTO = "2024-01-20", "2024-01-25"


@query(f"SELECT DISTINCT user_id FROM events WHERE ts > TIMESTAMP '{_SINCE}' AND ts <= TIMESTAMP '{_UPTO}' AND event_type IN ('purchase', 'signup')")
def changed_conversions(spark: SparkSession, sf_dir: str, since: str = _SINCE, upto: str = _UPTO) -> DataFrame:
    """Profiles with conversions in an ingest interval, open below and closed above."""
    rows = load(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "signup"))
    return rows.filter((F.col("ts") > F.to_timestamp_ntz(F.lit(since), F.lit("yyyy-MM-dd"))) & (F.col("ts") <= F.to_timestamp_ntz(F.lit(upto), F.lit("yyyy-MM-dd")))).select("user_id").distinct()


@query(f"WITH {SESSION_SQL} SELECT visitor, session_number, session_id, first_page, last_page, n_pages, session_start, session_end, seconds FROM sessions WHERE visitor IN (SELECT visitor FROM pages WHERE ts > TIMESTAMP '{_SINCE}')")
def dirty_visitor_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors with pages after a time are rebuilt from their whole history."""
    pages = page_views(spark, sf_dir)
    at = pages.withColumn("ingested_at", F.unix_micros(F.col("ts").cast("timestamp")))
    since = spark.sql(f"SELECT unix_micros(TIMESTAMP '{_SINCE}') AS t").first()["t"]
    return session_rollup(sessionize(pages.join(dirty_visitors(at, since, None), "visitor", "left_semi")))


@query(f"""WITH RECURSIVE {SESSION_SQL}, old_named AS (SELECT *, md5(visitor || '|' || CAST(sum(CASE WHEN g IS NULL OR g >= 1860000000 THEN 1 ELSE 0 END) OVER (PARTITION BY visitor ORDER BY ts, page_id ROWS UNBOUNDED PRECEDING) AS BIGINT)) AS id FROM (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY visitor ORDER BY ts, page_id) AS g FROM pages WHERE ts < TIMESTAMP '{_SINCE}')),
  o AS (SELECT id, count(*) AS n, min(page_id) AS a, max(page_id) AS b FROM old_named GROUP BY 1), n AS (SELECT session_id AS id, count(*) AS n, min(page_id) AS a, max(page_id) AS b FROM named GROUP BY 1)
  SELECT coalesce(o.id, n.id) AS session_id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM o FULL JOIN n ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL OR o.n <> n.n OR o.a <> n.a OR o.b <> n.b""")
def session_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages after a time change in the session table."""
    pages = page_views(spark, sf_dir)
    digest = lambda rows: sessionize(rows).groupBy("session_id").agg(F.count("*").alias("n"), F.min("page_id").alias("a"), F.max("page_id").alias("b"))
    return revision(digest(pages.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(_SINCE), F.lit("yyyy-MM-dd")))), digest(pages))


_COMMIT_SQL = """versions AS (SELECT o_orderkey AS conversion, 1 AS commit, o_totalprice AS amount FROM orders UNION ALL SELECT o_orderkey, 2, round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, 3, -1.0 FROM orders WHERE o_orderpriority = '5-LOW'),
  commits AS (SELECT o_orderkey AS conversion, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS commit FROM orders)"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, sf_dir, "orders")
    row = lambda df, n, amount: df.select(F.col("o_orderkey").alias("conversion"), F.lit(n).cast("bigint").alias("commit"), amount.alias("amount"))
    price = F.col("o_totalprice")
    rows = row(o, 1, price).unionByName(row(o.filter("o_orderstatus <> 'F'"), 2, F.round(price * 2, 2))).unionByName(row(o.filter("o_orderpriority = '5-LOW'"), 3, F.lit(-1.0)))
    return rows, o.select(F.col("o_orderkey").alias("conversion"), F.when(F.col("o_orderstatus") == "O", 2).otherwise(1).cast("bigint").alias("commit"))


@query(f"WITH {_COMMIT_SQL} SELECT v.conversion, CAST(v.commit AS BIGINT) AS commit, amount FROM versions v JOIN commits c ON c.conversion = v.conversion AND c.commit = v.commit")
def committed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are visible only under the latest commit of their conversion; later writes without a commit are not."""
    rows, commits = _versions(spark, sf_dir)
    return rows.join(latest_by(commits, ["conversion"], [F.col("commit").desc()]), ["conversion", "commit"])


@query(f"WITH {_COMMIT_SQL}, pin AS (SELECT 'g7' AS token, 2 AS generation) SELECT conversion, amount FROM (SELECT v.*, row_number() OVER (PARTITION BY conversion ORDER BY commit DESC) AS k FROM versions v, pin WHERE v.commit <= generation) WHERE k = 1")
def pinned_generation(spark: SparkSession, sf_dir: str, token: str = "g7") -> DataFrame:
    """What readers of a pinned generation see: the newest version at or before it. An unknown token is an error."""
    rows, _ = _versions(spark, sf_dir)
    pins = {"g7": 2}
    return latest_by(rows.filter(F.col("commit") <= pins[token]), ["conversion"], [F.col("commit").desc()]).select("conversion", "amount")


@query(f"WITH {_COMMIT_SQL}, seed AS (SELECT conversion, amount FROM versions WHERE commit = 1), delta AS (SELECT v.conversion, amount FROM versions v JOIN commits c ON c.conversion = v.conversion AND c.commit = v.commit WHERE v.commit > 1) SELECT conversion, amount FROM delta UNION ALL SELECT * FROM seed WHERE conversion NOT IN (SELECT conversion FROM delta)")
def committed_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, commits = _versions(spark, sf_dir)
    delta = rows.filter("commit > 1").join(commits, ["conversion", "commit"]).withColumn("is_deleted", F.lit(False))
    return overlay(rows.filter("commit = 1").select("conversion", "amount"), delta, ["conversion"])


@query("""SELECT 'orders without customer' AS gate, count(*) AS n_failed, count(*) = 0 AS passed FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'line items without order', count(*), count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'negative prices', count(*), count(*) = 0 FROM orders WHERE o_totalprice < 0
  UNION ALL SELECT 'repeated keys', count(*), count(*) = 0 FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def readiness_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality gates before a generation is published; publication fails closed."""
    t = lambda n: load(spark, sf_dir, n)
    orders = t("orders")
    checks = {
        "orders without customer": orders.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
        "line items without order": t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
        "negative prices": orders.filter("o_totalprice < 0"),
        "repeated keys": orders.groupBy("o_orderkey").count().filter("count > 1"),
    }
    counted = [rows.agg(F.lit(name).alias("gate"), F.count("*").alias("n_failed")) for name, rows in checks.items()]
    found = counted[0]
    for x in counted[1:]:
        found = found.unionByName(x)
    return found.withColumn("passed", F.col("n_failed") == 0)


def publish(gates: DataFrame, write, activate) -> None:
    """Write a generation and then move the pointer, if every gate passed; else raise and leave the pointer."""
    failed = [r["gate"] for r in gates.filter(~F.col("passed")).collect()]  # one row per gate
    if failed:
        raise RuntimeError(f"not published: {', '.join(failed)}")
    write()
    activate()


@query(f"WITH {SESSION_SQL} SELECT visitor, session_number, session_id, first_page, last_page, n_pages, session_start, session_end, seconds FROM sessions")
def streaming_session_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming rebuild over the event files, which equals the batch result."""
    path = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    events = load(spark, sf_dir, "events")
    pages = stream_parquet(spark, f"{sf_dir}/events.parquet", events.schema).filter(F.col("event_type").isin("view", "click"))
    rebuild(pages.select(F.col("event_id").alias("page_id"), F.col("user_id").cast("string").alias("visitor"), "ts"), path, f"{path}/checkpoint")
    return current_sessions(spark, path)
