"""Scans, projections, joins, set operations and limits, one query for each kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wherry.operators.joins import as_of, full_on, left_any, null_safe, page_after, policy_join
from wherry.plans.registry import query
from wherry.sources.tables import literal_rows, load


@query("""SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS gross FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01' AND l_discount > 0.05""")
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").filter("l_shipdate >= timestamp_ntz'1995-01-01' and l_shipdate < timestamp_ntz'1996-01-01' and l_discount > 0.05")
    return rows.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("gross"))


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def inner_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: load(spark, sf_dir, n)
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'")
def left_join_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return load(spark, sf_dir, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


_DAILY = """o AS (SELECT CAST(o_orderdate AS DATE) AS day, nullif(o_orderstatus, 'P') AS grain, sum(o_totalprice) AS spend FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL),
            l AS (SELECT CAST(l_shipdate AS DATE) AS day, nullif(l_linestatus, 'P') AS grain, sum(l_extendedprice) AS revenue FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)"""


@query(f"""WITH {_DAILY} SELECT coalesce(o.day, l.day) AS day, coalesce(o.grain, l.grain) AS grain, round(spend, 2) AS spend, round(revenue, 2) AS revenue,
              CASE WHEN o.day IS NULL THEN 0 ELSE 1 END AS has_left, CASE WHEN l.day IS NULL THEN 0 ELSE 1 END AS has_right
           FROM o FULL JOIN l ON o.day IS NOT DISTINCT FROM l.day AND o.grain IS NOT DISTINCT FROM l.grain""")
def full_join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").filter("o_orderpriority <> '1-URGENT'").groupBy(F.col("o_orderdate").cast("date").alias("day"), F.expr("nullif(o_orderstatus, 'P')").alias("grain")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    r = load(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'").groupBy(F.col("l_shipdate").cast("date").alias("day"), F.expr("nullif(l_linestatus, 'P')").alias("grain")).agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return full_on(o, r, ["day", "grain"])


@query("""WITH a AS (SELECT n_regionkey AS region, count(*) AS nations FROM nation WHERE n_regionkey <> 0 GROUP BY 1),
               b AS (SELECT n_regionkey AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 1 GROUP BY 1),
               c AS (SELECT n_regionkey AS region, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 2 GROUP BY 1)
          SELECT coalesce(a.region, b.region, c.region) AS region, coalesce(nations, 0) AS nations, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers
          FROM a FULL JOIN b ON a.region = b.region FULL JOIN c ON coalesce(a.region, b.region) = c.region""")
def full_join_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_regionkey").alias("region"))
    a = nation.filter("region <> 0").groupBy("region").agg(F.count("*").alias("nations"))
    b = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("key")).filter("region <> 1").groupBy("region").agg(F.count("*").alias("customers"))
    c = load(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("key")).filter("region <> 2").groupBy("region").agg(F.count("*").alias("suppliers"))
    met = a.join(b, "region", "full").join(c, "region", "full")
    return met.select("region", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("nations", "customers", "suppliers")])


@query("""WITH p AS (SELECT 'small' AS band, 0.0 AS low, 50000.0 AS high UNION ALL SELECT 'large', 50000.0, 1e18)
          SELECT o_orderkey, band FROM orders CROSS JOIN p WHERE o_totalprice >= low AND o_totalprice < high""")
def policy_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = literal_rows(spark, "band string, low double, high double", ("small", 0.0, 50000.0), ("large", 50000.0, 1e18))
    orders = load(spark, sf_dir, "orders")
    return policy_join(orders, policy, (F.col("o_totalprice") >= F.col("low")) & (F.col("o_totalprice") < F.col("high"))).select("o_orderkey", "band")


@query("""SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1) ON c_custkey = o_custkey""")
def left_any_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return left_any(load(spark, sf_dir, "customer"), orders, ["c_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).select("c_custkey", "o_orderkey")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def left_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").join(load(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_join_in_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = load(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return load(spark, sf_dir, "part").join(returned, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand")


@query("""WITH a AS (SELECT event_id, nullif(user_id % 4, 0) AS g FROM events), b AS (SELECT nullif(n_nationkey % 4, 0) AS g, min(n_name) AS name FROM nation GROUP BY 1)
          SELECT event_id, name FROM a JOIN b ON a.g IS NOT DISTINCT FROM b.g""")
def null_safe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "events").select("event_id", F.expr("nullif(user_id % 4, 0)").alias("g"))
    b = load(spark, sf_dir, "nation").groupBy(F.expr("nullif(n_nationkey % 4, 0)").cast("bigint").alias("g")).agg(F.min("n_name").alias("name"))
    return a.join(b, null_safe(a, b, ["g"])).select("event_id", "name")


@query("""SELECT a.event_id AS purchase_id, count(*) AS n_before FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts <= a.ts AND b.event_type = 'click'
          WHERE a.event_type = 'purchase' GROUP BY 1""")
def theta_join_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of the user up to each purchase: a running count over both, not their pairs."""
    events = load(spark, sf_dir, "events").filter("event_type in ('purchase', 'click') and user_id is not null and ts is not null")
    upto = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.select("event_type", F.col("event_id").alias("purchase_id"), F.count_if(F.col("event_type") == "click").over(upto).alias("n_before"))
    return counted.filter("event_type = 'purchase' and n_before > 0").select("purchase_id", "n_before")


@query("""SELECT p.event_id, c.event_id AS click_id, c.value AS click_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p
          LEFT JOIN LATERAL (SELECT event_id, value FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id AND c.ts <= p.ts ORDER BY c.ts DESC, c.event_id DESC LIMIT 1) c ON true""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return as_of(purchases, clicks, ["user_id"], "ts", "ts", ["click_id", "click_value"], "click_id").select("event_id", "click_id", "click_value")


@query("""SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word IN ('the', 'de', 'der') GROUP BY ALL""")
def explode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    return words.filter(F.col("word").isin("the", "de", "der")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, method, CASE method WHEN 'first' THEN o_totalprice WHEN 'last' THEN -o_totalprice ELSE 0 END AS amount
          FROM orders CROSS JOIN (SELECT unnest(['first', 'last', 'solo']) AS method) WHERE method <> 'solo' OR o_orderstatus = 'F'""")
def unpivot_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").withColumn("method", F.explode(F.array(F.lit("first"), F.lit("last"), F.lit("solo"))))
    amount = F.when(F.col("method") == "first", F.col("o_totalprice")).when(F.col("method") == "last", -F.col("o_totalprice")).otherwise(0.0)
    return rows.filter("method <> 'solo' or o_orderstatus = 'F'").select("o_orderkey", "method", amount.alias("amount"))


@query("SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    b = load(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b)


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).union(load(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT * EXCLUDE (p_retailprice, p_size) FROM part")
def all_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").drop("p_retailprice", "p_size")


@query("SELECT DISTINCT p_brand, p_type FROM part")
def select_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN 'vip' WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'fast'
          WHEN o_orderstatus = 'F' THEN 'done' ELSE 'other' END AS rule FROM orders""")
def first_match_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    rule = F.when((priority == "1-URGENT") & (F.col("o_totalprice") > 200000), "vip").when(priority.startswith("1") | priority.startswith("2"), "fast").when(F.col("o_orderstatus") == "F", "done").otherwise("other")
    return load(spark, sf_dir, "orders").select("o_orderkey", rule.alias("rule"))


@query("SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderkey) > (40, 100) ORDER BY o_custkey, o_orderkey LIMIT 50")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_after(load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], (40, 100), 50)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100")
def order_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").limit(100)


@query("SELECT CAST(range AS BIGINT) AS n, CAST(range * range % 97 AS BIGINT) AS v FROM range(10000)")
def number_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(10000).select(F.col("id").alias("n"), (F.col("id") * F.col("id") % 97).alias("v"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events""")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lambda p: F.get_json_object("props", p)
    return load(spark, sf_dir, "events").select("event_id", path("$.k").cast("bigint").alias("k"), F.coalesce(path("$.missing"), F.lit("")).alias("missing"))


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1995-04-01'""")
def endpoint_with_parameters(spark: SparkSession, sf_dir: str, start: str = "1995-03-01", stop: str = "1995-04-01") -> DataFrame:
    load(spark, sf_dir, "orders").createOrReplaceTempView("wherry_orders")
    text = "SELECT o_orderkey, o_totalprice FROM wherry_orders WHERE o_orderdate >= to_timestamp_ntz(:start) AND o_orderdate < to_timestamp_ntz(:stop)"
    return spark.sql(text, args={"start": start, "stop": stop})
