"""Payments over orders and line items: classification, sequence numbers, plan timing, sales, customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wherry.functions.calendar import net_price
from wherry.plans.registry import query
from wherry.sources.tables import load


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments: urgent ones are a subscription, high ones a plan of instalments, the rest paid at once; the link is customer and priority."""
    o = load(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "subscription").when(F.col("o_orderpriority") == "2-HIGH", "plan").otherwise("once")
    rows = o.select(F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("paid_at"), F.col("o_totalprice").alias("amount"), kind.alias("kind"), "o_orderpriority", "o_orderstatus")
    order = Window.partitionBy("customer", "o_orderpriority").orderBy("paid_at", "payment_id")
    return rows.withColumn("sequence", F.row_number().over(order).cast("bigint"))


_PAYMENT_SQL = """payments AS (SELECT o_orderkey AS payment_id, o_custkey AS customer, o_orderdate AS paid_at, o_totalprice AS amount, CASE o_orderpriority WHEN '1-URGENT' THEN 'subscription' WHEN '2-HIGH' THEN 'plan' ELSE 'once' END AS kind, o_orderpriority, o_orderstatus,
  row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS sequence FROM orders)"""


@query(f"""WITH {_PAYMENT_SQL}, r AS (SELECT *, CASE WHEN is_balance THEN 'balance' WHEN kind = 'plan' AND by_link AND sequence = 1 THEN 'initial' WHEN kind = 'plan' AND by_link THEN 'installment' WHEN kind = 'once' THEN 'one_time'
    WHEN reason = 'subscription_create' THEN 'initial' WHEN kind = 'plan' THEN 'installment' ELSE 'renewal' END AS occurrence
    FROM (SELECT *, kind <> 'once' AND o_orderstatus = 'P' AS is_balance, payment_id % 2 = 0 AS by_link, CASE WHEN kind <> 'once' AND payment_id % 3 > 0 THEN CASE WHEN payment_id % 3 = 1 THEN 'subscription_create' ELSE 'subscription_cycle' END END AS reason FROM payments))
  SELECT payment_id, kind, sequence, reason, occurrence, is_balance OR (kind = 'plan' AND by_link AND sequence > 1) OR (kind <> 'once' AND coalesce(reason <> 'subscription_create', true)) AS is_repeat FROM r""")
def payment_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrence by the first rule that matches: instalments through the plan's link by their number, others by the billing reason.

    A payment of a subscription or plan without a reason counts as a repeat.
    """
    kind, sequence, number = F.col("kind"), F.col("sequence"), F.col("payment_id")
    reason = F.when((kind != "once") & (number % 3 > 0), F.when(number % 3 == 1, "subscription_create").otherwise("subscription_cycle"))
    rows = payments(spark, sf_dir).withColumn("reason", reason)
    balance, linked = (kind != "once") & (F.col("o_orderstatus") == "P"), (kind == "plan") & (number % 2 == 0)
    created = F.coalesce(F.col("reason") == "subscription_create", F.lit(False))
    occurrence = (
        F.when(balance, "balance").when(linked & (sequence == 1), "initial").when(linked, "installment").when(kind == "once", "one_time")
        .when(created, "initial").when(kind == "plan", "installment").otherwise("renewal")
    )
    repeat = balance | (linked & (sequence > 1)) | ((kind != "once") & ~created)
    return rows.select("payment_id", "kind", "sequence", "reason", occurrence.alias("occurrence"), repeat.alias("is_repeat"))


@query(f"""WITH {_PAYMENT_SQL}, p AS (SELECT *, min(paid_at) OVER w AS started, lag(paid_at) OVER (PARTITION BY customer ORDER BY paid_at, payment_id) AS earlier, count(*) OVER w AS n_payments FROM payments WHERE kind = 'plan' WINDOW w AS (PARTITION BY customer))
  SELECT payment_id, customer, sequence, n_payments, (epoch_us(paid_at) - epoch_us(started)) // 86400000000 AS days_in, (epoch_us(paid_at) - epoch_us(earlier)) // 86400000000 AS days_since, sequence = n_payments AS is_last FROM p""")
def payment_plan_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = Window.partitionBy("customer")
    at = F.unix_micros(F.col("paid_at").cast("timestamp"))
    rows = payments(spark, sf_dir).filter("kind = 'plan'").withColumn("at", at)
    days = lambda since: F.floor((F.col("at") - since) / 86_400_000_000).cast("bigint")
    return rows.select(
        "payment_id", "customer", "sequence", F.count("*").over(whole).alias("n_payments"), days(F.min("at").over(whole)).alias("days_in"),
        days(F.lag("at").over(whole.orderBy("at", "payment_id"))).alias("days_since"), (F.col("sequence") == F.count("*").over(whole)).alias("is_last"),
    )


@query("""SELECT p_brand AS brand, string_split(p_type, ' ')[1] AS category, count(DISTINCT l_orderkey) AS n_orders, CAST(sum(l_quantity) AS BIGINT) AS units, CAST(round(sum(net), 2) AS DOUBLE) AS gross,
  CAST(round(sum(CASE WHEN l_returnflag = 'R' THEN net ELSE 0 END), 2) AS DOUBLE) AS refunds FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM lineitem) JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = net_price()
    rows = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    refund = F.when(F.col("l_returnflag") == "R", net).otherwise(F.lit(0))
    return rows.groupBy(F.col("p_brand").alias("brand"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("category")).agg(
        F.countDistinct("l_orderkey").alias("n_orders"), F.sum("l_quantity").cast("bigint").alias("units"), F.round(F.sum(net), 2).cast("double").alias("gross"), F.round(F.sum(refund), 2).cast("double").alias("refunds")
    )


@query(f"""WITH {_PAYMENT_SQL} SELECT c_custkey, c_mktsegment, count(payment_id) AS n_payments, round(coalesce(sum(amount), 0), 2) AS lifetime, min(paid_at) AS first_paid, max(paid_at) AS last_paid, arg_max(kind, (paid_at, payment_id)) AS last_kind,
  coalesce(count(*) FILTER (WHERE kind = 'subscription') > 0, false) AS has_subscription FROM customer LEFT JOIN payments ON customer = c_custkey GROUP BY ALL""")
def customer_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments are summed per customer before the join."""
    key = F.struct("paid_at", "payment_id")
    summed = payments(spark, sf_dir).groupBy("customer").agg(
        F.count("*").alias("n"), F.sum("amount").alias("total"), F.min("paid_at").alias("first_paid"), F.max("paid_at").alias("last_paid"), F.max_by("kind", key).alias("last_kind"), F.count_if(F.col("kind") == "subscription").alias("subs")
    )
    joined = load(spark, sf_dir, "customer").join(summed, F.col("customer") == F.col("c_custkey"), "left")
    return joined.select("c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_payments"), F.round(F.coalesce("total", F.lit(0.0)), 2).alias("lifetime"), "first_paid", "last_paid", "last_kind", (F.coalesce("subs", F.lit(0)) > 0).alias("has_subscription"))


@query(f"""WITH {_PAYMENT_SQL}, links AS (SELECT payment_id, 1 AS linked_at, 'm' || (customer % 10) AS profile FROM payments WHERE o_orderstatus = 'P' UNION ALL SELECT payment_id, 2, 'n' || (customer % 7) FROM payments WHERE o_orderstatus = 'P' AND customer % 2 = 0),
  manual AS (SELECT payment_id, arg_max(profile, linked_at) AS profile FROM links GROUP BY 1), automatic AS (SELECT c_custkey AS customer, 'a' || c_custkey AS profile FROM customer WHERE c_acctbal > 0)
  SELECT p.payment_id, coalesce(m.profile, a.profile) AS profile, CASE WHEN m.profile IS NOT NULL THEN 'manual' WHEN a.profile IS NOT NULL THEN 'automatic' ELSE 'unattributed' END AS method
  FROM payments p LEFT JOIN manual m ON m.payment_id = p.payment_id LEFT JOIN automatic a ON a.customer = p.customer""")
def resolved_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest manual link goes before the automatic profile; however many links there are, a payment is one row."""
    p = payments(spark, sf_dir)
    options = F.array(F.struct(F.lit(1).alias("linked_at"), F.concat(F.lit("m"), F.col("customer") % 10).alias("manual")), F.struct(F.lit(2).alias("linked_at"), F.concat(F.lit("n"), F.col("customer") % 7).alias("manual")))
    links = p.filter("o_orderstatus = 'P'").select("payment_id", F.inline(F.slice(options, F.lit(1), F.when(F.col("customer") % 2 == 0, 2).otherwise(1))))
    manual = links.groupBy("payment_id").agg(F.max_by("manual", "linked_at").alias("manual"))
    automatic = load(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("customer"), F.concat(F.lit("a"), F.col("c_custkey")).alias("automatic"))
    rows = p.join(manual, "payment_id", "left").join(automatic, "customer", "left")
    method = F.when(F.col("manual").isNotNull(), "manual").when(F.col("automatic").isNotNull(), "automatic").otherwise("unattributed")
    return rows.select("payment_id", F.coalesce("manual", "automatic").alias("profile"), method.alias("method"))


@query("""WITH t AS (SELECT p_partkey, trim(unnest(string_split(replace(replace(p_type, 'PROMO ', 'PROMO~'), ' ', ' + '), ' + '))) AS item FROM part) SELECT p_partkey, replace(item, '~', ' ') AS item FROM t WHERE item <> ''""")
def product_text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product text split at separators; a protected pair of words stays together."""
    text = F.replace(F.replace(F.col("p_type"), F.lit("PROMO "), F.lit("PROMO~")), F.lit(" "), F.lit(" + "))
    items = load(spark, sf_dir, "part").select("p_partkey", F.explode(F.split(text, r" \+ ")).alias("item"))
    return items.select("p_partkey", F.replace(F.trim("item"), F.lit("~"), F.lit(" ")).alias("item")).filter("item <> ''")


@query("""WITH a AS (SELECT c_custkey, unnest(['seg ' || c_mktsegment, c_mktsegment, 'x']) AS tag, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_deleted FROM customer), p AS (SELECT * FROM (VALUES (1, 'exact', 'BUILDING', 'vip', 'primary'), (2, 'prefix', 'seg A', 'auto', 'primary'), (3, 'prefix', 'seg ', 'any', 'fallback')) v(priority, how, pattern, kind, role)),
  m AS (SELECT c_custkey, kind, role FROM a JOIN p ON CASE how WHEN 'exact' THEN tag = pattern ELSE starts_with(tag, pattern) END WHERE is_deleted = 0 QUALIFY row_number() OVER (PARTITION BY c_custkey, tag ORDER BY priority) = 1),
  f AS (SELECT *, max(CASE WHEN role = 'primary' THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey) AS has_primary FROM m)
  SELECT c_custkey, kind FROM f WHERE role = 'primary' OR has_primary = 0""")
def tag_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and prefix tag rules, the first priority per assignment; fallback tags count only without a primary one."""
    from wherry.operators.joins import policy_join
    from wherry.operators.versions import latest_by
    from wherry.sources.tables import literal_rows

    policy = literal_rows(spark, "priority int, how string, pattern string, kind string, role string", (1, "exact", "BUILDING", "vip", "primary"), (2, "prefix", "seg A", "auto", "primary"), (3, "prefix", "seg ", "any", "fallback"))
    tags = load(spark, sf_dir, "customer").filter("c_acctbal >= 0").select("c_custkey", F.explode(F.array(F.concat(F.lit("seg "), "c_mktsegment"), "c_mktsegment", F.lit("x"))).alias("tag"))
    hit = F.when(F.col("how") == "exact", F.col("tag") == F.col("pattern")).otherwise(F.startswith("tag", "pattern"))
    best = latest_by(policy_join(tags, policy, hit), ["c_custkey", "tag"], [F.col("priority").asc()])
    primary = F.max((F.col("role") == "primary").cast("int")).over(Window.partitionBy("c_custkey"))
    return best.withColumn("has_primary", primary).filter("role = 'primary' or has_primary = 0").select("c_custkey", "kind")


@query("SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN sha256(concat_ws('|', lower(c_name) || '@example.org', 'vip', '2024-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0'))) END AS canonical_id FROM customer")
def canonical_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sha256 of email, type and local date; null without an email."""
    email = F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lower("c_name"), F.lit("@example.org")))
    day = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("c_custkey") % 28).cast("string"), 2, "0"))
    return load(spark, sf_dir, "customer").select("c_custkey", F.when(email.isNotNull(), F.sha2(F.concat_ws("|", email, F.lit("vip"), day), 256)).alias("canonical_id"))


#: Configuration: rule -> (name, how it was found, category); the rules themselves are in `product_rules`, first match wins.
PRODUCT_RULES = {
    "vip": ("Challenge VIP", "charge_amount_and_text", "vip"), "book": ("Book", "charge_statement_descriptor", "book"), "deposit": ("Program deposit", "charge_description_and_amount", "mentorship"),
    "balance": ("Program balance", "invoice_status", "mentorship"), "installments": ("Program in instalments", "plan_or_catalog", "mentorship"), "catalog_product": (None, "catalog", "catalog"), "unclassified": ("unclassified", "unclassified", "unknown"),
}


def product_rules() -> Column:
    """The first rule that matches a payment with its text, kind, status, amount and catalog name."""
    text, plan = F.lower(F.coalesce("product_text", F.lit(""))), F.col("kind") == "plan"
    return (
        F.when(text.contains("promo") & (F.col("amount") < 150_000), "vip").when(text.contains("economy"), "book").when(plan & (F.col("amount") < 50_000), "deposit").when(plan & (F.col("o_orderstatus") == "P"), "balance")
        .when(plan, "installments").when(F.col("catalog_name").isNotNull(), "catalog_product").otherwise("unclassified")
    )


def related_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice rows as an export repeats them: an early state of each and, for two thirds, a later one."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("payment_id"))
    states = F.array(F.struct(F.lit(1).alias("version"), F.lit("draft").alias("state")), F.struct(F.lit(2).alias("version"), F.when(F.col("payment_id") % 2 == 0, "paid").otherwise("open").alias("state")))
    return o.select("payment_id", F.inline(F.slice(states, F.lit(1), F.when(F.col("payment_id") % 3 == 0, 1).otherwise(2))))


_ADAPTER_SQL = f"""{_PAYMENT_SQL},
  objects AS (SELECT o_orderkey AS payment_id, 1 AS version, 'draft' AS state FROM orders UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 2 = 0 THEN 'paid' ELSE 'open' END FROM orders WHERE o_orderkey % 3 <> 0),
  invoice AS (SELECT payment_id, arg_max(state, version) AS invoice_state, count(*) AS n_states FROM objects GROUP BY 1),
  line AS (SELECT l_orderkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1),
  enriched AS (SELECT p.*, invoice_state, n_states, p_type AS product_text, CASE WHEN p_size < 40 THEN p_name END AS catalog_name FROM payments p LEFT JOIN invoice i ON i.payment_id = p.payment_id LEFT JOIN line l ON l.l_orderkey = p.payment_id LEFT JOIN part ON p_partkey = l.l_partkey),
  ruled AS (SELECT *, lower(coalesce(product_text, '')) AS t, CASE WHEN contains(lower(coalesce(product_text, '')), 'promo') AND amount < 150000 THEN 'vip' WHEN contains(lower(coalesce(product_text, '')), 'economy') THEN 'book'
    WHEN kind = 'plan' AND amount < 50000 THEN 'deposit' WHEN kind = 'plan' AND o_orderstatus = 'P' THEN 'balance' WHEN kind = 'plan' THEN 'installments' WHEN catalog_name IS NOT NULL THEN 'catalog_product' ELSE 'unclassified' END AS product_rule FROM enriched)"""


def adapted_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with the latest state of their related objects and the rule that says what was bought."""
    objects = related_objects(spark, sf_dir).groupBy("payment_id").agg(F.max_by("state", "version").alias("invoice_state"), F.count("*").alias("n_states"))
    lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("payment_id")).agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("p_partkey"))
    part = load(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product_text"), F.when(F.col("p_size") < 40, F.col("p_name")).alias("catalog_name"))
    rows = payments(spark, sf_dir).join(objects, "payment_id", "left").join(lines, "payment_id", "left").join(part, "p_partkey", "left")
    return rows.withColumn("product_rule", product_rules())


@query(f"WITH {_ADAPTER_SQL} SELECT payment_id, invoice_state, n_states, product_text, catalog_name FROM enriched")
def payment_related_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted_payments(spark, sf_dir).select("payment_id", "invoice_state", "n_states", "product_text", "catalog_name")


@query(f"""WITH {_ADAPTER_SQL} SELECT payment_id, product_rule, CASE product_rule WHEN 'vip' THEN 'Challenge VIP' WHEN 'book' THEN 'Book' WHEN 'deposit' THEN 'Program deposit' WHEN 'balance' THEN 'Program balance' WHEN 'installments' THEN 'Program in instalments' WHEN 'catalog_product' THEN catalog_name ELSE 'unclassified' END AS product_name,
  CASE WHEN product_rule = 'book' THEN 'Book' || CASE WHEN contains(t, 'brushed') THEN ' + brushed' WHEN contains(t, 'plated') THEN ' + plated' ELSE '/no label' END || CASE WHEN contains(t, 'steel') THEN ' + steel' ELSE '' END END AS product_variant,
  CASE product_rule WHEN 'vip' THEN 'charge_amount_and_text' WHEN 'book' THEN 'charge_statement_descriptor' WHEN 'deposit' THEN 'charge_description_and_amount' WHEN 'balance' THEN 'invoice_status' WHEN 'installments' THEN 'plan_or_catalog' WHEN 'catalog_product' THEN 'catalog' ELSE 'unclassified' END AS classification_method FROM ruled""")
def payment_product_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule, name, variant and method of each payment."""
    text, rule = F.lower(F.coalesce("product_text", F.lit(""))), F.col("product_rule")
    told = lambda at: F.create_map(*[x for name, values in PRODUCT_RULES.items() for x in (F.lit(name), F.lit(values[at]))])[rule]
    variant = F.concat(F.lit("Book"), F.when(text.contains("brushed"), " + brushed").when(text.contains("plated"), " + plated").otherwise("/no label"), F.when(text.contains("steel"), " + steel").otherwise(""))
    name = F.when(rule == "catalog_product", F.col("catalog_name")).otherwise(told(0))
    return adapted_payments(spark, sf_dir).select("payment_id", "product_rule", name.alias("product_name"), F.when(rule == "book", variant).alias("product_variant"), told(1).alias("classification_method"))


@query(f"WITH {_ADAPTER_SQL} SELECT CASE WHEN product_rule = 'vip' THEN 'vip' WHEN product_rule = 'book' THEN 'book' WHEN product_rule IN ('deposit', 'balance', 'installments') THEN 'mentorship' WHEN product_rule = 'catalog_product' THEN 'catalog' ELSE 'unknown' END AS category, count(*) AS n_payments, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM ruled GROUP BY 1")
def payment_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and amounts by reporting category."""
    category = F.create_map(*[x for name, (_, _, kind) in PRODUCT_RULES.items() for x in (F.lit(name), F.lit(kind))])[F.col("product_rule")]
    return adapted_payments(spark, sf_dir).groupBy(category.alias("category")).agg(F.count("*").alias("n_payments"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"))
