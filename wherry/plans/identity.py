"""Identity over the personal data in documents: a document is a fact, what it names are its identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wherry.operators.identity import components, profiles, resolve
from wherry.operators.versions import latest_by
from wherry.plans.registry import query
from wherry.session import materialize
from wherry.sources.tables import load

_KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[A-Za-z0-9]", "phone": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "user_id": r"[0-9]{16}", "anonymous_id": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"}


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact, key (kind:value) and seen_at of every identifier that a text names; written once where it is read several times."""
    def named(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1)), lambda x: F.concat(F.lit(f"{kind}:"), F.lower(x)))

    found = [named(kind, pattern) for kind, pattern in _KINDS.items()]
    return load(spark, sf_dir, "documents").select(F.col("doc_id").alias("fact"), F.explode(F.array_distinct(F.concat(*found))).alias("key"), F.col("doc_id").alias("seen_at"))


_EVIDENCE_SQL = "evidence AS (SELECT DISTINCT fact, key FROM (" + " UNION ALL ".join(f"SELECT doc_id AS fact, '{kind}:' || lower(unnest(regexp_extract_all(text, '{pattern}'))) AS key FROM documents" for kind, pattern in _KINDS.items()) + "))"
_COMPONENT_SQL = f"""WITH RECURSIVE {_EVIDENCE_SQL},
  edges AS (SELECT DISTINCT a.key AS x, b.key AS y FROM evidence a JOIN evidence b ON a.fact = b.fact),
  reach AS (SELECT DISTINCT key, key AS other FROM evidence UNION SELECT r.key, e.y FROM reach r JOIN edges e ON e.x = r.other),
  labels AS (SELECT key, min(other) AS component FROM reach GROUP BY 1)"""


@query(f"{_COMPONENT_SQL} SELECT key, component FROM labels")
def identity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(materialize(evidence(spark, sf_dir), "evidence")[0])


_WINNER_SQL = f"""{_COMPONENT_SQL},
  profiles AS (SELECT component, arg_min(e.key, (CASE split_part(e.key, ':', 1) WHEN 'email' THEN 0 WHEN 'user_id' THEN 2 WHEN 'anonymous_id' THEN 3 ELSE 4 END, fact, e.key)) AS winner, count(DISTINCT fact) AS n_facts FROM evidence e JOIN labels l ON l.key = e.key GROUP BY 1)"""


@query(f"{_WINNER_SQL} SELECT component, winner, n_facts, md5(winner) AS profile_id FROM profiles")
def identity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = materialize(evidence(spark, sf_dir), "evidence")
    return profiles(rows, components(rows))


@query(f"""{_WINNER_SQL}, req AS (SELECT fact AS request_id, key, CASE split_part(key, ':', 1) WHEN 'email' THEN 0 WHEN 'user_id' THEN 2 WHEN 'anonymous_id' THEN 3 ELSE 4 END AS k FROM evidence)
  SELECT request_id, r.key AS matched_key, md5(winner) AS profile_id FROM req r JOIN labels l ON l.key = r.key JOIN profiles p ON p.component = l.component QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY k, r.key) = 1""")
def resolve_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a request with its identifiers, best kind first."""
    rows, _ = materialize(evidence(spark, sf_dir), "evidence")
    labels, _ = materialize(components(rows), "labels")
    mapping = labels.join(profiles(rows, labels), "component").select("key", "profile_id")
    kind = F.split_part("key", F.lit(":"), F.lit(1))
    rank = F.when(kind == "email", 0).when(kind == "user_id", 2).when(kind == "anonymous_id", 3).otherwise(4)
    requests = rows.groupBy(F.col("fact").alias("request_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), "key"))), lambda x: x["key"]).alias("keys"))
    return resolve(requests, mapping)


@query(f"{_COMPONENT_SQL}, s AS (SELECT component, source, d.doc_id FROM evidence e JOIN labels l ON l.key = e.key JOIN documents d ON d.doc_id = e.fact) SELECT component, arg_max(source, doc_id) FILTER (WHERE trim(source) <> '') AS latest_source, max(doc_id) AS last_fact FROM s GROUP BY 1")
def latest_known_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest non-empty value of a trait per profile."""
    rows, _ = materialize(evidence(spark, sf_dir), "evidence")
    traits = rows.join(components(rows), "key").join(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("fact"), "source"), "fact")
    return traits.groupBy("component").agg(F.max_by("source", F.when(F.trim("source") != "", F.col("fact"))).alias("latest_source"), F.max("fact").alias("last_fact"))


@query(f"WITH {_EVIDENCE_SQL} SELECT * FROM evidence QUALIFY row_number() OVER (PARTITION BY fact ORDER BY CASE WHEN split_part(key, ':', 1) = 'phone' THEN 0 ELSE 1 END, key) = 1")
def search_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best identifier of each record, phones first."""
    best = F.when(F.split_part("key", F.lit(":"), F.lit(1)) == "phone", 0).otherwise(1)
    return latest_by(evidence(spark, sf_dir).select("fact", "key"), ["fact"], [best.asc(), F.col("key").asc()])


@query(f"WITH {_EVIDENCE_SQL} SELECT key, min(fact) AS first_fact, count(*) AS n_facts FROM evidence GROUP BY 1 HAVING count(*) > 1")
def shared_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence(spark, sf_dir).groupBy("key").agg(F.min("fact").alias("first_fact"), F.count("*").alias("n_facts")).filter("n_facts > 1")
