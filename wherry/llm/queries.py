"""The registered queries of the text operators and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wherry.llm import fingerprint, html_extract, license_scan, lm_scoring, mixing, packing, quality_classifier, quality_rules, simhash, token_counts
from wherry.llm.common import documents, table

PACKING_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COUNTING_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), PACKING_VOCABULARY)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.score(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), COUNTING_MODEL)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(documents(spark, sf_dir))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_ledger(documents(spark, sf_dir))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (op1_packing, op2_quality_classifier, op3_token_counts, op4_license_scan, op5_fingerprint, op6_quality_rules, op7_lm_scoring, op8_mixing, op9_simhash, op10_html_extract)
}

_QUALITY_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
starts AS (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM s),
windows AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g FROM starts),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS p FROM twice, range(5) AS x(k)) GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_exclamations,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echoes
  FROM s LEFT JOIN covered USING (r)),
f AS (
  SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_upper > 4 * word_chars THEN 16 ELSE 0 END + CASE WHEN 5 * n_exclamations > n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 40 * n_words THEN 64 ELSE 0 END + CASE WHEN 4 * n_echoes > n_words THEN 128 ELSE 0 END AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_exclamations, n_echoes,
       CAST(bits AS BIGINT) AS failed_bits, bits & 3 <> 0 AS base_failed, bits = 0 AS kept
FROM f
"""

_LM_SCORING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
p AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v FROM w),
c1 AS (SELECT w, count(*) AS n FROM w GROUP BY w),
o1 AS (SELECT r, w, count(*) AS n FROM w GROUP BY r, w),
c2 AS (SELECT v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY v, w),
o2 AS (SELECT r, v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY r, v, w),
a AS (SELECT count(*) AS n FROM w),
x AS (
  SELECT p.r, p.v, c1.n - o1.n AS one, c0.n - o0.n AS before, c2.n - o2.n AS two, a.n - len(d.ws) AS others
  FROM p JOIN d ON d.r = p.r JOIN c1 ON c1.w = p.w JOIN o1 ON o1.r = p.r AND o1.w = p.w CROSS JOIN a
  LEFT JOIN c1 AS c0 ON c0.w = p.v LEFT JOIN o1 AS o0 ON o0.r = p.r AND o0.w = p.v
  LEFT JOIN c2 ON c2.v = p.v AND c2.w = p.w LEFT JOIN o2 ON o2.r = p.r AND o2.v = p.v AND o2.w = p.w),
t AS (
  SELECT r, sum(CASE WHEN v IS NOT NULL AND two > 0 THEN ln(two) - ln(before)
                     ELSE ln(greatest(one, 0.5)) - ln(greatest(others, 1)) + CASE WHEN v IS NULL THEN 0 ELSE ln(0.4) END END) AS lp
  FROM x GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(lp, 0), 3) AS log_probability,
       round(CASE WHEN len(ws) > 0 THEN exp(-lp / len(ws)) END, 2) AS perplexity
FROM d LEFT JOIN t USING (r)
"""

#: The other queries hash, tokenize, learn, compress or parse, which SQL cannot: tests compare them with brute force.
ORACLES: dict[str, str] = {"op6_quality_rules": _QUALITY_RULES_SQL, "op7_lm_scoring": _LM_SCORING_SQL}
