"""Rule bitmask ledger: every rule is evaluated once, then policies and ablations are bitwise.

`ledger` makes one row per document with its measurements and a bitmask of failed rules. A policy is a
named mask; `apply_policy` keeps the documents whose failed bits miss the mask. `ablations` groups the
ledger by bitmask (at most 2**len(RULES) groups, summed map-side) and derives per rule how many documents
it fails, fails alone, and would be readmitted without it. All of it is DataFrame expressions.

Defined cases: a null text has no words (all counts 0, too_few_words fails); equal rows give equal rows;
empty tables give empty results; extra columns are dropped by `quality_ledger` and kept by `filter_documents`.
Repeated windows are compared by 64-bit hashes of their five words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import WORD_SPACE, filled, let, words
from wherry.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: name -> condition under which the rule fails; the position is the bit.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbol_ratio": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "shouting": "10 * n_upper > 4 * word_chars",
    "exclamations": "5 * n_exclamations > n_words",
    "word_length": "word_chars > 40 * n_words",
    "echoed_words": "4 * n_echoes > n_words",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}
BASE_MASK = BITS["too_few_words"] | BITS["repeated_windows"]

#: policy version -> mask of the rules that reject.
POLICIES: dict[str, int] = {
    "base": BASE_MASK,
    "v1": BASE_MASK | BITS["symbol_ratio"] | BITS["duplicate_lines"] | BITS["shouting"] | BITS["exclamations"],
    "v2": sum(BITS.values()),
}
CURRENT_POLICY = "v2"


def _n_repeat_words(word_array: Column) -> Column:
    """Words covered by a five-word window that occurs twice or more."""

    def covered(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            hits = F.filter(s, lambda x, i: same(x, i + 1) | ((i > 0) & same(x, i - 1)))
            return F.sort_array(F.transform(hits, lambda x: x["i"]))

        def union_length(starts: Column) -> Column:
            steps = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

        some = let(let(order, repeated), union_length)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(some)

    hashes = let(
        word_array,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        ),
    )
    return F.when(F.size(word_array) <= WINDOW, F.lit(0).cast("bigint")).otherwise(let(hashes, covered))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the measurement columns the rules need; the text is split once."""
    body = filled(text)
    without = lambda chars: F.length(F.translate(body, chars, "")).cast("bigint")
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    length = F.length(body).cast("bigint")
    return df.withColumns({"_words": words(body), "_lines": lines}).select(
        *[F.col(c) for c in df.columns],
        F.size("_words").cast("bigint").alias("n_words"),
        without(WORD_SPACE).alias("word_chars"),
        (length - without(SYMBOLS)).alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _n_repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        (length - without("!")).alias("n_exclamations"),
        F.size(let(F.col("_words"), lambda w: F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))).cast("bigint").alias("n_echoes"),
    )


def failed_bits() -> Column:
    total = F.lit(0).cast("bigint")
    for name, condition in RULES.items():
        total = total.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name]).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return total


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """df with measurements and `failed_bits`."""
    return measure(df, text).withColumn("failed_bits", failed_bits())


def rejected(policy: str = CURRENT_POLICY) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("bigint")) != 0


def apply_policy(ledger_df: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """The ledger with base_failed and kept under a policy version."""
    base = F.col("failed_bits").bitwiseAND(F.lit(BASE_MASK).cast("bigint")) != 0
    return ledger_df.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected(policy))


def ablations(ledger_df: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and the kept count without it."""
    mask = POLICIES[policy]
    in_policy = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")
    patterns = ledger_df.groupBy(in_policy).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("bigint").alias("bit")) for name, bit in BITS.items() if bit & mask])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    zero = F.lit(0).cast("bigint")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(zero)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(zero)).alias("n_failed_alone"),
        F.sum(F.when(alone | (F.col("bits") == 0), F.col("n")).otherwise(zero)).alias("n_kept_without"),
    )


def quality_ledger(docs: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """One row per document: measurements, failed bits, base verdict and verdict of the policy."""
    return apply_policy(ledger(docs.select("doc_id", "text")), policy).drop("text")


def filter_documents(docs: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """The documents that the policy keeps, with their own columns.

    The failed bits go through an explode of one element: a filter is not pushed below it, so no rule is evaluated a second time.
    """
    plain = docs.select(F.struct("*").alias("_doc"), F.col("text"))
    once = ledger(plain).select("_doc", F.explode(F.array("failed_bits")).alias("failed_bits"))
    return apply_policy(once, policy).filter("kept").select("_doc.*")


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger (doc_id, measurements, failed bits) written once to the shared folder; policies and ablations read it, not the texts."""
    return materialize(ledger(docs.select("doc_id", "text")).drop("text"), "rule-ledger")[0]


def policy_ablations(docs: DataFrame) -> DataFrame:
    """The ablations of every policy version, from one stored ledger: policy, rule, n_failed, n_failed_alone, n_kept_without."""
    stored = stored_ledger(docs)
    each = [ablations(stored, policy).select(F.lit(policy).alias("policy"), "*") for policy in POLICIES]
    return reduce(DataFrame.unionByName, each)
