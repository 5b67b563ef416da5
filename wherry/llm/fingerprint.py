"""One-permutation MinHash with optimal densification and packed low-order bits, in DataFrame expressions only.

Each five-word shingle is hashed once; the top BIN_BITS of the hash choose its bin and the least hash of a bin stays. An empty
bin i takes the value of the first occupied bin in a probe order of its own, j -> a_i * (j - i) mod BINS with a_i odd, which
visits every bin: the densification that gives each empty bin an independent choice. Of each bin LOW_BITS bits are
stored. A share m of equal bins estimates the likeness as (m - c) / (1 - c), c = 2**-LOW_BITS being the chance of equal bits.

The next document of a row is found in runs of consecutive ids: rows go once through a hash exchange on the run, and the first
row of each run is also sent to the run above, so no task sorts more than one run and nothing global is sorted. Rows that share an id, or have none,
are cut into runs by the hash of their text.

Defined cases: a null text is the empty text; texts of one to four words are one shingle; a text without words has the
fingerprint '' (likeness 1 to another such, 0 to any other); equal ids are ordered by the hash of their text; null ids come last; a very long text is hashed whole; the only
row is its own next; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.llm.common import filled, let, words

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 8
LOW_MASK = (1 << LOW_BITS) - 1
RUN_ROWS = 2_000
MOST_RUNS = 16_384


#: Of each bin's probe order, this many places are tried one by one; beyond them the order is ranked at once.
PROBES = 40


def _shingle_hashes(word_array: Column) -> Column:
    """The 64-bit hashes of the shingles of an array of words, in ascending order; none for no words."""
    starts = F.sequence(F.lit(0), F.size(word_array) - SHINGLE)
    many = F.transform(starts, lambda i: F.xxhash64(*[F.get(word_array, i + k) for k in range(SHINGLE)]))
    one = F.array(F.xxhash64(F.array_join(word_array, " ")))
    none = F.array().cast("array<bigint>")
    return F.sort_array(F.when(F.size(word_array) >= SHINGLE, many).when(F.size(word_array) > 0, one).otherwise(none))


def _occupied(hashes: Column) -> Column:
    """bin << LOW_BITS | low bits of the least hash, for each bin that has one, in bin order."""
    bin_of = lambda h: F.shiftright(h, 64 - BIN_BITS)
    least = F.filter(hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1))))
    return F.transform(least, lambda h: ((bin_of(h) + BINS // 2) * (LOW_MASK + 1) + h.bitwiseAND(F.lit(LOW_MASK))).cast("int"))


def _low(e: Column) -> Column:
    return e.bitwiseAND(F.lit(LOW_MASK)).cast("smallint")


def _probe_orders() -> Column:
    """For each bin i the odd a of its probe order and the inverse of a: j has rank a * (j - i), rank t is i + t / a."""
    odd = [(xxhash.xxh32_intdigest(str(i)) & (BINS - 1)) | 1 for i in range(BINS)]
    # array() and struct() of literals are folded to one literal; from_json would parse it again for each row
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(pow(a, -1, BINS)).alias("inverse")) for i, a in enumerate(odd)])


def _densified(occupied: Column, own: Column) -> Column:
    """One value per bin: its own, or that of the first occupied bin in its probe order."""

    def value(p: Column) -> Column:
        tried = [F.get(own, (p["i"] + p["inverse"] * t).bitwiseAND(F.lit(BINS - 1))) for t in range(PROBES)]
        rank = lambda e: ((F.shiftright(e, LOW_BITS) - p["i"]) * p["a"]).bitwiseAND(F.lit(BINS - 1))
        ranked = F.array_min(F.transform(occupied, lambda e: rank(e) * (LOW_MASK + 1) + e.bitwiseAND(F.lit(LOW_MASK))))
        return F.coalesce(*tried, _low(ranked))

    return F.when(F.size(occupied) == 0, F.array().cast("array<smallint>")).otherwise(F.transform(_probe_orders(), value))


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with `name`, array<smallint> of BINS values; empty for a text without words.

    Each step is a column of its own, evaluated once; what a lambda mentions is bound by `let`, else the optimizer would
    put its definition inside the lambda.
    """
    places = F.sequence(F.lit(0), F.lit(BINS - 1))
    own = lambda o: let(F.transform(o, lambda e: F.shiftright(e, LOW_BITS)), lambda b: F.transform(places, lambda i: _low(F.get(o, F.array_position(b, i).cast("int") - 1))))
    stepped = df.withColumn("_w", words(F.col(text))).withColumn("_h", _shingle_hashes(F.col("_w"))).withColumn("_o", _occupied(F.col("_h")))
    return stepped.withColumn(name, let(F.col("_o"), lambda o: let(own(o), lambda d: _densified(o, d)))).drop("_w", "_h", "_o")


def packed(sig: Column) -> Column:
    """The signature as hex digits, LOW_BITS a bin."""
    return F.lower(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x), LOW_BITS // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the shingle sets behind two signatures, 0 to 1."""
    chance = 1.0 / (LOW_MASK + 1)
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    share = (same.cast("double") / BINS - chance) / (1 - chance)
    both = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(both)


def _literal(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(kind)


def _under(bounds: list[int], doc_id: Column) -> Column:
    """How many bounds are under doc_id, by binary search."""
    if not bounds:
        return F.lit(0)
    array = _literal(bounds, "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    under = lambda at, step: F.coalesce(F.get(array, at + step - 1) < doc_id, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(under(at, step), at + step).otherwise(at))


def _back() -> Column:
    """Ascending where ids are descending, without overflow; null for null."""
    return F.bitwise_not("doc_id")


def _hash() -> Column:
    return F.xxhash64("text")


class Runs:
    """The runs of rows (doc_id, text) in order: ids descending, null last, equal ids by hash of the text.

    An id that fills several runs is cut by that hash. There are at most 3 * MOST_RUNS runs; the driver holds a few numbers of each.
    """

    def __init__(self, rows: DataFrame):
        n = rows.count()
        each = max(RUN_ROWS, -(-n // MOST_RUNS))
        cuts = [k * each / n for k in range(1, -(-n // each))]
        found = rows.agg(F.percentile_approx("doc_id", cuts, max(10_000, 10 * len(cuts))).alias("b")).first()["b"] if cuts else None
        heavy = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * each).collect()}
        ids = [x for x in heavy if x is not None]
        self.bounds = sorted({*(found or []), *ids, *(x - 1 for x in ids if x > -(1 << 63))})
        null_run = len(self.bounds) + 1  # after run 0, the lowest ids
        parts = [1] * (null_run + 1)
        for x, count in heavy.items():
            parts[null_run if x is None else bisect_left(self.bounds, x)] = -(-count // each)
        order = [*range(null_run - 1, -1, -1), null_run]
        starts = dict(zip(order, accumulate((parts[r] for r in order), initial=0)))
        self.starts, self.parts, self.total = [starts[r] for r in range(null_run + 1)], parts, sum(parts)
        first = F.min(F.struct(_back().alias("back"), _hash().alias("hash"))).alias("first")
        self.firsts = {r["place"]: tuple(r["first"]) for r in rows.groupBy(self.place.alias("place")).agg(first).collect()}

    @property
    def place(self) -> Column:
        """The number of a row's run."""
        run = F.when(F.col("doc_id").isNull(), F.lit(len(self.bounds) + 1)).otherwise(_under(self.bounds, F.col("doc_id")))
        share = _hash() / F.lit(2.0**64) + 0.5
        cut = lambda r: F.get(_literal(self.starts, "array<int>"), r) + let(F.get(_literal(self.parts, "array<int>"), r), lambda m: F.least(m - 1, F.floor(share * m).cast("int")))
        return let(run, cut)


def _with_next(rows: DataFrame, sign) -> DataFrame:
    """rows (doc_id, text) signed, with next_text and next_sig: those of the row after it, cyclically."""
    runs = Runs(rows)
    used = sorted(runs.firsts) or [0]
    above = dict(zip(used, [used[-1], *used]))  # the run whose last row is followed by this run's first
    known = [runs.firsts.get(k, (None, None)) for k in range(runs.total)]
    numbered = rows.withColumn("place", runs.place)
    at = lambda values, kind: F.get(_literal(values, kind), F.col("place"))
    is_first = _back().eqNullSafe(at([b for b, _ in known], "array<bigint>")) & (_hash() == at([h for _, h in known], "array<bigint>"))
    target = at([above.get(k, 0) for k in range(runs.total)], "array<int>")
    guests = sign(numbered.filter(is_first).select(target.alias("place"), "text").dropDuplicates(["place"]))
    columns = ["place", F.col("text"), "sig"]
    both = sign(numbered).select("doc_id", F.lit(False).alias("guest"), *columns).unionByName(guests.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(True).alias("guest"), *columns))
    order = Window.partitionBy("place").orderBy("guest", F.col("doc_id").desc_nulls_last(), _hash(), "text")
    found = both.withColumn("_next", F.lead(F.struct("text", "sig")).over(order)).filter("not guest")
    return found.select("doc_id", "text", "sig", F.coalesce("_next.text", "text").alias("next_text"), F.coalesce("_next.sig", "sig").alias("next_sig"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with the likenesses that follow from them."""
    rows = docs.select(F.col("doc_id").cast("bigint"), filled().alias("text"))
    signed = _with_next(rows, lambda df: with_signature(df, "text", "sig"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = signed.select(
        "doc_id", "sig", "next_sig", n.cast("bigint").alias("n_chars"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)).alias("edited"),
    )
    both = with_signature(edited, "edited", "edited_sig")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("sig")).alias("fingerprint"), packed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
