"""One document of each group of near copies: SimHash links, confirmed by the exact Jaccard likeness of five-word shingles.

Two texts are linked if the SimHash fingerprints of their sets of words differ in RADIUS bits at most and their sets of five-word shingles are
LIKENESS alike. A few changed words break five times as many shingles, but leave the set of words much as it was, so single words give
close fingerprints to texts whose shingles are 0.8 alike (README gives the share), and shingles decide. Equal sets of shingles are one row before
anything else. Covering tables (simhash.links) give the components of the fingerprints without missing a pair in the radius; a group lies
within one of them. Of a component, the links are found in one task by an inverted index of its shingles: a search from each set over
those not yet reached, so a component of near copies costs little more than its size. A component of more than COMPONENT_SETS sets or
COMPONENT_GRAMS shingles is never brought into one task: the pairs of its buckets are compared in rounds, some pivots of every bucket against
all its later sets, then the components of what was confirmed, then more pivots, until each bucket is one group or each of its sets was a
pivot. Both ways give the same groups. Links are never dropped.

What is shuffled: a row of numbers per document, fingerprints by table, the texts of components of two sets or more, and the documents once.

Defined cases: a null text counts as empty; texts without words are copies of each other; a text of fewer words than a shingle is one
shingle; repeated rows are copies; of rows equal in doc_id and text, the one with the smaller hash of its other columns stays; a null doc_id
takes part but stays only if its group has no other; very long texts are read whole; empty tables give empty results; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.llm.common import filled, slices
from wherry.llm.simhash import SEED, covering_masks, fingerprint_of, links, shingle_hashes, signed
from wherry.operators.components import connected_components
from wherry.session import materialize

WORDS = 5
LIKENESS = 0.8
RADIUS = 7
COMPONENT_SETS = 5_000
COMPONENT_GRAMS = 4_000_000
#: Pivots of a bucket in the first round, and by how much they grow from round to round.
PIVOTS, MORE = 1, 2


def shingle_set(text: str, words: int) -> tuple[int, np.ndarray]:
    """The hash of a text's set of shingles, and the set."""
    grams = np.unique(shingle_hashes(text, words))
    return signed(xxhash.xxh64_intdigest(grams.tobytes())), grams


def word_fingerprint(text: str) -> int:
    """The SimHash of a text's set of words."""
    different = set(text.encode().lower().split())
    return fingerprint_of(np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in different), "<u8", len(different)))


def _hashes(docs: DataFrame) -> list[Column]:
    """Three hashes by which a row of docs is known: two of doc_id and text, one of its other columns."""
    known = [x for c in ("doc_id", "text") for x in (F.col(c), F.isnull(c))]  # a hash passes over nulls
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    other = F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("bigint")
    return [F.xxhash64(*known).alias("a"), F.xxhash64(F.lit("b"), *known).alias("b"), other.alias("other")]


KEY = ["a", "b", "other"]


def _numbers(docs: DataFrame, words: int) -> DataFrame:
    """a, b, other, doc_id, s (hash of the set of shingles), n (its size), fp per row of docs."""
    kinds = {"a": pa.int64(), "b": pa.int64(), "other": pa.int64(), "doc_id": pa.int64(), "s": pa.int64(), "n": pa.int64(), "fp": pa.int64()}

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            sets = [(s, len(grams)) for s, grams in (shingle_set(t, words) for t in texts)]
            columns = [*(batch.column(c) for c in (*KEY, "doc_id")), *(pa.array([x[k] for x in sets], pa.int64()) for k in (0, 1)), pa.array([signed(word_fingerprint(t)) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

    rows = docs.select(*_hashes(docs), F.col("doc_id").cast("bigint").alias("doc_id"), filled().alias("text"))
    return rows.mapInArrow(made, ", ".join(f"{c} bigint" for c in kinds))


def _with_grams(texts: DataFrame, words: int) -> DataFrame:
    """c, s, n, fp and grams (the set of shingles) per row of texts."""
    names = ["c", "s", "n", "fp"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams = pa.array([shingle_set(t, words)[1].tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), grams], names=[*names, "grams"])

    return texts.select(*names, "text").mapInArrow(made, "c bigint, s bigint, n bigint, fp bigint, grams binary")


def linked(sets: list[np.ndarray], fps: np.ndarray, likeness: float, radius: int) -> np.ndarray:
    """For each set the position of the first of its group: linked directly or through others."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    by_gram = np.argsort(gram, kind="stable")
    firsts = np.searchsorted(gram[by_gram], np.arange(gram.max() + 2 if len(gram) else 1))
    having, starts = owner[by_gram], np.cumsum(sizes) - sizes
    root = np.full(len(sets), -1)
    for k in range(len(sets)):
        if root[k] >= 0:
            continue
        root[k], front = k, [k]
        while front:
            at = front.pop()
            grams = gram[starts[at] : starts[at] + sizes[at]]
            if not len(grams):
                continue
            both = np.bincount(np.concatenate([having[firsts[g] : firsts[g + 1]] for g in grams]), minlength=len(sets))
            near = np.flatnonzero((both >= likeness * (sizes[at] + sizes - both)) & (root < 0) & (np.bitwise_count(fps ^ fps[at]) <= radius))
            root[near] = k
            front += near.tolist()
    return root


def _whole(likeness: float, radius: int):
    def found(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("s").sort_values("s")
        s = frame["s"].to_numpy()
        root = linked([np.frombuffer(g, "<u8") for g in frame["grams"]], frame["fp"].to_numpy().view(np.uint64), likeness, radius)
        return pd.DataFrame({"s": s, "root": s[root]})

    return found


def _alike(likeness: float):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                x, y = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= likeness * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return found


def _in_rounds(grams: DataFrame, likeness: float, radius: int) -> DataFrame:
    """s and root of the sets of components too large for one task, from the pairs of their buckets."""
    grams, _ = materialize(grams.dropDuplicates(["s"]), "grams")
    tables = F.explode(F.array(*[F.lit(signed(m)).cast("bigint") for m in covering_masks(radius)]))
    keyed = grams.select("s", "n", "fp", tables.alias("kept")).withColumn("key", F.xxhash64("kept", F.col("fp").bitwiseAND(F.col("kept"))))
    by_key = Window.partitionBy("key")
    many = keyed.withColumn("m", F.count("*").over(by_key)).withColumn("at", F.row_number().over(by_key.orderBy("s"))).filter("m > 1").drop("kept")
    buckets, _ = materialize(many, "buckets")
    confirmed = labels = None
    low, high = 0, PIVOTS
    while not buckets.filter(F.col("m") > low + 1).isEmpty():
        rows = buckets.withColumn("c", F.col("s"))
        if labels is not None:
            rows = buckets.join(labels, buckets["s"] == labels["node"], "left").select(buckets["*"], F.coalesce("component", "s").alias("c"))
        left = rows.filter(F.col("m") > low + 1)
        pivots = left.filter((F.col("at") > low) & (F.col("at") <= high)).select("key", F.col("s").alias("u"), F.col("n").alias("nu"), F.col("fp").alias("fu"), F.col("at").alias("pivot"), F.col("c").alias("cu"))
        pairs = left.join(pivots, "key").filter((F.col("at") > F.col("pivot")) & (F.col("c") != F.col("cu")))
        pairs = pairs.filter(F.least("n", "nu") >= likeness * F.greatest("n", "nu")).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fu"))) <= radius)
        pairs = pairs.select("u", F.col("s").alias("v")).distinct()
        sides = [grams.select(F.col("s").alias(k), F.col("grams").alias(g)) for k, g in (("u", "a"), ("v", "b"))]
        found, _ = materialize(pairs.join(sides[0], "u").join(sides[1], "v").mapInArrow(_alike(likeness), "u bigint, v bigint"), "alike")
        confirmed = found if confirmed is None else confirmed.unionByName(found)
        labels, _ = materialize(connected_components(confirmed), "labels")
        low, high = high, high * MORE
    if labels is None:
        return grams.select("s", F.col("s").alias("root"))
    return grams.join(labels, grams["s"] == labels["node"], "left").select("s", F.coalesce("component", "s").alias("root"))


def set_groups(docs: DataFrame, sets: DataFrame, words: int, likeness: float, radius: int) -> DataFrame:
    """(s, root) for the sets (s, n, fp, rep) of components of two sets or more."""
    found, _ = materialize(connected_components(links(sets.select("fp").distinct(), radius)), "components")
    placed = sets.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("c", F.coalesce("component", "fp"))
    sizes = placed.groupBy("c").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1")
    large = (F.col("m") > COMPONENT_SETS) | (F.col("total") > COMPONENT_GRAMS)
    members, _ = materialize(placed.join(sizes.withColumn("large", large).drop("m", "total"), "c").select("c", "s", "n", "fp", "large", *[F.col(f"rep.{k}").alias(k) for k in KEY]), "members")
    texts = docs.select(*_hashes(docs), filled().alias("text"))

    def grams(chosen: DataFrame) -> DataFrame:
        return _with_grams(texts.join(chosen, KEY).dropDuplicates(KEY), words)

    small = grams(members.filter("not large")).groupBy("c").applyInPandas(_whole(likeness, radius), "s bigint, root bigint")
    if members.filter("large").isEmpty():
        return small
    return small.unionByName(_in_rounds(grams(members.filter("large")), likeness, radius))


def keep_one(docs: DataFrame, words: int = WORDS, likeness: float = LIKENESS, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies, with its own columns; of equal rows one stays."""
    rows, _ = materialize(_numbers(docs, words), "shingles")
    least = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", *KEY)
    sets, _ = materialize(rows.groupBy("s").agg(F.min(least).alias("rep"), F.max("n").alias("n"), F.max("fp").alias("fp")), "sets")
    groups, _ = materialize(set_groups(docs, sets, words, likeness, radius), "groups")
    reps = sets.select("s", "rep").join(groups, "s", "left").groupBy(F.coalesce("root", "s").alias("root")).agg(F.min("rep").alias("rep"))
    kept = reps.select(*[F.col(f"rep.{k}").alias(k) for k in KEY])
    keyed = docs.select(*_hashes(docs), F.struct("*").alias("doc"))
    return keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY).select("doc.*")
