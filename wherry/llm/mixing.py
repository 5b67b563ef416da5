"""Mixing sources to target weights by blocks, slots and index permutations.

The documents of a source are dealt by hash to groups of about GROUP_WORDS words, laid end to end within a group, the groups end to end,
and the whole is cut into blocks of BLOCK_WORDS words: all are full but the last. A source with n blocks and a target of t words gets the
slots whose blocks make up t words; slot j takes block perm(j mod n), where perm is a keyed Feistel permutation of the source and the
pass j div n, and of the block of the last slot only the words that are still missing are taken. So every source takes its target to the
word. Targets stop at twice the size, so no word is taken more than twice. The slots are dealt to output shards by multinomial draws: each
shard walks a binary tree of splits from the root, every split a binomial draw per source seeded by its node, which also gives the slot number
where the shard starts. No shard needs another's result; shards have SHARD_SLOTS slots in the mean, not each.

A row is known by two hashes of its values and, among equal rows, a number; equal rows are counted before the shuffle. So the mix does not
depend on how the table is split into files or tasks. A hot source is many groups and its blocks are joined by (source, block), so no key is hot.

The driver holds one row per source (name, size, target), as does each task that draws; documents, blocks and slots stay on the executors.
Only the source table is broadcast, and only up to BROADCAST_SOURCES rows; all other joins are merged.

Defined cases: a null text has size 0 and is never taken; null is a source of its own, after all others; equal rows are
documents of their own; a very long text is parts of many blocks; empty tables give empty results; extra columns are ignored by
`mix_counts`, kept by `mixed_documents`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wherry.llm.common import filled, free_name, groups_for, slices
from wherry.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 64
GROUP_WORDS = 250_000
SHARD_SLOTS = 16_384
SEED = 8
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_SOURCES = 50_000
#: Groups whose sizes one task adds up; the sums of such spans are added up by source.
SPAN_GROUPS = 4096


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words per source: `share` of all sizes by weight; what goes over `most` sizes is shared out again by weight."""
    found, open_, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / total > most * sizes[i]}
        if not over:
            for i in open_:
                found[i] = left * weights[i] / total
            break
        for i in over:
            found[i] = most * sizes[i]
        open_ -= over
        left -= sum(found[i] for i in over)
    return found


def _generator(*key: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little"))


def shard_counts(totals: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, slots) per source of one shard; over all shards they tile range(total) of each source."""
    low, high, start, count = 0, shards, np.zeros_like(totals), totals.copy()
    while high - low > 1:
        middle = (low + high) // 2
        left = _generator(seed, low, high).binomial(count, (middle - low) / (high - low))
        if shard < middle:
            high, count = middle, left
        else:
            low, start, count = middle, start + left, count - left
    return start, count


class Permutation:
    """A permutation of range(n), chosen by key: a four-round Feistel network, walked until it lands under n."""

    def __init__(self, n: int, *key: object):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = _generator("permute", *key).integers(0, 1 << 63, 4, dtype=np.uint64)

    def _round(self, x: np.ndarray, k: np.uint64) -> np.ndarray:
        m = (x + k) * np.uint64(0x9E3779B97F4A7C15)
        m ^= m >> np.uint64(29)
        m *= np.uint64(0xBF58476D1CE4E5B9)
        return (m >> np.uint64(32)) & self.mask

    def _forward(self, v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(self.half), v & self.mask
        for k in self.keys:
            left, right = right, left ^ self._round(right, k)
        return left << np.uint64(self.half) | right

    def _back(self, v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(self.half), v & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ self._round(left, k), left
        return left << np.uint64(self.half) | right

    def _walk(self, index: np.ndarray, step) -> np.ndarray:
        x = step(index.astype(np.uint64))
        while len(over := np.flatnonzero(x >= np.uint64(self.n))):
            x[over] = step(x[over])
        return x.astype(np.int64)

    def at(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._forward)

    def place_of(self, value: int) -> int:
        return int(self._walk(np.array([value]), self._back)[0])


def slots_for(target: int, size: int, block: int, *key: object) -> tuple[int, int]:
    """(slots of a source, words that the last of them takes; 0 if it takes its whole block)."""
    if not size:
        return 0, 0
    n = -(-size // block)
    passes, left = divmod(target, size)
    short = size - (n - 1) * block
    place = Permutation(n, *key, passes).place_of(n - 1)  # the one block that may be short
    if left >= place * block + short:
        whole, rest = divmod(left + block - short, block)
    else:
        whole = min(left // block, place)
        rest = left - whole * block
    return passes * n + whole + (rest > 0), rest


#: What a row is known by: two hashes of doc_id, source and text, one of the columns that a mix carries along, and a number among equal rows.
ROW = ("a", "b", "other", "occurrence")


def _hashes(carried: list[str]) -> list[Column]:
    known = [x for c in ("doc_id", "source", "text") for x in (F.col(c), F.isnull(c))]  # a hash passes over nulls
    other = F.xxhash64(F.to_json(F.struct(*carried))) if carried else F.lit(0).cast("bigint")
    return [F.xxhash64(*known).alias("a"), F.xxhash64(F.lit("b"), *known).alias("b"), other.alias("other")]


def _sized(docs: DataFrame, hashes: list[Column]) -> DataFrame:
    """ROW, doc_id, source, size of every row of docs; the texts are read once."""
    size = F.regexp_count(filled(), F.lit(WORD)).cast("bigint").alias("size")
    rows = docs.select(*hashes, F.col("doc_id").cast("bigint").alias("doc_id"), "source", size)
    counted, _ = materialize(rows.groupBy("a", "b", "other", "doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    return counted.select("a", "b", "other", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("occurrence"), "doc_id", "source", "size")


class Plan:
    """The blocks, fragments and slots of a mix."""

    def __init__(self, sizes: DataFrame, weights: tuple[float, ...], share: float, most: float, block: int, seed: int):
        self.spark, self.block, self.seed = sizes.sparkSession, block, seed
        stats = sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()
        stats.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        self.sizes = [r["size"] for r in stats]
        self.targets = targets(self.sizes, [weights[i % len(weights)] for i in range(len(stats))], share, most)
        rows = [(r["source"], i, r["size"], t, groups_for(r["size"], GROUP_WORDS)) for i, (r, t) in enumerate(zip(stats, self.targets))]
        self.sources = self.spark.createDataFrame(rows, "source string, source_index int, source_size bigint, target double, n_groups bigint")
        side = F.broadcast(self.sources) if len(rows) <= BROADCAST_SOURCES else self.sources
        named = sizes.alias("d").join(side.alias("s"), F.expr("d.source <=> s.source")).select(*[f"d.{c}" for c in ROW], "d.doc_id", "d.size", "s.source_index", "s.source_size", "s.target", "s.n_groups")
        self.docs = named.withColumn("group", F.pmod(F.xxhash64("a", "b", "occurrence"), "n_groups")).drop("n_groups")
        made = [slots_for(round(t), s, block, seed, i) for i, (t, s) in enumerate(zip(self.targets, self.sizes))]
        self.slots_of, self.last_words = np.array([n for n, _ in made], dtype=np.int64), np.array([w for _, w in made], dtype=np.int64)
        self.blocks = np.array([-(-s // block) for s in self.sizes], dtype=np.int64)

    def _group_starts(self) -> DataFrame:
        """source_index, group, first_word: sums over the groups before, first of whole spans of groups, then within a span."""
        groups = self.docs.groupBy("source_index", "group").agg(F.sum("size").alias("words")).withColumn("span", F.expr(f"group div {SPAN_GROUPS}"))
        before = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sum_before = lambda window: F.coalesce(F.sum("words").over(window), F.lit(0))
        spans = groups.groupBy("source_index", "span").agg(F.sum("words").alias("words"))
        spans = spans.select("source_index", "span", sum_before(before(["source_index"], "span")).alias("span_start"))
        inside = groups.withColumn("start", sum_before(before(["source_index", "span"], "group")))
        return inside.join(spans.hint("merge"), ["source_index", "span"]).select("source_index", "group", (F.col("span_start") + F.col("start")).alias("first_word"))

    def fragments(self) -> DataFrame:
        """ROW, source_index, block, at (place in the block), skip (words of the document before it) and words: the parts of documents in blocks."""
        before = Window.partitionBy("source_index", "group").orderBy(*ROW).rowsBetween(Window.unboundedPreceding, -1)
        placed = self.docs.filter("size > 0").withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        placed = placed.join(self._group_starts().hint("merge"), ["source_index", "group"]).withColumn("start", F.col("start") + F.col("first_word"))
        placed = placed.withColumn("stop", F.col("start") + F.col("size"))
        b = self.block
        each = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (stop - 1) div {b})"))).withColumn("from", F.expr(f"greatest(start, block * {b})"))
        return each.select(*ROW, "source_index", "block", F.expr(f"from - block * {b}").alias("at"), F.expr("from - start").alias("skip"), F.expr(f"least(stop, (block + 1) * {b}) - from").alias("words"))

    def slots(self) -> DataFrame:
        """shard, source_index, slot, block, words (of the block, for the last slot of a source; else null): what every output shard takes."""
        totals, blocks, last, seed = self.slots_of, self.blocks, self.last_words, self.seed
        shards = groups_for(int(totals.sum()), SHARD_SLOTS)

        def drawn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for shard in frame["id"]:
                    start, count = shard_counts(totals, shards, int(shard), seed)
                    for s in np.flatnonzero(count):
                        slot = np.arange(start[s], start[s] + count[s])
                        found, passes = np.empty(len(slot), dtype=np.int64), slot // blocks[s]
                        for p in np.unique(passes):
                            here = passes == p
                            found[here] = Permutation(int(blocks[s]), seed, int(s), int(p)).at(slot[here] % blocks[s])
                        is_part = (slot == totals[s] - 1) & (last[s] > 0)
                        yield pd.DataFrame({"shard": shard, "source_index": np.int32(s), "slot": slot, "block": found, "words": pd.arrays.IntegerArray(np.full(len(slot), last[s]), ~is_part)})

        tasks = min(shards, max(self.spark.sparkContext.defaultParallelism, shards // 16))
        return self.spark.range(0, shards if totals.sum() else 0, 1, tasks).mapInPandas(drawn, "shard bigint, source_index int, slot bigint, block bigint, words bigint")

    def taken(self) -> DataFrame:
        """ROW, skip, words, times: parts of documents that the mix takes; no two overlap."""
        per_block = self.slots().groupBy("source_index", "block").agg(F.count(F.when(F.col("words").isNull(), 1)).alias("times"), F.coalesce(F.max("words"), F.lit(0)).alias("part"))
        both = self.fragments().join(per_block.hint("merge"), ["source_index", "block"]).withColumn("more", F.expr("greatest(0L, least(words, part - at))"))
        split = F.expr("inline(filter(array(struct(skip as skip, more as words, times + 1 as times), struct(skip + more as skip, words - more as words, times as times)), x -> x.words > 0 and x.times > 0))")
        return both.select(*ROW, split)


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK_WORDS, seed: int = SEED) -> Plan:
    return Plan(_sized(docs, _hashes([])), weights, share, most, block, seed)


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) for every row of docs."""
    made = plan(docs, **options)
    words = made.taken().groupBy(*ROW).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    found = made.docs.join(words.hint("merge"), list(ROW), "left")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def shard_contents(docs: DataFrame, **options) -> DataFrame:
    """shard, source_index, slot, ROW, skip, words: what stands in each slot of each output shard, blocks joined by index."""
    made = plan(docs, **options)
    slots = made.slots().withColumnRenamed("words", "limit")
    both = slots.join(made.fragments().hint("merge"), ["source_index", "block"]).withColumn("words", F.expr("coalesce(least(words, limit - at), words)"))
    return both.filter("words > 0").select("shard", "source_index", "slot", *ROW, "skip", "words")


def _span_texts(text: str, spans: list[tuple[int, int, int]], most: int) -> list[str]:
    """For each copy 1..most: the parts of text that are taken so often; neighbours stay joined as they stand in the text."""
    found = [m.span() for m in re.finditer(WORD, text)]
    copies = []
    for copy in range(1, most + 1):
        runs: list[list[int]] = []
        for skip, words, times in sorted(spans):
            if times >= copy:
                if runs and runs[-1][1] == skip:
                    runs[-1][1] = skip + words
                else:
                    runs.append([skip, skip + words])
        if runs == [[0, len(found)]]:
            copies.append(text)
        elif runs:
            copies.append("\n".join(text[found[a][0] : found[b - 1][1]] for a, b in runs))
    return copies


def mixed_documents(docs: DataFrame, most: float = MOST, **options) -> DataFrame:
    """The documents of the mix, with the columns of docs: what is taken twice stands twice, what is not taken is left out.

    A document taken whole keeps its text; of one taken in part, text and n_chars (if docs has it) are those of the parts.
    Rows that are equal in all columns stand once in the join, and once in the result for each time they are taken.
    """
    parts = free_name(docs, "_spans")
    hashes = _hashes([c for c in docs.columns if c not in ("doc_id", "source", "text")])
    made = Plan(_sized(docs, hashes), options.get("weights", WEIGHTS), options.get("share", SHARE), most, options.get("block", BLOCK_WORDS), options.get("seed", SEED))
    spans = made.taken().groupBy(*ROW).agg(F.collect_list(F.struct("skip", "words", "times")).alias("spans"))
    keyed = docs.select(*hashes, F.struct("*").alias("doc")).dropDuplicates(["a", "b", "other"])
    both = keyed.join(spans.hint("merge"), ["a", "b", "other"])
    copies = int(np.ceil(most))

    names, place = docs.columns, docs.columns.index("text")

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [_span_texts(t, [(s["skip"], s["words"], s["times"]) for s in found], copies) for t, found in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist())]
            at, texts = pa.array([k for k, x in enumerate(made) for _ in x], pa.int64()), [t for x in made for t in x]
            columns = [batch.column(k).take(at) for k in range(len(names))]
            columns[place] = pa.array(texts, batch.column(place).type)
            if "n_chars" in names:
                columns[names.index("n_chars")] = pa.array([len(t) for t in texts], columns[names.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.select("doc.*", F.col("spans").alias(parts)).mapInArrow(expanded, docs.schema)
