"""Stupid-backoff scores from n-gram counts over the whole corpus, each document's own counts left out.

With c the counts of the corpus less those of the document scored (N' their number of words), a word w after the words v scores
c(v w) / c(v) if c(v w) > 0, else BACKOFF times its score after v without its first word; with no word before it, it scores c(w) / N', a count
of zero there being read as one half. v is the `order` - 1 words before w, or as many as the document has. A document's score is the sum of the
natural logarithms. Words are lower-cased (A-Z) runs outside ASCII white space.

Relations: documents are dealt into chunks of about CHUNK_WORDS words. The n-grams of each chunk (64-bit hashes, orders 1 to `order`) are counted
and sent, once per chunk and different n-gram, to the partition of their hash: the count tables. There the counts of all chunks are summed, and
joined back: each chunk gets the totals of its own n-grams, in the order it sent them. The chunk joins them to its documents' n-grams
and sums per document. A row holds the n-grams of one chunk, order and partition as packed arrays, and there is a row only where there are
n-grams: the rows never outnumber the different n-grams of the chunks, and partitions have about PART_WORDS words at any size. No n-gram, however
frequent, is more than one entry per chunk, and no count is dropped. The chunk of a row is drawn from its place in the input, so equal rows
are spread as well; the input must give its rows in the same order when a task is repeated, as files do, and a chunk that gets totals for other
n-grams than it has is an error.

Defined cases: a null text is the empty text, with 0 words and log-probability 0; equal rows count as different documents (a copy
is known from its twin); a very long text is one document of its chunk; one row per input row; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, groups_for

BACKOFF = 0.4
UNSEEN = 0.5
ORDER = 2
CHUNK_WORDS = 2_000_000
CHUNK_ROWS = 100_000
PART_WORDS = 2_500_000
CACHE_WORDS = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[bytes, int] = {}


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words; those of frequent words stay in a bounded cache."""
    global _WORDS
    if len(_WORDS) > CACHE_WORDS:
        _WORDS = {}
    parts = text.encode().lower().split()
    digest, known = xxhash.xxh64_intdigest, _WORDS
    for p in parts:
        if p not in known:
            known[p] = digest(p)
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


def longer_hashes(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams followed by a word."""
    x = grams * MIX ^ (words + MIX)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


class Chunk:
    """The n-grams of some documents and where each stands."""

    def __init__(self, texts: list[str], order: int = ORDER):
        each = [word_hashes(t) for t in texts]
        self.sizes = np.array([len(x) for x in each], dtype=np.int64)
        words = np.concatenate([*each, np.zeros(0, np.uint64)])
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        before = np.arange(len(words)) - np.repeat(starts, self.sizes)  # words of the document before each word
        #: per order: where n-grams end, the different ones in ascending order, which of them ends there, and their counts
        self.ends, self.grams, self.at, self.counts = [], [], [], []
        hashes = words
        for n in range(order):
            ends = np.flatnonzero(before >= n)
            if n:
                hashes = np.zeros_like(words)
                hashes[ends] = longer_hashes(previous[ends - 1], words[ends])
            grams, at, counts = np.unique(hashes[ends], return_inverse=True, return_counts=True)
            self.ends.append(ends)
            self.grams.append(grams)
            self.at.append(at.ravel())
            self.counts.append(counts)
            previous = hashes

    def dealt(self, n: int, partitions: int) -> tuple[np.ndarray, np.ndarray]:
        """(order of the n-grams by partition and hash, how many each partition gets)."""
        place = (self.grams[n] >> np.uint64(11)) % np.uint64(partitions)
        return np.argsort(place, kind="stable"), np.bincount(place.astype(np.int64), minlength=partitions)

    def own(self, n: int) -> np.ndarray:
        """For each n-gram position, its count in its own document."""
        key = self.doc[self.ends[n]] * np.int64(max(1, len(self.grams[n]))) + self.at[n]
        _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        return counts[back.ravel()]

    def scores(self, totals: list[np.ndarray], corpus_words: int) -> np.ndarray:
        """Log-probability of each document, given the corpus counts of the n-grams of each order."""
        shorter = (totals[0][self.at[0]] - self.own(0)).astype(float)
        others = (corpus_words - self.sizes[self.doc]).astype(float)
        logs = np.log(np.maximum(shorter, UNSEEN)) - np.log(np.maximum(others, 1.0))
        for n in range(1, len(self.grams)):
            ends = self.ends[n]
            count = (totals[n][self.at[n]] - self.own(n)).astype(float)
            known = count > 0
            logs[ends] += math.log(BACKOFF)
            logs[ends[known]] = np.log(count[known]) - np.log(shorter[ends[known] - 1])
            shorter = np.zeros(len(self.doc))
            shorter[ends] = count
        return np.bincount(self.doc, weights=logs, minlength=len(self.sizes))


GRAMS = "part int, chunk int, n int, grams binary, counts binary"
TOTALS = "chunk int, part int, n int, totals binary"


def _narrow(counts: np.ndarray) -> tuple[int, np.ndarray]:
    """The bytes of the smallest unsigned integers that hold counts, and counts as those."""
    size = next(k for k in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << 8 * k)
    return size, counts.astype(f"<u{size}")


def _wide(data: bytes, length: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // max(1, length)}", count=length).astype(np.int64)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive stretches of data as binary values."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _sent(chunk: int, made: Chunk, partitions: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk: one for each order and partition with n-grams."""
    for n, (grams, counts) in enumerate(zip(made.grams, made.counts)):
        by, sizes = made.dealt(n, partitions)
        used = np.flatnonzero(sizes)
        _, narrow = _narrow(counts)
        columns = [pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int32()), pa.array(np.full(len(used), n), pa.int32()), _binary(grams[by].astype("<u8"), sizes[used]), _binary(narrow[by], sizes[used])]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "n", "grams", "counts"])


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str]]]:
    """The texts of each chunk, from batches sorted by chunk."""
    chunk, texts = None, []
    for batch in batches:
        for at, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist()):
            if at != chunk:
                if chunk is not None:
                    yield chunk, texts
                chunk, texts = at, []
            texts.append(text)
    if chunk is not None:
        yield chunk, texts


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    """The count table of one partition, joined back to what each chunk sent."""
    found = []
    for _, rows in frame.groupby("n"):
        grams = [np.frombuffer(g, "<u8") for g in rows["grams"]]
        sizes = [len(g) for g in grams]
        _, at = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.concatenate([_wide(c, size) for c, size in zip(rows["counts"], sizes)])
        table = np.bincount(at.ravel(), weights=counts).astype(np.int64)
        each = np.split(table[at.ravel()], np.cumsum(sizes)[:-1])
        found.append(pd.DataFrame({"chunk": rows["chunk"], "part": rows["part"], "n": rows["n"], "totals": [_narrow(t)[1].tobytes() for t in each]}))
    return pd.concat(found)


def _received(made: Chunk, rows: pd.DataFrame, partitions: int) -> list[np.ndarray]:
    """The corpus count of each n-gram of a chunk, from the rows that came back."""
    totals = []
    for n, grams in enumerate(made.grams):
        by, sizes = made.dealt(n, partitions)
        some = rows[rows["n"] == n].sort_values("part")
        if some["part"].tolist() != np.flatnonzero(sizes).tolist():
            raise RuntimeError("the totals are those of other n-grams: the input did not give the same rows twice")
        found = np.empty(len(grams), np.int64)
        if len(some):
            found[by] = np.concatenate([_wide(data, size) for data, size in zip(some["totals"], sizes[sizes > 0].tolist())])
        totals.append(found)
    return totals


def score_documents(docs: DataFrame, order: int = ORDER, chunk_words: int = CHUNK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_words, log_probability and perplexity for every row of docs."""
    words = F.coalesce(F.sum(F.regexp_count(filled(), F.lit(r"[^\x20\x09-\x0D]+"))), F.lit(0))
    total, rows = docs.agg(words, F.count("*")).first()
    chunks, partitions = max(groups_for(total, chunk_words), groups_for(rows, CHUNK_ROWS)), groups_for(total, part_words)
    placed = docs.select(F.col("doc_id").cast("bigint"), filled().alias("text"), F.monotonically_increasing_id().alias("place"))
    # twice as many tasks as chunks: fewer tasks get several
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("place"), F.lit(chunks)).cast("int")).drop("place").repartition(2 * chunks, "chunk")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, texts in _by_chunk(batches):
            yield from _sent(chunk, Chunk(texts, order), partitions)

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        made = Chunk(left["text"].tolist(), order)
        return pd.DataFrame({"doc_id": left["doc_id"], "n_words": made.sizes, "log_probability": made.scores(_received(made, right, partitions), total)})

    known = placed.sortWithinPartitions("chunk").mapInArrow(counted, GRAMS).groupBy("part").applyInPandas(_joined, TOTALS)
    # the texts stay where the first exchange put them; only the totals move
    both = placed.groupBy("chunk").cogroup(known.groupBy("chunk"))
    found = both.applyInPandas(scored, "doc_id bigint, n_words bigint, log_probability double")
    return found.select(
        "doc_id", "n_words", F.round("log_probability", 3).alias("log_probability"),
        F.round(F.when(F.col("n_words") > 0, F.exp(-F.col("log_probability") / F.col("n_words"))), 2).alias("perplexity"),
    )
