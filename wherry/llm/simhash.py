"""SimHash near-duplicates by covering locality-sensitive hashing.

Up to three differing bits: every bit position gets a nonzero vector of four bits; table v (v = 1..15) keeps the positions whose vector has an odd
inner product with v. The differing bits are three linear conditions on v in four dimensions, so some nonzero v meets them all: in that table
the two fingerprints agree on every kept bit. For a wider radius the positions are cut in so many blocks that one of them has three
differing bits at most, and each block has its own 15 tables. No pair within the radius is missed.

Equal fingerprints are one row before any bucket is built. A bucket of more than BUCKET_ROWS different fingerprints is
dealt anew, at most twice: its free bits are cut in radius + 1 blocks, of which the differing bits leave one untouched. What is still large
then, a task links by the same cuts and then directly, at eight bytes a fingerprint. A bucket returns a spanning star for each of its
components, never all its pairs; of up to SMALL fingerprints, the links themselves.

A fingerprint that many rows share is joined back by a broadcast of those that a thousandth of the rows or more share, of which there are
a thousand at most; the others are merged.

Defined cases: a null text counts as empty; texts without words have fingerprint zero and are linked like any other;
repeated rows are linked to each other; a null doc_id takes part but is never the smallest unless its group has no other; a very long text is
read whole; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, slices
from wherry.operators.components import connected_components
from wherry.session import materialize

RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET_ROWS = 4096
DIRECT = 1024
SMALL = 6
HOT_SHARE = 1000
ALL = (1 << 64) - 1


def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's shingles of so many words, one per place (of all its words if fewer; empty if none)."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space separates
    if not parts:
        return np.zeros(0, dtype="<u8")
    ends = list(accumulate(map(len, parts), lambda a, n: a + 1 + n))
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], dtype="<u8")
    starts = [0, *(e + 1 for e in ends)]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])), dtype="<u8", count=len(parts) - words + 1)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's three-word shingles (all its words if fewer; zero if none)."""
    return fingerprint_of(shingle_hashes(text))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65536):
        part = hashes[k : k + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = pa.array([signed(fingerprint(t)) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row of docs; fp is the fingerprint as a signed long."""
    return docs.select(F.col("doc_id").cast("bigint"), filled().alias("text")).mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


# ---- masks -------------------------------------------------------------------------------------------------------


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The kept bits of the tables: 15 for each block, and a block for each four bits of radius + 1."""
    blocks = -(-(radius + 1) // 4)
    within = radius // blocks  # one block has no more differing bits than this
    masks = []
    for k in range(blocks):
        places = range(k, 64, blocks)
        vectors = [j % ((2 << within) - 1) + 1 for j in range(len(places))]
        masks += [sum(1 << i for i, m in zip(places, vectors) if (m & v).bit_count() & 1) for v in range(1, 2 << within)]
    return masks


def cuts(kept: int, radius: int = RADIUS) -> list[int]:
    """The kept masks after each of radius + 1 blocks of the free bits is kept too."""
    free = [i for i in range(64) if not kept >> i & 1]
    return [kept | sum(1 << i for i in free[k :: radius + 1]) for k in range(radius + 1)]


# ---- linking one bucket ---------------------------------------------------------------------------------------------


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _union(parent: np.ndarray, a: int, b: int) -> None:
    a, b = _root(parent, a), _root(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def _link(values: np.ndarray, index: np.ndarray, kept: int, parent: np.ndarray, radius: int) -> None:
    """Join the components of values[index], which agree on the kept bits."""
    if len(index) <= DIRECT:
        left = index
        front: list[int] = []
        while len(left):
            if not front:
                front, left = [int(left[0])], left[1:]
            at = front.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= radius
            for j in left[near].tolist():
                _union(parent, at, j)
                front.append(j)
            left = left[~near]
        return
    for mask in cuts(kept, radius):
        keys = values[index] & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.diff(keys[order])) + 1
        for part in np.split(index[order], edges):
            if len(part) > 1:
                _link(values, part, mask, parent, radius)


def link_bucket(values: np.ndarray, kept: int = 0, radius: int = RADIUS) -> np.ndarray:
    """For different fingerprints that agree on the kept bits: the position of the first of each one's component."""
    parent = np.arange(len(values))
    _link(values, np.arange(len(values)), kept, parent, radius)
    return np.array([_root(parent, i) for i in range(len(values))], dtype=np.int64)


def _edges(block: np.ndarray, radius: int) -> pa.RecordBatch:
    """Edges of whole buckets: rows kept, key, fp, sorted by (kept, key)."""
    kept, key, fp = block
    cut = np.flatnonzero((kept[1:] != kept[:-1]) | (key[1:] != key[:-1])) + 1
    starts, stops = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
    sizes = stops - starts
    last = np.repeat(np.where(sizes <= SMALL, stops, starts), sizes)
    left, right = [fp[:0]], [fp[:0]]
    for step in range(1, SMALL):
        at = np.flatnonzero(np.arange(len(fp)) + step < last)
        at = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
        left.append(fp[at])
        right.append(fp[at + step])
    for a, b in zip(starts[sizes > SMALL].tolist(), stops[sizes > SMALL].tolist()):
        values = fp[a:b]
        root = link_bucket(values, int(kept[a]), radius)
        moved = np.flatnonzero(root != np.arange(len(values)))
        left.append(values[root[moved]])
        right.append(values[moved])
    columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)]
    return pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def _bucket_edges(radius: int):
    """Rows (kept, key, fp) sorted by (kept, key) -> edges. A bucket may run over several batches."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("kept", "key", "fp")])
            same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            done = int(np.argmax(same))
            if not done and rest and (rest[-1][:2, -1] == rows[:2, -1]).all():
                rest.append(rows)  # one bucket goes on
                continue
            whole = np.concatenate([*rest, rows[:, :done]], axis=1)
            if whole.shape[1]:
                yield _edges(whole, radius)
            rest = [rows[:, done:]]
        if rest:
            yield _edges(np.concatenate(rest, axis=1), radius)

    return found


# ---- the join -------------------------------------------------------------------------------------------------------


def _dealt(fps: DataFrame, masks: list[int]) -> DataFrame:
    kept = F.explode(F.array(*[F.lit(signed(m)).cast("bigint") for m in masks]))
    return fps.select("fp", kept.alias("kept")).withColumn("key", F.col("fp").bitwiseAND(F.col("kept")))


def _recut(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Rows of large buckets, dealt to the cuts of their masks."""
    options = F.create_map(*[x for m in masks for x in (F.lit(signed(m)).cast("bigint"), F.array(*[F.lit(signed(c)).cast("bigint") for c in cuts(m, radius)]))])
    return rows.select("fp", F.explode(options[F.col("kept")]).alias("kept")).withColumn("key", F.col("fp").bitwiseAND(F.col("kept")))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of the different fingerprints fps.fp within the radius."""
    masks = covering_masks(radius)
    rows, parts = _dealt(fps, masks), []
    for _ in range(2):
        large, _path = materialize(rows.groupBy("kept", "key").count().filter(F.col("count") > BUCKET_ROWS).select("kept", "key"), "large")
        if large.isEmpty():
            break
        parts.append(rows.join(large, ["kept", "key"], "left_anti"))
        rows = _recut(rows.join(large, ["kept", "key"], "left_semi"), masks, radius)
        masks = [c for m in masks for c in cuts(m, radius)]
    parts.append(rows)
    found = None
    for part in parts:
        placed = part.select("kept", "key", "fp").repartition("kept", "key").sortWithinPartitions("kept", "key")
        edges = placed.mapInArrow(_bucket_edges(radius), "u bigint, v bigint")
        found = edges if found is None else found.unionByName(edges)
    return found.distinct()


def fingerprint_components(rows: DataFrame) -> DataFrame:
    """(fp, n, component_id) per different fingerprint of rows (doc_id, fp); n counts its rows."""
    least = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id"))
    fps, _ = materialize(rows.groupBy("fp").agg(F.min(least).alias("rep"), F.count("*").alias("n")), "fps")
    labels, _ = materialize(connected_components(links(fps)), "labels")
    rooted = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    groups = rooted.groupBy("root").agg(F.min("rep").alias("rep"))
    return rooted.select("fp", "n", "root").join(groups, "root").select("fp", "n", F.col("rep.doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) per row of docs."""
    rows, _ = materialize(fingerprints(docs), "simhash")
    found, _ = materialize(fingerprint_components(rows), "components")
    n = rows.count()
    hot = F.broadcast(found.filter(F.col("n") * HOT_SHARE >= n).select("fp", "component_id"))  # at most HOT_SHARE rows
    joined = rows.join(hot, "fp").unionByName(rows.join(hot, "fp", "left_anti").join(found.select("fp", "component_id"), "fp"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
