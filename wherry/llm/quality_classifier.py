"""Quality grades by ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(theta_k - w.x): one weight vector for all grades, thresholds kept in order by adding exponentials.
The expected grade is the sum of the tails P(grade > k); selection uses the tail of the top grade.

Grades from `labels`: 0 is toxic, 1 is low quality, 2 is neither. Toxic words add up without bound and so belong at an end; the shares of
word shapes that mark low quality are bounded and fit between two thresholds.
Features: presence of lower-cased words without their outer punctuation, shares of word shapes (runs of letter case,
digits and the marks themselves), and the share of words equal to the word before; all hashed to DIMENSIONS weights.

Fit on at most `sample` labelled documents (a documented bound; chosen by hash of doc_id, whole texts): at most `sample` feature lists, none longer
than DIMENSIONS. However long the texts, the driver takes the lists a partition at a time into a temporary file and reads that CHUNK_FEATURES
features at a time. The model is DIMENSIONS floats and goes out with the tasks. Scoring reads every whole text.

Defined cases: a null text is the empty text; labels without a document, and null labels, are left out; of several labels of a document the
lowest grade counts; of several documents with a labelled doc_id, the one with the smallest hash of its text is fitted; with fewer than two
different grades the model keeps every document; a very long text has one feature list like any other; one row per input row; empty tables
give empty results.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, slices

DIMENSIONS = 1 << 18
GRADES = 3
SAMPLE = 8_000
MIN_DOCUMENTS = 3
LEAST_Z = 4.0
THRESHOLD = 0.5
SHAPE_SCALE = 10.0
CACHE_WORDS = 200_000
EDGES = re.compile(r"^\W+|\W+$")
REPEATED = 0
#: Features that the fit holds at once, unless one list is longer.
CHUNK_FEATURES = 1 << 20


def _slot(kind: str, name: str) -> int:
    return 1 + xxhash.xxh64_intdigest(f"{kind}:{name}", 2) % (DIMENSIONS - 1)


def shape(word: str) -> str:
    """X for capitals, x for other letters, 0 for digits, marks as they are; runs of one kind are one."""
    out = [""]
    for ch in word:
        kind = "X" if ch.isupper() else "x" if ch.isalpha() else "0" if ch.isdigit() else ch
        if out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Hasher:
    """Sparse features of whole texts; the slots of a word are looked up once while it stays in the cache."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def _slots(self, word: str) -> tuple[int, int]:
        if word not in self.known:
            if len(self.known) > CACHE_WORDS:
                self.known = {}
            self.known[word] = _slot("word", EDGES.sub("", word).lower()), _slot("shape", shape(word))
        return self.known[word]

    def features(self, text: str) -> dict[int, float]:
        words = text.split()
        if not words:
            return {}
        found: dict[int, float] = {}
        shapes: Counter[int] = Counter()
        for word, n in Counter(words).items():
            w, s = self._slots(word)
            found[w] = 1.0
            shapes[s] += n
        for s, n in shapes.items():
            found[s] = SHAPE_SCALE * n / len(words)
        found[REPEATED] = SHAPE_SCALE * sum(map(eq, words, words[1:])) / len(words)
        return found


_HASHER = Hasher()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIMENSIONS, np.float32))
    thresholds: np.ndarray | None = None  # None: nothing was learned, every tail is 1

    def score(self, text: str, hasher: Hasher) -> float:
        weights = self.weights
        return float(sum(weights[k] * v for k, v in hasher.features(text).items()))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) in column k."""
        if self.thresholds is None:
            return np.ones((len(scores), GRADES - 1))
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _mapped(file, kind: type) -> np.ndarray:
    """The numbers written to a file, read from it when they are used."""
    file.flush()
    return np.asarray(np.memmap(file, kind, "r")) if os.fstat(file.fileno()).st_size else np.zeros(0, kind)


def _spans(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Runs of lists that hold CHUNK_FEATURES features at most, or one list."""
    ends, spans, at = np.cumsum(lengths), [], 0
    while at < len(lengths):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_FEATURES, "right")))
        spans.append((at, stop))
        at = stop
    return spans


def _telling(indices: list[np.ndarray], values: list[np.ndarray], lengths: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Which features go along with some cut of the grades by at least LEAST_Z standard errors: the rest would only fit noise."""
    n = len(grades)
    above = [(grades > k).astype(float) for k in range(GRADES - 1)]
    count, total, squares, *tops = np.zeros((3 + len(above), DIMENSIONS))
    for a, b in _spans(lengths):
        rows, cols, vals = np.repeat(np.arange(a, b), lengths[a:b]), np.concatenate(indices[a:b]), np.concatenate(values[a:b])
        count += np.bincount(cols, minlength=DIMENSIONS)
        for out, x in ((total, vals), (squares, vals.astype(float) ** 2)):
            out += np.bincount(cols, weights=x, minlength=DIMENSIONS)
        for out, over in zip(tops, above):
            out += np.bincount(cols, weights=vals * over[rows], minlength=DIMENSIONS)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 1e-12))
    z = np.zeros(DIMENSIONS)
    for top, over in zip(tops, above):
        if over.std() > 0:
            z = np.maximum(z, np.abs(top / n - mean * over.mean()) / (spread * over.std()) * np.sqrt(n))
    return (count >= MIN_DOCUMENTS) & (z >= LEAST_Z)


def fit(indices: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, steps: int = 300, rate: float = 0.1, penalty: float = 5e-4) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty by full-batch Adam; the same input gives the same model. The lists may lie in files."""
    present = np.unique(grades)
    if len(present) < 2:
        return OrdinalModel()
    lengths = np.array([len(x) for x in indices])
    columns = np.flatnonzero(_telling(indices, values, lengths, grades))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[columns] = np.arange(len(columns))
    with tempfile.TemporaryFile() as cols_file, tempfile.TemporaryFile() as vals_file:
        for k, (index, value) in enumerate(zip(indices, values)):
            at = place[index]
            at[at >= 0].tofile(cols_file)
            value[at >= 0].astype(np.float32, copy=False).tofile(vals_file)
            lengths[k] = (at >= 0).sum()
        cols, vals = _mapped(cols_file, np.int32), _mapped(vals_file, np.float32)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    spans = [(slice(a, b), slice(ends[a], ends[b])) for a, b in _spans(lengths)]
    parts = lambda: ((rows, np.repeat(np.arange(rows.stop - rows.start), lengths[rows]), cols[at].astype(np.int64), vals[at]) for rows, at in spans)
    if len(spans) == 1:
        whole = list(parts())
        parts = lambda: whole
    n, d, cuts = len(grades), len(columns), GRADES - 1
    above = np.array([(grades > k).mean() for k in range(cuts)]).clip(0.5 / n, 1 - 0.5 / n)
    theta = np.log((1 - above) / above)
    params = np.concatenate([np.zeros(d), [theta[0]], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, gaps = params[:d], np.exp(params[d + 1 :])
        theta = params[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.concatenate([np.bincount(row, weights=x * w[col], minlength=rows.stop - rows.start) for rows, row, col, x in parts()])
        edge = np.concatenate([np.full((n, 1), -np.inf), theta[None, :] - eta[:, None], np.full((n, 1), np.inf)], axis=1)
        cdf = _sigmoid(edge)
        low, high = np.take_along_axis(cdf, grades[:, None], 1)[:, 0], np.take_along_axis(cdf, grades[:, None] + 1, 1)[:, 0]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        g_eta = (d_high - d_low) / n  # of the negative log likelihood
        g_theta = np.array([(np.where(grades == k + 1, d_low, 0) - np.where(grades == k, d_high, 0)).sum() / n for k in range(cuts)])
        g_gaps = np.array([g_theta[k + 1 :].sum() for k in range(cuts - 1)]) * gaps
        g_w = sum(np.bincount(col, weights=x * g_eta[rows][row], minlength=d) for rows, row, col, x in parts())
        g = np.concatenate([g_w + penalty * w, [g_theta.sum()], g_gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[columns] = params[:d]
    return OrdinalModel(weights, params[d] + np.concatenate([[0.0], np.cumsum(np.exp(params[d + 1 :]))]))


def grade() -> Column:
    """0, 1 or 2 from the columns quality and toxic; null if either is."""
    return F.when(F.col("toxic") == 1, 0).when((F.col("quality") == 0) & (F.col("toxic") == 0), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The feature lists as bytes: int32 indices, float32 values."""
    names = ["doc_id", "grade", "text_hash"]
    for batch in slices(batches, "text"):
        lists = [[], []]
        for text in batch.column("text").to_pylist():
            found = _HASHER.features(text)
            for out, x, kind in zip(lists, (found.keys(), found.values()), (np.int32, np.float32)):
                out.append(np.fromiter(x, kind, len(found)).tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(x, pa.binary()) for x in lists)], names=[*names, "indices", "values"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> OrdinalModel:
    """A model fitted on at most `sample` labelled documents."""
    graded = labels.select(F.col("doc_id").cast("bigint"), grade().alias("grade")).filter("doc_id is not null and grade is not null")
    chosen = graded.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint"), filled().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers
    found = joined.select("doc_id", "grade", "text_hash", "text").mapInArrow(_sample_features, "doc_id bigint, grade int, text_hash bigint, indices binary, values binary")
    one = found.groupBy("doc_id").agg(F.min(F.struct("text_hash", "grade", "indices", "values")).alias("x"))
    ids, grades, lengths = [], [], []
    with tempfile.TemporaryFile() as cols_file, tempfile.TemporaryFile() as vals_file:
        for doc_id, g, index, value in one.select("doc_id", "x.grade", "x.indices", "x.values").toLocalIterator():
            cols_file.write(index)
            vals_file.write(value)
            ids.append(doc_id)
            grades.append(g)
            lengths.append(len(index) // 4)
        cols, vals = _mapped(cols_file, np.int32), _mapped(vals_file, np.float32)
    if not ids:
        return OrdinalModel()
    order, ends = np.argsort(ids), np.cumsum(lengths)
    lists = [slice(ends[k] - lengths[k], ends[k]) for k in order]
    return fit([cols[x] for x in lists], [vals[x] for x in lists], np.array(grades, np.int64)[order], **options)


def score(docs: DataFrame, model: OrdinalModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, expected_grade, top_probability and kept for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            tails = known.tails(np.array([known.score(t, _HASHER) for t in batch.column("text").to_pylist()], dtype=float))
            columns = [batch.column("doc_id"), pa.array(tails.sum(axis=1).round(6)), pa.array(tails[:, -1].round(6))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_grade", "top_probability"])

    rows = docs.select(F.col("doc_id").cast("bigint"), filled().alias("text"))
    found = rows.mapInArrow(scored, "doc_id bigint, expected_grade double, top_probability double")
    return found.withColumn("kept", F.col("top_probability") >= threshold)


def filter_documents(docs: DataFrame, model: OrdinalModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose top grade is probable enough, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            tails = known.tails(np.array([known.score(t or "", _HASHER) for t in batch.column(place).to_pylist()], dtype=float))
            yield batch.filter(pa.array(tails[:, -1].round(6) >= threshold))

    return docs.mapInArrow(chosen, docs.schema)
