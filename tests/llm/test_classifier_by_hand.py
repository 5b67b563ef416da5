"""The ordinal model against its definition: features, scores, probabilities and likelihood written out again."""

import math
import re
from collections import Counter

import numpy as np
import xxhash
from test_text_operators import DOCS, EDGE, edge  # noqa: F401

from wherry.llm import quality_classifier as qc

SLOTS = 1 << 18


def slot(kind, name):
    return 1 + xxhash.xxh64_intdigest(f"{kind}:{name}".encode(), 2) % (SLOTS - 1)


def shape_by_hand(word):
    marks = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", marks, flags=re.S)


def features_by_hand(text):
    words = (text or "").split()
    found = Counter()
    for w in words:
        found[slot("shape", shape_by_hand(w))] += 10 / len(words)
    for a, b in zip(words, words[1:]):
        found[0] += 10 * (a == b) / len(words)
    for k in {slot("word", re.sub(r"^\W+|\W+$", "", w).lower()) for w in words}:
        found.setdefault(k, 1.0)
    return found


def test_scores_equal_the_definition(spark, edge):  # noqa: F811
    rng = np.random.default_rng(4)
    model = qc.OrdinalModel(rng.normal(size=SLOTS).astype(np.float32), np.array([-0.5, 0.75]))
    got = {(r["doc_id"], r["expected_grade"], r["top_probability"], r["kept"]) for r in qc.score(edge, model).collect()}
    want = set()
    for doc_id, text, *_ in EDGE:
        eta = sum(float(model.weights[k]) * v for k, v in features_by_hand(text).items())
        above = [1 / (1 + math.exp(min(700.0, t - eta))) for t in (-0.5, 0.75)]
        want.add((doc_id, sum(above), above[1], round(above[1], 6) >= 0.5))
    key = lambda r: (str(r[0]), r[1])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 2e-5 and abs(a[2] - b[2]) < 2e-5 and a[3] == b[3]


def loss(weights, thresholds, rows, grades, penalty):
    total = 0.0
    for (index, value), g in zip(rows, grades):
        eta = float(np.dot(weights[index], value))
        below = [0.0, *(1 / (1 + math.exp(eta - t)) for t in thresholds), 1.0]
        total -= math.log(below[g + 1] - below[g])
    return total / len(rows) + penalty / 2 * float(np.dot(weights, weights))


def test_fit_is_the_likelihoods_minimum():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 240)
    rows = [(np.array([3 + g, 9 + rng.integers(3), 20]), np.array([1.0, 0.5, 1.0], np.float32)) for g in grades]
    flip = rng.random(240) < 0.2  # so that the grades are not separable
    rows = [(np.array([3 + rng.integers(3), *i[1:]]), v) if f else (i, v) for (i, v), f in zip(rows, flip)]
    model = qc.fit([i for i, _ in rows], [v for _, v in rows], grades, steps=3000, rate=0.02, penalty=1e-2)
    w, t = model.weights.astype(float), model.thresholds
    best = loss(w, t, rows, grades, 1e-2)
    for k in np.flatnonzero(w):
        for step in (-0.05, 0.05):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, t, rows, grades, 1e-2) > best - 1e-6
    for k in range(2):
        for step in (-0.05, 0.05):
            moved = t.copy()
            moved[k] += step
            assert loss(w, moved, rows, grades, 1e-2) > best - 1e-6


def fitted_with(monkeypatch, *args, **options):
    seen = {}
    monkeypatch.setattr(qc, "fit", lambda indices, values, grades, **more: seen.update(n=len(grades), longest=max(map(len, indices)), grades=sorted(grades)))
    qc.train(*args, **options)
    return seen


def test_repeated_ids_do_not_multiply_the_sample(spark, monkeypatch):
    rows = [(1, f"copy {k} of it", "en", "a", 0) for k in range(1000)] + [(2, "other text", "en", "a", 0), (3, "third", "en", "a", 0)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert fitted_with(monkeypatch, spark.createDataFrame(rows, DOCS), labels, sample=2)["grades"] == [1, 2]


def test_long_labelled_texts_are_fitted_whole(spark, monkeypatch):
    rows = [(1, " ".join(f"w{k}" for k in range(40_000)), "en", "a", 0), (2, "short", "en", "a", 0)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert fitted_with(monkeypatch, spark.createDataFrame(rows, DOCS), labels)["longest"] > 36_000
