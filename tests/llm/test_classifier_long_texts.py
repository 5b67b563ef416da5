"""The fit on labelled texts that together are larger than what the driver takes at once."""

import os
import subprocess
import sys
import tracemalloc

import numpy as np

from wherry.llm import quality_classifier as qc

SCRIPT = """
from wherry.llm import quality_classifier as qc
from wherry.session import build_session

spark = build_session("long", "local[2]", spark__driver__maxResultSize="2m", spark__sql__shuffle__partitions="48", spark__sql__adaptive__coalescePartitions__enabled="false")
rows = spark.range(60).selectExpr("id as doc_id", "concat(if(id % 2 = 0, 'good ', 'bad '), array_join(transform(sequence(1, 20000), x -> hex(xxhash64(x, id))), ' ')) as text")
model = qc.train(rows, spark.range(60).selectExpr("id as doc_id", "cast(1 - id % 2 as int) as quality", "0 as toxic"))
assert model.weights[qc._slot("word", "good")] > 0 > model.weights[qc._slot("word", "bad")]
spark.stop()
"""


def test_lists_larger_than_the_drivers_largest_result():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", SCRIPT], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]


def lists(n, each, seed):
    rng = np.random.default_rng(seed)
    grades = rng.integers(0, 3, n)
    indices = [np.concatenate([[g], 3 + rng.choice(qc.DIMENSIONS - 3, each - 1, replace=False)]).astype(np.int32) for g in grades]
    return indices, [np.ones(each, np.float32)] * n, grades


def test_the_fit_holds_a_chunk_at_a_time():
    args = lists(100, 100_000, 2)
    tracemalloc.start()
    model = qc.fit(*args, steps=2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert np.count_nonzero(model.weights) and peak < 130e6  # the lists have 1e7 features; rows, indices and values in one piece take 200 MB and more


def test_chunks_do_not_change_the_model(monkeypatch):
    args = lists(120, 30, 3)
    whole = qc.fit(*args)
    monkeypatch.setattr(qc, "CHUNK_FEATURES", 70)
    cut = qc.fit(*args)
    assert np.count_nonzero(whole.weights) and np.allclose(whole.weights, cut.weights, atol=1e-5) and np.allclose(whole.thresholds, cut.thresholds, atol=1e-5)
