"""The pipeline against its stages by brute force, and its last stage against what the stages kept."""

from collections import Counter

import test_text_operators as brute
from test_simhash_groups import kept_by_hand
from test_text_operators import VOCABULARY, WORD, check_packed, rules_by_hand

import corpus_pipeline
from wherry.llm import mixing, packing, quality_classifier, quality_rules


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps, at = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = at
        at = spark.createDataFrame(stage(spark, before, sf_dir).collect(), docs.schema)
        assert at.columns == docs.columns
        steps[name] = (before.collect(), at.collect())

    before, after = steps["quality_rules"]
    failed = quality_rules.quality_ledger(docs).filter("not kept").select("doc_id")
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {r[0] for r in failed.collect()}
    for r in after:
        n, _, _, _, repeat = rules_by_hand(r["text"])
        assert n >= 10 and 100 * repeat <= 20 * n

    before, after = steps["quality_classifier"]
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in quality_classifier.score(docs, model).filter("kept").collect()}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} & kept

    before, after = steps["near_dedup"]
    assert sorted(r["doc_id"] for r in after) == kept_by_hand(sorted((r["doc_id"], r["text"]) for r in before))

    before, after = steps["mixing"]
    taken = Counter()
    for r in after:
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    want = {r["doc_id"]: r["taken"] for r in mixing.mix_counts(spark.createDataFrame(before, docs.schema)).collect() if r["taken"]}
    assert sum(taken.values()) == sum(want.values())

    packed = packing.pack_documents(at, VOCABULARY).collect()
    check_packed(packed, [(r["doc_id"], r["text"]) for r in after], 4096)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.count() > 0 and set(whole.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_stages_take_empty_tables(spark, sf_dir):
    empty = spark.createDataFrame([], brute.DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_registered_queries_equal_sql(spark, duck, sf_dir):
    from compare import same

    from wherry.llm.queries import ORACLES, QUERIES

    assert sum(name.startswith("op") for name in QUERIES) == 10
    for name, sql in ORACLES.items():
        same(QUERIES[name](spark, sf_dir).toPandas(), duck.execute(sql).fetchdf())


NAMES = ("a", "b", "n", "s", "fp", "row", "size", "_doc", "doc", "_spans", "spans", "failed_bits", "kept", "other", "occurrence", "group", "block", "words", "n_words", "length", "piece", "text_hash", "grade", "_words")


def edge_documents(spark):
    letters = lambda x: "abcdefghijklmnop"[x & 15] + (letters(x >> 4) if x >> 4 else "")
    prose = lambda k, n: " ".join(f"{'the of and to in'.split()[j % 5]} {letters(j + 100_000 * (k + 1))}" for j in range(n)) + "."
    rows = [*brute.EDGE, *[(100 + k, prose(k, 60), "en", "abc"[k % 3], 0) for k in range(12)], (200, prose(99, 60_000), "en", "b", 0), (201, prose(99, 60_000) + " tail", "en", None, 0)]
    rows += [rows[-3], rows[-3], (300, prose(3, 60), None, "c", None), (None, prose(5, 90), "en", "a", 0), (None, prose(5, 90), "en", "a", 0)]
    return spark.createDataFrame(rows, brute.DOCS)


def test_stages_take_nulls_long_texts_repeated_rows_and_other_columns(spark, tmp_path):
    docs, sf_dir = edge_documents(spark), str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(100, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")  # one grade: all are kept
    clashing = docs.selectExpr("*", *[f"{k} as {name}" for k, name in enumerate(NAMES)], "map('k', doc_id) as m", "array(text) as texts")
    plain_at, at = docs, clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain_at, at = (spark.createDataFrame(stage(spark, x, sf_dir).collect(), x.schema) for x in (plain_at, at))
        assert at.columns == clashing.columns, name
        key = lambda df: Counter((r["doc_id"], r["source"]) for r in df.collect())
        assert key(at) == key(plain_at), name
        if name == "near_dedup":
            ids = Counter(r["doc_id"] for r in at.collect())
            assert max(ids.values()) == 1 and 200 in ids and 201 not in ids and 103 in ids and 300 not in ids and None in ids
    assert {200, 100} <= {r["doc_id"] for r in at.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, at, sf_dir).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in at.collect()], 4096)


def test_run_over_edge_tables(spark, tmp_path):
    edge_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(100, 1, 0), (101, 0, 0), (101, 1, 1), (None, 1, 0), (999, 1, 1), (102, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
