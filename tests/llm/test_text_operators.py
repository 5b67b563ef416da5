"""The text operators against brute force, and their defined cases."""

import hashlib
import html as html_module
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from wherry.llm import common, fingerprint, html_extract, license_scan, lm_scoring, mixing, packing, quality_classifier, quality_rules, simhash, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: Null text, empty, blank, one word, repeated rows, a very long text, odd white space, special strings, null ids and sources.
EDGE = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", "en", "b", 4), (4, "word", "en", None, 4), (5, "one two three four", "en", "b", 18), (5, "one two three four", "en", "b", 18),
    (6, "the quick brown fox jumps over the lazy dog again " * 4000, "en", "a", 200_000), (7, "a b c▁d  e\r\nf\x1cg\u0085h", "fr", "b", 18), (8, "<|endoftext|> it's </s><unk> x\x00y <|startoftext|>", "de", "c", 40),
    (None, "no id here at all", "en", "c", 17), (9, "éa ́x \U0001f600\U0001f600 مرحبا 你好", None, "c", 20), (10, "line one of two\nline one of two\nline one of two\n\nother", "en", "a", 50),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(spark, edge):
    """Extra columns named as the operators name their own."""
    return edge.selectExpr("*", *[f"{k} as {name}" for k, name in enumerate(("n_words", "run", "chunk", "fp", "key", "kept", "size", "row", "sig", "sequence_id", "_doc", "_words", "_order"))])


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- 1: packing -----------------------------------------------------------------------------------------------------


def pieces_by_library(texts, capacity):
    found = Counter()
    for doc_id, text in texts:
        ids = _tokenizer().encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            found[doc_id, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return found


@cache
def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def check_packed(rows, texts, capacity):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces_by_library(texts, capacity)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_equals_library_and_is_tight(docs, edge):
    rows = packing.pack_documents(docs, VOCABULARY).collect()
    n = check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)
    assert n <= sum(r["length"] for r in rows) / 4096 * 1.03 + 2
    check_packed(packing.pack_documents(edge, VOCABULARY, capacity=16, max_open=2).collect(), [(r[0], r[1]) for r in EDGE], 16)


def test_packing_gives_ids_back(edge):
    rows = packing.pack_documents(edge.filter("doc_id = 10"), VOCABULARY, capacity=8, with_ids=True).collect()
    ids = [i for r in sorted(rows, key=lambda r: r["piece"]) for i in r["ids"]]
    assert ids == _tokenizer().encode(EDGE[-1][1], add_special_tokens=False).ids + [1]


def test_word_encoder_equals_library_on_random_texts():
    encoder, r = packing.WordEncoder(VOCABULARY), random.Random(4)
    assert encoder.merges is not None
    odd = [chr(c) for c in range(0x21, 0x250)] + ["\u0301", "İ", "ς", "Σ", "你", "\u00a0", "\u2028", "<|endoftext|>", "'s", "'LL"]
    texts = ["".join(r.choice(odd) if r.random() < 0.4 else r.choice("abcXYZéÉß .,!\n") for _ in range(r.randrange(14))) for _ in range(4000)]
    want = [[*e.ids, 1] for e in _tokenizer().encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time every part is known
        assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    assert [x.tolist() for k in range(0, 4000, 7) for x in encoder.encode(pa.array(texts)[k : k + 7])] == want
    assert encoder.encode(pa.array([], pa.string())) == [] and encoder.encode(pa.array([""]))[0].tolist() == [1]


def test_word_encoder_starts_its_cache_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    encoder, texts = packing.WordEncoder(VOCABULARY), ["one two three", "Four, five! six", "one seven. 8"]
    for _ in range(3):
        assert [x.tolist() for t in texts for x in encoder.encode(pa.array([t]))] == [[*_tokenizer().encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_slices_are_bounded_by_bytes_and_lose_no_row():
    texts = ["a" * n for n in (3, 9, 30, 0, 1, 5, 2)] + [None, "x"]
    batch = pa.RecordBatch.from_pydict({"n": list(range(9)), "text": texts})
    found = [x.column("n").to_pylist() for x in common.slices([batch, batch.slice(9)], "text", 10)]
    assert found == [[0], [1], [2], [3, 4, 5, 6, 7, 8]]


def test_open_bins_are_bounded_and_best_fit():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n)[0] for n in (6, 7, 8, 4, 3)] == [0, 1, 2, 0, 3]  # the fullest (1) closed for 2
    r = random.Random(3)
    bins, used = packing.OpenBins(100, 5), defaultdict(int)
    for _ in range(2000):
        n = r.randint(1, 100)
        at, offset = bins.place(n)
        assert used[at] == offset
        used[at] += n
        assert used[at] <= 100 and bins.count <= 5


def test_packing_empty_and_clashing(nothing, clashing, edge):
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0
    assert packing.pack_documents(clashing, VOCABULARY).count() == packing.pack_documents(edge, VOCABULARY).count()


# ---- 2: classifier --------------------------------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark, sf_dir):
    where = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2))
    model = quality_classifier.train(docs, labels.filter(half == 0))
    assert (np.diff(model.thresholds) > 0).all()
    held = quality_classifier.score(docs, model).join(labels.filter(half == 1), "doc_id").toPandas()
    clean = (held["quality"] == 1) & (held["toxic"] == 0)
    assert held[clean]["kept"].mean() > 0.98
    assert held[held["quality"] == 0]["kept"].mean() < 0.1
    assert held[(held["quality"] == 1) & (held["toxic"] == 1)]["kept"].mean() < 0.1


def test_fit_orders_thresholds_and_learns():
    r = np.random.default_rng(0)
    grades = r.integers(0, 3, 300)
    indices = [np.array([10 + g, 20 + r.integers(5)]) for g in grades]
    model = quality_classifier.fit(indices, [np.ones(2, np.float32)] * 300, grades)
    scores = np.array([model.weights[i].sum() for i in indices])
    expected = model.tails(scores).sum(axis=1)
    assert model.thresholds[0] < model.thresholds[1]
    assert expected[grades == 0].mean() < 0.5 < 1.5 < expected[grades == 2].mean()


def test_classifier_defined_cases(spark, edge, clashing, nothing):
    none = quality_classifier.train(edge, spark.createDataFrame([(1, 1, None), (77, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    assert none.thresholds is None
    assert quality_classifier.score(edge, none).filter("kept").count() == len(EDGE)
    assert quality_classifier.score(nothing, none).count() == 0
    assert quality_classifier.filter_documents(clashing, none).columns == clashing.columns


# ---- 3: token counts ------------------------------------------------------------------------------------------------


def test_token_counts_equal_library(docs, edge):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (docs, edge):
        want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in df.collect()), key=repr)
        got = token_counts.count_tokens(df, MODEL)
        assert plain(got.select("doc_id", "n_bytes", "n_tokens")) == want
        assert got.filter("over_limit <> (n_tokens > 4096)").count() == 0


def test_token_counts_on_random_texts():
    import sentencepiece

    library, count, r = sentencepiece.SentencePieceProcessor(model_file=MODEL), token_counts.counter(MODEL).count, random.Random(11)
    assert token_counts.counter(MODEL).separable
    for _ in range(3000):
        text = "".join(r.choice(["a", "the", " ", "  ", "\n", "\r", ";", "{", "▁", "é", "\t", "ing", "0", " ", "你", "</s>"]) for _ in range(r.randrange(12)))
        assert count(text) == len(library.encode(text)), repr(text)


def test_token_counts_empty_and_clashing(nothing, clashing):
    assert token_counts.count_tokens(nothing, MODEL).count() == 0
    assert token_counts.count_tokens(clashing, MODEL).count() == len(EDGE)


# ---- 4: licenses ----------------------------------------------------------------------------------------------------


def test_each_template_is_found_in_a_text_and_variants_too(spark):
    filler = "Some words stand here and there.\nMore of them follow in a line."
    rows = [(k, f"{filler}\n{text}\n{filler}") for k, (text, _) in enumerate(license_scan.TEMPLATES.values())]
    found = {r["doc_id"]: r for r in license_scan.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, name in enumerate(license_scan.TEMPLATES):
        assert found[k]["license"] == name
        assert (found[k]["line"], found[k]["missing"], found[k]["added"]) == (2, "", "")
    variants = {"Licensed under the GNU General Public License, version 3": "GPL-3.0", "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0", "RELEASED UNDER THE MIT LICENSE": "MIT", "We need a license to fish here in the morning before noon": None}
    got = {r["block_text"]: r["license"] for r in license_scan.scan_documents(spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string")).collect()}
    assert got == variants


def test_licenses_equal_a_plain_search(docs):
    phrases = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    want = {(r["doc_id"], n) for r in docs.collect() for n, p in phrases.items() if p in (r["text"] or "")}
    got = {(r["doc_id"], r["license"]) for r in license_scan.scan_documents(docs).collect() if r["license"] in phrases}
    assert got == want


def test_licenses_empty_and_clashing(nothing, clashing, edge):
    assert license_scan.scan_documents(nothing).count() == 0
    assert license_scan.scan_documents(clashing).count() == license_scan.scan_documents(edge).count() == 0


# ---- 5: fingerprints ------------------------------------------------------------------------------------------------


def shingles(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def check_fingerprints(rows, docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), simhash.signed(xxhash.xxh64_intdigest(d[1].encode(), 42))))
    follows = [(d, order[(k + 1) % len(order)]) for k, d in enumerate(order)]
    want, errors = Counter(), []
    by_id = defaultdict(list)
    for (doc_id, text), (_, other) in follows:
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
        by_id[doc_id].append((jaccard(shingles(text), shingles(edited)), jaccard(shingles(text), shingles(other))))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    for r in rows:
        if len(by_id[r["doc_id"]]) == 1:
            a, b = by_id[r["doc_id"]][0]
            errors += [abs(a - r["near_edited"]), abs(b - r["near_next"])]
    assert np.mean(errors) < 0.03 and max(errors) < 0.25


def test_fingerprints_estimate_likeness(docs):
    check_fingerprints(fingerprint.fingerprint_documents(docs).collect(), [(r["doc_id"], r["text"] or "") for r in docs.collect()])


def test_next_document_over_many_runs(docs, monkeypatch):
    monkeypatch.setattr(fingerprint, "RUN_ROWS", 7)
    check_fingerprints(fingerprint.fingerprint_documents(docs).collect(), [(r["doc_id"], r["text"] or "") for r in docs.collect()])


def test_next_document_of_equal_and_missing_ids(spark, docs, monkeypatch):
    """Ids that fill many runs are cut by the hash of the text; none goes to one task."""
    monkeypatch.setattr(fingerprint, "RUN_ROWS", 6)
    ids = F.when(F.col("doc_id") % 3 == 0, F.lit(-(1 << 63))).when(F.col("doc_id") % 3 == 1, F.lit(None)).when(F.col("doc_id") % 2 == 0, F.lit(50)).otherwise(F.col("doc_id"))
    rows = docs.dropDuplicates(["text"]).select(ids.cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    check_fingerprints(fingerprint.fingerprint_documents(rows).collect(), [(r["doc_id"], r["text"]) for r in rows.collect()])
    runs = fingerprint.Runs(rows)
    assert max(r["count"] for r in rows.groupBy(runs.place.alias("p")).count().collect()) <= 30


def test_fingerprint_defined_cases(spark, edge, nothing, clashing):
    rows = fingerprint.fingerprint_documents(edge).collect()
    assert len(rows) == len(EDGE)
    same = [r["fingerprint"] for r in rows if r["doc_id"] == 5]
    assert same[0] == same[1] != ""
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {""}
    assert fingerprint.fingerprint_documents(nothing).count() == 0
    assert fingerprint.fingerprint_documents(clashing).count() == len(EDGE)
    alone = fingerprint.fingerprint_documents(spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(("a b c d e f g"[:9] + "a b c d e f g"[:4]).encode()).hexdigest()


# ---- 6: quality rules -----------------------------------------------------------------------------------------------


def rules_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_equal_brute_force(docs, edge):
    for df in (docs, edge):
        want = []
        for r in df.collect():
            n, chars, symbols, dup, repeat = rules_by_hand(r["text"])
            want.append((r["doc_id"], n, chars, symbols, dup, repeat, n < 10 or 100 * repeat > 20 * n))
        got = quality_rules.quality_ledger(df)
        assert plain(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == sorted(want, key=repr)
        assert got.filter("base_failed and kept").count() == 0


def test_quality_rules_keep_clean_and_reject_junk(spark, sf_dir):
    where = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{where}/labels.parquet")
    found = quality_rules.quality_ledger(spark.read.parquet(f"{where}/documents.parquet")).join(labels, "doc_id")
    assert found.filter("quality = 1 and not base_failed and not kept").count() == 0
    assert found.filter("quality = 0 and kept").count() == 0


def test_policies_and_ablations(docs):
    ledger = quality_rules.ledger(docs.select("doc_id", "text")).cache()
    kept = quality_rules.apply_policy(ledger).filter("kept").count()
    rows = {r["rule"]: r for r in quality_rules.ablations(ledger).collect()}
    for rule, bit in quality_rules.BITS.items():
        r = rows[rule]
        assert r["n_failed"] == ledger.filter(f"failed_bits & {bit} <> 0").count()
        assert r["n_kept_without"] == ledger.filter(f"failed_bits & {sum(quality_rules.BITS.values()) & ~bit} = 0").count() == kept + r["n_failed_alone"]
    assert quality_rules.apply_policy(ledger, "base").filter("kept").count() >= quality_rules.apply_policy(ledger, "v1").filter("kept").count()
    ledger.unpersist()


def test_quality_rules_empty_and_clashing(nothing, clashing):
    assert quality_rules.quality_ledger(nothing).count() == 0
    assert quality_rules.filter_documents(clashing).columns == clashing.columns


def test_native_plans_have_no_python(docs):
    for df in (quality_rules.quality_ledger(docs), fingerprint.fingerprint_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ---- 7: LM scores ---------------------------------------------------------------------------------------------------


def scores_by_hand(texts, order):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [WORD.findall((t or "").translate(lower)) for t in texts]
    grams = lambda d: Counter(tuple(d[k : k + n]) for n in range(1, order + 1) for k in range(len(d) - n + 1))
    corpus, total, found = sum(map(grams, docs), Counter()), sum(map(len, docs)), []
    for d in docs:
        own = grams(d)
        count = lambda g: corpus[g] - own[g]

        def log_score(context, word):
            if not context:
                return math.log(max(count((word,)), 0.5)) - math.log(max(total - len(d), 1))
            if count((*context, word)) > 0:
                return math.log(count((*context, word))) - math.log(count(context))
            return math.log(0.4) + log_score(context[1:], word)

        found.append((len(d), sum(log_score(tuple(d[max(0, k - order + 1) : k]), w) for k, w in enumerate(d))))
    return found


def check_lm(df, order, **options):
    rows = df.collect()
    want = sorted((str(r["doc_id"]), n, s) for r, (n, s) in zip(rows, scores_by_hand([r["text"] for r in rows], order)))
    got = sorted((str(r["doc_id"]), r["n_words"], r["log_probability"]) for r in lm_scoring.score_documents(df, order, **options).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-3, rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_scores_equal_brute_force(docs, edge, order):
    check_lm(docs.limit(80), order, chunk_words=9000, part_words=5000)
    check_lm(edge, order, chunk_words=15_000, part_words=9_000)


def test_lm_scores_of_the_table_in_one_chunk_and_many(docs):
    check_lm(docs, 2)
    check_lm(docs, 2, chunk_words=20_000, part_words=9_000)


def test_lm_equal_rows_are_spread(spark, docs):
    same = docs.limit(1).crossJoin(spark.range(400)).drop("id").unionByName(docs.limit(20))
    check_lm(same, 2, chunk_words=10_000)
    chunk = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(8))
    assert same.select(chunk.alias("c")).distinct().count() == 8


def test_lm_other_rows_than_counted_are_an_error():
    made, other = lm_scoring.Chunk(["a b c d e f g"]), lm_scoring.Chunk(["a b x y z"])
    rows = pa.Table.from_batches(list(lm_scoring._sent(0, made, 5))).to_pandas()
    back = lm_scoring._joined(rows)
    assert [t.tolist() for t in lm_scoring._received(made, back, 5)] == [c.tolist() for c in made.counts]
    with pytest.raises(RuntimeError, match="same rows twice"):
        lm_scoring._received(other, back, 5)


def test_lm_scores_empty_and_clashing(nothing, clashing):
    assert lm_scoring.score_documents(nothing).count() == 0
    assert lm_scoring.score_documents(clashing).count() == len(EDGE)


# ---- 8: mixing ------------------------------------------------------------------------------------------------------


def test_mix_meets_targets(docs, edge):
    for df in (docs, edge):
        rows = mixing.mix_counts(df).collect()
        sizes = {i: Counter() for i in (0, 1)}
        names = {}
        for r in df.collect():
            names.setdefault(r["doc_id"], r["source"])
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"]
            sizes[0][names[r["doc_id"]]] += r["size"]
            sizes[1][names[r["doc_id"]]] += r["taken"]
        order = sorted(sizes[0], key=lambda s: (s is None, s or ""))
        want = dict(zip(order, mixing.targets([sizes[0][s] for s in order], [(3.0, 1.0, 2.0)[i % 3] for i in range(len(order))])))
        for r in rows:
            assert r["target"] == pytest.approx(want[names[r["doc_id"]]]) and r["source_size"] == sizes[0][names[r["doc_id"]]]
        for s in order:
            assert abs(sizes[1][s] - want[s]) <= 0.5  # to the word
        assert plain(mixing.mix_counts(df)) == sorted(map(tuple, rows), key=repr)


def test_mix_does_not_depend_on_the_layout(docs, edge):
    doubled = docs.unionByName(docs.limit(30)).unionByName(edge)
    for make in (mixing.mix_counts, mixing.mixed_documents):
        want = plain(make(doubled))
        assert plain(make(doubled.repartition(7))) == want
        assert plain(make(doubled.orderBy(F.rand(5)).coalesce(1))) == want


def test_small_sources_meet_their_targets_to_the_word(spark):
    rows = [(k, "w " * n, "en", f"s{k:02}", 0) for k, n in enumerate((20, 20, 20, 1, 3, 63, 64, 65, 100, 129))]
    found = mixing.mix_counts(spark.createDataFrame(rows, DOCS)).collect()
    assert len({round(r["target"] / r["size"], 3) for r in found}) > 2
    assert all(abs(r["taken"] - r["target"]) <= 0.5 for r in found)


@pytest.mark.parametrize("size", [1, 5, 63, 64, 65, 128, 1000])
def test_slots_take_the_target(size):
    n = -(-size // 64)
    for target in range(0, 2 * size + 1, max(1, size // 40)):
        slots, last = mixing.slots_for(target, size, 64, 8, 0)
        words = 0
        for j in range(slots):
            block = int(mixing.Permutation(n, 8, 0, j // n).at(np.array([j % n]))[0])
            whole = 64 if block < n - 1 else size - 64 * (n - 1)
            assert last < whole or j < slots - 1
            words += last if j == slots - 1 and last else whole
        assert words == target


def test_rows_with_nulls_in_other_places_stay_apart(spark):
    rows = [(1, None, "en", "c d", 0), (1, "c d", "en", None, 0), (None, "c d", "en", "x", 0), (None, "c d", "fr", "x", 0)]
    df = spark.createDataFrame(rows, DOCS)
    assert mixing.mix_counts(df).count() == 4
    assert all(r["taken"] <= 2 * r["size"] for r in mixing.mix_counts(df).collect())


def test_targets_share_the_excess():
    assert mixing.targets([10, 10, 10], [3, 1, 2]) == pytest.approx([20, 10 * 25 / 30, 10 * 50 / 30])
    assert mixing.targets([0, 0], [3, 1]) == [0, 0]
    assert mixing.targets([], []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    found = mixing.Permutation(n, 1, 2).at(np.arange(n))
    assert sorted(found.tolist()) == list(range(n))
    assert [mixing.Permutation(n, 1, 2).place_of(x) for x in found[:50]] == list(range(min(n, 50)))
    if n == 1000:
        assert found.tolist() != mixing.Permutation(n, 1, 3).at(np.arange(n)).tolist()


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_shards_tile_the_slots(shards):
    totals = np.array([1000, 0, 37, 5])
    next_ = np.zeros(4, dtype=np.int64)
    for s in range(shards):
        start, count = mixing.shard_counts(totals, shards, s)
        assert (start == next_).all() and (count >= 0).all()
        next_ = start + count
    assert (next_ == totals).all()


def test_shards_of_very_many_slots_are_drawn_alike():
    totals = np.array([6 * 10**12, 10**9, 3])
    counts = np.array([mixing.shard_counts(totals, 8, s)[1] for s in range(8)])
    assert (counts.sum(axis=0) == totals).all()
    spread = np.abs(counts[:, 0] - totals[0] / 8) / np.sqrt(totals[0] / 8)
    assert 0 < spread.max() < 6 and len(set(counts[:, 1])) == 8


def test_mixed_documents_hold_what_is_taken(docs, clashing):
    taken = sum(r["taken"] for r in mixing.mix_counts(docs).collect())
    mixed = mixing.mixed_documents(docs)
    rows = mixed.collect()
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r["text"])) for r in rows) == taken
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 2
    assert mixing.mixed_documents(clashing).columns == clashing.columns


def test_shard_contents_are_blocks(docs):
    rows = mixing.shard_contents(docs).collect()
    slots = Counter()
    for r in rows:
        slots[r["shard"], r["source_index"], r["slot"]] += r["words"]
    assert max(slots.values()) == mixing.BLOCK_WORDS
    assert sum(slots.values()) == sum(r["taken"] for r in mixing.mix_counts(docs).collect())
    assert mixing.mix_counts(docs.limit(0)).count() == 0


# ---- 9: near-duplicates ---------------------------------------------------------------------------------------------


def simhash_by_hand(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(values):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


def test_simhash_equals_brute_force(docs, edge):
    for df in (docs, edge.filter("doc_id is not null")):
        rows = sorted(df.collect(), key=lambda r: r["doc_id"])
        values = [simhash_by_hand(r["text"]) for r in rows]
        roots = components_by_hand(values)
        want = sorted((r["doc_id"], f"{v:016x}", rows[k]["doc_id"]) for r, v, k in zip(rows, values, roots))
        assert plain(simhash.near_duplicates(df)) == sorted(want, key=repr)


@pytest.mark.parametrize("radius, tables", [(0, 1), (1, 3), (3, 15), (5, 14), (7, 30), (11, 45)])
def test_masks_cover_every_pair_in_the_radius(radius, tables):
    masks = simhash.covering_masks(radius)
    assert len(masks) == tables and min(m.bit_count() for m in masks) >= 64 // (2 * -(-(radius + 1) // 4)) - 2
    r = random.Random(1)
    for _ in range(3000):
        bits = sum(1 << b for b in r.sample(range(64), r.randint(0, radius)))
        assert any(not m & bits for m in masks)
        m = next(m for m in masks if not m & bits)
        assert any(not c & bits and c & m == m for c in simhash.cuts(m, radius))


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_buckets_over_batches_link_like_brute_force(size):
    r = random.Random(size)
    values = sorted({sum({1 << r.randrange(12) for _ in range(4)}) for _ in range(400)})
    key = [v & 7 for v in values]
    order = sorted(range(len(values)), key=lambda k: key[k])
    whole = pa.RecordBatch.from_pydict({"kept": [7] * len(values), "key": [key[k] for k in order], "fp": [values[k] for k in order]})
    edges = [e for batch in simhash._bucket_edges(3)([whole[k : k + size] for k in range(0, len(values), size)]) for e in zip(*batch.to_pydict().values())]
    assert all(u & 7 == v & 7 for u, v in edges)
    parent = {v: v for v in values}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for u, v in edges:
        parent[max(find(u), find(v))] = min(find(u), find(v))
    for k in range(8):
        some = [v for v in values if v & 7 == k]
        assert [some.index(find(v)) for v in some] == components_by_hand(some)


@pytest.mark.parametrize("n", [2, 60, 1500, 3000])
def test_a_large_bucket_links_like_brute_force(n):
    r = random.Random(n)
    base = [r.getrandbits(64) for _ in range(max(1, n // 300))]
    values = sorted({r.choice(base) ^ sum({1 << r.randrange(40) for _ in range(r.randrange(7))}) for _ in range(n)})
    got = simhash.link_bucket(np.array(values, np.uint64))
    if n > 1500:  # the same by the direct way
        full, simhash.DIRECT = simhash.DIRECT, 10**6
        try:
            want = simhash.link_bucket(np.array(values, np.uint64)).tolist()
        finally:
            simhash.DIRECT = full
    else:
        want = components_by_hand(values)
    assert got.tolist() == want


def test_large_buckets_are_dealt_anew(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(3)]
    values = sorted({r.choice(base) ^ sum({1 << r.randrange(64) for _ in range(r.randrange(5))}) for _ in range(250)})
    rows = spark.createDataFrame([(k, simhash.signed(v)) for k, v in enumerate(values)], "doc_id long, fp long")
    found = {simhash.ALL & r["fp"]: r["component_id"] for r in simhash.fingerprint_components(rows).collect()}
    assert [found[v] for v in values] == components_by_hand(values)


def test_simhash_null_ids_empty_and_clashing(edge, clashing, nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE) and [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert plain(simhash.near_duplicates(clashing)) == plain(simhash.near_duplicates(edge))


def test_simhash_of_a_hot_fingerprint_and_of_none(docs, monkeypatch):
    want = plain(simhash.near_duplicates(docs))
    for share in (1, 10**9):
        monkeypatch.setattr(simhash, "HOT_SHARE", share)
        assert plain(simhash.near_duplicates(docs)) == want


# ---- 10: pages ------------------------------------------------------------------------------------------------------


def article_by_hand(page):
    if not page:
        return ""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", inside)
    return "\n".join(b for b in (" ".join(html_module.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts) if b)


def test_pages_equal_their_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = sorted(((r["page_id"], r["url"], article_by_hand(r["html"])) for r in pages.collect()), key=repr)
    got = html_extract.extract_pages(pages)
    assert plain(got.select("page_id", "url", "text")) == want
    assert got.filter("n_chars <> length(text)").count() == 0


def test_markup_cases():
    text = lambda page: html_extract.own_text(html_extract.page_lines(page), [])[0]
    assert text(None) == text("") == ""
    assert text("<article><h1>A &amp; B</h1><p>x\n  y<br>z<p>second<ul><li>i<li>j</ul></article><footer>f</footer>") == "A & B\nx y z\nsecond\ni\nj"
    assert text("<main><p>m</p><div class='cookie-notice'>c</div><section id=comments><p>r</p></section><form><p>f</p></form><aside>s</aside></main><p>out</p>") == "m"
    assert text("<div role=navigation>n</div><p>kept</p><script>var a='<p>no</p>'</script><div class=ad><p>ad</p></div><p>too &lt;b&gt;</p>") == "kept\ntoo <b>"
    assert text("<article><p>cut off in the <b>midd") == "cut off in the midd"
    assert text("<p>a <span style='display: none'>hidden</span>b</p><header>h</header><div class='adventure'>adventure</div>") == "a b\nadventure"


def test_differencing_deletes_what_pages_of_a_host_share(spark):
    page = lambda k: f"<p>Welcome to the site</p><p>Story {k} is told here.</p><p>All about cookies</p>"
    rows = [(k, f"http://h{k % 2}.org/a/{k:02d}", page(k)) for k in range(40)] + [(99, "http://alone.org/", page(99)), (100, None, None), (101, "http://h0.org/a/00", page(0))]
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert len(found) == 43
    assert all(found[k] == f"Story {k} is told here." for k in range(1, 40))
    assert found[99] == "Welcome to the site\nStory 99 is told here.\nAll about cookies" and found[100] == ""
    # of a page and its copy, the one with another neighbour is differenced with that, the other keeps its lines
    assert found[101] == "Story 0 is told here." and found[0] == page(0)[3:-4].replace("</p><p>", "\n")


@pytest.mark.parametrize("parts", [1, 7, 211])
def test_pages_are_complete_under_any_number_of_ranges(spark, sf_dir, parts, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").drop("n")
    monkeypatch.setattr(html_extract, "RANGE_ROWS", max(1, 50 // parts))
    got = html_extract.extract_pages(pages.repartition(parts))
    monkeypatch.setattr(html_extract, "RANGE_ROWS", 1000)
    assert plain(got) == plain(html_extract.extract_pages(pages))


def test_unmarked_pages_of_a_template(spark):
    """Realistic pages without an article element: the template goes, own lines and quoted prose stay."""
    quote = "It was said that " + " ".join(f"word{k}" for k in range(40)) + "."
    def page(k):
        body = f"<h1>Title {k}</h1><p>Body of page {k}, first part.<p>{quote if k % 2 else f'Another {k}.'}<p>Last words of {k}."
        return f"<html><body><div class=top><a>Home</a> <a>About us</a></div><ul><li>News<li>Sport</ul>{body}<p>Subscribe today<div id=footer>Imprint</div><p>All rights reserved {k // 50}</body></html>"

    rows = [(k, f"https://site.org/news/{k:03d}", page(k)) for k in range(60)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(60):
        middle = quote if k % 2 else f"Another {k}."
        want = f"Title {k}\nBody of page {k}, first part.\n{middle}\nLast words of {k}."
        assert found[k] in (want, f"{want}\nAll rights reserved {k // 50}"), k


def test_shared_lines_of_very_long_pages():
    import time

    began = time.process_time()
    assert len(html_extract.shared([7] * 50_000, [7] * 50_000)) == 50_000
    assert len(html_extract.shared([1] + [7] * 50_000 + [2], [3] + [7] * 50_000 + [4])) == 50_000
    assert time.process_time() - began < 60
    long_page = "<article>" + "<ul>" + "<li>same item</li>" * 20_000 + "</ul></article>"
    text, n = html_extract.own_text(html_extract.page_lines(long_page), [html_extract.line_hashes(html_extract.page_lines(long_page))])
    assert text.count("same item") == 20_000 and n == 0


def test_shared_is_a_longest_common_subsequence(monkeypatch):
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        return row[-1]

    r = random.Random(2)
    for k in range(600):
        monkeypatch.setattr(html_extract, "DIRECT_BITS", 20 if k % 2 else 1 << 24)
        a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
        at = sorted(html_extract.shared(a, b))
        rest = iter(b)
        assert len(at) == length(a, b) and all(any(a[i] == y for y in rest) for i in at)


def test_pages_empty_and_clashing(spark):
    schema = "page_id long, url string, html string, host string, path string, text string, task int"
    assert html_extract.extract_pages(spark.createDataFrame([], schema)).count() == 0
    assert html_extract.extract_pages(spark.createDataFrame([(1, "http://a/b", "<p>x</p>", "h", "p", "t", 3)] * 2, schema)).count() == 2
