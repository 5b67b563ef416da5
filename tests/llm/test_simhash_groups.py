"""Groups of near copies against all pairs by hand."""

import random
import re

import pytest
import xxhash
from test_text_operators import DOCS, WORD, edge, nothing  # noqa: F401

import corpus_pipeline
from wherry.llm import simhash, simhash_groups


def grams_by_hand(text):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def word_bits(text):
    words = {re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")}
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def kept_by_hand(rows):
    sets, bits, parent = [grams_by_hand(t) for _, t in rows], [word_bits(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and (bits[i] ^ bits[j]).bit_count() <= 7):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted({rows[root(i)][0] for i in range(len(rows))})


def varied(seed):
    """Texts of a few groups, with up to eight words of 200 changed."""
    r = random.Random(seed)
    bases = [[f"w{r.randrange(5000)}" for _ in range(200)] for _ in range(4)]
    out = []
    for k in range(160):
        words = list(r.choice(bases))
        for _ in range(r.randrange(9)):
            words[r.randrange(200)] = f"x{r.randrange(5000)}"
        out.append((k, " ".join(words)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], DOCS)


@pytest.mark.parametrize("most", [5_000, 30])
def test_groups_equal_all_pairs(spark, most, monkeypatch):
    """A component in one task, and the same in rounds."""
    monkeypatch.setattr(simhash_groups, "COMPONENT_SETS", most)
    rows = varied(1)
    got = simhash_groups.keep_one(frame(spark, rows))
    assert sorted(r["doc_id"] for r in got.collect()) == kept_by_hand(rows)


def test_documents_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sorted(r["doc_id"] for r in simhash_groups.keep_one(docs).collect()) == kept_by_hand(rows)


def test_the_pipeline_drops_copies_beyond_three_bits(spark, sf_dir):
    words = [f"v{k}" for k in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(f"x{k}" if k in (50, 90, 130, 170) else w for k, w in enumerate(words)))]
    assert (simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).bit_count() > 3
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert [r["doc_id"] for r in stage(spark, frame(spark, rows), sf_dir).collect()] == [1]


def test_rows_equal_but_for_other_columns(spark):
    """The same row stays however the table is laid out; of wholly equal rows one stays."""
    text = "one two three four five six seven"
    rows = [(1, text, lang, "a", k) for k, lang in enumerate(("en", "fr", "de", "fr"))] + [(1, text, "en", "a", 0)]
    found = {tuple(simhash_groups.keep_one(spark.createDataFrame(rows[k:] + rows[:k], DOCS).repartition(3)).collect()[0]) for k in range(4)}
    assert len(found) == 1


def test_near_copies_defined_cases(spark, edge, nothing):  # noqa: F811
    ids = [r["doc_id"] for r in simhash_groups.keep_one(edge).collect()]
    assert sorted(ids, key=repr) == sorted([1, 4, 5, 6, 7, 8, None, 9, 10], key=repr)
    assert simhash_groups.keep_one(nothing).count() == 0


def test_clashing_names_stay(spark, edge):  # noqa: F811
    names = ("a", "b", "other", "s", "n", "fp", "doc", "c", "m", "rep", "kept", "key", "large", "root", "grams")
    clashing = edge.selectExpr("*", *[f"{k} as {x}" for k, x in enumerate(names)])
    found = simhash_groups.keep_one(clashing)
    assert found.columns == clashing.columns and found.count() == simhash_groups.keep_one(edge).count()
