import random

import pytest
from conftest import plan_of
from plain import bm25, ranked
from pyspark.sql import functions as F

from gleaner.operators import sparse
from gleaner.operators.sparse import SparseIndex, bm25_scores, bm25_search, build_postings

SCHEMA = "chunk_id string, doc_ord long, chunk_index int, text string"


def index_of(spark, corpus):
    rows = [(f"c{i}", i // 3, i % 3, t) for i, t in enumerate(corpus)]
    return SparseIndex.build(spark.createDataFrame(rows, SCHEMA))


def ask(spark, index, questions, k, pad=True):
    frame = spark.createDataFrame(list(enumerate(questions)), "query_id long, question string")
    got = {i: [] for i in range(len(questions))}
    for r in bm25_search(frame, index, k, pad).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((int(r["chunk_id"][1:]), round(r["score"], 9)))
    return got


def expected(corpus, question, k):
    scores = bm25(corpus, question)
    return [(i, round(scores[i], 9) + 0.0) for i in ranked(scores, k)]


def zipf_corpus(n=300, seed=1):
    """The first word is in more than a third of all texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(3, 25))) for _ in range(n)]


QUESTIONS = ["w0 w0 w5", "w150", "w1 w2 w3 w4", "nothing here", "", "w199 w0 unknown", "W7, w7!"]


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, monkeypatch, small):
    corpus = zipf_corpus()
    index = index_of(spark, corpus)
    assert index.average_idf > 0
    if not small:
        monkeypatch.setattr(sparse, "fits_broadcast", lambda *a, **k: False)
        # Many slices, so frequent words really are cut.
        monkeypatch.setattr(sparse, "slice_rows", lambda total, slices=512: 10)
    for k in (1, 7, 20):
        got = ask(spark, index, QUESTIONS, k)
        for i, question in enumerate(QUESTIONS):
            assert got[i] == expected(corpus, question, k), (k, question)


def test_without_padding_only_matches(spark):
    corpus = zipf_corpus(60)
    got = ask(spark, index_of(spark, corpus), QUESTIONS, 50, pad=False)
    for i, question in enumerate(QUESTIONS):
        full = [e for e in expected(corpus, question, 60) if e[1] > 0][:50]
        assert got[i] == full


@pytest.mark.parametrize(
    "corpus",
    [
        ["a b", "a b", "a c", "a b d", "b a"],
        ["x"] * 7,
        ["a b", "c d"],
        ["a b c", "a b", "a", "b c a", "zz a b", "a b"],
    ],
)
def test_tiny_corpora_with_zero_or_negative_weights(spark, corpus):
    index = index_of(spark, corpus)
    assert index.average_idf <= 0
    questions = ["a", "a b", "zz", "none", "x"]
    for k in (1, 3, 10):
        got = ask(spark, index, questions, k)
        for i, question in enumerate(questions):
            assert got[i] == expected(corpus, question, k), (k, question)


def test_texts_without_words(spark):
    index = index_of(spark, ["...", "!!", "--"])
    assert index.terms.count() == 0
    assert [c for c, _ in ask(spark, index, ["a"], 2)[0]] == [0, 1]


def test_empty_corpus(spark):
    index = index_of(spark, [])
    assert ask(spark, index, ["a"], 5) == {0: []}


def test_k_zero(spark):
    assert ask(spark, index_of(spark, zipf_corpus(20)), ["w1"], 0) == {0: []}


def test_plans(spark):
    corpus = zipf_corpus(50)
    index = index_of(spark, corpus)
    rows = spark.createDataFrame([(f"c{i}", i, 0, t) for i, t in enumerate(corpus)], SCHEMA)
    assert "Exchange" not in plan_of(build_postings(rows))
    queries = spark.createDataFrame([(0, "w0 w1")], "query_id long, question string")
    plan = plan_of(bm25_search(queries, index, 5, False))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert plan.count("WindowGroupLimit") == 2
    # Pairs are summed where their chunk's postings are: one shuffle of postings, none of sums.
    assert plan_of(bm25_scores(queries, index)).count("Exchange hashpartitioning") == 1


def test_postings_hold_the_lengths(spark):
    rows = spark.createDataFrame([("c0", 0, 0, "b a b"), ("c1", 1, 0, "")], SCHEMA)
    got = {(r["term"], r["chunk_id"], r["tf"], r["dl"]) for r in build_postings(rows).collect()}
    assert got == {("a", "c0", 1, 3), ("b", "c0", 2, 3)}
    assert sparse.chunk_lengths(rows).agg(F.sum("dl"), F.count("*")).first()[:] == (3, 2)
