"""Search by shard: the bounds must never cost a hit."""

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from plain import bm25, ranked
from pyspark.sql import functions as F
from test_sparse import QUESTIONS, SCHEMA, expected, index_of, zipf_corpus

from gleaner.operators import shards, sparse
from gleaner.operators.shards import Shard
from gleaner.operators.sparse import bm25_search, bm25_work


def random_shard(rng, n_words, n_chunks, density):
    held = rng.random((n_words, n_chunks)) < density * rng.random((n_words, 1)) ** 2
    word, chunk = np.nonzero(held)
    mix = rng.permutation(len(word))
    word, chunk = word[mix].astype(np.int32), chunk[mix].astype(np.int32)
    impact = rng.integers(1, 9, len(word)) / 4  # many ties
    full = np.zeros((n_words, n_chunks))
    full[word, chunk] = impact
    return Shard(word, chunk, impact, n_words, n_chunks), full


@pytest.mark.parametrize("seed", range(25))
def test_top_keeps_all_that_reach(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(shards, "BLOCK_CHUNKS", int(rng.integers(1, 40)))
    n_words, n_chunks = int(rng.integers(1, 30)), int(rng.integers(1, 400))
    shard, full = random_shard(rng, n_words, n_chunks, 0.6)
    for _ in range(20):
        word = rng.choice(n_words, int(rng.integers(1, n_words + 1)), replace=False)
        weight = rng.integers(0, 12, len(word)) / 2
        scores = (full[word] * weight[:, None]).sum(axis=0)
        matched = (full[word] > 0).any(axis=0)
        for k in (1, 3, 20):
            best = np.sort(scores[matched])[::-1]
            sample = shard.sample(word, weight, k)
            # The sample holds scores of chunks, so its k-th is no higher than the true one.
            assert len(sample) <= k and (np.sort(sample)[::-1] <= best[: len(sample)] + 1e-9).all()
            for reach in (-1.0, best[k - 1] if len(best) >= k and best[k - 1] > 0 else -1.0, float(rng.random() * 20) or -1.0):
                chunk, score = shard.top(word, weight, reach)
                want = np.flatnonzero(matched & (scores >= reach))
                order = np.argsort(chunk)
                assert chunk[order].tolist() == want.tolist()
                assert np.allclose(score[order], scores[want], atol=1e-9)


def test_bounds_save_reading():
    """One block holds all good chunks: the others are left alone."""
    n = 64 * shards.BLOCK_CHUNKS
    chunk = np.tile(np.arange(n, dtype=np.int32), 2)
    word = np.repeat(np.array([0, 1], np.int32), n)
    impact = np.where(chunk < shards.BLOCK_CHUNKS, 2.0, 0.1)
    shard = Shard(word, chunk, impact, 2, n)
    found, _ = shard.top(np.array([0, 1]), np.array([1.0, 1.0]), 3.0)
    assert len(found) == shards.BLOCK_CHUNKS and shard.read <= 2 * shards.BLOCK_CHUNKS
    shard.read = 0
    assert len(shard.top(np.array([0, 1]), np.array([1.0, 1.0]), 4.5)[0]) == 0 and shard.read == 0


@pytest.mark.parametrize("blocks", [1, 4])
def test_search_equals_brute_force(spark, monkeypatch, blocks):
    corpus = zipf_corpus(400)
    index = index_of(spark, corpus)
    if blocks > 1:
        monkeypatch.setattr(shards, "BROADCAST_ROWS", 4)
    monkeypatch.setattr(shards, "BLOCK_CHUNKS", 8)
    frame = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(QUESTIONS)], "query_id string, question string")
    for k in (1, 7, 20):
        got = {i: [] for i in range(len(QUESTIONS))}
        for r in bm25_search(frame, index, k, True, by_shard=True).orderBy("query_id", "rank").collect():
            got[int(r["query_id"][1:])].append((int(r["chunk_id"][1:]), round(r["score"], 9)))
        for i, question in enumerate(QUESTIONS):
            assert got[i] == expected(corpus, question, k), (k, question)


def test_both_ways_agree_without_padding(spark):
    corpus = zipf_corpus(300, seed=5)
    index = index_of(spark, corpus)
    frame = spark.createDataFrame(list(enumerate(QUESTIONS * 3)), "query_id long, question string")
    rows = lambda by_shard: sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["score"], 9)) for r in bm25_search(frame, index, 30, False, by_shard).collect())
    assert rows(True) == rows(False)


def test_many_pairs_choose_shards(spark, monkeypatch):
    index = index_of(spark, zipf_corpus(50))
    frame = spark.createDataFrame([(0, "w0 w1")], "query_id long, question string")
    assert "MapInPandas" not in plan_of(bm25_search(frame, index, 5, False))
    monkeypatch.setattr(sparse, "SHARD_PAIRS", 10)
    assert "MapInPandas" in plan_of(bm25_search(frame, index, 5, False))


def test_negative_weights_are_never_bounded(spark):
    """On such corpora every match counts, also those that lower a score."""
    index = index_of(spark, ["a b", "a b", "a c", "a b d", "b a"])
    assert index.average_idf < 0
    frame = spark.createDataFrame([(0, "a b c")], "query_id long, question string")
    got = [(r["chunk_id"], round(r["score"], 9)) for r in bm25_search(frame, index, 5, False, by_shard=True).orderBy("rank").collect()]
    want = bm25(["a b", "a b", "a c", "a b d", "b a"], "a b c")
    assert got == [(f"c{i}", round(want[i], 9)) for i in ranked(want, 5)]


def test_work_is_reported(spark):
    corpus = zipf_corpus(300)
    index = index_of(spark, corpus)
    frame = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id long, question string")
    work = {r["query_id"]: r for r in bm25_work(frame, index, 5).collect()}
    df = {r["term"]: r["df"] for r in index.terms.collect()}
    for i, question in enumerate(QUESTIONS):
        words = set(question.lower().replace(",", "").replace("!", "").split())
        want = sum(df.get(w, 0) for w in words)
        assert (work[i]["matched"] if i in work else 0) == want
        assert i not in work or 0 < work[i]["read"] <= 2 * want


def test_long_documents_are_cut(spark):
    rows = spark.createDataFrame([(f"c{i}", 7, i, "w x") for i in range(5_000)], SCHEMA)
    index = sparse.SparseIndex.build(rows)
    words = spark.createDataFrame([("w", 0)], "term string, word int")
    chunks = shards.by_chunk(index.postings, words, 8).select(F.spark_partition_id().alias("p"), "word").collect()
    sizes = pd.Series([r["p"] for r in chunks]).value_counts()
    assert sizes.sum() == 5_000 and len(sizes) >= 3 and sizes.max() < 5_000
