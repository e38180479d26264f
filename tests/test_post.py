import random

import pytest
from conftest import plan_of
from plain import alike
from pyspark.sql import functions as F

from gleaner.config import RetrievalConfig
from gleaner.operators.evaluate import evaluate, mean_metrics
from gleaner.operators.fuse import fused_top_k
from gleaner.operators.post import (
    NO_ANSWER,
    build_context,
    build_prompt,
    dedup_hits,
    extractive_answer,
    generated_answer,
    hydrate,
    package_results,
    report,
    source_rows,
)

HITS = "query_id long, rank int, chunk_id string, score double, doc_id string, text string"


def hits_of(spark, lists):
    rows = [
        (q, i + 1, f"c{i}", 1.0 / (i + 1), f"d{i}", text) for q, texts in lists.items() for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, HITS)


def asked(spark, n):
    return spark.createDataFrame([(q, f"why {q}? {{x}} %s") for q in range(n)], "query_id long, question string")


def ranks(spark, lists):
    rows = [(q, i + 1, c) for q, ids in lists.items() for i, c in enumerate(ids)]
    return spark.createDataFrame(rows, "query_id long, rank int, chunk_id string")


def test_fusion_equals_brute_force(spark):
    rng = random.Random(2)
    ids = [f"c{i}" for i in range(30)]
    dense = {q: rng.sample(ids, 20) for q in range(6)} | {7: ["a", "b"]}
    sparse = {q: rng.sample(ids, rng.randint(1, 20)) for q in range(6)} | {8: ["z"]}
    cfg = RetrievalConfig()
    got = {}
    for r in fused_top_k(ranks(spark, dense), ranks(spark, sparse), 25, cfg).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["chunk_id"], round(r["score"], 12)))
    for q in (*range(6), 7, 8):
        total = {}
        for weight, found in ((0.6, dense.get(q, [])), (0.4, sparse.get(q, []))):
            for i, c in enumerate(found, 1):
                total[c] = total.get(c, 0.0) + weight / (60 + i)
        best = sorted(total.items(), key=lambda x: -x[1])[:25]
        assert got[q] == [(c, round(s, 12)) for c, s in best]


def test_equal_scores_keep_dense_order_first(spark):
    cfg = RetrievalConfig(dense_weight=0.5, sparse_weight=0.5)
    got = fused_top_k(ranks(spark, {0: ["a", "b"]}), ranks(spark, {0: ["c", "d"]}), 4, cfg)
    assert [r["chunk_id"] for r in got.orderBy("rank").collect()] == ["a", "c", "b", "d"]


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.95, 1.0])
def test_dedup_equals_brute_force(spark, threshold):
    rng = random.Random(4)
    lists = {q: [" ".join(rng.choices("ABcdef", k=rng.randint(0, 5))) for _ in range(12)] for q in range(20)}
    hits = hits_of(spark, lists)
    got = {}
    for r in dedup_hits(hits, threshold).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["chunk_id"])
        assert r["rank"] == len(got[r["query_id"]])
    for q, texts in lists.items():
        kept = []
        for i, text in enumerate(texts):
            if not any(alike(text, texts[j], threshold) for j in kept):
                kept.append(i)
        assert got[q] == [f"c{i}" for i in kept]
    assert dedup_hits(hits).columns == hits.columns


def test_dedup_threshold_is_inclusive(spark):
    base = [f"w{i}" for i in range(20)]
    at = " ".join(base[:19])  # 19 of 20 words: exactly 0.95
    below = " ".join(base[:18])
    got = dedup_hits(hits_of(spark, {0: [" ".join(base), at], 1: [" ".join(base), below]}))
    assert {(r["query_id"], r["chunk_id"]) for r in got.collect()} == {(0, "c0"), (1, "c0"), (1, "c1")}


@pytest.mark.parametrize(
    "texts, parts",
    [
        (["a" * 50, "b" * 60], ["a" * 50]),  # 50 characters left are not enough for a cut
        (["a" * 49, "b" * 60], ["a" * 49, "b" * 51]),
        (["a" * 100, "b"], ["a" * 100]),
        ([" a ", "b"], ["a", "b"]),
        (["a" * 101], ["a" * 100]),
        (["a" * 60, "b" * 90, "c"], ["a" * 60]),
        ([], []),
    ],
)
def test_context_budget(spark, texts, parts):
    got = build_context(asked(spark, 1), hits_of(spark, {0: texts}), 100).first()["context"]
    assert got == "\n\n---\n\n".join(parts)


def test_prompt_and_answers(spark):
    queries, hits = asked(spark, 2), hits_of(spark, {0: ["first {text} 100%", "second"]})
    prompts = {r["query_id"]: r["prompt"] for r in build_prompt(queries, hits).collect()}
    head = (
        "Answer the following question based only on the provided context. "
        "If the context does not contain enough information, say 'I don't know'.\n\nContext:\n"
    )
    tail = "\n\nQuestion: why {}? {{x}} %s\n\nAnswer:"
    assert prompts[0] == head + "first {text} 100%\n\n---\n\nsecond" + tail.format(0)
    assert prompts[1] == head + tail.format(1)
    answers = {r["query_id"]: r["answer"] for r in extractive_answer(queries, hits).collect()}
    assert answers == {0: "first {text} 100%", 1: NO_ANSWER}
    packed = {r["query_id"]: r for r in package_results(queries, hits).collect()}
    assert packed[0]["answer"] == "first {text} 100%" and [h["rank"] for h in packed[0]["retrieved"]] == [1, 2]
    assert packed[1]["answer"] == NO_ANSWER and packed[1]["retrieved"] == []


def test_generated_answers(spark):
    def load():
        return lambda prompts: [f"{len(p)} chars" for p in prompts]

    queries, hits = asked(spark, 2), hits_of(spark, {0: ["text"]})
    prompts = {r["query_id"]: r["prompt"] for r in build_prompt(queries, hits).collect()}
    got = {r["query_id"]: r["answer"] for r in generated_answer(queries, hits, load).collect()}
    assert got == {q: f"{len(p)} chars" for q, p in prompts.items()}


def test_reports(spark):
    hits = hits_of(spark, {0: ["a\n" * 200]})
    row = report(hits).first()
    assert row["snippet"] == "a " * 60 and row["score"] == 1.0
    row = source_rows(hits).first()
    assert row["snippet"] == "a " * 150 + "…" and row["doc_id"] == "d0"


def test_hydrate_both_ways(spark):
    chunks = spark.createDataFrame([("c0", "d", "t0"), ("c1", "d", "t1")], "chunk_id string, doc_id string, text string")
    hits = ranks(spark, {0: ["c1"], 1: ["c1", "c0"]})
    small, large = hydrate(hits, chunks, True), hydrate(hits, chunks, False)
    assert "BroadcastHashJoin" in plan_of(small)
    assert sorted(small.collect()) == sorted(large.collect()) and small.count() == 3


def test_metrics(spark):
    queries = spark.createDataFrame([(i,) for i in range(5)], "query_id long")
    runs = ranks(spark, {0: ["a", "b", "c"], 1: ["x", "y", "z"], 2: ["a", "b", "c"], 3: ["b", "a"], 4: ["q"]})
    judged = [(0, "a"), (1, "a"), (2, "a"), (2, "c"), (3, "a"), (3, "a")]
    qrels = spark.createDataFrame(judged, "query_id long, chunk_id string")
    rows = evaluate(queries, runs, qrels, 2)
    got = {r["query_id"]: (r["reciprocal_rank"], r["recall"], r["precision"]) for r in rows.collect()}
    assert got == {0: (1.0, 1.0, 0.5), 1: (0.0, 0.0, 0.0), 2: (1.0, 0.5, 0.5), 3: (0.5, 1.0, 0.5), 4: (0.0, 0.0, 0.0)}
    assert mean_metrics(rows).first()["mrr"] == 0.5
    assert evaluate(queries, runs, qrels, 0).agg(F.sum("precision")).first()[0] == 0.0
    short = evaluate(queries, runs, qrels, 10).where("query_id = 3").first()
    assert short["precision"] == 0.1
