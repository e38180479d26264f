"""Postings kept as lists: the same rows, fewer of them moved and written."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.functions.text import tokenize, word_count
from gleaner.operators import sparse
from gleaner.operators.sparse import build_postings, posting_lists, term_bucket, unlisted
from gleaner.plans.hybrid import HybridIndex

KIND = "doc_id string, text string, metadata map<string,string>, doc_ord bigint"
COLUMNS = ["term", "chunk_id", "doc_ord", "chunk_index", "tf", "dl"]


def documents(spark, first, last):
    rows = [(f"d{i}", f"document {i} of the dark dark forest and its many old trees by the river", {}, i) for i in range(first, last)]
    return spark.createDataFrame(rows, KIND)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(COLUMNS).collect())


def test_lists_of_any_cut(monkeypatch):
    monkeypatch.setattr(sparse, "LIST_POSTINGS", 3)
    monkeypatch.setattr(sparse, "SENT_POSTINGS", 5)
    rng = np.random.default_rng(1)
    words = [None, [], ["a"], ["b", "a", "b"]] + [[f"w{x}" for x in rng.integers(0, 6, n)] for n in rng.integers(0, 9, 20)]
    ids = [None if i == 5 else f"c{i // 2}" for i in range(len(words))]  # repeated and null ids
    table = pa.table({"chunk_id": ids, "doc_ord": list(range(len(words))), "chunk_index": [0] * len(words), "tokens": pa.array(words, pa.list_(pa.string()))})
    batches = list(sparse._lists_of(table.combine_chunks()))
    got = []
    for batch in batches:
        sizes = [len(r["tfs"]) for r in batch.to_pylist()]
        assert 0 < min(sizes) and max(sizes) <= 3 and (sum(sizes) <= 5 or len(sizes) == 1)
        for r in batch.to_pylist():
            got += [(r["term"], *p) for p in zip(r["chunk_ids"], r["doc_ords"], r["chunk_indexes"], r["tfs"], r["dls"])]
    want = [(t, ids[i], i, 0, n, len(w)) for i, w in enumerate(words) if w for t, n in Counter(w).items()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert list(sparse._lists_of(table.slice(0, 2).combine_chunks())) == []


def test_an_append_writes_lists_and_not_a_row_per_posting(spark):
    index = HybridIndex.build(documents(spark, 0, 200).coalesce(1))
    lists = index.store.table("posting_lists", index.manifest)
    postings = rows_of(index.sparse.postings)
    assert postings == rows_of(build_postings(index.chunks)) and len(postings) == 200 * 13
    assert lists.count() * 5 < len(postings)
    assert lists.select("term").distinct().count() == len({p[0] for p in postings})


def test_postings_of_an_earlier_version_are_read_beside_lists(spark, tmp_path):
    index = HybridIndex.build(documents(spark, 0, 5), str(tmp_path / "index"))
    path = index.store.path
    flat = build_postings(index.chunks).select("*", term_bucket(index.config.term_buckets))
    flat = spark.createDataFrame(flat.collect(), flat.schema)
    # Batch 0 as it was written before; a failed attempt at batch 1 left rows behind.
    index.store.write(flat, "postings", 0, "bucket")
    index.store.write(flat, "postings", 1, "bucket")
    (tmp_path / "index" / "posting_lists").rename(tmp_path / "kept")
    assert rows_of(index.store.read("postings", index.manifest)) == rows_of(flat)
    index.append(documents(spark, 5, 9))
    whole = rows_of(build_postings(index.chunks))
    assert rows_of(index.sparse.postings) == whole and len(whole) == 9 * 13
    copy = index.save(str(tmp_path / "copy"))
    assert rows_of(copy.sparse.postings) == whole and copy.store.table("postings", copy.manifest) is None
    assert path == index.store.path


def test_a_copy_holds_no_postings_of_replaced_chunks(spark, tmp_path):
    index = HybridIndex.build(documents(spark, 0, 6))
    index.append(documents(spark, 2, 4).withColumn("text", F.lit("an entirely other text on high mountains and the snow on top of them")), on_conflict="replace")
    want = rows_of(build_postings(index.chunks))
    assert rows_of(index.sparse.postings) == want
    copy = index.save(str(tmp_path / "copy"))
    assert rows_of(copy.sparse.postings) == want == rows_of(unlisted(copy.store.table("posting_lists", copy.manifest)))


def test_words_are_counted_as_they_are_found(spark):
    points = [p for p in range(1, 0x30000) if not 0xD800 <= p < 0xE000]
    texts = [(f"a{chr(p)}b {chr(p)} É{chr(p)}",) for p in points] + [("İstanbul IİI",), ("",), (None,)]
    counts = spark.createDataFrame(texts, "t string").select("t", word_count(F.col("t")).alias("n"), F.size(tokenize(F.col("t"))).alias("m"))
    assert counts.where("not n <=> m").collect() == []
    old = F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    assert counts.where(~old.eqNullSafe(tokenize(F.col("t")))).isEmpty()
    assert counts.where("t like 'İstanbul%'").first()["n"] == 4


@pytest.mark.parametrize("kind", ["bigint", "int"])
def test_lists_keep_the_types_of_the_order(spark, kind):
    chunks = spark.createDataFrame([("c0", 0, 0, "b a b"), ("c1", None, 1, "a"), ("c2", 2, 0, None)], f"chunk_id string, doc_ord {kind}, chunk_index int, text string")
    found = unlisted(posting_lists(chunks))
    assert found.schema["doc_ord"].dataType.simpleString() == kind
    assert {tuple(r) for r in found.collect()} == {("a", "c0", 0, 0, 1, 3), ("b", "c0", 0, 0, 2, 3), ("a", "c1", None, 1, 1, 1)}
