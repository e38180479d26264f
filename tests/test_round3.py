"""Faults found in the third review."""

import hashlib
import os
import re
import subprocess
import sys

import numpy as np
import pytest
from conftest import plan_of
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleaner.functions.hashing import hashed_vector
from gleaner.operators import dense
from gleaner.operators.shards import Shard
from gleaner.operators.sparse import SparseIndex
from gleaner.plans.hybrid import HybridIndex
from gleaner.sources import files
from workload import queries
from workload.queries import corpus, passage_judgements, q_stream_ingest


@pytest.mark.parametrize("files", [1, 3])
def test_stream_of_a_table_of_many_files(spark, tmp_path, files):
    words = "the quick brown fox jumps over the lazy dog and runs far away into the dark forest"
    rows = spark.createDataFrame([(i, f"document {i}: {words}") for i in range(7)], "doc_id bigint, text string")
    rows.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["chunk_id"] for r in q_stream_ingest(corpus(spark, str(tmp_path))).collect()}
    assert found == {f"{i}_0" for i in range(7)}


def test_hashed_vectors_are_summed_by_batch_not_by_expressions(spark):
    texts = [None, "", " .. ", "a a b", "ß É 北京 x_1", "one two three " * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for dim, normalize in ((64, True), (7, False)):
        made = frame.select("i", hashed_vector(F.col("text"), dim, normalize).alias("v"))
        assert "ArrowEvalPython" in plan_of(made)
        found = {r["i"]: r["v"] for r in made.collect()}
        assert found[0] == [None] * dim
        for i, text in list(enumerate(texts))[1:]:
            sums = np.zeros(dim)
            for word in re.findall(r"\w+", text.lower()):
                h = hashlib.md5(word.encode()).hexdigest()
                sums[int(h[:7], 16) % dim] += 1.0 if h[7] < "8" else -1.0
            n = np.sqrt((sums * sums).sum())
            wanted = sums / n if normalize and n > 0 else sums
            assert np.array_equal(np.array(found[i], np.float32), wanted.astype(np.float32))


def test_judgements_leave_postings_and_texts_where_they_are(spark):
    texts = ["a quick fox jumps", "quickly", "the fox", "a quick fox sleeps"]
    rows = [(f"c{i}", f"c{i}", 0, t, i) for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(rows, "chunk_id string, doc_id string, chunk_index int, text string, doc_ord long")
    asked = spark.createDataFrame([(1, "a quick fox"), (2, "the fox"), (3, "a missing fox")], "query_id long, question string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables beyond it
    try:
        found = passage_judgements(asked, chunks, SparseIndex.build(chunks))
        assert {tuple(r) for r in found.collect()} == {(1, "c0"), (1, "c3"), (2, "c2")}
        plan = plan_of(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_many_files_of_a_folder_are_no_list_of_names(spark, tmp_path, monkeypatch):
    """Other files, folders and patterns in names stay out; hidden files are found without asking every file."""
    monkeypatch.setattr(files, "PATTERN_NAMES", 3)
    for i in range(8):
        (tmp_path / f"part-{i}[x].txt").write_text(f"text {i}")
    (tmp_path / "part-a=1").mkdir()
    (tmp_path / "part-a=1" / "part-0[x].txt").write_text("below")
    (tmp_path / "part-a=1" / "_deep.txt").write_text("hidden")
    asked = [str(tmp_path / f"part-{i}[x].txt") for i in (5, 1, 6, 2, 99)]
    patterns = []
    escape = files.escaped
    monkeypatch.setattr(files, "escaped", lambda p: patterns.append(p) or escape(p))
    read = files.read_files(spark, asked)
    assert sorted(patterns) == sorted([f"file:{tmp_path}", "part-"])  # the folder and what the names have in common
    assert [r["text"] for r in read.documents.orderBy("doc_ord").collect()] == ["text 5", "text 1", "text 6", "text 2"]
    assert [r["path"] for r in read.rejects.collect()] == asked[-1:]
    both = files.read_files(spark, [*asked, str(tmp_path / "part-a=1" / "part-0[x].txt"), str(tmp_path / "none" / "x.txt")])
    assert [r["text"] for r in both.documents.orderBy("doc_ord").collect()][-1] == "below"
    assert both.documents.count() == 5 and both.rejects.count() == 2
    absent = files.read_files(spark, [str(tmp_path / "none" / f"{i}.txt") for i in range(5)])
    assert absent.documents.count() == 0 and absent.rejects.count() == 5
    whole = files.read_directory(spark, str(tmp_path))
    assert whole.documents.count() == 9 and whole.rejects.first()["path"].endswith("part-a=1/_deep.txt")


def test_a_saved_index_of_one_batch_is_not_gathered_again(spark, tmp_path, monkeypatch):
    rows = [(f"d{i}", f"document {i} of the dark forest and its many old trees by the river", {}, i) for i in range(20)]
    documents = spark.createDataFrame(rows, "doc_id string, text string, metadata map<string,string>, doc_ord bigint")
    hints = []
    hint = type(documents).hint
    once = HybridIndex.build(documents)
    twice = HybridIndex.build(documents.where("doc_ord < 10"))
    twice.append(documents.where("doc_ord >= 10"))
    monkeypatch.setattr(type(documents), "hint", lambda self, name, *a: hints.append(a) or hint(self, name, *a))
    for index, gathered in ((once, False), (twice, True)):
        hints.clear()
        copy = index.save(str(tmp_path / str(gathered)))
        assert (("chunk_folder",) in hints) == gathered
        for table in ("chunks", "postings"):
            read = [i.store.read(table, i.manifest) for i in (index, copy)]
            a, b = (r.select(*sorted(set(r.columns) - {"batch", "metadata"})) for r in read)
            assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_a_question_does_not_pass_over_all_chunks_of_a_shard(monkeypatch):
    """The first round picks among the chunks that hold its rarest words; the second looks up many words at once."""
    n, sizes = 20_000, [60] + [300] * 39 + [20_000]
    rng = np.random.default_rng(1)
    chunk = np.concatenate([np.sort(rng.choice(n, s, replace=False)) for s in sizes]).astype(np.int32)
    word = np.repeat(np.arange(41, dtype=np.int32), sizes)
    shard = Shard(word, chunk, np.where(word == 0, 9.0, 0.01), 41, n)
    picked, searched = [], []
    partition, search = np.argpartition, np.searchsorted
    monkeypatch.setattr(np, "argpartition", lambda a, *more, **kw: picked.append(len(a)) or partition(a, *more, **kw))
    monkeypatch.setattr(np, "searchsorted", lambda a, *more, **kw: searched.append(len(a)) or search(a, *more, **kw))
    asked = np.arange(41), np.ones(41)
    assert len(shard.sample(*asked, 5)) == 5 and max(picked) <= 41 * 300
    searched.clear()
    found, _ = shard.top(*asked, 9.0)
    assert sorted(found.tolist()) == sorted(chunk[:60].tolist()) and len(searched) <= 5


@pytest.mark.parametrize("block", [7, 1_000])
def test_rounds_of_queries_do_not_grow_with_the_cells_they_look_into(spark, monkeypatch, block):
    rng = np.random.default_rng(3)
    values = rng.integers(-3, 4, (120, 4)).astype(float)  # many ties
    cell = rng.integers(0, 10, 120)
    stored = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(values, cell))], "vec_id long, embedding array<float>, cell int")
    queries = stored.where("vec_id < 40").select(F.col("vec_id").alias("query_id"), "embedding")
    cells = dense.Cells(rng.normal(size=(10, 4)))
    rounds, scan = [], dense._scan_search
    monkeypatch.setattr(dense, "_scan_search", lambda *a: rounds.append(1) or scan(*a))
    monkeypatch.setattr(dense, "BROADCAST_BYTES", 3_300)  # 40 vectors and 400 numbers of cells are 6,400 bytes
    monkeypatch.setattr(dense, "BLOCK_VECTORS", block)
    monkeypatch.setattr(dense, "_PRODUCT_CELLS", 5 * block)
    monkeypatch.setattr(dense, "_WAITING_HITS", 50, raising=False)
    found = dense.ivf_search(queries, stored, cells, 5, 10, dim=4, id_col="vec_id", order=("vec_id",))
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    scores = values[:40] @ values.T
    for q in range(40):
        want = np.lexsort((np.arange(120), -scores[q]))[:5]
        assert got[q] == [(int(i), scores[q, i]) for i in want]
    assert len(rounds) == 2


def test_models_of_the_queries_need_no_module_on_executors(tmp_path):
    for load in (queries._echo, queries._letter_counter):
        (tmp_path / "load.pickle").write_bytes(cloudpickle.dumps(load))
        code = "import pickle; print(len(pickle.load(open('load.pickle', 'rb'))()(['a prompt'])))"
        environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        made = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True)
        assert made.stdout.strip() == "1", made.stderr


def test_a_word_listed_twice_for_a_chunk_counts_once():
    word, chunk = np.repeat([0, 1], 40).astype(np.int32), np.tile(np.repeat(np.arange(20), 2), 2).astype(np.int32)
    shard = Shard(word, chunk, np.full(80, 1.5), 2, 20)
    for reach in (-1.0, 2.0):
        found, score = shard.top(np.array([0, 1]), np.ones(2), reach)
        assert found.tolist() == list(range(20)) and np.allclose(score, 3.0)
    assert np.allclose(shard.sample(np.array([0, 1]), np.ones(2), 3), 3.0)
    assert np.allclose(shard._looked_up(np.array([1]), np.ones(1), np.array([40]), np.arange(20)), 1.5)
    shard.row[:] = -1  # looked up by search
    assert np.allclose(shard._looked_up(np.array([1]), np.ones(1), np.array([40]), np.arange(20)), 1.5)
