"""Cases that earlier versions dropped or got wrong."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner import IndexConfig, VectorIndexConfig
from gleaner.operators.dense import Cells
from gleaner.operators.sparse import SparseIndex, bm25_search
from gleaner.plans.hybrid import HybridIndex
from gleaner.sources.files import read_directory, read_file, read_files
from gleaner.sources.tables import from_table
from workload.queries import passage_judgements

CHUNK = "chunk_id string, doc_id string, chunk_index int, text string, doc_ord long"


def chunks_of(spark, texts):
    return spark.createDataFrame([(f"c{i}", f"c{i}", 0, t, i) for i, t in enumerate(texts)], CHUNK)


def test_word_in_exactly_half_of_the_chunks_weighs_nothing(spark):
    index = SparseIndex.build(chunks_of(spark, ["one two", "three four", "half five", "half six"]))
    asked = spark.createDataFrame([(1, "half"), (2, "half six")], "query_id long, question string")
    rows = bm25_search(asked, index, 2).orderBy("query_id", "rank").collect()
    assert [r["chunk_id"] for r in rows if r["query_id"] == 1] == ["c0", "c1"]
    assert [r["chunk_id"] for r in rows if r["query_id"] == 2] == ["c3", "c0"]


def test_judgements_of_short_questions(spark):
    texts = ["a quick fox jumps", "quickly", "the fox", "?! none"]
    chunks = chunks_of(spark, texts)
    questions = ["quick", "quick fox", "?!", "a quick fox", "absent words entirely here"]
    asked = spark.createDataFrame(list(enumerate(questions)), "query_id long, question string")
    found = {(r["query_id"], r["chunk_id"]) for r in passage_judgements(asked, chunks, SparseIndex.build(chunks)).collect()}
    assert found == {(q, f"c{i}") for q, w in enumerate(questions) for i, t in enumerate(texts) if w in t}


def vectors(spark, points):
    return spark.createDataFrame([(f"c{i}", [float(x) for x in p]) for i, p in enumerate(points)], "chunk_id string, embedding array<float>")


def test_cells_come_from_all_vectors(spark):
    """More than the former sample: the centres fit better than one centre, and no vector is left out of a cell."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1500, 3)) + np.repeat(np.eye(3) * 6, 500, axis=0)
    cells = Cells.train(vectors(spark, points), VectorIndexConfig(nlist=3))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    mean = unit.mean(axis=0) / np.linalg.norm(unit.mean(axis=0))
    assert (unit @ cells.centers.T).max(axis=1).mean() > (unit @ mean).mean()
    assert cells.assign(vectors(spark, points)).count() == 1500


def test_cells_grow_with_the_corpus(spark):
    cfg = IndexConfig(vectors=VectorIndexConfig(auto=True))
    index = HybridIndex.create(spark, config=cfg)
    rng = np.random.default_rng(2)
    total = 0
    for size in (36, 200):
        texts = [f"text number {total + i}" for i in range(size)]
        ready = spark.createDataFrame(
            [(f"c{total + i}", f"d{total + i}", 0, t, total + i) for i, t in enumerate(texts)], CHUNK
        )
        points = rng.normal(size=(size, 64))
        own = spark.createDataFrame(
            [(f"c{total + i}", [float(x) for x in p]) for i, p in enumerate(points)], "chunk_id string, embedding array<float>"
        )
        index.add_chunks(ready, own)
        total += size
    assert index.cells.nlist == 15 and index.vectors.count() == 236
    assert cfg.vectors.probes(15) == 1
    assert VectorIndexConfig(search="exact").wants_cells(10**9) is False
    assert VectorIndexConfig(search="cells").wants_cells(3) is True


def test_vectors_are_checked_before_they_are_stored(spark):
    chunks = chunks_of(spark, ["x y", "z"])
    index = HybridIndex.create(spark)
    unit = [1.0] + [0.0] * 63
    kind = "chunk_id string, embedding array<float>"
    with pytest.raises(ValueError, match="more than one vector"):
        index.add_chunks(chunks, spark.createDataFrame([("c0", unit), ("c1", unit), ("c1", unit)], kind))
    with pytest.raises(ValueError, match="length"):
        index.add_chunks(chunks, spark.createDataFrame([("c0", unit[:7]), ("c1", unit[:7])], kind))
    assert index.n_chunks == 0
    index.add_chunks(chunks, spark.createDataFrame([("c0", unit), ("c1", unit)], kind))
    docs = spark.createDataFrame([(9, "a longer text that certainly has more than fifty characters in it")], "doc_id long, text string")
    index.append(from_table(docs))
    assert {"metadata", "start_char", "end_char"} <= set(index.chunks.columns) and index.chunks.count() == 3


def test_hidden_files_are_named(spark, tmp_path):
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    for name in ("_a.txt", ".b.md", "sub/_c.txt", "sub/deep/_d.md", "sub/e.txt", "_x.bin"):
        (tmp_path / name).write_text("t")
    read = read_directory(spark, str(tmp_path))
    assert [r["doc_id"] for r in read.documents.collect()] == ["e"]
    assert {r["path"].rsplit("/", 1)[-1] for r in read.rejects.collect()} == {"_a.txt", ".b.md", "_c.txt", "_d.md"}
    flat = read_directory(spark, str(tmp_path), recursive=False)
    assert {r["path"].rsplit("/", 1)[-1] for r in flat.rejects.collect()} == {"_a.txt", ".b.md"}
    with pytest.raises(ValueError, match="hidden"):
        read_file(spark, str(tmp_path / "_a.txt"))


def test_one_name_in_two_folders(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "README.md").write_text(f"The text of folder {folder}, which is longer than fifty characters.")
    docs = read_directory(spark, str(tmp_path), ids="path").documents
    assert {r["doc_id"] for r in docs.collect()} == {"a/README.md", "b/README.md"}
    assert HybridIndex.build(docs).n_chunks == 2


def test_literal_paths_and_unreadable_files(spark, tmp_path):
    (tmp_path / "a[1].txt").write_text("brackets")
    (tmp_path / "a1.txt").write_text("other")
    (tmp_path / "p.pdf").write_bytes(b"x")
    assert read_file(spark, str(tmp_path / "a[1].txt")).first()["text"] == "brackets"
    assert read_files(spark, [str(tmp_path / "a[1].txt")]).documents.first()["text"] == "brackets"
    with pytest.raises(ValueError, match="no extractor"):
        read_file(spark, str(tmp_path / "p.pdf"))
    pages = read_file(spark, str(tmp_path / "p.pdf"), {".pdf": lambda b: ["one", " ", "", "two"]})
    assert pages.first()["text"] == "one\n\n \n\ntwo"


def test_ids_that_are_no_numbers(spark):
    table = spark.createDataFrame([("doc-b", "x"), ("doc-a", "y")], "doc_id string, text string")
    rows = {r["doc_id"]: r["doc_ord"] for r in from_table(table).collect()}
    assert rows == {"doc-a": 0, "doc-b": 1}
    assert from_table(table.withColumn("n", F.lit(4)), order="n").first()["doc_ord"] == 4


def test_texts_are_read_from_the_folders_of_the_hits(spark):
    docs = spark.createDataFrame(
        [(i, f"Text number {i} about topic{i} and others, with more than fifty characters.") for i in range(50)],
        "doc_id long, text string",
    )
    index = HybridIndex.build(from_table(docs))
    found = index.sparse_only(spark.createDataFrame([(1, "topic7")], "query_id long, question string"), 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "chunk_folder" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert found.first()["doc_id"] == "7"
    lookup = index.chunk("7_0")
    assert "chunk_folder" in lookup._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert lookup.count() == 1 and index.chunk("none").count() == 0
