"""Many small files, and what an index writes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import dense
from gleaner.operators.chunk import chunk_documents
from gleaner.operators.sparse import posting_lists
from gleaner.plans.hybrid import HybridIndex
from gleaner.sources import store
from gleaner.sources.files import fewer_tasks, read_directory, read_files
from workload import queries


def test_each_file_is_parsed_once(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"f{i}.pdf").write_bytes(b"page %d" % i)
    calls = str(tmp_path / "calls")

    def pages(content):
        with open(calls, "ab") as file:
            file.write(b".")
        return [content.decode()]

    read = read_directory(spark, str(tmp_path), {".pdf": pages})
    assert len(read.documents.collect()) == 100
    assert os.path.getsize(calls) == 100


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    for i in range(1_500):
        (tmp_path / f"f{i}.txt").write_text(f"text {i}")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    assert files.rdd.getNumPartitions() > 4 * 8 >= fewer_tasks(files).rdd.getNumPartitions()
    read = read_files(spark, [f"{tmp_path}/f{i}.txt" for i in range(1_500)])
    assert [r["text"] for r in read.documents.orderBy("doc_ord").collect()] == [f"text {i}" for i in range(1_500)]
    assert read.documents.rdd.getNumPartitions() <= 4 * 8


def test_documents_become_one_plain_file_each(spark, tmp_path):
    rows = [(i, None if i == 3 else f"line\n\x85 é {i}" * i) for i in range(50)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    folder = queries._as_files(queries.Corpus(spark, str(tmp_path)))
    names = os.listdir(folder)
    assert len(names) == 50 and all(n.startswith("part-") and n.endswith(".txt") for n in names)
    texts = sorted(open(os.path.join(folder, n), encoding="utf-8", newline="").read() for n in names)
    assert texts == sorted(f"{i}\n{t}\n" if t is not None else f"{i}\n" for i, t in rows)


def test_hidden_names_are_found_on_disk(spark, tmp_path):
    for name in ("a.txt", "_b.txt", ".c.MD", "_d.xyz", "sub/_e.pdf", "sub/deep/.f.txt", "_sub/_g.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    (tmp_path / "_folder.txt").mkdir()
    hidden = lambda **more: {r["path"] for r in read_directory(spark, f"file://{tmp_path}", **more).rejects.collect()}
    assert hidden() == {f"file:{tmp_path}/{n}" for n in ("_b.txt", ".c.MD", "sub/_e.pdf", "sub/deep/.f.txt")}
    assert hidden(recursive=False) == {f"file:{tmp_path}/{n}" for n in ("_b.txt", ".c.MD")}


KIND = "doc_id string, text string, metadata map<string,string>, doc_ord bigint"


def _documents(spark, n):
    rows = [(f"d{i}", f"document {i} of the dark dark forest and its many old trees by the river", {}, i) for i in range(n)]
    return spark.createDataFrame(rows, KIND)


def test_lists_are_in_insertion_order_whatever_the_order_of_chunks(spark):
    chunks = chunk_documents(_documents(spark, 300)).coalesce(1).sortWithinPartitions(F.xxhash64("chunk_id"))
    for row in posting_lists(chunks).collect():
        places = list(zip(row["doc_ords"], row["chunk_indexes"], row["chunk_ids"]))
        assert places == sorted(places) and [p[2] for p in places] == [f"d{p[0]}_{p[1]}" for p in places]


def test_large_tasks_write_to_folders_without_a_shuffle(spark, monkeypatch):
    columns = ("chunk_id", "text", "doc_ord", "chunk_index")
    kind = type(spark.range(1))
    hints, hint = [], kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *by: hints.append(by) or hint(self, name, *by))
    indexes = []
    for least, shuffled in ((1 << 20, True), (1, False)):
        monkeypatch.setattr(store, "FILE_BYTES", least)
        hints.clear()
        indexes.append(HybridIndex.build(_documents(spark, 500).coalesce(2)))
        assert (("chunk_folder",) in hints) == shuffled and ("bucket",) in hints  # word counts are gathered in any case
        assert hints.count(("bucket",)) == 1 + shuffled
    one, other = (sorted(map(tuple, i.chunks.select(*columns).collect())) for i in indexes)
    assert one == other and len(one) == 500
    one, other = (sorted(map(tuple, i.sparse.postings.select("term", "chunk_id", "tf", "dl").collect())) for i in indexes)
    assert one == other
    folder = indexes[1].store.path.removeprefix("file:")
    assert all(name.endswith((".zstd.parquet", "_SUCCESS", ".crc")) for t in ("chunks", "posting_lists") for _, _, names in os.walk(f"{folder}/{t}") for name in names)


def test_queries_pass_through_the_driver_as_arrays(spark, monkeypatch):
    values = np.random.default_rng(5).normal(size=(300, 8)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(values)], "vec_id long, embedding array<float>, cell int").repartition(3)
    sent, scan = [], dense._scan_search
    monkeypatch.setattr(dense, "_scan_search", lambda names, vectors, probes, *more: sent.append((names, vectors, *probes.values())) or scan(names, vectors, probes, *more))
    monkeypatch.setattr(type(table), "toPandas", lambda self: pytest.fail("rows of Python objects"))
    queries = table.select(F.col("vec_id").alias("query_id"), "embedding")
    monkeypatch.setattr(dense, "BROADCAST_BYTES", 4_000)
    found = dense.exact_search(queries, table, 3, dim=8, id_col="vec_id", order=("vec_id",))
    scores = values.astype(float) @ values.T.astype(float)
    want = {(q, r + 1, int(i)) for q in range(300) for r, i in enumerate(np.lexsort((np.arange(300), -np.rint(scores[q] * 1e9)))[:3])}
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in found.collect()} == want
    assert len(sent) > 5 and all(v.dtype == np.float32 and sum(a.nbytes for a in (n, v, *p)) <= 2 * 4_000 for n, v, *p in sent)


def test_a_query_without_a_vector_is_an_error(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    queries = table.select(F.col("vec_id").alias("query_id"), "embedding")
    with pytest.raises(ValueError):
        dense.exact_search(queries, table.where("vec_id = 1"), 1, dim=2, id_col="vec_id", order=("vec_id",)).collect()
