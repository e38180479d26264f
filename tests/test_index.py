import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from gleaner.config import ChunkingConfig, IndexConfig, RetrievalConfig, VectorIndexConfig
from gleaner.operators.embed import EmbeddingCache, HashingEncoder, ModelEncoder, embed
from gleaner.plans.hybrid import HybridIndex
from gleaner.sources import registry
from gleaner.sources.store import grown
from gleaner.sources.tables import from_table, from_texts
from gleaner.streaming.ingest import ingest_stream

SENTENCES = [
    "Rivers carry fresh water from the mountains to the sea.",
    "A compass needle points towards the magnetic north pole.",
    "Bakers let the dough rest so that yeast can raise it.",
    "The library keeps maps, letters and very old newspapers.",
    "Solar panels turn sunlight into electric current.",
    "Bees visit flowers to collect nectar and pollen.",
    "Trains on this line leave the station every ten minutes.",
    "Iron rusts when water and oxygen reach its surface.",
]

CONFIG = IndexConfig(
    chunking=ChunkingConfig(200, 20, 10),
    retrieval=RetrievalConfig(top_k=3, dense_candidates=8, sparse_candidates=8),
    vectors=VectorIndexConfig(nlist=100),
    term_buckets=4,
)


def ids(frame):
    return sorted(r[0] for r in frame.select("chunk_id").collect())


def ask(spark, *questions):
    return spark.createDataFrame(list(enumerate(questions)), "query_id long, question string")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def documents(spark, rows=None):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    return from_table(table if rows is None else table.where(F.col("doc_id") < rows))


def test_questions_find_their_sentence(spark):
    index = HybridIndex.build(from_texts(spark, SENTENCES), config=CONFIG)
    assert index.n_chunks == 8 and index.chunks.count() == 8
    questions = ask(spark, "magnetic compass", "yeast and dough", "sunlight electric panels")
    for hits in (index.retrieve(questions), index.sparse_only(questions), index.dense_only(questions)):
        best = {r["query_id"]: r["text"] for r in hits.where("rank = 1").collect()}
        assert best == {0: SENTENCES[1], 1: SENTENCES[2], 2: SENTENCES[4]}
        assert hits.groupBy("query_id").count().where("count = 3").count() == 3
    rows = {r["query_id"]: r for r in index.answer(questions).collect()}
    assert rows[1]["answer"] == SENTENCES[2] and len(rows[1]["retrieved"]) == 3
    scores = [h["score"] for h in rows[1]["retrieved"]]
    assert scores == sorted(scores, reverse=True)
    assert index.retrieve(questions, 0).count() == 0 and index.retrieve(questions, 100).count() == 24
    with pytest.raises(ValueError):
        index.retrieve(questions, -1)
    assert "yeast" in index.prompts(questions).where("query_id = 1").first()["prompt"]
    model = lambda: lambda prompts: [p[:6] for p in prompts]
    assert {r["answer"] for r in index.answer(questions, model=model).collect()} == {"Answer"}
    assert index.chunk("text_2_0").first()["text"] == SENTENCES[2] and index.chunk("none").isEmpty()


def test_empty_index_still_answers(spark):
    index = HybridIndex.create(spark, config=CONFIG)
    assert index.append(from_texts(spark, ["short", ""])) == 0 and index.append(from_texts(spark, [])) == 0
    row = index.answer(ask(spark, "anything")).first()
    assert row["answer"] == "No relevant documents found." and row["retrieved"] == []
    assert index.retrieve(ask(spark, "anything")).count() == 0


def test_append_equals_one_build(spark):
    docs = documents(spark, 60)
    whole = HybridIndex.build(docs, config=CONFIG)
    grown = HybridIndex.create(spark, config=CONFIG)
    for low, high in ((0, 10), (10, 35), (35, 60)):
        grown.append(docs.where(f"doc_ord >= {low} and doc_ord < {high}"), label=f"part {low}")
    assert grown.append(docs.where("doc_ord < 10"), label="part 0") == 0  # a retried batch
    assert grown.n_chunks == whole.n_chunks and grown.manifest.total_length == whole.manifest.total_length
    assert same(grown.sparse.terms, whole.sparse.terms)
    assert round(grown.sparse.average_idf, 9) == round(whole.sparse.average_idf, 9)
    questions = ask(spark, "the tion and here", "der und", "zzz")
    rounded = ["query_id", "rank", "chunk_id", F.round("score", 9).alias("s")]
    assert same(grown.sparse_only(questions, 30).select(*rounded), whole.sparse_only(questions, 30).select(*rounded))
    # A compact copy holds the same, in one batch.
    copy = grown.save(f"{grown.store.path}-copy")
    again = HybridIndex.load(spark, copy.store.path)
    assert again.manifest.batches == 1 and again.config == CONFIG and again.n_chunks == grown.n_chunks
    assert same(again.sparse_only(questions, 30).select(*rounded), grown.sparse_only(questions, 30).select(*rounded))
    with pytest.raises(ValueError):
        grown.save(copy.store.path)


def test_repeated_documents(spark):
    index = HybridIndex.build(from_texts(spark, SENTENCES, [f"s{i}" for i in range(8)]), config=CONFIG)
    new = from_texts(spark, ["Rivers have been straightened for many centuries now."], ["s0"])
    with pytest.raises(ValueError):
        index.append(new)
    assert index.n_chunks == 8
    assert index.append(new, on_conflict="replace") == 1
    assert index.n_chunks == 8 and ids(index.chunks) == [f"s{i}_0" for i in range(8)]
    assert "straightened" in index.chunk("s0_0").first()["text"]
    fresh = HybridIndex.build(index.chunks.select("doc_id", "text", "metadata", "doc_ord"), config=CONFIG)
    assert same(index.sparse.terms, fresh.sparse.terms)
    assert index.manifest.total_length == fresh.manifest.total_length
    assert index.vectors.count() == 8 and index.sparse.postings.where("term = 'mountains'").isEmpty()
    twice = from_texts(spark, SENTENCES[:2], ["n", "n"])
    with pytest.raises(ValueError):
        index.append(twice)


def test_chunks_and_vectors_must_match(spark):
    index = HybridIndex.create(spark, config=CONFIG)
    source = HybridIndex.build(from_texts(spark, SENTENCES), config=CONFIG)
    chunks, vectors = source.chunks.drop("dl"), source.vectors
    with pytest.raises(ValueError):
        index.add_chunks(chunks, vectors.where("doc_ord > 0"))
    assert index.add_chunks(chunks, vectors) == 8
    assert index.add_chunks(chunks.limit(0), vectors.limit(0)) == 0
    question = ask(spark, "bees and flowers")
    assert same(index.retrieve(question), source.retrieve(question))


def test_flat_index_moves_to_cells_when_it_has_grown(spark):
    docs = documents(spark, 40)
    config = IndexConfig(vectors=VectorIndexConfig(nlist=20, nprobe=20))
    index = HybridIndex.create(spark, config=config)
    index.append(docs.where("doc_ord < 5"))
    assert index.n_chunks < 80 and index.cells is None
    index.append(docs.where("doc_ord >= 5 and doc_ord < 30"))
    assert index.n_chunks >= 80 and index.cells.nlist == 20
    index.append(docs.where("doc_ord >= 30"))
    assert index.vectors.count() == index.n_chunks and index.vectors.where("cell is null").isEmpty()
    flat = HybridIndex.build(docs, config=IndexConfig(vectors=VectorIndexConfig(nlist=10**6)))
    questions = ask(spark, "the tion and here", "der und")
    ranked = ("query_id", "rank", "chunk_id")
    assert same(index.dense_only(questions).select(*ranked), flat.dense_only(questions).select(*ranked))
    before = index.manifest.cells
    index.retrain()
    assert index.manifest.cells > before
    loaded = HybridIndex.load(spark, index.store.path)
    assert same(loaded.dense_only(questions).select(*ranked), flat.dense_only(questions).select(*ranked))
    copy = index.save(f"{index.store.path}-copy")
    assert same(copy.dense_only(questions).select(*ranked), flat.dense_only(questions).select(*ranked))


def test_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        HybridIndex.load(spark, str(tmp_path / "none"))
    path = str(tmp_path / "index")
    HybridIndex.build(from_texts(spark, SENTENCES), path, config=CONFIG)
    with pytest.raises(ValueError):
        HybridIndex.create(spark, path)
    assert HybridIndex.load(spark, path).n_chunks == 8


def test_a_failed_append_leaves_no_trace(spark, monkeypatch):
    index = HybridIndex.build(from_texts(spark, SENTENCES[:4]), config=CONFIG)
    more = from_texts(spark, SENTENCES[4:], ["m4", "m5", "m6", "m7"])
    with monkeypatch.context() as patch:
        patch.setattr(HybridIndex, "_write_vectors", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            index.append(more)
    again = HybridIndex.load(spark, index.store.path)
    assert again.n_chunks == again.chunks.count() == again.vectors.count() == 4
    assert again.append(more) == 4
    assert again.chunks.count() == again.vectors.count() == 8


def test_stream_equals_batch_and_may_be_replayed(spark, tmp_path):
    docs = documents(spark, 60)
    for part in range(3):
        docs.where(F.col("doc_ord") % 3 == part).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    stream = (
        spark.readStream.schema(docs.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .parquet(str(tmp_path / "in"))
    )
    index = HybridIndex.create(spark, config=CONFIG)
    for _ in range(2):  # the second run finds nothing new
        ingest_stream(stream, index, str(tmp_path / "checkpoint")).awaitTermination()
    loaded = HybridIndex.load(spark, index.store.path)
    assert loaded.manifest.batches == 3
    whole = HybridIndex.build(docs, config=CONFIG)
    assert ids(loaded.chunks) == ids(whole.chunks) and same(loaded.sparse.terms, whole.sparse.terms)


def counting_encoder(path):
    def load():
        import os
        import uuid

        import numpy as np

        def encode(texts):
            with open(os.path.join(path, uuid.uuid4().hex), "w") as log:
                log.writelines(t + "\n" for t in texts)
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return encode

    return ModelEncoder(load, dim=2)


def test_model_encodes_each_distinct_text_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    encoder = counting_encoder(str(log))
    texts = ["hot"] * 300 + [f"text {i}" for i in range(50)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    cache = EmbeddingCache(spark, str(tmp_path / "cache"))
    first = embed(frame, encoder, cache).collect()
    seen = [line for f in log.iterdir() for line in f.read_text().splitlines()]
    assert sorted(seen) == sorted(set(texts))
    assert len(first) == 350 and {r["id"] for r in first} == set(range(350))
    for r in first:
        norm = (len(r["text"]) ** 2 + 1) ** 0.5
        assert r["embedding"] == pytest.approx([len(r["text"]) / norm, 1 / norm], rel=1e-6)
    more = spark.createDataFrame([(0, "hot"), (1, "new")], "id long, text string")
    assert embed(more, encoder, cache).count() == 2
    seen = [line for f in log.iterdir() for line in f.read_text().splitlines()]
    assert sorted(seen) == sorted([*set(texts), "new"])
    assert len(embed(frame, encoder).collect()) == 350  # without a cache


def test_hashing_encoder(spark):
    frame = spark.createDataFrame([("b a b",), ("a B b",), ("",)], "text string")
    for dim in (1, 5, 64):
        rows = [r["embedding"] for r in embed(frame, HashingEncoder(dim)).collect()]
        assert rows[0] == rows[1] and all(len(r) == dim for r in rows) and set(rows[2]) == {0.0}
    assert sum(x * x for x in rows[0]) == pytest.approx(1.0)


def test_cache_reads_the_folders_it_needs(spark, tmp_path):
    cache = EmbeddingCache(spark, str(tmp_path / "cache"), folders=50)
    encoder, other = HashingEncoder(8), HashingEncoder(4)
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "id long, text string")
    want = {r["id"]: r["embedding"] for r in embed(frame, encoder).collect()}
    for part in (frame.where("id < 200"), frame.where("id >= 100")):
        got = {r["id"]: r["embedding"] for r in embed(part, encoder, cache).collect()}
        assert got == {i: want[i] for i in got} and len(got) == 200
    assert cache.read(encoder.name).count() == 300
    # Another encoder finds nothing here, and leaves its own.
    assert all(len(r["embedding"]) == 4 for r in embed(frame.limit(20), other, cache).collect())
    assert cache.read(other.name).count() == 20 and cache.read(encoder.name).count() == 300
    one = frame.where("id = 7").select(F.sha2("text", 256).alias("key"))
    found = cache.lookup(one, encoder.name)
    assert found.count() == 1
    scan = next(line for line in plan_of(found).splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [" in scan and "folder" in scan.split("PartitionFilters")[1] and "encoder" in scan.split("PartitionFilters")[1]
    small = cache.compacted(str(tmp_path / "compact"), folders=2)
    assert small.read(encoder.name).count() == 300 and small.read(other.name).count() == 20
    files = lambda c: len(read_files_of(spark, c.path))
    assert files(small) < files(cache)
    assert embed(frame, encoder, small).count() == 300 and EmbeddingCache(spark, str(tmp_path / "none")).read("x") is None


def read_files_of(spark, path):
    return spark.read.parquet(path).inputFiles()


def many_appends(spark, parts, rows=40, **config):
    docs = documents(spark, rows)
    index = HybridIndex.create(spark, config=IndexConfig(chunking=ChunkingConfig(200, 20, 10), vectors=VectorIndexConfig(search="exact"), **config))
    for part in range(parts):
        index.append(docs.where(F.col("doc_ord") % parts == part))
    return docs, index


def test_runs_of_batches_are_merged_by_size(spark):
    tiers, sizes = [], []
    for batch in range(40):
        tiers, merges = grown(tiers, batch)
        sizes.append(len(tiers))
        assert [t[1] for t in tiers] == [0, *[t[2] + 1 for t in tiers[:-1]]] and tiers[-1][2] == batch
        assert all(len({t[0] for t in g}) == 1 and len(g) == 4 for g in merges)
    assert max(sizes) <= 3 * 3 + 1 and grown([], 5) == ([[0, 5, 5]], [])


def test_many_appends_equal_one_build(spark):
    docs, index = many_appends(spark, 9, term_buckets=8, chunk_buckets=8)
    assert [t[0] for t in index.manifest.tiers] == [1, 1, 0]
    whole = HybridIndex.build(docs, config=index.config)
    loaded = HybridIndex.load(spark, index.store.path)
    assert same(loaded.sparse.terms, whole.sparse.terms)
    # The average comes from how many words have each frequency, kept up to date by changed words.
    assert loaded.sparse.average_idf == pytest.approx(whole.sparse.average_idf, rel=1e-9)
    vocabulary = loaded.sparse.terms.groupBy("df").count()
    counts = loaded.store.read_tiers("df_counts", loaded.manifest.tiers).groupBy("df").agg(F.sum("n").alias("count")).where("count <> 0")
    assert same(counts.selectExpr("df", "count"), vocabulary.selectExpr("df", "count"))
    for text_rows in (docs.where("doc_ord = 3"), docs.where("doc_ord = 26")):
        with pytest.raises(ValueError):
            loaded.append(text_rows)
    assert loaded.append(docs.where("doc_ord in (3, 26, 30)"), on_conflict="replace") > 0
    assert same(loaded.sparse.terms, whole.sparse.terms) and ids(loaded.chunks) == ids(whole.chunks)
    assert loaded.sparse.average_idf == pytest.approx(whole.sparse.average_idf, rel=1e-9)
    copy = loaded.save(f"{loaded.store.path}-copy")
    assert copy.sparse.average_idf == pytest.approx(whole.sparse.average_idf, rel=1e-9)
    with pytest.raises(ValueError):
        copy.append(docs.where("doc_ord = 3"))


def test_chunks_that_were_replaced_may_come_back(spark):
    """An id that a filter knows but that was replaced is no conflict."""
    config = IndexConfig(chunking=ChunkingConfig(200, 20, 10), vectors=VectorIndexConfig(search="exact"))
    long = " ".join(SENTENCES)
    index = HybridIndex.build(from_texts(spark, [long], ["d"]), config=config)
    assert index.n_chunks > 2
    index.append(from_texts(spark, [SENTENCES[0]], ["d"]), on_conflict="replace")
    assert ids(index.chunks) == ["d_0"]
    back = index.chunks.drop("dl").withColumn("chunk_id", F.lit("d_2")).withColumn("doc_ord", F.lit(9).cast("bigint"))
    vectors = index.vectors.select(F.lit("d_2").alias("chunk_id"), "embedding")
    assert index.add_chunks(back, vectors) == 1 and ids(index.chunks) == ["d_0", "d_2"]
    with pytest.raises(ValueError):
        index.add_chunks(back, vectors)


def test_filters_know_their_ids_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(registry, "SLICE_IDS", 500)
    monkeypatch.setattr(registry, "TASK_IDS", 100)
    frame = lambda a, b: spark.range(a, b).select(F.concat(F.lit("doc "), F.col("id").cast("string")).alias("id"))
    made = lambda a, b: registry.filters_of(frame(a, b).select(F.lit("doc").alias("kind"), "id"), {"doc": b - a})
    rows = [made(a, b).withColumn("tier", F.lit(f"t{a}")) for a, b in ((0, 3_000), (5_000, 5_040))]
    filters = rows[0].unionByName(rows[1])
    shapes = [(r["tier"], r["slices"]) for r in filters.select("tier", "slices").distinct().collect()]
    assert sorted(shapes) == [("t0", 6), ("t5000", 1)]
    found = {r["id"] for r in registry.may_hold(frame(2_000, 12_000), filters, shapes).collect()}
    held = {f"doc {i}" for i in [*range(2_000, 3_000), *range(5_000, 5_040)]}
    assert held <= found and len(found - held) < 0.02 * 9_000
    assert registry.may_hold(frame(0, 0), filters, shapes).count() == 0 == registry.may_hold(frame(0, 5), filters, []).count()
    assert made(0, 0).count() == 0


def test_append_does_not_read_the_chunks_before_it(spark, monkeypatch):
    """Without repeated ids only filters are read; a repeated one is looked up in its folder."""
    docs, index = many_appends(spark, 2, term_buckets=8, chunk_buckets=16)
    read, asked = index.store.read, []
    monkeypatch.setattr(index.store, "read", lambda table, *a: asked.append(table) or read(table, *a))
    index.append(from_texts(spark, SENTENCES, [f"new {i}" for i in range(8)]))
    assert "chunks" not in asked
    with pytest.raises(ValueError):
        index.append(docs.where("doc_ord = 1").limit(1))
    assert "chunks" in asked


def test_appends_that_change_no_word(spark):
    """A document replaced by itself, and texts without a word."""
    config = IndexConfig(chunking=ChunkingConfig(200, 20, 10), vectors=VectorIndexConfig(search="exact"))
    index = HybridIndex.build(from_texts(spark, SENTENCES), config=config)
    terms, average = index.sparse.terms.collect(), index.sparse.average_idf
    assert index.append(from_texts(spark, SENTENCES[:1], ["text_0"]), on_conflict="replace") == 1
    assert sorted(index.sparse.terms.collect()) == sorted(terms) and index.sparse.average_idf == pytest.approx(average)
    assert index.append(from_texts(spark, ["... !!! ??? ... !!! ??? ..."], ["signs"])) == 1
    assert index.n_chunks == 9 and sorted(index.sparse.terms.collect()) == sorted(terms)
