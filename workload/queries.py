"""Every registered query: whole tables in, one DataFrame out."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner import ChunkingConfig, IndexConfig, RetrievalConfig, VectorIndexConfig
from gleaner.functions.text import clean_text, split_segments, strip, text_key, tokenize, word_set
from gleaner.functions.vectors import dimensions, l2_normalize
from gleaner.operators.chunk import chunk_documents
from gleaner.operators.dense import CellBounds, Cells, bounded_search, exact_search, ivf_search, tuned_nprobe
from gleaner.operators.embed import EmbeddingCache, HashingEncoder, ModelEncoder, cache_misses, embed
from gleaner.operators.evaluate import evaluate, mean_metrics, overlap_recall
from gleaner.operators.fuse import fused_top_k
from gleaner.operators.post import (
    build_context,
    build_prompt,
    dedup_hits,
    extractive_answer,
    generated_answer,
    hydrate,
    report,
    source_rows,
)
from gleaner.operators.sparse import (
    SparseIndex,
    bm25_search,
    bm25_work,
    build_postings,
    merge_term_frequencies,
    term_frequencies,
)
from gleaner.plans.hybrid import HybridIndex
from gleaner.runtime import fits_broadcast, materialize, scratch_path, spread
from gleaner.sources.files import (
    SUFFIXES,
    FileDocuments,
    assemble_parts,
    escaped,
    fewer_tasks,
    file_name,
    local_folder,
    read_directory,
    read_files,
    stem,
    suffix,
)
from gleaner.sources.store import IndexStore
from gleaner.sources.tables import default_doc_ids, from_table, from_texts
from gleaner.streaming.ingest import ingest_stream

CANDIDATES = 20
PROBES = (3, 5)  # of ten cells
METRIC_K = 5
RECALL, SLACK = 0.95, 0.35


@dataclass
class Corpus:
    """Index tables of one data folder, each written once per session on first use."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        return from_table(spread(self.table("documents")))

    @property
    def questions(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))

    @cached_property
    def chunks(self) -> DataFrame:
        return materialize(chunk_documents(self.documents), "chunks")

    @cached_property
    def sparse(self) -> SparseIndex:
        return SparseIndex.build(self.chunks)

    @cached_property
    def vectors(self) -> DataFrame:
        encoded = embed(self.chunks.select("chunk_id", "doc_ord", "chunk_index", "text"), HashingEncoder())
        return materialize(encoded.drop("text"), "vectors")

    def dense_hits(self, k: int) -> DataFrame:
        encoded = embed(self.questions, HashingEncoder(), text="question")
        return exact_search(encoded, self.vectors, k, dim=64)

    def sparse_hits(self, k: int, pad_zero: bool = True) -> DataFrame:
        return bm25_search(self.questions, self.sparse, k, pad_zero)

    @cached_property
    def fused(self) -> DataFrame:
        """Fused lists of every question at full candidate depth, with texts."""
        hits = fused_top_k(self.dense_hits(CANDIDATES), self.sparse_hits(CANDIDATES), CANDIDATES)
        return materialize(hydrate(materialize(hits, "hits"), self.chunks), "fused")

    @cached_property
    def cells(self) -> Cells:
        """One cell per label, its centre the mean direction: cells that SQL can compute as well."""
        values = self.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
        means = values.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
        mean = F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"])
        centers = means.groupBy("label").agg(l2_normalize(mean).alias("centroid"))
        return Cells.from_frame(centers.select((F.row_number().over(Window.orderBy("label")) - 1).alias("cell"), "centroid"))

    @cached_property
    def trained_cells(self) -> Cells:
        return Cells.train(self.table("embeddings"), VectorIndexConfig())

    @cached_property
    def vectors_by_trained_cell(self) -> DataFrame:
        return materialize(self.trained_cells.assign(self.table("embeddings")), "trained", ("cell",))

    @cached_property
    def vectors_by_cell(self) -> DataFrame:
        return materialize(self.cells.assign(self.table("embeddings")), "cells", ("cell",))


_corpora: dict[tuple[str, str], Corpus] = {}


def corpus(spark: SparkSession, folder: str) -> Corpus:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _corpora:
        _corpora[key] = Corpus(spark, folder)
    return _corpora[key]


# Text and chunks ------------------------------------------------------------


def q_clean_text(c: Corpus) -> DataFrame:
    return c.documents.select("doc_id", clean_text(F.col("text")).alias("cleaned"))


def q_strip_pages(c: Corpus) -> DataFrame:
    html = F.col("html").cast("string")
    return c.table("pages").select("page_id", F.length(strip(html)).alias("n_chars"), clean_text(html).alias("cleaned"))


def q_segments(c: Corpus) -> DataFrame:
    cfg = ChunkingConfig()
    cleaned = c.documents.select("doc_id", clean_text(F.col("text")).alias("t"))
    segments = split_segments(F.col("t"), cfg.chunk_size, cfg.separators)
    return cleaned.select("doc_id", F.posexplode(segments).alias("seg_no", "segment"))


def q_chunks(c: Corpus) -> DataFrame:
    return chunk_documents(c.documents).select(
        "chunk_id", "doc_id", "chunk_index", "start_char", "end_char", "text"
    )


def q_page_chunks(c: Corpus) -> DataFrame:
    pages = spread(c.table("pages")).select("page_id", F.col("html").cast("string").alias("html"))
    return chunk_documents(from_table(pages, "page_id", "html")).select(
        "chunk_id", "chunk_index", "start_char", "end_char", "text"
    )


def q_chunk_counts(c: Corpus) -> DataFrame:
    return chunk_documents(c.documents).groupBy("doc_id").agg(F.count("*").alias("n_chunks"))


def q_source_counts(c: Corpus) -> DataFrame:
    """Indexed sources in order of first appearance, with their chunks."""
    docs = from_table(spread(c.table("documents")), metadata=["source"])
    return (
        chunk_documents(docs)
        .groupBy(F.col("metadata")["source"].alias("source"))
        .agg(F.min("doc_ord").alias("first_ord"), F.count("*").alias("n_chunks"))
    )


def q_assemble_parts(c: Corpus) -> DataFrame:
    return assemble_parts(c.table("conversations"), "conv_id", "turn")


def q_default_doc_ids(c: Corpus) -> DataFrame:
    turns = c.table("conversations").select(
        F.when(F.col("turn") == 0, F.col("conv_id").cast("string")).alias("doc_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_ord"),
        "text",
    )
    return default_doc_ids(turns).select("doc_ord", "doc_id")


def q_metadata_map(c: Corpus) -> DataFrame:
    docs = from_table(c.table("documents"), metadata=["lang", "source", "n_chars"])
    return docs.select("doc_id", F.explode("metadata").alias("key", "value"))


def q_path_parts(c: Corpus) -> DataFrame:
    url = F.col("url")
    return c.table("pages").select(
        "page_id",
        file_name(url).alias("filename"),
        stem(url).alias("stem"),
        suffix(url).alias("suffix"),
        suffix(url).isin(*SUFFIXES).alias("supported"),
    )


def q_word_sets(c: Corpus) -> DataFrame:
    return c.documents.select("doc_id", F.size(word_set(F.col("text"))).cast("bigint").alias("n_words"))


def q_tokens(c: Corpus) -> DataFrame:
    return c.documents.select("doc_id", F.posexplode(tokenize(F.col("text"))).alias("pos", "token"))


# Sparse ----------------------------------------------------------------------


def q_postings(c: Corpus) -> DataFrame:
    return build_postings(c.chunks).select("term", "chunk_id", "tf", "dl")


def q_term_stats(c: Corpus) -> DataFrame:
    return c.sparse.weights.select("term", "df", F.round("idf", 6).alias("idf"))


def q_corpus_stats(c: Corpus) -> DataFrame:
    return c.sparse.stats().select(
        "n_chunks", "total_len", F.round("avgdl", 6).alias("avgdl"), F.round("average_idf", 6).alias("average_idf")
    )


def q_appended_term_stats(c: Corpus) -> DataFrame:
    """Frequencies of two separately indexed parts add up to those of the whole."""
    postings = build_postings(c.chunks)
    parts = [postings.where(F.col("doc_ord") % 2 == half) for half in (0, 1)]
    return merge_term_frequencies(*(term_frequencies(p) for p in parts))


def _ranked(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), *more, F.round("score", 6).alias("score")
    )


def q_bm25_topk(c: Corpus) -> DataFrame:
    return _ranked(c.sparse_hits(CANDIDATES, pad_zero=False), "chunk_id")


def q_bm25_padded(c: Corpus) -> DataFrame:
    """Every user's turn as a question; short ones match less than k chunks and are filled up."""
    turns = c.table("conversations").where("role = 'user'")
    asked = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("question"))
    return _ranked(bm25_search(asked, c.sparse, CANDIDATES), "chunk_id")


def q_bm25_by_shard(c: Corpus) -> DataFrame:
    """The same search on the path for many pairs of questions and postings."""
    return _ranked(bm25_search(c.questions, c.sparse, CANDIDATES, False, by_shard=True), "chunk_id")


def q_bm25_work(c: Corpus) -> DataFrame:
    """Postings that share a word with a question; no more than twice as many are read by both rounds."""
    work = bm25_work(c.questions, c.sparse, CANDIDATES)
    return work.select("query_id", "matched", (F.col("read") <= 2 * F.col("matched")).alias("bounded"))


# Dense -----------------------------------------------------------------------

_VECTORS = {"dim": 64, "id_col": "vec_id", "order": ("vec_id",)}


def _vector_queries(c: Corpus) -> DataFrame:
    return c.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def q_dense_topk(c: Corpus) -> DataFrame:
    found = exact_search(_vector_queries(c), spread(c.table("embeddings")), 5, **_VECTORS)
    return _ranked(found, "vec_id")


def q_dense_topk_blocks(c: Corpus) -> DataFrame:
    """The same search on the path for query tables beyond the broadcast size."""
    found = exact_search(_vector_queries(c), c.table("embeddings"), 5, small_queries=False, **_VECTORS)
    return _ranked(found, "vec_id")


def q_ivf_full_probe(c: Corpus) -> DataFrame:
    found = ivf_search(_vector_queries(c), c.vectors_by_cell, c.cells, 5, c.cells.nlist, **_VECTORS)
    return _ranked(found, "vec_id")


def q_ivf_topk(c: Corpus) -> DataFrame:
    found = ivf_search(_vector_queries(c), c.vectors_by_cell, c.cells, 5, PROBES[0], **_VECTORS)
    return _ranked(found, "vec_id")


def q_ivf_recall(c: Corpus) -> DataFrame:
    """Mean recall@5 against exact search, by the number of cells looked at."""
    queries = _vector_queries(c)
    truth = exact_search(queries, c.vectors_by_cell, 5, **_VECTORS)
    rows = None
    for nprobe in PROBES:
        found = ivf_search(queries, c.vectors_by_cell, c.cells, 5, nprobe, **_VECTORS)
        mean = overlap_recall(found, truth, "vec_id").agg(F.round(F.avg("recall"), 6).alias("recall"))
        mean = mean.select(F.lit(nprobe).alias("nprobe"), "recall")
        rows = mean if rows is None else rows.unionByName(mean)
    return rows


def q_ivf_exact(c: Corpus) -> DataFrame:
    """Trained cells, visited until none that is left can hold a better vector."""
    bounds = CellBounds.measure(c.vectors_by_trained_cell, c.trained_cells)
    found, _ = bounded_search(_vector_queries(c), c.vectors_by_trained_cell, c.trained_cells, bounds, 5, **_VECTORS)
    return _ranked(found, "vec_id")


def trained_recall(c: Corpus) -> DataFrame:
    """(search, recall, share of vectors scored) of trained cells: a measured number of cells, and narrowed bounds."""
    cells, stored, queries = c.trained_cells, c.vectors_by_trained_cell, _vector_queries(c)
    truth = materialize(exact_search(queries, stored, 5, **_VECTORS), "truth")
    sizes = stored.groupBy("cell").agg(F.count("*").alias("vectors"))
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(1_000)
    nprobe = tuned_nprobe(sample, stored, cells, 5, RECALL, **_VECTORS)
    by_number = ivf_search(queries, stored, cells, 5, nprobe, **_VECTORS)
    # A row per cell: small by construction.
    looked = cells.probes(queries, nprobe).join(F.broadcast(sizes), "cell").groupBy("query_id").agg(F.sum("vectors").alias("vectors"))
    bounds = CellBounds.measure(stored, cells, SLACK)
    by_bound, scored = bounded_search(queries, stored, cells, bounds, 5, **_VECTORS)
    rows = None
    for name, found, work in (("nprobe", by_number, looked), ("bounds", by_bound, scored)):
        mean = overlap_recall(found, truth, "vec_id").agg(F.avg("recall").alias("recall"))
        share = work.agg(F.avg("vectors").alias("v")).join(sizes.agg(F.sum("vectors").alias("n"))).select((F.col("v") / F.col("n")).alias("share"))
        row = mean.join(share).select(F.lit(name).alias("search"), "recall", "share")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def q_ivf_trained_recall(c: Corpus) -> DataFrame:
    """Both ways of stopping early find what they should without scoring every vector."""
    return trained_recall(c).select("search", (F.col("recall") >= RECALL).alias("reached"), (F.col("share") < 1).alias("saved"))


def q_cell_sizes(c: Corpus) -> DataFrame:
    return c.vectors_by_cell.groupBy("cell").agg(F.count("*").alias("n"))


def q_vector_dimensions(c: Corpus) -> DataFrame:
    return dimensions(c.table("embeddings"))


def q_normalized_vectors(c: Corpus) -> DataFrame:
    """Vectors scaled away from unit length and back."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    scaled_rows = c.table("embeddings").select("vec_id", scaled.alias("v"))
    return scaled_rows.select("vec_id", F.posexplode(l2_normalize(F.col("v"))).alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 6).alias("x")
    )


def q_hashed_embeddings(c: Corpus) -> DataFrame:
    vectors = embed(c.chunks.select("chunk_id", "text"), HashingEncoder())
    values = vectors.select("chunk_id", F.posexplode("embedding").alias("pos", "x")).where("x <> 0")
    return values.select("chunk_id", "pos", F.round(F.col("x").cast("double"), 6).alias("x"))


def q_embed_cache_misses(c: Corpus) -> DataFrame:
    """Distinct texts to encode when the English documents are cached already."""
    docs = c.table("documents")
    cached = docs.where("lang = 'en'").select(text_key(F.col("text")).alias("key")).distinct()
    return cache_misses(docs, cached).select("key", "n")


def q_embed_cached(c: Corpus) -> DataFrame:
    """All documents through a cache that knows the English ones, and others under another encoder's name."""
    docs = c.table("documents").select("doc_id", "lang", "text")
    cache, encoder = EmbeddingCache(c.spark, scratch_path(c.spark, "cache")), HashingEncoder()
    embed(docs.where("lang = 'en'"), encoder, cache)
    embed(docs.where("lang = 'de'"), HashingEncoder(32), cache)
    vectors = embed(docs, encoder, cache)
    values = vectors.select("doc_id", F.posexplode("embedding").alias("pos", "x")).where("x <> 0")
    return values.select("doc_id", "pos", F.round(F.col("x").cast("double"), 6).alias("x"))


def _letter_counter():
    """A caller's model: one plus how often four characters occur."""
    return lambda texts: np.array([[1 + t.count(c) for c in "aei "] for t in texts], np.float32).reshape(-1, 4)


def q_embed_model(c: Corpus) -> DataFrame:
    """Documents encoded by a caller's model, each distinct text once."""
    vectors = embed(c.documents.select("doc_id", "text"), ModelEncoder(_letter_counter, 4, model="letters"))
    values = vectors.select("doc_id", F.posexplode("embedding").alias("pos", "x"))
    return values.select("doc_id", "pos", F.round(F.col("x").cast("double"), 5).alias("x"))


def q_text_keys(c: Corpus) -> DataFrame:
    return c.documents.select("doc_id", text_key(F.col("text")).alias("key"))


# Hybrid and answers -------------------------------------------------------------


def q_dense_chunks(c: Corpus) -> DataFrame:
    return _ranked(c.dense_hits(CANDIDATES), "chunk_id")


def q_hybrid_rrf(c: Corpus) -> DataFrame:
    hits = fused_top_k(c.dense_hits(CANDIDATES), c.sparse_hits(CANDIDATES), CANDIDATES)
    return _ranked(hits, "chunk_id", "dense_rank", "sparse_rank")


def q_dedup_hits(c: Corpus) -> DataFrame:
    return _ranked(dedup_hits(c.fused), "chunk_id")


def q_dedup_hits_loose(c: Corpus) -> DataFrame:
    return _ranked(dedup_hits(c.fused, 0.3), "chunk_id")


def q_context(c: Corpus) -> DataFrame:
    return build_context(c.questions, dedup_hits(c.fused)).select("query_id", "context")


def q_prompt(c: Corpus) -> DataFrame:
    return build_prompt(c.questions, dedup_hits(c.fused), 1200).select("query_id", "prompt")


def q_extractive_answer(c: Corpus) -> DataFrame:
    return extractive_answer(c.questions, c.fused)


def _echo():
    """A caller's answer model: the length and the end of its prompt."""
    return lambda prompts: [f"{len(p)}:{p[-40:]}" for p in prompts]


def q_model_answer(c: Corpus) -> DataFrame:
    return generated_answer(c.questions, dedup_hits(c.fused), _echo, 1200).select("query_id", "answer")


def q_report(c: Corpus) -> DataFrame:
    return report(c.fused)


def q_source_rows(c: Corpus) -> DataFrame:
    return source_rows(c.fused).withColumn("score", F.round("score", 6))


def _exact_config() -> IndexConfig:
    """Exhaustive vector search at any size, so the results have a plain SQL form."""
    return IndexConfig(vectors=VectorIndexConfig(search="exact"))


def q_hybrid_answer(c: Corpus) -> DataFrame:
    """Documents to answers through the index: build, retrieve, deduplicate, answer."""
    index = HybridIndex.build(c.documents, config=_exact_config())
    answers = index.answer(c.questions)
    return answers.select(
        "query_id",
        "question",
        "answer",
        F.array_join(F.transform("retrieved", lambda r: r["chunk_id"]), ",").alias("retrieved"),
    )


def q_bm25_answer(c: Corpus) -> DataFrame:
    """Documents to answers by BM25 alone."""
    chunks = materialize(chunk_documents(c.documents), "chunks")
    hits = bm25_search(c.questions, SparseIndex.build(chunks), RetrievalConfig().top_k)
    top = hydrate(materialize(hits.select("query_id", "rank", "chunk_id", "score"), "hits"), chunks)
    return extractive_answer(c.questions, top)


# Evaluation ----------------------------------------------------------------------


def _sent(rows: DataFrame, label: str, *text_columns: str) -> DataFrame:
    """A written table, sent to the rows it is joined with where it fits."""
    rows = materialize(rows, label)
    return F.broadcast(rows) if fits_broadcast(rows, *text_columns) else rows


def passage_judgements(questions: DataFrame, chunks: DataFrame, index: SparseIndex) -> DataFrame:
    """(query_id, chunk_id) of the chunks that contain a question's text word for word.

    Such a chunk holds every inner word of the passage, so only chunks with the
    rarest inner word are compared. Questions of at most two words have no inner word; these
    few are compared with every chunk.
    """
    worded = questions.select("query_id", "question", tokenize(F.col("question")).alias("words"))
    short = worded.where(F.size("words") <= 2).select("query_id", "question")
    if fits_broadcast(short, "question"):
        short = F.broadcast(short)
    held = chunks.select("chunk_id", "text").join(short, F.contains("text", "question")).select("query_id", "chunk_id")
    inner = worded.where(F.size("words") > 2).select(
        "query_id", "question", F.explode(F.slice("words", F.lit(2), F.size("words") - 2)).alias("term")
    )
    # What belongs to the questions goes to the tables of the corpus, where it may be broadcast.
    inner = _sent(inner, "inner-words", "term", "question")
    known = _sent(index.weights_of(inner.select("term")).select("term", "df"), "inner-terms", "term")
    rarest = (
        inner.join(known, "term")
        .groupBy("query_id")
        .agg(F.min(F.struct("df", "term"))["term"].alias("term"), F.any_value("question").alias("question"))
    )
    # No inner word may be missing from the corpus.
    unknown = inner.join(known, "term", "left_anti").select("query_id").distinct()
    rarest = _sent(rarest.join(unknown, "query_id", "left_anti"), "rarest-words", "term", "question")
    near = index.postings.join(rarest, "term").select("query_id", "chunk_id", "question")
    near = _sent(near, "near", "chunk_id", "question")
    return (
        chunks.select("chunk_id", "text")
        .join(near, "chunk_id")
        .where(F.contains("text", "question"))
        .select("query_id", "chunk_id")
        .unionByName(held)
    )


def q_judgements(c: Corpus) -> DataFrame:
    return passage_judgements(c.questions, c.chunks, c.sparse)


def _metrics(c: Corpus) -> DataFrame:
    return evaluate(c.questions, c.fused, passage_judgements(c.questions, c.chunks, c.sparse), METRIC_K)


def q_retrieval_metrics(c: Corpus) -> DataFrame:
    return _metrics(c).select(
        "query_id", *(F.round(m, 6).alias(m) for m in ("reciprocal_rank", "recall", "precision"))
    )


def q_mean_metrics(c: Corpus) -> DataFrame:
    return mean_metrics(_metrics(c)).select(*(F.round(m, 6).alias(m) for m in ("mrr", "recall", "precision")))


# Index life-cycle -------------------------------------------------------------------

_CHUNK_COLUMNS = ("chunk_id", "start_char", "end_char", "text")


def q_index_append(c: Corpus) -> DataFrame:
    """Two appends: the postings of both batches give the term table of the whole corpus."""
    index = HybridIndex.create(c.spark, config=_exact_config())
    for half in (0, 1):
        index.append(c.documents.where(F.col("doc_ord") % 2 == half))
    return index.sparse.weights.select("term", "df", F.round("idf", 6).alias("idf"))


def q_index_save_load(c: Corpus) -> DataFrame:
    index = HybridIndex.build(c.documents, config=_exact_config())
    path = scratch_path(c.spark, "saved")
    index.save(path)
    return HybridIndex.load(c.spark, path).chunks.select(*_CHUNK_COLUMNS)


def q_chunk_lookup(c: Corpus) -> DataFrame:
    """A chunk found by its id, in the folder of that id."""
    index = HybridIndex.build(c.documents, config=_exact_config())
    return index.chunk("1_0").select(*_CHUNK_COLUMNS)


def q_index_upgrade(c: Corpus) -> DataFrame:
    """Vectors appended in two batches: exhaustive at first, by cell after the second one."""
    cfg = IndexConfig(vectors=VectorIndexConfig(nlist=50))
    index = HybridIndex.create(c.spark, config=cfg)
    stored = c.table("embeddings").select(
        F.concat(F.lit("v_"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.col("vec_id").cast("string").alias("doc_id"),
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"),
        F.col("vec_id").alias("doc_ord"),
        F.lit(0).alias("chunk_index"),
        "embedding",
        (F.pmod(F.xxhash64("vec_id"), F.lit(4)) > 0).alias("second"),
    )
    for second in (False, True):
        part = stored.where(F.col("second") == second)
        index.add_chunks(part.drop("embedding", "second"), part.select("chunk_id", "embedding"))
    return index.vectors.select("chunk_id", (F.col("cell") >= 0).alias("in_cell"))


def _as_files(c: Corpus) -> str:
    """One text file per document, its id on the first line."""
    path = scratch_path(c.spark, "files")
    lines = c.table("documents").select(F.concat_ws("\n", F.col("doc_id").cast("string"), "text").alias("value"))
    folder = local_folder(c.spark, path)
    if folder is None:
        # Tasks put their files in place themselves: the driver would move so many one by one.
        writer = lines.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        writer.text(path)
        return path
    os.makedirs(folder)

    # On a disk that all tasks share, Hadoop starts processes for the permissions of each file; plain files need none.
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        started = os.path.join(folder, f".{task.taskAttemptId()}")
        for batch in batches:
            for value in batch["value"]:
                # Named by its place, so that a task that is run again writes the same files.
                with open(started, "wb") as file:
                    file.write(value.as_py() + b"\n")
                os.replace(started, os.path.join(folder, f"part-{task.partitionId():05d}-{number:07d}.txt"))
                number += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([number], pa.int64())})

    lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return path


def _file_rows(read: FileDocuments) -> DataFrame:
    text = F.col("text")
    return read.documents.select(
        F.substring_index(text, "\n", 1).cast("bigint").alias("doc_id"),
        F.substr(text, F.instr(text, "\n") + 1).alias("body"),
        (F.col("doc_ord") >= 0).alias("placed"),
    )


def q_files_directory(c: Corpus) -> DataFrame:
    """Documents written as files and read back as a folder."""
    return _file_rows(read_directory(c.spark, _as_files(c)))


def q_files_list(c: Corpus) -> DataFrame:
    """The same files by a list of their paths."""
    path = _as_files(c)
    files = c.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    return _file_rows(read_files(c.spark, fewer_tasks(files).toArrow()["path"].to_pylist()))


def q_inline_texts(c: Corpus) -> DataFrame:
    """Texts given one by one, without ids: named by their place in the list."""
    texts = [r["text"] for r in c.table("benchmark").orderBy("item_id").select("text").collect()]
    return from_texts(c.spark, texts).select("doc_id", "doc_ord", "text")


def q_stream_ingest(c: Corpus) -> DataFrame:
    """The documents as a stream of files, appended batch by batch."""
    index = HybridIndex.create(c.spark, config=_exact_config())
    source = c.table("documents")
    # A pattern that only this name matches: the table may be one file or a folder of files.
    stream = c.spark.readStream.schema(source.schema).parquet(f"{escaped(c.folder)}/documents.parque[t]")
    query = ingest_stream(from_table(stream), index, scratch_path(c.spark, "stream"))
    query.awaitTermination()
    return HybridIndex.load(c.spark, IndexStore(c.spark, index.store.path).path).chunks.select(*_CHUNK_COLUMNS)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> f(spark, folder) for every `q_` function above."""

    def bind(body: Callable[[Corpus], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: body(corpus(spark, folder))

    return {name[2:]: bind(body) for name, body in globals().items() if name.startswith("q_")}
