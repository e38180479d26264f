"""The whole path: build and grow an index, retrieve for a table of questions, answer it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.config import IndexConfig
from gleaner.functions.text import word_count
from gleaner.functions.vectors import require_dimension
from gleaner.operators.chunk import chunk_documents
from gleaner.operators.dense import Cells, exact_search, ivf_search, tuned_nprobe
from gleaner.operators.embed import EmbeddingCache, Encoder, HashingEncoder, embed
from gleaner.operators.fuse import fused_top_k
from gleaner.operators.post import (
    build_prompt,
    dedup_hits,
    generated_answer,
    hydrate,
    package_results,
)
from gleaner.operators.sparse import (
    INSERTION_ORDER,
    LIST_OPTIONS,
    SparseIndex,
    bm25_search,
    in_folders_of,
    list_frequencies,
    merge_signed,
    posting_lists,
    term_bucket,
    term_frequencies,
)
from gleaner.runtime import fits_broadcast, materialize, read_table, scratch_path
from gleaner.sources.registry import filters_of, may_hold
from gleaner.sources.store import IndexStore, Manifest, gathers, grown


# Columns of a chunk that callers of `add_chunks` may leave out.
OPTIONAL_COLUMNS = {"metadata": "map<string,string>", "start_char": "int", "end_char": "int"}


CHUNK_FOLDER = "chunk_folder"
TEXT_OPTIONS = {"compression": "zstd"}
# Bytes of a word, with the blank after it or as a posting: to tell how much a task writes.
WORD_BYTES = 6
# Questions on which recall is measured when cells are trained.
RECALL_SAMPLE = 1_000


def chunk_bucket(chunk_id: Column, buckets: int) -> Column:
    """Storage folder of a chunk."""
    return F.pmod(F.xxhash64(chunk_id), F.lit(buckets)).cast("int")


class HybridIndex:
    """Chunks, postings and vectors under one path, all of them DataFrames."""

    def __init__(
        self, spark: SparkSession, path: str, config: IndexConfig, encoder: Encoder, manifest: Manifest
    ) -> None:
        self.spark = spark
        self.store = IndexStore(spark, path)
        self.config = config
        self.encoder = encoder
        self.manifest = manifest

    # Building ---------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str | None = None,
        config: IndexConfig | None = None,
        encoder: Encoder | None = None,
    ) -> "HybridIndex":
        """An empty index at `path`, by default in the session's shared work folder."""
        config = config or IndexConfig()
        encoder = encoder or HashingEncoder(config.embedding.dim, config.embedding.normalize)
        index = cls(spark, path or scratch_path(spark, "index"), config, encoder, Manifest(config.to_json()))
        if index.store.latest() is not None:
            raise ValueError(f"an index exists at {path}")
        index.store.commit(index.manifest)
        return index

    @classmethod
    def build(cls, documents: DataFrame, path: str | None = None, **options) -> "HybridIndex":
        index = cls.create(documents.sparkSession, path, **options)
        index.append(documents)
        return index

    @classmethod
    def load(cls, spark: SparkSession, path: str, encoder: Encoder | None = None) -> "HybridIndex":
        manifest = IndexStore(spark, path).latest()
        if manifest is None:
            raise FileNotFoundError(f"no saved index in {path}")
        config = IndexConfig.from_json(manifest.config)
        encoder = encoder or HashingEncoder(config.embedding.dim, config.embedding.normalize)
        return cls(spark, path, config, encoder, manifest)

    def append(
        self,
        documents: DataFrame,
        label: str | None = None,
        on_conflict: str = "error",
        cache: EmbeddingCache | None = None,
    ) -> int:
        """Chunk, encode and index documents(doc_id, text, metadata, doc_ord); returns the chunk count.

        A label that was appended before is skipped, so a retried batch counts once.
        """
        chunks = chunk_documents(documents, self.config.chunking)
        return self._append(chunks, documents, None, label, on_conflict, cache)

    def add_chunks(
        self, chunks: DataFrame, vectors: DataFrame, label: str | None = None, on_conflict: str = "error"
    ) -> int:
        """Append ready chunks with their vectors(chunk_id, embedding); both must name the same chunks."""
        rows, distinct, length = vectors.agg(
            F.count("*"), F.countDistinct("chunk_id"), F.coalesce(F.max(F.size("embedding")), F.lit(self.encoder.dim))
        ).first()
        if distinct < rows:
            raise ValueError("a chunk id has more than one vector")
        if require_dimension(vectors) not in (0, self.encoder.dim):
            raise ValueError(f"vectors have length {length}, the index has {self.encoder.dim}")
        unmatched = (
            chunks.select("chunk_id", F.lit(1).alias("c"))
            .join(vectors.select("chunk_id", F.lit(1).alias("v")), "chunk_id", "full_outer")
            .where("c is null or v is null")
        )
        if not unmatched.isEmpty():
            raise ValueError("chunks and vectors do not name the same chunk ids")
        return self._append(chunks, chunks, vectors, label, on_conflict, None)

    def _append(
        self,
        chunks: DataFrame,
        ordered: DataFrame,
        vectors: DataFrame | None,
        label: str | None,
        on_conflict: str,
        cache: EmbeddingCache | None,
    ) -> int:
        if on_conflict not in ("error", "replace"):
            raise ValueError("on_conflict is 'error' or 'replace'")
        old = self.manifest = self.store.latest() or self.manifest
        if label is not None and label in old.labels:
            return 0
        batch = old.batches
        now = old.with_(batches=batch + 1, labels=[*old.labels, label] if label else old.labels)

        first, size = ordered.agg(F.min("doc_ord"), F.sum(F.octet_length("text"))).first()
        if first is None:
            return 0
        # Insertion order goes on where the last batch ended.
        placed = chunks.withColumn("doc_ord", F.col("doc_ord") + (old.next_ord - first))
        # Every batch has every column, so that a table reads alike whichever batch names its schema.
        for name, kind in OPTIONAL_COLUMNS.items():
            if name not in placed.columns:
                placed = placed.withColumn(name, F.lit(None).cast(kind))
        self._write_chunks(self.store, placed.withColumn("dl", word_count(F.col("text"))), batch, size or 0)
        new = read_table(self.spark, f"{self.store.path}/chunks/batch={batch}")
        if new is None:  # folders without rows leave no file
            return 0
        count, distinct, length, last = new.agg(
            F.count("*"), F.countDistinct("chunk_id"), F.sum("dl"), F.max("doc_ord")
        ).first()
        if count == 0:
            return 0
        if distinct < count:
            raise ValueError("chunk ids repeat within the batch")
        now = now.with_(
            n_chunks=old.n_chunks + count, total_length=old.total_length + length, next_ord=last + 1
        )
        # Indexes that an earlier version began have no filters; their ids are read.
        filtered = bool(old.tiers) or not old.batches
        replace = self._replace_old if filtered else self._replace_unfiltered
        now = replace(new, old, now, batch, on_conflict)

        frequencies = list_frequencies(self._write_postings(self.store, new, batch, length))
        if batch in now.replaced:
            gone = self.spark.read.parquet(f"{self.store.path}/dropped/batch={batch}")
            lost = term_frequencies(self.store.read("postings", old).join(gone, "chunk_id", "left_semi"))
            frequencies = merge_signed(frequencies.unionByName(lost.withColumn("df", -F.col("df"))))
        if filtered:
            now = self._write_tiers(new, frequencies, old, now, batch)
        else:
            self.store.write(frequencies, "terms", batch)

        self._write_vectors(new, vectors, batch, cache)
        if self.config.vectors.wants_cells(now.n_chunks, None if self.cells is None else self.cells.nlist):
            now = self._train(now, batch)
        self._publish(now)
        return count

    def _write_chunks(self, store: IndexStore, chunks: DataFrame, batch: int, size: int) -> None:
        """Chunks of about `size` bytes of text, in folders by id."""
        buckets = self.config.chunk_buckets
        if buckets:
            placed = chunks.withColumn(CHUNK_FOLDER, chunk_bucket(F.col("chunk_id"), buckets))
            store.write(placed, "chunks", batch, CHUNK_FOLDER, gathers(chunks, buckets, size), TEXT_OPTIONS)
        else:
            store.write(chunks, "chunks", batch, options=TEXT_OPTIONS)

    def _write_postings(self, store: IndexStore, chunks: DataFrame, batch: int, words: int) -> DataFrame:
        """The lists of some chunks with so many words, in folders by word, as written."""
        buckets = self.config.term_buckets
        lists = posting_lists(chunks).select("*", term_bucket(buckets))
        store.write(lists, "posting_lists", batch, "bucket", gathers(lists, buckets, words * WORD_BYTES), LIST_OPTIONS)
        # With a schema: texts without a word leave no file.
        return self.spark.read.schema(lists.schema).parquet(f"{store.path}/posting_lists/batch={batch}")

    def _write_tiers(self, new: DataFrame, frequencies: DataFrame, old: Manifest, now: Manifest, batch: int) -> Manifest:
        """Term counts, changes of the number of words per frequency, and id filters of a batch; then merges that are due."""
        own, buckets = [0, batch, batch], self.config.term_buckets
        self.store.write_tier(frequencies.select("term", F.col("df").cast("bigint").alias("df"), term_bucket(buckets)), "terms", own, "bucket")
        added = self.store.read_tiers("terms", [own])
        known = self.store.read_tiers("terms", old.tiers)
        if known is None:
            changes = added.groupBy("df").agg(F.count("*").alias("n"))
        else:
            # The frequencies before, of this batch's words only, from the folders that they lie in.
            before = in_folders_of(known, added, buckets).join(added.select("term"), "term", "left_semi")
            before = before.groupBy("term").agg(F.sum("df").alias("was"))
            both = added.join(before, "term", "left").withColumn("was", F.coalesce("was", F.lit(0)))
            change = F.array(F.struct(F.col("was").alias("df"), F.lit(-1).alias("n")), F.struct((F.col("was") + F.col("df")).alias("df"), F.lit(1).alias("n")))
            changes = both.select(F.inline(change)).where("df > 0").groupBy("df").agg(F.sum("n").alias("n")).where("n <> 0")
        self.store.write_tier(changes.select(F.col("df").cast("bigint").alias("df"), F.col("n").cast("bigint").alias("n")).coalesce(1), "df_counts", own)
        self._write_filters(new, own)
        self.store.write_tier(new.select("doc_id", "chunk_id", "dl", chunk_bucket(F.col("doc_id"), self._id_folders).alias("folder")), "ids", own, "folder")
        tiers, merges = grown(old.tiers, batch)
        for group in merges:
            into = [group[0][0] + 1, group[0][1], group[-1][2]]
            terms = merge_signed(self.store.read_tiers("terms", group))
            self.store.write_tier(terms.select("term", "df", term_bucket(buckets)), "terms", into, "bucket")
            counts = self.store.read_tiers("df_counts", group).groupBy("df").agg(F.sum("n").alias("n")).where("n <> 0")
            self.store.write_tier(counts.coalesce(1), "df_counts", into)
            rows = self.store.read_tiers("ids", group)
            self.store.write_tier(rows.select("doc_id", "chunk_id", "dl", "folder"), "ids", into, "folder")
            self._write_filters(self.store.read_tiers("ids", [into]), into)
        return now.with_(tiers=tiers)

    def _write_filters(self, rows: DataFrame, tier: list[int]) -> None:
        """Filters of the document and chunk ids of written rows."""
        # Repeated ids fall into one place; a few that replaced others are counted twice, and the filter is a little larger.
        docs, chunks = rows.agg(F.count_distinct("doc_id"), F.count("*")).first()
        kinds = F.array(F.struct(F.lit("chunk").alias("kind"), F.col("chunk_id").alias("id")), F.struct(F.lit("doc").alias("kind"), F.col("doc_id").alias("id")))
        ids = rows.select(F.inline(kinds)).distinct()
        self.store.write_tier(filters_of(ids, {"doc": docs, "chunk": chunks}), "filters", tier)

    @property
    def _id_folders(self) -> int:
        return self.config.chunk_buckets or 64

    def _may_hold(self, ids: DataFrame, kind: str, manifest: Manifest) -> DataFrame:
        """The ids (id) that an earlier batch may have brought, a few new ones among them."""
        filters = self.store.read_tiers("filters", manifest.tiers)
        filters = filters.where(F.col("kind") == kind)
        shapes = [(r["tier"], r["slices"]) for r in filters.select("tier", "slices").distinct().collect()]
        return materialize(may_hold(ids, filters, shapes), "known-ids")

    def _replace_old(self, new: DataFrame, old: Manifest, now: Manifest, batch: int, on_conflict: str) -> Manifest:
        """Chunk ids are unique: a repeated document is an error, or takes the place of the old one.

        Filters tell which ids may be known; only these are looked up, in the folders they would lie in.
        """
        if not old.tiers:
            return now
        if on_conflict == "error":
            maybe = self._may_hold(new.select(F.col("chunk_id").alias("id")), "chunk", old).withColumnRenamed("id", "chunk_id")
            if not maybe.isEmpty() and not self._chunks_of(maybe, old).join(maybe, "chunk_id", "left_semi").isEmpty():
                raise ValueError("chunk ids exist already; use on_conflict='replace'")
            return now
        maybe = self._may_hold(new.select(F.col("doc_id").alias("id")).distinct(), "doc", old).withColumnRenamed("id", "doc_id")
        if maybe.isEmpty():
            return now
        # At most as many numbers as folders.
        folders = [r[0] for r in maybe.select(chunk_bucket(F.col("doc_id"), self._id_folders)).distinct().collect()]
        known = self.store.read_tiers("ids", old.tiers).where(F.col("folder").isin(folders)).join(maybe, "doc_id", "left_semi")
        # What was replaced before is in the registry still; the chunks themselves tell what is there.
        known = materialize(known.select("chunk_id").distinct(), "known-chunks")
        live = self._chunks_of(known, old).join(maybe, "doc_id", "left_semi")
        return self._dropped(live.select("chunk_id", "dl"), now, batch)

    def _dropped(self, gone: DataFrame, now: Manifest, batch: int) -> Manifest:
        self.store.write(gone, "dropped", batch)
        written = self.spark.read.parquet(f"{self.store.path}/dropped/batch={batch}")
        count, length = written.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        return now.with_(
            n_chunks=now.n_chunks - count,
            total_length=now.total_length - length,
            replaced=[*now.replaced, batch],
        )

    def _replace_unfiltered(self, new: DataFrame, old: Manifest, now: Manifest, batch: int, on_conflict: str) -> Manifest:
        known = self.store.read("chunks", old) if old.batches else None
        if known is None:
            return now
        if on_conflict == "error":
            if not known.join(new.select("chunk_id"), "chunk_id", "left_semi").isEmpty():
                raise ValueError("chunk ids exist already; use on_conflict='replace'")
            return now
        gone = known.join(new.select("doc_id").distinct(), "doc_id", "left_semi")
        return self._dropped(gone.select("chunk_id", "dl"), now, batch)

    def _write_vectors(
        self, new: DataFrame, vectors: DataFrame | None, batch: int, cache: EmbeddingCache | None
    ) -> None:
        keys = new.select("chunk_id", *INSERTION_ORDER, "text")
        if vectors is None:
            encoded = embed(keys, self.encoder, cache)
        else:
            encoded = keys.join(vectors.select("chunk_id", "embedding"), "chunk_id")
        encoded = encoded.select("chunk_id", *INSERTION_ORDER, "embedding")
        if self.cells is not None:
            self.store.write(self.cells.assign(encoded), self._vector_table, batch, "cell")
        else:
            self.store.write(encoded, self._vector_table, batch)

    def _train(self, manifest: Manifest, batch: int) -> Manifest:
        """Cells over all vectors: k-means, then every vector is written to its cell."""
        flat = self.store.read(self._vector_table, manifest).drop("batch", "cell")
        cells = Cells.train(flat, self.config.vectors.resolve(manifest.n_chunks))
        self.store.write(cells.to_frame(self.spark).coalesce(1), "centroids", batch)
        self.store.write(cells.assign(flat), f"vectors_by_cell_{batch}", batch, "cell")
        manifest, recall = manifest.with_(cells=batch, nprobe=None), self.config.vectors.recall
        if recall is None:
            return manifest
        placed = self.spark.read.parquet(f"{self.store.path}/vectors_by_cell_{batch}/batch={batch}")
        # Stored vectors as questions, chosen by a hash of their id.
        sample = placed.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(RECALL_SAMPLE)
        sample = sample.select(F.col("chunk_id").alias("query_id"), "embedding")
        k = max(1, self.config.retrieval.dense_candidates)
        return manifest.with_(nprobe=tuned_nprobe(sample, placed, cells, k, recall, dim=self.encoder.dim))

    def retrain(self) -> None:
        """New cells for a corpus that has drifted since they were trained."""
        version = self.manifest.batches
        self._publish(self._train(self.manifest.with_(batches=version + 1), version))

    def _publish(self, manifest: Manifest) -> None:
        self.store.commit(manifest)
        self.manifest = manifest
        for name in ("cells", "sparse"):
            self.__dict__.pop(name, None)

    def save(self, path: str) -> "HybridIndex":
        """Write a compact copy, one batch whatever the number of appends, and return it."""
        copy = IndexStore(self.spark, path)
        if copy.latest() is not None:
            raise ValueError(f"an index exists at {path}")
        m = self.manifest
        done = m.with_(batches=1, replaced=[], cells=None if m.cells is None else 0, tiers=[])
        if m.n_chunks:
            # The tables of one batch lie in their folders already; those of several are gathered.
            single = m.batches == 1
            if single and self.config.chunk_buckets:
                copy.write(self.store.read("chunks", m).drop("batch"), "chunks", 0, CHUNK_FOLDER, gathered=True, options=TEXT_OPTIONS)
            else:
                self._write_chunks(copy, self.chunks, 0, m.total_length * WORD_BYTES)
            written = self.spark.read.parquet(f"{copy.path}/chunks/batch=0")
            lists = None if m.replaced or self.store.table("postings", m) is not None else self.store.table("posting_lists", m)
            if lists is None:  # some postings are gone, or lie row by row
                self._write_postings(copy, written, 0, m.total_length)
            else:
                copy.write(lists.drop("batch"), "posting_lists", 0, "bucket", gathered=single, options=LIST_OPTIONS)
            twin = HybridIndex(self.spark, path, self.config, self.encoder, done)
            done = twin._write_tiers(written, self.sparse.terms, done, done, 0)
            if m.cells is None:
                copy.write(self.vectors, "vectors", 0)
            else:
                copy.write(self.vectors, "vectors_by_cell_0", 0, "cell")
                copy.write(self.cells.to_frame(self.spark).coalesce(1), "centroids", 0)
        copy.commit(done)
        return HybridIndex(self.spark, path, self.config, self.encoder, done)

    # Tables -----------------------------------------------------------------

    @property
    def _vector_table(self) -> str:
        return "vectors" if self.manifest.cells is None else f"vectors_by_cell_{self.manifest.cells}"

    @property
    def n_chunks(self) -> int:
        return self.manifest.n_chunks

    @property
    def chunks(self) -> DataFrame:
        """Every indexed chunk."""
        return self.store.read("chunks", self.manifest).drop("batch", CHUNK_FOLDER)

    def _chunks_of(self, hits: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        """The chunks in the folders that some hits lie in: literal folders, so that the others are not read."""
        rows, buckets = self.store.read("chunks", manifest or self.manifest), self.config.chunk_buckets
        if buckets:
            # At most as many numbers as folders.
            found = hits.select(chunk_bucket(F.col("chunk_id"), buckets).alias("b")).distinct().collect()
            rows = rows.where(F.col(CHUNK_FOLDER).isin([r["b"] for r in found]))
        return rows.drop("batch", CHUNK_FOLDER)

    @property
    def vectors(self) -> DataFrame:
        return self.store.read(self._vector_table, self.manifest).drop("batch")

    def chunk(self, chunk_id: str) -> DataFrame:
        """The chunk of that id: one row, or none."""
        rows = self.store.read("chunks", self.manifest).where(F.col("chunk_id") == chunk_id)
        if self.config.chunk_buckets:
            rows = rows.where(F.col(CHUNK_FOLDER) == chunk_bucket(F.lit(chunk_id), self.config.chunk_buckets))
        return rows.drop("batch", CHUNK_FOLDER)

    @cached_property
    def cells(self) -> Cells | None:
        if self.manifest.cells is None:
            return None
        return Cells.from_frame(self.spark.read.parquet(f"{self.store.path}/centroids/batch={self.manifest.cells}"))

    @cached_property
    def sparse(self) -> SparseIndex:
        m = self.manifest
        members = self.chunks.select("chunk_id", *INSERTION_ORDER, "dl")
        postings = self.store.read("postings", m)
        terms = self.store.read_tiers("terms", m.tiers) if m.tiers else self.store.read("terms", m)
        counts = self.store.read_tiers("df_counts", m.tiers)
        return SparseIndex.of(postings, members, terms, m.n_chunks, m.total_length, self.config.term_buckets, counts)

    # Retrieval --------------------------------------------------------------

    def _none(self, queries: DataFrame) -> DataFrame:
        kind = queries.schema["query_id"].dataType.simpleString()
        return self.spark.createDataFrame([], f"query_id {kind}, rank int, chunk_id string, score double")

    def _dense(self, queries: DataFrame, k: int) -> DataFrame:
        if self.n_chunks == 0:
            return self._none(queries)
        encoded = embed(queries.select("query_id", "question"), self.encoder, text="question")
        if self.cells is None:
            hits = exact_search(encoded, self.vectors, k, dim=self.encoder.dim)
        else:
            nprobe = self.manifest.nprobe or self.config.vectors.probes(self.cells.nlist)
            hits = ivf_search(encoded, self.vectors, self.cells, k, nprobe, dim=self.encoder.dim)
        return hits.select("query_id", "rank", "chunk_id", "score")

    def _sparse(self, queries: DataFrame, k: int) -> DataFrame:
        if self.n_chunks == 0:
            return self._none(queries)
        return bm25_search(queries, self.sparse, k, self.config.retrieval.pad_zero).select(
            "query_id", "rank", "chunk_id", "score"
        )

    def _with_text(self, hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        if self.n_chunks == 0:
            return hits.select("*", F.lit("").alias("doc_id"), F.lit("").alias("text"))
        # Written once: read for the folders and again for the texts.
        hits = materialize(hits, "hits")
        return hydrate(hits, self._chunks_of(hits), fits_broadcast(hits, "chunk_id"))

    def _k(self, top_k: int | None) -> int:
        k = self.config.retrieval.top_k if top_k is None else top_k
        if k < 0:
            raise ValueError("top_k must not be negative")
        return k

    def dense_only(self, queries: DataFrame, top_k: int | None = None) -> DataFrame:
        k = self._k(top_k)
        return self._with_text(self._dense(queries, k), queries, k)

    def sparse_only(self, queries: DataFrame, top_k: int | None = None) -> DataFrame:
        k = self._k(top_k)
        return self._with_text(self._sparse(queries, k), queries, k)

    def retrieve(self, queries: DataFrame, top_k: int | None = None) -> DataFrame:
        """Hybrid hits of every question: (query_id, rank, chunk_id, score, doc_id, text)."""
        cfg, k = self.config.retrieval, self._k(top_k)
        hits = fused_top_k(
            self._dense(queries, cfg.dense_candidates), self._sparse(queries, cfg.sparse_candidates), k, cfg
        ).select("query_id", "rank", "chunk_id", "score")
        return self._with_text(hits, queries, k)

    def hits(self, queries: DataFrame, top_k: int | None = None, deduplicate: bool = True) -> DataFrame:
        found = self.retrieve(queries, top_k)
        return dedup_hits(found, self.config.context.similarity_threshold) if deduplicate else found

    def prompts(self, queries: DataFrame, top_k: int | None = None, deduplicate: bool = True) -> DataFrame:
        return build_prompt(queries, self.hits(queries, top_k, deduplicate), self.config.context.max_chars)

    def answer(
        self,
        queries: DataFrame,
        top_k: int | None = None,
        deduplicate: bool = True,
        model: Callable[[], Callable[[Any], Any]] | None = None,
    ) -> DataFrame:
        """(query_id, question, answer, retrieved), one row per question, also when nothing is found.

        Without a model the answer is the text of the best hit.
        """
        found = self.hits(queries, top_k, deduplicate)
        if model is None:
            return package_results(queries, found)
        # Read twice below, for the prompts and for the result rows.
        found = materialize(found, "found")
        answers = generated_answer(queries, found, model, self.config.context.max_chars)
        return package_results(queries, found, answers)
