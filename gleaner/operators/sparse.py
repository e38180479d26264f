"""BM25 over a posting table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import let, term_counts, tokenize, word_count
from gleaner.operators.ranking import RANK_SCALE, positions, top_k
from gleaner.operators.shards import shard_search
from gleaner.runtime import busy_partitions, fits_broadcast, materialize, salted_join, slice_rows

# BM25 parameters.
K1 = 1.5
B = 0.75
EPSILON = 0.25

# Pairs of a question and a posting from which shards are scored with arrays.
SHARD_PAIRS = 2_000_000

INSERTION_ORDER = ("doc_ord", "chunk_index")

# Words that are brought together at once, and postings of one list and of one Arrow batch at most.
LIST_WORDS, LIST_POSTINGS, SENT_POSTINGS = 4_000_000, 8_192, 200_000
# Chunks are too many for a dictionary of their values, which is given up only after it was filled. Lists are in insertion order:
# as differences to the one before, chunk ids and orders take a fraction of their room.
LIST_OPTIONS = {f"parquet.enable.dictionary#{array}.list.element": "false" for array in ("chunk_ids", "doc_ords")}
LIST_OPTIONS |= {"parquet.writer.version": "v2", "compression": "zstd"}
# Columns of a posting, and the arrays of a list that hold them.
LISTS = {"chunk_id": "chunk_ids", "doc_ord": "doc_ords", "chunk_index": "chunk_indexes", "tf": "tfs", "dl": "dls"}


def term_bucket(buckets: int) -> Column:
    """Storage folder of a posting's term."""
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")


def in_folders_of(table: DataFrame, words: DataFrame, buckets: int | None) -> DataFrame:
    """A table stored by term folder, without the folders that hold none of the words; others as they are."""
    if not buckets or "bucket" not in table.columns:
        return table
    # At most as many numbers as folders; literal ones prune the scan.
    folders = [row[0] for row in words.select(term_bucket(buckets)).distinct().collect()]
    return table.where(F.col("bucket").isin(folders))


def _lists_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The lists of some chunks: pairs of a word and a row, in insertion order, are sorted, and runs of a pair are counted."""
    words = rows["tokens"].combine_chunks()
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    known, n = words.flatten().dictionary_encode(), len(words)
    order = np.lexsort([pc.fill_null(rows[name].chunk(0), 0).to_numpy(zero_copy_only=False) for name in reversed(INSERTION_ORDER)])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    pairs = known.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + np.repeat(place, size)
    pairs.sort()
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    tf = np.diff(first, append=len(pairs)).astype(np.int32)
    word, row = np.divmod(pairs[first], n)
    row = order[row]
    # A list ends with its word, or when it is full.
    within = np.arange(len(word)) - np.searchsorted(word, np.arange(len(known.dictionary)))[word]
    starts = np.flatnonzero(within % LIST_POSTINGS == 0)
    ends = np.append(starts[1:], len(word))
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + SENT_POSTINGS, "right")))
        own = slice(starts[low], ends[high - 1])
        offsets = pa.array(np.append(starts[low:high], ends[high - 1]) - starts[low], pa.int32())
        held = pa.array(row[own])
        # One chunk per column: `rows` was combined.
        fields = [rows[name].chunk(0).take(held) for name in ("chunk_id", *INSERTION_ORDER)]
        fields += [pa.array(tf[own]), pa.array(size[row[own]].astype(np.int32))]
        lists = [pa.ListArray.from_arrays(offsets, f) for f in fields]
        yield pa.RecordBatch.from_arrays([known.dictionary.take(pa.array(word[starts[low:high]])), *lists], ["term", *LISTS.values()])
        low = high


def posting_lists(chunks: DataFrame) -> DataFrame:
    """(term, chunk_ids, doc_ords, chunk_indexes, tfs, dls): postings of a word, several to a row.

    A map: each task brings the words of some chunks together, so a word has one or more lists per task. They are moved and
    written in a fraction of the time that a row per posting takes.
    """
    columns = ("chunk_id", *INSERTION_ORDER)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows + len(batch["tokens"].flatten())
            if held >= LIST_WORDS:
                yield from _lists_of(pa.Table.from_batches(waiting).combine_chunks())
                waiting, held = [], 0
        if held:
            yield from _lists_of(pa.Table.from_batches(waiting).combine_chunks())

    kinds = [chunks.schema[c].dataType.simpleString() for c in columns] + ["int", "int"]
    schema = ", ".join(["term string", *(f"{name} array<{kind}>" for name, kind in zip(LISTS.values(), kinds))])
    return chunks.select(*columns, tokenize(F.col("text")).alias("tokens")).mapInArrow(work, schema)


def unlisted(lists: DataFrame, *more: str) -> DataFrame:
    """(term, chunk_id, doc_ord, chunk_index, tf, dl, more), one row per posting."""
    rows = lists.select("term", F.posexplode("chunk_ids").alias("_at", "chunk_id"), *list(LISTS.values())[1:], *more)
    return rows.select("term", "chunk_id", *(F.get(array, "_at").alias(c) for c, array in list(LISTS.items())[1:]), *more)


def build_postings(chunks: DataFrame) -> DataFrame:
    """(term, chunk_id, doc_ord, chunk_index, tf, dl), one row per distinct term of a chunk; a map, without a shuffle."""
    return unlisted(posting_lists(chunks))


def chunk_lengths(chunks: DataFrame) -> DataFrame:
    """(chunk_id, doc_ord, chunk_index, dl), including chunks without a single token."""
    return chunks.select("chunk_id", *INSERTION_ORDER, word_count(F.col("text")).alias("dl"))


def term_frequencies(postings: DataFrame) -> DataFrame:
    """(term, df). Additive: frequencies of two disjoint sets of chunks may be summed."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def list_frequencies(lists: DataFrame) -> DataFrame:
    """The same, from lists."""
    return lists.groupBy("term").agg(F.sum(F.size("tfs")).alias("df"))


def raw_idf(n_chunks: int, df: Column) -> Column:
    return F.log(F.lit(float(n_chunks)) - df + 0.5) - F.log(df + 0.5)


def term_weights(terms: DataFrame, n_chunks: int, average_idf: float | None) -> DataFrame:
    """(term, df, idf); a negative idf is lifted to a quarter of the mean raw idf."""
    raw = raw_idf(n_chunks, F.col("df"))
    floor = F.lit(EPSILON * (average_idf or 0.0))
    return terms.select("term", "df", F.when(raw < 0, floor).otherwise(raw).alias("idf"))


@dataclass(frozen=True)
class SparseIndex:
    postings: DataFrame
    members: DataFrame
    # (term, df), possibly with several partial counts per term.
    term_parts: DataFrame
    n_chunks: int
    total_length: int
    average_idf: float | None
    # Number of folders the postings are stored in, when they carry `bucket`.
    buckets: int | None = None

    @classmethod
    def build(cls, chunks: DataFrame) -> "SparseIndex":
        """Tokenise once, keep the tables on shared storage."""
        lists = materialize(posting_lists(chunks), "postings", options=LIST_OPTIONS)
        members = materialize(chunk_lengths(chunks), "members")
        n_chunks, total = members.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        return cls.of(unlisted(lists), members, materialize(list_frequencies(lists), "terms"), n_chunks, total)

    @classmethod
    def of(
        cls,
        postings: DataFrame,
        members: DataFrame,
        term_parts: DataFrame,
        n_chunks: int,
        total_length: int,
        buckets: int | None = None,
        df_counts: DataFrame | None = None,
    ) -> "SparseIndex":
        """With `df_counts` (df, n), how many words have each frequency, the vocabulary itself is not read."""
        if df_counts is None:
            average = merge_term_frequencies(term_parts).agg(F.avg(raw_idf(n_chunks, F.col("df")))).first()[0]
        else:
            rows = df_counts.groupBy("df").agg(F.sum("n").alias("n")).where("n > 0 and df > 0")
            average = rows.agg(F.try_divide(F.sum(F.col("n") * raw_idf(n_chunks, F.col("df"))), F.sum("n").cast("double"))).first()[0]
        return cls(postings, members, term_parts, n_chunks, total_length, average, buckets)

    @property
    def average_length(self) -> float:
        return self.total_length / self.n_chunks if self.n_chunks else 0.0

    @property
    def terms(self) -> DataFrame:
        """(term, df), one row per term."""
        return merge_term_frequencies(self.term_parts)

    @property
    def weights(self) -> DataFrame:
        """(term, df, idf) of the whole vocabulary."""
        return term_weights(self.terms, self.n_chunks, self.average_idf)

    def weights_of(self, words: DataFrame) -> DataFrame:
        """(term, df, idf) of some words; partial counts are summed after the other words are gone."""
        parts = merge_term_frequencies(in_folders_of(self.term_parts, words, self.buckets).join(words, "term", "left_semi"))
        return term_weights(parts, self.n_chunks, self.average_idf)

    def stats(self) -> DataFrame:
        """One row: n_chunks, total_len, avgdl, average_idf."""
        return self.members.agg(
            F.count("*").alias("n_chunks"),
            F.coalesce(F.sum("dl"), F.lit(0)).alias("total_len"),
            F.try_divide(F.sum("dl").cast("double"), F.count("*").cast("double")).alias("avgdl"),
        ).withColumn("average_idf", F.lit(self.average_idf))


def query_terms(queries: DataFrame, question: str = "question") -> DataFrame:
    """(query_id, term, qtf): a word asked twice counts twice."""
    return queries.select(
        "query_id", F.explode(term_counts(tokenize(F.col(question)))).alias("_t")
    ).select("query_id", "_t.term", F.col("_t.tf").alias("qtf"))


def term_score(avgdl: float) -> Column:
    """Contribution of one posting, given `weight` = qtf * idf."""
    tf = F.col("tf").cast("double")
    length = F.try_divide(F.col("dl").cast("double"), F.lit(avgdl))
    return F.col("weight") * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * length))


def question_words(queries: DataFrame, index: SparseIndex) -> tuple[DataFrame, bool]:
    """(query_id, term, df, weight) of the words that occur, and whether they may be broadcast.

    Written once: the question words with their weights steer the joins with the postings.
    """
    asked = query_terms(queries)
    small = fits_broadcast(asked, "term")
    if small:
        asked = F.broadcast(asked)
    weighted = materialize(
        index.weights_of(asked.select("term"))
        .join(asked, "term")
        .select("query_id", "term", "df", (F.col("qtf") * F.col("idf")).alias("weight")),
        "question_words",
    )
    return weighted, small


def postings_of(weighted: DataFrame, index: SparseIndex, small: bool) -> DataFrame:
    """The postings, without folders that hold none of the words."""
    postings = in_folders_of(index.postings, weighted, index.buckets) if small else index.postings
    return postings.select("term", "chunk_id", *INSERTION_ORDER, "tf", "dl")


def bm25_scores(queries: DataFrame, index: SparseIndex) -> DataFrame:
    """(query_id, chunk_id, doc_ord, chunk_index, score) of every chunk sharing a term with a query."""
    return _all_scores(*question_words(queries, index), index)


def _all_scores(weighted: DataFrame, small: bool, index: SparseIndex) -> DataFrame:
    postings = postings_of(weighted, index, small)
    if small:
        # The words go to the postings. Matching postings move once, to their chunk; sums and
        # the per-task top-k then need no further shuffle of (query, chunk) pairs.
        words = F.broadcast(weighted.select("term"))
        matched = postings.join(words, "term", "left_semi").repartition(
            busy_partitions(weighted.sparkSession), "chunk_id"
        )
        pairs = matched.join(F.broadcast(weighted.drop("df")), "term")
    else:
        # Both sides meet by term. Words found in a large share of the chunks are cut into
        # slices by chunk, so no task holds all postings of one word.
        pairs = salted_join(
            postings, weighted, "term", F.col("df"), slice_rows(index.n_chunks), ["chunk_id"]
        )
    keys = ("query_id", "chunk_id", *INSERTION_ORDER)
    return pairs.groupBy(*keys).agg(F.sum(term_score(index.average_length)).alias("score"))


def _impact(avgdl: float):
    """Score of postings of weight 1, from arrays of tf and dl."""

    def impact(tf, dl):
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))

    return impact


def _matches(weighted: DataFrame) -> tuple[int, int]:
    """Postings of the words, and pairs of a question and a posting of one of its words."""
    words = weighted.groupBy("term").agg(F.any_value("df").alias("df"), F.count("*").alias("n"))
    postings, pairs = words.agg(F.sum("df"), F.sum(F.col("df") * F.col("n"))).first()
    return postings or 0, pairs or 0


def bm25_work(queries: DataFrame, index: SparseIndex, k: int) -> DataFrame:
    """(query_id, matched, read): postings of each question's words, and those that the bounds left to be scored."""
    weighted, small = question_words(queries, index)
    work = shard_search(
        weighted, postings_of(weighted, index, small), _matches(weighted)[0], k, _impact(index.average_length), count=True
    )
    return work.groupBy("query_id").agg(F.sum("matched").alias("matched"), F.sum("read").alias("read"))


def bm25_search(
    queries: DataFrame, index: SparseIndex, k: int, pad_zero: bool = True, by_shard: bool | None = None
) -> DataFrame:
    """Top-k chunks of each question: (query_id, rank, chunk_id, doc_ord, chunk_index, score).

    Few pairs of a question and a posting are summed as rows; many are scored by shard, where a question takes one array.
    """
    by_insertion = [F.col(c).asc() for c in INSERTION_ORDER]
    columns = ("query_id", "rank", "chunk_id", *INSERTION_ORDER, "score")
    negative = (index.average_idf or 0.0) < 0.0
    if pad_zero and (index.average_idf or 0.0) <= 0.0:
        return _ranked_with_all_zeros(queries, index, k).select(*columns)
    weighted, small = question_words(queries, index)
    postings, pairs = _matches(weighted)
    if by_shard is None:
        by_shard = not small or pairs > SHARD_PAIRS
    if by_shard and not negative and k > 0:
        scores = shard_search(weighted, postings_of(weighted, index, small), postings, k, _impact(index.average_length))
    else:
        scores = _all_scores(weighted, small, index)
    hits = top_k(scores, k, *by_insertion).select(*columns)
    return _with_zero_tail(queries, hits, index, k) if pad_zero and k > 0 else hits


def _with_zero_tail(queries: DataFrame, hits: DataFrame, index: SparseIndex, k: int) -> DataFrame:
    """Fill lists shorter than k with zero-score chunks in insertion order.

    No weight is negative here. A match whose words weigh nothing scores zero and stands among the
    unmatched chunks, so only matches that score above zero come first: a question has listed all of
    them when it has less than k, and 2k first chunks always hold enough others.
    """
    hits = hits.where(F.rint(F.col("score") * RANK_SCALE) > 0)
    fields = ("chunk_id", *INSERTION_ORDER, "score")
    first = index.members.orderBy(*INSERTION_ORDER).limit(2 * k)
    pad = F.struct("chunk_id", *INSERTION_ORDER, F.lit(0.0).alias("score"))
    order = F.struct(*INSERTION_ORDER)
    head = first.agg(F.array_sort(F.collect_list(F.struct(order.alias("at"), pad.alias("row")))).alias("head"))
    # At most k rows per question.
    found = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("row")))).alias("found")
    )

    def with_pads(rows: Column) -> Column:
        unseen = F.filter(
            F.transform("head", lambda h: h["row"]),
            lambda h: ~F.exists(rows, lambda r: r["chunk_id"] == h["chunk_id"]),
        )
        return F.when(F.size(rows) >= k, rows).otherwise(F.slice(F.concat(rows, unseen), 1, k))

    rows = F.transform(F.coalesce(F.col("found"), F.array().cast(found.schema["found"].dataType)), lambda f: f["row"])
    return (
        queries.select("query_id")
        .join(found, "query_id", "left")
        .withColumn("head", head.scalar())
        .select("query_id", F.posexplode(let(rows, with_pads)).alias("i", "row"))
        .select("query_id", (F.col("i") + 1).alias("rank"), *(f"row.{c}" for c in fields))
    )


def _ranked_with_all_zeros(queries: DataFrame, index: SparseIndex, k: int) -> DataFrame:
    """Top-k when word weights may be zero or negative, so that chunks without a match can win.

    The first k unmatched chunks of a question lie in the gaps between its matched
    positions; gaps are found from neighbouring matches, never by listing all pairs.
    """
    by_insertion = [F.col(c).asc() for c in INSERTION_ORDER]
    place = materialize(positions(index.members.select("chunk_id", *INSERTION_ORDER), *INSERTION_ORDER), "places")
    matched = materialize(
        bm25_scores(queries, index).join(place.select("chunk_id", "position"), "chunk_id"), "matched"
    )
    ends = queries.select(
        "query_id", F.lit(index.n_chunks).cast("bigint").alias("position")
    )
    by_place = Window.partitionBy("query_id").orderBy("position")
    marks = matched.select("query_id", "position").unionByName(ends)
    gaps = (
        marks.withColumn("seen", F.row_number().over(by_place) - 1)
        .withColumn("start", F.coalesce(F.lag("position").over(by_place) + 1, F.lit(0).cast("bigint")))
        .withColumn("free_before", F.col("start") - F.col("seen"))
        .withColumn("take", F.least(F.col("position") - F.col("start"), F.lit(k) - F.col("free_before")))
        .where("take > 0")
        .select("query_id", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("take") - 1)).alias("position"))
    )
    zeros = gaps.join(place, "position").select(
        "query_id", "chunk_id", *INSERTION_ORDER, F.lit(0.0).alias("score")
    )
    return top_k(matched.drop("position").unionByName(zeros), k, *by_insertion)


def merge_term_frequencies(*parts: DataFrame) -> DataFrame:
    """(term, df) of several disjoint sets of chunks; terms that sum to zero are gone."""
    merged = parts[0].select("term", "df")
    for part in parts[1:]:
        merged = merged.unionByName(part.select("term", "df"))
    return merged.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")


def merge_signed(parts: DataFrame) -> DataFrame:
    """(term, df) of partial counts, some of them negative; words whose counts cancel are gone."""
    return parts.groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")
