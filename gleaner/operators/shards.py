"""BM25 by chunk shard, with bounds: many questions against the postings of a bounded number of chunks.

The postings of the asked words move once, to the shard of their chunk, and are written there. A task lays its chunks out in insertion
order and cuts them into blocks; for every word and block it notes the largest score that the word gives any chunk there. Two rounds follow.

The first looks for a high k-th score: a task adds up the rarest words of a question, completes the few best chunks and returns their
scores. The k-th best of all tasks is a score that the answer's k-th cannot be below. The second round is exact: words
that add most per posting come first; once what the remaining words can still add in a block is below the wanted score, only chunks
already met count, and as these become fewer the remaining words are looked up for them instead of read. Blocks and shards whose
words cannot reach the score at all are not read. A task returns only chunks that reach it.

No weight may be negative: a bound must not be lifted by leaving words out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.ranking import RANK_SCALE
from gleaner.runtime import BROADCAST_BYTES, BROADCAST_ROWS, materialize

# Postings that a task holds, and chunks of a block.
TASK_POSTINGS = 2_000_000
BLOCK_CHUNKS = 64
# Neighbours in insertion order that stay together: a long document is cut, short ones share a shard.
_DOCS_TOGETHER, _CHUNKS_TOGETHER = 16, 1_024
_NAMES, _NAMES_IN_ORDER = ("chunk_id", "doc_ord", "chunk_index"), ("doc_ord", "chunk_index", "chunk_id")
# Scores that agree to nine decimals are ties, so a bound must be lower by more than that.
_SLACK = 2e-9
# Share of a question's postings that the first round adds up.
_FIRST_ROUND = 1 / 64
# A word in more than one of so many chunks is common; common words have a value for every chunk, in so many bytes at most.
_COMMON, _COMMON_BYTES = 16, 32 << 20
# Pairs of a word and a chunk that are looked up at once.
_LOOK_UPS = 2_048


@dataclass(frozen=True, eq=False)
class Questions:
    """Words of a bounded block of questions: the words of question q are at [starts[q], starts[q + 1])."""

    names: np.ndarray
    starts: np.ndarray
    word: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, rows: pd.DataFrame, words: pd.Index) -> "Questions":
        number, names = pd.factorize(rows["query_id"], use_na_sentinel=False)
        order = np.argsort(number, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(number, minlength=len(names)))))
        word = words.get_indexer(rows["term"])[order].astype(np.int32)
        return cls(np.asarray(names), starts, word, rows["weight"].to_numpy(np.float64)[order])


class Shard:
    """Postings of some chunks, by word, then chunk; chunk numbers follow insertion order."""

    def __init__(self, word: np.ndarray, chunk: np.ndarray, impact: np.ndarray, n_words: int, n_chunks: int):
        key = word.astype(np.int64) * max(1, n_chunks) + chunk
        order = np.argsort(key)
        self.key, self.chunk, self.impact, self.n_chunks = key[order], chunk[order], impact[order], n_chunks
        # A word that is listed twice for a chunk, as for documents given twice, counts once.
        self.impact[:-1][self.key[1:] == self.key[:-1]] = 0.0
        word = word[order]
        del key, order
        self.starts = np.searchsorted(word, np.arange(n_words + 1))
        self.size = BLOCK_CHUNKS
        while n_words * -(-n_chunks // self.size) > 1 << 23:  # a bound for every word and block, within 64 MB
            self.size *= 2
        self.blocks = max(1, -(-n_chunks // self.size))
        cell = word.astype(np.int64) * self.blocks + self.chunk // self.size
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        self.most = np.zeros(n_words * self.blocks)
        if len(first):
            self.most[cell[first]] = np.maximum.reduceat(self.impact, first)
        self.most = self.most.reshape(n_words, self.blocks)
        # Words of many chunks also have a value for every chunk, where they are looked up without a search.
        sizes = np.diff(self.starts)
        common = np.argsort(-sizes, kind="stable")[: _COMMON_BYTES // (8 * max(1, n_chunks))]
        common = common[_COMMON * sizes[common] > n_chunks]
        self.row, self.common = np.full(n_words, -1), np.zeros((len(common), n_chunks))
        self.row[common] = np.arange(len(common))
        for n, w in enumerate(common.tolist()):
            a, b = self.starts[w], self.starts[w + 1]
            self.common[n, self.chunk[a:b]] = self.impact[a:b]
        self.read = 0

    def known(self, word: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words that occur here, their weights, their postings)."""
        sizes = self.starts[word + 1] - self.starts[word]
        here = sizes > 0
        return word[here], weight[here], sizes[here]

    def _added(self, word: np.ndarray, weight: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(chunks from `low` on, what they get) of the words' postings in chunks [low, high), word after word."""
        a, b = self.starts[word], self.starts[word + 1]
        if low > 0 or high < self.n_chunks:
            first = word.astype(np.int64) * self.n_chunks
            a, b = np.searchsorted(self.key, first + low), np.searchsorted(self.key, first + high)
        sizes, spans = b - a, [slice(*ab) for ab in zip(a.tolist(), b.tolist())]
        chunk, impact = (np.concatenate([x[s] for s in spans]) for x in (self.chunk, self.impact))
        self.read += len(chunk)
        return chunk - low if low else chunk, impact * np.repeat(weight, sizes)

    def _looked_up(self, word: np.ndarray, weight: np.ndarray, sizes: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """What some words add to the scores of some chunks."""
        self.read += int(np.minimum(sizes, len(chunks)).sum())
        row = self.row[word]
        common = row >= 0
        found = weight[common] @ self.common[row[common][:, None], chunks]
        if not common.all():
            wanted = word[~common].astype(np.int64)[:, None] * self.n_chunks + chunks
            at = np.maximum(np.searchsorted(self.key, wanted, "right") - 1, 0)
            found += weight[~common] @ np.where(self.key[at] == wanted, self.impact[at], 0.0)
        return found

    def sample(self, word: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Scores of n chunks that hold the rarest words: good ones, not always the best."""
        word, weight, sizes = self.known(word, weight)
        if not len(word):
            return np.zeros(0)
        order, more = np.argsort(sizes, kind="stable"), 2 * n + 8
        word, weight, sizes = word[order], weight[order], sizes[order]
        first = 1 + int(np.searchsorted(np.cumsum(sizes), max(2 * more, sizes.sum() * _FIRST_ROUND)))
        score = np.bincount(*self._added(word[:first], weight[:first], 0, self.n_chunks), self.n_chunks)
        chunks = np.flatnonzero(score > 0)
        if len(chunks) > more:
            chunks = chunks[np.argpartition(score[chunks], len(chunks) - more)[len(chunks) - more :]]
        found = score[chunks]
        if first < len(word):
            found = found + self._looked_up(word[first:], weight[first:], sizes[first:], chunks)
        return np.sort(found)[len(found) - min(n, len(found)) :]

    def top(self, word: np.ndarray, weight: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(chunks, scores) of all chunks that share a word with the question and score at least `reach`."""
        word, weight, sizes = self.known(word, weight)
        bounds = self.most[word] * weight[:, None]
        rest = bounds.sum(axis=0)
        alive = np.flatnonzero(rest >= reach)
        if not len(word) or not len(alive):
            return np.zeros(0, np.int64), np.zeros(0)
        blocks = slice(int(alive[0]), int(alive[-1]) + 1)
        low, high = blocks.start * self.size, min(self.n_chunks, blocks.stop * self.size)
        if reach <= 0:  # not even k chunks are known: whatever matches counts, also words that weigh nothing
            chunk, added = self._added(word, weight, low, high)
            hit = np.flatnonzero(np.bincount(chunk, minlength=high - low))
            return hit + low, np.bincount(chunk, added, high - low)[hit]
        order = np.argsort(-bounds.max(axis=1) / sizes, kind="stable")
        word, weight, sizes = word[order], weight[order], sizes[order]
        after = rest - np.cumsum(bounds[order], axis=0)  # what the words after each one can still add in a block
        enough = np.flatnonzero(after.max(axis=1) < reach)
        n = int(enough[0]) + 1 if len(enough) else len(word)
        # Without one of these words no chunk reaches the score. Whole blocks: places after the last chunk score nothing.
        places = (blocks.stop - blocks.start) * self.size
        score = np.bincount(*self._added(word[:n], weight[:n], low, high), places)
        while True:
            left = np.flatnonzero(score.reshape(-1, self.size) >= (reach - after[n - 1, blocks])[:, None])
            if n == len(word) or 2 * len(left) < sizes[n]:
                break
            score += np.bincount(*self._added(word[n : n + 1], weight[n : n + 1], low, high), places)
            n += 1
        left = left[left < high - low]
        chunks, score = left + low, score[left]
        while n < len(word) and len(chunks):
            upto = n + max(1, _LOOK_UPS // len(chunks))
            score = score + self._looked_up(word[n:upto], weight[n:upto], sizes[n:upto], chunks)
            n = min(upto, len(word))
            good = score + after[n - 1, chunks // self.size] >= reach
            chunks, score = chunks[good], score[good]
        good = score >= reach
        return chunks[good], score[good]


def question_blocks(weighted: DataFrame) -> Iterator[pd.DataFrame]:
    """(query_id, term, weight) in bounded blocks, whole questions each, one after the other.

    A table that fits a broadcast is one block; a larger one is cut by a hash of the question.
    """
    rows, size = weighted.agg(F.count("*"), F.sum(F.octet_length("term") + 64)).first()
    n = max(1, math.ceil(rows / BROADCAST_ROWS), math.ceil((size or 0) / BROADCAST_BYTES))
    columns = weighted.select("query_id", "term", "weight")
    if n == 1:
        yield columns.toPandas()
        return
    cut = columns.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n)).cast("int"))
    cut = materialize(cut, "question-blocks", ("block",))
    for block in range(n):
        yield cut.where(F.col("block") == block).drop("block").toPandas()


def by_chunk(postings: DataFrame, words: DataFrame, tasks: int) -> DataFrame:
    """One row per chunk with some of the words: its (word, tf), chunks of a shard in one partition."""
    shard = F.xxhash64(F.floor(F.col("doc_ord") / _DOCS_TOGETHER), F.floor(F.col("chunk_index") / _CHUNKS_TOGETHER))
    matched = postings.join(F.broadcast(words), "term").select(
        shard.alias("shard"), "chunk_id", "doc_ord", "chunk_index", "dl", "word", "tf"
    )
    # Grouped where they lie: equal chunks are in equal shards.
    return (
        matched.repartition(tasks, "shard")
        .groupBy("shard", "chunk_id", "doc_ord", "chunk_index", "dl")
        .agg(F.collect_list(F.struct("word", "tf")).alias("words"))
        .select("chunk_id", "doc_ord", "chunk_index", "dl", F.col("words.word").alias("word"), F.col("words.tf").alias("tf"))
    )


def _shards(batches: Iterator[pd.DataFrame], n_words: int, impact) -> Iterator[tuple[Shard, pd.DataFrame]]:
    """A partition's chunks in shards of at most about `TASK_POSTINGS` postings, with the names of their chunks."""
    parts, held = [], 0
    for batch in batches:
        # Flat arrays at once: an array object per chunk takes more room than its postings.
        word = np.concatenate(batch["word"].to_numpy()).astype(np.int32)
        tf = np.concatenate(batch["tf"].to_numpy()).astype(np.int32)
        parts.append((batch[[*_NAMES, "dl"]], batch["word"].str.len().to_numpy(np.int32), word, tf))
        held += len(word)
        del batch, word, tf
        if held >= TASK_POSTINGS:
            yield _shard(parts, n_words, impact)
            held = 0
    if held:
        yield _shard(parts, n_words, impact)


def _shard(parts: list[tuple], n_words: int, impact) -> tuple[Shard, pd.DataFrame]:
    """Takes the parts out of the list, so that they are not held beside the shard."""
    rows, sizes, word, tf = zip(*parts)
    parts.clear()
    rows = pd.concat(rows, ignore_index=True).sort_values(list(_NAMES_IN_ORDER))
    sizes, word = np.concatenate(sizes), np.concatenate(word)
    place = np.empty(len(rows), np.int32)
    place[rows.index.to_numpy()] = np.arange(len(rows), dtype=np.int32)
    dl = np.repeat(rows["dl"].sort_index().to_numpy(np.float64), sizes)
    worth = impact(np.concatenate(tf).astype(np.float64), dl)
    del tf, dl
    return Shard(word, np.repeat(place, sizes), worth, n_words, len(rows)), rows[list(_NAMES)].reset_index(drop=True)


def _sample(asked: Questions, n_words: int, n: int, impact):
    """Task body of the first round: (question, score, read)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, _ in _shards(batches, n_words, impact):
            number, scores, read = [], [], []
            for q in range(len(asked.names)):
                a, b = asked.starts[q], asked.starts[q + 1]
                shard.read = 0
                # One row even if nothing is found, for what was read.
                found = np.append(shard.sample(asked.word[a:b], asked.weight[a:b], n), 0.0)
                number.append(np.full(len(found), q))
                scores.append(found)
                read.append(np.r_[shard.read, np.zeros(len(found) - 1, np.int64)])
            yield pd.DataFrame({"question": np.concatenate(number), "score": np.concatenate(scores), "read": np.concatenate(read)})
            del shard  # not held while the next one is made

    return run


def _search(asked: Questions, n_words: int, k: int, impact, reach: np.ndarray, count: bool):
    """Task body of the second round: all chunks of a partition against a block of questions."""

    def hits_of(shard: Shard, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        waiting, held = [], 0
        for q in range(len(asked.names)):
            a, b = asked.starts[q], asked.starts[q + 1]
            chunk, score = shard.top(asked.word[a:b], asked.weight[a:b], reach[q])
            if len(chunk) > k:  # by score to nine decimals, then in insertion order
                best = np.lexsort((chunk, -np.rint(score * RANK_SCALE)))[:k]
                chunk, score = chunk[best], score[best]
            waiting.append((np.full(len(chunk), q), chunk, score))
            held += len(chunk)
            if held > 100_000 or q == len(asked.names) - 1:
                of, chunk, score = (np.concatenate(x) for x in zip(*waiting))
                made = rows.iloc[chunk].reset_index(drop=True)
                made.insert(0, "query_id", asked.names[of])
                yield made.assign(score=score)
                waiting, held = [], 0

    def work_of(shard: Shard) -> Iterator[pd.DataFrame]:
        matched, read = [], []
        for q in range(len(asked.names)):
            a, b = asked.starts[q], asked.starts[q + 1]
            shard.read = 0
            shard.top(asked.word[a:b], asked.weight[a:b], reach[q])
            matched.append(int(shard.known(asked.word[a:b], asked.weight[a:b])[2].sum()))
            read.append(shard.read)
        yield pd.DataFrame({"query_id": asked.names, "matched": matched, "read": read})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, rows in _shards(batches, n_words, impact):
            yield from work_of(shard) if count else hits_of(shard, rows)
            del shard, rows

    return run


def _reach(sampled: DataFrame, k: int, questions: int) -> np.ndarray:
    """A score that each question's k-th cannot be below; -1 where k chunks were not seen."""
    best = Window.partitionBy("question").orderBy(F.col("score").desc())
    kth = sampled.where("score > 0").withColumn("n", F.row_number().over(best)).where(F.col("n") == k)
    rows = kth.select("question", "score").toPandas()  # at most one row a question
    reach = np.full(questions, -1.0)
    reach[rows["question"].to_numpy(np.int64)] = rows["score"].to_numpy() - _SLACK
    return reach


def shard_search(weighted: DataFrame, postings: DataFrame, n_postings: int, k: int, impact, count: bool = False) -> DataFrame:
    """The best k chunks of each question and some more: (query_id, chunk_id, doc_ord, chunk_index, score).

    `weighted` is (query_id, term, weight); `impact(tf, dl)` gives the score of one posting of weight 1. Beyond a broadcast, questions come in
    blocks, one pass over the postings each. With `count`: (query_id, matched, read), postings of the question and those read, by task.
    """
    spark = weighted.sparkSession
    fields = [weighted.schema["query_id"]]
    if count:
        fields += [T.StructField(c, T.LongType()) for c in ("matched", "read")]
    else:
        fields += [postings.schema[c] for c in ("chunk_id", "doc_ord", "chunk_index")]
        fields.append(T.StructField("score", T.DoubleType()))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n_postings / TASK_POSTINGS))
    found = None
    for rows in question_blocks(weighted):
        if not len(rows):
            continue
        words = pd.Index(rows["term"].unique())
        asked = Questions.of(rows, words)
        numbered = spark.createDataFrame(pd.DataFrame({"term": words, "word": np.arange(len(words), dtype=np.int32)}), "term string, word int")
        # Written: read by both rounds, by tasks of its size and not of the shuffle's.
        chunks = materialize(by_chunk(postings, numbered, tasks), "chunk-postings")
        each = min(k, max(2, -(-4 * k // tasks)))
        sampled = chunks.mapInPandas(_sample(asked, len(words), each, impact), "question int, score double, read bigint")
        sampled = materialize(sampled, "question-sample")
        reach = _reach(sampled, k, len(asked.names))
        hits = chunks.mapInPandas(_search(asked, len(words), k, impact, reach, count), schema)
        if count:
            names = spark.createDataFrame(pd.DataFrame({"query_id": asked.names, "question": np.arange(len(asked.names), dtype=np.int32)}))
            first = sampled.groupBy("question").agg(F.sum("read").alias("read")).join(F.broadcast(names), "question")
            hits = hits.unionByName(first.select(F.col("query_id").cast(schema["query_id"].dataType), F.lit(0).cast("bigint").alias("matched"), "read"))
        # One block is left to the caller's plan; more are written one by one, so that one is held at a time.
        found = hits if found is None else materialize(found, "block-hits").unionByName(hits)
    return spark.createDataFrame([], schema) if found is None else found
