"""Shortest-pack-first packing over the histogram of lengths.

Texts become token ids and are cut into pieces of at most one sequence. Only the histogram of piece lengths, at
most `SEQUENCE` numbers, reaches the driver: lengths are placed longest first, each time into the pattern of
packs with the least in it, as many at once as length and pattern share, and into new packs when that one is full. The
result is a list of slots (length, ranks from-to, first sequence, offset). Pieces are then ranked within their
length and find their slot by rank.

Cases: a null or empty text is one piece holding the end id; repeated rows are packed each; ties in length go by
id, then start; an empty table gives an empty result; other columns are ignored by `pack` and very long
texts are cut into as many pieces as they need, none dropped.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.llm.bpe import LETTER_1, NUMBER_1, SPACE_1
from gleaner.llm.common import id_and_text, in_bulk, map_texts
from gleaner.runtime import materialize

SEQUENCE = 4096
END_ID = 2
# A length with more pieces than this, or than the total over `BUCKETS`, is cut into buckets that are ranked apart.
BUCKET_ROWS = 1_000
BUCKETS = 200_000
# Characters of texts whose words are encoded together, and of texts that are split and looked up at once.
BULK, SLICE = 16 << 20, 2 << 20
# Characters of texts that are cut into pieces together; fewer, as the stages of a pipeline share the worker's memory.
PIECES = 8 << 20
# Words and their bytes that a worker remembers from batch to batch and from task to task.
KNOWN_WORDS, KNOWN_BYTES = 1_000_000, 8 << 20
# New words that are Python objects at a time.
NEW_WORDS = 50_000


class WordTokenizer:
    """A `tokenizers` vocabulary; encodes each distinct word of a batch of Latin-1 texts once.

    The vocabulary lower-cases, drops white space, splits what stands between it by a pattern and merges within these parts,
    so a text's ids are those of its words, here all between ASCII white space, in turn. New words are encoded many in one text: the
    last id of a part is known by its word end. Texts with other characters, where normal forms may join across
    words, and texts that hold one of the vocabulary's special strings are encoded whole. What was learned is remembered, up to
    `KNOWN_WORDS`.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.special = [token.content for token in self.model.get_added_tokens_decoder().values()]
        ends = self.model.model.end_of_word_suffix
        if not ends:
            raise ValueError("the vocabulary does not mark the ends of words")
        self.closes = np.zeros(self.model.get_vocab_size(), bool)
        self.closes[[i for token, i in self.model.get_vocab().items() if token.endswith(ends)]] = True
        # The vocabulary's own split, for lower-cased texts below U+0100.
        self.parts = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER_1}]+|[{NUMBER_1}]|[^{SPACE_1}{LETTER_1}{NUMBER_1}]+"
        ).findall
        # The merges alone, for parts that are lower-cased, split and spelled in the vocabulary's letters for bytes already.
        settings = json.loads(self.model.to_str())
        settings |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(settings))
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(256) if chr(c) != " "}
        # Remembered words, and their ids as `learn` gives them.
        self.words, self.ids, self.starts = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, size): the ids of distinct word w are ids[first[w]:first[w] + size[w]]; only new words are encoded."""
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(place.is_null())
        made, starts = self.learn_all(new)
        place = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(new))
        ids, starts = np.concatenate((self.ids, made)), np.concatenate((self.starts, starts[1:] + self.starts[-1]))
        room = min(KNOWN_WORDS - len(self.words), len(new))
        # The first new words, while they are short enough together.
        chars = np.cumsum(pc.binary_length(new).to_numpy(zero_copy_only=False)) + self.words.nbytes
        room = max(0, min(room, int(np.searchsorted(chars, KNOWN_BYTES, "right"))))
        if room:
            n = len(self.words) + room
            self.words = pa.concat_arrays([self.words, new.slice(0, room)])
            self.ids, self.starts = ids[: starts[n]].copy(), starts[: n + 1].copy()
        return ids, starts[place], np.diff(starts)[place]

    def learn_all(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """What `learn` gives, `NEW_WORDS` at a time."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for at in range(0, len(words), NEW_WORDS):
            made, starts = self.learn(words.slice(at, NEW_WORDS).to_pylist())
            ids.append(made)
            sizes.append(np.diff(starts))
        return np.concatenate(ids), np.cumsum(np.concatenate(sizes))

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): the ids of word w are ids[starts[w]:starts[w + 1]]."""
        split = [(w,) if w.isalpha() else self.parts(w) for w in words]
        texts = [" ".join(chain.from_iterable(split[at : at + 500])).translate(self.spelled) for at in range(0, len(words), 500)]
        flats = [np.zeros(0, np.uint32)]
        for at in range(0, len(texts), 20):
            made = self.merges.encode_batch_fast(texts[at : at + 20], add_special_tokens=False)
            flats += [np.array(m.ids, np.uint32) for m in made]
        ids = np.concatenate(flats)
        last = np.concatenate(([0], np.flatnonzero(self.closes[ids]) + 1))
        upto = np.cumsum([0, *map(len, split)])
        if upto[-1] != len(last) - 1:
            raise ValueError("the vocabulary does not split as expected")
        return ids, last[upto]

    def plain(self, text: str) -> str | None:
        """A text in lower case; None for one that is left to the library as it is."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        text = text.lower()
        return None if any(special in text for special in self.special) else text

    def split(self, texts: list[str]) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
        """(distinct words, numbers of each slice's words, words of each text; none where a text is left to the library).

        Split and told apart by Arrow, a slice at a time; no word becomes a Python object here.
        """
        parts, lengths, sizes = [], [], np.fromiter(map(len, texts), np.int64, len(texts))
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE)) + 1).tolist(), len(texts)]
        for first, last in zip(cuts, cuts[1:]):
            words = pc.ascii_split_whitespace(pa.array([self.plain(t) for t in texts[first:last]], pa.large_string()))
            lengths.append(pc.fill_null(pc.list_value_length(words), -1).to_numpy(zero_copy_only=False))
            parts.append(words.flatten().dictionary_encode())
        shared = pa.chunked_array(parts).unify_dictionaries()
        return shared.chunk(0).dictionary, [c.indices.to_numpy() for c in shared.chunks], np.concatenate(lengths)

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; a batch of many texts encodes each of its words once."""
        if not texts:
            return
        words, numbers, lengths = self.split(texts)
        known, starts, sizes = self.known(words)
        k = 0
        for own in numbers:
            upto = np.concatenate(([0], np.cumsum(sizes[own])))
            place = np.repeat(starts[own] - upto[:-1], sizes[own])
            place += np.arange(len(place))
            ids, at = known[place], 0
            while k < len(texts) and at + max(0, lengths[k]) <= len(own):
                if lengths[k] < 0:
                    yield np.array(self.model.encode(texts[k], add_special_tokens=False).ids, np.uint32)
                else:
                    yield ids[upto[at] : upto[at + lengths[k]]]
                    at += lengths[k]
                k += 1


@lru_cache(maxsize=2)
def _kept(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenizer_of(path: str) -> WordTokenizer:
    """One per worker process, so that later tasks know the words of earlier ones; one per task where workers lack this module."""
    try:
        from gleaner.llm import packing
    except ImportError:
        return WordTokenizer(path)
    return packing._kept(path)


def pieces_of(frame: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, ids): texts cut every `sequence` ids; ids are null unless asked for."""
    end = np.array([end_id], np.uint32)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_of(tokenizer_path)
        for batch in in_bulk(batches, "text", PIECES):
            rows = []
            for key, own in zip(batch["id"].tolist(), tokenizer.batch(batch["text"].tolist()), strict=True):
                own = np.concatenate((own, end)).astype("<u4")
                for start in range(0, len(own), sequence):
                    piece = own[start : start + sequence]
                    rows.append((key, start, len(piece), zlib.crc32(piece), len(own), piece.astype(np.int32) if with_ids else None))
            yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    columns = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids array<int>"
    return map_texts(id_and_text(frame, id_col, text_col), work, columns)


@dataclass(frozen=True)
class Slot:
    """Pieces of one length and ranks [low, low + n) go to sequences first..first+packs-1, row after row of packs."""

    length: int
    low: int
    n: int
    first: int
    packs: int
    offset: int


@dataclass(frozen=True)
class Pattern:
    """A run of sequences that hold the same lengths."""

    used: int
    first: int
    packs: int


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> tuple[list[Slot], list[Pattern]]:
    """Slots for all pieces and the patterns they make, from counts by length.

    Each step handles a whole run of equal packs, so the work follows the number of lengths, not of pieces.
    """
    slots: list[Slot] = []
    heap: list[tuple[int, int, int]] = []  # (used, first sequence, packs)
    sequences = 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= sequence:
            raise ValueError(f"length {length} is outside 1..{sequence}")
        left, rank = histogram[length], 0
        while left:
            if heap and heap[0][0] + length <= sequence:
                used, first, packs = heapq.heappop(heap)
                now = min(left, packs)
                slots.append(Slot(length, rank, now, first, now, used))
                heapq.heappush(heap, (used + length, first, now))
                if now < packs:
                    heapq.heappush(heap, (used, first + now, packs - now))
            else:
                each = sequence // length
                packs, now = (left // each, left // each * each) if left >= each else (1, left)
                slots.append(Slot(length, rank, now, sequences, packs, 0))
                heapq.heappush(heap, (now // packs * length, sequences, packs))
                sequences += packs
            rank += now
            left -= now
    return slots, [Pattern(*x) for x in sorted(heap, key=lambda x: x[1])]


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Pieces with their rank within their length, from 0, by id and start.

    A length with many pieces is cut into buckets by a hash of the piece; a bucket's first rank
    is the number of pieces in the buckets before it. There are at most `BUCKETS` buckets and one more per length.
    """
    most = max(BUCKET_ROWS, -(-total // BUCKETS))
    wanted = pieces.groupBy("length").agg(F.ceil(F.count("*") / most).cast("int").alias("_buckets"))
    cut = pieces.join(F.broadcast(wanted), "length").withColumn(
        "_bucket", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.col("_buckets")).cast("int")
    )
    sizes = cut.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    floors = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_floor"))
    own = Window.partitionBy("length", "_bucket").orderBy("id", "start", "ids_crc32")
    return (
        cut.withColumn("_row", F.row_number().over(own) - 1)
        .join(floors, ["length", "_bucket"])
        .withColumn("rank", F.col("_floor") + F.col("_row"))
        .drop("_bucket", "_buckets", "_row", "_floor")
    )


def place(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces with sequence_id, offset and padded_to.

    A sequence is padded to `sequence` ids, unless what it holds is a power of two already. `pieces` should
    be a written table: it is read for the histogram and again for the ranks.
    """
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, patterns = shortest_pack_first(histogram, sequence)
    slots.sort(key=lambda s: (s.length, s.low))
    table = np.array([(s.length, s.low, s.first, s.packs, s.offset) for s in slots], np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 46) | table[:, 1]
    runs = np.array([(p.first, p.used) for p in patterns], np.int64).reshape(-1, 2)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            slot = table[np.searchsorted(keys, (length << 46) | rank, "right") - 1]
            within = rank - slot[:, 1]
            at = slot[:, 2] + within % slot[:, 3]
            used = runs[np.searchsorted(runs[:, 0], at, "right") - 1, 1]
            batch["sequence_id"] = at
            batch["offset"] = slot[:, 4] + length * (within // slot[:, 3])
            batch["padded_to"] = np.where(used & (used - 1) == 0, used, sequence)
            yield batch.drop(columns="rank")

    rows = ranked(pieces, sum(histogram.values()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("id", "rank"))
    placed = map_texts(rows, work, f"{kinds}, sequence_id bigint, offset bigint, padded_to bigint")
    return placed.select(*pieces.columns, "sequence_id", "offset", "padded_to")


def pack(frame: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset, padded_to): every piece and its place."""
    pieces = materialize(pieces_of(frame, tokenizer_path, id_col, text_col, sequence, end_id, with_ids), "pack-pieces")
    return place(pieces, sequence)
