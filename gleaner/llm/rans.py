"""Token ids as binary files: static range asymmetric numeral systems over one shared frequency table.

The ids of all documents are counted, and their counts are scaled to 2^`BITS`: one table for all files. Documents are sorted by
id and cut into blocks of about `BLOCK_IDS` ids. A block is coded by itself: its ids are dealt to `LANES` interleaved
coders, and after every `STEPS` ids of each lane there is a checkpoint, which holds the state of every lane, the place of the
next word and a checksum of the ids up to the next checkpoint. Any checkpoint is a place to start reading, so the
segments of a block are decoded side by side, one numpy operation for all lanes of all of them, and blocks and files
are decoded by different tasks.

Files (numbers are little-endian). A folder holds `table/`, one file, and `ids/`, files of blocks in no particular order.
  table   "RTAB", bits u32, symbols u32, frequency u32 of each symbol, checksum u32 of all before
  block   "RBLK", version u16, lanes u16, steps u32, bytes u64 (of the whole block), checksum of the table u32, part u32, sequence u32,
          documents u32, ids u64, words u64; of each document: id i64, number of ids u64, null marks (a bit each);
          of each segment: first word u64, checksum u32, states u64 of its lanes; words u32; checksum u32 of all before
  A block is followed by one line feed. (part, sequence) is the order of blocks; places of documents follow from their sizes.

A lane's state lies in [2^31, 2^63) and gives off or takes in words of 32 bits. Files are written and read by Spark's own writers
and readers, so they may lie wherever Spark can write; a lost task is written again, byte for byte.

Cases: null and empty texts hold the end id; null ids come first; repeated ids go by size, then checksum; an empty table makes
a table file and no block; other columns are ignored; a very long text is one block of many segments, coded some at a
time. A damaged file, a block of another table and ids that are no whole numbers are errors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import id_and_text, in_bulk
from gleaner.llm.packing import BULK, tokenizer_of
from gleaner.runtime import materialize

END_ID = 1
BITS = 20
LANES, STEPS = 32, 256
BLOCK_IDS, BLOCKS_A_FILE = 1 << 20, 32
# Ids of one write task, and segments that are coded side by side.
TASK_IDS, SIDE_BY_SIDE = 32 << 20, 128

VERSION = 1
_HEADER = "<4sHHIQIIIIQQ"
_HEADER_BYTES = struct.calcsize(_HEADER)
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS = np.uint64(BITS)
_SLOTS = np.uint64((1 << BITS) - 1)


class DamagedFile(ValueError):
    """Bytes that are no block of the table at hand."""


# The table ---------------------------------------------------------------------------


def scaled(counts: np.ndarray, total: int = 1 << BITS) -> np.ndarray:
    """Frequencies that add up to `total`, at least 1 for every symbol that occurs."""
    seen = np.flatnonzero(counts)
    if not len(seen):
        return np.zeros(len(counts), np.uint32)
    if len(seen) > total // 2:
        raise ValueError(f"{len(seen)} symbols are too many for {total} slots")
    exact = counts[seen].astype(np.float64) * total / counts[seen].sum()
    shares = np.maximum(1, np.floor(exact)).astype(np.int64)
    # What rounding left over or took too much is settled by the most frequent symbols, which feel it least.
    order = np.argsort(-shares, kind="stable")
    while left := total - int(shares.sum()):
        step = np.maximum(1, shares[order] // 64)
        room = step if left > 0 else np.minimum(step, shares[order] - 1)
        upto = np.minimum(np.cumsum(room), abs(left))
        shares[order] += np.sign(left) * np.diff(upto, prepend=0)
    made = np.zeros(len(counts), np.uint32)
    made[seen] = shares
    return made


@dataclass(frozen=True, eq=False)
class Table:
    """Frequencies shared by all blocks."""

    freq: np.ndarray

    @cached_property
    def wide(self) -> np.ndarray:
        return self.freq.astype(np.uint64)

    @cached_property
    def low(self) -> np.ndarray:
        """First slot of each symbol."""
        return np.cumsum(self.wide) - self.wide

    @cached_property
    def symbol(self) -> np.ndarray:
        """The symbol of each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)

    @cached_property
    def common(self) -> int:
        return int(np.argmax(self.freq))

    @cached_property
    def checksum(self) -> int:
        return zlib.crc32(self.to_bytes()[:-4])

    def to_bytes(self) -> bytes:
        body = struct.pack("<4sII", b"RTAB", BITS, len(self.freq)) + self.freq.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Table":
        if len(data) < 16 or data[:4] != b"RTAB" or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise DamagedFile("not a frequency table")
        bits, n = struct.unpack_from("<II", data, 4)
        if bits != BITS or len(data) != 16 + 4 * n:
            raise DamagedFile("a frequency table of another kind")
        return cls(np.frombuffer(data, "<u4", n, 12).astype(np.uint32))


# Segments ---------------------------------------------------------------------------


def _encode_side_by_side(ids: np.ndarray, table: Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """(states, words of each segment) of ids[segment, step, lane], from the last step to the first."""
    segments, steps, lanes = ids.shape
    freq, low = table.wide[ids], table.low[ids]
    state = np.full((segments, lanes), _LOW)
    words, given = np.empty(ids.shape, np.uint32), np.empty(ids.shape, bool)
    most = freq << np.uint64(63 - BITS)
    for t in range(steps - 1, -1, -1):
        f = freq[:, t]
        over = state >= most[:, t]
        words[:, t], given[:, t] = state, over  # the lower 32 bits
        state = np.where(over, state >> _WORD, state)
        whole = state // f
        state = (whole << _BITS) + (state - whole * f) + low[:, t]
    return state, [w[g] for w, g in zip(words, given)]


def _decode_side_by_side(words: np.ndarray, at: np.ndarray, state: np.ndarray, steps: int, table: Table) -> np.ndarray:
    """ids[segment, step, lane], each segment reading `words` from its own place."""
    segments, lanes = state.shape
    state, at = state.copy(), at.copy()
    ids = np.empty((segments, steps, lanes), np.uint32)
    symbol, freq, low = table.symbol, table.wide, table.low
    for t in range(steps):
        slot = state & _SLOTS
        s = symbol[slot]
        ids[:, t] = s
        state = freq[s] * (state >> _BITS) + slot - low[s]
        hungry = state < _LOW
        taken = np.cumsum(hungry, axis=1)
        place = (at[:, None] + taken - 1)[hungry]
        if len(place):
            if place.max() >= len(words):
                raise DamagedFile("words run out")
            state[hungry] = (state[hungry] << _WORD) | words[place]
        at += taken[:, -1]
    if (state != _LOW).any():
        raise DamagedFile("a lane did not come back to where its coder began")
    return ids


# Blocks ---------------------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class Block:
    """A block as it lies in a file, its parts found but not decoded."""

    part: int
    sequence: int
    lanes: int
    steps: int
    ids: int
    doc_ids: np.ndarray
    null: np.ndarray
    sizes: np.ndarray
    first_word: np.ndarray
    checksums: np.ndarray
    states: np.ndarray
    words: np.ndarray

    @property
    def segment_ids(self) -> int:
        return self.lanes * self.steps

    def decode(self, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids at [first, last) of the block; only segments that hold some of them are decoded."""
        last = self.ids if last is None else min(last, self.ids)
        if first >= last:
            return np.zeros(0, np.uint32)
        size, found = self.segment_ids, []
        begin, end = first // size, -(-last // size)
        for a in range(begin, end, SIDE_BY_SIDE):
            b = min(end, a + SIDE_BY_SIDE)
            ids = _decode_side_by_side(self.words, self.first_word[a:b], self.states[a:b], self.steps, table).reshape(b - a, -1)
            for k, row in enumerate(ids, a):
                row = row[: self.ids - k * size]
                if zlib.crc32(row.astype("<u4")) != self.checksums[k]:
                    raise DamagedFile(f"segment {k} of block {self.part}.{self.sequence} has another checksum")
                found.append(row)
        return np.concatenate(found)[first - begin * size : last - begin * size]


def encode_block(doc_ids: list[int | None], docs: list[np.ndarray], table: Table, part: int = 0, sequence: int = 0) -> bytes:
    """A block of whole documents."""
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    if len(ids) and (ids.max() >= len(table.freq) or not table.freq[ids].all()):
        raise ValueError("an id is not in the table")
    lanes = LANES
    steps = min(STEPS, max(1, -(-len(ids) // lanes)))
    size = lanes * steps
    segments = -(-len(ids) // size)
    states, words, checksums = [], [], []
    for a in range(0, segments, SIDE_BY_SIDE):
        own = ids[a * size : (a + SIDE_BY_SIDE) * size]
        checksums += [zlib.crc32(own[k : k + size].astype("<u4")) for k in range(0, len(own), size)]
        filled = np.full(-(-len(own) // size) * size, table.common, np.uint32)
        filled[: len(own)] = own
        end, given = _encode_side_by_side(filled.reshape(-1, steps, lanes), table)
        states.append(end)
        words += given
    counts = np.array([len(w) for w in words], np.int64)
    marks = np.zeros(segments, np.dtype([("first", "<u8"), ("check", "<u4"), ("state", "<u8", (lanes,))]))
    if segments:
        marks["first"], marks["check"], marks["state"] = np.cumsum(counts) - counts, checksums, np.concatenate(states)
    directory = np.zeros(len(docs), np.dtype([("id", "<i8"), ("size", "<u8")]))
    directory["id"] = [i if i is not None else 0 for i in doc_ids]
    directory["size"] = [len(d) for d in docs]
    null = np.packbits(np.array([i is None for i in doc_ids], bool))
    body = [directory.tobytes(), null.tobytes(), marks.tobytes(), *[w.astype("<u4").tobytes() for w in words]]
    length = _HEADER_BYTES + sum(map(len, body)) + 4
    header = struct.pack(
        _HEADER, b"RBLK", VERSION, lanes, steps, length, table.checksum, part, sequence, len(docs), len(ids), int(counts.sum())
    )
    whole = b"".join([header, *body])
    return whole + struct.pack("<I", zlib.crc32(whole))


def blocks_in(data: bytes, table: Table) -> Iterator[Block]:
    """The blocks of a file."""
    at = 0
    while at < len(data):
        if len(data) - at < _HEADER_BYTES:
            raise DamagedFile("a block is cut short")
        magic, version, lanes, steps, length, check, part, sequence, n_docs, n_ids, n_words = struct.unpack_from(_HEADER, data, at)
        if magic != b"RBLK" or version != VERSION:
            raise DamagedFile(f"no block of version {VERSION} at byte {at}")
        if at + length >= len(data) or length < _HEADER_BYTES + 4 or data[at + length] != 10:
            raise DamagedFile("a block is cut short")
        whole = memoryview(data)[at : at + length]
        if zlib.crc32(whole[:-4]) != struct.unpack("<I", whole[-4:])[0]:
            raise DamagedFile(f"block {part}.{sequence} has another checksum")
        if check != table.checksum:
            raise DamagedFile(f"block {part}.{sequence} was coded with another table")
        segments = -(-n_ids // (lanes * steps))
        place = at + _HEADER_BYTES
        directory = np.frombuffer(data, np.dtype([("id", "<i8"), ("size", "<u8")]), n_docs, place)
        place += directory.nbytes
        null = np.unpackbits(np.frombuffer(data, np.uint8, -(-n_docs // 8), place), count=n_docs).astype(bool)
        place += -(-n_docs // 8)
        marks = np.frombuffer(data, np.dtype([("first", "<u8"), ("check", "<u4"), ("state", "<u8", (lanes,))]), segments, place)
        place += marks.nbytes
        words = np.frombuffer(data, "<u4", n_words, place)
        yield Block(
            part, sequence, lanes, steps, n_ids, directory["id"].astype(np.int64), null, directory["size"].astype(np.int64),
            marks["first"].astype(np.int64), marks["check"].astype(np.int64), marks["state"].astype(np.uint64), words,
        )
        at += length + 1


# Spark ---------------------------------------------------------------------------


def token_ids(frame: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """(id bigint, n, crc, ids, counts) of every row: the text's ids and the end id, as unsigned 16 or 32-bit numbers.

    Two bytes an id where the vocabulary allows; `crc` is of 32-bit numbers either way. A task's last row has no ids (`n` is null)
    but `counts`: how often it met each id, as unsigned 64-bit numbers.
    """
    kind = frame.schema[id_col].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"ids are whole numbers, not {kind.simpleString()}")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_of(tokenizer_path)
        size = max(tokenizer.model.get_vocab_size(), end_id + 1)
        narrow, counts = "<u2" if size <= 1 << 16 else "<u4", np.zeros(size, "<u8")
        for batch in in_bulk(batches, "text", BULK):
            sizes, checks, made = [], [], []
            for ids in tokenizer.batch(batch["text"].tolist()):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                sizes.append(len(ids))
                checks.append(zlib.crc32(ids))
                made.append(ids.astype(narrow).tobytes())
            counts += np.bincount(np.frombuffer(b"".join(made), narrow), minlength=size).astype("<u8")
            yield pd.DataFrame({"id": batch["id"], "n": sizes, "crc": checks, "ids": made, "counts": None})
        if counts.any():
            yield pd.DataFrame({"id": [None], "n": pd.array([None], "Int64"), "crc": pd.array([None], "Int64"), "ids": [None], "counts": [counts.tobytes()]})

    texts = id_and_text(frame, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    found = texts.mapInPandas(work, "id string, n bigint, crc bigint, ids binary, counts binary")
    return found.withColumn("id", F.col("id").cast("bigint"))


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype(np.uint32)


def count_ids(tokens: DataFrame) -> DataFrame:
    """(token, n) over all documents, from the counts that each task left behind its rows."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch["counts"]:
                own = np.frombuffer(data, "<u8").astype(np.int64)
                total = own + total if len(total) else own
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"token": seen, "n": total[seen]})

    parts = tokens.where("counts is not null").select("counts").mapInPandas(work, "token bigint, n bigint")
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def table_of(tokens: DataFrame) -> Table:
    """The shared table; at most one number per symbol of the vocabulary comes to the driver."""
    rows = count_ids(tokens).toPandas()
    counts = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["token"].to_numpy(np.int64)] = rows["n"]
    return Table(scaled(counts))


def _binary(rows: DataFrame, column: str, path: str, rows_a_file: int) -> None:
    """Write a binary column as files, each value followed by a line feed."""
    writer = rows.select(F.col(column).cast("string").alias("value")).write.option("maxRecordsPerFile", rows_a_file)
    writer.option("compression", "none").text(path)


def write_ids(tokens: DataFrame, path: str, table: Table | None = None, block_ids: int = BLOCK_IDS,
              blocks_a_file: int = BLOCKS_A_FILE) -> Table:
    """Write what `token_ids` gave as files below `path`, in ascending order of id; `tokens` should be a written table."""
    spark = tokens.sparkSession
    table = table or table_of(tokens)
    coded = table.to_bytes()
    _binary(spark.createDataFrame([(bytearray(coded),)], "data binary"), "data", f"{path}/table", 1)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shared, part, sequence = Table.from_bytes(coded), TaskContext.get().partitionId(), 0
        names, docs, held = [], [], 0
        for batch in batches:
            for name, n, data in zip(batch["id"], batch["n"], batch["ids"]):
                names.append(None if name is None else int(name))
                docs.append(_numbers(data, n))
                held += n
                if held >= block_ids:
                    yield pd.DataFrame({"block": [encode_block(names, docs, shared, part, sequence)]})
                    sequence += 1
                    names, docs, held = [], [], 0
        if docs:
            yield pd.DataFrame({"block": [encode_block(names, docs, shared, part, sequence)]})

    total = tokens.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_IDS))
    order = ["id", "n", "crc"]
    # Rows of one id are dealt by size and checksum as well, so an id that repeats is not one task's.
    dealt = tokens.where("n is not null").drop("counts").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    sent = dealt.select(F.col("id").cast("string").alias("id"), "n", "ids")
    _binary(sent.mapInPandas(work, "block binary"), "block", f"{path}/ids", blocks_a_file)
    return table


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/table").select("content").collect()
    if len(rows) != 1:
        raise DamagedFile(f"{path} has {len(rows)} tables")
    return Table.from_bytes(bytes(rows[0]["content"])[:-1])


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document in the files; `start` counts the ids of all before it.

    Every task decodes whole files by itself. Places follow from the sizes of blocks: per write task, then within it.
    """
    coded = read_table(spark, path).to_bytes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table.from_bytes(coded)
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"]):
                try:
                    for block in blocks_in(data, table):
                        yield read_block(block, table)
                except DamagedFile as error:
                    raise DamagedFile(f"{file}: {error}") from error

    def read_block(block: Block, table: Table) -> pd.DataFrame:
        ids, upto = block.decode(table).astype("<u4"), np.cumsum(block.sizes)
        docs = [ids[b - n : b] for b, n in zip(upto.tolist(), block.sizes.tolist())]
        return pd.DataFrame(
            {
                "part": block.part,
                "sequence": block.sequence,
                "id": [None if no else str(i) for i, no in zip(block.doc_ids.tolist(), block.null.tolist())],
                "within": upto - block.sizes,
                "n_tokens": block.sizes,
                "ids_crc32": [zlib.crc32(d) for d in docs],
                "ids": [d.astype(np.int32) if with_ids else None for d in docs],
            }
        )

    columns = "part int, sequence int, id string, within bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    except Exception as error:
        raise FileNotFoundError(f"no token files in {path}") from error
    rows = files.select("path", "content").mapInPandas(work, columns)
    rows = materialize(rows.withColumn("id", F.col("id").cast("bigint")), "token-rows")
    blocks = rows.groupBy("part", "sequence").agg(F.sum("n_tokens").alias("size"))
    parts = blocks.groupBy("part").agg(F.sum("size").alias("size"))
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per write task of the files, then one per block of a write task.
    parts = parts.select("part", before(Window.orderBy("part")).alias("base"))
    blocks = blocks.select("part", "sequence", before(Window.partitionBy("part").orderBy("sequence")).alias("ahead"))
    places = blocks.join(F.broadcast(parts), "part").select("part", "sequence", (F.col("base") + F.col("ahead")).alias("floor"))
    return rows.join(places, ["part", "sequence"]).select(
        "id", (F.col("floor") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
