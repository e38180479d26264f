"""Byte-level BPE over a whole collection of words by merge replay.

The distinct pieces of a slice of the corpus are laid out in one flat symbol array. An inverted index lists
the positions of each mergeable pair of symbols; the merges are applied in rank order, each visiting only the positions
listed for it and re-indexing only the two neighbours it touched. The result is the encoding of every distinct
piece, which documents look up piece by piece.

Cases: null and empty texts have no ids; repeated rows are encoded alike; other columns of the input are
ignored; very long texts are encoded whole (a batch then holds that one row).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import by_text_bytes, id_and_text, map_texts

# Unicode white space, as the pattern's \s has it; letters and numbers below U+0100.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACE_1 = "\\t-\\r \\x85\\xa0"
LETTER_1 = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
NUMBER_1 = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"

# Distinct pieces a worker remembers; beyond it the memory is emptied, not the work.
REMEMBERED = 250_000

BORDER, GONE, SHIFT, BLOCK = -1, -2, 24, 8


@dataclass(frozen=True, eq=False)
class Ranks:
    """Token bytes to rank, and back."""

    rank: dict[bytes, int]
    token: dict[int, bytes]

    def pairs(self) -> "PairTable":
        return _pairs(self)

    def byte_ids(self) -> np.ndarray:
        return np.array([self.rank[bytes([b])] for b in range(256)])

    @staticmethod
    def read(path: str) -> "Ranks":
        rank = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, value = line.split()
                    rank[base64.b64decode(token)] = int(value)
        return Ranks(rank, {v: k for k, v in rank.items()})


@dataclass(frozen=True, eq=False)
class PairTable:
    """Every pair of tokens whose joined bytes are a token, as sorted codes with that token's rank."""

    code: np.ndarray
    rank: np.ndarray
    largest: int

    def rank_of(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.rank[at], -1)


@lru_cache(maxsize=2)
def _pairs(ranks: Ranks) -> PairTable:
    rows = []
    for token, rank in ranks.rank.items():
        for cut in range(1, len(token)):
            a, b = ranks.rank.get(token[:cut]), ranks.rank.get(token[cut:])
            if a is not None and b is not None:
                rows.append(((a << SHIFT) | b, rank))
    made = np.array(sorted(rows), np.int64).reshape(-1, 2)
    return PairTable(made[:, 0].copy(), made[:, 1].copy(), max(ranks.token))


@lru_cache(maxsize=4)
def ranks_of(path: str) -> Ranks:
    return Ranks.read(path)


def splitters(pattern: str):
    """(for texts below U+0100, for all others): the pattern with its classes spelled out."""
    small = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE_1}{LETTER_1}{NUMBER_1}]")
    small = small.replace(r"\p{L}", f"[{LETTER_1}]").replace(r"\p{N}", f"[{NUMBER_1}]")
    small = small.replace(r"\S", f"[^{SPACE_1}]").replace(r"\s", f"[{SPACE_1}]")
    full = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}\\p{{L}}\\p{{N}}]")
    full = full.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    return re.compile(small), regex.compile(full)


def encode_one(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """One piece, lowest rank first: the plain definition."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], 1 << 40))
        joined = parts[best] + parts[best + 1]
        if joined not in rank:
            break
        parts[best : best + 2] = [joined]
    return [rank[p] for p in parts]


def replay(words: list[bytes], ranks: Ranks) -> list[list[int]]:
    """Ids of every word by replaying the merges over all of them together, in rank order.

    All words lie in one symbol array with links to the left and right neighbour. The inverted index is kept as
    (merged rank, position, pair) rows in blocks of ranks; a block is sorted when the replay gets there.
    """
    rank, table = ranks.rank, ranks.pairs()
    out: list[list[int] | None] = [None] * len(words)
    long = []
    for w, word in enumerate(words):
        whole = rank.get(word)
        if whole is None:
            long.append(w)
        else:
            out[w] = [whole]
    if not long:
        return out
    flat = np.frombuffer(b"".join([words[w] for w in long]), np.uint8)
    sizes = np.array([len(words[w]) for w in long])
    owner = np.repeat(np.arange(len(long)), sizes)
    at = np.arange(len(flat)) + owner + 1  # one border before each word, one at the end
    n = len(flat) + len(long) + 1
    symbol = np.full(n, BORDER, np.int64)
    symbol[at] = ranks.byte_ids()[flat]
    word_at = np.full(n, -1, np.int64)
    word_at[at] = owner
    left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
    right[-1] = n - 1

    def listed(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index rows of the pairs that start at the positions and can be merged."""
        code = (symbol[positions] << SHIFT) | symbol[right[positions]]
        code[(symbol[positions] < 0) | (symbol[right[positions]] < 0)] = -1
        merged = table.rank_of(code)
        can = merged >= 0
        return merged[can], positions[can], code[can]

    blocks: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range((table.largest >> BLOCK) + 1)]

    def file(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not rows:
            return
        merged, positions, code = (np.concatenate(x) for x in zip(*rows))
        order = np.argsort(merged, kind="stable")
        merged, positions, code = merged[order], positions[order], code[order]
        edges = np.flatnonzero(np.diff(merged >> BLOCK)) + 1
        for part in zip(np.split(merged, edges), np.split(positions, edges), np.split(code, edges)):
            if len(part[0]):
                blocks[int(part[0][0]) >> BLOCK].append(part)

    file([listed(np.arange(n - 1))])
    odd: set[int] = set()  # words where a merge makes a pair of lower or equal rank
    for block, rows in enumerate(blocks):
        if not rows:
            continue
        merged, positions, code = (np.concatenate(x) for x in zip(*rows))
        rows.clear()
        order = np.lexsort((positions, merged))
        merged, positions, code = merged[order], positions[order], code[order]
        starts = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]])
        ends = np.r_[starts[1:], len(merged)]
        agenda = {int(merged[s]): [(positions[s:e], code[s:e])] for s, e in zip(starts, ends)}
        heap = sorted(agenda)
        later = []
        while heap:
            r = heapq.heappop(heap)
            parts = agenda.pop(r)
            if len(parts) == 1:
                p, c = parts[0]
            else:
                p, first = np.unique(np.concatenate([x[0] for x in parts]), return_index=True)
                c = np.concatenate([x[1] for x in parts])[first]
            j = right[p]
            live = ((symbol[p] << SHIFT) | symbol[j]) == c
            live &= symbol[p] >= 0
            p, j = p[live], j[live]
            if not len(p):
                continue
            if len(p) > 1 and (j[:-1] == p[1:]).any():  # occurrences that overlap go from left to right
                keep, taken = [], -1
                for k, (x, y) in enumerate(zip(p.tolist(), j.tolist())):
                    if x != taken:
                        keep.append(k)
                        taken = y
                p, j = p[keep], j[keep]
            after = right[j]
            symbol[p], symbol[j] = r, GONE
            right[p], left[after] = after, p
            touched = np.concatenate((left[p], p))
            merged, positions, code = listed(touched)
            if not len(merged):
                continue
            low = merged <= r
            if low.any():
                odd.update(word_at[positions[low]].tolist())
            here = (merged >> BLOCK) == block
            if here.any():
                near = np.flatnonzero(here & ~low)
                near = near[np.argsort(merged[near], kind="stable")]
                edges = np.flatnonzero(np.diff(merged[near])) + 1
                for part in np.split(near, edges) if len(near) else ():
                    q = int(merged[part[0]])
                    if q not in agenda:
                        agenda[q] = []
                        heapq.heappush(heap, q)
                    agenda[q].append((positions[part], code[part]))
                here = ~here
                later.append((merged[here], positions[here], code[here]))
            else:
                later.append((merged, positions, code))
        file(later)
    alive = symbol >= 0
    ids, of = symbol[alive].tolist(), word_at[alive]
    edges = np.searchsorted(of, np.arange(len(long) + 1)).tolist()
    for k, w in enumerate(long):
        out[w] = ids[edges[k] : edges[k + 1]] if k not in odd else encode_one(words[w], rank)
    return out


class Pieces(dict):
    """Piece to its number, in order of first sight."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Pieces of texts to ids; remembers what it has encoded."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, (self.small, self.full) = ranks, splitters(pattern)
        self.forget()

    def forget(self) -> None:
        self.number, self.sizes, self.ids, self.decoded = Pieces(), [], [], []

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.full.findall(text)
        return self.small.findall(text)

    def batch(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        """(count, ids as text, decoded bytes) of each text, after one replay over all unknown pieces."""
        if len(self.number) > REMEMBERED:
            self.forget()
        number = self.number.__getitem__
        split = [np.fromiter(map(number, self.pieces(t)), np.int32) for t in texts]
        new = list(islice(self.number, len(self.sizes), None))
        token = self.ranks.token
        for ids in replay([p.encode("utf-8") for p in new], self.ranks):
            self.sizes.append(len(ids))
            self.ids.append(" ".join(map(str, ids)))
            self.decoded.append(b"".join(map(token.__getitem__, ids)))
        sizes = np.array(self.sizes, np.int64)
        for numbers in split:
            own = numbers.tolist()
            yield (
                int(sizes[numbers].sum()),
                " ".join(map(self.ids.__getitem__, own)),
                b"".join(map(self.decoded.__getitem__, own)),
            )


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> Encoder:
    """One per worker process, so that later tasks know the pieces of earlier ones."""
    return Encoder(ranks_of(path), pattern)


def encode_texts(frame: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = True) -> DataFrame:
    """(id, ids, n_tokens, ids_sha256, decoded, decoded_sha256) for every row; ids and decoded are null unless asked for.

    A task replays the merges over the distinct pieces of its own batches, so nothing is shuffled.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(ranks_path, pattern)
        for batch in by_text_bytes(batches, "text", 16 << 20):
            rows = []
            for count, ids, decoded in encoder.batch(batch["text"].tolist()):
                rows.append(
                    (
                        [int(i) for i in ids.split()] if with_ids else None,
                        count,
                        hashlib.sha256(ids.encode()).hexdigest(),
                        decoded.decode("utf-8", "replace") if with_ids else None,
                        hashlib.sha256(decoded).hexdigest(),
                    )
                )
            made = pd.DataFrame(rows, columns=["ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"])
            made.insert(0, "id", batch["id"].to_numpy())
            yield made

    source = id_and_text(frame, id_col, text_col)
    columns = "ids array<int>, n_tokens bigint, ids_sha256 string, decoded string, decoded_sha256 string"
    return map_texts(source, work, columns)


def decode_ids(frame: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): ids back to text; null ids give an empty text, unknown ids an error."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = ranks_of(ranks_path).token
        for batch in batches:
            texts = [
                b"".join(token[int(i)] for i in ids).decode("utf-8", "replace") if ids is not None else ""
                for ids in batch["ids"]
            ]
            yield pd.DataFrame({"id": batch["id"], "text": texts})

    source = frame.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_texts(source, work, "text string")
