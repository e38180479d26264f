"""Fill-in-middle transformation by memoized content-defined chunks.

A rolling hash over the last `WINDOW` bytes proposes borders, so a passage that many documents share is cut into
the same chunks wherever it stands. For each chunk a task remembers a boundary summary: whether it begins and ends inside
a word, how many words end within it, and where, in bytes and in code points. A remembered chunk counts only if its
bytes are equal, not just its hash. A document is never scanned for words as a whole: the counts of its chunks are added
up, a word that runs over a border counting once, and the chunk that holds the wanted word end gives the cut.

A unit is white space followed by a word, or the white space at the end of a text. Two cuts, drawn from a digest of seed and id,
part the n units into prefix, middle and suffix; further digits choose between plain, suffix-prefix-middle and
prefix-suffix-middle order. The digest depends on nothing else, so a recomputed task gives the same rows.

Cases: null and empty texts have no units and stay plain; a text that holds one of the marks stays plain; a null id is
drawn as the empty string; repeated rows are cut alike; texts without a border in the hash are cut every `LONGEST`
bytes; very long texts are hashed in portions and their chunks are found one after the other; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import by_text_bytes, id_and_text, map_texts

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Shares, in percent: of documents that are transformed, and of these in suffix-prefix-middle order.
TRANSFORMED, SPM = 50, 80
# Bytes that the rolling hash sees, sizes of chunks, and the bits of the hash that are zero at a border.
WINDOW, SHORTEST, LONGEST, ZERO_BITS = 32, 64, 4_096, 8
# Bytes of chunks and summaries that a task remembers; beyond it the memory is emptied, not the work.
REMEMBERED = 32 << 20
PORTION = 1 << 20

_MIX = np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint32)
# The six white-space characters of ASCII.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def borders(data: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last `WINDOW` bytes ends in zeros.

    Byte b counts _MIX[b] << age, so bytes that left the window have left the 32 bits. The sums of 1, 2, 4, ... bytes
    are built from those of half as many, a portion at a time.
    """
    found = []
    for at in range(0, len(data), PORTION):
        low = max(0, at - WINDOW + 1)
        total = _MIX[data[low : at + PORTION]]
        width = 1
        while width < WINDOW:
            total[width:] = total[width:] + (total[:-width] << np.uint32(width))
            width *= 2
        hit = np.flatnonzero(total >> np.uint32(32 - ZERO_BITS) == 0) + low + 1
        found.append(hit[hit > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(size: int, proposed: list[int], low: int) -> list[int]:
    """Ends, relative to `low`, of the chunks of a text at [low, low + size) of what was hashed.

    No chunk but the last is shorter than `SHORTEST`, which is no less than `WINDOW`: a border is never decided by bytes in front of its chunk.
    """
    ends, at = [], 0
    while size - at > SHORTEST:
        k = bisect_left(proposed, low + at + SHORTEST)
        end = proposed[k] - low if k < len(proposed) else size
        at = min(end, at + LONGEST, size)
        ends.append(at)
    if at < size:
        ends.append(size)
    return ends


@dataclass(frozen=True, eq=False)
class Summary:
    """What a chunk tells its document."""

    content: bytes
    chars: int
    opens_in_word: bool
    closes_in_word: bool
    # Ends of words inside the chunk (not at its own end), in bytes and in code points.
    ends: np.ndarray
    char_ends: np.ndarray


def summary_of(content: bytes) -> Summary:
    data = np.frombuffer(content, np.uint8)
    space = _SPACE[data]
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    if content.isascii():
        chars, char_ends = len(content), ends
    else:
        starts = np.cumsum((data & 0xC0) != 0x80)
        chars, char_ends = int(starts[-1]), starts[ends - 1]
    return Summary(content, chars, not space[0], not space[-1], ends, char_ends)


class Memory:
    """Summaries of the chunks a task has met, within a bound of bytes."""

    def __init__(self, most: int = REMEMBERED):
        self.known: dict[int, Summary] = {}
        self.most, self.held = most, 0
        self.asked = self.found = 0

    def __call__(self, content: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(content)
        self.asked += 1
        old = self.known.get(key)
        if old is not None and old.content == content:
            self.found += 1
            return old
        made = summary_of(content)
        if old is None:  # of two chunks with one hash the first is remembered
            cost = 400 + len(content) + made.ends.nbytes * (1 if made.char_ends is made.ends else 2)
            if self.held + cost > self.most:
                self.known.clear()
                self.held = 0
            self.known[key] = made
            self.held += cost
        return made


class Located:
    """A text as a row of chunk summaries: its number of units and the place of each unit's end."""

    def __init__(self, parts: list[Summary]):
        self.parts = parts
        # A word that closes one chunk while the next opens with white space ends between the two.
        self.between = [a.closes_in_word and not b.opens_in_word for a, b in zip(parts, parts[1:])]
        counts = np.array([len(p.ends) for p in parts], np.int64)
        counts[1:] += np.array(self.between, np.int64)
        self.upto = np.cumsum(counts)
        self.bytes_before = np.cumsum([0, *[len(p.content) for p in parts]])
        self.chars_before = np.cumsum([0, *[p.chars for p in parts]])
        self.units = int(self.upto[-1]) + 1 if parts else 0  # and the word or white space at the end

    def end_of(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) up to the end of the first `unit` units."""
        if unit <= 0:
            return 0, 0
        if unit >= self.units:
            return int(self.bytes_before[-1]), int(self.chars_before[-1])
        k = int(np.searchsorted(self.upto, unit))
        nth = unit - (int(self.upto[k - 1]) if k else 0)
        if k and self.between[k - 1]:
            nth -= 1
        if nth == 0:
            return int(self.bytes_before[k]), int(self.chars_before[k])
        part = self.parts[k]
        return int(self.bytes_before[k] + part.ends[nth - 1]), int(self.chars_before[k] + part.char_ends[nth - 1])


def draws(doc_id: str | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits from the digest of `seed:id`."""
    digits = hashlib.sha256(f"{seed}:{doc_id if doc_id is not None else ''}".encode()).digest()
    return [int.from_bytes(digits[k : k + 4], "big") for k in range(0, 16, 4)]


@dataclass(frozen=True)
class Marks:
    prefix: str = PREFIX
    suffix: str = SUFFIX
    middle: str = MIDDLE

    def __post_init__(self) -> None:
        """A mark opens with a sign that it does not hold again, so no mark can begin in a text and end in a mark."""
        marks = [self.prefix, self.suffix, self.middle]
        first = {m[:1] for m in marks}
        if len(set(marks)) < 3 or len(first) > 1 or any(len(m) < 2 or m.count(m[0]) > 1 for m in marks):
            raise ValueError("marks are three different texts that open with the same sign and hold it once")
        if any(a != b and a.startswith(b) for a in marks for b in marks):
            raise ValueError("no mark may begin another")

    def within(self, text: str) -> bool:
        return self.prefix in text or self.suffix in text or self.middle in text


def transform(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: Marks = Marks(), seed: int = SEED,
              transformed: int = TRANSFORMED, spm: int = SPM) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row; the two sizes are null where the form is plain."""

    def rows_of(batch: pd.DataFrame, remembered: Memory) -> Iterator[tuple]:
        coded = [t.encode("utf-8") for t in batch["text"]]
        flat = b"".join(coded)
        proposed = borders(np.frombuffer(flat, np.uint8)).tolist()
        low = 0
        for key, text, data in zip(batch["id"], batch["text"], coded, strict=True):
            at, parts = 0, []
            for end in chunk_ends(len(data), proposed, low):
                parts.append(remembered(data[at:end]))
                at = end
            low += len(data)
            where = Located(parts)
            n, (h1, h2, h3, h4) = where.units, draws(key, seed)
            if not data or h3 % 100 >= transformed or marks.within(text):
                yield key, n, "plain", None, None, text
                continue
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            (a, a_chars), (b, b_chars) = where.end_of(first), where.end_of(second)
            before, held, rest = (x.decode("utf-8") for x in (data[:a], data[a:b], data[b:]))
            if h4 % 100 < spm:
                form, made = "spm", (marks.suffix, rest, marks.prefix, before, marks.middle, held)
            else:
                form, made = "psm", (marks.prefix, before, marks.suffix, rest, marks.middle, held)
            yield key, n, form, a_chars, b_chars - a_chars, "".join(made)

    columns = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembered = Memory()
        for batch in by_text_bytes(batches, "text", 4 << 20):
            made = pd.DataFrame(list(rows_of(batch, remembered)), columns=columns)
            yield made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    source = id_and_text(frame, id_col, text_col)
    return map_texts(source, work, "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made from, as a column expression.

    A text that holds a mark is plain, so in the two other forms each mark occurs once.
    """
    after = lambda mark: F.substring_index(output, mark, -1)
    upto = lambda text, mark: F.substring_index(text, mark, 1)
    middle = after(marks.middle)
    psm = F.concat(upto(after(marks.prefix), marks.suffix), middle, upto(after(marks.suffix), marks.middle))
    spm = F.concat(upto(after(marks.prefix), marks.middle), middle, upto(after(marks.suffix), marks.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
