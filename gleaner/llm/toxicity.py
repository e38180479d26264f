"""Toxicity of texts whose words may be disguised: a noisy channel undoes the disguise, then the restored text is scored.

1. A character trigram model is counted over every text of the corpus (at most ALPHABET**3 numbers).
2. Disguised words - digits or signs for letters, letters spelled apart, letters repeated - become lattices: each written
   character may stand for itself, for the letters it imitates, or for nothing. The Viterbi path under the
   character model and the channel's costs is the restored word.
3. Words, and word beginnings that several words share, are weighted by the lower confidence bound of
   their log odds between toxic and clean labelled documents. A logistic model over the strongest weights of a text gives
   its score.

The weights are fitted on at most `MAX_LABELLED` labelled rows, those with the smallest hashes; only restored text is ever
read for a score.

Cases: null and empty texts get the score of a text without evidence; repeated rows score alike, and count
once per row in the model; without labelled rows of both kinds every score is the prior (0.0 if there are none); an
empty table gives an empty result; texts are scored whole. `filter_documents` keeps the columns as they came.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import ROW, by_text_bytes, id_and_text, in_bulk, map_texts, packed, released
from gleaner.runtime import materialize

MAX_LABELLED = 20_000
MIN_TOXIC = 3
MIN_KINDS = 4  # different words that must share a beginning before it counts
PREFIXES = (3, 4, 5, 6)
DEVIATIONS = 2.5
TOP = 3
# Characters of labelled texts whose words are counted together.
COUNTED = 8 << 20

# Letters below U+0100 in lower case, and the signs that imitate letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
ALPHABET = len(LETTERS) + 1  # 0: a border
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "*": "aeiou",
}
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(256, np.int64)
for _c, _i in CODE.items():
    _TABLE[ord(_c)] = _i
    _upper = _c.upper()
    if len(_upper) == 1 and ord(_upper) < 256:
        _TABLE[ord(_upper)] = _i

# Costs of the channel, as natural logarithms.
KEEP, IMITATE, DROP_SIGN, DROP_REPEAT = -0.05, -1.5, -3.0, -0.7
#: A word border between letters spelled apart.
BORDER = -1.0
#: A restored word must be at least this likely, per letter, or the written one stays.
FLOOR = -6.0

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(IMITATES))
#: A run of letters and imitating signs; it is disguised if it has both, or a letter three times in a row (`_MAYBE`).
_RUN = re.compile(rf"(?:[^\W\d_]|[{_SIGNS}])+")
_REPEATED = re.compile(r"(.)\1{3,}", re.S)
#: Longer runs are decoded like others, but not remembered.
REMEMBERED = 80
#: Four or more single characters, the same separator between them; signs may follow the last one.
_SPELLED = re.compile(
    rf"(?<![\w{_SIGNS}])[^\W_]([\x20.\-_*])(?:[\w{_SIGNS}]\1){{2,}}(?:[^\W_]|[{_SIGNS}](?!\1))(?![{_SIGNS}]*+\w)"
)
_MAYBE = re.compile(rf"[{_SIGNS}][^\W\d_]|[^\W\d_][{_SIGNS}]|([^\W\d_])\1\1")
_DOUBLE, _LETTERS = re.compile(r"([^\W\d_])\1"), re.compile(r"[^\W\d_]*")
_ALL_DOUBLE = re.compile(r"(?:([^\W\d_])\1+){2,}")


def trigram_counts(text: str) -> np.ndarray:
    """Codes of all letter trigrams of a text; a border is a letter of its own, once."""
    flat = _TABLE[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    flat = np.concatenate(([0, 0], flat, [0]))
    a, b, c = flat[:-2], flat[1:-1], flat[2:]
    a = np.where(b == 0, 0, a)
    used = (b > 0) | (c > 0)
    return (a[used] * ALPHABET + b[used]) * ALPHABET + c[used]


def character_counts(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(code, n): letter trigrams over whole texts of all rows; at most ALPHABET**3 rows."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in by_text_bytes(batches, "text"):
            for text in batch["text"]:
                codes = trigram_counts(text)
                if len(codes) > 4096:
                    total += np.bincount(codes, minlength=len(total))
                else:
                    np.add.at(total, codes, 1)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"code": seen, "n": total[seen]})

    counts = id_and_text(frame, id_col, text_col).mapInPandas(released(work), "code bigint, n bigint")
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


@dataclass
class CharacterModel:
    """Interpolated letter trigrams: log P(letter | two before)."""

    logp: np.ndarray  # [a, b, c]

    @cached_property
    def rows(self) -> list[list[list[float]]]:
        """The same numbers where a task reads them one by one."""
        return self.logp.tolist()

    @staticmethod
    def of(codes: np.ndarray, counts: np.ndarray) -> "CharacterModel":
        tri = np.zeros(ALPHABET**3)
        tri[codes] = counts
        tri = tri.reshape(ALPHABET, ALPHABET, ALPHABET)
        bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1)) + 1.0
        p1 = uni / uni.sum()
        p2 = (bi + 5 * p1) / (bi.sum(axis=1, keepdims=True) + 5)
        p3 = (tri + 10 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 10)
        return CharacterModel(np.log(p3))

    @staticmethod
    def collect(counts: DataFrame) -> "CharacterModel":
        rows = counts.toPandas()
        return CharacterModel.of(rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.float64))


def lattice(written: str, separator: str | None = None) -> list[list[tuple[int, float]]]:
    """For each written character what it may stand for: (letter code, or 0 for nothing; cost)."""
    columns: list[list[tuple[int, float]]] = []
    chars = [c for c in written.lower() if c != separator] if separator else list(written.lower())
    for k, c in enumerate(chars):
        options: list[tuple[int, float]] = []
        if c in CODE:
            options.append((CODE[c], KEEP))
            if k and chars[k - 1] == c:
                options.append((0, DROP_REPEAT))
        else:
            options += [(CODE[x], IMITATE) for x in IMITATES.get(c, "")]
            options.append((0, DROP_SIGN))
        columns.append(options)
    return columns


def decode(written: str, model: CharacterModel, separator: str | None = None, borders: bool = False) -> str:
    """The likeliest word behind the written one, or the written one if none is likely.

    With borders, letters spelled apart may be several words. Paths are chains of (before, letter), so time and memory are linear.
    """
    logp = model.rows
    paths: dict[tuple[int, int], tuple[float, int, tuple | None]] = {(0, 0): (0.0, 0, None)}
    for options in lattice(written, separator):
        if borders:
            ends = [(x[0] + BORDER + logp[a][b][0], x[1] + 1, (x[2], 0)) for (a, b), x in paths.items() if b]
            if ends:
                paths[0, 0] = max([*ends, *([paths[0, 0]] if (0, 0) in paths else [])], key=lambda x: x[0])
        grown: dict[tuple[int, int], tuple[float, int, tuple | None]] = {}
        for (a, b), (score, size, chain) in paths.items():
            for code, cost in options:
                if code:
                    key, now, next_size, text = (b, code), score + cost + logp[a][b][code], size + 1, (chain, code)
                else:
                    key, now, next_size, text = (a, b), score + cost, size, chain
                if key not in grown or now > grown[key][0]:
                    grown[key] = (now, next_size, text)
        paths = grown
    ended = [(score + logp[a][b][0] * (b > 0), size, chain) for (a, b), (score, size, chain) in paths.items() if chain]
    if not ended:
        return written
    score, size, chain = max(ended, key=lambda x: x[0])
    if score / (size + 1) < FLOOR:
        return written
    letters = []
    while chain:
        chain, code = chain
        letters.append(LETTERS[code - 1] if code else " ")
    return "".join(reversed(letters)).strip()


class Restorer:
    """Texts with their disguised words decoded; remembers decoded words.

    `also` has further readings of the last text: spelled passages as one word, and words with double letters (which may
    be right as they are) without them.
    """

    def __init__(self, model: CharacterModel):
        self.model, self.known, self.also = model, {}, set()

    def word(self, written: str, separator: str | None = None, borders: bool = False) -> str:
        key = (written, separator, borders)
        found = self.known.get(key)
        if found is None:
            short = _REPEATED.sub(r"\1\1\1", written)
            found = decode(short, self.model, separator, borders)
            found = written if found == short else found
            self.remember(key, found)
        return found

    def remember(self, key: tuple, found: str) -> None:
        if len(key[0]) <= REMEMBERED:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = found

    def runs(self, text: str) -> str:
        """The text with its disguised runs decoded; only runs around a match of `_MAYBE` can be disguised."""
        out, done, hit = [], 0, _MAYBE.search(text)
        while hit:
            start = hit.start()
            while start > done and _RUN.match(text[start - 1]):
                start -= 1
            end = _RUN.match(text, start).end()
            out += [text[done:start], self.word(text[start:end])]
            done, hit = end, _MAYBE.search(text, end)
        return "".join([*out, text[done:]]) if out else text

    def undoubled(self, written: str) -> str | None:
        """What `decode` makes of a word of letters, none more than twice in a row; None for other words.

        Whether one of two equal letters is dropped depends on the letters around them alone, as the decoder's
        states are the last two letters: so each pair is decided by itself.
        """
        codes = [CODE.get(c, 0) for c in written.lower()]
        if 0 in codes:
            return None
        rows, kept, last = self.model.rows, [], len(codes) - 1
        a = b = 0
        score = 0.0
        for k, c in enumerate(codes):
            after = codes[k + 1] if k < last else 0
            if b == c and k and codes[k - 1] == c:
                if a == c or after == c or (k > 2 and codes[k - 2] == codes[k - 3]):
                    return None
                with_it, without = KEEP + rows[a][b][c] + rows[b][c][after], DROP_REPEAT + rows[a][b][after]
                if with_it < without:
                    score += DROP_REPEAT
                    continue
            score += KEEP + rows[a][b][c]
            kept.append(c)
            a, b = b, c
        if (score + rows[a][b][0]) / (len(kept) + 1) < FLOOR:
            return written
        return "".join([LETTERS[c - 1] for c in kept])

    def spelled(self, match: re.Match) -> str:
        self.also.add(self.word(match[0], match[1]).lower())
        return self.word(match[0], match[1], True)

    def doubled(self, text: str) -> str:
        """Words whose letters are all doubled are decoded; other words with a double letter are read both ways."""
        out, done = [], 0
        for m in _DOUBLE.finditer(text):
            start, end = m.span()
            if start < done:
                continue
            while start > done and text[start - 1].isalpha():
                start -= 1
            end = _LETTERS.match(text, end).end()
            written = text[start:end]
            reading = self.known.get((written, None, False))
            if reading is None:
                reading = self.undoubled(written)
                if reading is None:
                    reading = self.word(written)
                else:
                    self.remember((written, None, False), reading)
            if reading != written:
                if _ALL_DOUBLE.fullmatch(written.lower()):
                    out += [text[done:start], reading]
                    done = end
                    continue
                self.also.add(reading.lower())
            out.append(text[done:end])
            done = end
        return "".join([*out, text[done:]]) if out else text

    def text(self, text: str) -> str:
        self.also = set()
        text = _SPELLED.sub(self.spelled, text)
        return self.doubled(self.runs(text))

    def words(self, text: str) -> tuple[str, set[str]]:
        """The restored text, and all words of its readings."""
        restored = self.text(text)
        return restored, {*_WORD.findall(restored.lower()), *(w for x in self.also for w in _WORD.findall(x))}


@dataclass
class Weights:
    """Log-odds bounds of words and of word beginnings, and the logistic model over a text's strongest ones."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    logit: tuple[float, ...] = (-20.0,) + (0.0,) * (TOP + 1)

    def of(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        for k in PREFIXES:
            if len(word) > k:
                best = max(best, self.prefixes.get(word[:k], 0.0))
        return best


def evidence(found: list[float]) -> list[float]:
    """What the logistic model reads: the strongest weights of a text's distinct words, and their bounded sum."""
    top = sorted((x for x in found if x > 0), reverse=True)[:TOP]
    return top + [0.0] * (TOP - len(top)) + [math.log1p(sum(top))]


class Scorer:
    def __init__(self, model: CharacterModel, weights: Weights):
        self.restorer, self.weights, self.known = Restorer(model), weights, {}

    def evidence(self, text: str) -> tuple[str, list[float]]:
        restored, words = self.restorer.words(text)
        if len(self.known) > 300_000:
            self.known.clear()
        known = self.known
        for word in words.difference(known):
            known[word] = self.weights.of(word)
        found = list(filter(None, map(known.__getitem__, words)))
        return restored, evidence(found)

    def score(self, found: list[float]) -> float:
        z = self.weights.logit[0] + sum(w * x for w, x in zip(self.weights.logit[1:], found, strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def word_counts(labelled: DataFrame, model: CharacterModel) -> DataFrame:
    """(word, toxic, clean): documents of each kind that hold a restored word; labelled is (id, text, toxic)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for batch in in_bulk(batches, "text", COUNTED):  # the more texts, the fewer rows
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                for word in restorer.words(text)[1]:
                    counts.setdefault(word, [0, 0])[0 if toxic else 1] += 1
            yield pd.DataFrame(
                {"word": list(counts), "toxic": [x[0] for x in counts.values()], "clean": [x[1] for x in counts.values()]}
            )

    made = labelled.mapInPandas(released(work), "word string, toxic bigint, clean bigint")
    return made.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _bound(toxic: Column, clean: Column, toxic_docs: int, clean_docs: int) -> Column:
    """Lower confidence bound of the log odds between the two kinds of documents."""
    a, b = toxic + F.lit(0.5), clean + F.lit(0.5)
    return (
        F.log(a / F.lit(toxic_docs + 1.0)) - F.log(b / F.lit(clean_docs + 1.0))
        - F.lit(DEVIATIONS) * F.sqrt(1 / a + 1 / b)
    )


def fit(labelled: DataFrame, model: CharacterModel) -> Weights:
    """Weights from (id, text, toxic boolean); the table should be written, it is read again.

    Only words and beginnings with a positive bound reach the driver: at most a few per labelled row, whose number is bounded.
    """
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Weights(logit=(20.0 if toxic else -20.0,) + (0.0,) * (TOP + 1))
    words = materialize(word_counts(labelled, model), "toxicity-words")
    strong = (
        words.withColumn("w", _bound(F.col("toxic"), F.col("clean"), toxic, clean))
        .where((F.col("toxic") >= MIN_TOXIC) & (F.col("w") > 0))
        .select("word", "w")
    )
    # A beginning counts by what is left without its most frequent next letter - else it only stands
    # for a longer one - and only if several words share it.
    starts = (
        words.select(
            "word", "toxic", "clean",
            F.explode(F.array(*[F.when(F.length("word") > k, F.lit(k)) for k in PREFIXES])).alias("k"),
        )
        .where("k is not null")
        .groupBy(F.substring("word", F.lit(1), F.col("k")).alias("start"), F.substring("word", F.lit(1), F.col("k") + 1).alias("longer"))
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("clean").alias("clean"),
            F.count_if(F.col("toxic") > F.col("clean")).alias("kinds"),
        )
        .groupBy("start")
        .agg(
            (F.sum("toxic") - F.max("toxic")).alias("toxic"),
            F.sum("clean").alias("clean"),
            F.sum("kinds").alias("kinds"),
        )
        .where((F.col("toxic") >= MIN_TOXIC) & (F.col("kinds") >= MIN_KINDS))
        .withColumn("w", _bound(F.col("toxic"), F.col("clean"), toxic, clean))
        .where("w > 0")
        .select("start", "w")
    )
    weights = Weights(
        {r["word"]: r["w"] for r in strong.collect()}, {r["start"]: r["w"] for r in starts.collect()}
    )
    rows = _evidence_rows(labelled, model, weights).select("toxic", "found").toPandas()
    x = np.array(rows["found"].tolist(), np.float64).reshape(-1, TOP + 1)
    weights.logit = logistic(x, rows["toxic"].to_numpy(np.float64))
    return weights


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Weights (intercept first) of a ridge logistic regression by Newton steps; the rarer kind weighs as much as the other."""
    x = np.column_stack([np.ones(len(x)), x])
    share = y.mean()
    rows = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (rows * (p - y)) + penalty * w
        hessian = (x * (rows * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _evidence_rows(rows: DataFrame, model: CharacterModel, weights: Weights) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model, weights)
        for batch in by_text_bytes(batches, "text"):
            batch["found"] = [scorer.evidence(t)[1] for t in batch["text"]]
            yield batch[["id", "toxic", "found"]]

    return map_texts(rows, work, "toxic boolean, found array<double>")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text, divisible by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, text, toxic) of at most `most` labelled rows that are not held out, by smallest hash of the id.

    Conflicting labels of one id count as toxic; null labels and ids are left out.
    """
    marks = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .groupBy("id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .where(~held_out("id"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    # `most` pairs of an id and a flag: small whatever the tables.
    return id_and_text(documents, id_col, text_col).join(F.broadcast(marks), "id").dropDuplicates(["id"])


@dataclass
class ToxicityModel:
    characters: CharacterModel
    weights: Weights

    @staticmethod
    def train(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, id_col: str = "doc_id",
              text_col: str = "text") -> "ToxicityModel":
        characters = CharacterModel.collect(character_counts(documents, id_col, text_col))
        sample = materialize(labelled_sample(documents, labels, most, id_col, text_col), "toxicity-labelled")
        return ToxicityModel(characters, fit(sample, characters))

    def score(self, frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
        """(id, score, restored) of every row; restored texts are null unless asked for."""
        model, weights = self.characters, self.weights

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = Scorer(model, weights)
            for batch in by_text_bytes(batches, "text"):
                scores, texts = [], []
                for text in batch["text"]:
                    restored, found = scorer.evidence(text)
                    scores.append(scorer.score(found))
                    texts.append(restored if with_text else None)
                yield pd.DataFrame({"id": batch["id"], "score": scores, "restored": pd.Series(texts, dtype=object)})

        return map_texts(id_and_text(frame, id_col, text_col), work, "score double, restored string")

    def filter_documents(self, frame: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
        """The rows scored below the threshold, with the columns they came with."""
        model, weights = self.characters, self.weights

        def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = Scorer(model, weights)
            for texts in batches:
                yield pd.Series([scorer.score(scorer.evidence(t or "")[1]) for t in texts], dtype="float64")

        @F.pandas_udf("double")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return released(work)(batches)

        rows = packed(frame).withColumn("__score", scores(F.col(ROW)[text_col].cast("string")))
        return rows.where(F.col("__score") < threshold).select(f"{ROW}.*")
