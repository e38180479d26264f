"""Chat formatting: typed content parts become one text with ordered placeholders.

A visitor has one method per kind of part. `flatten` walks a turn's parts in order and lets the visitor say what each
becomes: text is escaped, an image, audio or document becomes a placeholder numbered within its turn, together with
the attachment it refers to and the number of tokens it expands to. Turns are wrapped in control strings; the same
strings inside texts are escaped, so that a formatted conversation can be read back exactly. All of this is
expressions of one row; nothing is shuffled before the turns are put in order.

A part is a struct (kind, text, ref, width, height, seconds, pages). Control strings begin with "<"; in texts "\\" and "<" get
a "\\" before them.

Cases: null or empty texts are empty parts; turns without parts are empty turns; parts of an unknown or null kind are an error;
missing sizes count as zero; turns without a conversation id are one conversation; null roles read "unknown" and roles may hold any text; ties in turn number go by role,
then text; repeated rows are repeated turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
TURN_OPEN, TURN_MID, TURN_CLOSE = "<turn:", ">", "</turn>"
TRAINED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\<"))


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PartVisitor:
    """What each kind of part becomes. Every method gets the part and its number among the turn's attachments."""

    PATCH = 28
    AUDIO_TOKENS_A_SECOND = 25
    TOKENS_A_PAGE = 1_500

    def text(self, part: Column, number: Column) -> Column:
        return self.made(escape(F.coalesce(part["text"], F.lit(""))), F.lit(0))

    def image(self, part: Column, number: Column) -> Column:
        across = lambda side: F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(self.PATCH))
        return self.placeholder("image", number, across("width") * across("height"))

    def audio(self, part: Column, number: Column) -> Column:
        seconds = F.coalesce(part["seconds"], F.lit(0.0))
        return self.placeholder("audio", number, F.ceil(seconds * F.lit(self.AUDIO_TOKENS_A_SECOND)))

    def document(self, part: Column, number: Column) -> Column:
        return self.placeholder("document", number, F.coalesce(part["pages"], F.lit(0)) * F.lit(self.TOKENS_A_PAGE))

    def placeholder(self, kind: str, number: Column, tokens: Column) -> Column:
        return self.made(F.concat(F.lit(f"<{kind}:"), number.cast("string"), F.lit(">")), tokens)

    def made(self, text: Column, tokens: Column) -> Column:
        return F.struct(text.alias("text"), tokens.cast("bigint").alias("tokens"))

    def visit(self, part: Column, number: Column) -> Column:
        """Dispatch on the kind."""
        chosen = None
        for kind in ("text", "image", "audio", "document"):
            test, made = part["kind"] == kind, getattr(self, kind)(part, number)
            chosen = F.when(test, made) if chosen is None else chosen.when(test, made)
        return chosen.otherwise(
            F.raise_error(F.concat(F.lit("unknown kind of part: "), F.coalesce(part["kind"], F.lit("null"))))
        )


def flatten(parts: Column, visitor: PartVisitor | None = None) -> tuple[Column, Column]:
    """(text of a turn, its attachments array<struct<number, kind, ref, tokens>>)."""
    visitor = visitor or PartVisitor()
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: F.coalesce(p["kind"], F.lit("")) != "text")
    number = lambda k: F.size(F.filter(F.slice(parts, 1, k), lambda p: F.coalesce(p["kind"], F.lit("")) != "text"))
    visited = F.transform(parts, lambda p, k: visitor.visit(p, number(k)))
    text = F.array_join(F.transform(visited, lambda v: v["text"]), "")
    attachments = F.transform(
        attached,
        lambda p, k: F.struct(
            k.alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), visitor.visit(p, k)["tokens"].alias("tokens")
        ),
    )
    return text, attachments


def text_part(text: Column) -> Column:
    """A text as the only part of a turn."""
    null = lambda kind: F.lit(None).cast(kind)
    part = F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"), null("string").alias("ref"), null("int").alias("width"),
        null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"),
    )
    return F.array(part)


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None, trained: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """(conv_id, turn, role, formatted, loss_start, loss_end, attachments) from (conv_id, turn, role, parts).

    A conversation's text is the concatenation of its turns in order; the loss mask [loss_start, loss_end) of a turn is in code
    points of `formatted` and covers exactly the text of trained roles.
    """
    text, attachments = flatten(F.col("parts"), visitor)
    role = F.coalesce(F.col("role").cast("string"), F.lit("unknown"))
    rows = turns.select(
        "conv_id", "turn", role.alias("role"), F.inline(F.array(F.struct(text.alias("__text"), attachments.alias("attachments"))))
    )
    head = F.concat(F.lit(TURN_OPEN), F.replace(escape(F.col("role")), F.lit(">"), F.lit("\\>")), F.lit(TURN_MID))
    start = F.when(F.col("role").isin(*trained), F.length(head))
    return rows.select(
        "conv_id", "turn", "role",
        F.concat(head, F.col("__text"), F.lit(TURN_CLOSE)).alias("formatted"),
        start.alias("loss_start"),
        (start + F.length("__text")).alias("loss_end"),
        "attachments",
    )


_TURN = re.compile(r"<turn:((?:[^\\>]++|\\.)*+)>((?:[^\\<]++|\\.|<(?:image|audio|document):[0-9]+>)*+)</turn>", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text; placeholders stay in the text."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a turn at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")
    return found


def in_order(formatted: DataFrame) -> DataFrame:
    """Formatted turns with each conversation together and its turns in order, one after the other in a partition.

    A conversation is streamed, never gathered: readers hold one batch of its turns, however long it is.
    """
    partitions = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return formatted.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): what the formatted turns say.

    Digests run over a conversation from its first turn to its last, so each conversation is read in order by one task, in
    batches; only digest states are kept.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, done = object(), None, []
        for batch in batches:
            for conv, text, low, high in zip(
                batch["conv_id"].tolist(), batch["formatted"], batch["loss_start"], batch["loss_end"], strict=True
            ):
                if conv != current:
                    if state:
                        done.append(state.row(current))
                    current, state = conv, _Digest()
                state.add(text, None if pd.isna(low) else int(low), None if pd.isna(high) else int(high))
            if done:
                yield pd.DataFrame(done, columns=_COLUMNS)
                done = []
        if state:
            yield pd.DataFrame([state.row(current)], columns=_COLUMNS)

    # Ids travel as texts that are never null, so that turns without one are a conversation like any other.
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = in_order(formatted.withColumn("conv_id", key)).select("conv_id", "formatted", "loss_start", "loss_end")
    found = rows.mapInPandas(
        work,
        "conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    own = F.when(F.col("conv_id") != "", F.substr(F.col("conv_id"), F.lit(2)))
    return found.withColumn("conv_id", own.cast(formatted.schema["conv_id"].dataType))


_COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, low: int | None, high: int | None) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        if low is not None:
            masked = unescape(formatted[low:high])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)
        self.chars += len(formatted)

    def row(self, conv: object) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
