"""Conversation structure repair with costs shared by all conversations that end alike.

A conversation is legal if its roles read as an optional system turn and then pairs of user and assistant, or not at all. Every
turn gets a sign: the initial of its role and whether its text breaks off, or one sign for turns that must go (blank, or said
before). The signs of a conversation are its signature. Distinct signatures are read from the end: sorted by their reverse, they
are the depth-first walk of the automaton in which equal endings are one node. A node is made once, from the node of the
ending that is one sign shorter: for each state of the grammar the least cost of legal edits from here on, the edits that come
first, and the state in which the shorter ending goes on. An audit is then read off by following these links. Only the
current path is kept, so memory follows the longest signature; a task meets again only the nodes above its first signature.

Edits: K keeps a turn, R gives it the role user or assistant (3), D deletes it (4; blank and repeated turns must go), I inserts an
empty turn of either role (3); a turn that breaks off and stays costs 3 more. Of audits that cost the same the ASCII-least is
taken: the choices at a node differ in their first unlike edit, so they are told apart there and no audits are compared.

Cases: null roles and texts read as one space; null turn numbers come first; ties in turn number go by role, then by the digest of the
text; a null conversation id is a conversation; repeated rows are repeated turns; an empty table gives an empty result; other columns
are ignored. Turns that one conversation says again and again are counted before they are shuffled, and a
conversation's turns are streamed in order, never gathered: its signature and its audit, a byte a turn, are all that is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.runtime import materialize, salted_join, slice_rows

REROLE, DELETE, INSERT, BROKEN_OFF = 3, 4, 3, 3
# States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# The state that an inserted or renamed turn leads to: user, but assistant after user.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# State to state for a kept turn of an initial; what is missing is illegal.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
LEGAL = ("su", "ua", "au")
MUST_GO = "x"

# The six white-space characters of ASCII.
SPACE = " \t\n\x0b\x0c\r"


# Automaton ---------------------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class Node:
    """An ending: per grammar state the cost to go, the edits up to and with its first turn, and the state behind them."""

    cost: tuple[int, ...]
    edits: tuple[str, ...]
    then: tuple[int, ...]


def end_node() -> Node:
    """No turns are left: insert until the grammar may end."""
    cost, edits, then = [], [], []
    for state in range(4):
        n, at = 0, state
        while at not in ENDS:
            n, at = n + 1, NEXT[at]
        cost.append(n * INSERT)
        edits.append("I" * n)
        then.append(at)
    return Node(tuple(cost), tuple(edits), tuple(then))


def node_before(sign: str, rest: Node) -> Node:
    """The ending that begins with a turn of this sign and goes on as `rest`."""
    direct = []  # without an insertion: (cost, edit, state)
    for state in range(4):
        ways = [(DELETE + rest.cost[state], "D", state)]
        if sign != MUST_GO:
            stays = BROKEN_OFF if sign.isupper() else 0
            kept = KEEP[sign.lower()].get(state)
            if kept is not None:
                ways.append((stays + rest.cost[kept], "K", kept))
            ways.append((REROLE + stays + rest.cost[NEXT[state]], "R", NEXT[state]))
        direct.append(min(ways))
    best = []
    for state in range(4):
        ways, at = [], state
        for n in range(3):  # a third insertion would come back to a state it has been in
            cost, edit, then = direct[at]
            ways.append((n * INSERT + cost, "I" * n + edit, then))
            at = NEXT[at]
        best.append(min(ways))
    return Node(*(tuple(x) for x in zip(*best)))


class Automaton:
    """The path of the signature read last; endings that the next one shares are taken from it."""

    def __init__(self) -> None:
        self.path, self.signs = [end_node()], ""
        self.made = 0

    def solve(self, backwards: str) -> tuple[int, str]:
        """(cost, audit) of the signature that reads `backwards` from its end; best called in sorted order."""
        shared, most = 0, min(len(backwards), len(self.signs))
        while shared < most and backwards[shared] == self.signs[shared]:
            shared += 1
        del self.path[shared + 1 :]
        for sign in backwards[shared:]:
            self.path.append(node_before(sign, self.path[-1]))
            self.made += 1
        self.signs = backwards
        state, audit = START, []
        for node in reversed(self.path):
            audit.append(node.edits[state])
            state = node.then[state]
        return self.path[-1].cost[START], "".join(audit)


# Spark ---------------------------------------------------------------------------


def _key(conv_id: Column) -> Column:
    """Conversation ids as texts that are never null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(key, turn, role, text, said) of every row: no nulls but in `turn`; `said` is a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("said", F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)))


def signs(turns: DataFrame) -> DataFrame:
    """(key, turn, role, said, copies, blank, broken, first): distinct turns with their faults.

    Equal turns are counted first, so whatever is said over and over is one row; the first time that something is said is
    found by a minimum, not by gathering who says it.
    """
    trimmed = F.rtrim("text", F.lit(SPACE))
    counted = (
        turns.select(
            "key", "turn", "role", "said",
            (F.length(trimmed) == 0).alias("blank"),
            (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("broken"),
        )
        .groupBy("key", "turn", "role", "said", "blank", "broken")
        .agg(F.count("*").alias("copies"))
    )
    counted = materialize(counted, "repair-turns")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    firsts = counted.groupBy("key", "said").agg(F.min(order).alias("earliest"))
    return counted.join(firsts, ["key", "said"]).select(
        "key", "turn", "role", "said", "copies", "blank", "broken", F.col("turn").eqNullSafe(F.col("earliest.turn")).alias("first")
    )


def in_order(rows: DataFrame, *ahead: str) -> DataFrame:
    """Each conversation together, its turns one after the other."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "key").sortWithinPartitions("key", *ahead, F.col("turn").asc_nulls_first(), "role", "said")


_REPORT = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]


class _Report:
    """What is wrong with the turns seen so far."""

    def __init__(self, key: str):
        self.key, self.signature = key, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.low = self.high = self.last = None

    def add(self, turn: str | None, role: str, copies: int, blank: bool, broken: bool, first: bool) -> None:
        if turn is not None and (number := int(turn)) != self.high:
            self.low = number if self.low is None else self.low
            self.high = number
            self.numbers += 1
        initial = role[:1]
        self.illegal += (self.last is not None and self.last + initial not in LEGAL) + copies - 1
        self.last = initial
        if blank:
            self.blank += copies
            self.signature.append(MUST_GO * copies)
            return
        if first:
            copies -= 1
            self.truncated += broken
            sign = initial if initial in ("s", "u", "a") else "o"
            self.signature.append(sign.upper() if broken else sign)
        self.duplicate += copies
        self.signature.append(MUST_GO * copies)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.numbers if self.numbers else 0
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(self.signature)


def reports(turns: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, signature) of every conversation."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        report = None
        for batch in batches:
            done = []
            turn = batch["turn"].astype(object).where(batch["turn"].notna(), None)
            for key, number, *rest in zip(
                batch["key"], turn, batch["role"], batch["copies"], batch["blank"], batch["broken"], batch["first"], strict=True
            ):
                if report is None or key != report.key:
                    if report:
                        done.append(report.row())
                    report = _Report(key)
                report.add(number, *rest)
            yield pd.DataFrame(done, columns=_REPORT)
        if report:
            yield pd.DataFrame([report.row()], columns=_REPORT)

    columns = ("key", "turn", "role", "copies", "blank", "broken", "first")
    rows = in_order(signs(turns)).select(*(F.col(c).cast("string") if c == "turn" else c for c in columns))
    counts = ", ".join(f"{c} bigint" for c in _REPORT[1:-1])
    return rows.mapInPandas(work, f"key string, {counts}, signature string")


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct signatures, each range of their reverses walked as one automaton."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton()
        for batch in batches:
            found = [automaton.solve(b) for b in batch["backwards"]]
            yield pd.DataFrame(
                {"signature": [b[::-1] for b in batch["backwards"]], "cost": [c for c, _ in found], "audit": [a for _, a in found]}
            )

    backwards = signatures.select(F.reverse("signature").alias("backwards"))
    rows = backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return rows.mapInPandas(work, "signature string, cost bigint, audit string")


def plans(turns: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has turns."""
    found = materialize(reports(turns).withColumn("digest", F.sha2("signature", 256)), "repair-reports")
    total = found.count()
    distinct = materialize(found.groupBy("signature", "digest").agg(F.count("*").alias("n")), "repair-signatures")
    solved = audits(distinct.select("signature")).withColumn("digest", F.sha2("signature", 256)).drop("signature")
    solved = materialize(solved.join(distinct.select("digest", "n"), "digest"), "repair-audits")
    # A signature that a third of all conversations have is cut into slices.
    joined = salted_join(found, solved, "digest", F.col("n"), slice_rows(total), ["key"])
    return joined.select("key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired_turns(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """(key, place, edit, role, text): the turns that stay or are put in, each conversation in order within its partition."""
    head = planned.select("key", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(None).cast("binary").alias("said"))
    body = turns.select("key", F.lit(1).alias("kind"), "turn", "role", "text", "said")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, edits, at, state, place, made = None, "", 0, START, 0, []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place
            made.append((key, place, edit, role, text))
            place += 1

        def insert() -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                state = NEXT[state]
                put("I", ROLE[state], "")
                at += 1

        for batch in batches:
            for own, kind, role, text in zip(batch["key"], batch["kind"], batch["role"], batch["text"], strict=True):
                if kind == 0:  # a conversation's audit stands before its turns
                    insert()
                    key, edits, at, state, place = own, text, 0, START, 0
                    continue
                insert()
                edit = edits[at]
                at += 1
                if edit == "K":
                    state = KEEP[role[:1]][state]
                    put("K", role, text)
                elif edit == "R":
                    state = NEXT[state]
                    put("R", ROLE[state], text)
            yield pd.DataFrame(made, columns=_TURN)
            made = []
        insert()
        yield pd.DataFrame(made, columns=_TURN)

    rows = in_order(head.unionByName(body), "kind").select("key", "kind", "role", "text")
    return rows.mapInPandas(work, "key string, place bigint, edit string, role string, text string")


_TURN = ["key", "place", "edit", "role", "text"]


def _conv_id(kind: T.DataType) -> Column:
    return F.when(F.col("key") != "", F.col("key").substr(F.lit(2), F.length("key"))).cast(kind).alias("conv_id")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports with cost and audit, repaired turns) of conversations(conv_id, turn, role, text); both carry `conv_id`.

    A conversation's repaired turns (conv_id, place, edit, role, text) stand in order within one partition.
    """
    conv_id = _conv_id(conversations.schema["conv_id"].dataType)
    turns = turns_of(conversations)
    planned = materialize(plans(turns), "repair-plans")
    return planned.select(conv_id, *planned.columns[1:]), repaired_turns(turns, planned).select(conv_id, *_TURN[1:])


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): `role:text` of the turns that `repair` returned, joined by line feeds."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, done = None, None, []
        for batch in batches:
            for own, role, text in zip(batch["key"], batch["role"], batch["text"], strict=True):
                if own != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                    state.update(f"{role}:{text}".encode())
                else:
                    state.update(f"\n{role}:{text}".encode())
            yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
            done = []
        if state:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "repaired_sha256"])

    rows = repaired.select(_key(F.col("conv_id")).alias("key"), "role", "text")
    found = rows.mapInPandas(work, "key string, repaired_sha256 string")
    return found.select(_conv_id(repaired.schema["conv_id"].dataType), "repaired_sha256")
