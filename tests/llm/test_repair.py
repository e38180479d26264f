"""Conversation repair against a plain definition that compares whole audits."""

import hashlib
import itertools
import random
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from gleaner.llm import repair
from gleaner.llm.queries import damaged, op12_conversation_repair

sys.setrecursionlimit(20_000)
SPACE = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def plain_best(signs, most_inserts=3):
    """(cost, audit) of the cheapest, then ASCII-least audit, trying every edit with whole strings."""

    @lru_cache(None)
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(signs) and state in ("", "a") else []
        if inserts < most_inserts:
            for role in "ua":
                if (state, role) in STEP:
                    c, a = best(i, STEP[state, role], inserts + 1)
                    ways.append((c + 3, "I" + a))
        if i < len(signs):
            sign = signs[i]
            c, a = best(i + 1, state, 0)
            ways.append((c + 4, "D" + a))
            if sign != "x":
                more = 3 if sign.isupper() else 0
                for edit, role, cost in [("K", sign.lower(), 0), ("R", "u", 3), ("R", "a", 3)]:
                    if (state, role) in STEP:
                        c, a = best(i + 1, STEP[state, role], 0)
                        ways.append((c + cost + more, edit + a))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def plain_report(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines) of one conversation's rows in order."""
    seen, signs = set(), ""
    counts = {"x": 0, "blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        kept = text.rstrip(SPACE)
        if not kept:
            counts["blank"] += 1
            signs += "x"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            signs += "x"
        else:
            sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if kept[-1] not in ".!?":
                counts["truncated"] += 1
                sign = sign.upper()
            signs += sign
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = plain_best(signs)
    lines, state, rest = [], "", iter(rows)
    for edit in audit:
        role = "a" if state == "u" else "u"
        if edit == "I":
            lines.append("user:" if role == "u" else "assistant:")
            state = role
            continue
        _, own, text = next(rest)
        if edit == "K":
            state = own[:1]
            lines.append(f"{own}:{text}")
        elif edit == "R":
            state = role
            lines.append(("user:" if role == "u" else "assistant:") + text)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, lines


def test_automaton_equals_whole_audits_for_all_short_signatures():
    signs = "suaoSUAOx"
    words = ["".join(w) for n in range(5) for w in itertools.product(signs, repeat=n)]
    automaton = repair.Automaton()
    for word in sorted(words, key=lambda w: w[::-1]):
        assert automaton.solve(word[::-1]) == plain_best(word), word
    assert automaton.made == sum(9**n for n in range(1, 5))  # every ending once


def test_automaton_on_long_signatures_in_any_order():
    random.seed(4)
    automaton = repair.Automaton()
    for _ in range(60):
        word = "".join(random.choices("suaoSUAOx", k=random.randrange(40)))
        assert automaton.solve(word[::-1]) == plain_best(word)
    cost, audit = automaton.solve("au" * 200_000)
    assert (cost, audit) == (0, "K" * 400_000)


def order(row):
    turn, role, text = row
    digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
    return turn is not None, turn or 0, role, digest


def rows_for_test():
    random.seed(7)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(random.randrange(9)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = random.choice(["Hello there.", "Yes", "no!", None, "", " \n", "why?\x0b", "é.", "again.", f"turn {turn}."])
            rows.append((conv, random.choice([turn, turn, turn, turn + 1, None]), role, text))
    rows += [(500, k, "user", "the same.") for k in range(300)] + [(501, None, None, None)] * 3
    rows += [(2**62, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(401)] + [(502, -(2**53) - k, "user", "a.") for k in range(2)]
    return rows


def test_repair_equals_plain(spark):
    rows = rows_for_test()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.select("*", F.lit("x").alias("key"), F.lit(1).alias("said"), F.lit(1).alias("place"), F.lit(0).alias("kind"))
    reports, turns = repair.repair(frame.repartition(7))
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = {conv: plain_report(sorted(own, key=order)) for conv, own in by_conv.items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in reports.collect()}
    assert got == {conv: w[:-1] for conv, w in want.items()}
    lines = {}
    for r in turns.orderBy("place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert lines == {conv: w[-1] for conv, w in want.items() if w[-1]}
    sums = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(turns).collect()}
    assert sums == {conv: hashlib.sha256("\n".join(own).encode()).hexdigest() for conv, own in lines.items()}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    reports, turns = repair.repair(frame)
    assert reports.collect() == [] and turns.collect() == [] and repair.digests(turns).collect() == []
    assert reports.schema["conv_id"].dataType.simpleString() == "string"


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(3)] + [(None, None, None, None), (None, 1, "a", "b")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(repr, map(tuple, damaged(frame).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_returns_every_conversation(spark, folder):
    got = {r["conv_id"] for r in op12_conversation_repair(spark, folder).collect()}
    assert got == {r["conv_id"] for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id").distinct().collect()}
