"""Fill-in-middle against a plain definition: units by one regular expression, cuts by slicing."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    hexed = hashlib.sha256(f"42:{doc_id if doc_id is not None else ''}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def located(text, remembered=None):
    data = text.encode()
    remembered = remembered or fim.Memory()
    at, parts = 0, []
    for end in fim.chunk_ends(len(data), fim.borders(np.frombuffer(data, np.uint8)).tolist(), 0):
        parts.append(remembered(data[at:end]))
        at = end
    assert at == len(data)
    return fim.Located(parts)


TEXTS = st.text(st.sampled_from(list("ab \n\t\x0b  é漢😀")), max_size=1500)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_counts_and_places_equal_the_plain_scan(text):
    where, units = located(text), UNIT.findall(text)
    assert where.units == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert where.end_of(k) == (len(head.encode()), len(head))


def test_shared_passages_share_chunks():
    rng = np.random.default_rng(1)
    passage = " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(2_000))
    remembered = fim.Memory()
    located(passage, remembered)
    asked = remembered.asked
    located("a few other words in front " + passage + " and behind", remembered)
    assert remembered.found >= 0.9 * asked


def test_borders_do_not_depend_on_portions(monkeypatch):
    data = np.random.default_rng(2).integers(97, 101, 5_000).astype(np.uint8)
    whole = fim.borders(data)
    monkeypatch.setattr(fim, "PORTION", 700)
    assert len(whole) > 5 and fim.borders(data).tolist() == whole.tolist()


def test_equal_hashes_are_told_apart_by_content(monkeypatch):
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda content: 1)
    remembered = fim.Memory()
    assert remembered(b"one two").ends.tolist() == [3]
    assert remembered(b"a b c").ends.tolist() == [1, 3]
    assert remembered.found == 0 and remembered(b"one two").ends.tolist() == [3] and remembered.found == 1


def test_memory_is_bounded():
    remembered = fim.Memory(10_000)
    for k in range(2_000):
        remembered(f"chunk {k}".encode())
        assert remembered.held <= 10_000


def rows(spark):
    rng = np.random.default_rng(3)
    words = ["the", "Word", "naïve", "漢字", "😀", "<", "<P", "x" * 5_000]
    made = [(None, "no id but some words"), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "has <M> a mark"), (6, "x" * 50_000)]
    for k in range(7, 400):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", "\n", "  \t", " "])) for _ in range(rng.integers(1, 80)))
        made.append((k, text if k % 3 else text.rstrip()))
    made += [(7, made[7][1]), (8, "tail " * 40_000)]
    return made


def test_transform_equals_plain(spark):
    made = rows(spark)
    frame = spark.createDataFrame(made, "doc_id bigint, text string")
    frame = frame.select("*", F.lit(1).alias("n"), F.lit("x").alias("form"), F.lit("x").alias("id"), F.lit("y").alias("output"))
    out = fim.transform(frame.repartition(3)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(((r["id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in out.collect()), key=repr)
    want = sorted(((i, *plain(i, t), t or "") for i, t in made), key=repr)
    assert got == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.transform(frame).collect() == []


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("<P>", "[S]", "<M>"), ("<P", "<PQ", "<M>"), ("<<", "<S>", "<M>"), ("<", "<S", "<M")])
def test_marks_that_cannot_be_undone_are_refused(marks):
    with pytest.raises(ValueError):
        fim.Marks(*marks)
