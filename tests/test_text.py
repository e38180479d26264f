import random

import pytest
from pyspark.sql import functions as F

from gleaner.config import DEFAULT_SEPARATORS, ChunkingConfig, IndexConfig, RetrievalConfig, VectorIndexConfig
from gleaner.functions import text as t


def one(spark, value, body, kind="string"):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(body(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("a  b\t\tc", "a b c"),
        ("a\r\nb\rc", "a\nb\nc"),
        ("a\n\n\n\n\nb", "a\n\nb"),
        ("a\r\n\r\n\r\nb", "a\n\nb"),
        ("  \x1f a b 　\x85\n", "a b"),
        ("a \t\n b", "a \n b"),
        ("", ""),
        ("\n \n", ""),
    ],
)
def test_clean(spark, raw, cleaned):
    assert one(spark, raw, t.clean_text) == cleaned


def test_strip_knows_every_white_space(spark):
    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    assert set(spaces) == set(t.WHITESPACE_CHARS)
    assert one(spark, f"{spaces}x{spaces}y{spaces}", t.strip) == f"x{spaces}y"


@pytest.mark.parametrize("sep", DEFAULT_SEPARATORS)
def test_each_separator_stays_in_front(spark, sep):
    got = one(spark, f"one{sep}two{sep}", lambda c: t.split_segments(c, 512, DEFAULT_SEPARATORS))
    assert got == [f"one{sep}", f"two{sep}"]


def test_only_the_first_separator_found_is_used(spark):
    text = "a. b\n\nc. d\ne"
    got = one(spark, text, lambda c: t.split_segments(c, 512, DEFAULT_SEPARATORS))
    assert got == ["a. b\n\n", "c. d\ne"]


def test_segments_without_separator_and_too_long(spark):
    assert one(spark, "x" * 25, lambda c: t.split_segments(c, 10, DEFAULT_SEPARATORS)) == ["x" * 10, "x" * 10, "x" * 5]
    assert one(spark, "", lambda c: t.split_segments(c, 10, DEFAULT_SEPARATORS)) == []
    assert one(spark, "\U0001f600" * 3 + "\nb", lambda c: t.split_segments(c, 2, ("\n",))) == [
        "\U0001f600" * 2,
        "\U0001f600\n",
        "b",
    ]
    assert one(spark, "aaa", lambda c: t.split_segments(c, 10, ("aa",))) == ["aa", "a"]


@pytest.mark.parametrize(
    "text, overlap, tail",
    [("short", 10, "short"), ("one two three", 7, "three"), ("onetwothree", 4, "hree"), ("a b", 0, ""), ("abcd e", 1, "e")],
)
def test_overlap_tail(spark, text, overlap, tail):
    assert one(spark, text, lambda c: t.overlap_tail(c, overlap)) == tail


def test_tokens_match_word_characters(spark):
    text = "Ça va_bien, ÉTÉ 2nd x² ½ 東京 naïve! I'm"
    assert one(spark, text, t.tokenize) == ["ça", "va_bien", "été", "2nd", "x²", "½", "東京", "naïve", "i", "m"]


def test_word_set_and_jaccard(spark):
    assert set(one(spark, "A a b\n b", t.word_set)) == {"a", "b"}
    assert one(spark, " \t ", t.word_set) == []
    frame = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d"], [])], "a array<string>, b array<string>, e array<string>")
    row = frame.select(t.jaccard(F.col("a"), F.col("b")).alias("j"), t.jaccard(F.col("a"), F.col("e")).alias("n")).first()
    assert row["j"] == 0.5 and row["n"] is None


def test_term_counts(spark):
    rng = random.Random(3)
    tokens = [rng.choice("abcdef") for _ in range(200)]
    got = one(spark, tokens, t.term_counts, "array<string>")
    assert {r["term"]: r["tf"] for r in got} == {x: tokens.count(x) for x in set(tokens)}
    assert one(spark, [], t.term_counts, "array<string>") == []


def test_snippet(spark):
    assert one(spark, "a\nb" + "c" * 10, lambda c: t.snippet(c, 4)) == "a bc"
    assert one(spark, "abcd", lambda c: t.snippet(c, 4, True)) == "abcd"
    assert one(spark, "abcde", lambda c: t.snippet(c, 4, True)) == "abcd…"


def test_config():
    cfg = IndexConfig(chunking=ChunkingConfig(100, 10, 1), retrieval=RetrievalConfig.balanced(0.75))
    assert IndexConfig.from_json(cfg.to_json()) == cfg
    assert cfg.retrieval.sparse_weight == 0.25
    assert VectorIndexConfig().wants_cells(400) and not VectorIndexConfig().wants_cells(399)
    assert VectorIndexConfig(auto=True).resolve(2500) == VectorIndexConfig(50, 5)
    for bad in (lambda: RetrievalConfig(top_k=-1), lambda: ChunkingConfig(chunk_size=0), lambda: VectorIndexConfig(0)):
        with pytest.raises(ValueError):
            bad()
