import random

import pytest
from conftest import SF, plan_of
from plain import chunks
from pyspark.sql import functions as F

from gleaner.config import ChunkingConfig
from gleaner.operators.chunk import chunk_documents

SETTINGS = [(512, 64, 50), (512, 64, 1), (200, 20, 1), (50, 10, 1), (512, 0, 1), (50, 15, 1), (30, 40, 0), (1, 1, 1)]


def texts():
    rng = random.Random(7)
    pieces = ["word", "x" * 40, "é", "\U0001f600", " ", "  ", "\n", "\n\n", ". ", "! ", "? ", "; ", "　", "ab cd"]
    made = ["", "Hello world", "a" * 1000, ("word " * 500).strip(), "x. " * 200, "line\n" * 300]
    for _ in range(120):
        some = rng.sample(pieces, rng.randint(1, len(pieces)))
        made.append("".join(rng.choice(some) for _ in range(rng.randint(1, 250))))
    return made


@pytest.mark.parametrize("size, overlap, least", SETTINGS)
def test_equals_brute_force(spark, size, overlap, least):
    rows = [(i, t) for i, t in enumerate(texts())]
    cfg = ChunkingConfig(size, overlap, least)
    frame = chunk_documents(spark.createDataFrame(rows, "doc_id long, text string"), cfg, clean=False)
    got = {}
    for r in frame.orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r["doc_id"], []).append((r["text"], r["start_char"], r["end_char"]))
        assert r["chunk_id"] == f"{r['doc_id']}_{r['chunk_index']}"
    for i, text in rows:
        assert got.get(i, []) == chunks(text, size, overlap, least), i


def test_more_chunks_than_one_block(spark):
    text = "\n".join(f"line {i} of a long book" for i in range(3000))
    cfg = ChunkingConfig(60, 10, 1)
    frame = chunk_documents(spark.createDataFrame([("b", text)], "doc_id string, text string"), cfg)
    got = [(r["text"], r["start_char"], r["end_char"]) for r in frame.orderBy("chunk_index").collect()]
    assert len(got) > 300 and got == chunks(text, 60, 10, 1)


def test_offsets_point_into_the_cleaned_text_and_metadata_travels(spark):
    text = "First  part.\r\n\r\n" + "Second part is longer than it should be. " * 30
    rows = [("d", text, {"author": "x", "year": "2024"})]
    frame = chunk_documents(spark.createDataFrame(rows, "doc_id string, text string, metadata map<string,string>"))
    cleaned = text.replace("  ", " ").replace("\r\n", "\n").strip()
    for r in frame.collect():
        assert cleaned[r["start_char"] : r["end_char"]].strip() == r["text"]
        assert r["metadata"] == {"author": "x", "year": "2024"}


def test_whole_table_without_shuffle_or_python(spark):
    frame = chunk_documents(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    plan = plan_of(frame)
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert frame.count() == 6699
    assert frame.agg(F.max(F.length("text"))).first()[0] <= 512 + 64 - 1
