"""Token files: exact round trips, damage, and the library's own ids."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import rans
from gleaner.llm.queries import WORD_BPE


def table_for(ids, size=None):
    return rans.Table(rans.scaled(np.bincount(ids, minlength=size or 0)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 10**9)), max_size=300))
def test_scaled_frequencies_add_up(counts):
    counts = np.array(counts, np.int64)
    made = rans.scaled(counts)
    assert ((made > 0) == (counts > 0)).all()
    assert int(made.sum()) == (1 << rans.BITS if counts.any() else 0)


def test_scaled_when_most_symbols_are_rare():
    counts = np.ones(400_000, np.int64)
    counts[7] = 10**12
    made = rans.scaled(counts)
    assert int(made.sum()) == 1 << rans.BITS and made.min() == 1
    with pytest.raises(ValueError):
        rans.scaled(np.ones(600_000, np.int64))


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 511, 8191, 8192, 8193, 50_000, 1_200_000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
    table = table_for(np.r_[ids, np.arange(5)], 49_408)
    cuts = np.sort(rng.integers(0, n + 1, 7)) if n else []
    docs = np.split(ids, cuts)
    names = [None if k == 2 else -k * 10**15 for k in range(len(docs))]
    data = rans.encode_block(names, docs, table, 3, 4)
    (block,) = rans.blocks_in(data + b"\n", table)
    assert (block.part, block.sequence, block.ids) == (3, 4, n)
    assert block.decode(table).tolist() == ids.tolist()
    assert block.sizes.tolist() == [len(d) for d in docs]
    assert [None if no else i for i, no in zip(block.doc_ids.tolist(), block.null.tolist())] == names
    for _ in range(5):  # from any checkpoint on
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert block.decode(table, a, b).tolist() == ids[a:b].tolist()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.2, 1 << 20), 45_000).astype(np.uint32)
    table = table_for(ids)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert len(rans.encode_block([1], [ids], table)) < 1.04 * entropy


def test_only_needed_segments_are_decoded(monkeypatch):
    ids = np.arange(200_000, dtype=np.uint32) % 1_000
    table = table_for(ids)
    (block,) = rans.blocks_in(rans.encode_block([1], [ids], table) + b"\n", table)
    seen, decode = [], rans._decode_side_by_side
    monkeypatch.setattr(rans, "_decode_side_by_side", lambda w, at, *rest: seen.append(len(at)) or decode(w, at, *rest))
    assert block.decode(table, 100_000, 100_010).tolist() == ids[100_000:100_010].tolist()
    assert seen == [1]


def test_damage_is_found():
    ids = np.random.default_rng(5).integers(0, 900, 20_000).astype(np.uint32)
    table = table_for(ids)
    data = rans.encode_block([1], [ids], table) + b"\n"
    for at in (0, 9, 30, 200, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(rans.DamagedFile):
            [b.decode(table) for b in rans.blocks_in(bytes(broken), table)]
    for cut in (data[:-1], data[:40], data[:-100]):
        with pytest.raises(rans.DamagedFile):
            list(rans.blocks_in(cut, table))
    other = table_for(np.r_[ids, ids[:5]])
    with pytest.raises(rans.DamagedFile):
        list(rans.blocks_in(data, other))
    coded = bytearray(table.to_bytes())
    assert (rans.Table.from_bytes(bytes(coded)).freq == table.freq).all()
    coded[20] ^= 1
    with pytest.raises(rans.DamagedFile):
        rans.Table.from_bytes(bytes(coded))
    # Words altered and the block's checksum made to fit: the checkpoint's own checksum tells.
    body = bytearray(data[:-5])
    body[-40] ^= 1
    forged = bytes(body) + struct.pack("<I", zlib.crc32(bytes(body))) + b"\n"
    with pytest.raises(rans.DamagedFile):
        [b.decode(table) for b in rans.blocks_in(forged, table)]
    with pytest.raises(ValueError):
        rans.encode_block([1], [np.array([5_000], np.uint32)], table)


def plain(rows):
    """(id, start, size, crc) by the library, in order."""
    model = Tokenizer.from_file(WORD_BPE)
    coded = []
    for key, text in rows:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        coded.append((key, len(ids), zlib.crc32(ids), ids.tolist()))
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    start, out = 0, []
    for key, n, crc, ids in coded:
        out.append((key, start, n, crc, ids))
        start += n
    return out


def written(spark, frame, tmp_path, **options):
    tokens = rans.token_ids(frame, WORD_BPE).cache()
    path = f"{tmp_path}/out"
    rans.write_ids(tokens, path, **options)
    return path


def test_files_hold_what_the_library_says(spark, tmp_path):
    rng = np.random.default_rng(8)
    words = ["the", "Word", "naïve", "漢字", "😀", "<|endoftext|>", "x1y2", "don't"]
    rows = [(k * 3 - 50, " ".join(rng.choice(words, rng.integers(0, 60)))) for k in range(400)]
    rows += [(10**15, None), (-(2**62), ""), (None, "no id"), (None, "no id"), (None, "another"), (1, "again"), (1, "again"), (5, "long " * 60_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.select("*", F.lit(1).alias("id"), F.lit("x").alias("ids"), F.lit(2).alias("n"), F.lit(3).alias("crc"))
    path = written(spark, frame.repartition(5), tmp_path, block_ids=1_000, blocks_a_file=3)
    got = rans.read_ids(spark, path).collect()
    got = sorted(((r["id"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in got), key=lambda r: r[1])
    assert got == plain(rows)
    slim = rans.read_ids(spark, path, with_ids=False)
    assert {r["ids"] for r in slim.collect()} == {None} and slim.count() == len(rows)


def test_empty_table_and_wrong_ids(spark, tmp_path):
    path = written(spark, spark.createDataFrame([], "doc_id bigint, text string"), tmp_path)
    assert rans.read_ids(spark, path).collect() == [] and len(rans.read_table(spark, path).freq) == 0
    with pytest.raises(ValueError):
        rans.token_ids(spark.createDataFrame([("a", "b")], "doc_id string, text string"), WORD_BPE)


def test_a_damaged_file_is_named(spark, tmp_path):
    path = written(spark, spark.createDataFrame([(1, "some words")], "doc_id bigint, text string"), tmp_path)
    (file,) = [f for f in (tmp_path / "out" / "ids").glob("part-*")]
    data = bytearray(file.read_bytes())
    data[70] ^= 4
    (tmp_path / "out" / "ids" / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        rans.read_ids(spark, path).collect()
