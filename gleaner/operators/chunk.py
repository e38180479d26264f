"""Documents to overlapping chunks with exact character offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import ChunkingConfig
from gleaner.functions.text import clean_text, let, overlap_tail, split_segments, strip

_CHUNKS = "array<struct<text:string,start_char:int,end_char:int>>"
# Chunks gather in blocks of this size, so a book-length text is not copied once per chunk.
_BLOCK = 128


def pack_segments(segments: Column, cfg: ChunkingConfig) -> Column:
    """Fold segments into chunks: array<struct<text, start_char, end_char>>."""

    def chunk_of(buf: Column, length: Column, start: Column, least: int) -> Column:
        none = F.array().cast(_CHUNKS)
        return let(
            strip(buf),
            lambda text: F.when(
                F.length(text) >= least,
                F.array(
                    F.struct(
                        text.alias("text"),
                        start.cast("int").alias("start_char"),
                        (start + length).cast("int").alias("end_char"),
                    )
                ),
            ).otherwise(none),
        )

    def state(buf, length, start, offset, block, done) -> Column:
        return F.struct(
            buf.alias("buf"),
            length.cast("int").alias("len"),
            start.cast("int").alias("start"),
            offset.cast("int").alias("offset"),
            block.alias("block"),
            done.alias("done"),
        )

    def step(acc: Column, segment: Column) -> Column:
        size = F.length(segment)
        empty = F.array().cast(_CHUNKS)

        def flush(tail: Column) -> Column:
            full = F.size(acc["block"]) >= _BLOCK
            emitted = chunk_of(acc["buf"], acc["len"], acc["start"], cfg.min_chunk_size)
            return state(
                F.concat(tail, segment),
                F.length(tail) + size,
                acc["start"] + acc["len"] - F.length(tail),
                acc["offset"] + size,
                F.concat(F.when(full, empty).otherwise(acc["block"]), emitted),
                F.when(full, F.concat(acc["done"], F.array(acc["block"]))).otherwise(acc["done"]),
            )

        grown = state(
            F.concat(acc["buf"], segment),
            acc["len"] + size,
            F.when(acc["len"] == 0, acc["offset"]).otherwise(acc["start"]),
            acc["offset"] + size,
            acc["block"],
            acc["done"],
        )
        overflow = (acc["len"] > 0) & (acc["len"] + size > cfg.chunk_size)
        return F.when(overflow, let(overlap_tail(acc["buf"], cfg.chunk_overlap), flush)).otherwise(grown)

    def finish(acc: Column) -> Column:
        last = chunk_of(acc["buf"], acc["len"], acc["start"], max(cfg.min_chunk_size, 1))
        return F.concat(F.flatten(acc["done"]), acc["block"], last)

    zero = state(
        F.lit(""),
        F.lit(0),
        F.lit(0),
        F.lit(0),
        F.array().cast(_CHUNKS),
        F.array().cast(f"array<{_CHUNKS}>"),
    )
    return F.aggregate(segments, zero, step, finish)


def chunk_documents(
    documents: DataFrame, cfg: ChunkingConfig = ChunkingConfig(), *, clean: bool = True
) -> DataFrame:
    """One row per chunk of `documents(doc_id, text[, metadata][, doc_ord])`.

    A narrow map over the documents: no shuffle and no Python worker, on batch
    and streaming frames alike. Columns besides `text` are carried through.
    """
    keep = [c for c in documents.columns if c != "text"]
    text = F.col("text")
    return (
        documents.select(*keep, (clean_text(text) if clean else text).alias("_text"))
        .select(*keep, split_segments(F.col("_text"), cfg.chunk_size, cfg.separators).alias("_segments"))
        .select(*keep, F.posexplode(pack_segments(F.col("_segments"), cfg)).alias("chunk_index", "_chunk"))
        .select(
            F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"),
            *keep,
            "chunk_index",
            "_chunk.text",
            "_chunk.start_char",
            "_chunk.end_char",
        )
    )
