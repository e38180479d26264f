"""Registered queries of this package: each applies one operator to its whole table and derives digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, chat, fim, hnsw, html, licenses, packing, pii, quality, rans, repair, simhash, toxicity
from gleaner.llm.common import BYTE_BPE, ROW, WORD_BPE, table
from gleaner.runtime import materialize, scratch_path


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.ToxicityModel.train(documents, table(spark, folder, "labels"))
    return model.score(documents).select(
        F.col("id").alias("doc_id"),
        toxicity.held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = packing.pack(table(spark, folder, "documents"), WORD_BPE)
    return placed.select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to"
    )


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, those without an id as one, and one whose texts hold control strings of templates."""
    said = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = said.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(turns))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    base = [rule.name for rule in quality.BASE_RULES]
    return quality.judge(table(spark, folder, "documents")).select(
        F.col(ROW)["doc_id"].alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.arrays_overlap("failed_rules", F.array(*map(F.lit, base))).alias("base_failed"),
        "kept",
    )


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op6_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_documents(table(spark, folder, "documents"))
    span = lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string"))
    return found.withColumn("runs", F.array_join(F.transform("runs", span), ",")).withColumnRenamed("id", "doc_id")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode_texts(
        table(spark, folder, "documents"), BYTE_BPE, public_tokenizers.PATTERN, with_ids=False
    )
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    texts = html.extract(pages, html.fit(pages))
    return texts.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op9_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest vectors of every hundredth row; one more id is kept per copy, as a query's own does not count."""
    vectors = hnsw.vectors_of(table(spark, folder, "embeddings"), "vec_id", "embedding")
    index = hnsw.shard_index(vectors, keep_ids=11)
    found = hnsw.search_index(index, vectors.where("id % 100 = 0"), 10)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _joined(spans: Column) -> Column:
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans_of(table(spark, folder, "documents"))
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(spans).cast("bigint").alias("n_spans"),
    )


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fim.transform(table(spark, folder, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def damaged(said: DataFrame) -> DataFrame:
    """Conversations with some turns lost, emptied, cut, repeated or under another role, by a checksum of their number."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    rows = said.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    kept = rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return kept.drop("copy")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    reports, turns = repair.repair(damaged(said))
    digests = repair.digests(turns).withColumnRenamed("conv_id", "own")
    reports = reports.withColumnRenamed("conv_id", "of")
    every = said.select("conv_id").distinct()
    rows = every.join(reports, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokens = materialize(rans.token_ids(table(spark, folder, "documents"), WORD_BPE), "token-ids")
    path = scratch_path(spark, "token-files")
    rans.write_ids(tokens, path)
    found = rans.read_ids(spark, path, with_ids=False)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every `op` function above."""
    return {name: body for name, body in globals().items() if name.startswith("op") and callable(body)}
