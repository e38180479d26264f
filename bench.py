"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores. Index tables are built once, timed as `index_build`, and then searched, as
in use. Every query is run in full into the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleaner.operators.sparse import bm25_work  # noqa: E402
from workload.queries import CANDIDATES, corpus, registered, trained_recall  # noqa: E402

HEADLINE = (
    "clean_text",
    "chunks",
    "tokens",
    "postings",
    "term_stats",
    "hashed_embeddings",
    "embed_cache_misses",
    "bm25_topk",
    "bm25_padded",
    "dense_topk",
    "dense_topk_blocks",
    "ivf_topk",
    "dense_chunks",
    "hybrid_rrf",
    "dedup_hits",
    "prompt",
    "extractive_answer",
    "retrieval_metrics",
    "hybrid_answer",
    "index_append",
    "judgements",
)


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(body) -> float:
    start = time.perf_counter()
    body()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gleaner-bench")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    tables, queries, times = corpus(spark, folder), registered(), {}

    def build_index() -> None:
        for part in ("chunks", "sparse", "vectors", "cells", "vectors_by_cell"):
            times[f"build_{part}"] = timed(lambda: getattr(tables, part))

    times["index_build"] = timed(build_index)
    times["build_fused"] = timed(lambda: tables.fused)  # hits that the post-processing queries start from
    recall = {r["nprobe"]: r["recall"] for r in queries["ivf_recall"](spark, folder).collect()}
    for name in HEADLINE:
        times[name] = timed(lambda: run(queries[name](spark, folder)))

    trained = {r["search"]: [round(r["recall"], 4), round(r["share"], 4)] for r in trained_recall(tables).collect()}
    matched, read = bm25_work(tables.questions, tables.sparse, CANDIDATES).agg(F.sum("matched"), F.sum("read")).first()

    total = round(sum(t for n, t in times.items() if not n.startswith("build_")), 3)
    label = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    found = {
        "ivf_recall_at_5": recall,
        "trained_recall_and_share_scored": trained,
        "bm25_share_of_postings_read": round(read / matched, 4),
    }
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": label} | found))


if __name__ == "__main__":
    main()
