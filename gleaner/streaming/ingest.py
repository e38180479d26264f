"""Continuous indexing: a stream of documents appended to an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gleaner.plans.hybrid import HybridIndex


def ingest_stream(
    documents: DataFrame,
    index: HybridIndex,
    checkpoint: str,
    on_conflict: str = "error",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append every micro-batch of documents(doc_id, text, metadata, doc_ord) to the index.

    Chunking keeps no state between documents. A batch replayed after a failure
    carries the same label and is skipped if it was committed.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        index.append(batch, label=f"{checkpoint}#{batch_id}", on_conflict=on_conflict)

    return (
        documents.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
