"""gleaner: document retrieval as Spark jobs.

Documents become cleaned, overlapping chunks; chunks become a BM25 posting
table and a vector table; a whole table of questions is answered in one plan.
Every public function takes and returns DataFrames or Columns.
"""

import sys

from pyspark import cloudpickle

from gleaner.config import (
    ChunkingConfig,
    ContextConfig,
    EmbeddingConfig,
    IndexConfig,
    RetrievalConfig,
    VectorIndexConfig,
)

# Task-side helpers travel with the job, so executors need no install of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "ChunkingConfig",
    "ContextConfig",
    "EmbeddingConfig",
    "IndexConfig",
    "RetrievalConfig",
    "VectorIndexConfig",
]
