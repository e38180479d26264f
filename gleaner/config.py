"""Settings of every stage, with the defaults users already rely on."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

# Order matters, the first separator found in a text is the only one used.
DEFAULT_SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", "; ")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class ChunkingConfig:
    """Sizes are characters (Unicode code points), not tokens."""

    chunk_size: int = 512
    chunk_overlap: int = 64
    min_chunk_size: int = 50
    separators: tuple[str, ...] = DEFAULT_SEPARATORS

    def __post_init__(self) -> None:
        object.__setattr__(self, "separators", tuple(self.separators))
        _require(self.chunk_size > 0, "chunk_size must be positive")
        _require(self.min_chunk_size >= 0, "min_chunk_size must not be negative")
        _require(all(self.separators), "separators must not be empty strings")


@dataclass(frozen=True)
class EmbeddingConfig:
    dim: int = 64
    batch_size: int = 64
    normalize: bool = True


@dataclass(frozen=True)
class RetrievalConfig:
    top_k: int = 5
    dense_weight: float = 0.6
    sparse_weight: float = 0.4
    dense_candidates: int = 20
    sparse_candidates: int = 20
    rrf_k: int = 60
    # Sparse lists shorter than their depth are filled with zero-score chunks in insertion order.
    pad_zero: bool = True

    def __post_init__(self) -> None:
        for name in ("top_k", "dense_candidates", "sparse_candidates"):
            _require(getattr(self, name) >= 0, f"{name} must not be negative")

    @classmethod
    def balanced(cls, dense_weight: float, **other) -> "RetrievalConfig":
        """Weights that add up to one, given only the dense share."""
        return cls(dense_weight=dense_weight, sparse_weight=1.0 - dense_weight, **other)


@dataclass(frozen=True)
class VectorIndexConfig:
    nlist: int = 100
    nprobe: int = 10
    seed: int = 42
    # nlist = sqrt(N), nprobe = nlist / 10 instead of the fixed numbers.
    auto: bool = False
    # "exact" or "cells" whatever the size, or "by_size".
    search: str = "by_size"
    # Share of the true nearest that questions should find: nprobe is then measured whenever cells are trained.
    recall: float | None = None

    def __post_init__(self) -> None:
        _require(self.nlist > 0 and self.nprobe > 0, "nlist and nprobe must be positive")
        _require(self.search in ("by_size", "exact", "cells"), "search is 'by_size', 'exact' or 'cells'")
        _require(self.recall is None or 0 < self.recall <= 1, "recall is a share above 0")

    def resolve(self, n: int) -> "VectorIndexConfig":
        """The concrete nlist and nprobe for n vectors."""
        if not self.auto:
            return self
        nlist = max(1, round(n**0.5))
        return replace(self, nlist=nlist, nprobe=max(1, nlist // 10), auto=False)

    def wants_cells(self, n: int, trained: int | None = None) -> bool:
        """Whether to train cells: by size, exact search below four vectors per cell, cells from there on.

        Cells that exist are trained anew once `auto` wants twice as many.
        """
        wanted = self.resolve(n).nlist
        if trained is not None:
            return self.auto and wanted >= 2 * trained
        if self.search == "by_size":
            return n >= 4 * wanted
        return self.search == "cells" and n > 0

    def probes(self, trained: int) -> int:
        """Cells looked at per question, of those that were trained."""
        return max(1, trained // 10) if self.auto else self.nprobe


@dataclass(frozen=True)
class ContextConfig:
    max_chars: int = 2000
    similarity_threshold: float = 0.95


@dataclass(frozen=True)
class IndexConfig:
    chunking: ChunkingConfig = field(default_factory=ChunkingConfig)
    embedding: EmbeddingConfig = field(default_factory=EmbeddingConfig)
    retrieval: RetrievalConfig = field(default_factory=RetrievalConfig)
    vectors: VectorIndexConfig = field(default_factory=VectorIndexConfig)
    context: ContextConfig = field(default_factory=ContextConfig)
    # Folders of the stored posting table; a question reads those of its words. Thousands for large corpora.
    term_buckets: int = 64
    # Folders of the stored chunks, by a hash of the chunk id; texts of hits are read from the folders they lie in.
    chunk_buckets: int = 64

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "IndexConfig":
        raw = json.loads(text)
        return cls(
            ChunkingConfig(**raw["chunking"]),
            EmbeddingConfig(**raw["embedding"]),
            RetrievalConfig(**raw["retrieval"]),
            VectorIndexConfig(**{k: v for k, v in raw["vectors"].items() if k != "train_per_cell"}),
            ContextConfig(**raw["context"]),
            raw["term_buckets"],
            raw.get("chunk_buckets", 0),
        )
