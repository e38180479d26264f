"""A text encoder without a model: signed feature hashing of words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import tokenize

# Values of a block of vectors that are summed at once.
_BLOCK_VALUES = 4_000_000


def hashed_vector(text: Column, dim: int, normalize: bool = True) -> Column:
    """array<float> of length `dim`: each word adds its count, signed, to its bucket; without a text all values are null.

    The word's md5 gives the bucket (digits 1 to 7) and the sign (digit 8). Words are hashed once per Arrow
    batch, by its dictionary, and summed as whole numbers, so their order does not matter.
    """

    values = _BLOCK_VALUES  # the task needs no module but those on executors

    def sums(words: pa.Array) -> pa.Array:
        rows = len(words)
        known = words.flatten().dictionary_encode()
        code = known.indices.to_numpy(zero_copy_only=False)
        digits = [int(hashlib.md5(w).hexdigest()[:8], 16) for w in known.dictionary.cast(pa.binary()).to_pylist()]
        digest = np.array(digits, np.int64)
        bucket, sign = (digest >> 4) % dim, np.where(digest & 15 < 8, 1.0, -1.0)
        size = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        made = np.empty(rows * dim, np.float32)
        step = max(1, values // dim)
        for low in range(0, rows, step):
            high = min(rows, low + step)
            own = code[ends[low] : ends[high]]
            row = np.repeat(np.arange(high - low), size[low:high])
            part = np.bincount(row * dim + bucket[own], sign[own], (high - low) * dim).reshape(-1, dim)
            if normalize:
                length = np.sqrt((part * part).sum(axis=1, keepdims=True))
                part = part / np.where(length > 0, length, 1.0)
            made[low * dim : high * dim] = part.ravel()
        none = np.repeat(words.is_null().to_numpy(zero_copy_only=False), dim)
        return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * dim), pa.array(made, mask=none))

    return F.arrow_udf(sums, "array<float>")(tokenize(text))
