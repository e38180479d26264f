"""SimHash near-duplicates by a binary trie joined with itself.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are stored as four rotated tries, one
per 16-bit block brought to the front: of two fingerprints that differ in at most three bits, one block
agrees, so the pair meets under one 16-bit node of that trie. Below such nodes pairs of nodes are walked
together, the bits in which they differ are added up, and a pair of nodes is dropped once the sum exceeds the
budget. A task keeps only a spanning forest of the links it finds, so a group of n fingerprints yields at most n - 1
rows; the forests are then joined to components by alternating star steps, each written to the shared folder.

Cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows share a component;
an empty table gives an empty result; other columns are ignored by `near_duplicates` and kept by `keep_one`.
Ties for the representative go to the smallest id. Texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import by_text_bytes, id_and_text, map_texts
from gleaner.runtime import materialize

SHINGLE = 3
SEED = 42
BUDGET = 3
BLOCKS = 4
BLOCK_BITS = 16
# Distinct fingerprints that one task walks together; groups beyond it are cut by a second block.
GROUP_ROWS = 200_000
TASK_ROWS = 20_000

_ONE = np.uint64(1)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 where more than half of the shingle hashes have it."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp bigint): the 64 bits as a signed number."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_text_bytes(batches, "text"):
            made = np.array([fingerprint(t, shingle) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"id": batch["id"], "fp": made})

    return map_texts(id_and_text(frame, id_col, text_col), work, "fp bigint")


# The walk ---------------------------------------------------------------------------


def _halves(keys: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """Where each node [low, high) of the sorted keys divides at its next bit."""
    bit = np.uint64(1 << (63 - depth))
    start = keys[low] & ~(bit | (bit - _ONE))
    return np.clip(np.searchsorted(keys, start | bit), low, high)


def trie_pairs(keys: np.ndarray, depth: int, budget: int = BUDGET, at_once: int = 1 << 18) -> Iterator[np.ndarray]:
    """Index pairs (i < j) of sorted distinct keys that agree in the first `depth` bits and differ in at most `budget`.

    The frontier holds pairs of trie nodes with the bits in which they differ so far; it is
    walked in portions of `at_once` pairs, so memory does not grow with the number of pairs.
    """
    if len(keys) < 2:
        return
    prefix = keys >> np.uint64(64 - depth) if depth else np.zeros(len(keys), np.uint64)
    low = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    high = np.r_[low[1:], len(keys)]
    more = high - low > 1
    low, high = low[more], high[more]
    stack = [(depth, np.stack([low, high, low, high, np.zeros_like(low)]))]
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > at_once:
            stack.append((depth, nodes[:, at_once:]))
            nodes = nodes[:, :at_once]
        a, b, c, d, err = nodes
        # Two single keys, or the last bit: finish by counting.
        done = ((b - a == 1) & (d - c == 1)) | (depth == 64)
        if done.any():
            i, j = a[done], c[done]
            near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
            if near.any():
                yield np.stack([i[near], j[near]])
        rest = ~done
        if not rest.any():
            continue
        a, b, c, d, err = a[rest], b[rest], c[rest], d[rest], err[rest]
        m, n = _halves(keys, a, b, depth), _halves(keys, c, d, depth)
        same = a == c  # a node with itself: its two halves meet once
        grown = []
        for x, y, u, v, e, keep in (
            (a, m, c, n, err, None),
            (m, b, n, d, err, None),
            (a, m, n, d, err + 1, None),
            (m, b, c, n, err + 1, ~same),
        ):
            ok = (x < y) & (u < v) & (e <= budget)
            ok &= ~((x == u) & (y - x == 1))  # one key with itself
            if keep is not None:
                ok &= keep
            if ok.any():
                grown.append(np.stack([x[ok], y[ok], u[ok], v[ok], e[ok]]))
        if grown:
            stack.append((depth + 1, np.concatenate(grown, axis=1)))


class Forest:
    """Union-find over 0..n-1 that remembers only the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        parent = self.parent
        while True:
            up = parent[parent]
            if (up == parent).all():
                self.parent = parent
                return parent
            parent = up

    def add(self, pairs: np.ndarray) -> None:
        """Hook roots on smaller roots until all pairs agree."""
        i, j = pairs
        while len(i):
            roots = self.roots()
            x, y = roots[i], roots[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def _rotated(fp: np.ndarray, block: int) -> np.ndarray:
    k = np.uint64(block * BLOCK_BITS)
    return fp if block == 0 else (fp << k) | (fp >> np.uint64(64 - block * BLOCK_BITS))


def links(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(src, dst) with src > dst: forests of the links among distinct fingerprints (rep, fp)."""
    spark = nodes.sparkSession
    if budget >= BLOCKS:
        raise ValueError(f"at most {BLOCKS - 1} bits: fingerprints further apart need not share a block")
    block = lambda c, k: F.shiftrightunsigned(c, 64 - BLOCK_BITS * (k + 1)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    copies = nodes.select(
        "rep", "fp",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), block(F.col("fp"), k).alias("v")) for k in range(BLOCKS)])).alias("b"),
    ).select("rep", "fp", F.col("b.k").alias("k"), F.col("b.v").cast("int").alias("v"))
    # At most BLOCKS * 2^16 rows, whatever the corpus.
    sizes = copies.groupBy("k", "v").count()
    crowded = sizes.where(F.col("count") > GROUP_ROWS).select("k", "v", F.lit(True).alias("crowded"))
    total = nodes.count()
    coarse = max(0, min(BLOCK_BITS, (max(1, total // TASK_ROWS) - 1).bit_length()))
    cut = copies.join(F.broadcast(crowded), ["k", "v"], "left")
    # In a crowded group one of four equal parts of the other 48 bits agrees as well.
    rest = F.shiftleft("fp", 0)
    rotated = F.when(F.col("k") == 0, rest)
    for k in range(1, BLOCKS):
        rotated = rotated.when(
            F.col("k") == k,
            F.shiftleft("fp", BLOCK_BITS * k).bitwiseOR(F.shiftrightunsigned("fp", 64 - BLOCK_BITS * k)),
        )
    part = lambda j: F.shiftrightunsigned(rotated, 36 - 12 * j).bitwiseAND(F.lit(4095)).cast("int")
    sub = F.when(
        F.col("crowded"), F.array(*[F.struct(F.lit(j).alias("j"), part(j).alias("w")) for j in range(4)])
    ).otherwise(F.array(F.struct(F.lit(-1).alias("j"), F.lit(0).alias("w"))))
    keyed = cut.select("rep", "fp", "k", "v", F.explode(sub).alias("s")).select(
        "rep", "fp", "k",
        F.when(F.col("s.j") >= 0, F.col("v")).otherwise(F.shiftright("v", BLOCK_BITS - coarse)).alias("g"),
        F.col("s.j").alias("j"), F.col("s.w").alias("w"),
    )

    def walk(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fp = group["fp"].to_numpy().view(np.uint64)
        keys, depth = _rotated(fp, int(key[0])), BLOCK_BITS
        if key[2] >= 0:  # bring the agreeing part forward as well
            low, at = np.uint64((1 << 48) - 1), 12 * int(key[2])
            body = keys & low
            body = ((body << np.uint64(at)) | (body >> np.uint64(48 - at))) & low if at else body
            keys, depth = (keys & ~low) | body, BLOCK_BITS + 12
        order = np.argsort(keys)
        keys, reps = keys[order], group["rep"].to_numpy()[order]
        forest = Forest(len(keys))
        for pairs in trie_pairs(keys, depth, budget):
            forest.add(pairs)
        roots = forest.roots()
        # Name every tree by its smallest member.
        smallest = pd.Series(reps).groupby(roots).transform("min").to_numpy()
        away = smallest != reps
        return pd.DataFrame({"src": reps[away], "dst": smallest[away]})

    found = keyed.groupBy("k", "g", "j", "w").applyInPandas(walk, "src bigint, dst bigint").distinct()
    return materialize(found, "simhash-links")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): every node with links and the smallest node it can reach, by alternating star steps.

    A step sends each node the smallest neighbour it has seen; keys with many neighbours are
    combined before the shuffle and split by adaptive execution in the join. Each round is written out.
    """
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("low"))
        low = low.select("src", F.least("src", "low").alias("low"))
        # Large star: larger neighbours move to the smallest one known.
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.where("src <> dst").distinct()
        # Small star: a node's smaller neighbours, and itself, move to the smallest of them.
        floor = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(floor, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        stars = floor.select("src", F.col("low").alias("dst"))
        moved = materialize(small.union(stars).distinct(), "simhash-round")
        # Done when every node points at one root, and no root points anywhere.
        many = moved.groupBy("src").count().where("count > 1").limit(1)
        chained = moved.select(F.col("dst").alias("src")).join(moved.select("src"), "src", "left_semi").limit(1)
        edges = moved
        if many.isEmpty() and chained.isEmpty():
            return moved.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    raise RuntimeError("components did not settle")


def near_duplicates(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    budget: int = BUDGET) -> DataFrame:
    """(id, fp, component_id) for every row with a non-null id; ids are whole numbers."""
    named_rows = frame.where(F.col(id_col).isNotNull())
    prints = materialize(fingerprints(named_rows, id_col, text_col, shingle), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-nodes")
    roots = components(links(nodes, budget))
    named = nodes.join(roots, nodes["rep"] == roots["node"], "left").select(
        F.col("fp"), F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(named, "fp").select("id", "fp", "component_id")


def keep_one(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             budget: int = BUDGET) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id, all columns as they came.

    Rows that repeat this id are repeated rows of one document, and one of them stays; rows without an id all stay.
    """
    first = near_duplicates(frame, id_col, text_col, shingle, budget).where("id = component_id")
    kept = materialize(first.groupBy("id").agg(F.count("*").alias("rows")), "simhash-kept")
    joined = frame.join(kept, frame[id_col] == kept["id"], "left_semi")
    if not kept.where("rows > 1").isEmpty():  # texts are shuffled once more only for ids that repeat
        joined = joined.dropDuplicates([id_col])
    return joined.unionByName(frame.where(F.col(id_col).isNull()))
