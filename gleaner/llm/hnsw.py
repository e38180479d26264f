"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Vectors are sharded by a hash of their content, so that copies meet: a shard's graph holds each distinct vector
once, with the smallest ids that share it. Graphs are flat arrays - one neighbour matrix per level - and are
built for blocks of vectors at once: a block searches the graph so far, keeps diverse neighbours, and is linked
both ways. The index is a table with one row per shard. Every query goes to every shard of its length; a shard
answers with k rows per query, re-measured in double precision, and these are merged.

Cases: vectors that are null, empty, zero or hold a null or non-finite component take no part; vectors meet only those
of their length; a query's own id is no candidate; ties go to the smaller id; repeated rows of one id count once;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.runtime import fits_broadcast, materialize

SHARD_ROWS = 16_384
LINKS = 16
BUILD_WIDTH = 96
SEARCH_WIDTH = 256
BLOCK = 256
QUERY_BLOCK = 128


@dataclass
class Graph:
    """Flat neighbour arrays: level 0 for all vectors, higher levels for fewer; -1 where there is no neighbour."""

    vectors: np.ndarray  # float32 [n, d]
    neighbours: list[np.ndarray]  # per level int32 [n or fewer, width]
    slots: list[np.ndarray]  # per level: row of a vector in that level's matrix, or -1
    entry: int
    top: int


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each query [q, d] to its own candidates [q, c, d]."""
    gap = b - a[:, None, :]
    return np.einsum("qcd,qcd->qc", gap, gap)


def search_level(graph: Graph, level: int, queries: np.ndarray, entries: np.ndarray, width: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries together on one level: (ids, squared distances) by distance, -1 where there are fewer."""
    links, slot = graph.neighbours[level], graph.slots[level]
    q, n, m = len(queries), len(graph.vectors), links.shape[1]
    rows = np.arange(q)
    seen = np.zeros((q, n), bool)
    ids = np.full((q, width), -1, np.int64)
    dist = np.full((q, width), np.inf, np.float32)
    open_ = np.zeros((q, width), bool)
    for k in range(entries.shape[1]):  # several entries may be given
        e = entries[:, k]
        fresh = (e >= 0) & ~seen[rows, np.maximum(e, 0)]
        seen[rows[fresh], e[fresh]] = True
        ids[fresh, k], open_[fresh, k] = e[fresh], True
        dist[fresh, k] = _distances(queries[fresh], graph.vectors[e[fresh]][:, None, :])[:, 0]
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist, open_ = (np.take_along_axis(x, order, 1) for x in (ids, dist, open_))
    active = rows
    while len(active):
        waiting = open_[active]
        has = waiting.any(axis=1)
        active = active[has]
        if not len(active):
            break
        waiting = waiting[has]
        # The nearest unvisited ones of each query.
        rank = np.cumsum(waiting, axis=1)
        chosen = waiting & (rank <= at_once)
        ar, ac = np.nonzero(chosen)
        open_[active[ar], ac] = False
        found = links[slot[ids[active[ar], ac]]]
        block = np.full((len(active), at_once * m), -1, np.int64)
        place = (rank[ar, ac] - 1)[:, None] * m + np.arange(m)
        block[ar[:, None], place] = found
        valid = block >= 0
        valid &= ~seen[active[:, None], np.maximum(block, 0)]
        # A neighbour met twice in one step counts once.
        order = np.argsort(np.where(valid, block, n), axis=1, kind="stable")
        block, valid = np.take_along_axis(block, order, 1), np.take_along_axis(valid, order, 1)
        valid[:, 1:] &= block[:, 1:] != block[:, :-1]
        keep = valid.any(axis=0)
        block, valid = block[:, keep], valid[:, keep]
        if not block.shape[1]:
            continue
        vr, vc = np.nonzero(valid)
        seen[active[vr], block[vr, vc]] = True
        gap = graph.vectors[block[vr, vc]] - queries[active[vr]]
        d = np.full(block.shape, np.inf, np.float32)
        d[vr, vc] = np.einsum("ij,ij->i", gap, gap)
        d[d >= dist[active, -1:]] = np.inf
        all_d = np.concatenate((dist[active], d), axis=1)
        all_i = np.concatenate((ids[active], np.where(np.isfinite(d), block, -1)), axis=1)
        all_o = np.concatenate((open_[active], np.isfinite(d)), axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        dist[active] = np.take_along_axis(all_d, order, 1)
        ids[active] = np.take_along_axis(all_i, order, 1)
        open_[active] = np.take_along_axis(all_o, order, 1)
    return ids, dist


def diverse(vectors: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` candidates per row, nearest first, each nearer to the row's vector than to those chosen before;
    places left over go to the nearest of the rest. ids, dist [q, c] by distance; -1 pads."""
    q, c = ids.shape
    points = vectors[np.maximum(ids, 0)]
    norms = np.einsum("qcd,qcd->qc", points, points)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
    taken = np.zeros((q, c), bool)
    count = np.zeros(q, np.int64)
    for k in range(c):
        nearer = (between[:, k, :] < dist[:, k, None]) & taken
        take = (ids[:, k] >= 0) & ~nearer.any(axis=1) & (count < most)
        taken[:, k] = take
        count += take
    order = np.argsort(np.where(ids < 0, 2, np.where(taken, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    if out.shape[1] < most:
        out = np.concatenate((out, np.full((q, most - out.shape[1]), -1, out.dtype)), axis=1)
    return out


def _link_back(graph: Graph, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
    """Add each new vector to the lists of the neighbours it chose; lists that overflow keep diverse ones."""
    links, slot = graph.neighbours[level], graph.slots[level]
    width = links.shape[1]
    target, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    at, first, count = np.unique(target, return_index=True, return_counts=True)
    old = links[slot[at]]
    more = int(count.max()) if len(count) else 0
    incoming = np.full((len(at), more), -1, np.int64)
    incoming[np.repeat(np.arange(len(at)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    merged = np.concatenate((old, incoming), axis=1)
    for a in range(0, len(at), 1024):
        part, own = merged[a : a + 1024], graph.vectors[at[a : a + 1024]]
        d = _distances(own, graph.vectors[np.maximum(part, 0)])
        d[part < 0] = np.inf
        # A neighbour that stands in the list twice counts once.
        order = np.argsort(part, axis=1, kind="stable")
        part, d = np.take_along_axis(part, order, 1), np.take_along_axis(d, order, 1)
        twice = np.zeros(part.shape, bool)
        twice[:, 1:] = (part[:, 1:] == part[:, :-1]) & (part[:, 1:] >= 0)
        part[twice], d[twice] = -1, np.inf
        order = np.argsort(d, axis=1, kind="stable")
        part, d = np.take_along_axis(part, order, 1), np.take_along_axis(d, order, 1)
        room = int((part >= 0).sum(axis=1).max()) if len(part) else 0
        part, d = part[:, : max(room, 1)], d[:, : max(room, 1)]
        full = (part >= 0).sum(axis=1) > width
        kept = np.full((len(part), width), -1, np.int64)
        w = min(width, part.shape[1])
        kept[:, :w] = part[:, :w]
        if full.any():
            kept[full] = diverse(graph.vectors, part[full], d[full], width)
        links[slot[at[a : a + 1024]]] = kept


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, block: int = BLOCK, seed: int = 7) -> Graph:
    """The graph of distinct float32 vectors, inserted in blocks in the given order."""
    n = len(vectors)
    vectors = np.ascontiguousarray(vectors, np.float32)
    rng = np.random.default_rng(seed)
    levels = np.minimum((-np.log(rng.random(n)) / np.log(links)).astype(int), 6)
    if n:
        levels[0] = levels.max()
    top = int(levels.max()) if n else 0
    matrices, slots = [], []
    for level in range(top + 1):
        members = np.flatnonzero(levels >= level)
        slot = np.full(n, -1, np.int64)
        slot[members] = np.arange(len(members))
        slots.append(slot)
        matrices.append(np.full((len(members), 2 * links if level == 0 else links), -1, np.int64))
    graph = Graph(vectors, matrices, slots, 0, top)
    done, size = 1, 1
    while done < n:
        new = np.arange(done, min(n, done + size))
        points = vectors[new]
        entries = np.zeros((len(new), 1), np.int64)
        # Members of a block do not see each other in the graph; they are compared directly.
        norms = np.einsum("ij,ij->i", points, points)
        among = norms[:, None] + norms[None, :] - 2 * (points @ points.T)
        np.fill_diagonal(among, np.inf)
        for level in range(top, -1, -1):
            here = levels[new] >= level
            ids, dist = search_level(graph, level, points, entries, width if here.any() else 1)
            entries = ids[:, : min(4, ids.shape[1])]
            entries = np.where(entries >= 0, entries, entries[:, :1])
            if not here.any():
                continue
            own, o_ids, o_dist = new[here], ids[here], dist[here]
            if len(own) > 1:
                inner = among[np.ix_(here, here)]
                near = np.argsort(inner, axis=1, kind="stable")[:, : min(links, len(own) - 1)]
                o_ids = np.concatenate((o_ids, own[near]), axis=1)
                o_dist = np.concatenate((o_dist, np.take_along_axis(inner, near, 1)), axis=1)
                order = np.argsort(o_dist, axis=1, kind="stable")
                o_ids, o_dist = np.take_along_axis(o_ids, order, 1), np.take_along_axis(o_dist, order, 1)
            chosen = diverse(vectors, o_ids, o_dist, links)
            matrix, slot = graph.neighbours[level], graph.slots[level]
            matrix[slot[own], :links] = chosen
            _link_back(graph, level, own, chosen)
        done += len(new)
        size = min(block, done)
    graph.neighbours = [m.astype(np.int32) for m in matrices]
    return graph


def search(graph: Graph, queries: np.ndarray, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of up to `width` nearest vectors of each query."""
    if not len(graph.vectors):
        return np.full((len(queries), 1), -1), np.full((len(queries), 1), np.inf)
    entries = np.full((len(queries), 1), graph.entry, np.int64)
    for level in range(graph.top, 0, -1):
        ids, _ = search_level(graph, level, queries, entries, 8)
        entries = np.where(ids >= 0, ids, ids[:, :1])
    return search_level(graph, 0, queries, entries, max(width, entries.shape[1]))


def stored(graph: Graph, exact: np.ndarray, ids: list[list[int]]) -> bytes:
    """A shard as plain arrays in one binary value."""
    arrays = {f"links{k}": m for k, m in enumerate(graph.neighbours)} | {f"slots{k}": m for k, m in enumerate(graph.slots)}
    counts = np.array([len(own) for own in ids], np.int64)
    flat = np.array([i for own in ids for i in own], np.int64)
    out = io.BytesIO()
    np.savez(out, exact=exact, counts=counts, ids=flat, shape=np.array([graph.entry, graph.top]), **arrays)
    return out.getvalue()


def restored(value: bytes) -> tuple[Graph, np.ndarray, list[list[int]]]:
    arrays = np.load(io.BytesIO(value), allow_pickle=False)
    exact, (entry, top) = arrays["exact"], arrays["shape"].tolist()
    levels = range(top + 1)
    links, slots = [arrays[f"links{k}"] for k in levels], [arrays[f"slots{k}"] for k in levels]
    ends = np.cumsum(arrays["counts"]).tolist()
    flat = arrays["ids"].tolist()
    ids = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    return Graph(exact.astype(np.float32), links, slots, entry, top), exact, ids


# Tables -----------------------------------------------------------------------------


def usable(column: Column) -> Column:
    """Vectors that take part: finite numbers, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return column.isNotNull() & ~F.exists(column, bad) & F.exists(column, lambda x: x != 0)


def vectors_of(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = frame.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("v")))


def _fewest(ids: list[int], most: int) -> list[int]:
    return sorted(set(ids))[:most]


def shard_index(rows: DataFrame, keep_ids: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, graph binary): one row per shard of (id, v), written out.

    Copies of a vector are first brought together within each task, keeping their `keep_ids` smallest ids - no
    more of them can be among the nearest - so a vector that fills a third of the table is a few rows in the shuffle.
    """
    shards = max(1, -(-rows.count() // shard_rows))

    def bring_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, list[int]] = {}
        for batch in batches:
            for key, v in zip(batch["id"].tolist(), batch["v"], strict=True):
                found.setdefault(np.asarray(v, np.float64).tobytes(), []).append(key)
            if len(found) > 20_000:
                yield _rows(found, keep_ids)
                found = {}
        if found:
            yield _rows(found, keep_ids)

    together = rows.mapInPandas(bring_together, "v binary, ids array<bigint>")
    keyed = together.select(
        "v", "ids",
        (F.octet_length("v") / 8).cast("int").alias("dim"),
        F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"),
    )

    def graphs(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found: dict[bytes, list[int]] = {}
        for v, ids in zip(group["v"], group["ids"], strict=True):
            found.setdefault(bytes(v), []).extend(int(i) for i in ids)
        # A fixed order that has nothing to do with the order of arrival.
        order = sorted(found, key=lambda v: min(found[v]))
        exact = np.frombuffer(b"".join(order), np.float64).reshape(len(order), -1)
        ids = [_fewest(found[v], keep_ids) for v in order]
        graph = build(exact.astype(np.float32))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [stored(graph, exact, ids)]})

    made = keyed.groupBy("dim", "shard").applyInPandas(graphs, "dim int, shard int, graph binary")
    return materialize(made, "hnsw-index")


def _rows(found: dict[bytes, list[int]], keep_ids: int) -> pd.DataFrame:
    return pd.DataFrame({"v": list(found), "ids": [_fewest(ids, keep_ids) for ids in found.values()]})


def search_index(index: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each query (id, v), from a table of shards.

    Queries go to the shards, never the other way: a task reads one graph, then streams through
    the queries in blocks and returns k rows for each. The k rows of all shards are merged per query.
    """
    names = index.select("dim", "shard")
    if fits_broadcast(names):  # a row per shard: not dealt by `dim`, which may be one value
        names = F.broadcast(names)
    # Of vectors under one id the least is asked for.
    asked = queries.groupBy("id").agg(F.min("v").alias("v")).select(F.size("v").alias("dim"), "id", "v").join(names, "dim")
    kinds = "dim", "shard", "kind", "id", "v", "graph"
    both = (
        index.withColumns({"kind": F.lit(0), "id": F.lit(None).cast("bigint"), "v": F.lit(None).cast("array<double>")})
        .select(*kinds)
        .unionByName(asked.withColumns({"kind": F.lit(1), "graph": F.lit(None).cast("binary")}).select(*kinds))
    )
    parts = max(index.count(), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = both.repartition(parts, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, None
        for batch in batches:
            for key, part in batch.groupby(["dim", "shard"], sort=False):
                if key != at:
                    at, held = key, None
                graphs = part[part["kind"] == 0]
                if len(graphs):
                    held = restored(graphs["graph"].iloc[0])
                part = part[part["kind"] == 1]
                for low in range(0, len(part), QUERY_BLOCK):
                    block = part.iloc[low : low + QUERY_BLOCK]
                    rows = nearest(held, block["id"].tolist(), np.array(block["v"].tolist(), np.float64), k, width)
                    yield pd.DataFrame(rows, columns=["query_id", "id", "score"])

    found = sent.mapInPandas(answer, "query_id bigint, id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    ranks = found.withColumn("rank", F.row_number().over(order))
    return ranks.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def nearest(shard: tuple, owners: list[int], points: np.ndarray, k: int, width: int) -> list[tuple[int, int, float]]:
    """(query, id, distance) of the k nearest of a shard for each query, measured again in double precision."""
    graph, exact, ids = shard
    found, _ = search(graph, points.astype(np.float32), width)
    out = []
    for own, point, row in zip(owners, points, found, strict=True):
        row = row[row >= 0]
        gap = exact[row] - point
        score = np.sqrt((gap * gap).sum(axis=1))
        near = sorted((s, i) for s, r in zip(score.tolist(), row.tolist()) for i in ids[r] if i != own)
        out += [(own, i, s) for s, i in near[:k]]
    return out
