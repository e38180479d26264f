"""Which ids an index may hold: small filters, so that a batch is checked without reading the ids that came before it.

A filter is a Bloom filter in slices: an id's hash names its slice, and a few bits of that slice. Filters are written per run of batches
(`tiers`); an id that no filter knows is new for sure, and the few others are looked up where they would lie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids of a slice, bits an id, and bits set for each: about 3 of 1,000 new ids pass a filter.
SLICE_IDS = 65_536
BITS_AN_ID, PROBES = 12, 8
# New ids that one task holds against a slice.
TASK_IDS = 1_000_000

FILTER = "kind string, slice int, slices int, bits binary"


def hashes() -> tuple[Column, Column]:
    """Two hashes of an `id`: h and g."""
    return F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(1)).alias("g")


def _places(h: np.ndarray, g: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each id, a row of `PROBES`."""
    h, g = h.astype(np.int64).view(np.uint64), g.astype(np.int64).view(np.uint64) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    mixed = (g[:, None] + steps * (h[:, None] | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)


def filters_of(ids: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(kind, slice, slices, bits) of the distinct ids of (kind, id); `counts` has their number by kind."""
    slices = {kind: max(1, math.ceil(n / SLICE_IDS)) for kind, n in counts.items()}
    bits = {kind: 64 * math.ceil(BITS_AN_ID * max(1, n) / slices[kind] / 64) for kind, n in counts.items()}

    def build(group: pd.DataFrame) -> pd.DataFrame:
        kind = group["kind"].iloc[0]
        marks = np.zeros(bits[kind], bool)
        marks[_places(group["h"].to_numpy(), group["g"].to_numpy(), bits[kind]).ravel()] = True
        row = {"kind": [kind], "slice": [group["slice"].iloc[0]], "slices": [slices[kind]], "bits": [np.packbits(marks).tobytes()]}
        return pd.DataFrame(row)

    # Slices hold equal shares of distinct ids, whatever the ids.
    many = F.create_map(*[x for kind, n in slices.items() for x in (F.lit(kind), F.lit(n))])
    keyed = ids.select("kind", *hashes()).withColumn("slice", F.pmod("h", many[F.col("kind")]).cast("int"))
    return keyed.groupBy("kind", "slice").applyInPandas(build, FILTER)


def may_hold(ids: DataFrame, filters: DataFrame, shapes: list[tuple[str, int]]) -> DataFrame:
    """The ids (id) that some filter knows; `filters` has (tier, slice, slices, bits), `shapes` is (tier, slices) of each tier.

    Filters and ids meet by slice; a slice that many new ids fall into is repeated, and the ids are dealt over its copies.
    """
    if not shapes:
        return ids.limit(0)
    n = ids.count()
    copies = {tier: max(1, math.ceil(n / slices / TASK_IDS)) for tier, slices in shapes}
    looks = [
        F.struct(
            F.lit(tier).alias("tier"),
            F.pmod("h", F.lit(slices)).cast("int").alias("slice"),
            F.pmod("g", F.lit(copies[tier])).cast("int").alias("copy"),
        )
        for tier, slices in shapes
    ]
    asked = ids.select("id", *hashes()).select("id", "h", "g", F.explode(F.array(*looks)).alias("at")).select("at.*", "id", "h", "g")
    many = F.create_map(*[x for tier, c in copies.items() for x in (F.lit(tier), F.lit(c))])
    held = filters.select("tier", "slice", F.explode(F.sequence(F.lit(0), many[F.col("tier")] - 1)).alias("copy"), "bits")
    none = lambda kind: F.lit(None).cast(kind)
    both = held.select("tier", "slice", "copy", F.lit(0).alias("row"), none("string").alias("id"), F.lit(0).cast("bigint").alias("h"), F.lit(0).cast("bigint").alias("g"), "bits").unionByName(
        asked.select("tier", "slice", "copy", F.lit(1).alias("row"), "id", "h", "g", none("binary").alias("bits"))
    )
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = both.repartition(parts, "tier", "slice", "copy").sortWithinPartitions("tier", "slice", "copy", "row")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, marks = None, None
        for batch in batches:
            for key, part in batch.groupby(["tier", "slice", "copy"], sort=False):
                if key != at:  # one slice is held at a time; it stands before its ids
                    at, marks = key, None
                first = part[part["row"] == 0]
                if len(first):
                    marks = np.unpackbits(np.frombuffer(first["bits"].iloc[0], np.uint8)).astype(bool)
                part = part[part["row"] == 1]
                if marks is not None and len(part):
                    known = marks[_places(part["h"].to_numpy(), part["g"].to_numpy(), len(marks))].all(axis=1)
                    yield part.loc[known, ["id"]]

    return sent.mapInPandas(check, "id string").distinct()
