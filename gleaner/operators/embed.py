"""Texts to vectors: encoders, and a cache table so that no text is encoded twice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.hashing import hashed_vector
from gleaner.functions.text import text_key
from gleaner.functions.vectors import l2_normalize
from gleaner.runtime import materialize, read_table, salted_join, slice_rows


class Encoder(Protocol):
    """Anything that adds an array<float> column for a text column."""

    dim: int
    # True when encoding costs more than a shuffle, so each distinct text is encoded once.
    costly: bool
    # Names the vectors: two encoders of one name must give equal vectors.
    name: str

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame: ...


@dataclass(frozen=True)
class HashingEncoder:
    dim: int = 64
    normalize: bool = True
    costly: bool = False

    @property
    def name(self) -> str:
        return f"hashing-{self.dim}{'' if self.normalize else '-raw'}"

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame:
        return df.withColumn(into, hashed_vector(F.col(text), self.dim, self.normalize))


@dataclass(frozen=True)
class ModelEncoder:
    """A caller's model. `load()` runs once per Python worker and returns f(texts) -> (n, dim) array.

    Encoders that share a cache need names of their own.
    """

    load: Callable[[], Callable[[Any], Any]]
    dim: int
    batch_size: int = 64
    normalize: bool = True
    costly: bool = True
    model: str = "model"

    @property
    def name(self) -> str:
        return f"{self.model}-{self.dim}{'' if self.normalize else '-raw'}"

    def encode(self, df: DataFrame, text: str, into: str) -> DataFrame:
        predict = predict_batch_udf(
            self.load, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size
        )
        encoded = df.withColumn(into, predict(F.col(text)))
        if self.normalize:
            encoded = encoded.withColumn(into, l2_normalize(F.col(into)).cast("array<float>"))
        return encoded


class EmbeddingCache:
    """Vectors by encoder and text key, in folders by key; a new path is an empty cache.

    A call reads the folders of the keys it asks for, of its encoder only. Use thousands of folders where calls ask for few
    texts of a large cache.
    """

    def __init__(self, spark: SparkSession, path: str, folders: int = 64) -> None:
        self.spark = spark
        self.path = path
        self.folders = folders

    def _folder(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.folders)).cast("int")

    def _table(self, encoder: str) -> DataFrame | None:
        table = read_table(self.spark, self.path)
        return None if table is None else table.where(F.col("encoder") == encoder)

    def lookup(self, keys: DataFrame, encoder: str) -> DataFrame | None:
        """(key, embedding) of those keys that the cache holds; `keys` should be a written table."""
        table = self._table(encoder)
        if table is None:
            return None
        # At most as many numbers as folders; literal ones prune the scan.
        asked = [r[0] for r in keys.select(self._folder()).distinct().collect()]
        found = table.where(F.col("folder").isin(asked)).join(keys.select("key"), "key", "left_semi")
        # Two writers may race on the same text; any of their equal vectors will do.
        return found.groupBy("key").agg(F.any_value("embedding").alias("embedding"))

    def read(self, encoder: str) -> DataFrame | None:
        """Everything that one encoder has left here."""
        table = self._table(encoder)
        return None if table is None else table.groupBy("key").agg(F.any_value("embedding").alias("embedding"))

    def add(self, vectors: DataFrame, encoder: str) -> None:
        rows = vectors.select("key", "embedding", F.lit(encoder).alias("encoder"), self._folder().alias("folder"))
        rows.hint("rebalance", "folder").write.mode("append").partitionBy("encoder", "folder").parquet(self.path)

    def compacted(self, path: str, folders: int | None = None) -> "EmbeddingCache":
        """A copy without repeated keys and with few files a folder, whatever the number of calls that filled it."""
        copy = EmbeddingCache(self.spark, path, folders or self.folders)
        table = read_table(self.spark, self.path)
        if table is not None:
            once = table.groupBy("encoder", "key").agg(F.any_value("embedding").alias("embedding"))
            rows = once.withColumn("folder", copy._folder())
            rows.hint("rebalance", "encoder", "folder").write.partitionBy("encoder", "folder").parquet(path)
        return copy


def cache_misses(texts: DataFrame, cached: DataFrame | None, text: str = "text") -> DataFrame:
    """Distinct texts that the cache lacks: (key, text, n) with n rows of `texts` each."""
    distinct = texts.groupBy(text_key(F.col(text)).alias("key")).agg(
        F.any_value(F.col(text)).alias("text"), F.count("*").alias("n")
    )
    return distinct if cached is None else distinct.join(cached.select("key"), "key", "left_anti")


def embed(
    df: DataFrame,
    encoder: Encoder,
    cache: EmbeddingCache | None = None,
    text: str = "text",
    into: str = "embedding",
) -> DataFrame:
    """Add the vector of `text` to every row.

    A cheap encoder runs in place, without a shuffle. A costly one, or one with
    a cache, sees each distinct missing text once; the vectors are joined back
    by text key, with the keys of often repeated texts cut into slices.
    """
    if cache is None and not encoder.costly:
        return encoder.encode(df, text, into)
    if cache is None:
        counted = cache_misses(df, None, text)
        vectors = encoder.encode(counted, "text", into).select("key", "n", into)
    else:
        # Written: read for its folders, for what is missing, and for the vectors.
        counted = materialize(cache_misses(df, None, text), "asked-texts")
        known = cache.lookup(counted, encoder.name)
        missing = counted if known is None else counted.join(known.select("key"), "key", "left_anti")
        made = materialize(encoder.encode(missing, "text", "embedding").select("key", "embedding"), "new-vectors")
        # What was known is looked up before the cache grows, so that a text has one vector here.
        vectors = made if known is None else materialize(known, "known-vectors").unionByName(made)
        cache.add(made, encoder.name)
        vectors = counted.join(vectors, "key").select("key", "n", F.col("embedding").alias(into))
    keyed = df.withColumn("key", text_key(F.col(text)))
    per_slice = slice_rows(df.count())
    # Copies of one text differ in their other columns, which spread them over its slices.
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return salted_join(keyed, vectors, "key", F.col("n"), per_slice, hashable).select(*df.columns, into)
