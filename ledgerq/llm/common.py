"""What the operators share: session settings, Arrow row streams, stable row keys, learning splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerq.sources.workspace import cut

__all__ = ["MIX", "WordHashes", "cut", "mapped", "mix64", "prepare", "remainder", "table"]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators count on; sizes and partitions stay the session's own."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Texts differ a lot in length: small batches bound what a Python worker holds at once.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    }.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def mapped(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """Arrow batches in, Arrow batches out, inside the tasks that hold the rows."""
    return df.mapInArrow(rows, schema)


#: Odd 64-bit multipliers of a finaliser with full avalanche.
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x *= MIX[0]
    x ^= x >> np.uint64(33)
    x *= MIX[1]
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """A 64-bit hash of each word. Holds up to ``limit`` words; others are hashed each time."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word):
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
