"""Keyed snapshots in hash buckets of their key: a merge writes the buckets it touches and refers to the others.

A snapshot is a folder with ``data``, one folder per bucket written by this merge, and ``manifest``, a small table that
names the folder of every bucket, in this snapshot or an earlier one. Earlier snapshots must stay while one refers to them.
The manifest is written last, so a snapshot without one is not finished.

The stored rows of a touched bucket are not shuffled if the incoming keys are few enough to be broadcast: they are read by
bucket and written by bucket. Each such merge adds files of incoming rows to a bucket, so every ``COMPACT``-th merge of a
bucket brings its rows together in an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerq.operators.upsert import merge_snapshot

BUCKETS, COMPACT = 64, 8
_BUCKET = "_bucket"
_MANIFEST = "buckets int, bucket int, folder string, merges int"


@dataclass(frozen=True)
class Manifest:
    """How many buckets a snapshot has, and for each that holds rows its folder and the merges since it was compact."""

    buckets: int
    folders: dict[int, tuple[str, int]]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """What the snapshot at ``path`` consists of; None for a table that was written without buckets."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").collect()  # a row per bucket and one for the count
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return Manifest(rows[0].buckets, {r.bucket: (r.folder, r.merges) for r in rows if r.folder is not None})


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a snapshot, or of a table without buckets."""
    found = manifest(spark, path)
    if found is None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return _of(spark, [folder for folder, _ in found.folders.values()], schema)


def merge(
    stored: str | None, incoming: DataFrame, keys: Sequence[str], path: str, buckets: int = BUCKETS
) -> DataFrame:
    """Write the snapshot at ``path``: that at ``stored``, its rows replaced by ``incoming`` where the keys are equal.

    ``incoming`` holds a key at most once, and should be a written table: it is read twice, and Spark knows its size.
    A stored snapshot keeps its number of buckets. A table without buckets is dealt into buckets once.
    """
    spark, schema = incoming.sparkSession, incoming.schema
    before = None if stored is None else manifest(spark, stored)
    if before is None:
        old = None if stored is None else read(spark, stored, schema)
        written = _write(_dealt(merge_snapshot(old, incoming, keys), keys, buckets), path, schema)
        return _finish(spark, path, Manifest(buckets, {b: (folder, 0) for b, folder in written.items()}), schema)
    buckets = before.buckets
    touched = {r[0] for r in incoming.select(bucket_of(keys, buckets)).distinct().collect()}  # at most ``buckets``
    met = {b: before.folders[b] for b in touched if b in before.folders}
    full = {b for b, (_, merges) in met.items() if merges + 1 >= COMPACT}
    new = _dealt(incoming, keys, buckets)
    parts = []
    if plain := [folder for b, (folder, _) in met.items() if b not in full]:
        parts.append(_untouched(spark, plain, schema, incoming, keys).withColumn(_BUCKET, bucket_of(keys, buckets)))
    if full:
        old = _untouched(spark, [met[b][0] for b in full], schema, incoming, keys)
        own = new.where(F.col(_BUCKET).isin(full)).drop(_BUCKET)
        parts.append(_dealt(own.unionByName(old), keys, buckets))
        new = new.where(~F.col(_BUCKET).isin(full))
    for part in parts:
        new = new.unionByName(part)
    folders = dict(before.folders)
    if touched:
        for b, folder in _write(new, path, schema).items():
            folders[b] = (folder, met[b][1] + 1 if b in met and b not in full else 0)
    return _finish(spark, path, Manifest(buckets, folders), schema)


def _of(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders).select(*schema.names)


def _untouched(
    spark: SparkSession, folders: list[str], schema: T.StructType, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    return _of(spark, folders, schema).join(incoming.select(*keys), list(keys), "left_anti").select(*schema.names)


def _dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    # AQE cuts a large bucket into several tasks and joins small ones.
    return rows.withColumn(_BUCKET, bucket_of(keys, buckets)).hint("rebalance", _BUCKET)


def _write(rows: DataFrame, path: str, schema: T.StructType) -> dict[int, str]:
    """The folder of each bucket that was written."""
    spark, data = rows.sparkSession, f"{path}/data"
    rows.select(*schema.names, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(data)
    whole = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
    return {r[0]: f"{data}/{_BUCKET}={r[0]}" for r in spark.read.schema(whole).parquet(data).select(_BUCKET).distinct().collect()}


def _finish(spark: SparkSession, path: str, found: Manifest, schema: T.StructType) -> DataFrame:
    rows = [(found.buckets, None, None, None), *((found.buckets, b, f, n) for b, (f, n) in sorted(found.folders.items()))]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return _of(spark, [folder for folder, _ in found.folders.values()], schema)
