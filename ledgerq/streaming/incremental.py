"""Restartable loads: a file stream that takes in only what earlier runs have not."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerq.operators.dedup import repeated_keys
from ledgerq.operators.rules import REJECT_COLUMNS, WRITE, accepted
from ledgerq.sources.delimited import FILE_POSITION, number_rows, parsed, placed
from ledgerq.sources.workspace import cut

_BATCH_ROWS = 1 << 40  # seq has room for so many rows in a batch
_BATCH, _BUCKET = "lote", "_bucket"


@dataclass(frozen=True)
class UniqueKey:
    """A natural key that holds over all batches: columns of the validated rows, and the reject of a later arrival.

    ``reason`` has one ``%s`` for the ``seq`` of the row that keeps the key. Keys seen are kept in ``buckets``
    folders by hash, so that a batch reads the buckets of its own keys only.
    """

    columns: Sequence[str]
    code: str
    reason: str
    buckets: int = 256


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    validate: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    bytes_per_batch: int = 1 << 42,
    unique: UniqueKey | None = None,
) -> None:
    """Validate every file that arrived since the last call and add it to the table at ``target``.

    The checkpoint remembers the files. Each micro-batch goes to a folder of its own number, so a
    batch repeated after a failure replaces itself: rows are added exactly once. ``seq`` orders
    rows by batch, then file, then line. A backlog is taken in batches of about ``bytes_per_batch``
    (4 TiB, of lines of four bytes or more); a batch of too many rows for ``seq`` raises.

    With ``unique``, an accepted row whose key an earlier row holds, of this batch or any before it, becomes a
    write reject of its batch. The keys a batch brings are a table beside ``target``, a folder per batch: a batch
    looks only at those of lower number, so that repeating it changes nothing.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = number_rows(cut(parsed(placed(batch), schema), "lines"))
        full = F.raise_error(F.lit("too many rows in a batch; lower bytes_per_batch")).cast("long")
        seq = F.when(F.col("seq") < _BATCH_ROWS, F.col("seq") + F.lit(batch_id * _BATCH_ROWS)).otherwise(full)
        rows = validate(rows.withColumn("seq", seq))
        if unique is not None:
            rows = _first_of_key(cut(rows, "validated"), unique, seen_path(target), batch_id)
        rows.write.mode("overwrite").parquet(f"{target}/{_BATCH}={batch_id}")

    query = (
        spark.readStream.option("maxBytesPerTrigger", bytes_per_batch)
        .text(source)
        .selectExpr(*FILE_POSITION, "value")
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """All validated rows taken in so far, with the batch (``lote``) that brought them."""
    return spark.read.parquet(target)


def seen_path(target: str) -> str:
    """Where the keys that a table's batches brought are kept."""
    return f"{target.rstrip('/')}-claves"


def _first_of_key(rows: DataFrame, unique: UniqueKey, seen: str, batch_id: int) -> DataFrame:
    """``rows``, a written table, with the later arrivals of a key turned into rejects; notes the batch's new keys."""
    spark, keys = rows.sparkSession, list(unique.columns)
    ok = accepted(rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(unique.buckets)).cast("int").alias(_BUCKET)
    mine = cut(ok.groupBy(*keys).agg(F.min("seq").alias("_mine")).select("*", bucket), "batch-keys")
    before = _seen_before(spark, seen, mine, batch_id)
    # Keys seen before this batch, among its own; written, so that Spark knows how few they are.
    old = None if before is None else cut(_meet(before, mine, keys).select(*keys, F.col("_kept")), "old-keys")
    new = mine if old is None else _meet(mine, old, keys, "left_anti")
    new.withColumnRenamed("_mine", "_kept").write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{seen}/{_BATCH}={batch_id}")
    # Repeated within the batch, or known before it: only these meet the rows.
    again = repeated_keys(ok, keys)
    taken = again if old is None else _meet(again, old, keys, "left_anti").unionByName(old)
    taken = cut(taken.select("_kept", *(F.col(k).alias(f"_key_{k}") for k in keys)), "taken-keys")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys), F.col("reject_code").isNull())
    met = rows.join(taken, same, "left")
    late = F.col("_kept").isNotNull() & (F.col("seq") > F.col("_kept"))
    values = (F.lit(WRITE), F.lit(unique.code), F.format_string(unique.reason, F.col("_kept").cast("string")))
    marked = {c: F.when(late, v).otherwise(F.col(c)) for c, v in zip(REJECT_COLUMNS, values, strict=True)}
    return met.withColumns(marked).select(*rows.columns)


def _seen_before(spark: SparkSession, seen: str, mine: DataFrame, batch_id: int) -> DataFrame | None:
    """Keys that batches of lower number brought, of the buckets that this batch has keys in."""
    if batch_id == 0:
        return None
    touched = [r[0] for r in mine.select(_BUCKET).distinct().collect()]  # as many as there are buckets, at most
    names = [c for c in mine.columns if c not in ("_mine", _BUCKET)]
    fields = [*mine.select(*names).schema, *(T.StructField(c, t) for c, t in (("_kept", T.LongType()), (_BATCH, T.LongType()), (_BUCKET, T.IntegerType())))]
    try:
        table = spark.read.schema(T.StructType(fields)).parquet(seen)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.where((F.col(_BATCH) < batch_id) & F.col(_BUCKET).isin(touched)).select(*names, "_kept")


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    named = right.select(*(F.col(k).alias(f"_key_{k}") for k in keys))
    return left.join(named, reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys)), how)
