"""Quality classifier: logistic regression over hashed word n-grams, trained by follow the regularised leader.

Tokens are runs of word characters and runs of other visible characters; a token equal to the one before it becomes
one mark for repetition. Single tokens and pairs of neighbours are hashed into 2 ** ``BITS`` weights. A text's margin is the
bias plus the sparse dot product of its n-gram counts with the weights, over the square root of the number of
n-grams; the score is its logistic.

Training takes a bounded hash sample of about ``SAMPLE`` labelled rows that aren't held out, dealt to ``SHARDS`` shards
by hash; each is learned by FTRL-proximal in hash order, and the weights are averaged.

Null texts count as empty: their score is that of the bias. Labels other than 0 and 1 and null keys are not learned
from; of several labels of a key the highest counts. Without labels of both kinds the score is their smoothed share.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped, mix64, remainder

BITS, SAMPLE, SHARDS, EPOCHS = 18, 12_000, 4, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
_token = re.compile(r"\w+|[^\w\s]+")
_MASK = np.uint64((1 << BITS) - 1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = np.uint64(1)


class _Tokens(dict):
    def __missing__(self, token: str) -> int:
        value = zlib.crc32(token.encode("utf-8", "surrogatepass")) + 2
        if len(self) < 100_000:
            self[token] = value
        return value


_tokens = _Tokens()


def features(text: str | None) -> np.ndarray:
    """The hashed n-grams of a text, one number per occurrence."""
    tokens = _token.findall(text or "")
    if not tokens:
        return np.empty(0, np.int64)
    x = np.fromiter(map(_tokens.__getitem__, tokens), np.uint64, len(tokens))
    same = np.flatnonzero(x[1:] == x[:-1]) + 1
    x[same] = _REPEATED
    pairs = mix64(x[:-1] * _PAIR + x[1:])
    return (np.concatenate([mix64(x), pairs]) & _MASK).astype(np.int64)


def margin(found: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[-1] + (weights[found].sum() / np.sqrt(len(found)) if len(found) else 0.0))


def logistic(m: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(m, -35, 35))))


def train(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Weights, the bias last, from (n-grams, label) in the order given, ``EPOCHS`` times."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    sparse = []
    for found, label in rows:
        at, count = np.unique(found, return_counts=True)
        sparse.append((np.append(at, size - 1), np.append(count / np.sqrt(max(len(found), 1)), 1.0), label))

    def weight(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for at, value, label in sparse:
            w = weight(at)
            g = (logistic(float(w @ value)) - label) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weight(np.arange(size))


def _shard(group: pa.Table) -> pa.Table:
    group = group.sort_by([("_order", "ascending"), ("_text", "ascending")])
    rows = [(features(t), y) for t, y in zip(group["_text"].to_pylist(), group["_label"].to_pylist(), strict=True)]
    w = train(rows)
    at = np.flatnonzero(w)
    return pa.table({"i": pa.array(at, pa.int64()), "w": pa.array(w[at], pa.float64())})


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights, the bias last."""
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .where(remainder(F.col(key), 3) != 1)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    n = marked.count()
    weights = np.zeros((1 << BITS) + 1)
    chosen = marked.where(F.pmod(F.xxhash64("_key"), 1_000_000) < int(min(1.0, SAMPLE / max(n, 1)) * 1_000_000))
    rows = cut(
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .join(chosen, "_key")
        .select("_label", "_text", F.xxhash64("_key", F.lit(1)).alias("_order"), F.pmod(F.xxhash64("_key", F.lit(2)), SHARDS).alias("_shard")),
        "labelled",
    )
    ones, all_ = rows.agg(F.coalesce(F.sum("_label"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < ones < all_:
        weights[-1] = np.log((ones + 1) / (all_ - ones + 1))
        return weights
    shards = rows.select("_shard").distinct().count()
    found = rows.groupBy("_shard").applyInArrow(_shard, "i long, w double").groupBy("i").agg(F.sum("w").alias("w")).toArrow()
    weights[found["i"].to_numpy()] = found["w"].to_numpy() / shards
    return weights


def scores(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def rows(batches):
        for batch in batches:
            found = [logistic(margin(features(t.as_py()), model.value)) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_out"], pa.array(found, pa.float64())], ["_id", "_out", "_score"])

    return mapped(
        docs.select(F.col(key).cast("long").alias("_id"), (remainder(F.col(key), 3) == 1).alias("_out"), F.col(text).alias("_text")),
        rows,
        "_id long, _out boolean, _score double",
    ).select(
        F.col("_id").alias(key),
        F.col("_out").alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """The rows with a score of 0.5 or more, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            keep = [logistic(margin(features(t.as_py()), model.value)) >= 0.5 for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
