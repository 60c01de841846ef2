"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one kept per group.

Centroids are fitted on a bounded hash sample (``SAMPLE_PER_CELL`` vectors per cell, one cell per block or per square
root of the rows, whichever gives fewer); every vector is then assigned. Cells alone would lose pairs that a cell
border parts: two vectors at the threshold are at most r = sqrt(2 - 2 * threshold) apart, and their distances to a
border between them add up to at most that, so one of the two lies within r / 2 of it. A vector is therefore also
shown to every cell whose border is within r / 2, which is exact for any data. A pair that meets in both cells
counts in the lower one. ``reach`` = k takes k * r / sqrt(dimensions) for r, where that is less; it loses pairs.

Cells are cut into blocks of bounded size and only counts and one link to a block's root per vector leave a
comparison, never the pairs. Equal vectors are compared once and counted with their number.

Null, empty and zero vectors and those with a null or non-finite component link with nothing. Vectors of
different lengths don't link; lengths other than the most frequent form a cell each. Rows with a repeated key
are vectors of their own. A null key is never a ``component_id`` unless all keys of its component are null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped
from ledgerq.llm.graph import components

THRESHOLD, BLOCK = 0.95, 1024
SAMPLE_PER_CELL, ROUNDS = 16, 8


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Double vectors; None where a vector links with nothing."""
    out = []
    for value in column:
        x = None
        if value.is_valid:
            items = value.values
            if len(items) and not items.null_count:
                x = np.asarray(items.to_numpy(zero_copy_only=False), dtype=np.float64)
                x = x if np.isfinite(x).all() and x.any() else None
        out.append(x)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _keyed(batches):
    import hashlib

    for batch in batches:
        vectors = _vectors(batch["_v"])
        nodes = [None if x is None else hashlib.md5((x + 0.0).tobytes()).digest() for x in vectors]
        units = [None if x is None else _unit(x) for x in vectors]
        yield pa.RecordBatch.from_arrays(
            [
                batch["_id"],
                pa.array(nodes, pa.binary()),
                pa.array([None if x is None else len(x) for x in vectors], pa.int32()),
                pa.array(units, pa.list_(pa.float64())),
            ],
            ["_id", "_node", "_dim", "_unit"],
        )


def fit(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids of a sample of unit vectors, seeded by evenly spaced sample rows."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1)
        live = size > 1e-9
        centres[live] = sums[live] / size[live, None]
    return np.unique(centres, axis=0)


def _assigner(centres: np.ndarray, reach: float):
    dim = centres.shape[1]
    apart = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2) if len(centres) <= 512 else None

    def rows(batches):
        for batch in batches:
            dims = batch["_dim"].to_numpy()
            of, cell, own_cell, also = [], [], [], [[]] * len(batch["_dim"])
            main = np.flatnonzero(dims == dim)
            if len(main):
                x = np.stack([batch["_unit"][i].values.to_numpy() for i in main])
                scores = x @ centres.T
                own = np.argmax(scores, axis=1)
                best = scores[np.arange(len(x)), own]
                gaps = apart[own] if apart is not None else np.sqrt(np.maximum(2 - 2 * centres[own] @ centres.T, 0))
                shown = best[:, None] - scores <= reach / 2 * gaps + 1e-8
                shown[np.arange(len(x)), own] = False
                i, c = np.nonzero(shown)
                of += [*main, *main[i]]
                cell += [*own, *c]
                own_cell += [*own, *own[i]]
                for k, m in enumerate(main):
                    also[m] = np.flatnonzero(shown[k]).tolist()
            rest = np.flatnonzero(dims != dim)
            of += [*rest]
            cell += [-1] * len(rest)
            own_cell += [-1] * len(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_node"].take(pa.array(of, pa.int64())),
                    batch["_dim"].take(pa.array(of, pa.int64())),
                    batch["_unit"].take(pa.array(of, pa.int64())),
                    batch["_copies"].take(pa.array(of, pa.int64())),
                    pa.array(cell, pa.int32()),
                    pa.array(own_cell, pa.int32()),
                    pa.array([also[i] if c == o else [] for i, c, o in zip(of, cell, own_cell, strict=True)], pa.list_(pa.int32())),
                ],
                ["_node", "_dim", "_unit", "_copies", "_cell", "_own", "_also"],
            )

    return rows


def _block(threshold: float):
    def compare(key, group):
        dim, cell, i, j = (k.as_py() for k in key)
        group = group.combine_chunks()
        x = np.asarray(pc.list_flatten(group["_unit"]).to_numpy()).reshape(-1, dim)
        part, own = np.array(group["_part"]), np.array(group["_own"])
        home = own == cell
        copies = np.array(group["_copies"])
        n = len(x)
        linked = (x @ x.T) >= threshold
        linked &= home[:, None] | home[None, :]
        linked[np.arange(n), np.arange(n)] = False
        if i != j:
            linked &= part[:, None] != part[None, :]
        else:
            linked &= (part == i)[:, None] & (part == i)[None, :]
        # What a vector of a lower cell links here is left to that cell if it is shown there.
        below = np.flatnonzero(own < cell)
        if len(below):
            lower, which = np.unique(own[below], return_inverse=True)
            shown = np.asarray(pc.list_flatten(group["_also"]))
            row = np.repeat(np.arange(n), np.asarray(pc.list_value_length(group["_also"])))
            hit = np.isin(shown, lower)
            meets = np.zeros((n, len(lower)), bool)
            meets[row[hit], np.searchsorted(lower, shown[hit])] = True
            linked[:, below] &= ~meets[:, which]
            linked[below] &= ~meets[:, which].T
        count = linked @ copies
        # Each vector's root within the block: the smallest position that links reach.
        root = np.arange(n)
        some = np.flatnonzero(linked.any(axis=1))
        while len(some):
            low = np.minimum(root[some], np.where(linked[some], root[None, :], n).min(axis=1))
            if (low == root[some]).all():
                break
            root[some] = low
            root = root[root]
        nodes = group["_node"]
        return pa.table(
            {
                "a": nodes.take(pa.array(some, pa.int64())),
                "b": nodes.take(pa.array(root[some], pa.int64())),
                "n": pa.array(count[some], pa.int64()),
            }
        )

    return compare


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    reach: float | None = None,
) -> DataFrame:
    """One row per row: key, ``n_links``, ``component_id`` and ``kept`` (key = component_id)."""
    rows = vectors.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    keyed = cut(mapped(rows, _keyed, "_id long, _node binary, _dim int, _unit array<double>"), "vectors")
    nodes = cut(
        keyed.where("_node is not null")
        .groupBy("_node", "_dim")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_id").alias("_least"), F.first("_unit").alias("_unit")),
        "nodes",
    )
    sizes = nodes.groupBy("_dim").count().orderBy(F.desc("count"), "_dim").limit(1).collect()
    if sizes:
        dim, n = sizes[0]
        cells = max(1, min(math.isqrt(n), n // BLOCK))
        share = min(1.0, SAMPLE_PER_CELL * cells / n)
        sample = (
            nodes.where((F.col("_dim") == dim) & (F.pmod(F.xxhash64("_node"), 1_000_000) < math.ceil(share * 1_000_000)))
            .orderBy("_node")
            .select("_unit")
            .toArrow()["_unit"]
            .combine_chunks()
        )
        units = sample.flatten().to_numpy().reshape(-1, dim) if len(sample) else np.eye(1, dim)
        chord = math.sqrt(max(0.0, 2 - 2 * threshold))
        across = chord if reach is None else min(chord, reach * chord / math.sqrt(dim))
        assign = _assigner(fit(units, cells), across)
    else:
        assign = _assigner(np.ones((1, 1)), 0.0)
    placed = cut(
        mapped(
            nodes.select("_node", "_dim", "_unit", "_copies"),
            assign,
            "_node binary, _dim int, _unit array<double>, _copies long, _cell int, _own int, _also array<int>",
        ),
        "cells",
    )
    # A cell's own vectors are numbered before those it is shown, which needn't be compared with each other.
    home = F.col("_own") == F.col("_cell")
    split = placed.groupBy("_dim", "_cell").agg(
        F.ceil(F.count(F.when(home, 1)) / BLOCK).cast("int").alias("_homes"),
        F.ceil(F.count(F.when(~home, 1)) / BLOCK).cast("int").alias("_guests"),
    )
    spread = F.xxhash64("_node")
    blocks = (
        placed.join(split, ["_dim", "_cell"])
        .where("_homes > 0")
        .withColumn("_part", F.when(home, F.pmod(spread, "_homes")).otherwise(F.col("_homes") + F.pmod(spread, "_guests")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("_homes") + F.when(home, F.col("_guests")).otherwise(0) - 1)).alias("_other"))
        .withColumns({"_x": F.least("_part", "_other"), "_y": F.greatest("_part", "_other")})
        .select("_dim", "_cell", "_x", "_y", "_node", "_unit", "_copies", "_own", "_also", "_part")
    )
    found = cut(
        blocks.groupBy("_dim", "_cell", "_x", "_y").applyInArrow(_block(threshold), "a binary, b binary, n long"), "found"
    )
    counts = found.groupBy(F.col("a").alias("_node")).agg(F.sum("n").alias("_links"))
    roots = components(found.select("a", "b")).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    named = cut(
        nodes.select("_node", "_copies", "_least")
        .join(counts, "_node", "left")
        .join(roots, "_node", "left")
        .select(
            "_node",
            (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_links"),
            F.coalesce("_root", "_node").alias("_root"),
            "_least",
        ),
        "named",
    )
    least = named.groupBy("_root").agg(F.min("_least").alias("_component"))
    by_node = named.join(least, "_root").select("_node", "_links", "_component")
    linked = keyed.where("_node is not null").select("_id", "_node").join(by_node, "_node")
    alone = keyed.where("_node is null").select(
        "_id", F.lit(None).cast("binary").alias("_node"), F.lit(0).cast("long").alias("_links"), F.col("_id").alias("_component")
    )
    return linked.unionByName(alone).select(
        F.col("_id").alias(key),
        F.col("_links").alias("n_links"),
        F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
    )
