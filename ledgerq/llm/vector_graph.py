"""Approximate nearest neighbours by a robust-pruned directed graph in each shard of the vectors.

Different vectors are dealt by hash into shards of about ``SHARD``. In each shard a graph is built: a greedy search from
the shard's central vector proposes the vectors it passed as neighbours of a new one, and pruning keeps the nearest
of them and drops those that a kept one is nearer to by the factor ``ALPHA``, which leaves long, diverse edges. A
neighbour gets the edge back and is pruned again when it has too many. Vectors enter in batches, whose searches
advance together; a batch is at most a quarter of the graph it meets.

Queries are beam searched in every shard, in blocks of ``QUERIES``; distances of what the beam holds at the end are
taken again in double precision from the original vectors, and each shard hands on a query's best ``k`` rows only.
The graph is a table of its own, ``build``, that any number of searches can use.

Rows with equal vectors are one vector of the graph with its smallest k + 1 keys: no query needs more of them.
A table of few vectors is searched whole: a ring through all vectors of a shard beside the pruned edges makes each
reachable, so a beam as wide as the shard misses none.

Defined results: null, empty and zero vectors and those with a null or non-finite component take no part, neither as
queries nor as candidates; vectors of other lengths than a query's are no candidates of it; rows with the same key
and the same vector count once, rows with the same key and different vectors are queries of their own, and none of
them is a candidate of another; a null key is no query, and comes last among ties as a candidate; an empty table, or one
without queries, gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerq.llm.common import cut

K = 10
SHARD, QUERIES = 16_384, 65_536
DEGREE, ALPHA = 32, 1.2
BUILD_BEAM, SEARCH_BEAM, EXPANDED = 40, 256, 4
#: Searches that advance together, and the largest share of the graph so far that enters at once.
TOGETHER, SHARE = 256, 0.25
#: Nearest vectors a pruning looks at, of those a search passed and the edges there are.
CONSIDERED = 128


class Graph:
    """Vectors and at most ``degree`` edges of each; row ``n`` stands for no vector."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, entry: int = 0, degree: int = DEGREE):
        self.n, self.entry, self.degree = len(x), entry, degree
        # Scaled, so that squares of single precision neither overflow nor vanish.
        scale = float(np.abs(x).max(initial=0.0)) or 1.0
        self.scale = scale
        self.x = np.zeros((self.n + 1, x.shape[1] if x.ndim == 2 else 0), np.float32)
        self.x[:-1] = x / scale
        # Beyond ``degree`` there is some room for edges back, so that not each of them asks for a new pruning.
        self.edges = np.full((self.n + 1, degree + degree // 2), self.n, np.int32) if edges is None else edges

    def beam(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and squared distances of the best ``width`` per query, nearest first; and of all that were expanded."""
        count, n = len(q), self.n
        seen = np.zeros((count, n + 1), bool)
        seen[:, [n, self.entry]] = True
        ids = np.full((count, width), n, np.int32)
        dist = np.full((count, width), np.inf, np.float32)
        fresh = np.zeros((count, width), bool)
        ids[:, 0], fresh[:, 0] = self.entry, True
        dist[:, 0] = ((self.x[self.entry] - q) ** 2).sum(axis=1)
        passed, passed_dist = [], []
        act = np.arange(count)
        take = min(EXPANDED, width)
        while len(act):
            # The nearest few that were not expanded yet.
            waiting = np.where(fresh[act], dist[act], np.inf)
            pick = np.argpartition(waiting, take - 1, axis=1)[:, :take]
            rows = act[:, None]
            live = np.take_along_axis(waiting, pick, 1) < np.inf
            chosen = np.where(live, ids[rows, pick], n)
            fresh[rows, pick] = False
            step, step_dist = np.full((count, take), n, np.int32), np.full((count, take), np.inf, np.float32)
            step[act], step_dist[act] = chosen, np.where(live, dist[rows, pick], np.inf)
            passed.append(step)
            passed_dist.append(step_dist)
            # Their neighbours that no step met before, each once.
            near = np.sort(self.edges[chosen].reshape(len(act), -1), axis=1)
            new = ~seen[rows, near]
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[rows, near] = True
            near = np.where(new, near, n)
            r, c = np.nonzero(new)
            gap = self.x[near[r, c]] - q[act[r]]
            found = np.full(near.shape, np.inf, np.float32)
            found[r, c] = np.einsum("ij,ij->i", gap, gap)
            all_dist = np.concatenate([dist[act], found], axis=1)
            keep = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
            dist[act] = np.take_along_axis(all_dist, keep, 1)
            ids[act] = np.take_along_axis(np.concatenate([ids[act], near], axis=1), keep, 1)
            fresh[act] = np.take_along_axis(np.concatenate([fresh[act], new], axis=1), keep, 1)
            act = act[(fresh[act] & (dist[act] < np.inf)).any(axis=1)]
        order = np.argsort(dist, axis=1, kind="stable")
        everything = (np.concatenate(passed, axis=1), np.concatenate(passed_dist, axis=1)) if passed else (ids, dist)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1), *everything

    def prune(self, of: np.ndarray, ids: np.ndarray, dist: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of the vectors ``of`` among candidates: nearest first, without those a kept one covers."""
        n = self.n
        # A candidate counts once, and never for itself.
        order = np.argsort(ids, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        off = (ids == n) | (ids == of[:, None])
        off[:, 1:] |= ids[:, 1:] == ids[:, :-1]
        dist = np.where(off, np.inf, dist)
        order = np.argsort(dist, axis=1, kind="stable")[:, :CONSIDERED]
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        x = self.x[np.where(dist < np.inf, ids, n)]
        square = np.einsum("ijk,ijk->ij", x, x)
        between = square[:, :, None] + square[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
        covered = alpha * alpha * between <= dist[:, None, :]
        alive = dist < np.inf
        kept = np.zeros(ids.shape, bool)
        room = np.full(len(of), self.degree)
        for j in range(ids.shape[1]):
            take = alive[:, j] & (room > 0)
            if take.any():
                kept[take, j] = True
                room[take] -= 1
                alive[take] &= ~covered[take, j]
        edges = np.full((len(of), self.edges.shape[1]), n, np.int32)
        r, c = np.nonzero(kept)
        edges[r, np.cumsum(kept, axis=1)[r, c] - 1] = ids[r, c]
        return edges

    def distances(self, of: np.ndarray, ids: np.ndarray) -> np.ndarray:
        gap = self.x[ids] - self.x[of][:, None]
        return np.where(ids == self.n, np.inf, np.einsum("ijk,ijk->ij", gap, gap)).astype(np.float32)

    def link(self, new: np.ndarray, width: int, alpha: float) -> None:
        """Search the graph for the vectors ``new``, give them pruned edges, and their neighbours edges back."""
        _, _, ids, dist = self.beam(self.x[new], width)
        old = self.edges[new]
        self.edges[new] = self.prune(new, np.concatenate([ids, old], 1), np.concatenate([dist, self.distances(new, old)], 1), alpha)
        r, c = np.nonzero(self.edges[new] < self.n)
        to, back = self.edges[new][r, c], new[r]
        # An edge that is there already needs no other.
        fresh = (self.edges[to] != back[:, None]).all(axis=1)
        to, back = to[fresh], back[fresh]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        goals, first, size = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, size)
        held = (self.edges[goals] < self.n).sum(axis=1)
        fits = held + size <= self.edges.shape[1]
        one = np.repeat(fits, size)
        self.edges[to[one], (np.repeat(held, size) + place)[one]] = back[one]
        # Goals with about as many new edges are pruned together.
        full = np.flatnonzero(~fits)
        full = full[np.argsort(size[full], kind="stable")]
        for at in range(0, len(full), TOGETHER):
            part = full[at : at + TOGETHER]
            incoming = np.full((len(part), int(size[part].max())), self.n, np.int32)
            row = np.repeat(np.arange(len(part)), size[part])
            column = np.arange(len(row)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            incoming[row, column] = back[np.repeat(first[part], size[part]) + column]
            both = np.concatenate([self.edges[goals[part]], incoming], axis=1)
            self.edges[goals[part]] = self.prune(goals[part], both, self.distances(goals[part], both), alpha)


def build_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, width: int = BUILD_BEAM) -> Graph:
    """The graph of different vectors, which enter in random order after the central one."""
    graph = Graph(x, degree=degree)
    n = graph.n
    if n < 2:
        return graph
    middle = graph.x[:-1].mean(axis=0)
    graph.entry = int(np.argmin(((graph.x[:-1] - middle) ** 2).sum(axis=1)))
    rest = np.random.default_rng(n).permutation(n)
    rest = rest[rest != graph.entry]
    at = 0
    while at < len(rest):
        size = max(1, min(TOGETHER, int((at + 1) * SHARE)))
        graph.link(rest[at : at + size], width, alpha)
        at += size
    # The ring: a last edge of each vector that no pruning takes away.
    ring = np.full((n + 1, 1), n, np.int32)
    ring[:n, 0] = (np.arange(n) + 1) % n
    graph.edges = np.concatenate([graph.edges, ring], axis=1)
    return graph


def _matrix(column, dim: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(values), dim)


def _built(key, group):
    """The nodes of one shard with their edges; rows of one vector become one node."""
    dim = key[0].as_py()
    order = np.lexsort([group["_b"].to_numpy(), group["_a"].to_numpy()])
    group = group.take(pa.array(order))
    a, b = group["_a"].to_numpy(), group["_b"].to_numpy()
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    keys = group["_id"].to_pylist()
    ends = [*first[1:].tolist(), len(keys)]
    nodes = group.take(pa.array(first))
    graph = build_graph(_matrix(nodes["_v"], dim))
    n = len(first)
    edges = [[int(e) for e in row if e < n] for row in graph.edges[:n]]
    return pa.table(
        {
            "dim": nodes["_dim"],
            "shard": nodes["_shard"],
            "node": pa.array(np.arange(n), pa.int32()),
            "entry": pa.array(np.arange(n) == graph.entry),
            "vector": nodes["_v"].combine_chunks().cast(pa.list_(pa.float64())),
            "keys": pa.array([keys[i:j] for i, j in zip(first.tolist(), ends, strict=True)], pa.list_(pa.int64())),
            "edges": pa.array(edges, pa.list_(pa.int32())),
        }
    )


INDEX = "dim int, shard long, node int, entry boolean, vector array<double>, keys array<long>, edges array<int>"


def _searcher(k: int, width: int):
    def search(key, nodes, queries):
        dim = key[0].as_py()
        nodes = nodes.take(pa.array(np.argsort(nodes["node"].to_numpy())))
        n = len(nodes)
        out = {"query_id": [], "_vector": [], "_key": [], "score": []}
        if n and len(queries):
            x = _matrix(nodes["vector"], dim)
            lists = nodes["edges"].combine_chunks()
            lengths = np.asarray(lists.value_lengths())
            edges = np.full((n + 1, max(1, int(lengths.max(initial=0)))), n, np.int32)
            row = np.repeat(np.arange(n), lengths)
            edges[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
            graph = Graph(x, edges, int(np.flatnonzero(nodes["entry"])[0]))
            keys, names = nodes["keys"].to_pylist(), queries["query_id"].to_pylist()
            marks = queries["_query"].to_pylist()
            q = _matrix(queries["vector"], dim)
            for at in range(0, len(q), TOGETHER):
                part = q[at : at + TOGETHER]
                ids = graph.beam((part / graph.scale).astype(np.float32), width)[0]
                gap = x[np.minimum(ids, n - 1)] - part[:, None]
                score = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
                for i in range(len(part)):
                    own = names[at + i]
                    best = sorted(
                        (s, c is None, c or 0)
                        for d, s in zip(ids[i].tolist(), score[i].tolist(), strict=True)
                        if d < n
                        for c in keys[d]
                        if c != own
                    )[:k]
                    out["query_id"] += [own] * len(best)
                    out["_vector"] += [marks[at + i]] * len(best)
                    out["_key"] += [None if none else c for _, none, c in best]
                    out["score"] += [s for s, _, _ in best]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    return search


def usable(vector: Column) -> Column:
    """Whether a vector takes part: finite, without nulls, not zero."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & fits & F.exists(vector, lambda c: c != 0)


def _rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable rows, each pair of key and vector once, with two hashes that stand for the vector."""
    v = F.col(vector)
    rows = vectors.select(F.col(key).cast("long").alias("_id"), v.alias("_v")).where(usable(F.col("_v")))
    return rows.select(
        "_id",
        F.size("_v").alias("_dim"),
        F.xxhash64("_v").alias("_a"),
        F.xxhash64(F.lit(1), "_v").alias("_b"),
        "_v",
    ).dropDuplicates(["_id", "_dim", "_a", "_b"])


def build(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, shard: int = SHARD) -> DataFrame:
    """The index: every vector with its keys and edges, by ``dim`` and ``shard``. Searches may ask for up to ``k``.

    The smallest keys of a vector are picked before the shuffle in part, so copies of a frequent vector don't meet.
    """
    copies = Window.partitionBy("_dim", "_a", "_b").orderBy(F.col("_id").asc_nulls_last())
    rows = _rows(vectors, key, vector).withColumn("_place", F.row_number().over(copies)).where(F.col("_place") <= k + 1)
    rows = cut(rows, "vectors")
    shards = rows.where("_place = 1").groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / shard).alias("_shards"))
    dealt = rows.join(shards, "_dim").withColumn("_shard", F.pmod("_a", "_shards"))
    # A shard is few bytes and much work: as many tasks as shards, whatever size Spark would make them.
    tasks = max(1, shards.agg(F.sum("_shards")).first()[0] or 1)
    return dealt.repartition(int(tasks), "_dim", "_shard").groupBy("_dim", "_shard").applyInArrow(_built, INDEX)


def search(
    index: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, width: int = SEARCH_BEAM
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each row of ``queries`` with a key."""
    asked = _rows(queries, key, vector).where("_id is not null")
    asked = cut(
        asked.select("_dim", F.col("_id").alias("query_id"), F.col("_a").alias("_query"), F.col("_v").cast("array<double>").alias("vector")),
        "vector-queries",
    )
    spread = F.xxhash64("query_id", "_query")
    blocks = asked.groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("_blocks"))
    # Under names of their own: nodes and queries are both grouped by shard.
    shards = index.select(F.col("dim").alias("_of"), F.col("shard").alias("_shard")).distinct()
    dealt = (
        asked.join(blocks, "_dim").withColumn("_block", F.pmod(spread, "_blocks")).join(shards, F.col("_dim") == F.col("_of"))
    )
    every = F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)
    nodes = index.join(blocks, F.col("dim") == F.col("_dim")).withColumn("_at", F.explode(every))
    found = (
        nodes.select("dim", "shard", "_at", "node", "entry", "vector", "keys", "edges")
        .groupBy("dim", "shard", "_at")
        .cogroup(dealt.select("_dim", "_shard", "_block", "query_id", "_query", "vector").groupBy("_dim", "_shard", "_block"))
        .applyInArrow(_searcher(k, width), "query_id long, _vector long, _key long, score double")
    )
    best = Window.partitionBy("query_id", "_vector").orderBy("score", F.col("_key").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), F.col("_key").alias("vec_id"), "score")
    )


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """Build the index of ``vectors``, write it, and search it for ``queries``."""
    return search(cut(build(vectors, key, vector, k), "vector-graph"), queries, key, vector, k)
