"""Nearest vectors against brute force: recall on the tables, exact results on small and odd ones."""

import math

import numpy as np
import pytest

from ledgerq.llm import vector_graph
from ledgerq.llm.common import cut, table
from ledgerq.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, score int, keys string"


def plain(rows, queries, k=10):
    """All distances, one at a time."""
    fits = lambda v: v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    rows = {(i, tuple(v)) for i, v in rows if fits(v)}
    out = []
    for i, v in {(i, tuple(v)) for i, v in queries if fits(v) and i is not None}:
        found = sorted(
            (math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w, strict=True))), c is None, c or 0)
            for c, w in rows
            if c != i and len(w) == len(v)
        )
        out += [(i, rank, None if null else c, round(s, 9)) for rank, (s, null, c) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("n, shard", [(1, 50), (2, 50), (7, 50), (200, 50), (240, 1000)])
def test_small_tables_are_searched_whole(spark, n, shard):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(n)]
    df = frame(spark, rows)
    index = cut(vector_graph.build(df, shard=shard), "index")
    got = vector_graph.search(index, df.where("vec_id % 4 = 0"))
    assert result(got) == plain(rows, [r for r in rows if r[0] % 4 == 0])


def test_ties_copies_and_odd_vectors(spark):
    """A third of the rows share one vector; integer grids give ties between different vectors."""
    rng = np.random.default_rng(5)
    rows = [(i, [3.0, 0.0, 4.0] if i % 3 == 0 else rng.integers(-1, 2, 3).astype(float).tolist()) for i in range(150)]
    rows += rows[:20] + [(3, [3.0, 0.0, 4.0])] * 40  # repeated rows
    rows += [(6, [1.0, 1.0, 1.0]), (None, [3.0, 0.0, 4.0]), (None, [0.0, 0.0, 2.0])]
    rows += [(900, None), (901, []), (902, [0.0, 0.0, 0.0]), (903, [1.0, None, 2.0]), (904, [math.nan, 1.0, 1.0]), (905, [math.inf, 1.0, 1.0])]
    rows += [(910, [1.0, 2.0]), (911, [1.0, 2.5]), (912, [1e30, 1e30]), (913, [5.0])]
    df = frame(spark, rows)
    asked = df.where("vec_id % 3 = 0 or vec_id > 800 or vec_id is null")
    want = plain(rows, [r for r in rows if r[0] is not None and (r[0] % 3 == 0 or r[0] > 800)])
    assert result(vector_graph.nearest(df, asked)) == want


def test_float_vectors_int_keys_and_empty_tables(spark):
    df = frame(spark, [(i, [i / 7, 1.0]) for i in range(30)])
    narrow = df.selectExpr("cast(vec_id as int) as vec_id", "cast(embedding as array<float>) as embedding")
    got = vector_graph.nearest(narrow, narrow.where("vec_id = 10")).collect()
    assert [r.vec_id for r in got][:3] in ([9, 11, 8], [11, 9, 12], [11, 9, 8], [9, 11, 12])
    empty = df.where("false")
    assert vector_graph.nearest(empty, empty).count() == 0
    assert vector_graph.nearest(df, empty).count() == 0
    assert vector_graph.nearest(empty, df).count() == 0


def test_pruning_keeps_the_near_and_the_diverse():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8))
    graph = vector_graph.build_graph(x, degree=6)
    assert all(len(set(e[e < 400])) == (e < 400).sum() and i not in e for i, e in enumerate(graph.edges[:400, :-1]))
    # By definition: a candidate stays out where a kept one, nearer to the vector, is nearer to it by the factor.
    ids = np.arange(1, 60)[None]
    made = graph.prune(np.zeros(1, int), ids, graph.distances(np.zeros(1, int), ids), 1.2)[0]
    gap = np.linalg.norm(graph.x[:60, None].astype(float) - graph.x[None, :60], axis=2)
    kept = []
    for c in sorted(range(1, 60), key=lambda c: gap[0, c]):
        if len(kept) < 6 and not any(1.2 * gap[s, c] <= gap[0, c] for s in kept):
            kept.append(c)
    assert made[made < 400].tolist() == kept


def recall(spark, folder):
    vectors = table(spark, folder, "embeddings").toPandas()
    x = np.stack(vectors["embedding"]).astype(float)
    ids = vectors["vec_id"].to_numpy()
    got = QUERIES["op12_nearest_vectors"](spark, folder).toPandas()
    at = {i: n for n, i in enumerate(ids)}
    exact = [np.linalg.norm(x[at[q]] - x[at[v]]) for q, v in zip(got["query_id"], got["vec_id"], strict=True)]
    assert np.allclose(exact, got["score"], rtol=1e-12)
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        gap = np.linalg.norm(x - x[at[q]], axis=1)
        gap[ids == q] = np.inf
        best = np.lexsort((ids, gap))[:10]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11))
        assert (mine["score"].diff().dropna() >= 0).all()
        hits += len(set(ids[best]) & set(mine["vec_id"]))
        total += 10
    return hits / total


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, folder):
    assert recall(spark, f"/root/testdata/{folder}") >= 0.95
