"""Set operators against plain Python on small random inputs, with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerq.operators.components import components
from ledgerq.operators.constraints import Limit, LimitBroken, check_constraints, require
from ledgerq.operators.dedup import first_arrivals, key_conflicts, last_arrivals, late_arrivals, repeated_keys
from ledgerq.operators.row_ranges import RANGE, range_of, range_of_dense, range_plan, split_points, write_by_range
from ledgerq.operators import serial_unique
from ledgerq.operators.serial_unique import in_slices, settle
from ledgerq.operators.rules import validated_where
from ledgerq.operators.upsert import merge_snapshot
from ledgerq.plans.transactions import validate_transactions


def hot_rows(n, seed=1):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(n // 4)}", f"v{i}") for i in rng.sample(range(10 * n), n)]


def test_first_last_and_late_arrivals(spark):
    rows = hot_rows(600)
    df = spark.createDataFrame(rows, "seq long, k string, v string").repartition(5)
    by_key = {}
    for row in sorted(rows):
        by_key.setdefault(row[1], []).append(row)
    assert sorted(map(tuple, first_arrivals(df, ["k"]).collect())) == sorted(g[0] for g in by_key.values())
    assert sorted(map(tuple, last_arrivals(df, ["k"]).collect())) == sorted(g[-1] for g in by_key.values())
    late = sorted((*row, g[0][0]) for g in by_key.values() for row in g[1:])
    assert sorted(map(tuple, late_arrivals(df, ["k"]).collect())) == late
    assert sorted(map(tuple, late_arrivals(df, ["k"], repeated_keys(df, ["k"])).collect())) == late


def test_null_keys_are_equal_for_winners_and_losers(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "k", "c")], "seq long, k string, v string")
    assert sorted(r["seq"] for r in first_arrivals(df, ["k"]).collect()) == [1, 3]
    assert [(r["seq"], r["_kept"]) for r in late_arrivals(df, ["k"]).collect()] == [(2, 1)]


def test_no_window_puts_a_key_in_one_task(spark):
    df = spark.createDataFrame(hot_rows(60), "seq long, k string, v string")
    for frame in (first_arrivals(df, ["k"]), last_arrivals(df, ["k"]), late_arrivals(df, ["k"])):
        assert "Window" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_key_conflicts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "c"), (6, "c")], "cuenta_id long, n string")
    assert sorted(map(tuple, key_conflicts(df, ["n"]).collect())) == [("a", 2, 1, 2), ("c", 3, 4, 6)]


def test_merge_keeps_untouched_rows_and_is_idempotent(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None)], "id long, v string, w string")
    merged = merge_snapshot(stored, new, ["id"])
    want = [(1, "a", None), (2, None, "y"), (3, "c", None)]
    assert sorted(map(tuple, merged.collect())) == want
    assert sorted(map(tuple, merge_snapshot(merged, new, ["id"]).collect())) == want
    assert merge_snapshot(None, new, ["id"]).count() == 2


@pytest.mark.parametrize("n, ranges", [(0, 3), (2, 3), (1000, 6), (1000, 1), (57, 80)])
def test_range_plan(spark, n, ranges):
    rows = [tuple(r) for r in range_plan(spark.range(n), ranges).orderBy("particion").collect()]
    sizes = [n // ranges + (i < n % ranges) for i in range(ranges)]
    want, start = [], 1
    for i, size in enumerate(s for s in sizes if s):
        want.append((i, start, start + size - 1, size))
        start += size
    assert rows == want


@pytest.mark.parametrize("spread, ranges", [(1, 1), (1, 40), (7, 5), (10**12, 2), (10**12, 40)])
def test_split_points_are_exact(spark, spread, ranges):
    rng = random.Random(spread + ranges)
    values = sorted({-50 + rng.randrange(400) * spread for _ in range(150)} | {10**15})
    points = split_points(spark.createDataFrame([(v,) for v in values], "seq long"), ranges)
    sizes = [len(values) // ranges + (i < len(values) % ranges) for i in range(ranges)]
    parts = [sum(v >= p for p in points) for v in values]
    assert [parts.count(i) for i in range(ranges)] == sizes
    got = spark.createDataFrame([(v,) for v in values], "seq long").select(range_of(points).alias("p"))
    assert [r["p"] for r in got.collect()] == parts


def test_ten_thousand_ranges(spark):
    points = list(range(10, 100_000, 10))
    got = spark.range(100_000).select(F.col("id"), range_of(points, "id").alias("p"))
    assert got.where("p != id div 10").isEmpty()
    assert got.select(F.count_distinct("p")).first()[0] == 10_000


def test_split_points_need_unique_values(spark):
    with pytest.raises(ValueError, match="not unique"):
        split_points(spark.createDataFrame([(5,)] * 9 + [(6,)], "seq long"), 3)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, f"c{i // 2}") for i in range(40)] + [(i, f"d{(i + 1) // 2}") for i in range(40)]
    star = [(100 + i, "hub") for i in range(30)]
    rows = spark.createDataFrame(chain + star, "a long, k string")
    got = dict(map(tuple, components(rows, "a", "k").collect()))
    assert got == {i: 0 for i in range(40)} | {100 + i: 100 for i in range(30)}


def replayed(rows, stored):
    """The definition, one row at a time."""
    holder = {key: account for account, key in stored}
    holds = dict(stored)
    verdicts = {}
    for seq, account, key in sorted(rows):
        verdicts[seq] = holder.get(key, account) == account
        if verdicts[seq]:
            holder.pop(holds.get(account), None)
            holder[key], holds[account] = account, key
    return verdicts


@pytest.mark.parametrize(
    "accounts, keys, with_stored, replay_rows",
    [(40, 60, False, 1000), (40, 60, True, 1000), (12, 9, True, 35), (60, 200, True, 25)],
)
def test_serial_uniqueness_is_that_of_a_replay(spark, accounts, keys, with_stored, replay_rows):
    rng = random.Random(accounts * keys)
    rows = []
    for seq in rng.sample(range(1000), 120):
        account = 1 if rng.random() < 0.2 else rng.randrange(accounts)
        key = "hot" if rng.random() < 0.3 else f"k{rng.randrange(keys)}"
        rows.append((seq, account, key))
    stored = [(a, f"k{a}") for a in range(0, min(accounts, keys), 2)] if with_stored else []
    df = spark.createDataFrame(rows, "seq long, cuenta long, nombre string")
    held = spark.createDataFrame(stored, "cuenta long, nombre string") if with_stored else None
    got = settle(df, held, "cuenta", ["nombre"], replay_rows).select("seq", "conserva").collect()
    assert dict(map(tuple, got)) == replayed(rows, stored)


def test_slices_are_exact_ranks_of_groups(spark):
    """A third of the rows are one group, which spans several ranges."""
    rng = random.Random(4)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 9), seq, 7, "k") for i, seq in enumerate(rng.sample(range(10**6), 900))]
    df = spark.createDataFrame(rows, "grupo long, seq long, cuenta long, clave string").repartition(6)
    got = {r["seq"]: r["_slice"] for r in in_slices(df, 40).collect()}
    by_group = {}
    for g, seq, *_ in sorted(rows):
        by_group.setdefault(g, []).append(seq)
    assert got == {seq: i // 40 for g in by_group.values() for i, seq in enumerate(g)}


def test_large_groups_are_replayed_side_by_side(spark, monkeypatch):
    """Ten groups of up to five slices take five jobs, and one for the small groups."""
    rng = random.Random(9)
    rows = []
    for group in range(10):
        rows += [(10 * group + rng.randrange(6), f"g{group}-{rng.randrange(5)}") for _ in range(100 if group == 3 else 50)]
    rows += [(500 + i, f"s{i // 2}") for i in range(30)]
    rng.shuffle(rows)
    rows = [(seq, *r) for seq, r in enumerate(rows)]
    stored = [(10 * g, f"g{g}-1") for g in range(10)]
    jobs = []
    replay = serial_unique.replay
    monkeypatch.setattr(serial_unique, "replay", lambda *a: jobs.append(1) or replay(*a))
    df = spark.createDataFrame(rows, "seq long, cuenta long, nombre string")
    held = spark.createDataFrame(stored, "cuenta long, nombre string")
    got = settle(df, held, "cuenta", ["nombre"], 20).select("seq", "conserva").collect()
    assert dict(map(tuple, got)) == replayed(rows, stored)
    assert len(jobs) == 5 + 1


def test_nothing_shared_means_nothing_turned_away(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "seq long, cuenta long, nombre string")
    assert settle(df, None, "cuenta", ["nombre"], 10).where(~F.col("conserva")).isEmpty()


def test_first_arrivals_aggregate_keys_only(spark):
    """No row is sorted or aggregated as a whole; winners and losers share one written shuffle of keys."""
    rows = hot_rows(300)
    df = spark.createDataFrame(rows, "seq long, k string, v string")
    plan = first_arrivals(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    repeated = spark.createDataFrame(repeated_keys(df, ["k"]).collect(), "k string, _kept long")
    first = first_arrivals(df, ["k"], repeated=repeated)
    late = late_arrivals(df, ["k"], repeated).drop("_kept")
    assert sorted(map(tuple, first.unionByName(late).collect())) == sorted(rows)
    assert first.groupBy("k").count().where("count > 1").isEmpty()


def test_every_kind_of_limit(spark):
    limits = (Limit("a", required=True, max_length=3), Limit("m", required=True, precision=(5, 2)), Limit("n", integer=True))
    rows = [("abc", "999.99", 2**31 - 1), (None, "1", 1), ("abcd", "1", 1), ("a", None, 1), ("a", "-1000", 1), ("a", "1", 2**31), ("a", "1", None)]
    df = spark.createDataFrame(rows, "a string, m string, n long").withColumn("m", F.col("m").cast("decimal(38,2)")).coalesce(1)
    codes = [r["reject_code"] for r in check_constraints(df, limits).collect()]
    assert codes == [None, "nulo:a", "largo:a", "nulo:m", "precision:m", "rango:n", None]
    assert require(df.limit(1), limits).count() == 1
    with pytest.raises(LimitBroken, match="n excede integer"):
        require(df.where("n > 2147483647"), limits)


def test_conditions_on_raw_columns_reach_the_scan(spark, tmp_path):
    rows = [(i, f"2024-01-{1 + i % 40:02d}", str(i), "credito") for i in range(200)]
    spark.createDataFrame(rows, "id long, fecha string, monto string, tipo string").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).withColumn("seq", F.col("id"))
    found = validated_where(raw, validate_transactions, "id = 5", F.col("reject_code").isNull(), "monto_ok < 100")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,5)" in plan.split("PushedFilters: [", 1)[1].split("]")[0]
    assert [r["id"] for r in found.collect()] == [5]
    conditions = ("id % 3 = 0", "reject_code = 'fecha_invalida'", "tipo = 'credito'")
    got = validated_where(raw, validate_transactions, *conditions)
    want = validate_transactions(raw).where(" AND ".join(conditions))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        validated_where(raw, validate_transactions, "nowhere = 1")


@pytest.mark.parametrize("n, ranges", [(1, 1), (10, 3), (1000, 7), (57, 80), (20_000, 10_000)])
def test_dense_ranges_are_those_of_the_plan(spark, n, ranges):
    plan = {r["particion"]: (r["inicio"], r["fin"]) for r in range_plan(spark.range(n), ranges).collect()}
    rows = spark.range(1, n + 1).select(F.col("id").alias("seq"), range_of_dense(n, ranges, "id").alias("p"))
    got = rows.groupBy("p").agg(F.min("seq"), F.max("seq")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == plan


def test_a_layout_by_range_has_few_files_and_is_pruned(spark, tmp_path):
    n, ranges = 6000, 300
    df = spark.range(1, n + 1).select(F.col("id").alias("seq"), range_of_dense(n, ranges, "id").alias(RANGE), (F.col("id") * 2).alias("v"))
    table = write_by_range(df.repartition(16), str(tmp_path / "t"))
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert ranges <= len(files) <= ranges + 16
    some = table.where(F.col(RANGE).between(10, 12))
    assert "PartitionFilters: [isnotnull(particion" in some._jdf.queryExecution().executedPlan().toString()
    assert len(some.inputFiles()) == len(files) and some.count() == 60
    read = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert len(read) <= 3 + 3
