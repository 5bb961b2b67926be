"""Distributed windows against plain windows, with ties, NULLs and hot values."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import ordered as o
from starmart.operators import series

BIG = dict(partitions=7)


@pytest.fixture(scope="module")
def numbers(spark):
    # a third of all rows share one value, some are NULL, groups are uneven
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 50).when(F.col("id") % 97 == 0, None).otherwise(F.xxhash64("id") % 400)
        .cast("long").alias("v"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
    ).cache()


def same(a, b):
    assert sorted(map(tuple, a.select(*b.columns).collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("tiles", [1, 5, 7])
@pytest.mark.parametrize("n", [1, 4, 5, 6, 101, 3000])
def test_ntile(numbers, n, tiles):
    df = numbers.filter(F.col("id") < n)
    order = [F.col("v").desc(), F.col("id")]
    plain = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    same(o.global_ntile(df, order, tiles, "t", **BIG), plain)


@pytest.mark.parametrize("within", [(), ("g",)])
@pytest.mark.parametrize("desc", [True, False])
def test_rank(numbers, within, desc):
    plain = o.rank_by(numbers, "v", within, desc, "r", max_rows=3000)
    same(o.rank_by(numbers, "v", within, desc, "r", **BIG), plain)


def test_row_numbers(numbers):
    plain = o.row_numbers(numbers, ["v", "id"], "rn", "n", max_rows=3000)
    same(o.row_numbers(numbers, ["v", "id"], "rn", "n", **BIG), plain)


@pytest.mark.parametrize("within", [(), ("g",)])
def test_running_sums(numbers, within):
    df = numbers.filter("v IS NOT NULL")
    plain = o.running_sums(df, ["v", "id"], {"s": "v"}, within, max_rows=3000)
    same(o.running_sums(df, ["v", "id"], {"s": "v"}, within, **BIG), plain)


@pytest.mark.parametrize("ties,key", [("range", ()), ("rows", ("id",))])
def test_running_share(numbers, ties, key):
    df = numbers.filter("v IS NOT NULL")
    plain = o.running_share(df, "v", ties=ties, key=key, max_rows=3000)
    same(o.running_share(df, "v", ties=ties, key=key, **BIG), plain)


def test_equal_values_share_a_running_total(spark):
    df = spark.createDataFrame([("a", 50), ("b", 20), ("c", 20), ("d", 10), ("e", -5), ("f", 5)], "k string, v int")
    for opts in (dict(max_rows=6), BIG):
        got = {r["k"]: r["running"] for r in o.running_share(df, "v", **opts).collect()}
        assert got == {"a": 50, "b": 90, "c": 90, "d": 100, "f": 105, "e": 100}


def test_pareto_leaves_the_crossing_row_out(spark):
    df = spark.createDataFrame([("a", 50), ("b", 25), ("c", 15), ("d", 10)], "k string, v int")
    for opts in (dict(max_rows=4), BIG):
        assert {r["k"] for r in o.pareto_cutoff(df, "v", 0.8, **opts).collect()} == {"a", "b"}
        kept = o.pareto_cutoff(df, "v", 0.8, key=["k"], include_crossing=True, **opts)
        assert {r["k"] for r in kept.collect()} == {"a", "b", "c"}


def test_rank_has_gaps(spark):
    df = spark.createDataFrame([(1, 9), (2, 9), (3, 5)], "id int, v int")
    for opts in (dict(max_rows=3), BIG):
        assert sorted(r["rank"] for r in o.rank_by(df, "v", **opts).collect()) == [1, 1, 3]


@pytest.mark.parametrize("n", [1, 2, 3, 1000])
def test_quantiles(numbers, n):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    df = numbers.filter(F.col("id") < n)
    plain = o.quantiles(df, "v", probs, max_rows=3000).first()
    spread = o.quantiles(df, "v", probs, **BIG).first()
    assert [x is None or round(x, 9) for x in plain] == [x is None or round(x, 9) for x in spread]


def test_occurrence_index(numbers):
    plain = o.occurrence_index(numbers, ["g"], ["id"], max_rows=3000)
    same(o.occurrence_index(numbers, ["g"], ["id"], **BIG), plain)


def test_series_blocks(spark):
    df = spark.range(1, 2501).select(F.col("id").alias("k"), (F.xxhash64("id") % 1000).alias("v"))
    for f, extra in ((series.moving_avg, dict(before=6)), (series.moving_avg, dict(before=2, after=3, min_periods=4)),
                     (series.centred_avg, {}), (series.drift, {})):
        plain = f(df, "k", "v", max_rows=2500, **extra)
        same(f(df, "k", "v", block=37, **extra), plain)


def test_moving_average_of_partial_windows(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 11)], "k int, v int")
    part = {r["k"]: r["moving_avg"] for r in series.moving_avg(df, "k", "v", 6, max_rows=10).collect()}
    full = {r["k"]: r["moving_avg"] for r in series.moving_avg(df, "k", "v", 6, min_periods=7, max_rows=10).collect()}
    assert part[1] == 1.0 and part[2] == 1.5 and part[7] == 4.0
    assert full[6] is None and full[7] == 4.0 and full[10] == 7.0


def test_centred_average_keeps_three_first_and_four_last(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(12)], "k int, v int")
    got = {r["k"]: r["smoothed"] for r in series.centred_avg(df, "k", "v", max_rows=12).collect()}
    assert [got[i] for i in (0, 1, 2, 8, 9, 10, 11)] == [0, 1, 4, 64, 81, 100, 121]
    assert got[3] == sum(i * i for i in range(7)) / 7


def test_no_single_task_window_over_large_input(numbers):
    plan = o.global_ntile(numbers, ["v", "id"], 5, **BIG)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # the sort ran once and was stored
    # the only gathered frame is one row per range partition, below a broadcast
    assert plan.count("SinglePartition") <= 1 and "BroadcastHashJoin" in plan


@pytest.fixture(scope="module")
def gaps(spark):
    """NULL groups, NULL metrics and a group of NULLs only."""
    rows = [(i, None if i % 4 == 0 else "n" if i % 4 == 1 else "g", None if i % 4 == 1 or i % 5 == 0 else i * 7 % 50)
            for i in range(200)]
    return spark.createDataFrame(rows, "id int, g string, v long").cache()


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_null_groups_and_metrics(gaps, partitions):
    big = dict(partitions=partitions)
    for within in ((), ("g",)):
        for order in ([F.col("v").desc(), "id"], ["v", "id"]):
            same(o.running_sums(gaps, order, {"s": "v"}, within, **big),
                 o.running_sums(gaps, order, {"s": "v"}, within, max_rows=200))
        same(o.rank_by(gaps, "v", within, name="r", **big), o.rank_by(gaps, "v", within, name="r", max_rows=200))
    same(o.occurrence_index(gaps, ["g"], ["id"], **big), o.occurrence_index(gaps, ["g"], ["id"], max_rows=200))
    same(o.running_share(gaps, "v", **big), o.running_share(gaps, "v", max_rows=200))
    assert o.rank_by(gaps, "v", ("g",), **big).count() == 200
    assert o.quantiles(gaps, "v", {"m": 0.37}, **big).collect() == o.quantiles(gaps, "v", {"m": 0.37}, max_rows=200).collect()


def test_empty_input(gaps):
    none = gaps.limit(0)
    for opts in (dict(max_rows=1), BIG):
        assert o.rank_by(none, "v", ("g",), **opts).count() == o.occurrence_index(none, ["g"], ["id"], **opts).count() == 0
        assert o.quantiles(none, "v", {"m": 0.5}, **opts).collect() == [(None,)]


def test_allocation_of_zero_weights(spark):
    from starmart.operators.allocate import allocate

    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "k int, w int")
    for opts in (dict(max_rows=3), {}):
        assert {r["k"]: r["allocated"] for r in allocate(df, "w", 11, "k", **opts).collect()} == {1: 4, 2: 4, 3: 3}
    mixed = spark.createDataFrame([(1, 3), (2, 0), (3, 1)], "k int, w int")
    assert {r["k"]: r["allocated"] for r in allocate(mixed, "w", 10, "k").collect()} == {1: 8, 2: 0, 3: 2}


def test_deviation_of_large_means(spark):
    df = spark.range(1000).selectExpr("cast(100000000000 + id % 7 as decimal(18,2)) AS v")
    got = o.distribution(df, "v").first()
    values = [i % 7 for i in range(1000)]
    mean = sum(values) / 1000
    assert abs(got["stdev_v"] - (sum((x - mean) ** 2 for x in values) / 999) ** 0.5) < 1e-4


@pytest.mark.parametrize("kind", ["int", "double", "decimal(20,4)"])
def test_tiles_without_sorting(spark, kind):
    from starmart.operators.tiles import Ranking, tile_columns

    rng = random.Random(len(kind))
    for n, spread in ((0, 1), (1, 1), (3, 9), (700, 1), (700, 3), (1500, 10**6)):
        rows = [(i * 3, None if rng.random() < 0.2 else rng.randrange(spread), rng.choice([None, 1, 2, 2, 2, 2])) for i in range(n)]
        if kind == "double" and n > 100:
            rows[:4] = [(0, 5e-324, 1), (3, math.inf, 1), (6, -math.inf, 1), (9, 0.1 + 0.2, 2)]
        df = spark.createDataFrame([(i, None if v is None else float(v), w) for i, v, w in rows], "id long, v double, w int")
        df = df.withColumn("v", F.col("v").cast(kind))
        rankings = {"a": Ranking("v"), "b": Ranking("v", descending=True), "c": Ranking("w"), "d": Ranking("w", descending=True)}
        for tiles in (1, 5, 7):
            got = df.withColumns(tile_columns(df, "id", rankings, tiles))
            plain = df.withColumns({
                name: F.ntile(tiles).over(Window.orderBy(F.desc(r.metric) if r.descending else F.asc(r.metric), "id"))
                for name, r in rankings.items()
            })
            picked = ["id", *rankings]
            assert sorted(got.select(picked).collect()) == sorted(plain.select(picked).collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
