"""Pair counting against brute force, with repeats, a hot basket, and pruning."""

import random
from collections import Counter
from itertools import combinations

import pytest

from starmart.operators.baskets import pairs


def brute(rows):
    baskets, pop = {}, Counter()
    for b, i in rows:
        baskets.setdefault(b, []).append(i)
    co = Counter()
    for items in baskets.values():
        pop.update(set(items))
        for x, y in combinations(sorted(items), 2):
            if x != y:
                co[(x, y)] += 1
    return co, pop, len(baskets)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out = [(rnd.randrange(200), min(int(rnd.expovariate(0.05)), 120)) for _ in range(1200)]
    out += [(999, i % 130) for i in range(600)]  # one basket with a third of all lines, items repeated
    return out


@pytest.mark.parametrize("opts", [
    {},
    dict(block_items=17),
    dict(block_items=17, pairs_per_row=0, seed_items=20),
    dict(pairs_per_row=0, seed_items=5),
])
def test_top_pairs(spark, rows, opts):
    co, pop, n = brute(rows)
    want = sorted(co.items(), key=lambda kv: (-kv[1], kv[0]))[:100]
    got = pairs(spark.createDataFrame(rows, "b int, i int"), "b", "i", top=100, **opts).collect()
    got.sort(key=lambda r: (-r["co_occurrence"], r["item_a"], r["item_b"]))
    assert [((r["item_a"], r["item_b"]), r["co_occurrence"]) for r in got] == want
    for r in got:
        assert (r["baskets_a"], r["baskets_b"]) == (pop[r["item_a"]], pop[r["item_b"]])
        assert r["lift"] == pytest.approx(r["co_occurrence"] * n / (r["baskets_a"] * r["baskets_b"]))


@pytest.mark.parametrize("block", [1000, 11])
def test_all_pairs(spark, rows, block):
    co, _, _ = brute(rows)
    got = pairs(spark.createDataFrame(rows, "b int, i int"), "b", "i", top=None, block_items=block).collect()
    assert {(r["item_a"], r["item_b"]): r["co_occurrence"] for r in got} == dict(co)


def test_single_line_baskets_have_no_pairs(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "b int, i int")
    assert pairs(df, "b", "i").collect() == []


def test_lines_are_counted_not_products(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 6)], "b int, i int")
    assert [r["co_occurrence"] for r in pairs(df, "b", "i").collect()] == [2]


def test_support_pruning_is_exact(spark, rows):
    co, _, _ = brute(rows)
    got = pairs(spark.createDataFrame(rows, "b int, i int"), "b", "i", top=None, min_support=4).collect()
    assert {(r["item_a"], r["item_b"]): r["co_occurrence"] for r in got} == {k: n for k, n in co.items() if n >= 4}
