"""Sharding, hard negatives and importance resampling against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from compare import differences, duck
from starmart.llm import hard_negatives, resampling, sharding
from starmart.llm.queries import ORACLES, QUERIES

from .conftest import TEXTS, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_weighted_shards", "op12_hard_negatives", "op13_importance_resampling"])
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == []


# --- sharding


def descend(tree, key):
    """A plain walk down the tree."""
    path = ()
    for depth in range(3):
        weights = collections.defaultdict(float)
        for leaf in tree:
            names = tuple(map(str, leaf[:3]))
            if names[:depth] == path and leaf[3] > 0:
                weights[names[depth]] += leaf[3]
        draws = []
        for name, w in weights.items():
            h = int(hashlib.md5("/".join([key, *path, name]).encode()).hexdigest()[:12], 16)
            draws.append((-math.log((h + 0.5) / 2**48) / w, name))
        path += (min(draws)[1],)
    return path[0], path[1], int(path[2])


UNEVEN = [("west", "a", 0, 1.0), ("west", "a", 1, 3.0), ("west", "b", 2, 2.0), ("east", "a", 3, 4.0), ("east", "a", 4, 0.0), ("east", "c", 5, 0.5)]


def keys(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))


def test_descent_and_slots_of_odd_rows(docs, nothing):
    got = sharding.shard(docs, UNEVEN).collect()
    assert len(got) == len(TEXTS)
    want = collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", *descend(UNEVEN, "" if i is None else str(i)))
        for i, t in TEXTS
    )
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.law, r.region, r.rack, r.shard) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(nothing, UNEVEN).count() == 0


def test_shares_follow_the_weights(spark):
    n = 20_000
    counts = dict(sharding.place(keys(spark, n), UNEVEN, F.col("doc_id").cast("string")).groupBy("shard").count().collect())
    assert 4 not in counts
    for region, rack, k, w in UNEVEN:
        share = w / sum(leaf[3] for leaf in UNEVEN)
        assert abs(counts.get(k, 0) - n * share) < 5 * math.sqrt(n * share) + 1


def moves(spark, before, after, n=20_000):
    rows = sharding.place(keys(spark, n), before, F.col("doc_id").cast("string"))
    rows = sharding.place(rows, after, F.col("doc_id").cast("string"), ("r", "k", "s"))
    return rows.where("region <> r OR rack <> k OR shard <> s").collect()


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for tree in (sharding.even_tree(8), UNEVEN):
        after = sharding.grown(tree)
        moved = moves(spark, tree, after)
        assert {m.s for m in moved} == {after[-1][2]}
        share = 1 / sum(leaf[3] for leaf in after)
        assert abs(len(moved) - 20_000 * share) < 5 * math.sqrt(20_000 * share)


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    heavier = [(r, k, s, w + 2.0 * (s == 2)) for r, k, s, w in UNEVEN]  # west/b, by shard 2
    for m in moves(spark, UNEVEN, heavier):
        assert m.region == "west" or m.r == "west"  # into west, or within it
        assert m.r == "west"
        if m.region == "west":
            assert (m.rack, m.k) == ("a", "b")  # within west only into the rack that grew
    lighter = [(r, k, s, w - 2.0 * (s == 1)) for r, k, s, w in UNEVEN]  # west/a, by shard 1
    for m in moves(spark, UNEVEN, lighter):
        assert m.region == "west"  # only out of west, or within it
        if m.r == "west" and m.rack != m.k:
            assert m.rack == "a"
        if m.r == "west" and m.rack == m.k:
            assert (m.rack, m.shard, m.s) == ("a", 1, 0)


def test_a_hot_id_keeps_its_slots_gapless(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = sharding.shard(rows, sharding.even_tree(8)).groupBy("shard").agg(
        F.count("*").alias("n"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.count_distinct("slot").alias("d")).collect()
    assert sum(r.n for r in got) == 3000 and max(r.n for r in got) > 1000
    assert all((r.least, r.most, r.d) == (0, r.n - 1, r.n) for r in got)


# --- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, row long, means string"


def brute_force(rows, every=100, first=5, low=80):
    """Counter of result rows, over all pairs."""
    able = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        able.append((k, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v]))
    out = collections.Counter()
    for k, i, label, q in able:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), j, other) for m, j, other, p in able if m != k]
        positives = sorted((s, j) for s, j, other in scored if other == label)[:first]
        for s, j in positives:
            inside = sorted((n, m) for n, m, other in scored if other != label and low * -s <= 100 * -n <= 100 * -s)
            for rank, (n, m) in enumerate(inside[:first], 1):
                out[i, j, rank, m, -s, -n] += 1
    return out


def mined(spark, rows, **how):
    made = spark.createDataFrame([(*r, 7, "clash") for r in rows], VECTORS)
    got = hard_negatives.mine(made, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return collections.Counter(map(tuple, got.collect()))


def test_hard_negatives_of_odd_rows(spark):
    rng = random.Random(3)
    near = [rng.gauss(0, 1) for _ in range(9)]
    rows = [(k, [x + rng.gauss(0, 0.8) for x in near], rng.randrange(3)) for k in range(1, 160)]
    rows += [(0, near, 1), (100, near, 1), (100, near, 1), (100, [-x for x in near], 2), (200, near[:4], 0), (300, [], 0), (400, near, None)]
    rows += [(500, None, 1), (600, [1.0, None], 1), (700, [float("nan")] * 9, 1), (800, [float("inf")] * 9, 1), (None, near, 1)]
    rows += [(161, near, 1), (161, near, 2), (162, near, 2), (900, [0.0] * 9, -3), (1000, near, 55)]
    want = brute_force(rows)
    assert len(want) > 50 and mined(spark, rows) == want
    assert mined(spark, rows, every=10, positives=2, negatives=7, low=50) != {}
    assert mined(spark, []) == mined(spark, [(100, near, 1)]) == {}


def test_hard_negatives_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROUND", 3)
    rng = random.Random(5)
    rows = [(k, [round(rng.gauss(0, 0.3), 1) for _ in range(6)], 0 if k % 3 else rng.randrange(4)) for k in range(2500)]
    assert mined(spark, rows) == brute_force(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(14, 22) for _ in range(4)], k % 2) for k in range(0, 300, 5)]
    assert mined(spark, rows) == brute_force(rows)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(1)
    centres = np.repeat(rng.normal(0, 200, (8, 16)), 4, axis=1)  # level within a segment
    q = np.rint(centres[rng.integers(0, 8, 400)] + rng.normal(0, 5, (400, 64))).astype(np.int64)
    means, devs = hard_negatives.summaries(q)
    table = pa.table({
        "row": np.arange(400), "id": np.arange(400), "label": np.zeros(400, np.int64), "q": list(q),
        "means": list(means), "devs": list(devs),
    })
    block = hard_negatives.Block(table, 64, 16)
    scores = q @ q.T
    sizes = []
    for m, d in block.levels:
        middle, spread = m @ m.T, d @ d.T
        assert (np.abs(scores - middle) <= spread + 0.5).all()
        sizes.append(spread.mean())
    assert sizes == sorted(sizes, reverse=True)  # narrower segments, narrower bounds
    low = np.partition(scores, -5, axis=1)[:, -5].astype(float)
    rows, cols = hard_negatives.candidates(block, block, slice(0, 400), np.ones((400, 400), bool), low, np.full(400, 1e18))
    found = set(zip(rows.tolist(), cols.tolist()))
    assert found >= set(zip(*np.nonzero(scores >= low[:, None]))) and len(found) < 0.3 * scores.size
    assert (hard_negatives.exact(block, block, slice(0, 400), rows, cols) == scores[rows, cols]).all()


# --- importance resampling


def plain_resample(rows, target, percent=10, least=20, seed=2024, buckets=10_000):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    def bucket(w):
        return zlib.crc32(w.encode()) % buckets

    s, t = (collections.Counter(bucket(w) for text in texts for w in words(text)) for texts in ([r[1] for r in rows], target))
    total, goal = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * total / ((s[b] + 1.0) * goal))) for b in s}
    out = []
    for i, text in rows:
        own = words(text)
        weight = sum(gain[bucket(w)] for w in own)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(own), weight, score))
    able = sorted((-o[3], o[0]) for o in out if o[1] >= least and o[3] is not None)
    ranked = collections.defaultdict(list)
    for rank, (score, i) in enumerate(able[:percent * len(able) // 100], 1):
        ranked[i, -score].append(rank)
    return collections.Counter(
        (*o, ranked[o[0], o[3]].pop(0) if o[1] >= least and ranked[o[0], o[3]] else None) for o in out
    )


def resampled(spark, rows, target, **how):
    got = resampling.resample(frame(spark, rows).repartition(4), spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect())


def test_resample_of_odd_rows(spark, nothing):
    target = ["w3x W4X w5x!", None, "", "Größe 日本語 w9x"]
    assert resampled(spark, TEXTS, target, percent=50) == plain_resample(TEXTS, target, percent=50)
    assert resampled(spark, TEXTS, []) == plain_resample(TEXTS, [])
    assert resampling.resample(nothing, nothing).count() == 0


def test_ranks_are_exact_under_ties_and_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SAMPLES", 40)
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 50)
    rng = random.Random(8)
    rows = [(rng.randrange(10**9) if k % 3 else 77, " ".join(rng.choices(["a", "b", "ü"], k=25))) for k in range(3000)]
    target = ["a a b"]
    for percent in (0, 10, 60, 100):
        assert resampled(spark, rows, target, percent=percent) == plain_resample(rows, target, percent)


def test_longer_runs_are_features():
    assert resampling.features("a B,c", 2, 1000)[1].tolist() == [zlib.crc32(w) % 1000 for w in (b"a", b"b", b"c", b"a b", b"b c")]
    assert resampling.words_of("Zażółć\x00gęślą-9z [é]") == ["Zażółć".lower().encode(), "gęślą".encode(), b"9z", "é".encode()]
