"""Products bought together.

Pair counting is quadratic in the size of a basket, so two things guard it.  A large basket
is cut into blocks of items and each pair of blocks is its own join key, which bounds what a
single task expands.  And because only the top pairs are wanted, items that provably cannot
be part of one are dropped first: the pruning bound is exact, no pair is lost to a cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.measures import ratio
from starmart.sources.scratch import materialize

FEW_PAIRS = 100_000  # rows of a broadcast, a few MB
BLOCK_ITEMS = 1_000     # items of one basket that are paired within one join key
SEED_ITEMS = 256        # items whose pairs give the first lower limit for the top list
PAIR_BUCKETS = 1 << 21  # counts of the first pass at a support threshold; 16 MB at most are broadcast
PAIRS_PER_ROW = 50      # expected expansion up to which all pairs are simply counted


def basket_items(sales: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, item, n): lines of an item in a basket, with the basket's number of distinct
    items ``k`` and largest line count ``m``."""
    counts = sales.groupBy(F.col(basket).alias("basket"), F.col(item).alias("item")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sizes = counts.groupBy("basket").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("m"))
    return counts.join(sizes, "basket")


def pair_lines(items: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_a, item_b, n) with ``item_a < item_b`` for every basket that has both: their pairs of lines.

    A basket of k items has ``ceil(k / block_items)`` blocks.  An item goes to every cell
    (block pair) its block is part of; two items of different blocks meet only in the cell of
    their two blocks, two items of one block only in the diagonal cell.
    """
    blocks = F.ceil(F.col("k") / block_items).cast("int")
    own = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    cells = (
        items.select("basket", "item", "n", blocks.alias("blocks"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "basket",
            F.least("own", "other").alias("c1"),
            F.greatest("own", "other").alias("c2"),
            "own",
            "item",
            "n",
        )
    )
    a, b = cells.alias("a"), cells.alias("b")
    meet = (
        (F.col("a.basket") == F.col("b.basket"))
        & (F.col("a.c1") == F.col("b.c1"))
        & (F.col("a.c2") == F.col("b.c2"))
        & (F.col("a.item") < F.col("b.item"))
        & ((F.col("a.own") != F.col("b.own")) | (F.col("a.c1") == F.col("a.c2")))
    )
    return a.join(b, meet).select(
        F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"), (F.col("a.n") * F.col("b.n")).alias("n")
    )


def pair_counts(items: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_a, item_b, co_occurrence), counting pairs of lines."""
    return pair_lines(items, block_items).groupBy("item_a", "item_b").agg(F.sum("n").alias("co_occurrence"))


def able_pair_lines(items: DataFrame, min_support: int, block_items: int = BLOCK_ITEMS, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """``pair_lines`` without pairs that provably occur less than ``min_support`` times.

    A first pass counts the pairs by a hash into ``buckets``; of these counts each task hands on at most one a bucket.  A
    pair cannot occur more often than its bucket, so pairs of lesser buckets are never shuffled.
    """
    lines = pair_lines(items, block_items).withColumn("bucket", F.pmod(F.xxhash64("item_a", "item_b"), F.lit(buckets)))
    able = lines.groupBy("bucket").agg(F.sum("n").alias("most")).filter(F.col("most") >= min_support).select("bucket")
    return lines.join(F.broadcast(able), "bucket", "left_semi").drop("bucket")  # at most ``buckets`` whole numbers


def _best(pairs: DataFrame, top: int) -> DataFrame:
    return pairs.orderBy(F.col("co_occurrence").desc(), "item_a", "item_b").limit(top)


def _bounds(items: DataFrame) -> DataFrame:
    """(item, bound): no pair of the item can occur more often than ``bound``.

    In a basket, the line pairs of an item with any one partner number at most its own lines
    times the largest line count of the basket.
    """
    return items.groupBy("item").agg(F.sum(F.col("n") * F.col("m")).alias("bound"))


def _reaching(items: DataFrame, least: int) -> DataFrame:
    """Without items all of whose pairs occur less than ``least`` times."""
    keep = _bounds(items).filter(F.col("bound") >= least).select("item")
    return items.join(keep, "item", "left_semi")


def _candidates(items: DataFrame, top: int, block_items: int, seed_items: int) -> DataFrame:
    """Items that can still be part of a top pair.

    The exact counts among the items with the largest bounds give a count the top list is
    sure to reach, and items bounded below it are out.  Items that tie it stay, so the
    tie-break by item sees the same pairs.
    """
    bounds = _bounds(items)
    seeds = bounds.orderBy(F.col("bound").desc(), "item").limit(seed_items).select("item")
    seeded = items.join(F.broadcast(seeds), "item", "left_semi")  # at most seed_items rows
    reached = _best(pair_counts(seeded, block_items), top).agg(
        F.min("co_occurrence").alias("least"), F.count(F.lit(1)).alias("found")
    ).first()
    if reached["found"] < top:
        return items
    return _reaching(items, reached["least"])


def pairs(
    sales: DataFrame,
    basket: str,
    item: str,
    top: int | None = 100,
    min_support: int = 1,
    block_items: int = BLOCK_ITEMS,
    seed_items: int = SEED_ITEMS,
    pairs_per_row: int = PAIRS_PER_ROW,
) -> DataFrame:
    """Item pairs by co-occurrence, with popularity and rule measures.

    ``co_occurrence`` counts pairs of lines.  ``baskets_a``/``baskets_b`` are the baskets that
    hold the item; ``confidence_ab`` is co-occurrence over ``baskets_a``.  ``support`` and
    ``lift`` relate to all baskets.  ``top=None`` returns every pair.
    """
    items, _ = materialize(basket_items(sales, basket, item))
    paired = items.filter("k > 1")
    if min_support > 1:
        paired = _reaching(paired, min_support)
    if top is not None:
        # A basket of k items is k rows, each with (k - 1) / 2 of its pairs.
        expected = paired.agg(F.sum(F.col("k") - 1).alias("ends"), F.count(F.lit(1)).alias("rows")).first()
        if (expected["ends"] or 0) / 2 > pairs_per_row * expected["rows"]:
            paired = _candidates(paired, top, block_items, seed_items)
    if min_support > 1:
        able = able_pair_lines(paired, min_support, block_items)
        counted = able.groupBy("item_a", "item_b").agg(F.sum("n").alias("co_occurrence"))
    else:
        counted = pair_counts(paired, block_items)
    counted = counted.filter(F.col("co_occurrence") >= min_support)
    all_baskets = items.agg(F.count_distinct("basket").alias("n")).scalar()
    popularity = items.groupBy("item").agg(F.count(F.lit(1)).alias("baskets"))
    if top is not None:
        counted = _best(counted, top)
        if top <= FEW_PAIRS:
            counted = F.broadcast(counted)  # at most ``top`` rows
    pop_a = popularity.select(F.col("item").alias("item_a"), F.col("baskets").alias("baskets_a"))
    pop_b = popularity.select(F.col("item").alias("item_b"), F.col("baskets").alias("baskets_b"))
    return (
        pop_a.join(counted, "item_a")
        .join(pop_b, "item_b")
        .withColumn("baskets", all_baskets)
        .select(
            "item_a", "item_b", "co_occurrence", "baskets_a", "baskets_b",
            ratio("co_occurrence", "baskets_a").alias("confidence_ab"),
            ratio("co_occurrence", "baskets_b").alias("confidence_ba"),
            ratio("co_occurrence", "baskets").alias("support"),
            ratio(
                F.col("co_occurrence").cast("double") * F.col("baskets"),
                F.col("baskets_a").cast("double") * F.col("baskets_b"),
            ).alias("lift"),
        )
    )
