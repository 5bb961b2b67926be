"""Sharding by a hierarchical weighted hash tree: a document descends region, rack and shard by weighted hash draws.

A tree is a list of leaves (region, rack, shard, weight); the weight of a rack or region is the sum of its shards'.  At
each level every child draws ``-ln(u) / weight``, where u in (0, 1) is read off the MD5 of the document's key and the
child's path, and the child with the least draw is taken (equal draws: the lesser name).  So a child is taken in proportion
to its weight, and its draw depends on nothing but the key, its path and its own weight.  When weights change, a key
changes a level only if one of the changed children wins or loses it: rows move into, out of or within subtrees
whose weights changed, and between all others nothing moves.  A new shard that comes as a region of its own (``grown``)
therefore takes rows only into itself.  Children of weight 0 or less take nothing.

Placement is a projection; nothing is shuffled for it.  Only ``slot``, the place in a shard, needs an order: narrow rows
are range partitioned by shard, ``doc_id`` and place in the scan, stored, and numbered by their place in their range after
the counts of the ranges before, so no shard has to fit into a task.

A NULL text is empty (size 1).  All rows with a NULL ``doc_id`` have the same key and so the same shard; so have rows that
share a ``doc_id``.  Each row has a slot of its own, repeated rows too.  Equal texts are no reason to share a shard under this
law: ``doc_id`` and the tree decide alone.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import stored, text_of

Tree = list[tuple[str, str, int, float]]

LEVELS = ("region", "rack", "shard")
POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition there


def even_tree(shards: int, regions: int = 2, racks: int = 2) -> Tree:
    """``shards`` equal shards dealt over ``regions`` of ``racks`` racks, neighbours together."""
    cells = regions * racks
    return [(f"region{k * cells // shards // racks}", f"rack{k * cells // shards % racks}", k, 1.0) for k in range(shards)]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, as a region of its own."""
    new = max((leaf[2] for leaf in tree), default=-1) + 1
    return [*tree, (f"region-of-{new}", "rack0", new, weight)]


def _children(tree: Tree, depth: int) -> dict[str, list[tuple[str, float]]]:
    """For each path of ``depth`` names its children with their weights."""
    found: dict[str, dict[str, float]] = {}
    for leaf in tree:
        names = [str(n) for n in leaf[:3]]
        if leaf[3] > 0:
            own = found.setdefault("/".join(names[:depth]), {})
            own[names[depth]] = own.get(names[depth], 0.0) + float(leaf[3])
    return {path: sorted(own.items()) for path, own in found.items()}


def _draw(key: Column, path: Column, child: Column) -> Column:
    """Draw and name of a child; ``path`` is empty at the root."""
    digits = F.substring(F.md5(F.concat_ws("/", key, F.when(path != "", path), child["name"])), 1, 12)
    exponential = -F.ln((F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(2.0**48))
    return F.struct((exponential / child["weight"]).alias("draw"), child["name"].alias("name"))


def _draws(children: Column, key: Column, path: Column) -> Column:
    return F.transform(children, lambda child: _draw(key, path, child))


def place(rows: DataFrame, tree: Tree, key: Column, names: tuple[str, str, str] = LEVELS) -> DataFrame:
    """Add the region, rack and shard of ``key`` under the three ``names``; NULL if no child has weight."""
    path, out = F.lit(""), rows
    for depth, name in enumerate(names):
        tables = _children(tree, depth)
        if not tables:
            return out.withColumns({n: F.lit(None).cast("string") for n in names[depth:]})
        children = F.element_at(F.create_map(*[
            c for parent, own in tables.items()
            for c in (F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in own]))
        ]), path)
        out = out.withColumn(name, F.array_min(_draws(children, key, path))["name"])
        path = F.col(name) if depth == 0 else F.concat_ws("/", path, F.col(name))
    return out.withColumn(names[2], F.col(names[2]).cast("int"))


def shard(docs: DataFrame, tree: Tree, next_tree: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack: every row's place under ``tree``.

    ``grown_shard`` is the shard under ``next_tree``, by default ``tree`` with one more shard.
    """
    text, key = text_of(docs), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("scanned"),
    )
    rows = place(rows, tree, key)
    rows = place(rows, next_tree or grown(tree), key, ("_region", "_rack", "grown_shard")).drop("_region", "_rack")
    order = ["shard", "doc_id", "scanned"]
    lined_up = stored(stored(rows).repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()
    )).withColumn("part", F.shiftright("at", POSITION_BITS))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lined_up.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "part", F.col("shard").alias("_shard"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    # ranges follow the shards, so there are fewer starts than ranges and shards together
    return lined_up.join(F.broadcast(starts.withColumnRenamed("part", "_part")),
                         (F.col("part") == F.col("_part")) & F.col("shard").eqNullSafe(F.col("_shard"))).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("at") - F.col("first")).alias("slot"),
        "grown_shard", "region", "rack",
    )
