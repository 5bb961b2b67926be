"""Connected components of a relation between nodes that is found by common keys, without pairing whole groups.

Nodes with a key in common are candidates.  Pairing all members of a key would grow with the square of a group of near
copies, so the members of a key are first paired with one leader only, in a few rounds with different leaders.  What is
verified joins components.  A key whose members all are in one component is done.  In the last round every pair of
members of an open key that lie in different components and can be linked is verified, so no relation between two
components is lost: what is never looked at are pairs that are connected already.  A caller may find the pairs of that round's large
keys by ``finer`` ones, so that members of one large key are not all compared with each other.  All
steps are DataFrame operations.

Defined results: a NULL key is no key, a NULL node no node; no members, or none with a key in common, give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import release, stored

LEADER_ROUNDS = 2


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    Alternating large and small stars: every node passes its larger, then its smaller neighbours on to the smallest one
    it knows, until only stars around the smallest nodes are left.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        then = _mark(after)
        if then == mark:
            release(after)
            break
        release(now)
        now, mark = after, then
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def linked_components(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], extras: tuple[str, ...] = (),
    possible: Callable[[str, str], Column] | None = None, prefer: str | None = None, direct: DataFrame | None = None,
    finer: Callable[[DataFrame], DataFrame] | None = None, few: int = 0,
) -> DataFrame:
    """(node, component) of all nodes that are linked with another.

    ``members`` has key, node (bigint) and the columns ``extras``.  ``verify`` takes distinct pairs (a, b), a < b, and
    returns those that are linked.  ``possible`` gives the condition under which two members of a key may be linked on
    account of it, from the names of two structs of node and extras; a linked pair must pass it at one of its keys.
    Leaders of the first round have the least ``prefer``.  ``direct`` has pairs (a, b), a < b, to verify beside those of
    ``members``.  ``finer`` takes the open members (key, n, x, component) of those keys of the last round that have more than
    ``few`` members outside their largest component, ``n`` in all, and returns pairs (a, b), a < b, among them all linked
    pairs of a key and of different components.
    """
    one = F.struct("node", *extras)

    def admitted(rows: DataFrame) -> DataFrame:
        able = rows.where(possible("x", "y")) if possible else rows
        return able.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()

    members = stored(members)
    groups = members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"),
                                        F.min_by(one, F.struct(prefer or "node", "node")).alias("y"))
    open_members = stored(members.join(groups.where("low < high"), "key").select(
        "key", one.alias("x"), "y", F.col("node").alias("component"), F.col("y.node").alias("its")
    ))
    release(members)
    tried = links = parts = None
    for turn in range(1, LEADER_ROUNDS + 2):
        if turn <= LEADER_ROUNDS:
            pairs = open_members.where("component <> its").select("x", "y")
        else:
            often = open_members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
            keys = often.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                            (F.sum("n") - F.max("n")).alias("outside"), F.sum("n").alias("n"))
            apart = F.col("component") != F.col("other")
            able = apart & possible("x", "y") if possible else apart
            now = open_members.select("key", "x", "component")
            if finer:
                keys = stored(keys)
            main = keys.where(F.col("outside") <= few) if finer else keys
            rest = now.join(main, "key").where("component <> main").select("key", F.col("x").alias("y"), F.col("component").alias("other"))
            pairs = now.join(rest, "key").where(able).select("x", "y")
        pairs = admitted(pairs)
        if turn > LEADER_ROUNDS and finer:
            many = keys.where(F.col("outside") > few).select("key", "n")
            if many.take(1):
                pairs = pairs.unionByName(finer(now.join(many, "key"))).distinct()
        if turn == 1 and direct is not None:
            pairs = pairs.unionByName(direct.select("a", "b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = stored(verify(pairs))
        links = found if links is None else links.unionByName(found)
        if parts is None or found.take(1):
            parts = stored(connected(links))
        if turn > LEADER_ROUNDS:
            return parts
        own = parts.select(F.col("node").alias("_node"), F.col("component").alias("_own"))
        placed = open_members.select("key", "x").join(own, F.col("x.node") == F.col("_node"), "left").select(
            "key", "x", F.coalesce("_own", "x.node").alias("component")
        )
        still = placed.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by(F.struct("x", "component"), F.xxhash64("x.node", F.lit(turn))).alias("leader"),
        ).where("low < high").select("key", F.col("leader.x").alias("y"), F.col("leader.component").alias("its"))
        before, open_members = open_members, stored(placed.join(still, "key").select("key", "x", "y", "component", "its"))
        release(before)
        if not open_members.take(1):
            return parts
    raise AssertionError("the last round returns")
