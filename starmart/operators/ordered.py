"""Ranks, tiles, running totals and quantiles over inputs of any size.

A window without PARTITION BY moves its whole input into one task.  That is fine for a
handful of promotions and fatal for customers.  Every operator here takes the plain
window only when the caller can prove a row bound (``max_rows``), and otherwise range
partitions the rows, stores them once, and adds per-partition offsets: one row per
partition is all that is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import ratio, rounded
from starmart.sources.scratch import materialize

# Largest proven input for a window that runs in a single task (tens of MB of sort data).
SINGLE_TASK_ROWS = 1_000_000

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def fits_one_task(max_rows: int | None, limit: int = SINGLE_TASK_ROWS) -> bool:
    return max_rows is not None and max_rows <= limit


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _range_sorted(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """Rows in global order with ``_part`` (range partition) and ``_pos`` (place in it).

    The partition boundaries are sampled, so the result is stored: both the offset pass and
    the final pass must see the same boundaries.
    """
    # Without a given number AQE merges small neighbouring ranges, which keeps the order.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order)
    stored, _ = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()))
    return stored.select(
        "*",
        F.shiftright("_id", _POS_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
    ).drop("_id")


def _offsets(totals: DataFrame, sums: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Sum of earlier partitions per group, NULL where nothing was summed.  ``totals`` has a row per (partition,
    group), and since groups are contiguous in the order, a group spans few partitions."""
    w = Window.partitionBy(*within).orderBy("_part")
    return totals.select(
        "_part",
        *within,
        *[F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(Window.partitionBy(*within)).alias(f"_all_{s}") for s in sums],
    )


def running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: dict[str, str],
    within: Sequence[str] = (),
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``alias -> running sum of column`` and ``alias_total`` in a total order.

    ``order`` must be unique within the group; ties are the caller's business (collapse
    them first for RANGE semantics).
    """
    order = _order(order)
    if fits_one_task(max_rows, single_task_rows):
        w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        everything = Window.partitionBy(*within)
        return df.select(
            "*",
            *[F.sum(c).over(w).alias(a) for a, c in sums.items()],
            *[F.sum(c).over(everything).alias(f"{a}_total") for a, c in sums.items()],
        )
    ranged = _range_sorted(df, [*map(F.col, within), *order], partitions)
    cols = sorted(set(sums.values()))
    totals = ranged.groupBy("_part", *within).agg(*[F.sum(c).alias(c) for c in cols])
    offsets = _offsets(totals, cols, within).withColumnsRenamed({c: f"_k_{c}" for c in ["_part", *within]})
    if not within:
        offsets = F.broadcast(offsets)  # one row per range partition
    same = F.col("_part") == F.col("_k__part")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))  # rows of a NULL group are a group

    def onward(before: str, local: str) -> Column:
        """The window's sum: NULL only as long as nothing but NULLs was met."""
        b, own = F.col(before), F.col(local)
        return F.when(b.isNull(), own).when(own.isNull(), b).otherwise(b + own)

    local = Window.partitionBy("_part", *within).orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        ranged.withColumns({f"_local_{a}": F.sum(c).over(local) for a, c in sums.items()})
        .join(offsets, same)
        .select(
            *df.columns,
            *[onward(f"_before_{c}", f"_local_{a}").alias(a) for a, c in sums.items()],
            *[F.col(f"_all_{c}").alias(f"{a}_total") for a, c in sums.items()],
        )
    )


def row_numbers(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "rn",
    total: str | None = None,
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Global 1-based position in ``order`` (a total order), optionally with the row total."""
    order = _order(order)
    if fits_one_task(max_rows, single_task_rows):
        extra = [F.count(F.lit(1)).over(Window.partitionBy()).alias(total)] if total else []
        return df.select("*", F.row_number().over(Window.orderBy(*order)).cast("long").alias(name), *extra)
    ranged = _range_sorted(df, order, partitions)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    offsets = F.broadcast(_offsets(sizes, ["n"], ()))  # one row per range partition
    extra = [F.col("_all_n").alias(total)] if total else []
    return ranged.join(offsets, "_part").select(
        *df.columns, (F.coalesce("_before_n", F.lit(0)) + F.col("_pos") + 1).alias(name), *extra
    )


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "position", **opts) -> DataFrame:
    """The rows with their 1-based position first, for printing; of any number of rows."""
    return row_numbers(df, order, name, **opts).select(name, *df.columns)


def global_ntile(
    df: DataFrame,
    order: Sequence[str | Column],
    tiles: int,
    name: str = "tile",
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """``NTILE(tiles)`` over the whole input.  The larger tiles come first, as in SQL."""
    if fits_one_task(max_rows, single_task_rows):
        return df.withColumn(name, F.ntile(tiles).over(Window.orderBy(*_order(order))))
    numbered = row_numbers(df, order, "_rn", "_n", partitions=partitions, single_task_rows=single_task_rows)
    q = F.floor(F.col("_n") / tiles)
    r = F.col("_n") % tiles
    head = r * (q + 1)  # rows that fall into the r larger tiles
    tile = F.when(F.col("_rn") <= head, F.ceil(F.col("_rn") / (q + 1))).otherwise(
        r + F.ceil((F.col("_rn") - head) / F.greatest(q, F.lit(1)))
    )
    return numbered.select(*df.columns, tile.cast("int").alias(name))


def rank_by(
    df: DataFrame,
    metric: str | Column,
    within: Sequence[str] = (),
    desc: bool = True,
    name: str = "rank",
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """``RANK()`` with gaps; NULL metrics last in descending and first in ascending order."""
    value = F.col(metric) if isinstance(metric, str) else metric
    if fits_one_task(max_rows, single_task_rows):
        order = value.desc() if desc else value.asc()
        return df.withColumn(name, F.rank().over(Window.partitionBy(*within).orderBy(order)))
    # Ties share a rank, so rank each distinct value once by the rows in front of it, then
    # hand the result back.  A value held by very many rows is one row of ``values``.
    stored, _ = materialize(df.withColumn("_v", value))
    values = stored.groupBy(*within, "_v").agg(F.count(F.lit(1)).alias("_n"))
    order = F.col("_v").desc() if desc else F.col("_v").asc()
    ranks = running_sums(
        values, [order], {"_upto": "_n"}, within, partitions=partitions, single_task_rows=single_task_rows
    ).select(
        *[F.col(c).alias(f"_k_{c}") for c in within],
        F.col("_v").alias("_k_v"),
        (F.col("_upto") - F.col("_n") + 1).cast("int").alias(name),
    )
    same = F.col("_v").eqNullSafe(F.col("_k_v"))
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return stored.join(ranks, same).select(*df.columns, name)


def running_share(
    df: DataFrame,
    metric: str,
    running: str = "running",
    share: str = "share",
    ties: str = "range",
    key: Sequence[str] = (),
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Running total of ``metric`` from the largest down, and its share of the grand total.

    ``ties="range"`` gives equal values one common total; ``ties="rows"`` separates them by
    ``key``.
    """
    opts = dict(max_rows=max_rows, partitions=partitions, single_task_rows=single_task_rows)
    if ties == "rows":
        if not key:
            raise ValueError('ties="rows" needs a key that makes the order total')
        out = running_sums(df, [F.col(metric).desc(), *key], {running: metric}, **opts)
    elif fits_one_task(max_rows, single_task_rows):
        w = Window.orderBy(F.col(metric).desc()).rangeBetween(Window.unboundedPreceding, 0)
        out = df.select(
            "*",
            F.sum(metric).over(w).alias(running),
            F.sum(metric).over(Window.partitionBy()).alias(f"{running}_total"),
        )
    else:
        stored, _ = materialize(df)
        values = stored.groupBy(metric).agg(F.sum(metric).alias("_s"))
        totals = running_sums(
            values, [F.col(metric).desc()], {running: "_s"}, partitions=partitions,
            single_task_rows=single_task_rows,
        ).select(F.col(metric).alias("_k"), running, f"{running}_total")
        out = stored.join(totals, F.col(metric).eqNullSafe(F.col("_k"))).drop("_k")
    return out.withColumn(share, ratio(running, f"{running}_total")).drop(f"{running}_total")


def pareto_cutoff(
    df: DataFrame,
    metric: str,
    cutoff: float = 0.8,
    key: Sequence[str] = (),
    include_crossing: bool = False,
    **opts,
) -> DataFrame:
    """Rows that carry up to ``cutoff`` of the total, largest first.

    Without ``key`` equal values share one running total.  With ``key`` every row has its own,
    and ``include_crossing`` also keeps the row that crosses the line, giving the smallest set
    that reaches it.
    """
    if include_crossing and not key:
        raise ValueError("include_crossing needs a key that makes the order total")
    shared = running_share(df, metric, "_run", "_share", "rows" if key else "range", key, **opts)
    reached = F.col("_share")
    if include_crossing:
        # share in front of the row: the running total without the row itself
        reached = F.col("_share") * ratio(F.col("_run") - F.col(metric), "_run")
        return shared.filter((reached < cutoff)).drop("_run", "_share")
    return shared.filter(reached <= cutoff).drop("_run", "_share")


def quantiles(
    df: DataFrame,
    metric: str,
    probs: dict[str, float],
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """One row of exact, linearly interpolated quantiles of a numeric column (NULLs skipped).  One formula for every
    size: only the running counts below are taken by a plain window where the rows are proven few."""
    values = df.select(F.col(metric).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counts = values.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(
        counts, ["_v"], {"_upto": "_n"}, max_rows=max_rows, partitions=partitions, single_task_rows=single_task_rows
    )
    picks = []
    for alias, p in probs.items():
        at = F.lit(p) * (F.col("_upto_total") - 1)  # 0-based position, maybe between two rows
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (pos >= F.col("_upto") - F.col("_n")) & (pos < F.col("_upto"))
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"{alias}_{side}"))
    picked = cum.agg(*picks, F.max("_upto_total").alias("_N"))
    out = []
    for alias, p in probs.items():
        at = F.lit(p) * (F.col("_N") - 1)
        lo, hi = F.col(f"{alias}_lo"), F.col(f"{alias}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(alias))
    return picked.select(*out)


def sample_stddev(metric: str) -> Column:
    """Sample deviation, by Spark's stable update; the caller rounds, as its last digits depend on the row order."""
    return F.stddev_samp(F.col(metric).cast("double"))


def distribution(df: DataFrame, metric: str, count_name: str = "n", **opts) -> DataFrame:
    """One row: count, extremes, mean, sample deviation and quartiles of a DECIMAL column."""
    stats = df.agg(
        F.count(metric).alias(count_name),
        F.min(metric).alias(f"min_{metric}"),
        F.max(metric).alias(f"max_{metric}"),
        ratio(F.sum(metric), F.count(metric)).alias(f"avg_{metric}"),
        rounded(sample_stddev(metric), 8).alias(f"stdev_{metric}"),
    )
    parts = quantiles(df, metric, {"q25": 0.25, "median": 0.5, "q75": 0.75}, **opts)
    return stats.select("*", *[
        parts.select(rounded(c, 8).alias(c)).scalar().alias(f"{c}_{metric}") for c in ("q25", "median", "q75")
    ])


def occurrence_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    index: str = "occurrence",
    size: str = "group_size",
    max_rows: int | None = None,
    partitions: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """0-based place of each row among rows with equal ``keys``, and how many there are."""
    if fits_one_task(max_rows, single_task_rows):
        w = Window.partitionBy(*keys)
        return df.select(
            "*",
            (F.row_number().over(w.orderBy(*order)) - 1).cast("long").alias(index),
            F.count(F.lit(1)).over(w).alias(size),
        )
    return (
        running_sums(
            df.withColumn("_one", F.lit(1).cast("long")), order, {"_upto": "_one"}, keys,
            partitions=partitions, single_task_rows=single_task_rows,
        )
        .select(*df.columns, (F.col("_upto") - 1).alias(index), F.col("_upto_total").alias(size))
    )
