"""Splitting a whole number over groups in proportion to a weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.measures import ratio
from starmart.operators.ordered import SINGLE_TASK_ROWS, fits_one_task, running_sums


def allocate(
    df: DataFrame,
    weight: str,
    total: int,
    key: str,
    name: str = "allocated",
    max_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Whole shares of ``total`` that add up to it exactly.

    Every group gets the floor of its proportional share and the units left over go, one
    each, to the groups with the largest weight (``key`` breaks ties).  ``weight`` is an
    integer or decimal and not negative; the division is exact, so the floors never add up
    to more than ``total``.  If all weights are zero the groups share equally.
    """
    opts = dict(max_rows=max_rows, single_task_rows=single_task_rows)
    weighed = df.withColumn("_one", F.lit(1).cast("long"))
    placed = running_sums(weighed, [F.col(weight).desc(), F.col(key)], {"_rn": "_one", "_w": weight}, **opts)
    floored = placed.withColumn(
        "_floor",
        F.expr(f"""CASE WHEN coalesce(_w_total, 0) = 0 THEN cast({total} as bigint) div _rn_total
            ELSE (cast({total} as decimal(18,0)) * cast({weight} as decimal(18,2))) div nullif(_w_total, 0) END"""),
    )
    summed = running_sums(floored, [F.col(weight).desc(), F.col(key)], {"_f": "_floor"}, **opts)
    left = F.lit(total) - F.col("_f_total")
    return summed.select(
        *df.columns, (F.col("_floor") + F.when(F.col("_rn") <= left, 1).otherwise(0)).cast("long").alias(name)
    )


def scale_to_target(lines: DataFrame, targets: DataFrame, key: str, value: str, target: str,
                    name: str = "scaled", factor: str = "factor", max_keys: int | None = None) -> DataFrame:
    """Factor ``target / sum(value)`` per key put back on the lines, and the scaled value.

    The sums are aggregated and joined back: a window by key would gather a hot key's lines.
    ``max_keys`` bounds the rows of ``targets``; when they are few the factors are broadcast
    and the lines are not shuffled at all.
    """
    sums = lines.groupBy(key).agg(F.sum(value).alias("_sum"))
    factors = sums.join(targets.select(key, target), key).select(
        key, F.coalesce(ratio(target, "_sum"), F.lit(1.0)).alias(factor)
    )
    if fits_one_task(max_keys):
        factors = F.broadcast(factors)
    return lines.join(factors, key).withColumn(name, F.col(value).cast("double") * F.col(factor))
