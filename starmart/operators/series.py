"""Moving averages and period-over-period change along one ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import ratio
from starmart.operators.ordered import SINGLE_TASK_ROWS, fits_one_task, row_numbers

_BLOCK = 100_000


def _along(
    df: DataFrame,
    order: str,
    before: int,
    after: int,
    exprs: dict[str, callable],
    max_rows: int | None,
    single_task_rows: int,
    block: int = _BLOCK,
) -> DataFrame:
    """Add ``name -> expr(window)`` for frames that look ``before`` rows back and ``after``
    ahead; the expressions may also use ``_rn`` (position) and ``_n`` (length).

    A long series is cut into blocks, each with copies of the rows its frames reach beyond
    the block's edge, so that no task sorts the whole series.
    """
    bounded = fits_one_task(max_rows, single_task_rows)
    rows = row_numbers(df, [order], "_rn", "_n", max_rows=max_rows, single_task_rows=single_task_rows)
    if bounded:
        w = Window.orderBy(order)
        return rows.select(*df.columns, *[e(w).alias(n) for n, e in exprs.items()])
    home = F.floor((F.col("_rn") - 1) / block)
    lo = F.floor((F.col("_rn") - 1 - after) / block)
    hi = F.floor((F.col("_rn") - 1 + before) / block)
    spread = rows.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(lo, hi)))
    w = Window.partitionBy("_block").orderBy("_rn")
    return (
        spread.select("*", *[e(w).alias(n) for n, e in exprs.items()])
        .filter(F.col("_block") == F.col("_home"))
        .select(*df.columns, *exprs)
    )


def moving_avg(
    df: DataFrame,
    order: str,
    value: str,
    before: int,
    after: int = 0,
    min_periods: int = 1,
    name: str = "moving_avg",
    max_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    block: int = _BLOCK,
) -> DataFrame:
    """Mean over ``before`` rows back to ``after`` rows ahead; NULL below ``min_periods`` rows."""

    def mean(w) -> Column:
        frame = w.rowsBetween(-before, after)
        avg = ratio(F.sum(value).over(frame), F.count(value).over(frame))
        return F.when(F.count(F.lit(1)).over(frame) >= min_periods, avg)

    return _along(df, order, before, after, {name: mean}, max_rows, single_task_rows, block)


def centred_avg(
    df: DataFrame,
    order: str,
    value: str,
    window: int = 7,
    raw_head: int = 3,
    raw_tail: int = 4,
    name: str = "smoothed",
    max_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    block: int = _BLOCK,
) -> DataFrame:
    """Centred mean; the first ``raw_head`` and last ``raw_tail`` rows keep their raw value."""
    half = window // 2

    def smooth(w) -> Column:
        frame = w.rowsBetween(-half, half)
        edge = (F.col("_rn") <= raw_head) | (F.col("_rn") > F.col("_n") - raw_tail)
        return F.when(edge, F.col(value).cast("double")).otherwise(
            ratio(F.sum(value).over(frame), F.lit(window))
        )

    return _along(df, order, half, half, {name: smooth}, max_rows, single_task_rows, block)


def drift(
    df: DataFrame,
    order: str,
    value: str,
    name: str = "drift",
    max_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    block: int = _BLOCK,
) -> DataFrame:
    """Change relative to the previous row; 0 for the first row and after a zero."""

    def change(w) -> Column:
        prev = F.lag(value).over(w)
        return F.coalesce(ratio(F.col(value) - prev, prev), F.lit(0.0))

    return _along(df, order, 1, 0, {name: change}, max_rows, single_task_rows, block)
