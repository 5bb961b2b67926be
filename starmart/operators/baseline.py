"""Uplift of groups against a baseline group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import ratio
from starmart.operators.ordered import fits_one_task
from starmart.sources.scratch import materialize


def relative_change(value: Column | str, base: Column | str, digits: int | None = None) -> Column:
    """``(value - base) / base``; NULL for a zero base."""
    v = F.col(value) if isinstance(value, str) else value
    b = F.col(base) if isinstance(base, str) else base
    return ratio(v - b, b, digits)


def with_baseline(
    groups: DataFrame,
    is_baseline: Column,
    values: dict[str, Callable[[Column], Column]],
    max_rows: int | None = None,
) -> DataFrame:
    """Put aggregates over the baseline rows beside every row of ``groups``.

    ``values`` maps a new column to a function that builds the aggregate from the condition a
    row has to meet.  Groups that are proven to be few take a window.  Otherwise they are
    stored and the baseline is read back from them, so the fact is scanned once either way.
    """
    if fits_one_task(max_rows):
        everything = Window.partitionBy()
        return groups.select("*", *[f(is_baseline).over(everything).alias(n) for n, f in values.items()])
    stored, _ = materialize(groups)
    base = stored.agg(*[f(is_baseline).alias(n) for n, f in values.items()])
    return stored.select("*", *[base.select(n).scalar().alias(n) for n in values])


def uplift(groups: DataFrame, is_baseline: Column, value: str, per: str, max_rows: int | None = None) -> DataFrame:
    """Add ``per_unit`` (value / per), the baseline's own ``base`` and ``uplift`` over it."""
    with_sums = with_baseline(
        groups,
        is_baseline,
        {
            "_bv": lambda on: F.sum(F.when(on, F.col(value))),
            "_bp": lambda on: F.sum(F.when(on, F.col(per))),
        },
        max_rows,
    )
    return (
        with_sums.withColumn("per_unit", ratio(value, per))
        .withColumn("base", ratio("_bv", "_bp"))
        .withColumn("uplift", relative_change("per_unit", "base"))
        .drop("_bv", "_bp")
    )
