"""Aggregate first, join afterwards.

Catalyst does not push an aggregation below a join on its own.  When a measure is additive
and the dimension is joined on a unique key, summing the fact by that key first shrinks the
join input from fact rows to keys, and the map-side partial sums absorb hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import ratio
from starmart.sources.scratch import materialize


def aggregate_then_join(
    fact: DataFrame,
    on: str,
    sums: dict[str, Column],
    dim: DataFrame,
    keys: Sequence[str] = (),
    derived: dict[str, Column] | None = None,
    then_by: Sequence[str] | None = None,
    then: dict[str, Column] | None = None,
) -> DataFrame:
    """Sum ``fact`` by ``keys + on``, inner join ``dim``, add ``derived`` columns and, when
    ``then_by`` is given, aggregate again with ``then``.

    ``on`` must be unique in ``dim``.  Measures have to be SUM, COUNT, MIN or MAX; a distinct
    count does not survive the second level and belongs in a branch of its own.
    """
    eager = fact.groupBy(*keys, on).agg(*[c.alias(a) for a, c in sums.items()])
    joined = eager.join(dim, on, "inner")
    if derived:
        joined = joined.withColumns(derived)
    if then_by is None:
        return joined
    return joined.groupBy(*then_by).agg(*[c.alias(a) for a, c in (then or {}).items()])


def share(df: DataFrame, metric: str, within: Sequence[str] = (), name: str = "share",
          digits: int | None = None) -> DataFrame:
    """Share of each row in its group's total.

    With ``within``, ``df`` is an aggregate over code-list columns (channels, reasons, bands), so a group has no more rows
    than the code list has entries.  Without it ``df`` may be of any size: it is stored, and its total is one row.
    """
    if not within:
        df, _ = materialize(df)
        return df.withColumn(name, ratio(F.col(metric), df.agg(F.sum(metric)).scalar(), digits))
    total = F.sum(metric).over(Window.partitionBy(*within))
    return df.withColumn(name, ratio(F.col(metric), total, digits))
