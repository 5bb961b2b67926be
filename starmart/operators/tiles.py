"""Several NTILEs over one set of rows, without sorting, storing or moving the rows.

A tile of a row follows from the tile's boundary rows alone.  So the boundaries are selected exactly, all of them together:
counts by range narrow the range of values around each wanted position until one value is left, and where rows tie on
it, the same is done with their keys.  A round is one aggregate that gathers at most ``RANGES`` counts for each boundary.
Each tile is then an expression of the row, whatever the number of rows, rankings and tiles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = 1000


@dataclass(frozen=True)
class Ranking:
    """Order by a metric; NULLs come first, or last if it is descending, as in SQL.  NaN comes after all numbers either way."""

    metric: str
    descending: bool = False


@dataclass
class _Wanted:
    """The row at ``place`` of those between two values that pass ``among``, in order of ``value``."""

    value: Column
    among: Column
    place: int
    low: object
    high: object
    rows: int = 0


def last_of_tiles(n: int, tiles: int) -> list[int]:
    """Position of the last row of each tile but the last; the larger tiles come first."""
    whole, more = divmod(n, tiles)
    ends = [whole * k + min(k, more) for k in range(1, tiles)]
    return [e for e in ends if e]


def _range(w: _Wanted) -> Column:
    """A number that never falls with the value and is different for the two ends."""
    low, high = (float(x) for x in (w.low, w.high))
    if math.isfinite(low) and math.isfinite(high) and low < high:
        return F.width_bucket(w.value.cast("double"), F.lit(low), F.lit(high), F.lit(RANGES)).cast("long")
    if math.isfinite(low) and math.isfinite(high):  # too close for a double
        return (w.value > F.lit((w.low + w.high) // 2 if isinstance(w.low, int) else (w.low + w.high) / 2)).cast("long")
    return F.when(w.value == F.lit(w.low), 0).when(w.value == F.lit(w.high), 2).otherwise(1).cast("long")


def _same(a: object, b: object) -> bool:
    return a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))


def _narrow(rows: DataFrame, wanted: list[_Wanted]) -> None:
    """Until each has one value: ``low``.  ``place`` is then the place among the ``rows`` that have it.  The values have one
    type."""
    while True:
        still = {i: w for i, w in enumerate(wanted) if not w.rows or not _same(w.low, w.high)}
        if not still:
            return
        met = F.array(*[
            F.when(w.among & w.value.between(F.lit(w.low), F.lit(w.high)),
                   F.struct(F.lit(i).alias("i"), w.value.alias("x"), _range(w).alias("range")))
            for i, w in still.items()
        ])
        counts = rows.select(F.explode(F.filter(met, lambda s: s.isNotNull())).alias("s")).groupBy("s.i", "s.range").agg(
            F.count(F.lit(1)).alias("n"), F.min("s.x").alias("low"), F.max("s.x").alias("high")
        ).collect()
        for i, w in still.items():
            for c in sorted((c for c in counts if c["i"] == i), key=lambda c: c["range"]):
                if w.place <= c["n"]:
                    w.low, w.high, w.rows = c["low"], c["high"], c["n"]
                    break
                w.place -= c["n"]


def tile_columns(rows: DataFrame, key: str, rankings: dict[str, Ranking], tiles: int) -> dict[str, Column]:
    """NTILE(``tiles``) over each ranking, by name; equal metrics are ordered by ``key``, a whole number and unique.

    ``rows`` are read a few times and should be stored or cheap.
    """
    value, is_float = {}, {}
    for name, r in rankings.items():
        is_float[name] = isinstance(rows.schema[r.metric].dataType, (T.DoubleType, T.FloatType))
        x = F.col(r.metric).cast("double" if is_float[name] else "decimal(38,8)")
        value[name] = -x if r.descending else x
    k = F.col(key).cast("long")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.min(k).alias("first"), F.max(k).alias("last"), *[
        c.alias(f"{what}_{i}") for i, x in enumerate(value.values())
        for what, c in (("some", F.count(x)), ("low", F.min(x)), ("high", F.max(x)))
    ]).first()
    ends = last_of_tiles(facts["n"], tiles)
    by_value: dict[tuple[str, int], _Wanted] = {}
    of_nulls: dict[tuple[str, int], int] = {}
    for i, (name, r) in enumerate(rankings.items()):
        some, nulls = facts[f"some_{i}"], facts["n"] - facts[f"some_{i}"]
        for end in ends:
            place = end if r.descending else end - nulls
            if 0 < place <= some:
                by_value[name, end] = _Wanted(value[name], value[name].isNotNull(), place, facts[f"low_{i}"], facts[f"high_{i}"])
            else:
                of_nulls[name, end] = place - some if r.descending else end
    for kind in (True, False):
        some = [w for (name, _), w in by_value.items() if is_float[name] is kind]
        if some:
            _narrow(rows, some)
    by_key = {
        at: _Wanted(k, value[at[0]] == F.lit(w.low), w.place, facts["first"], facts["last"])
        for at, w in by_value.items() if w.place < w.rows
    }
    by_key |= {
        at: _Wanted(k, value[at[0]].isNull(), place, facts["first"], facts["last"])
        for at, place in of_nulls.items() if place < facts["n"] - facts[f"some_{list(rankings).index(at[0])}"]
    }
    if by_key:
        _narrow(rows, list(by_key.values()))
    out = {}
    for name, r in rankings.items():
        behind = []
        for end in ends:
            x, w, tie = value[name], by_value.get((name, end)), by_key.get((name, end))
            tied = x.isNull() if w is None else F.coalesce(x == F.lit(w.low), F.lit(False))
            if w is None:
                after = F.lit(False) if r.descending else x.isNotNull()
            else:
                after = F.coalesce(x > F.lit(w.low), F.lit(r.descending))
            behind.append((after | (tied & (k > F.lit(tie.low))) if tie else after).cast("int"))
        out[name] = reduce(Column.__add__, behind, F.lit(1))
    return out
