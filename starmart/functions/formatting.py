"""Report text.  Used only at the edge; marts and reports stay numeric."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(c: str | Column, digits: int = 0) -> Column:
    """Thousands separators; empty text for NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.format_number(c, digits), F.lit(""))


def pct(c: str | Column, digits: int = 2, scale: int = 100) -> Column:
    """A fraction as percent text; empty text for NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.format_number(c * scale, digits), F.lit("%")), F.lit(""))


def text(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def bar(c: str | Column, per_block: int = 2, block: str = "█") -> Column:
    """A text bar, one block for every ``per_block`` points."""
    c = F.col(c) if isinstance(c, str) else c
    return F.repeat(F.lit(block), (c / per_block).cast("int"))


def format_report(
    df: DataFrame, money_cols: Iterable[str] = (), pct_cols: Iterable[str] = (), limit: int | None = None
) -> DataFrame:
    """Format chosen columns for printing; other columns are left alone.  Positions come from
    ``operators.ordered.numbered``, before the limit and before money has become text."""
    money_cols, pct_cols = set(money_cols), set(pct_cols)
    if limit is not None:
        df = df.limit(limit)
    return df.select(
        *[
            money(c).alias(c) if c in money_cols else pct(c).alias(c) if c in pct_cols else F.col(c)
            for c in df.columns
        ]
    )

