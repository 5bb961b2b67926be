"""Ordered bands over a numeric column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(col: str | Column, edges: Sequence, labels: Sequence, right: bool = True,
              else_last: bool = False) -> Column:
    """Label ``col`` by inner ``edges``; one more label than edges.

    ``right=True`` puts a value equal to an edge in the lower band, ``right=False`` in the
    upper one.  NULL stays NULL, or takes the last label with ``else_last``, as a CASE that ends in ELSE does.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    c = F.col(col) if isinstance(col, str) else col
    band = None
    for edge, label in zip(edges, labels):
        hit = c <= F.lit(edge) if right else c < F.lit(edge)
        band = F.when(hit, F.lit(label)) if band is None else band.when(hit, F.lit(label))
    return band.otherwise(F.lit(labels[-1])) if else_last else band.when(c.isNotNull(), F.lit(labels[-1]))


@dataclass(frozen=True)
class Banding:
    edges: tuple
    labels: tuple
    right: bool = True
    else_last: bool = False

    def of(self, col: str | Column) -> Column:
        return bucketize(col, self.edges, self.labels, self.right, self.else_last)

    def ordinal(self, col: str | Column) -> Column:
        """Position of the band, for sorting reports by band and not by label."""
        return bucketize(col, self.edges, tuple(range(1, len(self.labels) + 1)), self.right, self.else_last)


# Band edges and labels of the published reports.
DELIVERY_SPEED = Banding((2, 5), ("Fast (1-2 days)", "Standard (3-5 days)", "Long (>5 days)"), else_last=True)
DELIVERY_SPEED_SHORT = Banding((2, 5), ("Fast (1-2)", "Normal (3-5)", "Slow (6+)"), else_last=True)
PRICE_TIER = Banding(
    (50, 200, 500), ("Budget (<50)", "Mid (50-200)", "Premium (200-500)", "Luxury (500+)"), right=False, else_last=True
)
RECENCY = Banding(
    (30, 90, 180),
    ("Active (0-30 days)", "Recent (31-90 days)", "Dormant (91-180 days)", "Churned (>180 days)"),
)
INCOME_BRACKET = Banding(
    (25000, 50000, 75000, 100000), ("Low", "Medium", "High", "Very High", "Ultra High")
)
INCOME_TIER = Banding((30000, 50000, 80000), ("Bronze", "Silver", "Gold", "Platinum"))
MARGIN_BUCKET_LABELS = (
    "< -10%", "-10% to -5%", "-5% to 0%", "0-5%", "5-10%", "10-15%", "15-20%", "20-25%", "25-30%",
    ">30% (invalid)",
)
MARGIN_BUCKET = Banding((-10, -5, 0, 5, 10, 15, 20, 25, 30), MARGIN_BUCKET_LABELS)


def margin_bucket(col: str | Column) -> Column:
    """Five-point margin bands.  The lowest edge belongs to the second band."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == -10, F.lit(MARGIN_BUCKET_LABELS[1])).otherwise(MARGIN_BUCKET.of(c))


def margin_bucket_ordinal(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == -10, F.lit(2)).otherwise(MARGIN_BUCKET.ordinal(c))
