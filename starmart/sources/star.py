"""The star schema as a handle: six tables, asked for by column."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import TABLES
from starmart.sources import catalog


@dataclass
class Star:
    """Access to the star tables.

    Analyses call ``sales(*columns)`` with the columns they use, so that a source which has
    to join to provide a column only does so when the column is asked for.
    """

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    reference_date: date | None = None

    @classmethod
    def from_catalog(cls, spark: SparkSession, namespace: str, reference_date: date | None = None,
                     tables: Iterable[str] = tuple(TABLES)) -> Star:
        return cls(spark, {n: catalog.table(spark, namespace, n) for n in tables}, reference_date)

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def sales(self, *columns: str) -> DataFrame:
        """Fact rows with the given columns.  ``revenue`` is pre-tax revenue of the line,
        gross less discount, negative on returns."""
        fact = self.table("fact_sales")
        measures = {"revenue": F.col("grossvalue") - F.col("discountamount")}
        return fact.select(*[measures[c].alias(c) if c in measures else c for c in columns]) if columns else fact

    @property
    def product(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def store(self) -> DataFrame:
        return self.table("dim_store")

    @property
    def customer(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def promotion(self) -> DataFrame:
        return self.table("dim_promotion")

    @property
    def date(self) -> DataFrame:
        return self.table("dim_date")

    @cached_property
    def as_of(self) -> date:
        """Reference date for everything that looks back from "today"."""
        return self.reference_date or self.date.agg(F.max("fulldate")).first()[0]

    @cached_property
    def _rows(self) -> dict[str, int]:
        return {}

    def rows(self, name: str) -> int:
        """Row count of a dimension: for stored tables a footer read.  It bounds every
        aggregate keyed by the dimension and decides between plain and distributed windows."""
        if name not in self._rows:
            self._rows[name] = self.table(name).count()
        return self._rows[name]
