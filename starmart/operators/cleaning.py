"""Typed cleaning, key handling and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import TableSpec

# Dash characters that look like '-' and are brought back to it.
_DASHES = "‐‑‒–—−"


def plain_dashes(c: str | Column) -> Column:
    """Typographic dashes to '-', so that coded values compare equal."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(c, _DASHES, "-" * len(_DASHES))


def empty_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def refine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast to the clean types in one projection: '' becomes NULL, typographic dashes in
    ``channel`` become '-', a value its type cannot hold becomes NULL (see ``quarantine``).
    Columns outside the declared schema, such as lineage, pass through."""
    types = spec.clean_types
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = empty_to_null(plain_dashes(c) if f.name == "channel" else c)
        if f.name in types:
            c = c.try_cast(types[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


def quarantine(df: DataFrame, spec: TableSpec, corrupt: str = "_corrupt_record") -> DataFrame:
    """Raw rows that would lose a value in ``refine``, or that could not be parsed."""
    lost = F.lit(False)
    for name, kind in spec.clean_types.items():
        if name in df.columns:
            raw = F.col(name)
            if isinstance(df.schema[name].dataType, T.StringType):
                raw = empty_to_null(raw)
            lost = lost | (raw.isNotNull() & raw.try_cast(kind).isNull())
    if corrupt in df.columns:
        lost = lost | F.col(corrupt).isNotNull()
    return df.filter(lost)


def dedup(df: DataFrame, pk: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, else the latest ingestion; rows still tied are
    told apart by a hash of the row.  Spark keeps one row per key on the map side already
    (partial group limit), so a key with very many copies is not gathered."""
    if order is None:
        order = [F.col("_ingestion_ts").desc()] if "_ingestion_ts" in df.columns else []
    content = [c for c in df.columns if not c.startswith("_")]
    w = Window.partitionBy(*pk).orderBy(*order, F.xxhash64(*content))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_defaults(df: DataFrame, string: str | None = "Unknown", integer: int | None = 0,
                  fraction: float | None = 0.0) -> DataFrame:
    """Replace NULL, and '' in text columns, by a default per type."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType) and string is not None:
            c = F.coalesce(empty_to_null(c), F.lit(string))
        elif isinstance(f.dataType, T.IntegralType) and integer is not None:
            c = F.coalesce(c, F.lit(integer).cast(f.dataType))
        elif isinstance(f.dataType, T.FractionalType) and fraction is not None:
            c = F.coalesce(c, F.lit(fraction).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def literal_row(df: DataFrame, values: dict) -> DataFrame:
    """A one-row frame shaped like ``df``: given values, '' for other text and 0 for numbers."""
    cols = []
    for f in df.schema.fields:
        if f.name in values:
            v = f"'{values[f.name]}'"
        elif isinstance(f.dataType, T.StringType):
            v = "''"
        else:
            v = "0" if isinstance(f.dataType, T.NumericType) else "NULL"
        cols.append(f"CAST({v} AS {f.dataType.simpleString()}) AS `{f.name}`")
    return df.sparkSession.sql(f"SELECT {', '.join(cols)}")


def missing_members(df: DataFrame, spec: TableSpec, check: bool = True) -> DataFrame:
    """The table's unknown and none members that ``df`` does not hold.

    Only the special keys are looked up (a filter that reaches the scan), so asking does not
    shuffle the dimension.  ``check=False`` skips even that when they cannot be there.
    """
    members = None
    for values in spec.special_rows:
        row = literal_row(df, values)
        members = row if members is None else members.unionByName(row)
    if check:
        keys = [r[spec.pk] for r in spec.special_rows]
        present = df.filter(F.col(spec.pk).isin(keys)).select(spec.pk)
        members = members.join(present, spec.pk, "left_anti").select(df.columns)
    return members


def with_special_members(df: DataFrame, spec: TableSpec, check: bool = True) -> DataFrame:
    """Append the missing special members."""
    return df.unionByName(missing_members(df, spec, check))


def restricted(df: DataFrame, store: DataFrame, region: str | None, admin: bool = False) -> DataFrame:
    """Rows of a table with ``storeid`` that a principal of ``region`` may see; an
    administrator sees all, a principal without a region sees none."""
    if admin:
        return df
    allowed = store.filter(F.col("region") == F.lit(region)).select("storeid")
    return df.join(allowed, "storeid", "left_semi")
