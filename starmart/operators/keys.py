"""Key integrity: orphans, duplicates, null profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.scratch import materialize

FEW_KEYS = 100_000  # rows of a broadcast, a few MB

Refs = dict[str, tuple[DataFrame, str]]


def names_frame(spark: SparkSession, names: Sequence[str], column: str) -> DataFrame:
    """A few literal names as rows, in the given order (``_pos``)."""
    return spark.range(0, 1, 1, 1).select(F.posexplode(F.array(*map(F.lit, names))).alias("_pos", column))


def orphan_keys(fact: DataFrame, refs: Refs) -> DataFrame:
    """(fk, key, n, orphan) for every distinct foreign key value, all references in one pass.

    Each fact row is unpivoted to its keys and counted map side, so what is shuffled and
    joined is distinct keys, not fact rows, and a hot key is one row.
    """
    # References go by number until the end: grouping by text would cost more per fact row.
    keys = F.array(*[F.col(fk).cast("long") for fk in refs])
    used = (
        fact.select(F.posexplode(keys).alias("ref", "key"))
        .groupBy("ref", "key").agg(F.count(F.lit(1)).alias("n"))
    )
    known = None
    for i, (dim, pk) in enumerate(refs.values()):
        part = dim.select(F.lit(i).alias("ref"), F.col(pk).cast("long").alias("key"))
        known = part if known is None else known.unionByName(part)
    known = known.distinct().withColumn("_known", F.lit(1))
    names = F.array(*[F.lit(fk) for fk in refs])
    return used.join(known, ["ref", "key"], "left").select(
        names[F.col("ref")].alias("fk"), "key", "n", F.col("_known").isNull().alias("orphan")
    )


def orphans(fact: DataFrame, refs: Refs) -> DataFrame:
    """(fk, orphan_count): fact rows whose key is missing from the dimension, or NULL."""
    counts = orphan_keys(fact, refs).groupBy("fk").agg(
        F.sum(F.when(F.col("orphan"), F.col("n")).otherwise(0)).alias("orphan_count")
    )
    return (
        names_frame(fact.sparkSession, list(refs), "fk")
        .join(counts, "fk", "left")
        .select("fk", F.coalesce("orphan_count", F.lit(0)).cast("long").alias("orphan_count"))
    )


def missing_keys(fact: DataFrame, refs: Refs) -> DataFrame:
    """(fk, key): the distinct foreign key values no dimension row has."""
    return orphan_keys(fact, refs).filter("orphan").select("fk", "key")


def rows_with_orphans(fact: DataFrame, refs: Refs) -> DataFrame:
    """One row, ``orphan_count``: fact rows for which at least one reference is missing or NULL.

    The keys that no dimension has come first, from distinct keys only.  Fact rows are then marked against these few; a
    hot key that is known, such as the unknown member, moves no rows.  The missing keys are broadcast if they are counted
    and few, and joined otherwise.
    """
    lost, n = materialize(missing_keys(fact, refs).filter("key IS NOT NULL"))
    marked, hit = fact.select(*refs), F.lit(False)
    for fk in refs:
        hit = hit | F.col(fk).isNull()
        if n:
            keys = lost.filter(F.col("fk") == fk).select(F.col("key").alias(fk), F.lit(1).alias(f"_lost_{fk}"))
            marked = marked.join(F.broadcast(keys) if n <= FEW_KEYS else keys, fk, "left")
            hit = hit | F.col(f"_lost_{fk}").isNotNull()
    return marked.agg(F.count_if(hit).alias("orphan_count"))


def duplicate_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``n`` rows and ``duplicates`` = rows minus distinct keys.  A NULL key is no
    key, so each NULL row counts as a duplicate.  Two levels of counting keep the shuffle to
    the key columns and a repeated key to one row per map task."""
    is_null = F.lit(False)
    for c in cols:
        is_null = is_null | F.col(c).isNull()
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("n") - F.when(is_null, 0).otherwise(1)), F.lit(0)).alias("duplicates"),
    )


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, nulls) from one aggregate."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "nulls")


def assertions(df: DataFrame, keys: Sequence[Sequence[str]] = (), filled: Sequence[str] = ()) -> DataFrame:
    """(assertion, column_name, violations, holds) for unique keys and columns without NULL, as result rows."""
    nulls = null_profile(df, filled).select(
        F.lit("no nulls").alias("assertion"), "column_name", F.col("nulls").alias("violations")) if filled else None
    for cols in keys:
        row = duplicate_count(df, cols).select(
            F.lit("unique").alias("assertion"), F.lit(", ".join(cols)).alias("column_name"), F.col("duplicates").alias("violations"))
        nulls = row if nulls is None else nulls.unionByName(row)
    return nulls.withColumn("holds", F.col("violations") == 0)


def require_unique(df: DataFrame, cols: Sequence[str], what: str) -> None:
    """Raise when the key is duplicated or NULL."""
    bad = duplicate_count(df, cols).first()["duplicates"]
    if bad:
        raise ValueError(f"{what}: {bad} duplicate or NULL values in {', '.join(cols)}")


def require_no_nulls(df: DataFrame, what: str) -> None:
    bad = [r for r in null_profile(df, df.columns).filter("nulls > 0").collect()]
    if bad:
        raise ValueError(f"{what}: NULLs in " + ", ".join(f"{r[0]} ({r[1]})" for r in bad))
