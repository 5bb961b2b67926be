"""Raw files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.cleaning import dedup, missing_members, quarantine, refine, with_special_members
from starmart.plans.marts import MARTS
from starmart.schemas import TABLES
from starmart.sources import catalog
from starmart.sources.delimited import CORRUPT, exists, read_csv, with_lineage
from starmart.sources.star import Star


def load_bronze(spark: SparkSession, folder: str, layer: str = "bronze") -> list[tuple]:
    """Load every expected file that is there; (table, rows or None, status) per table.

    Rows that do not parse stay in the bronze table as read, so nothing is lost, and are
    listed by :func:`rejected`.
    """
    catalog.ensure_namespaces(spark, [layer])
    out = []
    for name, spec in TABLES.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        if not exists(spark, path):
            out.append((name, None, "missing"))
            continue
        raw = with_lineage(read_csv(spark, path, spec, corrupt=True), f"{name}.csv")
        out.append((name, catalog.publish(raw, layer, name), "loaded"))
    return out


def rejected(spark: SparkSession, name: str, layer: str = "bronze") -> DataFrame:
    """Bronze rows with cells that did not parse or do not fit the clean type."""
    return quarantine(catalog.table(spark, layer, name), TABLES[name], CORRUPT)


def clean(df: DataFrame, name: str) -> DataFrame:
    """Bronze rows to silver rows: clean types, one row per key, special members, audit time."""
    spec = TABLES[name]
    df = df.drop(CORRUPT)
    out = dedup(refine(df, spec), [spec.pk])
    if spec.special_rows:
        out = with_special_members(out, spec)
    return out.withColumn("_silver_processed_ts", F.current_timestamp())


def build_silver(spark: SparkSession, source: str = "bronze", target: str = "silver",
                 exclude: Sequence[str] = ()) -> list[tuple]:
    catalog.ensure_namespaces(spark, [target])
    out = []
    for name, _ in catalog.listing(spark, source, exclude=exclude):
        if name in TABLES:
            rows = catalog.publish(clean(catalog.table(spark, source, name), name), target, name)
            out.append((name, rows, "cleaned"))
    return out


def ensure_special_members(spark: SparkSession, layer: str, name: str) -> int:
    """Insert the unknown and none members a stored dimension lacks; rows inserted."""
    stored, spec = catalog.table(spark, layer, name), TABLES[name]
    missing = missing_members(stored, spec)
    n = missing.count()
    if n:
        catalog.append(missing, layer, name)
    return n


def build_gold(spark: SparkSession, source: str = "silver", target: str = "gold",
               as_of: date | None = None) -> list[tuple]:
    """Materialise the 17 marts with their descriptions."""
    catalog.ensure_namespaces(spark, [target])
    star = Star.from_catalog(spark, source, as_of)
    out = []
    for name, build in MARTS.items():
        text = " ".join((build.__doc__ or "").split())
        out.append((name, catalog.publish(build(star), target, name, comment=text), "published"))
    return out


def reconcile(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """(table_name, source_rows, target_rows, matches) for every table of the source layer."""
    out = None
    for name, src in sources.items():
        a = src.agg(F.count(F.lit(1)).alias("source_rows"))
        b = targets[name].agg(F.count(F.lit(1)).alias("target_rows"))
        row = a.select(F.lit(name).alias("table_name"), "source_rows", b.scalar().alias("target_rows"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def require_reconciled(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> None:
    bad = reconcile(sources, targets).filter("NOT matches").collect()
    if bad:
        raise ValueError("row counts differ: " + ", ".join(f"{r[0]} {r[1]}/{r[2]}" for r in bad))


@dataclass
class StepResult:
    name: str
    seconds: float
    status: str
    detail: object = None


def run(steps: Sequence[tuple[str, Callable[[], object]]], stop_on_failure: bool = True) -> list[StepResult]:
    """Run named steps in order and time them; by default the first failure ends the run."""
    out = []
    for name, step in steps:
        start = time.monotonic()
        try:
            out.append(StepResult(name, time.monotonic() - start, "ok", step()))
        except Exception as e:
            out.append(StepResult(name, time.monotonic() - start, "failed", str(e)))
            if stop_on_failure:
                break
        out[-1].seconds = time.monotonic() - start
    return out


def medallion_steps(spark: SparkSession, folder: str, as_of: date | None = None) -> list[tuple[str, Callable]]:
    return [
        ("bronze", lambda: load_bronze(spark, folder)),
        ("silver", lambda: build_silver(spark)),
        ("gold", lambda: build_gold(spark, as_of=as_of)),
    ]
