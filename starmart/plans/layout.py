"""Physical layout of stored tables: compaction, multi-column clustering, old snapshots.

Delta tables use Delta's own OPTIMIZE and VACUUM.  Parquet tables, which ``catalog.publish``
keeps in snapshot folders, are rewritten to a new snapshot, and the table's location is
switched to it once the write is complete, so a failed run never leaves a half-written table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import TABLES, TableSpec
from starmart.sources import catalog

MANY_FILES = 20            # compaction pays from here on
RETENTION_HOURS = 168
TARGET_FILE_BYTES = 512 << 20
SORT_BYTES = 256 << 20     # of rows that a task sorts for a clustered file, in memory
CELL_BYTES = 16            # of a column of such a row
RANK_BITS = 7              # places per clustering column: 2 ** RANK_BITS


def cluster_keys(name: str, columns: Sequence[str]) -> list[str]:
    """Clustering columns of a star table that the stored table really has."""
    spec: TableSpec | None = TABLES.get(name)
    return [c for c in spec.cluster_by if c in columns] if spec else []


def file_count(total_bytes: int, target: int = TARGET_FILE_BYTES) -> int:
    return max(1, -(-total_bytes // target))


def sort_count(rows: int, columns: int) -> int:
    """Parts that a sort of so many rows takes for each to hold ``SORT_BYTES`` at most.  Files are packed many times
    denser than the rows that a task sorts for them, so their own size says nothing about that."""
    return max(1, -(-rows * (columns + 4) * CELL_BYTES // SORT_BYTES))


def rank_edges(df: DataFrame, keys: Sequence[str], bits: int = RANK_BITS) -> dict[str, list[float]]:
    """Values that cut each key's rows into parts of like size.  Special members (below 1) and NULL are left out, so they do
    not take part of the range away from the rest."""
    parts = (1 << bits) - 2
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(*[
        F.percentile_approx(F.when(_regular(k), F.col(k).cast("double")), shares, 10 * parts).alias(f"edges{i}")
        for i, k in enumerate(keys)
    ]).first()
    return {k: sorted(set(found[i] or [])) for i, k in enumerate(keys)}


def _regular(key: str) -> Column:
    return F.col(key).cast("double") >= 1


def _below(value: Column, edges: Sequence[float], low: int, high: int) -> Column:
    """How many edges are below the value, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value <= edges[middle], _below(value, edges, low, middle)).otherwise(_below(value, edges, middle + 1, high))


def rank_place(key: str, edges: Sequence[float]) -> Column:
    """0 for NULL, 1 for special members, from 2 on the part of the ranks a value falls into."""
    value = F.col(key).cast("double")
    return F.when(value.isNull(), 0).when(~_regular(key), 1).otherwise(_below(value, edges, 0, len(edges)) + 2).cast("long")


def morton_key(df: DataFrame, keys: Sequence[str], bits: int = RANK_BITS) -> DataFrame:
    """Add ``_curve``: the interleaved bits of each key's place among the ranks of its values, so rows close in every key
    get close numbers, however unevenly the values lie."""
    edges, curve = rank_edges(df, keys, bits), F.lit(0).cast("long")
    for i, key in enumerate(keys):
        place = rank_place(key, edges[key])
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1).cast("long"))
            curve = curve.bitwiseOR(F.shiftleft(bit, b * len(keys) + i))
    return df.withColumn("_curve", curve)


def cluster(df: DataFrame, keys: Sequence[str], files: int | None = None, bits: int = RANK_BITS) -> DataFrame:
    """Rows in clustering order, spread over ``files`` range partitions, or as many as
    adaptive execution finds right for their size.

    A single column is sorted as it is.  Within a cell of the curve rows are in order of the keys; the row hash behind
    them lets rows with one and the same key spread over several partitions.
    """
    content = [F.col(c) for c in df.columns if not c.startswith("_")]
    if len(keys) == 1:
        keyed = df.withColumn("_curve", F.col(keys[0]))
    else:
        keyed = morton_key(df, keys, bits)
    order = ("_curve", *keys, F.xxhash64(*content))
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions("_curve", *keys).drop("_curve")


def _parquet_rewrite(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Write a new snapshot beside the current one and point the table at it."""
    layer, name = table.rsplit(".", 1)
    new = catalog.snapshot_path(spark, layer, name)
    df.write.parquet(new)
    catalog.commit(spark, layer, name, new, spark.table(table).schema)
    catalog.follow(spark, layer, name)


def finish_swap(spark: SparkSession, layer: str, name: str) -> None:
    """Move the files that a committed swap brings, and remove those that give way.  Safe to repeat after dying."""
    newest = catalog.committed(spark, layer, name)
    if not newest or not newest["swap"]:
        return
    path, swap = newest["path"], newest["swap"]
    fs = None
    for n in catalog.data_files(spark, swap["come"]):
        there, fs = catalog._place(spark, f"{swap['come']}/{n}")
        fs.rename(there, catalog._place(spark, f"{path}/{n}")[0])
    for n in swap["gone"]:
        there, fs = catalog._place(spark, f"{path}/{n}")
        fs.delete(there, False)
    if fs:
        fs.delete(catalog._place(spark, swap["come"])[0], True)
    catalog.commit(spark, layer, name, path, newest["schema"])
    catalog.follow(spark, layer, name)
    spark.catalog.refreshTable(f"{layer}.{name}")


def compact(spark: SparkSession, table: str, target: int = TARGET_FILE_BYTES) -> dict[str, int]:
    """Merge the files below half of ``target`` bytes into files of about ``target``; larger ones are not touched.

    The folder is listed once.  Spark's own packing of small files into read partitions does the grouping, and each read
    partition becomes one file, without a shuffle.  One commit makes the merged files count instead of the small ones for
    all who read by ``catalog.table``; moving and removing files comes after it and can be finished by the next run.
    """
    layer, name = table.rsplit(".", 1)
    finish_swap(spark, layer, name)
    newest = catalog.committed(spark, layer, name)
    path = newest["path"]
    sizes = catalog.data_files(spark, path)
    if not sizes:
        raise FileNotFoundError(f"{table}: no files in {path}")
    small = sorted(n for n, size in sizes.items() if 2 * size < target)
    if len(small) < 2:
        return {"before": len(sizes), "rewritten": 0, "after": len(sizes)}
    come = f"{path}/_merged-{uuid.uuid4().hex}"
    packing = {"spark.sql.files.maxPartitionBytes": str(target), "spark.sql.files.openCostInBytes": "0",
               "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in packing}
    try:
        for k, v in packing.items():
            spark.conf.set(k, v)
        spark.read.schema(newest["schema"]).parquet(*[f"{path}/{n}" for n in small]).write.parquet(come)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    merged = catalog.data_files(spark, come)
    catalog.commit(spark, layer, name, path, newest["schema"], {"gone": small, "come": come})
    finish_swap(spark, layer, name)
    return {"before": len(sizes), "rewritten": len(small), "after": len(sizes) - len(small) + len(merged)}


def optimize_table(spark: SparkSession, table: str, files: int | None = None, many: int = MANY_FILES) -> tuple:
    """Cluster a table that has clustering columns, else compact it when it has many files.

    Returns (table, status, files before, files after).  Delta does both itself.  A clustered file is sorted by one task, so
    without ``files`` there are enough of them for the rows of each to fit its memory.
    """
    layer, name = table.rsplit(".", 1)
    df = spark.table(table)
    keys = cluster_keys(name, df.columns)
    before = len(df.inputFiles())
    if not keys and before <= many:
        return table, "skipped", before, before
    if catalog.has_delta(spark):
        zorder = f" ZORDER BY ({', '.join(keys)})" if keys else ""
        spark.sql(f"OPTIMIZE {table}{zorder}")
    elif not keys and catalog.committed(spark, layer, name):
        compact(spark, table)
    else:
        finish_swap(spark, layer, name)
        sizes = catalog.data_files(spark, catalog.table_detail(spark, table, count=False)["location"])
        n = files or file_count(sum(sizes.values()))
        if keys and not files:
            n = max(n, sort_count(df.count(), len(df.columns) + len(keys)))
        _parquet_rewrite(spark, table, cluster(df, keys, n) if keys else df.repartition(n))
    return table, "clustered" if keys else "compacted", before, len(spark.table(table).inputFiles())


def optimize_layers(spark: SparkSession, layers: Sequence[str] = catalog.LAYERS, **opts) -> list[tuple]:
    """Every table of the layers; an error on one is reported and does not stop the others."""
    out = []
    for layer in layers:
        if not spark.catalog.databaseExists(layer):
            continue
        for name, _ in catalog.listing(spark, layer):
            try:
                out.append(optimize_table(spark, f"{layer}.{name}", **opts))
            except Exception as e:
                out.append((f"{layer}.{name}", f"failed: {e}", None, None))
    return out


def vacuum(spark: SparkSession, table: str, retention_hours: int = RETENTION_HOURS, enabled: bool = False) -> list[str]:
    """Remove snapshots the table no longer points at, once they are older than the retention.

    Off unless asked for.  Returns what was, or with ``enabled=False`` would be, removed.
    """
    if catalog.has_delta(spark):
        if enabled:
            spark.sql(f"VACUUM {table} RETAIN {retention_hours} HOURS")
        return []
    newest = catalog.committed(spark, *table.rsplit(".", 1))
    current = newest["path"] if newest else catalog.table_detail(spark, table, count=False)["location"]
    if "/snapshot-" not in current:
        return []
    base = current.rsplit("/snapshot-", 1)[0]
    jpath = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    cutoff_ns = time.time_ns() - retention_hours * 3_600_000_000_000
    stale = []
    for status in fs.listStatus(jpath):
        path = status.getPath()
        name = path.getName()
        if name.startswith("snapshot-") and name != current.rsplit("/", 1)[-1]:
            if int(name.split("-")[1]) < cutoff_ns:
                stale.append(path)
    if enabled:
        for p in stale:
            fs.delete(p, True)
    return [p.toString() for p in stale]
