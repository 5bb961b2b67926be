"""Namespaces, tables and views of the session catalog.

What a published table holds is decided by its newest commit: a small file beside the data that names a finished snapshot
folder and its schema, and that appears by one rename.  The catalog entry follows the commit; ``table`` reads what is
committed and mends an entry that a writer left behind when it died between the two.  So an overwrite is one step for
readers even when the schema changes, which takes the catalog several steps.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import TABLES
from starmart.sources.scratch import scratch_path

LAYERS = ("bronze", "silver", "gold")
COMPRESSION = "zstd"  # of stored parquet files; smaller than by Spark's default, and as fast to read


def has_delta(spark: SparkSession) -> bool:
    """Whether Delta tables can be written in this session."""
    try:
        spark._jvm.java.lang.Class.forName(
            "io.delta.tables.DeltaTable", False, spark._jvm.Thread.currentThread().getContextClassLoader()
        )
    except Exception:  # py4j wraps ClassNotFoundException
        return False
    return True


def ensure_namespaces(spark: SparkSession, names: Iterable[str] = LAYERS) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")


@contextmanager
def scoped_namespaces(spark: SparkSession, names: Iterable[str] = LAYERS) -> Iterator[dict[str, str]]:
    """Namespaces of one's own for the names, in the scratch folder; dropped with their tables at the end."""
    root, suffix = scratch_path(spark), uuid.uuid4().hex[:12]
    made = {n: f"{n}_{suffix}" for n in names}
    try:
        for n, own in made.items():
            spark.sql(f"CREATE DATABASE {own} LOCATION '{root}/{n}'")
        yield made
    finally:
        for own in made.values():
            spark.sql(f"DROP DATABASE IF EXISTS {own} CASCADE")


def table_root(spark: SparkSession, layer: str, name: str) -> str:
    return f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}/{name}"


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, layer: str, name: str) -> list[str]:
    folder, fs = _place(spark, f"{table_root(spark, layer, name)}/_commits")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(n for n in names if n.isdigit())


def commit(spark: SparkSession, layer: str, name: str, path: str, schema: T.StructType, swap: dict | None = None) -> None:
    """Make the finished files in ``path`` the content of ``layer.name``, by one rename that fails if another writer was
    first.  ``swap`` says that files of the folder are about to give way to others (see ``layout.compact``): ``gone``, their
    names, and ``come``, the folder that holds the others until they are moved."""
    done = _commits(spark, layer, name)
    folder = f"{table_root(spark, layer, name)}/_commits"
    pending, fs = _place(spark, f"{folder}/pending-{uuid.uuid4().hex}")
    final, _ = _place(spark, f"{folder}/{int(done[-1]) + 1 if done else 1:012d}")
    out = fs.create(pending, False)
    out.write(bytearray(json.dumps({"path": path, "schema": schema.jsonValue(), "swap": swap}).encode()))
    out.close()
    jvm = spark._jvm
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.NONE  # does not replace
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(pending), fs.makeQualified(final), how)


def committed(spark: SparkSession, layer: str, name: str) -> dict | None:
    """path, schema and swap of the newest commit; None for a table that was never published here."""
    done = _commits(spark, layer, name)
    if not done:
        return None
    path, fs = _place(spark, f"{table_root(spark, layer, name)}/_commits/{done[-1]}")
    stream = fs.open(path)
    entry = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return entry | {"schema": T.StructType.fromJson(entry["schema"])}


def data_files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Name and bytes of each data file in a folder, by one listing."""
    path, fs = _place(spark, folder)
    if not fs.exists(path):
        return {}
    return {f.getPath().getName(): f.getLen() for f in fs.listStatus(path)
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """What is committed as ``layer.name``.  A catalog entry that is behind is brought up to date; if that fails the
    committed files are read all the same."""
    newest = None if has_delta(spark) else committed(spark, layer, name)
    if newest is None:
        return spark.table(f"{layer}.{name}")
    path, schema, swap = newest["path"], newest["schema"], newest["swap"]
    if swap:
        come = data_files(spark, swap["come"])  # first: a file that is moved meanwhile is met twice, not never
        stay = data_files(spark, path).keys() - set(swap["gone"])
        files = [f"{path}/{n}" for n in sorted(stay)] + [f"{swap['come']}/{n}" for n in sorted(come.keys() - stay)]
        return spark.read.schema(schema).parquet(*files)
    try:
        follow(spark, layer, name)
        return spark.table(f"{layer}.{name}")
    except PySparkException:
        return spark.read.schema(schema).parquet(path)


def follow(spark: SparkSession, layer: str, name: str) -> None:
    """Bring the catalog entry to the newest commit.  Safe to repeat after dying at any point."""
    newest = committed(spark, layer, name)
    path, schema = newest["path"], newest["schema"]
    full = f"{layer}.{name}"
    if spark.catalog.tableExists(full):
        if _columns(spark.table(full).schema) == _columns(schema):
            location, fs = _place(spark, table_detail(spark, full, count=False)["location"])
            wanted, _ = _place(spark, path)
            if not fs.makeQualified(location).equals(fs.makeQualified(wanted)):
                spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
                spark.catalog.refreshTable(full)
            return
        spark.sql(f"DROP TABLE {full}")
    spark.catalog.createTable(full, path=path, source="parquet", schema=schema)


def row_digest(columns: Sequence[str]) -> Column:
    """60 bits of a row's content, the same in any order of rows and in any engine with MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell whether two tables hold the same rows: number, sum and exclusive or of the row digests.  A
    changed cell changes the sum; a lost row that another row makes up for in number changes both."""
    own = row_digest(columns)
    return [F.count(F.lit(1)).alias("rows"), F.sum(own.cast("decimal(38,0)")).cast("string").alias("digest_sum"),
            F.bit_xor(own).alias("digest_xor")]


def snapshot_path(spark: SparkSession, layer: str, name: str) -> str:
    """A new folder for one version of a table's data."""
    return f"{table_root(spark, layer, name)}/snapshot-{time.time_ns()}"


def publish(df: DataFrame, layer: str, name: str, comment: str | None = None, files: int | None = None,
            max_records: int | None = None) -> int:
    """Replace table ``layer.name`` by ``df``, schema included; return the rows written (see ``publish_observed``)."""
    return publish_observed(df, layer, name, [F.count(F.lit(1)).alias("rows")], comment, files, max_records)["rows"]


def publish_observed(df: DataFrame, layer: str, name: str, observe: Sequence[Column], comment: str | None = None,
                     files: int | None = None, max_records: int | None = None) -> dict:
    """Replace table ``layer.name`` by ``df``, schema included; return the aggregates ``observe`` of what was written.

    Parquet data is written to a snapshot folder of its own first, then committed, and the catalog follows.  A write that
    fails at any point leaves the earlier or the new table, whole (``layout.vacuum`` removes old snapshots).

    The aggregates are observed while writing, so the lineage is not run a second time for them.  The number of files
    follows the partitions AQE ends up with; ``files`` forces a number for small tables and ``max_records`` limits the
    size of one.
    """
    spark = df.sparkSession
    if files is not None:
        df = df.repartition(files)
    seen = Observation()
    writer = df.observe(seen, *observe).write.mode("overwrite").option("overwriteSchema", "true")
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    if has_delta(spark):
        writer.format("delta").saveAsTable(f"{layer}.{name}")
    else:
        path = snapshot_path(spark, layer, name)
        writer.parquet(path, compression=COMPRESSION)
        commit(spark, layer, name, path, df.schema)
        follow(spark, layer, name)
    if comment:
        describe(spark, f"{layer}.{name}", comment)
    return seen.get


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def publish_query(spark: SparkSession, query: str, layer: str, name: str, comment: str | None = None) -> int:
    """Materialise a SQL query as a table."""
    return publish(spark.sql(query), layer, name, comment)


def append(df: DataFrame, layer: str, name: str) -> None:
    """Append by position to an existing table."""
    df.write.insertInto(f"{layer}.{name}")


def describe(spark: SparkSession, table: str, text: str, view: bool = False) -> None:
    """Attach a description to a table or view."""
    literal = text.replace("\\", "\\\\").replace("'", "\\'")
    if view:
        spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ('comment' = '{literal}')")
    else:
        spark.sql(f"COMMENT ON TABLE {table} IS '{literal}'")


def publish_view(spark: SparkSession, name: str, query: str, comment: str) -> None:
    """A virtual mart: a catalog view with its description."""
    literal = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{literal}' AS {query}")


def drop(spark: SparkSession, layer: str, names: Iterable[str], kind: str = "TABLE") -> None:
    for n in names:
        spark.sql(f"DROP {kind} IF EXISTS {layer}.{n}")


def listing(spark: SparkSession, layer: str, pattern: str | None = None, exclude: Sequence[str] = ()) -> list[tuple]:
    """(name, description) of the tables in a layer whose name matches a regular expression."""
    found = [
        (t.name, t.description) for t in spark.catalog.listTables(layer)
        if not t.isTemporary and not any(x in t.name for x in exclude)
        and (pattern is None or re.search(pattern, t.name))
    ]
    return sorted(found)


def register_views(spark: SparkSession, layer: str, prefix: str = "") -> None:
    """Session views ``<prefix><table>`` over the star tables of a layer."""
    for n in TABLES:
        table(spark, layer, n).createOrReplaceTempView(f"{prefix}{n}")


def table_detail(spark: SparkSession, table: str, count: bool = True) -> dict:
    """Location and, if asked for, file count of a table."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name IN ('Location', 'Provider')").collect()
    info = {r["col_name"].lower(): r["data_type"] for r in rows}
    if count:
        info["files"] = len(spark.table(table).inputFiles())
    return info


def refresh_statistics(spark: SparkSession, table: str) -> None:
    """Full-scan column statistics, which the cost-based optimizer reads."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, least, most, nulls) as the optimizer has them, one row a column; NULL where it keeps none."""
    rows = []
    for c in spark.table(table).columns:
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{c}`").collect()}
        rows.append((c, *(None if told.get(k) in (None, "NULL") else told[k] for k in ("min", "max", "num_nulls"))))
    return spark.createDataFrame(rows, "column_name string, least string, most string, nulls string").withColumn(
        "nulls", F.col("nulls").cast("long"))
