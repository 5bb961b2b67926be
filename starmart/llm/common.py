"""What several operators share: reading the table, stored intermediates and joins that survive a hot key."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmart
from starmart.sources.scratch import dropped_shuffles, materialize

HOT_PARTS = 1000
MARK_BITS, MOST_MARKS = 8, 1 << 20
ASCII_SPACE = r"[\x20\x09-\x0D]+"


PACKAGE = "starmart-package.zip"
_remembered: dict[str, Callable[[], None]] = {}  # in a worker: how to drop it, by operator


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if not any(f.endswith("/" + PACKAGE) for f in sc.listFiles):
        root = os.path.dirname(os.path.dirname(os.path.abspath(starmart.__file__)))
        name = os.path.join(tempfile.mkdtemp(), PACKAGE)
        sc.addPyFile(shutil.make_archive(name.removesuffix(".zip"), "zip", root, "starmart"))


def task_of(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called where a task begins.  Spark keeps Python workers for later tasks: what this one still remembers of another
    operator's tasks goes, what ``forget`` drops stays until a task of another operator begins."""
    for other in [k for k in _remembered if k != operator]:
        _remembered.pop(other)()
    if forget:
        _remembered[operator] = forget


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage, survives lost executors.

    Its shuffle files go as soon as it is written.
    """
    with dropped_shuffles(df.sparkSession):
        return materialize(df, compression)[0]


def release(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more: what was made of it is stored itself."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(table.inputFiles()[0]))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(df: DataFrame) -> Column:
    """The text column, NULL as the empty text.  Every operator begins with it, so it sees to it that executors can run
    the operator's Python."""
    ship(df.sparkSession)
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def maybe_among(rows: DataFrame, keys: DataFrame, key: str, most: int = MOST_MARKS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys`` (one row a key), so that few others are shuffled.  A
    bitmap of hashed keys is broadcast, of some ``MARK_BITS`` a key and ``most`` numbers at most; a full one lets more rows pass."""
    words, n = 1, keys.count()
    while words < most and words * 64 < n * MARK_BITS:
        words *= 2
    place = F.pmod(F.xxhash64(key), F.lit(64 * words))
    number, bit = F.shiftright(place, 6).cast("int"), (place % 64).cast("int")
    one = keys.select(number.alias("number"), F.expr("1L").alias("one"), bit.alias("bit"))
    found = one.groupBy("number").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")).toArrow()
    marks = np.zeros(words, "i8")
    marks[found.column("number").to_numpy()] = found.column("bits").to_numpy()
    table = rows.sparkSession.createDataFrame(pa.table({"marks": pa.array([marks], pa.list_(pa.int64()))}))
    kept = rows.columns
    return rows.crossJoin(F.broadcast(table)).where(F.getbit(F.element_at("marks", number + 1), bit) == 1).select(*kept)


def attach(rows: DataFrame, groups: DataFrame, key: str | list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per ``key`` in ``groups``, where ``weight`` is how many rows a group has.

    A group with a thousandth of all rows or more is hot.  There are at most 1000 of these, so they are broadcast
    and their rows are never shuffled; all other groups meet in an ordinary shuffle join.  Both inputs are read
    twice and should be stored.
    """
    keys = [key] if isinstance(key, str) else key
    is_hot = F.col(weight) * HOT_PARTS >= F.lit(total)
    hot, rest = F.broadcast(groups.where(is_hot)), groups.where(~is_hot)
    return rows.join(hot, keys).unionByName(
        rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys)
    )
