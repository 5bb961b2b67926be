"""Delimited files: typed scan with lineage, quarantine of bad rows, fixed-decimal writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import TABLES, TableSpec

CORRUPT = "_corrupt_record"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches ``path`` on the path's own file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str | Sequence[str], spec: TableSpec, columns: Sequence[str] = (),
             corrupt: bool = False) -> DataFrame:
    """Scan with the declared raw schema; nothing is inferred.

    A cell that does not parse is NULL.  ``corrupt`` keeps the text of such rows in
    ``_corrupt_record``.  ``columns`` restricts the result, and with it what is parsed.
    """
    schema = T.StructType(spec.raw_schema.fields)
    if corrupt:
        schema = schema.add(CORRUPT, "string")
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    df = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    return df.select(*columns) if columns else df


def with_lineage(df: DataFrame, logical_name: str) -> DataFrame:
    """Add the source file, the ingestion time and the logical input name."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingestion_ts"),
        F.lit(logical_name).alias("_file_name"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", digits: dict[str, int] | None = None,
              compression: str = "none") -> None:
    """Write with a header; ``digits`` fixes the decimals of chosen columns.  Compressed files are read as they are, each by
    one task."""
    digits = digits or {}
    df.select(
        *[
            F.col(c).cast(f"decimal(38,{digits[c]})").alias(c) if c in digits else F.col(c)
            for c in df.columns
        ]
    ).write.mode(mode).option("header", True).option("encoding", "UTF-8").option("compression", compression).csv(path)


def available_inputs(spark: SparkSession, folder: str, names: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """(table_name, path, status) of the expected input files; a missing one is reported and
    not an error."""
    rows = []
    for n in names:
        path = f"{folder.rstrip('/')}/{n}.csv"
        rows.append((n, path, "found" if exists(spark, path) else "missing"))
    return spark.createDataFrame(rows, "table_name string, path string, status string")
