"""The raw, clean and published layers as queries: files written, loaded, cleaned and published in namespaces of a run's own.

Input files are made from a star by the data's own rows, with what real inputs bring along: repeated lines, empty texts, a
cell that does not parse and typographic dashes.  Special members are left out of them; the clean layer adds them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.keys import assertions
from starmart.plans import layout, marts, medallion
from starmart.schemas import DIMENSIONS, TABLES
from starmart.sources import catalog
from starmart.sources.delimited import write_csv
from starmart.sources.order_lines import OrderLineStar
from starmart.sources.scratch import materialize, scratch_path
from starmart.sources.star import Star

REPEATED = 7    # every so many orders' lines come twice
LARGE_FILE_ROWS, LARGE_FILES = 10_000_000, 24  # lines of a large file, and large files at most; small ones stay below half of one
UNREADABLE = 1000  # every so many orders' lines have a cell that does not parse
# Orders have several lines and lines no key of their own, so the files carry one made of the line.
LINE_KEY = (
    "CAST(conv(substring(md5(concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
    "CAST(l_suppkey AS STRING), CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING))), 1, 15), 16, 10) AS BIGINT)"
)


def raw_rows(star: OrderLineStar, name: str) -> DataFrame:
    """A table as it comes in, as text where a cell does not fit its type."""
    if name != "fact_sales":
        spec = TABLES[name]
        return star.table(name).filter(F.col(spec.pk) > 0).select(spec.names)
    lines = star.sales(*TABLES[name].names, line_key=LINE_KEY)
    told = lines.withColumns({
        "channel": F.translate("channel", "-", "‑"),
        "payment": F.when(F.col("payment") == "Cash", "").otherwise(F.col("payment")),
        "hour": F.when(F.col("salesid") % UNREADABLE == 1, "late").otherwise(F.col("hour").cast("string")),
    })
    # Once more within the row's own task: the lines are read and joined to their orders once.
    times = F.when(F.col("salesid") % REPEATED == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    again = told.withColumn("_time", F.explode(times)).drop("_time")
    return again.withColumn("salesid", F.col("line_key")).drop("line_key")


@dataclass
class Layers:
    """The layers of one run: their namespaces, and what was written."""

    spark: SparkSession
    namespaces: dict[str, str]
    loaded: list[tuple]
    cleaned: dict[str, dict]

    def table(self, layer: str, name: str) -> DataFrame:
        return catalog.table(self.spark, self.namespaces[layer], name)


def clean_columns(name: str) -> list[str]:
    return TABLES[name].names


def through_layers(star: OrderLineStar, names: Iterable[str], build: Callable[[Layers], DataFrame]) -> DataFrame:
    """``build`` over the bronze and silver layers of the tables.  Its rows are stored, then the namespaces are dropped."""
    spark, names = star.spark, list(names)
    folder = scratch_path(spark)
    for name in names:
        write_csv(raw_rows(star, name), f"{folder}/{name}.csv", compression="gzip")
    with catalog.scoped_namespaces(spark) as spaces:
        steps = medallion.run([
            ("bronze", lambda: medallion.load_bronze(spark, folder, spaces["bronze"])),
            ("silver", lambda: {
                name: catalog.publish_observed(
                    medallion.clean(catalog.table(spark, spaces["bronze"], name), name), spaces["silver"], name,
                    catalog.digest(clean_columns(name)))
                for name, _ in catalog.listing(spark, spaces["bronze"], exclude=["scratch"])
            }),
        ])
        failed = [s for s in steps if s.status != "ok"]
        if failed:
            raise RuntimeError(f"{failed[0].name}: {failed[0].detail}")
        return materialize(build(Layers(spark, spaces, steps[0].detail, steps[1].detail)), catalog.COMPRESSION)[0]


def layers_row_counts(star: OrderLineStar) -> DataFrame:
    """Rows loaded and rows after cleaning of every table that there was a file for; the others are missing."""
    def build(layers: Layers) -> DataFrame:
        rows = [(n, s, loaded, layers.cleaned.get(n, {}).get("rows")) for n, loaded, s in layers.loaded]
        return star.spark.createDataFrame(rows, "table_name string, status string, bronze_rows long, silver_rows long")

    return through_layers(star, ["fact_sales", "dim_product", "dim_store", "dim_promotion"], build)


def layers_silver_fact(star: OrderLineStar) -> DataFrame:
    """All clean sales lines."""
    return through_layers(star, ["fact_sales"], lambda layers: layers.table("silver", "fact_sales").select(clean_columns("fact_sales")))


def layers_rejected(star: OrderLineStar) -> DataFrame:
    """Loaded lines with a cell that did not parse, and the file they came from."""
    return through_layers(star, ["fact_sales"], lambda layers: medallion.rejected(
        star.spark, "fact_sales", layers.namespaces["bronze"]).select(
        "salesid", "_file_name", F.col("_source_file").contains("/fact_sales.csv/").alias("from_its_file")))


def _mart(star: OrderLineStar, names: list[str], mart: Callable[[Star], DataFrame]) -> DataFrame:
    def build(layers: Layers) -> DataFrame:
        spark, gold = star.spark, layers.namespaces["gold"]
        clean = Star.from_catalog(spark, layers.namespaces["silver"], star.as_of, names)
        catalog.publish(mart(clean), gold, mart.__name__, comment=" ".join((mart.__doc__ or "").split()))
        return catalog.table(spark, gold, mart.__name__)

    return through_layers(star, names, build)


def layers_m001(star: OrderLineStar) -> DataFrame:
    """The product margin mart, published from files."""
    return _mart(star, ["fact_sales", "dim_product"], marts.product_category_margin)


def layers_m003(star: OrderLineStar) -> DataFrame:
    """The customer segment mart, published from files."""
    return _mart(star, ["fact_sales", "dim_product", "dim_date"], marts.customer_rfm_segments)


def layers_special_members(star: OrderLineStar) -> DataFrame:
    """Members below 1 of the clean dimensions; adding them once more adds none."""
    def build(layers: Layers) -> DataFrame:
        out = None
        for name in DIMENSIONS:
            again = medallion.ensure_special_members(star.spark, layers.namespaces["silver"], name)
            rows = layers.table("silver", name).filter(F.col(TABLES[name].pk) < 1).select(
                F.lit(name).alias("table_name"), F.col(TABLES[name].pk).cast("long").alias("key"),
                F.lit(again).cast("long").alias("added_again"))
            out = rows if out is None else out.unionByName(rows)
        return out

    return through_layers(star, DIMENSIONS, build)


def compare_digests(written: dict[str, dict], stored: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows, digest_sum, digest_xor, matches): what was observed while writing against what is read back."""
    out = None
    for name, seen in written.items():
        own = stored[name].agg(*catalog.digest(clean_columns(name)))
        same = [F.col(k).eqNullSafe(F.lit(v)) for k, v in seen.items()]
        row = own.select(F.lit(name).alias("table_name"), "rows", "digest_sum", "digest_xor", (same[0] & same[1] & same[2]).alias("matches"))
        out = row if out is None else out.unionByName(row)
    return out


def layers_digests(star: OrderLineStar) -> DataFrame:
    """Content of the clean tables, observed while they were written and read back."""
    names = ["fact_sales", "dim_store"]
    return through_layers(star, names, lambda layers: compare_digests(
        layers.cleaned, {n: layers.table("silver", n) for n in names}))


def layers_published(star: OrderLineStar) -> DataFrame:
    """Names and descriptions of what a layer holds: a query's table, a mart by pattern, without an excluded one."""
    def build(layers: Layers) -> DataFrame:
        spark, gold = star.spark, layers.namespaces["gold"]
        layers.table("silver", "dim_store").createOrReplaceTempView("layers_store")
        rows = catalog.publish_query(spark, "SELECT region, count(*) AS stores FROM layers_store GROUP BY region", gold, "regions", "Stores of each region")
        spark.catalog.dropTempView("layers_store")
        catalog.publish(layers.table("silver", "dim_store").limit(0), gold, "regions_old", comment="left out")
        catalog.append(catalog.table(spark, gold, "regions").filter("region <> 'Unknown'"), gold, "regions")
        catalog.publish_view(spark, f"{gold}.regions_view", f"SELECT * FROM {gold}.regions WHERE stores > 0", "The same as a view")
        catalog.publish(spark.range(1), gold, "staging")
        catalog.drop(spark, gold, ["staging", "staging"])
        found = catalog.listing(spark, gold, "^regions", exclude=["_old"])
        counted = [(n, text, rows, catalog.table(spark, gold, n).count() if n == "regions" else spark.table(f"{gold}.{n}").count()) for n, text in found]
        return spark.createDataFrame(counted, "name string, description string, written long, rows long")

    return through_layers(star, ["dim_store"], build)


def layers_overwrite(star: OrderLineStar) -> DataFrame:
    """A table overwritten with other columns by a writer that stops after its commit: readers have the new rows."""
    spark = star.spark
    sales = star.sales("storeid", "net", "isreturn")
    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(sales.groupBy("storeid").agg(F.count(F.lit(1)).alias("lines")), gold, "store_sales")
        wider = sales.groupBy("storeid", "isreturn").agg(F.count(F.lit(1)).alias("lines"), F.sum("net").alias("net"))
        path = catalog.snapshot_path(spark, gold, "store_sales")
        wider.write.parquet(path)
        catalog.commit(spark, gold, "store_sales", path, wider.schema)
        return materialize(catalog.table(spark, gold, "store_sales"))[0]


def table_statistics(star: OrderLineStar) -> DataFrame:
    """Column statistics of stored sales, as the optimizer has them after a refresh."""
    spark = star.spark
    with catalog.scoped_namespaces(spark, ["silver"]) as spaces:
        full = f"{spaces['silver']}.sales"
        catalog.publish(star.sales("salesid", "productid", "qty", "net", "isreturn", "hour"), spaces["silver"], "sales")
        catalog.refresh_statistics(spark, full)
        told = catalog.column_statistics(spark, full)
        return told.select("column_name", F.col("least").cast("double"), F.col("most").cast("double"), "nulls")


def compacted_sales(star: OrderLineStar) -> DataFrame:
    """Sales in large files and many small ones, compacted: lines and value by store, and what became of the files."""
    spark = star.spark
    sales = star.sales("salesid", "storeid", "net")
    few = F.col("storeid") % 10 == 0
    with catalog.scoped_namespaces(spark, ["silver"]) as spaces:
        silver = spaces["silver"]
        large = min(LARGE_FILES, -(-star.rows("fact_sales") // LARGE_FILE_ROWS))
        rest = sales.filter(~few)
        catalog.publish(rest.repartition(large) if large > 1 else rest.coalesce(1), silver, "sales")
        catalog.append(sales.filter(few).repartition(12), silver, "sales")
        path = catalog.committed(spark, silver, "sales")["path"]
        before = catalog.data_files(spark, path)
        done = layout.compact(spark, f"{silver}.sales", target=max(before.values()))
        after = catalog.data_files(spark, path)
        kept = max(before, key=before.get) in after
        return materialize(catalog.table(spark, silver, "sales").groupBy("storeid").agg(
            F.count(F.lit(1)).alias("lines"), F.sum("net").alias("net")
        ).withColumns({"large_file_kept": F.lit(kept), "small_files_rewritten": F.lit(done["rewritten"]),
                       "fewer_files": F.lit(len(after) == done["after"] < len(before))}))[0]


def maintained_layers(star: OrderLineStar) -> DataFrame:
    """Maintenance over a layer in which one table is broken: the status of each table and the rows that stay, after old
    snapshots are removed."""
    spark = star.spark
    with catalog.scoped_namespaces(spark, ["silver"]) as spaces:
        silver = spaces["silver"]
        for _ in range(2):  # the first snapshots are old ones after this
            catalog.publish(star.sales("datekey", "productid", "customerid", "salesid"), silver, "fact_sales", max_records=20_000)
            catalog.publish(star.table("dim_store"), silver, "dim_store", files=2)
        catalog.publish(spark.range(3), silver, "broken")
        location, fs = catalog._place(spark, catalog.committed(spark, silver, "broken")["path"])
        fs.delete(location, True)
        rows = []
        for full, status, *_ in layout.optimize_layers(spark, [silver], many=1):
            name = full.rsplit(".", 1)[1]
            removed = len(layout.vacuum(spark, full, retention_hours=0, enabled=True))
            rows.append((name, status.split(":")[0], removed, None if status.startswith("failed") else spark.table(full).count()))
        return spark.createDataFrame(rows, "table_name string, status string, snapshots_removed long, rows long")


def key_assertions(star: OrderLineStar) -> DataFrame:
    """Unique keys and columns without NULL, as rows: the fact's line key holds, its order key does not."""
    lines = star.sales("salesid", "productid", "customerid", line="l_linenumber").withColumn(
        "customerid", F.when(F.col("salesid") % 13 != 0, F.col("customerid")))
    return assertions(lines, [["salesid", "line"], ["salesid"]], ["salesid", "productid", "customerid"])


LAYERS: dict[str, Callable[[OrderLineStar], DataFrame]] = {
    f.__name__: f for f in (
        layers_row_counts, layers_silver_fact, layers_rejected, layers_m001, layers_m003, layers_special_members,
        layers_digests, layers_published, layers_overwrite, table_statistics,
        compacted_sales, maintained_layers, key_assertions,
    )
}
