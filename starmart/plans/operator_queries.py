"""The reusable operators, each applied to the whole of one or more tables.

Calls that leave out ``max_rows`` run the distributed form of an operator on purpose; the
number of range partitions is left to adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import banding
from starmart.functions import measures as m
from starmart.operators.agg_join import share
from starmart.operators.allocate import allocate, scale_to_target
from starmart.operators.baseline import uplift
from starmart.operators.baskets import pairs
from starmart.operators.cleaning import (
    dedup, dedup_rows, fill_defaults, refine, restricted,
)
from starmart.operators.customers import first_and_last, rfm
from starmart.operators.keys import missing_keys, rows_with_orphans
from starmart.operators.ordered import (
    global_ntile, occurrence_index, pareto_cutoff, quantiles, rank_by, row_numbers, running_share,
)
from starmart.operators.series import centred_avg, drift, moving_avg
from starmart.plans import reports
from starmart.plans.layers import raw_rows
from starmart.plans.layout import cluster
from starmart.plans.marts import product_totals
from starmart.plans.medallion import reconcile
from starmart.schemas import DIM_CUSTOMER, FACT_SALES
from starmart.sources.delimited import read_csv, write_csv
from starmart.sources.order_lines import OrderLineStar
from starmart.sources.scratch import dropped_shuffles, scratch_path
from starmart.streaming.incremental import load_distinct, stored_batches


def dedup_lines(star: OrderLineStar) -> DataFrame:
    """Latest shipped line per (order, line number)."""
    order = [F.desc("l_shipdate"), *map(F.col, ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))]
    kept = dedup(star.raw("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                       F.col("l_shipdate").cast("date").alias("l_shipdate"))


def distinct_part_suppliers(star: OrderLineStar) -> DataFrame:
    return dedup_rows(star.raw("lineitem").select("l_partkey", "l_suppkey"))


def income_bands(star: OrderLineStar) -> DataFrame:
    """Customers by income bracket and income tier."""
    return star.customer.groupBy(
        banding.INCOME_BRACKET.of("annualincome").alias("bracket"),
        banding.INCOME_TIER.of("annualincome").alias("income_tier"),
    ).agg(F.count(F.lit(1)).alias("customers"))


def order_value_deciles(star: OrderLineStar) -> DataFrame:
    orders = star.raw("orders").select("o_orderkey", "o_totalprice")
    return global_ntile(orders, ["o_totalprice", "o_orderkey"], 10, "decile")


def order_positions(star: OrderLineStar) -> DataFrame:
    orders = star.raw("orders").select("o_orderkey", "o_totalprice")
    return row_numbers(orders, [F.desc("o_totalprice"), "o_orderkey"], "position", "orders")


def customer_rfm_scores(star: OrderLineStar) -> DataFrame:
    sales = star.sales(
        "customerid", "salesid", "datekey", "productid", "qty", "revenue", "isreturn"
    ).filter(m.is_sale())
    return rfm(sales, star.product, star.date, star.as_of, single_task_rows=0)


def _customer_revenue(star: OrderLineStar) -> DataFrame:
    sales = star.sales("customerid", "revenue", "isreturn").filter(m.is_sale())
    return sales.groupBy("customerid").agg(F.sum(m.revenue()).alias("revenue"))


def customer_running_share(star: OrderLineStar) -> DataFrame:
    return running_share(_customer_revenue(star), "revenue", ties="rows", key=["customerid"])


def quantity_running_share(star: OrderLineStar) -> DataFrame:
    """Order lines' quantities by customer: many equal values share one running total."""
    lines = star.sales("customerid", "isreturn").groupBy("customerid").agg(F.count(F.lit(1)).alias("line_count"))
    return running_share(lines, "line_count")


def pareto_customers(star: OrderLineStar) -> DataFrame:
    """Smallest set of customers that makes 80% of revenue."""
    return pareto_cutoff(_customer_revenue(star), "revenue", 0.8, key=["customerid"], include_crossing=True)


def customers_ranked_by_lines(star: OrderLineStar) -> DataFrame:
    """Rank in the tier by number of lines, with ties."""
    lines = star.sales("customerid").groupBy("customerid").agg(F.count(F.lit(1)).alias("line_count"))
    tiers = star.customer.select("customerid", "tier")
    return rank_by(lines.join(tiers, "customerid"), "line_count", ["tier"], name="rank_in_tier")


def line_value_quantiles(star: OrderLineStar) -> DataFrame:
    """Quartiles over every order line."""
    q = quantiles(star.raw("lineitem"), "l_extendedprice", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return q.select(*[m.rounded(c, 6).alias(c) for c in q.columns])


def name_occurrences(star: OrderLineStar) -> DataFrame:
    """Place of each product among products of one name."""
    return occurrence_index(star.product.select("productid", "name"), ["name"], ["productid"])


def daily_scale_factors(star: OrderLineStar) -> DataFrame:
    """Factor that brings each day's sales to the same target, applied to the lines."""
    lines = star.sales("datekey", "net", "isreturn").filter(m.is_sale())
    targets = star.date.select("datekey", F.lit(100000).cast("decimal(18,2)").alias("target"))
    scaled = scale_to_target(lines, targets, "datekey", "net", "target", max_keys=star.rows("dim_date"))
    return scaled.groupBy("datekey").agg(
        F.count(F.lit(1)).alias("lines"), F.max("factor").alias("factor"),
        m.rounded(F.sum(F.col("scaled").cast("decimal(28,10)")), 4).alias("scaled_total"))


def allocate_units(star: OrderLineStar) -> DataFrame:
    """100000 units over days in proportion to revenue."""
    days = star.sales("datekey", "net", "isreturn").filter(m.is_sale()).groupBy("datekey").agg(
        F.sum("net").cast("decimal(18,2)").alias("revenue")).join(star.date.select("datekey"), "datekey")
    return allocate(days, "revenue", 100_000, "datekey", "units", max_rows=star.rows("dim_date"))


def region_restricted_sales(star: OrderLineStar) -> DataFrame:
    """What a principal of one region sees, by store."""
    seen = restricted(star.sales("storeid", "net"), star.store, "ASIA")
    return seen.groupBy("storeid").agg(F.count(F.lit(1)).alias("lines"), F.sum("net").alias("net"))


def reconcile_layers(star: OrderLineStar) -> DataFrame:
    """Rows of the source tables against the star tables built from them."""
    names = {"fact_sales": "lineitem", "dim_product": "part", "dim_customer": "customer", "dim_store": "supplier"}
    return reconcile(
        {t: star.raw(r) for t, r in names.items()},
        {t: star.table(t) for t in names},
    )


def filled_parts(star: OrderLineStar) -> DataFrame:
    raw = star.raw("part").selectExpr(
        "p_partkey", "nullif(p_brand, 'Brand#2') AS p_brand", "nullif(p_size, 7) AS p_size",
        "CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END AS p_type",
        "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice")
    return fill_defaults(raw)


def refined_sales(star: OrderLineStar) -> DataFrame:
    """Raw doubles and typographic dashes to clean types, summed by channel."""
    sales = star.sales("channel", "net", "grossvalue", "payment")
    raw = sales.select(
        F.translate("channel", "-", "‑").alias("channel"), F.col("net").cast("double"),
        F.col("grossvalue").cast("double"),
        F.when(F.col("payment") == "Cash", "").otherwise(F.col("payment")).alias("payment"))
    return refine(raw, FACT_SALES).groupBy("channel").agg(
        F.sum("net").alias("net"), F.sum("grossvalue").alias("grossvalue"), F.count("payment").alias("with_payment"))


def first_last_purchase(star: OrderLineStar) -> DataFrame:
    sales = star.sales("customerid", "datekey", "isreturn").filter(m.is_sale())
    return first_and_last(sales, ["customerid"], "datekey")


def channel_uplift(star: OrderLineStar) -> DataFrame:
    """Revenue per line of each channel over the in-store channel."""
    groups = star.sales("channel", "net", "isreturn").filter(m.is_sale()).groupBy("channel").agg(
        F.sum("net").alias("net"), F.count(F.lit(1)).alias("lines"))
    return uplift(groups, F.col("channel") == "In-Store", "net", "lines")


def payment_share(star: OrderLineStar) -> DataFrame:
    sums = star.sales("channel", "payment", "net", "isreturn").filter(m.is_sale()).groupBy("channel", "payment").agg(
        F.sum("net").alias("net"))
    return share(sums, "net", ["channel"], "share_of_channel")


def customer_emails(star: OrderLineStar) -> DataFrame:
    """Mail address built from a name: lower case, blanks to dots, other signs stripped."""
    local = F.regexp_replace(F.translate(F.lower("fullname"), " #", ".."), "[^a-z0-9.]", "")
    return star.customer.select("customerid", F.concat_ws("@", local, F.lit("example.com")).alias("email"))


def list_line_amounts(star: OrderLineStar) -> DataFrame:
    """Money columns of every line at list price, signed on returns."""
    lines = star.sales("salesid", "productid", "qty", "promoid", "channel", "isreturn")
    product = star.product.select("productid", "unitprice", "tax_rate", "weight", "category")
    promo = star.promotion.select("promoid", "discount_pct")
    joined = lines.join(product, "productid").join(promo, "promoid").withColumns(m.line_amounts())
    signed = {c: F.sum(m.signed(c)).alias(c) for c in ("grossvalue", "discountamount", "taxamount", "net")}
    return joined.groupBy("category").agg(
        *signed.values(), F.sum("shipcost").alias("shipcost"),
        F.sum(m.nonzero_flag("discountamount")).alias("discounted"),
        F.sum(m.clip("qty", 5, 40)).alias("clipped_qty"))


def csv_round_trip(star: OrderLineStar) -> DataFrame:
    """Customers written as delimited text and scanned again with the declared schema."""
    path = scratch_path(star.spark)
    write_csv(star.customer, path, digits={"totalspend": 2, "annualincome": 2, "spendmultiplier": 3})
    raw = read_csv(star.spark, path, DIM_CUSTOMER)
    return refine(raw, DIM_CUSTOMER)


def keys_missing_from_large_products(star: OrderLineStar) -> DataFrame:
    """Product and store keys used by sales that two partial dimensions do not have."""
    refs = {"productid": (star.product.filter("unitprice >= 500"), "productid"),
            "storeid": (star.store.filter("region <> 'ASIA'"), "storeid")}
    return missing_keys(star.sales(*refs), refs)


def rows_missing_a_dimension(star: OrderLineStar) -> DataFrame:
    refs = {"productid": (star.product.filter("unitprice >= 500"), "productid"),
            "storeid": (star.store.filter("region <> 'ASIA'"), "storeid")}
    return rows_with_orphans(star.sales(*refs), refs)


def pair_rules(star: OrderLineStar) -> DataFrame:
    """Every pair bought together at least twice, with support, confidence and lift."""
    sales = star.sales("salesid", "productid", "isreturn").filter(m.is_sale())
    return pairs(sales, "salesid", "productid", top=None, min_support=2)


def order_value_moving_average(star: OrderLineStar) -> DataFrame:
    """A long series: mean of ten orders in key order."""
    orders = star.raw("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return moving_avg(orders, "o_orderkey", "v", before=9, name="ma_10", block=1000)


def order_value_smoothed(star: OrderLineStar) -> DataFrame:
    orders = star.raw("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return centred_avg(orders, "o_orderkey", "v", block=1000)


def order_value_drift(star: OrderLineStar) -> DataFrame:
    orders = star.raw("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return drift(orders, "o_orderkey", "v", block=1000)


def clustered_sales(star: OrderLineStar) -> DataFrame:
    """All sales rewritten in multi-column clustering order and read back."""
    path = scratch_path(star.spark)
    facts = star.sales("datekey", "productid", "customerid", "salesid", "net")
    cluster(facts, FACT_SALES.cluster_by).write.parquet(path)
    stored = star.spark.read.parquet(path)
    return stored.groupBy("productid").agg(F.count(F.lit(1)).alias("lines"), F.sum("net").alias("net"))


def clustering_spans(star: OrderLineStar) -> DataFrame:
    """Sales clustered into 16 files, every eleventh order without a date and every thirteenth without a customer: the
    rows, special rows and ends of each key, and whether files cover narrow ranges of its regular members."""
    path, keys = scratch_path(star.spark), FACT_SALES.cluster_by
    unknown = star.sales("datekey", "productid", "customerid", "salesid", "net").withColumns({
        "datekey": F.when(F.col("salesid") % 11 == 0, -1).otherwise(F.col("datekey")),
        "customerid": F.when(F.col("salesid") % 13 == 0, None).otherwise(F.col("customerid")),
    })
    cluster(unknown, keys, 16).write.parquet(path)
    stored = star.spark.read.parquet(path).select(
        F.input_file_name().alias("file"), F.expr("stack(3, " + ", ".join(f"'{k}', CAST({k} AS BIGINT)" for k in keys) + ") AS (key, value)"))
    regular = F.col("value") >= 1
    files = stored.groupBy("key", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(regular).alias("regular"), F.min(F.when(regular, F.col("value"))).alias("least"),
        F.max(F.when(regular, F.col("value"))).alias("most"))
    ends = files.groupBy("key").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("regular")).alias("special_rows"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.sum(F.col("most") - F.col("least")).alias("spans"), F.count("least").alias("files"))
    narrow = F.col("spans") <= 0.9 * F.col("files") * (F.col("most") - F.col("least"))
    return ends.select("key", "rows", "special_rows", "least", "most", narrow.alias("narrow"))


def stream_distinct_sales(star: OrderLineStar) -> DataFrame:
    """Sales lines that come twice, streamed from files in several batches and stored once each."""
    spark, folder, target = star.spark, scratch_path(star.spark), scratch_path(star.spark)
    with dropped_shuffles(spark):
        write_csv(raw_rows(star, "fact_sales"), folder, compression="gzip")
    load_distinct(spark, folder, FACT_SALES, target, scratch_path(spark), files_per_batch=4)
    return stored_batches(spark, target).select("salesid", "qty", "net")


OPERATORS: dict[str, Callable[[OrderLineStar], DataFrame]] = {
    f.__name__: f for f in (
        dedup_lines, distinct_part_suppliers, income_bands, order_value_deciles, order_positions,
        customer_rfm_scores, customer_running_share, quantity_running_share, pareto_customers,
        customers_ranked_by_lines, line_value_quantiles, name_occurrences, daily_scale_factors,
        allocate_units, region_restricted_sales, reconcile_layers, filled_parts, refined_sales,
        first_last_purchase, channel_uplift, payment_share, customer_emails, list_line_amounts,
        csv_round_trip, keys_missing_from_large_products, rows_missing_a_dimension, pair_rules,
        order_value_moving_average, order_value_smoothed, order_value_drift, clustered_sales,
        clustering_spans, stream_distinct_sales,
    )
} | {
    "product_totals": product_totals,
    "smoothed_daily_revenue": reports.smoothed_daily_revenue,
    "daily_revenue_drift": reports.daily_revenue_drift,
}
