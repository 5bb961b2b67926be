"""Product margin report: list price against list cost, in percent points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import measures as m
from starmart.functions.banding import margin_bucket, margin_bucket_ordinal
from starmart.functions.formatting import bar
from starmart.operators.agg_join import share
from starmart.operators.ordered import quantiles, sample_stddev
from starmart.sources.star import Star

# Allowed margin in percent points and the tolerance of the stored fraction.
HIGH, LOW, TOLERANCE = 30.0, -10.0, 0.0001


def priced_products(star: Star) -> DataFrame:
    """Real products with a price, with ``actual`` margin in percent points.  Exact to ten
    digits of the fraction, so sums do not depend on row order."""
    fraction = m.ratio(F.col("unitprice") - F.col("unitcost"), "unitprice")
    return (
        star.product.filter("productid > 0 AND unitprice > 0")
        .withColumn("fraction", fraction.cast("decimal(14,10)"))
        .withColumn("actual", (F.col("fraction") * 100).cast("decimal(18,8)"))
    )


def _off(products_fraction="fraction"):
    return F.abs(F.col("margin_pct") - F.col(products_fraction))


def margin_stats(star: Star) -> DataFrame:
    """Count, extremes, mean, deviation, median and rule violations."""
    p = priced_products(star)
    n, s = F.count("actual").cast("double"), F.sum("actual").cast("double")
    stats = p.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.min("actual").alias("min_margin_pct"),
        F.max("actual").alias("max_margin_pct"),
        m.rounded(s / n, 6).alias("avg_margin_pct"),
        m.rounded(sample_stddev("actual"), 4).alias("stdev_margin_pct"),
        F.count_if(F.col("actual") > HIGH).alias("products_above_30pct"),
        F.count_if(F.col("actual") < LOW).alias("products_below_minus10pct"),
        F.count_if((F.col("actual") > HIGH) | (F.col("actual") < LOW)).alias("products_invalid_margin"),
        F.count_if(_off() > F.lit(TOLERANCE).cast("decimal(5,4)")).alias("mismatched_stored_margin"),
    )
    median = quantiles(p, "actual", {"q": 0.5}, max_rows=star.rows("dim_product"))
    return stats.withColumn("median_margin_pct", median.select(m.rounded("q", 6).alias("q")).scalar())


def _violations(star: Star, high: bool, n: int) -> DataFrame:
    p = priced_products(star)
    bad = p.filter(F.col("actual") > HIGH) if high else p.filter(F.col("actual") < LOW)
    order = F.desc("actual") if high else F.asc("actual")
    return (
        bad.orderBy(order, "productid").limit(n)
        .select(
            "productid", "name", "category", "unitprice", "unitcost",
            m.rounded("actual", 6).alias("actual_margin_pct"),
            (F.col("margin_pct") * 100).alias("stored_margin_pct"),
            F.lit("VIOLATION" if high else "WARNING").alias("remark"),
        )
    )


def above_limit(star: Star, n: int = 20) -> DataFrame:
    return _violations(star, True, n)


def below_limit(star: Star, n: int = 20) -> DataFrame:
    return _violations(star, False, n)


def histogram(star: Star) -> DataFrame:
    """Products in five-point bands with share and text bar, in band order."""
    bands = (
        priced_products(star)
        .groupBy(margin_bucket("actual").alias("margin_bucket"), margin_bucket_ordinal("actual").alias("bucket_no"))
        .agg(F.count(F.lit(1)).alias("product_count"))
    )
    shared = share(bands, "product_count", (), "_share")
    percent = F.round((F.col("_share") * 100).cast("decimal(18,8)"), 2)
    return shared.select(
        "bucket_no", "margin_bucket", "product_count",
        percent.cast("decimal(5,2)").alias("percentage"),
        bar(percent).alias("bar_chart"),
    ).orderBy("bucket_no")


def by_category(star: Star) -> DataFrame:
    return (
        priced_products(star).groupBy("category").agg(
            F.count(F.lit(1)).alias("products"),
            F.min("actual").alias("min_margin_pct"),
            F.max("actual").alias("max_margin_pct"),
            m.ratio(F.sum("actual"), F.count("actual"), 6).alias("avg_margin_pct"),
            F.count_if(F.col("actual") > HIGH).alias("violations_above_30pct"),
        ).orderBy(F.desc("avg_margin_pct"), "category")
    )


def consistency(star: Star) -> DataFrame:
    """Stored against computed margin; exactly the tolerance counts as inconsistent here."""
    tol = F.lit(TOLERANCE).cast("decimal(5,4)")
    bad = F.count_if(_off() >= tol)
    return priced_products(star).agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_if(_off() < tol).alias("consistent"),
        bad.alias("inconsistent"),
        m.rounded(m.ratio(bad, F.count(F.lit(1))) * 100, 2).alias("inconsistency_pct"),
    )


def sample_in_range(star: Star, n: int = 10) -> DataFrame:
    return (
        priced_products(star).filter(F.col("actual").between(LOW, HIGH)).orderBy("productid").limit(n)
        .select(
            "productid", "name", "category", "unitprice", "unitcost",
            (F.col("margin_pct") * 100).alias("stored_margin_pct"),
            m.rounded("actual", 6).alias("actual_margin_pct"),
        )
    )


MARGIN_REPORT: dict[str, Callable[[Star], DataFrame]] = {
    "g1_margin_stats": margin_stats,
    "g2_above_limit": above_limit,
    "g3_below_limit": below_limit,
    "g4_margin_histogram": histogram,
    "g5_margin_by_category": by_category,
    "g6_margin_consistency": consistency,
    "g7_sample_in_range": sample_in_range,
}
