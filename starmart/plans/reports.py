"""Report queries and KPIs (revenue here is ``net``, tax included, of lines that are not
returns, unless a docstring says otherwise)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import measures as m
from starmart.functions.formatting import format_report
from starmart.operators.agg_join import aggregate_then_join
from starmart.operators.customers import new_vs_returning as first_purchase_split
from starmart.operators.keys import null_profile, orphans
from starmart.operators.ordered import distribution, numbered
from starmart.operators.series import centred_avg, drift, moving_avg
from starmart.schemas import CHANNELS, FACT_SALES
from starmart.sources.star import Star


def _net_by(star: Star, key: str, *more: str) -> DataFrame:
    return star.sales(key, "net", "isreturn", *more).filter(m.is_sale())


def _product_money(star: Star) -> DataFrame:
    """One row: revenue and cost of goods of sold products."""
    return aggregate_then_join(
        _net_by(star, "productid", "qty"),
        "productid",
        {"net": F.sum("net"), "qty": m.total_qty()},
        star.product.select("productid", "unitcost"),
        then_by=[],
        then={"revenue": F.sum("net"), "cogs": F.sum(m.cost())},
    )


def total_revenue(star: Star) -> DataFrame:
    return star.sales("net", "isreturn").filter(m.is_sale()).agg(F.sum("net").alias("total_revenue"))


def total_cogs(star: Star) -> DataFrame:
    return aggregate_then_join(
        star.sales("productid", "qty", "isreturn").filter(m.is_sale()),
        "productid",
        {"qty": m.total_qty()},
        star.product.select("productid", "unitcost"),
        then_by=[],
        then={"total_cogs": F.sum(m.cost())},
    )


def gross_profit(star: Star) -> DataFrame:
    return _product_money(star).select((F.col("revenue") - F.col("cogs")).alias("gross_profit"))


def gross_margin_pct(star: Star) -> DataFrame:
    """Gross margin in percent points."""
    return _product_money(star).select(
        (m.ratio(F.col("revenue") - F.col("cogs"), "revenue") * 100).alias("gross_margin_pct")
    )


def average_basket(star: Star) -> DataFrame:
    """Revenue over distinct baskets.  Summing to baskets first counts them without a
    distinct aggregate on the side."""
    baskets = _net_by(star, "salesid").groupBy("salesid").agg(F.sum("net").alias("net"))
    return baskets.agg(m.ratio(F.sum("net"), F.count("salesid")).alias("avg_basket_value"))


def return_rate(star: Star) -> DataFrame:
    return star.sales("isreturn").agg(m.ratio(F.sum("isreturn"), F.count("isreturn")).alias("return_rate"))


def discount_penetration(star: Star) -> DataFrame:
    sales = star.sales("discountapplied", "isreturn").filter(m.is_sale())
    return sales.agg(m.ratio(F.sum("discountapplied"), F.count("discountapplied")).alias("discount_penetration"))


def _revenue_by(star: Star, key: str, dim: DataFrame, label: str) -> DataFrame:
    return aggregate_then_join(
        _net_by(star, key),
        key,
        {"net": F.sum("net")},
        dim.select(key, label),
        then_by=[label],
        then={"revenue": F.sum("net")},
    )


def revenue_by_category(star: Star) -> DataFrame:
    return _revenue_by(star, "productid", star.product, "category").orderBy(F.desc("revenue"), "category")


def revenue_by_region(star: Star) -> DataFrame:
    return _revenue_by(star, "storeid", star.store, "region").orderBy(F.desc("revenue"), "region")


def top_products(star: Star, n: int = 10) -> DataFrame:
    """Best products by id; products missing from the dimension do not take a place."""
    best = (
        _net_by(star, "productid").groupBy("productid").agg(F.sum("net").alias("revenue"))
        .join(star.product.select("productid", "name"), "productid")
    )
    return best.select("productid", "name", "revenue").orderBy(F.desc("revenue"), "productid").limit(n)


def top_product_names(star: Star, n: int = 10) -> DataFrame:
    """Best products by name; products that share a name are added up."""
    named = _revenue_by(star, "productid", star.product, "name")
    return named.orderBy(F.desc("revenue"), "name").limit(n)


def monthly_revenue(star: Star) -> DataFrame:
    return _revenue_by(star, "datekey", star.date, "yearmonth").orderBy("yearmonth")


def average_discount(star: Star) -> DataFrame:
    """Mean of discount over gross of discounted lines."""
    sales = star.sales("discountamount", "grossvalue", "discountapplied", "isreturn").filter(
        m.is_sale() & (F.col("discountapplied") == 1) & (F.col("grossvalue") > 0)
    )
    rate = m.fixed(m.ratio("discountamount", "grossvalue"))
    return sales.agg(m.mean_of_fixed(F.sum(rate), F.count(rate), 8).alias("avg_discount_pct"))


def delivery_days_by_channel(star: Star) -> DataFrame:
    sales = star.sales("channel", "deliverydays", "isreturn").filter(m.is_sale())
    return sales.groupBy("channel").agg(
        m.ratio(F.sum("deliverydays"), F.count("deliverydays")).alias("avg_delivery_days")
    )


def return_rate_by_category(star: Star) -> DataFrame:
    """Returned lines over all lines."""
    return aggregate_then_join(
        star.sales("productid", "isreturn"),
        "productid",
        {"returned": m.returns_count(), "lines": F.count(F.lit(1))},
        star.product.select("productid", "category"),
        then_by=["category"],
        then={"return_rate": m.ratio(F.sum("returned"), F.sum("lines"))},
    ).orderBy(F.desc("return_rate"), "category")


def new_vs_returning(star: Star, include_returns: bool = False) -> DataFrame:
    sales = star.sales("customerid", "datekey", "net", "isreturn")
    if not include_returns:
        sales = sales.filter(m.is_sale())
    return first_purchase_split(sales, include_returns=include_returns)


def weekend_revenue(star: Star) -> DataFrame:
    return _revenue_by(star, "datekey", star.date, "isweekend").orderBy("isweekend")


def top_stores(star: Star, n: int = 10) -> DataFrame:
    best = (
        _net_by(star, "storeid").groupBy("storeid").agg(F.sum("net").alias("revenue"))
        .join(star.store.select("storeid", "storename"), "storeid")
    )
    return best.select("storeid", "storename", "revenue").orderBy(F.desc("revenue"), "storeid").limit(n)


def product_margin_distribution(star: Star) -> DataFrame:
    """Stored product margin: count, mean, deviation, quartiles, extremes."""
    return distribution(
        star.product.filter("productid > 0"), "margin_pct", "products", max_rows=star.rows("dim_product"))


def promotion_discount_distribution(star: Star) -> DataFrame:
    """The same of promotion discounts, special members left out."""
    return distribution(
        star.promotion.filter("promoid > 0"), "discount_pct", "promotions", max_rows=star.rows("dim_promotion"))


def critical_nulls(star: Star) -> DataFrame:
    cols = ["hour", "returnreason", "promoid"]
    return null_profile(star.sales(*cols), cols)


def instore_delivery(star: Star) -> DataFrame:
    sales = star.sales("channel", "deliverydays").filter("channel = 'In-Store' AND deliverydays > 0")
    return sales.agg(F.count(F.lit(1)).alias("instore_nonzero_delivery"))


def orphan_foreign_keys(star: Star) -> DataFrame:
    refs = {fk: (star.table(t), pk) for fk, (t, pk) in FACT_SALES.fks.items()}
    return orphans(star.sales(*refs), refs)


def revenue_by_channel(star: Star) -> DataFrame:
    return (
        _net_by(star, "channel").groupBy("channel").agg(F.sum("net").alias("revenue"))
        .orderBy(F.desc("revenue"), "channel")
    )


def daily_revenue(star: Star) -> DataFrame:
    """Revenue per day: at most one row per calendar day."""
    return _revenue_by(star, "datekey", star.date, "fulldate").withColumnRenamed("revenue", "daily_total")


def moving_average_7d(star: Star, min_periods: int = 1) -> DataFrame:
    """Daily revenue with its mean over the day and up to six days with sales before it."""
    return moving_avg(
        daily_revenue(star), "fulldate", "daily_total", before=6, min_periods=min_periods, name="ma_7days",
        max_rows=star.rows("dim_date"),
    )


def smoothed_daily_revenue(star: Star) -> DataFrame:
    return centred_avg(
        daily_revenue(star), "fulldate", "daily_total", name="smooth_7days", max_rows=star.rows("dim_date")
    )


def daily_revenue_drift(star: Star) -> DataFrame:
    return drift(daily_revenue(star), "fulldate", "daily_total", max_rows=star.rows("dim_date"))


def promotion_effect(star: Star) -> DataFrame:
    """Average daily revenue of days with and without promoted lines."""
    days = aggregate_then_join(
        _net_by(star, "datekey", "promoid"),
        "datekey",
        {"has_promo": F.max((F.col("promoid") > 0).cast("int")), "net": F.sum("net")},
        star.date.select("datekey", "fulldate"),
        then_by=["fulldate"],
        then={"has_promo": F.max("has_promo"), "net": F.sum("net")},
    )
    return days.groupBy("has_promo").agg(m.ratio(F.sum("net"), F.count(F.lit(1))).alias("avg_revenue"))


def promotion_uplift(star: Star) -> DataFrame:
    """Promoted revenue over unpromoted revenue, less one; 0 when nothing was unpromoted."""
    promoted = F.sum(F.when(F.col("promoid") > 0, F.col("net")))
    plain = F.sum(F.when(F.col("promoid") == 0, F.col("net")))
    return _net_by(star, "promoid").agg(
        F.coalesce(m.ratio(promoted - plain, plain), F.lit(0.0)).alias("promo_uplift")
    )


def payment_channel_matrix(star: Star) -> DataFrame:
    """Revenue by payment method and channel.  The channels are given, so the pivot needs no
    pass of its own to find them."""
    return _net_by(star, "payment", "channel").groupBy("payment").pivot("channel", CHANNELS).agg(F.sum("net"))


def kpi_summary(star: Star) -> DataFrame:
    """All headline KPIs in one row from two passes: lines by product and distinct baskets."""
    sale = m.is_sale()
    by_product = star.sales("productid", "net", "qty", "isreturn", "discountapplied").groupBy("productid").agg(
        F.sum(F.when(sale, F.col("net"))).alias("net"),
        F.sum(F.when(sale, F.col("qty"))).alias("qty"),
        F.count_if(sale).alias("sales"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(sale, F.col("discountapplied"))).alias("discounted"),
    )
    baskets = star.sales("salesid", "isreturn").filter(sale).agg(F.count_distinct("salesid").alias("n"))
    totals = by_product.join(star.product.select("productid", "unitcost"), "productid", "left").agg(
        F.sum("net").alias("total_revenue"),
        F.sum(m.cost()).alias("total_cogs"),
        (F.sum("lines") - F.sum("sales")).alias("returned"),
        F.sum("lines").alias("lines"),
        F.sum("sales").alias("sales"),
        F.sum("discounted").alias("discounted"),
    )
    profit = F.col("total_revenue") - F.col("total_cogs")
    return totals.withColumn("baskets", baskets.scalar()).select(
        "total_revenue",
        "total_cogs",
        profit.alias("gross_profit"),
        (m.ratio(profit, "total_revenue") * 100).alias("gross_margin_pct"),
        m.ratio("total_revenue", "baskets").alias("avg_basket_value"),
        m.ratio("returned", "lines").alias("return_rate"),
        m.ratio("discounted", "sales").alias("discount_penetration"),
    )


def formatted_category_report(star: Star) -> DataFrame:
    """Revenue and return rate by category as report text, with the position on the printed table."""
    report = aggregate_then_join(
        star.sales("productid", "net", "isreturn"),
        "productid",
        {"net": F.sum(F.when(m.is_sale(), F.col("net"))), "returned": m.returns_count(), "lines": F.count(F.lit(1))},
        star.product.select("productid", "category"),
        then_by=["category"],
        then={"revenue": F.sum("net"), "return_rate": m.ratio(F.sum("returned"), F.sum("lines"))},
    )
    placed = numbered(report, [F.desc("revenue"), "category"])
    return format_report(placed, money_cols=["revenue"], pct_cols=["return_rate"])


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "r01_total_revenue": total_revenue,
    "r02_total_cogs": total_cogs,
    "r03_gross_profit": gross_profit,
    "r04_gross_margin_pct": gross_margin_pct,
    "r05_average_basket": average_basket,
    "r06_return_rate": return_rate,
    "r07_discount_penetration": discount_penetration,
    "r08_revenue_by_category": revenue_by_category,
    "r09_revenue_by_region": revenue_by_region,
    "r10_top_products": top_products,
    "r10_top_product_names": top_product_names,
    "r11_monthly_revenue": monthly_revenue,
    "r12_average_discount": average_discount,
    "r13_delivery_days_by_channel": delivery_days_by_channel,
    "r14_return_rate_by_category": return_rate_by_category,
    "r15_new_vs_returning": new_vs_returning,
    "r15_new_vs_returning_all_rows": lambda star: new_vs_returning(star, include_returns=True),
    "r16_weekend_revenue": weekend_revenue,
    "r17_top_stores": top_stores,
    "r18_product_margin_distribution": product_margin_distribution,
    "r19_promotion_discounts": promotion_discount_distribution,
    "r20_critical_nulls": critical_nulls,
    "r21_instore_delivery": instore_delivery,
    "r22_orphan_foreign_keys": orphan_foreign_keys,
    "r23_revenue_by_channel": revenue_by_channel,
    "r24_moving_average_7d": moving_average_7d,
    "r24_moving_average_full_weeks": lambda star: moving_average_7d(star, min_periods=7),
    "r25_promotion_effect": promotion_effect,
    "r26_promotion_uplift": promotion_uplift,
    "r27_payment_channel_matrix": payment_channel_matrix,
    "r28_kpi_summary": kpi_summary,
    "r29_formatted_category_report": formatted_category_report,
}
