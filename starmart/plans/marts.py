"""The 17 published marts.

Every function takes a :class:`~starmart.sources.star.Star` and returns the mart.  Returns are
left out unless the docstring says otherwise; a fact row whose dimension member is missing is
dropped by the inner joins, as published.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import banding
from starmart.functions import measures as m
from starmart.operators.agg_join import aggregate_then_join, share
from starmart.operators.baseline import relative_change, with_baseline
from starmart.operators.baskets import pairs
from starmart.operators.customers import customer_summary, recency, rfm
from starmart.operators.ordered import rank_by, running_share
from starmart.schemas import SHIPPED_CHANNELS
from starmart.sources.star import Star


def _sums(**extra) -> dict:
    return {"total_qty": m.total_qty(), "revenue": F.sum(m.revenue()), **extra}


def _margin():
    return F.col("revenue") - m.cost("total_qty")


def product_category_margin(star: Star) -> DataFrame:
    """Revenue, cost and margin per product with its rank in the category by margin share."""
    sales = star.sales("productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    sold = aggregate_then_join(
        sales, "productid", _sums(), star.product.select("productid", "category", "name", "unitcost")
    ).filter("revenue > 0")
    pct = m.ratio(_margin(), "revenue")
    ranked = rank_by(
        sold.withColumn("_pct", pct), "_pct", ["category"], name="rank_in_cat",
        max_rows=star.rows("dim_product"),
    )
    return ranked.select(
        "category",
        "productid",
        "name",
        F.col("revenue").alias("total_revenue"),
        m.cost("total_qty").cast("decimal(28,2)").alias("total_cost"),
        _margin().cast("decimal(28,2)").alias("total_margin"),
        m.rounded("_pct", 4).alias("margin_pct"),
        "rank_in_cat",
    )


def _promo_orders(star: Star) -> DataFrame:
    """Distinct baskets per promotion: a narrow shuffle of its own."""
    sales = star.sales("promoid", "salesid", "isreturn").filter(m.is_sale())
    return sales.groupBy("promoid").agg(F.count_distinct("salesid").alias("orders"))


def promo_performance(star: Star) -> DataFrame:
    """Promotions against sales without one: basket, uplift and margin with ranks.

    The baseline is the average revenue of promotion 0 lines.  Promotion -1 (unknown) is
    reported like any other promotion.
    """
    n_promos = star.rows("dim_promotion")
    sales = star.sales("promoid", "productid", "qty", "revenue", "grossvalue", "discountamount", "isreturn").filter(m.is_sale())
    rate = m.fixed(F.coalesce(
        F.when(F.col("grossvalue") > 0, m.ratio("discountamount", "grossvalue")), F.lit(0.0)))
    # Catalyst does not aggregate below a join: sum by promotion and product first.  A left
    # join keeps lines of unknown products for the baseline and the discount rate, which are
    # defined on the fact alone.
    by_product = sales.groupBy("promoid", "productid").agg(
        *[c.alias(a) for a, c in _sums(lines=F.count(F.lit(1)), rates=F.sum(rate)).items()]
    )
    cost = star.product.select("productid", "unitcost")
    known = F.col("unitcost").isNotNull()
    promos = by_product.join(cost, "productid", "left").groupBy("promoid").agg(
        F.sum(F.when(known, F.col("total_qty"))).alias("total_qty"),
        F.sum(F.when(known, F.col("revenue"))).alias("revenue"),
        F.sum(_margin()).alias("margin"),
        F.sum("revenue").alias("all_revenue"),
        F.sum("lines").alias("lines"),
        F.sum("rates").alias("rates"),
    )
    base = with_baseline(
        promos,
        F.col("promoid") == 0,
        {
            "base_revenue": lambda on: F.sum(F.when(on, F.col("all_revenue"))),
            "base_lines": lambda on: F.sum(F.when(on, F.col("lines"))),
        },
    )
    per_line = m.ratio("base_revenue", "base_lines")
    per_order = m.ratio("revenue", "num_transactions")
    out = (
        star.promotion.filter("promoid <> 0")
        .select("promoid", "promoname", "type", "discount_pct", "promoupliftfactor")
        .join(base.filter("revenue IS NOT NULL"), "promoid")
        .join(_promo_orders(star).withColumnRenamed("orders", "num_transactions"), "promoid")
        .withColumn("_uplift", relative_change(per_order, per_line))
    )
    out = rank_by(out, "margin", name="margin_rank", max_rows=n_promos)
    out = rank_by(out, "_uplift", name="uplift_rank", max_rows=n_promos)
    return out.select(
        "promoid", "promoname", "type", "discount_pct", "promoupliftfactor", "num_transactions",
        "total_qty", "revenue", "margin",
        m.mean_of_fixed("rates", "lines", 8).alias("avg_disc_rate"),
        m.rounded(per_order, 2).alias("avg_basket"),
        m.rounded("_uplift", 4).alias("uplift_pct"),
        m.ratio("margin", "revenue", 4).alias("margin_pct"),
        "margin_rank",
        "uplift_rank",
    )


def customer_rfm_segments(star: Star) -> DataFrame:
    """Customers by RFM segment with average and total value."""
    sales = star.sales(
        "customerid", "salesid", "datekey", "productid", "qty", "revenue", "isreturn"
    ).filter(m.is_sale())
    scored = rfm(sales, star.product, star.date, star.as_of)
    pct = m.ratio("margin_total", "monetary").cast("decimal(28,10)")
    return scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        m.ratio(F.sum("monetary"), F.count("monetary")).alias("avg_ltv"),
        F.sum("monetary").alias("total_ltv"),
        m.ratio(F.sum(pct), F.count(pct), 4).alias("avg_margin_pct"),
    )


def returns_analysis(star: Star) -> DataFrame:
    """Returned lines by channel and reason."""
    returns = star.sales("channel", "returnreason", "shipcost", "revenue", "isreturn").filter(
        m.is_return()
    )
    grouped = returns.groupBy("channel", "returnreason").agg(
        F.count(F.lit(1)).alias("return_count"),
        F.sum("shipcost").alias("total_shipping_cost_returns"),
        m.ratio(F.sum(m.revenue()), F.count(m.revenue())).alias("avg_return_value"),
    )
    return share(grouped, "return_count", ["channel"], "pct_of_channel_returns", 4)


def channel_performance(star: Star) -> DataFrame:
    """Channel averages per line; returns are part of it."""
    sales = star.sales(
        "channel", "productid", "deliverydays", "shipcost", "qty", "revenue", "isreturn"
    )
    n = F.sum("lines")
    return aggregate_then_join(
        sales,
        "productid",
        _sums(
            lines=F.count(F.lit(1)),
            days=F.sum("deliverydays"),
            ship=F.sum("shipcost"),
            returned=m.returns_count(),
        ),
        star.product.select("productid", "unitcost"),
        keys=["channel"],
        then_by=["channel"],
        then={
            "transactions": n,
            "avg_delivery_days": m.ratio(F.sum("days"), n, 2),
            "avg_shipping_cost": m.ratio(F.sum("ship"), n, 2),
            "avg_qty": m.ratio(F.sum("total_qty"), n, 2),
            "avg_basket_value": m.ratio(F.sum("revenue"), n, 2),
            "avg_margin_after_shipping": m.ratio(F.sum(_margin() - F.col("ship")), n, 2),
            "return_rate": m.ratio(F.sum("returned"), n, 4),
        },
    )


def seasonal_category_revenue(star: Star) -> DataFrame:
    """Revenue by calendar month (all years together) and category, ranked in the category."""
    sales = star.sales("datekey", "productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    # Days collapse to twelve months before the product join, so its input is months x products.
    months = sales.join(star.date.select("datekey", "monthnumber", "monthname"), "datekey")
    by_month = aggregate_then_join(
        months,
        "productid",
        _sums(),
        star.product.select("productid", "category"),
        keys=["monthnumber", "monthname"],
        then_by=["monthnumber", "monthname", "category"],
        then={"revenue": F.sum("revenue"), "quantity": F.sum("total_qty")},
    )
    w = Window.partitionBy("category").orderBy(F.desc("revenue"))  # twelve rows per category
    return by_month.withColumn("rank_in_cat", F.rank().over(w))


def store_performance_by_region_type(star: Star) -> DataFrame:
    """Stores with sales, averaged without weights over region and type.

    ``unique_customers`` adds up distinct customers per store: someone who buys in two stores
    counts twice.
    """
    sales = star.sales("storeid", "productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    money = aggregate_then_join(
        sales,
        "productid",
        _sums(),
        star.product.select("productid", "unitcost"),
        keys=["storeid"],
        then_by=["storeid"],
        then={"revenue": F.sum("revenue"), "margin": F.sum(_margin())},
    )
    buyers = (
        star.sales("storeid", "customerid", "isreturn").filter(m.is_sale())
        .groupBy("storeid").agg(F.count_distinct("customerid").alias("buyers"))
    )
    return (
        star.store.join(money, "storeid").join(buyers, "storeid")
        .groupBy("region", F.col("type").alias("store_type"))
        .agg(
            m.ratio(F.sum("storerating"), F.count("storerating"), 2).alias("avg_rating"),
            m.ratio(F.sum("sizem2"), F.count("sizem2"), 2).alias("avg_size_m2"),
            m.ratio(F.sum("storesizemultiplier"), F.count("storesizemultiplier"), 4).alias("avg_size_multiplier"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("margin").alias("total_margin"),
            F.sum("buyers").alias("unique_customers"),
        )
    )


def product_totals(star: Star) -> DataFrame:
    """Revenue and margin per product sold."""
    sales = star.sales("productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    return aggregate_then_join(
        sales, "productid", _sums(), star.product.select("productid", "unitcost"), derived={"margin": _margin()}
    ).select("productid", "revenue", "margin")


def pareto_margin(star: Star) -> DataFrame:
    """Products up to 80% of the running margin.

    Equal margins share one running total, and the product that crosses 80% is outside.
    """
    run = running_share(
        product_totals(star), "margin", share="running_pct", max_rows=star.rows("dim_product")
    ).filter("running_pct <= 0.8")
    return run.agg(
        F.count(F.lit(1)).alias("product_cnt"),
        F.min("running_pct").alias("min_pct_contribution"),
        F.max("running_pct").alias("max_pct_contribution"),
    )


def delivery_speed_impact(star: Star) -> DataFrame:
    """Shipped channels by category and delivery speed; returns are part of it."""
    sales = (
        star.sales("channel", "productid", "deliverydays", "revenue", "isreturn")
        .filter(F.col("channel").isin(SHIPPED_CHANNELS))
        .withColumn("delivery_speed", banding.DELIVERY_SPEED.of("deliverydays"))
    )
    n = F.sum("lines")
    return aggregate_then_join(
        sales,
        "productid",
        {"lines": F.count(F.lit(1)), "returned": m.returns_count(), "value": F.sum(m.revenue()),
         "valued": F.count(m.revenue())},
        star.product.select("productid", "category"),
        keys=["channel", "delivery_speed"],
        then_by=["channel", "category", "delivery_speed"],
        then={
            "total_orders": n,
            "returns": F.sum("returned"),
            "return_rate": m.ratio(F.sum("returned"), n, 4),
            "avg_order_value": m.ratio(F.sum("value"), F.sum("valued")),
        },
    )


def warranty_eco_impact(star: Star) -> DataFrame:
    """Product flags against quantity, revenue and returns; returns are part of it.

    Sums per product meet the product's flags; buyers, being a distinct count, have a narrow branch of their own.
    """
    keys = ["haswarranty", "ecofriendly"]
    flags = star.product.select("productid", *keys)
    sums = aggregate_then_join(
        star.sales("productid", "qty", "revenue", "isreturn"),
        "productid",
        {"lines": F.count(F.lit(1)), "qty": F.sum("qty"), "counted": F.count("qty"), "value": F.sum(m.revenue()),
         "valued": F.count(m.revenue()), "returned": m.returns_count()},
        flags,
        then_by=keys,
        then={
            "avg_qty_per_transaction": m.ratio(F.sum("qty"), F.sum("counted")),
            "avg_revenue": m.ratio(F.sum("value"), F.sum("valued")),
            "return_rate": m.ratio(F.sum("returned"), F.sum("lines"), 4),
        },
    )
    pairs_sold = star.sales("productid", "customerid").distinct()
    buyers = pairs_sold.join(flags, "productid").groupBy(*keys).agg(F.count_distinct("customerid").alias("unique_buyers"))
    same = reduce(and_, [sums[k].eqNullSafe(buyers[k]) for k in keys])
    return sums.join(buyers, same).select(sums["*"], "unique_buyers")


def hourly_sales_margin(star: Star) -> DataFrame:
    """Hours of the day by channel; returns are part of it."""
    sales = star.sales(
        "hour", "channel", "productid", "qty", "revenue", "isreturn", "deliverydays"
    ).filter("hour IS NOT NULL")
    hours = aggregate_then_join(
        sales,
        "productid",
        _sums(lines=F.count(F.lit(1)), returned=m.returns_count(), days=F.sum("deliverydays")),
        star.product.select("productid", "unitcost"),
        keys=["hour", "channel"],
        then_by=["hour", "channel"],
        then={
            "transactions": F.sum("lines"),
            "items_sold": F.sum("total_qty"),
            "revenue": F.sum("revenue"),
            "gross_margin": F.sum(_margin()),
            "returned": F.sum("returned"),
            "days": F.sum("days"),
        },
    )
    w = Window.partitionBy("channel").orderBy(F.desc("revenue"))  # 24 rows per channel
    return hours.select(
        "hour", "channel", "transactions", "items_sold", "revenue", "gross_margin",
        m.ratio("gross_margin", "revenue", 4).alias("margin_pct"),
        m.ratio("returned", "transactions", 4).alias("return_rate"),
        m.ratio("days", "transactions", 2).alias("avg_delivery_days"),
        F.rank().over(w).alias("revenue_rank_in_channel"),
    )


def pareto_revenue_margin(star: Star) -> DataFrame:
    """Revenue and margin Pareto in one row.

    The first column counts products inside either 80% range, as published; use
    :func:`starmart.operators.ordered.pareto_cutoff` for one measure at a time.
    """
    bound = dict(max_rows=star.rows("dim_product"))
    run = running_share(product_totals(star), "revenue", "_r", "rev_share", **bound)
    run = running_share(run, "margin", "_m", "mar_share", **bound)
    return run.filter("rev_share <= 0.8 OR mar_share <= 0.8").agg(
        F.count(F.lit(1)).alias("products_needed_for_80pct_revenue"),
        F.min(F.when(F.col("rev_share") >= 0.8, F.col("revenue"))).alias("min_rev_in_top80"),
        F.count_if(F.col("mar_share") <= 0.8).alias("products_needed_for_80pct_margin"),
        F.min(F.when(F.col("mar_share") >= 0.8, F.col("margin"))).alias("min_margin_in_top80"),
    )


def basket_analysis(star: Star, top: int = 100, **opts) -> DataFrame:
    """Top product pairs.  The two ``lift`` columns carry their published names; they are
    confidences.  ``pairs`` has the actual lift."""
    sales = star.sales("salesid", "productid", "isreturn").filter(m.is_sale())
    found = pairs(sales, "salesid", "productid", top=top, **opts)
    return found.select(
        F.col("item_a").alias("product_a"),
        F.col("item_b").alias("product_b"),
        "co_occurrence",
        "baskets_a",
        "baskets_b",
        m.rounded("confidence_ab", 4).alias("lift_a_to_b"),
        m.rounded("confidence_ba", 4).alias("lift_b_to_a"),
    )


def delivery_speed_impact_detailed(star: Star) -> DataFrame:
    """Delivery speed and channel with margin; ``margin_pct`` divides the rounded averages."""
    sales = (
        star.sales("channel", "productid", "deliverydays", "qty", "shipcost", "revenue", "isreturn")
        .filter(F.col("channel").isin(SHIPPED_CHANNELS) & (F.col("deliverydays") > 0))
        .withColumn("delivery_speed", banding.DELIVERY_SPEED_SHORT.of("deliverydays"))
    )
    n, whole = F.sum("lines"), m.revenue().isNotNull() & F.col("qty").isNotNull()
    stats = aggregate_then_join(
        sales,
        "productid",
        _sums(lines=F.count(F.lit(1)), returned=m.returns_count(), ship=F.sum("shipcost"), shipped=F.count("shipcost"),
              valued=F.count(m.revenue()), both=F.count_if(whole), value=F.sum(F.when(whole, m.revenue())),
              units=F.sum(F.when(whole, F.col("qty")))),
        star.product.select("productid", "unitcost"),
        keys=["delivery_speed", "channel"],
        then_by=["delivery_speed", "channel"],
        then={
            "orders": n,
            "returns": F.sum("returned"),
            "avg_order_value": m.ratio(F.sum("revenue"), F.sum("valued"), 2),
            "avg_margin": m.ratio(
                F.sum(F.col("value") - m.cost("units")), F.sum(F.when(F.col("unitcost").isNotNull(), F.col("both"))), 2
            ),
            "avg_shipcost": m.ratio(F.sum("ship"), F.sum("shipped"), 2),
        },
    )
    return stats.select(
        "delivery_speed", "channel", "orders", "returns",
        m.ratio("returns", "orders", 4).alias("return_rate"),
        "avg_order_value", "avg_margin",
        m.ratio("avg_margin", "avg_order_value", 4).alias("margin_pct"),
        "avg_shipcost",
    )


def margin_by_price_tier(star: Star) -> DataFrame:
    """Stored product margin against the margin achieved, by price tier and category."""
    sales = star.sales("productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    achieved = m.ratio(F.sum("margin"), F.sum("revenue"))
    stored = m.ratio(F.sum("margin_pct"), F.count("margin_pct"))
    return aggregate_then_join(
        sales,
        "productid",
        _sums(),
        star.product.select("productid", "category", "unitprice", "unitcost", "margin_pct"),
        derived={"price_tier": banding.PRICE_TIER.of("unitprice"), "margin": _margin()},
        then_by=["price_tier", "category"],
        then={
            "products": F.count(F.lit(1)),  # one row per product here
            "total_qty": F.sum("total_qty"),
            "revenue": F.sum("revenue"),
            "total_margin": F.sum("margin"),
            "achieved_margin_pct": m.rounded(achieved, 4),
            "avg_product_margin_pct": m.rounded(stored, 4),
            "margin_deviation": m.rounded(stored - achieved, 4),
        },
    )


def recency_impact_on_spend(star: Star) -> DataFrame:
    """Spend of customers by how long ago they last bought.  Spend covers all their sales."""
    sales = star.sales(
        "customerid", "salesid", "datekey", "productid", "qty", "revenue", "isreturn"
    ).filter(m.is_sale())
    customers = recency(customer_summary(sales, star.product), star.date, star.as_of, banding.RECENCY)
    orders, value, margin = F.sum("known_orders"), F.sum("monetary"), F.sum("margin_total")
    n = F.count(F.lit(1))
    return customers.groupBy("recency_segment").agg(
        n.alias("customers"),
        m.ratio(value, orders, 2).alias("avg_order_value"),
        m.ratio(margin, orders, 2).alias("avg_order_margin"),
        m.ratio(margin, value, 4).alias("avg_margin_pct"),
        m.ratio(orders, n, 2).alias("avg_orders_per_customer"),
    )


def promo_margin_efficiency(star: Star) -> DataFrame:
    """Promotions by margin per order against lines sold without a promotion."""
    n_promos = star.rows("dim_promotion")
    sales = star.sales("promoid", "productid", "qty", "revenue", "isreturn").filter(m.is_sale())
    promos = aggregate_then_join(
        sales,
        "productid",
        _sums(lines=F.count(F.lit(1))),
        star.product.select("productid", "unitcost"),
        keys=["promoid"],
        then_by=["promoid"],
        then={"revenue": F.sum("revenue"), "margin": F.sum(_margin()), "lines": F.sum("lines")},
    )
    base = with_baseline(
        promos,
        F.col("promoid") == 0,
        {f"base_{c}": (lambda on, c=c: F.sum(F.when(on, F.col(c)))) for c in ("revenue", "margin", "lines")},
    )
    base_basket, base_margin = m.ratio("base_revenue", "base_lines"), m.ratio("base_margin", "base_lines")
    basket, margin = m.ratio("revenue", "txn"), m.ratio("margin", "txn")
    out = (
        base.filter("promoid <> 0")
        .join(star.promotion.select("promoid", "promoname", "type", "discount_pct"), "promoid")
        .join(_promo_orders(star).withColumnRenamed("orders", "txn"), "promoid")
        .withColumn("_gain", margin - base_margin)
    )
    out = rank_by(out, "_gain", name="margin_effectiveness_rank", max_rows=n_promos)
    return out.select(
        "promoid", "promoname", "type", "discount_pct", "txn",
        m.rounded(basket, 2).alias("avg_basket"),
        m.rounded(margin, 2).alias("avg_margin"),
        m.rounded(basket - base_basket, 2).alias("basket_increase"),
        m.rounded("_gain", 2).alias("margin_increase"),
        m.rounded(relative_change(margin, base_margin), 4).alias("margin_uplift_pct"),
        m.rounded(margin, 2).alias("actual_margin_per_txn"),
        "margin_effectiveness_rank",
    )


MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_001_product_category_margin": product_category_margin,
    "vw_002_promo_performance": promo_performance,
    "vw_003_customer_rfm_segments": customer_rfm_segments,
    "vw_004_returns_analysis": returns_analysis,
    "vw_005_channel_performance": channel_performance,
    "vw_006_seasonal_category_revenue": seasonal_category_revenue,
    "vw_007_store_performance_by_region_type": store_performance_by_region_type,
    "vw_008_pareto_margin_analysis": pareto_margin,
    "vw_009_delivery_speed_impact": delivery_speed_impact,
    "vw_010_warranty_eco_impact": warranty_eco_impact,
    "vw_011_hourly_sales_margin_analysis": hourly_sales_margin,
    "vw_012_pareto_revenue_margin": pareto_revenue_margin,
    "vw_013_basket_analysis": basket_analysis,
    "vw_014_delivery_speed_impact_detailed": delivery_speed_impact_detailed,
    "vw_015_margin_by_price_tier": margin_by_price_tier,
    "vw_016_recency_impact_on_spend": recency_impact_on_spend,
    "vw_017_promo_margin_efficiency": promo_margin_efficiency,
}
