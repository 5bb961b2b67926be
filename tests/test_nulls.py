"""Published averages, bands and verdicts where cells are NULL; answers by hand."""

from fixtures import tiny_star
from starmart.functions import banding
from starmart.functions import measures as m
from starmart.plans import marts
from starmart.quality import engine

PRODUCTS = [dict(productid=1, unitcost=8, unitprice=10, haswarranty=1, ecofriendly=0), dict(productid=2, unitcost=None, unitprice=None)]


def line(i, **kw):
    return dict(salesid=i, grossvalue=100, discountamount=10, **kw)


def test_a_null_cell_is_no_part_of_an_average(spark):
    lines = [line(1, isreturn=1, returnreason="Other"), dict(salesid=2, grossvalue=None, isreturn=1, returnreason="Other")]
    got = marts.returns_analysis(tiny_star(spark, lines, PRODUCTS)).first()
    assert (got["return_count"], got["avg_return_value"]) == (2, 90.0)


def test_flags_mart_counts_what_is_there(spark):
    lines = [line(1, qty=4), line(2, qty=None), dict(salesid=3, grossvalue=None, qty=2)]
    got = marts.warranty_eco_impact(tiny_star(spark, lines, PRODUCTS)).filter("haswarranty = 1").first()
    assert (got["avg_qty_per_transaction"], got["avg_revenue"], got["unique_buyers"]) == (3.0, 90.0, 1)


def test_missing_delivery_days_are_the_last_band(spark):
    lines = [line(1, deliverydays=None), line(2, deliverydays=9), dict(salesid=3, grossvalue=None, deliverydays=9)]
    got = marts.delivery_speed_impact(tiny_star(spark, lines, PRODUCTS)).collect()
    assert [(r["delivery_speed"], r["total_orders"], r["avg_order_value"]) for r in got] == [("Long (>5 days)", 3, 90.0)]


def test_missing_price_is_the_last_tier(spark):
    got = marts.margin_by_price_tier(tiny_star(spark, [line(1, productid=2)], PRODUCTS)).first()
    assert got["price_tier"] == "Luxury (500+)" and got["avg_product_margin_pct"] is not None


def test_detailed_delivery_averages(spark):
    lines = [line(1, qty=2, shipcost=3), line(2, qty=None, shipcost=None), line(3, productid=2, qty=1, shipcost=5)]
    got = marts.delivery_speed_impact_detailed(tiny_star(spark, lines, PRODUCTS)).first()
    assert (got["orders"], got["avg_order_value"], got["avg_margin"], got["avg_shipcost"]) == (3, 90.0, 74.0, 4.0)


def test_store_size_mean_skips_missing_sizes(spark):
    stores = [dict(storeid=1, sizem2=100), dict(storeid=2, sizem2=None)]
    got = marts.store_performance_by_region_type(
        tiny_star(spark, [line(1), line(2, storeid=2)], PRODUCTS, stores)).first()
    assert got["avg_size_m2"] == 100.0


def test_bands_without_else_keep_null(spark):
    row = spark.sql("SELECT CAST(NULL AS INT) AS x").select(banding.INCOME_TIER.of("x"), banding.RECENCY.of("x"))
    assert row.first() == (None, None)


def test_shipping_of_shipped_channels_but_not_of_returns(spark):
    rows = [("Online", 0, 6), ("Mobile App", 0, 6), ("Mobile App", 1, 0), ("In-Store", 0, 0), ("Phone Order", 0, 0)]
    df = spark.createDataFrame([(c, r) for c, r, _ in rows], "channel string, isreturn int").selectExpr(
        "*", "4 AS qty", "10.00 AS unitprice", "0.0 AS discount_pct", "0.0 AS tax_rate", "3.00 AS weight")
    got = df.withColumns(m.line_amounts()).collect()
    assert [float(r["shipcost"]) for r in got] == [c for _, _, c in rows]


def test_verdict_has_three_states(spark):
    def verdict(*states):
        df = spark.createDataFrame([(s,) for s in states], "status string")
        return engine.verdict(df).first()["verdict"]

    assert verdict("PASS", "FAIL", "WARN") == "FAILED"
    assert verdict("PASS", "WARN") == "WARNINGS"
    assert verdict("PASS") == "PASSED"
