"""Hand-computed answers for the semantics that are easy to get wrong."""

from datetime import date
from decimal import Decimal

import pytest
from fixtures import table, tiny_star
from pyspark.sql import functions as F

from starmart.functions import banding, formatting, measures as m
from starmart.operators import baseline, cleaning
from starmart.operators.calendar import calendar
from starmart.operators.customers import rfm
from starmart.operators.ordered import numbered
from starmart.plans import marts, reports
from starmart.schemas import DIM_PROMOTION, DIM_STORE, FACT_SALES


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def sale(i, **kw):
    return {"salesid": i, **kw}


def ret(i, **kw):
    return {"salesid": i, "isreturn": 1, "returnreason": "Other", "grossvalue": -100, "discountamount": -10,
            "taxamount": "-18.90", "net": "-108.90", **kw}


def test_unknown_promotion_is_reported_and_none_is_not(spark):
    star = tiny_star(spark, [sale(1, promoid=0), sale(2, promoid=-1), sale(3, promoid=1)])
    assert set(by(marts.promo_performance(star), "promoid")) == {-1, 1}
    assert set(by(marts.promo_margin_efficiency(star), "promoid")) == {-1, 1}


def test_uplift_over_unpromoted_lines(spark):
    star = tiny_star(spark, [
        sale(1, promoid=0, grossvalue=100, discountamount=0), sale(2, promoid=0, grossvalue=300, discountamount=0),
        sale(3, promoid=1, grossvalue=500, discountamount=100, qty=10)])
    r = marts.promo_performance(star).first()
    assert (r["avg_basket"], r["uplift_pct"], r["avg_disc_rate"]) == (400.0, 1.0, 0.2)
    assert r["margin"] == Decimal("320.00") and r["margin_pct"] == 0.8


def test_discount_rate_of_a_zero_gross_line_is_zero(spark):
    star = tiny_star(spark, [
        sale(1, promoid=1, grossvalue=0, discountamount=0), sale(2, promoid=1, grossvalue=100, discountamount=20)])
    r = marts.promo_performance(star).first()
    assert r["avg_disc_rate"] == 0.1
    assert r["uplift_pct"] is None  # nothing was sold without a promotion
    zero = tiny_star(spark, [sale(1, grossvalue=0, discountamount=0)])
    assert marts.product_category_margin(zero).count() == 0
    assert reports.average_discount(zero).first()[0] is None


def test_returns_add_cost_where_they_are_part_of_the_mart(spark):
    star = tiny_star(spark, [sale(1, qty=2), ret(2, qty=2)])
    r = marts.channel_performance(star).first()
    # revenue 90 - 90, cost 16 + 16 because quantity stays positive, shipping 1 + 1
    assert r["transactions"] == 2 and r["return_rate"] == 0.5
    assert r["avg_margin_after_shipping"] == -17.0


def test_first_purchase_with_and_without_returns(spark):
    star = tiny_star(spark, [
        ret(1, datekey=20230101), sale(2, datekey=20230105, net=10), sale(3, datekey=20230110, net=30)])
    r = reports.new_vs_returning(star).first()
    assert (r[0], r[1]) == (10.0, 30.0)
    r = reports.new_vs_returning(star, include_returns=True).first()
    assert (r[0], r[1]) == (None, 20.0)


def test_customer_with_returns_only_has_no_segment(spark):
    star = tiny_star(spark, [ret(1, customerid=5), sale(2, customerid=6)])
    assert sum(r["customers"] for r in marts.customer_rfm_segments(star).collect()) == 1


def test_rfm_scores(spark):
    sales = [sale(10 * c + i, customerid=c, datekey=20230100 + c, grossvalue=100 * c)
             for c in range(1, 11) for i in range(c)]
    star = tiny_star(spark, sales, customers=[{"customerid": c} for c in range(1, 11)])
    args = (star.sales("customerid", "salesid", "datekey", "productid", "qty", "revenue", "isreturn"),
            star.product, star.date, date(2023, 1, 31))
    for opts in ({}, dict(single_task_rows=0)):
        got = by(rfm(*args, **opts), "customerid")
        for c in range(1, 11):
            tile = (c + 1) // 2
            assert (got[c]["recency_score"], got[c]["frequency_score"], got[c]["monetary_score"]) == (tile,) * 3
            assert got[c]["recency"] == 31 - c
        assert got[10]["segment"] == "Champions" and got[1]["segment"] == "At Risk"
        assert got[5]["segment"] == "Other"


def test_lost_needs_the_lowest_recency_and_some_frequency(spark):
    from starmart.operators.customers import rfm_segment

    df = spark.createDataFrame(
        [(5, 5, 1), (4, 3, 1), (3, 1, 4), (2, 2, 5), (1, 3, 5), (1, 2, 1), (2, 3, 1), (3, 3, 3)],
        "recency_score int, frequency_score int, monetary_score int")
    assert [r[0] for r in df.select(rfm_segment()).collect()] == [
        "Champions", "Loyal", "Big Spenders", "At Risk", "Lost", "At Risk", "Other", "Other"]


def test_recency_uses_the_reference_date(spark):
    star = tiny_star(spark, [sale(1, customerid=1, datekey=20231201), sale(2, customerid=2, datekey=20230101)])
    got = by(marts.recency_impact_on_spend(star), "recency_segment")
    assert set(got) == {"Active (0-30 days)", "Churned (>180 days)"}
    star.__dict__["as_of"] = date(2023, 1, 31)
    assert "Active (0-30 days)" in by(marts.recency_impact_on_spend(star), "recency_segment")


def test_customer_of_two_stores_counts_twice_per_region(spark):
    star = tiny_star(spark, [sale(1, storeid=1), sale(2, storeid=2)], stores=[{"storeid": 1}, {"storeid": 2}])
    assert marts.store_performance_by_region_type(star).first()["unique_customers"] == 2


def test_pareto_counts_products_in_either_range(spark):
    products = [dict(productid=i, unitcost=c) for i, c in ((1, 0), (2, 0), (3, 90))]
    star = tiny_star(spark, [
        sale(1, productid=1, grossvalue=60, discountamount=0), sale(2, productid=2, grossvalue=20, discountamount=0),
        sale(3, productid=3, grossvalue=100, discountamount=0)], products=products)
    r = marts.pareto_revenue_margin(star).first()
    # revenue order 3, 1, 2 with shares 0.56, 0.89, 1; margin order 1, 2, 3 with shares 0.67, 0.89, 1
    assert r["products_needed_for_80pct_revenue"] == 2
    assert r["products_needed_for_80pct_margin"] == 1
    assert r["min_rev_in_top80"] == Decimal("60.00") and r["min_margin_in_top80"] == Decimal("10.00")
    assert marts.pareto_margin(star).first()["product_cnt"] == 1


def test_detailed_margin_divides_rounded_averages(spark):
    star = tiny_star(spark, [sale(i, grossvalue=g, discountamount=0, qty=0, deliverydays=6)
                             for i, g in ((1, "0.01"), (2, "0.00"), (3, "0.00"))])
    r = marts.delivery_speed_impact_detailed(star).first()
    assert r["delivery_speed"] == "Slow (6+)" and r["avg_order_value"] == 0.0 and r["margin_pct"] is None


def test_delivery_bands(spark):
    star = tiny_star(spark, [sale(i, deliverydays=d) for i, d in enumerate((0, 2, 3, 5, 6))])
    got = {r["delivery_speed"]: r["total_orders"] for r in marts.delivery_speed_impact(star).collect()}
    assert got == {"Fast (1-2 days)": 2, "Standard (3-5 days)": 2, "Long (>5 days)": 1}
    got = {r["delivery_speed"]: r["orders"] for r in marts.delivery_speed_impact_detailed(star).collect()}
    assert got == {"Fast (1-2)": 1, "Normal (3-5)": 2, "Slow (6+)": 1}


def test_price_tiers_are_left_closed(spark):
    prices = {1: "49.99", 2: 50, 3: "199.99", 4: 200, 5: 499, 6: 500}
    star = tiny_star(spark, [sale(i, productid=i) for i in prices],
                     products=[dict(productid=i, unitprice=p) for i, p in prices.items()])
    got = {r["price_tier"]: r["products"] for r in marts.margin_by_price_tier(star).collect()}
    assert got == {"Budget (<50)": 1, "Mid (50-200)": 2, "Premium (200-500)": 2, "Luxury (500+)": 1}


def test_margin_buckets(spark):
    df = spark.createDataFrame([(-10.1,), (-10.0,), (-5.0,), (-4.9,), (0.0,), (30.0,), (30.1,)], "m double")
    got = [tuple(r) for r in df.select(banding.margin_bucket("m"), banding.margin_bucket_ordinal("m")).collect()]
    assert got == [("< -10%", 1), ("-10% to -5%", 2), ("-10% to -5%", 2), ("-5% to 0%", 3), ("-5% to 0%", 3),
                   ("25-30%", 9), (">30% (invalid)", 10)]


def test_bucketize_edges_and_nulls(spark):
    df = spark.createDataFrame([(None,), (25000,), (25001,), (10**6,)], "x int")
    assert [r[0] for r in df.select(banding.INCOME_BRACKET.of("x")).collect()] == [None, "Low", "Medium", "Ultra High"]


def test_calendar_weeks_at_new_year(spark):
    got = by(calendar(spark, date(2023, 12, 31), date(2025, 1, 6)), "fulldate")
    assert (got[date(2023, 12, 31)]["yearweek"], got[date(2023, 12, 31)]["yearweeknumber"]) == ("2023-W52", 202352)
    assert (got[date(2024, 1, 1)]["yearweek"], got[date(2024, 1, 1)]["yearweeknumber"]) == ("2024-W01", 202401)
    assert (got[date(2024, 12, 30)]["yearweek"], got[date(2024, 12, 30)]["yearweeknumber"]) == ("2024-W53", 202401)
    assert (got[date(2025, 1, 1)]["yearweek"], got[date(2025, 1, 1)]["yearweeknumber"]) == ("2025-W00", 202501)
    assert got[date(2024, 7, 1)]["isholiday"] == 1 and got[date(2024, 6, 30)]["isholiday"] == 0
    assert got[date(2024, 6, 30)]["isweekend"] == 1 and got[date(2024, 6, 30)]["weekdayname"] == "Sunday"


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.5,)], "x double")
    assert [r[0] for r in df.select(m.rounded("x", 2)).collect()] == [1.01, -1.01, 2.5]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(m.ratio("a", "b")).collect()] == [None, None, 0.25]


def test_typographic_dashes(spark):
    raw = spark.createDataFrame([("In‑Store", "Cash"), ("In-Store", "")], "channel string, payment string")
    got = cleaning.refine(raw, FACT_SALES).collect()
    assert [r["channel"] for r in got] == ["In-Store", "In-Store"]
    assert [r["payment"] for r in got] == ["Cash", None]


def test_refine_and_quarantine(spark):
    raw = spark.createDataFrame(
        [("1", "12.345", "x"), ("abc", "1", "y"), ("3", "", "")], "storeid string, annualrentcost string, city string")
    got = cleaning.refine(raw, DIM_STORE).collect()
    assert [r["storeid"] for r in got] == [1, None, 3]
    assert [r["annualrentcost"] for r in got] == [Decimal("12.35"), Decimal("1.00"), None]
    assert [r["storeid"] for r in cleaning.quarantine(raw, DIM_STORE).collect()] == ["abc"]


def test_dedup_keeps_the_latest_ingestion(spark):
    df = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "a", 1), (None, "x", 1), (None, "y", 3)], "k int, v string, ts int"
    ).withColumn("_ingestion_ts", F.timestamp_seconds("ts")).drop("ts")
    got = cleaning.dedup(df, ["k"])
    assert {(r["k"], r["v"]) for r in got.collect()} == {(1, "new"), (2, "a"), (None, "y")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0  # limited before the shuffle


def test_dedup_does_not_depend_on_order(spark):
    rows = [(1, "a"), (1, "b"), (1, "c")]
    kept = {tuple(cleaning.dedup(spark.createDataFrame(rows[i:] + rows[:i], "k int, v string"), ["k"]).first())
            for i in range(3)}
    assert len(kept) == 1


def test_special_members_are_added_once(spark):
    df = table(spark, "dim_promotion", [{"promoid": 7}, {"promoid": 0, "promoname": "Mine"}])
    once = cleaning.with_special_members(df, DIM_PROMOTION)
    twice = cleaning.with_special_members(once, DIM_PROMOTION)
    assert sorted(r["promoid"] for r in once.collect()) == [-1, 0, 7]
    assert twice.count() == 3
    assert by(once, "promoid")[0]["promoname"] == "Mine"


def test_row_filter(spark):
    star = tiny_star(spark, [sale(1, storeid=1), sale(2, storeid=2)],
                     stores=[{"storeid": 1, "region": "North"}, {"storeid": 2, "region": "South"}])
    see = lambda region, admin=False: cleaning.restricted(star.sales(), star.store, region, admin).count()
    assert (see("North"), see("East"), see(None), see(None, True)) == (1, 0, 0, 2)


def test_baseline_by_scalar_subquery(spark):
    groups = spark.createDataFrame([("a", 10.0, 1), ("b", 30.0, 2), ("base", 20.0, 4)], "g string, v double, n int")
    plain = by(baseline.uplift(groups, F.col("g") == "base", "v", "n", max_rows=3), "g")
    large = by(baseline.uplift(groups, F.col("g") == "base", "v", "n"), "g")
    assert plain == large and plain["a"]["uplift"] == 1.0 and plain["base"]["uplift"] == 0.0


def test_report_text(spark):
    df = spark.createDataFrame([("x", 1234567.5, 0.12345), ("y", None, None)], "k string, a double, b double")
    got = formatting.format_report(df, ["a"], ["b"]).collect()
    assert tuple(got[0]) == ("x", "1,234,568", "12.34%") or tuple(got[0]) == ("x", "1,234,568", "12.35%")
    assert tuple(got[1]) == ("y", "", "")
    placed = numbered(df.withColumn("k", F.upper("k")), [F.desc("a"), "k"], single_task_rows=0)
    assert placed.columns == ["position", "k", "a", "b"] and {(r[0], r[1]) for r in placed.collect()} == {(1, "X"), (2, "Y")}


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, None, None), ("", 1, 2.0)], "s string, i int, d double")
    assert [tuple(r) for r in cleaning.fill_defaults(df).collect()] == [("Unknown", 0, 0.0), ("Unknown", 1, 2.0)]


def test_aggregation_below_the_join_changes_nothing(spark, order_star):
    fast = marts.product_totals(order_star)
    slow = (
        order_star.sales("productid", "qty", "revenue", "isreturn").filter("isreturn = 0")
        .join(order_star.product.select("productid", "unitcost"), "productid")
        .groupBy("productid").agg(F.sum("revenue").alias("revenue"),
                                  F.sum(m.revenue() - m.cost()).alias("margin")))
    assert fast.exceptAll(slow.select(fast.columns)).count() == 0 and fast.count() == slow.count()


def test_filters_and_columns_reach_the_scan(spark, order_star):
    plan = marts.product_category_margin(order_star)._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(l_returnflag,R))" in plan or "l_returnflag" in plan
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "l_partkey" in line)
    assert "l_shipdate" not in scan and "l_linenumber" not in scan and "orders" not in plan


@pytest.mark.parametrize("name", ["star", "orders"])
def test_revenue_is_gross_less_discount(spark, order_star, name):
    star = order_star if name == "orders" else tiny_star(spark, [sale(1), ret(2)])
    df = star.sales("revenue", "grossvalue", "discountamount")
    assert df.filter("revenue <> grossvalue - discountamount").count() == 0
