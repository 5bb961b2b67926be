"""DuckDB SQL for every registered query, written join first and aggregate last.

The star tables are rebuilt from the raw tables as CTEs (the column mapping is the one the
Spark adapter uses); everything after that is independent of the library.
"""

from __future__ import annotations

from starmart.quality.rules import catalogue
from starmart.schemas import TABLES
from starmart.sources import order_lines as src

_TYPES = {"b": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "x": "BOOLEAN"}


def typed(sql: str, columns: str) -> str:
    """Outer projection with one cast per column: ``"name:b other:d"``."""
    cols = []
    for item in columns.split():
        name, kind = item.rsplit(":", 1)
        name = name.replace("~", " ")
        cols.append(f'CAST("{name}" AS {_TYPES[kind]}) AS "{name}"')
    return f"SELECT {', '.join(cols)} FROM ({sql}) typed_result"


def r(x: str, n: int) -> str:
    return f"ROUND(CAST({x} AS DECIMAL(28,10)), {n})"


def q(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


# --- star tables ---------------------------------------------------------------------------


def _mapping(exprs: dict) -> str:
    return ", ".join(f"{e[0] if isinstance(e, tuple) else e} AS {c}" for c, e in exprs.items())


def _special(table: str) -> str:
    spec = TABLES[table]
    out = []
    for row in spec.special_rows:
        cols = []
        for name, _, kind in spec.columns:
            default = "''" if kind == "string" else "NULL" if kind == "date" else "0"
            v = row.get(name, default)
            if name in row and isinstance(v, str):
                v = f"'{v}'"
            cols.append(f"CAST({v} AS {'VARCHAR' if kind == 'string' else kind}) AS {name}")
        out.append(f"UNION ALL SELECT {', '.join(cols)}")
    return " ".join(out)


_CTES = {
    "fact": f"SELECT {_mapping(src.FACT)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "product": f"SELECT {_mapping(src.PRODUCT)} FROM part {_special('dim_product')}",
    "cust": f"SELECT {_mapping(src.CUSTOMER)} FROM customer {_special('dim_customer')}",
    "store": (
        f"SELECT {_mapping(src.STORE)} FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        f"JOIN region ON n_regionkey = r_regionkey {_special('dim_store')}"
    ),
    "promo": f"SELECT {_mapping(src.PROMOTION)} FROM "
             f"(SELECT DISTINCT {src.PROMOTION_STEP} AS i FROM lineitem) WHERE i <> 0 {_special('dim_promotion')}",
    "dates": f"""SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS datekey, d AS fulldate, year(d) AS year,
        quarter(d) AS quarternumber, 'Q' || quarter(d) AS quartername, month(d) AS monthnumber,
        monthname(d) AS monthname, isodow(d) AS weekdaynumber, dayname(d) AS weekdayname,
        CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS isweekend, strftime(d, '%Y-%m') AS yearmonth,
        year(d) * 100 + month(d) AS yearmonthnumber, year(d) || '-Q' || quarter(d) AS yearquarter,
        year(d) * 10 + quarter(d) AS yearquarternumber, strftime(d, '%Y-W%W') AS yearweek,
        year(d) * 100 + weekofyear(d) AS yearweeknumber,
        CASE WHEN month(d) IN (12, 1, 7) THEN 1 ELSE 0 END AS isholiday
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders))
        {_special('dim_date')}""",
    "refday": "SELECT max(CAST(o_orderdate AS DATE)) AS today FROM orders",
    "sale": "SELECT *, grossvalue - discountamount AS rev FROM fact WHERE isreturn = 0",
    "line": "SELECT *, grossvalue - discountamount AS rev FROM fact",
    "cost": "SELECT s.*, p.category, p.name, p.unitcost, p.haswarranty, p.ecofriendly, p.unitprice AS listprice, "
            "p.margin_pct, s.rev - CAST(s.qty AS DECIMAL(18,0)) * p.unitcost AS margin "
            "FROM line s JOIN product p ON s.productid = p.productid",
    "prodsum": "SELECT productid, SUM(rev) AS revenue, SUM(margin) AS margin FROM cost WHERE isreturn = 0 GROUP BY 1",
    "priced": "SELECT *, CAST(CAST(unitprice - unitcost AS DOUBLE) / CAST(unitprice AS DOUBLE) AS DECIMAL(14,10)) "
              "AS fraction, CAST(CAST(CAST(unitprice - unitcost AS DOUBLE) / CAST(unitprice AS DOUBLE) AS DECIMAL(14,10)) "
              "* 100 AS DECIMAL(18,8)) AS actual FROM product WHERE productid > 0 AND unitprice > 0",
    "daily": "SELECT d.fulldate, SUM(s.net) AS daily_total FROM sale s JOIN dates d ON s.datekey = d.datekey GROUP BY 1",
}
_NEEDS = {
    "sale": ["fact"], "line": ["fact"], "cost": ["line", "product"], "prodsum": ["cost"],
    "priced": ["product"], "daily": ["sale", "dates"],
}


def star(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it names and the ones those need."""
    order: list[str] = []

    def add(n):
        for need in _NEEDS.get(n, []):
            add(need)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    body = sql.strip()
    head = ", ".join(f"{n} AS ({_CTES[n]})" for n in order)
    return f"WITH {head}{', ' + body[5:] if body.startswith('WITH ') else ' ' + body}"


def marts() -> dict[str, str]:
    o = {}
    o["m001_product_category_margin"] = typed(star(f"""
        WITH s AS (SELECT category, productid, name, unitcost, SUM(rev) AS revenue, SUM(margin) AS margin,
                          SUM(CAST(qty AS DECIMAL(18,0))) * unitcost AS cost
                   FROM cost WHERE isreturn = 0 GROUP BY 1, 2, 3, 4 HAVING SUM(rev) > 0)
        SELECT category, productid, name, revenue AS total_revenue, cost AS total_cost, margin AS total_margin,
               {r(q('margin', 'revenue'), 4)} AS margin_pct,
               RANK() OVER (PARTITION BY category ORDER BY {q('margin', 'revenue')} DESC) AS rank_in_cat FROM s""",
        "cost"), "category:s productid:b name:s total_revenue:d total_cost:d total_margin:d margin_pct:d rank_in_cat:b")
    o["m002_promo_performance"] = typed(star(f"""
        WITH tx AS (SELECT promoid, COUNT(DISTINCT salesid) AS n,
                      AVG(CASE WHEN grossvalue > 0 THEN {q('discountamount', 'grossvalue')} ELSE 0 END) AS rate FROM sale GROUP BY 1),
        mg AS (SELECT promoid, SUM(qty) AS total_qty, SUM(rev) AS revenue, SUM(margin) AS margin
               FROM cost WHERE isreturn = 0 GROUP BY 1),
        b AS (SELECT {q('SUM(rev)', 'COUNT(*)')} AS base FROM sale WHERE promoid = 0),
        x AS (SELECT p.promoid, promoname, type, discount_pct, promoupliftfactor, n AS num_transactions, total_qty,
                     revenue, margin, rate, {q('revenue', 'n')} AS basket, base
              FROM promo p JOIN mg ON p.promoid = mg.promoid JOIN tx ON p.promoid = tx.promoid, b WHERE p.promoid <> 0)
        SELECT promoid, promoname, type, discount_pct, promoupliftfactor, num_transactions, total_qty, revenue, margin,
               {r('rate', 8)} AS avg_disc_rate, {r('basket', 2)} AS avg_basket,
               {r('(basket - base) / base', 4)} AS uplift_pct, {r(q('margin', 'revenue'), 4)} AS margin_pct,
               RANK() OVER (ORDER BY margin DESC) AS margin_rank,
               RANK() OVER (ORDER BY (basket - base) / base DESC) AS uplift_rank FROM x""", "sale", "cost", "promo"),
        "promoid:b promoname:s type:s discount_pct:d promoupliftfactor:d num_transactions:b total_qty:b revenue:d "
        "margin:d avg_disc_rate:d avg_basket:d uplift_pct:d margin_pct:d margin_rank:b uplift_rank:b")
    rfm = """
        WITH c AS (SELECT s.customerid, MAX(datekey) AS mk, COUNT(DISTINCT salesid) AS frequency, SUM(rev) AS monetary,
                          SUM(margin) AS margin FROM cost s WHERE isreturn = 0 GROUP BY 1),
        b AS (SELECT customerid, date_diff('day', fulldate, today) AS recency, frequency, monetary, margin
              FROM c JOIN dates d ON c.mk = d.datekey, refday),
        z AS (SELECT *, NTILE(5) OVER (ORDER BY recency DESC, customerid) AS rs,
                     NTILE(5) OVER (ORDER BY frequency, customerid) AS fs,
                     NTILE(5) OVER (ORDER BY monetary, customerid) AS ms FROM b),
        seg AS (SELECT *, CASE WHEN rs >= 4 AND fs >= 4 THEN 'Champions' WHEN rs >= 4 AND fs >= 3 THEN 'Loyal'
                     WHEN rs >= 3 AND ms >= 4 THEN 'Big Spenders' WHEN rs <= 2 AND fs <= 2 THEN 'At Risk'
                     WHEN rs = 1 THEN 'Lost' ELSE 'Other' END AS segment FROM z)"""
    pct = f"CAST({q('margin', 'monetary')} AS DECIMAL(28,10))"
    o["m003_customer_rfm_segments"] = typed(star(rfm + f"""
        SELECT segment, COUNT(*) AS customers, {q('SUM(monetary)', 'COUNT(*)')} AS avg_ltv,
               SUM(monetary) AS total_ltv, {r(q(f'SUM({pct})', f'COUNT({pct})'), 4)} AS avg_margin_pct
        FROM seg GROUP BY 1""", "cost", "dates", "refday"),
        "segment:s customers:b avg_ltv:d total_ltv:d avg_margin_pct:d")
    o["customer_rfm_scores"] = typed(star(rfm + """
        SELECT customerid, recency, frequency, monetary, margin AS margin_total, rs AS recency_score,
               fs AS frequency_score, ms AS monetary_score, segment FROM seg""", "cost", "dates", "refday"),
        "customerid:b recency:b frequency:b monetary:d margin_total:d recency_score:b frequency_score:b "
        "monetary_score:b segment:s")
    o["m004_returns_analysis"] = typed(star(f"""
        SELECT channel, returnreason, COUNT(*) AS return_count,
               {r('CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER (PARTITION BY channel) AS DOUBLE)', 4)}
                 AS pct_of_channel_returns,
               SUM(shipcost) AS total_shipping_cost_returns, {q('SUM(rev)', 'COUNT(*)')} AS avg_return_value
        FROM line WHERE isreturn = 1 GROUP BY 1, 2""", "line"),
        "channel:s returnreason:s return_count:b pct_of_channel_returns:d total_shipping_cost_returns:d avg_return_value:d")
    n = "COUNT(*)"
    o["m005_channel_performance"] = typed(star(f"""
        SELECT channel, COUNT(*) AS transactions, {r(q('SUM(deliverydays)', n), 2)} AS avg_delivery_days,
               {r(q('SUM(shipcost)', n), 2)} AS avg_shipping_cost, {r(q('SUM(qty)', n), 2)} AS avg_qty,
               {r(q('SUM(rev)', n), 2)} AS avg_basket_value,
               {r(q('SUM(margin - shipcost)', n), 2)} AS avg_margin_after_shipping,
               {r(q('SUM(isreturn)', n), 4)} AS return_rate FROM cost GROUP BY 1""", "cost"),
        "channel:s transactions:b avg_delivery_days:d avg_shipping_cost:d avg_qty:d avg_basket_value:d "
        "avg_margin_after_shipping:d return_rate:d")
    o["m006_seasonal_category_revenue"] = typed(star("""
        SELECT monthnumber, monthname, category, SUM(rev) AS revenue, SUM(qty) AS quantity,
               RANK() OVER (PARTITION BY category ORDER BY SUM(rev) DESC) AS rank_in_cat
        FROM cost c JOIN dates d ON c.datekey = d.datekey WHERE isreturn = 0 GROUP BY 1, 2, 3""", "cost", "dates"),
        "monthnumber:b monthname:s category:s revenue:d quantity:b rank_in_cat:b")
    o["m007_store_performance"] = typed(star(f"""
        WITH mny AS (SELECT storeid, SUM(rev) AS revenue, SUM(margin) AS margin FROM cost WHERE isreturn = 0 GROUP BY 1),
        u AS (SELECT storeid, COUNT(DISTINCT customerid) AS n FROM sale GROUP BY 1)
        SELECT region, type AS store_type, {r(q('SUM(storerating)', n), 2)} AS avg_rating,
               {r(q('SUM(sizem2)', n), 2)} AS avg_size_m2, {r(q('SUM(storesizemultiplier)', n), 4)} AS avg_size_multiplier,
               SUM(revenue) AS total_revenue, SUM(margin) AS total_margin, SUM(u.n) AS unique_customers
        FROM store s JOIN mny ON s.storeid = mny.storeid JOIN u ON s.storeid = u.storeid GROUP BY 1, 2""",
        "cost", "sale", "store"),
        "region:s store_type:s avg_rating:d avg_size_m2:d avg_size_multiplier:d total_revenue:d total_margin:d "
        "unique_customers:b")
    o["m008_pareto_margin"] = typed(star(f"""
        WITH x AS (SELECT {q('SUM(margin) OVER (ORDER BY margin DESC)', 'SUM(margin) OVER ()')} AS p FROM prodsum)
        SELECT COUNT(*) AS product_cnt, MIN(p) AS min_pct_contribution, MAX(p) AS max_pct_contribution
        FROM x WHERE p <= 0.8""", "prodsum"), "product_cnt:b min_pct_contribution:d max_pct_contribution:d")
    o["m009_delivery_speed_impact"] = typed(star(f"""
        SELECT channel, category, CASE WHEN deliverydays <= 2 THEN 'Fast (1-2 days)' WHEN deliverydays <= 5
                 THEN 'Standard (3-5 days)' ELSE 'Long (>5 days)' END AS delivery_speed,
               COUNT(*) AS total_orders, SUM(isreturn) AS returns, {r(q('SUM(isreturn)', n), 4)} AS return_rate,
               {q('SUM(rev)', n)} AS avg_order_value
        FROM cost WHERE channel IN ('Online', 'Mobile App') GROUP BY 1, 2, 3""", "cost"),
        "channel:s category:s delivery_speed:s total_orders:b returns:b return_rate:d avg_order_value:d")
    o["m010_warranty_eco_impact"] = typed(star(f"""
        SELECT haswarranty, ecofriendly, {q('SUM(qty)', n)} AS avg_qty_per_transaction, {q('SUM(rev)', n)} AS avg_revenue,
               {r(q('SUM(isreturn)', n), 4)} AS return_rate, COUNT(DISTINCT customerid) AS unique_buyers
        FROM cost GROUP BY 1, 2""", "cost"),
        "haswarranty:b ecofriendly:b avg_qty_per_transaction:d avg_revenue:d return_rate:d unique_buyers:b")
    o["m011_hourly_sales_margin"] = typed(star(f"""
        SELECT hour, channel, COUNT(*) AS transactions, SUM(qty) AS items_sold, SUM(rev) AS revenue,
               SUM(margin) AS gross_margin, {r(q('SUM(margin)', 'SUM(rev)'), 4)} AS margin_pct,
               {r(q('SUM(isreturn)', n), 4)} AS return_rate, {r(q('SUM(deliverydays)', n), 2)} AS avg_delivery_days,
               RANK() OVER (PARTITION BY channel ORDER BY SUM(rev) DESC) AS revenue_rank_in_channel
        FROM cost WHERE hour IS NOT NULL GROUP BY 1, 2""", "cost"),
        "hour:b channel:s transactions:b items_sold:b revenue:d gross_margin:d margin_pct:d return_rate:d "
        "avg_delivery_days:d revenue_rank_in_channel:b")
    o["m012_pareto_revenue_margin"] = typed(star(f"""
        WITH x AS (SELECT *, {q('SUM(revenue) OVER (ORDER BY revenue DESC)', 'SUM(revenue) OVER ()')} AS pr,
                   {q('SUM(margin) OVER (ORDER BY margin DESC)', 'SUM(margin) OVER ()')} AS pm FROM prodsum)
        SELECT COUNT(*) AS products_needed_for_80pct_revenue,
               MIN(CASE WHEN pr >= 0.8 THEN revenue END) AS min_rev_in_top80,
               COUNT(CASE WHEN pm <= 0.8 THEN 1 END) AS products_needed_for_80pct_margin,
               MIN(CASE WHEN pm >= 0.8 THEN margin END) AS min_margin_in_top80
        FROM x WHERE pr <= 0.8 OR pm <= 0.8""", "prodsum"),
        "products_needed_for_80pct_revenue:b min_rev_in_top80:d products_needed_for_80pct_margin:b min_margin_in_top80:d")
    pairs = """
        WITH l AS (SELECT l_orderkey AS o, l_partkey + 1 AS p FROM lineitem WHERE l_returnflag <> 'R'),
        pr AS (SELECT a.p AS pa, b.p AS pb, COUNT(*) AS co FROM l a JOIN l b ON a.o = b.o AND a.p < b.p GROUP BY 1, 2),
        pop AS (SELECT p, COUNT(DISTINCT o) AS n FROM l GROUP BY 1),
        x AS (SELECT pa, pb, co, a.n AS na, b.n AS nb, (SELECT COUNT(DISTINCT o) FROM l) AS nn
              FROM pr JOIN pop a ON pa = a.p JOIN pop b ON pb = b.p)"""
    o["m013_basket_analysis"] = typed(pairs.strip() + f"""
        SELECT pa AS product_a, pb AS product_b, co AS co_occurrence, na AS baskets_a, nb AS baskets_b,
               {r(q('co', 'na'), 4)} AS lift_a_to_b, {r(q('co', 'nb'), 4)} AS lift_b_to_a
        FROM x ORDER BY co DESC, pa, pb LIMIT 100""",
        "product_a:b product_b:b co_occurrence:b baskets_a:b baskets_b:b lift_a_to_b:d lift_b_to_a:d")
    o["pair_rules"] = typed(pairs.strip() + f"""
        SELECT pa AS item_a, pb AS item_b, co AS co_occurrence, na AS baskets_a, nb AS baskets_b,
               {q('co', 'na')} AS confidence_ab, {q('co', 'nb')} AS confidence_ba, {q('co', 'nn')} AS support,
               (CAST(co AS DOUBLE) * nn) / (CAST(na AS DOUBLE) * nb) AS lift FROM x WHERE co >= 2""",
        "item_a:b item_b:b co_occurrence:b baskets_a:b baskets_b:b confidence_ab:d confidence_ba:d support:d lift:d")
    o["m014_delivery_speed_detailed"] = typed(star(f"""
        WITH x AS (SELECT CASE WHEN deliverydays <= 2 THEN 'Fast (1-2)' WHEN deliverydays <= 5 THEN 'Normal (3-5)'
                   ELSE 'Slow (6+)' END AS delivery_speed, channel, COUNT(*) AS orders, SUM(isreturn) AS returns,
                   {r(q('SUM(rev)', n), 2)} AS avg_order_value, {r(q('SUM(margin)', n), 2)} AS avg_margin,
                   {r(q('SUM(shipcost)', n), 2)} AS avg_shipcost
                   FROM cost WHERE channel IN ('Online', 'Mobile App') AND deliverydays > 0 GROUP BY 1, 2)
        SELECT *, {r(q('returns', 'orders'), 4)} AS return_rate, {r(q('avg_margin', 'avg_order_value'), 4)} AS margin_pct
        FROM x""", "cost"),
        "delivery_speed:s channel:s orders:b returns:b return_rate:d avg_order_value:d avg_margin:d margin_pct:d "
        "avg_shipcost:d")
    ach, sto = q("SUM(margin)", "SUM(revenue)"), q("SUM(margin_pct)", n)
    o["m015_margin_by_price_tier"] = typed(star(f"""
        WITH s AS (SELECT productid, category, listprice, margin_pct, SUM(qty) AS qty, SUM(rev) AS revenue,
                          SUM(margin) AS margin FROM cost WHERE isreturn = 0 GROUP BY 1, 2, 3, 4)
        SELECT CASE WHEN listprice < 50 THEN 'Budget (<50)' WHEN listprice < 200 THEN 'Mid (50-200)'
                    WHEN listprice < 500 THEN 'Premium (200-500)' ELSE 'Luxury (500+)' END AS price_tier,
               category, COUNT(DISTINCT productid) AS products, SUM(qty) AS total_qty, SUM(revenue) AS revenue,
               SUM(margin) AS total_margin, {r(ach, 4)} AS achieved_margin_pct, {r(sto, 4)} AS avg_product_margin_pct,
               {r(f'{sto} - {ach}', 4)} AS margin_deviation FROM s GROUP BY 1, 2""", "cost"),
        "price_tier:s category:s products:b total_qty:b revenue:d total_margin:d achieved_margin_pct:d "
        "avg_product_margin_pct:d margin_deviation:d")
    o["m016_recency_impact_on_spend"] = typed(star(f"""
        WITH c AS (SELECT customerid, MAX(datekey) AS mk FROM sale GROUP BY 1),
        rc AS (SELECT customerid, date_diff('day', fulldate, today) AS days FROM c JOIN dates d ON c.mk = d.datekey, refday),
        f AS (SELECT customerid, COUNT(DISTINCT salesid) AS n, SUM(rev) AS v, SUM(margin) AS m FROM cost
              WHERE isreturn = 0 GROUP BY 1)
        SELECT CASE WHEN days <= 30 THEN 'Active (0-30 days)' WHEN days <= 90 THEN 'Recent (31-90 days)'
                    WHEN days <= 180 THEN 'Dormant (91-180 days)' ELSE 'Churned (>180 days)' END AS recency_segment,
               COUNT(DISTINCT rc.customerid) AS customers, {r(q('SUM(v)', 'SUM(n)'), 2)} AS avg_order_value,
               {r(q('SUM(m)', 'SUM(n)'), 2)} AS avg_order_margin, {r(q('SUM(m)', 'SUM(v)'), 4)} AS avg_margin_pct,
               {r(q('SUM(n)', 'COUNT(DISTINCT rc.customerid)'), 2)} AS avg_orders_per_customer
        FROM rc LEFT JOIN f ON rc.customerid = f.customerid GROUP BY 1""", "sale", "cost", "dates", "refday"),
        "recency_segment:s customers:b avg_order_value:d avg_order_margin:d avg_margin_pct:d avg_orders_per_customer:d")
    o["m017_promo_margin_efficiency"] = typed(star(f"""
        WITH i AS (SELECT promoid, SUM(rev) AS rev, SUM(margin) AS mar FROM cost WHERE isreturn = 0 AND promoid <> 0 GROUP BY 1),
        t AS (SELECT promoid, COUNT(DISTINCT salesid) AS txn FROM sale WHERE promoid <> 0 GROUP BY 1),
        b AS (SELECT {q('SUM(rev)', n)} AS bb, {q('SUM(margin)', n)} AS bm FROM cost WHERE promoid = 0 AND isreturn = 0),
        x AS (SELECT i.promoid, promoname, type, discount_pct, txn, {q('rev', 'txn')} AS basket, {q('mar', 'txn')} AS mg,
                     bb, bm FROM i JOIN promo p ON i.promoid = p.promoid JOIN t ON i.promoid = t.promoid, b)
        SELECT promoid, promoname, type, discount_pct, txn, {r('basket', 2)} AS avg_basket, {r('mg', 2)} AS avg_margin,
               {r('basket - bb', 2)} AS basket_increase, {r('mg - bm', 2)} AS margin_increase,
               {r('(mg - bm) / bm', 4)} AS margin_uplift_pct, {r('mg', 2)} AS actual_margin_per_txn,
               RANK() OVER (ORDER BY mg - bm DESC) AS margin_effectiveness_rank FROM x""", "cost", "sale", "promo"),
        "promoid:b promoname:s type:s discount_pct:d txn:b avg_basket:d avg_margin:d basket_increase:d margin_increase:d "
        "margin_uplift_pct:d actual_margin_per_txn:d margin_effectiveness_rank:b")
    return o


def reports() -> dict[str, str]:
    o = {}
    n = "COUNT(*)"
    cogs = "SUM(CAST(qty AS DECIMAL(18,0)) * unitcost)"
    o["r01_total_revenue"] = typed(star("SELECT SUM(net) AS total_revenue FROM sale", "sale"), "total_revenue:d")
    o["r02_total_cogs"] = typed(star(f"SELECT {cogs} AS total_cogs FROM cost WHERE isreturn = 0", "cost"), "total_cogs:d")
    o["r03_gross_profit"] = typed(
        star(f"SELECT SUM(net) - {cogs} AS gross_profit FROM cost WHERE isreturn = 0", "cost"), "gross_profit:d")
    o["r04_gross_margin_pct"] = typed(star(
        f"SELECT {q(f'SUM(net) - {cogs}', 'SUM(net)')} * 100 AS gross_margin_pct FROM cost WHERE isreturn = 0", "cost"),
        "gross_margin_pct:d")
    o["r05_average_basket"] = typed(star(
        f"SELECT {q('SUM(net)', 'COUNT(DISTINCT salesid)')} AS avg_basket_value FROM sale", "sale"), "avg_basket_value:d")
    o["r06_return_rate"] = typed(star(f"SELECT {q('SUM(isreturn)', n)} AS return_rate FROM fact", "fact"), "return_rate:d")
    o["r07_discount_penetration"] = typed(star(
        f"SELECT {q('SUM(discountapplied)', n)} AS discount_penetration FROM sale", "sale"), "discount_penetration:d")
    for key, dim, on, label, typ in (
        ("r08_revenue_by_category", "product", "productid", "category", "s"),
        ("r09_revenue_by_region", "store", "storeid", "region", "s"),
        ("r11_monthly_revenue", "dates", "datekey", "yearmonth", "s"),
        ("r16_weekend_revenue", "dates", "datekey", "isweekend", "b"),
    ):
        o[key] = typed(star(
            f"SELECT {label}, SUM(net) AS revenue FROM sale s JOIN {dim} d ON s.{on} = d.{on} GROUP BY 1", "sale", dim),
            f"{label}:{typ} revenue:d")
    o["r10_top_products"] = typed(star("""
        SELECT productid, name, SUM(net) AS revenue FROM cost WHERE isreturn = 0 GROUP BY 1, 2
        ORDER BY 3 DESC, 1 LIMIT 10""", "cost"), "productid:b name:s revenue:d")
    o["r10_top_product_names"] = typed(star("""
        SELECT name, SUM(net) AS revenue FROM cost WHERE isreturn = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", "cost"),
        "name:s revenue:d")
    rate = q("discountamount", "grossvalue")
    o["r12_average_discount"] = typed(star(f"""
        SELECT {r(f'AVG({rate})', 8)} AS avg_discount_pct FROM sale
        WHERE discountapplied = 1 AND grossvalue > 0""", "sale"), "avg_discount_pct:d")
    o["r13_delivery_days_by_channel"] = typed(star(
        f"SELECT channel, {q('SUM(deliverydays)', n)} AS avg_delivery_days FROM sale GROUP BY 1", "sale"),
        "channel:s avg_delivery_days:d")
    o["r14_return_rate_by_category"] = typed(star(
        f"SELECT category, {q('SUM(isreturn)', n)} AS return_rate FROM cost GROUP BY 1", "cost"),
        "category:s return_rate:d")
    for key, first in (("r15_new_vs_returning", "sale"), ("r15_new_vs_returning_all_rows", "fact")):
        o[key] = typed(star(f"""
            WITH fp AS (SELECT customerid, MIN(datekey) AS fk FROM {first} GROUP BY 1),
            x AS (SELECT s.net, s.datekey = fp.fk AS isnew FROM sale s JOIN fp ON s.customerid = fp.customerid)
            SELECT {q('SUM(CASE WHEN isnew THEN net END)', 'COUNT(CASE WHEN isnew THEN 1 END)')} AS avg_new_basket,
                   {q('SUM(CASE WHEN NOT isnew THEN net END)', 'COUNT(CASE WHEN NOT isnew THEN 1 END)')}
                     AS avg_returning_basket FROM x""", "sale"), "avg_new_basket:d avg_returning_basket:d")
    o["r17_top_stores"] = typed(star("""
        SELECT s.storeid, storename, SUM(net) AS revenue FROM sale s JOIN store d ON s.storeid = d.storeid GROUP BY 1, 2
        ORDER BY 3 DESC, 1 LIMIT 10""", "sale", "store"), "storeid:b storename:s revenue:d")
    o["r18_product_margin_distribution"] = typed(star(f"""
        SELECT COUNT(margin_pct) AS products, MIN(margin_pct) AS min_margin_pct, MAX(margin_pct) AS max_margin_pct,
               {q('SUM(margin_pct)', 'COUNT(margin_pct)')} AS avg_margin_pct,
               {r('stddev_samp(CAST(margin_pct AS DOUBLE))', 8)} AS stdev_margin_pct,
               {r('quantile_cont(CAST(margin_pct AS DOUBLE), 0.25)', 8)} AS q25_margin_pct,
               {r('quantile_cont(CAST(margin_pct AS DOUBLE), 0.5)', 8)} AS median_margin_pct,
               {r('quantile_cont(CAST(margin_pct AS DOUBLE), 0.75)', 8)} AS q75_margin_pct
        FROM product WHERE productid > 0""", "product"),
        "products:b min_margin_pct:d max_margin_pct:d avg_margin_pct:d stdev_margin_pct:d q25_margin_pct:d "
        "median_margin_pct:d q75_margin_pct:d")
    o["r19_promotion_discounts"] = typed(star(f"""
        SELECT COUNT(*) AS promotions, MIN(discount_pct) AS min_discount_pct, MAX(discount_pct) AS max_discount_pct,
               {q('SUM(discount_pct)', 'COUNT(discount_pct)')} AS avg_discount_pct,
               {r('stddev_samp(CAST(discount_pct AS DOUBLE))', 8)} AS stdev_discount_pct,
               {r('quantile_cont(CAST(discount_pct AS DOUBLE), 0.25)', 8)} AS q25_discount_pct,
               {r('quantile_cont(CAST(discount_pct AS DOUBLE), 0.5)', 8)} AS median_discount_pct,
               {r('quantile_cont(CAST(discount_pct AS DOUBLE), 0.75)', 8)} AS q75_discount_pct
        FROM promo WHERE promoid > 0""", "promo"),
        "promotions:b min_discount_pct:d max_discount_pct:d avg_discount_pct:d stdev_discount_pct:d q25_discount_pct:d "
        "median_discount_pct:d q75_discount_pct:d")
    o["r20_critical_nulls"] = typed(star(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM fact"
        for c in ("hour", "returnreason", "promoid")), "fact"), "column_name:s nulls:b")
    o["r21_instore_delivery"] = typed(star(
        "SELECT COUNT(*) AS instore_nonzero_delivery FROM fact WHERE channel = 'In-Store' AND deliverydays > 0", "fact"),
        "instore_nonzero_delivery:b")
    dims = {"datekey": "dates", "productid": "product", "customerid": "cust", "storeid": "store", "promoid": "promo"}
    o["r22_orphan_foreign_keys"] = typed(star(" UNION ALL ".join(
        f"SELECT '{k}' AS fk, COUNT(*) AS orphan_count FROM fact f LEFT JOIN {d} d ON f.{k} = d.{k} WHERE d.{k} IS NULL"
        for k, d in dims.items()), "fact", *dims.values()), "fk:s orphan_count:b")
    o["r23_revenue_by_channel"] = typed(
        star("SELECT channel, SUM(net) AS revenue FROM sale GROUP BY 1", "sale"), "channel:s revenue:d")
    w = "OVER (ORDER BY fulldate ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    avg7 = q(f"SUM(daily_total) {w}", f"COUNT(*) {w}")
    o["r24_moving_average_7d"] = typed(
        star(f"SELECT fulldate, daily_total, {avg7} AS ma_7days FROM daily", "daily"),
        "fulldate:t daily_total:d ma_7days:d")
    o["r24_moving_average_full_weeks"] = typed(star(
        f"SELECT fulldate, daily_total, CASE WHEN COUNT(*) {w} >= 7 THEN {avg7} END AS ma_7days FROM daily", "daily"),
        "fulldate:t daily_total:d ma_7days:d")
    c7 = "SUM(daily_total) OVER (ORDER BY fulldate ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"
    o["smoothed_daily_revenue"] = typed(star(f"""
        WITH x AS (SELECT *, ROW_NUMBER() OVER (ORDER BY fulldate) AS rn, COUNT(*) OVER () AS nn,
                   CAST({c7} AS DOUBLE) / 7 AS sm FROM daily)
        SELECT fulldate, daily_total, CASE WHEN rn <= 3 OR rn > nn - 4 THEN CAST(daily_total AS DOUBLE) ELSE sm END
          AS smooth_7days FROM x""", "daily"), "fulldate:t daily_total:d smooth_7days:d")
    lag = "LAG(daily_total) OVER (ORDER BY fulldate)"
    o["daily_revenue_drift"] = typed(star(
        f"SELECT fulldate, daily_total, COALESCE({q(f'daily_total - {lag}', lag)}, 0) AS drift FROM daily", "daily"),
        "fulldate:t daily_total:d drift:d")
    o["r25_promotion_effect"] = typed(star(f"""
        WITH x AS (SELECT fulldate, MAX(CASE WHEN promoid > 0 THEN 1 ELSE 0 END) AS has_promo, SUM(net) AS v
                   FROM sale s JOIN dates d ON s.datekey = d.datekey GROUP BY 1)
        SELECT has_promo, {q('SUM(v)', n)} AS avg_revenue FROM x GROUP BY 1""", "sale", "dates"),
        "has_promo:b avg_revenue:d")
    p, z = "SUM(CASE WHEN promoid > 0 THEN net END)", "SUM(CASE WHEN promoid = 0 THEN net END)"
    o["r26_promotion_uplift"] = typed(
        star(f"SELECT COALESCE({q(f'{p} - {z}', z)}, 0) AS promo_uplift FROM sale", "sale"), "promo_uplift:d")
    o["r27_payment_channel_matrix"] = typed(star("SELECT payment, " + ", ".join(
        f"SUM(CASE WHEN channel = '{c}' THEN net END) AS \"{c}\""
        for c in ("Online", "In-Store", "Mobile App", "Phone Order")) + " FROM sale GROUP BY 1", "sale"),
        "payment:s Online:d In-Store:d Mobile~App:d Phone~Order:d")
    o["r28_kpi_summary"] = typed(star(f"""
        WITH a AS (SELECT SUM(net) AS rev, COUNT(DISTINCT salesid) AS b, {q('SUM(discountapplied)', n)} AS dp FROM sale),
        k AS (SELECT {cogs} AS c FROM cost WHERE isreturn = 0), rr AS (SELECT {q('SUM(isreturn)', n)} AS rt FROM fact)
        SELECT rev AS total_revenue, c AS total_cogs, rev - c AS gross_profit, {q('rev - c', 'rev')} * 100
          AS gross_margin_pct, {q('rev', 'b')} AS avg_basket_value, rt AS return_rate, dp AS discount_penetration
        FROM a, k, rr""", "sale", "cost", "fact"),
        "total_revenue:d total_cogs:d gross_profit:d gross_margin_pct:d avg_basket_value:d return_rate:d "
        "discount_penetration:d")
    o["r29_formatted_category_report"] = typed(star(f"""
        SELECT ROW_NUMBER() OVER (ORDER BY SUM(CASE WHEN isreturn = 0 THEN net END) DESC, category) AS position, category,
               format('{{:,}}', CAST(ROUND(SUM(CASE WHEN isreturn = 0 THEN net END), 0) AS BIGINT)) AS revenue,
               format('{{:.2f}}', {r(q('SUM(isreturn)', n) + ' * 100', 2)}::DOUBLE) || '%' AS return_rate
        FROM cost GROUP BY category""", "cost"), "position:b category:s revenue:s return_rate:s")
    return o


def margins() -> dict[str, str]:
    o = {}
    bad = "ABS(margin_pct - fraction)"
    o["g1_margin_stats"] = typed(star(f"""
        SELECT COUNT(*) AS total_products, MIN(actual) AS min_margin_pct, MAX(actual) AS max_margin_pct,
               {r('CAST(SUM(actual) AS DOUBLE) / COUNT(*)', 6)} AS avg_margin_pct,
               {r('stddev_samp(CAST(actual AS DOUBLE))', 4)} AS stdev_margin_pct,
               {r('quantile_cont(CAST(actual AS DOUBLE), 0.5)', 6)} AS median_margin_pct,
               COUNT(*) FILTER (WHERE actual > 30) AS products_above_30pct,
               COUNT(*) FILTER (WHERE actual < -10) AS products_below_minus10pct,
               COUNT(*) FILTER (WHERE actual > 30 OR actual < -10) AS products_invalid_margin,
               COUNT(*) FILTER (WHERE {bad} > 0.0001) AS mismatched_stored_margin FROM priced""", "priced"),
        "total_products:b min_margin_pct:d max_margin_pct:d avg_margin_pct:d stdev_margin_pct:d median_margin_pct:d "
        "products_above_30pct:b products_below_minus10pct:b products_invalid_margin:b mismatched_stored_margin:b")
    cols = ("productid, name, category, unitprice, unitcost, " + r("actual", 6) +
            " AS actual_margin_pct, margin_pct * 100 AS stored_margin_pct")
    types = "productid:b name:s category:s unitprice:d unitcost:d actual_margin_pct:d stored_margin_pct:d"
    for key, cond, order, remark in (("g2_above_limit", "actual > 30", "DESC", "VIOLATION"),
                                     ("g3_below_limit", "actual < -10", "ASC", "WARNING")):
        o[key] = typed(star(
            f"SELECT {cols}, '{remark}' AS remark FROM priced WHERE {cond} ORDER BY actual {order}, productid LIMIT 20",
            "priced"), types + " remark:s")
    o["g4_margin_histogram"] = typed(star("""
        WITH b AS (SELECT CASE WHEN actual < -10 THEN 1 WHEN actual <= -5 THEN 2 WHEN actual <= 0 THEN 3
                     WHEN actual <= 5 THEN 4 WHEN actual <= 10 THEN 5 WHEN actual <= 15 THEN 6 WHEN actual <= 20 THEN 7
                     WHEN actual <= 25 THEN 8 WHEN actual <= 30 THEN 9 ELSE 10 END AS k FROM priced),
        h AS (SELECT k, COUNT(*) AS c, ROUND(CAST(CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) * 100
                     AS DECIMAL(18,8)), 2) AS p FROM b GROUP BY 1)
        SELECT k AS bucket_no, (['< -10%', '-10% to -5%', '-5% to 0%', '0-5%', '5-10%', '10-15%', '15-20%', '20-25%',
                 '25-30%', '>30% (invalid)'])[k] AS margin_bucket, c AS product_count, p AS percentage,
               repeat('█', CAST(floor(p / 2) AS BIGINT)) AS bar_chart FROM h""", "priced"),
        "bucket_no:b margin_bucket:s product_count:b percentage:d bar_chart:s")
    o["g5_margin_by_category"] = typed(star(f"""
        SELECT category, COUNT(*) AS products, MIN(actual) AS min_margin_pct, MAX(actual) AS max_margin_pct,
               {r(q('SUM(actual)', 'COUNT(*)'), 6)} AS avg_margin_pct,
               COUNT(*) FILTER (WHERE actual > 30) AS violations_above_30pct FROM priced GROUP BY 1""", "priced"),
        "category:s products:b min_margin_pct:d max_margin_pct:d avg_margin_pct:d violations_above_30pct:b")
    inc = f"COUNT(*) FILTER (WHERE {bad} >= 0.0001)"
    o["g6_margin_consistency"] = typed(star(f"""
        SELECT COUNT(*) AS total_products, COUNT(*) FILTER (WHERE {bad} < 0.0001) AS consistent, {inc} AS inconsistent,
               {r(q(inc, 'COUNT(*)') + ' * 100', 2)} AS inconsistency_pct FROM priced""", "priced"),
        "total_products:b consistent:b inconsistent:b inconsistency_pct:d")
    o["g7_sample_in_range"] = typed(star(
        f"SELECT {cols} FROM priced WHERE actual BETWEEN -10 AND 30 ORDER BY productid LIMIT 10", "priced"), types)
    return o


# --- quality -------------------------------------------------------------------------------

_CTE_OF = {"dim_date": "dates", "dim_customer": "cust", "dim_product": "product", "dim_store": "store",
           "dim_promotion": "promo", "fact_sales": "fact"}


def _rule_sql(rule) -> str:
    t, k = _CTE_OF[rule.table], "s"
    head = (f"'{rule.table}' AS table_name, '{rule.group}' AS check_group, '{rule.name}' AS check_name, "
            f"'{rule.description}' AS description")
    fail = f"'{rule.severity}'"
    scope = rule.scope.replace("TRUE", "1 = 1")
    if rule.kind == "row":
        cond = rule.condition.replace("dayofweek(fulldate) IN (1, 7)", "isodow(fulldate) IN (6, 7)")
        inner = f"SELECT COUNT(*) AS n FROM {t} WHERE ({cond}) AND {scope}"
    elif rule.kind == "unique":
        inner = f"SELECT COUNT(*) - COUNT(DISTINCT {rule.columns[0]}) AS n FROM {t} WHERE {scope}"
    elif rule.kind == "fk":
        k = rule.columns[0]
        dim = {"datekey": "dates", "productid": "product", "customerid": "cust", "storeid": "store", "promoid": "promo"}[k]
        inner = f"SELECT COUNT(*) AS n FROM fact f LEFT JOIN {dim} d ON f.{k} = d.{k} WHERE d.{k} IS NULL"
    elif rule.kind == "count":
        high = "" if rule.high is None else f" AND n <= {rule.high}"
        want = f">= {rule.low}" if rule.high is None else f"{rule.low}..{rule.high}"
        ok = f"n >= {rule.low}{high}"
        return (f"SELECT {head}, CASE WHEN {ok} THEN 0 ELSE 1 END AS issue_count, '{want}' AS expected_value, "
                f"CAST(n AS VARCHAR) AS actual_value, CASE WHEN {ok} THEN 'PASS' ELSE {fail} END AS status "
                f"FROM (SELECT COUNT(*) AS n FROM {t})")
    else:
        ok = f"m = {rule.condition}"
        return (f"SELECT {head}, CASE WHEN {ok} THEN 0 ELSE 1 END AS issue_count, "
                f"CAST({rule.condition} AS VARCHAR) AS expected_value, CAST(m AS VARCHAR) AS actual_value, "
                f"CASE WHEN {ok} THEN 'PASS' ELSE {fail} END AS status "
                f"FROM (SELECT MAX({rule.columns[0]}) AS m FROM {t})")
    return (f"SELECT {head}, n AS issue_count, '0' AS expected_value, CAST(n AS VARCHAR) AS actual_value, "
            f"CASE WHEN n = 0 THEN 'PASS' ELSE {fail} END AS status FROM ({inner})")


RESULT_TYPES = ("table_name:s check_group:s check_name:s description:s issue_count:b expected_value:s "
                "actual_value:s status:s")


def quality(min_date: str) -> dict[str, str]:
    o = {}
    as_of = "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"
    every = ["fact", "dates", "cust", "product", "store", "promo"]
    rules = " UNION ALL ".join(_rule_sql(rule) for rule in catalogue(as_of, min_date))
    o["dq_results"] = typed(star(rules, *every), RESULT_TYPES)
    o["dq_problems"] = typed(star(f"SELECT * FROM ({rules}) WHERE status <> 'PASS'", *every), RESULT_TYPES)
    o["dq_summary"] = typed(star(f"""
        SELECT table_name, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed,
               COUNT(*) FILTER (WHERE status = 'WARN') AS warnings, COUNT(*) FILTER (WHERE status = 'FAIL') AS failures
        FROM ({rules}) GROUP BY 1""", *every), "table_name:s total_checks:b passed:b warnings:b failures:b")
    o["dq_verdict"] = typed(star(f"""
        SELECT bool_or(status = 'FAIL') AS has_failures, bool_or(status = 'WARN') AS has_warnings,
          CASE WHEN bool_or(status = 'FAIL') THEN 'FAILED' WHEN bool_or(status = 'WARN') THEN 'WARNINGS' ELSE 'PASSED' END
          AS verdict FROM ({rules})""", *every), "has_failures:x has_warnings:x verdict:s")
    o["dq_table_counts"] = typed(star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {c}" for t, c in _CTE_OF.items()), *every),
        "table_name:s row_count:b")
    o["dq_key_duplicates"] = typed(star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{TABLES[t].pk}' AS key_column, COUNT(*) - COUNT(DISTINCT {TABLES[t].pk}) "
        f"AS duplicates FROM {c}" for t, c in _CTE_OF.items()), *every), "table_name:s key_column:s duplicates:b")
    o["dq_financial_summary"] = typed(star("""
        SELECT SUM(net) AS total_net, SUM(grossvalue) AS total_gross, SUM(discountamount) AS total_discount,
               SUM(taxamount) AS total_tax, SUM(shipcost) AS total_shipping, SUM(qty) AS total_qty FROM sale""", "sale"),
        "total_net:d total_gross:d total_discount:d total_tax:d total_shipping:d total_qty:b")

    def counted(*rows):
        return " UNION ALL ".join(
            f"SELECT '{name}' AS check_name, COUNT(*) AS issue_count FROM {t} WHERE {cond}" for name, t, cond in rows)

    two = "check_name:s issue_count:b"
    o["dq_fraction_ranges"] = typed(star(counted(
        ("margin_pct", "product", "margin_pct < -0.10 OR margin_pct > 0.30"),
        ("tax_rate", "product", "tax_rate < 0 OR tax_rate > 1"),
        ("discount_pct", "promo", "discount_pct < 0 OR discount_pct > 0.45")), "product", "promo"), two)
    o["dq_hour_checks"] = typed(star(counted(
        ("hour_null", "fact", "hour IS NULL"), ("hour_out_of_range", "fact", "hour NOT BETWEEN 0 AND 23")), "fact"), two)
    o["dq_return_reasons"] = typed(star(counted(
        ("reason_null", "fact", "returnreason IS NULL"),
        ("sale_with_reason", "fact", "isreturn = 0 AND returnreason <> 'No return'"),
        ("return_without_reason", "fact", "isreturn = 1 AND returnreason = 'No return'")), "fact"), two)
    o["dq_delivery"] = typed(star(counted(
        ("instore_with_delivery", "fact", "channel = 'In-Store' AND deliverydays <> 0"),
        ("shipped_without_delivery", "fact", "channel IN ('Online', 'Mobile App') AND deliverydays = 0")), "fact"), two)
    o["dq_null_profile"] = typed(star(" UNION ALL ".join(
        f"SELECT 'fact_sales' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM fact"
        for c in TABLES["fact_sales"].names), "fact"), "table_name:s column_name:s nulls:b")
    o["dq_fact_sample"] = typed(star("""
        SELECT salesid, productid, storeid, qty, grossvalue, discountamount, taxamount, isreturn FROM fact
        ORDER BY 1, 2, 3, 4, 5, 6, 7, 8 LIMIT 10""", "fact"),
        "salesid:b productid:b storeid:b qty:b grossvalue:d discountamount:d taxamount:d isreturn:b")
    o["dq_mart_summary"] = typed(
        f"""SELECT COUNT(*) AS row_count, SUM(CAST(total_revenue AS DECIMAL(18,2))) AS total_revenue,
            format('{{:.2f}}', CAST({r(q('SUM(CAST(margin_pct AS DECIMAL(18,4)))', 'COUNT(*)') + ' * 100', 2)} AS DOUBLE))
              || '%' AS avg_margin
            FROM ({marts()['m001_product_category_margin']})""", "row_count:b total_revenue:d avg_margin:s")
    bad = " OR ".join(f"NOT EXISTS (SELECT 1 FROM {d} d WHERE d.{k} = f.{k})" for k, d in (
        ("datekey", "dates"), ("productid", "product"), ("customerid", "cust"), ("storeid", "store"), ("promoid", "promo")))
    keys = " + ".join(
        f"(SELECT CASE WHEN COUNT(*) > COUNT(DISTINCT {TABLES[t].pk}) THEN 1 ELSE 0 END FROM {c})"
        for t, c in _CTE_OF.items() if t != "fact_sales")

    def contract(cat, text, n):
        return (f"SELECT '{cat}' AS check_category, '{text}' AS check_description, CASE WHEN n = 0 THEN 'OK' ELSE 'ISSUE' "
                f"END AS status, CAST(n AS VARCHAR) AS details FROM ({n})")

    o["model_contract"] = typed(star(" UNION ALL ".join([
        contract("fact_foreign_keys", "fact refers to every dimension", "SELECT 0 AS n"),
        contract("fact_columns", "fact has no unexpected column", "SELECT 0 AS n"),
        contract("dimension_keys", "every dimension has a unique key without NULLs", f"SELECT {keys} AS n"),
        contract("referential_integrity", "no fact row misses a dimension row",
                 f"SELECT COUNT(*) AS n FROM fact f WHERE {bad}"),
    ]), *every), "check_category:s check_description:s status:s details:s")
    return o


# --- operators -----------------------------------------------------------------------------


def _all(table: str) -> str:
    kinds = {"string": "s", "date": "t", "bigint": "b", "int": "b", "smallint": "b", "tinyint": "b"}
    return " ".join(f"{c}:{kinds.get(kind, 'd')}" for c, _, kind in TABLES[table].columns)


def operators() -> dict[str, str]:
    o = {}
    for t, c in _CTE_OF.items():
        o[f"star_{t}"] = typed(star(f"SELECT * FROM {c}", c), _all(t))
    o["csv_round_trip"] = typed(star("SELECT * FROM cust", "cust"), _all("dim_customer"))
    o["dedup_lines"] = typed("""
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
        WHERE rn = 1""", "l_orderkey:b l_linenumber:b l_partkey:b l_suppkey:b l_quantity:d l_extendedprice:d l_shipdate:t")
    o["distinct_part_suppliers"] = typed(
        "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem", "l_partkey:b l_suppkey:b")
    o["income_bands"] = typed(star("""
        SELECT CASE WHEN annualincome <= 25000 THEN 'Low' WHEN annualincome <= 50000 THEN 'Medium'
                 WHEN annualincome <= 75000 THEN 'High' WHEN annualincome <= 100000 THEN 'Very High'
                 ELSE 'Ultra High' END AS bracket,
               CASE WHEN annualincome > 80000 THEN 'Platinum' WHEN annualincome > 50000 THEN 'Gold'
                 WHEN annualincome > 30000 THEN 'Silver' ELSE 'Bronze' END AS income_tier,
               COUNT(*) AS customers FROM cust GROUP BY 1, 2""", "cust"), "bracket:s income_tier:s customers:b")
    o["order_value_deciles"] = typed("""
        SELECT o_orderkey, o_totalprice, NTILE(10) OVER (ORDER BY o_totalprice, o_orderkey) AS decile FROM orders""",
        "o_orderkey:b o_totalprice:d decile:b")
    o["order_positions"] = typed("""
        SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position,
               COUNT(*) OVER () AS orders FROM orders""", "o_orderkey:b o_totalprice:d position:b orders:b")
    crev = "WITH c AS (SELECT customerid, SUM(rev) AS revenue FROM sale GROUP BY 1)"
    run = "SUM(revenue) OVER (ORDER BY revenue DESC, customerid ROWS UNBOUNDED PRECEDING)"
    o["customer_running_share"] = typed(star(f"""{crev}
        SELECT customerid, revenue, {run} AS running, {q(run, 'SUM(revenue) OVER ()')} AS share FROM c""", "sale"),
        "customerid:b revenue:d running:d share:d")
    lrun = "SUM(line_count) OVER (ORDER BY line_count DESC)"
    o["quantity_running_share"] = typed(star(f"""
        WITH c AS (SELECT customerid, COUNT(*) AS line_count FROM fact GROUP BY 1)
        SELECT customerid, line_count, {lrun} AS running, {q(lrun, 'SUM(line_count) OVER ()')} AS share FROM c""", "fact"),
        "customerid:b line_count:b running:b share:d")
    o["pareto_customers"] = typed(star(f"""{crev},
        x AS (SELECT *, {run} AS rr, SUM(revenue) OVER () AS tt FROM c)
        SELECT customerid, revenue FROM x WHERE (rr - revenue) < 0.8 * tt""", "sale"), "customerid:b revenue:d")
    o["customers_ranked_by_lines"] = typed(star("""
        WITH c AS (SELECT customerid, COUNT(*) AS line_count FROM fact GROUP BY 1)
        SELECT c.customerid, line_count, tier, RANK() OVER (PARTITION BY tier ORDER BY line_count DESC) AS rank_in_tier
        FROM c JOIN cust ON c.customerid = cust.customerid""", "fact", "cust"),
        "customerid:b line_count:b tier:s rank_in_tier:b")
    o["line_value_quantiles"] = typed("SELECT " + ", ".join(
        f"{r(f'quantile_cont(l_extendedprice, {p})', 6)} AS {a}" for a, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    ) + " FROM lineitem", "q25:d median:d q75:d")
    o["name_occurrences"] = typed(star("""
        SELECT productid, name, ROW_NUMBER() OVER (PARTITION BY name ORDER BY productid) - 1 AS occurrence,
               COUNT(*) OVER (PARTITION BY name) AS group_size FROM product""", "product"),
        "productid:b name:s occurrence:b group_size:b")
    o["daily_scale_factors"] = typed(star(f"""
        WITH d AS (SELECT datekey, SUM(net) AS s FROM sale GROUP BY 1),
        x AS (SELECT s.datekey, CAST(net AS DOUBLE) * (100000.0::DOUBLE / CAST(d.s AS DOUBLE)) AS v,
                     100000.0::DOUBLE / CAST(d.s AS DOUBLE) AS f FROM sale s JOIN d ON s.datekey = d.datekey)
        SELECT datekey, COUNT(*) AS lines, MAX(f) AS factor, {r('SUM(CAST(v AS DECIMAL(28,10)))', 4)} AS scaled_total
        FROM x GROUP BY 1""", "sale"), "datekey:b lines:b factor:d scaled_total:d")
    o["allocate_units"] = typed(star("""
        WITH d AS (SELECT datekey, SUM(net) AS revenue FROM sale GROUP BY 1),
        f AS (SELECT *, (CAST(revenue * 100 AS HUGEINT) * 100000) // CAST(SUM(revenue) OVER () * 100 AS HUGEINT) AS fl,
                     ROW_NUMBER() OVER (ORDER BY revenue DESC, datekey) AS rn FROM d)
        SELECT datekey, revenue, fl + CASE WHEN rn <= 100000 - SUM(fl) OVER () THEN 1 ELSE 0 END AS units FROM f""", "sale"),
        "datekey:b revenue:d units:b")
    o["region_restricted_sales"] = typed(star("""
        SELECT storeid, COUNT(*) AS lines, SUM(net) AS net FROM fact
        WHERE storeid IN (SELECT storeid FROM store WHERE region = 'ASIA') GROUP BY 1""", "fact", "store"),
        "storeid:b lines:b net:d")
    o["reconcile_layers"] = typed(star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {raw}) AS source_rows, (SELECT COUNT(*) FROM {c}) AS target_rows, "
        f"(SELECT COUNT(*) FROM {raw}) = (SELECT COUNT(*) FROM {c}) AS matches"
        for t, raw, c in (("fact_sales", "lineitem", "fact"), ("dim_product", "part", "product"),
                          ("dim_customer", "customer", "cust"), ("dim_store", "supplier", "store"))),
        "fact", "product", "cust", "store"), "table_name:s source_rows:b target_rows:b matches:x")
    o["filled_parts"] = typed("""
        SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' THEN 'Unknown' ELSE p_brand END AS p_brand,
               CASE WHEN p_size = 7 THEN 0 ELSE p_size END AS p_size,
               CASE WHEN p_type = 'SMALL' THEN 'Unknown' ELSE p_type END AS p_type,
               CASE WHEN p_partkey % 3 = 0 THEN 0.0 ELSE p_retailprice END AS p_retailprice FROM part""",
        "p_partkey:b p_brand:s p_size:b p_type:s p_retailprice:d")
    o["refined_sales"] = typed(star("""
        SELECT channel, SUM(net) AS net, SUM(grossvalue) AS grossvalue,
               COUNT(CASE WHEN payment <> 'Cash' THEN 1 END) AS with_payment FROM fact GROUP BY 1""", "fact"),
        "channel:s net:d grossvalue:d with_payment:b")
    o["first_last_purchase"] = typed(star(
        "SELECT customerid, MIN(datekey) AS first_datekey, MAX(datekey) AS last_datekey FROM sale GROUP BY 1", "sale"),
        "customerid:b first_datekey:b last_datekey:b")
    o["channel_uplift"] = typed(star(f"""
        WITH g AS (SELECT channel, SUM(net) AS net, COUNT(*) AS lines FROM sale GROUP BY 1),
        x AS (SELECT *, {q('net', 'lines')} AS per_unit, (SELECT {q('net', 'lines')} FROM g WHERE channel = 'In-Store') AS base
              FROM g)
        SELECT *, (per_unit - base) / base AS uplift FROM x""", "sale"),
        "channel:s net:d lines:b per_unit:d base:d uplift:d")
    o["payment_share"] = typed(star(f"""
        WITH g AS (SELECT channel, payment, SUM(net) AS net FROM sale GROUP BY 1, 2)
        SELECT *, {q('net', 'SUM(net) OVER (PARTITION BY channel)')} AS share_of_channel FROM g""", "sale"),
        "channel:s payment:s net:d share_of_channel:d")
    o["customer_emails"] = typed(star("""
        SELECT customerid, regexp_replace(replace(replace(lower(fullname), ' ', '.'), '#', '.'), '[^a-z0-9.]', '', 'g')
          || '@example.com' AS email FROM cust""", "cust"), "customerid:b email:s")
    sg = "CASE WHEN isreturn = 1 THEN -1 ELSE 1 END"
    o["list_line_amounts"] = typed(star(f"""
        WITH j AS (SELECT f.qty, f.channel, f.isreturn, p.category, p.weight, p.tax_rate, m.discount_pct,
                     CAST(f.qty * p.unitprice AS DECIMAL(18,2)) AS g FROM fact f JOIN product p ON f.productid = p.productid
                   JOIN promo m ON f.promoid = m.promoid),
        d AS (SELECT *, CAST(g * discount_pct AS DECIMAL(18,2)) AS di FROM j),
        t AS (SELECT *, CAST((g - di) * tax_rate AS DECIMAL(18,2)) AS tx FROM d)
        SELECT category, SUM({sg} * g) AS grossvalue, SUM({sg} * di) AS discountamount, SUM({sg} * tx) AS taxamount,
               SUM({sg} * (g - di + tx)) AS net,
               SUM(CASE WHEN channel IN ('Online', 'Mobile App') AND isreturn = 0 THEN CAST(weight * qty * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2)) ELSE 0 END)
                 AS shipcost,
               COUNT(CASE WHEN di <> 0 THEN 1 END) AS discounted, SUM(LEAST(GREATEST(qty, 5), 40)) AS clipped_qty
        FROM t GROUP BY 1""", "fact", "product", "promo"),
        "category:s grossvalue:d discountamount:d taxamount:d net:d shipcost:d discounted:b clipped_qty:b")
    o["keys_missing_from_large_products"] = typed(star("""
        SELECT DISTINCT 'productid' AS fk, productid AS key FROM fact
          WHERE productid NOT IN (SELECT productid FROM product WHERE unitprice >= 500)
        UNION ALL SELECT DISTINCT 'storeid', storeid FROM fact
          WHERE storeid NOT IN (SELECT storeid FROM store WHERE region <> 'ASIA')""", "fact", "product", "store"),
        "fk:s key:b")
    o["rows_missing_a_dimension"] = typed(star("""
        SELECT COUNT(*) AS orphan_count FROM fact
        WHERE productid NOT IN (SELECT productid FROM product WHERE unitprice >= 500)
           OR storeid NOT IN (SELECT storeid FROM store WHERE region <> 'ASIA')""", "fact", "product", "store"),
        "orphan_count:b")
    ords = "WITH x AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders)"
    w10 = "OVER (ORDER BY o_orderkey ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    o["order_value_moving_average"] = typed(
        f"{ords} SELECT o_orderkey, v, {q(f'SUM(v) {w10}', f'COUNT(*) {w10}')} AS ma_10 FROM x",
        "o_orderkey:b v:d ma_10:d")
    o["order_value_smoothed"] = typed(f"""{ords},
        y AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn, COUNT(*) OVER () AS nn,
              SUM(v) OVER (ORDER BY o_orderkey ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS s7 FROM x)
        SELECT o_orderkey, v, CASE WHEN rn <= 3 OR rn > nn - 4 THEN CAST(v AS DOUBLE) ELSE CAST(s7 AS DOUBLE) / 7 END
          AS smoothed FROM y""", "o_orderkey:b v:d smoothed:d")
    lag = "LAG(v) OVER (ORDER BY o_orderkey)"
    o["order_value_drift"] = typed(
        f"{ords} SELECT o_orderkey, v, COALESCE({q(f'v - {lag}', lag)}, 0) AS drift FROM x", "o_orderkey:b v:d drift:d")
    o["clustered_sales"] = typed(star(
        "SELECT productid, COUNT(*) AS lines, SUM(net) AS net FROM fact GROUP BY 1", "fact"), "productid:b lines:b net:d")
    unknown = """(SELECT CASE WHEN salesid % 11 = 0 THEN -1 ELSE datekey END AS datekey, productid,
                  CASE WHEN salesid % 13 = 0 THEN NULL ELSE customerid END AS customerid FROM fact)"""
    o["clustering_spans"] = typed(star(" UNION ALL ".join(
        f"""SELECT '{k}' AS key, COUNT(*) AS rows, COUNT(*) - COUNT(CASE WHEN {k} >= 1 THEN 1 END) AS special_rows,
            MIN(CASE WHEN {k} >= 1 THEN {k} END) AS least, MAX({k}) AS most, TRUE AS narrow FROM {unknown} f"""
        for k in TABLES["fact_sales"].cluster_by), "fact"), "key:s rows:b special_rows:b least:b most:b narrow:x")
    o["stream_distinct_sales"] = typed(_layered(star("SELECT salesid, qty, net FROM fact", "fact")), "salesid:b qty:b net:d")
    o["product_totals"] = typed(star("SELECT * FROM prodsum", "prodsum"), "productid:b revenue:d margin:d")
    return o


def _layered(sql: str) -> str:
    """Over sales lines with a key of their own, as the input files have them."""
    key = """CAST('0x' || left(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT))), 15) AS BIGINT)"""
    return sql.replace("l_orderkey AS salesid", f"{key} AS salesid, l_orderkey AS its_order")


def _cleaned(table: str, source: str) -> str:
    """The clean columns of a table: types as declared, empty texts NULL; and what the input files change."""
    cols = []
    for name, _, kind in TABLES[table].columns:
        e = f"NULLIF({name}, '')" if kind == "string" else name
        if table == "fact_sales":
            e = {"payment": "NULLIF(payment, 'Cash')", "hour": "CASE WHEN its_order % 1000 = 1 THEN NULL ELSE hour END"}.get(name, e)
        cols.append(f"CAST({e} AS {'VARCHAR' if kind == 'string' else kind}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM {source}"


def _digest(table: str, source: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in TABLES[table].names)
    return f"""SELECT '{table}' AS table_name, COUNT(*) AS rows, CAST(SUM(CAST(h AS HUGEINT)) AS VARCHAR) AS digest_sum,
        bit_xor(h) AS digest_xor, TRUE AS matches
        FROM (SELECT CAST('0x' || left(md5(concat_ws('|', {text})), 15) AS BIGINT) AS h FROM ({_cleaned(table, source)}) c) x"""


def layers() -> dict[str, str]:
    o = {}
    marts_sql = marts()
    o["layers_m001"] = _layered(marts_sql["m001_product_category_margin"])
    o["layers_m003"] = _layered(marts_sql["m003_customer_rfm_segments"])
    o["layers_silver_fact"] = typed(_layered(star(_cleaned("fact_sales", "fact"), "fact")), _all("fact_sales"))
    o["layers_rejected"] = typed(_layered(star("""
        SELECT salesid, 'fact_sales.csv' AS _file_name, TRUE AS from_its_file FROM fact WHERE its_order % 1000 = 1
        UNION ALL SELECT salesid, 'fact_sales.csv', TRUE FROM fact WHERE its_order % 1000 = 1 AND its_order % 7 = 0""", "fact")),
        "salesid:b _file_name:s from_its_file:x")
    dims = {"dim_product": "product", "dim_store": "store", "dim_promotion": "promo"}
    o["layers_row_counts"] = typed(_layered(star("""
        SELECT 'fact_sales' AS table_name, 'loaded' AS status,
               COUNT(*) + COUNT(CASE WHEN its_order % 7 = 0 THEN 1 END) AS bronze_rows, COUNT(*) AS silver_rows FROM fact
        """ + "".join(f"UNION ALL SELECT '{t}', 'loaded', COUNT(CASE WHEN {TABLES[t].pk} > 0 THEN 1 END), COUNT(*) FROM {c} "
                      for t, c in dims.items()) +
        "UNION ALL SELECT 'dim_date', 'missing', NULL, NULL UNION ALL SELECT 'dim_customer', 'missing', NULL, NULL",
        "fact", *dims.values())), "table_name:s status:s bronze_rows:b silver_rows:b")
    members = [(t, s[spec.pk]) for t, spec in TABLES.items() for s in spec.special_rows]
    o["layers_special_members"] = typed("SELECT * FROM (VALUES " + ", ".join(f"('{t}', {k}, 0)" for t, k in members) +
                                        ") v(table_name, key, added_again)", "table_name:s key:b added_again:b")
    o["layers_digests"] = typed(_layered(star(
        _digest("fact_sales", "fact") + " UNION ALL " + _digest("dim_store", "store"), "fact", "store")),
        "table_name:s rows:b digest_sum:s digest_xor:b matches:x")
    o["layers_published"] = typed(star("""
        WITH n AS (SELECT COUNT(DISTINCT region) AS r FROM store)
        SELECT 'regions' AS name, 'Stores of each region' AS description, r AS written, 2 * r - 1 AS rows FROM n
        UNION ALL SELECT 'regions_view', 'The same as a view', r, 2 * r - 1 FROM n""", "store"),
        "name:s description:s written:b rows:b")
    o["layers_overwrite"] = typed(star(
        "SELECT storeid, isreturn, COUNT(*) AS lines, SUM(net) AS net FROM fact GROUP BY 1, 2", "fact"),
        "storeid:b isreturn:b lines:b net:d")
    o["compacted_sales"] = typed(star("""
        SELECT storeid, COUNT(*) AS lines, SUM(net) AS net, TRUE AS large_file_kept, 12 AS small_files_rewritten, TRUE AS fewer_files
        FROM fact GROUP BY 1""", "fact"),
        "storeid:b lines:b net:d large_file_kept:x small_files_rewritten:b fewer_files:x")
    o["key_assertions"] = typed(star("""
        WITH l AS (SELECT l_orderkey AS salesid, l_linenumber AS line, l_partkey + 1 AS productid,
                          CASE WHEN l_orderkey % 13 <> 0 THEN o_custkey + 1 END AS customerid
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        a AS (SELECT 'no nulls' AS assertion, 'salesid' AS column_name, COUNT(*) - COUNT(salesid) AS violations FROM l
              UNION ALL SELECT 'no nulls', 'productid', COUNT(*) - COUNT(productid) FROM l
              UNION ALL SELECT 'no nulls', 'customerid', COUNT(*) - COUNT(customerid) FROM l
              UNION ALL SELECT 'unique', 'salesid, line', COUNT(*) - COUNT(DISTINCT (salesid, line)) FROM l
              UNION ALL SELECT 'unique', 'salesid', COUNT(*) - COUNT(DISTINCT salesid) FROM l)
        SELECT *, violations = 0 AS holds FROM a""", "fact"), "assertion:s column_name:s violations:b holds:x")
    o["maintained_layers"] = typed(star("""
        SELECT 'fact_sales' AS table_name, 'clustered' AS status, 2 AS snapshots_removed, COUNT(*) AS rows FROM fact
        UNION ALL SELECT 'dim_store', 'clustered', 2, COUNT(*) FROM store
        UNION ALL SELECT 'broken', 'failed', 0, NULL""", "fact", "store"),
        "table_name:s status:s snapshots_removed:b rows:b")
    o["table_statistics"] = typed(star(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS least, CAST(MAX({c}) AS DOUBLE) AS most, COUNT(*) - COUNT({c}) AS nulls FROM fact"
        for c in ("salesid", "productid", "qty", "net", "isreturn", "hour")), "fact"), "column_name:s least:d most:d nulls:b")
    return o


def all_oracles(min_date: str) -> dict[str, str]:
    return {**marts(), **reports(), **margins(), **quality(min_date), **operators(), **layers()}
