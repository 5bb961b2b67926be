"""Tiny star tables: given columns plus neutral defaults for the rest."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.calendar import calendar
from starmart.schemas import TABLES
from starmart.sources.star import Star

# A valid row of every table; tests override what they are about.
VALID = {
    "dim_customer": dict(customerid=1, fullname="Ann Lee", email="ann.lee@example.com", age=40, gender="Female",
                         tier="Gold", totalspend=10, regdate="2023-05-01", annualincome=60000),
    "dim_product": dict(productid=1, name="Ball", category="Sports", unitcost=8, unitprice=10, margin_pct="0.2",
                        tax_rate="0.21", isactive=1),
    "dim_store": dict(storeid=1, storename="Main", type="Convenience", staff=10, sizem2=100, openingyear=2000,
                      region="North", renovationyear=2010, storerating=3, storesizemultiplier=1),
    "dim_promotion": dict(promoid=1, promoname="Spring", discount_pct="0.1", type="BOGO", startdate="2023-02-01",
                          enddate="2023-03-01", redemption_rate="0.1", promoupliftfactor=1),
    "fact_sales": dict(salesid=1, datekey=20230105, productid=1, customerid=1, storeid=1, promoid=1, qty=1,
                       unitprice=100, tax_rate="0.21", net="108.90", payment="Card", channel="Online", grossvalue=100,
                       discountamount=10, taxamount="18.90", shipcost=1, isreturn=0, discountapplied=1,
                       returnreason="No return", deliverydays=3, hour=10),
}


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    spec = TABLES[name]
    out = None
    data = []
    for row in rows:
        full = {**VALID.get(name, {}), **row}
        data.append(tuple(
            None if full.get(c, 0) is None else str(full.get(c, "" if k == "string" else "0" if k != "date" else "2023-01-01"))
            for c, _, k in spec.columns))
    raw = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in spec.names))
    out = raw.select(*[F.col(c).cast(k).alias(c) for c, _, k in spec.columns])
    return out


def tiny_star(spark: SparkSession, sales: list[dict], products=({},), stores=({},), customers=({},), promos=({},),
              start=date(2023, 1, 1), end=date(2023, 12, 31), specials: bool = True, tables: dict | None = None) -> Star:
    from starmart.operators.cleaning import with_special_members

    made = {
        "dim_product": table(spark, "dim_product", list(products)),
        "dim_store": table(spark, "dim_store", list(stores)),
        "dim_customer": table(spark, "dim_customer", list(customers)),
        "dim_promotion": table(spark, "dim_promotion", list(promos)),
        "dim_date": calendar(spark, start, end),
        "fact_sales": table(spark, "fact_sales", sales),
    }
    if specials:
        for t in made:
            if TABLES[t].special_rows:
                made[t] = with_special_members(made[t], TABLES[t])
    made.update(tables or {})
    return Star(spark, made, end)
