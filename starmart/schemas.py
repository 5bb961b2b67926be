"""Declared schemas of the six star tables.

Each table is written once as ``column -> (raw type, clean type)``.  The raw type is
what a delimited file is read with, the clean type is what every later layer holds.
Money is DECIMAL(18,2) throughout, flags and hours are TINYINT and anything that can
exceed 127 is wider.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
FRACTION = "decimal(5,4)"
FACTOR = "decimal(10,4)"

# Column names, order and types of the published data model.
_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "dim_date": [
        ("datekey", "int", "int"),
        ("fulldate", "date", "date"),
        ("year", "smallint", "smallint"),
        ("quarternumber", "tinyint", "tinyint"),
        ("quartername", "string", "string"),
        ("monthnumber", "tinyint", "tinyint"),
        ("monthname", "string", "string"),
        ("weekdaynumber", "tinyint", "tinyint"),
        ("weekdayname", "string", "string"),
        ("isweekend", "tinyint", "tinyint"),
        ("yearmonth", "string", "string"),
        ("yearmonthnumber", "int", "int"),
        ("yearquarter", "string", "string"),
        ("yearquarternumber", "int", "int"),
        ("yearweek", "string", "string"),
        ("yearweeknumber", "int", "int"),
        ("isholiday", "tinyint", "tinyint"),
    ],
    "dim_customer": [
        ("customerid", "int", "int"),
        ("fullname", "string", "string"),
        ("email", "string", "string"),
        ("age", "tinyint", "tinyint"),
        ("gender", "string", "string"),
        ("city", "string", "string"),
        ("tier", "string", "string"),
        ("points", "int", "int"),
        ("isactive", "tinyint", "tinyint"),
        ("lang", "string", "string"),
        ("totalspend", "double", MONEY),
        ("regdate", "date", "date"),
        ("annualincome", "double", MONEY),
        ("incomebracket", "string", "string"),
        ("education", "string", "string"),
        ("maritalstatus", "string", "string"),
        ("childrencount", "tinyint", "tinyint"),
        ("loyaltysegment", "string", "string"),
        ("satisfactionscore", "double", "decimal(5,1)"),
        ("dayssincelastpurchase", "int", "int"),
        ("hassubscription", "tinyint", "tinyint"),
        ("preferredcontact", "string", "string"),
        ("spendmultiplier", "double", FACTOR),
    ],
    "dim_product": [
        ("productid", "int", "int"),
        ("name", "string", "string"),
        ("category", "string", "string"),
        ("brand", "string", "string"),
        ("unitcost", "double", MONEY),
        ("unitprice", "double", MONEY),
        ("margin_pct", "double", FRACTION),
        ("weight", "double", "decimal(10,2)"),
        ("color", "string", "string"),
        ("material", "string", "string"),
        ("supplierid", "int", "int"),
        ("isactive", "tinyint", "tinyint"),
        ("minstock", "int", "int"),
        ("tax_rate", "double", FACTOR),
        ("haswarranty", "tinyint", "tinyint"),
        ("ecofriendly", "tinyint", "tinyint"),
        ("seasonalityfactor", "double", "decimal(5,2)"),
        ("warrantymonths", "tinyint", "tinyint"),
        ("ecoscore", "int", "int"),
        ("releaseyear", "smallint", "smallint"),
        ("skucount", "int", "int"),
        ("isdiscontinued", "tinyint", "tinyint"),
        ("productrating", "double", "decimal(3,1)"),
        ("stockstatus", "string", "string"),
    ],
    "dim_store": [
        ("storeid", "int", "int"),
        ("storename", "string", "string"),
        ("city", "string", "string"),
        ("type", "string", "string"),
        ("staff", "smallint", "smallint"),
        ("sizem2", "int", "int"),
        ("hascafe", "tinyint", "tinyint"),
        ("openingyear", "smallint", "smallint"),
        ("region", "string", "string"),
        ("renovationyear", "smallint", "smallint"),
        ("parkingspots", "smallint", "smallint"),
        ("storerating", "double", "decimal(3,1)"),
        ("hasdeliveryservice", "tinyint", "tinyint"),
        ("floornumber", "tinyint", "tinyint"),
        ("distancetocitycenterkm", "double", "decimal(8,1)"),
        ("annualrentcost", "double", MONEY),
        ("storesizemultiplier", "double", FACTOR),
    ],
    "dim_promotion": [
        ("promoid", "int", "int"),
        ("promoname", "string", "string"),
        ("discount_pct", "double", FRACTION),
        ("discount_fixed", "double", "decimal(10,2)"),
        ("type", "string", "string"),
        ("isactive", "tinyint", "tinyint"),
        ("minspend", "int", "int"),
        ("channel", "string", "string"),
        ("budget", "double", MONEY),
        ("startdate", "date", "date"),
        ("enddate", "date", "date"),
        ("targetaudience", "string", "string"),
        ("maxdiscountcap", "double", MONEY),
        ("isstackable", "tinyint", "tinyint"),
        ("redemption_rate", "double", FACTOR),
        ("coderequired", "tinyint", "tinyint"),
        ("promoupliftfactor", "double", FACTOR),
    ],
    "fact_sales": [
        ("salesid", "bigint", "bigint"),
        ("datekey", "int", "int"),
        ("productid", "int", "int"),
        ("customerid", "int", "int"),
        ("storeid", "int", "int"),
        ("promoid", "int", "int"),
        ("qty", "int", "int"),
        ("unitprice", "double", MONEY),
        ("tax_rate", "double", FACTOR),
        ("net", "double", MONEY),
        ("payment", "string", "string"),
        ("channel", "string", "string"),
        ("grossvalue", "double", MONEY),
        ("discountamount", "double", MONEY),
        ("taxamount", "double", MONEY),
        ("shipcost", "double", MONEY),
        ("isreturn", "tinyint", "tinyint"),
        ("shipweight", "double", "decimal(10,2)"),
        ("discountapplied", "tinyint", "tinyint"),
        ("returnreason", "string", "string"),
        ("deliverydays", "tinyint", "tinyint"),
        ("hour", "tinyint", "tinyint"),
    ],
}

AUDIT_COLUMNS = ("_source_file", "_ingestion_ts", "_file_name", "_silver_processed_ts")


@dataclass(frozen=True)
class TableSpec:
    """A star table: columns with raw and clean types, key, references, layout keys."""

    name: str
    pk: str
    columns: tuple[tuple[str, str, str], ...]
    fks: dict[str, tuple[str, str]] = field(default_factory=dict)
    special_rows: tuple[dict, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c for c, _, _ in self.columns]

    @property
    def raw_schema(self) -> T.StructType:
        return _struct((c, raw) for c, raw, _ in self.columns)

    @property
    def schema(self) -> T.StructType:
        return _struct((c, clean) for c, _, clean in self.columns)

    @property
    def clean_types(self) -> dict[str, str]:
        return {c: clean for c, _, clean in self.columns}


def _struct(pairs) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in pairs))


# The special members every dimension carries so that no fact key is NULL.
_DATE_UNKNOWN = dict(
    datekey=-1, fulldate="1900-01-01", year=1900, quarternumber=1, quartername="Q1",
    monthnumber=1, monthname="January", weekdaynumber=1, weekdayname="Monday", isweekend=0,
    yearmonth="1900-01", yearmonthnumber=190001, yearquarter="1900-Q1",
    yearquarternumber=19001, yearweek="1900-W01", yearweeknumber=190001, isholiday=0,
)
_CUSTOMER_UNKNOWN = dict(
    customerid=-1, fullname="Unknown Customer", email="unknown@example.com", gender="Unknown",
    city="Unknown", tier="None", lang="Unknown", regdate="1900-01-01", incomebracket="Unknown",
    education="Unknown", maritalstatus="Unknown", loyaltysegment="Unknown",
    preferredcontact="Unknown", spendmultiplier=1,
)
_PRODUCT_UNKNOWN = dict(
    productid=-1, name="Unknown Product", category="Unknown", brand="Unknown", color="Unknown",
    material="Unknown", seasonalityfactor=1, releaseyear=1900, isdiscontinued=1,
    stockstatus="Unknown",
)
_STORE_UNKNOWN = dict(
    storeid=-1, storename="Unknown Store", city="Unknown", type="Unknown", openingyear=1900,
    region="Unknown", floornumber=1, storesizemultiplier=1,
)
_PROMO_UNKNOWN = dict(
    promoid=-1, promoname="Unknown Promotion", type="Unknown", channel="Unknown",
    startdate="1900-01-01", enddate="1900-01-01", targetaudience="Unknown", promoupliftfactor=1,
)
_PROMO_NONE = dict(
    promoid=0, promoname="No Promotion", type="None", isactive=1, channel="All",
    startdate="2000-01-01", enddate="2099-12-31", targetaudience="All", promoupliftfactor=1,
)


def _spec(name, pk, fks=None, special=(), cluster=()):
    return TableSpec(name, pk, tuple(_COLUMNS[name]), fks or {}, tuple(special), tuple(cluster))


DIM_DATE = _spec("dim_date", "datekey", special=[_DATE_UNKNOWN], cluster=["datekey"])
DIM_CUSTOMER = _spec("dim_customer", "customerid", special=[_CUSTOMER_UNKNOWN], cluster=["customerid"])
DIM_PRODUCT = _spec("dim_product", "productid", special=[_PRODUCT_UNKNOWN], cluster=["productid"])
DIM_STORE = _spec("dim_store", "storeid", special=[_STORE_UNKNOWN], cluster=["storeid"])
DIM_PROMOTION = _spec(
    "dim_promotion", "promoid", special=[_PROMO_UNKNOWN, _PROMO_NONE], cluster=["promoid"]
)
FACT_SALES = _spec(
    "fact_sales",
    "salesid",
    fks={
        "datekey": ("dim_date", "datekey"),
        "productid": ("dim_product", "productid"),
        "customerid": ("dim_customer", "customerid"),
        "storeid": ("dim_store", "storeid"),
        "promoid": ("dim_promotion", "promoid"),
    },
    cluster=["datekey", "productid", "customerid"],
)

TABLES: dict[str, TableSpec] = {
    s.name: s
    for s in (DIM_DATE, DIM_CUSTOMER, DIM_PRODUCT, DIM_STORE, DIM_PROMOTION, FACT_SALES)
}
DIMENSIONS = [n for n in TABLES if n.startswith("dim_")]

# Code lists of the data model.
CHANNELS = ["Online", "In-Store", "Mobile App", "Phone Order"]
SHIPPED_CHANNELS = ["Online", "Mobile App"]
PAYMENTS = ["Card", "Cash", "Bank Transfer", "Digital Wallet", "PayPal"]
CATEGORIES = ["Electronics", "Home", "Sports", "Kids", "Garden"]
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
GENDERS = ["Male", "Female"]
NO_RETURN = "No return"
