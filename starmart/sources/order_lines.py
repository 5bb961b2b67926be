"""Star schema over order/line-item tables.

Maps a TPC-H-like layout (lineitem, orders, part, supplier, customer, nation, region) to the
six star tables.  Attributes the source lacks are derived from keys by integer arithmetic.
Keys are shifted by one because the source counts from 0 and keys below 1 are special members,
and they stay BIGINT: at large scale factors parts and customers outgrow 32 bits.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.calendar import calendar
from starmart.operators.cleaning import with_special_members
from starmart.schemas import MONEY, TABLES
from starmart.sources.scratch import materialize
from starmart.sources.star import Star

_SIGN = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END"

# The source holds money as DOUBLE.  Amounts are worked out in whole cents and turned into
# DECIMAL once at the end: a cast from DOUBLE to DECIMAL goes through text and is slow.
_GROSS = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"


def _percent_of(cents: str, fraction: str) -> str:
    """Cents of a whole-percent fraction, half a cent up."""
    return f"CAST(floor(({cents} * floor({fraction} * 100 + 0.5) + 50) / CAST(100 AS DOUBLE)) AS BIGINT)"


def _money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {MONEY})"


_DISC = _percent_of(_GROSS, "l_discount")
_TAX = _percent_of(f"({_GROSS} - {_DISC})", "l_tax")
_CHANNEL = (
    "CASE o_orderpriority WHEN '2-HIGH' THEN 'Mobile App' WHEN '3-MEDIUM' THEN 'In-Store' "
    "WHEN '4-NOT SPECIFIED' THEN 'Phone Order' ELSE 'Online' END"
)
_SHIPPED = "o_orderpriority NOT IN ('3-MEDIUM', '4-NOT SPECIFIED')"

# column -> (expression, needs the orders table)
FACT = {
    "salesid": ("l_orderkey", False),
    "datekey": ("CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT)", True),
    "productid": ("l_partkey + 1", False),
    "customerid": ("o_custkey + 1", True),
    "storeid": ("l_suppkey + 1", False),
    "promoid": ("CAST(floor(l_discount * 100 + 0.5) AS INT)", False),
    "qty": ("CAST(l_quantity AS INT)", False),
    "unitprice": (f"CAST(floor(l_extendedprice / l_quantity) AS {MONEY})", False),
    "tax_rate": ("CAST(l_tax AS DECIMAL(10,4))", False),
    "net": (_money(f"({_SIGN}) * ({_GROSS} - {_DISC} + {_TAX})"), False),
    "payment": (
        "CASE l_suppkey % 5 WHEN 0 THEN 'Card' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Bank Transfer' "
        "WHEN 3 THEN 'Digital Wallet' ELSE 'PayPal' END", False),
    "channel": (_CHANNEL, True),
    "grossvalue": (_money(f"({_SIGN}) * {_GROSS}"), False),
    "discountamount": (_money(f"({_SIGN}) * {_DISC}"), False),
    "taxamount": (_money(f"({_SIGN}) * {_TAX}"), False),
    "shipcost": (
        _money(f"CASE WHEN {_SHIPPED} AND l_returnflag <> 'R' THEN CAST(floor(l_quantity * 50) AS BIGINT) ELSE 0 END"),
        True),
    "isreturn": ("CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS TINYINT)", False),
    "shipweight": (f"CAST({_money('CAST(floor(l_quantity * 30 + 0.5) AS BIGINT)')} AS DECIMAL(10,2))", False),
    "discountapplied": (f"CAST(CASE WHEN {_DISC} <> 0 THEN 1 ELSE 0 END AS TINYINT)", False),
    "returnreason": (
        "CASE WHEN l_returnflag <> 'R' THEN 'No return' ELSE CASE l_partkey % 6 WHEN 0 THEN 'Defective' "
        "WHEN 1 THEN 'Wrong item' WHEN 2 THEN 'Not as described' WHEN 3 THEN 'Changed mind' "
        "WHEN 4 THEN 'Late delivery' ELSE 'Other' END END", False),
    "deliverydays": (
        "CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 "
        "ELSE 1 + (l_linenumber + l_partkey) % 10 END AS TINYINT)", True),
    "hour": ("CAST(l_orderkey % 24 AS TINYINT)", False),
}

# Measures of a line that analyses ask for by name, see Star.sales.
MEASURES = {"revenue": (_money(f"({_SIGN}) * ({_GROSS} - {_DISC})"), False)}

_RETAIL = "CAST(p_retailprice AS DECIMAL(18,2))"
_PRICE = f"CAST({_RETAIL} * CAST(p_size AS DECIMAL(4,0)) * CAST(0.04 AS DECIMAL(3,2)) AS {MONEY})"
_COST_TENTHS = "CAST(5 + 2 * (p_partkey % 11) AS DECIMAL(4,0))"
_TENTH = "CAST(0.1 AS DECIMAL(2,1))"
PRODUCT = {
    "productid": "p_partkey + 1",
    "name": "p_name",
    "category": "p_type",
    "brand": "p_brand",
    "unitcost": f"CAST({_PRICE} * {_COST_TENTHS} * {_TENTH} AS {MONEY})",
    "unitprice": _PRICE,
    "margin_pct": (
        f"CAST(1 - {_COST_TENTHS} * {_TENTH} + CASE WHEN p_partkey % 50 = 7 "
        "THEN CAST(0.01 AS DECIMAL(3,2)) ELSE CAST(0 AS DECIMAL(3,2)) END AS DECIMAL(5,4))"
    ),
    "weight": f"CAST(CAST(p_size AS DECIMAL(10,0)) * {_TENTH} AS DECIMAL(10,2))",
    "color": "CASE p_partkey % 3 WHEN 0 THEN 'Red' WHEN 1 THEN 'Blue' ELSE 'Black' END",
    "material": "CASE p_partkey % 2 WHEN 0 THEN 'Steel' ELSE 'Wood' END",
    "supplierid": "CAST(p_partkey % 97 AS INT)",
    "isactive": "CAST(CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE 1 END AS TINYINT)",
    "minstock": "CAST(p_partkey % 40 AS INT)",
    "tax_rate": "CAST(CASE WHEN p_partkey % 5 = 0 THEN 0.10 ELSE 0.21 END AS DECIMAL(10,4))",
    "haswarranty": "CAST(p_size % 2 AS TINYINT)",
    "ecofriendly": "CAST(p_partkey % 2 AS TINYINT)",
    "seasonalityfactor": "CAST(1 AS DECIMAL(5,2))",
    "warrantymonths": "CAST(CASE WHEN p_size % 2 = 1 OR p_partkey % 60 = 1 THEN 24 ELSE 0 END AS TINYINT)",
    "ecoscore": "CAST(p_partkey % 200 AS INT)",
    "releaseyear": "CAST(1990 + p_partkey % 10 AS SMALLINT)",
    "skucount": "CAST(1 + p_partkey % 9 AS INT)",
    "isdiscontinued": "CAST(CASE WHEN p_partkey % 20 = 0 OR p_partkey % 70 = 3 THEN 1 ELSE 0 END AS TINYINT)",
    "productrating": f"CAST(CAST(10 + p_partkey % 41 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(3,1))",
    "stockstatus": "CASE p_partkey % 4 WHEN 0 THEN 'Low' ELSE 'In Stock' END",
}
CUSTOMER = {
    "customerid": "c_custkey + 1",
    "fullname": "c_name",
    "email": "concat(lower(replace(c_name, '#', '.')), '@example.com')",
    "age": "CAST(18 + c_custkey % 58 AS TINYINT)",
    "gender": "CASE c_custkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END",
    "city": "concat('City ', CAST(c_nationkey AS VARCHAR(10)))",
    "tier": (
        "CASE WHEN c_acctbal > 7500 THEN 'Platinum' WHEN c_acctbal > 5000 THEN 'Gold' "
        "WHEN c_acctbal > 2500 THEN 'Silver' ELSE 'Bronze' END"
    ),
    "points": "CAST(floor(c_acctbal) AS INT)",
    "isactive": "CAST(CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS TINYINT)",
    "lang": "CASE c_nationkey % 3 WHEN 0 THEN 'EN' WHEN 1 THEN 'ES' ELSE 'DE' END",
    "totalspend": f"CAST(c_acctbal AS {MONEY})",
    "regdate": "DATE '1994-01-01' + CAST(c_custkey % 700 AS INT)",
    "annualincome": f"CAST(30000 + (c_custkey % 97) * 1000 AS {MONEY})",
    "incomebracket": (
        "CASE WHEN c_custkey % 97 <= 20 THEN 'Medium' WHEN c_custkey % 97 <= 45 THEN 'High' "
        "WHEN c_custkey % 97 <= 70 THEN 'Very High' ELSE 'Ultra High' END"
    ),
    "education": "CASE c_custkey % 3 WHEN 0 THEN 'Primary' WHEN 1 THEN 'Secondary' ELSE 'University' END",
    "maritalstatus": "CASE c_custkey % 2 WHEN 0 THEN 'Single' ELSE 'Married' END",
    "childrencount": "CAST(c_custkey % 4 AS TINYINT)",
    "loyaltysegment": "c_mktsegment",
    "satisfactionscore": f"CAST(CAST(c_custkey % 101 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(5,1))",
    "dayssincelastpurchase": "CAST(c_custkey % 365 AS INT)",
    "hassubscription": "CAST(c_custkey % 2 AS TINYINT)",
    "preferredcontact": "CASE c_custkey % 2 WHEN 0 THEN 'Email' ELSE 'Phone' END",
    "spendmultiplier": f"CAST(CAST(5 + c_custkey % 75 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(10,4))",
}
STORE = {
    "storeid": "s_suppkey + 1",
    "storename": "s_name",
    "city": "n_name",
    "type": (
        "CASE s_suppkey % 4 WHEN 0 THEN 'Supermarket' WHEN 1 THEN 'Hypermarket' "
        "WHEN 2 THEN 'Convenience' ELSE 'Department' END"
    ),
    "staff": "CAST(10 + s_suppkey % 200 AS SMALLINT)",
    "sizem2": "CAST(150 + (s_suppkey * 37) % 4850 AS INT)",
    "hascafe": "CAST(s_suppkey % 2 AS TINYINT)",
    "openingyear": "CAST(1990 + s_suppkey % 30 AS SMALLINT)",
    "region": "r_name",
    "renovationyear": "CAST(CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE 1990 + s_suppkey % 37 END AS SMALLINT)",
    "parkingspots": "CAST(s_suppkey % 300 AS SMALLINT)",
    "storerating": f"CAST(CAST(20 + s_suppkey % 31 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(3,1))",
    "hasdeliveryservice": "CAST(s_suppkey % 2 AS TINYINT)",
    "floornumber": "CAST(1 + s_suppkey % 4 AS TINYINT)",
    "distancetocitycenterkm": f"CAST(CAST(s_suppkey % 250 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(8,1))",
    "annualrentcost": f"CAST(10000 + (s_suppkey * 53) % 9000 AS {MONEY})",
    "storesizemultiplier": f"CAST(CAST(5 + s_suppkey % 40 AS DECIMAL(4,0)) * {_TENTH} AS DECIMAL(10,4))",
}
# One row per discount that occurs; ``promoid`` is the discount in percent, 0 is no promotion.
PROMOTION_STEP = "CAST(floor(l_discount * 100 + 0.5) AS INT)"
PROMOTION = {
    "promoid": "CAST(i AS INT)",
    "promoname": "concat('Promo ', CAST(i AS VARCHAR(10)))",
    "discount_pct": "CAST(CAST(i AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,4))",
    "discount_fixed": "CAST(i AS DECIMAL(10,2))",
    "type": (
        "CASE i % 4 WHEN 0 THEN 'Percentage' WHEN 1 THEN 'Fixed Amount' "
        "WHEN 2 THEN 'BOGO' ELSE 'Free Shipping' END"
    ),
    "isactive": "CAST(CASE WHEN i = 3 THEN 1 ELSE 0 END AS TINYINT)",
    "minspend": "CAST(i * 10 AS INT)",
    "channel": "'All'",
    "budget": f"CAST(i * 1000 AS {MONEY})",
    "startdate": "DATE '1995-01-01' + CAST(i * 30 AS INT)",
    "enddate": "DATE '1995-03-01' + CAST(i * 60 AS INT)",
    "targetaudience": "'All'",
    "maxdiscountcap": f"CAST(i * 100 AS {MONEY})",
    "isstackable": "CAST(i % 2 AS TINYINT)",
    "redemption_rate": "CAST(CAST(i AS DECIMAL(4,0)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(10,4))",
    "coderequired": "CAST(i % 2 AS TINYINT)",
    "promoupliftfactor": "CAST(1 + CAST(i AS DECIMAL(4,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(10,4))",
}


class OrderLineStar(Star):
    """Star over parquet files ``<folder>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:  # opening a file set reads footers; do it once per star
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def sales(self, *columns: str, **more: str) -> DataFrame:
        """Order lines; the orders table is joined only for columns that come from it.  Every
        line has exactly one order, so leaving the join out changes no row.  ``more`` adds columns of the line itself."""
        columns = columns or tuple(FACT)
        exprs = FACT | MEASURES
        lines = self.raw("lineitem")
        if any(exprs[c][1] for c in columns):
            orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.selectExpr(*[f"{exprs[c][0]} AS {c}" for c in columns], *[f"{e} AS {c}" for c, e in more.items()])

    def table(self, name: str) -> DataFrame:
        if name == "fact_sales":
            return self.sales()
        if name not in self.tables:
            build = {
                "dim_product": lambda: self._map("part", PRODUCT),
                "dim_customer": lambda: self._map("customer", CUSTOMER),
                "dim_store": self._stores,
                "dim_promotion": self._promotions,
                "dim_date": lambda: calendar(self.spark, *self._span),
            }[name]
            # Derived keys start at 1, so the special members cannot be there already.
            self.tables[name] = with_special_members(build(), TABLES[name], check=False)
        return self.tables[name]

    def _map(self, source: str | DataFrame, exprs: dict[str, str]) -> DataFrame:
        df = self.raw(source) if isinstance(source, str) else source
        return df.selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])

    def _stores(self) -> DataFrame:
        nation = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        joined = self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return self._map(joined, STORE)

    def _promotions(self) -> DataFrame:
        """Promotions from the discounts of all lines.  Stored once: the few rows then have a
        known size and number, which an aggregate over the lines has not."""
        steps = self.raw("lineitem").selectExpr(f"{PROMOTION_STEP} AS i").filter("i <> 0").distinct()
        stored, n = materialize(self._map(steps, PROMOTION))
        self._rows["dim_promotion"] = n + len(TABLES["dim_promotion"].special_rows)
        return stored

    @cached_property
    def _span(self) -> tuple[date, date]:
        d = F.col("o_orderdate").cast("date")
        first, last = self.raw("orders").agg(F.min(d), F.max(d)).first()
        return first, last

    @cached_property
    def as_of(self) -> date:
        return self.reference_date or self._span[1]

    def rows(self, name: str) -> int:
        """Upper bounds from the source tables: footers instead of derived rows."""
        if name not in self._rows:
            special = len(TABLES[name].special_rows)
            if name == "dim_promotion":
                self.table(name)  # counts them
                return self._rows[name]
            if name == "dim_date":
                n = (self._span[1] - self._span[0]).days + 1
            else:
                source = {"dim_product": "part", "dim_customer": "customer", "dim_store": "supplier",
                          "fact_sales": "lineitem"}[name]
                n = self.raw(source).count()
            self._rows[name] = n + special
        return self._rows[name]
