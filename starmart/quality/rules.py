"""The rule catalogue: 64 rules over the six star tables.

A row rule is the condition a bad row meets, in SQL; a NULL condition counts as not met.
``real_only`` leaves special members (key below 1) out.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from starmart.schemas import CATEGORIES, FACT_SALES, GENDERS, SHIPPED_CHANNELS, TABLES, TIERS


@dataclass(frozen=True)
class Rule:
    table: str
    group: str
    name: str
    description: str
    kind: str = "row"            # row | unique | fk | count | latest
    condition: str = ""          # row rules: what makes a row bad
    columns: tuple[str, ...] = ()  # unique and fk rules
    real_only: bool = False
    severity: str = "FAIL"
    low: int | None = None       # count rules
    high: int | None = None

    @property
    def scope(self) -> str:
        return f"{TABLES[self.table].pk} > 0" if self.real_only else "TRUE"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def unique(table: str, column: str, name: str, description: str, group="Uniqueness", real_only=False) -> Rule:
    return Rule(table, group, name, description, "unique", columns=(column,), real_only=real_only)


def not_null(table: str, column: str, name: str | None = None) -> Rule:
    return Rule(table, "Null", name or f"{column}_null", f"{column} must not be NULL", condition=f"{column} IS NULL")


def row_count(table: str, name: str, low: int, high: int | None, description: str) -> Rule:
    return Rule(table, "Count", name, description, "count", severity="WARN", low=low, high=high)


# Limits of the published rule set.
MIN_DATE = "2023-01-01"
MIN_CALENDAR_DAYS = 365
FACT_ROWS = (9_000_000, 11_000_000)


def catalogue(
    as_of: date | str,
    min_date: str = MIN_DATE,
    fact_rows: tuple[int, int] = FACT_ROWS,
    categories=CATEGORIES,
) -> list[Rule]:
    """All rules for a reference date (a date, or SQL that yields one); limits that depend on
    the data set are parameters."""
    today = as_of if isinstance(as_of, str) else f"DATE '{as_of.isoformat()}'"

    def rows(table, real_only, *entries):
        return [
            Rule(table, group, name, text, condition=cond, real_only=real_only)
            for group, name, cond, text in entries
        ]

    d, c, p, s, pr, f = (
        "dim_date", "dim_customer", "dim_product", "dim_store", "dim_promotion", "fact_sales",
    )
    shipped = _in(SHIPPED_CHANNELS)
    return [
        not_null(d, "datekey"),
        not_null(d, "fulldate"),
        *rows(d, True, (
            "Range", "fulldate_out_of_range", f"fulldate < DATE '{min_date}' OR fulldate > {today}",
            "dates lie between the first day and the reference date")),
        unique(d, "datekey", "duplicate_datekey", "datekey is unique"),
        *rows(d, False, ("Logical", "isholiday_invalid", "isholiday NOT IN (0, 1)", "holiday flag is 0 or 1")),
        *rows(
            d, True,
            ("Logical", "year_month_mismatch", "year <> year(fulldate) OR monthnumber <> month(fulldate)",
             "year and month agree with the date"),
            ("Completeness", "missing_weekend_flag",
             "isweekend <> CASE WHEN dayofweek(fulldate) IN (1, 7) THEN 1 ELSE 0 END",
             "weekend flag agrees with the weekday of the date")),
        row_count(d, "date_row_count", MIN_CALENDAR_DAYS, None, "calendar covers at least a year"),
        Rule(d, "Range", "date_coverage_end", "calendar ends on the reference date", "latest",
             condition=today, columns=("fulldate",)),
        not_null(c, "customerid"),
        unique(c, "email", "duplicate_email", "email is unique", real_only=True),
        *rows(
            c, True,
            ("Range", "age_out_of_bounds", "age < 18 OR age > 75", "age is 18 to 75"),
            ("Value", "invalid_gender", f"gender NOT IN {_in(GENDERS)}", "known gender code"),
            ("Value", "invalid_tier", f"tier NOT IN {_in(TIERS)}", "known tier"),
            ("Logical", "regdate_future", f"regdate > {today}", "registered by the reference date"),
            ("Logical", "negative_totalspend", "totalspend < 0", "spend is not negative"),
            ("Consistency", "tier_income_mismatch", "tier = 'Platinum' AND annualincome < 70000",
             "platinum customers earn at least 70000"),
            ("Consistency", "bronze_high_income", "tier = 'Bronze' AND annualincome > 100000",
             "bronze customers earn at most 100000")),
        not_null(p, "productid"),
        unique(p, "name", "duplicate_name", "product name is unique", real_only=True),
        *rows(
            p, True,
            ("Range", "unitprice_le_0", "unitprice <= 0", "price is positive"),
            ("Range", "unitcost_negative", "unitcost < 0", "cost is not negative"),
            ("Logical", "unitcost_gt_unitprice_pos_margin", "unitcost > unitprice AND margin_pct > 0",
             "cost above price has no positive margin"),
            ("Range", "margin_pct_outside_range", "margin_pct < -0.10 OR margin_pct > 0.30",
             "margin is -0.10 to 0.30"),
            ("Range", "tax_rate_outside_0_1", "tax_rate < 0 OR tax_rate > 1", "tax rate is a fraction"),
            ("Value", "invalid_category", f"category NOT IN {_in(categories)}", "known category"),
            ("Logical", "warranty_months_positive", "haswarranty = 0 AND warrantymonths > 0",
             "no warranty, no warranty months"),
            ("Logical", "discontinued_but_active", "isdiscontinued = 1 AND isactive = 1",
             "discontinued products are inactive")),
        not_null(s, "storeid"),
        unique(s, "storename", "duplicate_storename", "store name is unique", real_only=True),
        *rows(
            s, True,
            ("Logical", "renovation_before_opening", "renovationyear <> 0 AND renovationyear < openingyear",
             "renovation follows opening"),
            ("Range", "staff_out_of_bounds", "staff <= 0 OR staff > 500", "staff is 1 to 500"),
            ("Range", "rating_out_of_bounds", "storerating < 2.0 OR storerating > 5.0", "rating is 2.0 to 5.0")),
        not_null(pr, "promoid"),
        *rows(
            pr, False,
            ("Range", "discount_pct_outside_0_0_45", "discount_pct < 0 OR discount_pct > 0.45",
             "discount is 0 to 0.45"),
            ("Range", "discount_fixed_negative", "discount_fixed < 0", "fixed discount is not negative"),
            ("Range", "redemption_rate_outside_0_1", "redemption_rate < 0 OR redemption_rate > 1",
             "redemption rate is a fraction")),
        *rows(
            pr, True,
            ("Logical", "startdate_after_enddate", "startdate > enddate", "starts before it ends"),
            ("Logical", "ended_but_active", f"enddate < {today} AND isactive = 1", "ended promotions are inactive")),
        unique(pr, "promoname", "duplicate_promoname", "promotion name is unique", real_only=True),
        *rows(
            f, False,
            ("Financial", "net_calculation_error",
             "abs(net - (grossvalue - discountamount + taxamount)) > 0.01", "net = gross - discount + tax"),
            ("Range", "unitprice_out_of_bounds", "unitprice > 3000 OR unitprice < 0", "price is 0 to 3000"),
            ("Range", "tax_rate_outside_0_1", "tax_rate < 0 OR tax_rate > 1", "tax rate is a fraction"),
            ("Logical", "return_positive_net", "isreturn = 1 AND net > 0", "returns have no positive net"),
            ("Logical", "nonreturn_negative_net", "isreturn = 0 AND net < 0", "sales have no negative net"),
            ("Logical", "return_positive_gross", "isreturn = 1 AND grossvalue > 0",
             "returns have no positive gross"),
            ("Logical", "nonreturn_has_no_return_reason", "isreturn = 0 AND returnreason <> 'No return'",
             "sales carry no return reason"),
            ("Logical", "return_missing_reason", "isreturn = 1 AND returnreason = 'No return'",
             "returns carry a reason"),
            ("Range", "qty_out_of_bounds", "qty <= 0 OR qty > 50", "quantity is 1 to 50")),
        not_null(f, "hour"),
        *rows(
            f, False,
            ("Range", "hour_out_of_range", "hour < 0 OR hour > 23", "hour is 0 to 23"),
            ("Logical", "deliverydays_zero_for_instore", "channel = 'In-Store' AND deliverydays > 0",
             "in-store sales are not delivered"),
            ("Logical", "deliverydays_positive_for_online", f"channel IN {shipped} AND deliverydays = 0",
             "shipped sales take at least a day"),
            ("Logical", "discount_mismatch", "discountapplied = 1 AND discountamount = 0",
             "a discount flag comes with an amount"),
            ("Logical", "no_discount_but_amount", "discountapplied = 0 AND discountamount <> 0",
             "a discount amount comes with a flag"),
            ("Logical", "shipcost_nonzero_for_instore", "channel = 'In-Store' AND shipcost > 0",
             "in-store sales are not shipped"),
            ("Logical", "shipcost_zero_for_online", f"channel IN {shipped} AND isreturn = 0 AND shipcost = 0",
             "shipped sales have a shipping cost")),
        *[
            Rule(f, "FK", f"invalid_{fk}", f"{fk} has a dimension row", "fk", columns=(fk,))
            for fk in FACT_SALES.fks
        ],
        unique(f, "salesid", "duplicate_salesid", "salesid is unique", group="PK"),
        row_count(f, "fact_row_count", *fact_rows, "fact has the expected number of rows"),
    ]
