"""The rule engine: clean data passes, one bad row trips exactly its rule."""

from datetime import date

import pytest
from fixtures import table, tiny_star
from pyspark.sql import functions as F

from starmart.operators import keys
from starmart.operators.calendar import calendar
from starmart.quality import engine
from starmart.quality.rules import catalogue
from starmart.schemas import TABLES
from starmart.sources.star import Star

AS_OF = date(2023, 12, 31)
RULES = catalogue(AS_OF, "2023-01-01", fact_rows=(1, 3))


def star_with(spark, changes: dict[str, list[dict]] | None = None, tables=None):
    changes = changes or {}
    rows = {t: changes.get(t, [{}]) for t in TABLES}
    return tiny_star(spark, rows["fact_sales"], rows["dim_product"], rows["dim_store"], rows["dim_customer"],
                     rows["dim_promotion"], tables=tables)


def failing(star):
    return {(r["table_name"], r["check_name"]): r["status"] for r in engine.check(star, RULES).collect()
            if r["status"] != "PASS"}


def test_there_are_64_rules():
    assert len(RULES) == 64 and len({(r.table, r.name) for r in RULES}) == 64


def test_clean_data_passes(spark):
    star = star_with(spark)
    results = engine.check(star, RULES)
    assert failing(star) == {}
    assert results.columns == list(engine.RESULT_COLUMNS)
    assert engine.verdict(results).first()["verdict"] == "PASSED"
    assert engine.problems(results).count() == 0


C, P, S, PR, FS = "dim_customer", "dim_product", "dim_store", "dim_promotion", "fact_sales"
RETURN = dict(isreturn=1, returnreason="Other", grossvalue=-100, discountamount=-10, taxamount="-18.90", net="-108.90")
MUTANTS = [
    (C, [dict(customerid=1), dict(customerid=None, email="n@example.com")], "customerid_null"),
    (C, [dict(customerid=1), dict(customerid=2)], "duplicate_email"),
    (C, [dict(age=17)], "age_out_of_bounds"),
    (C, [dict(gender="X")], "invalid_gender"),
    (C, [dict(tier="Tin")], "invalid_tier"),
    (C, [dict(regdate="2024-01-01")], "regdate_future"),
    (C, [dict(totalspend=-1)], "negative_totalspend"),
    (C, [dict(tier="Platinum", annualincome=69999)], "tier_income_mismatch"),
    (C, [dict(tier="Bronze", annualincome=100001)], "bronze_high_income"),
    (P, [dict(productid=1), dict(productid=None, name="N")], "productid_null"),
    (P, [dict(productid=1), dict(productid=2)], "duplicate_name"),
    (P, [dict(unitprice=0, unitcost=0)], "unitprice_le_0"),
    (P, [dict(unitcost=-1)], "unitcost_negative"),
    (P, [dict(unitcost=11, margin_pct="0.1")], "unitcost_gt_unitprice_pos_margin"),
    (P, [dict(margin_pct="0.31")], "margin_pct_outside_range"),
    (P, [dict(tax_rate="1.1")], "tax_rate_outside_0_1"),
    (P, [dict(category="Toys")], "invalid_category"),
    (P, [dict(warrantymonths=12)], "warranty_months_positive"),
    (P, [dict(isdiscontinued=1)], "discontinued_but_active"),
    (S, [dict(storeid=1), dict(storeid=None, storename="N")], "storeid_null"),
    (S, [dict(storeid=1), dict(storeid=2)], "duplicate_storename"),
    (S, [dict(renovationyear=1999)], "renovation_before_opening"),
    (S, [dict(staff=501)], "staff_out_of_bounds"),
    (S, [dict(storerating="1.9")], "rating_out_of_bounds"),
    (PR, [dict(promoid=1), dict(promoid=None, promoname="N")], "promoid_null"),
    (PR, [dict(discount_pct="0.46")], "discount_pct_outside_0_0_45"),
    (PR, [dict(discount_fixed=-1)], "discount_fixed_negative"),
    (PR, [dict(startdate="2023-03-02")], "startdate_after_enddate"),
    (PR, [dict(isactive=1)], "ended_but_active"),
    (PR, [dict(redemption_rate="1.1")], "redemption_rate_outside_0_1"),
    (PR, [dict(promoid=1), dict(promoid=2)], "duplicate_promoname"),
    (FS, [dict(net="109.00")], "net_calculation_error"),
    (FS, [dict(unitprice=3001)], "unitprice_out_of_bounds"),
    (FS, [dict(tax_rate="-0.1")], "tax_rate_outside_0_1"),
    (FS, [{**RETURN, "net": "1.10", "taxamount": "91.10"}], "return_positive_net"),
    (FS, [dict(net="-10.00", taxamount="-100.00")], "nonreturn_negative_net"),
    (FS, [{**RETURN, "grossvalue": 10, "discountamount": 20, "taxamount": 0, "net": -10}], "return_positive_gross"),
    (FS, [dict(returnreason="Other")], "nonreturn_has_no_return_reason"),
    (FS, [{**RETURN, "returnreason": "No return"}], "return_missing_reason"),
    (FS, [dict(qty=51)], "qty_out_of_bounds"),
    (FS, [dict(hour=None)], "hour_null"),
    (FS, [dict(hour=24)], "hour_out_of_range"),
    (FS, [dict(channel="In-Store", shipcost=0)], "deliverydays_zero_for_instore"),
    (FS, [dict(deliverydays=0)], "deliverydays_positive_for_online"),
    (FS, [dict(discountamount=0, net="118.90")], "discount_mismatch"),
    (FS, [dict(discountapplied=0)], "no_discount_but_amount"),
    (FS, [dict(channel="In-Store", deliverydays=0)], "shipcost_nonzero_for_instore"),
    (FS, [dict(shipcost=0)], "shipcost_zero_for_online"),
    (FS, [dict(datekey=20240101)], "invalid_datekey"),
    (FS, [dict(productid=99)], "invalid_productid"),
    (FS, [dict(customerid=99)], "invalid_customerid"),
    (FS, [dict(storeid=None)], "invalid_storeid"),
    (FS, [dict(promoid=99)], "invalid_promoid"),
    (FS, [dict(salesid=1), dict(salesid=1)], "duplicate_salesid"),
    (FS, [dict(salesid=i) for i in range(4)], "fact_row_count"),
]


UNIQUE = {C: "email", P: "name", S: "storename", PR: "promoname", FS: None}


@pytest.mark.parametrize("table_name", [C, P, S, PR, FS])
def test_each_bad_row_trips_one_rule(spark, table_name):
    """All bad rows of a table side by side, each with its own key and name: every rule must
    count exactly one, so no row trips a second rule."""
    pk, label = TABLES[table_name].pk, UNIQUE[table_name]
    rows, expected = [], {}
    for i, (_, mutant, rule) in enumerate(m for m in MUTANTS if m[0] == table_name):
        if rule == "fact_row_count":
            continue
        expected[rule] = 1
        for j, row in enumerate(mutant):
            own = {pk: 1000 + 10 * i + j}
            if label and not rule.startswith("duplicate"):
                own[label] = f"own {i} {j}"
            elif label:
                own[label] = f"own {i}"
            if pk in row and row[pk] is None:
                own[pk] = None
            if rule == "duplicate_salesid":
                own[pk] = 1000
            rows.append({**row, **own})
    if table_name == FS:  # the two rows of one key repeat the key of the first bad row
        expected["duplicate_salesid"] = 2
        expected["fact_row_count"] = 1
    star = star_with(spark, {table_name: rows})
    mine = [r for r in RULES if r.table == table_name]
    got = {r["check_name"]: r["issue_count"] for r in engine.check(star, mine).collect()}
    assert got == expected


def dates(spark, **changes):
    d = calendar(spark, date(2023, 1, 1), AS_OF)
    hit = F.col("datekey") == 20230601
    return d.select(*[F.when(hit, F.expr(changes[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
                      for c in d.columns])


def test_date_rules(spark):
    cases = [
        (dict(datekey="NULL"), {"datekey_null", "duplicate_datekey"}),
        (dict(fulldate="NULL"), {"fulldate_null"}),
        (dict(fulldate="DATE '2022-06-01'", year="2022", isweekend="0"), {"fulldate_out_of_range"}),
        (dict(datekey="20230602"), {"duplicate_datekey"}),
        (dict(isholiday="2"), {"isholiday_invalid"}),
        (dict(monthnumber="7"), {"year_month_mismatch"}),
        (dict(isweekend="1"), {"missing_weekend_flag"}),
    ]
    mine = [r for r in RULES if r.table == "dim_date"]
    for changes, rules in cases:
        star = Star(spark, {"dim_date": dates(spark, **changes)}, AS_OF)
        bad = {r["check_name"] for r in engine.check(star, mine).collect() if r["status"] != "PASS"}
        assert bad == rules


def test_calendar_coverage(spark):
    star = star_with(spark, tables={"dim_date": calendar(spark, date(2023, 1, 1), date(2023, 12, 30))})
    mine = [r for r in RULES if r.table == "dim_date"]
    got = {r["check_name"]: (r["status"], r["actual_value"]) for r in engine.check(star, mine).collect()}
    assert got["date_coverage_end"] == ("FAIL", "2023-12-30") and got["date_row_count"] == ("WARN", "364")


def test_a_null_key_counts_as_duplicate_and_orphan(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert tuple(keys.duplicate_count(df, ["k"]).first()) == (5, 3)
    dim = spark.createDataFrame([(1,)], "k int")
    assert keys.orphans(df, {"k": (dim, "k")}).first()["orphan_count"] == 3
    assert keys.rows_with_orphans(df, {"k": (dim, "k")}).first()["orphan_count"] == 3


def test_quick_checks_look_at_special_members(spark):
    star = star_with(spark)
    got = {r["check_name"]: r["issue_count"] for r in engine.fraction_ranges(star).collect()}
    assert got == {"margin_pct": 0, "tax_rate": 0, "discount_pct": 0}


def test_model_contract_reports_issues_first(spark):
    extra = table(spark, "fact_sales", [{"promoid": 99}]).withColumn("coupon", F.lit(1))
    rows = engine.model_contract(star_with(spark, tables={"fact_sales": extra})).collect()
    assert [r["status"] for r in rows] == ["ISSUE", "ISSUE", "OK", "OK"]
    assert {r["check_category"] for r in rows[:2]} == {"fact_columns", "referential_integrity"}


def test_requirements_raise(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    with pytest.raises(ValueError, match="1 duplicate"):
        keys.require_unique(df, ["k"], "t")
    with pytest.raises(ValueError, match=r"v \(1\)"):
        keys.require_no_nulls(df, "t")
    keys.require_unique(df.limit(1), ["k"], "t")


def test_fact_rules_are_one_aggregate(spark):
    star = star_with(spark)
    rules = [r for r in RULES if r.table == FS and r.kind in ("row", "count")]
    plan = engine.check(star, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
