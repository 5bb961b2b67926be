"""Evaluate rules: one pass per table for all row, count and latest-value rules, one narrow
pass per uniqueness rule, one pass for all foreign keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.keys import duplicate_count, null_profile, orphans, rows_with_orphans
from starmart.quality.rules import Rule
from starmart.schemas import DIMENSIONS, FACT_SALES, SHIPPED_CHANNELS, TABLES
from starmart.sources.star import Star

RESULT_COLUMNS = (
    "table_name", "check_group", "check_name", "description",
    "issue_count", "expected_value", "actual_value", "status",
)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _result(rule: Rule, issues: str, expected: str, actual: str, ok: str) -> str:
    """SQL struct with the columns of a result row; the arguments are SQL expressions."""
    fields = {
        "table_name": _text(rule.table),
        "check_group": _text(rule.group),
        "check_name": _text(rule.name),
        "description": _text(rule.description),
        "issue_count": f"CAST({issues} AS BIGINT)",
        "expected_value": expected,
        "actual_value": f"CAST({actual} AS STRING)",
        "status": f"CASE WHEN {ok} THEN 'PASS' ELSE {_text(rule.severity)} END",
    }
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _zero_issues(rule: Rule, issues: str) -> str:
    return _result(rule, issues, "'0'", issues, f"{issues} = 0")


def _rows(df: DataFrame, results: Sequence[str]) -> DataFrame:
    return df.selectExpr(f"inline(array({', '.join(results)}))")


def _one_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules that are plain aggregates of one scan."""
    aggs, results = [], []
    for i, r in enumerate(rules):
        name = f"c{i}"
        if r.kind == "row":
            scope = f" AND {r.scope}" if r.real_only else ""
            aggs.append(F.expr(f"count_if(({r.condition}){scope}) AS {name}"))
            results.append(_zero_issues(r, name))
        elif r.kind == "count":
            aggs.append(F.expr(f"count(1) AS {name}"))
            ok = f"{name} >= {r.low}" + ("" if r.high is None else f" AND {name} <= {r.high}")
            expected = f">= {r.low}" if r.high is None else f"{r.low}..{r.high}"
            results.append(_result(r, f"CASE WHEN {ok} THEN 0 ELSE 1 END", _text(expected), name, ok))
        elif r.kind == "latest":
            aggs.append(F.expr(f"max({r.columns[0]}) AS {name}"))
            ok = f"coalesce({name} = {r.condition}, FALSE)"
            results.append(_result(
                r, f"CASE WHEN {ok} THEN 0 ELSE 1 END", f"CAST({r.condition} AS STRING)", name, ok))
    return _rows(df.agg(*aggs), results)


def check(star: Star, rules: Sequence[Rule]) -> DataFrame:
    """Result rows of ``rules``, one per rule."""
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == table]
        flat = [r for r in mine if r.kind in ("row", "count", "latest")]
        if flat:
            parts.append(_one_pass(star.table(table), flat))
        for r in (r for r in mine if r.kind == "unique"):
            # Separate and narrow: a distinct count inside the wide aggregate would shuffle
            # every row with all the other counters attached.
            source = star.sales(*r.columns) if table == "fact_sales" else star.table(table)
            if r.real_only:
                source = source.filter(r.scope)
            parts.append(_rows(duplicate_count(source, r.columns), [_zero_issues(r, "duplicates")]))
        fks = {r.columns[0]: r for r in mine if r.kind == "fk"}
        if fks:
            refs = {fk: (star.table(TABLES[table].fks[fk][0]), TABLES[table].fks[fk][1]) for fk in fks}
            counts = orphans(star.sales(*refs), refs)
            whens = " ".join(f"WHEN '{fk}' THEN {_zero_issues(r, 'orphan_count')}" for fk, r in fks.items())
            parts.append(_rows(counts, [f"CASE fk {whens} END"]))
    return reduce(DataFrame.unionByName, parts)


def problems(results: DataFrame) -> DataFrame:
    """Failures and warnings, failures first."""
    rank = F.when(F.col("status") == "FAIL", 0).otherwise(1)
    return results.filter(F.col("status").isin("FAIL", "WARN")).orderBy(
        rank, "table_name", "check_group", "check_name"
    )


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "FAIL").alias("failures"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: whether any check failed, or else whether any warned."""

    def some(status: str) -> Column:
        return F.coalesce(F.bool_or(F.col("status") == status), F.lit(False))

    return results.agg(some("FAIL").alias("has_failures"), some("WARN").alias("has_warnings")).withColumn(
        "verdict", F.when(F.col("has_failures"), "FAILED").when(F.col("has_warnings"), "WARNINGS").otherwise("PASSED")
    )


# --- quick checks --------------------------------------------------------------------------


def table_counts(star: Star, tables: Sequence[str] = tuple(TABLES)) -> DataFrame:
    parts = [
        star.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def key_duplicates(star: Star, tables: Sequence[str] = tuple(TABLES)) -> DataFrame:
    parts = []
    for t in tables:
        pk = TABLES[t].pk
        source = star.sales(pk) if t == "fact_sales" else star.table(t)
        parts.append(duplicate_count(source, [pk]).select(
            F.lit(t).alias("table_name"), F.lit(pk).alias("key_column"), "duplicates"))
    return reduce(DataFrame.unionByName, parts)


def financial_summary(star: Star) -> DataFrame:
    """Totals of sales lines."""
    sales = star.sales("net", "grossvalue", "discountamount", "taxamount", "shipcost", "qty", "isreturn")
    return sales.filter("isreturn = 0").agg(
        F.sum("net").alias("total_net"),
        F.sum("grossvalue").alias("total_gross"),
        F.sum("discountamount").alias("total_discount"),
        F.sum("taxamount").alias("total_tax"),
        F.sum("shipcost").alias("total_shipping"),
        F.sum("qty").alias("total_qty"),
    )


def _labelled(df: DataFrame, conditions: dict[str, str], names=("check_name", "issue_count")) -> DataFrame:
    wide = df.agg(*[F.count_if(F.expr(c)).alias(n) for n, c in conditions.items()])
    return wide.unpivot([], list(conditions), *names)


def fraction_ranges(star: Star) -> DataFrame:
    """Fractions outside their range; special members are looked at as well."""
    product = _labelled(star.product, {
        "margin_pct": "margin_pct < -0.10 OR margin_pct > 0.30",
        "tax_rate": "tax_rate < 0 OR tax_rate > 1",
    })
    promotion = _labelled(star.promotion, {"discount_pct": "discount_pct < 0 OR discount_pct > 0.45"})
    return product.unionByName(promotion)


def hour_checks(star: Star) -> DataFrame:
    return _labelled(star.sales("hour"), {
        "hour_null": "hour IS NULL", "hour_out_of_range": "hour NOT BETWEEN 0 AND 23"})


def return_reason_checks(star: Star) -> DataFrame:
    return _labelled(star.sales("isreturn", "returnreason"), {
        "reason_null": "returnreason IS NULL",
        "sale_with_reason": "isreturn = 0 AND returnreason <> 'No return'",
        "return_without_reason": "isreturn = 1 AND returnreason = 'No return'",
    })


def delivery_checks(star: Star) -> DataFrame:
    """Here any non-zero in-store delivery counts, and shipped returns are looked at too."""
    shipped = ", ".join(f"'{c}'" for c in SHIPPED_CHANNELS)
    return _labelled(star.sales("channel", "deliverydays"), {
        "instore_with_delivery": "channel = 'In-Store' AND deliverydays <> 0",
        "shipped_without_delivery": f"channel IN ({shipped}) AND deliverydays = 0",
    })


def fact_sample(star: Star, n: int = 10) -> DataFrame:
    """First rows by key, for looking at."""
    order = ["salesid", "productid", "storeid", "qty", "grossvalue", "discountamount", "taxamount"]
    return star.sales(*order, "isreturn").orderBy(*order, "isreturn").limit(n)


def mart_summary(mart: DataFrame) -> DataFrame:
    """Rows, revenue and average margin text of the product margin mart."""
    return mart.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("total_revenue").alias("total_revenue"),
        F.concat(F.format_number(F.avg(F.col("margin_pct").cast("decimal(18,4)")) * 100, 2), F.lit("%")).alias(
            "avg_margin"),
    )


def mart_summaries(spark, tables: Sequence[str]) -> DataFrame | None:
    """Row counts of the marts that exist; missing ones are skipped."""
    parts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("mart"), "row_count")
        for t in tables if spark.catalog.tableExists(t)
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


# --- model contract ------------------------------------------------------------------------


def _contract(df: DataFrame, category: str, description: str, issues: Column) -> DataFrame:
    return df.select(
        F.lit(category).alias("check_category"),
        F.lit(description).alias("check_description"),
        F.when(issues == 0, F.lit("OK")).otherwise(F.lit("ISSUE")).alias("status"),
        issues.cast("string").alias("details"),
    )


def model_contract(star: Star) -> DataFrame:
    """Checks of the model itself, issues first."""
    spec = FACT_SALES
    have = set(star.table("fact_sales").columns)
    one = star.spark.range(0, 1, 1, 1)
    missing = [fk for fk in spec.fks if fk not in have]
    extra = [c for c in sorted(have) if c not in spec.names and not c.startswith("_")]
    parts = [
        _contract(one, "fact_foreign_keys", "fact refers to every dimension", F.lit(len(missing))),
        _contract(one, "fact_columns", "fact has no unexpected column", F.lit(len(extra))),
    ]
    bad_keys = None
    for t in DIMENSIONS:
        pk = TABLES[t].pk
        dup = duplicate_count(star.table(t), [pk]).select("duplicates")
        bad_keys = dup if bad_keys is None else bad_keys.unionByName(dup)
    parts.append(_contract(
        bad_keys.agg(F.count_if(F.col("duplicates") > 0).alias("i")),
        "dimension_keys", "every dimension has a unique key without NULLs", F.col("i")))
    refs = {fk: (star.table(t), pk) for fk, (t, pk) in spec.fks.items()}
    parts.append(_contract(
        rows_with_orphans(star.sales(*refs), refs),
        "referential_integrity", "no fact row misses a dimension row", F.col("orphan_count")))
    report = reduce(DataFrame.unionByName, parts)
    first = F.when(F.col("status") == "ISSUE", 0).otherwise(1)
    return report.orderBy(first, "check_category")


def table_nulls(star: Star, table: str) -> DataFrame:
    """NULL counts of every declared column of a table."""
    spec = TABLES[table]
    return null_profile(star.table(table), spec.names).select(F.lit(table).alias("table_name"), "column_name", "nulls")
