"""Calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import DIM_DATE


def calendar(spark: SparkSession, start: date, end: date, holidays: Sequence[int] = (12, 1, 7)) -> DataFrame:
    """One row per day from ``start`` to ``end``; days in a ``holidays`` month are flagged.

    ``yearweek`` counts Monday weeks from 0, ``yearweeknumber`` is the ISO week next to the
    calendar year; the two disagree around New Year on purpose.
    """
    days = (end - start).days + 1
    d = F.col("fulldate")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    monday_week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7)
    derived = {
        "datekey": year * 10000 + month * 100 + F.dayofmonth(d),
        "fulldate": d,
        "year": year,
        "quarternumber": quarter,
        "quartername": F.concat(F.lit("Q"), quarter),
        "monthnumber": month,
        "monthname": F.date_format(d, "MMMM"),
        "weekdaynumber": F.weekday(d) + 1,
        "weekdayname": F.date_format(d, "EEEE"),
        "isweekend": F.weekday(d) >= 5,
        "yearmonth": F.date_format(d, "yyyy-MM"),
        "yearmonthnumber": year * 100 + month,
        "yearquarter": F.concat(year, F.lit("-Q"), quarter),
        "yearquarternumber": year * 10 + quarter,
        "yearweek": F.concat(year, F.lit("-W"), F.lpad(monday_week.cast("string"), 2, "0")),
        "yearweeknumber": year * 100 + F.weekofyear(d),
        "isholiday": month.isin(*holidays),
    }
    dates = spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("fulldate")
    )
    return dates.select(*[derived[c].cast(t).alias(c) for c, t in DIM_DATE.clean_types.items()])
