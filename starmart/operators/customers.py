"""Customer behaviour: summaries, RFM scores, recency bands, first purchase cohorts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import measures as m
from starmart.functions.banding import Banding
from starmart.operators.ordered import SINGLE_TASK_ROWS, fits_one_task
from starmart.operators.tiles import Ranking, tile_columns
from starmart.sources.scratch import materialize


def customer_summary(sales: DataFrame, product: DataFrame) -> DataFrame:
    """One row per buying customer: last date key, orders, revenue and margin.

    Lines roll up to baskets and baskets to customers.  The middle level does the work of a
    distinct basket count, and its map-side partial sums keep one very large customer from
    landing in a single task.  ``known_orders`` and the money columns cover lines whose
    product is in the dimension; ``orders`` and ``last_key`` cover all lines.
    """
    known = F.col("unitcost").isNotNull()
    lines = sales.join(product.select("productid", "unitcost"), "productid", "left")
    baskets = lines.groupBy("customerid", "salesid").agg(
        F.max("datekey").alias("last_key"),
        F.max(known.cast("int")).alias("known"),
        F.sum(F.when(known, m.revenue())).alias("rev"),
        F.sum(m.cost()).alias("cost"),
    )
    return baskets.groupBy("customerid").agg(
        F.max("last_key").alias("last_key"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("known").cast("long")).alias("known_orders"),
        F.sum("rev").alias("monetary"),
        (F.sum("rev") - F.sum("cost")).alias("margin_total"),
    )


def rfm_scores(
    customers: DataFrame,
    customer: str = "customerid",
    recency: str = "recency",
    frequency: str = "frequency",
    monetary: str = "monetary",
    tiles: int = 5,
    max_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``recency_score``, ``frequency_score``, ``monetary_score`` (higher is better).

    Equal metrics are ordered by customer so that the tiles do not depend on the run.  Beyond ``single_task_rows`` nothing
    is sorted or stored: the tiles' boundaries are selected and each row's tiles read off them.
    """
    rankings = {
        "recency_score": Ranking(recency, descending=True), "frequency_score": Ranking(frequency), "monetary_score": Ranking(monetary),
    }
    if not fits_one_task(max_rows, single_task_rows):
        return customers.withColumns(tile_columns(customers, customer, rankings, tiles))
    return customers.withColumns({
        name: F.ntile(tiles).over(Window.orderBy(F.desc(r.metric) if r.descending else F.asc(r.metric), F.asc(customer)))
        for name, r in rankings.items()
    })


def rfm_segment(r: str = "recency_score", f: str = "frequency_score", mo: str = "monetary_score") -> Column:
    """First matching segment, best customers first."""
    rc, fc, mc = F.col(r), F.col(f), F.col(mo)
    return (
        F.when((rc >= 4) & (fc >= 4), "Champions")
        .when((rc >= 4) & (fc >= 3), "Loyal")
        .when((rc >= 3) & (mc >= 4), "Big Spenders")
        .when((rc <= 2) & (fc <= 2), "At Risk")
        .when(rc == 1, "Lost")
        .otherwise("Other")
    )


def recency(customers: DataFrame, dates: DataFrame, as_of: date, bands: Banding | None = None,
            last_key: str = "last_key") -> DataFrame:
    """Days since the last purchase as of a fixed date, and the band they fall into."""
    days = F.date_diff(F.lit(as_of).cast("date"), F.col("fulldate"))
    out = customers.join(
        dates.select(F.col("datekey").alias(last_key), "fulldate"), last_key, "inner"
    ).withColumn("recency", days)
    if bands is not None:
        out = out.withColumn("recency_segment", bands.of("recency"))
    return out.drop("fulldate")


def rfm(
    sales: DataFrame,
    product: DataFrame,
    dates: DataFrame,
    as_of: date,
    tiles: int = 5,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Customers with recency, frequency, monetary value, margin, scores and segment.

    The customers are stored once: they are read several times for the tiles, and their counted number, not an
    assumption about the dimension, decides how the tiles are computed.
    """
    base = recency(
        customer_summary(sales, product).filter(F.col("known_orders") > 0), dates, as_of
    ).select("customerid", "recency", F.col("orders").alias("frequency"), "monetary", "margin_total")
    stored, n = materialize(base)
    scored = rfm_scores(stored, tiles=tiles, max_rows=n, single_task_rows=single_task_rows)
    return scored.withColumn("segment", rfm_segment())


def new_vs_returning(
    fact: DataFrame,
    value: str = "net",
    customer: str = "customerid",
    day: str = "datekey",
    include_returns: bool = False,
) -> DataFrame:
    """Average line value on a customer's first purchase day and on later days (one row).

    ``include_returns`` decides whether a return can be the first purchase; the averages
    are over sales either way.  Lines are summed to customer-days first, so the window over
    one customer never holds more rows than the calendar has days.
    """
    sale = m.is_sale()
    visits = fact.groupBy(customer, day).agg(
        F.count_if(sale).alias("n"), F.sum(F.when(sale, F.col(value))).alias("v")
    )
    first = F.col(day) if include_returns else F.when(F.col("n") > 0, F.col(day))
    flagged = visits.withColumn("_new", F.col(day) == F.min(first).over(Window.partitionBy(customer)))
    new, old = F.col("_new"), ~F.col("_new")
    return flagged.agg(
        m.ratio(F.sum(F.when(new, F.col("v"))), F.sum(F.when(new, F.col("n")))).alias("avg_new_basket"),
        m.ratio(F.sum(F.when(old, F.col("v"))), F.sum(F.when(old, F.col("n")))).alias("avg_returning_basket"),
    )


def first_and_last(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Smallest and largest ``value`` per key as ``first_<value>`` and ``last_<value>``."""
    return df.groupBy(*key).agg(F.min(value).alias(f"first_{value}"), F.max(value).alias(f"last_{value}"))
