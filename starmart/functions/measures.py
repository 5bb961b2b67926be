"""Named measures of the sales model and safe arithmetic.

Money is summed as DECIMAL (exact, whatever the order of the partial sums); a ratio is
one DOUBLE division of two exact sums, rounded half away from zero where a published
column is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.schemas import SHIPPED_CHANNELS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def revenue() -> Column:
    """Pre-tax revenue of a line (``Star.sales("revenue")``); negative on returns."""
    return F.col("revenue")


def revenue_incl_tax() -> Column:
    return F.col("net")


def is_sale() -> Column:
    return F.col("isreturn") == 0


def is_return() -> Column:
    return F.col("isreturn") == 1


def cost(qty="qty", unitcost="unitcost") -> Column:
    """Quantity times list cost.  Quantities are narrowed to DECIMAL(18,0) first so the
    product keeps both decimals instead of losing scale to a 38-digit cap."""
    return _c(qty).cast("decimal(18,0)") * _c(unitcost)


def total_qty() -> Column:
    return F.sum("qty")


def returns_count() -> Column:
    return F.count_if(is_return())


def ratio(a, b, digits: int | None = None) -> Column:
    """``a / b`` as DOUBLE, NULL when ``b`` is 0 or NULL."""
    value = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return value if digits is None else rounded(value, digits)


def rounded(x, digits: int) -> Column:
    """Round half away from zero.  Going through DECIMAL makes a tie such as 1.005 round
    by its written digits and not by its binary neighbour."""
    return F.round(_c(x).cast("decimal(28,10)"), digits).cast("double")


FIXED_DIGITS = 10


def fixed(x) -> Column:
    """A fraction as a whole number of 10**-FIXED_DIGITS units.  Sums of these are exact, so
    an average of row ratios does not depend on the order the rows are added in."""
    return F.floor(_c(x) * F.lit(10.0**FIXED_DIGITS) + F.lit(0.5)).cast("decimal(20,0)")


def mean_of_fixed(total, n, digits: int | None = None) -> Column:
    """Average from a sum of ``fixed`` values and a count."""
    value = ratio(total, n) / F.lit(10.0**FIXED_DIGITS)
    return value if digits is None else rounded(value, digits)


def clip(x, low, high) -> Column:
    return F.least(F.greatest(_c(x), F.lit(low)), F.lit(high))


def signed(x, returned="isreturn") -> Column:
    """Flip the sign of a measure on returned lines."""
    return F.when(_c(returned) == 1, -_c(x)).otherwise(_c(x))


def nonzero_flag(x, digits: int = 2) -> Column:
    """1 when the value is still non-zero after rounding, else 0."""
    return (F.round(_c(x), digits) != 0).cast("tinyint")


def line_amounts(qty="qty", price="unitprice", discount_pct="discount_pct", tax_rate="tax_rate",
                 weight="weight", channel="channel", returned="isreturn", ship_rate=0.5) -> dict[str, Column]:
    """The money columns of one sales line before any return sign is applied.  Lines of the shipped channels cost
    shipping, unless they are returned."""
    gross = (_c(qty) * _c(price)).cast("decimal(18,2)")
    discount = (gross * _c(discount_pct)).cast("decimal(18,2)")
    tax = ((gross - discount) * _c(tax_rate)).cast("decimal(18,2)")
    shipping = F.when(
        _c(channel).isin(SHIPPED_CHANNELS) & (_c(returned) != 1), _c(weight) * _c(qty) * F.lit(ship_rate).cast("decimal(4,2)")
    ).otherwise(F.lit(0))
    return {
        "grossvalue": gross,
        "discountamount": discount,
        "taxamount": tax,
        "net": (gross - discount + tax).cast("decimal(18,2)"),
        "shipcost": shipping.cast("decimal(18,2)"),
    }
