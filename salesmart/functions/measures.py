"""Money measures as column expressions.

Amounts are computed in exact decimal arithmetic: inputs are cast to
``decimal(18,2)`` (rates to ``decimal(5,2)``) *before* multiplying.  Only the
net line amount is rounded to cents per line (half-up), as its definition says;
COGS, Discount and GrossMargin keep the full scale of their products, and a
total is rounded once, at the end.  Sums are exact and independent of the order
in which partial sums meet, so a total is the same on one core and on a
thousand executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed types of the sales mart.
MONEY = "decimal(18,2)"
RATE = "decimal(5,2)"
TOTAL = "decimal(38,2)"
EXACT = "decimal(28,4)"  # a product of money with a quantity or a fraction rate, unrounded
EXACT_TOTAL = "decimal(38,4)"  # sums of unrounded products
EXACT_PERCENT = "decimal(30,6)"  # the same with a percent rate


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast an amount to the money type."""
    return _c(c).cast(MONEY)


def net_factor(rate, rate_unit: str = "fraction") -> Column:
    """``1 - rate`` for a fraction (0.05) or ``1 - pct/100`` for a percent (5.00)."""
    r = _c(rate).cast(RATE)
    if rate_unit == "fraction":
        return F.lit(1) - r
    if rate_unit == "percent":
        return (F.lit(100) - r) * F.lit(0.01).cast("decimal(3,2)")
    raise ValueError(f"rate_unit must be 'fraction' or 'percent', not {rate_unit!r}")


def gross(qty, price) -> Column:
    """Qty * Price, unrounded."""
    return (money(qty) * money(price)).cast(EXACT)


def line_amount(amount=None, discount=None, qty=None, price=None, rate_unit: str = "fraction") -> Column:
    """Net line amount ``CAST(Qty*UnitPrice*(1-Discount) AS DECIMAL(18,2))``.

    Give either ``amount`` (an already multiplied gross) or ``qty`` and ``price``.
    """
    # 26 digits leave room for the four decimals of a percent factor: nothing is rounded before the cast.
    base = money(amount) if amount is not None else (money(qty) * money(price)).cast("decimal(26,4)")
    return (base * net_factor(discount, rate_unit)).cast(MONEY)


def discount_amount(amount, rate, rate_unit: str = "fraction") -> Column:
    """Discount = Gross * rate (fraction) or Gross * pct / 100 (percent), unrounded."""
    r = _c(rate).cast(RATE)
    if rate_unit == "percent":
        return (money(amount) * r * F.lit(0.01).cast("decimal(3,2)")).cast(EXACT_PERCENT)
    if rate_unit != "fraction":
        raise ValueError(f"rate_unit must be 'fraction' or 'percent', not {rate_unit!r}")
    return (money(amount) * r).cast(EXACT)


def with_sales_measures(df, qty, cost, amount, rate, rate_unit: str = "fraction"):
    """Add Gross (money), COGS, Discount and GrossMargin (unrounded) to a sales frame.

    Gross = the sold amount (Qty*Price), COGS = Qty*Cost,
    Discount = Gross*rate, GrossMargin = Gross - COGS.
    """
    return df.withColumns(
        {
            "Gross": money(amount),
            "COGS": gross(qty, cost),
            "Discount": discount_amount(amount, rate, rate_unit),
        }
    ).withColumn("GrossMargin", (F.col("Gross") - F.col("COGS")).cast(EXACT))


def total(c) -> Column:
    """Exact money sum with a fixed result type."""
    return F.sum(_c(c)).cast(TOTAL)


def engagement_rate(views, likes, comments) -> Column:
    """(likes + comments) / views * 100, and 0 when there are no views.

    ``when`` is evaluated lazily, so a zero or NULL view count never reaches
    the division (safe under ANSI mode).
    """
    v = _c(views)
    return (
        F.when(v > 0, (_c(likes) + _c(comments)) / v * 100)
        .otherwise(F.lit(0.0))
        .cast("double")
    )
