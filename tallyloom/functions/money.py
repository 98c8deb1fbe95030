"""Money: doubles are cast to decimal before any arithmetic, results rounded to cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(7,4)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def money(col) -> Column:
    """Amount as ``decimal(18,2)`` (cast before any arithmetic or sum)."""
    return _c(col).cast(MONEY)


def rate(col) -> Column:
    """Discount or tax rate, four places, so that a rate is never cut to cents."""
    return _c(col).cast(RATE)


def cents(col) -> Column:
    """Round a decimal expression to 2 places and present it as a double."""
    return F.round(_c(col), 2).cast("double")


def net_amount(price="l_extendedprice", discount="l_discount") -> Column:
    """price * (1 - discount), in cents."""
    return F.round(money(price) * (F.lit(1) - rate(discount)), 2).cast(MONEY)


def gross_amount(price="l_extendedprice", discount="l_discount", tax="l_tax") -> Column:
    """net * (1 + tax), in cents."""
    return F.round(net_amount(price, discount) * (F.lit(1) + rate(tax)), 2)


def refund(collected, penalty) -> Column:
    """Collected minus penalty, floored at 0; a missing amount counts as 0."""
    diff = F.coalesce(_c(collected), F.lit(0)) - F.coalesce(_c(penalty), F.lit(0))
    return F.greatest(diff, F.lit(0).cast(MONEY))


def second_party(value, first_share, full=100) -> Column:
    """The second buyer's value, hidden (NULL) when the first buyer holds the whole share."""
    return F.when(F.coalesce(_c(first_share), F.lit(0)) < F.lit(full), _c(value))


# The same expressions as SQL text, for the DuckDB oracles.
MONEY_SQL = "CAST({} AS DECIMAL(18,2))"
RATE_SQL = "CAST({} AS DECIMAL(7,4))"
NET_SQL = ("CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - CAST(l_discount AS DECIMAL(7,4)) AS DECIMAL(8,4)), 2) "
           "AS DECIMAL(18,2))")
GROSS_SQL = f"ROUND({NET_SQL} * CAST(1 + CAST(l_tax AS DECIMAL(7,4)) AS DECIMAL(8,4)), 2)"
