"""Exact decimal arithmetic for money columns.

Averages and shares are rounded HALF_UP from the exact rational value, computed
on whole cents with integral division (``div``). This avoids rounding twice (once
at the intermediate decimal scale, once to 2 places) and never goes through
doubles. Decimal(38,0) intermediates keep ``20000 * cents`` exact far beyond any
realistic total.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import col

WHOLE = "decimal(38,0)"


def cents(c: Column | str) -> Column:
    """Exact cents of a 2-decimal amount as decimal(38,0)."""
    return (col(c) * 100).cast(WHOLE)


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) HALF_UP (ties away from zero) for whole numbers.

    NULL when ``den`` is 0 or NULL (like ``try_divide``).
    """
    a = (F.abs(num) * 2 + F.abs(den)).cast(WHOLE)
    b = (F.abs(den) * 2).cast(WHOLE)
    whole = F.when(b != 0, F.call_function("div", a, b))
    return F.signum(num).cast("long") * F.signum(den).cast("long") * whole


def avg_half_up(amount: Column | str) -> Column:
    """Aggregate: average of a 2-decimal amount, rounded HALF_UP to 2 places."""
    units = half_up_div(F.sum(cents(amount)), F.count(col(amount)).cast(WHOLE))
    return (units.cast(WHOLE) / 100).cast("decimal(18,2)")


def share_pct_half_up(part: Column | str, total: Column | str) -> Column:
    """100 * part / total rounded HALF_UP to 2 places, as a double."""
    units = half_up_div(cents(part) * 10000, cents(total))
    return (units.cast(WHOLE) / 100).cast("double")
