"""Money arithmetic.

Amounts are double at the edges (the contracts say so) but are summed as
``decimal(18,2)``, so totals do not depend on the order in which partial
aggregates meet after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def to_money(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def money_sum(col: str | Column) -> Column:
    """Exact sum of a money column, returned as double."""
    return F.sum(to_money(col)).cast("double")
