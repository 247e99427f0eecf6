"""Marts as declarations: named metrics over one grouped aggregation.

All metrics of a mart come from one partial + final hash aggregation, so a hot
group is collapsed map-side before the shuffle. A mart with a population has
one row per member of it, whether it has facts or not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.money import MONEY
from marquee.plans.facts import TableOf, as_of_now


def money(column: str) -> str:
    """SQL text of a sum that does not depend on the order of its parts."""
    return f"CAST(sum(CAST({column} AS {MONEY})) AS DOUBLE)"


@dataclass(frozen=True)
class Population:
    table: str
    columns: tuple[str, ...]
    #: metrics that are 0 for a member without facts; others are NULL
    zero: tuple[str, ...]


@dataclass(frozen=True)
class Mart:
    base: str
    by: tuple[str, ...]
    #: name -> aggregate expression
    metrics: Mapping[str, str]
    population: Population | None = None
    #: name -> expression over the finished metrics
    ratios: Mapping[str, str] = field(default_factory=dict)


CANCELLED = "count_if(booking_status = 'CANCELLED')"

# fixed values: the marts' columns and formulas
MARTS = {
    "gold_daily_revenue": Mart(
        base="fact_bookings",
        by=("booking_date", "venue_id"),  # bookings of an unknown venue are a group
        metrics={
            "total_revenue": money("revenue"),
            "cancelled_count": CANCELLED,
            "total_bookings": "count(booking_id)",
            "total_seats_booked": "sum(num_seats)",
        },
    ),
    "gold_promotion_performance": Mart(
        base="fact_promotion_redemptions",
        by=("promotion_id", "code"),
        metrics={
            "total_redemptions": "count(redemption_id)",
            "total_discount_given": money("discount_amount"),
            "total_net_revenue": money("net_revenue"),
        },
    ),
    "gold_user_booking_summary": Mart(
        base="fact_bookings",
        by=("user_id",),
        metrics={
            "total_bookings": "count(booking_id)",
            "lifetime_spend": money("revenue"),
            "cancelled_bookings": CANCELLED,
            "first_booking_date": "min(booking_date)",
            "last_booking_date": "max(booking_date)",
            "avg_seats_per_booking": "avg(num_seats)",
        },
        population=Population("dim_user", ("city", "signup_date"), ("total_bookings", "cancelled_bookings", "lifetime_spend")),
        ratios={"cancellation_rate": "CASE WHEN total_bookings > 0 THEN round(cancelled_bookings / total_bookings, 4) ELSE 0D END"},
    ),
}


def build(mart: Mart, table: TableOf) -> DataFrame:
    """``table`` gives the frame of a table's name."""
    out = table(mart.base).groupBy(*mart.by).agg(*[F.expr(sql).alias(name) for name, sql in mart.metrics.items()])
    if mart.population:
        members = as_of_now(table(mart.population.table)).select(*mart.by, *mart.population.columns)
        out = members.join(out, list(mart.by), "left").fillna(0, list(mart.population.zero))
    return out.withColumns({name: F.expr(sql) for name, sql in mart.ratios.items()})


def top_k(df: DataFrame, k: int, by: Sequence[tuple[str, bool]]) -> DataFrame:
    """First ``k`` rows by ``(column, descending)`` pairs; the last pairs must
    make the order total. Planned as a per-partition top-k plus a k-row merge."""
    order = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in by]
    return df.orderBy(*order).limit(k)


def top_shows_by_occupancy(occupancy: DataFrame, k: int = 10) -> DataFrame:
    return top_k(occupancy, k, [("occupancy_pct", True), ("show_id", False)])


def top_promotions(performance: DataFrame, k: int = 10) -> DataFrame:
    return top_k(performance, k, [("total_net_revenue", True), ("promotion_id", False), ("code", False)])


def top_users_by_spend(summary: DataFrame, k: int = 10) -> DataFrame:
    return top_k(summary, k, [("lifetime_spend", True), ("user_id", False)])


def top_venue_days(revenue: DataFrame, k: int = 10) -> DataFrame:
    return top_k(revenue, k, [("total_revenue", True), ("booking_date", False), ("venue_id", False)])


def venue_history(dim_venue: DataFrame) -> DataFrame:
    return dim_venue.orderBy("venue_id", "effective_start")
