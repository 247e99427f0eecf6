"""Facts as declarations: a base table, the lookups that enrich it, and
derived columns.

A lookup lends columns of a table with one row per key (of a dimension: its
open versions) to the rows of the fact, by one left equi-join. Catalyst
broadcasts a side whose size is under ``spark.sql.autoBroadcastJoinThreshold``
and AQE re-plans on the measured size of the shuffled side, so a broadcast is
always behind a size check with a sort-merge join as the other way. A hot key
of a ``large`` lookup can be taken out of that join (``operators.skew``): AQE
splits it only where both sides are shuffled for the join, which a bucketed
fact, or one that keeps its dedup's partitioning, isn't.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import contracts as C
from marquee.operators.scd2 import current
from marquee.operators.skew import hot_keys, lookup_join

TableOf = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Lookup:
    table: str
    key: str
    #: SQL select items over the lookup's row
    carried: tuple[str, ...]
    #: a side that grows with the events
    large: bool = False


@dataclass(frozen=True)
class Fact:
    base: str
    lookups: tuple[Lookup, ...]
    #: name -> SQL expression over the enriched row
    derived: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] = ("*",)


def as_of_now(table: DataFrame) -> DataFrame:
    """A dimension's open versions; any other table as it is."""
    return current(table) if "is_current" in table.columns else table


def enrich(rows: DataFrame, side: DataFrame, lookup: Lookup, hot: DataFrame | None = None) -> DataFrame:
    columns = [*rows.columns, *[c for c in as_of_now(side).selectExpr(*lookup.carried).columns]]
    return lookup_join(rows, as_of_now(side).selectExpr(lookup.key, *lookup.carried), lookup.key, hot).select(*columns)


def build(fact: Fact, table: TableOf, hot_rows: int | None = None) -> DataFrame:
    """``table`` gives the frame of a table's name. With ``hot_rows`` the base
    table's keys of large lookups are counted first, and those with so many
    rows or more are joined apart; meant for base tables that are written."""
    base = as_of_now(table(fact.base))
    rows = base.selectExpr(*fact.columns)
    for lookup in fact.lookups:
        hot = hot_keys(base, lookup.key, hot_rows) if lookup.large and hot_rows else None
        rows = enrich(rows, table(lookup.table), lookup, hot)
    return rows.withColumns({name: F.expr(sql) for name, sql in fact.derived.items()})


def occupied_seats(seat_state: DataFrame) -> DataFrame:
    """Distinct occupied seats per show. The rows of a seat are reduced first,
    so an input with several rows per seat counts it once; that aggregation
    has the seat state's own key, and both steps combine before they shuffle."""
    taken = f"hold_status IN ({', '.join(map(repr, C.OCCUPIED_STATUSES))})"
    seats = seat_state.groupBy("show_id", "seat_no").agg(F.expr(f"bool_or({taken})").alias("taken"))
    return seats.groupBy("show_id").agg(F.expr("count_if(taken AND seat_no IS NOT NULL)").alias("occupied_seats"))


BOOKING_CONTEXT = ("venue_id", "movie_id")

# fixed values: the facts' columns and formulas
FACTS = {
    "fact_bookings": Fact(
        base="silver_bookings",
        lookups=(Lookup("dim_show", "show_id", ("movie_id", "venue_id", "show_time", "base_price"), large=True),),
        derived={
            # only confirmed bookings earn
            "revenue": "CASE booking_status WHEN 'CONFIRMED' THEN total_amount ELSE 0D END",
            "booking_date": "to_date(booking_time)",
        },
    ),
    "fact_payments": Fact(
        base="silver_payments",
        lookups=(
            Lookup("fact_bookings", "booking_id", (*BOOKING_CONTEXT, "booking_status AS booking_status_at_fact_time"), large=True),
        ),
    ),
    "fact_promotion_redemptions": Fact(
        base="silver_promotion_redemptions",
        lookups=(
            Lookup("silver_promotions", "promotion_id", ("code", "discount_type")),
            Lookup("fact_bookings", "booking_id", (*BOOKING_CONTEXT, "revenue AS gross_revenue"), large=True),
        ),
        # greatest() skips NULLs: an unknown booking nets 0 and its gross stays NULL
        derived={"net_revenue": "greatest(gross_revenue - discount_amount, 0D)"},
    ),
    "fact_seat_occupancy": Fact(
        base="dim_show",
        columns=("show_id", "venue_id", "show_time"),
        lookups=(
            Lookup("dim_venue", "venue_id", ("capacity",)),
            Lookup("occupied_seats", "show_id", ("occupied_seats",)),
        ),
        derived={
            "occupied_seats": "coalesce(occupied_seats, 0L)",
            "occupancy_pct": "CASE WHEN capacity > 0 THEN round(coalesce(occupied_seats, 0L) / capacity * 100, 2) END",
        },
    ),
}
