"""The table catalog: one lazily built DataFrame per table of the lakehouse.

``Tables`` wires the pure builders together over one input (the conform
layer over a test-table folder, or any bronze frames passed in). Each table
is built once per ``Tables`` object, so a query that needs several tables
shares their common lineage inside one plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marquee.operators import scd2
from marquee.operators.quality import expect
from marquee.plans import facts, marts, silver
from marquee.sources import conform
from marquee.sources.landing import bronze as add_bronze_metadata

# fixed run times used wherever results are compared
INGESTED_AT = "2024-06-01 00:00:00"
DIM_AS_OF = "2024-06-01 00:00:00"
MERGE_AS_OF = "2024-07-01 00:00:00"
THIRD_AS_OF = "2024-08-01 00:00:00"

# run times of a dimension history that lies within the time of the bookings
TIMELINE = ("1995-06-01 00:00:00", "1997-06-01 00:00:00", "1999-06-01 00:00:00")

ENTITIES = ("users", "venues", "movies", "shows", "bookings", "payments", "seat_holds", "promotions",
            "promotion_redemptions")

# fixed values: SCD2 key and tracked columns per dimension
DIMENSIONS = {
    "dim_venue": ("venues", "venue_id", ["capacity", "venue_name"]),
    "dim_show": ("shows", "show_id", ["base_price", "screen_no"]),
    "dim_user": ("users", "user_id", ["city", "name"]),
}


LAYER_TABLES = (
    [("bronze", f"bronze_{e}") for e in ENTITIES]
    + [("silver", t) for t in (
        "silver_users", "silver_venues", "silver_movies", "silver_shows", "silver_bookings", "quarantine_bookings",
        "silver_payments", "quarantine_payments", "silver_seat_holds", "quarantine_seat_holds",
        "silver_promotions", "quarantine_promotions", "silver_promotion_redemptions", "quarantine_redemptions",
        "quarantine_users", "quarantine_venues", "quarantine_movies", "quarantine_shows")]
    + [("gold", t) for t in (
        "dim_venue", "dim_show", "dim_user", "fact_bookings", "fact_payments", "gold_daily_revenue",
        "fact_seat_occupancy", "fact_promotion_redemptions", "gold_promotion_performance",
        "gold_user_booking_summary")]
)


class Tables:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        bronze_frames: dict[str, DataFrame] | None = None,
        ingested_at: str | None = INGESTED_AT,
        as_of: str = DIM_AS_OF,
        prebuilt: dict[str, DataFrame] | None = None,
        hot_rows: int | None = None,
    ) -> None:
        """``prebuilt`` supplies tables already materialised (read back from
        snapshots); anything built on top of them starts from there.
        ``hot_rows``: see ``facts.build``."""
        self.hot_rows = hot_rows
        self.spark = spark
        self.sf_dir = sf_dir
        self.ingested_at = ingested_at
        self.as_of = as_of
        self._bronze = dict(bronze_frames or {})
        self._sources = conform.Sources(spark, sf_dir) if sf_dir else None
        self.__dict__.update(prebuilt or {})

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    # --- bronze ---------------------------------------------------------
    def landed(self, entity: str) -> DataFrame:
        return conform.landed(self.spark, self.sf_dir, entity, self._sources)

    def bronze(self, entity: str) -> DataFrame:
        if entity not in self._bronze:
            self._bronze[entity] = add_bronze_metadata(self.landed(entity), entity, self.ingested_at)
        return self._bronze[entity]

    # --- silver ---------------------------------------------------------
    def before_expectations(self, table: str) -> DataFrame:
        """A silver table as its build function returns it, before the
        table's declared expectations drop rows."""
        built = {
            "silver_bookings": lambda: self._bookings[0],
            "silver_payments": lambda: self._payments[0],
            "silver_seat_holds": lambda: self._seat_holds[0],
            "silver_promotion_redemptions": lambda: self._redemptions[0],
        }
        return built[table]()

    def _expected(self, table: str) -> DataFrame:
        return expect(self.before_expectations(table), silver.EXPECTATIONS[table])

    @cached_property
    def latest_bookings(self) -> DataFrame:
        return silver.latest_bookings(self.bronze("bookings"))

    @cached_property
    def _bookings(self) -> tuple[DataFrame, DataFrame]:
        return silver.clean_bookings(self.bronze("bookings"))

    @cached_property
    def silver_bookings(self) -> DataFrame:
        return self._expected("silver_bookings")

    @cached_property
    def quarantine_bookings(self) -> DataFrame:
        return self._bookings[1]

    @cached_property
    def silver_payments(self) -> DataFrame:
        return self._expected("silver_payments")

    @cached_property
    def _payments(self) -> tuple[DataFrame, DataFrame]:
        return silver.clean_payments(self.bronze("payments"))

    @cached_property
    def quarantine_payments(self) -> DataFrame:
        return self._payments[1]

    @cached_property
    def _redemptions(self) -> tuple[DataFrame, DataFrame]:
        return silver.clean_redemptions(self.bronze("promotion_redemptions"))

    @cached_property
    def quarantine_redemptions(self) -> DataFrame:
        return self._redemptions[1]

    def silver_dimension(self, entity: str) -> DataFrame:
        return silver.clean_dimension(self.bronze(entity), entity)[0]

    @cached_property
    def silver_users(self) -> DataFrame:
        return self.silver_dimension("users")

    @cached_property
    def silver_venues(self) -> DataFrame:
        return self.silver_dimension("venues")

    @cached_property
    def silver_movies(self) -> DataFrame:
        return self.silver_dimension("movies")

    @cached_property
    def silver_shows(self) -> DataFrame:
        return self.silver_dimension("shows")

    @cached_property
    def quarantine_users(self) -> DataFrame:
        return silver.clean_dimension(self.bronze("users"), "users")[1]

    @cached_property
    def quarantine_venues(self) -> DataFrame:
        return silver.clean_dimension(self.bronze("venues"), "venues")[1]

    @cached_property
    def quarantine_movies(self) -> DataFrame:
        return silver.clean_dimension(self.bronze("movies"), "movies")[1]

    @cached_property
    def quarantine_shows(self) -> DataFrame:
        return silver.clean_dimension(self.bronze("shows"), "shows")[1]

    @cached_property
    def _seat_holds(self) -> tuple[DataFrame, DataFrame]:
        return silver.clean_seat_holds(self.bronze("seat_holds"))

    @cached_property
    def silver_seat_holds(self) -> DataFrame:
        return self._expected("silver_seat_holds")

    @cached_property
    def quarantine_seat_holds(self) -> DataFrame:
        return self._seat_holds[1]

    @cached_property
    def _promotions(self) -> tuple[DataFrame, DataFrame]:
        return silver.clean_promotions(self.bronze("promotions"))

    @cached_property
    def silver_promotions(self) -> DataFrame:
        return self._promotions[0]

    @cached_property
    def quarantine_promotions(self) -> DataFrame:
        return self._promotions[1]

    @cached_property
    def silver_promotion_redemptions(self) -> DataFrame:
        return self._expected("silver_promotion_redemptions")

    # --- dimensions -----------------------------------------------------
    @cached_property
    def dim_venue(self) -> DataFrame:
        return scd2.bootstrap(self.silver_venues, self.as_of)

    @cached_property
    def dim_show(self) -> DataFrame:
        return scd2.bootstrap(self.silver_shows, self.as_of)

    @cached_property
    def dim_user(self) -> DataFrame:
        return scd2.bootstrap(self.silver_users, self.as_of)

    @cached_property
    def venues_next_snapshot(self) -> DataFrame:
        return conform.venues_next_snapshot(self.silver_venues)

    def merged_dim(self, dim: str, on_missing: str = "keep") -> DataFrame:
        """A dimension after its second snapshot."""
        entity, key, tracked = DIMENSIONS[dim]
        snapshot = getattr(conform, f"{entity}_next_snapshot")(self.silver_dimension(entity))
        return scd2.merge(getattr(self, dim), snapshot, key, tracked, MERGE_AS_OF, on_missing)

    def scd2_three_snapshots_venue(self) -> DataFrame:
        """Two merges, so the second one meets closed history."""
        _, key, tracked = DIMENSIONS["dim_venue"]
        third = conform.venues_third_snapshot(self.venues_next_snapshot)
        return scd2.merge(self.merged_dim("dim_venue"), third, key, tracked, THIRD_AS_OF)

    def timeline(self, dim: str) -> DataFrame:
        """A dimension of shows or venues after three snapshots, at ``TIMELINE``."""
        entity, key, tracked = DIMENSIONS[dim]
        first = self.silver_dimension(entity)
        second = getattr(conform, f"{entity}_next_snapshot")(first)
        third = getattr(conform, f"{entity}_third_snapshot")(second)
        out = scd2.bootstrap(first, TIMELINE[0])
        for snapshot, as_of in ((second, TIMELINE[1]), (third, TIMELINE[2])):
            out = scd2.merge(out, snapshot, key, tracked, as_of)
        return out

    # --- facts and marts ------------------------------------------------
    @cached_property
    def fact_bookings(self) -> DataFrame:
        return facts.build(facts.FACTS["fact_bookings"], self.table, self.hot_rows)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return facts.build(facts.FACTS["fact_payments"], self.table, self.hot_rows)

    @cached_property
    def occupied_seats(self) -> DataFrame:
        return facts.occupied_seats(self.silver_seat_holds)

    @cached_property
    def fact_seat_occupancy(self) -> DataFrame:
        return facts.build(facts.FACTS["fact_seat_occupancy"], self.table, self.hot_rows)

    @cached_property
    def fact_promotion_redemptions(self) -> DataFrame:
        return facts.build(facts.FACTS["fact_promotion_redemptions"], self.table, self.hot_rows)

    @cached_property
    def gold_daily_revenue(self) -> DataFrame:
        return marts.build(marts.MARTS["gold_daily_revenue"], self.table)

    @cached_property
    def gold_promotion_performance(self) -> DataFrame:
        return marts.build(marts.MARTS["gold_promotion_performance"], self.table)

    @cached_property
    def gold_user_booking_summary(self) -> DataFrame:
        return marts.build(marts.MARTS["gold_user_booking_summary"], self.table)
