"""Declared contracts of the nine landed entities.

Fixed values that must equal the source system's: field names and order,
the allowed status sets and the source-system tags. Keys are bigint because
the landed rows are derived from the test tables; timestamps are
``timestamp_ntz`` (ISO strings without a zone in the landing files).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TS = TimestampNTZType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- fixed values: entity contracts (name, type, declared nullable) ---------
USERS = _schema(
    ("user_id", LongType(), False), ("name", StringType(), True), ("email", StringType(), True),
    ("phone", StringType(), True), ("city", StringType(), True), ("signup_date", TS, True),
    ("updated_at", TS, False),
)
VENUES = _schema(
    ("venue_id", LongType(), False), ("venue_name", StringType(), True), ("city", StringType(), True),
    ("state", StringType(), True), ("capacity", IntegerType(), True), ("updated_at", TS, False),
)
MOVIES = _schema(
    ("movie_id", StringType(), False), ("title", StringType(), True), ("genre", StringType(), True),
    ("language", StringType(), True), ("duration_min", IntegerType(), True), ("release_date", TS, True),
    ("updated_at", TS, False),
)
SHOWS = _schema(
    ("show_id", LongType(), False), ("movie_id", StringType(), False), ("venue_id", LongType(), False),
    ("screen_no", IntegerType(), True), ("show_time", TS, False), ("base_price", DoubleType(), True),
    ("updated_at", TS, False),
)
BOOKINGS = _schema(
    ("booking_id", LongType(), False), ("user_id", LongType(), False), ("show_id", LongType(), False),
    ("num_seats", IntegerType(), True), ("total_amount", DoubleType(), True),
    ("booking_status", StringType(), True), ("booking_time", TS, False), ("updated_at", TS, False),
    ("is_deleted", BooleanType(), True),
)
PAYMENTS = _schema(
    ("payment_id", LongType(), False), ("booking_id", LongType(), False), ("amount", DoubleType(), True),
    ("payment_method", StringType(), True), ("payment_status", StringType(), True),
    ("payment_time", TS, False), ("updated_at", TS, False),
)
SEAT_HOLDS = _schema(
    ("hold_id", LongType(), False), ("show_id", LongType(), False), ("seat_no", StringType(), False),
    ("user_id", LongType(), True), ("hold_status", StringType(), True), ("held_at", TS, False),
    ("updated_at", TS, False),
)
PROMOTIONS = _schema(
    ("promotion_id", LongType(), False), ("code", StringType(), True), ("discount_type", StringType(), True),
    ("discount_value", DoubleType(), True), ("valid_from", TS, True), ("valid_to", TS, True),
    ("status", StringType(), True), ("updated_at", TS, False),
)
PROMOTION_REDEMPTIONS = _schema(
    ("redemption_id", LongType(), False), ("promotion_id", LongType(), False),
    ("booking_id", LongType(), False), ("discount_amount", DoubleType(), True), ("redeemed_at", TS, False),
    ("updated_at", TS, False),
)

# --- fixed values: allowed domains ------------------------------------------
BOOKING_STATUSES = ("CONFIRMED", "CANCELLED", "PENDING")
HOLD_STATUSES = ("HELD", "BOOKED", "RELEASED", "EXPIRED")
OCCUPIED_STATUSES = ("HELD", "BOOKED")
DISCOUNT_TYPES = ("PERCENT", "FLAT")
PROMOTION_STATUSES = ("ACTIVE", "EXPIRED", "DISABLED")

# --- fixed values: source-system tag per entity (one table for all paths) ---
SOURCE_SYSTEMS = {
    "users": "user_service",
    "venues": "venue_service",
    "movies": "catalog_service",
    "shows": "show_service",
    "bookings": "booking_oltp_cdc",
    "payments": "payment_gateway",
    "seat_holds": "seat_lock_service",
    "promotions": "promotions_engine",
    "promotion_redemptions": "promotions_engine",
}

CONTRACTS = {
    "users": USERS,
    "venues": VENUES,
    "movies": MOVIES,
    "shows": SHOWS,
    "bookings": BOOKINGS,
    "payments": PAYMENTS,
    "seat_holds": SEAT_HOLDS,
    "promotions": PROMOTIONS,
    "promotion_redemptions": PROMOTION_REDEMPTIONS,
}

# business key per entity (seat holds carry state per seat, not per hold)
KEYS = {
    "users": ["user_id"],
    "venues": ["venue_id"],
    "movies": ["movie_id"],
    "shows": ["show_id"],
    "bookings": ["booking_id"],
    "payments": ["payment_id"],
    "seat_holds": ["show_id", "seat_no"],
    "promotions": ["promotion_id"],
    "promotion_redemptions": ["redemption_id"],
}


def version_order(entity: str) -> list[str]:
    """Columns that order versions of one key, newest first.

    ``updated_at`` decides; the remaining contract columns break its ties so
    the winner is the same in every engine and on every re-run. Rows that tie
    on all of them are identical, so which one survives does not matter.
    """
    names = [f.name for f in CONTRACTS[entity].fields]
    keys = set(KEYS[entity])
    return ["updated_at"] + [n for n in names if n != "updated_at" and n not in keys]
