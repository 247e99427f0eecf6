"""Conform layer: the test tables re-shaped into the nine landed entities.

The test tables hold no NULLs and no dirty values, so the dirty cases the
pipeline must handle (NULL keys and references, negative amounts, unknown or
NULL statuses, tombstones, duplicate versions) are derived by fixed rules.
The same rules are written in DuckDB SQL in ``marquee.plans.oracle``; the two
are compared query by query.

Each entity is one projection per source (``selectExpr``), cast to its
contract, in the contract's column order.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import contracts as C

BASE_TS = "2024-01-01 00:00:00"


class Sources:
    """The test tables of one folder. Each is opened once (file listing and
    footer read happen on the driver), however many entities derive from it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}
        self._lock = threading.Lock()  # plans may be built from several threads

    def __call__(self, table: str) -> DataFrame:
        with self._lock:
            if table not in self._frames:
                self._frames[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
            return self._frames[table]


def _ts(value: str) -> str:
    return f"TIMESTAMP_NTZ '{value}'"


def _project(df: DataFrame, entity: str, exprs: dict[str, str]) -> DataFrame:
    """One projection: every contract field from its SQL expression, cast to
    the contract type."""
    fields = C.CONTRACTS[entity].fields
    return df.selectExpr(*[f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])


def _union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


LINE_KEY = "l_orderkey * 10 + l_linenumber"


def bookings(src: Sources) -> DataFrame:
    rows = src("lineitem").join(src("orders"), F.expr("l_orderkey = o_orderkey"))
    return _project(rows, "bookings", {
        "booking_id": f"CASE WHEN l_linenumber = 7 AND l_discount = 0.07 THEN NULL ELSE {LINE_KEY} END",
        "user_id": "CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' AND l_discount = 0 THEN NULL ELSE o_custkey END",
        # some bookings name a show that does not exist
        "show_id": "CASE WHEN l_partkey % 50 = 7 THEN l_partkey + 10000000 ELSE l_partkey END",
        "num_seats": "l_quantity",
        "total_amount": "CASE WHEN l_linenumber = 1 AND l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END",
        "booking_status": """CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'UNKNOWN'
            WHEN l_linenumber = 6 AND l_discount = 0.1 THEN NULL
            WHEN l_returnflag = 'A' THEN 'CONFIRMED'
            WHEN l_returnflag = 'R' THEN 'CANCELLED'
            WHEN l_returnflag = 'N' THEN 'PENDING' END""",
        "booking_time": "o_orderdate",
        "updated_at": "l_shipdate",
        "is_deleted": "CASE WHEN l_tax = 0.08 THEN NULL ELSE l_tax = 0 END",
    })


def payments(src: Sources) -> DataFrame:
    return _project(src("lineitem"), "payments", {
        "payment_id": f"CASE WHEN l_linenumber = 6 AND l_discount = 0.02 THEN NULL ELSE {LINE_KEY} END",
        "booking_id": f"CASE WHEN l_linenumber = 3 AND l_discount = 0.05 THEN NULL ELSE {LINE_KEY} END",
        "amount": "CASE WHEN l_linenumber = 4 AND l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END",
        "payment_method": "CASE l_linenumber % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'UPI' ELSE 'WALLET' END",
        "payment_status": """CASE WHEN l_linestatus = 'O' THEN ' pending '
            WHEN l_returnflag = 'R' THEN ' refunded' ELSE 'Success ' END""",
        "payment_time": "l_shipdate",
        "updated_at": "l_shipdate",
    })


def _email(key: str) -> str:
    return (f"CASE WHEN {key} % 97 = 0 THEN concat('user', CAST({key} AS STRING), '.example.com') "
            f"WHEN {key} % 83 = 0 THEN concat('user', CAST({key} AS STRING), char(10), 'name@example.com') "
            f"ELSE concat('user', CAST({key} AS STRING), '@example.com') END")


def _phone(key: str) -> str:
    return (f"CASE WHEN {key} % 89 = 0 THEN CAST({key} % 100 AS STRING) "
            f"ELSE concat('+91', lpad(CAST({key} AS STRING), 10, '0')) END")


def users(src: Sources) -> DataFrame:
    cust = src("customer")

    def customer_rows(where: str, user_id: str, city: str, updated: str) -> DataFrame:
        return _project(cust.filter(where), "users", {
            "user_id": user_id,
            "name": "c_name",
            "email": _email("c_custkey"),
            "phone": _phone("c_custkey"),
            "city": city,
            "signup_date": f"timestampadd(DAY, c_custkey % 365, {_ts('2023-01-01 00:00:00')})",
            "updated_at": _ts(updated),
        })

    city = "concat('City-', CAST(c_nationkey AS STRING))"
    key = "(CAST(n_nationkey AS BIGINT) + 900000)"
    never_booked = _project(src("nation"), "users", {
        "user_id": key,
        "name": "n_name",
        "email": _email(key),
        "phone": _phone(key),
        "city": "n_name",
        "signup_date": _ts("2023-01-01 00:00:00"),
        "updated_at": _ts(BASE_TS),
    })
    return _union(
        customer_rows("true", "c_custkey", city, BASE_TS),
        customer_rows("c_custkey % 10 = 0", "c_custkey",
                      "concat('City-', CAST((c_nationkey + 1) % 25 AS STRING))", "2024-01-02 00:00:00"),
        customer_rows("c_custkey = 1", "NULL", city, "2024-01-03 00:00:00"),
        never_booked,
    )


def venues(src: Sources) -> DataFrame:
    sup = src("supplier")

    def venue_rows(where: str, venue_id: str, name: str, updated: str) -> DataFrame:
        return _project(sup.filter(where), "venues", {
            "venue_id": venue_id,
            "venue_name": name,
            "city": "concat('City-', CAST(s_nationkey AS STRING))",
            "state": "concat('State-', CAST(s_nationkey % 5 AS STRING))",
            "capacity": "120 + (s_suppkey % 4) * 60",
            "updated_at": _ts(updated),
        })

    return _union(
        venue_rows("true", "s_suppkey", "s_name", BASE_TS),
        venue_rows("s_suppkey % 10 = 0", "s_suppkey", "concat(s_name, ' (renovated)')", "2024-01-02 00:00:00"),
        venue_rows("s_suppkey = 1", "NULL", "s_name", "2024-01-03 00:00:00"),
    )


def shows(src: Sources) -> DataFrame:
    part = src("part")

    def show_rows(where: str, show_id: str, price: str, updated: str) -> DataFrame:
        return _project(part.filter(where), "shows", {
            "show_id": show_id,
            "movie_id": "p_brand",
            "venue_id": "p_partkey % 110",
            "screen_no": "p_size % 10 + 1",
            "show_time": f"timestampadd(HOUR, p_partkey % 720, {_ts('2024-02-01 10:00:00')})",
            "base_price": price,
            "updated_at": _ts(updated),
        })

    return _union(
        show_rows("true", "p_partkey", "p_retailprice", BASE_TS),
        show_rows("p_partkey % 10 = 0", "p_partkey", "p_retailprice + 10.0D", "2024-01-02 00:00:00"),
        show_rows("p_partkey = 1", "NULL", "p_retailprice", "2024-01-03 00:00:00"),
    )


def movies(src: Sources) -> DataFrame:
    return _project(src("part"), "movies", {
        "movie_id": "p_brand",
        "title": "p_name",
        "genre": "p_type",
        "language": "CASE p_partkey % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'HI' WHEN 2 THEN 'TA' ELSE 'TE' END",
        "duration_min": "p_size + 90",
        "release_date": f"timestampadd(DAY, -p_size, {_ts('2023-06-01 00:00:00')})",
        "updated_at": f"timestampadd(MINUTE, p_partkey, {_ts(BASE_TS)})",
    })


def seat_holds(src: Sources) -> DataFrame:
    return _project(src("events"), "seat_holds", {
        "hold_id": "event_id",
        "show_id": "user_id",
        "seat_no": "get_json_object(props, '$.k')",
        "user_id": "event_id % 1000",
        "hold_status": """CASE event_type WHEN 'view' THEN 'HELD' WHEN 'purchase' THEN 'BOOKED'
            WHEN 'click' THEN 'RELEASED' WHEN 'signup' THEN 'EXPIRED'
            WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'UNKNOWN' END END""",
        "held_at": "ts",
        "updated_at": "ts",
    })


def promotions(src: Sources) -> DataFrame:
    return _project(src("supplier"), "promotions", {
        "promotion_id": "s_nationkey",
        "code": "s_name",
        "discount_type": "CASE WHEN s_suppkey % 5 = 0 THEN 'MYSTERY' WHEN s_suppkey % 5 <= 2 THEN 'FLAT' ELSE 'PERCENT' END",
        "discount_value": "s_acctbal",
        "valid_from": f"timestampadd(DAY, s_suppkey % 30, {_ts(BASE_TS)})",
        "valid_to": f"timestampadd(DAY, s_suppkey % 30 + 60, {_ts(BASE_TS)})",
        "status": """CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'DISABLED' WHEN 2 THEN 'EXPIRED'
            ELSE 'ACTIVE' END""",
        "updated_at": f"timestampadd(MINUTE, s_suppkey, {_ts(BASE_TS)})",
    })


def promotion_redemptions(src: Sources) -> DataFrame:
    share = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))"
    return _project(src("lineitem").filter("l_discount > 0"), "promotion_redemptions", {
        "redemption_id": f"CASE WHEN l_linenumber = 7 AND l_discount = 0.04 THEN NULL ELSE {LINE_KEY} END",
        "promotion_id": "CASE WHEN l_linenumber = 5 AND l_discount = 0.03 THEN NULL ELSE l_suppkey % 25 END",
        "booking_id": LINE_KEY,
        "discount_amount": f"""CASE WHEN l_discount = 0.1 THEN l_extendedprice * 2
            WHEN l_discount = 0.09 THEN -1.0D ELSE CAST({share} AS DOUBLE) END""",
        "redeemed_at": "l_shipdate",
        "updated_at": "l_shipdate",
    })


ENTITIES = {
    "users": users,
    "venues": venues,
    "movies": movies,
    "shows": shows,
    "bookings": bookings,
    "payments": payments,
    "seat_holds": seat_holds,
    "promotions": promotions,
    "promotion_redemptions": promotion_redemptions,
}


def landed(spark: SparkSession, sf_dir: str, entity: str, src: Sources | None = None) -> DataFrame:
    return ENTITIES[entity](src or Sources(spark, sf_dir))


def _replaced(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{exprs[c]} AS {c}" if c in exprs else c for c in df.columns])


def venues_next_snapshot(silver_venues: DataFrame) -> DataFrame:
    """Second full venue snapshot for the SCD2 merge: some venues gone,
    some with +60 capacity, some new ids."""
    kept = _replaced(
        silver_venues.filter("venue_id % 17 <> 3"),
        {"capacity": "CASE WHEN venue_id % 10 = 0 THEN capacity + 60 ELSE capacity END"},
    )
    added = _replaced(silver_venues.filter("venue_id % 25 = 0"), {"venue_id": "venue_id + 100000"})
    return kept.unionByName(added)


def venues_third_snapshot(next_snapshot: DataFrame) -> DataFrame:
    """Third snapshot: some capacities change a second time, some names change."""
    return _replaced(next_snapshot, {
        "capacity": "CASE WHEN venue_id % 20 = 0 THEN capacity + 30 ELSE capacity END",
        "venue_name": "CASE WHEN venue_id % 9 = 4 THEN concat(venue_name, ' II') ELSE venue_name END",
    })


def shows_next_snapshot(silver_shows: DataFrame) -> DataFrame:
    """Prices and screens change, untracked times change, some shows are gone,
    some are new."""
    kept = _replaced(silver_shows.filter("show_id % 23 <> 5"), {
        "base_price": "CASE WHEN show_id % 9 = 0 THEN base_price + 25.0D ELSE base_price END",
        "screen_no": "CASE WHEN show_id % 14 = 1 THEN CAST(NULL AS INT) ELSE screen_no END",
        "show_time": "CASE WHEN show_id % 8 = 2 THEN show_time + INTERVAL 1 HOUR ELSE show_time END",
    })
    return kept.unionByName(_replaced(silver_shows.filter("show_id % 40 = 0"), {"show_id": "show_id + 5000000"}))


def shows_third_snapshot(next_snapshot: DataFrame) -> DataFrame:
    """Third snapshot: some prices change a second time, some screens change."""
    return _replaced(next_snapshot, {
        "base_price": "CASE WHEN show_id % 18 = 0 THEN base_price + 5.0D ELSE base_price END",
        "screen_no": "CASE WHEN show_id % 7 = 3 THEN 99 ELSE screen_no END",
    })


def users_next_snapshot(silver_users: DataFrame) -> DataFrame:
    """Cities and names change, untracked phones change, nobody is gone."""
    return _replaced(silver_users, {
        "city": "CASE WHEN user_id % 11 = 0 THEN concat(city, ' North') ELSE city END",
        "name": "CASE WHEN user_id % 31 = 2 THEN CAST(NULL AS STRING) ELSE name END",
        "phone": "CASE WHEN user_id % 13 = 0 THEN '+440000000000' ELSE phone END",
    })
