"""Independent SQL statement of every registered query, for DuckDB.

The conform rules, gates and builders are stated here as plain SQL over the
test tables (views ``lineitem``, ``orders``, ...). Nothing is imported from
the Spark side: keys, version orders, rule texts, status sets and run times
are written out, so a rule that is wrong over there does not agree with itself.
"""

from __future__ import annotations

BASE_TS = "2024-01-01 00:00:00"
INGESTED_AT = "2024-06-01 00:00:00"
DIM_AS_OF = "2024-06-01 00:00:00"
MERGE_AS_OF = "2024-07-01 00:00:00"
THIRD_AS_OF = "2024-08-01 00:00:00"

# entity -> (source system, keys, version order after updated_at)
ENTITIES = {
    "users": ("user_service", ["user_id"], ["name", "email", "phone", "city", "signup_date"]),
    "venues": ("venue_service", ["venue_id"], ["venue_name", "city", "state", "capacity"]),
    "movies": ("catalog_service", ["movie_id"], ["title", "genre", "language", "duration_min", "release_date"]),
    "shows": ("show_service", ["show_id"], ["movie_id", "venue_id", "screen_no", "show_time", "base_price"]),
    "bookings": ("booking_oltp_cdc", ["booking_id"],
                 ["user_id", "show_id", "num_seats", "total_amount", "booking_status", "booking_time", "is_deleted"]),
    "payments": ("payment_gateway", ["payment_id"],
                 ["booking_id", "amount", "payment_method", "payment_status", "payment_time"]),
    "seat_holds": ("seat_lock_service", ["show_id", "seat_no"], ["hold_id", "user_id", "hold_status", "held_at"]),
    "promotions": ("promotions_engine", ["promotion_id"],
                   ["code", "discount_type", "discount_value", "valid_from", "valid_to", "status"]),
    "promotion_redemptions": ("promotions_engine", ["redemption_id"],
                              ["promotion_id", "booking_id", "discount_amount", "redeemed_at"]),
}

# gate -> (rule name, predicate); a NULL predicate fails
RULES = {
    "bookings": (
        ("booking_id_present", "booking_id IS NOT NULL"),
        ("user_id_present", "user_id IS NOT NULL"),
        ("show_id_present", "show_id IS NOT NULL"),
        ("num_seats_positive", "num_seats > 0"),
        ("total_amount_non_negative", "total_amount >= 0"),
        ("booking_status_known", "booking_status IN ('CONFIRMED', 'CANCELLED', 'PENDING')"),
    ),
    "payments": (
        ("payment_id_present", "payment_id IS NOT NULL"),
        ("booking_id_present", "booking_id IS NOT NULL"),
        ("amount_non_negative", "amount >= 0"),
    ),
    "seat_holds": (
        ("show_id_present", "show_id IS NOT NULL"),
        ("seat_no_present", "seat_no IS NOT NULL"),
        ("hold_status_known", "hold_status IN ('HELD', 'BOOKED', 'RELEASED', 'EXPIRED')"),
    ),
    "promotions": (
        ("promotion_id_present", "promotion_id IS NOT NULL"),
        ("discount_type_known", "discount_type IN ('PERCENT', 'FLAT')"),
        ("discount_value_positive", "discount_value > 0"),
        ("status_known", "status IN ('ACTIVE', 'EXPIRED', 'DISABLED')"),
    ),
    "promotion_redemptions": (
        ("redemption_id_present", "redemption_id IS NOT NULL"),
        ("promotion_id_present", "promotion_id IS NOT NULL"),
        ("booking_id_present", "booking_id IS NOT NULL"),
        ("discount_amount_non_negative", "discount_amount >= 0"),
    ),
}

EXPECTATIONS = {
    "silver_bookings": (("valid_booking_id", "booking_id IS NOT NULL"), ("valid_amount", "total_amount >= 0")),
    "silver_payments": (("valid_booking_ref", "booking_id IS NOT NULL"),),
    "silver_seat_holds": (("valid_show_and_seat", "show_id IS NOT NULL AND seat_no IS NOT NULL"),),
    "silver_promotion_redemptions": (("valid_refs", "promotion_id IS NOT NULL AND booking_id IS NOT NULL"),),
}

LAYERS = {
    "bronze": [f"bronze_{e}" for e in ENTITIES],
    "silver": ["silver_users", "silver_venues", "silver_movies", "silver_shows", "silver_bookings", "quarantine_bookings",
               "silver_payments", "quarantine_payments", "silver_seat_holds", "quarantine_seat_holds",
               "silver_promotions", "quarantine_promotions", "silver_promotion_redemptions", "quarantine_redemptions",
               "quarantine_users", "quarantine_venues", "quarantine_movies", "quarantine_shows"],
    "gold": ["dim_venue", "dim_show", "dim_user", "fact_bookings", "fact_payments", "gold_daily_revenue",
             "fact_seat_occupancy", "fact_promotion_redemptions", "gold_promotion_performance",
             "gold_user_booking_summary"],
}

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (deps, sql)


def _ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def with_ctes(final: str, *names: str) -> str:
    """``WITH`` every named CTE and its dependencies, in dependency order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in _CTES[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in ordered)
    return f"WITH {body}\n{final}"


def _dedup(src: str, entity: str, null_keys: str) -> str:
    _, keys, rest = ENTITIES[entity]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["updated_at", *rest])
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    sql = (
        f"SELECT * FROM {src} WHERE {keyed}\n"
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
    )
    if null_keys == "bypass":
        sql = f"SELECT * FROM ({sql})\nUNION ALL BY NAME\nSELECT * FROM {src} WHERE NOT ({keyed})"
    return sql


def _ok(rules) -> str:
    return " AND ".join(f"coalesce(({predicate}), false)" for _, predicate in rules)


def _valid(src: str, rules) -> str:
    return f"SELECT * FROM {src} WHERE {_ok(rules)}"


def _quarantined(src: str, rules) -> str:
    reasons = ", ".join(f"CASE WHEN NOT coalesce(({sql}), false) THEN '{name}' END" for name, sql in rules)
    return f"SELECT *, concat_ws(',', {reasons}) AS _dq_failures FROM {src} WHERE NOT ({_ok(rules)})"


def _bronze(entity: str) -> str:
    return (
        f"SELECT *, {_ts(INGESTED_AT)} AS _ingested_at, '{ENTITIES[entity][0]}' AS _source_system "
        f"FROM landed_{entity}"
    )


# --- conform layer ------------------------------------------------------------
_cte("landed_bookings", """SELECT
  CASE WHEN l_linenumber = 7 AND l_discount = 0.07 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS booking_id,
  CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' AND l_discount = 0 THEN NULL ELSE o_custkey END AS user_id,
  CASE WHEN l_partkey % 50 = 7 THEN l_partkey + 10000000 ELSE l_partkey END AS show_id,
  CAST(trunc(l_quantity) AS INTEGER) AS num_seats,
  CASE WHEN l_linenumber = 1 AND l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END AS total_amount,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'UNKNOWN'
       WHEN l_linenumber = 6 AND l_discount = 0.1 THEN NULL
       WHEN l_returnflag = 'A' THEN 'CONFIRMED'
       WHEN l_returnflag = 'R' THEN 'CANCELLED'
       WHEN l_returnflag = 'N' THEN 'PENDING' END AS booking_status,
  o_orderdate AS booking_time,
  l_shipdate AS updated_at,
  CASE WHEN l_tax = 0.08 THEN NULL ELSE l_tax = 0 END AS is_deleted
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

_cte("landed_payments", """SELECT
  CASE WHEN l_linenumber = 6 AND l_discount = 0.02 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS payment_id,
  CASE WHEN l_linenumber = 3 AND l_discount = 0.05 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS booking_id,
  CASE WHEN l_linenumber = 4 AND l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END AS amount,
  CASE l_linenumber % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'UPI' ELSE 'WALLET' END AS payment_method,
  CASE WHEN l_linestatus = 'O' THEN ' pending ' WHEN l_returnflag = 'R' THEN ' refunded' ELSE 'Success ' END AS payment_status,
  l_shipdate AS payment_time,
  l_shipdate AS updated_at
FROM lineitem""")

_EMAIL = "CASE WHEN {k} % 97 = 0 THEN 'user' || CAST({k} AS VARCHAR) || '.example.com' WHEN {k} % 83 = 0 THEN 'user' || CAST({k} AS VARCHAR) || chr(10) || 'name@example.com' ELSE 'user' || CAST({k} AS VARCHAR) || '@example.com' END"
_PHONE = "CASE WHEN {k} % 89 = 0 THEN CAST({k} % 100 AS VARCHAR) ELSE '+91' || lpad(CAST({k} AS VARCHAR), 10, '0') END"


def _user_rows(where: str, user_id: str, city: str, updated: str) -> str:
    k = "c_custkey"
    return f"""SELECT {user_id} AS user_id, c_name AS name, {_EMAIL.format(k=k)} AS email, {_PHONE.format(k=k)} AS phone,
  {city} AS city, TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS signup_date,
  {_ts(updated)} AS updated_at FROM customer WHERE {where}"""


_cte("landed_users", "\nUNION ALL\n".join([
    _user_rows("true", "c_custkey", "'City-' || CAST(c_nationkey AS VARCHAR)", BASE_TS),
    _user_rows("c_custkey % 10 = 0", "c_custkey", "'City-' || CAST((c_nationkey + 1) % 25 AS VARCHAR)", "2024-01-02 00:00:00"),
    _user_rows("c_custkey = 1", "CAST(NULL AS BIGINT)", "'City-' || CAST(c_nationkey AS VARCHAR)", "2024-01-03 00:00:00"),
    f"""SELECT CAST(n_nationkey AS BIGINT) + 900000 AS user_id, n_name AS name,
  {_EMAIL.format(k='(CAST(n_nationkey AS BIGINT) + 900000)')} AS email,
  {_PHONE.format(k='(CAST(n_nationkey AS BIGINT) + 900000)')} AS phone,
  n_name AS city, TIMESTAMP '2023-01-01 00:00:00' AS signup_date, {_ts(BASE_TS)} AS updated_at FROM nation""",
]))


def _venue_rows(where: str, venue_id: str, name: str, updated: str) -> str:
    return f"""SELECT {venue_id} AS venue_id, {name} AS venue_name, 'City-' || CAST(s_nationkey AS VARCHAR) AS city,
  'State-' || CAST(s_nationkey % 5 AS VARCHAR) AS state, CAST(120 + (s_suppkey % 4) * 60 AS INTEGER) AS capacity,
  {_ts(updated)} AS updated_at FROM supplier WHERE {where}"""


_cte("landed_venues", "\nUNION ALL\n".join([
    _venue_rows("true", "s_suppkey", "s_name", BASE_TS),
    _venue_rows("s_suppkey % 10 = 0", "s_suppkey", "s_name || ' (renovated)'", "2024-01-02 00:00:00"),
    _venue_rows("s_suppkey = 1", "CAST(NULL AS BIGINT)", "s_name", "2024-01-03 00:00:00"),
]))


def _show_rows(where: str, show_id: str, price: str, updated: str) -> str:
    return f"""SELECT {show_id} AS show_id, p_brand AS movie_id, p_partkey % 110 AS venue_id,
  CAST(p_size % 10 + 1 AS INTEGER) AS screen_no,
  TIMESTAMP '2024-02-01 10:00:00' + to_hours(CAST(p_partkey % 720 AS BIGINT)) AS show_time,
  {price} AS base_price, {_ts(updated)} AS updated_at FROM part WHERE {where}"""


_cte("landed_shows", "\nUNION ALL\n".join([
    _show_rows("true", "p_partkey", "p_retailprice", BASE_TS),
    _show_rows("p_partkey % 10 = 0", "p_partkey", "p_retailprice + 10.0", "2024-01-02 00:00:00"),
    _show_rows("p_partkey = 1", "CAST(NULL AS BIGINT)", "p_retailprice", "2024-01-03 00:00:00"),
]))

_cte("landed_movies", f"""SELECT p_brand AS movie_id, p_name AS title, p_type AS genre,
  CASE p_partkey % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'HI' WHEN 2 THEN 'TA' ELSE 'TE' END AS language,
  CAST(p_size + 90 AS INTEGER) AS duration_min,
  TIMESTAMP '2023-06-01 00:00:00' - to_days(CAST(p_size AS INTEGER)) AS release_date,
  {_ts(BASE_TS)} + to_minutes(CAST(p_partkey AS BIGINT)) AS updated_at
FROM part""")

_cte("landed_seat_holds", """SELECT event_id AS hold_id, user_id AS show_id, json_extract_string(props, '$.k') AS seat_no,
  event_id % 1000 AS user_id,
  CASE event_type WHEN 'view' THEN 'HELD' WHEN 'purchase' THEN 'BOOKED' WHEN 'click' THEN 'RELEASED'
       WHEN 'signup' THEN 'EXPIRED' WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'UNKNOWN' END END AS hold_status,
  ts AS held_at, ts AS updated_at
FROM events""")

_cte("landed_promotions", f"""SELECT CAST(s_nationkey AS BIGINT) AS promotion_id, s_name AS code,
  CASE WHEN s_suppkey % 5 = 0 THEN 'MYSTERY' WHEN s_suppkey % 5 <= 2 THEN 'FLAT' ELSE 'PERCENT' END AS discount_type,
  s_acctbal AS discount_value,
  {_ts(BASE_TS)} + to_days(CAST(s_suppkey % 30 AS INTEGER)) AS valid_from,
  {_ts(BASE_TS)} + to_days(CAST(s_suppkey % 30 + 60 AS INTEGER)) AS valid_to,
  CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'DISABLED' WHEN 2 THEN 'EXPIRED' ELSE 'ACTIVE' END AS status,
  {_ts(BASE_TS)} + to_minutes(CAST(s_suppkey AS BIGINT)) AS updated_at
FROM supplier""")

_cte("landed_promotion_redemptions", """SELECT
  CASE WHEN l_linenumber = 7 AND l_discount = 0.04 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS redemption_id,
  CASE WHEN l_linenumber = 5 AND l_discount = 0.03 THEN NULL ELSE l_suppkey % 25 END AS promotion_id,
  l_orderkey * 10 + l_linenumber AS booking_id,
  CASE WHEN l_discount = 0.1 THEN l_extendedprice * 2
       WHEN l_discount = 0.09 THEN -1.0
       ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE)
  END AS discount_amount,
  l_shipdate AS redeemed_at, l_shipdate AS updated_at
FROM lineitem WHERE l_discount > 0""")

for _e in ENTITIES:
    _cte(f"bronze_{_e}", _bronze(_e), f"landed_{_e}")

# --- silver -------------------------------------------------------------------
_cte("latest_bookings", _dedup("bronze_bookings", "bookings", "bypass"), "bronze_bookings")
_cte("live_bookings", "SELECT * FROM latest_bookings WHERE is_deleted IS NULL OR NOT is_deleted", "latest_bookings")
_cte("silver_bookings",
     f"SELECT * REPLACE (upper(trim(booking_status)) AS booking_status) FROM ({_valid('live_bookings', RULES['bookings'])})",
     "live_bookings")
_cte("quarantine_bookings", _quarantined("live_bookings", RULES['bookings']), "live_bookings")

_cte("latest_payments", _dedup("bronze_payments", "payments", "bypass"), "bronze_payments")
_cte("quarantine_payments", _quarantined("latest_payments", RULES["payments"]), "latest_payments")
_cte("silver_payments",
     f"SELECT * REPLACE (upper(trim(payment_status)) AS payment_status) FROM ({_valid('latest_payments', RULES['payments'])})",
     "latest_payments")

for _e in ("users", "venues", "movies", "shows"):
    _cte(f"silver_{_e}", _dedup(f"bronze_{_e}", _e, "drop"), f"bronze_{_e}")
    _cte(f"quarantine_{_e}", f"SELECT *, '{_e[:-1]}_id_present' AS _dq_failures FROM bronze_{_e} WHERE {_e[:-1]}_id IS NULL", f"bronze_{_e}")

_cte("valid_seat_holds", _valid("bronze_seat_holds", RULES["seat_holds"]), "bronze_seat_holds")
_cte("silver_seat_holds", _dedup("valid_seat_holds", "seat_holds", "drop"), "valid_seat_holds")
_cte("quarantine_seat_holds", _quarantined("bronze_seat_holds", RULES["seat_holds"]), "bronze_seat_holds")

_cte("valid_promotions", _valid("bronze_promotions", RULES["promotions"]), "bronze_promotions")
_cte("silver_promotions", _dedup("valid_promotions", "promotions", "drop"), "valid_promotions")
_cte("quarantine_promotions", _quarantined("bronze_promotions", RULES["promotions"]), "bronze_promotions")

_cte("latest_redemptions", _dedup("bronze_promotion_redemptions", "promotion_redemptions", "bypass"),
     "bronze_promotion_redemptions")
_cte("silver_promotion_redemptions", _valid("latest_redemptions", RULES["promotion_redemptions"]), "latest_redemptions")
_cte("quarantine_redemptions", _quarantined("latest_redemptions", RULES["promotion_redemptions"]), "latest_redemptions")

# --- dimensions -----------------------------------------------------------------
for _d, _src in (("dim_venue", "venues"), ("dim_show", "shows"), ("dim_user", "users")):
    _cte(_d, f"SELECT *, {_ts(DIM_AS_OF)} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
             f"true AS is_current FROM silver_{_src}", f"silver_{_src}")

_cte("venues_next", """SELECT * REPLACE (CASE WHEN venue_id % 10 = 0 THEN capacity + 60 ELSE capacity END AS capacity)
FROM silver_venues WHERE venue_id % 17 <> 3
UNION ALL BY NAME
SELECT * REPLACE (venue_id + 100000 AS venue_id) FROM silver_venues WHERE venue_id % 25 = 0""", "silver_venues")

_cte("venues_third", """SELECT * REPLACE (
  CASE WHEN venue_id % 20 = 0 THEN capacity + 30 ELSE capacity END AS capacity,
  CASE WHEN venue_id % 9 = 4 THEN venue_name || ' II' ELSE venue_name END AS venue_name) FROM venues_next""", "venues_next")

_cte("shows_next", """SELECT * REPLACE (
  CASE WHEN show_id % 9 = 0 THEN base_price + 25.0 ELSE base_price END AS base_price,
  CASE WHEN show_id % 14 = 1 THEN NULL ELSE screen_no END AS screen_no,
  CASE WHEN show_id % 8 = 2 THEN show_time + INTERVAL 1 HOUR ELSE show_time END AS show_time)
FROM silver_shows WHERE show_id % 23 <> 5
UNION ALL BY NAME
SELECT * REPLACE (show_id + 5000000 AS show_id) FROM silver_shows WHERE show_id % 40 = 0""", "silver_shows")

_cte("users_next", """SELECT * REPLACE (
  CASE WHEN user_id % 11 = 0 THEN city || ' North' ELSE city END AS city,
  CASE WHEN user_id % 31 = 2 THEN NULL ELSE name END AS name,
  CASE WHEN user_id % 13 = 0 THEN '+440000000000' ELSE phone END AS phone) FROM silver_users""", "silver_users")


def _merged(dim: str, snapshot: str, key: str, tracked: list[str], as_of: str, close_missing: bool = False) -> str:
    """Rows of ``dim`` after a merge, case by case."""
    changed = "(" + " OR ".join(f"c.{t} IS DISTINCT FROM n.{t}" for t in tracked) + ")"
    ended = f"c.* REPLACE ({_ts(as_of)} AS effective_end, false AS is_current)"
    gone = ended if close_missing else "c.*"
    return f"""SELECT * FROM {dim} WHERE NOT is_current
UNION ALL BY NAME
SELECT {gone} FROM {dim} c WHERE c.is_current AND c.{key} NOT IN (SELECT {key} FROM {snapshot})
UNION ALL BY NAME
SELECT c.* FROM {dim} c JOIN {snapshot} n ON c.{key} = n.{key} WHERE c.is_current AND NOT {changed}
UNION ALL BY NAME
SELECT {ended} FROM {dim} c JOIN {snapshot} n ON c.{key} = n.{key} WHERE c.is_current AND {changed}
UNION ALL BY NAME
SELECT n.*, {_ts(as_of)} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, true AS is_current
FROM {snapshot} n LEFT JOIN (SELECT * FROM {dim} WHERE is_current) c ON c.{key} = n.{key}
WHERE c.{key} IS NULL OR {changed}"""


_VENUE = ("venue_id", ["capacity", "venue_name"])
_cte("scd2_merge_venue", _merged("dim_venue", "venues_next", *_VENUE, MERGE_AS_OF), "dim_venue", "venues_next")
_cte("scd2_close_missing_venue", _merged("dim_venue", "venues_next", *_VENUE, MERGE_AS_OF, True), "dim_venue", "venues_next")
_cte("scd2_three_snapshots_venue", _merged("scd2_merge_venue", "venues_third", *_VENUE, THIRD_AS_OF),
     "scd2_merge_venue", "venues_third")
_cte("scd2_merge_show", _merged("dim_show", "shows_next", "show_id", ["base_price", "screen_no"], MERGE_AS_OF),
     "dim_show", "shows_next")
_cte("scd2_merge_user", _merged("dim_user", "users_next", "user_id", ["city", "name"], MERGE_AS_OF), "dim_user", "users_next")

# the dimensions after two deliveries: what had come by the second day, then everything
for _d, _src, _key, _tracked in (("dim_venue", "venues", "venue_id", ["capacity", "venue_name"]),
                                 ("dim_show", "shows", "show_id", ["base_price", "screen_no"]),
                                 ("dim_user", "users", "user_id", ["city", "name"])):
    _cte(f"early_{_src}", f"SELECT * FROM bronze_{_src} WHERE updated_at < {_ts('2024-01-02 00:00:00')}", f"bronze_{_src}")
    _cte(f"{_d}_early", f"SELECT *, {_ts(DIM_AS_OF)} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
                        f"true AS is_current FROM ({_dedup(f'early_{_src}', _src, 'drop')})", f"early_{_src}")
    _cte(f"{_d}_twice", _merged(f"{_d}_early", f"silver_{_src}", _key, _tracked, MERGE_AS_OF), f"{_d}_early", f"silver_{_src}")

# --- facts and marts -----------------------------------------------------------
_cte("fact_bookings", """SELECT b.*, s.movie_id, s.venue_id, s.show_time, s.base_price,
  CASE WHEN b.booking_status = 'CONFIRMED' THEN b.total_amount ELSE 0.0 END AS revenue,
  CAST(b.booking_time AS DATE) AS booking_date
FROM silver_bookings b
LEFT JOIN (SELECT show_id, movie_id, venue_id, show_time, base_price FROM dim_show WHERE is_current) s
  ON b.show_id = s.show_id""", "silver_bookings", "dim_show")

_cte("fact_payments", """SELECT p.*, f.venue_id, f.movie_id, f.booking_status AS booking_status_at_fact_time
FROM silver_payments p LEFT JOIN fact_bookings f ON p.booking_id = f.booking_id""", "silver_payments", "fact_bookings")

_cte("fact_seat_occupancy", """SELECT s.show_id, s.venue_id, s.show_time, v.capacity,
  coalesce(o.occupied_seats, 0) AS occupied_seats,
  CASE WHEN v.capacity IS NOT NULL AND v.capacity > 0
       THEN round(coalesce(o.occupied_seats, 0) / v.capacity * 100, 2) END AS occupancy_pct
FROM (SELECT show_id, venue_id, show_time FROM dim_show WHERE is_current) s
LEFT JOIN (SELECT venue_id, capacity FROM dim_venue WHERE is_current) v ON s.venue_id = v.venue_id
LEFT JOIN (SELECT show_id, count(DISTINCT seat_no) AS occupied_seats FROM silver_seat_holds
           WHERE hold_status IN ('HELD', 'BOOKED') GROUP BY show_id) o ON s.show_id = o.show_id""",
     "dim_show", "dim_venue", "silver_seat_holds")

_cte("fact_promotion_redemptions", """SELECT r.*, p.code, p.discount_type, f.venue_id, f.movie_id,
  f.revenue AS gross_revenue, greatest(f.revenue - r.discount_amount, 0.0) AS net_revenue
FROM silver_promotion_redemptions r
LEFT JOIN (SELECT promotion_id, code, discount_type FROM silver_promotions) p ON r.promotion_id = p.promotion_id
LEFT JOIN fact_bookings f ON r.booking_id = f.booking_id""",
     "silver_promotion_redemptions", "silver_promotions", "fact_bookings")


def _money_sum(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


_cte("gold_daily_revenue", f"""SELECT booking_date, venue_id, {_money_sum('revenue')} AS total_revenue,
  count(*) FILTER (WHERE booking_status = 'CANCELLED') AS cancelled_count,
  count(booking_id) AS total_bookings, CAST(sum(num_seats) AS BIGINT) AS total_seats_booked
FROM fact_bookings GROUP BY booking_date, venue_id""", "fact_bookings")

_cte("gold_promotion_performance", f"""SELECT promotion_id, code, count(redemption_id) AS total_redemptions,
  {_money_sum('discount_amount')} AS total_discount_given, {_money_sum('net_revenue')} AS total_net_revenue
FROM fact_promotion_redemptions GROUP BY promotion_id, code""", "fact_promotion_redemptions")

_cte("gold_user_booking_summary", f"""SELECT u.user_id, u.city, u.signup_date,
  coalesce(p.total_bookings, 0) AS total_bookings, coalesce(p.lifetime_spend, 0.0) AS lifetime_spend,
  coalesce(p.cancelled_bookings, 0) AS cancelled_bookings,
  p.first_booking_date, p.last_booking_date, p.avg_seats_per_booking,
  coalesce(CASE WHEN p.total_bookings > 0 THEN round(p.cancelled_bookings / p.total_bookings, 4) ELSE 0.0 END, 0.0)
    AS cancellation_rate
FROM (SELECT user_id, city, signup_date FROM dim_user WHERE is_current) u
LEFT JOIN (SELECT user_id, count(booking_id) AS total_bookings, {_money_sum('revenue')} AS lifetime_spend,
             count(*) FILTER (WHERE booking_status = 'CANCELLED') AS cancelled_bookings,
             min(booking_date) AS first_booking_date, max(booking_date) AS last_booking_date,
             avg(num_seats) AS avg_seats_per_booking
           FROM fact_bookings GROUP BY user_id) p ON u.user_id = p.user_id""", "fact_bookings", "dim_user")


def _masked(privileged: bool) -> str:
    if privileged:
        email, phone = "email", "phone"
    else:
        # first character, three stars, everything from the last @ on
        email = ("CASE WHEN email IS NULL THEN NULL WHEN strpos(substr(email, 2), '@') > 0 "
                 "THEN left(email, 1) || '***@' || list_last(string_split(email, '@')) ELSE '***' END")
        phone = "CASE WHEN phone IS NULL THEN NULL WHEN length(phone) > 4 THEN '******' || right(phone, 4) ELSE '******' END"
    return (f"SELECT user_id, {email} AS email, {phone} AS phone, city, signup_date, "
            "effective_start, effective_end, is_current FROM dim_user")


# --- reports -----------------------------------------------------------------------
def _expectation_report(table_of: dict[str, str]) -> str:
    parts = []
    for table, expectations in EXPECTATIONS.items():
        for name, sql in expectations:
            ok = f"coalesce(({sql}), false)"
            parts.append(f"SELECT '{table_of[table]}' AS table_name, '{name}' AS expectation, "
                         f"count(*) FILTER (WHERE {ok}) AS passed_records, "
                         f"count(*) FILTER (WHERE NOT {ok}) AS failed_records FROM {table_of[table]}")
    return with_ctes("\nUNION ALL\n".join(parts), *table_of.values())


def _layer_row_counts(instead: dict[str, str]) -> str:
    tables = [(layer, t) for layer, names in LAYERS.items() for t in names]
    parts = [f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {instead.get(t, t)}" for layer, t in tables]
    return with_ctes("\nUNION ALL\n".join(parts), *[instead.get(t, t) for _, t in tables])


#: every so many landed lines of an entity are landed once more, cut off
CUT_LINES = {
    "users": "user_id % 101 = 0", "venues": "venue_id % 11 = 0", "movies": "duration_min % 13 = 0", "shows": "show_id % 101 = 0",
    "bookings": "booking_id % 1009 = 0", "payments": "payment_id % 1009 = 0", "seat_holds": "hold_id % 101 = 0",
    "promotions": "promotion_id % 7 = 0", "promotion_redemptions": "redemption_id % 1009 = 0",
}
#: what is left of an entity's rows that were landed whole
OUTCOMES = {
    "users": ("silver_users", None), "venues": ("silver_venues", None), "movies": ("silver_movies", None),
    "shows": ("silver_shows", None), "bookings": ("silver_bookings", "quarantine_bookings"),
    "payments": ("silver_payments", "quarantine_payments"), "seat_holds": ("silver_seat_holds", "quarantine_seat_holds"),
    "promotions": ("silver_promotions", "quarantine_promotions"),
    "promotion_redemptions": ("silver_promotion_redemptions", "quarantine_redemptions"),
}


def _quarantine_malformed() -> str:
    """Per entity: lines landed, cut off, valid, quarantined, and versions that
    a newer one or a delete supersedes."""
    parts, names = [], []
    for entity, (_, keys, _) in ENTITIES.items():
        valid, quarantined = OUTCOMES[entity]
        landed = f"landed_{entity}"
        no_key = " OR ".join(f"{k} IS NULL" for k in keys)
        bad = f"(SELECT count(*) FROM {quarantined})" if quarantined else f"(SELECT count(*) FROM {landed} WHERE {no_key})"
        cut = f"(SELECT count(*) FROM {landed} WHERE {CUT_LINES[entity]})"
        good = f"(SELECT count(*) FROM {valid})"
        parts.append(
            f"SELECT '{entity}' AS entity, (SELECT count(*) FROM {landed}) + {cut} AS landed_lines, {cut} AS malformed_lines, "
            f"{good} AS valid_rows, {bad} + {cut} AS quarantined_rows, "
            f"(SELECT count(*) FROM {landed}) - {good} - {bad} AS superseded_rows"
        )
        names += [landed, valid, *([quarantined] if quarantined else [])]
    return with_ctes("\nUNION ALL\n".join(parts), *names)


def _select(table: str) -> str:
    return with_ctes(f"SELECT * FROM {table}", table)


def _top(table: str, order: str) -> str:
    return with_ctes(f"SELECT * FROM {table} ORDER BY {order} LIMIT 10", table)


def oracle_sql() -> dict[str, str]:
    q = {name: _select(name) for name in (
        "latest_bookings", "silver_bookings", "quarantine_bookings", "silver_payments", "silver_users",
        "silver_venues", "silver_movies", "silver_shows", "silver_seat_holds", "quarantine_seat_holds",
        "silver_promotions", "quarantine_promotions", "silver_promotion_redemptions", "dim_show", "dim_venue",
        "quarantine_payments", "quarantine_redemptions", "quarantine_users", "quarantine_venues", "quarantine_movies",
        "quarantine_shows", "dim_user", "scd2_merge_venue", "scd2_merge_show",
        "scd2_merge_user", "scd2_three_snapshots_venue", "scd2_close_missing_venue", "fact_bookings", "fact_payments", "fact_seat_occupancy",
        "fact_promotion_redemptions", "gold_daily_revenue", "gold_promotion_performance",
        "gold_user_booking_summary")}
    q.update({f"bronze_{e}": with_ctes(f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM bronze_{e}", f"bronze_{e}")
              for e in ENTITIES})
    q["quarantine_malformed"] = _quarantine_malformed()
    q["dim_venue_after_failed_run"] = _select("scd2_merge_venue")
    q["incremental_dim_venue"] = _select("scd2_merge_venue")
    q["dim_venue_history"] = with_ctes("SELECT * FROM scd2_merge_venue ORDER BY venue_id, effective_start",
                                       "scd2_merge_venue")
    q["top_shows_by_occupancy"] = _top("fact_seat_occupancy", "occupancy_pct DESC NULLS LAST, show_id ASC NULLS LAST")
    q["top_promotions"] = _top("gold_promotion_performance",
                               "total_net_revenue DESC NULLS LAST, promotion_id ASC NULLS LAST, code ASC NULLS LAST")
    q["top_users_by_spend"] = _top("gold_user_booking_summary", "lifetime_spend DESC NULLS LAST, user_id ASC NULLS LAST")
    q["top_venue_days"] = _top("gold_daily_revenue",
                               "total_revenue DESC NULLS LAST, booking_date ASC NULLS LAST, venue_id ASC NULLS LAST")
    q["dim_user_masked"] = with_ctes(_masked(False), "dim_user")
    q["dim_user_unmasked"] = with_ctes(_masked(True), "dim_user")
    q["expectation_report"] = _expectation_report({t: t for t in EXPECTATIONS})
    q["expectation_report_bronze"] = _expectation_report({t: t.replace("silver", "bronze") for t in EXPECTATIONS})
    q["layer_row_counts"] = _layer_row_counts({})
    q["incremental_layer_row_counts"] = _layer_row_counts({d: f"{d}_twice" for d in ("dim_venue", "dim_show", "dim_user")})
    q["stream_bronze_events"] = _select("bronze_seat_holds")
    q["stream_silver_seat_state"] = _select("silver_seat_holds")
    q["stream_seat_state_resized"] = _select("silver_seat_holds")
    return q
