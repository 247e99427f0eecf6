"""DuckDB SQL of the queries in ``marquee.plans.extensions``, stated on its own."""

from __future__ import annotations

from marquee.plans.oracle import ENTITIES, LAYERS, _cte, _merged, _money_sum, _ts, with_ctes

TIMELINE = ("1995-06-01 00:00:00", "1997-06-01 00:00:00", "1999-06-01 00:00:00")

_cte("shows_third", """SELECT * REPLACE (
  CASE WHEN show_id % 18 = 0 THEN base_price + 5.0 ELSE base_price END AS base_price,
  CASE WHEN show_id % 7 = 3 THEN 99 ELSE screen_no END AS screen_no) FROM shows_next""", "shows_next")

for _src, _key, _tracked in (("shows", "show_id", ["base_price", "screen_no"]), ("venues", "venue_id", ["capacity", "venue_name"])):
    _cte(f"{_src}_t1", f"SELECT *, {_ts(TIMELINE[0])} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
                       f"true AS is_current FROM silver_{_src}", f"silver_{_src}")
    _cte(f"{_src}_t2", _merged(f"{_src}_t1", f"{_src}_next", _key, _tracked, TIMELINE[1]), f"{_src}_t1", f"{_src}_next")
    _cte(f"{_src}_t3", _merged(f"{_src}_t2", f"{_src}_third", _key, _tracked, TIMELINE[2]), f"{_src}_t2", f"{_src}_third")

_VALID = "{v}.effective_start <= b.booking_time AND (b.booking_time < {v}.effective_end OR {v}.effective_end IS NULL)"
_cte("fact_bookings_asof", f"""SELECT b.*, s.movie_id, s.venue_id, s.screen_no, s.base_price, s.effective_start AS show_version_start,
  v.venue_name, v.capacity, v.effective_start AS venue_version_start,
  CAST(CAST(s.base_price AS DECIMAL(18,2)) * b.num_seats AS DOUBLE) AS list_amount,
  CASE WHEN b.booking_status = 'CONFIRMED' THEN b.total_amount ELSE 0.0 END AS revenue
FROM silver_bookings b
LEFT JOIN shows_t3 s ON s.show_id = b.show_id AND {_VALID.format(v='s')}
LEFT JOIN venues_t3 v ON v.venue_id = s.venue_id AND {_VALID.format(v='v')}""", "silver_bookings", "shows_t3", "venues_t3")

_cte("sessions", f"""SELECT user_id, min(ts) AS session_start, max(ts) AS session_end,
  (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS duration_ms, count(*) AS n_events,
  count(*) FILTER (event_type = 'purchase') AS n_purchases, count(*) FILTER (event_type = 'error') AS n_errors,
  {_money_sum('value')} AS total_value
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM (
  SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
  FROM events)) GROUP BY user_id, n""")

_cte("velocity", """SELECT user_id, window_start, window_start + INTERVAL 12 HOUR AS window_end, count(*) AS n_events,
  count(DISTINCT event_type) AS n_items
FROM (SELECT user_id, event_type, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 11 HOUR, date_trunc('hour', ts), INTERVAL 1 HOUR)) AS window_start
  FROM events) GROUP BY user_id, window_start HAVING count(*) >= 4""")


def _region(level: str, columns: tuple[str, ...]) -> str:
    names = ", ".join(c if c in columns else f"NULL AS {c}" for c in ("state", "city", "venue_id"))
    by = f" GROUP BY {', '.join(columns)}" if columns else ""
    return (f"SELECT '{level}' AS level, {names}, count(*) AS total_bookings, "
            f"count(*) FILTER (booking_status = 'CANCELLED') AS cancelled_count, "
            f"round(count(*) FILTER (booking_status = 'CANCELLED') / count(*), 4) AS cancellation_rate, "
            f"{_money_sum('revenue')} AS total_revenue FROM placed_bookings{by}")


_cte("placed_bookings", """SELECT f.booking_status, f.revenue, f.venue_id, v.city, v.state
FROM fact_bookings f LEFT JOIN (SELECT venue_id, city, state FROM dim_venue WHERE is_current) v ON f.venue_id = v.venue_id""",
     "fact_bookings", "dim_venue")
_cte("regional", "\nUNION ALL BY NAME\n".join([
    _region("venue", ("state", "city", "venue_id")), _region("city", ("state", "city")), _region("state", ("state",)), _region("all", ()),
]), "placed_bookings")

_cte("days", """SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM (
  SELECT CAST(min(booking_date) AS TIMESTAMP) AS a, CAST(max(booking_date) AS TIMESTAMP) AS b FROM fact_bookings)""", "fact_bookings")
_cte("dim_date", """SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(date) AS INTEGER) AS year,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) AS INTEGER) AS iso_weekday, CAST(week(date) AS INTEGER) AS iso_week, isodow(date) >= 6 AS is_weekend,
  last_day(date) = date AS is_month_end FROM days""", "days")
_cte("daily_calendar", """SELECT date, CAST(isodow(date) AS INTEGER) AS iso_weekday, n AS total_bookings, CAST(r AS DOUBLE) AS total_revenue,
  CAST(sum(r) OVER (ORDER BY date ROWS 6 PRECEDING) AS DOUBLE) AS revenue_7_days
FROM (SELECT date, count(f.booking_date) AS n, coalesce(sum(CAST(f.revenue AS DECIMAL(18,2))), 0) AS r
  FROM days LEFT JOIN fact_bookings f ON f.booking_date = date GROUP BY date)""", "days", "fact_bookings")

_DRIFT = (("bookings", "total_amount", 10000, "booking_time"), ("payments", "amount", 10000, "payment_time"),
          ("promotion_redemptions", "discount_amount", 2500, "redeemed_at"))
_cte("drift_values", "\nUNION ALL\n".join(
    f"SELECT 'bronze_{t}' AS table_name, '{c}' AS column_name, CAST(date_trunc('month', {at}) AS DATE) AS period, {c} AS v, "
    f"CAST(floor({c} / {width}.0) AS BIGINT) AS bin FROM bronze_{t} WHERE {at} IS NOT NULL" for t, c, width, at in _DRIFT
), *[f"bronze_{t}" for t, *_ in _DRIFT])
_cte("drift_periods", """SELECT *, lag(period) OVER w AS before, lag(mean) OVER w AS mean_before, lag(n_rows) OVER w AS rows_before FROM (
  SELECT table_name, column_name, period, count(*) AS n_rows, count(*) - count(v) AS n_null,
    CASE WHEN count(v) > 0 THEN CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(v) END AS mean
  FROM drift_values GROUP BY ALL) WINDOW w AS (PARTITION BY table_name, column_name ORDER BY period)""", "drift_values")
_cte("drift_bins", "SELECT table_name, column_name, period, bin, count(*) AS n FROM drift_values GROUP BY ALL", "drift_values")
_cte("drift_pairs", """SELECT p.table_name, p.column_name, p.period, p.n_rows, p.rows_before, x.bin, coalesce(a.n, 0) AS n, coalesce(b.n, 0) AS m
FROM drift_periods p
JOIN (SELECT DISTINCT p.table_name, p.column_name, p.period, d.bin FROM drift_periods p JOIN drift_bins d
  ON d.table_name = p.table_name AND d.column_name = p.column_name AND (d.period = p.period OR d.period = p.before)) x
  USING (table_name, column_name, period)
LEFT JOIN drift_bins a ON a.table_name = p.table_name AND a.column_name = p.column_name AND a.period = p.period AND a.bin IS NOT DISTINCT FROM x.bin
LEFT JOIN drift_bins b ON b.table_name = p.table_name AND b.column_name = p.column_name AND b.period = p.before AND b.bin IS NOT DISTINCT FROM x.bin""",
     "drift_periods", "drift_bins")
_cte("drift_index", """SELECT table_name, column_name, period, round(sum((p - q) * ln(p / q)), 6) AS psi FROM (
  SELECT *, (n + 0.5) / (n_rows + 0.5 * k) AS p, (m + 0.5) / (rows_before + 0.5 * k) AS q FROM (
    SELECT *, count(*) OVER (PARTITION BY table_name, column_name, period) AS k FROM (
      SELECT table_name, column_name, period, bin, CAST(n AS DOUBLE) AS n, CAST(m AS DOUBLE) AS m,
        CAST(n_rows AS DOUBLE) AS n_rows, CAST(rows_before AS DOUBLE) AS rows_before FROM drift_pairs)))
GROUP BY ALL""", "drift_pairs")
_cte("drift", """SELECT table_name, column_name, period, n_rows, n_null / n_rows AS null_share, mean AS mean_value, mean - mean_before AS mean_change, psi, coalesce(psi > 0.2, false) AS drifted
FROM drift_periods LEFT JOIN drift_index USING (table_name, column_name, period)""", "drift_periods", "drift_index")


def _token(column: str, version: str = "v1", salt: str = "salt of the test tables") -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"'{version}.' || sha256('{len(salt)}:{salt}:' || length({text}) || ':' || {text})"


def oracle_sql() -> dict[str, str]:
    table_of = {
        "ext_fact_bookings_asof": "fact_bookings_asof", "ext_clickstream_sessions": "sessions",
        "stream_clickstream_sessions": "sessions", "ext_velocity_flags": "velocity", "ext_regional_revenue": "regional",
        "ext_dim_date": "dim_date", "ext_daily_revenue_calendar": "daily_calendar", "ext_drift_report": "drift",
        "stream_live_seat_occupancy": "fact_seat_occupancy",
    }
    q = {name: with_ctes(f"SELECT * FROM {table}", table) for name, table in table_of.items()}
    q["stream_velocity_flags"] = with_ctes("SELECT * EXCLUDE (n_items) FROM velocity", "velocity")
    for name, source in (("ext_dim_movie", "silver_movies"), ("ext_dim_promotion", "silver_promotions")):
        q[name] = with_ctes(f"SELECT *, {_ts('2024-06-01 00:00:00')} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
                            f"true AS is_current FROM {source}", source)
    q["ext_tokenized_users"] = with_ctes(
        f"SELECT {_token('user_id')} AS user_token, {_token('email')} AS email_token, {_token('phone')} AS phone_token, "
        "* EXCLUDE (user_id, email, phone, name, _ingested_at) FROM dim_user", "dim_user")
    for e in ENTITIES:
        if e != "seat_holds":
            q[f"stream_bronze_{e}"] = with_ctes(f"SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM bronze_{e}", f"bronze_{e}")
    counted = [(layer, t) for layer in ("bronze", "silver") for t in LAYERS[layer]]
    q["incremental_silver_row_counts"] = with_ctes("\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}" for layer, t in counted), *[t for _, t in counted])
    q["incremental_silver_bookings"] = with_ctes("SELECT * FROM silver_bookings", "silver_bookings")
    q["bronze_of_one_ingest_date"] = with_ctes(
        f"SELECT * REPLACE ({_ts('2024-06-02 00:00:00')} AS _ingested_at) FROM bronze_payments "
        f"WHERE updated_at >= {_ts('1998-06-01 00:00:00')}", "bronze_payments")
    # joined on the raw values
    q["ext_tokenized_spend"] = with_ctes(
        f"SELECT u.city, count(*) AS total_bookings, {_money_sum('f.revenue')} AS total_revenue FROM fact_bookings f "
        "LEFT JOIN (SELECT user_id, city FROM dim_user WHERE is_current) u ON f.user_id = u.user_id GROUP BY u.city",
        "fact_bookings", "dim_user")
    return q
